"""Reading pipeline layers.

* The reader is picked from the path's extension or an explicit ``fmt`` (CSV,
  Parquet, JSON, ORC, or any ``spark.read.format`` name), so local paths,
  ``hdfs://``/``s3a://`` URIs, directories and globs all work; a missing path
  surfaces as Spark's own ``PATH_NOT_FOUND`` error.
* CSV is read with a header; the schema is inferred only when none is given
  (inference costs an extra pass over the file).  ``read_declared`` applies a declared schema by column
  name: no pass for inference, and rows that do not parse are kept, with their text in a column of its own.
* An empty layer is an error, detected with ``DataFrame.isEmpty`` (a ``limit 1``
  job in the JVM; header-only and zero-byte files are both empty).
* ``load_layers`` reads the layers a mode needs (staging once for ``both``) and
  turns a load failure into a ``LoadResult`` with the error instead of raising.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.predicates import qcol
from ..spec import Mode, parse_mode

_EXT = {".csv": "csv", ".parquet": "parquet", ".pq": "parquet", ".json": "json", ".jsonl": "json", ".orc": "orc"}


class EmptyLayerError(ValueError):
    pass


_COMPRESSION = (".gz", ".bz2", ".zst", ".snappy", ".lz4", ".deflate", ".xz")


def infer_format(path: str) -> str:
    """Reader format from the path: the last known extension, ignoring a compression suffix and
    trailing globs; directories named like ``orders.parquet/`` count too.  Default Parquet."""
    p = path.lower().rstrip("/")
    while p.endswith("/*") or p.endswith("*"):
        p = p[: p.rfind("/")] if "/" in p else ""
    for suffix in _COMPRESSION:
        if p.endswith(suffix):
            p = p[: -len(suffix)]
    for ext, fmt in _EXT.items():
        if p.endswith(ext) or f"{ext}/" in p:
            return fmt
    return "parquet"


def read_layer(
    spark: SparkSession,
    path: str,
    fmt: str | None = None,
    schema: T.StructType | str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Lazy reader for one layer."""
    fmt = fmt or infer_format(path)
    reader = spark.read.format(fmt)
    opts = dict(options or {})
    if fmt == "csv":
        opts.setdefault("header", "true")
        if schema is None:
            opts.setdefault("inferSchema", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**opts).load(path)


# the column that holds the text of a CSV row that does not parse as declared
UNPARSABLE = "_unparsable_record"


def read_declared(spark: SparkSession, path: str, declared: T.StructType, options: Mapping[str, str] | None = None) -> DataFrame:
    """CSV rows read with the declared types, in the order of the file's header.

    Only the header is looked at beforehand.  A column that is not declared is text; a declared one that the
    file lacks is absent, as ``schemachk`` reports.  A row with a value that does not fit its type, or with too few or too many values, is
    kept: the values that do not parse are NULL and ``UNPARSABLE`` holds the row's text (NULL for other rows).
    Files of one layer whose headers differ are an error.
    """
    opts = {"header": "true", **(options or {})}
    header = spark.read.options(**opts).csv(path).columns
    if UNPARSABLE in header:
        raise ValueError(f"a column is named {UNPARSABLE}")
    types = {f.name: f.dataType for f in declared.fields}
    fields = [T.StructField(c, types.get(c, T.StringType())) for c in header]
    schema = T.StructType([*fields, T.StructField(UNPARSABLE, T.StringType())])
    opts |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": UNPARSABLE, "enforceSchema": "false"}
    rows = spark.read.schema(schema).options(**opts).csv(path)
    # Spark parses the columns that a query reads: nothing of each is appended, so that all are read with this one
    nothing = F.substring(F.concat_ws("", *[qcol(c).cast("string") for c in header]), 1, 0)
    return rows.select(*[qcol(c) for c in header], F.concat(F.col(UNPARSABLE), nothing).alias(UNPARSABLE))


def ensure_not_empty(df: DataFrame, name: str) -> DataFrame:
    if df.isEmpty():
        raise EmptyLayerError(f"{name} layer is empty")
    return df


@dataclass
class LoadResult:
    ok: bool
    layers: dict[str, DataFrame] = field(default_factory=dict)
    error: str | None = None

    @property
    def source(self) -> DataFrame | None:
        return self.layers.get("source")

    @property
    def staging(self) -> DataFrame | None:
        return self.layers.get("staging")

    @property
    def target(self) -> DataFrame | None:
        return self.layers.get("target")


def load_layers(
    spark: SparkSession,
    paths: Mapping[str, str],
    mode: str | Mode = Mode.BOTH,
    fmt: str | None = None,
    schemas: Mapping[str, T.StructType | str] | None = None,
    options: Mapping[str, str] | None = None,
    check_empty: bool = True,
    declared: Mapping[str, T.StructType | None] | None = None,
) -> LoadResult:
    """Read the layers ``mode`` needs from ``paths`` (keys ``source``/``staging``/``target``).

    A CSV layer with a schema in ``declared`` is read by ``read_declared``.
    """
    mode = parse_mode(mode)
    layers: dict[str, DataFrame] = {}
    try:
        for layer in mode.layers:
            if layer not in paths or not paths[layer]:
                raise ValueError(f"no path configured for the {layer} layer")
            wanted = (declared or {}).get(layer)
            if wanted is not None and (fmt or infer_format(paths[layer])) == "csv":
                df = read_declared(spark, paths[layer], wanted, options)
            else:
                df = read_layer(spark, paths[layer], fmt, (schemas or {}).get(layer), options)
            layers[layer] = ensure_not_empty(df, layer) if check_empty else df
    except Exception as exc:
        return LoadResult(False, {}, f"{type(exc).__name__}: {exc}")
    return LoadResult(True, layers)


def read_lookup(spark: SparkSession, path: str, column: str, fmt: str | None = None, options=None) -> DataFrame:
    """Only the lookup column of the lookup dataset's target layer (column-pruned at the scan); an empty one is an error."""
    return ensure_not_empty(read_layer(spark, path, fmt, None, options).select(qcol(column)), "lookup")


@contextlib.contextmanager
def persisted(*dfs: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[tuple[DataFrame, ...]]:
    """Keep inputs that feed several jobs cached for the duration of a block, then release them."""
    for df in dfs:
        df.persist(level)
    try:
        yield dfs
    finally:
        for df in dfs:
            df.unpersist()
