"""Dataset configuration files → ``DatasetSpec`` + layer paths, and the dataset driver.

The file layout follows the original framework's two JSON documents:

``file_config``::

    {"orders_data": {
        "src_file_path": ..., "stg_file_path": ..., "trgt_file_path": ...,
        "primary_key": ["order_id"],
        "non_nullable_columns": [...]            # or "non_nullable": {"source_to_staging": [...], "staging_to_target": [...]}
        "scd_type": "type2",
        "active_flag_column": "is_active",
        "lookup": {"lookup_file": "customer_data", "lookup_column": "customer_id", "target_column": "customer_id"}}}

``schema_config``::

    {"orders_data": {"staging": [{"name": ..., "type": "IntegerType", "nullable": false}, ...], "target": [...]}}

Optional extra keys: ``format``, ``read_options``, ``read_schema`` (``"declared"``: CSV layers are read with the
schema that the schema config declares for them, ``source`` included, instead of an inferred one, and rows that do not
parse count as violations of ``schemachk``), ``cache``, ``batch_column``,
``active_values``, ``inactive_values``, ``check_nullable``, ``sample_size``,
``hot_key_rows``, ``max_hot_keys`` and ``rules`` (``[{"name", "violation", "requires"}]``).  When ``rules`` is absent
the original non-negative ``amount`` rule applies.
"""

from __future__ import annotations

import dataclasses
import json
from collections.abc import Mapping
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..plans.checks import ERROR, RESULT_SCHEMA
from ..plans.suites import run_suite
from ..spec import NON_NEGATIVE_AMOUNT, DatasetSpec, Lookup, Mode, Rule, parse_expected_schema, parse_mode
from .readers import UNPARSABLE, load_layers, persisted, read_lookup


# Keys of a dataset entry in the file config.
SOURCE_PATH, STAGING_PATH, TARGET_PATH = "src_file_path", "stg_file_path", "trgt_file_path"
PRIMARY_KEY = "primary_key"
NON_NULL_FLAT, NON_NULL_BY_STAGE = "non_nullable_columns", "non_nullable"
SCD_TYPE, ACTIVE_FLAG = "scd_type", "active_flag_column"
LOOKUP, LOOKUP_DATASET, LOOKUP_COLUMN, LOOKUP_TARGET = "lookup", "lookup_file", "lookup_column", "target_column"
# and of a dataset entry in the schema config
STAGING_SCHEMA, TARGET_SCHEMA = "staging", "target"
# ours: how CSV layers get their types
READ_SCHEMA = "read_schema"


def _load_json(value: Mapping | str | Path) -> dict:
    if isinstance(value, Mapping):
        return dict(value)
    with open(value, encoding="utf-8") as fh:
        return json.load(fh)


@dataclass(frozen=True)
class DatasetConfig:
    spec: DatasetSpec
    paths: dict[str, str]
    fmt: str | None
    read_options: dict[str, str]
    lookup_path: str | None
    lookup_fmt: str | None
    persist: bool = False
    lookup_options: dict[str, str] = dataclasses.field(default_factory=dict)
    declared: dict[str, T.StructType] | None = None


def dataset_config(name: str, file_config: Mapping | str | Path, schema_config: Mapping | str | Path | None = None) -> DatasetConfig:
    files = _load_json(file_config)
    schemas = _load_json(schema_config) if schema_config is not None else {}
    if name not in files:
        raise KeyError(f"dataset {name!r} not in the file config")
    info = files[name]
    non_null = info.get(NON_NULL_FLAT, info.get(NON_NULL_BY_STAGE, {}))
    sch = schemas.get(name, {})
    declares = info.get(READ_SCHEMA, "inferred")
    if declares not in ("inferred", "declared"):
        raise ValueError(f"{READ_SCHEMA} must be 'inferred' or 'declared', not {declares!r}")
    declares = declares == "declared"
    rules = (
        tuple(Rule(r["name"], r["violation"], tuple(r.get("requires", ()))) for r in info["rules"])
        if "rules" in info
        else (NON_NEGATIVE_AMOUNT,)
    )
    lookup_path = lookup_fmt = None
    lookup, lookup_options = None, {}
    if LOOKUP in info:
        lk = info[LOOKUP]
        other = files.get(lk[LOOKUP_DATASET])
        if other is None:
            raise KeyError(f"lookup dataset {lk[LOOKUP_DATASET]!r} not in the file config")
        lookup_path, lookup_fmt = other[TARGET_PATH], other.get("format")
        lookup_options = dict(other.get("read_options", {}))  # the lookup is a dataset of its own
        lookup = Lookup(None, lk[LOOKUP_COLUMN], lk[LOOKUP_TARGET], name=lk[LOOKUP_DATASET])
    spec = DatasetSpec(
        name=name,
        key=tuple(info[PRIMARY_KEY]),
        scd_type=info.get(SCD_TYPE, "type1"),
        non_null=non_null,
        staging_schema=parse_expected_schema(sch[STAGING_SCHEMA]) if STAGING_SCHEMA in sch else None,
        target_schema=parse_expected_schema(sch[TARGET_SCHEMA]) if TARGET_SCHEMA in sch else None,
        active_flag=info.get(ACTIVE_FLAG),
        active_values=tuple(info.get("active_values", ("Y", "TRUE", "1"))),
        inactive_values=tuple(info.get("inactive_values", ("N", "FALSE", "0"))),
        batch_column=info.get("batch_column", "batch_date"),
        rules=rules,
        lookup=lookup,
        check_nullable=bool(info.get("check_nullable", True)),
        sample_size=int(info.get("sample_size", 10)),
        hot_key_rows=int(info.get("hot_key_rows", 100_000)),
        max_hot_keys=int(info.get("max_hot_keys", 100_000)),
        unparsable_column=UNPARSABLE if declares else None,
    )
    paths = {"source": info.get(SOURCE_PATH), "staging": info.get(STAGING_PATH), "target": info.get(TARGET_PATH)}
    return DatasetConfig(
        spec, paths, info.get("format"), dict(info.get("read_options", {})), lookup_path, lookup_fmt,
        bool(info.get("cache", False)), lookup_options,
        {layer: parse_expected_schema(sch[layer]) for layer in ("source", STAGING_SCHEMA, TARGET_SCHEMA) if layer in sch} if declares else None,
    )


def validate_dataset(
    spark: SparkSession,
    name: str,
    file_config: Mapping | str | Path,
    schema_config: Mapping | str | Path | None = None,
    mode: str | Mode = Mode.BOTH,
    persist: bool = False,
    parallelism: int = 4,
) -> DataFrame:
    """Config → load → lookup → suites → result rows.

    A load failure gives a single ``load`` row with status ``Error`` and the
    reason; a lookup that cannot be read makes ``referential_integrity`` fail.
    ``persist`` caches the loaded layers (memory and disk) while the checks run
    and releases them afterwards: worth it for layers that fit the cluster's
    storage, since every check reads them; leave it off for very large layers,
    which the checks read column-pruned anyway.  ``parallelism`` is the number of
    checks submitted to Spark at once.
    """
    mode = parse_mode(mode)
    cfg = dataset_config(name, file_config, schema_config)
    loaded = load_layers(spark, cfg.paths, mode, cfg.fmt, options=cfg.read_options, declared=cfg.declared)
    if not loaded.ok:
        row = (name, "load", 0, "load", ERROR, None, {}, [], loaded.error)
        return spark.createDataFrame([row], RESULT_SCHEMA)
    spec = cfg.spec
    if spec.lookup is not None and mode is not Mode.SOURCE_TO_STAGING:
        table, error = None, ""
        try:
            # a missing path or column or an empty file fails here, not inside the check
            table = read_lookup(spark, cfg.lookup_path, spec.lookup.lookup_column, cfg.lookup_fmt, cfg.lookup_options)
        except Exception as exc:
            error = f"{type(exc).__name__}: {exc}"
        spec = dataclasses.replace(spec, lookup=dataclasses.replace(spec.lookup, table=table, error=error))
    layers = [df for df in (loaded.source, loaded.staging, loaded.target) if df is not None]
    with persisted(*(layers if persist or cfg.persist else [])):
        return run_suite(
            spark, spec, mode, source=loaded.source, staging=loaded.staging, target=loaded.target, parallelism=parallelism
        )
