"""One tagged aggregate over both layers of a stage, by key, that serves every key-level check.

The rows of both layers go into one ``groupBy(key)`` with fixed-width values only:
a row count per side, the least and greatest of two 64-bit hashes of the compared values, and counters
(NULLs per column, say).  Spark runs that as a hash aggregate with a map-side part, so a hot key is
one row per task before the one shuffle.  A key's rows are all equal exactly when both hashes are constant, up to a
chance of 2^-128 for a pair of unlike rows; whoever needs certainty compares the values themselves
(``consistency_parts(..., exact=True)``).

Of the per-key rows only the totals and the keys with something wrong are kept, in one
checkpoint in the shared folder: duplicate keys, keys missing on the right, keys whose rows differ.
It is as small as the data are good, and it is removed with the object that holds it
(``spark.cleaner.referenceTracking.cleanCheckpoints``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.predicates import free_names, qcol
from ..session import ensure_checkpoint_dir

KEY = "_k{}"
_ATOMIC = (T.NumericType, T.StringType, T.BinaryType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.CharType, T.VarcharType)
# the keys of one kind are broadcast up to this size, which the totals state
BROADCAST_BYTES = 32 << 20


def can_digest(types: Sequence[T.DataType]) -> bool:
    """Whether a row's values hash without a value that hides another: plain types only (a NULL inside an array would)."""
    return all(isinstance(t, _ATOMIC) for t in types)


def digests(values: Sequence[Column]) -> list[Column]:
    """Two 64-bit hashes of a row's values and of which of them are NULL."""
    nulls = [v.isNull() for v in values]
    return [F.xxhash64(F.lit(seed), *nulls, *values) for seed in (1, 2)]


@dataclass(frozen=True)
class KeyFindings:
    """What ``find`` returns: exact totals, and the keys with something wrong as (``_k0``.., ``_m``, ``_n``, ``_differs``)."""

    totals: dict[str, int]
    wrong: DataFrame
    key: tuple[str, ...]

    @property
    def kcols(self) -> list[str]:
        return [KEY.format(i) for i in range(len(self.key))]

    def _named(self, rows: DataFrame, *more: Column) -> DataFrame:
        return rows.select(*[F.col(c).alias(k) for c, k in zip(self.kcols, self.key)], *more)

    def duplicates(self, count_name: str = "n_rows") -> DataFrame:
        """Keys held by more than one row of the right side."""
        (count_name,) = free_names(self.key, count_name)
        return self._named(self.wrong.where("_n > 1"), F.col("_n").alias(count_name))

    def missing(self) -> DataFrame:
        """Left keys without an equal key on the right (a NULL part equals nothing)."""
        return self._named(self.wrong.where(_missing(self.kcols)))

    def differing(self, single: bool) -> DataFrame:
        """Keys whose rows differ: those with one row on each side, or all others."""
        one = F.expr("_m = 1 AND _n = 1")
        rows = self.wrong.where(F.col("_differs") & (one if single else ~one)).select(*self.kcols, "_m", "_n")
        return F.broadcast(rows) if self.small(single) else rows

    def small(self, single: bool) -> bool:
        """Whether the differing keys may be broadcast: their stated size is bounded."""
        return self.totals["single_bytes" if single else "multi_bytes"] <= BROADCAST_BYTES


def _whole(kcols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in kcols:
        cond = cond & F.col(c).isNotNull()
    return cond


def _missing(kcols: Sequence[str]) -> Column:
    return (F.col("_m") > 0) & ((F.col("_n") == 0) | ~_whole(kcols))


def tagged(
    left: DataFrame, right: DataFrame, key: Sequence[str], left_values: Sequence[Column] = (), right_values: Sequence[Column] = (), counters: Sequence[Column] = ()
) -> DataFrame:
    """A row per key of either side: ``_k0``.., rows ``_m`` and ``_n``, ``_same`` (all rows' values equal) and counters ``_c0``.. .

    ``left_values`` and ``right_values`` name columns by the aliases ``s`` and ``o``; ``counters`` are conditions on the
    right side, counted.  NULL keys are keys of their own here.
    """

    def side(df: DataFrame, name: str, values: Sequence[Column], is_left: bool) -> DataFrame:
        keys = [qcol(k, name).alias(KEY.format(i)) for i, k in enumerate(key)]
        hashes = [h.alias(f"_h{i}") for i, h in enumerate(digests(values))] if values else []
        counted = [(F.lit(False) if is_left else c).alias(f"_c{i}") for i, c in enumerate(counters)]
        return df.alias(name).select(*keys, F.lit(is_left).alias("_left"), *hashes, *counted)

    both = side(left, "s", left_values, True).unionByName(side(right, "o", right_values, False))
    spread = [f(f"_h{i}").alias(f"_{n}{i}") for i in (0, 1) for n, f in (("lo", F.min), ("hi", F.max))] if left_values else []
    agg = both.groupBy(*[KEY.format(i) for i in range(len(key))]).agg(
        F.count_if("_left").alias("_m"),
        F.count_if(~F.col("_left")).alias("_n"),
        *spread,
        *[F.count_if(f"_c{i}").alias(f"_c{i}") for i in range(len(counters))],
    )
    same = F.expr("_lo0 = _hi0 AND _lo1 = _hi1") if left_values else F.lit(True)
    return agg.withColumn("_same", same).drop("_lo0", "_hi0", "_lo1", "_hi1")


def find(
    left: DataFrame,
    right: DataFrame,
    key: Sequence[str],
    left_values: Sequence[Column] = (),
    right_values: Sequence[Column] = (),
    counters: dict[str, Column] | None = None,
    only_differing: bool = False,
) -> KeyFindings:
    """Run the tagged aggregate: one pass over each layer, one shuffle, one small checkpoint."""
    counters, kcols = counters or {}, [KEY.format(i) for i in range(len(key))]
    per_key = tagged(left, right, key, left_values, right_values, list(counters.values()))
    # tests of the key are tied to a count: alone, Spark would move them below the aggregate in one of its two uses, and run it twice
    both = F.when(_whole(kcols), F.least("_m", "_n")).otherwise(F.col("_m") - F.col("_m")) > 0
    differs = both & ~F.col("_same")
    per_key = per_key.withColumn("_differs", differs)
    pairs, one = F.col("_m") * F.col("_n"), F.expr("_m = 1 AND _n = 1")
    width = F.lit(16 * len(kcols) + 16)
    for c in kcols:  # an upper bound of the bytes that a key takes
        plain = isinstance(per_key.schema[c].dataType, _ATOMIC)
        width = width + (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) if plain else F.lit(1 << 16))
    total = lambda e: F.coalesce(F.sum(e), F.lit(0)).cast("bigint")
    named = {
        "left_rows": total("_m"),
        "right_rows": total("_n"),
        "duplicates": F.count_if(F.col("_n") > 1),
        "missing": F.count_if(_missing(kcols)),
        "pairs": total(F.when(both, pairs)),
        "single": F.count_if(differs & one),
        "multi": F.count_if(differs & ~one),
        "multi_pairs": total(F.when(differs & ~one, pairs)),
        "single_bytes": total(F.when(differs & one, width)),
        "multi_bytes": total(F.when(differs & ~one, width)),
        "multi_rows": total(F.when(differs & ~one, F.col("_m") + F.col("_n"))),
        "multi_most": F.coalesce(F.max(F.when(differs & ~one, F.greatest("_m", "_n"))), F.lit(0)),
        **{f"counter:{n}": total(f"_c{i}") for i, n in enumerate(counters)},
    }
    totals = per_key.agg(F.array(*named.values()).alias("_totals"))
    wanted = F.col("_differs") if only_differing else F.col("_differs") | (F.col("_n") > 1) | _missing(kcols)
    columns = [*kcols, "_m", "_n", "_differs"]
    rows = per_key.where(wanted).select(*columns, F.lit(None).cast("array<bigint>").alias("_totals"))
    nothing = [F.lit(None).cast(per_key.schema[c].dataType).alias(c) for c in columns]
    ensure_checkpoint_dir(left.sparkSession)
    kept = rows.unionByName(totals.select(*nothing, "_totals")).checkpoint()
    figures = kept.where("_totals IS NOT NULL").first()["_totals"]
    return KeyFindings(dict(zip(named, figures)), kept.where("_totals IS NULL").select(*columns), tuple(key))
