"""Lazy violation DataFrames, one function per check.

Each function only builds a plan; nothing runs until the caller acts on the
result.  Outputs are full (no sampling): the row-level violations, or one row
per checked column / rule.  All of them are aggregate- or join-shaped so Spark
plans partial (map-side) aggregation before any shuffle, and a hot key or value
collapses to one partial row per task instead of landing whole in one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.predicates import (
    ACTIVE_FLAG_VALUES,
    INACTIVE_FLAG_VALUES,
    free_names,
    is_active,
    is_inactive,
    is_null_or_blank,
    keys_not_null,
    qcol,
)
from ..spec import Rule
from .skew import salted_stats_join


def _field_types(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def _long_form(df: DataFrame, names: Sequence[str], exprs: Sequence[Column], name_col: str, value_col: str) -> DataFrame:
    """One aggregate row → one row per name, in the given order (``stack`` in the same stage)."""
    if not names:
        spark = df.sparkSession
        return spark.createDataFrame([], T.StructType([T.StructField(name_col, T.StringType()), T.StructField(value_col, T.LongType())]))
    aliased = [e.alias(f"_v{i}") for i, e in enumerate(exprs)]
    wide = df.agg(*aliased)
    pairs = [F.struct(F.lit(n).alias(name_col), F.col(f"_v{i}").cast("bigint").alias(value_col)) for i, n in enumerate(names)]
    return wide.select(F.inline(F.array(*pairs)))


# ---------------------------------------------------------------- C2 / C8

def row_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: ``source_count``, ``target_count`` (two scalar subqueries, run concurrently)."""
    src = source.select(F.count(F.lit(1))).scalar()
    tgt = target.select(F.count(F.lit(1))).scalar()
    return source.sparkSession.range(1).select(src.alias("source_count"), tgt.alias("target_count"))


# ---------------------------------------------------------------- C3

def null_or_blank_exprs(df: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    """``count_if`` per present column (NULL, or blank after trim for strings)."""
    types = _field_types(df)
    return {c: F.count_if(is_null_or_blank(qcol(c), types[c])) for c in columns if c in types}


def null_or_blank_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_name``, ``null_count`` for every configured column, one scan for all.

    A configured column absent from ``df`` gets ``null_count`` NULL (reported as a
    failure by the check, never an exception).
    """
    exprs = null_or_blank_exprs(df, columns)
    names = list(columns)
    values = [exprs.get(c, F.lit(None).cast("bigint")) for c in names]
    return _long_form(df, names, values, "column_name", "null_count")


def null_or_blank_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The offending rows themselves, with an array of the columns they break."""
    types = _field_types(df)
    present = [c for c in columns if c in types]
    if not present:
        return df.limit(0).withColumn("violated_columns", F.array().cast("array<string>"))
    flags = [F.when(is_null_or_blank(qcol(c), types[c]), F.lit(c)) for c in present]
    return df.withColumn("violated_columns", F.filter(F.array(*flags), lambda x: x.isNotNull())).where(
        F.size("violated_columns") > 0
    )


# ---------------------------------------------------------------- C4

def duplicate_keys(df: DataFrame, key: Sequence[str], count_name: str = "n_rows") -> DataFrame:
    """Key groups with more than one row.  NULL key parts group together (two NULL keys are duplicates).

    The count's name gets a number if a key column has it.
    """
    (count_name,) = free_names(key, count_name)
    return (
        df.groupBy(*[qcol(k) for k in key])
        .agg(F.count(F.lit(1)).alias(count_name))
        .where(F.col(count_name) > 1)
    )


# ---------------------------------------------------------------- C5

def missing_keys(source: DataFrame, staging: DataFrame, key: Sequence[str]) -> DataFrame:
    """Distinct source keys with no equal key in staging.

    Matching is ``=`` on every key part, so a source key with a NULL part is
    always missing.  Both sides are reduced to distinct keys first (partial
    aggregation), so the anti join shuffles keys, never whole rows.
    """
    src = source.select(*[qcol(k) for k in key]).distinct()
    right = [f"_r{i}" for i in range(len(key))]
    stg = (
        staging.where(keys_not_null(key))
        .select(*[qcol(k).alias(r) for k, r in zip(key, right)])
        .distinct()
    )
    cond = [qcol(k) == F.col(r) for k, r in zip(key, right)]
    return src.join(stg, cond, "left_anti")


# ---------------------------------------------------------------- C7

def latest_batch_counts(staging: DataFrame, target: DataFrame, batch_column: str = "batch_date") -> DataFrame:
    """``batch_value`` = max batch in staging, and the row counts of that batch on both sides.

    The batch is a scalar subquery, so on tables partitioned by the batch column
    the filter prunes partitions at run time instead of scanning all history.
    """
    b = qcol(batch_column)
    # staging is read once: rows per batch (one row per batch), then its max and that batch's count
    per_batch = staging.groupBy(b.alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    latest = per_batch.select(F.max("_b")).scalar()
    stg_n = per_batch.where(F.col("_b") == latest).select(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint")).scalar()
    tgt_n = target.where(b == latest).select(F.count(F.lit(1))).scalar()
    return staging.sparkSession.range(1).select(
        latest.alias("batch_value"), stg_n.alias("staging_count"), tgt_n.alias("target_count")
    )


# ---------------------------------------------------------------- C9 / C10

def active_flag_violations(
    df: DataFrame, key: Sequence[str], flag: str, active_values: Iterable[str] = ACTIVE_FLAG_VALUES
) -> DataFrame:
    """Business keys whose number of active versions is not exactly one."""
    return (
        df.groupBy(*[qcol(k) for k in key])
        .agg(F.count_if(is_active(qcol(flag), active_values)).alias("active_count"))
        .where(F.col("active_count") != 1)
    )


def history_counts(
    df: DataFrame,
    flag: str,
    inactive_values: Iterable[str] = INACTIVE_FLAG_VALUES,
    active_values: Iterable[str] = ACTIVE_FLAG_VALUES,
) -> DataFrame:
    """One row: ``inactive_count`` (closed versions) and ``unknown_flag_count`` (neither active nor inactive)."""
    f = qcol(flag)
    return df.agg(
        F.count_if(is_inactive(f, inactive_values)).alias("inactive_count"),
        F.count_if(~is_inactive(f, inactive_values) & ~is_active(f, active_values)).alias("unknown_flag_count"),
    )


# ---------------------------------------------------------------- C11

def orphan_values(
    df: DataFrame, target_column: str, lookup: DataFrame, lookup_column: str, count_name: str = "n_rows"
) -> DataFrame:
    """Foreign-key values of ``df`` absent from ``lookup``, with their row counts.

    The target is first aggregated by FK value (partial aggregation collapses a
    hot FK value before the shuffle), then anti-joined with the distinct lookup
    keys.  ``sum(n_rows)`` is the reference's orphan row count.  A NULL FK never
    matches, so it is an orphan.
    """
    fk = df.groupBy(qcol(target_column)).agg(F.count(F.lit(1)).alias(count_name))
    keys = lookup.select(qcol(lookup_column).alias("_lookup_key")).where(F.col("_lookup_key").isNotNull()).distinct()
    return fk.join(keys, qcol(target_column) == F.col("_lookup_key"), "left_anti")


def orphan_rows(df: DataFrame, target_column: str, lookup: DataFrame, lookup_column: str) -> DataFrame:
    """The target rows whose FK has no match (row-level diagnostics).

    The orphan FK values come from ``orphan_values`` (aggregated first).  Usually
    they are few and Spark broadcasts them; otherwise the rows of a value that
    holds a large share are spread by ``salted_stats_join``.  Rows with a NULL FK are
    orphans too and come out of the same pass: the target is read twice in all.
    """
    fk, n = free_names(df.columns, "_fk", "_n")
    orphans = orphan_values(df, target_column, lookup, lookup_column, count_name=n)
    stats = orphans.where(qcol(target_column).isNotNull()).select(qcol(target_column).alias(fk), n)
    joined = salted_stats_join(df.withColumn(fk, qcol(target_column)), stats, [fk], n, how="left")
    return joined.where(F.col(n).isNotNull() | F.col(fk).isNull()).select(*[qcol(c) for c in df.columns])


# a filter block is one long, and a key sets this many of its bits
_BITS = 4
_BITS_PER_KEY = 16
MOST_BLOCKS = 1 << 20


def key_filter(keys: DataFrame, column: str, expected: int, most_blocks: int = MOST_BLOCKS) -> tuple[DataFrame, int]:
    """A blocked Bloom filter of ``column``: (block, bits) rows, at most ``most_blocks`` of them, and the number of blocks.

    A key's hash names its block, a 64-bit word, and four bits of it.  At 16 bits a key about 1 value in 200 that
    is not in ``keys`` seems to be (at 8 bits 1 in 30, at 4 bits 1 in 6); none that is seems not to be.  With
    2^20 blocks that is 4 million keys at 16 bits and 17 million at 4.
    """
    blocks = 1
    while blocks < most_blocks and blocks * 64 < expected * _BITS_PER_KEY:
        blocks *= 2
    marked = keys.select(*_marks(qcol(column), blocks)).where("_block IS NOT NULL")
    return marked.groupBy("_block").agg(F.bit_or("_bits").alias("_held")), blocks


def _marks(value: Column, blocks: int) -> list[Column]:
    h = F.xxhash64(value)
    bits = F.lit(0).cast("long")
    for i in range(_BITS):
        place = F.shiftrightunsigned(h, 32 + 6 * i).bitwiseAND(F.lit(63)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return [F.when(value.isNotNull(), h.bitwiseAND(F.lit(blocks - 1))).alias("_block"), bits.alias("_bits")]


def orphan_values_filtered(
    df: DataFrame, target_column: str, lookup: DataFrame, lookup_column: str, expected: int, count_name: str = "n_rows", most_blocks: int = MOST_BLOCKS
) -> DataFrame:
    """``orphan_values`` for a lookup too large to broadcast: the same rows, with less of the lookup shuffled.

    A filter of the target's values, ``expected`` of them or so, is broadcast (a bounded number of blocks) and read by the scan of
    the lookup: keys that are certainly not among the values leave there, and only the others go into the
    exact anti join.  A filter of the lookup's keys does the same for the target's values: those that certainly miss are orphans
    without meeting the lookup.  Where there are many more values than the filter has room for it lets most pass, and the
    result is still exact.
    """
    fk_name, word = free_names([target_column, count_name], "_fk", "_w")
    fk = df.groupBy(qcol(target_column).alias(fk_name)).agg(F.count(F.lit(1)).alias(count_name))
    keys = lookup.select(qcol(lookup_column).cast(df.schema[target_column].dataType).alias("_lookup_key")).where("_lookup_key IS NOT NULL")

    def passed(rows: DataFrame, column: str, held: DataFrame, blocks: int, hit: bool) -> DataFrame:
        block, bits = _marks(qcol(column), blocks)
        met = rows.withColumns({"_block": block, word: bits}).join(F.broadcast(held), "_block", "left")
        maybe = F.coalesce(F.col("_held").bitwiseAND(F.col(word)) == F.col(word), F.lit(False))
        return met.where(maybe if hit else ~maybe).select(*[qcol(c) for c in rows.columns])

    values, n = key_filter(fk, fk_name, expected, most_blocks)
    near = passed(keys, "_lookup_key", values, n, True).distinct()
    # of the lookup only keys that seem to be among the values are left: no more than them, but for the few false ones
    known, m = key_filter(near, "_lookup_key", expected, most_blocks)
    misses = passed(fk, fk_name, known, m, False)
    rest = passed(fk, fk_name, known, m, True).join(near, F.col(fk_name) == F.col("_lookup_key"), "left_anti")
    return misses.unionByName(rest).withColumnRenamed(fk_name, target_column)


# ---------------------------------------------------------------- C12

def rule_exprs(df: DataFrame, rules: Sequence[Rule]) -> dict[str, Column]:
    """``count_if(violation)`` per applicable rule.  NULL predicate results do not count."""
    return {r.name: F.count_if(F.coalesce(r.predicate(), F.lit(False))) for r in rules if r.applies_to(df)}


def rule_violation_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``rule``, ``violations`` for every applicable rule, all in one scan."""
    exprs = rule_exprs(df, rules)
    return _long_form(df, list(exprs), list(exprs.values()), "rule", "violations")


def rule_violation_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    applicable = [r for r in rules if r.applies_to(df)]
    flags = [F.when(F.coalesce(r.predicate(), F.lit(False)), F.lit(r.name)) for r in applicable]
    if not flags:
        return df.limit(0).withColumn("violated_rules", F.array().cast("array<string>"))
    return df.withColumn("violated_rules", F.filter(F.array(*flags), lambda x: x.isNotNull())).where(
        F.size("violated_rules") > 0
    )
