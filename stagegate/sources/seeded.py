"""Pipeline layers derived from the shared test tables, with seeded defects.

The test tables are clean (no NULLs, no orphans), so the layers a pipeline would
produce are derived from them deterministically, each rule planting a defect a
check must find.  Every derivation is a lazy Spark plan over the whole table, so
its cost grows with the scale factor; nothing is written to the test-data folder.

* ``staging``  - ``orders`` loaded into staging on 2025-12-17, with price drift,
  blank/NULL priorities, lost rows and duplicated rows;
* ``target``   - three daily loads of ``orders`` (type-1 history kept) with
  lost rows, orphan customer keys and negative prices in the last load;
* ``scd2``     - ``events`` as type-2 versions per ``user_id`` with broken
  active flags for some users.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.history import append_batch, build_versions, stamp_batch
from ..operators.skew import join_key_stats

# The seeding rules (modulus, remainder) and load dates.
PRICE_DRIFT = (50, 7)          # staging o_totalprice + 1
BLANK_PRIORITY = (40, 3)       # staging o_orderpriority = three spaces
NULL_PRIORITY = (40, 4)        # staging o_orderpriority = NULL
LOST_IN_STAGING = (97, 5)      # dropped from staging and from the last target load
DUPLICATED_IN_STAGING = (200, 11)
LOST_IN_TARGET = (100, 1)      # dropped from the last target load only
ORPHAN_CUSTOMER = (500, 3)     # last load: o_custkey -> -o_custkey - 1
NEGATIVE_PRICE = (300, 9)      # last load: o_totalprice -> -o_totalprice
LINE_QTY_DRIFT = (13, 1)       # lineitem staging: l_quantity + 1 (on l_partkey)
LINE_NULL_FLAG = (17, 2)       # lineitem staging: l_returnflag NULL (on l_suppkey)
LINE_LOST = (31, 4)            # lineitem staging: rows dropped (on l_orderkey)
ALL_INACTIVE_USERS = (10, 1)   # scd2: every version flagged 'N'
TWO_ACTIVE_USERS = (10, 2)     # scd2: last two versions flagged 'Y'
LOAD_DATES = (dt.date(2025, 12, 15), dt.date(2025, 12, 16), dt.date(2025, 12, 17))

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


_SCHEMAS: dict[tuple[str, str], StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One shared test table.  Its schema is inferred once per application and then
    passed explicitly, which skips Parquet's footer-reading inference job on every read."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    cache_key = (spark.sparkContext.applicationId, path)
    schema = _SCHEMAS.get(cache_key)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[cache_key] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)


def _hit(col: str, rule: tuple[int, int]):
    m, r = rule
    return (F.col(col) % m) == r


def staging(orders: DataFrame) -> DataFrame:
    """``orders`` as loaded into staging on the last load date, with seeded defects."""
    base = orders.where(~_hit("o_orderkey", LOST_IN_STAGING)).select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.when(_hit("o_orderkey", PRICE_DRIFT), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate",
        F.when(_hit("o_orderkey", BLANK_PRIORITY), F.lit("   "))
        .when(_hit("o_orderkey", NULL_PRIORITY), F.lit(None).cast("string"))
        .otherwise(F.col("o_orderpriority"))
        .alias("o_orderpriority"),
    )
    base = stamp_batch(base, LOAD_DATES[-1])
    return base.unionByName(base.where(_hit("o_orderkey", DUPLICATED_IN_STAGING)))


def lineitem_staging(lineitem: DataFrame) -> DataFrame:
    """``lineitem`` loaded into staging with lost orders, drifted quantities and NULL return flags.

    Its key (l_orderkey, l_linenumber) repeats in the source, so consistency
    against it exercises duplicate-key pairs on real data.
    """
    return lineitem.where(~_hit("l_orderkey", LINE_LOST)).select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        F.when(_hit("l_partkey", LINE_QTY_DRIFT), F.col("l_quantity") + 1).otherwise(F.col("l_quantity")).alias("l_quantity"),
        "l_extendedprice",
        "l_discount",
        "l_tax",
        F.when(_hit("l_suppkey", LINE_NULL_FLAG), F.lit(None).cast("string")).otherwise(F.col("l_returnflag")).alias("l_returnflag"),
        "l_linestatus",
        "l_shipdate",
    )


def target(orders: DataFrame) -> DataFrame:
    """Three loads of (o_orderkey, o_custkey, o_totalprice) kept as history (type 1)."""
    cols = orders.select("o_orderkey", "o_custkey", "o_totalprice")
    first = stamp_batch(cols, LOAD_DATES[0])
    second = stamp_batch(cols, LOAD_DATES[1])
    last = cols.where(~_hit("o_orderkey", LOST_IN_STAGING) & ~_hit("o_orderkey", LOST_IN_TARGET)).select(
        "o_orderkey",
        F.when(_hit("o_orderkey", ORPHAN_CUSTOMER), -F.col("o_custkey") - 1).otherwise(F.col("o_custkey")).alias("o_custkey"),
        F.when(_hit("o_orderkey", NEGATIVE_PRICE), -F.col("o_totalprice")).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
    )
    return append_batch(append_batch(first, second), stamp_batch(last, LOAD_DATES[2]))


def scd2(events: DataFrame) -> DataFrame:
    """``events`` as type-2 versions per user, with broken flags for some users.

    Columns: user_id, event_id, event_type, value, effective_start, effective_end,
    is_active.  Versions are ordered by (ts, event_id); the end of a version is the
    start of the next one (NULL for the last).  Users with ``user_id % 10 = 1`` have
    no active version, users with ``% 10 = 2`` have two.
    """
    # Each event carries its user's last (ts, event_id); the version whose successor is that
    # last one is the second-to-last.  The per-user table is attached to the plain event scan
    # with the hot-key-safe join (a user with most of the events is not shuffled into one
    # task) and then rides through the version build as payload, so the range pass runs once.
    last = events.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"), F.max(F.struct("ts", "event_id")).alias("_last"))
    rows = join_key_stats(events.select("user_id", "event_id", "event_type", "value", "ts"), last, ["user_id"], last, "_n")
    versions = build_versions(
        rows,
        key=["user_id"],
        start="ts",
        tiebreak=["event_id"],
        start_name="effective_start",
        end_name="effective_end",
        flag_name="is_active",
        next_columns=["event_id"],
    )
    successor_is_last = F.coalesce(
        (F.col("effective_end") == F.col("_last.ts")) & (F.col("next_event_id") == F.col("_last.event_id")),
        F.lit(False),
    )
    flag = (
        F.when(_hit("user_id", ALL_INACTIVE_USERS), F.lit("N"))
        .when(_hit("user_id", TWO_ACTIVE_USERS) & successor_is_last, F.lit("Y"))
        .otherwise(F.col("is_active"))
    )
    return versions.withColumn("is_active", flag).select(
        "user_id", "event_id", "event_type", "value", "effective_start", "effective_end", "is_active"
    )
