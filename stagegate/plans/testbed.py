"""Dataset definitions over the shared test tables, used by the registered queries.

Two datasets:

* ``orders`` (type 1): source = ``orders``, staging and target derived with seeded
  defects (``sources.seeded``), lookup ``customer.c_custkey`` for ``o_custkey``;
* ``events`` (type 2): staging = the distinct users of ``events``, target = the
  type-2 history of ``events`` per user.

The SQL strings here are the DuckDB oracles of the suite-level queries.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.history import insert_load, merge_versions, scd2_load
from ..session import shared_folder
from ..sources import seeded, sinks
from ..sources.config import validate_dataset
from ..sources.readers import persisted
from ..spec import DatasetSpec, Lookup, Mode, Rule, ScdType, Stage, parse_expected_schema
from .suites import run_suite

STAGING_EXPECTED = parse_expected_schema(
    [
        {"name": "o_orderkey", "type": "IntegerType", "nullable": False},
        {"name": "o_custkey", "type": "bigint"},
        {"name": "o_totalprice", "type": "double"},
        {"name": "o_orderdate", "type": "date"},
        {"name": "o_orderpriority", "type": "StringType"},
        {"name": "batch_date", "type": "StringType", "nullable": False},
        {"name": "o_comment", "type": "StringType"},
    ]
)

TARGET_EXPECTED = parse_expected_schema(
    [
        {"name": "o_orderkey", "type": "bigint", "nullable": False},
        {"name": "o_custkey", "type": "bigint"},
        {"name": "o_totalprice", "type": "double"},
        {"name": "batch_date", "type": "date", "nullable": False},
        {"name": "o_orderdate", "type": "string"},
    ]
)

SCD_EXPECTED = parse_expected_schema(
    [
        {"name": "user_id", "type": "bigint", "nullable": False},
        {"name": "event_id", "type": "bigint"},
        {"name": "event_type", "type": "string"},
        {"name": "value", "type": "double"},
        {"name": "effective_start", "type": "timestamp_ntz"},
        {"name": "effective_end", "type": "timestamp_ntz"},
        {"name": "is_active", "type": "string", "nullable": False},
    ]
)

# DuckDB literal of the issues ``compare_schemas(staging.schema, STAGING_EXPECTED)`` must give.
SCHEMACHK_ORACLE = """SELECT * FROM (VALUES
  ('o_orderkey', 'type', 'bigint', 'int'),
  ('o_orderkey', 'nullable', 'true', 'false'),
  ('o_orderdate', 'type', 'timestamp_ntz', 'date'),
  ('batch_date', 'type', 'date', 'string'),
  ('o_comment', 'missing', NULL, 'string'),
  ('o_orderstatus', 'extra', 'string', NULL)
) AS t(field_name, issue, actual, expected)"""

TARGET_RULES = (Rule("non_negative_price", "o_totalprice < 0", ("o_totalprice",)),)
SCD_RULES = (Rule("non_negative_value", "`value` < 0", ("value",)),)


def orders_spec(lookup: DataFrame | None) -> DatasetSpec:
    return DatasetSpec(
        name="orders",
        key=("o_orderkey",),
        scd_type=ScdType.TYPE1,
        non_null={
            Stage.SOURCE_TO_STAGING: ("o_orderkey", "o_orderpriority"),
            Stage.STAGING_TO_TARGET: ("o_orderkey", "o_custkey"),
        },
        staging_schema=STAGING_EXPECTED,
        target_schema=TARGET_EXPECTED,
        rules=TARGET_RULES,
        lookup=Lookup(lookup, "c_custkey", "o_custkey", name="customer") if lookup is not None else None,
    )


EVENTS_SPEC = DatasetSpec(
    name="events",
    key=("user_id",),
    scd_type=ScdType.TYPE2,
    non_null=("user_id", "is_active"),
    target_schema=SCD_EXPECTED,
    active_flag="is_active",
    rules=SCD_RULES,
)


def scd2_staging(events: DataFrame) -> DataFrame:
    """The type-2 staging layer: one row per user."""
    return events.select("user_id").distinct()


def price_changes(staging: DataFrame) -> DataFrame:
    """Keyed changes: the staging prices of the drifted orders (one row per key)."""
    return staging.where((F.col("o_orderkey") % seeded.PRICE_DRIFT[0]) == seeded.PRICE_DRIFT[1]).select(
        "o_orderkey", "o_totalprice"
    )


def orders_scd2_incremental(target: DataFrame) -> DataFrame:
    """The three ``target`` loads applied one after another as type-2 merges."""
    cols = ["o_orderkey", "o_custkey", "o_totalprice"]
    loads = [target.where(F.col("batch_date") == F.lit(d)).select(*cols, "batch_date") for d in seeded.LOAD_DATES]
    history = scd2_load(loads[0].drop("batch_date"), seeded.LOAD_DATES[0])
    for load in loads[1:]:
        history = merge_versions(history, load, ["o_orderkey"], ["o_custkey", "o_totalprice"])
    return history


# the order in which the late-load query gets the loads
LATE_ORDER = (seeded.LOAD_DATES[0], seeded.LOAD_DATES[2], seeded.LOAD_DATES[1])


def orders_scd2_late(target: DataFrame) -> DataFrame:
    """The three ``target`` loads applied out of order: the same history as in order."""
    cols = ["o_orderkey", "o_custkey", "o_totalprice"]
    load = lambda d: target.where(F.col("batch_date") == F.lit(d)).select(*cols, "batch_date")
    none = F.array().cast("array<date>")
    history = scd2_load(load(LATE_ORDER[0]).drop("batch_date"), LATE_ORDER[0]).withColumn("confirmed_dates", none)
    for d in LATE_ORDER[1:]:
        history = insert_load(history, load(d), ["o_orderkey"], ["o_custkey", "o_totalprice"])
    return history.drop("confirmed_dates")


def written_target(spark: SparkSession, target: DataFrame) -> DataFrame:
    """``target`` written load by load into a table partitioned by batch, the last load twice, and read back."""
    path = f"{shared_folder(spark, 'target')}/orders"
    for d in (*seeded.LOAD_DATES, seeded.LOAD_DATES[-1]):
        sinks.write_load(target.where(F.col("batch_date") == F.lit(d)), path)
    return sinks.read_batches(spark, path, target)


# every so many orders the staging CSV holds a price that is no number
UNPARSABLE_PRICE = (60, 1)

CSV_SCHEMA = [
    {"name": "o_orderkey", "type": "bigint"},
    {"name": "o_custkey", "type": "bigint"},
    {"name": "o_orderstatus", "type": "StringType"},
    {"name": "o_totalprice", "type": "double"},
    {"name": "o_orderdate", "type": "timestamp_ntz"},
    {"name": "o_orderpriority", "type": "StringType"},
    {"name": "batch_date", "type": "date"},
]


def orders_files(spark: SparkSession, sf_dir: str) -> dict:
    """File config of ``orders`` over three unlike layers: the given table, a staging CSV and a target partitioned by batch."""
    orders = seeded.table(spark, sf_dir, "orders")
    staging, target = seeded.staging(orders), seeded.target(orders)
    folder = shared_folder(spark, "layers")
    m, r = UNPARSABLE_PRICE
    text = F.when(F.col("o_orderkey") % m == r, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    keep = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    staging.withColumn("o_totalprice", text).write.options(header="true", **keep).csv(f"{folder}/staging.csv")
    sinks.write_load(target, f"{folder}/target.parquet")
    return {
        "orders": {
            "src_file_path": f"{sf_dir}/orders.parquet",
            "stg_file_path": f"{folder}/staging.csv",
            "trgt_file_path": f"{folder}/target.parquet",
            "read_schema": "declared",
            "primary_key": ["o_orderkey"],
            "non_nullable": {"source_to_staging": ["o_orderkey", "o_orderpriority"], "staging_to_target": ["o_orderkey", "o_custkey"]},
            "lookup": {"lookup_file": "customer", "lookup_column": "c_custkey", "target_column": "o_custkey"},
            "rules": [{"name": "non_negative_price", "violation": "o_totalprice < 0", "requires": ["o_totalprice"]}],
        },
        "customer": {"trgt_file_path": f"{sf_dir}/customer.parquet", "primary_key": ["c_custkey"]},
    }


def config_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result rows of the dataset driver over those layers; the staging CSV is read as declared."""
    return validate_dataset(spark, "orders", orders_files(spark, sf_dir), {"orders": {"staging": CSV_SCHEMA}})


def load_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the dataset driver reports for a good load, an empty layer, a missing file and a layer without a path.

    A row per result: dataset, stage, check, status, the kind of error, and the rows counted.
    """
    path = f"{sf_dir}/orders.parquet"
    folder = shared_folder(spark, "guards")
    seeded.table(spark, sf_dir, "orders").where("o_orderkey IS NULL").write.parquet(f"{folder}/empty.parquet")
    entry = lambda staging: {"src_file_path": path, "stg_file_path": staging, "primary_key": ["o_orderkey"]}
    files = {"good": entry(path), "empty": entry(f"{folder}/empty.parquet"), "gone": entry(f"{folder}/gone.parquet"), "unnamed": entry(None)}
    results = [validate_dataset(spark, name, files, mode=Mode.SOURCE_TO_STAGING) for name in files]
    rows = results[0]
    for r in results[1:]:
        rows = rows.unionByName(r)
    error = F.when(F.col("status") == "Error", F.regexp_extract("details", "^([A-Za-z]+):", 1))
    return rows.select("dataset", "stage", "check", "status", error.alias("error"), F.try_element_at("metrics", F.lit("target_count")).alias("n_rows"))


LOAD_GUARDS_ORACLE = """SELECT 'good' AS dataset, 'source_to_staging' AS stage, c AS "check", 'Success' AS status, CAST(NULL AS VARCHAR) AS error,
       CASE WHEN c = 'count_val' THEN (SELECT count(*) FROM orders) END AS n_rows
FROM (VALUES ('schemachk'), ('count_val'), ('null_val'), ('primary_key_val'), ('data_completeness'), ('data_consistency')) AS t(c)
UNION ALL
SELECT d, 'load', 'load', 'Error', e, NULL
FROM (VALUES ('empty', 'EmptyLayerError'), ('gone', 'AnalysisException'), ('unnamed', 'ValueError')) AS t(d, e)"""


def _merge_step(prev: str, load: str, name: str) -> str:
    return f"""
c_{name} AS (
  SELECT b.* FROM {load} b LEFT JOIN (SELECT * FROM {prev} WHERE is_active = 'Y') h ON b.o_orderkey = h.o_orderkey
  WHERE h.o_orderkey IS NULL OR b.o_custkey IS DISTINCT FROM h.o_custkey OR b.o_totalprice IS DISTINCT FROM h.o_totalprice),
{name} AS (
  SELECT h.o_orderkey, h.o_custkey, h.o_totalprice, h.effective_start_date,
         CASE WHEN h.is_active = 'Y' AND c.o_orderkey IS NOT NULL THEN c.batch_date ELSE h.effective_end_date END
           AS effective_end_date,
         CASE WHEN h.is_active = 'Y' AND c.o_orderkey IS NOT NULL THEN 'N' ELSE h.is_active END AS is_active
  FROM {prev} h LEFT JOIN c_{name} c ON h.o_orderkey = c.o_orderkey
  UNION ALL
  SELECT o_orderkey, o_custkey, o_totalprice, batch_date, CAST(NULL AS DATE), 'Y' FROM c_{name})"""


SCD2_MERGE_ORACLE = (
    """,
l1 AS (SELECT * FROM tgt WHERE batch_date = DATE '2025-12-15'),
l2 AS (SELECT * FROM tgt WHERE batch_date = DATE '2025-12-16'),
l3 AS (SELECT * FROM tgt WHERE batch_date = DATE '2025-12-17'),
h1 AS (SELECT o_orderkey, o_custkey, o_totalprice, batch_date AS effective_start_date,
              CAST(NULL AS DATE) AS effective_end_date, 'Y' AS is_active FROM l1),"""
    + _merge_step("h1", "l2", "h2")
    + ","
    + _merge_step("h2", "l3", "h3")
    + "\nSELECT * FROM h3"
)


def suite_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result rows of both orders stages and of the events type-2 stage."""
    t = lambda name: seeded.table(spark, sf_dir, name)
    orders, events = t("orders"), t("events")
    stg, tgt = seeded.staging(orders), seeded.target(orders)
    # the type-2 history is derived (range pass + joins) and read by several checks: keep it cached
    # while they run
    scd = seeded.scd2(events)
    with persisted(scd), ThreadPoolExecutor(max_workers=2) as pool:
        a = pool.submit(run_suite, spark, orders_spec(t("customer")), Mode.BOTH, source=orders, staging=stg, target=tgt)
        b = pool.submit(run_suite, spark, EVENTS_SPEC, Mode.STAGING_TO_TARGET, staging=scd2_staging(events), target=scd)
        return a.result().unionByName(b.result())


# number of schema issues each layer has against its declared schema
_SCHEMA_ISSUES = {"orders_s2s": 6, "orders_s2t": 2, "events_s2t": 1}


def config_layers_oracle(stg: str, tgt: str) -> str:
    """The orders rows over a staging layer whose unparsable prices are NULL."""
    m, r = UNPARSABLE_PRICE
    columns = "o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority, batch_date"
    damaged = f"csv AS (SELECT {columns}, CASE WHEN o_orderkey % {m} = {r} THEN NULL ELSE o_totalprice END AS o_totalprice FROM stg)"
    rows = [x.replace("FROM stg", "FROM csv").replace("JOIN stg", "JOIN csv") for x in _suite_union(stg, tgt, "", "").split("\nUNION ALL\n") if "'orders' AS dataset" in x]
    schema = [
        f"SELECT 'orders' AS dataset, 'source_to_staging' AS stage, 'schemachk' AS \"check\", CASE WHEN n = 0 THEN 'Success' ELSE 'Fail' END AS status, CAST(n AS BIGINT) AS violation_count"
        f" FROM (SELECT count(*) AS n FROM stg WHERE o_orderkey % {m} = {r})",
        "SELECT 'orders', 'staging_to_target', 'schemachk', 'Success', CAST(0 AS BIGINT)",
    ]
    return "WITH " + ",".join([stg, tgt, damaged]) + "\n" + "\nUNION ALL\n".join(schema + [x for x in rows if "'schemachk'" not in x])


def _suite_union(stg: str, tgt: str, scd: str, scd2_stg: str) -> str:
    def row(ds, stage, check, status_ok, n):
        return (
            f"SELECT '{ds}' AS dataset, '{stage}' AS stage, '{check}' AS \"check\", "
            f"CASE WHEN {status_ok} THEN 'Success' ELSE 'Fail' END AS status, CAST({n} AS BIGINT) AS violation_count"
        )

    def schema_row(ds, stage, n):
        return row(ds, stage, "schemachk", f"{n} = 0", n)

    s2s, s2t = "source_to_staging", "staging_to_target"
    dup = "(SELECT count(*) FROM (SELECT {k} FROM {t} GROUP BY {k} HAVING count(*) > 1))"
    blank = "count(CASE WHEN {c} IS NULL OR trim({c}, ' ') = '' THEN 1 END)"
    nul = "count(CASE WHEN {c} IS NULL THEN 1 END)"
    cons = " + ".join(
        f"count(CASE WHEN s.{c} IS DISTINCT FROM t.{c} THEN 1 END)"
        for c in ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    )
    parts = [
        schema_row("orders", s2s, _SCHEMA_ISSUES["orders_s2s"]),
        row("orders", s2s, "count_val", "a = b", "abs(a - b)") + " FROM (SELECT (SELECT count(*) FROM orders) AS a, (SELECT count(*) FROM stg) AS b)",
        row("orders", s2s, "null_val", "n = 0", "n")
        + f" FROM (SELECT {nul.format(c='o_orderkey')} + {blank.format(c='o_orderpriority')} AS n FROM stg)",
        row("orders", s2s, "primary_key_val", "n = 0", "n") + f" FROM (SELECT {dup.format(k='o_orderkey', t='stg')} AS n)",
        row("orders", s2s, "data_completeness", "n = 0", "n")
        + " FROM (SELECT count(DISTINCT o_orderkey) AS n FROM orders s"
        " WHERE NOT EXISTS (SELECT 1 FROM stg t WHERE t.o_orderkey = s.o_orderkey))",
        row("orders", s2s, "data_consistency", "n = 0", "n")
        + f" FROM (SELECT {cons} AS n FROM orders s JOIN stg t ON s.o_orderkey = t.o_orderkey)",
        schema_row("orders", s2t, _SCHEMA_ISSUES["orders_s2t"]),
        row("orders", s2t, "count_val_latest_batch", "a = b", "abs(a - b)")
        + " FROM (SELECT (SELECT count(*) FROM stg WHERE batch_date = (SELECT max(batch_date) FROM stg)) AS a,"
        " (SELECT count(*) FROM tgt WHERE batch_date = (SELECT max(batch_date) FROM stg)) AS b)",
        row("orders", s2t, "null_val", "n = 0", "n")
        + f" FROM (SELECT {nul.format(c='o_orderkey')} + {nul.format(c='o_custkey')} AS n FROM tgt)",
        row("orders", s2t, "primary_key_val", "n = 0", "n") + f" FROM (SELECT {dup.format(k='o_orderkey', t='tgt')} AS n)",
        row("orders", s2t, "referential_integrity", "n = 0", "n")
        + " FROM (SELECT count(*) AS n FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = t.o_custkey))",
        row("orders", s2t, "transformation_rules", "n = 0", "n")
        + " FROM (SELECT count(CASE WHEN o_totalprice < 0 THEN 1 END) AS n FROM tgt)",
        schema_row("events", s2t, _SCHEMA_ISSUES["events_s2t"]),
        row("events", s2t, "scd_type2_record_count", "t >= s", "greatest(s - t, 0)")
        + " FROM (SELECT (SELECT count(*) FROM s2) AS s, (SELECT count(*) FROM scd) AS t)",
        row("events", s2t, "null_val", "n = 0", "n")
        + f" FROM (SELECT {nul.format(c='user_id')} + {blank.format(c='is_active')} AS n FROM scd)",
        row("events", s2t, "primary_key_val", "n = 0", "n") + f" FROM (SELECT {dup.format(k='user_id', t='scd')} AS n)",
        row("events", s2t, "scd_type2_active_flag", "n = 0", "n")
        + " FROM (SELECT count(*) AS n FROM (SELECT user_id FROM scd GROUP BY user_id"
        " HAVING count(CASE WHEN upper(trim(is_active)) IN ('Y', 'TRUE', '1') THEN 1 END) <> 1))",
        row("events", s2t, "scd_type2_history", "TRUE", "0"),
        row("events", s2t, "transformation_rules", "n = 0", "n")
        + " FROM (SELECT count(CASE WHEN value < 0 THEN 1 END) AS n FROM scd)",
    ]
    del stg, tgt, scd, scd2_stg
    return "\nUNION ALL\n".join(parts)


def suite_oracle(stg: str, tgt: str, scd: str, scd2_stg: str) -> str:
    return "WITH " + ",".join([stg, tgt, scd, scd2_stg]) + "\n" + _suite_union(stg, tgt, scd, scd2_stg)


def summary_oracle(stg: str, tgt: str, scd: str, scd2_stg: str) -> str:
    return (
        "WITH "
        + ",".join([stg, tgt, scd, scd2_stg])
        + ", r AS (\n"
        + _suite_union(stg, tgt, scd, scd2_stg)
        + """)
SELECT dataset, stage, count(*) AS total, count(CASE WHEN status = 'Success' THEN 1 END) AS passed,
       count(*) - count(CASE WHEN status = 'Success' THEN 1 END) AS failed
FROM r GROUP BY ROLLUP (dataset, stage)"""
    )
