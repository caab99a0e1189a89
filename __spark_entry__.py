"""

``entry(spark)`` runs the flagship query over sf0.001: both stages of the type-1
orders pipeline and the type-2 events history, as check result rows.  ``queries()`` maps every implemented operator to
a callable ``(spark, sf_dir) -> DataFrame`` and ``oracle_sql()`` gives the same
result as DuckDB SQL over the shared test tables.  The pipeline layers the
checks need (staging, target, type-2 history) are derived from those tables
with seeded defects (``stagegate.sources.seeded``); the SQL CTEs below derive
them the same way.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

# the package sits next to this file; make it importable however this module is loaded
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagegate.operators import consistency as C
from stagegate.operators import history as H
from stagegate.operators import schema as S
from stagegate.operators import violations as V
from stagegate.plans import testbed
from stagegate.plans.checks import FAIL, SUCCESS
from stagegate.sources import seeded
from stagegate.sources.config import validate_dataset

try:  # an optional subpackage: its queries are added only where it is installed
    from stagegate.llm import queries as extra
except ImportError:
    extra = None

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: both stages of the orders pipeline plus the type-2 history suite, as result rows."""
    return testbed.suite_results(spark, SMOKE_DIR)


# ---------------------------------------------------------------- Spark side


def _t(spark, d, name):
    return seeded.table(spark, d, name)


def _stg(spark, d):
    return seeded.staging(_t(spark, d, "orders"))


def _tgt(spark, d):
    return seeded.target(_t(spark, d, "orders"))


def _scd(spark, d):
    return seeded.scd2(_t(spark, d, "events"))


def _status(ok) -> F.Column:
    return F.when(ok, F.lit(SUCCESS)).otherwise(F.lit(FAIL)).alias("status")


def q_schemachk(spark, d):
    return S.schema_issues(_stg(spark, d).schema, testbed.STAGING_EXPECTED, spark=spark)


def q_count_val(spark, d):
    r = V.row_counts(_t(spark, d, "orders"), _stg(spark, d))
    return r.select("source_count", "target_count", _status(F.col("source_count") == F.col("target_count")))


def q_null_val(spark, d):
    return V.null_or_blank_counts(_stg(spark, d), ["o_orderkey", "o_orderpriority"])


def q_null_rows(spark, d):
    return V.null_or_blank_rows(_stg(spark, d), ["o_orderkey", "o_orderpriority"]).select(
        "o_orderkey", F.array_join("violated_columns", ",").alias("violated_columns")
    )


def q_primary_key_val(spark, d):
    return V.duplicate_keys(_stg(spark, d), ["o_orderkey"])


def q_primary_key_lineitem(spark, d):
    return V.duplicate_keys(_t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_data_completeness(spark, d):
    return V.missing_keys(_t(spark, d, "orders"), _stg(spark, d), ["o_orderkey"])


def q_data_consistency(spark, d):
    return C.consistency_summary(_t(spark, d, "orders"), _stg(spark, d), ["o_orderkey"])


def q_data_consistency_keys(spark, d):
    return C.inconsistent_keys(_t(spark, d, "orders"), _stg(spark, d), ["o_orderkey"])


_LINE_KEY = ["l_orderkey", "l_linenumber"]


def q_data_consistency_lineitem(spark, d):
    li = _t(spark, d, "lineitem")
    return C.consistency_summary(li, seeded.lineitem_staging(li), _LINE_KEY)


def q_data_completeness_lineitem(spark, d):
    li = _t(spark, d, "lineitem")
    return V.missing_keys(li, seeded.lineitem_staging(li), _LINE_KEY)


def q_count_val_latest_batch(spark, d):
    r = V.latest_batch_counts(_stg(spark, d), _tgt(spark, d))
    return r.select("batch_value", "staging_count", "target_count", _status(F.col("staging_count") == F.col("target_count")))


def q_scd_type2_record_count(spark, d):
    r = V.row_counts(testbed.scd2_staging(_t(spark, d, "events")), _scd(spark, d))
    return r.select(
        F.col("source_count").alias("staging_count"),
        "target_count",
        _status(F.col("target_count") >= F.col("source_count")),
    )


def q_scd_type2_active_flag(spark, d):
    return V.active_flag_violations(_scd(spark, d), ["user_id"], "is_active")


def q_scd_type2_history(spark, d):
    return V.history_counts(_scd(spark, d), "is_active")


def q_referential_integrity(spark, d):
    return V.orphan_values(_tgt(spark, d), "o_custkey", _t(spark, d, "customer"), "c_custkey")


def q_referential_integrity_rows(spark, d):
    return V.orphan_rows(_tgt(spark, d), "o_custkey", _t(spark, d, "customer"), "c_custkey")


def q_referential_integrity_filtered(spark, d):
    return V.orphan_values_filtered(_tgt(spark, d), "o_custkey", _t(spark, d, "customer"), "c_custkey", expected=1_000_000)


def q_transformation_rule_rows(spark, d):
    rows = V.rule_violation_rows(_tgt(spark, d), testbed.TARGET_RULES)
    return rows.select("o_orderkey", "o_custkey", "o_totalprice", "batch_date", F.array_join("violated_rules", ",").alias("violated_rules"))


def q_transformation_rules(spark, d):
    return V.rule_violation_counts(_tgt(spark, d), testbed.TARGET_RULES)


def q_scd2_build(spark, d):
    return _scd(spark, d)


def q_scd1_append(spark, d):
    return H.batch_counts(_tgt(spark, d))


def q_scd1_append_rows(spark, d):
    return _tgt(spark, d)


def q_data_consistency_decimal(spark, d):
    # both sides hold more digits than a double: the last cent of a large price must count
    big = F.lit("90071992547409920000").cast("decimal(22,0)")
    wide = lambda df, t: df.select("o_orderkey", "o_custkey", (F.col("o_totalprice").cast("decimal(15,2)") + big).cast(t).alias("o_totalprice"))
    orders = _t(spark, d, "orders")
    drift = F.when(F.col("o_orderkey") % 50 == 7, F.lit("0.01").cast("decimal(3,2)")).otherwise(F.lit("0").cast("decimal(3,2)"))
    staged = wide(orders, "decimal(30,2)").withColumn("o_totalprice", (F.col("o_totalprice") + drift).cast("decimal(31,3)"))
    return C.consistency_summary(wide(orders, "decimal(26,2)"), staged, ["o_orderkey"])


def q_config_dataset(spark, d):
    path = f"{d}/lineitem.parquet"
    files = {
        "lines": {
            "src_file_path": path, "stg_file_path": path, "trgt_file_path": path,
            "primary_key": ["l_orderkey", "l_linenumber"],
            "non_nullable_columns": ["l_orderkey", "l_returnflag"],
            "batch_column": "l_shipdate",
            "lookup": {"lookup_file": "suppliers", "lookup_column": "s_suppkey", "target_column": "l_partkey"},
            "rules": [{"name": "small_quantity", "violation": "l_quantity > 45", "requires": ["l_quantity"]}],
        },
        "suppliers": {"trgt_file_path": f"{d}/supplier.parquet", "primary_key": ["s_suppkey"]},
    }
    res = validate_dataset(spark, "lines", files, mode="both")
    return res.select("dataset", "stage", "seq", "check", "status", "violation_count")


def q_scd1_latest(spark, d):
    return H.latest_per_key(_tgt(spark, d), ["o_orderkey"], ["batch_date"])


def q_scd1_apply_changes(spark, d):
    base = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    changes = testbed.price_changes(_stg(spark, d))
    return H.apply_changes(base, changes, ["o_orderkey"])


def q_scd2_load(spark, d):
    base = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return H.scd2_load(base, "2025-12-17", changes=testbed.price_changes(_stg(spark, d)), key=["o_orderkey"])


def q_scd2_merge(spark, d):
    return testbed.orders_scd2_incremental(_tgt(spark, d))


def q_scd2_rebuild(spark, d):
    # full rebuild from the log of loads, collapsing unchanged rows: equals the incremental merges
    return H.build_versions(
        _tgt(spark, d), ["o_orderkey"], "batch_date",
        start_name="effective_start_date", end_name="effective_end_date", tracked=["o_custkey", "o_totalprice"],
    )


def q_suite_results(spark, d):
    return testbed.suite_results(spark, d).select("dataset", "stage", "check", "status", "violation_count")


def q_suite_summary(spark, d):
    from stagegate.plans.suites import summarize

    return summarize(testbed.suite_results(spark, d))


def q_scd2_late_loads(spark, d):
    return testbed.orders_scd2_late(_tgt(spark, d))


def q_scd1_append_twice(spark, d):
    return testbed.written_target(spark, _tgt(spark, d))


def q_count_val_latest_partition(spark, d):
    r = V.latest_batch_counts(_stg(spark, d), testbed.written_target(spark, _tgt(spark, d)))
    return r.select("batch_value", "staging_count", "target_count", _status(F.col("staging_count") == F.col("target_count")))


def q_config_layers(spark, d):
    return testbed.config_layers(spark, d).select("dataset", "stage", "check", "status", "violation_count")


def q_load_guards(spark, d):
    return testbed.load_guards(spark, d)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {
        "schemachk": q_schemachk,
        "count_val": q_count_val,
        "null_val": q_null_val,
        "null_rows": q_null_rows,
        "primary_key_val": q_primary_key_val,
        "primary_key_lineitem": q_primary_key_lineitem,
        "data_completeness": q_data_completeness,
        "data_consistency": q_data_consistency,
        "data_consistency_keys": q_data_consistency_keys,
        "data_consistency_lineitem": q_data_consistency_lineitem,
        "data_completeness_lineitem": q_data_completeness_lineitem,
        "count_val_latest_batch": q_count_val_latest_batch,
        "scd_type2_record_count": q_scd_type2_record_count,
        "scd_type2_active_flag": q_scd_type2_active_flag,
        "scd_type2_history": q_scd_type2_history,
        "referential_integrity": q_referential_integrity,
        "referential_integrity_rows": q_referential_integrity_rows,
        "transformation_rules": q_transformation_rules,
        "transformation_rule_rows": q_transformation_rule_rows,
        "scd2_build": q_scd2_build,
        "scd1_append": q_scd1_append,
        "scd1_append_rows": q_scd1_append_rows,
        "data_consistency_decimal": q_data_consistency_decimal,
        "config_dataset": q_config_dataset,
        "scd1_latest": q_scd1_latest,
        "scd1_apply_changes": q_scd1_apply_changes,
        "scd2_load": q_scd2_load,
        "scd2_merge": q_scd2_merge,
        "scd2_rebuild": q_scd2_rebuild,
        "suite_results": q_suite_results,
        "suite_summary": q_suite_summary,
        "referential_integrity_filtered": q_referential_integrity_filtered,
        "scd2_late_loads": q_scd2_late_loads,
        "scd1_append_twice": q_scd1_append_twice,
        "count_val_latest_partition": q_count_val_latest_partition,
        "config_layers": q_config_layers,
        "load_guards": q_load_guards,
    }
    return out if extra is None else out | extra.queries()


# ---------------------------------------------------------------- DuckDB side

_STG = """
stg_base AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderkey % 50 = 7 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
         o_orderdate,
         CASE WHEN o_orderkey % 40 = 3 THEN '   ' WHEN o_orderkey % 40 = 4 THEN NULL ELSE o_orderpriority END
           AS o_orderpriority,
         DATE '2025-12-17' AS batch_date
  FROM orders WHERE o_orderkey % 97 <> 5),
stg AS (SELECT * FROM stg_base UNION ALL SELECT * FROM stg_base WHERE o_orderkey % 200 = 11)"""

_TGT = """
tgt AS (
  SELECT o_orderkey, o_custkey, o_totalprice, DATE '2025-12-15' AS batch_date FROM orders
  UNION ALL
  SELECT o_orderkey, o_custkey, o_totalprice, DATE '2025-12-16' AS batch_date FROM orders
  UNION ALL
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 500 = 3 THEN -o_custkey - 1 ELSE o_custkey END AS o_custkey,
         CASE WHEN o_orderkey % 300 = 9 THEN -o_totalprice ELSE o_totalprice END AS o_totalprice,
         DATE '2025-12-17' AS batch_date
  FROM orders WHERE o_orderkey % 97 <> 5 AND o_orderkey % 100 <> 1)"""

_SCD = """
ev AS (
  SELECT user_id, event_id, event_type, value, ts,
         lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn_desc
  FROM events),
scd AS (
  SELECT user_id, event_id, event_type, value, ts AS effective_start, nxt AS effective_end,
         CASE WHEN user_id % 10 = 1 THEN 'N'
              WHEN rn_desc = 1 THEN 'Y'
              WHEN user_id % 10 = 2 AND rn_desc = 2 THEN 'Y'
              ELSE 'N' END AS is_active
  FROM ev)"""

_LSTG = """
lstg AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
         CASE WHEN l_partkey % 13 = 1 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
         l_extendedprice, l_discount, l_tax,
         CASE WHEN l_suppkey % 17 = 2 THEN NULL ELSE l_returnflag END AS l_returnflag,
         l_linestatus, l_shipdate
  FROM lineitem WHERE l_orderkey % 31 <> 4)"""

_CHANGES = """
chg AS (SELECT o_orderkey, o_totalprice FROM stg WHERE o_orderkey % 50 = 7)"""

_SCD2_STG = """
s2 AS (SELECT DISTINCT user_id FROM events)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _sql_consistency_cols():
    return ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _config_oracle() -> str:
    compared = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    differing = " + ".join(f"count(CASE WHEN s.{c} IS DISTINCT FROM t.{c} THEN 1 END)" for c in compared)
    duplicates = "(SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))"
    blank = "(SELECT count(CASE WHEN l_orderkey IS NULL THEN 1 END) + count(CASE WHEN l_returnflag IS NULL OR trim(l_returnflag, ' ') = '' THEN 1 END) FROM lineitem)"
    checks = [
        ("source_to_staging", 1, "schemachk", "0"),
        ("source_to_staging", 2, "count_val", "0"),
        ("source_to_staging", 3, "null_val", blank),
        ("source_to_staging", 4, "primary_key_val", duplicates),
        ("source_to_staging", 5, "data_completeness", "0"),
        ("source_to_staging", 6, "data_consistency",
         f"(SELECT {differing} FROM lineitem s JOIN lineitem t ON s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber)"),
        ("staging_to_target", 1, "schemachk", "0"),
        ("staging_to_target", 2, "count_val_latest_batch", "0"),
        ("staging_to_target", 3, "null_val", blank),
        ("staging_to_target", 4, "primary_key_val", duplicates),
        ("staging_to_target", 5, "referential_integrity",
         "(SELECT count(*) FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l.l_partkey))"),
        ("staging_to_target", 6, "transformation_rules", "(SELECT count(*) FROM lineitem WHERE l_quantity > 45)"),
    ]
    rows = "\nUNION ALL\n".join(f"SELECT '{s}' AS stage, CAST({i} AS INTEGER) AS seq, '{c}' AS \"check\", CAST({n} AS BIGINT) AS violation_count" for s, i, c, n in checks)
    return f"SELECT 'lines' AS dataset, stage, seq, \"check\", CASE WHEN violation_count = 0 THEN 'Success' ELSE 'Fail' END AS status, violation_count FROM ({rows})"


def oracle_sql() -> dict[str, str]:
    cols = _sql_consistency_cols()
    pairs = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count(CASE WHEN s.{c} IS DISTINCT FROM t.{c} THEN 1 END) AS mismatches, "
        f"count(*) AS pairs FROM orders s JOIN stg t ON s.o_orderkey = t.o_orderkey"
        for c in cols
    )
    keys = "\nUNION ALL\n".join(
        f"SELECT s.o_orderkey, '{c}' AS column_name, count(*) AS mismatches FROM orders s JOIN stg t "
        f"ON s.o_orderkey = t.o_orderkey WHERE s.{c} IS DISTINCT FROM t.{c} GROUP BY s.o_orderkey"
        for c in cols
    )
    lcols = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
             "l_linestatus", "l_shipdate"]
    lpairs = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count(CASE WHEN s.{c} IS DISTINCT FROM t.{c} THEN 1 END) AS mismatches, "
        f"count(*) AS pairs FROM lineitem s JOIN lstg t ON s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber"
        for c in lcols
    )
    out = {
        "schemachk": testbed.SCHEMACHK_ORACLE,
        "data_consistency_lineitem": _with(_LSTG) + lpairs,
        "data_completeness_lineitem": _with(_LSTG)
        + """SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem s
WHERE NOT EXISTS (SELECT 1 FROM lstg t WHERE t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber)""",
        "count_val": _with(_STG)
        + """SELECT a.source_count, b.target_count,
       CASE WHEN a.source_count = b.target_count THEN 'Success' ELSE 'Fail' END AS status
FROM (SELECT count(*) AS source_count FROM orders) a, (SELECT count(*) AS target_count FROM stg) b""",
        "null_val": _with(_STG)
        + """SELECT 'o_orderkey' AS column_name, count(CASE WHEN o_orderkey IS NULL THEN 1 END) AS null_count FROM stg
UNION ALL
SELECT 'o_orderpriority', count(CASE WHEN o_orderpriority IS NULL OR trim(o_orderpriority, ' ') = '' THEN 1 END) FROM stg""",
        "null_rows": _with(_STG)
        + """SELECT o_orderkey,
       concat_ws(',', CASE WHEN o_orderkey IS NULL THEN 'o_orderkey' END,
                 CASE WHEN o_orderpriority IS NULL OR trim(o_orderpriority, ' ') = '' THEN 'o_orderpriority' END)
         AS violated_columns
FROM stg WHERE o_orderkey IS NULL OR o_orderpriority IS NULL OR trim(o_orderpriority, ' ') = ''""",
        "primary_key_val": _with(_STG)
        + "SELECT o_orderkey, count(*) AS n_rows FROM stg GROUP BY o_orderkey HAVING count(*) > 1",
        "primary_key_lineitem": "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem "
        "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
        "data_completeness": _with(_STG)
        + """SELECT DISTINCT o_orderkey FROM orders s
WHERE NOT EXISTS (SELECT 1 FROM stg t WHERE t.o_orderkey = s.o_orderkey)""",
        "data_consistency": _with(_STG) + pairs,
        "data_consistency_keys": _with(_STG) + keys,
        "count_val_latest_batch": _with(_STG, _TGT)
        + """, m AS (SELECT max(batch_date) AS b FROM stg)
SELECT m.b AS batch_value,
       (SELECT count(*) FROM stg WHERE batch_date = m.b) AS staging_count,
       (SELECT count(*) FROM tgt WHERE batch_date = m.b) AS target_count,
       CASE WHEN (SELECT count(*) FROM stg WHERE batch_date = m.b) = (SELECT count(*) FROM tgt WHERE batch_date = m.b)
            THEN 'Success' ELSE 'Fail' END AS status
FROM m""",
        "scd_type2_record_count": _with(_SCD, _SCD2_STG)
        + """SELECT a.staging_count, b.target_count,
       CASE WHEN b.target_count >= a.staging_count THEN 'Success' ELSE 'Fail' END AS status
FROM (SELECT count(*) AS staging_count FROM s2) a, (SELECT count(*) AS target_count FROM scd) b""",
        "scd_type2_active_flag": _with(_SCD)
        + """SELECT user_id, count(CASE WHEN upper(trim(CAST(is_active AS VARCHAR))) IN ('Y', 'TRUE', '1') THEN 1 END) AS active_count
FROM scd GROUP BY user_id
HAVING count(CASE WHEN upper(trim(CAST(is_active AS VARCHAR))) IN ('Y', 'TRUE', '1') THEN 1 END) <> 1""",
        "scd_type2_history": _with(_SCD)
        + """SELECT count(CASE WHEN upper(trim(CAST(is_active AS VARCHAR))) IN ('N', 'FALSE', '0') THEN 1 END) AS inactive_count,
       count(CASE WHEN coalesce(upper(trim(CAST(is_active AS VARCHAR))), '') NOT IN ('N', 'FALSE', '0', 'Y', 'TRUE', '1')
                  THEN 1 END) AS unknown_flag_count
FROM scd""",
        "referential_integrity": _with(_TGT)
        + """SELECT o_custkey, count(*) AS n_rows FROM tgt t
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = t.o_custkey)
GROUP BY o_custkey""",
        "referential_integrity_rows": _with(_TGT)
        + """SELECT * FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = t.o_custkey)""",
        "transformation_rule_rows": _with(_TGT)
        + "SELECT *, 'non_negative_price' AS violated_rules FROM tgt WHERE o_totalprice < 0",
        "transformation_rules": _with(_TGT)
        + "SELECT 'non_negative_price' AS rule, count(CASE WHEN o_totalprice < 0 THEN 1 END) AS violations FROM tgt",
        "scd2_build": _with(_SCD) + "SELECT * FROM scd",
        "scd1_append": _with(_TGT) + "SELECT batch_date, count(*) AS n_rows FROM tgt GROUP BY batch_date",
        "scd1_append_rows": _with(_TGT) + "SELECT * FROM tgt",
        "data_consistency_decimal": """SELECT 'o_custkey' AS column_name, CAST(0 AS BIGINT) AS mismatches, count(*) AS pairs
FROM orders s JOIN orders t ON s.o_orderkey = t.o_orderkey
UNION ALL
SELECT 'o_totalprice', count(CASE WHEN CAST(s.o_totalprice AS DECIMAL(15,2)) IS DISTINCT FROM
         CAST(t.o_totalprice AS DECIMAL(15,2)) + CASE WHEN t.o_orderkey % 50 = 7 THEN 0.01 ELSE 0.00 END THEN 1 END), count(*)
FROM orders s JOIN orders t ON s.o_orderkey = t.o_orderkey""",
        "config_dataset": _config_oracle(),
        "scd1_latest": _with(_TGT)
        + """SELECT o_orderkey, o_custkey, o_totalprice, batch_date FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY batch_date DESC, o_custkey DESC, o_totalprice DESC) AS rn
  FROM tgt) WHERE rn = 1""",
        "scd1_apply_changes": _with(_STG, _CHANGES)
        + """SELECT o.o_orderkey, o.o_custkey,
       CASE WHEN c.o_orderkey IS NOT NULL THEN c.o_totalprice ELSE o.o_totalprice END AS o_totalprice
FROM orders o LEFT JOIN chg c ON o.o_orderkey = c.o_orderkey""",
        "scd2_load": _with(_STG, _CHANGES)
        + """SELECT o.o_orderkey, o.o_custkey,
       CASE WHEN c.o_orderkey IS NOT NULL THEN c.o_totalprice ELSE o.o_totalprice END AS o_totalprice,
       DATE '2025-12-17' AS effective_start_date, CAST(NULL AS DATE) AS effective_end_date, 'Y' AS is_active
FROM orders o LEFT JOIN chg c ON o.o_orderkey = c.o_orderkey""",
        "scd2_merge": _with(_TGT) + testbed.SCD2_MERGE_ORACLE,
        "scd2_rebuild": _with(_TGT) + testbed.SCD2_MERGE_ORACLE,
        "suite_results": testbed.suite_oracle(_STG, _TGT, _SCD, _SCD2_STG),
        "suite_summary": testbed.summary_oracle(_STG, _TGT, _SCD, _SCD2_STG),
        "scd2_late_loads": _with(_TGT) + testbed.SCD2_MERGE_ORACLE,
        "scd1_append_twice": _with(_TGT) + "SELECT * FROM tgt",
        "config_layers": testbed.config_layers_oracle(_STG, _TGT),
        "load_guards": testbed.LOAD_GUARDS_ORACLE,
    }
    out["referential_integrity_filtered"] = out["referential_integrity"]
    out["count_val_latest_partition"] = out["count_val_latest_batch"]
    return out if extra is None else out | extra.oracle_sql()
