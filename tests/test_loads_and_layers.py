"""CSV layers read as declared, repeated loads, and pruning of a partitioned target."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stagegate.operators import violations as V
from stagegate.sources import sinks
from stagegate.sources.config import validate_dataset
from stagegate.sources.readers import UNPARSABLE, load_layers, read_declared
from stagegate.spec import parse_expected_schema


def test_declared_csv(spark, tmp_path):
    (tmp_path / "s.csv").write_text("k,amount,extra\n1,2.5,a\n2,x,b\n3,4,\n4\n,,\n")
    declared = parse_expected_schema([{"name": "k", "type": "IntegerType"}, {"name": "amount", "type": "FloatType"}, {"name": "lost", "type": "date"}])
    df = read_declared(spark, str(tmp_path / "s.csv"), declared)
    assert df.dtypes == [("k", "int"), ("amount", "float"), ("extra", "string"), (UNPARSABLE, "string")]
    rows = {r.k: (r.amount, r.extra, r[UNPARSABLE]) for r in df.collect()}
    assert rows == {1: (2.5, "a", None), 2: (None, "b", "2,x,b"), 3: (4.0, None, None), 4: (None, None, "4"), None: (None, None, None)}
    # the count does not depend on what else is read
    assert df.where(F.col(UNPARSABLE).isNotNull()).select("k").count() == 2


def test_unparsable_rows_are_violations_in_both_stages(spark, tmp_path):
    for name, lines in {"src": "k,amount\n1,2\n2,3\n", "stg": "k,amount\n1,2\n2,bad\n", "tgt": "k,amount,batch_date\n1,2,2025-01-01\nz,3,2025-01-01\n"}.items():
        (tmp_path / f"{name}.csv").write_text(lines)
    files = {"d": {**{f"{n}_file_path": str(tmp_path / f"{f}.csv") for n, f in (("src", "src"), ("stg", "stg"), ("trgt", "tgt"))}, "primary_key": ["k"], "read_schema": "declared"}}
    field = lambda n, t: {"name": n, "type": t}
    two = [field("k", "IntegerType"), field("amount", "FloatType")]
    schemas = {"d": {"source": two, "staging": two, "target": [*two, field("batch_date", "StringType")]}}
    rows = {(r.stage, r.check): r for r in validate_dataset(spark, "d", files, schemas).collect()}
    for stage in ("source_to_staging", "staging_to_target"):
        r = rows[stage, "schemachk"]
        assert (r.status, r.violation_count, r.metrics) == ("Fail", 1, {"issues": 0, "unparsable_rows": 1})
    consistency = rows["source_to_staging", "data_consistency"]
    assert consistency.metrics == {"amount": 1, "_pairs": 2} and UNPARSABLE not in consistency.details
    assert rows["source_to_staging", "data_completeness"].status == "Success"


def test_differing_headers_are_an_error(spark, tmp_path):
    (tmp_path / "d.csv").mkdir()
    (tmp_path / "d.csv" / "a.csv").write_text("k,v\n1,2\n")
    (tmp_path / "d.csv" / "b.csv").write_text("v,k\n1,2\n")
    declared = parse_expected_schema([{"name": "k", "type": "IntegerType"}, {"name": "v", "type": "IntegerType"}])
    res = load_layers(spark, {"source": str(tmp_path / "d.csv"), "staging": str(tmp_path / "d.csv")}, "source_to_staging", declared={"source": declared})
    with pytest.raises(Exception, match="(?i)header"):
        res.source.collect()


def test_repeated_and_corrected_loads(spark, tmp_path):
    path, day = str(tmp_path / "t"), dt.date(2025, 1, 1)
    rows = lambda d, vs: spark.createDataFrame([(v, d) for v in vs], "v int, batch_date date")
    first = rows(day, [1, 2])
    for load in (first, rows(None, [9]), rows(dt.date(2025, 1, 2), [3]), first, rows(dt.date(2025, 1, 2), [4, 5]), rows(day, [])):
        sinks.write_load(load, path)
    got = sinks.read_batches(spark, path, first)
    assert got.columns == ["v", "batch_date"] and sorted((r.v, str(r.batch_date)) for r in got.collect()) == [(1, "2025-01-01"), (2, "2025-01-01"), (4, "2025-01-02"), (5, "2025-01-02"), (9, "None")]


def test_latest_batch_reads_one_partition(spark, tmp_path):
    path, days = str(tmp_path / "t"), [dt.date(2025, 1, 1 + i) for i in range(5)]
    target = spark.createDataFrame([(i, d) for d in days for i in range(3)], "k int, batch_date date")
    sinks.write_load(target.coalesce(1), path)
    # whoever reads another batch's file fails
    for d in days[:-1]:
        for f in (tmp_path / "t" / f"batch_date={d}").glob("part-*"):
            f.write_bytes(b"no Parquet here")
    for f in (tmp_path / "t").glob("*/.*.crc"):
        f.unlink()
    table = sinks.read_batches(spark, path, target)
    staging = spark.createDataFrame([(i, days[-1]) for i in range(3)], "k int, batch_date date")
    row = V.latest_batch_counts(staging, table).first()
    assert (row.batch_value, row.staging_count, row.target_count) == (days[-1], 3, 3)
