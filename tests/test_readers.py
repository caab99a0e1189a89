"""Reader format inference and layer loading by mode."""

import pytest

from stagegate.sources.readers import infer_format, load_layers


@pytest.mark.parametrize(
    "path,fmt",
    [
        ("/a/orders.csv", "csv"),
        ("/a/orders.csv.gz", "csv"),
        ("/a/x.json.bz2", "json"),
        ("/a/ev.jsonl", "json"),
        ("/a/t.parquet", "parquet"),
        ("/a/t.parquet/part-0.snappy.parquet", "parquet"),
        ("/a/dir.csv/*", "csv"),
        ("/a/d/*.csv", "csv"),
        ("s3a://bucket/k/orders.orc", "orc"),
        ("/a/no_extension", "parquet"),
    ],
)
def test_infer_format(path, fmt):
    assert infer_format(path) == fmt


def test_load_layers_reads_only_what_the_mode_needs(spark, tmp_path):
    p = tmp_path / "s.parquet"
    spark.createDataFrame([(1,)], "k int").write.parquet(str(p))
    res = load_layers(spark, {"source": str(p), "staging": str(p), "target": None}, "source_to_staging")
    assert res.ok and set(res.layers) == {"source", "staging"}
    res2 = load_layers(spark, {"source": str(p), "staging": str(p), "target": None}, "both")
    assert not res2.ok and "target" in res2.error
