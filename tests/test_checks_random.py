"""Randomised checks of the simple operators against plain-Python counting."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stagegate.operators import violations as V

keys = st.one_of(st.none(), st.integers(0, 4))
strings = st.one_of(st.none(), st.sampled_from(["", " ", "  ", "a", "\t"]))
flags = st.one_of(st.none(), st.sampled_from(["Y", "N", "y", " Y", "1", "0", "A", "TRUE", "false"]))
rows = st.lists(st.tuples(keys, strings, flags), max_size=25)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
SCHEMA = "k int, s string, f string"


@SETTINGS
@given(data=rows)
def test_nulls_duplicates_flags(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    got_nulls = {r["column_name"]: r["null_count"] for r in V.null_or_blank_counts(df, ["k", "s"]).collect()}
    want_nulls = {
        "k": sum(1 for k, _, _ in data if k is None),
        "s": sum(1 for _, s, _ in data if s is None or s.strip(" ") == ""),
    }
    assert got_nulls == want_nulls

    counts = Counter(k for k, _, _ in data)
    got_dups = {r["k"]: r["n_rows"] for r in V.duplicate_keys(df, ["k"]).collect()}
    assert got_dups == {k: n for k, n in counts.items() if n > 1}

    active = Counter()
    for k, _, f in data:
        active[k] += int(f is not None and f.strip().upper() in ("Y", "TRUE", "1"))
    got_flags = {r["k"]: r["active_count"] for r in V.active_flag_violations(df, ["k"], "f").collect()}
    assert got_flags == {k: active[k] for k in counts if active[k] != 1}


@SETTINGS
@given(src=rows, stg=rows)
def test_missing_keys_and_orphans(spark, src, stg):
    s_df, t_df = spark.createDataFrame(src, SCHEMA), spark.createDataFrame(stg, SCHEMA)
    present = {k for k, _, _ in stg if k is not None}
    want_missing = {k for k, _, _ in src if k is None or k not in present}
    got_missing = {r["k"] for r in V.missing_keys(s_df, t_df, ["k"]).collect()}
    assert got_missing == want_missing

    want_orphans = Counter(k for k, _, _ in src if k is None or k not in present)
    got_orphans = {r["k"]: r["n_rows"] for r in V.orphan_values(s_df, "k", t_df, "k").collect()}
    assert got_orphans == dict(want_orphans)
    assert V.orphan_rows(s_df, "k", t_df, "k").count() == sum(want_orphans.values())
