"""Near duplicates and packing against brute force, and their edge cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stagegate.llm import minhash, packing
from stagegate.llm.queries import vocabulary

DOCS = "doc_id long, text string"


def brute_components(rows, size, percent):
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        n = min(size, len(w))
        sets.setdefault(i, []).append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and any(a and b and 100 * len(a & b) >= percent * len(a | b) for a in sets[x] for b in sets[y]):
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def copies(rnd, n, edits):
    """n variants of one text around the threshold, and what has nothing to do with it."""
    words = [f"w{rnd.randrange(10**6)}" for _ in range(120)]
    out = []
    for _ in range(n):
        w = list(words)
        for _ in range(rnd.randrange(edits + 1)):
            w[rnd.randrange(len(w))] = f"x{rnd.randrange(10**6)}"
        out.append(" ".join(w))
    return out + [" ".join(f"y{rnd.randrange(500)}" for _ in range(rnd.randrange(1, 80))) for _ in range(n // 2)]


@pytest.mark.parametrize("seed,edits,percent,size", [(1, 7, 85, 3), (2, 10, 85, 3), (3, 5, 80, 5)])
def test_components_match_brute_force(spark, seed, edits, percent, size):
    rnd = random.Random(seed)
    texts = copies(rnd, 60, edits)
    texts += [texts[0].upper(), texts[0], texts[3], "", None, " \t\n", "one", "One", "two words", "TWO\twords", "ß Ä", "ß ä"]
    rnd.shuffle(texts)
    rows = list(enumerate(texts))
    got = {r["doc_id"]: r for r in minhash.near_duplicates(spark.createDataFrame(rows, DOCS), percent, size).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == brute_components(rows, size, percent)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got.values())


def test_difference_join_finds_links_that_only_members_have(spark):
    # b and c are linked through changes they share, while neither is linked with the pivot a
    base = [f"w{i}" for i in range(140)]
    changed = list(base)
    for k in (5, 15, 25, 35, 45, 55, 65, 75):
        changed[k] = f"z{k}"
    other = list(changed)
    other[100] = "q"
    rows = [(1, " ".join(base)), (2, " ".join(changed)), (3, " ".join(other))]
    want = brute_components(rows, 3, 85)
    assert want == {1: 1, 2: 2, 3: 2}
    diffs = minhash.differences(spark.createDataFrame([(1, 2), (1, 3)], "a long, b long"), spark.createDataFrame(rows, DOCS), 3)
    roots = spark.createDataFrame([], "node long, root long")
    assert [tuple(r) for r in minhash.shared_differences(diffs, roots, 85).collect()] == [(2, 3)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, DOCS), 85, 3)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == want


def test_near_duplicate_edge_cases(spark):
    long = " ".join(f"t{i}" for i in range(30_000))
    df = spark.createDataFrame([(None, "a b c d e"), (1, "a b c d e"), (1, "a b c d e"), (2, "x y z"), (2, "a b c d e"), (3, "x y z"), (4, long), (5, long)], DOCS)
    df = df.withColumn("kept", F.lit(1)).withColumn("component_id", F.lit("c"))
    rows = minhash.near_duplicates(df, 80, 5).collect()
    assert len(rows) == 8
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], set()).add((r["component_id"], r["kept"]))
    # the two texts of id 2 join the groups of 1 and 3
    assert by == {None: {(None, True)}, 1: {(1, True)}, 2: {(1, False)}, 3: {(1, False)}, 4: {(4, True)}, 5: {(4, False)}}
    kept = minhash.keep_one(df)
    # each row is a document of its own there: the copy without an id goes, and the texts of id 2 link nothing
    assert kept.columns == df.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [1, 3, 4]
    assert minhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_signature_agreement_is_the_similarity():
    # the share of equal least and greatest values estimates Jaccard similarity
    rng = np.random.default_rng(0)
    shared = rng.integers(0, 1 << 63, 800, np.uint64)
    a, b = (np.unique(np.append(shared, rng.integers(0, 1 << 63, 200, np.uint64))) for _ in range(2))
    s = minhash.Signer(200, 2)
    agree = []
    for f in (np.min, np.max):
        agree.append(np.mean(f(a[:, None] * s.a + s.b, 0) == f(b[:, None] * s.a + s.b, 0)))
    assert abs(np.mean(agree) - 800 / 1200) < 0.08


# ---------------------------------------------------------------- packing


@pytest.mark.parametrize("seed", range(5))
def test_rounds_fill_sequences_without_gaps(seed):
    rnd = random.Random(seed)
    lengths = [min(50, int(rnd.expovariate(1 / 12)) + 1) for _ in range(400)]
    counts = {n: lengths.count(n) for n in set(lengths)}
    flows, opened = packing.rounds(counts, 50)
    fill, seen = {}, set()
    for length, lo, hi, first, each, base in flows:
        for rank in range(lo, hi):
            seq, at = first + (rank - lo) // each, base + (rank - lo) % each * length
            assert fill.get(seq, 0) == at and at + length <= 50
            fill[seq] = at + length
            seen.add((length, rank))
    assert seen == {(n, r) for n, c in counts.items() for r in range(c)}
    assert set(fill) == set(range(opened))
    # plain best fit in decreasing order, piece by piece, opens as many
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        g = min(fits) if fits else 50
        if fits:
            gaps.remove(g)
        gaps.append(g - n)
    assert opened == len(gaps)


def test_pack_edge_cases(spark):
    path = vocabulary("word_bpe_49k.json")
    df = spark.createDataFrame([(1, None), (2, ""), (2, ""), (None, "a b"), (5, "word " * 50)], DOCS).withColumn("length", F.lit("x"))
    rows = packing.pack(df, path, 0, capacity=16).collect()
    assert sorted((r["doc_id"] or 0, r["piece"], r["start"], r["length"]) for r in rows) == [
        (0, 0, 0, 3), (1, 0, 0, 1), (2, 0, 0, 1), (2, 0, 0, 1), (5, 0, 0, 16), (5, 1, 16, 16), (5, 2, 32, 16), (5, 3, 48, 3),
    ]
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        end = 0
        for at, n in sorted(places):
            assert at == end
            end += n
        assert end <= 16
    assert len(by) == 4
    assert packing.pack(spark.createDataFrame([], DOCS), path, 0).count() == 0


def test_packing_turns_a_part_of_a_batch_into_strings(monkeypatch):
    """Pieces of a large batch come in its order and equal those of small batches; the encoder gets a part at a time."""
    import pyarrow as pa

    from stagegate.llm import packing
    from stagegate.llm.queries import vocabulary

    class Docs:
        def mapInArrow(self, task, ddl):
            return task

    sizes = []
    enc = packing.encoder(vocabulary("word_bpe_49k.json"))
    encode = enc.encode
    monkeypatch.setattr(enc, "encode", lambda texts: (sizes.append(len(texts)), encode(texts))[1])
    texts = [None if i % 50 == 7 else f"text {i} " * (i % 40) for i in range(1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1000), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])
    task = packing.pieces(Docs(), vocabulary("word_bpe_49k.json"), 0, 16)
    rows = lambda batches: [r for b in task(iter(batches)) for r in b.to_pylist()]
    whole = rows([batch])
    assert max(sizes) < 1000
    assert whole == rows([batch.slice(i, 1) for i in range(1000)])
    assert [r["doc_id"] for r in whole if r["piece"] == 0] == list(range(1000))


def test_a_packing_task_leaves_no_pieces_in_its_worker(monkeypatch):
    """A worker stays beside later stages: a task holds a bounded number of pieces and forgets them at its end; the ids are the same."""
    import pyarrow as pa

    from stagegate.llm import packing
    from stagegate.llm.queries import vocabulary

    class Docs:
        def mapInArrow(self, task, ddl):
            return task

    path = vocabulary("word_bpe_49k.json")
    enc = packing.encoder(path)
    texts = [" ".join(f"w{chr(97 + i % 26)}{chr(97 + j % 26)}{'xyz'[j % 3]}" for j in range(i % 60)) for i in range(1500)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1500), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])
    rows = lambda: [r for b in packing.pieces(Docs(), path, 0, 16)(iter([batch])) for r in b.to_pylist()]
    whole = rows()
    assert enc.known == {"": b""}
    before, encode = [], enc.encode
    monkeypatch.setattr(enc, "encode", lambda texts: (before.append(len(enc.known)), encode(texts))[1])
    monkeypatch.setattr(packing, "_KNOWN", 100)
    assert rows() == whole
    assert len(before) > 1 and max(before) <= 100


def test_free_memory_leaves_the_worker_after_a_task(monkeypatch):
    """Both after the last batch and where there was none, and not between batches."""
    from stagegate.llm import common

    calls = []
    monkeypatch.setattr(common, "release_memory", lambda: calls.append(1))
    left = []
    for x in common.released(lambda batches: (b + 1 for b in batches))(iter([1, 2])):
        left.append((x, len(calls)))
    assert left == [(2, 0), (3, 0)] and len(calls) == 1
    assert list(common.released(lambda batches: batches)(iter([]))) == [] and len(calls) == 2


def test_packing_plans_need_no_python_workers(spark):
    """The small tables of ranks and flows come from Arrow: Spark holds them itself, with no Python RDD below."""
    from stagegate.llm import packing

    got = packing._longs(spark, [(1, -2), (3, 1 << 40)], ["length", "_shift"])
    assert [tuple(r) for r in got.collect()] == [(1, -2), (3, 1 << 40)] and got.dtypes == [("length", "bigint"), ("_shift", "bigint")]
    assert "PythonRDD" not in got._jdf.queryExecution().toRdd().toDebugString()
    none = packing._longs(spark, [], ["length"])
    assert none.count() == 0 and none.dtypes == [("length", "bigint")]
