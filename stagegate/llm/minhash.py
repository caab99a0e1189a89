"""Near duplicates by min-max hashing.

Under each permutation both the least and the greatest shingle hash are kept, so
72 hash evaluations a shingle give 144 signature values.  They are cut into 24
bands of 6; documents that share a band are candidates, and a candidate counts
only if the full shingle sets confirm it.  A pair at similarity 0.85 shares a
band with probability 1 - (1 - 0.85^6)^24 > 0.99998, one at 0.5 with 0.31.

Groups of copies are never expanded into pairs.  Documents with the same shingle
set become one class; within a band's bucket every class is compared with the
bucket's least one, its pivot.  Only classes that this leaves in different
components may still have a link.  They are known by how they differ from the
pivot O: x and y differ from each other where their differences from O differ,
so a link between x, which is not linked with O, and y demands that both differ from
O in the same way in almost half of y's differences or more.  Of each y's differences the
rarest are so many that one of them must be shared; pairs that share none of these are never made.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, WordHashes, ascii_words, mix64, released, row_keys
from .components import connected_components

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)]


def shingle_set(words: list[bytes], size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; a shorter text is one shingle, none has none."""
    if not words:
        return np.zeros(0, np.uint64)
    h = hashes.of(words)
    size = min(size, len(h))
    acc = np.full(len(h) - size + 1, size, np.uint64)
    for k in range(size):
        acc = mix64(acc ^ h[k : len(h) - size + 1 + k]) * _ODD[0]
    return np.unique(acc)


class Signer:
    """Band keys of shingle sets; the permutations follow from the seed."""

    def __init__(self, bands: int, rows: int, seed: int = 7):
        if rows % 2:
            raise ValueError("a band takes as many least as greatest values: rows must be even")
        perms = bands * rows // 2
        rng = np.random.default_rng(seed)
        self.a = rng.integers(0, 1 << 64, perms, np.uint64) | np.uint64(1)
        self.b = rng.integers(0, 1 << 64, perms, np.uint64)
        self.bands, self.half = bands, rows // 2
        self.weights = rng.integers(0, 1 << 64, rows, np.uint64) | np.uint64(1)
        self.salt = mix64(np.arange(1, bands + 1, dtype=np.uint64))

    def __call__(self, s: np.ndarray) -> np.ndarray:
        lo = np.full(len(self.a), np.iinfo(np.uint64).max)
        hi = np.zeros(len(self.a), np.uint64)
        for at in range(0, len(s), 1024):
            v = s[at : at + 1024, None] * self.a + self.b
            np.minimum(lo, v.min(0), out=lo)
            np.maximum(hi, v.max(0), out=hi)
        # the greatest values come from the next band's permutations: a band's values are independent
        parts = np.hstack([lo.reshape(self.bands, self.half), np.roll(hi, -self.half).reshape(self.bands, self.half)])
        return mix64((mix64(parts) * self.weights).sum(1, dtype=np.uint64) ^ self.salt)


_SKETCH = "doc_id long, n_shingles long, cls long, cls2 long, keys array<long>"


def sketch(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """Per document (columns doc_id, text): set size, 128-bit hash of the set and its band keys."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign, hashes = Signer(bands, rows), WordHashes(limit=200_000)
        w = np.arange(1, 3, dtype=np.uint64) * _ODD[3]
        for b in batches:
            n, cls, keys = [], [], []
            for text in b.column(1):
                s = shingle_set(ascii_words(text.as_py()), size, hashes)
                n.append(len(s))
                m = mix64(s)
                cls.append([int(mix64((m * (x | np.uint64(1))) ^ (m >> np.uint64(29))).sum(dtype=np.uint64)) for x in w])
                keys.append(sign(s).astype(np.int64) if len(s) else np.zeros(0, np.int64))
            two = np.array(cls, np.uint64).reshape(-1, 2).astype(np.int64)
            ends = np.append(0, np.cumsum([len(k) for k in keys]))
            flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(two[:, 0].copy()), pa.array(two[:, 1].copy()), lists], ["doc_id", "n_shingles", "cls", "cls2", "keys"])

    return docs.mapInArrow(released(task), _SKETCH)


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, text_a, text_b) by two joins that Spark may split on skew; rows come sorted by a."""
    rows = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    return rows.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a").select("a", "b", "text_a", "text_b")


def _compare(rows: DataFrame, size: int, of, names: list[str], types: list, ddl: str) -> DataFrame:
    """``of(set_a, set_b)`` for each row of ``_with_texts``; a task keeps the last a's set."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, last, sa = WordHashes(limit=200_000), None, None
        for batch in batches:
            got = []
            for ta, tb in zip(batch.column(2), batch.column(3)):
                ta = ta.as_py()
                if ta != last:
                    last, sa = ta, shingle_set(ascii_words(ta), size, hashes)
                got.append(of(sa, shingle_set(ascii_words(tb.as_py()), size, hashes)))
            cols = list(zip(*got)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(c, t) for c, t in zip(cols, types)]], ["a", "b", *names])

    return rows.mapInArrow(released(task), f"a long, b long, {ddl}")


def overlaps(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """Sizes of intersection and union of full sets: columns a, b, common, both."""

    def of(sa: np.ndarray, sb: np.ndarray) -> tuple[int, int]:
        c = len(np.intersect1d(sa, sb, assume_unique=True))
        return c, len(sa) + len(sb) - c

    return _compare(_with_texts(pairs, texts), size, of, ["common", "both"], [pa.int64()] * 2, "common long, both long")


def differences(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """Set sizes and the symmetric difference: columns a, b, n_a, n_b, diff array<long>."""

    def of(sa: np.ndarray, sb: np.ndarray) -> tuple[int, int, list]:
        return len(sa), len(sb), np.setxor1d(sa, sb, assume_unique=True).astype(np.int64).tolist()

    return _compare(_with_texts(pairs, texts), size, of, ["n_a", "n_b", "diff"], [pa.int64(), pa.int64(), pa.list_(pa.int64())], "n_a long, n_b long, diff array<long>")


def shared_differences(diffs: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that may be linked, by what they share of their differences from one pivot.

    With c = (100 - percent) / (100 + percent), x and y are linked if their symmetric difference is at most c (|x| + |y|).
    It is |Dx| + |Dy| - 2 |Dx & Dy| for the differences D from the pivot O, and |Dx| > c (|x| + |O|) as x
    is not linked with O: so more than (|Dy| - c (|y| - |O|)) / 2 of Dy must be shared.
    """
    c = (100 - percent) / (100 + percent)
    rows = diffs.select("a", F.col("b").alias("doc"), "n_a", F.col("n_b").alias("n"), F.size("diff").alias("nd"), F.explode("diff").alias("e"))
    common = diffs.select("a", F.explode("diff").alias("e")).groupBy("a", "e").agg(F.count("*").alias("df"))
    # a document's differences, rarest first: as many as it has, in one group
    order = Window.partitionBy("a", "doc").orderBy("df", "e")
    rows = rows.join(common, ["a", "e"]).withColumn("pos", F.row_number().over(order) - 1).where("df > 1")
    rows = rows.join(roots.withColumnRenamed("node", "doc"), "doc", "left").withColumn("root", F.coalesce("root", "doc"))
    x = rows.where(F.col("nd") > c * (F.col("n") + F.col("n_a"))).alias("x")
    must = F.floor((F.col("nd") - c * (F.col("n") - F.col("n_a"))) / 2 - 1e-9)
    y = rows.where(F.col("pos") < F.col("nd") - must).alias("y")
    met = x.join(y, (F.col("x.a") == F.col("y.a")) & (F.col("x.e") == F.col("y.e")) & (F.col("x.root") != F.col("y.root")) & _sizes_fit(F.col("x.n"), F.col("y.n"), percent))
    # the first shared one has so many after it in both
    need = (F.col("x.nd") + F.col("y.nd") - c * (F.col("x.n") + F.col("y.n"))) / 2 - 1e-9
    met = met.where(F.least(F.col("x.nd") - F.col("x.pos"), F.col("y.nd") - F.col("y.pos")) >= need)
    return met.select(F.least("x.doc", "y.doc").alias("a"), F.greatest("x.doc", "y.doc").alias("b")).distinct()


def _sizes_fit(x, y, percent: int):
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def bands_for(percent: int, rows: int, miss: float = 1.4e-5) -> int:
    """Bands of ``rows`` values so that a pair at the threshold shares none with a probability of at most ``miss`` (24 at 85, 37 at 80, for 6 rows)."""
    return math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** rows)) if percent < 100 else 1


def near_duplicates(docs: DataFrame, percent: int = 80, size: int = 5, bands: int | None = None, rows: int = 6, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document with its near-duplicate component: doc_id, n_shingles, component_id, kept.

    Two documents are linked if 100 * |A & B| >= percent * |A | B| for their sets
    of distinct ``size``-word shingles (A-Z lower-cased words; a shorter text is one
    shingle).  component_id is the least id reachable; kept marks it.

    NULL or empty text, or white space only: no shingles, linked with nothing.
    A NULL id: component_id NULL, kept, linked with nothing.  Repeated rows come
    out as often as they went in; rows that share an id but not the text count as
    one document with the links of each.  An empty table gives none.
    """
    spark = docs.sparkSession
    bands = bands or bands_for(percent, rows)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    scratch = Scratch(spark, "minhash")
    sketches = scratch.table(sketch(own, size, bands, rows))

    # classes of equal sets; the least id stands for a class
    classes = (
        sketches.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("cls", "cls2")
        .agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n"), F.first("keys").alias("keys"), F.count("*").alias("members"))
    )
    entries = scratch.table(classes.select(F.explode("keys").alias("key"), "rep", "n"))
    buckets = entries.groupBy("key").agg(F.min("rep").alias("least"), F.max("rep").alias("most")).where("least < most")
    shared = scratch.table(entries.join(buckets.drop("most"), "key"))

    star = scratch.table(shared.where("rep <> least").select(F.col("least").alias("a"), F.col("rep").alias("b")).distinct())
    # the only shuffle of whole texts; the ids wanted grow with the input, so they are not broadcast
    wanted = star.select(F.col("a").alias("doc_id")).union(star.select(F.col("b").alias("doc_id"))).distinct()
    texts = scratch.table(own.join(wanted.hint("merge"), "doc_id", "left_semi"))
    link = F.col("common") * 100 >= F.col("both") * percent
    seen = scratch.table(overlaps(star, texts, size).where(link).select("a", "b"))

    # a class of one stands for itself; a larger one meets its members over 16 sub-keys, so that a class of very many spreads
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(16)).cast("int").alias("salt")
    larger = classes.where("members > 1").select("cls", "cls2", "rep", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("salt"))
    hung = sketches.where("n_shingles > 0 AND doc_id IS NOT NULL").select("doc_id", "cls", "cls2", salt)
    hung = hung.join(larger, ["cls", "cls2", "salt"], "left").select("doc_id", F.coalesce("rep", "doc_id").alias("rep"))
    hung = scratch.table(hung)
    several = hung.groupBy("doc_id").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi").select("doc_id")
    links = seen.unionByName(hung.join(several, "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    roots = connected_components(links, scratch)

    # pivots of buckets with more than one component left
    named = shared.join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    parted = named.where("rep <> least").groupBy("key", "least").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).where("r1 < r2")
    open_ = scratch.table(star.join(parted.select(F.col("least").alias("a")).distinct(), "a", "left_semi"))
    cross = scratch.table(shared_differences(scratch.table(differences(open_, texts, size)), roots, percent))
    more = scratch.table(overlaps(cross, texts, size).where(link).select("a", "b"))
    if not more.isEmpty():
        roots = connected_components(more.unionByName(links), scratch)

    # members of a class hang on its least id
    named = hung.join(roots.withColumnRenamed("node", "rep"), "rep", "left").groupBy("doc_id").agg(F.min(F.coalesce("root", "rep")).alias("component_id"))
    out = sketches.select("doc_id", "n_shingles").join(named, "doc_id", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each component, that of its least id, with all columns.

    Each row is a document of its own; rows that share an id come after those with one of their own, rows
    without an id last, so a copy without an id goes and the text that it copies stays; of copies without ids one stays.
    """
    keyed, key = row_keys(docs, id_col, Scratch(docs.sparkSession, "keep"))
    found = near_duplicates(keyed, id_col=key, text_col=text_col, **options)
    gone = found.where("NOT kept").select(F.col("doc_id").alias("_gone_id"))
    left = keyed.join(gone, keyed[key] == gone["_gone_id"], "left_anti")
    return left if key == id_col else left.drop(key)
