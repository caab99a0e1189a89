"""Quality by a vote of the nearest labelled documents in a latent-semantic space.

A document's terms are the trigrams of its characters' classes (lower and upper
case, digits, each mark, white space, other scripts) and how much of it repeats.
Their weights are projected on the leading directions of the labelled documents'
term matrix.  The labelled vectors, bounded in number, are broadcast; every
document's cosines with all of them are exact products of blocks, and its nearest
vote with their similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes
from .fertility import repeated_lines, repeated_words

_MARKS = "\n\t .,;:!?'\"()-_/=@#*$%&|<>"
_CLASS = np.full(256, 31, np.uint8)  # what stands in no other class
_CLASS[128:192], _CLASS[192:] = 30, 29  # inside and at the start of a character beyond ASCII
for _i, _marks in enumerate(_MARKS):
    _CLASS[ord(_marks)] = _i
for _a, _z, _k in (("a", "z", 26), ("A", "Z", 27), ("0", "9", 28)):
    _CLASS[ord(_a) : ord(_z) + 1] = _k
_GRAMS = 1 << 15
_TERMS = _GRAMS + 2  # and the shares of repeated words and lines


def terms(text: str | None, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, weights) of a text's terms: log(1 + 100 * share)."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    c = _CLASS[np.frombuffer(b" " + raw + b" ", np.uint8)].astype(np.int32)
    count = np.bincount((c[:-2] << 10) | (c[1:-1] << 5) | c[2:], minlength=_TERMS).astype(np.float32)
    at = np.flatnonzero(count)
    share = count[at] / len(raw)
    lines = raw.count(b"\n") + 1
    again = np.array([repeated_words(hashes.of(words)) / len(words), repeated_lines(text) / lines], np.float32)
    at = np.append(at, np.flatnonzero(again > 0) + _GRAMS)
    return at.astype(np.int32), np.log1p(100 * np.append(share, again[again > 0])).astype(np.float32)


@dataclass
class Space:
    """``project``: term number -> row of ``axes`` or -1; ``vectors``: unit vectors of the labelled documents, ``labels`` 0/1."""

    project: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    base_rate: float
    k: int = 15
    sharpness: float = 4.0

    def vector(self, at: np.ndarray, weight: np.ndarray) -> np.ndarray:
        rows = self.project[at]
        known = rows >= 0
        v = weight[known] @ self.axes[rows[known]]
        n = np.linalg.norm(v)
        return v / n if n > 0 else v

    def vote(self, block: np.ndarray) -> np.ndarray:
        """Share of the votes for label 1 among the ``k`` nearest; the base rate where nothing is near."""
        if not len(self.vectors):
            return np.full(len(block), self.base_rate)
        cos = block @ self.vectors.T
        k = min(self.k, cos.shape[1])
        near = np.argpartition(-cos, k - 1, 1)[:, :k]
        w = np.clip(np.take_along_axis(cos, near, 1), 0, None).astype(float) ** self.sharpness
        total = w.sum(1)
        return np.where(total > 0, (w * self.labels[near]).sum(1) / np.maximum(total, 1e-12), self.base_rate)


def learn(docs: DataFrame, labels: DataFrame, most_labelled: int = 6_000, most_terms: int = 2_048, dimensions: int = 64, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Space:
    """The space of at most ``most_labelled`` labelled documents, half of each label where there are so many.

    They are those whose hashed ids are least; their terms (a few hundred numbers each)
    come to the driver, which finds the axes.  Without labels of both kinds every
    score is the share of label 1 (0.5 without any).
    """
    marked = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("doc_id IS NOT NULL AND y IN (0, 1)").dropDuplicates(["doc_id"])
    base = marked.agg(F.avg("y")).first()[0]
    pick = lambda y: marked.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_labelled // 2)
    sample = pick(0).unionByName(pick(1))  # bounded, so it may be broadcast
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(sample), "doc_id")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            got = [terms(t.as_py(), hashes) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([a.tolist() for a, _ in got], pa.list_(pa.int32())), pa.array([w.tolist() for _, w in got], pa.list_(pa.float32()))], ["doc_id", "y", "at", "w"])

    got = rows.mapInArrow(task, "doc_id long, y int, at array<int>, w array<float>").toArrow()
    got = got.take(pa.array(np.argsort(got["doc_id"].to_numpy(), kind="stable")))
    y = got["y"].to_numpy().astype(float)
    at, w = got["at"].to_pylist(), got["w"].to_pylist()
    project = np.full(_TERMS, -1, np.int32)
    nothing = Space(project, np.zeros((0, dimensions), np.float32), np.zeros((0, dimensions), np.float32), np.zeros(0), 0.5 if base is None else float(base))
    if len(set(y)) < 2:
        return nothing
    held = np.bincount(np.concatenate([np.array(a, np.int64) for a in at]), minlength=_TERMS)
    top = np.argsort(-held, kind="stable")[: min(most_terms, int((held > 0).sum()))]
    project[top] = np.arange(len(top))
    idf = np.log1p(len(y) / held[top])
    matrix = np.zeros((len(y), len(top)), np.float32)
    for row, (a, x) in enumerate(zip(at, w)):
        to = project[np.array(a, np.int64)] if a else np.zeros(0, int)
        matrix[row, to[to >= 0]] = np.array(x, np.float32)[to >= 0] * idf[to[to >= 0]]
    matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-9)
    _, axes = np.linalg.eigh((matrix.T @ matrix).astype(np.float64))
    axes = axes[:, ::-1][:, :dimensions].astype(np.float32)
    vectors = matrix @ axes
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    return Space(project, (axes * idf[:, None]).astype(np.float32), vectors, y, float(base))


def score(docs: DataFrame, space: Space, id_col: str = "doc_id", text_col: str = "text", block: int = 256) -> DataFrame:
    """doc_id and score (0 to 1) of every document.

    NULL text and text without a word is near nothing and gets the share of label 1.
    NULL ids and repeated rows come out as they went in; an empty table gives none.
    """
    held = docs.sparkSession.sparkContext.broadcast(space)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, here = WordHashes(), held.value
        for b in batches:
            out = []
            for lo in range(0, len(b), block):
                vectors = [here.vector(*terms(t.as_py(), hashes)) for t in b.column(1)[lo : lo + block]]
                out.append(here.vote(np.stack(vectors)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.clip(np.concatenate([*out, np.zeros(0)]), 0, 1))], ["doc_id", "score"])

    return own.mapInArrow(task, "doc_id long, score double")
