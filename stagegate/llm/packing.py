"""Best-fit packing of documents into sequences of a fixed number of tokens.

Documents are cut into pieces and range-sorted by length; equal lengths are
interchangeable, so a piece is known by its length and its rank among equals, and
the open gaps by their size and runs of sequence numbers.  Bulk-synchronous
rounds go down the lengths: all pieces of a length sweep to the successor, the
smallest gap that holds them; ranks settle which piece gets which sequence; the
gaps shrink, and what is left goes on to the next gap or opens new sequences.
That is best fit in decreasing order, with a round for a length instead of a step
for a piece.  The rounds see counts only (at most one per length); each piece then
finds its place by a join on length and rank.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, release_memory, released
from .pieces import encoder, slices

# rows of a batch that become Python strings at once, and their bytes where that is fewer
_PART, _PART_BYTES = 512, 1 << 21
# after so many pieces of text a task begins to remember them anew
_KNOWN = 300_000
_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int) -> DataFrame:
    """The token pieces of each document (columns doc_id, text), without their ids."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for b in batches:
            # a batch is Python strings a part at a time: beside a worker's cache these are most of its memory
            step = max(1, min(_PART, _PART_BYTES * b.num_rows // max(1, b.nbytes)))
            for rows in (b.slice(at, step) for at in range(0, b.num_rows, step)):
                doc_ids, texts = rows.column(0).to_pylist(), rows.column(1).to_pylist()
                for lo, hi in slices(texts, _PART_BYTES):
                    if len(enc.known) > _KNOWN:
                        enc.forget()
                    cols: list[list] = [[], [], [], [], []]
                    for doc_id, raw in zip(doc_ids[lo:hi], enc.encode(texts[lo:hi])):
                        ids = np.append(np.frombuffer(raw, enc.dtype), end_id).astype("<u4")
                        for k, at in enumerate(range(0, len(ids), capacity)):
                            part = ids[at : at + capacity]
                            for c, v in zip(cols, (doc_id, k, at, len(part), zlib.crc32(part.tobytes()))):
                                c.append(v)
                    types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["doc_id", "piece", "start", "length", "ids_crc32"])
                    release_memory()
            b = rows = None  # not held while the next batch is read
        enc.forget()  # the worker may stay for as long as the stages after this one

    return docs.mapInArrow(released(task), _PIECE)


def rounds(counts: dict[int, int], capacity: int) -> tuple[list[tuple], int]:
    """Best fit over counts of lengths: flows (length, first rank, end rank, first sequence, each, offset), and the number of sequences.

    A flow puts the pieces of a length with ranks in [first, end) into consecutive
    sequences, ``each`` to a sequence, from ``offset`` on.
    """
    gaps: list[int] = []  # sizes of open gaps, ascending
    runs: dict[int, list[tuple[int, int]]] = {}  # size -> runs (first sequence, how many)
    flows, opened = [], 0

    def free(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in runs:
                insort(gaps, gap)
            runs.setdefault(gap, []).append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            i = bisect_left(gaps, length)
            if i < len(gaps):
                gap = gaps[i]
                first, n = runs[gap].pop()
                if not runs[gap]:
                    del runs[gap], gaps[i]
            else:  # no gap holds it: open as many sequences as this length fills
                gap, first, n = capacity, opened, -(-left // (capacity // length))
                opened += n
            each = gap // length
            full = min(n, left // each)
            if full:
                flows.append((length, rank, rank + full * each, first, each, capacity - gap))
                free(gap - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if left and full < n:  # fewer than a sequence takes
                flows.append((length, rank, rank + left, first + full, left, capacity - gap))
                free(gap - left * length, first + full, 1)
                full, left = full + 1, 0
            free(gap, first + full, n - full)
    return flows, opened


def _longs(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small local table; from Arrow, since from tuples Spark would start Python workers of their own for it, which stay."""
    columns = list(zip(*rows)) or [()] * len(names)
    return spark.createDataFrame(pa.table([pa.array(c, pa.int64()) for c in columns], names))


def ranked(df: DataFrame, size: str, order: list[str], scratch: Scratch) -> DataFrame:
    """``df`` with ``rank``: a row's place among those of equal ``size``, counted over range-sorted partitions.

    A size that many rows share spreads over partitions; only a count per partition and size meets.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = scratch.table(df.repartitionByRange(n, size, *order).sortWithinPartitions(size, *order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33).alias("_part")
    own = at.groupBy(part, size).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    counts = sorted(own.collect(), key=lambda r: (r[size], r["_part"]))  # at most partitions + sizes rows
    before, base = {}, []
    for r in counts:
        base.append((r["_part"], r[size], before.get(r[size], 0) - r["_first"]))
        before[r[size]] = before.get(r[size], 0) + r["_n"]
    shift = _longs(df.sparkSession, base, ["_part", size, "_shift"])
    return at.withColumn("_part", part).join(F.broadcast(shift), ["_part", size]).withColumn("rank", F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift")


def pack(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and ``end_id``; a NULL text is empty, so every row has at least
    one token.  Longer ones than ``capacity`` are cut there; all pieces but the last are full.
    Repeated rows and NULL ids are packed like any other.  An empty table gives none.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # written first: cutting ranges samples its input, which would encode every text twice
    cut = ranked(scratch.table(pieces(own, vocabulary, end_id, capacity)), "length", ["doc_id", "piece"], scratch)
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most ``capacity`` rows
    flows, _ = rounds(counts, capacity)
    plan = _longs(spark, flows, ["length", "lo", "hi", "first", "each", "base"])
    placed = cut.join(F.broadcast(plan), "length").where("rank >= lo AND rank < hi")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.expr("first + (rank - lo) div each").alias("sequence_id"),
        F.expr("base + (rank - lo) % each * length").alias("offset"),
    )
