"""Token-id shards with Elias-Fano document boundaries.

A data set is a folder of shards in ascending order of the documents' ids; a shard has at most so many ids and
documents, and holds

* ``<name>.ids``: the ids of its documents, one after the other, little-endian,
  2 bytes an id where the vocabulary allows and else 4;
* ``<name>.ef``: two Elias-Fano sequences, where each document ends in ``.ids`` and
  the documents' integer ids, and the number of documents without an id, which stand before all others.

An Elias-Fano sequence keeps n non-decreasing values below u in n * log2(u / n)
low bits, a unary high part of at most 3n bits and the place of every 256th one bit,
from which ``select`` scans on.  The reader finds starts and ends by it, a block of documents at a time, and
reads ids in slices, so a task's memory does not grow with a shard or a document.  ``write`` names the shards that count in the rows
it returns; files of failed or repeated attempts are never read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_folder
from .pieces import encoder, slices

_SLICE = 1 << 22  # ids read at a time
_STEP = 256  # one bits between select samples
_HEAD = struct.Struct("<QQBQQ")  # n, least, low bits, bytes of low part, bytes of high part
_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)


class EliasFano:
    """A sorted sequence of integers with constant-time-like access by index."""

    def __init__(self, n: int, least: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.least, self.low_bits, self.low, self.high, self.samples = n, least, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> "EliasFano":
        """``values``: int64, non-decreasing."""
        n = len(values)
        least = int(values[0]) if n else 0
        v = (values - least).astype(np.uint64)
        u = int(v[-1]) + 1 if n else 1
        low_bits = max(0, (u // max(n, 1)).bit_length() - 1)
        bits = ((v[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        ones = (v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        high[ones] = 1
        samples = ones[::_STEP].astype("<u4" if len(high) < 1 << 32 else "<u8")
        return cls(n, least, low_bits, np.packbits(bits.ravel(), bitorder="little"), np.packbits(high, bitorder="little"), samples)

    def to_bytes(self) -> bytes:
        head = _HEAD.pack(self.n, self.least % (1 << 64), self.low_bits, len(self.low), len(self.high))
        return head + self.low.tobytes() + self.high.tobytes() + struct.pack("<QB", len(self.samples), self.samples.itemsize) + self.samples.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes, at: int = 0) -> tuple["EliasFano", int]:
        n, least, low_bits, n_low, n_high = _HEAD.unpack_from(raw, at)
        at += _HEAD.size
        low = np.frombuffer(raw, np.uint8, n_low, at)
        high = np.frombuffer(raw, np.uint8, n_high, at + n_low)
        n_samples, width = struct.unpack_from("<QB", raw, at + n_low + n_high)
        at += n_low + n_high + 9
        samples = np.frombuffer(raw, f"<u{width}", n_samples, at)
        return cls(n, least - (1 << 64) if least >> 63 else least, low_bits, low, high, samples), at + n_samples * width

    def select(self, i: int) -> int:
        """The i-th value, from the nearest sample on."""
        at = int(self.samples[i // _STEP])
        left = i % _STEP
        byte = at >> 3
        bits = int(self.high[byte]) >> (at & 7) << (at & 7)
        while left >= int(_ONES[bits]):
            left -= int(_ONES[bits])
            byte += 1
            bits = int(self.high[byte])
        for _ in range(left):
            bits &= bits - 1
        one = byte * 8 + (bits & -bits).bit_length() - 1
        lo = i * self.low_bits
        low = 0
        for k in range(self.low_bits):
            low |= (int(self.low[(lo + k) >> 3]) >> ((lo + k) & 7) & 1) << k
        return self.least + ((one - i) << self.low_bits) + low

    def select_range(self, lo: int, hi: int) -> np.ndarray:
        """Values ``lo`` up to ``hi``, from the nearest sample on; only their bits are looked at."""
        first, after = lo // _STEP, (hi - 1) // _STEP + 1
        at = int(self.samples[first]) if hi > lo else 0
        end = int(self.samples[after]) if after < len(self.samples) else len(self.high) * 8
        ones = np.flatnonzero(np.unpackbits(self.high[at >> 3 : (end + 7) >> 3], bitorder="little")) + (at >> 3 << 3)
        ones = ones[ones >= at][lo - first * _STEP : hi - first * _STEP]
        b = lo * self.low_bits
        bits = np.unpackbits(self.low[b >> 3 : (hi * self.low_bits + 7) >> 3], bitorder="little")[b & 7 :]
        bits = bits[: (hi - lo) * self.low_bits].reshape(hi - lo, self.low_bits)
        low = (bits.astype(np.int64) << np.arange(self.low_bits)).sum(1)
        return self.least + ((ones - np.arange(lo, hi)) << self.low_bits) + low

    def decode(self) -> np.ndarray:
        """All values."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        bits = np.unpackbits(self.low, bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits)
        low = (bits.astype(np.int64) << np.arange(self.low_bits)).sum(1)
        return self.least + ((ones - np.arange(self.n)) << self.low_bits) + low


def _get(folder: str, name: str):
    fs, path = pafs.FileSystem.from_uri(folder)
    with fs.open_input_file(f"{path}/{name}") as f:
        return f.read_buffer()


_SHARD = "name string, task int, shard int, width int, docs long, n_ids long"


class _Writer:
    """A shard being written: ids go out at once, boundaries and document ids when it is closed."""

    def __init__(self, folder: str, width: int):
        self.fs, self.path = pafs.FileSystem.from_uri(folder)
        self.fs.create_dir(self.path, recursive=True)
        self.name, self.width = f"shard-{uuid.uuid4().hex}", width
        self.out = self.fs.open_output_stream(f"{self.path}/{self.name}.ids")
        self.doc_ids: list[int] = []
        self.ends: list[int] = []
        self.without_id = self.total = 0

    def add(self, doc_ids: list[int | None], coded: list[bytes], end: bytes) -> None:
        self.out.write(end.join(coded) + end)
        ends = np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded)) // self.width + 1) + self.total
        self.total = int(ends[-1])
        self.ends += ends.tolist()
        known = [i for i in doc_ids if i is not None]
        self.without_id += len(doc_ids) - len(known)
        self.doc_ids += known

    def close(self) -> tuple:
        self.out.close()
        with self.fs.open_output_stream(f"{self.path}/{self.name}.ef") as f:
            for values in (self.ends, self.doc_ids):
                f.write(EliasFano.of(np.array(values, np.int64)).to_bytes())
            f.write(self.without_id.to_bytes(8, "little"))
        return self.name, self.width, len(self.ends), self.total


def write(
    docs: DataFrame, folder: str, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", shards: int | None = None,
    most_ids: int = 1 << 26, most_docs: int = 1 << 20,
) -> DataFrame:
    """Encode ``text_col`` and write shards in ascending order of ``id_col``; returns a row per shard that counts.

    A NULL text is empty: its document is the end id alone.  Rows without an id come
    first.  Rows that share an id are
    neighbours, each with its own boundary, by a hash of their texts; even very many of them are cut into ranges.  An empty table gives no shard.
    The text is shuffled once, into ``shards`` ranges (the session's shuffle partitions); a range is as many files as
    ``most_ids`` (and the rest of a slice of texts) and ``most_docs`` a file make it.
    """
    spark = docs.sparkSession
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # the row number only cuts equal rows apart: whichever of them comes first, the shards are the same
    rows = rows.withColumn("h", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(n, "id", "h", "row").sortWithinPartitions("id", "h", "text").select("id", "text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        end, width = np.array([end_id], enc.dtype).tobytes(), enc.dtype.itemsize
        made, shard = [], None
        try:
            for b in batches:
                ids, texts = (c.to_pylist() for c in b.columns)
                for lo, hi in slices(texts):
                    own, coded = ids[lo:hi], enc.encode(texts[lo:hi])
                    while own:
                        if shard is not None and (shard.total >= most_ids or len(shard.ends) >= most_docs):
                            made.append(shard.close())
                            shard = None
                        shard = shard or _Writer(folder, width)
                        fit = most_docs - len(shard.ends)
                        shard.add(own[:fit], coded[:fit], end)
                        own, coded = own[fit:], coded[fit:]
            if shard is not None:
                made.append(shard.close())
                shard = None
        finally:
            if shard is not None:
                shard.out.close()
        if made:
            name, widths, n_docs, n_ids = zip(*made)
            at = [TaskContext.get().partitionId()] * len(made), range(len(made))
            cols = zip((name, *at, widths, n_docs, n_ids), [pa.string(), *[pa.int32()] * 3, pa.int64(), pa.int64()])
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in cols], [x.split()[0] for x in _SHARD.split(", ")])

    made = rows.mapInArrow(task, _SHARD).collect()  # a row per shard
    return spark.createDataFrame(made, _SHARD)


def _crcs(f, width: int, start: int, stops: np.ndarray) -> list[int]:
    """crc32 of each document's ids as 32-bit integers; ``start`` is where the first one begins.  Read in slices."""
    out, crc, at, i = [], 0, start, 0
    stops = stops.tolist()
    while i < len(stops):
        upto = min(stops[-1], at + _SLICE)
        ids = np.frombuffer(f.read_at((upto - at) * width, at * width), f"<u{width}").astype("<u4")
        lo = at
        while i < len(stops) and stops[i] <= upto:
            out.append(zlib.crc32(ids[lo - at : stops[i] - at].tobytes(), crc))
            lo, crc, i = stops[i], 0, i + 1
        if i < len(stops):  # a document goes on in the next slice
            crc = zlib.crc32(ids[lo - at :].tobytes(), crc)
        at = upto
    return out


def read(spark, folder: str, shards: DataFrame, id_col: str = "doc_id", block: int = 4096) -> DataFrame:
    """A row per document of the shards: id (NULL for those without), start in the whole sequence, n_tokens and ids_crc32.

    ``shards`` is what ``write`` returned.  A task reads a shard, ``block`` documents at a time: their ends by
    ``select``, their ids in slices.
    """
    parts = sorted(shards.collect(), key=lambda r: (r["task"], r["shard"]))  # bounded by the number of shards
    base, plan = 0, []
    for r in parts:
        plan.append((r["name"], r["width"], base))
        base += r["n_ids"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in b.column(0).to_pylist():
                name, width, first = plan[i]
                raw = _get(folder, f"{name}.ef")
                ends, at = EliasFano.from_bytes(raw)
                doc_ids, at = EliasFano.from_bytes(raw, at)
                without = int.from_bytes(raw[at : at + 8].to_pybytes(), "little")
                fs, path = pafs.FileSystem.from_uri(folder)
                with fs.open_input_file(f"{path}/{name}.ids") as f:
                    for lo in range(0, ends.n, block):
                        hi = min(ends.n, lo + block)
                        begin = ends.select(lo - 1) if lo else 0
                        stops = ends.select_range(lo, hi)
                        starts = np.append(begin, stops[:-1])
                        nulls = min(max(without - lo, 0), hi - lo)
                        known = doc_ids.select_range(lo + nulls - without, hi - without) if hi - lo > nulls else np.zeros(0, np.int64)
                        ids = pa.array(np.append(np.zeros(nulls, np.int64), known), pa.int64(), mask=np.arange(hi - lo) < nulls)
                        numbers = [starts + first, stops - starts, np.array(_crcs(f, width, begin, stops), np.int64)]
                        yield pa.RecordBatch.from_arrays([ids, *[pa.array(c, pa.int64()) for c in numbers]], [id_col, "start", "n_tokens", "ids_crc32"])

    return spark.range(0, len(plan), 1, max(1, len(plan))).mapInArrow(task, f"{id_col} long, start long, n_tokens long, ids_crc32 long")


def document_ids(folder: str, shard: str, width: int, i: int) -> np.ndarray:
    """The ids of the i-th document of a shard, found by ``select`` alone."""
    ends, _ = EliasFano.from_bytes(_get(folder, f"{shard}.ef"))
    lo, hi = ends.select(i - 1) if i else 0, ends.select(i)
    fs, path = pafs.FileSystem.from_uri(folder)
    with fs.open_input_file(f"{path}/{shard}.ids") as f:
        return np.frombuffer(f.read_at((hi - lo) * width, lo * width), f"<u{width}")


def write_and_read(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """Encode ``docs`` into shards in the shared folder and return what reading them back gives."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "shards")
    return read(spark, folder, write(docs, folder, vocabulary, end_id))
