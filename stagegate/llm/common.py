"""Helpers shared by the operators: the shared folder, materialised tables and small numeric pieces."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.predicates import free_names
from ..session import shared_folder as _shared_folder


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one in ``spark.checkpoint.dir``, which driver and executors share; it goes with the driver's JVM."""
    return _shared_folder(spark, f"llm-{name}")


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``shared_folder`` named, through Spark's own file system layer."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class Scratch:
    """Tables of one operator run, kept in the shared folder until ``close`` or the end of the driver's JVM."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.n = spark, shared_folder(spark, name), 0

    def table(self, df: DataFrame) -> DataFrame:
        """Write ``df`` as Parquet and read it back: a lost executor costs no recomputation, and lineage ends here."""
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        drop_folder(self.spark, self.root)


def crc_mod(id_col: str, n: int):
    """crc32 of the id's decimal text, modulo ``n``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads 64-bit values, elementwise."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def release_memory() -> None:
    """Give the free memory that a worker's allocators keep back to the system."""
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
        pool.release_unused()


def released(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``task``, after which the worker keeps no free memory: it idles beside later stages, and other tasks run in it."""

    def run(batches: Iterator) -> Iterator:
        yield from task(batches)
        release_memory()

    return run


class WordHashes(dict):
    """word bytes -> 64-bit hash, remembered for the words of a task; emptied when it holds ``limit`` words."""

    def __init__(self, limit: int = 500_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def ascii_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def row_keys(docs: DataFrame, id_col: str, scratch: Scratch) -> tuple[DataFrame, str]:
    """``docs`` with a column of long keys, one a row, and that column's name.

    It is the id where each row has one of its own (and then nothing is added or written).  Else rows that share an id
    get numbers above all ids, and rows without one numbers above those, in a table written for it: each row counts for itself.
    """
    ident = F.col(f"`{id_col}`").cast("long")
    key, same = free_names(docs.columns, "_row", "_shared_id")
    shared = docs.where(ident.isNotNull()).groupBy(ident.alias(same)).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(same)
    shared = scratch.table(shared)
    if shared.isEmpty() and docs.where(ident.isNull()).isEmpty():
        return docs, id_col
    top = docs.select(F.coalesce(F.max(ident), F.lit(0))).first()[0]
    rows = docs.withColumn(key, F.monotonically_increasing_id() + F.lit(top + 1))
    # both sides are written tables, so that Spark can split a shared id that very many rows have
    rows = scratch.table(rows)
    last = rows.select(F.max(key)).first()[0]
    number = F.when(ident.isNull(), F.col(key) + F.lit(last - top)).when(F.col(same).isNull(), ident).otherwise(F.col(key))
    rows = rows.join(shared, ident == F.col(same), "left")
    return scratch.table(rows.withColumn(key, number).drop(same)), key
