"""Language-model scoring by prediction by partial matching (PPM) over bytes.

Training counts every (order + 1)-byte string of the training documents; the
counts of a context's symbols at each lower order follow from it, so together
they are the context trie.  A byte is coded in its longest known context; where
it was not seen there the model escapes (method C: as likely as the number of
distinct symbols seen) to the next shorter context, in which the symbols of the
longer one are excluded, down to a uniform choice among the bytes never seen.
The code length of a text is the sum over its bytes and one end mark.

All strings count.  They stay in a Spark table, partitioned by the last three bytes of
their context: a partition holds whole every context of three bytes or more that
ends in these.  Contexts of up to two bytes have at most 2^24 strings, whatever the corpus,
and are broadcast.  The probabilities of the most frequent strings are broadcast
too, up to a stated number; the documents' other strings meet theirs in a join.

Beside it stands the plain baseline: unigram word counts with additive smoothing.
Counts of frequent words are broadcast up to a stated number; all others meet the
documents' words in a join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, WordHashes, ascii_words, mix64

END = 0xFF  # never a byte of UTF-8: stands before and after a text


def _padded(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array, each after ``order`` end marks and before one; and where the coded bytes of each begin."""
    pad = bytes([END]) * order
    buf = np.frombuffer(b"".join(x for t in texts for x in (pad, t, b"\xff")), np.uint8)
    sizes = np.array([len(t) + order + 1 for t in texts], np.int64)
    return buf, np.append(0, np.cumsum(sizes))


def _codes(buf: np.ndarray, order: int) -> np.ndarray:
    """The (order + 1)-byte string that ends at each byte from ``order`` on, as a number."""
    out = np.zeros(len(buf) - order, np.uint64)
    for k in range(order + 1):
        out = (out << np.uint64(8)) | buf[k : len(buf) - order + k]
    return out


def _coded(bounds: np.ndarray, order: int, n: int) -> np.ndarray:
    """Mask of the strings that end at a coded byte, not in the padding of a text."""
    keep = np.ones(n, bool)
    for k in range(1, order + 1):  # the next text's padding
        at = bounds[1:-1] - order + k - 1
        keep[at] = False
    return keep


def _batches_of(texts: list, size: int = 1 << 20):
    part, n = [], 0
    for t in texts:
        part.append(t)
        n += len(t)
        if n >= size:
            yield part
            part, n = [], 0
    if part:
        yield part


def gram_counts(docs: DataFrame, order: int, text_col: str = "text") -> DataFrame:
    """(suffix, gram, n): how often each (order + 1)-byte string occurs, added up in every task before the shuffle; partitioned by suffix."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def merged() -> pa.RecordBatch:
            every = np.concatenate([np.zeros(0, np.uint64), *(u for u, _ in held)])
            codes, at = np.unique(every, return_inverse=True)
            counts = np.bincount(at, np.concatenate([np.zeros(0), *(n for _, n in held)]), len(codes))
            return pa.RecordBatch.from_arrays([pa.array(codes.astype(np.int64)), pa.array(counts.astype(np.int64))], ["gram", "n"])

        for b in batches:
            for part in _batches_of([(t or "").encode("utf-8", "surrogatepass") for t in b.column(0).to_pylist()]):
                buf, bounds = _padded(part, order)
                c = _codes(buf, order)
                held.append(np.unique(c[_coded(bounds, order, len(c))], return_counts=True))
                size += len(held[-1][0])
                # rows go out in bounded pieces, so that a task never holds more than some millions
                if size > 4_000_000:
                    yield merged()
                    held, size = [], 0
        yield merged()

    counted = docs.select(text_col).mapInArrow(task, "gram long, n long").withColumn("suffix", _suffix(order))
    return counted.repartition("suffix").groupBy("suffix", "gram").agg(F.sum("n").alias("n"))


def _shared(order: int) -> int:
    """Bytes of the context that the strings of a partition share."""
    return min(3, order)


def _suffix(order: int) -> Column:
    """The last ``_shared`` bytes of the context of ``gram``."""
    return F.shiftright("gram", 8).bitwiseAND(F.lit((1 << 8 * _shared(order)) - 1).cast("long"))


def _narrow(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest type that holds them: the trie is broadcast."""
    most = x.max(initial=0)
    return x.astype(np.uint16 if most < 1 << 16 else np.uint32 if most < 1 << 32 else np.float64)


class Trie:
    """Counts of symbols in contexts of every order up to ``order``, as sorted arrays.

    The orders of ``low`` are taken from it: ``codes`` may then be those of some contexts only.
    """

    def __init__(self, codes: np.ndarray, counts: np.ndarray, order: int, low: Trie | None = None):
        self.order = order
        self.grams, self.count = [], []  # by order: strings and counts
        self.contexts, self.total, self.distinct = [], [], []
        if low is not None:
            for name in ("grams", "count", "contexts", "total", "distinct"):
                setattr(self, name, list(getattr(low, name)))
        for k in range(len(self.grams), order + 1):
            mask = np.uint64((1 << 8 * (k + 1)) - 1)
            g, at = np.unique(codes & mask, return_inverse=True)
            n = np.bincount(at, counts, len(g))
            c, at = np.unique(g >> np.uint64(8), return_inverse=True)
            self.grams.append(g)
            self.count.append(_narrow(n))
            self.contexts.append(c)
            self.total.append(_narrow(np.bincount(at, n, len(c))))
            self.distinct.append(_narrow(np.bincount(at, minlength=len(c))))
        # what a context's symbols weigh in the next shorter context: the excluded mass
        self.excluded = [None] if low is None else list(low.excluded)
        for k in range(len(self.excluded), order + 1):
            lower = self.grams[k] & np.uint64((1 << 8 * k) - 1)
            mass = self.count[k - 1][np.searchsorted(self.grams[k - 1], lower)]
            at = np.searchsorted(self.contexts[k], self.grams[k] >> np.uint64(8))
            self.excluded.append(_narrow(np.bincount(at, mass, len(self.contexts[k]))))

    @staticmethod
    def _find(table: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(table, x), max(len(table) - 1, 0))
        return at, (table[at] == x if len(table) else np.zeros(len(x), bool))

    def log10_of(self, codes: np.ndarray) -> np.ndarray:
        """log10 probability of each string's last byte after the bytes before it."""
        out = np.zeros(len(codes))
        left = np.arange(len(codes))  # not yet coded
        ex_mass, ex_n = np.zeros(len(codes)), np.zeros(len(codes))  # excluded by the longer context
        for k in range(self.order, -1, -1):
            code = codes[left] & np.uint64((1 << 8 * (k + 1)) - 1)
            c, known = self._find(self.contexts[k], code >> np.uint64(8))
            if not len(self.contexts[k]):
                continue
            mass = np.where(known, self.total[k][c].astype(float) - ex_mass[left], 0)
            fresh = np.where(known, self.distinct[k][c].astype(float) - ex_n[left], 0)
            open_ = mass > 0.5  # some symbol is not excluded
            g, seen = self._find(self.grams[k], code)
            seen &= open_
            whole = np.where(open_, mass + fresh, 1)
            out[left] += np.where(open_, np.log10(np.where(seen, self.count[k][g] if len(self.grams[k]) else 1, np.maximum(fresh, 1)) / whole), 0)
            if k:
                ex_mass[left] = np.where(known, self.excluded[k][c], 0)
            ex_n[left] = np.where(known, self.distinct[k][c], 0)
            left = left[~seen]
            if not len(left):
                return out
        out[left] -= np.log10(np.maximum(256 - ex_n[left], 1))
        return out


def train(docs: DataFrame, order: int = 5, text_col: str = "text") -> Trie:
    """The whole trie of ``docs`` in one place, for few documents; ``score`` keeps it in a table."""
    got = gram_counts(docs, order, text_col).toArrow()
    return Trie(got["gram"].to_numpy().astype(np.uint64), got["n"].to_numpy().astype(float), order)


def _low(counted: DataFrame, order: int) -> Trie | None:
    """The orders under ``_shared``, from all strings: at most 2^24 rows, a bound by the alphabet of bytes."""
    shared = _shared(order)
    if not shared:
        return None
    tail = F.col("gram").bitwiseAND(F.lit((1 << 8 * shared) - 1).cast("long"))
    got = counted.groupBy(tail.alias("gram")).agg(F.sum("n").alias("n")).toArrow()
    return Trie(got["gram"].to_numpy().astype(np.uint64), got["n"].to_numpy().astype(float), shared - 1)


def _logs(wanted: DataFrame, counted: DataFrame, low: Broadcast, order: int, piece: int = 1_000_000) -> DataFrame:
    """(gram, log): log10 probability of each string of ``wanted`` (gram), which are distinct.

    Strings and counts meet by suffix; sorted by it, a task holds whole suffixes of some ``piece`` rows at a time.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def logs(suffix: np.ndarray, gram: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            known = n > 0
            trie = Trie(gram[known], n[known].astype(float), order, low.value)
            asked = gram[~known]
            return pa.RecordBatch.from_arrays([pa.array(asked.astype(np.int64)), pa.array(trie.log10_of(asked))], ["gram", "log"])

        held, size = [], 0
        for b in batches:
            held.append((b.column(0).to_numpy(), b.column(1).to_numpy().astype(np.uint64), b.column(2).to_numpy()))
            size += len(b)
            if size < piece or held[0][0][0] == held[-1][0][-1]:
                continue
            suffix, gram, n = map(np.concatenate, zip(*held))
            cut = int(np.searchsorted(suffix, suffix[-1]))  # the last suffix may go on
            yield logs(suffix[:cut], gram[:cut], n[:cut])
            held, size = [(suffix[cut:], gram[cut:], n[cut:])], len(suffix) - cut
        if held:
            yield logs(*map(np.concatenate, zip(*held)))

    asked = wanted.select(_suffix(order).alias("suffix"), "gram", F.lit(0).cast("long").alias("n"))
    both = counted.select("suffix", "gram", "n").unionByName(asked)
    return both.repartition("suffix").sortWithinPartitions("suffix").mapInArrow(task, "gram long, log double")


def least_count(counted: DataFrame, most: int) -> int:
    """The least n such that at most ``most`` rows have it or more."""
    # counts over a million share their power of two: the histogram has at most 1,000,044 rows
    step = F.when(F.col("n") <= 1_000_000, F.col("n")).otherwise(F.pow(F.lit(2), F.floor(F.log2("n"))).cast("long"))
    hist = sorted(((r["s"], r["k"]) for r in counted.groupBy(step.alias("s")).agg(F.count("*").alias("k")).collect()), reverse=True)
    total, least = 0, None
    for s, k in hist:
        if total + k > most:
            return least if least is not None else s + 1
        total, least = total + k, s
    return 1


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): occurrences of each word (64-bit hash) and of the end (0), by task before the shuffle."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, n_docs = WordHashes(limit=200_000), [], 0
        for b in batches:
            n_docs += len(b)
            held += [hashes.of(ascii_words(t)) for t in b.column(0).to_pylist()]
            if sum(map(len, held)) > 2_000_000:
                u, n = np.unique(np.concatenate(held), return_counts=True)
                held = []
                yield pa.RecordBatch.from_arrays([pa.array(_word_ids(u)), pa.array(n.astype(np.int64))], ["word", "n"])
        u, n = np.unique(np.concatenate([*held, np.zeros(0, np.uint64)]), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(_word_ids(u), 0)), pa.array(np.append(n, n_docs).astype(np.int64))], ["word", "n"])

    return docs.select("text").mapInArrow(task, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).where("n > 0")


def _word_ids(h: np.ndarray) -> np.ndarray:
    """Hashes as signed numbers other than 0, which stands for the end."""
    h = h.astype(np.int64)
    return np.where(h == 0, 1, h)


def _strings(row: np.ndarray, gram: np.ndarray, k: np.ndarray) -> pa.RecordBatch:
    """Rows of kind 2: strings that each row has ``k`` times and that are not broadcast."""
    n = len(row)
    none, nil = np.zeros(n, np.int64), np.zeros(n)
    arrays = [pa.array(row), pa.nulls(n, pa.int64()), pa.array(np.full(n, 2, np.int32)), pa.array(gram.astype(np.int64)), pa.array(k.astype(np.int32)), pa.array(none), pa.array(none), pa.array(nil), pa.array(nil)]
    return pa.RecordBatch.from_arrays(arrays, ["row", "doc_id", "kind", "word", "k", "n_tokens", "n_known", "base", "score"])


_SCORED = "row long, doc_id long, kind int, word long, k int, n_tokens long, n_known long, base double, score double"


def score(docs: DataFrame, training: DataFrame, order: int = 5, most_grams: int = 3_000_000, most_words: int = 65_536, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs``.

    ``base_score`` is the unigram baseline over A-Z lower-cased words and one end;
    ``score`` the log10 probability that the PPM model of ``training`` gives the text's bytes and its end.
    NULL text is empty: one token, the end.  NULL ids and repeated rows come out as
    they went in.  With no training rows every word and byte is unknown; an empty table gives none.
    ``most_grams`` and ``most_words`` bound what is broadcast (16 bytes each) and change no result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "ppm")
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    learn = training.select(F.col(text_col).cast("string").alias("text"))
    context = Window.partitionBy("suffix", F.shiftright("gram", 8))  # at most 256 rows
    counted = gram_counts(learn, order).select("*", (F.sum("n").over(context) + F.count("*").over(context)).alias("whole"))
    counted = scratch.table(counted)
    low = spark.sparkContext.broadcast(_low(counted, order))
    # a string of the training documents is coded in its longest context
    often = counted.where(F.col("n") >= least_count(counted, most_grams)).select("gram", F.log10(F.col("n") / F.col("whole")).alias("log")).toArrow()
    at = np.argsort(often["gram"].to_numpy())
    common = spark.sparkContext.broadcast((often["gram"].to_numpy()[at].astype(np.uint64), often["log"].to_numpy()[at]))
    del often
    words = scratch.table(word_counts(learn))
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    least = least_count(words.where("word <> 0"), most_words)
    head = words.where((F.col("n") >= least) | (F.col("word") == 0)).toArrow()  # at most most_words + 1 rows
    at = np.argsort(head["word"].to_numpy())
    frequent = spark.sparkContext.broadcast((head["word"].to_numpy()[at], head["n"].to_numpy()[at]))
    whole = total + 0.5 * (distinct + 1)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        hashes, (grams, logs), (known, times) = WordHashes(limit=200_000), common.value, frequent.value
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            ids, raw = b.column(0).to_pylist(), b.column(1).to_pylist()
            done = 0
            for part in _batches_of([(t or "").encode("utf-8", "surrogatepass") for t in raw]):
                buf, bounds = _padded(part, order)
                codes = _codes(buf, order)
                u, where = np.unique(codes, return_inverse=True)
                at = np.minimum(np.searchsorted(grams, u), max(len(grams) - 1, 0))
                found = grams[at] == u if len(grams) else np.zeros(len(u), bool)
                got = np.where(found, logs[at] if len(grams) else 0, 0)[where]
                coded = _coded(bounds, order, len(codes))
                got[~coded] = 0
                open_ = np.flatnonzero(coded & ~found[where])
                of = np.searchsorted(bounds, open_, "right") - 1  # the text that each stands in
                pair, k = np.unique(of * len(u) + where[open_], return_counts=True)
                yield _strings(row + pair // len(u), u[pair % len(u)], k)
                scores = np.add.reduceat(got, np.minimum(bounds[:-1], len(got) - 1))
                cols: list[list] = [[] for _ in range(9)]
                for i, t in enumerate(part):
                    w, n = np.unique(np.append(_word_ids(hashes.of(t.lower().split())), 0), return_counts=True)
                    at = np.minimum(np.searchsorted(known, w), max(len(known) - 1, 0))
                    found = known[at] == w if len(known) else np.zeros(len(w), bool)
                    c = np.where(found, times[at] if len(known) else 0, 0)
                    found |= w == 0  # the end is never looked up again
                    base = float((n * np.log10((c + 0.5) / whole))[found].sum())
                    doc = ids[done + i]
                    first = [row, doc, 0, int(mix64(np.array([row], np.uint64)).astype(np.int64)[0]), 0, int(n.sum()), int(n[found & (c > 0)].sum()), base, float(scores[i])]
                    rare, k = w[~found], n[~found]
                    cols[0].append(np.full(len(rare) + 1, row))
                    cols[1].append(pa.array([doc] * (len(rare) + 1), pa.int64()))
                    cols[2].append(np.append(0, np.ones(len(rare), np.int32)))
                    cols[3].append(np.append(first[3], rare))
                    cols[4].append(np.append(0, k))
                    for j in (5, 6, 7, 8):
                        cols[j].append(np.append(first[j], np.zeros(len(rare), type(first[j]))))
                    row += 1
                done += len(part)
                types = (pa.int64(), None, pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
                arrays = [pa.concat_arrays(c) if t is None else pa.array(np.concatenate(c), t) for c, t in zip(cols, types)]
                yield pa.RecordBatch.from_arrays(arrays, ["row", "doc_id", "kind", "word", "k", "n_tokens", "n_known", "base", "score"])

    # kind 0 carries a row's sums, kind 1 a word too rare to be broadcast, kind 2 such a string; the first join on a number of their own
    rows = scratch.table(own.mapInArrow(task, _SCORED))
    rare = words.where((F.col("n") < least) & (F.col("word") != 0)).select(F.lit(1).alias("kind"), "word", F.col("n").cast("double").alias("c"))
    strings = rows.where("kind = 2").select(F.col("word").alias("gram")).distinct()
    logs_of = _logs(strings, counted, low, order).select(F.lit(2).alias("kind"), F.col("gram").alias("word"), F.col("log").alias("c"))
    met = rows.join(rare.unionByName(logs_of), ["kind", "word"], "left").withColumn("score", F.when(F.col("kind") == 2, F.col("k") * F.col("c")).otherwise(F.col("score")))
    met = met.withColumn("c", F.when(F.col("kind") == 1, F.coalesce("c", F.lit(0.0))))
    met = met.withColumn("base", F.when(F.col("kind") == 1, F.col("k") * F.log10((F.col("c") + 0.5) / F.lit(whole))).otherwise(F.col("base")))
    met = met.withColumn("n_known", F.when(F.col("c") > 0, F.col("k").cast("long")).otherwise(F.col("n_known")))
    summed = met.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"),
        F.sum("base").alias("base_score"),
        F.sum("score").alias("score"),
    )
    return summed.select("doc_id", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
