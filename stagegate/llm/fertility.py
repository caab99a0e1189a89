"""Quality rules from tokeniser fertility.

A public vocabulary with byte fallback splits every word of a text.  Three
measures follow: characters per token, the share of tokens that are bare bytes,
and the entropy of the tokens used, over the most it could be.  Their quartiles
over all documents of a language (or, without one, a script) give its bands, those
of entropy over its documents of like length (the same power of two of words); a
document beyond a band, by a stated multiple of the quartiles' distance, is
rejected.  Plain counts of words, symbols and repetition stand beside them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, WordHashes, mix64

_SPACE = " \t\n\x0b\x0c\r"
# Characters that count as symbols
SYMBOLS = "#*$%&|<>"
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]
# first code point of a script's main blocks, in order
_SCRIPTS = ((0x0, "latin"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "other"), (0x590, "hebrew"), (0x600, "arabic"), (0x900, "indic"), (0xE00, "other"), (0x3040, "kana"), (0x3400, "han"), (0xAC00, "hangul"), (0xD7B0, "other"))
# rows of bands that may be broadcast: under 100 bytes each
_MOST_BROADCAST = 100_000
MEASURES = ("chars_per_token", "byte_share", "token_entropy")
_WORKER: dict[str, "WordPieces"] = {}


class WordPieces(dict):
    """word -> its token ids as bytes; forgotten when ``limit`` words are held."""

    def __init__(self, path: str, limit: int = 600_000):
        import sentencepiece

        super().__init__()
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.limit = limit
        self.bare = np.array([self.sp.is_byte(i) for i in range(self.sp.get_piece_size())])

    def learn(self, words: set[bytes]) -> None:
        if len(self) > self.limit:
            self.clear()
        new = [w for w in words if w not in self]
        for lo in range(0, len(new), 4096):
            part = new[lo : lo + 4096]
            for w, ids in zip(part, self.sp.encode([w.decode("utf-8", "replace") for w in part], num_threads=1)):
                self[w] = np.array(ids, "<i4").tobytes()


def repeated_words(h: np.ndarray) -> int:
    """Words that stand in a 3-word window found twice or more."""
    if len(h) < 4:
        return 0
    w = mix64(mix64(h[:-2] * _C[0] + h[1:-1]) * _C[1] + h[2:])
    u, at, n = np.unique(w, return_inverse=True, return_counts=True)
    if len(u) == len(w):
        return 0
    twice = np.append(n[at] > 1, [False, False])
    twice[1:] |= twice[:-1].copy()
    first = np.append(n[at] > 1, [False, False])
    twice[2:] |= first[:-2]
    return int(twice.sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier one."""
    if "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(_SPACE)]
    return len(lines) - len(set(lines))


def script_of(text: str) -> str:
    """The script that most letters of a text are in."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    points = points[(points > 0x40) & (points != 0xD7) & (points != 0xF7)]
    if not len(points):
        return "none"
    at = np.searchsorted([s for s, _ in _SCRIPTS], points, "right") - 1
    return _SCRIPTS[int(np.bincount(at).argmax())][1]


_ROW = "doc_id long, grp string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_tokens long, chars_per_token double, byte_share double, token_entropy double"


def measures(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Counts and measures of each document (columns doc_id, text, lang); measures are NULL without a word."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _WORKER:
            _WORKER[vocabulary] = WordPieces(vocabulary)
        held, hashes = _WORKER[vocabulary], WordHashes(limit=200_000)
        for b in batches:
            ids, texts, langs = (c.to_pylist() for c in b.columns)
            for lo in range(0, len(ids), 256):
                part = [(t or "") for t in texts[lo : lo + 256]]
                split = [t.encode("utf-8", "surrogatepass").split() for t in part]
                held.learn(set().union(*split))
                rows = []
                for doc_id, lang, t, words in zip(ids[lo : lo + 256], langs[lo : lo + 256], part, split):
                    chars = len(t) - sum(map(t.count, _SPACE))
                    tokens = np.frombuffer(b"".join(map(held.__getitem__, words)), "<i4")
                    n = len(tokens)
                    rate = bare = entropy = None
                    if n:
                        c = np.unique(tokens, return_counts=True)[1] / n
                        rate, bare = chars / n, float(held.bare[tokens].mean())
                        entropy = float(-(c * np.log(c)).sum() / np.log(n)) if n > 1 else 1.0
                    rows.append((doc_id, lang or script_of(t), len(words), chars, sum(map(t.count, SYMBOLS)), repeated_lines(t), repeated_words(hashes.of(words)), n, rate, bare, entropy))
                types = [pa.int64(), pa.string(), *[pa.int64()] * 6, *[pa.float64()] * 3]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [x.split()[0] for x in _ROW.split(", ")])

    return docs.mapInArrow(task, _ROW)


def rate(docs: DataFrame, vocabulary: str, low: tuple[float, float, float] = (4.0, 8.0, 1.5), high: tuple[float, float, float] = (6.0, 8.0, 4.0), least: tuple[float, float, float] = (0.15, 0.02, 0.045), least_words: int = 50, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang") -> DataFrame:
    """Counts, measures, ``base_failed`` and ``kept`` of every document.

    base_failed: under ``least_words`` words, or over half of the words in repeated
    3-word windows.  Others are kept unless a measure lies below q1 - w or above q3 + w, where
    q1 and q3 are its quartiles over all documents of the language and length class that did
    not fail and w is ``low`` or ``high`` (per measure) times their distance, ``least`` at the least; documents with the
    same counts and measures, as copies have, are one in the quartiles.  The multiples stand where labelled texts
    part: see the README for the rates of right and wrong rejections.

    NULL text has no words and fails.  A NULL language goes by script.  NULL ids and repeated
    rows come out as they went in; an empty table gives none.
    """
    scratch = Scratch(docs.sparkSession, "fertility")
    lang = F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), lang.alias("lang"))
    rows = scratch.table(measures(own, vocabulary))
    failed = (F.col("n_words") < least_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    rows = rows.withColumn("len2", F.floor(F.log2(F.greatest("n_words", F.lit(1)))).cast("int"))
    quartiles = lambda m: F.percentile_approx(m, [0.25, 0.75], 10_000).alias(f"q_{m}")
    good = rows.where(~failed).select("grp", "len2", "n_words", "word_chars", "n_tokens", *MEASURES).distinct()
    by_language = good.groupBy("grp").agg(quartiles(MEASURES[0]), quartiles(MEASURES[1]))
    by_length = good.groupBy("grp", "len2").agg(quartiles(MEASURES[2]))
    # a row per language, and per language and power of two: broadcast unless there are very many
    bands = [scratch.table(by_language), scratch.table(by_length)]
    if bands[1].count() <= _MOST_BROADCAST:
        bands = [F.broadcast(b) for b in bands]
    met = rows.join(bands[0], "grp", "left").join(bands[1], ["grp", "len2"], "left")
    outside = []
    for m, below, above, floor in zip(MEASURES, low, high, least):
        q1, q3 = F.col(f"q_{m}")[0], F.col(f"q_{m}")[1]
        down, up = (F.greatest((q3 - q1) * x, F.lit(floor)) for x in (below, above))
        outside.append(F.coalesce((F.col(m) < q1 - down) | (F.col(m) > q3 + up), F.lit(False)))
    out = met.withColumn("base_failed", failed).withColumn("kept", ~failed & ~(outside[0] | outside[1] | outside[2]))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens", *MEASURES, "base_failed", "kept")
