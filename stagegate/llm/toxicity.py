"""Toxicity by a weighted lexicon, matched by Aho-Corasick over folded text.

Folding lower-cases, replaces letters of other scripts and digits that look like
Latin letters, drops invisible characters and turns everything else that is no
letter into blanks.  The lexicon's entries are whole words and word beginnings;
each weighs the log odds of toxic against other documents that hold it, learned
from labelled documents.  Matches inside an exception phrase do not count.  The
sum of weights, normalised by length, becomes a score by a logistic curve.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release_memory, released

# Characters that look like a Latin letter (Cyrillic, Greek, digits and signs)
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "н": "h",
    "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ⅼ": "l",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a",
}
# Invisible characters
INVISIBLE = "­​‌‍⁠﻿"
# Phrases in which a word of the lexicon is not meant
EXCEPTIONS = ("clown fish", "clown car", "trash can", "trash bin", "trash bag", "pond scum", "stupid question", "idiot proof", "loser bracket", "disgusting weather")

# signs that stand for a letter only between letters
_INSIDE = (("$", re.compile(r"(?<=\w)\$+(?=\w)"), "s"), ("!", re.compile(r"(?<=\w)!(?=\w)"), "i"))


class _Fold(dict):
    """Code point -> its folded form, found once."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        low = c.lower()
        if c in INVISIBLE:
            to = ""
        elif low in LOOKALIKES:
            to = LOOKALIKES[low]
        elif "！" <= c <= "～":  # full-width forms
            to = self[code - 0xFEE0]
        elif c.isalpha():
            to = low
        else:
            to = " "
        self[code] = to
        return to


_FOLD = _Fold()


def fold(text: str | None) -> str:
    """Folded text: words of letters, each with one blank before it, and a blank at the end."""
    t = text or ""
    for sign, inside, letter in _INSIDE:
        if sign in t:
            t = inside.sub(letter, t)
    return f" {' '.join(t.translate(_FOLD).split())} "


@dataclass(frozen=True)
class Lexicon:
    """Entries begin with a blank: " word " is a whole word, " word" a beginning. The curve is 1 / (1 + exp(-(bias + slope * x)))."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    power: float = 0.5
    slope: float = 1.0
    bias: float = -1.0

    def matcher(self):
        import ahocorasick

        auto = ahocorasick.Automaton()
        for w, x in self.weights.items():
            auto.add_word(w, (len(w), x))
        for e in self.exceptions:
            auto.add_word(e := fold(e), (len(e), None))
        if len(auto):
            auto.make_automaton()
        return auto

    def measure(self, auto, folded: str) -> tuple[int, float, float]:
        """(matches, sum of weights, that sum over words ** power); of entries that begin at one place the heaviest counts."""
        words = folded.count(" ") - 1
        if not len(auto) or words < 1:
            return 0, 0.0, 0.0
        best: dict[int, float] = {}
        spared = []
        for end, (n, x) in auto.iter(folded):
            at = end - n + 1
            if x is None:
                spared.append((at, end))
            else:
                best[at] = max(x, best.get(at, -math.inf))
        if spared:
            best = {at: x for at, x in best.items() if not any(lo <= at < hi for lo, hi in spared)}
        total = sum(best.values())
        return len(best), total, total / words**self.power

    def score(self, x: float) -> float:
        z = max(-30.0, min(30.0, self.bias + self.slope * x))
        return 1 / (1 + math.exp(-z))


def entries(folded: str, least: int = 4, most: int = 8) -> set[str]:
    """Possible entries of a text: its words, however short, and their beginnings of ``least`` to ``most`` letters."""
    out = set()
    for w in set(folded.split()):
        out.add(f" {w} ")
        if len(w) >= least:
            out.update(f" {w[:n]}" for n in range(least, min(most, len(w)) + 1))
    return out


def _counted(docs: DataFrame, label: str, only: set[str] | None) -> DataFrame:
    """(entry, label 0/1, documents) summed over tasks first, then by entry."""
    held = docs.sparkSession.sparkContext.broadcast(only) if only is not None else None

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for text in b.column(0):
                found = entries(fold(text.as_py()))
                seen.update(found if held is None else found & held.value)
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["entry", "n"])

    return docs.select(label).mapInArrow(released(task), "entry string, n long").groupBy("entry").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, labels: DataFrame, most_labelled: int = 20_000, least_documents: int = 5, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Lexicon:
    """Weigh a lexicon on at most ``most_labelled`` labelled documents, half of them toxic where there are so many.

    The documents are those whose hashed ids are least.  Entries need ``least_documents`` toxic
    documents and log odds of 2; all of them count.  The driver holds the entries of ``least_documents`` toxic ones, which the
    bound on labelled documents bounds.  Of several labels of an id the greater counts.
    Without a toxic and another document nothing is learned: every score is then below 0.5.
    """
    half = most_labelled // 2
    marked = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("doc_id IS NOT NULL AND y IN (0, 1)").groupBy("doc_id").agg(F.max("y").alias("y"))
    pick = lambda y: marked.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(half)
    sample = pick(0).unionByName(pick(1))  # bounded, so it may be broadcast
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(sample), "doc_id").select("text", "y").persist()
    try:
        sizes = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
        if not sizes.get(0) or not sizes.get(1):
            return Lexicon({}, slope=1.0, bias=-1.0)
        toxic = _counted(rows.where("y = 1"), "text", None).where(F.col("n") >= least_documents)
        toxic = {r["entry"]: r["n"] for r in toxic.collect()}
        other = {r["entry"]: r["n"] for r in _counted(rows.where("y = 0"), "text", set(toxic)).collect()}
        odds = {}
        for e, n in toxic.items():
            odds[e] = math.log((n + 0.5) / (sizes[1] + 1)) - math.log((other.get(e, 0) + 0.5) / (sizes[0] + 1))
        # a beginning that says no more than a shorter one is left out
        kept: dict[str, float] = {}
        for e in sorted((e for e in odds if odds[e] >= 2.0), key=lambda e: (len(e), e)):
            word = e.rstrip(" ")
            if not any(word[:n] in kept and kept[word[:n]] >= odds[e] - 0.5 for n in range(5, len(word) + 1)):
                kept[e] = odds[e]
        return _fit(rows, Lexicon(kept))
    finally:
        rows.unpersist()


def _fit(rows: DataFrame, lexicon: Lexicon) -> Lexicon:
    """Choose the power of the length and the curve by the likelihood of the labelled documents."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = lexicon.matcher()
        for b in batches:
            got = [(lexicon.measure(auto, f := fold(t))[1], f.count(" ") - 1) for t in (x.as_py() for x in b.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in got], pa.float64()), pa.array([n for _, n in got], pa.int64()), b.column(1)], ["x", "n", "y"])

    got = rows.select("text", "y").mapInArrow(released(task), "x double, n long, y int").collect()  # numbers of the bounded sample
    got.sort()
    x, n, y = (np.array([r[i] for r in got], float) for i in range(3))
    best = None
    for power in (0.0, 0.25, 0.5, 0.75, 1.0):
        v = x / np.maximum(n, 1) ** power
        scale = v[v > 0].mean() if (v > 0).any() else 1.0
        slope, bias = _logistic(v / scale, y)
        p = 1 / (1 + np.exp(-np.clip(bias + slope * v / scale, -30, 30)))
        loss = -np.mean(y * np.log(p + 1e-12) + (1 - y) * np.log(1 - p + 1e-12))
        if best is None or loss < best[0] - 1e-4:
            best = (loss, power, slope / scale, bias)
    return Lexicon(lexicon.weights, lexicon.exceptions, best[1], float(best[2]), float(best[3]))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and bias of a logistic curve, by damped Newton steps with a weak prior."""
    design = np.stack([x, np.ones_like(x)], 1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (p - y) + 0.01 * w
        hess = (design * (p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w -= step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), float(w[1])


def score(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score and matches of every document.

    NULL or empty text has no matches and gets the curve's value at 0.  NULL ids and
    repeated rows come out as they went in; an empty table gives none.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = lexicon.matcher()
        for b in batches:
            got = [lexicon.measure(auto, fold(t.as_py())) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([lexicon.score(x) for _, _, x in got], pa.float64()), pa.array([n for n, _, _ in got], pa.int64())], ["doc_id", "score", "matches"])

    return own.mapInArrow(released(task), "doc_id long, score double, matches long")


def keep_clean(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores under ``threshold``, with all their columns; nothing is shuffled."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        auto = lexicon.matcher()
        for texts in batches:
            yield pd.Series([lexicon.score(lexicon.measure(auto, fold(t))[2]) for t in texts], dtype="float64")
            texts = None  # not held while the next batch is read
        del auto
        release_memory()

    return docs.where(scored(F.col(text_col).cast("string")) < threshold)
