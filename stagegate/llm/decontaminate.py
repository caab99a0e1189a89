"""Benchmark passages in documents, by SimHash of windows, in DataFrame functions only.

An item is the sequence of its five-word shingles.  Its windows are sized from
it: so many shingles that any passage with the wanted similarity, wherever its
words were changed or moved, still holds one whole aligned window (``window_size``).  The
documents are cut into consecutive windows of those sizes, the items have one at
every offset, so that some pair of windows lines up.  A window's 64-bit SimHash
is compared by multi-index blocks: with radius r the fingerprint is cut into
r + 1 blocks, and two fingerprints within r agree on one of them.

Candidates are verified exactly: every item-sized window of the document is
compared with the item by weighted Jaccard similarity, a shingle's weight being
how often it occurs, as a running sum over the shingles that enter and leave.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, row_keys

# A-Z and their lower case
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# index rows that may be broadcast: 24 bytes each, under 100 MB
_MOST_BROADCAST = 2_000_000


def window_size(n: int, percent: int, size: int, repeated: tuple[int, ...] = ()) -> int:
    """Shingles in a window for an item of n: the largest power of two w (up to 64) such that a run of 2w - 1 stays unchanged.

    Let c shingles of a passage be common with the item and l not.  It has at most n, and counts
    only if c >= percent / 100 (n + l), so l is at most n(1 - J) / (1 + J).  Where two runs
    meet that do not follow each other in the item, as after moved, inserted or deleted text,
    size - 1 shingles are not common, or size - 1 - k if the k words there occur
    elsewhere in the item as well.  ``repeated`` has, for k from 1 to size - 1, how many
    k-word strings of the item occur in it more than once.  A shingle ends one run at most.
    """
    left, breaks, used = n * (100 - percent) // (100 + percent), 0, 0
    lost = left
    for k in range(size - 1, 0, -1):
        have = (repeated[k - 1] if repeated else 0) - used
        take = max(min(have, left // (size - 1 - k)) if k < size - 1 else have, 0)
        breaks, used, left = breaks + take, used + take, left - take * (size - 1 - k)
    breaks += left // max(size - 1, 1)
    left %= max(size - 1, 1)
    run = -(-(-(-percent * (n + lost - left) // 100)) // (breaks + 1))
    w = 1
    while w < 64 and 4 * w - 1 <= run:
        w *= 2
    return w


def _window_column(percent: int, size: int) -> Column:
    """``window_size`` of an item from its columns n and repeated."""
    lost = F.floor(F.col("n") * (100 - percent) / (100 + percent))
    state = F.struct(lost.alias("left"), F.lit(0).cast("long").alias("breaks"))
    costs = F.sequence(F.lit(0), F.lit(size - 2)) if size > 1 else F.array().cast("array<int>")

    def step(acc: Column, cost: Column) -> Column:
        have = F.greatest(F.element_at("repeated", F.lit(size - 1) - cost) - acc["breaks"], F.lit(0).cast("long"))
        take = F.when(cost == 0, have).otherwise(F.least(have, F.floor(acc["left"] / F.greatest(cost, F.lit(1)))))
        return F.struct((acc["left"] - take * cost).alias("left"), (acc["breaks"] + take).alias("breaks"))

    def finish(acc: Column) -> Column:
        breaks, left = acc["breaks"] + F.floor(acc["left"] / max(size - 1, 1)), acc["left"] % max(size - 1, 1)
        run = F.ceil(F.ceil((F.col("n") + lost - left) * percent / 100) / (breaks + 1))
        w = F.lit(1)
        for k in range(1, 7):
            w = F.when(run >= (1 << k + 1) - 1, F.lit(1 << k)).otherwise(w)
        return w

    return F.aggregate(costs, state, step, finish)


def _repeated(hashes: Column, size: int) -> Column:
    """For k from 1 to size - 1 a number that the k-word strings found more than once do not exceed: twice those beyond the first of each."""
    more = [F.size(g) - F.size(F.array_distinct(g)) for g in (_grams(hashes, k) for k in range(1, size))]
    return F.array(*[(2 * x).cast("long") for x in more])


def with_shingles(rows: DataFrame, text_col: str, size: int, repeated: bool = False) -> DataFrame:
    """``rows`` with ``s`` in place of the text: array<long>, hashes of the ``size``-word shingles in order; [] with fewer words.

    With ``repeated`` also that, see ``_repeated``.  Each array leaves through a generator of one row: an expression that is used several times
    further on would else be worked out anew for each use.
    """
    rest = [c for c in rows.columns if c != text_col]
    words = F.filter(F.split(F.translate(F.coalesce(F.col(text_col), F.lit("")), _UPPER, _LOWER), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    hashed = rows.select(*rest, F.explode(F.array(F.transform(words, lambda w: F.xxhash64(w)))).alias("_h"))
    more = [_repeated(F.col("_h"), size).alias("repeated")] if repeated else []
    return hashed.select(*rest, *more, F.explode(F.array(_grams(F.col("_h"), size))).alias("s"))


def _grams(hashes: Column, size: int) -> Column:
    """Hashes of consecutive tuples: one array per place in the tuple, zipped."""
    n = F.size(hashes) - (size - 1)
    parts = [F.slice(hashes, F.lit(k + 1), F.greatest(n, F.lit(0))).alias(f"p{k}") for k in range(size)]
    return F.transform(F.arrays_zip(*parts), lambda t: F.xxhash64(*[t[f"p{k}"] for k in range(size)]))


def simhash(hashes: list[str]) -> str:
    """SQL of the 64-bit SimHash of 2^q hashes: bit b is set if more than half of them have it.

    Counts are kept eight to a long, a byte each: the bits b, b + 8, ... of a hash,
    moved to the low bits of the bytes, are added up; (count + w/2 - 1) & w is the vote.
    """
    w = len(hashes)
    ones = 0x0101010101010101
    out = []
    for b in range(8):
        counts = " + ".join(f"(shiftrightunsigned({h}, {b}) & {ones}L)" for h in hashes)
        vote = f"(({counts} + {ones * max(w // 2 - 1, 0)}L) & {ones * w}L)"
        shift = w.bit_length() - 1 - b
        out.append(f"shiftrightunsigned({vote}, {shift})" if shift >= 0 else f"shiftleft({vote}, {-shift})")
    return "(" + " | ".join(out) + ")"


def _windows(rows: DataFrame, keys: list[str], sizes: list[int], step: int | None = None) -> DataFrame:
    """(keys, w, at, fp): SimHash of the w shingles from ``at`` on.

    Without ``step`` consecutive windows of every size in one pass, cut out of tiles of the
    largest; with it, windows of the one size given at every ``step``.
    """
    top = max(sizes)
    step = step or top
    least = min(sizes)
    last = F.greatest(F.floor((F.size("s") - least) / step).cast("int"), F.lit(0))
    # the tile's hashes leave the generator as columns: they are read many times below
    at = lambda i, k: F.coalesce(F.try_element_at("s", i * step + (k + 1)), F.lit(0).cast("long")).alias(f"h{k}")
    tiles = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct((i * step).alias("at"), (F.size("s") - i * step).alias("n"), *[at(i, k) for k in range(top)]))
    cut = rows.where(F.size("s") >= least).select(*keys, F.inline(tiles))
    # a column for each fingerprint of a tile, then a row
    fps = [(w, o) for w in sizes for o in range(0, top if step == top else 1, w)]
    marked = cut.select(*keys, "at", "n", *[F.expr(simhash([f"h{k}" for k in range(o, o + w)])).alias(f"f{w}_{o}") for w, o in fps])
    each = [F.struct(F.lit(w).alias("w"), (F.col("at") + o).alias("at"), F.when(F.col("n") >= o + w, F.col(f"f{w}_{o}")).alias("fp")) for w, o in fps]
    return marked.select(*keys, F.inline(F.array(*each))).where("fp IS NOT NULL")


def _blocks(windows: DataFrame, radius: int) -> DataFrame:
    """A row per block of the fingerprint: (w, block, bits, ...)."""
    n, width = radius + 1, 64 // (radius + 1)
    cuts = [F.struct(F.lit(i).alias("block"), F.shiftrightunsigned("fp", i * width).bitwiseAND(F.lit((1 << width) - 1 if i < n - 1 else (1 << (64 - i * width)) - 1)).alias("bits")) for i in range(n)]
    return windows.withColumn("cut", F.explode(F.array(*cuts))).select("*", "cut.block", "cut.bits").drop("cut")


def matches(docs: DataFrame, items: DataFrame, percent: int = 80, size: int = 5, radius: int = 3, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, item, similarity, start, words): the best item-sized passage of each document for each item it holds.

    Words are ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased; ``start`` and ``words`` count them.
    A passage counts from similarity ``percent`` / 100 on; ties go to the first.
    NULL or short texts (under ``size`` words) hold nothing, and items that short, NULL
    ids and NULL items are no queries.  Repeated rows of a document give one row.
    Empty tables give none.  Columns of ``docs`` and ``items`` beyond the four named are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontaminate")
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text")).where(F.col(id_col).isNotNull())
    wanted = items.select(F.col(item_col).alias("item"), F.col(item_text_col).cast("string").alias("text")).where("item IS NOT NULL")
    wanted = with_shingles(wanted, "text", size, repeated=True).where("size(s) > 0").distinct().withColumn("n", F.size("s"))
    wanted = scratch.table(wanted.withColumn("w", _window_column(percent, size)).drop("repeated"))
    sizes = sorted(r["w"] for r in wanted.select("w").distinct().collect())  # at most seven
    if not sizes:
        return texts.select(F.col("doc").alias(id_col), F.lit(None).cast(items.schema[item_col].dataType).alias(item_col), F.lit(0.0).alias("similarity"), F.lit(0).alias("start"), F.lit(0).alias("words")).where("false")

    index = reduce(DataFrame.unionByName, [_windows(wanted.where(F.col("w") == w).select("item", F.col("n").alias("item_n"), "s"), ["item", "item_n"], [w], 1) for w in sizes])
    index = scratch.table(_blocks(index, radius).select("w", "block", "bits", F.col("fp").alias("item_fp"), "item", "item_n").distinct())
    if index.count() <= _MOST_BROADCAST:
        index = F.broadcast(index)
    rows = with_shingles(texts, "text", size)
    probes = _blocks(_windows(rows, ["doc"], sizes), radius)
    close = probes.join(index, ["w", "block", "bits"]).where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius)
    pairs = scratch.table(close.select("doc", "item").distinct())
    best = _best_passages(texts, wanted.drop("w"), pairs, percent, size, scratch)
    return best.select(F.col("doc").alias(id_col), F.col("item").alias(item_col), "b.similarity", (-F.col("b.s")).alias("start"), "b.words")


def _best_passages(texts: DataFrame, wanted: DataFrame, pairs: DataFrame, percent: int, size: int, scratch: Scratch) -> DataFrame:
    """(doc, item, b: similarity, -start, words) of the best window of the item's size in the whole text, for ``pairs`` that have one.

    A window's weighted Jaccard is the sum of least counts over the sum of greatest ones.  As the window slides, an occurrence of a
    shingle that the item holds c times counts from where it enters until it leaves, but not while c
    earlier ones are in the window.  So it adds one at one start and takes it away at another, and the running sum of
    these steps is the count at every start: a text costs its length, however long the item.
    """
    few = with_shingles(texts.join(pairs.select("doc").distinct(), "doc", "left_semi"), "text", size)
    # rows that share an id are texts of their own; equal rows fall together in the sets of places
    words = few.select("doc", F.xxhash64("s").alias("text"), F.size("s").alias("size"), F.posexplode("s").alias("pos", "x"))
    counts = wanted.select("item", F.xxhash64("s").alias("version"), "n", F.explode("s").alias("x"))
    counts = scratch.table(counts.groupBy("item", "version", "n", "x").agg(F.count(F.lit(1)).cast("int").alias("c")))
    # shingles of no item leave in the scan, where the items' are few enough to be broadcast
    if counts.count() <= _MOST_BROADCAST:
        words = words.join(F.broadcast(counts.select("x").distinct()), "x", "left_semi")
    window = ["doc", "text", "size", "item", "version", "n"]
    places = words.join(pairs.join(counts, "item"), ["doc", "x"]).groupBy(*window, "x", "c").agg(F.sort_array(F.collect_set("pos")).alias("at"))

    def steps(p: Column, i: Column) -> Column:
        enters = F.greatest(p - F.col("n") + 1, F.coalesce(F.get("at", i - F.col("c")) + 1, F.lit(0)), F.lit(0))
        return F.array(F.struct(enters.alias("start"), F.lit(1).alias("d")), F.struct((p + 1).alias("start"), F.lit(-1).alias("d")))

    moves = places.select(*window, F.inline(F.flatten(F.transform("at", steps)))).groupBy(*window, "start").agg(F.sum("d").alias("d"))
    order = Window.partitionBy(*window).orderBy("start")
    held = moves.select(*window, "start", F.sum("d").over(order).alias("common"), F.lead("start").over(order).alias("next"))
    # the count holds up to the next step; where the text ends inside the window, it is shortest at the last start
    last = F.least(F.coalesce("next", "size"), F.col("size")) - 1
    starts = F.when((last > F.col("start")) & (last > F.col("size") - F.col("n")), F.array("start", last)).otherwise(F.array("start"))
    tried = held.where("common > 0 AND start < size").withColumn("start", F.explode(starts))
    tried = tried.withColumn("length", F.least("n", F.col("size") - F.col("start"))).withColumn("both", F.col("n") + F.col("length") - F.col("common"))
    scored = tried.where(F.col("common") * 100 >= F.col("both") * percent)
    one = F.struct((F.col("common") / F.col("both")).alias("similarity"), (-F.col("start")).alias("s"), (F.col("length") + size - 1).alias("words"))
    return scored.groupBy("doc", "item").agg(F.max(one).alias("b"))


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that hold a passage of an item; all columns.  A row without an id is examined like any other."""
    id_col = options.pop("id_col", "doc_id")
    keyed, key = row_keys(docs, id_col, Scratch(docs.sparkSession, "clean"))
    held = matches(keyed, items, id_col=key, **options).select(F.col(f"`{key}`").alias("_held")).distinct()
    left = keyed.join(held, keyed[key] == held["_held"], "left_anti")
    return left if key == id_col else left.drop(key)
