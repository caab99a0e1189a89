"""Joining rows with per-key statistics when one key may hold a large share of the rows.

A per-key table (counts, a key's latest value, ...) comes out of an aggregate
that is already hash-partitioned by the key, so a join of the rows with it
shuffles only the rows side, and a key holding a third of the rows would land
whole in one task; AQE cannot split that partition because the other side is
not a shuffle stage.  ``join_key_stats`` therefore splits the keys by size:

* a key is *hot* when it has more than
  ``max(hot_key_rows, total rows / max_hot_keys)`` rows.  Fewer than
  ``max_hot_keys`` keys can pass that bar, so their statistics are broadcast
  (a size bound that holds for any data size) and their rows are joined in place,
  without a shuffle;
* every other key has at most ``1 / max_hot_keys`` of the rows, so the shuffle
  join of the remaining rows is balanced to within that share.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import free_names, keys_not_null

HOT_KEY_MIN_ROWS = 100_000
MAX_HOT_KEYS = 100_000


def hot_keys(
    counts: DataFrame,
    key: Sequence[str],
    count_col: str,
    hot_key_rows: int = HOT_KEY_MIN_ROWS,
    max_hot_keys: int = MAX_HOT_KEYS,
    total=None,
) -> DataFrame:
    """Keys of ``counts`` (one row per key) whose ``count_col`` passes the hot bar; fewer than ``max_hot_keys``.

    ``total`` (a scalar Column) may replace the sum of the counts by any larger
    figure, e.g. the row count of the input, which Spark can compute in parallel
    with the per-key aggregate instead of after it; the bound still holds.
    """
    if total is None:
        total = counts.select(F.sum(count_col)).scalar()
    bar = F.greatest(F.lit(hot_key_rows).cast("double"), total / F.lit(max_hot_keys))
    return counts.where(F.col(count_col) > bar).select(*key)


def join_key_stats(
    rows: DataFrame,
    stats: DataFrame,
    key: Sequence[str],
    counts: DataFrame,
    count_col: str,
    hot_key_rows: int = HOT_KEY_MIN_ROWS,
    max_hot_keys: int = MAX_HOT_KEYS,
    how: str = "inner",
) -> DataFrame:
    """Join of ``rows`` with ``stats`` (one row per key) on ``key``, safe for hot keys.

    ``counts`` holds the number of ``rows`` per key in ``count_col`` (often
    ``stats`` itself); it decides which keys are hot.  ``how`` is ``inner`` or
    ``left`` (rows without stats kept, stats columns NULL).
    """
    cold, hot = join_key_stats_parts(rows, stats, key, counts, count_col, hot_key_rows, max_hot_keys, how)
    return cold.unionByName(hot)


def join_key_stats_parts(
    rows: DataFrame,
    stats: DataFrame,
    key: Sequence[str],
    counts: DataFrame,
    count_col: str,
    hot_key_rows: int = HOT_KEY_MIN_ROWS,
    max_hot_keys: int = MAX_HOT_KEYS,
    how: str = "inner",
) -> tuple[DataFrame, DataFrame]:
    """``join_key_stats`` as its two parts: (rows of ordinary keys, rows of hot keys).

    The first part comes out of a shuffle join and keeps its hash partitioning
    on the key; a union with the second would lose it.  Callers that go on
    joining or grouping by the key can therefore use the parts separately.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    key = list(key)
    # rows (>= the summed counts) is counted by its own scan, side by side with the per-key aggregate
    total = rows.select(F.count(F.lit(1))).scalar()
    hot = hot_keys(counts, key, count_col, hot_key_rows, max_hot_keys, total)
    cold = rows.join(F.broadcast(hot), key, "left_anti").join(stats, key, how)
    hot_stats = stats.join(F.broadcast(hot), key, "left_semi")  # fewer than max_hot_keys rows
    hot_rows = rows.join(F.broadcast(hot), key, "left_semi").join(F.broadcast(hot_stats), key, how)
    return cold, hot_rows


def salted_stats_join(
    rows: DataFrame,
    stats: DataFrame,
    key: Sequence[str],
    count_col: str,
    hot_key_rows: int = HOT_KEY_MIN_ROWS,
    max_hot_keys: int = MAX_HOT_KEYS,
    how: str = "inner",
    salts: int = 64,
) -> DataFrame:
    """Join of ``rows`` with ``stats`` (one row per key, ``count_col`` = its rows) that reads ``rows`` once.

    The rows of a hot key (bounded in number, see above; marked by a broadcast)
    and, for ``left``, rows with a NULL key spread over ``salts`` sub-keys, for
    which the hot keys' statistics are repeated; all other keys have one.  Where
    ``stats`` is small Spark broadcasts it and nothing is shuffled.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    key = list(key)
    salt, hot = free_names([*rows.columns, *stats.columns], "_salt", "_hot")
    marked = hot_keys(stats, key, count_col, hot_key_rows, max_hot_keys).withColumn(hot, F.lit(True))
    spread = (F.monotonically_increasing_id() % salts).cast("int")
    no_key = ~keys_not_null(key)
    left = rows.join(F.broadcast(marked), key, "left")
    left = left.withColumn(salt, F.when(F.coalesce(F.col(hot), no_key), spread).otherwise(F.lit(0))).drop(hot)
    right = stats.join(F.broadcast(marked), key, "left")
    copies = F.when(F.col(hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = right.withColumn(salt, F.explode(copies)).drop(hot)
    return left.join(right, [*key, salt], how).drop(salt)
