"""History-building operators: batch stamping, keyed updates, batch append,
latest row per key (type 1), version intervals and incremental merge (type 2).

Scale notes
-----------
* ``latest_per_key`` is one aggregate (``max`` of a struct ordered by the batch
  column): partial aggregation collapses a hot key on the map side.
* ``build_versions`` needs, for every row, the next row of the same key in
  (start, tiebreak) order.  A window partitioned by the key would put a hot key
  (say a third of all rows) into one task, so the rows are range-partitioned on
  (key, start, tiebreak) instead: Spark samples the ordering and cuts even
  ranges, splitting a hot key over many tasks while keeping the global order.
  A window over (range, key) finds the next row inside a range, with built-in
  ``lag``/``lead`` that keep every value as it is; the
  last row of a range takes the first row of the next non-empty range, from a
  table of at most one row per partition, which is broadcast (its size is
  bounded by the partition count, not by the data).  The ranged data are
  checkpointed once so every consumer sees the same ranges, and lineage is cut
  at that point (a lost executor re-reads the checkpoint, not the whole input).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.compare import orderable
from ..functions.predicates import free_names, qcol
from ..session import ensure_checkpoint_dir
from .skew import join_key_stats

# ---------------------------------------------------------------- H1


def stamp_batch(df: DataFrame, batch: dt.date | str | Column, column: str = "batch_date") -> DataFrame:
    """Copy of ``df`` with a constant batch column (a ``date`` for date/ISO-string input)."""
    if isinstance(batch, Column):
        value = batch
    elif isinstance(batch, dt.date):
        value = F.lit(batch)
    else:
        value = F.to_date(F.lit(batch))
    return df.withColumn(column, value)


# ---------------------------------------------------------------- H2


def apply_changes(
    df: DataFrame,
    changes: DataFrame,
    key: Sequence[str],
    columns: Sequence[str] | None = None,
    skew_safe: bool = False,
) -> DataFrame:
    """Keyed update: where ``changes`` has a row for a key, its non-key columns replace the old values.

    ``changes`` holds the key plus the changed columns, one row per key.  A NULL
    in ``changes`` means "set to NULL" only for keys present; keys absent from
    ``changes`` keep their values.  The join is a left outer join on the key:
    with a small change set it is broadcast by AQE from runtime size, otherwise a
    sort-merge join whose skewed partitions AQE splits.  AQE cannot split when
    ``changes`` arrives already partitioned by the key (e.g. straight out of an
    aggregate); ``skew_safe=True`` then counts the rows per key of ``df`` and
    joins hot keys from a bounded broadcast (``skew.join_key_stats``).
    """
    cols = [c for c in (columns or changes.columns) if c not in key]
    unknown = [c for c in cols if c not in df.columns]
    if unknown:
        raise ValueError(f"changes name columns absent from the data: {unknown}")
    hit_name, rows_name, *helpers = free_names(df.columns, "_hit", "_rows", *[f"_ck{i}" for i in range(len(key))], *[f"_cv{i}" for i in range(len(cols))])
    kn, cv = helpers[: len(key)], helpers[len(key) :]
    ch = changes.select(
        *[qcol(k).alias(n) for k, n in zip(key, kn)],
        F.lit(True).alias(hit_name),
        *[qcol(c).alias(n) for c, n in zip(cols, cv)],
    )
    if skew_safe:
        rows = df.select("*", *[qcol(k).alias(n) for k, n in zip(key, kn)])
        counts = df.groupBy(*[qcol(k).alias(n) for k, n in zip(key, kn)]).agg(F.count(F.lit(1)).alias(rows_name))
        joined = join_key_stats(rows, ch, kn, counts, rows_name, how="left")
    else:
        cond = [qcol(k) == F.col(n) for k, n in zip(key, kn)]
        joined = df.join(ch, cond, "left")
    hit = F.coalesce(F.col(hit_name), F.lit(False))
    out = []
    for name in df.columns:
        if name in cols:
            i = cols.index(name)
            out.append(F.when(hit, F.col(cv[i])).otherwise(qcol(name)).alias(name))
        else:
            out.append(qcol(name))
    return joined.select(*out)


def update_where(df: DataFrame, condition: Column | str, values: Mapping[str, object]) -> DataFrame:
    """Set columns to literal values (or Columns) on the rows matching ``condition``."""
    cond = F.expr(condition) if isinstance(condition, str) else condition
    out = []
    for name in df.columns:
        if name in values:
            v = values[name]
            v = v if isinstance(v, Column) else F.lit(v)
            dtype = df.schema[name].dataType
            out.append(F.when(cond, v.cast(dtype)).otherwise(qcol(name)).alias(name))
        else:
            out.append(qcol(name))
    return df.select(*out)


# ---------------------------------------------------------------- H3


def append_batch(history: DataFrame, batch: DataFrame) -> DataFrame:
    """Concatenate a new load onto the history, matching columns by name."""
    return history.unionByName(batch)


def batch_counts(df: DataFrame, batch_column: str = "batch_date") -> DataFrame:
    """Rows per batch (``batch_column``, ``n_rows``)."""
    return df.groupBy(qcol(batch_column)).agg(F.count(F.lit(1)).alias("n_rows"))


# ---------------------------------------------------------------- H4


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.MapType):
        return False
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return True


def latest_per_key(df: DataFrame, key: Sequence[str], order_by: Sequence[str] = ("batch_date",)) -> DataFrame:
    """Type-1 current view: for each key the row with the greatest ``order_by`` values.

    One aggregate: ``max(struct(order_by..., other columns...))`` per key, which
    breaks ties on the remaining columns so the result is deterministic, and
    which Spark aggregates partially before the shuffle.
    """
    rest = [c for c in df.columns if c not in key and c not in order_by]
    types = {f.name: f.dataType for f in df.schema.fields}
    packed = [qcol(c).alias(f"_o{i}") for i, c in enumerate(order_by)]
    if all(_orderable(types[c]) for c in rest):
        agg = F.max(F.struct(*packed, *[qcol(c).alias(f"_r{i}") for i, c in enumerate(rest)])).alias("_latest")
    else:
        agg = F.max_by(F.struct(*packed, *[qcol(c).alias(f"_r{i}") for i, c in enumerate(rest)]), F.struct(*packed)).alias("_latest")
    grouped = df.groupBy(*[qcol(k) for k in key]).agg(agg)
    out = []
    for name in df.columns:
        if name in key:
            out.append(qcol(name))
        elif name in order_by:
            out.append(F.col(f"_latest._o{list(order_by).index(name)}").alias(name))
        else:
            out.append(F.col(f"_latest._r{rest.index(name)}").alias(name))
    return grouped.select(*out)


# ---------------------------------------------------------------- H5


def scd2_load(
    df: DataFrame,
    batch: dt.date | str,
    changes: DataFrame | None = None,
    key: Sequence[str] = (),
    start_name: str = "effective_start_date",
    end_name: str = "effective_end_date",
    flag_name: str = "is_active",
    active: str = "Y",
    skew_safe: bool = False,
) -> DataFrame:
    """One type-2 load: optional keyed changes, then start = batch, end = NULL, flag = active.

    ``skew_safe`` goes to ``apply_changes``.
    """
    out = apply_changes(df, changes, key, skew_safe=skew_safe) if changes is not None else df
    start = F.lit(batch) if isinstance(batch, dt.date) else F.to_date(F.lit(batch))
    return out.withColumns({start_name: start, end_name: F.lit(None).cast("date"), flag_name: F.lit(active)})


# ---------------------------------------------------------------- H6 (full rebuild)


def ordered_ranges(df: DataFrame, order: Sequence[str], num_partitions: int | None = None, pid: str = "_pid") -> DataFrame:
    """``df`` cut into contiguous ranges of ``order``, sorted within each, with the range id ``pid``.

    Without an explicit count AQE sizes the ranges from the shuffle statistics
    (coalescing keeps ranges contiguous, so the order is preserved).  The result
    is materialised once (reliable checkpoint in the session's checkpoint folder):
    two independent range exchanges may sample different bounds, and every
    consumer must see the same ranges.  The range id is kept as data, so nothing
    downstream depends on physical layout.
    """
    ensure_checkpoint_dir(df.sparkSession)
    by_range = [qcol(c) for c in order]
    ranged = df.repartitionByRange(num_partitions, *by_range) if num_partitions else df.repartitionByRange(*by_range)
    return ranged.sortWithinPartitions(*by_range).withColumn(pid, F.spark_partition_id()).checkpoint(eager=True)


def _fields(columns: Sequence[Column], stem: str) -> Column:
    """A struct of ``columns`` with fields ``<stem>0``, ``<stem>1``, ..."""
    return F.struct(*[c.alias(f"{stem}{i}") for i, c in enumerate(columns)])


def _all_equal(columns: Sequence[Column], struct: str, stem: str) -> Column:
    """NULL-safe equality of ``columns`` with the fields of ``struct``."""
    cond = F.lit(True)
    for i, c in enumerate(columns):
        cond = cond & c.eqNullSafe(F.col(f"{struct}.{stem}{i}"))
    return cond


def build_versions(
    df: DataFrame,
    key: Sequence[str],
    start: str,
    tiebreak: Sequence[str] = (),
    start_name: str | None = None,
    end_name: str = "effective_end",
    flag_name: str = "is_active",
    active: str = "Y",
    inactive: str = "N",
    next_columns: Sequence[str] = (),
    num_partitions: int | None = None,
    tracked: Sequence[str] = (),
) -> DataFrame:
    """Full type-2 history: each row is a version of its key.

    Versions of a key are ordered by (start, tiebreak...).  ``end_name`` is the
    next version's start (half-open interval; NULL for the last version) and
    ``flag_name`` is ``active`` for the last version, ``inactive`` otherwise.
    ``next_columns`` (a subset of ``tiebreak``) are also emitted as ``next_<c>``.
    Two versions of a key with the same (start, tiebreak...) have no order: the
    job fails and names the key.

    With ``tracked`` columns, a row whose tracked values equal (NULL-safely) those
    of the previous row of its key is not a new version and is dropped first.
    Rebuilding from the kept log of loads then gives the same history as
    applying the loads one by one with ``merge_versions``, and also repairs
    keys that received a late load.
    """
    key, tiebreak, tracked = list(key), list(tiebreak), list(tracked)
    order, carry = key + [start] + tiebreak, [start] + tiebreak
    types = {f.name: f.dataType for f in df.schema.fields}
    pid, prev, nxt, edge = free_names(df.columns, "_pid", "_prev", "_next", "_edge")
    rows = ordered_ranges(df, order, num_partitions, pid)
    # inside a range, the rows of a key; a hot key has many ranges
    inside = Window.partitionBy(pid, *[qcol(k) for k in key]).orderBy(*[qcol(c) for c in carry])
    by_range = Window.orderBy(pid)
    keys = [qcol(k) for k in key]

    if tracked:
        state = [orderable(qcol(c), types[c]) for c in tracked]
        last = F.max_by(F.struct(_fields(keys, "k").alias("k"), _fields(state, "t").alias("t")), _fields([qcol(c) for c in order], "o"))
        # the last row of the previous non-empty range (at most one row per partition)
        tails = rows.groupBy(pid).agg(last.alias(edge)).select(pid, F.lag(edge).over(by_range).alias(edge))
        rows = rows.withColumn(prev, F.lag(_fields(state, "t")).over(inside)).join(F.broadcast(tails), pid, "left")
        before = F.when(F.col(prev).isNotNull(), F.col(prev)).when(
            F.col(edge).isNotNull() & _all_equal(keys, f"{edge}.k", "k"), F.col(f"{edge}.t")
        )
        rows = rows.withColumn(prev, before)
        repeat = F.col(prev).isNotNull() & _all_equal(state, prev, "t")
        rows = rows.where(~repeat).drop(prev, edge)

    # the first row of the next non-empty range
    heads = rows.groupBy(pid).agg(F.min(_fields([qcol(c) for c in order], "o")).alias(edge))
    heads = heads.select(F.lag(pid).over(by_range).alias(pid), edge).where(F.col(pid).isNotNull())
    own = _fields([qcol(c) for c in carry], "c")
    joined = rows.withColumn(nxt, F.lead(own).over(inside)).join(F.broadcast(heads), pid, "left")
    from_edge = _fields([F.col(f"{edge}.o{len(key) + i}") for i in range(len(carry))], "c")
    following = F.when(F.col(nxt).isNotNull(), F.col(nxt)).when(F.col(edge).isNotNull() & _all_equal(keys, edge, "o"), from_edge)
    joined = joined.withColumn(nxt, following)
    has_next = F.col(nxt).isNotNull()
    tie = has_next & _all_equal([qcol(c) for c in carry], nxt, "c")
    error = F.raise_error(F.concat(F.lit("versions without an order (same start and tiebreak) for key "), F.to_json(F.struct(*keys))))
    start_col = qcol(start).alias(start_name or start)
    flag = F.when(tie, error.cast("string")).when(has_next, F.lit(inactive)).otherwise(F.lit(active))
    flag = F.coalesce(flag, F.lit(active))  # never NULL, and Spark knows it
    return joined.select(
        *[qcol(c) for c in df.columns if c in key],
        *[qcol(c) for c in df.columns if c not in key and c != start],
        start_col,
        F.col(f"{nxt}.c0").alias(end_name),
        flag.alias(flag_name),
        *[F.col(f"{nxt}.c{carry.index(c)}").alias(f"next_{c}") for c in next_columns],
    )


# ---------------------------------------------------------------- H6 (incremental)


def merge_versions(
    history: DataFrame,
    batch: DataFrame,
    key: Sequence[str],
    tracked: Sequence[str],
    batch_start: str = "batch_date",
    start_name: str = "effective_start_date",
    end_name: str = "effective_end_date",
    flag_name: str = "is_active",
    active: str = "Y",
    inactive: str = "N",
) -> DataFrame:
    """Apply one load to a type-2 history (MERGE semantics, loads in date order).

    ``history`` has the key, the tracked columns and the interval/flag columns,
    with at most one active version per key (as ``build_versions`` and this
    function produce).  ``batch`` has the key, the tracked columns and
    ``batch_start``, and may carry other history columns (untracked attributes),
    which new versions take from it; a key with several rows in one batch keeps
    only its latest.
    For a key whose tracked values differ NULL-safely from its current version,
    or which is new, the current version is closed at the batch start and the
    batch row becomes the new current version.  A change whose batch start is
    not after the current version's start (a late load) fails the job: it cannot
    be applied incrementally; rebuild the key's history with ``build_versions``
    from the kept loads instead.  Keys absent from the batch, and
    keys whose values did not change, are left as they are; closed versions pass
    through untouched.

    Keys match NULL-safely, as in ``build_versions``.  Only the current versions of
    the load's keys meet the load, in a full outer join with one row per key on
    each side; everything else passes through an anti join with the load's keys.
    Both of the joins that read the history are broadcast by Spark where the load is small.
    """
    key, tracked = list(key), list(tracked)
    cols = key + tracked
    types = {f.name: f.dataType for f in history.schema.fields}
    # other history columns the batch carries (untracked attributes) go into new versions as they are
    carried = [c for c in history.columns if c in batch.columns and c not in cols + [start_name, end_name, flag_name, batch_start]]
    cur, new, bstart, *helpers = free_names(
        history.columns, "_cur", "_new", "_bstart", *[f"_bk{i}" for i in range(len(key))], *[f"_bt{i}" for i in range(len(tracked))], *[f"_bc{i}" for i in range(len(carried))]
    )
    bk, bt, bc = helpers[: len(key)], helpers[len(key) : len(cols)], helpers[len(cols) :]
    # one row per key: the latest by batch start (ties broken on the tracked values)
    batch = latest_per_key(batch.select(*[qcol(c) for c in cols + carried], qcol(batch_start)), key, [batch_start])
    b = batch.select(
        *[qcol(k).alias(n) for k, n in zip(key, bk)],
        *[qcol(c).alias(n) for c, n in zip(tracked, bt)],
        *[qcol(c).alias(n) for c, n in zip(carried, bc)],
        qcol(batch_start).alias(bstart),
        F.lit(True).alias(new),
    )
    same_key = F.lit(True)
    for k, n in zip(key, bk):
        same_key = same_key & qcol(k).eqNullSafe(F.col(n))
    is_current = F.coalesce(qcol(flag_name) == F.lit(active), F.lit(False))
    touched = history.where(is_current).join(b.select(*bk), same_key, "left_semi").withColumn(cur, F.lit(True))
    rest = history.where(~is_current).unionByName(history.where(is_current).join(b.select(*bk), same_key, "left_anti"))
    joined = touched.join(b, same_key, "full_outer")

    same = F.lit(True)
    for i, c in enumerate(tracked):
        same = same & orderable(qcol(c), types[c]).eqNullSafe(orderable(F.col(bt[i]).cast(types[c]), types[c]))
    has_cur = F.coalesce(F.col(cur), F.lit(False))
    has_new = F.coalesce(F.col(new), F.lit(False))
    closes = has_cur & has_new & ~same
    opens = has_new & (~has_cur | ~same)
    # a change dated at or before the version it would close is a late (out-of-order)
    # load: applying it would invert an interval, so the job fails instead
    late = closes & (F.col(bstart).cast(types[start_name]) <= qcol(start_name))
    late_error = F.raise_error(
        F.concat(F.lit("late load: batch start is not after the current version's start for key "), F.to_json(F.struct(*[qcol(k) for k in key])))
    )

    out_cols = list(history.columns)
    cur_version = F.struct(
        *[
            (
                F.when(closes, F.col(bstart).cast(types[c])).otherwise(qcol(c))
                if c == end_name
                else F.when(late, late_error.cast(types[c])).when(closes, F.lit(inactive)).otherwise(qcol(c))
                if c == flag_name
                else qcol(c)
            ).alias(c)
            for c in out_cols
        ]
    )

    def new_value(c: str):
        if c in key:
            return F.col(bk[key.index(c)]).cast(types[c])
        if c in tracked:
            return F.col(bt[tracked.index(c)]).cast(types[c])
        if c == start_name:
            return F.col(bstart).cast(types[c])
        if c == flag_name:
            return F.lit(active).cast(types[c])
        if c in carried:
            return F.col(bc[carried.index(c)]).cast(types[c])
        return F.lit(None).cast(types[c])  # end date, and columns the batch does not carry

    new_version = F.struct(*[new_value(c).alias(c) for c in out_cols])
    versions = F.array(F.when(has_cur, cur_version), F.when(opens, new_version))
    merged = joined.select(F.explode(F.filter(versions, lambda v: v.isNotNull())).alias("_v")).select("_v.*")
    return rest.unionByName(merged)


# ---------------------------------------------------------------- H6 (loads in any order)


def insert_load(
    history: DataFrame,
    batch: DataFrame,
    key: Sequence[str],
    tracked: Sequence[str],
    batch_start: str = "batch_date",
    start_name: str = "effective_start_date",
    end_name: str = "effective_end_date",
    flag_name: str = "is_active",
    active: str = "Y",
    inactive: str = "N",
    confirmed_name: str | None = "confirmed_dates",
) -> DataFrame:
    """Apply one load to a type-2 history, on time or late: only the neighbours of its place in each key change.

    For each key of the load, ``at`` is its batch start.  The version whose interval holds ``at`` is cut
    there if its tracked values differ (NULL-safely), the load's row becomes a version up to the next statement
    about the key, and a neighbour after it that says the same is joined with it.  Versions of
    other keys, and all but at most two versions of a key, pass through.

    ``confirmed_name`` is an array column with the dates at which later loads repeated a version.  With it loads in
    any order give the history that ``build_versions(..., tracked=tracked)`` gives over all of them (a late
    row may stand between two loads that said the same).  Without it (None) such repeats are not
    remembered, and a late row then holds up to the next version.

    A key with several rows in the batch keeps its latest; a load that contradicts another of the same
    date for a key fails the job (``raise_error``), for the two have no order; one that repeats it changes nothing.  Keys
    match NULL-safely.  New versions take the other history columns that the batch carries; one that takes over from
    a version after it has that version's closing date.  The rows of a key with very many versions are spread where they
    meet the load, and the changed versions leave by (key, start), which is unique.
    """
    key, tracked = list(key), list(tracked)
    types = {f.name: f.dataType for f in history.schema.fields}
    special = [start_name, end_name, flag_name] + ([confirmed_name] if confirmed_name else [])
    payload = [c for c in history.columns if c not in key + special]
    carried = [c for c in payload if c in batch.columns and c not in tracked]
    start_type = types[start_name]
    latest = latest_per_key(batch.select(*[qcol(c) for c in key + tracked + carried], qcol(batch_start).cast(start_type).alias("_at")), key, ["_at"])

    def packed(cols: Sequence[str], given: Sequence[str]) -> Column:
        return F.struct(*[(qcol(c).cast(types[c]) if c in given else F.lit(None).cast(types[c])).alias(f"p{i}") for i, c in enumerate(cols)])

    whole_key = F.struct(*[qcol(k).cast(types[k]).alias(f"k{i}") for i, k in enumerate(key)])  # NULL parts equal NULL parts
    load = latest.select(whole_key.alias("_key"), "_at", packed(payload, tracked + carried).alias("_new"))
    none = F.array().cast(T.ArrayType(start_type))
    confirmed = F.coalesce(F.array_sort(qcol(confirmed_name)), none) if confirmed_name else none
    version = F.struct(
        qcol(start_name).alias("start"), qcol(end_name).cast(start_type).alias("stop"), packed(payload, payload).alias("p"), confirmed.alias("seen")
    )
    rows = history.select(whole_key.alias("_key"), version.alias("_v"))

    # the version that holds the load's date and the next one, for each key of the load
    counts = rows.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).join(load.select("_key"), "_key", "left_semi")
    met = join_key_stats(rows, load.select("_key", "_at"), ["_key"], counts, "_n")
    before = F.col("_v.start") <= F.col("_at")
    order = F.col("_v.start")
    near = met.groupBy("_key").agg(F.max_by(F.when(before, F.col("_v")), F.when(before, order)).alias("_b"), F.min_by(F.when(~before, F.col("_v")), F.when(~before, order)).alias("_a"))
    place = load.join(near, "_key", "left")
    ensure_checkpoint_dir(history.sparkSession)
    place = place.checkpoint()  # a row per key of the load; read for what leaves and for what comes

    def same(a: str, b: str) -> Column:
        cond = F.lit(True)
        for c in tracked:
            i = payload.index(c)
            cond = cond & orderable(F.col(f"{a}.p{i}"), types[c]).eqNullSafe(orderable(F.col(f"{b}.p{i}"), types[c]))
        return cond

    at = F.col("_at")
    has_b, has_a = F.col("_b").isNotNull(), F.col("_a").isNotNull()
    repeats = has_b & same("_b.p", "_new")
    named = (F.col("_b.start") == at) | F.array_contains("_b.seen", at)  # the date has a statement already
    clash = F.raise_error(F.concat(F.lit("two loads of one date disagree for key "), F.to_json("_key")))
    earlier = F.filter("_b.seen", lambda d: d < at)
    later = F.filter("_b.seen", lambda d: d > at)
    goes_on = has_b & (F.size(later) > 0)  # the cut version is stated again after the load
    joins = ~goes_on & has_a & same("_a.p", "_new")
    of = lambda start, stop, p, seen: F.struct(start.alias("start"), stop.alias("stop"), p.alias("p"), seen.alias("seen"))
    b, a = F.col("_b"), F.col("_a")
    # unchanged values: only the date is noted
    noted = F.when(named, b["seen"]).otherwise(F.array_sort(F.concat(b["seen"], F.array(at))))
    unchanged = F.array(of(b["start"], b["stop"], b["p"], noted if confirmed_name else none))
    cut = F.when(has_b, of(b["start"], at, b["p"], earlier))
    until = F.when(goes_on, F.get(later, F.lit(0))).when(joins, a["stop"]).otherwise(F.coalesce(b["stop"], a["start"]))
    new_seen = F.when(joins, F.concat(F.array(a["start"]), a["seen"])).otherwise(none) if confirmed_name else none
    new = of(at, until, F.col("_new"), new_seen)
    again = F.when(goes_on, of(F.get(later, F.lit(0)), b["stop"], b["p"], F.slice(later, F.lit(2), F.greatest(F.size(later) - 1, F.lit(0)))))
    after = F.when(has_a & ~joins, a)
    changed = F.array_compact(F.array(cut, new, again, after))
    result = F.when(repeats, F.array_compact(F.array(unchanged[0], F.when(has_a, a)))).when(has_b & named, F.array(clash.cast(rows.schema["_v"].dataType))).otherwise(changed)
    came = place.select("_key", F.explode(result).alias("_v"))
    left = place.select("_key", F.explode(F.array_compact(F.array(F.col("_b.start"), F.col("_a.start")))).alias("_s"))
    rest = history.withColumns({"_key": whole_key, "_s": qcol(start_name)}).join(left, ["_key", "_s"], "left_anti")

    out = []
    for c in history.columns:
        if c in key:
            e = F.col(f"_key.k{key.index(c)}")
        elif c == start_name:
            e = F.col("_v.start")
        elif c == end_name:
            e = F.col("_v.stop").cast(types[c])
        elif c == flag_name:
            e = F.when(F.col("_v.stop").isNull(), F.lit(active)).otherwise(F.lit(inactive)).cast(types[c])
        elif c == confirmed_name:
            e = F.col("_v.seen")
        else:
            e = F.col(f"_v.p.p{payload.index(c)}")
        out.append(e.alias(c))
    return rest.select(*[qcol(c) for c in history.columns]).unionByName(came.select(*out))
