"""Structure repair of conversations by a Viterbi search that hands out edits as soon as they are settled.

A conversation is in order when the initials of its roles form ``(s?(ua)+)?``.  Its
rows are read by turn and edited: Keep costs 0, Rerole to user or assistant 2,
Delete 3 (the only choice for a blank row or a repeated one), Insert of a message
without text 2; a truncated row that stays adds 1.  The cheapest edits count, and of
equally cheap ones those whose letters come first in ASCII order.

Spark deals the conversations over tasks, finds faults with built-in functions and sorts
each conversation; a task then reads row after row.  For each state of the pattern it
keeps one survivor: the best edits that end there, a leaf of a tree of
backpointers.  Nodes count who refers to them.  What no survivor needs is freed, and
once all survivors share their first edit that edit is settled and leaves the tree.  A
survivor that is dearer than another by more than it costs to go on from the other
instead cannot win and is dropped, so that survivors meet soon.  Tied survivors are
compared over all their unsettled letters; the outcome holds as long as both live,
so a lasting tie is not read again at every row.  Memory is the unsettled rows of one conversation, usually one to three.  Only
rows that leave two equally good readings open for long (users and no one else, say) stay unsettled for long.

Cases: a NULL role or text is one space; rows of one turn go by role, then text; NULL turns come
first; rows whose conversation is NULL are one conversation; other columns are ignored, whatever
their names; an empty table gives no row.  A conversation is one sequence by nature (its digest too),
so one task reads it; its memory does not grow with it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
_COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
_SPACE = " \t\n\x0b\x0c\r"

# states: 0 nothing yet, 1 after the system message, 2 after user, 3 after assistant; 0 and 3 may end
_NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_END = (0, 3)
_NAMES = {"u": "user", "a": "assistant"}
# [b][q]: the most by which the rest can cost more from state b than from q: what b lacks is
# inserted, a row that q keeps as the system message is deleted
_INSTEAD = ((0, 0, 2, 0), (4, 0, 2, 4), (5, 2, 0, 2), (3, 0, 2, 0))


def _inserts(state: int) -> list[tuple[int, tuple]]:
    """(state, steps) of inserting no, one and two messages; a third would come back to a state passed."""
    out, steps = [(state, ())], ()
    for _ in range(2):
        initial = "a" if state == 2 else "u"
        state, steps = _NEXT[state, initial], (*steps, (INSERT, _NAMES[initial]))
        out.append((state, steps))
    return out


def _options(initial: str, must_go: bool, truncated: bool) -> list[list[tuple]]:
    """For each state: (state after, cost, letters, steps) of all ways to insert messages and then edit one row."""
    table = []
    for state in range(4):
        ways = []
        for mid, steps in _inserts(state):
            edits = [(mid, 0, (DELETE, None))]
            if not must_go:
                edits += [(_NEXT[mid, initial], truncated, (KEEP, None))] if (mid, initial) in _NEXT else []
                edits += [(_NEXT[mid, i], truncated, (REROLE, name)) for i, name in _NAMES.items() if (mid, i) in _NEXT]
            for after, more, edit in edits:
                way = (*steps, edit)
                ways.append((after, more + sum(_COST[x] for x, _ in way), "".join(x for x, _ in way), way))
        table.append(ways)
    return table


_AT_END = [[(s, _COST[INSERT] * len(x), INSERT * len(x), x) for s, x in _inserts(state) if s in _END] for state in range(4)]


class _Node:
    """An unsettled edit: its letter, the role it gives (None: the row's own) and its row; it counts references."""

    __slots__ = ("parent", "letter", "role", "row", "children", "held", "depth")

    def __init__(self, parent: _Node | None, letter: str, role: str | None, row):
        self.parent, self.letter, self.role, self.row = parent, letter, role, row
        self.children: list[_Node] = []  # as many references as survivors branch off here
        self.held = 0  # survivors that end here
        self.depth = 0 if parent is None else parent.depth + 1

    def child(self, letter: str, role: str | None, row) -> _Node:
        for c in self.children:
            if c.letter == letter and c.role == role and c.row is row:
                return c
        self.children.append(_Node(self, letter, role, row))
        return self.children[-1]

    def release(self) -> None:
        """One survivor less ends here; free all that is not referred to any more."""
        self.held -= 1
        node = self
        while node.parent is not None and not node.children and not node.held:
            parent, node.parent = node.parent, None
            parent.children.remove(node)
            node = parent


class Survivors:
    """The search over one conversation.  ``add`` and ``finish`` return the edits settled by then, as (letter, role, row)."""

    _tables: dict[tuple, list] = {}

    def __init__(self) -> None:
        self.root = _Node(None, "", None, None)
        self.root.held = 1
        self.alive: dict[int, tuple[int, _Node]] = {0: (0, self.root)}
        self.order: dict[tuple[int, int], int] = {}
        self.cost = 0  # of the whole conversation, after ``finish``

    def add(self, initial: str, must_go: bool, truncated: bool, row) -> list[tuple]:
        kind = (initial if initial in ("s", "u", "a") else "", must_go, truncated)
        table = self._tables.get(kind)
        if table is None:
            table = self._tables[kind] = _options(*kind)
        self._step(table, row)
        for q, (cost, node) in list(self.alive.items()):
            if any(c + _INSTEAD[b][q] < cost for b, (c, _) in self.alive.items()):
                del self.alive[q]
                node.release()
        return self._settled()

    def finish(self) -> list[tuple]:
        self._step(_AT_END, None)
        best = min(c for c, _ in self.alive.values())
        for q, (cost, node) in list(self.alive.items()):
            if cost > best or any(c == best and self.order[b, q] < 0 for b, (c, _) in self.alive.items() if b != q):
                del self.alive[q]
                node.release()
        self.cost = best
        return self._settled()

    def unsettled(self) -> int:
        return max(node.depth for _, node in self.alive.values()) - self.root.depth

    def _step(self, table: list[list[tuple]], row) -> None:
        """The next survivor of each state: the least cost, then the letters that come first."""
        found: dict[int, tuple] = {}
        for state, (cost, _) in self.alive.items():
            for after, more, letters, way in table[state]:
                old = found.get(after)
                total = cost + more
                if old is None or total < old[0] or (total == old[0] and self._compare(state, letters, old[1], old[2]) < 0):
                    found[after] = (total, state, letters, way)
        order = {}
        for a, (_, s, x, _) in found.items():
            for b, (_, t, y, _) in found.items():
                if a < b:
                    order[a, b] = self._compare(s, x, t, y)
                    order[b, a] = -order[a, b]
        before, self.alive, self.order = self.alive, {}, order
        for after, (cost, state, _, way) in found.items():
            node = before[state][1]
            for letter, role in way:
                node = node.child(letter, role, None if letter == INSERT else row)
            node.held += 1
            self.alive[after] = (cost, node)
        for _, node in before.values():
            node.release()

    def _compare(self, a: int, x: str, b: int, y: str) -> int:
        """Survivor a's letters and ``x`` against b's and ``y``: -1 or 1 if they differ somewhere, -2 or 2 if one begins the other."""
        if a != b:
            known = self.order[a, b]
            if abs(known) == 1:
                return known
            m, n = self.alive[a][1], self.alive[b][1]  # one of them begins with the other: compare what is left
            tails = {a: [], b: []}
            while m is not n:
                if m.depth >= n.depth:
                    tails[a].append(m.letter)
                    m = m.parent
                else:
                    tails[b].append(n.letter)
                    n = n.parent
            x, y = "".join(reversed(tails[a])) + x, "".join(reversed(tails[b])) + y
        if x == y:
            return 0
        sign = -1 if x < y else 1
        return 2 * sign if x.startswith(y) or y.startswith(x) else sign

    def _settled(self) -> list[tuple]:
        out = []
        while len(self.root.children) == 1 and not self.root.held:
            self.root = self.root.children[0]
            self.root.parent = None
            out.append((self.root.letter, self.root.role, self.root.row))
        return out


def _prepared(rows: DataFrame, conv: str, turn: str, role: str, text: str, present: str | None) -> DataFrame:
    """Rows dealt by conversation and sorted, with their first fault; one shuffle serves window and order."""
    q = lambda name: F.col("`" + name.replace("`", "``") + "`")
    here = F.coalesce(q(present).cast("boolean"), F.lit(False)) if present else F.lit(True)
    df = rows.select(
        q(conv).alias("conv"),
        q(turn).cast("long").alias("turn"),
        F.coalesce(q(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(q(text).cast("string"), F.lit(" ")).alias("text"),
        here.alias("present"),
    ).repartition("conv")
    earlier = Window.partitionBy("conv", "role", "text", "present").orderBy(F.col("turn").asc_nulls_first())
    last = F.substring(F.rtrim("text", F.lit(_SPACE)), -1, 1)
    fault = (
        F.when(last == "", "blank").when(F.row_number().over(earlier) > 1, "duplicate").when(~last.isin(".", "!", "?"), "truncated").otherwise("")
    )
    return df.withColumn("fault", fault).sortWithinPartitions(F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text")


_ROW = ("turn", "role", "text", "fault")


def _by_conversation(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conversation, its present rows (turn, role, text, fault) one by one)."""

    def rows():
        for b in batches:
            yield from zip(*(b.column(n).to_pylist() for n in ("conv", "present", *_ROW)))

    for conv, group in groupby(rows(), key=lambda r: r[0]):
        yield conv, (r[2:] for r in group if r[1])


def _edited(s: Survivors, rows: Iterator[tuple]) -> Iterator[tuple]:
    """The edits of a conversation in order, each as soon as it is settled."""
    for r in rows:
        yield from s.add(r[1][:1], r[3] in ("blank", "duplicate"), r[3] == "truncated", r)
    yield from s.finish()


def edits(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: str | None = None) -> DataFrame:
    """A row per edit: conversation, step (from 0), edit (K R D I), turn, fault, and the role and text after the edit.

    The repaired conversation is its rows without ``D``, by step; inserted messages have no turn and an empty text.
    """
    df = _prepared(rows, conv, turn, role, text, present)
    names = [conv, "step", "edit", turn, "fault", role, text]
    schema = T.StructType([T.StructField(n, t) for n, t in zip(names, [df.schema["conv"].dataType, T.LongType(), T.StringType(), T.LongType(), *[T.StringType()] * 3])])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types: list = []

        def seen():
            for b in batches:
                types[:] = [b.schema.field("conv").type, pa.int64(), pa.string(), pa.int64(), *[pa.string()] * 3]
                yield b

        def batch(out):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

        out, size = [], 0
        for c, group in _by_conversation(seen()):
            for step, (letter, new, row) in enumerate(_edited(Survivors(), group)):
                at, own, said, fault = row or (None, None, "", "")
                out.append((c, step, letter, at, fault, new or own, said))
                size += len(said)
                if len(out) >= 4096 or size >= 1 << 24:
                    yield batch(out)
                    out, size = [], 0
        if out:
            yield batch(out)

    return df.mapInArrow(task, schema)


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def audits(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: str | None = None) -> DataFrame:
    """A row per conversation: what was wrong (gaps, blank, duplicate, truncated, illegal), cost, audit and the SHA-256 of the repaired rows.

    ``gaps`` are the turns missing between the least and the greatest one; ``illegal`` are neighbours whose role
    initials are not su, ua or au; ``audit`` holds the letters of the edits.  ``present`` names a boolean column: rows
    where it is not true only name their conversation.
    """
    df = _prepared(rows, conv, turn, role, text, present)
    types = [df.schema["conv"].dataType, *[T.LongType()] * len(_COUNTS), T.StringType(), T.StringType()]
    names = [conv, *_COUNTS, "audit", "repaired_sha256"]
    schema = T.StructType([T.StructField(n, t) for n, t in zip(names, types)])

    def one(rows: Iterator[tuple]) -> tuple:
        n = dict.fromkeys(_COUNTS, 0)
        first = last = before = None
        turns = 0

        def watched():
            nonlocal first, last, before, turns
            for r in rows:
                if r[0] is not None and r[0] != last:
                    first, last, turns = r[0] if first is None else first, r[0], turns + 1
                if r[3]:
                    n[r[3]] += 1
                if before is not None and before + r[1][:1] not in ("su", "ua", "au"):
                    n["illegal"] += 1
                before = r[1][:1]
                yield r

        search, audit, digest, between = Survivors(), [], hashlib.sha256(), b""
        for letter, new, row in _edited(search, watched()):
            audit.append(letter)
            if letter != DELETE:
                digest.update(between + f"{new or row[1]}:{row[2] if row else ''}".encode("utf-8", "surrogatepass"))
                between = b"\n"
        n["gaps"] = last - first + 1 - turns if turns else 0
        n["cost"] = search.cost
        return (*n.values(), "".join(audit), digest.hexdigest())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind: list = []

        def seen():
            for b in batches:
                kind[:] = [b.schema.field("conv").type]
                yield b

        def batch(out):
            cols = list(zip(*out))
            arrow = [*kind, *[pa.int64()] * len(_COUNTS), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, arrow)], names)

        out = []
        for c, group in _by_conversation(seen()):
            out.append((c, *one(group)))
            for _ in group:  # read to the end, also where ``one`` did not
                pass
            if len(out) >= 1024:
                yield batch(out)
                out = []
        if out:
            yield batch(out)

    return df.mapInArrow(task, schema)
