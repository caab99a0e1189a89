"""Conversation repair against an exhaustive search, damaged cases and the size of what stays unsettled."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from stagegate.llm import queries, repair

SPACE = " \t\n\x0b\x0c\r"
ALL = "conv_id long, turn long, role string, text string"


def faults(rows):
    """First fault of each (turn, role, text)."""
    out, seen = [], set()
    for _, role, text in rows:
        last = text.rstrip(SPACE)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "" if last in ".!?" else "truncated")
        seen.add((role, text))
    return out


def every_repair(rows):
    """(cost, audit, repaired) of all ways with up to two inserts between rows, by plain recursion."""
    bad, found = faults(rows), []

    def go(i, initials, cost, audit, said):
        if not re.fullmatch(r"(s?(ua)*u?)", initials):
            return
        options = [((), 0)] + [(x, 2 * len(x)) for n in (1, 2) for x in product("ua", repeat=n)]
        for ins, c in options:
            mid = initials + "".join(ins)
            add = [f"{ {'u': 'user', 'a': 'assistant'}[x] }:" for x in ins]
            if i == len(rows):
                if re.fullmatch(r"(s?(ua)+)?", mid):
                    found.append((cost + c, audit + "I" * len(ins), "\n".join(said + add)))
                continue
            _, role, text = rows[i]
            go(i + 1, mid, cost + c + 3, audit + "I" * len(ins) + "D", said + add)
            if bad[i] in ("blank", "duplicate"):
                continue
            t = bad[i] == "truncated"
            go(i + 1, mid + (role[:1] or "-"), cost + c + t, audit + "I" * len(ins) + "K", said + add + [f"{role}:{text}"])
            for new in ("user", "assistant"):
                go(i + 1, mid + new[0], cost + c + 2 + t, audit + "I" * len(ins) + "R", said + add + [f"{new}:{text}"])

    go(0, "", 0, "", [])
    return min(found)


def searched(rows):
    s = repair.Survivors()
    tagged = [(*r, f) for r, f in zip(rows, faults(rows))]
    out, said, most = "", [], 0
    for r in tagged:
        for letter, new, row in s.add(r[1][:1], r[3] in ("blank", "duplicate"), r[3] == "truncated", r):
            out += letter
            said += [] if letter == "D" else [f"{new or row[1]}:{row[2] if row else ''}"]
        most = max(most, s.unsettled())
    for letter, new, row in s.finish():
        out += letter
        said += [] if letter == "D" else [f"{new or row[1]}:{row[2] if row else ''}"]
    return s.cost, out, "\n".join(said), most


def test_equals_exhaustive_search():
    rng = random.Random(5)
    roles = ["user", "assistant", "system", "tool", "", "User"]
    for _ in range(400):
        weights = rng.choice([(5, 5, 2, 1, 1, 1), (1, 0, 0, 0, 0, 0), (0, 3, 3, 0, 0, 0), (1, 1, 1, 1, 1, 1)])
        n = rng.randint(0, 4)
        rows = [(i, rng.choices(roles, weights)[0], rng.choice(["", " \t", "a.", "b", "c!", "d? \n", f"x{i}.", f"y{i}"])) for i in range(n)]
        assert searched(rows)[:3] == every_repair(rows), rows


def test_long_ties_against_whole_strings():
    """Longer rows against a search that carries whole strings and drops nothing but dearer or later ones of a state."""
    rng = random.Random(6)
    for _ in range(300):
        n = rng.randint(5, 60)
        rows = [(i, rng.choice(["user", "user", "assistant", "system", "tool"]), rng.choice([f"x{i}.", f"x{i}.", f"y{i}", ""])) for i in range(n)]
        best = {0: (0, "")}
        for (_, role, _), f in zip(rows, faults(rows)):
            now = {}
            for state, (cost, audit) in best.items():
                for after, more, letters, _ in repair._options(role[:1] if role[:1] in "sua" else "", f in ("blank", "duplicate"), f == "truncated")[state]:
                    now[after] = min(now.get(after, (1 << 60, "")), (cost + more, audit + letters))
            best = now
        ends = [(c + m, a + x) for s, (c, a) in best.items() for _, m, x, _ in repair._AT_END[s]]
        assert searched(rows)[:2] == min(ends)


def test_unsettled_rows_stay_few():
    rng = random.Random(7)
    rows = [(i, "ua"[i % 2] if rng.random() < 0.9 else rng.choice("uast"), f"text {i}." if rng.random() < 0.9 else "cut") for i in range(5000)]
    rows = [(i, {"u": "user", "a": "assistant", "s": "system", "t": "tool"}[r], x) for i, r, x in rows]
    cost, audit, _, most = searched(rows)
    assert len(audit) >= 5000 and most < 300
    # a tie that no later row breaks: still right, and linear in time
    users = [(i, "user", f"{i}.") for i in range(20001)]
    cost, audit, _, _ = searched(users)
    assert cost == 20002 and set(audit) <= set("KRI")


def expected(rows):
    """Digest columns of one damaged conversation's (turn, role, text) rows."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    bad = faults(rows)
    turns = {r[0] for r in rows if r[0] is not None}
    cost, audit, said = every_repair(rows)
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *[bad.count(x) for x in ("blank", "duplicate", "truncated")],
        sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])),
        cost, audit, hashlib.sha256(said.encode()).hexdigest(),
    )


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        key, mine = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}", out.setdefault(conv, [])
        role, text, f = role if role is not None else " ", text if text is not None else " ", zlib.crc32(key.encode()) % 20
        if f:
            row = (turn, "user" if f == 4 else role, "" if f == 1 else re.sub("[.!?]", "", text) if f == 2 else text)
            mine += [row] * (2 if f == 3 else 1)
    return out


def test_query_on_small_conversations(spark, tmp_path):
    rng = random.Random(8)
    rows = []
    for conv in [*range(150), None]:
        for turn in range(rng.randint(1, 5)):
            role = rng.choice(["user", "assistant", "system", None, "tool"]) if rng.random() < 0.3 else ("user", "assistant")[turn % 2]
            rows.append((conv, None if rng.random() < 0.05 else turn, role, rng.choice(["Hi.", "é cut", "", None, "x" * 3000 + "!", f"t{turn}?"])))
    rows += rows[:5]  # repeated rows of a table
    dropped = next(c for c in range(1000, 9999) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((dropped, 0, "user", "gone."))
    spark.createDataFrame(rows, ALL).withColumn("conv", F.lit("x")).withColumn("fault", F.lit(1)).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r[0]: tuple(r)[1:] for r in queries.op11_conversation_repair(spark, str(tmp_path)).collect()}
    want = {c: expected(r) for c, r in damaged(rows).items()}
    assert got[dropped] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == want


def test_edits_are_the_repaired_rows(spark):
    rows = [(1, 0, "system", "S."), (1, 1, "assistant", "A."), (1, 2, "user", ""), (1, 3, "user", "U"), (2, 0, "user", "U?"), (2, 1, "assistant", "A!")]
    got = repair.edits(spark.createDataFrame(rows, ALL)).orderBy("conv_id", "step").collect()
    assert [(r.conv_id, r.edit, r.turn, r.role, r.text) for r in got if r.conv_id == 2] == [(2, "K", 0, "user", "U?"), (2, "K", 1, "assistant", "A!")]
    assert repair.audits(spark.createDataFrame(rows, ALL)).where("conv_id = 1").first().audit == "".join(r.edit for r in got if r.conv_id == 1)


@pytest.mark.parametrize("call", [repair.edits, repair.audits])
def test_empty_table(spark, call):
    assert call(spark.createDataFrame([], ALL)).count() == 0
