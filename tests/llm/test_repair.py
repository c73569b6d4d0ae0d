"""Conversation repair against every possible edit of short conversations, and against a plain search on long ones."""

import hashlib
import itertools
import random
import re

import pytest

from tallyforge.llm import repair
from tallyforge.llm.queries import ORACLES, QUERIES
from tests.oracle import compare, connect

ROLES = {"u": "user", "a": "assistant"}


def every_edit(rows):
    """The cheapest audit of all sequences of edits with at most two turns inserted in a place."""
    gaps = [""] + ["".join(p) for n in (1, 2) for p in itertools.product("ua", repeat=n)]
    best = None
    for edits in itertools.product(*[["D"] if gone else ["D", "K", "u", "a"] for _, gone, _ in rows]):
        cost = sum(4 if e == "D" else (0 if e == "K" else 3) + 3 * cut for e, (_, _, cut) in zip(edits, rows))
        if best and cost > best[0]:
            continue
        for put in itertools.product(gaps, repeat=len(rows) + 1):
            total = cost + 3 * sum(map(len, put))
            if best and total > best[0]:
                continue
            made = "".join(p + ("" if e == "D" else i if e == "K" else e) for p, e, (i, _, _) in zip(put, edits, rows)) + put[-1]
            audit = "".join("I" * len(p) + (e if e in "DK" else "R") for p, e in zip(put, edits)) + "I" * len(put[-1])
            if re.fullmatch("(s?(ua)+)?", made) and (best is None or (total, audit) < best):
                best = total, audit
    return best


def plain(rows):
    """The same by a search with (cost, audit) pairs."""
    def put(best):
        for _ in range(2):
            for q, (c, a) in list(best.items()):
                to = repair._NEXT[q]
                best[to] = min(best.get(to, (10**9, "")), (c + 3, a + "I"))
        return best

    best = {0: (0, "")}
    for initial, gone, cut in rows:
        new = {}
        for q, (c, a) in put(best).items():
            ways = [(q, c + 4, a + "D")]
            if not gone:
                ways.append((repair._NEXT[q], c + 3 + 3 * cut, a + "R"))
                if (initial, q) in repair._KEPT:
                    ways.append((repair._KEPT[initial, q], c + 3 * cut, a + "K"))
            for to, *w in ways:
                new[to] = min(new.get(to, (10**9, "")), tuple(w))
        best = new
    best = put(best)
    return min(best[q] for q in (0, 3) if q in best)


def weighed(rows, parts=1):
    cuts = [len(rows) * i // parts for i in range(parts + 1)]
    segments = []
    for i, (a, b) in enumerate(itertools.pairwise(cuts)):
        s = repair.Segment(range(4) if i else (0,))
        for initial, gone, cut in rows[a:b]:
            s.add(1, initial, gone, False, cut, 1)
        if b > a:
            segments.append(s.row())
    out = repair.folded(segments)
    return out["cost"], out["audit"]


def some_rows(rng, n, initials="ssuuaax "):
    return [(rng.choice(initials), rng.random() < 0.2, rng.random() < 0.3) for _ in range(n)]


def test_all_edits_of_short_conversations():
    rng = random.Random(4)
    for n in (1, 1, 2, 2, 3) * 25:
        rows = some_rows(rng, n)
        assert weighed(rows) == every_edit(rows) == plain(rows), rows


@pytest.mark.parametrize("block", [1, 3, 128])
def test_blocks_and_segments_change_nothing(monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    rng = random.Random(block)
    for n in (1, 2, 7, 30, 200, 700):
        for parts in (1, 2, 5):
            rows = some_rows(rng, n, rng.choice(["ua", "ssuuaax ", "a", "s"]))
            assert weighed(rows, parts) == plain(rows)


def plain_report(rows):
    """(conv_id, turn, role, text) rows after damage -> the report of each conversation."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
        mine.sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1], hashlib.sha256(m[2].encode()).hexdigest()))
        seen, flags, faults = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, r, x in mine:
            body = x.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (r, x) in seen else "truncated" if body[-1] not in ".!?" else None
            seen.add((r, x))
            if fault:
                faults[fault] += 1
            flags.append((r[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        turns = {t for t, _, _ in mine if t is not None}
        cost, audit = plain(flags)
        lines, state, at = [], 0, 0
        for e in audit:
            if e in "IR":
                state = repair._NEXT[state]
                lines.append(("user:" if state == 2 else "assistant:") + (mine[at][2] if e == "R" else ""))
            elif e == "K":
                state = repair._KEPT[mine[at][1][0], state]
                lines.append(f"{mine[at][1]}:{mine[at][2]}")
            at += e != "I"
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *faults.values(), sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(flags, flags[1:])),
                     cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def test_report_over_many_partitions(spark):
    rng = random.Random(6)
    rows = [(c, rng.choice([None, *range(12)]), rng.choice(["system", "user", "assistant", "tool", "", None]), rng.choice(["a.", "b!", "c", "", " \n", None, f"x{rng.randrange(99)}?"]))
            for c in [*range(40), None, -3] for _ in range(rng.randint(1, 9))]
    rows += [(100, t // 2, "user" if t % 3 else "assistant", f"say {t % 900}." if t % 5 else "more") for t in range(2500)]  # a conversation over several ranges
    rows += [(101, 4, "user", "again.")] * 700 + [(102, t, "assistant", "same.") for t in range(600)]
    df = spark.createDataFrame([(*r, 3) for r in rows], "conv_id long, turn long, role string, text string, cost int")
    names = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "9"}
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n, v in names.items():
            spark.conf.set(n, v)
        got = {r[0]: tuple(r)[1:] for r in repair.repair_report(df, df).collect()}
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)
    assert got == plain_report(rows)
    gone = repair.repair_report(df, df.where("conv_id > 1000")).collect()
    assert len(gone) == 45 and {tuple(r)[1:] for r in gone} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert repair.repair_report(df.limit(0), df.limit(0)).collect() == [] and repair.repaired_turns(df.limit(0), repair.find_repairs(df.limit(0))).collect() == []


def test_repaired_turns(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Yes"), (1, 3, "assistant", "No."), (2, 0, "tool", "x" * 300_000 + ".")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = repair.repaired_turns(df, repair.find_repairs(df))
    # the copy must go, and without the truncated turn (4) it is cheaper than with it and a turn between (3 + 3)
    assert sorted(map(tuple, out.collect())) == [(1, 0, "user", "Hi.", "K"), (1, 1, "assistant", "No.", "K")]
    lone = df.where("conv_id = 1 AND turn > 1")  # two assistant turns: one is made the user's
    assert sorted(map(tuple, repair.repaired_turns(lone, repair.find_repairs(lone)).collect())) == [(1, 0, "user", "Yes", "R"), (1, 1, "assistant", "No.", "K")]


def test_damage_matches_sql(spark, tmp_path):
    rows = [(c, t if c % 7 else None, "user" if t % 2 == 0 else "assistant", f"Text {t}. More!" if c % 5 else "One?\r\n") for c in range(60) for t in range(c % 6 + 1)]
    rows += [(None, None, None, None), (900, 1, "user", "long. " * 40_000), (900, 2, "ümlaut", "é.")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    con = connect(str(tmp_path / "none"))
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    n, problems = compare(QUERIES["op12_conversation_repair"](spark, str(tmp_path)), con, ORACLES["op12_conversation_repair"])
    assert not problems and n == 62
