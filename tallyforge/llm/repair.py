"""Repair of conversation structure at the least cost, with an audit of the edits."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.prefix_trie import CRC_TABLE_SQL, EMPTY_SHA256, crc32_sql

#: Edits in ASCII order; their digit is the place in this text, 0 is padding.
LETTERS = " DIKR"
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 4, 3, 3, 3
#: States of the grammar (s?(ua)+)?: nothing yet, after s, after u, after a.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: The state that a user or assistant turn leads to; each state allows one of the two.
_NEXT = (USER, USER, ASSISTANT, USER)
_KEPT = {("s", NOTHING): SYSTEM, ("u", NOTHING): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
#: Rows of a block, whose weights are summed up at once.
BLOCK = 128
_BITS = 3
WHITE = r"[\x20\x09-\x0D]"

#: A row as the repair sees it: the role's initial, whether it must be deleted, whether it is truncated.
Row = tuple[str, bool, bool]


class Weights:
    """Best ways through some rows: (begin state, end state) -> (weight, number of edits).

    A weight is one integer. Its low ``width`` digits of ``_BITS`` bits hold the edits in order, from the highest digit on, zeros
    after the last; the digits above them are the cost. So the least integer is the least cost, and of equal ones the least audit.
    """

    __slots__ = ("best", "width", "rows")

    def __init__(self, best: dict, width: int, rows: int):
        spare = width - max((n for _, n in best.values()), default=0)  # padding that no way uses
        self.best = {k: (w >> _BITS * spare, n) for k, (w, n) in best.items()}
        self.width, self.rows = width - spare, rows

    def then(self, other: Weights) -> Weights:
        width, out = self.width + other.width, {}
        low = (1 << _BITS * other.width) - 1
        for (a, b), (w1, n1) in self.best.items():
            padded = w1 << _BITS * other.width
            for (c, d), (w2, n2) in other.best.items():
                if b == c:
                    w = padded + (w2 >> _BITS * other.width << _BITS * width) + ((w2 & low) << _BITS * (self.width - n1))
                    if (a, d) not in out or w < out[a, d][0]:
                        out[a, d] = w, n1 + n2
        return Weights(out, width, self.rows + other.rows)


def _edit(cost: int, letter: int, at: int, width: int) -> int:
    return (cost << _BITS * width) + (letter << _BITS * (width - 1 - at))


def _insert(best: dict, width: int) -> dict:
    """``best`` (state -> (weight, edits)) with up to two turns inserted; more than two never help."""
    out, ahead = dict(best), best
    for _ in range(2):
        found = {}
        for state, (w, n) in ahead.items():
            new = w + _edit(INSERT_COST, INSERT, n, width)
            to = _NEXT[state]
            if to not in out or new < out[to][0]:
                out[to] = found[to] = new, n + 1
        ahead = found
    return out


def _through(best: dict, row: Row, width: int) -> dict:
    """``best`` after one more row, with turns inserted before it."""
    initial, gone, truncated = row
    out = {}
    for state, (w, n) in _insert(best, width).items():
        ways = [(state, _edit(DELETE_COST, DELETE, n, width))]
        if not gone:
            more = TRUNCATED_COST if truncated else 0
            ways.append((_NEXT[state], _edit(REROLE_COST + more, REROLE, n, width)))
            if (initial, state) in _KEPT:
                ways.append((_KEPT[initial, state], _edit(more, KEEP, n, width)))
        for to, weight in ways:
            if to not in out or w + weight < out[to][0]:
                out[to] = w + weight, n + 1
    return out


def block_weights(rows: list[Row], begins: Iterable[int]) -> Weights:
    """The DAG of one block: nodes are (row, state), every edge adds its cost and its edit's letter in the next digit."""
    width, ways = 3 * len(rows), {}
    for begin in begins:
        best = {begin: (0, 0)}
        for row in rows:
            best = _through(best, row, width)
        ways.update({(begin, end): found for end, found in best.items()})
    return Weights(ways, width, len(rows))


class Segment:
    """Rows of one conversation in order: their faults, and the best ways through them from each begin state."""

    def __init__(self, begins: Iterable[int]):
        self.begins, self.rows, self.done = tuple(begins), [], []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.first_turn = self.last_turn = self.least_turn = None

    def add(self, turn: int | None, initial: str, blank: bool, seen: bool, cut: bool, copies: int) -> None:
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.least_turn = turn if self.least_turn is None else self.least_turn
        if self.last is None:
            self.first, self.first_turn = initial, turn
        else:
            self.illegal += self.last + initial not in ("su", "ua", "au")
        self.illegal += copies - 1  # a row beside its copy
        self.last, self.last_turn = initial, turn
        again = 0 if blank else copies if seen else copies - 1
        self.blank, self.duplicate, self.truncated = self.blank + (copies if blank else 0), self.duplicate + again, self.truncated + (not blank and not seen and cut)
        for i in range(copies):
            self.rows.append((initial, blank or seen or i > 0, cut))
            if len(self.rows) == BLOCK:
                self._close()

    def _close(self) -> None:
        self.done.append(block_weights(self.rows, self.begins if not self.done else range(4)))
        self.rows = []
        while len(self.done) > 1 and self.done[-2].rows <= self.done[-1].rows:
            last = self.done.pop()
            self.done[-1] = self.done[-1].then(last)

    def weights(self) -> Weights:
        if self.rows or not self.done:
            self._close()
        while len(self.done) > 1:
            last = self.done.pop()
            self.done[-1] = self.done[-1].then(last)
        return self.done[0]

    def row(self) -> dict:
        w = self.weights()
        ways = [{"begin": a, "end": b, "cost": v >> _BITS * w.width, "audit": _letters(v, n, w.width)} for (a, b), (v, n) in sorted(w.best.items())]
        return {"n": w.rows, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal, "turns": self.turns,
                "first": self.first, "last": self.last, "first_turn": self.first_turn, "last_turn": self.last_turn, "least_turn": self.least_turn, "ways": ways}


_TO_TEXT, _TO_DIGITS = str.maketrans("1234", LETTERS[1:]), str.maketrans(LETTERS[1:], "1234")


def _letters(weight: int, n: int, width: int) -> str:
    """The audit of a weight of ``n`` edits."""
    return oct((weight & (1 << _BITS * width) - 1) >> _BITS * (width - n))[2:].translate(_TO_TEXT) if n else ""


def _weights(row: dict) -> Weights:
    width = max(len(w["audit"]) for w in row["ways"])
    best = {(w["begin"], w["end"]): ((w["cost"] << _BITS * width) + (int(w["audit"].translate(_TO_DIGITS) or "0", 8) << _BITS * (width - len(w["audit"]))), len(w["audit"]))
            for w in row["ways"]}
    return Weights(best, width, row["n"])


def folded(segments: list[dict]) -> dict:
    """A conversation's faults and its cheapest repair from its segments in order."""
    out = {k: sum(s[k] for s in segments) for k in ("blank", "duplicate", "truncated", "illegal", "turns")}
    turns = out.pop("turns")
    total, last = None, None
    for s in segments:
        if last is not None:
            out["illegal"] += last["last"] + s["first"] not in ("su", "ua", "au")
            turns -= s["first_turn"] is not None and s["first_turn"] == last["last_turn"]
        total, last = _weights(s) if total is None else total.then(_weights(s)), s
    least = next((s["least_turn"] for s in segments if s["least_turn"] is not None), None)
    out["gaps"] = 0 if least is None else last["last_turn"] - least + 1 - turns
    width = total.width + 2
    ends = _insert({b: (w << 2 * _BITS, n) for (a, b), (w, n) in total.best.items() if a == NOTHING}, width)
    weight, n = min(ends[q] for q in (NOTHING, ASSISTANT) if q in ends)
    return out | {"cost": weight >> _BITS * width, "audit": _letters(weight, n, width)}


def _rows(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    said = F.coalesce(F.col(text), F.lit(" "))
    return turns.select(F.col(conv).cast("bigint").alias("conv_id"), F.col(turn).cast("bigint").alias("turn"),
                        F.coalesce(F.col(role), F.lit(" ")).alias("role"), said.alias("text"), F.sha2(said.cast("binary"), 256).alias("sha"))


_SEGMENT = ("conv_id long, segment int, n long, blank long, duplicate long, truncated long, illegal long, turns long, first string, last string, "
            "first_turn long, last_turn long, least_turn long, ways array<struct<begin: int, end: int, cost: long, audit: string>>")
_SEGMENT_TYPE = pa.schema([("conv_id", pa.int64()), ("segment", pa.int32()), *[(c, pa.int64()) for c in ("n", "blank", "duplicate", "truncated", "illegal", "turns")],
                           ("first", pa.string()), ("last", pa.string()), *[(c, pa.int64()) for c in ("first_turn", "last_turn", "least_turn")],
                           ("ways", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])))])
REPAIR = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_REPAIR_TYPE = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string())])


def _segments(rows: DataFrame) -> DataFrame:
    """A row per conversation and range of the sorted rows; only the first and last of a range can go on in another."""

    def body(batches):
        part, first, out, last, segment = TaskContext.get().partitionId(), True, [], object(), None
        for batch in batches:
            for r in batch.to_pylist():
                if segment is None or r["conv_id"] != last:
                    if segment is not None:
                        out.append({"conv_id": last, "segment": part, **segment.row()})
                        first = False
                    if len(out) >= 1000:
                        yield pa.RecordBatch.from_pylist(out, schema=_SEGMENT_TYPE)
                        out = []
                    last, segment = r["conv_id"], Segment(range(4) if first else (NOTHING,))
                segment.add(r["turn"], r["initial"], r["blank"], r["seen"], r["cut"], r["copies"])
        if segment is not None:
            out.append({"conv_id": last, "segment": part, **segment.row()})
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_SEGMENT_TYPE)

    order = ["conv_id", "turn", "role", "sha"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "blank", "seen", "cut", "copies").mapInArrow(body, _SEGMENT)


def find_repairs(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """A row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit of the cheapest repair.

    Rows come in order of turn (null first), then role and the text's SHA-256; copies stand side by side. Null role and text count
    as one blank. A row's first fault counts: blank, duplicate (role and text stand earlier), truncated (the last character that is
    not white is none of ``.!?``). ``gaps`` counts missing turn numbers, ``illegal`` neighbours whose initials are not su, ua or au.
    The audit spells the edits (Delete, Insert, Keep, Rerole) after which the initials follow (s?(ua)+)?; of the cheapest ones it is
    the least in ASCII order.

    Copies of a row are counted before they are shuffled, then only a row's flags move: rows are range-partitioned in order, so a
    conversation that holds a third of all rows is dealt to many tasks, each of which sums up its part as 4 x 4 weights; a
    conversation's parts are put together in one task, in memory of its audit. An empty table gives no rows; other columns are ignored.
    """
    rows = _rows(turns, conv_col, turn_col, role_col, text_col)
    flags = rows.select("conv_id", "turn", "role", "sha", (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
                        (~F.col("text").rlike(rf"[.!?]{WHITE}*\z")).alias("cut"))
    counted = flags.groupBy("conv_id", "turn", "role", "sha", "blank", "cut").agg(F.count("*").alias("copies"))
    first = counted.groupBy("conv_id", "role", "sha").agg(F.min(F.struct("turn")).alias("first")).select(
        F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("sha").alias("s"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("sha") == F.col("s"))
    seen = counted.join(first, same).select("conv_id", "turn", "role", "sha", "blank", "cut", "copies",
                                            (~F.col("turn").eqNullSafe(F.col("first.turn"))).alias("seen"))

    def body(batches):
        held, last, out = [], None, []
        for batch in batches:
            for s in batch.to_pylist():
                if held and s["conv_id"] != last:
                    out.append({"conv_id": last, **folded(held)})
                    held = []
                held, last = [*held, s], s["conv_id"]
                if len(out) >= 1000:
                    yield pa.RecordBatch.from_pylist(out, schema=_REPAIR_TYPE)
                    out = []
        if held:
            out.append({"conv_id": last, **folded(held)})
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_REPAIR_TYPE)

    return _segments(seen).repartition("conv_id").sortWithinPartitions("conv_id", "segment").mapInArrow(body, REPAIR)


def repaired_turns(turns: DataFrame, repairs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The turns after their repairs: conv_id, position (from 0), role, text, edit (I, K or R).

    Every conversation of ``turns`` has a row in ``repairs`` (see ``find_repairs``); its rows are read as a stream after its audit.
    Rows of a conversation come in order, in one partition. Inserted turns have an empty text; deleted ones are gone.
    """
    rows = _rows(turns, conv_col, turn_col, role_col, text_col)
    both = rows.withColumn("audit", F.lit(None).cast("string")).unionByName(repairs.select("conv_id", "audit"), allowMissingColumns=True)
    dealt = both.withColumn("told", F.col("audit").isNull()).repartition("conv_id").sortWithinPartitions("conv_id", "told", "turn", "role", "sha")
    schema = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])

    def body(batches):
        conv = audit = None
        at = position = 0
        state, out = NOTHING, []

        def inserted():
            nonlocal at, position, state
            while at < len(audit) and audit[at] == "I":
                state = _NEXT[state]
                out.append((conv, position, "user" if state == USER else "assistant", "", "I"))
                at, position = at + 1, position + 1

        def made():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

        for whole in batches:
            for begin in range(0, whole.num_rows, 500):
                for c, role, text, told in zip(*(whole.slice(begin, 500).column(n).to_pylist() for n in ("conv_id", "role", "text", "audit"))):
                    if told is not None:
                        if audit is not None:
                            inserted()
                        conv, audit, at, position, state = c, told, 0, 0, NOTHING
                        continue
                    inserted()
                    edit, at = audit[at], at + 1
                    if edit != "D":
                        state = _NEXT[state] if edit == "R" else _KEPT[role[0], state]
                        out.append((conv, position, role if edit == "K" else "user" if state == USER else "assistant", text, edit))
                        position += 1
                if out:
                    yield made()
                    out.clear()
        if audit is not None:
            inserted()
        if out:
            yield made()

    return dealt.select("conv_id", "role", "text", "audit").mapInArrow(body, "conv_id long, position long, role string, text string, edit string")


def turn_digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of conversations whose rows come in order in one partition, as ``repaired_turns`` gives them:
    SHA-256 of ``role:text`` joined by line feeds. A conversation without rows has none."""
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])

    def body(batches):
        conv = running = None
        for batch in batches:
            done = []
            for c, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "text"))):
                if running is None or c != conv:
                    if running is not None:
                        done.append({"conv_id": conv, "repaired_sha256": running.hexdigest()})
                    conv, running = c, hashlib.sha256()
                else:
                    running.update(b"\n")
                running.update(f"{role}:{text}".encode())
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
        if running is not None:
            yield pa.RecordBatch.from_pylist([{"conv_id": conv, "repaired_sha256": running.hexdigest()}], schema=schema)

    return repaired.mapInArrow(body, "conv_id long, repaired_sha256 string")


def damaged(turns: DataFrame) -> DataFrame:
    """``conversations`` rows with known damage, by crc32 of ``conv_id:turn`` modulo 20 (nulls: one blank): 0 drops a row, 1 empties its
    text, 2 removes its marks ``.!?``, 3 repeats it, 4 makes it a user's."""
    blank = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind, text = F.crc32(name.cast("binary")) % 20, F.coalesce("text", blank)
    return turns.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), text.alias("text"), kind.alias("kind")).where("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def repair_report(ids: DataFrame, turns: DataFrame) -> DataFrame:
    """The repairs of ``turns`` with the digest of the repaired turns, for every conversation named in ``ids`` (conv_id); one without
    turns has zeros, an empty audit and the digest of nothing."""
    repairs = find_repairs(turns)
    digests = turn_digests(repaired_turns(turns, repairs)).withColumnRenamed("conv_id", "c")
    known = ids.select("conv_id").distinct()
    out = known.join(repairs.withColumnRenamed("conv_id", "r"), F.col("conv_id").eqNullSafe(F.col("r")), "left")
    out = out.join(digests, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    counts = [F.coalesce(n, F.lit(0)).alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(EMPTY_SHA256)).alias("repaired_sha256"))


REPAIR_SQL = rf"""
WITH RECURSIVE crc AS ({CRC_TABLE_SQL}),
src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               {crc32_sql("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS k FROM conversations, crc),
dam AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
               unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS copy FROM src WHERE k <> 0),
r AS (SELECT conv_id, turn, role, text, left(role, 1) AS ini, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen, NOT regexp_matches(text, '[.!?]{WHITE}*\z') AS cut,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM dam),
f AS (SELECT *, blank OR seen AS gone, NOT blank AND NOT seen AND cut AS trunc, lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini AS pair FROM r),
stat AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, sum(blank::BIGINT)::BIGINT AS blank,
                sum((seen AND NOT blank)::BIGINT)::BIGINT AS duplicate, sum(trunc::BIGINT)::BIGINT AS truncated,
                coalesce(sum((pair NOT IN ('su', 'ua', 'au'))::BIGINT), 0)::BIGINT AS illegal FROM f GROUP BY conv_id),
ins(q, to_q, cost, audit, body) AS (VALUES (0, 0, 0, '', []::VARCHAR[]), (0, 2, 3, 'I', ['user:']), (0, 3, 6, 'II', ['user:', 'assistant:']),
    (1, 1, 0, '', []), (1, 2, 3, 'I', ['user:']), (1, 3, 6, 'II', ['user:', 'assistant:']), (2, 2, 0, '', []), (2, 3, 3, 'I', ['assistant:']),
    (2, 2, 6, 'II', ['assistant:', 'user:']), (3, 3, 0, '', []), (3, 2, 3, 'I', ['user:']), (3, 3, 6, 'II', ['user:', 'assistant:'])),
op(q, edit, ini, to_q, cost, role) AS (SELECT q, 'D', '', q, 4, '' FROM range(4) x(q) UNION ALL
    SELECT * FROM (VALUES (0, 'R', '', 2, 3, 'user'), (1, 'R', '', 2, 3, 'user'), (2, 'R', '', 3, 3, 'assistant'), (3, 'R', '', 2, 3, 'user'),
                          (0, 'K', 's', 1, 0, ''), (0, 'K', 'u', 2, 0, ''), (1, 'K', 'u', 2, 0, ''), (3, 'K', 'u', 2, 0, ''), (2, 'K', 'a', 3, 0, ''))),
st AS (SELECT conv_id, 0::BIGINT AS i, 0::BIGINT AS q, '0000000000' AS weight, []::VARCHAR[] AS body FROM stat
       UNION ALL
       SELECT s.conv_id, f.i, op.to_q::BIGINT,
              min(printf('%010d', left(s.weight, 10)::BIGINT + ins.cost + op.cost + CASE WHEN op.edit <> 'D' AND f.trunc THEN 3 ELSE 0 END) || s.weight[11:] || ins.audit || op.edit),
              arg_min(s.body || ins.body || CASE op.edit WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [f.role || ':' || f.text] ELSE [op.role || ':' || f.text] END,
                      printf('%010d', left(s.weight, 10)::BIGINT + ins.cost + op.cost + CASE WHEN op.edit <> 'D' AND f.trunc THEN 3 ELSE 0 END) || s.weight[11:] || ins.audit || op.edit)
       FROM st s JOIN f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.i = s.i + 1 JOIN ins ON ins.q = s.q JOIN op ON op.q = ins.to_q
       WHERE op.edit = 'D' OR (NOT f.gone AND (op.edit = 'R' OR op.ini = f.ini)) GROUP BY s.conv_id, f.i, op.to_q),
fin AS (SELECT s.conv_id, min(printf('%010d', left(s.weight, 10)::BIGINT + ins.cost) || s.weight[11:] || ins.audit) AS weight,
               arg_min(s.body || ins.body, printf('%010d', left(s.weight, 10)::BIGINT + ins.cost) || s.weight[11:] || ins.audit) AS body
        FROM st s JOIN stat ON stat.conv_id IS NOT DISTINCT FROM s.conv_id AND stat.n = s.i JOIN ins ON ins.q = s.q WHERE ins.to_q IN (0, 3) GROUP BY s.conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(left(weight, 10)::BIGINT, 0) AS cost, coalesce(weight[11:], '') AS audit,
       sha256(coalesce(array_to_string(body, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN stat ON stat.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN fin ON fin.conv_id IS NOT DISTINCT FROM c.conv_id
"""
