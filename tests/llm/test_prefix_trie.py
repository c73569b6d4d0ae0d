"""The prefix trie against plain sets of prefixes, with blocks so small that most nodes span several."""

import hashlib
import random
import zlib

import pytest

from tallyforge.llm import prefix_trie as pt
from tallyforge.llm.queries import ORACLES, QUERIES
from tests.oracle import compare, connect


def sha(ids):
    return hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()


def plain_nodes(sequences):
    """(conv_id, list of (id, bytes)) pairs -> rows of the trie, from every distinct prefix."""
    members = {}
    for conv, turns in sequences:
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append((conv, len(turns) == d))
    least = {p: min((c for c, _ in m if c is not None), default=None) for p, m in members.items()}
    out = []
    for p, m in members.items():
        under = [q for q in members if q[:len(p)] == p]
        inner = {q[:-1] for q in members if q}
        out.append((least[p], len(p), least[p[:-1]] if p else None, len(m), sum(len(q) == len(p) + 1 for q in under), sum(q not in inner for q in under),
                    sum((len(members[q]) - 1) * q[-1][1] for q in under if q), sha([c for c, e in m if e and c is not None])))
    return sorted(out, key=str)


def frame(spark, sequences):
    rows = [(c, b"".join(hashlib.md5(str(i).encode()).digest() + n.to_bytes(8, "big") for i, n in t)) for c, t in sequences]
    return spark.createDataFrame(rows, "conv_id long, key binary")


def random_sequences(rng, n):
    hot = [(f"h{i}", i) for i in range(6)]
    out = []
    for c in range(n):
        start = hot[:rng.choice([0, 1, 3, 6])] if rng.random() < 0.7 else []
        rest = [(k, len(k)) for k in (f"t{rng.randrange(40)}" for _ in range(rng.choice([0, 0, 1, 2, 5])))]
        out.append((c * 3, start + rest))
    return out


@pytest.mark.parametrize("rows, size", [(1, 1 << 20), (7, 1 << 20), (50_000, 300), (50_000, 1 << 20)])
def test_blocks_change_nothing(spark, rows, size):
    sequences = random_sequences(random.Random(rows + size), 260) + [(None, [("h0", 0)]), (None, [("x", 1)]), (5000, []), (0, [("h0", 0)])]
    got = pt.prefix_trie(frame(spark, sequences).repartition(5), rows, size)
    assert sorted(map(tuple, got.select(*pt.RESULT).collect()), key=str) == plain_nodes(sequences)


def test_copies_and_long_keys(spark):
    long = [(f"l{i}", 2) for i in range(700)]
    sequences = [(i, [("a", 3)] * 2) for i in range(900)] + [(1000, long), (1001, long[:500]), (1002, long[:500] + [("z", 1)])]
    got = {tuple(r) for r in pt.prefix_trie(frame(spark, sequences), 100).select(*pt.RESULT).collect()}
    assert len(got) == 1 + 2 + 700 + 1
    assert (0, 2, 0, 900, 0, 1, 899 * 3, sha(range(900))) in got and (0, 0, None, 903, 2, 3, 899 * 6 + 1000 * 2, sha([])) in got
    assert (1000, 500, 1000, 3, 2, 2, 4, sha([1001])) in got
    assert pt.prefix_trie(frame(spark, sequences).limit(0)).collect() == []


def test_radix_tree_layouts():
    rng, tree, held = random.Random(2), pt.RadixTree(), {}
    for n in (3, 5, 17, 49, 200):
        for i in range(n):
            key = bytes([n, rng.randrange(256), i]) + bytes(rng.randrange(3) for _ in range(4))
            tree.insert(key, key)
            held[key] = key
        tree.insert(bytes([n]), n)
        held[bytes([n])] = n
    kinds, found, stack = set(), {}, [(tree.root, b"")]
    while stack:
        node, path = stack.pop()
        path += node.path
        kinds.add(type(node).__name__ + str(getattr(node, "room", "")))
        kids = list(node.kids())
        assert [k.path[0] for k in kids] == sorted({k.path[0] for k in kids}) and (len(kids) > 1 or node.end is not None or node is tree.root)
        if node.end is not None:
            found[path] = node.end
        stack += [(k, path) for k in kids]
    assert found == held and kinds == {"Leaf", "Few4", "Few16", "Indexed", "Direct"}


def test_rebuilt_conversations(spark):
    rng = random.Random(9)
    rows = [(c, t if rng.random() < 0.9 else None, rng.choice(["user", "assistant", None, ""]), rng.choice([None, "", "é" * rng.randrange(4), f"x{rng.randrange(5)}"]), 1)
            for c in [*range(60), *range(-12, 0), 1000, 1003] if c not in (10, 25) for t in range(rng.randint(1, 12))]
    rows += [(None, 1, "user", "n", 1), rows[0], *[(c, 0, "user", "only", 1) for c in range(3001, 3005)]]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, key int")
    by = {}
    for c, t, role, text, _ in rows:
        role, text = role or "", text or ""
        by.setdefault(c, []).append((t is not None, t or 0, role, hashlib.sha256(text.encode()).hexdigest(), text))
    own = {c: [(r, x) for _, _, r, _, x in sorted(v)] for c, v in by.items()}

    def base(c):
        return c if c is None else c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))

    want = []
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9 if c is not None else 0
        new = own.get(base(c), [])[:h] + turns[h:]
        want.append((c, [((r, x), len(x.encode())) for r, x in new]))
    got = pt.prefix_trie(pt.rebuilt_keys(pt.conversation_keys(df))).select(*pt.RESULT)
    assert sorted(map(tuple, got.collect()), key=str) == plain_nodes(want)
    assert any(not t for _, t in want)


def test_odd_rows_match_sql(spark, tmp_path):
    rows = [(1, None, None, None), (1, 0, "user", ""), (6, 2, "user", "a"), (6, 2, "user", "a"), (6, 1, "tool", "é\n"), (None, 3, "user", "a"), (7, 0, "user", "long " * 50_000),
            (5, 0, "user", "q"), (5, 1, "assistant", "r")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    con = connect(str(tmp_path / "none"))
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    _, problems = compare(QUERIES["op13_prefix_trie"](spark, str(tmp_path)), con, ORACLES["op13_prefix_trie"])
    assert not problems
