"""Edge rows of every corpus operator, and brute-force versions where SQL has none."""

import math
import random
import re

import numpy as np
import pytest

from tallyforge.llm import chat, exact, jaccard, language, lines, mixing, near_vectors, pieces, pii, quality
from tallyforge.llm.graph import components
from tests.llm.brute import jaccard_components, repeated_runs

DOC = "doc_id long, text string, lang string, source string, kept int, row string, h long, score string"
LONG = " ".join(f"word{i}" for i in range(30_000))


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids, texts and labels, an empty, a white and a very long text, repeated rows, names that operators use."""
    rows = [(1, None, "en", "a"), (2, "", "en", None), (3, " \t\n", None, "b"), (4, LONG, "en", "b"), (5, "one text here", "de", "a"),
            (5, "one text here", "de", "a"), (None, "one text here", None, "a"), (None, None, None, None), (6, LONG.upper(), "en", "c"), (7, "ÄÖ 😀 ▁ x\r\n\r\n", "de", "c")]
    return spark.createDataFrame([(*r, 1, "r", 2, "s") for r in rows], DOC)


def by_id(df, *cols):
    return {r[0]: tuple(r)[1:] if len(cols) > 2 else r[1] for r in df.select(*cols).collect() if r[0] is not None}


ALL = {
    "exact": exact.exact_groups, "mix": mixing.poisson_mix, "pii": pii.find_pii, "jaccard": jaccard.jaccard_groups, "lines": lines.drop_repeated_runs,
    "encode": pieces.encode, "decode": lambda d: pieces.decode(pieces.encode(d)), "quality": lambda d: quality.score_quality(d, quality.ByteConv()),
    "no quality": lambda d: quality.score_quality(d, None), "keep": lambda d: quality.keep_quality(d, quality.ByteConv()),
    "language": lambda d: language.identify(d, language.fit_languages(d)),
}


@pytest.mark.parametrize("name", sorted(ALL))
def test_odd_rows_and_no_rows(odd, name):
    n = len(ALL[name](odd).collect())
    assert n == 10 if name not in ("mix", "keep") else n >= 0
    assert ALL[name](odd.limit(0)).collect() == []


def test_exact_groups(odd):
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact.exact_groups(odd).collect()}
    assert got == {(3, 3, 4, True), (1, 3, 4, False), (2, 3, 4, False), (None, 3, 4, False), (4, 4, 1, True), (6, 6, 1, True), (7, 7, 1, True),
                   (5, 5, 3, True), (5, 5, 3, False), (None, 5, 3, False)}
    assert sum(r.kept for r in exact.exact_groups(odd).collect()) == 5


def test_exact_hot_group_over_slices(spark):
    rows = [(i, "a b c" + " " * (i % 7)) for i in range(500)] + [(i, f"t{i}") for i in range(500, 600)]
    got = exact.exact_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    hot = [r for r in got if r.group_size > 1]
    assert len(hot) == 500 and {r.keep_id for r in hot} == {6} and sum(r.kept for r in hot) == 1 and sum(r.kept for r in got) == 101


def test_mix_meets_weights_and_large_means(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "'0123456789' AS text", "CASE WHEN id < 40 THEN 'rare' WHEN id < 2000 THEN 'half' END AS source", "'old' AS copy")
    out = mixing.poisson_mix(docs, {"rare": 1.0, "half": 1.0}, rest=2.0)
    assert out.columns == ["doc_id", "text", "source", "copy", "shuffle_key"]
    n = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    assert all(abs(n[s] - want) < 5 * math.sqrt(want) for s, want in (("rare", 1000), ("half", 1000), (None, 2000)))
    per = [r["count"] for r in out.where("source = 'rare'").groupBy("doc_id").count().collect()]
    assert len(per) == 40 and 10 < np.var(per) < 60  # a mean of 25, over one draw's limit
    again = mixing.poisson_mix(docs.repartition(5), {"rare": 1.0, "half": 1.0}, rest=2.0)
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, again.collect()), key=str)
    assert "half" not in {r.source for r in mixing.poisson_mix(docs, {"half": 0.0}, rest=1.0).select("source").collect()}
    with pytest.raises(ValueError):
        mixing.poisson_mix(docs, {"a": -1.0})


def test_near_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    rows, base = [], rng.normal(size=(12, 16))
    for i in range(240):
        v = base[i % 12] + rng.normal(size=16) * (0.02 if i % 3 else 0.22)
        rows.append((i, [float(x) for x in np.float32(v)], i % 12 % 2))
    rows += [(900, rows[0][1], 0), (901, None, 0), (902, [0.0] * 16, 0), (903, [float("nan")] * 16, 0), (904, rows[0][1], None), (905, [1.0, None], 0),
             (906, [], 1), (907, [2.0 * x for x in rows[0][1]], 0), (908, rows[0][1][:8], 0), (None, rows[0][1], 0)]
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], "vec_id long, embedding array<float>, label int, c int, bucket string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors.near_vectors(df).collect()}
    ok = [(i, np.array(v), lab) for i, v, lab in rows if i is not None and v and lab is not None and len(v) == 16 and np.isfinite(v).all() and any(v)]
    linked = {i: [j for j, w, m in ok if j != i and m == lab and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.93] for i, v, lab in ok}
    low = {i: i for i in linked}
    for _ in range(20):
        low = {i: min([low[i], *[low[j] for j in linked[i]]]) for i in linked}
    assert any(0 < len(x) < 15 for x in linked.values())
    for i in (r[0] for r in rows):
        assert got[i] == ((len(linked[i]), low[i], low[i] == i) if i in linked else (0, i, i is not None)), i
    assert near_vectors.near_vectors(df.limit(0)).collect() == []


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, None)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")) or kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            out.append((kind, *m.span()))
    return out


def test_pii_base_equals_plain_patterns():
    rng = random.Random(5)
    for alphabet in ("a1@.+- 4)(", "12345678 -", "0123456789.", "ab@.- é\n"):
        for _ in range(4000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30)))
            assert pii.base_spans(text) == plain_spans(text), text


@pytest.mark.parametrize("text, kind, part", [
    ("mail john.doe at example dot com now", "email", "john.doe at example dot com"), ("x (at) mail [dot] org!", "email", "x (at) mail [dot] org"),
    ("to jоhn@exаmple.com ok", "email", "jоhn@exаmple.com"), ("call plus one two one two five five five zero one!", "phone", "plus one two one two five five five zero one"),
    ("at one nine two dot one six eight dot zero dot one", "ip", "one nine two dot one six eight dot zero dot one"),
    ("write john at example.com today", "email", "john at example.com"), ("to john @ example.com.", "email", "john @ example.com"),
    ("(john at mail.example dot com)", "email", "john at mail.example dot com"), ("tel +1 555 one 23 45 67", "phone", "+1 555 one 23 45 67"),
    ("ip 192.168.one.1 ok", "ip", "192.168.one.1"), ("ip 192 dot 168 dot one dot 1, ok", "ip", "192 dot 168 dot one dot 1"), ("jоhn@example.com", "email", "jоhn@example.com"),
    ("a.b [at] c-d [dot] e [dot] org", "email", "a.b [at] c-d [dot] e [dot] org"), ("x@mail dot org", "email", "x@mail dot org"),
    ("no ４１１１ １１１１ １１１１ １１１１", "card", "４１１１ １１１１ １１１１ １１１１"), ("4111 1111 l111 1111", "card", "4111 1111 l111 1111"), ("go 1O.0.0.1", "ip", "1O.0.0.1"),
])
def test_pii_disguises(text, kind, part):
    assert [(k, text[a:b]) for k, a, b in pii.hidden_spans(text, pii.base_spans(text))] == [(kind, part)]


def test_pii_leaves_prose_alone(spark):
    for text in ("Look at the dot. One, two, three.", "We met at home at one", "a@b.co is at c.co", "é at ñ dot", "v1.2.3 at 10", "Read it at example.com.",
                 "version 1 dot 2", "the point at which a dot ends", "at dot at dot", "dot com at", "@ dot @", "see @ home", "10 dot 20 dot 30"):
        assert pii.hidden_spans(text, pii.base_spans(text)) == []
    df = spark.createDataFrame([(1, "😀 a@b.co x (at) y (dot) org"), (2, None)], "doc_id long, text string")
    got = by_id(pii.find_pii(df), "doc_id", "spans", "n_email", "n_hidden")
    assert got == {1: ("email:2:8,email:9:27", 1, 1), 2: ("", 0, 0)}


def disguised(rng, plain):
    """One way to hide an address, a number or the like, of which all parts stay in order."""
    swap = {"a": "а", "e": "е", "o": "о", "p": "р", "c": "с"}
    name = {v: k for k, v in pii._DIGIT_WORDS.items() if k != "oh"}
    if "@" in plain:
        local, _, domain = plain.partition("@")
        at, dot = rng.choice([(" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" {at} ", "{dot}"), (" AT ", " DOT ")])
        return rng.choice([local.replace(".", dot) + at + domain.replace(".", dot), local + at + domain.replace(".", dot), "".join(swap.get(c, c) for c in plain),
                           local + at + domain, local + "@" + domain.replace(".", " dot ")])
    return rng.choice(["".join(chr(ord(c) + 0xFEE0) if c.isdigit() else c for c in plain), " ".join({"+": "plus", ".": "dot"}.get(c) or name.get(c, "") for c in plain if c not in " -").strip()])


def test_pii_finds_what_was_hidden():
    rng = random.Random(11)
    for _ in range(600):
        part = lambda n: "".join(rng.choice("acepoxyz") for _ in range(n))
        kind, plain = rng.choice([("email", f"{part(4)}.{part(3)}@{part(5)}.com"), ("email", f"{part(6)}@{part(3)}.{part(4)}.org"),
                                  ("ip", ".".join(str(rng.randrange(10, 256)) for _ in range(4))), ("phone", f"+{rng.randrange(10**10, 10**11)}")])
        hidden = disguised(rng, plain)
        text = f"words before: {hidden} , and words after"
        spans = {(k, text[a:b]) for k, a, b in pii.hidden_spans(text, pii.base_spans(text))}
        assert (kind, hidden) in spans or hidden == plain, (text, spans)


@pytest.mark.parametrize("text", ["x dot y " + "a dot " * 170_000, " " * 1_000_000 + "[dot] com", "a" + " " * 1_000_000 + "dot b", "john at mail dot com, " * 48_000, "[ " * 500_000 + "at ]",
                                  "one " * 250_000, "at " * 330_000, "1 dot " * 170_000, "a.b-c" * 200_000 + " at x dot org", "a at " + "b." * 400_000 + " dot @", "jоhn@example.com " * 60_000])
def test_pii_takes_time_in_proportion(text):
    import time

    def took(t):
        start = time.process_time()
        pii.hidden_spans(t, pii.base_spans(t))
        return time.process_time() - start

    assert took(text) < 20  # a megabyte takes seconds


def test_chat_round_trip_windows_and_rewriting(spark):
    rng = random.Random(1)
    bits = ["</s>", "[INST] ", "\\", "<<SYS>>\n", " [/INST]", "a", "\n", "", "\\<", ">>\n", "é"]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool>>\n", "", None]), rng.choice([None, "".join(rng.choice(bits) for _ in range(5))]), 0)
            for c in range(30) for t in range(rng.randint(1, 9))] + [(99, t, "user" if t % 2 == 0 else "assistant", f"t{t}", 0) for t in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, position int")
    out = sorted(chat.format_turns(df, window=8).collect(), key=lambda r: (r.conv_id, r.position))
    for conv in {r[0] for r in rows}:
        mine = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])]
        got = [r for r in out if r.conv_id == conv]
        text = "".join(r.piece for r in got)
        assert text == chat.inst_template(mine) and [chat.read_turn(r.piece) for r in got] == mine
        assert all(text[r.begin:r.end] == r.piece and chat.unescape(text[r.text_begin:r.text_end]) == m[1] and not r.rewrites for r, m in zip(got, mine))

    def forgetful(messages):  # writes the number of turns first
        return f"{len(messages)}|" + "".join(m[1] for m in messages)

    r = chat.Renderer(forgetful)
    assert [r.add(("user", t))["rewrites"] for t in ("a", "b")] == [True, True]

    def late(messages):  # strips all but the last two turns
        return "".join(m[1] if i >= len(messages) - 2 else "-" for i, m in enumerate(messages))

    r = chat.Renderer(late)
    assert [r.add(("user", t))["rewrites"] for t in ("aa", "bb", "cc")] == [False, False, True]
    assert chat.format_turns(df.limit(0)).collect() == [] and chat.conversation_digests(chat.format_turns(df.limit(0))).collect() == []


def numbered(messages):  # absolute turn numbers, and the system message again before each user turn
    first = next((t for r, t in messages if r == "system"), "")
    return "".join(f"{i}:{first if r == 'user' else ''}{t};" for i, (r, t) in enumerate(messages))


def stripped(messages):  # drops the text of the first turn after 80 turns
    return "".join("-" if len(messages) > 80 and i == 0 else t for i, (_, t) in enumerate(messages))


def test_chat_shows_whole_prefixes(spark):
    rows = [(1, t, "system" if t == 0 else "user" if t % 2 else "assistant", f"t{t}") for t in range(150)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = sorted(chat.format_turns(df, numbered).collect(), key=lambda r: r.position)
    text = "".join(r.piece for r in out)
    assert text == numbered([r[2:] for r in rows]) and not any(r.rewrites for r in out)
    assert all(text[r.text_begin:r.text_end] == m[3] for r, m in zip(out, rows))
    r = chat.Renderer(stripped)
    assert [t for t in range(150) if r.add(("user", f"t{t}"))["rewrites"]] == [80]


def test_jaccard_against_all_pairs(spark):
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(300)]
    docs, origin = [], [[rng.choice(vocab) for _ in range(rng.randint(5, 90))] for _ in range(12)]
    for i in range(260):  # near copies with few and with many edits, so that links are chains
        words = list(origin[i % 12] if i % 5 else origin[0])
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            at = rng.randrange(len(words))
            words[at:at + rng.randint(0, 1)] = [rng.choice(vocab)]
        docs.append((i, " ".join(words).upper() if i % 7 == 0 else "\n".join(words)))
    docs += [(500, None), (501, ""), (502, "a b"), (503, "A  b"), (504, "a b c d e"), (505, "b a")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for percent in (80, 60):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_groups(df.repartition(5), percent=percent).collect()}
        assert got == jaccard_components(docs, percent=percent)


def test_jaccard_links_against_all_pairs(spark):
    rng = random.Random(9)
    base = [[f"v{rng.randrange(400)}" for _ in range(60)] for _ in range(4)]
    docs = []
    for i in range(90):
        words = list(base[i % 4])
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            words[rng.choice([0, 1, -1, -2, rng.randrange(60)])] = f"v{rng.randrange(400)}"
        docs.append((i, " ".join(words)))
    docs += [(500, None), (501, ""), (502, "a b"), (503, "A  b"), (502, "a b")]
    sets = []
    for _, t in docs:
        w = (t or "").lower().split()
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for percent in (80, 60):
        def link(a, b):
            return len(a & b) > 0 and 100 * len(a & b) >= percent * len(a | b)

        links, membership = jaccard.jaccard_links(df.repartition(5), percent=percent)
        rows = membership.collect()
        want = sorted((d, len(s), sum(link(s, o) for o in sets) - (len(s) > 0)) for (d, _), s in zip(docs, sets))
        assert sorted((r.doc_id, r.n_shingles, r.n_links) for r in rows) == want
        key = {r.doc_id: r.set_key for r in rows}
        named = {key[d]: s for (d, _), s in zip(docs, sets) if s}
        got = sorted(map(tuple, links.collect()))
        assert got == sorted((a, b, len(named[a]), len(named[b]), len(named[a] & named[b])) for a in named for b in named if a < b and link(named[a], named[b]))
        assert len(got) > len(named)  # links besides a tree of them
    assert [x.collect() for x in jaccard.jaccard_links(df.limit(0))] == [[], []]


def test_lines_against_plain_version(spark):
    rng = random.Random(6)
    pool = [" ".join(rng.choice("abcdefg") for _ in range(rng.randint(0, 6))) for _ in range(12)]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 25)))) for i in range(80)]
    docs += [(100, "x y z\n" * 30), (101, docs[3][1]), (102, "one long line of eight words is here")]
    docs += [(103, "new\n" + docs[-1][1])]
    got = {r.doc_id: (r.text, r.n_deleted) for r in lines.drop_repeated_runs(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), 8)
           .select("row.doc_id", "text", "n_deleted").collect()}
    assert got == repeated_runs(docs, 8)
    assert got[103] == ("new", 1)


def runs_by_pairs(docs, min_words):
    """doc_id -> lines deleted, from the definition: every line against every earlier equal line, extended to both sides."""
    flat = [(d, i, x) for d, t in sorted(docs) for i, x in enumerate(t.split("\n"))]
    gone = {d: set() for d, _ in docs}
    for p in range(len(flat)):
        for q in range(p):
            if flat[p][2] != flat[q][2] or (flat[p][1] and flat[q][1] and flat[p - 1][2] == flat[q - 1][2]):
                continue
            n = 1
            while p + n < len(flat) and flat[p + n][1] and flat[q + n][1] and flat[p + n][2] == flat[q + n][2]:
                n += 1
            if sum(len(x[2].split()) for x in flat[p:p + n]) >= min_words:
                gone[flat[p][0]].update(x[1] for x in flat[p:p + n])
    return gone


def test_lines_whole_runs_against_all_pairs(spark):
    rng = random.Random(8)
    pool = [" ".join(rng.choice("abcdefg") for _ in range(rng.choice([0, 0, 1, 2, 3, 6, 9]))) for _ in range(12)]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 25)))) for i in range(60)]
    end = "\n".join(["w " * 60, "v " * 10])
    docs += [(100, end), (101, end), (102, "\n\n" + docs[3][1] + "\n\n"), (103, "\n\n" + docs[3][1] + "\n\n"), (104, "x y z\n" * 30)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    for words in (8, 50):
        gone = runs_by_pairs(docs, words)
        want = {d: ("\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d]), len(gone[d])) for d, t in docs}
        got = lines.drop_repeated_runs(df, words).select("row.doc_id", "text", "n_deleted").collect()
        assert {r.doc_id: (r.text, r.n_deleted) for r in got} == want
        assert want[101] == ("", 2) and want == repeated_runs(docs, words)


def test_lines_windows_select_single_lines():
    text = "\n".join(f"line {i} of six words {i}" for i in range(40)).encode()
    found = lines.run_windows(text, 50)
    assert len({(w[2], w[3]) for w in found}) == len({w[3] for w in found}) < len(found)  # a fingerprint has one place
    many = lines.run_windows(b"\n" * 20_000 + text, 50)
    assert len(many) == len(found) + 20_000 and {w[1] for w in many if w[0] < 20_000} == {20_000 + found[0][1]}


def test_lines_extensions_are_few_and_cover_every_run():
    """Windows and extensions inside a run cover it, whatever the run; there are at most two spans a line."""
    rng = random.Random(3)
    for _ in range(300):
        words = [rng.choice([0, 0, 1, 2, 3, 9, 20]) for _ in range(rng.randint(1, 30))]
        spans = [w[:2] for w in lines.run_windows("\n".join("x " * n for n in words).encode(), 10)]
        assert len(set(spans)) == len(spans) <= 2 * len(words) and all(sum(words[a:b + 1]) >= 10 for a, b in spans)
        for i in range(len(words)):
            for j in range(i, len(words)):
                if sum(words[i:j + 1]) >= 10:
                    assert {x for a, b in spans if i <= a and b <= j for x in range(a, b + 1)} == set(range(i, j + 1))


def segmentations(table, part):
    out = []

    def go(at, score, ids):
        if at == len(part):
            out.append((score, tuple(ids)))
        for end in range(at + 1, min(len(part), at + table.longest) + 1):
            i = table.normal.get(part[at:end])
            if i is not None:
                go(end, score + table.scores[i], ids + [i])
            elif end == at + 1:
                go(end, score + table.penalty, ids + list(table._bytes(part[at])))

    go(0, 0.0, [])
    return sorted(out, key=lambda s: -s[0])


def test_pieces_n_best_against_all_segmentations():
    table, rng = pieces.PieceTable(pieces.default_model()), random.Random(2)
    for _ in range(120):
        text = "".join(rng.choice("the ing aoné") for _ in range(rng.randint(1, 9)))
        every = segmentations(table, (" " + text).replace(" ", "▁"))
        ids, score, more = pieces.Encoder(table, 4).encode([text])[0]
        assert [score] + [m[0] for m in more] == [s[0] for s in every[:4]]
        paths = [tuple(ids)] + [tuple(pieces.with_edits(ids, e)) for _, e in more]
        assert len(set(paths)) == len(paths) and all(dict((b, a) for a, b in every)[p] == s for p, s in zip(paths, [score] + [m[0] for m in more]))
        assert table.n_best((" " + text).split(" ")[-1] or "x", 1)


def test_pieces_long_parts_in_linear_memory(monkeypatch):
    import base64
    import tracemalloc

    table, rng = pieces.PieceTable(pieces.default_model()), random.Random(7)
    for part in ["".join(rng.choice("theingaoné") for _ in range(rng.randint(1, 60))) for _ in range(80)] + ["word" * 20, "a" * 60]:
        rows = table._n_best_rows(part, 4)
        with monkeypatch.context() as m:
            m.setattr(pieces, "_LONG", 1000)
            assert rows == table.n_best(part, 4)
    encoder = pieces.Encoder(table, 3)
    text = base64.b64encode(rng.randbytes(4500)).decode()
    tracemalloc.start()
    ids, score, more = encoder.encode([text])[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20 and table.decode(ids) == text
    assert len(more) == 2 and score >= more[0][0] >= more[1][0]
    assert all(table.decode(pieces.with_edits(list(ids), e)) == text for _, e in more)


def test_pieces_round_trip(spark, odd):
    texts = ["", " ", "  x ", "a▁b  c\n\td", "😀 日本語\r\n", "\x00z", "word" * 500, LONG, None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert by_id(pieces.decode(pieces.encode(df)), "doc_id", "text") == dict(enumerate(texts))


def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = quality.quality_scores(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    both = got.where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality"), "doc_id").collect()
    assert sum(r.predicted == r.quality for r in both) >= 0.9 * len(both)
    assert sum(r.predicted == 1 for r in both if r.quality == 1) >= 0.97 * sum(r.quality == 1 for r in both)


def test_quality_covers_the_whole_text():
    model = quality.ByteConv(1)
    model.p["out"] += 0.1
    data = np.frombuffer(("a" * 40_003).encode(), np.uint8)
    high, _ = model.chunks(data)
    marked = data.copy()
    marked[-1] = 200
    assert len(high) == -(-model._windows(len(data)) // quality.CHUNK) and model.score(marked) != model.score(data)
    assert 0 <= model.score(data[:0]) <= 1


def test_language_held_out_and_mixed(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.languages(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.98 * len(got)
    model = language.fit_languages(docs)
    pick = {r.lang: r.text[:400] for r in docs.where("length(text) > 600 AND lang IN ('de', 'fr')").orderBy("doc_id").collect()}
    both = pick["de"] + "\n" + pick["fr"]
    r = language.identify(spark.createDataFrame([(1, both), (2, "123 !"), (3, None)], "doc_id long, text string"), model).orderBy("doc_id").collect()
    inside = {x: sum(s.end - s.start for s in r[0].spans if s.lang == x) for x in ("de", "fr")}
    assert min(inside.values()) > 300 and 0.4 < r[0].score < 0.7
    assert [(x.lang_pred, x.score, x.spans) for x in r[1:]] == [("und", 0.0, [])] * 2


def test_language_viterbi_against_all_sequences():
    import itertools

    rng = np.random.default_rng(0)
    model = language.LanguageModel(["a", "b", "c"], rng.integers(0, 9, (3, language.BUCKETS)).astype(float), np.tile(np.eye(1, language.N_SCRIPTS, 1), (3, 1)))
    texts = ["ab cde f ghij k lm", "", "x", "No pq rs", "tuv w"]
    words = language.Words(texts)
    labels = model.label(words)
    scores = np.add.reduceat(model.logs[words.triples], words.heads, axis=0)
    for i in range(len(texts)):
        a, b = words.of_text[i], words.of_text[i + 1]

        def total(seq):
            return sum(scores[a + k, x] for k, x in enumerate(seq)) - language.SWITCH * sum(x != y for x, y in zip(seq, seq[1:]))

        if b > a:
            assert math.isclose(total(labels[a:b]), max(map(total, itertools.product(range(3), repeat=int(b - a)))), rel_tol=1e-6)


def plain_score(model, data):
    """The network in loops, from its description: windows, filters, chunks, pooling, one logistic output."""
    p, n = {k: v.astype(float) for k, v in model.p.items()}, len(data)
    windows = [data[a:a + quality.WINDOW] + b"\0" * (quality.WINDOW - len(data[a:a + quality.WINDOW]))
               for a in range(0, max(n - quality.WINDOW, 0) + (-max(n - quality.WINDOW, 0) % quality.STRIDE) + 1, quality.STRIDE)]
    tops, means = [], []
    for c in range(0, len(windows), quality.CHUNK):
        responses = []
        for w in windows[c:c + quality.CHUNK]:
            numbers = [x for byte in w for x in p["emb"][byte]]
            responses.append([max(0.0, sum(a * b for a, b in zip(numbers, p["filters"][:, f])) + p["bias"][f]) for f in range(quality.FILTERS)])
        tops.append([max(r[f] for r in responses) for f in range(quality.FILTERS)])
        means.append([sum(r[f] for r in responses) / len(responses) for f in range(quality.FILTERS)])
    features = [pool([t[f] for t in part]) for part in (tops, means) for pool in (lambda x: sum(x) / len(x), max) for f in range(quality.FILTERS)]
    return 1 / (1 + math.exp(-sum(a * b for a, b in zip(features, p["out"])) - p["out_bias"][0]))


def test_quality_score_equals_plain_loops():
    rng = np.random.default_rng(5)
    model = quality.ByteConv(2)
    model.p["out"] = rng.normal(0, 0.3, 4 * quality.FILTERS).astype(np.float32)
    model.p["bias"] = rng.normal(0, 0.2, quality.FILTERS).astype(np.float32)
    for n in (0, 1, 15, 16, 17, 20, 21, 500, 1036, 1037, 2500):
        data = rng.integers(0, 256, n, dtype=np.uint8)
        assert model.score(data) == pytest.approx(plain_score(model, data.tobytes()), abs=2e-4), n


def test_quality_gradient_equals_differences():
    rng = np.random.default_rng(6)
    model = quality.ByteConv(3)
    model.p = {k: v.astype(float) for k, v in model.p.items()}
    model.p["out"] = rng.normal(0, 0.5, 4 * quality.FILTERS)
    raw = rng.integers(97, 123, 700, dtype=np.uint8)
    for label in (0.0, 1.0):
        grads = {k: np.zeros_like(v) for k, v in model.p.items()}
        model._gradient([raw.tobytes()], label, grads)

        def loss():
            s = model.score(raw)
            return -math.log(s if label else 1 - s)

        for name, at in (("out", 3), ("out", 40), ("out_bias", 0), ("bias", 2), ("filters", (5, 2)), ("filters", (33, 9)), ("emb", (100, 1)), ("emb", (110, 3))):
            here, eps = model.p[name][at], 1e-5
            model.p[name][at] = here + eps
            up = loss()
            model.p[name][at] = here - eps
            down = loss()
            model.p[name][at] = here
            assert grads[name][at] == pytest.approx((up - down) / (2 * eps), rel=0.02, abs=1e-6), (name, at)


def test_training_samples_are_bounded(spark, monkeypatch):
    docs = spark.range(400).selectExpr("id % 40 AS doc_id", "concat('text ', id % 40) AS text", "CASE WHEN id % 3 = 0 THEN 'a' ELSE 'b' END AS lang").unionByName(
        spark.range(50).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "concat('none ', id) AS text", "'a' AS lang"))
    labels = spark.range(400).selectExpr("id % 40 AS doc_id", "CAST(id % 2 AS INT) AS quality")
    held = []
    monkeypatch.setattr(quality.ByteConv, "fit", lambda self, texts, marks, seed=0: held.append((texts, marks)) or self)
    assert quality.fit_quality(docs, labels, docs_per_class=7) is not None
    texts, marks = held[0]
    assert len(texts) == 14 and sorted(marks.tolist()) == [0] * 7 + [1] * 7 and len({t[0] for t in texts}) == 14
    seen = []
    real = language.Words
    monkeypatch.setattr(language, "Words", lambda texts: seen.extend(texts) or real(texts))
    got = language.least_hashed(docs.selectExpr("lang", "xxhash64(doc_id) AS h"), "lang", "h", 5, 1).collect()
    assert len(got) == 5 and len({r.lang for r in got}) == 1
    everything = sorted(r.h for r in docs.where("lang = 'b'").selectExpr("xxhash64(doc_id) AS h").distinct().collect())
    assert sorted(r.h for r in got) == everything[:5]
    assert language.fit_languages(docs, 5) is not None
