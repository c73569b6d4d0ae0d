"""Byte-level BPE against a plain merge loop, and texts that the library alone cannot take."""

import hashlib
import random
import sys
import unicodedata

import pytest
import regex

import public_tokenizers
from tallyforge.llm import byte_bpe
from tallyforge.llm.queries import QUERIES

RANKS = byte_bpe.read_ranks(byte_bpe.default_ranks())


def plain(text):
    """Each match of the pattern by itself: merge the pair of least rank, leftmost first, until none has a rank."""
    out = []
    for m in regex.findall(public_tokenizers.PATTERN, text):
        parts = [bytes([b]) for b in m.encode()]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: (RANKS.get(parts[i] + parts[i + 1], 1 << 40), i))
            if parts[best] + parts[best + 1] not in RANKS:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        out += [RANKS[p] for p in parts]
    return out


BITS = ["'s", "'ll", "'", "s", "re", " ", "  ", "\n", "\t\n ", " ", " ", "abc", "é", "ß", "中文", "١٢", "12", "Ⅳ", "!?", "--", "😀", "é", "\x1c", "�", "<|endoftext|>"]


@pytest.mark.parametrize("sizes", [(1, 3), (5, 2), (40, 10)])
def test_parts_change_nothing(sizes):
    rng, whole = random.Random(1), byte_bpe.ByteBpe(RANKS)
    cut = byte_bpe.ByteBpe(RANKS, None, *sizes)
    for _ in range(1500):
        text = "".join(rng.choice(BITS) * rng.choice([1, 1, 1, 9]) for _ in range(rng.randint(0, 25)))
        assert "".join(p for p, _ in cut.parts(text)) == text
        got = cut.encode(text).tolist()
        assert got == plain(text) == whole.encode(text).tolist() and cut.decode(cut.encode(text)) == text.encode(), repr(text)


def test_classes_are_the_librarys():
    bpe = byte_bpe.ByteBpe(RANKS, None, 1, 1)
    text = "".join(chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
    seen, n = bpe._seen(text), 0
    for stand, encoding in bpe.classes:
        kind = regex.compile(encoding.name)
        for at in range(0, len(text), 1000):
            theirs = set(encoding.decode(encoding.encode_ordinary(text[at:at + 1000])))
            assert theirs == {c for c, s in zip(text[at:at + 1000], seen[at:at + 1000]) if kind.match(s)}
            n += len(theirs)
    assert n > 100_000
    new = next(c for c in text if unicodedata.category(c) == "Cn" and regex.match(r"\p{L}", c))  # known to the pattern's engine here only
    for t in ("ab" + new * 5 + "cd", new + "12" + new, "'s" + new):
        assert bpe.encode(t).tolist() == bpe.encoding.encode_ordinary(t)


@pytest.mark.parametrize("text", [" " * 1_500_000 + "x", "a" * 300_000, "\n" * 400_000, "x" + "\t " * 300_000, "中" * 200_000, "'" * 300_000 + "s", "1" * 200_000 + " 's" * 50_000])
def test_very_long_runs(text):
    bpe = byte_bpe.ByteBpe(RANKS)
    ids = bpe.encode(text)
    assert bpe.decode(ids) == text.encode()
    if text[0] not in " \n" and "\t" not in text:
        assert ids.tolist() == bpe.encoding.encode_ordinary(text)


def test_operator_rows(spark):
    rows = [(1, None, 7), (2, "", 7), (3, "Hello wörld's 中文 😀\r\n", 7), (3, "Hello wörld's 中文 😀\r\n", 7), (None, "x " * 40_000, 7), (4, "<|endoftext|>", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, bytes int")
    out = byte_bpe.decode(byte_bpe.encode(df)).collect()
    assert sorted(((r.doc_id, list(r.ids), bytes(r.bytes)) for r in out), key=str) == sorted(((d, plain(t or ""), (t or "").encode()) for d, t, _ in rows), key=str)
    assert byte_bpe.token_digests(byte_bpe.decode(byte_bpe.encode(df.limit(0)))).collect() == []
    broken = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF62' AS STRING) AS text")
    assert bytes(byte_bpe.decode(byte_bpe.encode(broken)).first().bytes) == "a�b".encode()
    part = byte_bpe.decode(spark.sql(f"SELECT 1L AS doc_id, array({RANKS[bytes([0xC3])]}) AS ids, 5 AS bytes UNION ALL SELECT 2L, CAST(NULL AS ARRAY<INT>), 5"))
    assert {r.doc_id: r.bytes and bytes(r.bytes) for r in part.collect()} == {1: b"\xc3", 2: None}


def test_query_against_plain_merges(spark):
    data = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_byte_bpe"](spark, data).collect()}
    assert set(got) == set(texts)
    for i, text in texts.items():
        if len(text) > 20_000:
            continue
        ids = plain(text)
        assert got[i] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
