"""Personal data, also when disguised, with spans of the original text."""

from __future__ import annotations

import bisect
import hashlib
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import map_slices

KINDS = ("email", "ip", "card", "phone")

# Letters of other scripts that look like Latin ones, and characters that do not show.
_LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S",
    "α": "a", "ο": "o", "ν": "v", "ρ": "p", "ι": "i", "κ": "k", "υ": "u", "Α": "A", "Β": "B", "Ε": "E", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M",
    "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Χ": "X", "Ζ": "Z", "ı": "i", "ɡ": "g", "ɑ": "a", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-",
    "。": ".", "․": ".", " ": " ", " ": " ", " ": " ",
}
_HIDDEN = "​‌‍⁠﻿­"
_DIGIT_WORDS = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}
_AT_WORDS, _DOT_WORDS = ("at", "arroba", "arobase"), ("dot", "punto", "punkt", "point")
# Last labels after which a plain "at" is read as an address, and words before "at" that are no mailbox.
_TOP_LABELS = frozenset("com org net edu gov int mil info biz io co dev app ai eu uk de fr es it nl be ch se no fi dk pl pt br mx us ca au in jp cn ru example test".split())
_NO_MAILBOX = frozenset("""a also am an and are available back be been but by can found go he her here him hosted i is it less live lives located look looked
looking lives me mail more not now off on only online open or out over page pages posted published reach read see seen she site so start still stop than that
the them then there they this those to today up us visit was we were what when where which who will with work works you""".split())
_AT, _DOT = f"(?:{'|'.join(_AT_WORDS)})", f"(?:{'|'.join(_DOT_WORDS)})"

_LETTERS = "".join(_LOOKALIKES) + _HIDDEN
#: Also compatibility forms: letters in circles, full width, bold and so on.
_STRANGE = re.compile(f"[{re.escape(_LETTERS)}ª²³¹º⁰-₟℀-⅏①-⓿！-～﹐-﹫\U0001d400-\U0001d7ff]")
_WORD = "|".join(_DIGIT_WORDS)
_SPELLED = re.compile(rf"(?<![^\W_])(?:plus[\s-]+)?(?:{_WORD})(?:[\s,-]+(?:{_DOT}[\s,-]+)?(?:{_WORD}))+(?![^\W_])", re.I)
_SPELLED_ONE = re.compile(rf"(?<![^\W_])(?:plus|{_DOT}|{_WORD})(?![^\W_])", re.I)
#: A single digit word where numerals stand on both sides, or a dot word and then a numeral.
_SPELLED_ALONE = re.compile(rf"[0-9](?:[ .-]| {_DOT} )({_WORD})(?=[ .-][0-9]| {_DOT} [0-9])", re.I)
_IN_DIGITS = re.compile(r"(?<=[0-9])[OolI|](?=[0-9]|\.[0-9])|(?<=[0-9][ .-])[OolI|](?=[0-9])")
_BRACKETED = re.compile(rf"[\[({{<]\s*(?:({_AT}|@)|({_DOT}|\.))\s*[\])}}>]", re.I)
_PART = r"[A-Za-z0-9][A-Za-z0-9-]*"
_TOKEN = re.compile(r"\S+")
_DOMAIN_PIECE = re.compile(rf"({_PART}(?:\.{_PART})*+)([^\w\s@]*)")
_OPEN_DOMAIN = re.compile(rf"@{_PART}(?:\.{_PART})*\Z")
_NUMBERS = r"[0-9]{1,3}(?:\.[0-9]{1,3}){0,2}"
_NUMBERS_LEFT, _NUMBERS_RIGHT = re.compile(rf"(?<![0-9.])({_NUMBERS})\Z"), re.compile(rf"({_NUMBERS})(?![0-9])([^\w\s]*)")
_HINT = re.compile(rf"\b{_DOT}\b|[\[({{<]\s*(?:{_AT}|@|\.)\s*[\])}}>]|(?<!\S)@(?!\S)|(?<!\S){_AT}\s+{_PART}\.[A-Za-z0-9]", re.I)

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the plain identifiers, by kind and start; time in proportion to the text.

    Equal to leftmost non-overlapping matching with the plain patterns: a local part reaches back from its "@" as far
    as its characters go, and runs of digits are only tried at their beginning.
    """
    out, done = [], 0
    if "@" in text:
        for m in _DOMAIN.finditer(text):
            start = m.start()
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                out.append(("email", start, m.end()))
                done = m.end()
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
                out.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = m.group().replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    out.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                    out.append(("phone", *m.span()))
    return out


class Mapped:
    """A text under rewriting; every character knows the span of the source it came from."""

    def __init__(self, text: str):
        self.text, self.starts, self.ends = text, list(range(len(text))), list(range(1, len(text) + 1))

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replaces spans (start, end, new text), given in order without overlap."""
        text, starts, ends, at = [], [], [], 0
        for a, b, new in edits:
            text += [self.text[at:a], new]
            starts += self.starts[at:a] + [self.starts[a]] * len(new)
            ends += self.ends[at:a] + [self.ends[b - 1]] * len(new)
            at = b
        self.text = "".join([*text, self.text[at:]])
        self.starts, self.ends = starts + self.starts[at:], ends + self.ends[at:]


def _homoglyphs(m: Mapped) -> None:
    edits = []
    for found in _STRANGE.finditer(m.text):
        c = found.group()
        new = "" if c in _HIDDEN else _LOOKALIKES.get(c) or unicodedata.normalize("NFKC", c)
        if new != c and new.isascii():
            edits.append((*found.span(), new))
    if edits:
        m.rewrite(edits)


def _digits(m: Mapped) -> None:
    edits = []
    for run in _SPELLED.finditer(m.text):
        at = run.start()
        for word in _SPELLED_ONE.finditer(m.text, run.start(), run.end()):
            edits.append((at, word.end(), "+" if word.group().lower() == "plus" else _DIGIT_WORDS.get(word.group().lower(), ".")))
            at = word.end()
    if edits:
        m.rewrite(edits)
    edits = [(*f.span(1), _DIGIT_WORDS[f.group(1).lower()]) for f in _SPELLED_ALONE.finditer(m.text)]
    if edits:
        m.rewrite(edits)
    edits = [(*f.span(), "0" if f.group() in "Oo" else "1") for f in _IN_DIGITS.finditer(m.text)]
    if edits:
        m.rewrite(edits)


def _brackets(m: Mapped) -> None:
    edits, done = [], 0
    for f in _BRACKETED.finditer(m.text):
        start, end = f.span()
        while start > done and m.text[start - 1].isspace():
            start -= 1
        while end < len(m.text) and m.text[end].isspace():
            end += 1
        edits.append((start, end, "@" if f.group(1) else "."))
        done = end
    if edits:
        m.rewrite(edits)


def _bare_words(m: Mapped) -> None:
    """Writes out "at" and "dot" that stand as words of their own: one pass over the tokens from left to right.

    An address is a chain of local parts, "at", and a chain of domain parts with a dot, written or plain; without any
    written dot its last label must be well known and its local part no common word. Each chain ends before the last address.
    """
    text = m.text
    spans = [t.span() for t in _TOKEN.finditer(text)]
    words = [text[a:b] for a, b in spans]
    kinds = ["" if len(w) > 8 else "@" if w == "@" else "at" if w.lower() in _AT_WORDS else "dot" if w.lower() in _DOT_WORDS else "" for w in words]
    marks, done = {}, -1

    def domain(j: int) -> tuple[int, int, str]:
        """The last token of the domain parts from token ``j`` on, their dots, the last label; -1 if there is none."""
        dots, last, label = 0, -1, ""
        while j < len(words):
            piece = None if kinds[j] else _DOMAIN_PIECE.fullmatch(words[j])
            if piece is None:
                break
            dots += piece.group(1).count(".") + (last >= 0)
            last, label = j, piece.group(1).rpartition(".")[2]
            if piece.group(2) or j + 1 >= len(words) or kinds[j + 1] != "dot":
                break
            j += 2
        return last, dots, label

    def local(k: int) -> tuple[int, str]:
        """The first token of the local parts that end with token ``k``, and the part beside the "at"."""
        first, beside = -1, ""
        while k > done:
            w = words[k]
            at = len(w)
            while at and w[at - 1] in _LOCAL:
                at -= 1
            if kinds[k] or at == len(w):
                break
            first, beside = k, beside or w[at:]
            if at or k - 2 <= done or kinds[k - 1] != "dot":
                break
            k -= 2
        return first, beside

    for i, kind in enumerate(kinds):
        if not kind or i <= done or i == 0:
            continue
        if kind == "dot":
            if _OPEN_DOMAIN.search(words[i - 1]):
                last = domain(i + 1)[0]
                if last >= 0:
                    marks.update((x, ".") for x in range(i, last, 2))
                    done = last
                continue
            left = _NUMBERS_LEFT.search(words[i - 1][-12:]) if i - 1 > done else None
            n, j = left.group(1).count(".") + 1 if left else 9, i
            while n < 4 and j + 1 < len(words) and kinds[j] == "dot" and (right := _NUMBERS_RIGHT.fullmatch(words[j + 1])):
                n, j = n + right.group(1).count(".") + 1, j + 2
                if right.group(2):
                    break
            if n == 4 and j > i:
                marks.update((x, ".") for x in range(i, j, 2))
                done = j - 1
            continue
        last, dots, label = domain(i + 1)
        if last < 0 or not dots:
            continue
        first, beside = local(i - 1)
        written = last > i + 1 or first < i - 1 or kind == "@"
        if first < 0 or not written and (label.lower() not in _TOP_LABELS or beside.lower() in _NO_MAILBOX):
            continue
        marks.update((x, ".") for x in range(first + 1, i, 2))
        marks[i] = "@"
        marks.update((x, ".") for x in range(i + 2, last, 2))
        done = last
    if marks:
        m.rewrite([(spans[i - 1][1], spans[i + 1][0], new) for i, new in sorted(marks.items())])


def hidden_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans that show only after rewriting and lie in no base span of their kind; one may reach over a base span that is a part of it.

    The transducers run in turn: look-alike and hidden characters, spelled digits and letters among digits, bracketed and
    then bare "at" and "dot". Each keeps the source span of every character it writes, and takes time in proportion to the text.
    """
    odd = not text.isascii() and _STRANGE.search(text)
    if not (odd or _HINT.search(text) or _SPELLED.search(text) or _SPELLED_ALONE.search(text) or _IN_DIGITS.search(text)):
        return []
    m = Mapped(text)
    for step in (_homoglyphs, _digits, _brackets, _bare_words):
        step(m)
    if m.text == text:
        return []
    known, out, done = {k: [s[1:] for s in base if s[0] == k] for k in KINDS}, [], dict.fromkeys(KINDS, 0)
    for kind, a, b in base_spans(m.text):
        start, end = m.starts[a], m.ends[b - 1]
        at = bisect.bisect_right(known[kind], start, key=lambda s: s[0]) - 1
        inside = at >= 0 and end <= known[kind][at][1]
        if text[start:end] != m.text[a:b] and not inside and start >= done[kind]:
            out.append((kind, start, end))
            done[kind] = end
    return out


def _written(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1])))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_hidden.

    The counts and the digest are of the identifiers in plain sight; ``spans`` lists these and the disguised ones as
    kind:start:end in code points of the source, end exclusive, by kind and start, and ``n_hidden`` counts the latter.

    Null text counts as empty, with no span. Rows are independent: repeated rows repeat, a null id is passed on, other
    columns are ignored, and an empty table gives no rows. Whole texts are searched in linear time.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))

    def run(piece):
        counts, digests, spans, hidden = {k: [] for k in KINDS}, [], [], []
        for text in piece.column("text").to_pylist():
            base = base_spans(text or "")
            more = hidden_spans(text or "", base)
            for k in KINDS:
                counts[k].append(sum(s[0] == k for s in base))
            digests.append(hashlib.sha256(_written(base).encode()).hexdigest())
            spans.append(_written(base + more))
            hidden.append(len(more))
        return pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), *[pa.array(counts[k], pa.int64()) for k in KINDS], pa.array(digests), pa.array(spans), pa.array(hidden, pa.int64())],
            names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_hidden"])

    return map_slices(rows, "text", run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_hidden long")
