"""SentencePiece encoding and decoding with the N best segmentations."""

from __future__ import annotations

import heapq
import re
import uuid
from array import array
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import map_slices

_SPACE = "▁"
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
#: Segmentations of chunks that a worker remembers, and their characters; longer chunks than this many characters are segmented alone.
_MEMORY, _CHARS, _LONG, _ROWS = 150_000, 6_000_000, 40, 8192
_SLOT_BITS = 19


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceTable:
    """The pieces of a model file with their scores, and the lattice search over them."""

    def __init__(self, path: str):
        import sentencepiece

        self.made = uuid.uuid4().hex
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.scores = [float(model.get_score(i)) for i in range(len(self.pieces))]
        special = {i for i in range(len(self.pieces)) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)}
        self.normal = {p: i for i, p in enumerate(self.pieces) if i not in special}
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(len(self.pieces)) if model.is_byte(i)}
        if len(self.bytes) != 256:
            raise ValueError("the model has no byte pieces, so not every text could be written")
        self.penalty = min(self.scores) - 10.0
        self.longest = max(map(len, self.normal))
        self.raw = [p.replace(_SPACE, " ").encode() for p in self.pieces]
        for value, i in self.bytes.items():
            self.raw[i] = bytes([value])
        # no piece reaches over the start of a word, so the parts between can be segmented one by one
        if any(_SPACE in p.lstrip(_SPACE) for p in self.normal):
            raise ValueError("a piece reaches over a word's start")
        alone = "".join(c for c in "\n\t\r" if not any(c in p and len(p) > 1 for p in self.normal))
        self.chunk = rf"{_SPACE}| *[^ {_SPACE}{alone}]+" + (f"|[{alone}]" if alone else "") + "| +"
        names = list(self.normal)
        keys = np.array([self._hash(p) for p in names], dtype=_U) * _BASE  # spread over the high bits
        order = np.argsort(keys)
        self.ids = np.array([self.normal[p] for p in names], dtype=np.int32)[order]
        self.keys = keys[order]
        if len(np.unique(self.keys)) != len(names):
            raise ValueError("two pieces have one hash")
        # pieces by the high bits of their hash: where a slot's pieces begin, whether it has any, and the most in one slot
        slots = (self.keys >> _U(64 - _SLOT_BITS)).astype(np.int64)
        self.first = np.searchsorted(slots, np.arange(1 << _SLOT_BITS)).astype(np.int32)
        held = np.bincount(slots, minlength=1 << _SLOT_BITS)
        self.taken, self.most = held > 0, int(held.max())
        self.keys = np.append(self.keys, np.zeros(self.most, dtype=_U))
        self.ids = np.append(self.ids, np.full(self.most, -2, dtype=np.int32))
        self.by_id = np.array(self.scores)

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def split(self, text: str) -> list[str]:
        """Parts of the text (with the model's leading space) that no piece reaches out of."""
        return re.findall(self.chunk, " " + text) if text else []

    def _edges(self, part: str, end: int):
        """(length, id) of the pieces that end at ``end``, longest first; id -1 stands for a character's bytes."""
        for size in range(min(end, self.longest), 0, -1):
            i = self.normal.get(part[end - size:end])
            if i is not None:
                yield size, i
            elif size == 1:
                yield 1, -1

    def forward(self, part: str) -> list[float]:
        """For every position the best score of a segmentation of what stands before it."""
        best = [0.0] + [float("-inf")] * len(part)
        for end in range(1, len(part) + 1):
            for size, i in self._edges(part, end):
                best[end] = max(best[end], best[end - size] + (self.scores[i] if i >= 0 else self.penalty))
        return best

    def n_best(self, chunk: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The ``n`` best segmentations (score, ids) of a part, best first.

        A-star from the end of the part backwards: a state's priority is the score of the pieces so far plus the
        forward Viterbi score of the rest, which is exact, so states come off the heap in the order of the whole
        segmentations they lead to. Ties prefer the longer last piece. As every state holds its path, parts of more
        than ``_LONG`` characters go to ``_n_best_rows`` instead.
        """
        if chunk == _SPACE:
            return [(3 * self.penalty, self._bytes(chunk))]
        if len(chunk) > _LONG:
            return self._n_best_rows(chunk, n)
        part = chunk.replace(" ", _SPACE)
        best = self.forward(part)
        heap, out = [(-best[-1], (), len(part), 0.0, ())], []
        while heap and len(out) < n:
            _, sizes, at, score, ids = heapq.heappop(heap)
            if not at:
                out.append((score, tuple(chain.from_iterable(ids[::-1]))))
                continue
            for size, i in self._edges(part, at):
                s = score + (self.scores[i] if i >= 0 else self.penalty)
                piece = (i,) if i >= 0 else self._bytes(part[at - 1])
                heapq.heappush(heap, (-(s + best[at - size]), (*sizes, -size), at - size, s, (*ids, piece)))
        return out

    def _n_best_rows(self, chunk: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The same by a Viterbi search with ``n`` rows and back pointers, in time and memory linear in the part."""
        part = chunk.replace(" ", _SPACE)
        scores = array("d", [0.0]) * (n * (len(part) + 1))  # by position and rank
        sizes, ids, ranks = (array("i", [0]) * len(scores) for _ in range(3))
        held = array("i", [1]) + array("i", [0]) * len(part)
        for end in range(1, len(part) + 1):
            found = []
            for size, i in self._edges(part, end):
                own, at = self.scores[i] if i >= 0 else self.penalty, n * (end - size)
                found += [(-(scores[at + rank] + own), -size, rank, i) for rank in range(held[end - size])]
            found.sort()
            held[end] = min(n, len(found))
            for at, (score, size, rank, i) in enumerate(found[:n], n * end):
                scores[at], sizes[at], ranks[at], ids[at] = -score, -size, rank, i
        out = []
        for rank in range(held[-1]):
            score, end, path = scores[n * len(part) + rank], len(part), []
            while end:
                at = n * end + rank
                path.append((ids[at],) if ids[at] >= 0 else self._bytes(part[end - 1]))
                end, rank = end - sizes[at], ranks[at]
            out.append((score, tuple(chain.from_iterable(path[::-1]))))
        return out

    def _bytes(self, c: str) -> tuple[int, ...]:
        return tuple(self.bytes[b] for b in c.encode())

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Ids of the pieces with these hashes, -2 where there is none."""
        h = h * _BASE
        slots = (h >> _U(64 - _SLOT_BITS)).astype(np.int64)
        out = np.full(len(h), -2, dtype=np.int32)
        at = np.flatnonzero(self.taken[slots])
        if len(at):
            key, place = h[at], self.first[slots[at]]
            for k in range(self.most):
                out[at] = np.where(self.keys[place + k] == key, self.ids[place + k], out[at])
        return out

    def best_many(self, chunks: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The Viterbi search over many parts at once: (parts, in a new order; their ids one after the other; numbers of
        ids; scores; gaps to the second best)."""
        order: list[str] = []
        out: list[list[np.ndarray]] = [[np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0)]]
        by_size: dict[int, list[str]] = {}
        for c in chunks:
            by_size.setdefault(0 if c == _SPACE or len(c) > _LONG else len(c), []).append(c)
        for c in by_size.pop(0, []):
            two = self.n_best(c, 2)
            order.append(c)
            for o, v in zip(out, (two[0][1], [len(two[0][1])], [two[0][0]], [two[0][0] - two[1][0] if len(two) > 1 else np.inf])):
                o.append(np.array(v, dtype=o[0].dtype))
        for size, group in by_size.items():
            for a in range(0, len(group), _ROWS):
                order += group[a:a + _ROWS]
                for o, v in zip(out, self._viterbi(group[a:a + _ROWS], size)):
                    o.append(v)
        return order, *[np.concatenate(o) for o in out]

    def _viterbi(self, chunks: list[str], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        rows = len(chunks)
        chars = np.array(chunks, dtype=f"U{n}").view(np.uint32).reshape(rows, n)
        chars = np.ascontiguousarray((np.where(chars == 32, ord(_SPACE), chars).astype(_U) + _U(1)).T)
        most = min(n, self.longest)
        ids = np.full((n, most + 1, rows), -2, dtype=np.int32)  # by start and length; -2: no piece
        for start in range(n):
            h = np.zeros(rows, dtype=_U)
            for size in range(1, min(most, n - start) + 1):
                h = h * _BASE + chars[start + size - 1]
                ids[start, size] = self._find(h)
            ids[start, 1] = np.where(ids[start, 1] == -2, -1, ids[start, 1])
        by_id = np.append(self.by_id, (-np.inf, self.penalty))  # ids -2 and -1 index from the end
        one, two = np.full((n + 1, rows), -np.inf), np.full((n + 1, rows), -np.inf)
        one[0], back = 0.0, np.zeros((n + 1, rows), dtype=np.int64)
        for end in range(1, n + 1):
            for size in range(min(end, most), 0, -1):
                i = ids[end - size, size]
                if size > 1 and (i == -2).all():
                    continue
                score = by_id[i]
                first, second = one[end - size] + score, two[end - size] + score
                better = first > one[end]
                two[end] = np.where(better, np.maximum(one[end], second), np.maximum(two[end], first))
                one[end] = np.where(better, first, one[end])
                back[end] = np.where(better, size, back[end])
        path, at, row = [], np.full(rows, n), np.arange(rows)
        while (live := at > 0).any():
            size = back[at, row]
            path.append(np.where(live, ids[np.maximum(at - size, 0), size, row], -3))
            at = np.where(live, at - size, 0)
        path = np.array(path[::-1], dtype=np.int32).T
        used = path != -3
        flat, sizes = path[used], used.sum(axis=1)
        raw = np.flatnonzero((path == -1).any(axis=1))
        if len(raw):  # characters without a piece become their bytes
            parts = np.split(flat, np.cumsum(sizes)[:-1])
            for k in raw.tolist():
                parts[k] = np.array(self._with_bytes(chunks[k].replace(" ", _SPACE), parts[k].tolist()), dtype=np.int32)
            flat, sizes = np.concatenate(parts), np.array([len(p) for p in parts])
        with np.errstate(invalid="ignore"):
            return flat, sizes, one[n], one[n] - two[n]

    def _with_bytes(self, part: str, found: list[int]) -> list[int]:
        out, at = [], 0
        for i in found:
            if i == -1:
                out += self._bytes(part[at])
            else:
                out.append(i)
            at += 1 if i == -1 else len(self.pieces[i])
        return out

    def decode(self, ids) -> str:
        """The text that ``ids`` were made from."""
        raw = b"".join([self.raw[i] for i in ids])
        return raw[1:].decode() if raw[:1] == b" " else raw.decode()


def with_edits(ids: list[int], edits) -> list[int]:
    """The piece ids of an alternative: ``edits`` are (at, drop, ids), by position in the best segmentation."""
    out, last = [], 0
    for at, drop, new in edits:
        out += [*ids[last:at], *new]
        last = at + drop
    return out + list(ids[last:])


class Encoder:
    """A worker's segmentations, with a bounded memory of parts seen before."""

    def __init__(self, table: PieceTable, n: int):
        self.table, self.n = table, n
        remembered = lru_cache(50_000)(lambda chunk: table.n_best(chunk, n))
        self.n_best = lambda chunk: remembered(chunk) if len(chunk) <= _LONG else table.n_best(chunk, n)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        self.flat, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.scores, self.gaps = np.zeros(0), np.zeros(0)

    def _learn(self, parts: set[str]) -> None:
        new = [c for c in parts if c not in self.known]
        if len(self.known) + len(new) > _MEMORY or self.chars + sum(map(len, new)) > _CHARS:
            self._forget()
            new = list(parts)
        if new:
            self.chars += sum(map(len, new))
            order, flat, sizes, scores, gaps = self.table.best_many(new)
            self.known.update(zip(order, range(len(self.known), len(self.known) + len(order))))
            self.flat = np.concatenate([self.flat, flat])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
            self.scores, self.gaps = np.concatenate([self.scores, scores]), np.concatenate([self.gaps, gaps])

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, float, list]]:
        """(ids, score, alternatives) of each text."""
        parts = [self.table.split(t) for t in texts]
        self._learn(set().union(*parts))
        return [self._one(p) for p in parts]

    def _one(self, parts: list[str]) -> tuple[np.ndarray, float, list]:
        at = np.fromiter(map(self.known.__getitem__, parts), dtype=np.int64, count=len(parts))
        begins, sizes = self.ends[at], self.ends[at + 1] - self.ends[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.arange(total) + np.repeat(begins - ends + sizes, sizes)]
        score = float(self.scores[at].sum())
        return ids, score, self._alternatives(parts, self.gaps[at], ends - sizes, ends, ids, score)

    def _alternatives(self, parts, gaps, begins, ends, ids, score):
        """The next best segmentations of the whole text as (score, edits).

        Only the parts whose second best is nearest can differ in them: n - 1 single changes of these are never worse
        than a change anywhere else.
        """
        if self.n < 2 or not parts:
            return []
        k = min(self.n - 1, len(gaps))
        limit = np.partition(gaps, k - 1)[k - 1]
        near = sorted(np.flatnonzero(gaps <= limit).tolist(), key=lambda i: (gaps[i], i))[:k]
        best = [(0.0, ())]
        for i in near:
            if gaps[i] == float("inf"):
                continue
            own = tuple(ids[begins[i]:ends[i]].tolist())
            found = self.n_best(parts[i])
            options = [(0.0, None)] + [(found[0][0] - s, (int(begins[i]), len(own), other)) for s, other in found if other != own]
            best = sorted([(a + b, (*e, x) if x else e) for a, e in best for b, x in options], key=lambda c: (c[0], c[1]))[:self.n]
        return [(score - d, sorted(e)) for d, e in best if e]


_ENCODERS: dict[tuple, Encoder] = {}


def _encoder(shared, n: int) -> Encoder:
    """The Python worker's encoder for a broadcast table, kept from task to task."""
    key = (shared.value.made, n)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(shared.value, n)
    return _ENCODERS[key]


_EDIT = pa.struct([("at", pa.int32()), ("drop", pa.int32()), ("ids", pa.list_(pa.int32()))])
_ALT = pa.struct([("score", pa.float64()), ("edits", pa.list_(_EDIT))])
ENCODED = "ids array<int>, score double, alternatives array<struct<score: double, edits: array<struct<at: int, drop: int, ids: array<int>>>>>"


def encode(docs: DataFrame, model: str | None = None, n: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per input row: doc_id, ids, score, alternatives.

    ``ids`` is the segmentation of the whole text with the highest sum of piece scores, ties going to the longer last
    piece; ``alternatives`` are the next ``n`` - 1 as edits of it (see ``with_edits``). Characters without a piece are
    written as their bytes, as is the space mark itself, so ``decode`` returns every text exactly.

    Words are segmented once per worker and remembered in a bounded table; the alternatives come from the A-star search
    over the few words in which they can differ, or, in a word of more than 40 characters, from a Viterbi search with ``n``
    rows, whose memory is linear in the word. The model's pieces (of fixed number) are broadcast from the driver.

    Null text gives null ids, score and alternatives; an empty text gives no piece, score 0 and no alternative. Rows are
    independent: repeated rows repeat, ids of any value pass, other columns are ignored, an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(PieceTable(model or default_model()))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))

    def run(piece):
        texts = piece.column("text").to_pylist()
        out = iter(_encoder(shared, n).encode([t for t in texts if t is not None]))
        got = [(None, None, None) if t is None else next(out) for t in texts]
        sizes = [0, *[0 if g[0] is None else len(g[0]) for g in got]]
        flat = pa.array(np.concatenate([np.zeros(0, np.int32), *[g[0] for g in got if g[0] is not None]]))
        ids = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), flat, mask=pa.array([g[0] is None for g in got]))
        alts = [None if g[2] is None else [{"score": s, "edits": [{"at": a, "drop": d, "ids": i} for a, d, i in e]} for s, e in g[2]] for g in got]
        return pa.RecordBatch.from_arrays([piece.column("doc_id"), ids, pa.array([g[1] for g in got], pa.float64()), pa.array(alts, pa.list_(_ALT))],
                                          names=["doc_id", "ids", "score", "alternatives"])

    return map_slices(rows, "text", run, "doc_id long, " + ENCODED, 2 << 20)


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """``encoded`` (with ``ids``) and the texts that its ids stand for; null ids give null."""
    shared = encoded.sparkSession.sparkContext.broadcast(PieceTable(model or default_model()).raw)

    def body(batches):
        raw = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                texts = []
                for ids in batch.column("ids"):
                    if not ids.is_valid:
                        texts.append(None)
                        continue
                    data = b"".join([raw[i] for i in ids.values.to_numpy(zero_copy_only=False).tolist()])
                    texts.append((data[1:] if data[:1] == b" " else data).decode())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "text"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(body, schema + ", text string")

