"""Hashed word shingles of many texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
_PIECE = 4 << 20
_BASE = U(0x9E3779B97F4A7C15)
_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MORE = U(0xD6E8FEB86659FD93)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BYTE = mix(np.arange(1, 257, dtype=U) * _BASE)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            one = np.full(max(n, 1 << 16), base, dtype=U)
            one[0] = 1
            _POWERS[name] = np.cumprod(one)
    return _POWERS["up"], _POWERS["down"]


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets); a null is an empty text."""
    big = texts.cast(pa.large_string())
    offsets = np.frombuffer(big.buffers()[1], dtype=np.int64)[big.offset:big.offset + len(big) + 1] if len(big) else np.zeros(1, np.int64)
    data = big.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def _word_hashes(data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes) of the words of ``data``; ``first`` marks bytes where a text begins."""
    n = len(data)
    inside = ~_WHITE[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1] | first[1:]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | first[1:]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    up, down = _powers(n)
    sums = np.zeros(n + 1, dtype=U)
    np.cumsum(_BYTE[_LOWER[data]] * up[:n], out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U) * _MORE)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in order, the number of words before each text).

    A word is a longest run without the six white characters, A-Z lowered. Long input is worked through in
    pieces that end at white space or between texts.
    """
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True
    all_starts, all_hashes, at = [], [], 0
    while at < len(data):
        to = min(len(data), at + _PIECE)
        while to < len(data) and not (first[to] or _WHITE[data[to]]):
            gap = np.flatnonzero(_WHITE[data[to:to + _PIECE]] | first[to:min(to + _PIECE, len(data))])
            to = to + int(gap[0]) if len(gap) else min(len(data), to + _PIECE)
        starts, hashes = _word_hashes(data[at:to], first[at:to])
        all_starts.append(starts + at)
        all_hashes.append(hashes)
        at = to
    starts = np.concatenate(all_starts) if all_starts else np.zeros(0, np.int64)
    hashes = np.concatenate(all_hashes) if all_hashes else np.zeros(0, U)
    return hashes, np.searchsorted(starts, offsets)


def _fold(parts: list[np.ndarray]) -> np.ndarray:
    h = parts[0]
    for p in parts[1:]:
        h = h * _BASE + p
    return h


def shingle_sets(texts: pa.Array, width: int = 5) -> list[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its ``width``-word shingles.

    Fewer words make one shingle of them all; no word or no text makes an empty set.
    """
    hashes, at = words(*utf8(texts))
    grams = mix(_fold([hashes[j:len(hashes) - width + 1 + j] for j in range(width)])) if len(hashes) >= width else hashes[:0]
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(grams[a:b - width + 1]))
        elif b > a:
            out.append(mix(_fold([hashes[j:j + 1] for j in range(a, b)]) + np.array([b - a], dtype=U) * _MORE))
        else:
            out.append(hashes[:0])
    return out


def set_hash(one: np.ndarray) -> int:
    """A signed 64-bit name of a set, the same for every order of its members."""
    total = mix(one ^ _MORE).sum(dtype=U, keepdims=True) + np.array([len(one)], dtype=U) * _BASE
    return int(mix(total).view(np.int64)[0])


def parity_bits(one: np.ndarray) -> bytes:
    """A bit per bucket: whether an odd number of members fall there; about as many bits as members.

    Two sets differ in at least as many members as their parity bits do. Halves may be XORed to compare
    with a shorter one.
    """
    m = 64
    while m < len(one):
        m *= 2
    odd = np.bincount((one & U(m - 1)).astype(np.int64), minlength=m).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").tobytes()


def parity_distance(a: bytes, b: bytes) -> int:
    """At most the number of members in one set only."""
    x, y = int.from_bytes(a, "little"), int.from_bytes(b, "little")
    n, m = len(a) * 8, len(b) * 8
    while n > m:
        n //= 2
        x = (x >> n) ^ (x & ((1 << n) - 1))
    while m > n:
        m //= 2
        y = (y >> m) ^ (y & ((1 << m) - 1))
    return (x ^ y).bit_count()
