"""Words and word n-grams of many texts at once, as 64-bit hashes (numpy).

A hash is a polynomial over the bytes of a token, found for all tokens of a buffer from one
running sum, then mixed. Texts are taken whole; long ones go through in pieces that are cut
between words, so memory stays at a few times ``PIECE`` plus eight bytes a word.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np

U = np.uint64
BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)
#: Bytes handled at a time, few enough for their sums to stay near the processor.
PIECE = 1 << 18
_SPACE = re.compile(rb"[\x00-\x20]")


def _classes(symbols: int) -> np.ndarray:
    kinds = np.full(256, symbols, np.uint8)
    kinds[:33] = 0
    for low, high in ((48, 58), (65, 91), (97, 123), (128, 256)):
        kinds[low:high] = 1
    return kinds


#: 1: letters, digits and whatever is not ASCII; 2: ASCII symbols, left out in WORDS.
WORDS, WORDS_AND_SYMBOLS = _classes(0), _classes(2)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U)
    out[:1] = 1
    return np.cumprod(out, dtype=U)


_cache: dict[str, np.ndarray] = {"up": _powers(BASE, 1), "down": _powers(INVERSE, 1)}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_cache["up"]) < n:
        size = max(n, PIECE + PIECE // 4)
        _cache["up"], _cache["down"] = _powers(BASE, size), _powers(INVERSE, size)
    return _cache["up"][:n], _cache["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijection of 64-bit numbers in which every output bit depends on all input bits."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the spans [start, end) of a buffer of bytes."""
    up, down = _tables(len(data))
    total = np.zeros(len(data) + 1, U)
    np.cumsum((data.astype(U) + U(1)) * up, dtype=U, out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def _buffer_tokens(buffer: bytes, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(buffer, np.uint8)
    kind = kinds[data]
    edge = np.empty(len(kind) + 1, bool)
    edge[0] = edge[-1] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:-1])
    cuts = np.flatnonzero(edge)
    starts, ends = cuts[:-1], cuts[1:]
    keep = kind[starts] != 0
    starts, ends = starts[keep], ends[keep]
    return starts, span_hashes(data, starts, ends)


def _cut(raw: bytes) -> list[bytes]:
    """A long text in pieces, cut at white space."""
    out, at = [], 0
    while len(raw) - at > PIECE:
        found = _SPACE.search(raw, at + PIECE)
        if not found:
            break
        out.append(raw[at : found.start()])
        at = found.start()
    out.append(raw[at:])
    return out


def tokens(texts: Sequence[str | None], kinds: np.ndarray = WORDS, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the tokens of text i are ``hashes[offsets[i]:offsets[i + 1]]``.

    A null text has no tokens, like an empty one.
    """
    parts: list[bytes] = []
    owner: list[int] = []
    for i, text in enumerate(texts):
        if text:
            raw = (text.lower() if lower else text).encode("utf-8", "surrogatepass")
            cut = [raw] if len(raw) <= PIECE else _cut(raw)
            parts += cut
            owner += [i] * len(cut)
    counts = np.zeros(len(texts), np.int64)
    found: list[np.ndarray] = []
    start = 0
    while start < len(parts):
        stop, size = start, 0
        while stop < len(parts) and (stop == start or size + len(parts[stop]) < PIECE):
            size += len(parts[stop]) + 1
            stop += 1
        at, hashes = _buffer_tokens(b" ".join(parts[start:stop]), kinds)
        begins = np.cumsum([0] + [len(p) + 1 for p in parts[start:stop]])
        n = np.diff(np.searchsorted(at, begins))
        np.add.at(counts, owner[start:stop], n)
        found.append(hashes)
        start = stop
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(counts, out=offsets[1:])
    return (np.concatenate(found) if found else np.empty(0, U)), offsets


def ngrams(hashes: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n neighbouring tokens; a text with fewer tokens, but some, has one gram of all."""
    counts = np.diff(offsets)
    grams = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    out_offsets = np.zeros(len(offsets), np.int64)
    np.cumsum(grams, out=out_offsets[1:])
    if not len(hashes):
        return hashes, out_offsets
    padded = np.concatenate([hashes, np.zeros(n, U)])
    value = np.zeros(len(hashes), U)
    for k in range(n):
        value *= U(BASE)
        value += padded[k : k + len(hashes)]
    first = np.arange(out_offsets[-1]) + np.repeat(offsets[:-1] - out_offsets[:-1], grams)
    value = value[first]
    for i in np.flatnonzero((counts > 0) & (counts < n)):
        v = 0
        for h in hashes[offsets[i] : offsets[i + 1]].tolist():
            v = (v * BASE + h + 1) & 0xFFFFFFFFFFFFFFFF
        value[out_offsets[i]] = v
    return mix(value), out_offsets
