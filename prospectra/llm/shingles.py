"""Word shingles of texts as sorted 64-bit hashes, and HyperMinHash registers over them."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

from prospectra.llm.common import WORD_SPACE, mix

WORDS = 5
#: Buckets of a sketch, and bits of mantissa kept beside the count of leading zeros.
BUCKETS, MANTISSA = 128, 10
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: A hash per byte value, and the factor between neighbouring places of a word.
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _MULTIPLIER)
_PLACE = _BYTES[0] | np.uint64(1)
_IN_WORD = np.array([chr(b) not in WORD_SPACE for b in range(256)])
#: Bytes hashed at once; a piece ends behind a word, so a longer word is a longer piece.
PIECE = 1 << 16


def _pieces(raw: bytes) -> Iterator[tuple[int, bytes]]:
    at = 0
    while at < len(raw):
        space = _SPACE.search(raw, at + PIECE)
        end = space.start() if space else len(raw)
        yield at, raw[at:end]
        at = end


def word_names(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin, and a 64-bit hash of each, equal on every machine: byte hashes times powers by place, summed, mixed with the length."""
    begins, names = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for at, piece in _pieces(raw):
        values = np.frombuffer(piece, np.uint8)
        inside = np.zeros(len(values) + 2, bool)
        inside[1:-1] = _IN_WORD[values]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        lengths = edges[1::2] - edges[::2]
        if len(lengths):
            first = np.cumsum(lengths) - lengths
            place = np.arange(lengths.sum()) - np.repeat(first, lengths)
            powers = np.cumprod(np.full(lengths.max(), _PLACE, np.uint64))
            sums = np.add.reduceat(_BYTES[values[inside[1:-1]]] * powers[place], first)
            begins.append(edges[::2] + at)
            names.append(mix(sums + lengths.astype(np.uint64) * _MULTIPLIER))
    return np.concatenate(begins), np.concatenate(names)


def _roll(names: np.ndarray, n: int) -> np.ndarray:
    """A hash per n neighbouring names; the names are mixed already, so the sum is mixed once."""
    rolled = np.full(len(names) - n + 1, n, np.uint64)
    for i in range(n):
        rolled = rolled * _MULTIPLIER + names[i:len(names) - n + 1 + i]
    return mix(rolled)


def shingle_sets(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text; one with fewer words is one shingle, one without words has none."""
    raws = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    ends = np.cumsum([len(r) + 1 for r in raws])
    begins, names = word_names(b" ".join(raws).translate(_LOWER))
    counts = np.bincount(np.searchsorted(ends, begins, "right"), minlength=len(texts))
    last = np.cumsum(counts)
    rolled = _roll(names, words) if len(names) >= words else names[:0]
    out = []
    for n, stop in zip(counts.tolist(), last.tolist()):
        own = rolled[stop - n:stop - words + 1] if n >= words else _roll(names[stop - n:stop], n) if n else names[:0]
        own = np.sort(own)
        out.append(own[np.r_[True, own[1:] != own[:-1]]] if len(own) else own)
    return out


_SEEDS = mix(np.arange(1, BUCKETS + 1, dtype=np.uint64) * _MULTIPLIER) | np.uint64(1)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """A row of 16-bit registers per non-empty set: for each bucket the leading zeros of its smallest hash, then the bits behind its first one."""
    if not sets:
        return np.zeros((0, BUCKETS), "<u2")
    low = np.empty((BUCKETS, len(sets)), np.uint64)
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    for b in range(BUCKETS):
        hashed = flat * _SEEDS[b]
        hashed ^= hashed >> np.uint64(32)
        hashed *= _MULTIPLIER
        low[b] = np.minimum.reduceat(hashed, starts)
    return np.ascontiguousarray(compress(low.ravel()).reshape(low.shape).T)


def compress(low: np.ndarray) -> np.ndarray:
    """Leading zeros (6 bits) and mantissa of 64-bit minima."""
    zeros = np.zeros(len(low), np.uint64)
    rest = low.copy()
    for step in (32, 16, 8, 4, 2, 1):
        small = rest < (np.uint64(1) << np.uint64(64 - step))
        zeros[small] += np.uint64(step)
        rest[small] <<= np.uint64(step)
    mantissa = (rest << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    return (np.minimum(zeros, 63) << np.uint64(MANTISSA) | mantissa).astype("<u2")


def chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The chance that registers of unrelated sets of sizes n and m agree.

    The smallest of n hashes is about exponential with mean 1/n; a register keeps it to a
    relative width of 2^-MANTISSA, and the sum over widths tends to this product form.
    """
    n, m = np.maximum(n, 1).astype(float), np.maximum(m, 1).astype(float)
    return np.minimum(1.0, n * m / (n + m) ** 2 * 2 * 0.7213 / 2**MANTISSA)


def jaccard_estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Share of equal registers, corrected for chance; rows of registers and the sets' sizes come in."""
    c = chance(n, m)
    return ((a == b).mean(axis=1) - c) / (1 - c)
