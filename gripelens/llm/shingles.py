"""Word shingles of many texts at once: hashes, distinct sets, fingerprints, signatures.

A word is a run of bytes other than blanks (space and codes 9 to 13), with A-Z lowered. Word
hashes come from prefix sums of a polynomial over the bytes, so that no word is cut out.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) < n:
        n = max(n, 1 << 20)
        _POWERS.clear()
        for factor in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(n, factor, _U)
            steps[0] = 1
            _POWERS.append(np.multiply.accumulate(steps))
    return _POWERS[0], _POWERS[1]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, number of words of each text)."""
    parts = [t.encode() for t in texts]
    raw = np.frombuffer(b"\n".join(parts).lower() + b"\n", np.uint8)
    word = ~_BLANK.take(raw)
    flips = np.flatnonzero(np.diff(word, prepend=False))
    starts, ends = flips[0::2], flips[1::2]
    power, inverse = _powers(len(raw))
    sums = np.zeros(len(raw) + 1, _U)
    np.cumsum(raw.astype(_U) * power[: len(raw)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * inverse[starts]
    hashes = mix(hashes + (ends - starts).astype(_U) * _U(0xD6E8FEB86659FD93))
    borders = np.cumsum([len(p) + 1 for p in parts])
    upto = np.searchsorted(starts, borders)
    return hashes, np.diff(upto, prepend=0)


def shingle_sets(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of each text end to end, set sizes). A text with fewer
    words than ``width`` has its whole sequence as one shingle; without words, none."""
    hashes, counts = word_hashes(texts)
    sets, sizes, at = [], np.zeros(len(texts), np.int64), 0
    rolled = np.zeros(max(len(hashes) - width + 1, 0), _U)
    for k in range(width):
        rolled = rolled * _U(0xA24BAED4963EE407) + hashes[k : k + len(rolled)]
    rolled = mix(rolled + _U(width))
    for i, n in enumerate(counts.tolist()):
        if n >= width:
            found = np.unique(rolled[at : at + n - width + 1])
        elif n:
            whole = np.zeros(1, _U)
            for h in hashes[at : at + n]:
                whole = whole * _U(0xA24BAED4963EE407) + h
            found = mix(whole + _U(n))
        else:
            found = rolled[:0]
        sets.append(found)
        sizes[i] = len(found)
        at += n
    return (np.concatenate(sets) if sets else np.zeros(0, _U)), sizes


def shingles(texts: list[str], width: int) -> np.ndarray:
    """The hashes of ``width`` words in a row, of all texts, as often as they occur; as in
    ``shingle_sets``, whose one shingle for shorter texts is left out."""
    hashes, counts = word_hashes(texts)
    rolled = np.zeros(max(len(hashes) - width + 1, 0), _U)
    for k in range(width):
        rolled = rolled * _U(0xA24BAED4963EE407) + hashes[k : k + len(rolled)]
    inside = np.ones(len(rolled), bool)
    ends = np.cumsum(counts)
    for k in range(1, width):  # those that reach into the next text
        inside[(at := ends - k)[(at >= 0) & (at < len(rolled))]] = False
    return mix(rolled[inside] + _U(width))


@lru_cache(maxsize=4)
def _permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * count + 1, dtype=_U) * _U(_BASE))
    return seeds[:count] | _U(1), seeds[count:]


@dataclass
class Signatures:
    """Per text: set size, 16-byte fingerprint of the set, and ``count`` minimum hashes."""

    sizes: np.ndarray
    prints: list[bytes | None]
    minima: np.ndarray


def signatures(texts: list[str], width: int, count: int) -> Signatures:
    flat, sizes = shingle_sets(texts, width)
    full = np.flatnonzero(sizes)
    starts = (np.cumsum(sizes) - sizes)[full]
    minima = np.zeros((len(texts), count), np.uint32)
    prints: list[bytes | None] = [None] * len(texts)
    if len(full):
        sums = [np.add.reduceat(mix(flat ^ _U(salt)), starts) for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
        both = np.stack([mix(sums[0] + sizes[full].astype(_U)), mix(sums[1])], 1)
        for i, value in zip(full.tolist(), both):
            prints[i] = value.tobytes()
        factors, shifts = _permutations(count)
        for k in range(count):
            values = ((flat * factors[k] + shifts[k]) >> _U(32)).astype(np.uint32)
            minima[full, k] = np.minimum.reduceat(values, starts)
    return Signatures(sizes, prints, minima)
