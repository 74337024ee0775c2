"""Periodic runs of words: stretches that repeat a block of words at least twice.

A run has smallest period q (words q apart are identical), at least max(LEAST, 2 q) words, and no
neighbouring word prolongs it. Words are maximal sequences of bytes other than blanks (space
and codes 9 to 13), compared as they are, by 64-bit hashes of all their bytes.

Sparse diagonal programme. Diagonal q holds the places whose word also stands q words earlier; a
run of period q is a stretch of m >= q such places in a row, m + q words in all. Only diagonals
that an earlier occurrence opens are followed:

* Lags below 8 are few: every word meets the seven before it.
* A lag of 8 or more in [g, 2g), g a power of two, needs g matches in a row. So for each word the
  g words from it on are looked up among earlier occurrences of the same g words, between g
  and 2g words back. An occurrence opens its diagonal only where the words before the two differ:
  one event for a whole diagonal, not one for each word.
* Occurrences at most g/2 apart overlap and form one repetition of that step p. Lags between
  two of them are multiples of p on the same stretch, never its smallest period. Its first
  occurrence alone can differ in the word before from others of the repetition, so a pair that
  opens a diagonal has such a first occurrence as one of its ends. Repetitions of one sequence
  are more than g/2 apart, which leaves at most four within reach: the work is near
  linear in the words at every g, however periodic or long the text is.

An open diagonal's match length grows, by chunks that double, up to the first mismatch; if it is
sufficient the run is emitted there. Of diagonals over the same stretch the smallest lag counts
(the others are its multiples).

Texts of a batch are laid end to end and do not match one another. Rows: null and empty texts have
no words and no runs; very long texts are one batch each, with memory in proportion to their
words; repeated rows give equal results; columns named like an output are replaced, others pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gripelens.llm.byte_bpe import slices
from gripelens.llm.shingles import _BLANK, _powers, mix

LEAST = 12
SHORT = 8  # lags below it are compared word by word
_U = np.uint64
RUN = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")])


def _words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash) of every word of texts laid end to end, a blank after each."""
    flips = np.flatnonzero(np.diff(~_BLANK.take(raw), prepend=False))
    starts, ends = flips[0::2], flips[1::2]
    power, inverse = _powers(len(raw))
    sums = np.zeros(len(raw) + 1, _U)
    np.cumsum(raw.astype(_U) * power[: len(raw)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * inverse[starts]
    return starts, ends, mix(hashes + (ends - starts).astype(_U) * _U(0xD6E8FEB86659FD93))


def _short_lags(w: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(first word, length, lag) of the sufficient diagonals with lags below SHORT."""
    for q in range(1, min(SHORT, len(w))):
        edges = np.flatnonzero(np.diff(w[q:] == w[:-q], prepend=False, append=False))
        first, matched = edges[0::2], edges[1::2] - edges[0::2]
        enough = matched >= max(q, least - q)
        yield first[enough], matched[enough] + q, q


def _between(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the range, member) for all members of the ranges [low, high)."""
    sizes = np.maximum(high - low, 0)
    which = np.repeat(np.arange(len(sizes)), sizes)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[which]


def _opened(w: np.ndarray, grams: np.ndarray, at: np.ndarray, g: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, earlier place) where diagonals with lags in [g, 2g) open and hold g words.

    ``grams`` has the hash of the g words from each place on, ``at`` the places to look at.
    """
    order = np.argsort(grams[at], kind="stable")
    place, gram = at[order], grams[at][order]
    again = gram[1:] == gram[:-1]
    repeated = np.zeros(len(place), bool)
    repeated[1:] |= again
    repeated[:-1] |= again
    fresh = np.concatenate([[True], ~again])[repeated]
    place = place[repeated]
    if not len(place):
        return place, place
    wide = np.int64(len(w) + 2 * g + 2)
    key = (np.cumsum(fresh) - 1) * wide + place  # occurrences of a sequence in order, sequences apart
    first = fresh | (np.diff(place, prepend=0) > g // 2)
    heads = np.flatnonzero(first)
    own = np.cumsum(first) - 1

    def reach(x: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = np.searchsorted(among, key[x] - np.minimum(place[x], 2 * g - 1), side="left")
        high = np.searchsorted(among, key[x] - g, side="right")
        return _between(low, high)

    every = np.arange(len(place))
    x1, h1 = reach(every, key[heads])
    other = h1 != own[x1]
    x1, y1 = x1[other], heads[h1[other]]
    rest = np.flatnonzero(~first)
    x2, r2 = reach(heads, key[rest])
    x = place[np.concatenate([x1, heads[x2]])]
    y = place[np.concatenate([y1, rest[r2]])]
    opens = (y == 0) | (w[x - 1] != w[y - 1])
    x, y = x[opens], y[opens]
    last = x + (x - y) - g  # the lag's own length must match as well: its last g words do
    inside = last < len(grams)
    x, y, last = x[inside], y[inside], last[inside]
    holds = grams[last] == grams[last - (x - y)]
    return x[holds], y[holds]


def _matched(w: np.ndarray, x: int, lag: int) -> int:
    """Length of the diagonal from ``x`` on, the first ``lag`` words of which match."""
    m, chunk = lag, max(2 * lag, 64)
    while True:
        later = w[x + m : x + m + chunk]
        differ = np.flatnonzero(later != w[x + m - lag : x + m - lag + len(later)])
        if len(differ):
            return m + int(differ[0])
        m += len(later)
        if len(later) < chunk:
            return m
        chunk *= 2


def find_runs(words: np.ndarray, counts: np.ndarray, least: int = LEAST) -> np.ndarray:
    """(text, start, length, period) of all runs, ordered; starts count from the text's first word.

    ``words`` are hashes of the words of texts laid end to end, ``counts`` their numbers.
    """
    ends = np.cumsum(counts)
    text = np.repeat(np.arange(len(counts)), counts)
    w = mix(words + mix(text.astype(_U) + _U(0x632BE59BD9B4E019)))
    found = [(first, length, np.full(len(first), q)) for first, length, q in _short_lags(w, least)]
    grams, g = w, 1
    longest = int(counts.max(initial=0))
    while 2 * max(g, SHORT) <= longest:
        if g >= SHORT:
            at = np.flatnonzero((counts >= 2 * g)[text[: len(grams)]] & (np.arange(len(grams)) + g <= ends[text[: len(grams)]]))
            x, y = _opened(w, grams, at, g)
            order = np.argsort(x - y, kind="stable")
            x, y = x[order], y[order]
            length = np.array([_matched(w, int(a), int(a - b)) for a, b in zip(x, y)], np.int64) + (x - y)
            enough = length >= least
            found.append((y[enough], length[enough], (x - y)[enough]))
        grams = mix(grams[:-g] * _U(0xA24BAED4963EE407) + grams[g:])
        g *= 2
    first, length, period = (np.concatenate([f[i] for f in found] or [[]]).astype(np.int64) for i in range(3))
    order = np.lexsort((period, length, first))
    first, length, period = first[order], length[order], period[order]
    smallest = np.ones(len(first), bool)
    smallest[1:] = (first[1:] != first[:-1]) | (length[1:] != length[:-1])
    first, length, period = first[smallest], length[smallest], period[smallest]
    whose = text[first]
    start = first - (ends - counts)[whose]
    order = np.lexsort((period, start, whose))
    return np.stack([whose, start, length, period], 1)[order]


def _covered(size: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """True at places inside any of the ranges [low, high)."""
    steps = np.zeros(size + 1, np.int32)
    np.add.at(steps, low, 1)
    np.add.at(steps, high, -1)
    return np.cumsum(steps[:-1], dtype=np.int32) > 0


class Runs:
    """Runs of a batch of texts, and the texts without their repetitions."""

    def __init__(self, texts: list[str], least: int = LEAST):
        parts = [t.encode() for t in texts]
        self.raw = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8) if parts else np.zeros(0, np.uint8)
        self.borders = np.cumsum([0, *[len(p) + 1 for p in parts]])
        self.starts, self.ends, hashes = _words(self.raw)
        upto = np.searchsorted(self.starts, self.borders)
        self.counts, self.base = np.diff(upto), upto[:-1]
        self.rows = find_runs(hashes, self.counts, least)

    def run_lists(self) -> pa.Array:
        offsets = np.searchsorted(self.rows[:, 0], np.arange(len(self.counts) + 1)).astype(np.int32)
        values = pa.StructArray.from_arrays([pa.array(self.rows[:, k]) for k in (1, 2, 3)], RUN.names)
        return pa.ListArray.from_arrays(pa.array(offsets), values)

    def collapsed(self) -> pa.Array:
        """The words that no run holds after its first period, joined by one space."""
        text, start, length, period = self.rows.T
        first = self.base[text] + start if len(text) else start
        keep = ~_covered(len(self.starts), first + period, first + length)
        kept = np.flatnonzero(keep)
        whose = np.repeat(np.arange(len(self.counts)), self.counts)[kept]
        low, high = self.starts[kept], self.ends[kept]
        blanks = high[:-1][whose[1:] == whose[:-1]]
        mask = _covered(len(self.raw), low, high)
        mask[blanks] = True
        out = self.raw.copy()
        out[blanks] = 0x20
        sizes = np.add.reduceat(mask, self.borders[:-1], dtype=np.int64) if len(self.counts) else np.zeros(0, np.int64)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return pa.Array.from_buffers(
            pa.string(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(out[mask]))]
        )


def periodic_runs(
    df: DataFrame,
    text_col: str = "text",
    runs_col: str = "runs",
    collapsed_col: str = "collapsed",
    count_col: str = "n_words",
    least: int = LEAST,
) -> DataFrame:
    """Adds the runs (array of start, length, period, ordered), the collapsed text and the number of
    words. One pass over the rows, no shuffle."""
    added = [
        T.StructField(runs_col, T.ArrayType(RUN, False), False),
        T.StructField(collapsed_col, T.StringType(), False),
        T.StructField(count_col, T.LongType(), False),
    ]
    new = [f.name for f in added]
    keep = [f for f in df.schema.fields if f.name not in new]
    names = [f.name for f in keep]
    if text_col not in names:
        raise ValueError(f"{text_col} is both the text and an output")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            found = Runs([t or "" for t in batch.column(text_col).to_pylist()], least)
            columns = [found.run_lists(), found.collapsed(), pa.array(found.counts)]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], *columns], [*names, *new])

    return df.mapInArrow(run, T.StructType([*keep, *added]))
