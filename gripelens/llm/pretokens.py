"""Pre-token boundaries of many texts at once, without a regular expression.

Every code point gets a class (letter, number, blank, ...). A small automaton reads the
classes and says where a pre-token begins. A character is a function from state to
state; functions compose associatively, and the compositions that can occur are a small
finite set, so composing is one table lookup. All prefixes of a text are therefore
composed as a blocked scan over arrays: within all blocks side by side, then over the
blocks' totals, then the states are read off.

The rule is that of the widespread byte-level pattern: the contractions 's 't 're 've 'm
'll 'd; runs of letters, of numbers, or of other marks, each with one leading space;
blanks, of which the last before a word stays outside the run.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np

LETTER, NUMBER, MARK, BLANK_INSIDE, SPACE_LAST, BLANK_LAST, SHORT, LONG, BORDER = range(9)
START, IN_WORD, IN_NUMBER, IN_MARKS, IN_BLANKS, AFTER_SPACE, ONE_MORE, TWO_MORE = range(8)

# Characters of a block of the scan.
_WIDTH = 64

# Code points with the White_Space property.
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
    0x205F, 0x3000,
)
# Endings of contractions.
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")


@lru_cache(maxsize=1)
def code_classes() -> np.ndarray:
    """LETTER, NUMBER, MARK or BLANK_INSIDE for every code point."""
    kinds = np.full(0x110000, MARK, np.uint8)
    for c in range(0x110000):
        first = unicodedata.category(chr(c))[0]
        if first == "L":
            kinds[c] = LETTER
        elif first == "N":
            kinds[c] = NUMBER
    kinds[list(WHITE_SPACE)] = BLANK_INSIDE
    return kinds


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """Next state, and whether the character begins a pre-token."""
    if state == TWO_MORE and symbol != BORDER:
        return ONE_MORE, False
    if state == ONE_MORE and symbol != BORDER:
        return START, False
    run = {LETTER: IN_WORD, NUMBER: IN_NUMBER, MARK: IN_MARKS, SHORT: IN_MARKS, LONG: IN_MARKS}
    if symbol in run:
        if state in (run[symbol], AFTER_SPACE):
            return run[symbol], False
        return {SHORT: ONE_MORE, LONG: TWO_MORE}.get(symbol, run[symbol]), True
    if symbol == BLANK_INSIDE:
        return IN_BLANKS, state != IN_BLANKS
    return (AFTER_SPACE if symbol == SPACE_LAST else START), True


@lru_cache(maxsize=1)
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(index of each symbol's function, composition table, functions, begin flags)."""
    step = [tuple(_step(s, x)[0] for s in range(8)) for x in range(9)]
    known: dict[tuple[int, ...], int] = {}
    for f in step:
        known.setdefault(f, len(known))
    queue = list(known)
    for f in queue:  # grows while new compositions turn up
        for g in step:
            h = tuple(g[s] for s in f)
            if h not in known:
                known[h] = len(known)
                queue.append(h)
    functions = np.array(list(known), np.uint8)
    count = len(functions)
    assert count < 1 << 15
    compose = np.empty((count, count), np.uint16)
    for i, f in enumerate(known):
        for j, g in enumerate(known):
            h = tuple(g[s] for s in f)
            compose[i, j] = known.setdefault(h, len(known))
    assert len(known) == count
    begins = np.array([[_step(s, x)[1] for x in range(9)] for s in range(8)], bool)
    return np.array([known[f] for f in step], np.uint16), compose, functions, begins


def _states(steps: np.ndarray, state: int = START) -> np.ndarray:
    """State after each character, from the characters' functions."""
    _, compose, functions, _ = automaton()
    n, width = len(steps), _WIDTH
    if n <= width:
        out = np.empty(n, np.uint8)
        for i in range(n):
            state = out[i] = functions[steps[i], state]
        return out
    blocks = -(-n // width)
    side = np.zeros((blocks, width), np.uint16)
    side.ravel()[:n] = steps
    side = np.ascontiguousarray(side.T)  # row j: the j-th character of every block
    flat, count = compose.ravel(), np.uint32(len(compose))
    for j in range(1, width):
        side[j] = flat.take(side[j - 1] * count + side[j])
    enter = np.empty(blocks, np.uint8)
    enter[0] = state
    enter[1:] = _states(side[-1], state)[:-1]
    out = functions.ravel().take(side * np.uint16(8) + enter)
    return np.ascontiguousarray(out.T).ravel()[:n]


def _symbols(points: np.ndarray, borders: np.ndarray) -> np.ndarray:
    kinds = code_classes().take(points)
    kinds[borders] = BORDER
    blank = kinds == BLANK_INSIDE
    last = np.zeros(len(kinds), bool)
    last[:-1] = blank[:-1] & ~blank[1:] & (kinds[1:] != BORDER)
    kinds[last] = np.where(points[last] == 0x20, SPACE_LAST, BLANK_LAST)
    marks = np.flatnonzero(points == ord("'"))
    marks = marks[kinds[marks] == MARK]
    if len(marks):
        padded = np.append(points, [0, 0])
        letters = np.append(kinds, [BORDER, BORDER]) == LETTER
        first = np.where(letters[marks + 1], padded[marks + 1], 0)
        second = np.where(letters[marks + 2], padded[marks + 2], 0)
        kinds[marks[np.isin(first, [ord(c) for c in ONE_LETTER])]] = SHORT
        for a, b in TWO_LETTERS:
            kinds[marks[(first == ord(a)) & (second == ord(b))]] = LONG
    return kinds


def boundaries(points: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Positions at which a pre-token begins; ``borders`` are positions of separators
    between texts, each of which counts as a beginning of its own."""
    if not len(points):
        return np.zeros(0, np.int64)
    function_of, _, _, begins = automaton()
    symbols = _symbols(points, borders)
    before = np.empty(len(points), np.uint8)
    before[0] = START
    before[1:] = _states(function_of.take(symbols))[:-1]
    return np.flatnonzero(begins.ravel().take(before.astype(np.uint16) * 9 + symbols))
