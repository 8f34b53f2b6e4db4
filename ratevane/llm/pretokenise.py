"""Where the pieces of a text begin, by a finite automaton whose transition functions are composed in blocks, without a regex.

The pieces are those of 's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+ .
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np

#: What is known of a character and of those that follow it. SPACE_LAST and WHITE_LAST stand before something else than white space.
LETTER, NUMBER, OTHER, SHORT, LONG, SPACE_LAST, WHITE_LAST, WHITE, NOTHING = range(9)
#: What the piece so far is: a run of one kind, a blank that the next character joins, letters of a contraction to come, or over.
IN_LETTER, IN_NUMBER, IN_OTHER, IN_WHITE, BLANK, ONE_MORE, TWO_MORE, OVER = range(8)
STATES = 8
FRESH = 9  # added to the kind of a text's first character: whatever came before, a piece begins


def _tables() -> tuple[np.ndarray, np.ndarray]:
    to = np.zeros((2 * FRESH, STATES), np.uint8)
    begins = np.zeros((2 * FRESH, STATES), bool)
    first = {LETTER: IN_LETTER, NUMBER: IN_NUMBER, OTHER: IN_OTHER, SHORT: ONE_MORE, LONG: TWO_MORE, SPACE_LAST: BLANK, WHITE_LAST: OVER, WHITE: IN_WHITE}
    goes_on = {(LETTER, IN_LETTER), (NUMBER, IN_NUMBER), (WHITE, IN_WHITE)} | {(k, s) for k in (OTHER, SHORT, LONG) for s in (IN_OTHER, BLANK)} | {(LETTER, BLANK), (NUMBER, BLANK)}
    for kind, begun in first.items():
        to[kind], begins[kind] = begun, True
        to[kind + FRESH], begins[kind + FRESH] = begun, True
        for state in range(STATES):
            if (kind, state) in goes_on:
                begins[kind, state] = False
                to[kind, state] = {SHORT: IN_OTHER, LONG: IN_OTHER}.get(kind, begun)
        to[kind, TWO_MORE], begins[kind, TWO_MORE] = ONE_MORE, False
        to[kind, ONE_MORE], begins[kind, ONE_MORE] = OVER, False
    to[NOTHING] = to[NOTHING + FRESH] = np.arange(STATES)
    return to, begins


TO, BEGINS = _tables()
_WIDTH = 64


@lru_cache(1)
def classes() -> np.ndarray:
    """Of every code point: LETTER, NUMBER, OTHER or WHITE."""
    out = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind in "LN":
            out[c] = LETTER if kind == "L" else NUMBER
    for a, b in ((9, 13), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)):  # Unicode's White_Space
        out[a : b + 1] = WHITE
    return out


def kinds(points: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The automaton's input: a kind for each code point of texts that begin at `off`."""
    kind = classes()[points]
    n = len(points)
    last = np.zeros(n + 1, bool)
    last[off[1:][off[1:] > 0] - 1] = True
    last = last[:n]
    ahead1 = np.append(points[1:], np.uint32(0))
    ahead1[last] = 0
    ahead2 = np.append(ahead1[1:], np.uint32(0))
    ahead2[last] = 0
    white = kind == WHITE
    before_more = white & (ahead1 != 0) & (np.append(kind[1:], np.uint8(WHITE)) != WHITE) & ~last
    kind[before_more] = np.where(points[before_more] == 32, SPACE_LAST, WHITE_LAST)
    mark = np.flatnonzero(points == 39)
    a, b = ahead1[mark], ahead2[mark]
    kind[mark[np.isin(a, [ord(c) for c in "stmd"])]] = SHORT
    two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
    kind[mark[two]] = LONG
    starts = off[:-1][off[:-1] < off[1:]]
    kind[starts] += FRESH
    return kind


def _states_before(functions: np.ndarray) -> np.ndarray:
    """The state before each of a list of transition functions (n, STATES), from OVER on: composition is associative, so blocks are composed side by side."""
    n = len(functions)
    if n <= _WIDTH:
        out, s = np.empty(n, np.uint8), OVER
        for i in range(n):
            out[i] = s
            s = functions[i, s]
        return out
    rows = -(-n // _WIDTH)
    padded = np.broadcast_to(np.arange(STATES, dtype=np.uint8), (rows * _WIDTH, STATES)).copy()
    padded[:n] = functions
    block = padded.reshape(rows, _WIDTH, STATES)
    whole = block[:, 0]
    for t in range(1, _WIDTH):
        whole = np.take_along_axis(block[:, t], whole.astype(np.intp), axis=1)
    state, out, at = _states_before(whole), np.empty((rows, _WIDTH), np.uint8), np.arange(rows)
    for t in range(_WIDTH):
        out[:, t] = state
        state = block[at, t, state]
    return out.ravel()[:n]


def boundaries(points: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Positions of the code points at which a piece begins."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = kinds(points, off)
    rows = -(-n // _WIDTH)
    grid = np.full(rows * _WIDTH, NOTHING, np.intp)
    grid[:n] = kind
    grid = np.ascontiguousarray(grid.reshape(rows, _WIDTH).T) * STATES
    flat, begins = TO.ravel().astype(np.intp), BEGINS.ravel()
    whole = flat[grid[0][:, None] + np.arange(STATES)]
    for t in range(1, _WIDTH):
        whole = flat[grid[t][:, None] + whole]
    state = _states_before(whole.astype(np.uint8)).astype(np.intp)
    found = np.empty((_WIDTH, rows), bool)
    for t in range(_WIDTH):
        at = grid[t] + state
        found[t] = begins[at]
        state = flat[at]
    return np.flatnonzero(found.T.ravel()[:n])
