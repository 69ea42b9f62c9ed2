"""Pre-tokenisation without regular expressions: codepoint classes, then a scan of transition functions.

Every codepoint belongs to a class, every class is a function from state to state. Function composition is
associative, so the states of a long text come from a scan: the text is laid out in rows, all rows are
composed side by side, the row functions are scanned in turn, and each row is then replayed from its
start state. The functions that compositions can reach are few; they are numbered once and composed by table.

Two splitters are built from the same states, see `Splitter`:
* "spaced": contractions, letters, numbers or others, each with one blank in front, and white space;
* "plain": contractions, letters, single digits and others; white space is dropped.
"""

import unicodedata
from functools import lru_cache

import numpy as np

# classes of codepoints; FIRST is added for the first codepoint of a text
BLANK, WHITE, APOSTROPHE, ONE, NEEDS_E, E, EL, LETTER, NUMBER, OTHER = range(10)
FIRST = 10
# states: what the codepoint read last belongs to. LEAD: an apostrophe that may begin a contraction;
# DONE: the end of a contraction; HALF_E, HALF_L: the first of two letters, to be told by the next one
S_WHITE, S_BLANK, S_LETTER, S_NUMBER, S_OTHER, S_LEAD, S_DONE, S_HALF_E, S_HALF_L, S_DONE_2 = range(10)
_LETTERS = {ONE, NEEDS_E, E, EL, LETTER}
# White_Space of the Unicode character database (fixed values)
_WHITE_SPACE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(maxsize=1)
def codepoint_classes() -> np.ndarray:
    """The class of each of the 1,114,112 codepoints, from the Unicode categories."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
    out[_WHITE_SPACE] = WHITE
    out[ord(" ")] = BLANK
    out[ord("'")] = APOSTROPHE
    for letters, kind in (("stmd", ONE), ("rv", NEEDS_E), ("e", E), ("l", EL)):
        for letter in letters:
            out[ord(letter)] = kind
    return out


def _next(state: int, kind: int) -> int:
    if kind == BLANK:
        return S_BLANK
    if kind == WHITE:
        return S_WHITE
    if kind == NUMBER:
        return S_NUMBER
    if kind == OTHER:
        return S_OTHER
    if kind == APOSTROPHE:
        return S_OTHER if state in (S_OTHER, S_LEAD, S_BLANK) else S_LEAD
    if state == S_LEAD:
        return {ONE: S_DONE, NEEDS_E: S_HALF_E, EL: S_HALF_L}.get(kind, S_LETTER)
    if (state, kind) in ((S_HALF_E, E), (S_HALF_L, EL)):
        return S_DONE_2
    return S_LETTER


class Splitter:
    """Token starts of many texts at once."""

    ROW = 128

    def __init__(self, spaced: bool):
        self.spaced = spaced
        states = range(10)
        # a blank that is dropped takes no part in what follows
        before = (lambda s: S_WHITE if s == S_BLANK and not spaced else s)
        functions = [tuple(_next(before(s), k) for s in states) for k in range(10)]
        functions += [tuple(_next(S_WHITE, k) for _ in states) for k in range(10)]
        known, order = {f: i for i, f in enumerate(dict.fromkeys(functions))}, list(dict.fromkeys(functions))
        done = 0
        while done < len(order):
            f = order[done]
            for g in functions:
                h = tuple(g[f[s]] for s in states)
                if h not in known:
                    known[h] = len(order)
                    order.append(h)
            done += 1
        self.apply = np.array(order, np.uint8)                                   # function, state -> state
        self.number = np.array([known[f] for f in functions], np.uint16)         # class -> function
        # function, class -> function that also reads that class; both tables flat, numbers times the width
        self.width = len(functions)
        self.then = np.array([known[tuple(g[f[s]] for s in states)] for f in order for g in functions],
                             np.uint16) * self.width
        self.step = np.array([f[s] for s in states for f in functions], np.uint8) * self.width

    def states(self, kinds: np.ndarray) -> np.ndarray:
        """The state after each codepoint."""
        n = len(kinds)
        if not n:
            return np.empty(0, np.uint8)
        rows = -(-n // self.ROW)
        grid = np.full(rows * self.ROW, FIRST + WHITE, np.uint8)
        grid[:n] = kinds
        grid = np.ascontiguousarray(grid.reshape(rows, self.ROW).T)
        whole = self.number[grid[0]] * self.width
        for j in range(1, self.ROW):
            whole = self.then.take(whole + grid[j])
        starts, state = np.empty(rows, np.uint8), S_WHITE
        at_state = self.apply[whole // self.width].tolist()
        for i, f in enumerate(at_state):
            starts[i] = state
            state = f[state]
        out, now = np.empty((self.ROW, rows), np.uint8), starts * self.width
        for j in range(self.ROW):
            now = self.step.take(now + grid[j])
            out[j] = now
        return np.ascontiguousarray(out.T).reshape(-1)[:n] // self.width

    def split(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Byte starts and byte ends of all tokens, and the index of the first token of each text (n + 1)."""
        heads = np.arange(len(data)) if not len(data) or data.max() < 0x80 else np.flatnonzero((data & 0xC0) != 0x80)
        n = len(heads)
        first = np.searchsorted(heads, ends)                    # codepoint index of each text's begin
        if not n:
            return heads, heads, np.zeros(len(ends), np.int64)
        points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = codepoint_classes()[points]
        begins = np.zeros(n + 1, bool)
        begins[first] = True
        plain = kinds.copy()
        kinds[begins[:n]] += FIRST
        state = self.states(kinds)
        white = plain <= WHITE
        prev_state = np.empty(n, np.uint8)
        prev_state[0], prev_state[1:] = S_WHITE, state[:-1]
        prev_white = np.empty(n, bool)
        prev_white[0], prev_white[1:] = True, white[:-1]
        last = begins[1:]                                       # last codepoint of its text
        next_white = np.empty(n, bool)
        next_white[-1], next_white[:-1] = False, white[1:]
        next_done = np.empty(n, bool)
        next_done[-1], next_done[:-1] = False, state[1:] == S_DONE_2
        # a state that differs from the one before begins a token, but for what belongs to a contraction
        start = (state != prev_state) & (state != S_DONE) & (state != S_DONE_2)
        start &= ~((state == S_OTHER) & (prev_state == S_LEAD))
        halves = (state == S_HALF_E) | (state == S_HALF_L)
        start &= ~(halves & next_done)
        start &= ~((state == S_LETTER) & ((prev_state == S_HALF_E) | (prev_state == S_HALF_L)))
        start |= state == S_LEAD                                # also right after a contraction
        if self.spaced:
            inner = white & prev_white & ~begins[:n]
            start[inner] = (~next_white & ~last)[inner]         # the last of several blanks stands apart
            start &= ~(~white & (prev_state == S_BLANK) & ~begins[:n])
        else:
            start |= state == S_NUMBER
            start &= ~white
        start[begins[:n]] = True if self.spaced else ~white[begins[:n]]
        at = np.flatnonzero(start)
        edges = np.append(heads, len(data))
        if self.spaced:
            stop = np.append(at[1:], n)
        else:                                                   # a token ends where white space or another one begins
            breaks = np.append(np.flatnonzero(start | white | begins[:n]), n)
            stop = breaks[np.searchsorted(breaks, at, side="right")]
        return edges[at], edges[stop], np.searchsorted(at, first)


@lru_cache(maxsize=2)
def splitter(spaced: bool) -> Splitter:
    return Splitter(spaced)
