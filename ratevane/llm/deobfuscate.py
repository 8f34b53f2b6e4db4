"""A noisy channel for disguised words: a lattice of what each character may stand for, decoded by Viterbi under a character model."""

from __future__ import annotations

import numpy as np

from .charlm import _STEP, BLANK, Mixture, folded
from .textbuf import mix

#: What a sign may stand for inside a word.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "¡": "i", "§": "s"}
#: Of those, signs that often just follow a word: they count only before a letter.
TRAILING = "!|+("
#: log10 costs: of a letter written as a sign, of a sign that is none, of a gap inside a word, of a letter said again.
SIGN, NO_SIGN, GAP, AGAIN = 0.6, 2.0, 0.25, 0.3
#: Readings that end in other letters count too if they are at most this much less likely than the best one (log10).
WITHIN = 2.0
#: Letters of a piece of a word that is cut by white space; a word of more is read as a word.
PIECE = 2
#: Strings and transitions that a decoder remembers; no result depends on it.
REMEMBERED = 100_000

_LETTER, _SIGN, _TRAIL = 1, 2, 4


def _flags() -> np.ndarray:
    out = np.where(folded() != BLANK, _LETTER, 0).astype(np.uint8)
    for c in LEET:
        out[ord(c)] |= _SIGN | (_TRAIL if c in TRAILING else 0)
    return out


_cache: dict[str, np.ndarray] = {}


def flags() -> np.ndarray:
    if "flags" not in _cache:
        _cache["flags"] = _flags()
    return _cache["flags"]


def suspects(points: np.ndarray, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first code point, one after the last, text) of what may be a disguised word, of words (white space apart) as code points.

    A sign next to a letter, a letter twice in a row, a letter after a mark and another letter, or several words of PIECE letters at most in a row.
    """
    n = len(points)
    if not len(starts):
        return starts, ends, doc
    kind = flags()[points]
    letter = (kind & _LETTER) > 0
    sign = (kind & _SIGN) > 0
    left, right = np.append(False, letter[:-1]), np.append(letter[1:], False)
    # a neighbour in another word is none: white space stands between, which is no letter
    mark = sign & (right | (left & ((kind & _TRAIL) == 0)))
    lower = folded()[points]
    again = np.append(False, letter[1:] & (lower[1:] == lower[:-1]))
    again[starts] = False  # the letter before is in another text
    mark |= again
    said = np.zeros(n + 1, np.int64)
    np.cumsum(letter, out=said[1:])
    before = np.zeros(n, np.int64)  # letters ahead of the word that a code point is in
    before[starts] = np.diff(said[starts], prepend=0)
    mark[1:] |= letter[1:] & ~letter[:-1] & (said[1:-1] > np.cumsum(before)[1:])
    total = np.zeros(n + 1, np.int64)
    np.cumsum(mark, out=total[1:])
    hit = np.flatnonzero(total[ends] > total[starts])
    count = np.zeros(n + 1, np.int64)
    np.cumsum(letter | sign, out=count[1:])
    read = count[ends] - count[starts]
    short = (read > 0) & (read <= PIECE) & (ends - starts <= PIECE + 1)
    joined = short[1:] & short[:-1] & (doc[1:] == doc[:-1])  # a short word and the next one
    first, last = np.flatnonzero(np.append(joined, False) & ~np.append(False, joined)), np.flatnonzero(np.append(False, joined) & ~np.append(joined, False))
    return np.concatenate([starts[hit], starts[first]]), np.concatenate([ends[hit], ends[last]]), np.concatenate([doc[hit], doc[first]])


def _outline() -> np.ndarray:
    """Of every code point: what all letters and signs that may be read alike have in common, or 0 where it may be left out."""
    out = np.where(folded() != BLANK, folded(), 0).astype(np.uint32)
    for read in LEET.values():  # letters of one sign are one, whichever else they share
        codes = {int(out[ord(c)]) for c in read}
        out[np.isin(out, list(codes))] = min(codes)
    for c, read in LEET.items():
        out[ord(c)] = out[ord(read[0])]
    return out


class Outlines:
    """Tells which strings may be read as a word, or a word's beginning, of a set: none that may is missed.

    A character of a word that is read is a letter or sign of the same outline, a letter said again, or left out. So the outlines of a string
    that can be read so, less repeats, hold those of the word in a row. The first LONGEST of these are looked for, by hashes.
    """

    LONGEST, BITS = 8, 22

    def __init__(self, words: list[str]) -> None:
        self.three, self.table = np.zeros(1 << 15, bool), np.zeros(1 << self.BITS, bool)
        for word in words:
            code, _ = self._of(np.frombuffer(word.encode("utf-32-le"), "<u4"))
            small = (code & np.uint32(31)).astype(np.int64)
            at = np.int64(0)
            for c in small[:3]:
                at = at << 5 | c
            spare = 5 * max(0, 3 - len(small))
            self.three[at << spare : (at + 1) << spare] = True
            value = np.zeros(1, np.uint64)
            for c in code[: self.LONGEST]:
                value = self._next(value, c)
            self.table[self._slot(value, min(len(code), self.LONGEST))] = True

    @staticmethod
    def _of(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(outlines less repeats, how many of them begin up to each code point)."""
        if "outline" not in _cache:
            _cache["outline"] = _outline()
        code = _cache["outline"][points]
        kept = np.flatnonzero(code)
        own = code[kept]
        new = np.ones(len(own), bool)
        new[1:] = own[1:] != own[:-1]
        mark = np.zeros(len(points), bool)
        mark[kept[new]] = True
        return own[new], np.cumsum(mark)

    @staticmethod
    def _next(value: np.ndarray, code: np.ndarray) -> np.ndarray:
        return value * _STEP + np.uint64(1) + code.astype(np.uint64)

    def _slot(self, value: np.ndarray, length: int) -> np.ndarray:
        return (mix(value + np.uint64(length)) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def may_hold(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Of each span of code points: whether it may be read as a word of the set."""
        code, number = self._of(points)
        wide = np.concatenate([code, np.zeros(self.LONGEST, np.uint32)])
        small = (wide & np.uint32(31)).astype(np.int64)
        n = len(code)
        at = np.flatnonzero(self.three[small[:n] << 10 | small[1 : n + 1] << 5 | small[2 : n + 2]])
        there, value = np.zeros(len(at), bool), np.zeros(len(at), np.uint64)
        for k in range(self.LONGEST):
            value = self._next(value, wide[at + k])
            there |= self.table[self._slot(value, k + 1)]
        total = np.zeros(n + 1, np.int64)
        total[at[there] + 1] = 1
        total = np.cumsum(total)
        # a span's first outline may have begun before it
        return total[number[ends - 1]] > total[np.maximum(number[starts] - 1, 0)]


_ALL = (1 << 64) - 1


def _mixed(x: int) -> int:
    """textbuf.mix() of one integer."""
    x ^= x >> 31
    x = x * 0x7FB5D329728EA185 & _ALL
    x ^= x >> 27
    x = x * 0x81DADEF4BC2DD44D & _ALL
    return x ^ x >> 33


class Decoder:
    """Viterbi decoding with memory: of transitions of the character model, and of whole strings."""

    def __init__(self, model: Mixture) -> None:
        self.model, self.step, self.known = model, {}, {}
        self.grams = [dict(zip(k.tolist(), p[:, 0].tolist(), strict=True)) for k, p in zip(model.keys, model.logp, strict=True)]
        self.weights = [dict(zip(k.tolist(), w[:, 0].tolist(), strict=True)) for k, w in zip(model.contexts, model.weight, strict=True)]
        self.unseen = -float(np.log10(model.alphabet))

    def _hashes(self, last_first: list[int]) -> list[int]:
        """Hashes of the last 0, 1, 2, ... characters, as charlm.grams() has them."""
        out, value, power = [0], 0, 1
        for k, c in enumerate(last_first):
            value += (c + 1) * power
            power = power * int(_STEP) & _ALL
            out.append(_mixed(value + k & _ALL))
        return out

    def _probability(self, key: str) -> float:
        """log10 probability of a string's last character after the others, one by one where Mixture.score() has arrays."""
        back = [ord(v) for v in reversed(key)]
        own, before, total = self._hashes(back), self._hashes(back[1:]), 0.0
        for k in range(len(back), 0, -1):
            found = self.grams[k - 1].get(own[k])
            if found is not None:
                return total + found
            total += self.weights[k - 1].get(before[k - 1], 0.0)
        return total + self.unseen

    def logp(self, context: str, c: str) -> float:
        key = context + c
        value = self.step.get(key)
        if value is None:
            if len(self.step) > REMEMBERED:
                self.step.clear()
            value = self.step[key] = self._probability(key)
        return value

    def restore(self, text: str) -> list[str]:
        """The words of the likeliest readings of `text`, best first, less those that stand in it undisguised."""
        found = self.known.get(text)
        if found is None:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            plain = set(folded()[np.frombuffer(text.encode("utf-32-le"), "<u4")].tobytes().decode("utf-32-le").split(" "))
            found = self.known[text] = [w for w in self._viterbi(text) if w not in plain]
        return found

    def arcs(self, text: str, i: int) -> list[tuple[str, float]]:
        """(what the i-th character may stand for, cost): a letter, a blank, or nothing."""
        ch = text[i]
        low = chr(folded()[ord(ch)])
        if low != " ":
            return [(low, 0.0)]
        out = [(c, SIGN) for c in LEET.get(ch, "")]
        out.append((" ", NO_SIGN if ch in LEET else 0.0))
        if ch not in LEET and 0 < i < len(text) - 1:
            out.append(("", GAP))
        return out

    def _viterbi(self, text: str) -> list[str]:
        """All states stay: a state is what was read last, as long as the model's contexts, so each character has few."""
        memory = self.model.order - 1
        states: dict[str, tuple[float, tuple | None]] = {" " * memory: (0.0, None)}  # what was read last: (log10 probability, (what was read before, letter))
        for i in range(len(text)):
            arcs = self.arcs(text, i)
            nxt: dict[str, tuple[float, tuple | None]] = {}
            for context, (value, read) in states.items():
                for c, cost in arcs:
                    if c == "" or (c == " " and context[-1] == " "):
                        options = ((context, value - cost, read),)
                    else:
                        step = ((context + c)[-memory:], value - cost + self.logp(context, c), (read, c))
                        options = (step, (context, value - cost - AGAIN, read)) if c != " " and context[-1] == c else (step,)
                    for state, v, r in options:
                        if state not in nxt or nxt[state][0] < v:
                            nxt[state] = (v, r)
            states = nxt
        ends = sorted(((v + (self.logp(c, " ") if c[-1] != " " else 0.0), c, r) for c, (v, r) in states.items()), key=lambda e: (-e[0], e[1]))
        found: dict[str, None] = {}
        for v, _, read in ends:
            if v > ends[0][0] - WITHIN:
                letters = []
                while read is not None:
                    read, c = read
                    letters.append(c)
                found |= dict.fromkeys("".join(reversed(letters)).split())
        return list(found)
