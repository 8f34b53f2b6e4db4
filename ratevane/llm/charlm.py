"""Interpolated modified Kneser-Ney models of characters, as sorted arrays of n-gram hashes."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import session
from .textbuf import chunks, mix

ORDER = 4
BLANK = 32
#: Bytes of text whose windows one step counts.
STEP_BYTES = 1 << 19
_STEP = np.uint64(0x100000001B3)


@lru_cache(1)
def folded() -> np.ndarray:
    """Of every code point: its lower-case letter, or a blank for all that isn't a letter."""
    out = np.full(0x110000, BLANK, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if unicodedata.category(ch)[0] == "L":
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def letters(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters of a chunk's texts with one blank between words and where non-letters follow the last, and the number of each one's text."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), "<u4")
    first = (data & 0xC0) != 0x80
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum(first, out=total[1:])
    doc = np.repeat(np.arange(len(off) - 1), np.diff(total[off]))
    x = folded()[points]
    letter = x != BLANK
    keep = letter.copy()
    keep[1:] |= letter[:-1] & (doc[1:] == doc[:-1])
    return x[keep], doc[keep]


def grams(x: np.ndarray, doc: np.ndarray, order: int = ORDER) -> list[np.ndarray]:
    """Hashes of the last 0, 1, ... `order` characters up to each place; before a text's start stand blanks."""
    at = np.arange(len(x))
    begin = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(x) else at
    inside = at - np.repeat(begin, np.diff(np.append(begin, len(x))))
    out, value, power = [np.zeros(len(x), np.uint64)], np.zeros(len(x), np.uint64), np.ones(1, np.uint64)
    for k in range(order):
        c = np.concatenate([np.full(min(k, len(x)), BLANK, np.uint32), x[: max(0, len(x) - k)]])
        c[inside < k] = BLANK
        value = value + (c.astype(np.uint64) + np.uint64(1)) * power
        power = power * _STEP
        out.append(mix(value + np.uint64(k)))
    return out


def amounts(n: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney's amounts taken off counts of 0, 1, 2 and 3 or more, from how many counts are 1, 2, 3 and 4."""
    n = np.asarray(n, float)
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    return np.array([0.0, *(min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.1), k - 0.05) if n[k - 1] else 0.5 for k in (1, 2, 3))])


def discounts(counts: np.ndarray) -> np.ndarray:
    """amounts() of counts."""
    return amounts(np.array([(counts == k).sum() for k in range(1, 5)]))


@dataclass
class Level:
    """n-grams of one order: sorted hashes, log10 probabilities, hashes without the first and without the last character; all contexts and their log10 back-off weights."""

    keys: np.ndarray
    logp: np.ndarray
    suffix: np.ndarray
    before: np.ndarray
    contexts: np.ndarray
    weight: np.ndarray


def windows(x: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(older two, newer two, uses) of the distinct runs of ORDER characters: two characters in an integer, blanks before a text's start."""
    at = np.arange(len(x))
    begin = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(x) else at
    inside = at - np.repeat(begin, np.diff(np.append(begin, len(x))))
    pair = np.zeros((2, len(x)), np.int64)
    for k in range(ORDER):
        c = np.concatenate([np.full(min(k, len(x)), BLANK, np.uint32), x[: max(0, len(x) - k)]]).astype(np.int64)
        c[inside < k] = BLANK
        pair[1 - k // 2] |= c << (21 * (k % 2))
    order = np.lexsort((pair[1], pair[0]))
    old, new = pair[0][order], pair[1][order]
    first = np.ones(len(x), bool)
    first[1:] = (old[1:] != old[:-1]) | (new[1:] != new[:-1])
    rows = np.flatnonzero(first)
    return old[rows], new[rows], np.diff(np.append(rows, len(x)))


def hashed(back: list[np.ndarray]) -> list[np.ndarray]:
    """Hashes of the last 0, 1, 2, ... characters of runs given by their last character, the one before it, and so on: those of grams()."""
    value, power = np.zeros(len(back[0]) if back else 1, np.uint64), np.ones(1, np.uint64)
    out = [np.zeros(len(value), np.uint64)]
    for k, c in enumerate(back):
        value = value + (c.astype(np.uint64) + np.uint64(1)) * power
        power = power * _STEP
        out.append(mix(value + np.uint64(k)))
    return out


def train_windows(old: np.ndarray, new: np.ndarray, uses: np.ndarray, alphabet: int, order: int = ORDER) -> list[Level]:
    """Levels of order 1 to `order`, from distinct windows(). Orders below the top count the distinct characters before an n-gram, not its uses.

    Memory follows the distinct windows, not the text.
    """
    mask = (1 << 21) - 1
    back = [new & mask, new >> 21, old & mask, old >> 21][:order]
    seen = hashed(back)
    before = [np.zeros(len(old), np.uint64), *hashed(back[1:])]  # of order k: hash of the k - 1 characters before the last
    keys, index, inverse = np.unique(seen[order], return_index=True, return_inverse=True)
    stack = [(order, keys, index, np.bincount(inverse, weights=uses, minlength=len(keys)).astype(np.int64))]
    for k in range(order - 1, 0, -1):
        at = index
        keys, rep, count = np.unique(seen[k][at], return_index=True, return_counts=True)
        index = at[rep]
        stack.append((k, keys, index, count))
    levels: list[Level] = []
    for k, keys, index, count in reversed(stack):
        d = discounts(count)
        off = d[np.minimum(count, 3)]
        ctx, inverse = np.unique(before[k][index], return_inverse=True)
        total = np.bincount(inverse, weights=count, minlength=len(ctx))
        weight = np.bincount(inverse, weights=off, minlength=len(ctx)) / total
        if k == 1:
            lower = np.full(len(keys), 1.0 / alphabet)
        else:
            lower = 10.0 ** levels[-1].logp[np.searchsorted(levels[-1].keys, seen[k - 1][index])]
        p = (count - off) / total[inverse] + weight[inverse] * lower
        levels.append(Level(keys, np.log10(p), seen[k - 1][index], before[k][index], ctx, np.log10(np.maximum(weight, 1e-12))))
    return levels


def train(x: np.ndarray, doc: np.ndarray, alphabet: int, order: int = ORDER) -> list[Level]:
    """train_windows() of one stream of characters."""
    return train_windows(*windows(x, doc), alphabet, order) if len(x) else []


def counted_windows(texts: DataFrame, group: str) -> DataFrame:
    """(group, old, new, uses): the distinct windows of all texts of each group, summed per step of text, per partition and by a shuffle."""
    session(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            names, codes = np.unique(np.array(batch.column(0).to_pylist(), object).astype(str), return_inverse=True)
            for g, name in enumerate(names.tolist()):
                for _, _, data, off in chunks(batch.column(1).filter(pa.array(codes == g)), STEP_BYTES):
                    old, new, uses = windows(*letters(data, off))
                    yield pa.record_batch([pa.array([name] * len(old), pa.string()), pa.array(old), pa.array(new), pa.array(uses.astype(np.int64))], names=["group", "old", "new", "uses"])

    flat = texts.select(F.col(group).cast("string").alias("group"), "text").mapInArrow(run, "group string, old bigint, new bigint, uses bigint")
    return flat.groupBy("group", "old", "new").agg(F.sum("uses").alias("uses"))


def fitted(texts: DataFrame, group: str, alphabet: int) -> dict[str, list[Level]]:
    """The levels of each group's texts. The driver gets the distinct windows alone, whose number the characters of the sample bound."""
    table = counted_windows(texts, group).toArrow()
    names, out = table["group"].to_numpy(zero_copy_only=False).astype(str), {}
    for name in np.unique(names).tolist():
        at = np.flatnonzero(names == name)
        out[name] = train_windows(*(table[c].to_numpy()[at] for c in ("old", "new", "uses")), alphabet)
    return out


def find(keys: np.ndarray, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of `query` in sorted `keys`, which are there)."""
    if not len(keys):
        return np.zeros(len(query), np.int64), np.zeros(len(query), bool)
    at = np.searchsorted(keys, query)
    at[at == len(keys)] = 0
    return at, keys[at] == query


class Mixture:
    """Models of several classes over one set of sorted hash arrays: a row per n-gram that any class has seen, a column per class."""

    def __init__(self, models: list[list[Level]], alphabet: int) -> None:
        self.alphabet, self.order, n = alphabet, len(models[0]), len(models)
        self.keys, self.logp, self.contexts, self.weight = [], [], [], []
        for k in range(self.order):
            keys, first = np.unique(np.concatenate([m[k].keys for m in models]), return_index=True)
            suffix, before = (np.concatenate([getattr(m[k], name) for m in models])[first] for name in ("suffix", "before"))
            contexts = np.unique(np.concatenate([m[k].contexts for m in models]))
            logp, weight = np.full((len(keys), n), np.nan, np.float32), np.zeros((len(contexts), n), np.float32)
            for c, m in enumerate(models):
                logp[np.searchsorted(keys, m[k].keys), c] = m[k].logp
                weight[np.searchsorted(contexts, m[k].contexts), c] = m[k].weight
            lower = self.logp[-1][np.searchsorted(self.keys[-1], suffix)] if k else np.full((len(keys), n), -np.log10(alphabet), np.float32)
            logp = np.where(np.isnan(logp), weight[np.searchsorted(contexts, before)] + lower, logp)  # what a class hasn't seen backs off
            self.keys.append(keys)
            self.logp.append(logp)
            self.contexts.append(contexts)
            self.weight.append(weight)

    def score(self, x: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """log10 probability of each character under each class."""
        n = self.logp[0].shape[1]
        out = np.zeros((len(x), n), np.float32)
        if not len(x):
            return out
        seen = grams(x, doc, self.order)
        start = grams(np.full(1, BLANK, np.uint32), np.zeros(1, np.int64), self.order)
        begins = np.concatenate([[True], doc[1:] != doc[:-1]])
        rows = np.arange(len(x))
        for k in range(self.order, 0, -1):
            at, there = find(self.keys[k - 1], seen[k][rows])
            if k == self.order and there.all():
                return self.logp[k - 1][at]
            out[rows[there]] += self.logp[k - 1][at[there]]
            rows = rows[~there]
            if not len(rows):
                return out
            previous = np.where(begins[rows], start[k - 1][0], seen[k - 1][rows - 1])
            at, there = find(self.contexts[k - 1], previous)
            out[rows[there]] += self.weight[k - 1][at[there]]
        out[rows] -= np.float32(np.log10(self.alphabet))
        return out
