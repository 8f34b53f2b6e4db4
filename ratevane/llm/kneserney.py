"""Interpolated modified Kneser-Ney trigrams of words: counted in Spark, stored as sorted arrays, memory-mapped by workers.

A first pass gathers the distinct words, as 64-bit hashes, at owners of hash ranges, which number them: from then on a word is its
number, so n-grams are told apart exactly and in few bits. A second pass brings each trigram to the owner of its middle word, so an owner
sees all of its trigrams' contexts, and all that stands around a middle word: it has the third level whole, and counts the distinct words
before each bigram for the second. What the first level needs, the distinct words before a word, adds up over owners and goes to the
words' owners by a second, small shuffle. Middle words too frequent for one owner, which the first pass has counted, are dealt over
several owners by the word before; the partial counts of their bigrams are added up by the second shuffle.

An owner writes its arrays to the shared folder, one file a level; workers map them, so that what they score with is in no heap and is
shared by all workers of a machine.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .charlm import amounts
from .frames import session, shared_dir, slim
from .shelf import load, lower_bound, save
from .textbuf import chunks, lowered, mix, span_hashes, word_spans

#: The hash of a text's end, and the number that stands before a text's first word; words have numbers from 1 on.
END, BEGIN = np.uint64(0x13198A2E03707344), 0
#: Owners at most: 2 to the power of this.
MOST_BITS = 17
#: Tokens that a counting task gathers before it sends their distinct trigrams on.
FLUSH_TOKENS = 2_200_000
#: Bytes of text that one vectorised step of scoring handles.
SCORE_BYTES = 4 << 20
#: A word with this share of an owner's fair part is dealt over several owners.
HOT = 0.5
#: Entries of a context whose sums aren't stored but added up when asked for.
SHORT = 8
_STEP = np.uint64(0x9E3779B97F4A7C15)
_ROW = "kind int, owner int, tag int, n int, major binary, older binary, minor binary, count binary"
_NAMES = [x.split()[0] for x in _ROW.split(", ")]
_KINDS = [pa.int32()] * 4 + [pa.binary()] * 4
#: Kinds of rows and files: counts of counts, words before words, bigrams of frequent words, trigrams, other bigrams, the vocabulary.
STATS, WORDS, FREQUENT, TRIGRAMS, BIGRAMS, VOCABULARY = range(6)
#: What a row of words has: how many words stand before each, or bigrams whose first word is frequent.
BEFORE, PAIRS = range(2)


def tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of each text's lower-case words and its end."""
    low = lowered(data)
    start, end, doc = word_spans(low, off)
    n = len(off) - 1
    words = np.bincount(doc, minlength=n)
    out = np.full(len(doc) + n, END, np.uint64)
    out[np.arange(len(doc)) + doc] = span_hashes(low, start, end)
    return out, np.repeat(np.arange(n), words + 1)


def back(token: np.ndarray, doc: np.ndarray, k: int, begin: object) -> np.ndarray:
    """The token k places back; before a text's first stands `begin`."""
    out = np.full(len(token), begin, token.dtype)
    out[k:] = token[:-k] if k < len(token) else token[:0]
    out[k:][doc[k:] != doc[: max(0, len(token) - k)]] = begin
    return out


def runs(*keys: np.ndarray) -> np.ndarray:
    """Where each run of equal rows of sorted keys begins."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def summed(count: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.add.reduceat(count, at) if len(at) else count[:0]


def squeezed(raw: bytes) -> bytes:
    return pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)


def planes(x: np.ndarray) -> bytes:
    """An array's first bytes, then its second ones, and so on, compressed: what numbers have in common is in few bytes."""
    return squeezed(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes())


def rising(x: np.ndarray) -> bytes:
    """planes() of the differences, which are small where `x` rises."""
    return planes(np.diff(x, prepend=x.dtype.type(0)))


def unplanes(data: bytes, kind: type, n: int) -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = pa.Codec("zstd").decompress(data, n * width, asbytes=True) if data else b""
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, n).T).view(kind).ravel() if data else np.zeros(0, kind)


def unrising(data: bytes, kind: type, n: int) -> np.ndarray:
    return np.cumsum(unplanes(data, kind, n), dtype=kind)


def listed(x: np.ndarray) -> bytes:
    """Numbers that repeat: the distinct ones in order, and the place of each in them."""
    values, at = np.unique(x, return_inverse=True)
    first, places = rising(values), planes(at.astype(np.uint16 if len(values) <= 1 << 16 else np.uint32))
    return np.array([len(values), len(first)], "<u4").tobytes() + first + places


def unlisted(data: bytes, kind: type, n: int) -> np.ndarray:
    if not data:
        return np.zeros(0, kind)
    distinct, size = np.frombuffer(data[:8], "<u4").tolist()
    return unrising(data[8 : 8 + size], kind, distinct)[unplanes(data[8 + size :], np.uint16 if distinct <= 1 << 16 else np.uint32, n)]


def top(x: np.ndarray, bits: int) -> np.ndarray:
    return (mix(x.astype(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


def ordered(major: np.ndarray, minor: np.ndarray) -> np.ndarray:
    """The rows of two columns in order; numbers of 32 bits are compared as one."""
    if major.dtype.itemsize <= 4 and minor.dtype.itemsize <= 4:
        return np.argsort(major.astype(np.uint64) << np.uint64(32) | minor)
    return np.lexsort((minor, major))


def pairs(major: np.ndarray, minor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a row of each distinct pair, in their order; the place of each row's pair among them)."""
    order = ordered(major, minor)
    at = runs(major[order], minor[order])
    which = np.empty(len(order), np.uint32)
    which[order] = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(order))))
    return order[at], which


class Words:
    """The vocabulary: sorted hashes of each owner, a file each; a word's number is its owner's first one and its place there."""

    def __init__(self, folder: str, bits: int, sizes: np.ndarray, tokens: int) -> None:
        self.folder, self.bits, self.tokens = folder, bits, tokens
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64) + 1
        self.distinct = int(self.first[-1]) - 1
        self.kind = np.uint32 if self.distinct < (1 << 32) - 2 else np.uint64
        self.unknown = np.iinfo(self.kind).max

    def numbers(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, uses) of distinct hashes; one that isn't in the vocabulary has `unknown` and no use."""
        number, uses = np.full(len(word), self.unknown, self.kind), np.zeros(len(word), np.int64)
        for o, rows in dealt(top(word, self.bits)):
            if self.first[o] < self.first[o + 1]:
                a = _mapped(f"{self.folder}/{VOCABULARY}/{o}")
                at = np.searchsorted(a["major"], word[rows])
                at[at == len(a["major"])] = 0
                hit = a["major"][at] == word[rows]
                number[rows[hit]], uses[rows[hit]] = (self.first[o] + at[hit]).astype(self.kind), a["uses"][at[hit]]
        return number, uses

    def owner(self, number: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, number.astype(np.int64), "right") - 1


class Deal:
    """Who counts what: owners by the middle word, of frequent ones by the word before too; words are numbers."""

    def __init__(self, bits: int, hot: np.ndarray, parts: np.ndarray) -> None:
        self.bits, self.hot, self.parts = bits, hot, parts

    def top(self, x: np.ndarray) -> np.ndarray:
        return top(x, self.bits)

    def frequent(self, middle: np.ndarray) -> np.ndarray:
        if not len(self.hot):
            return np.zeros(len(middle), bool)
        at = np.searchsorted(self.hot, middle)
        at[at == len(self.hot)] = 0
        return self.hot[at] == middle

    def trigram(self, middle: np.ndarray, older: np.ndarray) -> np.ndarray:
        part = np.zeros(len(middle), np.uint64)
        hit = np.flatnonzero(self.frequent(middle))
        part[hit] = np.uint64(1) + mix(older[hit].astype(np.uint64)) % self.parts[np.searchsorted(self.hot, middle[hit])]
        return self.top(middle.astype(np.uint64) + part * _STEP)


def dealt(owner: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(owner, its rows in their order)."""
    if not len(owner):
        return
    order = np.argsort(owner, kind="stable")
    at = runs(owner[order])
    for o, a, b in zip(owner[order][at].tolist(), at.tolist(), np.append(at[1:], len(order)).tolist(), strict=True):
        yield o, order[a:b]


def record(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(_KINDS)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, _KINDS, strict=True)], names=_NAMES)


def blocks(docs: DataFrame, flush: Callable[[np.ndarray, np.ndarray], pa.RecordBatch], schema: str) -> DataFrame:
    """What `flush` makes of the (hash, text) of all tokens of parts of the texts (a column `text`)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = base = 0

        def out() -> pa.RecordBatch:
            word, doc = (np.concatenate(c) for c in zip(*held, strict=True))
            held.clear()
            return flush(word, doc)

        for batch in batches:
            for _, _, data, off in chunks(batch.column(0)) if batch.num_rows else ():
                word, doc = tokens(data, off)
                held.append((word, doc + base))
                base += len(off) - 1
                size += len(word)
                if size >= FLUSH_TOKENS:
                    yield out()
                    size = 0
        if held:
            yield out()

    return docs.mapInArrow(run, schema)


def vocabulary(docs: DataFrame, folder: str, bits: int) -> Words:
    """The distinct words of all texts, their ends too, and how often each stands there."""

    def flush(word: np.ndarray, doc: np.ndarray) -> pa.RecordBatch:
        distinct, uses = np.unique(word, return_counts=True)
        rows = [(o, len(s), rising(distinct[s]), planes(uses[s].astype(np.uint64))) for o, s in dealt(top(distinct, bits))]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["owner", "n", "word", "uses"])

    def own(table: pa.Table) -> pa.Table:
        owner = table["owner"][0].as_py()
        parts = [(unrising(w.as_py(), np.uint64, n.as_py()), unplanes(u.as_py(), np.uint64, n.as_py())) for n, w, u in zip(table["n"], table["word"], table["uses"], strict=True)]
        word, uses = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.argsort(word)
        at = runs(word[order])
        save(f"{folder}/{VOCABULARY}/{owner}", {"major": word[order][at], "uses": summed(uses[order], at)})
        return pa.table({"owner": pa.array([owner], pa.int32()), "distinct": pa.array([len(at)], pa.int64()), "total": pa.array([int(uses.sum())], pa.int64())})

    found = blocks(docs, flush, "owner int, n int, word binary, uses binary").groupBy("owner").applyInArrow(own, "owner int, distinct bigint, total bigint").collect()  # a row for each owner
    sizes = np.zeros(1 << bits, np.int64)
    for r in found:
        sizes[r["owner"]] = r["distinct"]
    return Words(folder, bits, sizes, sum(r["total"] for r in found))


def count_rows(docs: DataFrame, words: Words, deal: Deal) -> DataFrame:
    """Blocks of distinct trigrams of parts of the texts, a row for each owner."""

    def flush(word: np.ndarray, doc: np.ndarray) -> pa.RecordBatch:
        distinct, rank = np.unique(word, return_inverse=True)
        number, _ = words.numbers(distinct)
        order = np.argsort(number)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(1, len(order) + 1)
        number, rank = np.append(number.dtype.type(BEGIN), number[order]), place[rank]
        older, middle, w = back(rank, doc, 2, 0), back(rank, doc, 1, 0), int(len(number)).bit_length()
        if 3 * w <= 63:
            key, count = np.unique(middle << (2 * w) | older << w | rank, return_counts=True)
            middle, older, last = key >> (2 * w), key >> w & ((1 << w) - 1), key & ((1 << w) - 1)
        else:
            order = np.lexsort((rank, older, middle))
            middle, older, last = middle[order], older[order], rank[order]
            at = runs(middle, older, last)
            middle, older, last, count = middle[at], older[at], last[at], np.diff(np.append(at, len(order)))
        b, a, c, count = number[middle], number[older], number[last], count.astype(np.uint32)
        return record([(TRIGRAMS, o, 0, len(s), rising(b[s]), listed(a[s]), listed(c[s]), planes(count[s])) for o, s in dealt(deal.trigram(b, a))])

    return blocks(docs, flush, _ROW)


@lru_cache(16_384)
def _mapped(file: str) -> dict[str, np.ndarray]:
    return load(file)


def counts_of(count: np.ndarray) -> list[int]:
    """How many counts are 1, 2, 3, 4, how many 3 or more, and their sum."""
    return [*(int((count == k).sum()) for k in (1, 2, 3, 4)), int((count >= 3).sum()), int(count.sum())]


def capped(count: np.ndarray) -> dict[str, np.ndarray]:
    """Counts in a byte each; those of 255 or more stand apart."""
    over = np.flatnonzero(count >= 255)
    return {"n": np.minimum(count, 255).astype(np.uint8), "over": over.astype(np.uint64), "full": count[over].astype(np.uint64)}


def counts_at(a: dict[str, np.ndarray], at: np.ndarray) -> np.ndarray:
    n = a["n"][at].astype(np.int64)
    full = np.flatnonzero(n == 255)
    if len(full):
        n[full] = a["full"][np.searchsorted(a["over"], at[full])]
    return n


def sums(count: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """Of each run that begins at `at`: its total, and how many counts are 1, 2, and 3 or more."""
    out = {"total": summed(count, at)} | {f"n{k}": summed((count == k if k < 3 else count >= 3).astype(np.int64), at) for k in (1, 2, 3)}
    return {k: v.astype(np.uint64) for k, v in out.items()}


def third_level(middle: np.ndarray, older: np.ndarray, minor: np.ndarray, count: np.ndarray) -> dict[str, np.ndarray]:
    """Sorted distinct trigrams: where each middle word's begin, and the word before and the last word of each."""
    at = runs(middle)
    begin = runs(middle, older)
    size = np.diff(np.append(begin, len(minor)))
    long = size > SHORT
    out = {"major": middle[at], "start": np.append(at, len(middle)).astype(np.uint64), "older": older, "minor": minor, "long": begin[long].astype(np.uint64)}
    return out | {name: v[long] for name, v in sums(count, begin).items()} | capped(count)


def second_level(middle: np.ndarray, minor: np.ndarray, count: np.ndarray) -> dict[str, np.ndarray]:
    at = runs(middle) if len(middle) else np.zeros(0, np.int64)
    return {"major": middle[at], "start": np.append(at, len(middle)).astype(np.uint64), "minor": minor} | sums(count, at) | capped(count)


class Model:
    """Where the arrays are, and what holds of all of them: kept in a few hundred bytes and some for each owner."""

    def __init__(self, words: Words, deal: Deal, off: list[np.ndarray], first: tuple[float, float], there: set[tuple[int, int]]) -> None:
        self.words, self.folder, self.deal, self.off, self.first, self.there = words, words.folder, deal, off, first, there
        self.train_tokens, self.distinct = words.tokens, words.distinct

    def _parts(self, kind: int, owner: np.ndarray) -> Iterator[tuple[np.ndarray, dict[str, np.ndarray]]]:
        """For each owner asked for: the places in `owner`, and its arrays."""
        for o, rows in dealt(owner):
            if (kind, o) in self.there:
                yield rows, _mapped(f"{self.folder}/{kind}/{o}")

    def unigrams(self, token: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number, uses in the training texts, probability) of distinct tokens."""
        number, uses = self.words.numbers(token)
        kinds, known = np.zeros(len(token), np.int64), np.flatnonzero(uses)
        for part, a in self._parts(WORDS, self.words.owner(number[known])):
            rows = known[part]
            kinds[rows] = a["kinds"][number[rows].astype(np.int64) - self.words.first[self.words.owner(number[rows[:1]])]]
        total, weight = self.first
        p = np.full(len(token), 1.0 / (self.distinct + 1))
        if total:
            p = np.maximum(kinds - self.off[0][np.minimum(kinds, 3)], 0) / total + weight * p
        return number, uses, p

    def _raised(self, p: np.ndarray, rows: np.ndarray, count: np.ndarray, total: np.ndarray, n: list[np.ndarray], d: np.ndarray) -> None:
        p[rows] = (np.maximum(count - d[np.minimum(count, 3)], 0) + sum(x * y for x, y in zip(d[1:], n, strict=True)) * p[rows]) / total

    def after_one(self, middle: np.ndarray, word: np.ndarray, p: np.ndarray) -> None:
        """Probabilities of words after one word, from those after none; each distinct pair is looked for once."""
        one, which = pairs(middle, word)
        middle, word, own = middle[one], word[one], p[one]
        often = self.deal.frequent(middle)
        for kind, chosen in ((BIGRAMS, np.flatnonzero(~often)), (FREQUENT, np.flatnonzero(often))):
            for part, a in self._parts(kind, self.deal.top(middle[chosen])):
                rows = chosen[part]  # still in order, so searches that follow each other touch what is near
                at = np.searchsorted(a["major"], middle[rows])
                at[at == len(a["major"])] = 0
                hit = a["major"][at] == middle[rows]
                rows, at = rows[hit], at[hit]
                lo, hi = a["start"][at].astype(np.int64), a["start"][at + 1].astype(np.int64)
                found = lower_bound(lambda i, a=a: a["minor"][i], lo, hi, word[rows])
                count = np.zeros(len(rows), np.int64)
                there = np.flatnonzero(found < hi)
                there = there[a["minor"][found[there]] == word[rows][there]]
                count[there] = counts_at(a, found[there])
                self._raised(own, rows, count, a["total"][at].astype(np.float64), [a[f"n{k}"][at].astype(np.float64) for k in (1, 2, 3)], self.off[1])
        p[:] = own[which]

    def _context(self, a: dict[str, np.ndarray], middle: np.ndarray, older: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """Of distinct contexts in order: (which are there; where each one's words begin and end; their total; how many counts are 1, 2, and 3 or more)."""
        at = np.searchsorted(a["major"], middle)
        at[at == len(a["major"])] = 0
        live = np.flatnonzero(a["major"][at] == middle)
        lo, last = a["start"][at[live]].astype(np.int64), a["start"][at[live] + 1].astype(np.int64)
        lo = lower_bound(lambda i: a["older"][i], lo, last, older[live])
        there = np.flatnonzero(lo < last)
        there = there[a["older"][lo[there]] == older[live[there]]]
        own, lo, last = live[there], lo[there], last[there]
        hi, before = lo + 1, older[own]
        live = np.arange(len(own))
        for _ in range(SHORT):  # most contexts end soon
            live = live[hi[live] < last[live]]
            live = live[a["older"][hi[live]] == before[live]]
            hi[live] += 1
        hi[live] = lower_bound(lambda i: a["older"][i], hi[live], last[live], before[live] + before.dtype.type(1))
        total, n = np.zeros(len(own)), [np.zeros(len(own)) for _ in range(3)]
        long = np.flatnonzero(hi - lo > SHORT)
        place = np.searchsorted(a["long"], lo[long].astype(np.uint64))
        total[long] = a["total"][place]
        for k in (1, 2, 3):
            n[k - 1][long] = a[f"n{k}"][place]
        short = np.flatnonzero(hi - lo <= SHORT)
        for j in range(SHORT):
            short = short[lo[short] + j < hi[short]]
            c = counts_at(a, lo[short] + j)
            total[short] += c
            for k in (1, 2, 3):
                n[k - 1][short] += np.minimum(c, 3) == k
        return own, lo, hi, total, n

    def after_two(self, middle: np.ndarray, older: np.ndarray, word: np.ndarray, p: np.ndarray) -> None:
        """Probabilities of words after two words, from those after one; each distinct context is looked for once."""
        one, which = pairs(middle, older)
        middle, older = middle[one], older[one]
        owner = self.deal.trigram(middle, older)
        order = ordered(which, word)
        slot = np.full(len(one), -1)
        for (o, mine), (_, part) in zip(dealt(owner), dealt(owner[which[order]]), strict=True):
            if (TRIGRAMS, o) not in self.there:
                continue
            a = _mapped(f"{self.folder}/{TRIGRAMS}/{o}")
            own, lo, hi, total, n = self._context(a, middle[mine], older[mine])
            slot[mine[own]] = np.arange(len(own))
            rows = order[part]
            at = slot[which[rows]]
            rows, at = rows[at >= 0], at[at >= 0]
            want, end = word[rows], hi[at]
            found = lower_bound(lambda i, a=a: a["minor"][i], lo[at], end, want)
            count = np.zeros(len(rows), np.int64)
            there = np.flatnonzero(found < end)
            there = there[a["minor"][found[there]] == want[there]]
            count[there] = counts_at(a, found[there])
            self._raised(p, rows, count, total[at], [x[at] for x in n], self.off[2])

    def score(self, data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
        """Of each text: tokens, known tokens, base score and log10 probability."""
        token, doc = tokens(data, off)
        begin = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        distinct, inverse = np.unique(token, return_inverse=True)
        number, uses, p = self.unigrams(distinct)
        base = np.log10((uses + 0.1) / (self.train_tokens + 0.1 * (self.distinct + 1)))
        p, word = p[inverse], number[inverse]
        middle, older = back(word, doc, 1, BEGIN), back(word, doc, 2, BEGIN)
        self.after_one(middle, word, p)
        self.after_two(middle, older, word, p)
        return {"n_tokens": np.diff(np.append(begin, len(doc))), "n_known": np.add.reduceat((uses > 0)[inverse].astype(np.int64), begin), "base_score": np.add.reduceat(base[inverse], begin), "score": np.add.reduceat(np.log10(p), begin)}


def deal_for(words: Words, spark: SparkSession, hot: float = HOT) -> Deal:
    """The words, and a text's beginning, that are too frequent for one owner, as the vocabulary has counted them."""
    least = max(1.0, hot * words.tokens / (1 << words.bits))
    end = int(top(np.array([END]), words.bits)[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for o in batch.column(0).to_pylist():
                if words.first[o] == words.first[o + 1]:
                    continue
                a = load(f"{words.folder}/{VOCABULARY}/{o}")
                number, uses = words.first[o] + np.arange(len(a["major"])), a["uses"].astype(np.int64)
                if o == end and (own := np.flatnonzero(a["major"] == END)).size:  # there are as many beginnings as ends
                    number, uses = np.append(number, BEGIN), np.append(uses, uses[own])
                often = uses >= least
                yield pa.record_batch([pa.array(number[often]), pa.array(uses[often])], names=["number", "n"])

    rows = spark.range(1 << words.bits).mapInArrow(run, "number bigint, n bigint").collect()  # fewer than 2 / hot times as many as owners
    found = sorted((r["number"], -(-4 * r["n"] * (1 << words.bits) // words.tokens)) for r in rows)
    return Deal(words.bits, np.array([w for w, _ in found], words.kind), np.array([p for _, p in found], np.uint64))


def fit(docs: DataFrame, hot: float = HOT) -> Model:
    """A Model of all texts of (doc_id, text)."""
    spark = session(docs)
    folder = shared_dir(spark)
    docs = docs.select("text")
    words = vocabulary(docs, folder, min(MOST_BITS, max(4, (2 * docs.rdd.getNumPartitions() - 1).bit_length())))
    deal = deal_for(words, spark, hot)
    kind_ = words.kind

    def stats(level: int, owner: int, count: np.ndarray, more: tuple[int, ...] = ()) -> tuple:
        return STATS, owner, level, 0, b"", b"", b"", np.array([*counts_of(count), *more], np.int64).tobytes()

    def own(table: pa.Table) -> pa.Table:
        owner, parts = table["owner"][0].as_py(), []
        for row in zip(*[table[c] for c in ("n", "major", "older", "minor", "count")], strict=True):
            n, *raw = (v.as_py() for v in row)
            parts.append((unrising(raw[0], kind_, n), unlisted(raw[1], kind_, n), unlisted(raw[2], kind_, n), unplanes(raw[3], np.uint32, n).astype(np.int64)))
        major, older, minor, count = (np.concatenate(c) for c in zip(*parts, strict=True))
        del parts
        order = np.lexsort((minor, older, major))
        major, older, minor, count = major[order], older[order], minor[order], count[order]
        at = runs(major, older, minor)
        major, older, minor, count = major[at], older[at], minor[at], summed(count, at)
        rows = [stats(3, owner, count)]
        save(f"{folder}/{TRIGRAMS}/{owner}", third_level(major, older, minor, count))
        del older
        order = np.lexsort((minor, major))
        major, minor = major[order], minor[order]
        at = runs(major, minor)
        count = np.diff(np.append(at, len(major)))  # the distinct words before a bigram
        major, minor = major[at], minor[at]
        often = deal.frequent(major)
        for o, s in dealt(deal.top(major[often])):
            rows.append((FREQUENT, o, 0, len(s), rising(major[often][s]), b"", planes(minor[often][s]), planes(count[often][s].astype(np.uint64))))
        for o, s in dealt(words.owner(minor[often])):
            rows.append((WORDS, o, PAIRS, len(s), rising(major[often][s]), b"", planes(minor[often][s]), b""))
        major, minor, count = major[~often], minor[~often], count[~often]
        if len(major):
            save(f"{folder}/{BIGRAMS}/{owner}", second_level(major, minor, count))
            word, kinds = np.unique(minor, return_counts=True)
            for o, s in dealt(words.owner(word)):
                rows.append((WORDS, o, BEFORE, len(s), b"", b"", planes(word[s]), planes(kinds[s].astype(np.uint64))))
            rows.append(stats(2, owner, count))
        return pa.Table.from_batches([record(rows)])

    def finish(table: pa.Table) -> pa.Table:
        kind, owner, out = table["kind"][0].as_py(), table["owner"][0].as_py(), []
        got = [tuple(v.as_py() for v in row) for row in zip(*[table[c] for c in ("tag", "n", "major", "minor", "count")], strict=True)]
        if kind == STATS:
            out = [(tag, owner, BIGRAMS if tag == 2 else TRIGRAMS, np.frombuffer(count, np.int64).tolist()) for tag, _, _, _, count in got]
        elif kind == FREQUENT:
            parts = [(unrising(b, kind_, n), unplanes(c, kind_, n), unplanes(k, np.uint64, n).astype(np.int64)) for _, n, b, c, k in got]
            major, minor, count = (np.concatenate(c) for c in zip(*parts, strict=True))
            order = np.lexsort((minor, major))
            major, minor = major[order], minor[order]
            at = runs(major, minor)
            major, minor, count = major[at], minor[at], summed(count[order], at)
            save(f"{folder}/{FREQUENT}/{owner}", second_level(major, minor, count))
            out = [(2, owner, FREQUENT, counts_of(count))]
        else:
            kinds = np.zeros(int(words.first[owner + 1] - words.first[owner]), np.int64)
            pair = [(unrising(b, kind_, n), unplanes(c, kind_, n)) for t, n, b, c, _ in got if t == PAIRS]
            for t, n, _, c, k in got:
                if t == BEFORE:
                    kinds[unplanes(c, kind_, n).astype(np.int64) - words.first[owner]] += unplanes(k, np.uint64, n).astype(np.int64)
            if pair:  # of one frequent word and what follows it, each once
                b, c = (np.concatenate(x) for x in zip(*pair, strict=True))
                order = np.lexsort((b, c))
                at = runs(c[order], b[order])
                kinds += np.bincount(c[order][at].astype(np.int64) - words.first[owner], minlength=len(kinds))
            save(f"{folder}/{WORDS}/{owner}", {"kinds": kinds.astype(np.uint64)})
            out = [(1, owner, WORDS, counts_of(kinds))]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64())), strict=True)], names=["level", "owner", "kind", "stats"])

    counted = count_rows(docs, words, deal).groupBy("kind", "owner").applyInArrow(own, _ROW)
    rows = counted.groupBy("kind", "owner").applyInArrow(finish, "level int, owner int, kind int, stats array<bigint>").collect()  # a few rows for each owner
    total = {k: np.sum([r["stats"] for r in rows if r["level"] == k] or [[0] * 8], axis=0) for k in (1, 2, 3)}
    off = [amounts(total[k][:4]) for k in (1, 2, 3)]
    one = total[1]
    weight = (off[0][1] * one[0] + off[0][2] * one[1] + off[0][3] * one[4]) / one[5] if one[5] else 1.0
    return Model(words, deal, off, (float(one[5]), float(weight)), {(r["kind"], r["owner"]) for r in rows})


def held_out(id_col: str = "doc_id"):
    """Which rows are held out: crc32 of the id as text leaves 0 modulo 10."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 10 == 0, F.lit(False))


def score_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: float = HOT) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity) of every row, learned from those not held out.

    A null or empty text is one token, its end. A null id isn't held out. Repeated rows count and are scored each. A word never seen
    has the uniform share of the lowest level. Without training texts every token has probability 1. Other columns are ignored; no
    rows give none. `hot` is the share of an owner's fair part from which a word is dealt over several owners; no result depends on it.
    """
    session(df)
    docs = slim(df, id_col, text_col)
    model = fit(docs.where(~held_out("doc_id")), hot)

    def scored(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        made = [model.score(data, off) for _, _, data, off in chunks(table["text"], SCORE_BYTES)]
        c = {k: np.concatenate([m[k] for m in made]) for k in made[0]}
        perplexity = 10.0 ** (-c["score"] / c["n_tokens"])
        return pa.record_batch([table["doc_id"].combine_chunks(), *(pa.array(c[k]) for k in ("n_tokens", "n_known", "base_score", "score")), pa.array(perplexity)], names=["doc_id", "n_tokens", "n_known", "base_score", "score", "perplexity"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0  # texts scored together share what is looked for
        for batch in batches:
            if not batch.num_rows:
                continue
            if held and size + batch.nbytes > SCORE_BYTES:
                yield scored(held)
                held, size = [], 0
            held.append(batch)
            size += batch.nbytes
        if held:
            yield scored(held)

    done = docs.mapInArrow(run, "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double, perplexity double")
    return done.select("doc_id", held_out("doc_id").alias("held_out"), "n_tokens", "n_known", F.lit(model.train_tokens).cast("bigint").alias("train_tokens"), "base_score", "score", "perplexity")
