"""SimHash fingerprints, and their links at a few differing bits through pivot distance tables."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .frames import id_key, less, map_texts, session, slim, written
from .textbuf import SPACE, chunks, lowered, word_spans

SHINGLE_WORDS, MAX_BITS, SEED = 4, 4, 42
#: Seven blocks of bits, of which four differing bits leave at least three alone: 35 tables, each keyed by three whole blocks.
BLOCKS = tuple(sum(1 << b for b in range(64 * i // 7, 64 * (i + 1) // 7)) for i in range(7))
TABLES = tuple(sum(c) for c in combinations(BLOCKS, 7 - MAX_BITS))
#: Reference fingerprints. By the triangle inequality, two fingerprints within MAX_BITS differ by no more than that in the distance to any of them.
PIVOTS = np.random.default_rng(6).integers(0, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.arange(16, dtype=np.uint64) % np.uint64(2)
#: Buckets up to this size compare their pairs in one vectorised step; larger ones are searched breadth first.
SMALL_BUCKET = 32
#: A larger bucket is dealt anew by the bits that its key leaves, while any are left.
DEEP_BUCKET = 4096


def shingle_hashes(data: np.ndarray, off: np.ndarray, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(XXH64 of every shingle, its text's number) over a chunk of texts, in the texts' order."""
    low = lowered(data)
    start, end, doc = word_spans(low, off)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keep = ~SPACE[low]
    after = end[:-1][doc[1:] == doc[:-1]]  # one white space between words of a text becomes the blank; the others go
    keep[after] = True
    low[after] = 32
    place = np.zeros(len(low) + 1, np.int64)
    np.cumsum(keep, out=place[1:])
    joined = low[keep].tobytes()
    start, end = place[start], place[end]
    n = np.bincount(doc, minlength=len(off) - 1)
    first = np.concatenate([[0], np.cumsum(n)])[:-1]
    made = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    owner = np.repeat(np.arange(len(n)), made)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(made) - made, made)
    head = first[owner] + nth
    tail = head + np.minimum(n[owner], size) - 1
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(start[head].tolist(), end[tail].tolist(), strict=True)), np.uint64, len(head)), owner


def majority(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """For each of `n` texts the bits set in over half of its hashes; zero without any."""
    out = np.zeros(n, np.uint64)
    if len(owner):
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        begin = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        total = np.add.reduceat(bits, begin, axis=0, dtype=np.int32)
        size = np.diff(np.append(begin, len(owner)))
        out[owner[begin]] = np.packbits(2 * total > size[:, None], axis=1).view(">u8").ravel()
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, own, fp) of (doc_id, text); `own` is a hash of the text as it is."""

    def body(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [majority(*shingle_hashes(data, off), to - at) for at, to, data, off in chunks(batch.column(1))]
        return pa.record_batch([batch.column(0), batch.column(2), pa.array(np.concatenate(made).view(np.int64))], names=["doc_id", "own", "fp"])

    return map_texts(docs.select("doc_id", "text", F.xxhash64("text").alias("own")), body, "doc_id bigint, own bigint, fp bigint")


def pivot_table(fp: np.ndarray) -> np.ndarray:
    """Hamming distances of each fingerprint to every pivot."""
    return np.bitwise_count(fp[:, None] ^ PIVOTS)


def with_pivots(fps: DataFrame) -> DataFrame:
    """(fp, d0, d1): the pivot distance table, eight distances of one byte in an integer: computed once for each fingerprint and carried to wherever its pairs are judged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                table = pivot_table(batch.column(0).to_numpy().view(np.uint64)).view(np.int64)
                yield pa.record_batch([batch.column(0), *(pa.array(np.ascontiguousarray(table[:, i])) for i in range(2))], names=["fp", "d0", "d1"])

    return fps.mapInArrow(run, "fp bigint, d0 bigint, d1 bigint")


def near(fp: np.ndarray, table: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs (i, j) are within MAX_BITS: by the largest coordinate difference first, survivors by their bits."""
    alive = np.arange(len(i))
    for p in range(table.shape[1]):
        if not len(alive):
            break
        d = table[i[alive], p].astype(np.int8) - table[j[alive], p].astype(np.int8)
        alive = alive[np.abs(d) <= MAX_BITS]
    return alive[np.bitwise_count(fp[i[alive]] ^ fp[j[alive]]) <= MAX_BITS]


def search(fp: np.ndarray, table: np.ndarray, free: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is near within one large bucket: spanning forests, not all pairs. `free`: bits that may differ."""
    if len(fp) > DEEP_BUCKET:
        bits = [b for b in range(64) if free >> b & 1]
        if len(bits) > 2 * MAX_BITS:
            a, b = [], []
            for part in np.array_split(np.array(bits), MAX_BITS + 1):  # one of five parts is equal in any near pair
                mask = sum(1 << int(x) for x in part)
                key = fp & np.uint64(mask)
                order = np.argsort(key, kind="stable")
                cut = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1], [True]]))
                for s, e in zip(cut, cut[1:], strict=False):
                    if e - s > 1:
                        own = order[s:e]
                        x, y = search(fp[own], table[own], free & ~mask) if e - s < len(fp) else forest(fp, table)
                        a.append(x)
                        b.append(y)
            if not a:
                return fp[:0], fp[:0]
            return np.concatenate(a), np.concatenate(b)
    return forest(fp, table)


def forest(fp: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Breadth first: what is found leaves the set that later fingerprints are compared with, so a dense bucket is soon empty."""
    order = np.argsort(table[:, 0], kind="stable")
    fp, table = fp[order], table[order]
    left, a, b = np.arange(len(fp)), [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            lo, hi = np.searchsorted(table[left, 0], [max(0, int(table[x, 0]) - MAX_BITS), int(table[x, 0]) + MAX_BITS + 1])
            window = left[lo:hi]
            hit = near(fp, table, np.full(len(window), x), window)
            if len(hit):
                found = window[hit]
                a.append(np.full(len(found), fp[x]))
                b.append(fp[found])
                queue.extend(found.tolist())
                left = np.delete(left, lo + hit)
    return (np.concatenate(a), np.concatenate(b)) if a else (fp[:0], fp[:0])


def first_table(differ: np.ndarray) -> np.ndarray:
    """The key mask of the first table that brings a pair together: a pair is a link there alone, not in every table."""
    alone = np.stack([differ & np.uint64(m) == 0 for m in BLOCKS], axis=1)
    alone &= np.cumsum(alone, axis=1) <= len(BLOCKS) - MAX_BITS
    return (alone * np.array(BLOCKS, np.uint64)).sum(axis=1, dtype=np.uint64)


def bucket_links(table_no: np.ndarray, key: np.ndarray, fp: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within whole buckets; rows come sorted by (table, key)."""
    cut = np.flatnonzero(np.concatenate([[True], (table_no[1:] != table_no[:-1]) | (key[1:] != key[:-1]), [True]]))
    size = np.diff(cut)
    a, b = [], []
    small = np.repeat((size > 1) & (size <= SMALL_BUCKET), size)
    bucket = np.repeat(np.arange(len(size)), size)
    rows = np.flatnonzero(small)
    if len(rows):
        f, g, table = fp[rows], bucket[rows], pivots[rows]
        for step in range(1, SMALL_BUCKET):
            i = np.flatnonzero(g[step:] == g[:-step])
            if not len(i):
                break
            hit = i[near(f, table, i, i + step)]
            hit = hit[first_table(f[hit] ^ f[hit + step]) == np.array(TABLES, np.uint64)[table_no[rows[hit]]]]
            a.append(f[hit])
            b.append(f[hit + step])
    for n in np.flatnonzero(size > SMALL_BUCKET):
        x, y = search(fp[cut[n] : cut[n + 1]], pivots[cut[n] : cut[n + 1]], (1 << 64) - 1 & ~TABLES[table_no[cut[n]]])
        a.append(x)
        b.append(y)
    return (np.concatenate(a), np.concatenate(b)) if a else (fp[:0], fp[:0])


def links(fps: DataFrame) -> DataFrame:
    """(a, b): links that connect all distinct fingerprints within MAX_BITS of each other; each is a true link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = [np.zeros(0, np.int64)] * 5

        def found(t: np.ndarray, k: np.ndarray, f: np.ndarray, *distances: np.ndarray) -> pa.RecordBatch:
            x, y = bucket_links(t, k, f.view(np.uint64), np.stack(distances, axis=1).view(np.uint8))
            x, y = x.view(np.int64), y.view(np.int64)
            pair = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1), axis=0)
            return pa.record_batch([pa.array(np.ascontiguousarray(pair[:, 0])), pa.array(np.ascontiguousarray(pair[:, 1]))], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held = [np.concatenate([h, batch.column(i).to_numpy().astype(np.int64)]) for i, h in enumerate(held)]
            t, k = held[:2]
            last = int(np.flatnonzero((t != t[-1]) | (k != k[-1]))[-1]) + 1 if (t[0], k[0]) != (t[-1], k[-1]) else 0  # the last bucket may go on
            if last > 50_000:
                yield found(*(h[:last] for h in held))
                held = [h[last:] for h in held]
        if len(held[0]):
            yield found(*held)

    keyed = with_pivots(fps).select("fp", "d0", "d1", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)) for m in TABLES])).alias("tab", "key"))
    return keyed.repartition("tab", "key").sortWithinPartitions("tab", "key").select("tab", "key", "fp", "d0", "d1").mapInArrow(run, "a bigint, b bigint")


def _grouped(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, own, fp, least, size) of every row: of its group the least (whether the id is null, id, own) and the number of rows."""
    session(df)
    prints = written(fingerprints(slim(df, id_col, text_col)), "fingerprints")
    row = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "own")
    own = written(prints.groupBy("fp").agg(F.min(row).alias("least"), F.count(F.lit(1)).alias("size")), "distinct")
    label = components(links(own.select("fp")))
    own = written(own.join(label.select(F.col("node").alias("fp"), "label"), "fp", "left").withColumn("label", F.coalesce("label", "fp")), "labels")
    group = own.groupBy("label").agg(F.min("least").alias("least"), F.sum("size").alias("size"))
    return prints.join(own.select("fp", "label").join(group, "label").drop("label"), "fp")


def simhash_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    A null or empty text, or one of white space alone, has no shingle: its fingerprint is zero and is linked like any other. A text
    of under four words is one shingle. A null id counts in no minimum; a group of null ids has a null component_id. Rows that repeat
    an id or text are kept. Other columns are ignored; no rows give none. Equal fingerprints are one before any search, so groups of
    exact copies cost nothing; no search emits all pairs of a bucket.
    """
    return _grouped(df, id_col, text_col).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("least.doc_id").alias("component_id"))


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = 1_000_000) -> DataFrame:
    """One row of each group, with all its columns: that of the smallest id, null ids last, and of equal ids the one of the least hash of its text.

    Rows are told apart by id and text, so an id that repeats over texts of different groups loses none of them.
    """
    rows = _grouped(df, id_col, text_col).where("size > 1")
    stays = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("own") == F.col("least.own"))
    rows = rows.groupBy(id_key("doc_id").alias("key"), "own").agg(F.max(stays).alias("stays"), F.count(F.lit(1)).alias("n"))
    return less(df, id_col, F.xxhash64(F.col(text_col).cast("string")), rows.where("not stays or n > 1").select("key", "own", "stays"), broadcast_rows)
