"""Benchmark decontamination by Wu-Manber search for many test strings at once.

A test string is a window of an item's words, so the search runs over words, each a 64-bit hash. Strings of one length share a table of
shifts: for each block of words, how far the end of the search window may move on before a string could end there. Most blocks of a text
stand in no string and let it skip nearly a string's length. Where the shift is zero, the block's bucket holds the strings that end in it,
ordered by a hash of all their words; those of the text's own hash are compared byte by byte.

The tables are built by executors in shards of bounded size and memory-mapped by the workers, so benchmarks of any size work: each text
meets the shards one after the other. A text is searched in many lanes at a time, each a stretch of ends of its own.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import map_texts, session, shared_dir, slim
from .shelf import load, lower_bound, save
from .textbuf import chunks, plain_words, span_hashes, spread

#: Words of a test string, and of the blocks by which it is found.
WINDOW, BLOCK = 10, 3
#: Bytes of item texts in a shard of the tables, but for one longer text.
SHARD_BYTES = 8 << 20
#: Ends that a lane walks over.
LANE = 128
_ODD, _DOWN = np.uint64(0xD6E8FEB86659FD93), np.uint64(29)


def folded(words: np.ndarray, last: np.ndarray, n: int) -> np.ndarray:
    """A hash of the n words that end at each place."""
    out = np.zeros(len(last), np.uint64)
    for back in range(n - 1, -1, -1):
        out = (out ^ words[last - back]) * _ODD
        out ^= out >> _DOWN
    return out


def windows_of(n_words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, first, words) of each item's windows; one of fewer words than `window` is one window."""
    begin = np.cumsum(n_words) - n_words
    item, place = spread(np.where(n_words > 0, np.maximum(n_words - window + 1, 1), 0))
    return item, begin[item] + place, np.minimum(n_words[item], window)


def built(ids: list[str | None], texts: pa.Array, window: int, block: int) -> dict[int, dict[str, np.ndarray]]:
    """The tables of some items, by the length of their windows."""
    parts, base, n_bytes = [], 0, 0
    for _, to, data, off in chunks(texts):
        plain, start, end, doc = plain_words(data, off)
        parts.append((plain, start + n_bytes, end + n_bytes, doc + base, span_hashes(plain, start, end)))
        base, n_bytes = to, n_bytes + len(plain)
    if not parts:
        return {}
    plain, start, end, doc, words = (np.concatenate(c) for c in zip(*parts, strict=True))
    raw = plain.tobytes()
    item, first, size = windows_of(np.bincount(doc, minlength=len(ids)), window)
    out = {}
    for m in np.unique(size).tolist():
        own = np.flatnonzero(size == m)
        number: dict[bytes, int] = {}
        holders = np.array([number.setdefault(raw[a:b], len(number)) for a, b in zip(start[first[own]].tolist(), end[first[own] + m - 1].tolist(), strict=True)], np.int64)
        _, one = np.unique(holders, return_index=True)
        last, b = first[own][one] + m - 1, min(block, m)
        blocks = [folded(words, last - back, b) for back in range(m - b + 1)]
        bits = min(22, max(8, int(8 * len(np.unique(np.concatenate(blocks)))).bit_length()))
        down = np.uint64(64 - bits)
        shift = np.full(1 << bits, m - b + 1, np.uint8 if m < 255 else np.int64)
        for back, h in enumerate(blocks):
            np.minimum.at(shift, (h >> down).astype(np.int64), back)
        whole, bucket = folded(words, last, m), (blocks[0] >> down).astype(np.int64)
        order = np.lexsort((whole, bucket))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        pairs = np.unique(np.stack([rank[holders], item[own]])[:, [ids[i] is not None for i in item[own].tolist()]], axis=1)
        strings = list(number)
        texts_ = [strings[i] for i in order.tolist()]
        names = [(x or "").encode() for x in ids]
        out[m] = {
            "shift": shift, "start": np.searchsorted(bucket[order], np.arange((1 << bits) + 1)).astype(np.uint64), "whole": whole[order],
            "text": np.frombuffer(b"".join(texts_), np.uint8), "text_at": np.cumsum([0, *map(len, texts_)]).astype(np.uint64),
            "item_at": np.searchsorted(pairs[0], np.arange(len(order) + 1)).astype(np.uint64), "item": pairs[1].astype(np.uint64),
            "name": np.frombuffer(b"".join(names), np.uint8), "name_at": np.cumsum([0, *map(len, names)]).astype(np.uint64),
        }
    return out


def tables(items: DataFrame, window: int, block: int, shard_bytes: int) -> tuple[str, list[tuple[int, int]]]:
    """The folder of the tables of all (item_id string, text), and (shard, length of windows) of each."""
    spark = session(items)
    folder = shared_dir(spark)
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    shards = max(1, -(-size // shard_bytes))

    def build(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        made = built(table["item_id"].to_pylist(), table["text"].combine_chunks(), window, block)
        for m, arrays in made.items():
            save(f"{folder}/{shard}/{m}", arrays)
        return pa.table({"shard": pa.array([shard] * len(made), pa.int32()), "words": pa.array(list(made), pa.int32())})

    dealt = items.select(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)).cast("int").alias("shard"), "item_id", "text").distinct()
    rows = dealt.groupBy("shard").applyInArrow(build, "shard int, words int").collect()  # at most `window` rows for each shard
    return folder, sorted((r["shard"], r["words"]) for r in rows)


@lru_cache(16)
def _mapped(file: str) -> dict[str, np.ndarray]:
    return load(file)


def occurrences(a: dict[str, np.ndarray], m: int, block: int, plain: np.ndarray, start: np.ndarray, end: np.ndarray, words: np.ndarray, doc_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(last word, string) of every occurrence of a table's strings of m words; `doc_at`: where each text's words begin, and the end."""
    b, bits = min(block, m), int(len(a["shift"])).bit_length() - 1
    down = np.uint64(64 - bits)
    lo, hi = doc_at[:-1] + m - 1, doc_at[1:]
    lane, place = spread(np.maximum(-(-(hi - lo) // LANE), 0))
    at = lo[lane] + place * LANE
    stop = np.minimum(at + LANE, hi[lane])
    seen, buckets = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while len(at):
        h = (folded(words, at, b) >> down).astype(np.int64)
        step = a["shift"][h].astype(np.int64)
        zero = step == 0
        seen.append(at[zero])
        buckets.append(h[zero])
        at = at + np.maximum(step, 1)
        live = at < stop
        at, stop = at[live], stop[live]
    last, bucket = np.concatenate(seen), np.concatenate(buckets)
    lo, hi = a["start"][bucket].astype(np.int64), a["start"][bucket + 1].astype(np.int64)
    own = folded(words, last, m)
    found = lower_bound(lambda i: a["whole"][i], lo, hi, own)
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    while True:  # strings of one hash stand side by side
        there = np.flatnonzero(found < hi)
        there = there[a["whole"][found[there]] == own[there]]
        if not len(there):
            return tuple(np.concatenate(c) for c in zip(*out, strict=True))
        last, hi, own, found = last[there], hi[there], own[there], found[there]
        x, y = start[last - m + 1], a["text_at"][found].astype(np.int64)
        size = end[last] - x
        even = np.flatnonzero(size == a["text_at"][found + 1].astype(np.int64) - y)
        row, place = spread(size[even])
        same = np.ones(len(even), bool)
        same[row[plain[x[even][row] + place] != a["text"][y[even][row] + place]]] = False
        out.append((last[even[same]], found[even[same]]))
        found = found + 1


def decontaminate(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, block: int = BLOCK, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, items, spans) of every row of `df`.

    Words are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased. A test string is `window` consecutive
    words of an item, or all words of an item of fewer, none of one without words. `n_hit` counts the words inside any occurrence of a
    test string, `items` lists the ids, as sorted strings, of the items of which a test string occurs, `spans` the runs of hit words
    (first, last: word numbers from 0). A null text has no words. Items that repeat count once; an item with a null id marks words, but
    isn't listed. Rows that repeat are searched each. Other columns are ignored; no rows give none, no items no hit.
    """
    named = items.select(F.col(item_id_col).cast("string").alias("item_id"), F.coalesce(F.col(item_text_col).cast("string"), F.lit("")).alias("text"))
    folder, there = tables(named, window, block, shard_bytes)

    def body(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
        made = []
        for a, b, data, off in chunks(batch.column(1)):
            plain, start, end, doc = plain_words(data, off)
            words = span_hashes(plain, start, end)
            n_words = np.bincount(doc, minlength=b - a)
            doc_at = np.concatenate([[0], np.cumsum(n_words)])
            hit, names = np.zeros(len(words) + 1, np.int64), [set() for _ in range(b - a)]
            for shard, m in there:
                table = _mapped(f"{folder}/{shard}/{m}")
                last, string = occurrences(table, m, block, plain, start, end, words, doc_at)
                np.add.at(hit, last - m + 1, 1)
                np.add.at(hit, last + 1, -1)
                text, string = np.unique(np.stack([doc[last], string]), axis=1)
                at = table["item_at"].astype(np.int64)
                row, place = spread(at[string + 1] - at[string])
                text, item = np.unique(np.stack([text[row], table["item"][at[string][row] + place].astype(np.int64)]), axis=1)
                raw, cut = table["name"].tobytes() if len(item) else b"", table["name_at"]
                for t, x, y in zip(text.tolist(), cut[item].tolist(), cut[item + 1].tolist(), strict=True):
                    names[t].add(raw[x:y].decode())
            inside = np.cumsum(hit)[:-1] > 0
            edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
            cut = np.zeros(len(words) + 1, bool)
            cut[doc_at] = True
            first = np.flatnonzero((edge[:-1] == 1) | inside & cut[:-1])
            stop = np.flatnonzero((edge[1:] == -1) | inside & cut[1:])
            total = np.concatenate([[0], np.cumsum(inside)])
            runs = np.bincount(doc[first], minlength=b - a)
            base = doc_at[doc[first]]
            spans_ = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(runs)]), pa.int32()), pa.StructArray.from_arrays([pa.array(first - base), pa.array(stop - base)], ["first", "last"]))
            made.append(pa.record_batch([batch.column(0).slice(a, b - a), pa.array(n_words.astype(np.int64)), pa.array(total[doc_at[1:]] - total[doc_at[:-1]]), pa.array([sorted(x) for x in names], pa.list_(pa.string())), spans_], names=["doc_id", "n_words", "n_hit", "items", "spans"]))
        return made

    return map_texts(slim(df, id_col, text_col), body, "doc_id bigint, n_words bigint, n_hit bigint, items array<string>, spans array<struct<first: bigint, last: bigint>>")

