"""Line dedup by pairwise alignment: documents that share a run of lines are aligned by patience diff; common blocks go from the later one."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.positions import positions
from .frames import map_texts, session, slim, written
from .textbuf import buffers, mix, value_hashes

#: Words that an aligned block needs to be deleted.
BLOCK_WORDS = 20
#: Bytes of deletions that are broadcast to the texts; more are joined by a shuffle.
BROADCAST_BYTES = 32 << 20


def line_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, words) of every \\n-split line; zero words mark a blank line."""
    lines = text.split(b"\n")
    words = np.array([len(x.split()) for x in lines], np.int32)
    return np.array([xxhash.xxh3_64_intdigest(x) >> 1 for x in lines], np.int64), words


def rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, sorted by their first, whose seconds rise."""
    tails: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for i, (_, b) in enumerate(pairs):
        k = bisect_left(tails, b)
        back.append(at[k - 1] if k else -1)
        if k == len(tails):
            tails.append(b)
            at.append(i)
        else:
            tails[k], at[k] = b, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned positions of equal lines, rising in both.

    Equal lines at both ends of a stretch match; between them, lines that each side has once are the anchors (if there are none, those
    that each side has equally often and least so), their longest rising run matches, and each gap is aligned the same way.
    """
    out, stack = [], [(0, len(a), 0, len(b))]
    while stack:
        i, j, k, m = stack.pop()
        while i < j and k < m and a[i] == b[k]:
            out.append((i, k))
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            j, m = j - 1, m - 1
            out.append((j, m))
        if i >= j or k >= m:
            continue
        left, right = Counter(a[i:j]), Counter(b[k:m])
        equal = {x: n for x, n in left.items() if right.get(x) == n}
        if not equal:
            equal = {x: min(n, right[x]) for x, n in left.items() if x in right}
            if not equal:
                continue
        least = min(equal.values())
        where: dict[tuple[int, int], int] = {}
        nth: Counter = Counter()
        for y in range(k, m):
            if equal.get(b[y]) == least:
                where[b[y], nth[b[y]]] = y
                nth[b[y]] += 1
        nth, pairs = Counter(), []
        for x in range(i, j):
            if equal.get(a[x]) == least:
                if (y := where.get((a[x], nth[a[x]]))) is not None:
                    pairs.append((x, y))
                nth[a[x]] += 1
        x0, y0 = i, k
        for x, y in rising(pairs):
            out.append((x, y))
            stack.append((x0, x, y0, y))
            x0, y0 = x + 1, y + 1
        stack.append((x0, j, y0, m))
    return sorted(out)


def common_lines(later: np.ndarray, words: np.ndarray, earlier: np.ndarray, earlier_words: np.ndarray, block_words: int = BLOCK_WORDS) -> list[int]:
    """Lines of the later document in blocks that both have: blank lines aside, aligned lines that follow each other in both."""
    own, other = np.flatnonzero(words > 0), np.flatnonzero(earlier_words > 0)
    gone: list[int] = []
    block: list[int] = []
    last = (-2, -2)
    for x, y in [*patience(later[own].tolist(), earlier[other].tolist()), (-9, -9)]:
        if (x, y) != (last[0] + 1, last[1] + 1):
            if sum(int(words[own[i]]) for i in block) >= block_words:
                gone += [int(own[i]) for i in block]
            block = []
        block.append(x)
        last = (x, y)
    return gone


def runs(lines: np.ndarray, words: np.ndarray, block_words: int = BLOCK_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first, one after the last) of runs of non-blank lines: from each line the shortest of `block_words`, and the shortest up to each line.

    Each line of a block is in a run that lies inside the block: where the run from a line leaves the block, the one up to it doesn't.
    """
    own = np.flatnonzero(words > 0)
    total = np.concatenate([[0], np.cumsum(words[own], dtype=np.int64)])
    at, least = np.arange(len(own)), max(1, block_words)
    end = np.searchsorted(total, total[:-1] + least)
    begin = np.searchsorted(total, total[1:] - least, side="right") - 1
    spans = np.concatenate([np.stack([at, end])[:, end <= len(own)], np.stack([begin, at + 1])[:, begin >= 0]], axis=1)
    if not spans.shape[1]:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    start, end = np.unique(spans, axis=1)
    return value_hashes(mix(lines[own].astype(np.uint64)), start, end).view(np.int64), start, end


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, own, text): `own` is a hash of the text, which orders documents of one id; a null text is an empty one."""
    return docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("own"), F.coalesce("text", F.lit("")).alias("text"))


def _sequences(docs: DataFrame) -> DataFrame:
    """(key, lines, words, kind): each document's line hashes, and one of its non-blank lines. The key orders documents by id, then by a hash of the text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, off = buffers(batch.column(2))
        raw = data[off[0] : off[-1]].tobytes()
        at = (off - off[0]).tolist()
        made = [line_hashes(raw[a:b]) for a, b in zip(at, at[1:], strict=False)]
        kinds = [xxhash.xxh3_64_intdigest(h[w > 0].tobytes()) >> 1 for h, w in made]
        return pa.record_batch([batch.column(0), batch.column(1), pa.array([h.tobytes() for h, _ in made], pa.binary()), pa.array([w.tobytes() for _, w in made], pa.binary()), pa.array(kinds, pa.int64())], names=["doc_id", "own", "lines", "words", "kind"])

    return map_texts(_keyed(docs), run, "doc_id bigint, own bigint, lines binary, words binary, kind bigint").select(F.struct("doc_id", "own").alias("key"), "lines", "words", "kind")


def _holders(seqs: DataFrame, block_words: int) -> DataFrame:
    """(run, key): each document once for each of its runs of lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sets = [np.unique(runs(np.frombuffer(a, np.int64), np.frombuffer(w, np.int32), block_words)[0]) for a, w in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
                take = pa.array(np.repeat(np.arange(len(sets)), [len(x) for x in sets]))
                yield pa.record_batch([pa.array(np.concatenate(sets)), batch.column(0).take(take), batch.column(1).take(take)], names=["run", "doc_id", "own"])

    flat = seqs.select("key.doc_id", "key.own", "lines", "words")
    return flat.mapInArrow(run, "run bigint, doc_id bigint, own bigint").select("run", F.struct("doc_id", "own").alias("key"))


def _aligned(pairs: DataFrame, seqs: DataFrame, block_words: int) -> DataFrame:
    """(key, gone): for each pair (later, earlier), the lines that the later one loses, if any."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i).to_pylist() for i in range(2, 6)]
            gone = [common_lines(np.frombuffer(a, np.int64), np.frombuffer(b, np.int32), np.frombuffer(c, np.int64), np.frombuffer(d, np.int32), block_words) for a, b, c, d in zip(*columns, strict=True)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(gone, pa.list_(pa.int32()))], names=["doc_id", "own", "gone"])

    both = pairs.join(seqs.select(F.col("key").alias("later"), "lines", "words"), "later").join(seqs.select(F.col("key").alias("earlier"), F.col("lines").alias("lines2"), F.col("words").alias("words2")), "earlier")
    found = both.select("later.doc_id", "later.own", "lines", "words", "lines2", "words2").mapInArrow(align, "doc_id bigint, own bigint, gone array<int>").where(F.size("gone") > 0)
    return found.groupBy(F.struct("doc_id", "own").alias("key")).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("gone"))


def _open(shared: DataFrame, seqs: DataFrame, gone: DataFrame, block_words: int) -> DataFrame:
    """(run, later): the runs that an earlier document has, of which a line is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left = []
            for a, b, known, away in zip(*[batch.column(i).to_pylist() for i in range(2, 6)], strict=True):
                lines, words = np.frombuffer(a, np.int64), np.frombuffer(b, np.int32)
                stays = np.ones(len(lines), np.int64)
                stays[away or []] = 0
                total = np.concatenate([[0], np.cumsum(stays[words > 0])])
                value, start, end = runs(lines, words, block_words)
                left.append(np.intersect1d(value[total[end] > total[start]], np.array(known, np.int64)))
            take = pa.array(np.repeat(np.arange(len(left)), [len(x) for x in left]))
            yield pa.record_batch([pa.array(np.concatenate(left)), batch.column(0).take(take), batch.column(1).take(take)], names=["run", "doc_id", "own"])

    all_ = seqs.join(shared, "key").join(gone, "key", "left").select("key.doc_id", "key.own", "lines", "words", "runs", "gone")
    return all_.mapInArrow(run, "run bigint, doc_id bigint, own bigint").select("run", F.struct("doc_id", "own").alias("later"))


def _union_of(found: list[DataFrame]) -> DataFrame:
    """(key, gone): the lines that a document loses in any of `found`."""
    both = reduce(DataFrame.unionByName, found)
    return both.groupBy("key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("gone"))


def deletions(seqs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, own, gone): the lines to delete from each later document, as sorted 32-bit integers: what all alignments with earlier ones give.

    Of documents of the same non-blank lines the first stands for all: beside it, another one loses all that any alignment can take. A
    block holds a run that both have, so only holders of a run are aligned: first each with the run's first holder, then, as long as a
    line of the run is left, with the run's next ones in their order, by rounds of 1, 2, 4, ... holders. Where no line is left, no
    alignment can take more, so a document is done once its own lines are.
    """
    first = written(seqs.groupBy("kind").agg(F.min("key").alias("earlier"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "kinds")
    copies = written(seqs.select("key", "kind").join(first, "kind").where(F.col("key") > F.col("earlier")).select(F.col("key").alias("later"), "earlier"), "copies")
    one = written(seqs.join(copies.select(F.col("later").alias("key")), "key", "left_anti").select("key", "lines", "words"), "one_of_each")
    holders = written(_holders(one, block_words), "holders")
    count = written(holders.groupBy("run").agg(F.count(F.lit(1)).alias("df"), F.min("key").alias("first")).where("df > 1").drop("df"), "counted")
    shared = holders.join(count, "run").where(F.col("key") > F.col("first")).groupBy("key").agg(F.collect_set("first").alias("firsts"), F.collect_set("run").alias("runs"))
    shared = written(shared, "shared")
    done = shared.select(F.col("key").alias("later"), F.explode("firsts").alias("earlier"))
    found = [written(_aligned(done.unionByName(copies), seqs, block_words), "gone")]
    left = written(_open(shared.select("key", "runs"), one, found[0], block_words), "open")
    if left.isEmpty():
        return found[0].select("key.doc_id", "key.own", "gone")
    near = positions(holders.join(left.select("run").distinct(), "run", "left_semi"), ["run", "key"], "at")
    ranked = near.join(near.groupBy("run").agg(F.min("at").alias("least")), "run").select("run", "key", (F.col("at") - F.col("least")).alias("rank"))
    ranked = written(ranked, "ranked")
    lo, width = 1, 1
    while True:
        own = ranked.select("run", F.col("key").alias("later"), F.col("rank").alias("own"))
        waiting = written(left.join(own, ["run", "later"]).where(F.col("own") > lo), "waiting")
        if waiting.isEmpty():
            break
        next_ = waiting.select("run", "later", F.explode(F.sequence(F.lit(lo), F.least(F.col("own") - 1, F.lit(lo + width - 1)))).alias("rank"))
        pairs = next_.join(ranked, ["run", "rank"]).select("later", F.col("key").alias("earlier")).distinct().join(done, ["later", "earlier"], "left_anti")
        pairs = written(pairs, "pairs")
        found.append(written(_aligned(pairs, one, block_words), "gone"))
        done = done.unionByName(pairs)
        lo, width = lo + width, 2 * width
        docs = waiting.groupBy(F.col("later").alias("key")).agg(F.collect_set("run").alias("runs"))
        left = written(_open(docs, one, _union_of(found), block_words), "open")
    return _union_of(found).select("key.doc_id", "key.own", "gone")


def align_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, text, n_lines, n_deleted) of every row: the text without the blocks of lines that an earlier document has.

    Documents come in the order of their ids, nulls first, equal ids by a hash of the text; rows that repeat id and text are one
    document and get the same result. Lines are equal if their bytes are; blank ones are no part of an alignment and stay. A null text
    is an empty one: one line. Other columns are ignored; no rows give none. Memory follows the longest pair of documents.
    """
    session(df)
    docs = slim(df, id_col, text_col)
    seqs = written(_sequences(docs).dropDuplicates(["key"]), "sequences")
    gone = written(deletions(seqs, block_words), "deletions")
    size = gone.agg(F.coalesce(F.sum(4 * F.size("gone") + 32), F.lit(0)).alias("n")).first()["n"]

    keyed = _keyed(docs).alias("d")
    right = (F.broadcast(gone) if size <= BROADCAST_BYTES else gone).alias("g")
    same = F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("d.own") == F.col("g.own"))
    n_lines = (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("bigint")
    whole = keyed.join(right, same, "left_anti").select("doc_id", "text", n_lines.alias("n_lines"), F.lit(0).cast("bigint").alias("n_deleted"))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept, lines, lost = [], [], []
        for text, gone_ in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            away, own = set(gone_), text.split("\n")
            kept.append("\n".join(x for i, x in enumerate(own) if i not in away))
            lines.append(len(own))
            lost.append(len(gone_))
        return pa.record_batch([batch.column(0), pa.array(kept, pa.string()), pa.array(lines, pa.int64()), pa.array(lost, pa.int64())], names=["doc_id", "text", "n_lines", "n_deleted"])

    # only texts that lose lines go through Python
    return whole.unionByName(map_texts(keyed.join(right, same).select("d.doc_id", "d.text", "g.gone"), cut, "doc_id bigint, text string, n_lines bigint, n_deleted bigint"))
