"""Exact dedup by an exchange of Golomb-coded fingerprints.

1. Each partition lower-cases A-Z, hashes its texts with SHA-256 and sorts the distinct hashes by owner (the hash's top bits).
   Every owner gets one message: a Golomb code of the sorted next 44 bits.
2. An owner decodes its messages and answers each with a bitmap: which of its hashes another partition holds as well.
3. Rows whose bit is set, or whose hash repeats inside the partition, are suspects. Only their texts are shuffled, grouped by the
   whole normalised text, which verifies them byte by byte. All other rows are known to be alone.

A partition names a hash once however many rows have it, and equal texts meet in map-side sums before the shuffle, so a group that
holds a third of all rows costs one message entry a partition and one text a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import golomb
from .frames import id_key, less, session, slim, written
from .textbuf import buffers, lowered

#: Bits of a hash that a message carries below the owner's bits. With a million hashes an owner, a hash is a false suspect about once in 16 million.
VALUE_BITS = 44
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_MESSAGES = "pid int, owner int, n int, k int, code binary, twice binary, place binary, ids binary, nulls binary, shas binary"


def owners_for(partitions: int) -> int:
    """A power of two: as many owners as partitions, between 16 and 4096."""
    return 1 << min(12, max(4, (partitions - 1).bit_length()))


def messages(docs: DataFrame, owners: int) -> DataFrame:
    """One row for each partition and owner: the message, and what only the partition needs later (ids, hashes, places in the message)."""
    shift = owners.bit_length() - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ids, nulls, shas = [], [], []
        for batch in batches:
            data, off = buffers(batch.column(1))
            low = lowered(data[off[0] : off[-1]]).tobytes()
            at = (off - off[0]).tolist()
            shas.append(b"".join(hashlib.sha256(low[a:b]).digest() for a, b in zip(at, at[1:], strict=False)))
            ids.append(batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
            nulls.append(batch.column(0).is_null().to_numpy(zero_copy_only=False))
        if not ids:
            return
        doc, null = np.concatenate(ids), np.concatenate(nulls)
        sha = np.frombuffer(b"".join(shas), np.uint8).reshape(-1, 32)
        top = np.ascontiguousarray(sha[:, :8]).view(">u8").ravel().astype(np.uint64)
        order = np.argsort(top, kind="stable")
        top, doc, null, sha = top[order], doc[order], null[order], sha[order]
        owner = (top >> np.uint64(64 - shift)).astype(np.int64)
        value = (top << np.uint64(shift)) >> np.uint64(64 - VALUE_BITS)
        cut = np.searchsorted(owner, np.arange(owners + 1))
        pid, rows = TaskContext.get().partitionId(), []
        for o in range(owners):
            a, b = cut[o], cut[o + 1]
            if a < b:
                distinct, place, count = np.unique(value[a:b], return_inverse=True, return_counts=True)
                code, k = golomb.encode(distinct, 1 << VALUE_BITS)
                rows.append((pid, o, len(distinct), k, code, golomb.bitmap(count > 1), place.astype("<i4").tobytes(), doc[a:b].astype("<i8").tobytes(), golomb.bitmap(null[a:b]), sha[a:b].tobytes()))
        names = [x.split()[0] for x in _MESSAGES.split(", ")]
        kinds = [pa.int32()] * 4 + [pa.binary()] * 6
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return docs.mapInArrow(run, _MESSAGES)


def answers(sent: DataFrame) -> DataFrame:
    """(pid, owner, bitmap): which hashes of each message stand in another message too."""

    def own(table: pa.Table) -> pa.Table:
        got = table.to_pydict()
        lists = [golomb.decode(c, n, k) for c, n, k in zip(got["code"], got["n"], got["k"], strict=True)]
        _, inverse, count = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
        shared, at, maps = count[inverse] > 1, 0, []
        for x in lists:
            maps.append(golomb.bitmap(shared[at : at + len(x)]))
            at += len(x)
        return pa.table({"pid": table["pid"], "owner": table["owner"], "bitmap": pa.array(maps, pa.binary())})

    return sent.select("pid", "owner", "n", "k", "code").groupBy("owner").applyInArrow(own, "pid int, owner int, bitmap binary")


def marked(sent: DataFrame, replies: DataFrame) -> DataFrame:
    """(doc_id, sha, suspect, row) of every row; `row` is its own number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                place = np.frombuffer(r["place"], "<i4")
                suspect = golomb.flags(r["twice"], r["n"]) | golomb.flags(r["bitmap"], r["n"])
                null = golomb.flags(r["nulls"], len(place))
                shas = pa.FixedSizeBinaryArray.from_buffers(pa.binary(32), len(place), [None, pa.py_buffer(r["shas"])]).cast(pa.binary())
                row = (np.int64(r["pid"]) << 40) + (np.int64(r["owner"]) << 28) + np.arange(len(place))
                yield pa.record_batch([pa.array(np.frombuffer(r["ids"], "<i8"), mask=null), shas, pa.array(suspect[place]), pa.array(row)], names=["doc_id", "sha", "suspect", "row"])

    both = sent.select("pid", "owner", "n", "twice", "place", "ids", "nulls", "shas").join(replies, ["pid", "owner"])
    return both.select("pid", "owner", "n", "twice", "bitmap", "place", "ids", "nulls", "shas").mapInArrow(run, "doc_id bigint, sha binary, suspect boolean, row bigint")


def normal(text_col: str) -> Column:
    return F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), UPPER, LOWER)


def _verdicts(df: DataFrame, id_col: str, text_col: str, broadcast_rows: int) -> DataFrame:
    """(doc_id, sha, suspect, keep_id, group_size, kept) of every row."""
    session(df)
    docs = slim(df, id_col, text_col)
    sent = written(messages(docs, owners_for(docs.rdd.getNumPartitions())), "messages")
    rows = written(marked(sent, answers(sent)), "marked")
    suspects = rows.where("suspect")
    ids = suspects.select(id_key("doc_id").alias("key")).distinct()
    few = suspects.count() <= broadcast_rows
    texts = docs.select("doc_id", normal("text").alias("normal"), id_key("doc_id").alias("key"))
    texts = texts.join(F.broadcast(ids) if few else ids, "key", "left_semi")
    groups = texts.groupBy("normal").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).select(F.unhex(F.sha2("normal", 256)).alias("sha"), "keep_id", "group_size")
    top = suspects.groupBy("sha").agg(F.max(F.struct("doc_id", "row"))["row"].alias("top"))
    groups = written(groups.join(top, "sha"), "groups")
    small = groups.count() <= broadcast_rows // 8  # of 56 bytes each; a join by a shuffle would bring a whole group to one task
    spread = suspects.join(F.broadcast(groups) if small else groups, "sha").withColumn("kept", F.col("row") == F.col("top"))
    alone = rows.where("not suspect").select("doc_id", "sha", "suspect", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"))
    return spread.select(alone.columns).unionByName(alone)


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = 1_000_000) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row; texts are equal if they are so after lower-casing A-Z alone.

    Exactly one row of a group stays: that of the largest id, and if several rows repeat that id, one of them, whichever. A null text
    is an empty one. A null id stays only if its whole group has null ids; then `keep_id` is null. Other columns are ignored; no rows
    give none. The suspects' ids select their texts through a broadcast up to `broadcast_rows` (8 MB of ids), else through a shuffled
    semi-join.
    """
    return _verdicts(df, id_col, text_col, broadcast_rows).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def keep_unique(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = 1_000_000) -> DataFrame:
    """The rows of `df` that exact_dedup() keeps, with all their columns: one of each text. Rows are told apart by id and text, so an id that repeats over different texts loses none of them."""
    rows = _verdicts(df, id_col, text_col, broadcast_rows).where("suspect").groupBy(id_key("doc_id").alias("key"), F.lower(F.hex("sha")).alias("own")).agg(F.max("kept").alias("stays"), F.count(F.lit(1)).alias("n"))
    return less(df, id_col, F.sha2(normal(text_col), 256), rows.where("not stays or n > 1").select("key", "own", "stays"), broadcast_rows)
