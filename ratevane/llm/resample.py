"""Importance resampling towards a target: hashed n-gram features, their gains, and a draw of the highest perturbed weights.

Two Arrow passes over the texts. The first adds up np.bincount vectors of feature buckets in each partition, which treeReduce merges; the
second gathers the gains of each text's features from a broadcast vector and adds them up by np.bincount with weights. A bucket's crc32 is
computed for all features of a batch at once, byte by byte. The draw sorts slim rows in range partitions; ranks are offsets of the
partitions and places inside them, so no task has all rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import map_texts, session, slim, written
from .textbuf import chunks, plain_words

BUCKETS, MAX_WORDS, MIN_WORDS, PERCENT, SEED = 10_000, 1, 20, 10, 2024
#: Bytes of a feature up to which its checksum is computed beside others'.
_SHORT = 48


@lru_cache(1)
def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & np.uint32(1), table >> np.uint32(1) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


def crc32_of(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The unsigned CRC-32 of each span."""
    table, size = _crc_table(), end - start
    crc = np.full(len(start), 0xFFFFFFFF, np.uint32)
    live = np.flatnonzero(size <= _SHORT)
    live = live[np.argsort(-size[live], kind="stable")]
    ordered, at, state = -size[live], start[live], crc[live]
    for k in range(int(-ordered[0]) if len(live) else 0):
        n = int(np.searchsorted(ordered, -k, "left"))  # those of more than k bytes stand first
        state[:n] = table[(state[:n] ^ data[at[:n] + k]) & np.uint32(0xFF)] ^ state[:n] >> np.uint32(8)
    crc[live] = ~state
    for i in np.flatnonzero(size > _SHORT).tolist():
        crc[i] = zlib.crc32(data[start[i] : end[i]])
    return crc


def features(data: np.ndarray, off: np.ndarray, max_words: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket) of every run of 1 to `max_words` words, and each text's words."""
    plain, start, end, doc = plain_words(data, off)
    docs, found = [], []
    for n in range(1, max_words + 1):
        first = np.flatnonzero(doc[: max(0, len(doc) - n + 1)] == doc[n - 1 :])
        docs.append(doc[first])
        found.append(crc32_of(plain, start[first], end[first + n - 1]) % np.uint32(buckets))
    return np.concatenate(docs), np.concatenate(found).astype(np.int64), np.bincount(doc, minlength=len(off) - 1)


def bucket_counts(texts: DataFrame, max_words: int, buckets: int) -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, data, off in chunks(batch.column(0)) if batch.num_rows else ():
                total += np.bincount(features(data, off, max_words, buckets)[1], minlength=buckets)
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["counts"])

    vectors = texts.mapInArrow(run, "counts binary").rdd.map(lambda r: np.frombuffer(r[0], np.int64))
    return vectors.treeReduce(np.add) if vectors.getNumPartitions() else np.zeros(buckets, np.int64)


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floors of 1000 times the log ratio of smoothed shares of a bucket in the target and in the source."""
    n, s, t = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((float(b) + 1) * (s + n) / ((float(a) + 1) * (t + n)))) for a, b in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def noise(id_col: str, seed: int) -> Column:
    """A Gumbel draw in thousandths that hangs on the seed and the id alone."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def weighted(docs: DataFrame, gains: np.ndarray, max_words: int) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)

    def body(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
        made, gain = [], shared.value
        for a, b, data, off in chunks(batch.column(1)):
            doc, bucket, n_words = features(data, off, max_words, len(gain))
            weight = np.bincount(doc, weights=gain[bucket], minlength=b - a)
            made.append(pa.record_batch([batch.column(0).slice(a, b - a), pa.array(n_words), pa.array(np.bincount(doc, minlength=b - a)), pa.array(weight.astype(np.int64))], names=["doc_id", "n_words", "n_features", "weight"]))
        return made

    return map_texts(docs, body, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def numbered(rows: DataFrame, order: list[Column], name: str = "place") -> DataFrame:
    """`rows` with their positions, from 0, in a total order of all of them: one range partitioning; a place in a partition and the partition's offset."""
    spark, schema = session(rows), rows.schema
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pid, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            place = pa.array(np.arange(at, at + batch.num_rows))
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, pid, np.int32)), place], names=[*batch.schema.names, "__part", name])

    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    placed = written(dealt.mapInArrow(run, f"{own}, __part int, `{name}` bigint"), "placed")
    sizes = sorted((r["__part"], r["n"]) for r in placed.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).collect())  # a row for each partition
    before, offsets = 0, []
    for part, size in sizes:
        offsets.append((part, before))
        before += size
    table = spark.createDataFrame(offsets, "__part int, __before bigint")
    return placed.join(F.broadcast(table), "__part").select(*schema.names, (F.col(name) + F.col("__before")).alias(name))


def resample(df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text", percent: int = PERCENT, min_words: int = MIN_WORDS, max_words: int = MAX_WORDS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of `df`; of the rows of at least `min_words` words, `percent` in a hundred have a rank.

    Words are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased; features are runs of 1 to `max_words`
    words, joined by a space, repeats counted. A null or empty text has none: weight 0. The score is the weight and a draw that only the
    id decides; a null id draws as an empty one. Ranks go by score, then the smaller id, null last, then fewer features; rows alike in
    all of these take their ranks in any order. An empty target gives every bucket the gain of its share in the source. Other columns are
    ignored; no rows give none.
    """
    session(df)
    docs = slim(df, id_col, text_col)
    source = bucket_counts(docs.select("text"), max_words, buckets)
    aim = bucket_counts(target.select(F.col(target_text_col).cast("string").alias("text")), max_words, buckets)
    rows = weighted(docs, gains_of(source, aim), max_words)
    rows = written(rows.select("doc_id", "n_features", "weight", (F.col("weight") + noise("doc_id", seed)).alias("score"), (F.col("n_words") >= min_words).alias("fit")), "scored")
    n = rows.where("fit").count()
    spare = F.col("spare")  # parts rows that are alike
    order = [F.col("fit").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").asc(), spare.asc()]
    placed = numbered(rows.withColumn("spare", F.monotonically_increasing_id()), order)
    rank = F.when(F.col("place") < n * percent // 100, F.col("place") + 1)
    return placed.select("doc_id", "n_features", "weight", "score", rank.alias("rank"))
