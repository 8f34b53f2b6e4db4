"""Optimal length buckets, and batches of a token budget inside them."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .frames import session, slim, written
from .textbuf import chunks, word_spans

BUCKETS, TOKEN_BUDGET = 16, 65_536
#: Rows of a bucket that one task ranks.
SHARD_ROWS = 200_000


def boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Upper lengths of at most `buckets` buckets of least total padding, ascending; the last is the greatest length.

    lengths ascend, counts are positive. With C and S the prefix sums of counts and of counts times lengths, a bucket of the
    lengths i+1..j pads L[j] * (C[j] - C[i]) - (S[j] - S[i]), so each layer of the dynamic programme asks for the least of lines
    in L[j]; their slopes fall and L rises, so a convex hull answers all in one walk. Exact integers; ties take the earlier cut.
    """
    n = len(lengths)
    if not n:
        return []
    c, s = [0], [0]
    for length, count in zip(lengths, counts, strict=True):
        c.append(c[-1] + count)
        s.append(s[-1] + length * count)
    best = [0] + [lengths[j - 1] * c[j] - s[j] for j in range(1, n + 1)]
    back = [[0] * (n + 1)]
    for k in range(2, min(buckets, n) + 1):
        hull: list[tuple[int, int, int]] = []  # slope, intercept, cut
        at, new, cut = 0, [0] * (n + 1), [0] * (n + 1)
        for j in range(k, n + 1):
            i = j - 1
            m, b = -c[i], best[i] + s[i]
            while len(hull) >= 2 and (hull[-1][1] - hull[-2][1]) * (hull[-1][0] - m) >= (b - hull[-1][1]) * (hull[-2][0] - hull[-1][0]):
                hull.pop()
            hull.append((m, b, i))
            at = min(at, len(hull) - 1)
            x = lengths[j - 1]
            while at + 1 < len(hull) and hull[at + 1][0] * x + hull[at + 1][1] < hull[at][0] * x + hull[at][1]:
                at += 1
            new[j], cut[j] = x * c[j] - s[j] + hull[at][0] * x + hull[at][1], hull[at][2]
        for j in range(1, k):
            new[j], cut[j] = best[j], back[-1][j]
        best = new
        back.append(cut)
        if best[n] == 0:
            break
    out, j = [], n
    for cut in reversed(back):
        if j:
            out.append(lengths[j - 1])
            j = cut[j]
    return out[::-1]


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, token_budget: int = TOKEN_BUDGET) -> DataFrame:
    """(doc_id, n_tokens, bucket, bucket_length, batch, slot) of every row.

    Tokens are the words `[^\\x20\\x09-\\x0D]+` of the whole text; a null or empty text has none and goes to the first bucket. The
    exact histogram of all lengths goes to the driver and gives the bucket boundaries of least padding: d distinct lengths take at least
    d * (d - 1) / 2 tokens, so it has under sqrt(2 * tokens) + 1 rows, two integers each (a million for half a trillion tokens). A
    batch holds texts of one bucket only, max(1, token_budget // bucket_length) of them, padded to bucket_length; every batch of a
    bucket but its last is full. A text beyond the budget is a batch of its own. (bucket, batch, slot) is unique. Null or repeated
    ids are rows like any other, ranked by their place in the input; ties of length and id go by that place. Other columns are
    ignored; no rows give none. A bucket with a third of all rows is ranked in as many shards as its rows need.
    """
    spark = session(df)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pid, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            n = np.concatenate([np.bincount(word_spans(data, off)[2], minlength=to - at) for at, to, data, off in chunks(batch.column(1))]).astype(np.int64)
            place = (np.int64(pid) << 40) + np.arange(row, row + len(n))
            row += len(n)
            yield pa.record_batch([batch.column(0), pa.array(n), pa.array(place)], names=["doc_id", "n_tokens", "place"])

    sized = written(slim(df, id_col, text_col).mapInArrow(measure, "doc_id bigint, n_tokens bigint, place bigint"), "lengths")
    seen = sorted((r["n_tokens"], r["n"]) for r in sized.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect())
    bounds = boundaries([a for a, _ in seen], [b for _, b in seen], buckets)
    total = [0] * len(bounds)
    for a, b in seen:
        total[bisect_left(bounds, a)] += b
    shape = spark.createDataFrame([(i, b, max(1, token_budget // max(1, b)), -(-n // SHARD_ROWS)) for i, (b, n) in enumerate(zip(bounds, total, strict=True))], "bucket int, bucket_length bigint, rows bigint, shards bigint")

    bucket = F.lit(0)
    for b in bounds[:-1]:
        bucket = bucket + (F.col("n_tokens") > b).cast("int")
    placed = sized.withColumn("bucket", bucket).join(F.broadcast(shape), "bucket").withColumn("shard", F.pmod(F.xxhash64("place"), "shards"))
    count = placed.groupBy("bucket", "shard").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("bucket").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = count.select("bucket", "shard", before.alias("base"))  # a row for each 200,000 rows of a bucket
    rank = F.row_number().over(Window.partitionBy("bucket", "shard").orderBy("n_tokens", "doc_id", "place")) - 1
    ranked = placed.withColumn("rank", rank).join(base, ["bucket", "shard"]).withColumn("index", F.col("base") + F.col("rank"))
    return ranked.select("doc_id", "n_tokens", "bucket", "bucket_length", F.floor(F.col("index") / F.col("rows")).cast("bigint").alias("batch"), (F.col("index") % F.col("rows")).alias("slot"))
