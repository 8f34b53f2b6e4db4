"""Vector code compression: product codes by weighted Lloyd rounds over the distinct parts of all vectors.

Vectors become integers and are cut into equal parts. Equal parts of a position are one weighted row, however many vectors have them;
each round assigns these rows to their codebook's nearest entry and adds up weighted sums in every task, of which only one row for each
position and entry and task is shuffled. At last codes and errors are joined back to the vectors' parts. A part that many vectors have
would bring them to one task of that join, so the heaviest parts, whose number is bounded, are broadcast and only the others are shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import session, written

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: A key with more than this share of all rows is joined by a broadcast: there are fewer than its inverse of them.
HOT = 1 / 1024
LONGEST = (1 << 63) - 1
#: Part rows that one vectorised step compares with a codebook.
STEP = 8192


def integers(df: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """(vec_id, label, ints) of the rows whose vector has only finite components; integers beyond 64 bits are the nearest that fit."""
    whole = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("bigint"))
    usable = F.col(vector_col).isNotNull() & F.forall(F.col(vector_col), lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))), F.lit(False)))
    return df.where(usable).select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).alias("label"), whole.alias("ints"))


def nearest(values: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance, exact) of each row: int64 where all sums fit a double's integers, else Python's integers."""
    most = max(int(np.abs(values).max(initial=0)), int(np.abs(book).max(initial=0)), -int(min(values.min(initial=0), book.min(initial=0))))
    if 4 * most * most * max(1, values.shape[1]) < 1 << 53:
        v, b = values.astype(np.float64), book.astype(np.float64)
        far = (b * b).sum(1) - 2 * (v @ b.T)  # the values' own squares don't change the order
        at = far.argmin(1)
        return at, (far[np.arange(len(at)), at] + (v * v).sum(1)).astype(np.int64)
    gap = values.astype(object)[:, None, :] - book.astype(object)[None, :, :]
    far = (gap * gap).sum(2)
    at = np.array([min(range(len(row)), key=row.__getitem__) for row in far.tolist()], np.int64)
    return at, far[np.arange(len(at)), at]


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(position, rows of the batch, their values) of at most STEP rows."""
    pos, part = batch.column(0).to_numpy(), batch.column(1)
    flat, at = part.flatten().to_numpy().astype(np.int64), part.offsets.to_numpy() - part.offsets[0].as_py()
    width = int(at[1] - at[0]) if len(pos) else 0
    for p in np.unique(pos).tolist():
        rows = np.flatnonzero(pos == p)
        for k in range(0, len(rows), STEP):
            own = rows[k : k + STEP]
            yield p, own, flat[at[own][:, None] + np.arange(width)]


def _sums(distinct: DataFrame, books: list[np.ndarray]) -> list:
    """(pos, entry, n, sums) of all parts assigned to each entry."""
    shared = distinct.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], list[int]] = {}
        for batch in batches:
            weight = batch.column(2).to_numpy()
            for p, own, values in _blocks(batch):
                at, _ = nearest(values, shared.value[p])
                order = np.argsort(at, kind="stable")
                cut = np.flatnonzero(np.diff(at[order], prepend=-1))
                exact = int(np.abs(values).max(initial=0)) * int(weight[own].sum()) < 1 << 62
                kind = np.int64 if exact and int(values.min(initial=0)) > -LONGEST else object
                w = weight[own][order].astype(kind)[:, None]
                both = np.add.reduceat(np.concatenate([w, values[order].astype(kind) * w], axis=1), cut, axis=0)
                for entry, row in zip(at[order][cut].tolist(), both.tolist(), strict=True):
                    held = total.get((p, entry))
                    total[p, entry] = [x + y for x, y in zip(held, row, strict=True)] if held else row
        big, keys = pa.decimal128(38, 0), list(total)
        rows = [[Decimal(int(x)) for x in total[k]] for k in keys]
        yield pa.record_batch([pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), pa.array(rows, pa.list_(big))], names=["pos", "entry", "sums"])

    each = distinct.select("pos", "part", "weight").mapInArrow(run, "pos int, entry int, sums array<decimal(38,0)>")
    flat = each.select("pos", "entry", F.posexplode("sums").alias("k", "x")).groupBy("pos", "entry", "k").agg(F.sum("x").alias("x"))
    return flat.collect()  # a number for each component of each entry


def codebooks(distinct: DataFrame, first: list[np.ndarray], rounds: int) -> list[np.ndarray]:
    """Codebooks after `rounds` of Lloyd's rule over weighted rows; an entry becomes the floor of its parts' mean, an unused one stays."""
    books = [b.copy() for b in first]
    for _ in range(rounds):
        got = {(r["pos"], r["entry"], r["k"]): int(r["x"]) for r in _sums(distinct, books)}
        for (p, entry, k), x in got.items():
            if k:
                books[p][entry, k - 1] = x // got[p, entry, 0]
    return books


def coded(distinct: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(pos, part, weight, code, error) of every distinct part; an error beyond 64 bits is the largest integer of 64 bits."""
    shared = distinct.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, error = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int64)
            for p, own, values in _blocks(batch):
                at, far = nearest(values, shared.value[p])
                code[own], error[own] = at, np.minimum(far, LONGEST).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code), pa.array(error)], names=["pos", "part", "weight", "code", "error"])

    return distinct.select("pos", "part", "weight").mapInArrow(run, "pos int, part array<bigint>, weight bigint, code int, error bigint")


def joined(rows: DataFrame, keyed: DataFrame, keys: list[str], heavy: str) -> DataFrame:
    """`rows` beside their row of `keyed`, a written table with one for each key (nulls are equal); the keys of which `heavy` holds are broadcast, the others shuffled."""
    other = keyed.withColumnsRenamed({k: f"__{k}" for k in keys})
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys))
    hot, cold = F.broadcast(other.where(heavy)), other.where(f"not ({heavy})")
    return rows.join(hot, same).unionByName(rows.join(hot, same, "left_anti").join(cold, same)).drop(*(f"__{k}" for k in keys))


def compress(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, codes, error, label_error) of every row with a usable vector, and the final codebooks, one array for each position.

    A vector is dropped if it is null or holds null or non-finite components. Components become floors of `scale` times their values.
    Vectors are compared if they have the commonest length that `parts` divides (ties: the shorter); rows of other lengths have null
    codes and null errors. Codebooks start with the parts of the `entries` smallest ids, null ids last, equal ids by their vectors; with
    fewer vectors they have fewer entries. Ties of distance go to the lower entry. Errors are exact up to 64 bits and the largest integer
    of 64 bits beyond. `label_error` adds up over equal labels, nulls together. Rows that repeat count each. No rows give none.
    """
    spark = session(df)
    kept = integers(df, id_col, vector_col, label_col, scale).withColumn("row", F.monotonically_increasing_id())
    kept = written(kept, "integers")
    sizes = kept.groupBy(F.size("ints").alias("size")).agg(F.count(F.lit(1)).alias("n")).where((F.col("size") > 0) & (F.col("size") % parts == 0))
    common = sizes.orderBy(F.desc("n"), "size").limit(1).collect()
    if not common:
        empty = kept.select("vec_id", "label", F.lit(None).cast("array<int>").alias("codes"), F.lit(None).cast("bigint").alias("error"), F.lit(None).cast("bigint").alias("label_error"))
        return empty, []
    size, total = common[0]["size"], common[0]["n"]
    width = size // parts
    own = kept.where(F.size("ints") == size)
    seeds = own.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).select("ints").collect()  # of fixed number
    seeds = np.array([r["ints"] for r in seeds], np.int64)
    first = [seeds[:, p * width : (p + 1) * width] for p in range(parts)]

    cut = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: F.slice("ints", p * width + 1, width))
    flat = own.select("row", F.posexplode(cut).alias("pos", "part"))
    distinct = written(flat.groupBy("pos", "part").agg(F.count(F.lit(1)).alias("weight")), "distinct")
    books = codebooks(distinct, first, rounds)
    found = written(coded(distinct, books), "coded")
    cells = joined(flat, found, ["pos", "part"], f"weight > {int(total * HOT)}").select("row", "pos", "code", "error")
    whole = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONGEST).cast("decimal(38,0)")).cast("bigint")
    done = cells.groupBy("row").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "code"))), lambda x: x["code"]).alias("codes"), whole.alias("error"))
    every = written(kept.select("row", "vec_id", "label").join(done, "row", "left"), "codes")

    own = every.where("error is not null")
    sums = written(own.groupBy("label").agg(F.count(F.lit(1)).alias("n"), whole.alias("label_error")), "labels")
    rest = every.where("error is null").withColumn("label_error", F.lit(None).cast("bigint"))
    return joined(own, sums, ["label"], f"n > {int(total * HOT)}").select("vec_id", "label", "codes", "error", "label_error").unionByName(rest.drop("row")), books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components in decimal, by position, entry and place, comma-joined."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()
