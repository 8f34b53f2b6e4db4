"""One JSON document from many tasks: sorted members in part files whose concatenation, in the order of their names, is the document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.positions import positions


def text_of(value: Column) -> Column:
    """A text as JSON."""
    return F.coalesce(F.regexp_replace(F.to_json(F.struct(value.alias("x"))), r'(?s)^\{"x":(.*)\}$', "$1"), F.lit("null"))


def write_document(members: DataFrame, path: str, order: list[str], group: str | None = None, head: str = "{", tail: str = "}") -> DataFrame:
    """Writes `members` (member: `"name":value`, and the columns of `order`) as one document; (file, start, bytes) of its fragments.

    With `group`, which `order` must begin with, members stand inside an object for each of its values, by name. Members are dealt over
    ranges of the order, a line each, so no task has the whole document; a reader puts the files together by name, or takes the fragment
    whose bytes it needs.
    """
    keep = list(dict.fromkeys([*order, *([group] if group else [])]))
    placed = positions(members.select(*keep, "member"), order)
    n = placed.count()
    line = F.col("member")
    last = F.col("place") == n - 1
    if group:
        ends = placed.groupBy(group).agg(F.min("place").alias("_from"), F.max("place").alias("_to"))
        placed = placed.join(ends, group)
        line = F.concat(F.when(F.col("place") == F.col("_from"), F.concat(text_of(F.col(group)), F.lit(":{"))).otherwise(""), line, F.when(F.col("place") == F.col("_to"), "}").otherwise(""))
    whole = F.concat(F.when(F.col("place") == 0, head).otherwise(""), line, F.when(last, tail).otherwise(","))
    spark = members.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = placed.select("place", whole.alias("line"))
    if not n:
        lines = spark.createDataFrame([(0, head + tail)], "place bigint, line string")
    lines.repartitionByRange(parts, "place").sortWithinPartitions("place").select("line").write.mode("overwrite").text(path)
    files = spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", "[^/]+$", 0).alias("file"), F.col("length").alias("bytes")).where("bytes > 0")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    return files.select("file", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("start"), "bytes")
