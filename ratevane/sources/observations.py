"""Logs of observations as DataFrames: scans, sinks, and the log that the event table stands for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import ROW

SHARD_NAME = r"^[a-z0-9][a-z0-9_-]*$"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether any file is there; `path` may be a pattern."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where)
    return found is not None and len(found) > 0


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, pos, line) of newline-delimited files. Lines end at \\n alone; an empty last one isn't a line; `pos` is the order in the file.

    `path` is a file, a pattern or a folder, with all that is in it: a source's shard is a file `s.ndjson` or a folder `source=s` of part
    files, as write_shards() and append_run() leave them, and is named as if it were `s.ndjson/...`, so that (path, pos) orders a source's lines.
    A file is read whole, as its order carries meaning; a large source has many part files. No file at `path`, or an empty one, gives no
    rows.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], "path string, pos int, line string")
    named = F.regexp_replace(F.col("_metadata.file_path"), "/source=([^/]+)/", "/$1.ndjson/")
    whole = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).select(named.alias("path"), F.split("value", "\n", -1).alias("lines"))
    return whole.select("path", F.posexplode("lines").alias("pos", "line")).where("line <> ''")


def parse_lines(lines: DataFrame, strict: bool = True) -> DataFrame:
    """`lines` with the fields of the row contract. A line that isn't a JSON object stops the query with its path and position, or is null if not `strict`."""
    row = F.from_json("line", ROW)
    good = F.col("line").rlike(r"^\s*\{") & F.try_parse_json("line").isNotNull()
    fault = F.raise_error(F.concat(F.lit("not a JSON object: "), "path", F.lit(" line "), F.col("pos").cast("string")))
    parsed = F.when(good, row).when(F.col("line") == "", F.lit(None)).otherwise(fault.cast(f"struct<{ROW.replace(' ', ':').replace(',:', ',')}>") if strict else F.lit(None))
    return lines.withColumn("r", parsed).select("path", "pos", "line", "r.*")


def read_log(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """All shards under `path`, in the order of their names and lines: (path, pos) orders what shares a key and a date."""
    return parse_lines(read_lines(spark, path), strict)


def read_shard(spark: SparkSession, folder: str, source: str, strict: bool = True) -> DataFrame:
    """One source's shard; a name that isn't a single safe segment is an error, a missing shard has no rows."""
    import re

    if not re.fullmatch(SHARD_NAME.strip("^$"), source):
        raise ValueError(f"bad shard name: {source}")
    return read_log(spark, f"{folder}/{{{source}.ndjson,source={source}}}", strict)


def shard_of(path: Column) -> Column:
    """The source that a line's path names."""
    return F.regexp_extract(path, r"([^/]+)\.ndjson(?:/|$)", 1)


def _named_lines(rows: DataFrame) -> DataFrame:
    named = rows.withColumn("source", F.when(F.col("source").rlike(SHARD_NAME), F.col("source")).otherwise(F.raise_error(F.concat(F.lit("bad shard name: "), F.coalesce("source", F.lit("null"))))))
    line = F.to_json(F.struct(*[c for c in rows.columns if c not in ("path", "pos", "line")]))
    return named.select("source", "model_id", "observed_at", "pos", line.alias("line"))


def write_shards(rows: DataFrame, path: str) -> None:
    """A folder of part files for each source, sorted by (model_id, observed_at, pos); the commit protocol makes a rewrite all or nothing.

    Rows are dealt over ranges of that order, so a large source is many tasks' work, and its files, by name, are in it.
    """
    order = ["source", "model_id", "observed_at", "pos"]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    _named_lines(rows).repartitionByRange(n, *order).sortWithinPartitions(*order).select("source", "line").write.mode("overwrite").partitionBy("source").text(path)


def append_run(rows: DataFrame, path: str, run: str) -> None:
    """Adds a run's rows to the log as files of their own, `source=s/run=<run>/part-*`: the same run again takes the place of what it wrote before, so nothing stands twice."""
    spark = rows.sparkSession
    at = f"{path.rstrip('/')}/.run={run}"
    order = ["source", "model_id", "observed_at"]
    _named_lines(rows.withColumn("pos", F.lit(0))).repartition("source").sortWithinPartitions(*order).select("source", "line").write.mode("overwrite").partitionBy("source").text(at)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    store = hadoop.Path(at).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for old in store.globStatus(hadoop.Path(f"{path}/source=*/run={run}")) or []:
        store.delete(old.getPath(), True)
    for made in store.globStatus(hadoop.Path(f"{at}/source=*")) or []:  # a folder for each source
        to = hadoop.Path(f"{path}/{made.getPath().getName()}")
        store.mkdirs(to)
        store.rename(made.getPath(), hadoop.Path(to, f"run={run}"))
    store.delete(hadoop.Path(at), True)


def read_fx(spark: SparkSession, path: str) -> DataFrame:
    """(currency, day, rate) of {currency: {day: rate}}; a rate that isn't finite and positive stops the query."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,map<string,double>>").alias("m"))
    flat = raw.select(F.explode("m").alias("currency", "days")).select("currency", F.explode("days").alias("day", "rate"))
    good = (F.col("rate") > 0) & (F.col("rate") < float("inf")) & F.col("day").rlike(r"^\d{4}-\d{2}-\d{2}$")
    return flat.withColumn("rate", F.when(good, F.col("rate")).otherwise(F.raise_error(F.concat(F.lit("bad rate of "), "currency", F.lit(" on "), "day")).cast("double")))


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """(canonical, name, vendor, curated, source, model_id): one row for each id that an entry claims; one id may stand alone or in a list."""
    entry = "struct<name:string,vendor:string,curated:boolean,sources:map<string,string>>"
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", f"struct<models:map<string,{entry}>>").alias("c"))
    each = raw.select(F.explode("c.models").alias("canonical", "e")).select("canonical", "e.name", "e.vendor", "e.curated", F.explode_outer("e.sources").alias("source", "ids"))
    ids = F.when(F.col("ids").startswith("["), F.from_json("ids", "array<string>")).otherwise(F.array("ids"))
    return each.select("canonical", "name", "vendor", "curated", "source", F.explode_outer(ids).alias("model_id"))


def read_aliases(spark: SparkSession, path: str) -> DataFrame:
    """(alias, valid_from, valid_to, canonical, citation): half-open ranges with open ends."""
    record = "struct<from:string,to:string,canonical:string,citation:string>"
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", f"struct<aliases:map<string,array<{record}>>>").alias("a"))
    flat = raw.select(F.explode("a.aliases").alias("alias", "records")).select("alias", F.explode("records").alias("r"))
    bad = F.col("r.from").isNotNull() & F.col("r.to").isNotNull() & (F.col("r.from") >= F.col("r.to"))
    canonical = F.when(bad, F.raise_error(F.concat(F.lit("empty range of alias "), "alias")).cast("string")).otherwise(F.col("r.canonical"))
    return flat.select("alias", F.col("r.from").alias("valid_from"), F.col("r.to").alias("valid_to"), canonical.alias("canonical"), F.col("r.citation").alias("citation"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log that `events` stands for: (source, model_id, pos, observed_at, effective_at, removed, k, rate_input)."""
    k = F.get_json_object("props", "$.k").cast("int")
    day = F.to_date("ts")
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("source"),
        F.col("user_id").cast("string").alias("model_id"),
        F.col("event_id").alias("pos"),
        F.date_format("ts", "yyyy-MM-dd").alias("observed_at"),
        F.when(k % 3 == 0, F.date_format(F.date_add(day, k % 7 - 3), "yyyy-MM-dd")).alias("effective_at"),
        (k % 10 == 0).alias("removed"),
        k.alias("k"),
        F.col("value").alias("rate_input"),
    )
