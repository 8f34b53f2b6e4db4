"""Published views of a log: entries with their chains, indexes, twins, merged history, counts and the static page's rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.page import DASH, rate
from ..functions.text import html
from ..operators.temporal import interval_chain
from ..operators.views import display_name
from ..schema import FIELDS, KEY

FLAT_VERSION = 3
#: Fields of a row that an entry shows, in order; and those of an interval.
SHOWN = ("schema", "effective_at", "rates", "overrides", "limits", "fees", "currency", "observed_at", "modality")
ITEM = ("currency", "rates", "overrides", "limits", "fees")


def required(rows: DataFrame) -> DataFrame:
    """`rows`; one without source, id or day, or whose source can't name a shard, stops the query with its line."""
    from ..sources.observations import SHARD_NAME

    missing = [F.when(F.col(c).isNull(), F.lit(f"row is missing {c}")) for c in (*KEY, "observed_at")]
    fault = F.coalesce(*missing, F.when(~F.col("source").rlike(SHARD_NAME), F.concat(F.lit("bad shard name: "), F.col("source"))))
    return rows.withColumn("source", F.when(fault.isNotNull(), F.raise_error(fault).cast("string")).otherwise(F.col("source")))


def agrees(rows: DataFrame, shards: DataFrame) -> DataFrame:
    """(source, side): sources of the rows that no shard is named after, and shards of no row's source; a published tree has none."""
    a, b = rows.select("source").distinct(), shards.select("source").distinct()
    return a.subtract(b).withColumn("side", F.lit("rows only")).unionByName(b.subtract(a).withColumn("side", F.lit("files only")))


def entries(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    """One entry for each key of `rows` (the contract's fields and pos): its last priced row's fields, or the last row's where none is priced.

    `catalog` (canonical, name, vendor, source, model_id) gives vendor and name; of several entries that claim an id the last by canonical
    name. The newest row, by day and then position, tells whether the key is removed. Intervals come in order of their start.
    """
    order = F.struct("observed_at", "pos")
    solid = ~F.coalesce("removed", F.lit(False))
    fields = F.struct(*[F.col(c) for c in (*SHOWN, "provenance")])
    own = rows.groupBy(*KEY).agg(F.min("observed_at").alias("first_seen"), F.max_by(F.when(solid, fields), F.when(solid, order)).alias("priced"), F.max_by(fields, order).alias("last"), F.max_by(F.struct((~solid).alias("removed"), "observed_at"), order).alias("newest"))
    item = F.struct("valid_from", "valid_to", "observed_at", *ITEM, F.when(~solid, F.lit(True)).alias("removed"))
    chain = interval_chain(rows.select(*KEY, "pos", "observed_at", "effective_at", "removed", *ITEM)).groupBy(*KEY).agg(F.transform(F.array_sort(F.collect_list(F.struct("valid_from", "pos", item.alias("item")))), lambda x: x["item"]).alias("intervals"))
    named = catalog.where("source is not null and model_id is not null").groupBy(*KEY).agg(F.max_by(F.struct("vendor", "name"), "canonical").alias("c"))
    base = F.coalesce("priced", "last")
    j = own.join(chain, list(KEY)).join(named, list(KEY), "left").withColumn("base", base)
    return j.select(*KEY, F.col("c.vendor").alias("vendor"), display_name(F.col("c.name"), F.col("base.provenance.name"), F.col("model_id")).alias("name"), *[F.col(f"base.{c}").alias(c) for c in SHOWN], "first_seen", "intervals", F.when(F.col("newest.removed"), F.col("newest.observed_at")).alias("removed_at"), F.col("newest.observed_at").alias("_newest"))


def heads(flat: DataFrame, version: int) -> DataFrame:
    """(scope, version, flat_version, updated_at, entries): of the whole export (scope null) and of each source's twin."""
    made = flat.groupingSets([[], [F.col("source")]], "source").agg(F.max("_newest").alias("updated_at"), F.count(F.lit(1)).alias("entries"))
    return made.select(F.col("source").alias("scope"), F.lit(version).alias("version"), F.lit(FLAT_VERSION).alias("flat_version"), F.coalesce("updated_at", F.lit("")).alias("updated_at"), "entries")


def second_version(flat: DataFrame) -> DataFrame:
    """The export's second version: entries priced by text alone, without the field that tells."""
    return flat.where(F.coalesce("modality", F.lit("")) == "").drop("modality")


def index(flat: DataFrame) -> DataFrame:
    """(source, model_id, entry): the nested index as rows, an entry as one JSON object; a reader of a source's part has its object's members."""
    body = [c for c in flat.columns if c not in (*KEY, "_newest")]
    return flat.select(*KEY, F.to_json(F.struct(*body)).alias("entry"))


def history(rows: DataFrame) -> DataFrame:
    """All rows as lines, sorted by source, id and day, ties in the order of their shard; one range partition follows another."""
    line = F.to_json(F.struct(*[c for c in FIELDS if c in rows.columns]))
    return rows.withColumn("line", line).orderBy(*KEY, "observed_at", "pos").select("line")


def counts(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    """One row: models, sources, rows, first_seen ('-' without rows), days (0 unless two dates), mapped (curated entries)."""
    from ..operators.log import stats

    mapped = catalog.where("curated").agg(F.count_distinct("canonical").alias("mapped"))
    return stats(rows).drop("updated_at").crossJoin(F.broadcast(mapped))  # one row beside one row


def counts_table(one: DataFrame) -> DataFrame:
    """The counts as a table's text."""
    n = lambda x: F.format_number(F.col(x), 0)
    return one.select(F.concat(F.lit("| metric | value |\n|---|---|\n| models tracked | **"), n("models"), F.lit("** |\n| sources | "), F.col("sources").cast("string"), F.lit(" |\n| dated rows | "), n("rows"), F.lit(" |\n| canonical models | "), n("mapped"), F.lit(" |\n| history | since "), "first_seen", F.lit(", "), n("days"), F.lit(" days |")).alias("text"))


def rendered(text: str, block: str, made: str) -> str:
    """`text` with what stands between a block's two marks replaced; a block that doesn't stand there once is an error."""
    start, end = f"<!-- {block}:start -->", f"<!-- {block}:end -->"
    if text.count(start) != 1 or text.count(end) != 1 or text.index(end) < text.index(start):
        raise ValueError(f"block {block} doesn't stand there once")
    return text[: text.index(start) + len(start)] + "\n" + made + "\n" + text[text.index(end) :]


def static_row(e: DataFrame) -> Column:
    """An entry as a row of the static page's table."""
    cell = lambda x: F.concat(F.lit("<td>"), x, F.lit("</td>"))
    tag = lambda cls, x: F.coalesce(F.concat(F.lit(f' <span class="{cls}">'), x, F.lit("</span>")), F.lit(""))
    name = F.concat(F.lit('<span class="table-name">'), html(F.col("name")), F.lit("</span>"), tag("tag tag-danger", F.concat(F.lit("removed "), html(F.col("removed_at")))), tag("tag tag-info", html(F.nullif(F.col("modality"), F.lit("")))), F.lit('<div class="td-sub">'), html(F.col("model_id")), F.lit("</div>"))
    cells = [name, F.coalesce(html(F.nullif(F.col("vendor"), F.lit(""))), F.lit(DASH)), html(F.col("source")), *[rate(F.col(f"rates.{a}")) for a in ("input", "cache_read", "output")]]
    return F.concat(F.lit('<tr data-key="'), html(F.concat_ws("/", "source", "model_id")), F.lit('">'), *[cell(x) for x in cells], F.lit("</tr>"))


def static_rows(flat: DataFrame) -> DataFrame:
    """(source, model_id, row) in the order of the export."""
    return flat.select(*KEY, static_row(flat).alias("row")).orderBy(*KEY)


def write(spark: SparkSession, rows: DataFrame, catalog: DataFrame, out: str, version: int, shards: DataFrame | None = None) -> None:
    """The published tree under `out`, each part overwritten whole: flat exports and heads, twins and index by source, history, the page's rows.

    The entries are made once, as a table of the tree, and read again by every part. Sources of rows and shards that disagree are an error.
    """
    checked = required(rows)
    if shards is not None and not (odd := agrees(checked, shards)).isEmpty():
        raise ValueError(f"rows and shards disagree on sources: {odd.limit(20).collect()}")
    entries(checked, catalog).write.mode("overwrite").parquet(f"{out}/entries")
    flat = spark.read.parquet(f"{out}/entries")
    own = flat.drop("_newest")
    heads(flat, version).write.mode("overwrite").json(f"{out}/heads")
    own.orderBy(*KEY).write.mode("overwrite").json(f"{out}/flat-v{FLAT_VERSION}")
    second_version(own).orderBy(*KEY).write.mode("overwrite").json(f"{out}/flat-v2")
    by = own.withColumn("_source", F.col("source")).repartition("_source").sortWithinPartitions("_source", "model_id")
    by.write.mode("overwrite").partitionBy("_source").json(f"{out}/flat")
    index(flat).write.mode("overwrite").partitionBy("source").json(f"{out}/index")
    history(checked).write.mode("overwrite").text(f"{out}/history")
    static_rows(own).select("row").write.mode("overwrite").text(f"{out}/page")


