"""Pages to priced ids: an extractor is a description, not a program; detection and scraping are queries over its tables' rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import money, text
from ..functions.tables import html_tables, markdown_tables, tables_of
from ..schema import AXES, RATES


@dataclass(frozen=True)
class Extractor:
    """Which table of a source's page holds prices: the folded label of the id column and of each axis, the currency's marker, the unit."""

    source: str
    id_label: str
    axes: dict[str, str]  # folded label: axis
    kind: str = "html"
    before: str = "$"
    after: str = ""
    currency: str = "USD"
    per: float = 1e6  # tokens that a printed price is for
    spellings: tuple[tuple[str, str], ...] = field(default=())  # pattern and replacement, each another spelling of an id
    clean: tuple[tuple[str, str], ...] = field(default=())  # patterns and replacements that a cell goes through first, as of crossed-out list prices
    id_clean: tuple[tuple[str, str], ...] = field(default=())  # the same for the id's cell


def _cells(pages: DataFrame, x: Extractor) -> DataFrame:
    """(url, row, id, axis, cell) of every priced cell under a header with the id's label and at least one axis."""
    rows = tables_of(pages.where(F.col("source") == x.source), "url", "body", html_tables if x.kind == "html" else markdown_tables)
    head = F.transform("cells", text.fold_heading)
    first = Window.partitionBy("url", "table_no").orderBy("row_no")
    labelled = rows.withColumn("head", F.first(head).over(first)).where("row_no > 0 and size(cells) = size(head)")
    labelled = labelled.where(F.array_contains("head", x.id_label))
    key = F.get(F.col("cells"), (F.array_position("head", x.id_label) - 1).cast("int"))
    named = F.create_map(*[F.lit(v) for kv in x.axes.items() for v in kv])
    flat = labelled.select("url", "table_no", "row_no", F.trim(key).alias("model_id"), F.posexplode(F.arrays_zip("head", "cells")).alias("at", "c"))
    return flat.select("url", "table_no", "row_no", _through("model_id", x.id_clean).alias("model_id"), F.try_element_at(named, F.col("c.head")).alias("axis"), _through("c.cells", x.clean).alias("cell")).where("axis is not null and model_id <> ''")


def _through(column: str, changes: tuple[tuple[str, str], ...]):
    out = F.col(column)
    for pattern, to in changes:
        out = F.regexp_replace(out, pattern, to)
    return F.trim(out)


def prices(pages: DataFrame, x: Extractor) -> DataFrame:
    """(source, model_id, currency, rates, malformed, url) of every id on `pages` (source, url, body).

    A cell with one readable amount is a price, zero too; a cell without any is unpriced; anything unreadable, or two amounts, marks the
    row as malformed, which is never the same as unpriced. Of several rows with an id the first priced one stands.
    """
    cells = _cells(pages, x)
    before, after, per = x.before, x.after, x.per

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [money.amounts(t, before, after) for t in batch.column(5).to_pylist()]
            value = [float(a[0].replace(',', '')) / per * 1e6 if len(a) == 1 and not bad else None for a, bad in made]
            yield pa.record_batch([*batch.columns[:5], pa.array(value, pa.float64()), pa.array([bad or len(set(a)) > 1 for a, bad in made], pa.bool_())], names=["url", "table_no", "row_no", "model_id", "axis", "value", "bad"])

    read = cells.mapInArrow(run, "url string, table_no int, row_no int, model_id string, axis string, value double, bad boolean")
    rows = read.groupBy("url", "table_no", "row_no", "model_id").agg(*[F.round(F.first(F.when(F.col("axis") == a, F.col("value")), ignorenulls=True), 6).alias(a) for a in AXES], F.max("bad").alias("malformed"))
    rates = F.struct(*AXES).cast(RATES)
    some = F.coalesce(*[F.col(a) for a in AXES]).isNotNull()
    row = rows.select("model_id", "url", F.when(some & ~F.col("malformed"), rates).alias("rates"), "malformed", F.struct((~some | F.col("malformed")).alias("late"), "table_no", "row_no").alias("order"))
    one = row.groupBy("model_id").agg(F.min_by(F.struct("rates", "malformed", "url"), "order").alias("x"))
    return one.select(F.lit(x.source).alias("source"), "model_id", F.lit(x.currency).alias("currency"), "x.rates", "x.malformed", "x.url")


def detected(pages: DataFrame, x: Extractor) -> DataFrame:
    """(source, model_id): ids whose row can be read, priced or not."""
    return prices(pages, x).where("not malformed").select("source", "model_id")


def spellings(ids: DataFrame, x: Extractor) -> DataFrame:
    """(model_id, spelling, ord): the id itself first, then its other spellings, each once: what a stored row may go by."""
    each = F.array(F.col("model_id"), *[F.regexp_replace("model_id", a, b) for a, b in x.spellings])
    return ids.select("model_id", F.posexplode(F.array_distinct(each)).alias("ord", "spelling"))


def stored_spelling(ids: DataFrame, stored: DataFrame, x: Extractor) -> DataFrame:
    """(model_id, stored_id): the first spelling of each id that has a stored row; null if none has."""
    hit = spellings(ids, x).join(stored.select(F.col("model_id").alias("spelling")).distinct(), "spelling")
    first = hit.groupBy("model_id").agg(F.min_by("spelling", "ord").alias("stored_id"))
    return ids.select("model_id").distinct().join(first, "model_id", "left")
