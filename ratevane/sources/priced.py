"""What the sources of pages share: the rows that they give, and how cells, cards and amounts become them.

A source is a function from Pages to PRICED rows, and what its pages are read for. One id is one row, the first on a run's pages; `fault` names what
can't be read, which is never the same as unpriced (neither rates nor fault). Rates are for a million tokens in `currency`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.markup import Pages, Reading
from ..schema import AXES, FEES, LIMITS, OVERRIDES, RATES

PRICED = f"source string, model_id string, currency string, rates {RATES}, overrides {OVERRIDES}, fees struct<{','.join(f'{f}:double' for f in FEES)}>, limits struct<{','.join(f'{x}:bigint' for x in LIMITS)}>, effective_at string, fault string, run string, url string"
SOURCES: dict[str, Callable[[Pages], DataFrame]] = {}
READINGS: dict[str, Reading] = {}
#: Digits of a token count that can be read.
COUNT_DIGITS = 12
c, lit = F.col, F.lit


def source(**reading: object) -> Callable[[Callable[[Pages], DataFrame]], Callable[[Pages], DataFrame]]:
    """A source under its function's name, with the fields of its Reading."""

    def named(f: Callable[[Pages], DataFrame]) -> Callable[[Pages], DataFrame]:
        SOURCES[f.__name__], READINGS[f.__name__] = f, Reading(**reading)
        return f

    return named


def slug(x: Column, keep: str = "a-z0-9.") -> Column:
    """Lower case, each run of other characters as one hyphen, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(x), f"[^{keep}]+", "-"), "^-+|-+$", "")


def amount(name: str, i: int = 0) -> Column:
    """The i-th amount of a scanned text; -1 is the last."""
    list_ = c(f"{name}_amounts")
    one = F.get(list_, i) if i >= 0 else F.get(list_, F.size(list_) + i)
    return F.replace(one, lit(","), lit("")).try_cast("double")


def faults(*checks: tuple[Column, str]) -> Column:
    """The first check that fails names the fault."""
    out = lit(None).cast("string")
    for bad, name in reversed(checks):
        out = F.when(bad, lit(name)).otherwise(out)
    return out


def rates(**axes: Column) -> Column:
    return F.struct(*[axes[a].cast("double").alias(a) if a in axes else lit(None).cast("double").alias(a) for a in AXES]).cast(RATES)


def override(own: Column, *, days: Column | None = None, window: Column | None = None, min_tokens: Column | None = None, mode: str | None = None, multiplier: Column | None = None) -> Column:
    none = lit(None)
    zone = F.when((days if days is not None else none).isNotNull() | (window if window is not None else none).isNotNull(), lit("UTC"))
    when = F.struct((days if days is not None else none).cast("array<string>").alias("days"), (window if window is not None else none).cast("array<int>").alias("window"), zone.alias("timezone"), (min_tokens if min_tokens is not None else none).cast("bigint").alias("min_tokens"), lit(mode).cast("string").alias("mode"))
    return F.struct(when.alias("when"), own.alias("rates"), (multiplier if multiplier is not None else none).cast("double").alias("quota_multiplier"))


def some(list_: Column) -> Column:
    return F.when(F.size(list_) > 0, list_)


def priced(rows: DataFrame, name: str, fault: Column, own: dict[str, Column], *, overrides: Column | None = None, fees: Column | None = None, limits: dict[str, Column] | None = None, effective: Column | None = None, currency: str = "USD", order: tuple = ()) -> DataFrame:
    """PRICED rows of `rows` (url, ord, model_id, ...): rates stand where input and output can be read."""
    good = fault.isNull() & own["input"].isNotNull() & own["output"].isNotNull()
    limit = {k: F.when(v > 0, v).cast("bigint") for k, v in (limits or {}).items()}
    limit = F.struct(*[limit.get(x, lit(None).cast("bigint")).alias(x) for x in LIMITS])
    none = lit(None)
    row = F.struct(
        lit(currency).alias("currency"),
        F.when(good, rates(**{k: F.round(v, 6) for k, v in own.items()})).alias("rates"),
        F.when(good, overrides if overrides is not None else none).cast(OVERRIDES).alias("overrides"),
        F.when(good, fees if fees is not None else none).cast(f"struct<{','.join(f'{f}:double' for f in FEES)}>").alias("fees"),
        F.when(good & F.coalesce(*[limit[x] for x in LIMITS]).isNotNull(), limit).alias("limits"),
        F.when(good, effective if effective is not None else none).cast("string").alias("effective_at"),
        fault.alias("fault"),
    )
    one = rows.where("model_id <> ''").groupBy("url.run", "model_id").agg(F.min_by(F.struct(row.alias("r"), "url"), F.struct(*order, "url", "ord")).alias("x"))
    return one.select(lit(name).alias("source"), "model_id", "x.r.currency", "x.r.rates", "x.r.overrides", "x.r.fees", "x.r.limits", "x.r.effective_at", "x.r.fault", F.nullif("run", lit("")).alias("run"), "x.url.url")


def data_rows(pages: Pages, head: Column) -> DataFrame:
    """The rows below the heading of tables whose folded heading fits."""
    return pages.rows.where(head & ~c("first") & ~c("in_head"))


def headed(*labels: str) -> Column:
    return F.transform("head", lambda h: h) == F.array(*[lit(" ".join(x.casefold().replace("&", " and ").split())) for x in labels])


def cell(i: int) -> Column:
    return F.get(c("cells"), i)


def sized(text: Column, k: int = 1000) -> Column:
    """A count such as 128K, 1.5 M or 32,768, in whole; null for another shape."""
    bare = F.upper(F.regexp_replace(text, r"[\s,]", ""))
    unit = F.when(bare.endswith("K"), k).when(bare.endswith("M"), k * k)
    number = F.when(unit.isNotNull(), F.left(bare, F.length(bare) - 1)).otherwise(bare)
    plain = F.when(number.rlike("^[0-9][0-9.]*$") & (F.length(number) <= COUNT_DIGITS), number.try_cast("double"))
    return F.floor(plain * F.coalesce(unit, lit(1)))


def word_before(text: Column, mark: str) -> Column:
    """The word right before the first `mark`, with the one before it where it is a unit alone."""
    words = F.split(F.trim(F.substring_index(text, mark, 1)), r"\s+")
    last = F.element_at(words, -1)
    return F.when(text.contains(mark), F.when(F.upper(last).isin("K", "M") & (F.size(words) > 1), F.concat(F.try_element_at(words, lit(-2)), last)).otherwise(last))


def thousand(text: Column, scale: int = 1024) -> Column:
    """A count such as 128k in tokens; null for another shape."""
    digits = F.regexp_extract(text, rf"^(\d{{1,{COUNT_DIGITS}}})[kK]$", 1)
    return F.when(digits != "", digits.cast("bigint") * scale)
