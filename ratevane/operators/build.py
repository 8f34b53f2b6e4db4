"""Rows of the log from scraped prices and from last observations, in USD."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import AXES, FEES, LIMITS, OVERRIDES, PROVENANCE, RATES, VERSION
from .temporal import as_of

#: What a scraper gives: costs of a token in `currency`, limits, a peak schedule, and entries of rates for a million tokens.
WINDOW_RATES = f"array<struct<days:array<string>,window:array<int>,min_tokens:bigint,mode:string,quota_multiplier:double,rates:{RATES}>>"
SCRAPED = (
    f"source string, model_id string, costs {RATES}, peak_costs {RATES}, peak_windows array<array<int>>, peak_days array<string>, window_rates {WINDOW_RATES}, timezone string, "
    f"fees struct<{','.join(f'{f}:double' for f in FEES)}>, limits struct<{','.join(f'{x}:bigint' for x in LIMITS)}>, effective_at string, currency string, unit string, url string"
)


def failed(condition: Column, message: Column, value: Column, kind: str) -> Column:
    """`value`, or an error that stops the query."""
    return F.when(condition, F.raise_error(message).cast(kind)).otherwise(value)


def resolved(quotes: DataFrame, fx: DataFrame, providers: DataFrame, strict: bool = True) -> DataFrame:
    """`quotes` (source, currency, observed_at, ...) with fx_rate, fx_rate_date and fx_fault.

    USD (or null) has none. DBU has its provider's rate (providers: source, currency_rate), dated with the observation. Others have the
    latest rate of `fx` (currency, day, rate) up to the day of the observation. A quote without a rate stops the query if `strict`;
    else fx_fault names it.
    """
    day = F.substring("observed_at", 1, 10)
    own = quotes.withColumn("_day", day).withColumn("_no", F.monotonically_increasing_id())
    dated = as_of(own, fx.withColumn("_at", F.col("day")), ("currency",), "_day", "day", ["rate", "_at"], "day")
    rate = dated.join(providers.select("source", F.col("currency_rate").alias("_own")).dropDuplicates(["source"]), "source", "left")
    usd, dbu = F.coalesce("currency", F.lit("USD")) == "USD", F.coalesce("currency", F.lit("")) == "DBU"
    found = F.when(usd, F.lit(None)).when(dbu, F.col("_own")).otherwise(F.col("rate"))
    fault = F.when(~usd & found.isNull(), F.concat(F.lit("no fx rate for "), F.coalesce("currency", F.lit("")), F.lit(" on or before "), F.col("_day")))
    value = failed(fault.isNotNull(), fault, found, "double") if strict else found
    at = F.when(usd | fault.isNotNull(), F.lit(None)).when(dbu, F.col("_day")).otherwise(F.col("_at"))
    return rate.select(*[F.col(c) for c in quotes.columns], value.cast("double").alias("fx_rate"), at.cast("string").alias("fx_rate_date"), fault.alias("fx_fault"))


def _scaled(rates: Column, factor: Column, per: float) -> Column:
    made = F.struct(*[F.round(rates[a] * factor * per, 6).alias(a) for a in AXES]).cast(RATES)
    return F.when(F.coalesce(*[made[a] for a in AXES]).isNotNull(), made)


def _when(days: Column, window: Column, zone: Column, min_tokens: Column, mode: Column) -> Column:
    some_days = F.when(F.size(days) > 0, days)
    any_ = F.coalesce(some_days.cast("string"), window.cast("string"), min_tokens.cast("string"), mode)
    return F.when(any_.isNotNull(), F.struct(some_days.cast("array<string>").alias("days"), window.cast("array<int>").alias("window"), zone.cast("string").alias("timezone"), min_tokens.cast("bigint").alias("min_tokens"), mode.cast("string").alias("mode")))


def price_rows(scraped: DataFrame, observed_at: str, page: str = "") -> DataFrame:
    """Rows of the contract from SCRAPED rows that resolved() gave fx_rate and fx_rate_date; `page` is the url where a row has none.

    Peak costs make an override for each peak window, or one without a window; entries of window_rates follow, those without rates with
    their multiplier. A zone stands only beside a condition. Empty parts are null, as is the currency at USD. Another unit than tokens
    stops the query.
    """
    none = F.lit(None)
    unit = F.coalesce("unit", F.lit("tokens"))
    factor = F.coalesce("fx_rate", F.lit(1.0))
    peak = _scaled(F.col("peak_costs"), factor, 1e6)
    windows = F.when(F.size("peak_windows") > 0, F.col("peak_windows")).otherwise(F.array(none.cast("array<int>")))

    def peaks(w: Column) -> Column:
        return F.struct(_when(F.col("peak_days"), w, F.col("timezone"), none.cast("bigint"), none.cast("string")).alias("when"), peak.alias("rates"), none.cast("double").alias("quota_multiplier"))

    def entry(e: Column) -> Column:
        return F.struct(_when(e["days"], e["window"], F.col("timezone"), e["min_tokens"], e["mode"]).alias("when"), _scaled(e["rates"], factor, 1.0).alias("rates"), e["quota_multiplier"].alias("quota_multiplier"))

    empty = F.array().cast(OVERRIDES)
    over = F.concat(F.when(peak.isNotNull(), F.transform(windows, peaks).cast(OVERRIDES)).otherwise(empty), F.coalesce(F.transform("window_rates", entry).cast(OVERRIDES), empty))
    limit = F.struct(*[F.when(F.col(f"limits.{x}") > 0, F.col(f"limits.{x}")).alias(x) for x in LIMITS])
    fee = F.coalesce(*[F.col(f"fees.{f}") for f in FEES])
    return scraped.select(
        failed(unit != "tokens", F.concat(F.lit("can't build a row for unit "), unit), F.lit(VERSION), "int").cast("int").alias("schema"),
        "source",
        "model_id",
        F.lit(observed_at).alias("observed_at"),
        none.cast("string").alias("modality"),
        "effective_at",
        none.cast("boolean").alias("removed"),
        F.nullif(F.col("currency"), F.lit("USD")).alias("currency"),
        _scaled(F.col("costs"), factor, 1e6).alias("rates"),
        F.when(F.size(over) > 0, over).alias("overrides"),
        F.when(fee.isNotNull(), F.col("fees")).alias("fees"),
        F.when(F.coalesce(*[limit[x] for x in LIMITS]).isNotNull(), limit).alias("limits"),
        none.cast("string").alias("unmapped"),
        F.struct(F.coalesce(F.nullif(F.col("url"), F.lit("")), F.lit(page)).alias("url"), none.cast("string").alias("name"), "fx_rate", "fx_rate_date").cast(PROVENANCE).alias("provenance"),
    )


def scraped_of(priced: DataFrame) -> DataFrame:
    """SCRAPED rows of the priced rows of pages (rates of a million tokens)."""
    million = lambda r: F.struct(*[(r[a] / 1e6).alias(a) for a in AXES]).cast(RATES)
    entry = F.transform("overrides", lambda o: F.struct(o["when"]["days"].alias("days"), o["when"]["window"].alias("window"), o["when"]["min_tokens"].alias("min_tokens"), o["when"]["mode"].alias("mode"), o["quota_multiplier"].alias("quota_multiplier"), o["rates"].alias("rates")))
    timed = F.exists(F.coalesce("overrides", F.array().cast(OVERRIDES)), lambda o: o["when"]["window"].isNotNull() | o["when"]["days"].isNotNull())
    none = F.lit(None)
    return priced.where("rates is not null").select("source", "model_id", million(F.col("rates")).alias("costs"), none.cast(RATES).alias("peak_costs"), none.cast("array<array<int>>").alias("peak_windows"), none.cast("array<string>").alias("peak_days"), entry.cast(WINDOW_RATES).alias("window_rates"), F.when(timed, F.lit("UTC")).alias("timezone"), "fees", "limits", "effective_at", "currency", F.lit("tokens").alias("unit"), "url")


def utc_snapshot(overrides: Column) -> Column:
    """Overrides whose conditions that name a zone name UTC, as their windows are UTC whatever the zone they were written in."""
    return F.transform(overrides, lambda o: F.when(o["when"]["timezone"].isNotNull(), o.withField("when", o["when"].withField("timezone", F.lit("UTC")))).otherwise(o))


def removal_rows(last: DataFrame, observed_at: str) -> DataFrame:
    """Removals of keys: `last` has each key's last priced row, or nulls but for the key. What a change is judged by is carried on; of the provenance only the conversion, where the quote isn't in USD."""
    fx = F.struct(F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("name"), F.col("provenance.fx_rate").alias("fx_rate"), F.col("provenance.fx_rate_date").alias("fx_rate_date")).cast(PROVENANCE)
    foreign = (F.coalesce("currency", F.lit("USD")) != "USD") & F.coalesce(F.col("provenance.fx_rate").cast("string"), F.col("provenance.fx_rate_date")).isNotNull()
    carried = ("effective_at", "currency", "rates", "fees", "limits", "unmapped", "modality")
    return last.select(F.lit(VERSION).alias("schema"), "source", "model_id", F.lit(observed_at).alias("observed_at"), "modality", "effective_at", F.lit(True).alias("removed"), *carried[1:3], utc_snapshot(F.col("overrides")).alias("overrides"), "fees", "limits", "unmapped", F.when(foreign, fx).alias("provenance"))
