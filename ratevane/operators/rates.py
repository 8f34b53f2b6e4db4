"""Conditional rates: matching of overrides, effective and peak rates, the cost of a session; rows built from scraped prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import AXES, RATES

MINUTES, HHMM = "minutes", "hhmm"


def matches(override: Column, day: Column, minute: Column, tokens: Column, mode: Column, clock: str = HHMM) -> Column:
    """Whether an override applies: all conditions it has hold. `tokens` must exceed min_tokens; a window is [start, end).

    The contract writes windows as clock numbers (0730); `clock="minutes"` compares them with minutes of the day instead, as some readers do.
    """
    at = minute if clock == MINUTES else F.floor(minute / 60) * 100 + minute % 60
    return met(override, F.lower(F.date_format(day, "EEEE")), at, tokens, mode)


def met(override: Column, weekday: Column, at: Column, tokens: Column, mode: Column) -> Column:
    """matches() from a weekday's name and a clock number (or minute) that are columns already: they are computed once a row, not for every override."""
    when = override["when"]
    in_days = when["days"].isNull() | F.array_contains(when["days"], weekday)
    in_window = when["window"].isNull() | ((at >= F.get(when["window"], 0)) & (at < F.get(when["window"], 1)))
    large = when["min_tokens"].isNull() | (tokens > when["min_tokens"])
    same = when["mode"].isNull() | (when["mode"] == mode)
    return when.isNull() | F.coalesce(in_days & in_window & large & same, F.lit(False))


def effective(base: Column, overrides: Column, applies) -> Column:
    """Base rates under the last override that applies, axis by axis; one without rates leaves the base as it is."""
    hit = F.try_element_at(F.filter(F.coalesce(overrides, F.array()), applies), F.lit(-1))["rates"]
    return F.struct(*[F.coalesce(hit[a], base[a]).alias(a) for a in AXES])


def session_total(rates: Column, tokens_in: Column, cached: Column, tokens_out: Column) -> Column:
    """Cost of a session; null if tokens were used on an axis without a rate. Cached tokens fall back to the input rate."""

    def part(count: Column, rate: Column) -> Column:
        return F.when(count == 0, F.lit(0.0)).otherwise(count / F.lit(1e6) * rate)

    return part(tokens_in, rates["input"]) + part(cached, F.coalesce(rates["cache_read"], rates["input"])) + part(tokens_out, rates["output"])


def peak(base: Column, overrides: Column) -> Column:
    """Each axis's highest rate: of the base and of every override with a clock window."""
    timed = F.filter(F.coalesce(overrides, F.array()), lambda o: F.size(o["when"]["window"]) == 2)

    def highest(axis: str) -> Column:
        return F.array_max(F.concat(F.array(base[axis]), F.transform(timed, lambda o: o["rates"][axis]))).alias(axis)

    return F.struct(*[highest(a) for a in AXES])


def priced_axes(base: Column, overrides: Column) -> Column:
    """Names of the axes that a peak schedule prices, in the order of AXES: the base's, and those of any override with a clock window."""
    timed = F.filter(F.coalesce(overrides, F.array()), lambda o: F.size(o["when"]["window"]) == 2)
    held = lambda axis: base[axis].isNotNull() | F.exists(timed, lambda o: o["rates"][axis].isNotNull())
    return F.array_compact(F.array(*[F.when(F.coalesce(held(a), F.lit(False)), a) for a in AXES]))


def ranked(costed: DataFrame, group: list[str], total: str = "total") -> DataFrame:
    """`costed` with the group's cheapest total, its multiple (of a cheapest of nothing only nothing is once) and the rank, null totals last."""
    w = Window.partitionBy(*group)
    low = F.min(total).over(w)
    return costed.withColumn("cheapest", low).withColumn("multiple", F.when(F.col("cheapest") > 0, F.col(total) / F.col("cheapest")).when((F.col("cheapest") == 0) & (F.col(total) == 0), 1.0)).withColumn("place", F.rank().over(w.orderBy(F.col(total).asc_nulls_last())))


def per_million(cost: Column) -> Column:
    return F.round(cost * 1e6, 6)


def built_rates(costs: dict[str, Column], factor: Column) -> Column:
    """Costs a token in a quoted currency as USD rates a million tokens; null if there is none."""
    rates = F.struct(*[(per_million(costs[a] * factor) if a in costs else F.lit(None).cast("double")).alias(a) for a in AXES])
    return F.when(F.coalesce(*[rates[a] for a in AXES]).isNotNull(), rates)


def built_overrides(windows: Column, peak_costs: dict[str, Column], factor: Column) -> Column:
    """One override for each peak window, or one without a window; null if no peak cost is quoted."""
    rates = built_rates(peak_costs, factor)

    def entry(window: Column) -> Column:
        when = F.struct(F.lit(None).cast("array<string>").alias("days"), window.cast("array<int>").alias("window"), F.when(window.isNotNull(), F.lit("UTC")).alias("timezone"), F.lit(None).cast("bigint").alias("min_tokens"), F.lit(None).cast("string").alias("mode"))
        return F.struct(F.when(window.isNotNull(), when).alias("when"), rates.cast(RATES).alias("rates"), F.lit(None).cast("double").alias("quota_multiplier"))

    each = F.transform(windows, entry)
    return F.when(rates.isNotNull(), F.when(F.size(F.coalesce(windows, F.array())) > 0, each).otherwise(F.array(entry(F.lit(None).cast("array<int>")))))


def removal_row(last: Column, today: Column) -> Column:
    """A removal: the key and comparable fields of the last priced row, dated today."""
    return last.withField("observed_at", today).withField("removed", F.lit(True))
