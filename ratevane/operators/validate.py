"""The row contract as one expression: the first fault of a row, or null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import AXES, DAYS, FIELDS, LIMITS, MODALITIES, VERSION

DATE = r"^\d{4}-\d{2}-\d{2}$"


def _finite(x: Column) -> Column:
    return ~F.isnan(x) & (F.abs(x) < float("inf"))


def price_fault(x: Column) -> Column:
    """A base price or fee is finite and not negative."""
    return x.isNotNull() & ~(_finite(x) & (x >= 0))


def override_fault(o: Column) -> Column:
    """What an override may not be: without rates and multiplier, unconditional with rates, or with a bad day-set, window, threshold, mode, zone or rate."""
    when, rates, multiple = o["when"], o["rates"], o["quota_multiplier"]
    days, window = when["days"], when["window"]
    start, end = F.get(window, 0), F.get(window, 1)
    bad_days = days.isNotNull() & ((F.size(days) == 0) | (F.size(F.array_distinct(days)) < F.size(days)) | F.exists(days, lambda d: ~F.coalesce(d.isin(list(DAYS)), F.lit(False))))
    bad_window = window.isNotNull() & ~F.coalesce((F.size(window) == 2) & (start >= 0) & (start < end) & (end <= 2400) & (start % 100 < 60) & (end % 100 < 60), F.lit(False))
    bad_tokens = when["min_tokens"].isNotNull() & (when["min_tokens"] <= 0)
    bad_mode = when["mode"].isNotNull() & (when["mode"] == "")
    bad_zone = when["timezone"].isNotNull() & ((when["timezone"] != "UTC") | (days.isNull() & window.isNull()))
    bare = rates.isNotNull() & days.isNull() & window.isNull() & when["min_tokens"].isNull() & when["mode"].isNull()
    bad_rate = F.lit(False)
    for a in AXES:
        bad_rate = bad_rate | (rates[a].isNotNull() & ~(_finite(rates[a]) & (rates[a] > 0)))
    bad_multiple = multiple.isNotNull() & ~(_finite(multiple) & (multiple > 0))
    return F.coalesce((rates.isNull() & multiple.isNull()) | bad_multiple | bad_days | bad_window | bad_tokens | bad_mode | bad_zone | bare | bad_rate, F.lit(True))


def unknown_keys(line: Column, known: tuple[str, ...] = FIELDS) -> Column:
    """Keys of a JSON object that the contract doesn't know."""
    return F.array_except(F.coalesce(F.json_object_keys(line), F.array().cast("array<string>")), F.array(*[F.lit(k) for k in known]))


def fault(line: Column | None = None) -> Column:
    """The name of the first fault of a row of the contract's fields, in the contract's order; null for a valid row. `line`, its JSON, gives unknown keys too."""
    c = F.col
    foreign = c("currency").isNotNull() & (c("currency") != "USD")
    fx, fx_day = c("provenance.fx_rate"), c("provenance.fx_rate_date")
    rules = [
        ("unknown", F.size(unknown_keys(line)) > 0 if line is not None else F.lit(False)),
        ("missing", F.coalesce(c("schema"), F.lit(None)).isNull() | c("source").isNull() | c("model_id").isNull() | c("observed_at").isNull()),
        ("schema", c("schema") != VERSION),
        ("source", c("source") == ""),
        ("model_id", c("model_id") == ""),
        ("modality", c("modality").isNotNull() & ~c("modality").isin(list(MODALITIES))),
        ("observed_at", ~c("observed_at").rlike(DATE)),
        ("effective_at", c("effective_at").isNotNull() & ~c("effective_at").rlike(DATE)),
        ("removed", c("removed").isNotNull() & ~c("removed")),
        ("currency", c("currency").isNotNull() & ~c("currency").rlike("^[A-Z]{3}$")),
        ("rates", c("rates").isNotNull() & (F.coalesce(*[c(f"rates.{a}") for a in AXES]).isNull() | _any([price_fault(c(f"rates.{a}")) for a in AXES]))),
        ("fees", c("fees").isNotNull() & _any([price_fault(c(f"fees.{a}")) for a in ("web_search", "search", "fetch")])),
        ("limits", c("limits").isNotNull() & _any([c(f"limits.{a}").isNotNull() & (c(f"limits.{a}") <= 0) for a in LIMITS])),
        ("fx_rate", foreign & ~F.coalesce(_finite(fx) & (fx > 0), F.lit(False))),
        ("fx_pair", ~foreign & (fx.isNotNull() | fx_day.isNotNull())),
        ("fx_rate_date", fx_day.isNotNull() & ~fx_day.rlike(DATE)),
        ("overrides", c("overrides").isNotNull() & ((F.size("overrides") == 0) | F.exists("overrides", override_fault))),
    ]
    return F.coalesce(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in rules])


def _any(columns: list[Column]) -> Column:
    out = F.lit(False)
    for x in columns:
        out = out | F.coalesce(x, F.lit(False))
    return out


def require_valid(rows: DataFrame) -> DataFrame:
    """`rows`, or an error that names the first fault met."""
    bad = fault()
    return rows.withColumn("source", F.when(bad.isNull(), F.col("source")).otherwise(F.raise_error(F.concat(F.lit("row fails the contract: "), bad))))
