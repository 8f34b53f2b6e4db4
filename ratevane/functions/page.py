"""Texts and shapes of the page and of reports, as expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import AXES, LIMITS, OVERRIDES
from .text import clock, clock_of_minutes, fixed

#: What an axis is called on the page, where its name doesn't say it; in reports; and the sign for nothing.
LABELS = {"cache_read": "cached input"}
REPORT = (("input", "input"), ("cache_read", "cache read"), ("cache_write", "cache write"), ("cache_write_1h", "cache write 1h"), ("output", "output"))
DASH = "—"


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def general(x: Column) -> Column:
    """A number with six significant digits, no trailing zeros; beyond six digits or below 0.0001 with an exponent of two digits or more."""
    trimmed = lambda t: F.regexp_replace(F.regexp_replace(t, r"(\.\d*?)0+$", "$1"), r"\.$", "")

    def written(v: Column) -> Column:
        def shown(p: Column) -> Column:
            e, m = p["e"], p["m"]
            power = F.concat(trimmed(F.format_string("%.5f", m)), F.when(e < 0, "e-").otherwise("e+"), F.lpad(F.abs(e).cast("string"), F.when(F.abs(e) > 99, 3).otherwise(2), F.lit("0")))
            plain = trimmed(F.format_string("%.10f", F.round(m * 100_000) / F.pow(F.lit(10.0), 5 - e)))
            return F.when((e < -4) | (e >= 6), power).otherwise(plain)

        raised = lambda p: F.named_struct(F.lit("e"), p["e"] + (p["m"] >= 10).cast("int"), F.lit("m"), F.when(p["m"] >= 10, p["m"] / 10).otherwise(p["m"]))
        scaled = lambda e: F.named_struct(F.lit("e"), e, F.lit("m"), F.round(v / F.pow(F.lit(10.0), e), 5))
        return once(F.floor(F.log10(v)).cast("int"), lambda e: once(once(scaled(e), raised), shown))

    return F.when(x.isNull(), DASH).when(x == 0, "0").otherwise(F.concat(F.when(x < 0, "-").otherwise(""), once(F.abs(x), written)))


def rate(x: Column) -> Column:
    """A rate at the shortest form that is that number: whole ones without a fraction, an exponent from 1e21 on and below 0.000001."""

    def parts(v: Column) -> Column:
        text = v.cast("string")
        digits = F.regexp_replace(F.regexp_extract(text, r"^-?([\d.]+)", 1), r"\.0$", "")
        return F.named_struct(F.lit("size"), F.abs(v), F.lit("digits"), digits, F.lit("exp"), F.coalesce(F.regexp_extract(text, r"E(-?\d+)$", 1).try_cast("int"), F.lit(0)))

    def laid(p: Column) -> Column:
        digits, dot = p["digits"], F.instr(p["digits"], ".")
        point = F.when(dot > 0, dot - 1).otherwise(F.length(digits)) + p["exp"]
        return F.named_struct(F.lit("p"), p, F.lit("body"), F.replace(digits, F.lit("."), F.lit("")), F.lit("point"), point)

    def shown(q: Column) -> Column:
        size, digits, exp, body, point = q["p"]["size"], q["p"]["digits"], q["p"]["exp"], q["body"], q["point"]
        wide = F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), body)).when(point >= F.length(body), F.concat(body, F.repeat(F.lit("0"), point - F.length(body)))).otherwise(F.concat(F.substring(body, F.lit(1), point), F.lit("."), F.substring(body, point + 1, F.length(body))))
        tiny = F.concat(F.regexp_replace(digits, r"\.$", ""), F.lit("e"), F.when(exp > 0, "+").otherwise(""), exp.cast("string"))
        return F.when(exp == 0, digits).when((size < 1e-6) | (size >= 1e21), tiny).otherwise(wide)

    written = once(once(once(x.cast("double"), parts), laid), shown)
    return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), F.lit(DASH)).otherwise(F.concat(F.when(x < 0, "-").otherwise(""), written))


def money(x: Column) -> Column:
    """Two places from a dollar up, four from a cent up, else three significant digits; what isn't positive is 0.00."""
    e = F.floor(F.log10(x)).cast("int")
    n = F.round(x * F.pow(F.lit(10.0), 2 - e))
    e, n = F.when(n >= 1000, e + 1).otherwise(e), F.when(n >= 1000, n / 10).otherwise(n)
    digits = F.format_string("%.0f", n)
    small = F.when(e < -6, F.concat(F.substring(digits, 1, 1), F.lit("."), F.substring(digits, 2, 2), F.lit("e"), e.cast("string"))).otherwise(F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), digits))
    return F.when(~F.coalesce(x > 0, F.lit(False)), "0.00").when(x >= 1, fixed(x, 2)).when(x >= 0.01, fixed(x, 4)).otherwise(small)


def times(total: Column, cheapest: Column) -> Column:
    """How many times the cheapest a total is; of a cheapest of nothing, only nothing is once."""
    share = F.concat(fixed(total / cheapest, 2), F.lit("×"))
    return F.when(total.isNull() | cheapest.isNull(), DASH).when(cheapest == 0, F.when(total == 0, "1.00×").otherwise(DASH)).otherwise(share)


def at_rate(rate_: Column, *counts: Column) -> Column:
    """A session at one flat rate for a million tokens."""
    total = counts[0]
    for n in counts[1:]:
        total = total + n
    return total / 1e6 * rate_


def token_count(text: Column, fallback: Column) -> Column:
    """A whole count of what can be read as a number that isn't negative; else the fallback."""
    n = F.when(F.trim(text) == "", F.lit(0.0)).otherwise(F.trim(text).try_cast("double"))
    return F.when((n >= 0) & (n < float("inf")), F.floor(n)).otherwise(fallback).cast("bigint")


def label(axis: str) -> str:
    return LABELS.get(axis, axis.replace("_", " "))


def rates_text(rates: Column) -> Column:
    return F.concat_ws(", ", *[F.when(rates[a].isNotNull(), F.concat(F.lit(label(a) + " "), rate(rates[a]))) for a in AXES])


def when_text(when: Column) -> Column:
    """A condition on the page; its window in minutes of the UTC day."""
    window = F.when(F.size(when["window"]) == 2, F.concat(clock_of_minutes(F.get(when["window"], 0)), F.lit(" to "), clock_of_minutes(F.get(when["window"], 1)), F.lit(" UTC")))
    parts = F.concat_ws(", ", F.when(F.size(when["days"]) > 0, F.array_join(when["days"], ", ")), window, F.concat(F.lit("above "), when["min_tokens"].cast("string"), F.lit(" tokens")), F.concat(F.lit("mode "), F.nullif(when["mode"], F.lit(""))), F.concat(F.lit("schedule zone "), F.nullif(when["timezone"], F.lit(""))))
    return F.when(parts == "", "any request").otherwise(parts)


def override_text(override: Column) -> Column:
    return F.concat_ws(": ", when_text(override["when"]), F.nullif(rates_text(override["rates"]), F.lit("")), F.when(override["quota_multiplier"].isNotNull(), F.concat(F.lit("× "), rate(override["quota_multiplier"]))))


def report_when(when: Column) -> Column:
    """A condition in a report: its window as clock numbers."""
    window = F.when(F.size(when["window"]) == 2, F.concat(clock(F.get(when["window"], 0)), F.lit("-"), clock(F.get(when["window"], 1))))
    parts = F.concat_ws(" ", F.when(F.size(when["days"]) > 0, F.array_join(when["days"], ", ")), window, F.concat(F.lit("over "), when["min_tokens"].cast("string"), F.lit(" tokens")), F.concat(when["mode"], F.lit(" mode")), when["timezone"])
    return F.when(parts == "", DASH).otherwise(parts)


def removal_text(rates: Column) -> Column:
    """A removal's last prices, as far as it has any."""
    parts = F.concat_ws(" / ", *[F.when(rates[a].isNotNull(), F.concat(F.lit(name + " "), general(rates[a]))) for a, name in REPORT])
    return F.when(parts == "", "not carried").otherwise(parts)


def quoted(usd: Column, fx_rate: Column) -> Column:
    """The quoted rate that a USD rate was converted from."""
    return general(usd / fx_rate)


def cache_writes(rates: Column) -> Column:
    five, hour = rates["cache_write"], rates["cache_write_1h"]
    return F.when(five.isNull() & hour.isNull(), DASH).when(hour.isNull(), general(five)).otherwise(F.concat_ws("/", general(five), general(hour)))


def timed(overrides: Column) -> Column:
    """Overrides with a clock window."""
    return F.filter(overrides, lambda o: F.size(o["when"]["window"]) == 2)


def peak_rate(base: Column, overrides: Column, axis: str) -> Column:
    """The highest of a base rate and those of clock-window overrides; null if nothing prices the axis."""
    return F.array_max(F.concat(F.array(base[axis]), F.coalesce(F.transform(timed(overrides), lambda o: o["rates"][axis]), F.array(base[axis]))))


def peak_moves(base: Column, overrides: Column, axes: tuple[str, ...] = ("input", "cache_read", "output")) -> Column:
    """Whether a peak rate differs from its base."""
    moved = F.lit(False)
    for a in axes:
        moved = moved | ~peak_rate(base, overrides, a).eqNullSafe(base[a])
    return moved


def found(needle: Column, name: Column, vendor: Column) -> Column:
    """Whether an entry is shown for what is searched: case and blanks around it don't count, blanks alone show everything, nothing is a wildcard."""
    sought = F.lower(F.trim(F.coalesce(needle, F.lit(""))))
    holds = lambda x: F.contains(F.lower(F.coalesce(x, F.lit(""))), sought)
    return (sought == "") | holds(name) | holds(vendor)


def sort_value(entry: dict[str, Column], key: str, peak: bool) -> Column:
    """What a table is sorted by: a rate or its peak, else lower-case text; null is a missing fact."""
    if key in ("input", "cache_read", "output"):
        return peak_rate(entry["rates"], entry["overrides"], key) if peak else entry["rates"][key]
    if key == "vendor":
        return F.lower(F.nullif(entry["vendor"], F.lit("")))
    return F.lower(F.coalesce(F.nullif(entry["name"], F.lit("")), entry["model_id"]))


def polyline(points: Column, end: Column, start: Column, finish: Column, top: Column, flat: Column) -> Column:
    """A run's steps in a box of 100 by 100: each value holds to the next point, the last to the run's end or the domain's. `points` has (date, value) in order."""
    days = lambda d: F.unix_date(F.to_date(d)).cast("double")
    span = F.greatest(days(finish) - days(start), F.lit(1.0))
    x = lambda d: F.least(F.lit(100.0), F.greatest(F.lit(0.0), (days(d) - days(start)) / span * 100))
    y = lambda v: F.when(flat, 50.0).when(top > 0, 100 - v / top * 100).otherwise(100.0)
    two = lambda v: rate(F.floor(v * 100 + 0.5) / 100)
    at = lambda a, b: F.concat(two(a), F.lit(","), two(b))
    first = at(x(F.get(points, 0)["date"]), y(F.get(points, 0)["value"]))
    steps = F.flatten(F.transform(F.sequence(F.lit(1), F.size(points) - 1), lambda i: F.array(at(x(F.get(points, i)["date"]), y(F.get(points, i - 1)["value"])), at(x(F.get(points, i)["date"]), y(F.get(points, i)["value"])))))
    last = at(F.least(F.lit(100.0), (days(F.coalesce(end, finish)) - days(start)) / span * 100), y(F.element_at(points, -1)["value"]))
    every = F.concat(F.array(first), F.when(F.size(points) > 1, steps).otherwise(F.array().cast("array<string>")), F.array(last))
    return F.when(F.size(points) > 0, F.array_join(every, " ")).otherwise("")


def chart_text(name: Column, axis: str, runs: Column, removed: Column) -> Column:
    """A chart in words. `runs` has (points, end) in order."""
    step = lambda p: F.concat(rate(p["value"]), F.lit(" from "), p["date"])
    spans = F.transform(runs, lambda r: F.concat(F.array_join(F.transform(r["points"], step), ", "), F.coalesce(F.concat(F.lit(", the line stops at "), r["end"]), F.lit(""))))
    tail = F.when(F.element_at(runs, -1)["end"].isNull(), "").when(removed, "; the model was removed there").otherwise(f"; no later era prices {label(axis)}")
    said = F.concat(F.lit(f"{label(axis)} price per million tokens: "), F.array_join(spans, "; then "), tail, F.lit("."))
    return F.when(F.size(runs) > 0, said).otherwise(F.concat(F.lit(f"no {label(axis)} rate is recorded for "), name, F.lit(".")))


def detail_rows(flat: DataFrame, peak: bool = False) -> DataFrame:
    """(source, model_id, ord, label, value, number) of what an entry's details show, in their order; `number` is a rate's own value.

    Rates (at their peak if `peak`), the currency of the quote, limits, overrides, days, the era that holds, and the day of a removal; what an
    entry doesn't have has no row, but for the open end of its era. `flat` has the entries with their intervals.
    """
    none = F.lit(None)
    row = lambda label_, value, number=none: F.struct(F.lit(label_).alias("label") if isinstance(label_, str) else label_.alias("label"), value.cast("string").alias("value"), number.cast("double").alias("number"))
    filled = lambda x: F.nullif(x.cast("string"), F.lit(""))
    rates_ = []
    for a in AXES:
        own = peak_rate(F.col("rates"), F.col("overrides"), a) if peak else F.col(f"rates.{a}")
        rates_.append(row(f"rate {label(a)}", F.when(own.isNotNull(), rate(own)), own))
    limits = [row(f"limit {label(x)}", F.col(f"limits.{x}")) for x in LIMITS]
    overrides = F.transform(F.coalesce("overrides", F.array().cast(OVERRIDES)), lambda o, i: row(F.concat(F.lit("override "), (i + 1).cast("string")), override_text(o)))
    solid = F.filter("intervals", lambda x: (x["valid_to"].isNull() | (x["valid_to"] > x["valid_from"])) & ~F.coalesce(x["removed"], F.lit(False)))
    era = F.try_element_at(F.array_sort(F.transform(solid, lambda x: F.struct(x["observed_at"].alias("at"), x["valid_from"].alias("from"), x["valid_to"].alias("to")))), F.lit(-1))
    ends = [row("first seen", filled(F.col("first_seen"))), row("observed", filled(F.col("observed_at"))), row("valid from", filled(era["from"])), row("valid to", F.when(era.isNotNull(), F.coalesce(era["to"], F.lit(DASH)))), row("removed", filled(F.col("removed_at")))]
    whole = F.concat(F.array(*rates_, row("quoted in", filled(F.col("currency")))), F.array(*limits), overrides, F.array(*ends))
    return flat.select("source", "model_id", F.posexplode(F.filter(whole, lambda r: r["value"].isNotNull())).alias("ord", "r")).select("source", "model_id", "ord", "r.*")


def restored(state: DataFrame, entries: DataFrame) -> DataFrame:
    """(key) of a decoded fragment's keys (`state`: pos, key as source/id) that name an entry for chats, in their order, each once; unknown ones and other modalities are dropped."""
    known = entries.where("modality is null").select(F.concat_ws("/", "source", "model_id").alias("key")).distinct()
    return state.groupBy("key").agg(F.min("pos").alias("pos")).join(known, "key", "left_semi").select("key", "pos")
