"""A listing of an API, one JSON document a fetch, as rows of the contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import in_order
from ..schema import AXES, DAYS, MODALITIES, RATES

# A listing's price keys and the axes they are.
PRICES = (("prompt", "input"), ("completion", "output"), ("input_cache_read", "cache_read"), ("input_cache_write", "cache_write"), ("input_cache_write_1h", "cache_write_1h"))
KINDS = (("image", "image"), ("audio", "audio"), ("input_audio_cache", "input_audio_cache"), ("internal_reasoning", "internal_reasoning"), ("image_output", "image_output"), ("audio_output", "audio_output"))
FEE = "web_search"
KEYS = tuple(k for k, _ in PRICES + KINDS)
#: Keys that an override may have, by kind: fixed values too.
PLAN_KEYS, VOLUME_KEYS = ("utc_days", "utc_start", "utc_end", *(k for k, _ in PRICES)), ("min_prompt_tokens", *KEYS)
_OVERRIDE = "struct<utc_days:array<string>,utc_start:int,utc_end:int,min_prompt_tokens:double," + ",".join(f"{k}:string" for k in KEYS) + ">"
_ENTRY = "struct<id:string,name:string,canonical_slug:string,alias_target:string,context_length:bigint,pricing:map<string,string>,architecture:struct<output_modalities:array<string>>>"


def rates_of(price, keep_zero: bool) -> Column:
    """Rates a million tokens of prices a token: `price` gives a key's text. Negative ones go, zero ones too in an override, where they mean the base."""
    value = {axis: price(key).try_cast("double") for key, axis in PRICES + KINDS}
    kept = {a: F.when(v >= 0 if keep_zero else v > 0, F.round(v * 1e6, 6)) for a, v in value.items()}
    rates = F.struct(*[kept.get(a, F.lit(None).cast("double")).alias(a) for a in AXES]).cast(RATES)
    return F.when(F.coalesce(*[rates[a] for a in AXES]).isNotNull(), rates)


def override_rows(entries: Column) -> Column:
    """Overrides of the contract: a schedule gives one for each same-day window (two over midnight), a threshold one with min_tokens."""

    def when(o: Column, start: Column, end: Column) -> Column:
        window = F.when(start.isNotNull(), F.array(start, end))
        plan = o["utc_days"].isNotNull() | window.isNotNull()
        return F.struct(F.when(o["utc_days"].isNotNull(), in_order(o["utc_days"])).alias("days"), window.alias("window"), F.when(plan, F.lit("UTC")).alias("timezone"), o["min_prompt_tokens"].cast("bigint").alias("min_tokens"), F.lit(None).cast("string").alias("mode"))

    def entry(o: Column, start: Column, end: Column) -> Column:
        return F.struct(when(o, start, end).alias("when"), rates_of(lambda k: o[k], False).alias("rates"), F.lit(None).cast("double").alias("quota_multiplier"))

    def each(o: Column) -> Column:
        start, end = o["utc_start"], F.when(o["utc_end"] == 0, 2400).otherwise(o["utc_end"])
        return F.when(start > end, F.array(entry(o, start, F.lit(2400)), entry(o, F.lit(0), end))).otherwise(F.array(entry(o, start, end)))

    made = F.flatten(F.transform(entries, each))
    return F.filter(made, lambda o: o["rates"].isNotNull())


def modality(outputs: Column) -> Column:
    """The one output that isn't text; null where text is among them, or where there are several others or an unknown one (see faults_of)."""
    text = F.array_contains(outputs, "text") | outputs.isNull()
    return F.when(~text & ~bad_modality(outputs), F.get(F.array_distinct(outputs), 0))


def bad_modality(outputs: Column) -> Column:
    known = F.array(*[F.lit(m) for m in MODALITIES])
    others = F.array_distinct(outputs)
    text = F.array_contains(outputs, "text") | outputs.isNull()
    return ~text & ((F.size(others) != 1) | (F.size(F.array_except(others, known)) > 0))


def bad_override(text: Column) -> Column:
    """What is wrong with an override (JSON): a key that its kind doesn't have, a price that isn't a number, days that aren't, a bound alone, a threshold that isn't whole and positive; null if nothing is."""
    keys = F.json_object_keys(text)
    o = F.from_json(text, _OVERRIDE)
    volume = F.array_contains(keys, "min_prompt_tokens")
    plan = F.array_contains(keys, "utc_days") | F.array_contains(keys, "utc_start") | F.array_contains(keys, "utc_end")
    unknown = F.when(volume & ~plan, F.array_except(keys, F.array(*map(F.lit, VOLUME_KEYS)))).when(plan & ~volume, F.array_except(keys, F.array(*map(F.lit, PLAN_KEYS))))
    prices = F.array(*[o[k] for k in KEYS])
    week = F.array(*map(F.lit, DAYS))
    clock = lambda x: x.isNotNull() & ((x < 0) | (x > 2400) | (x % 100 > 59))
    n = o["min_prompt_tokens"]
    return (
        F.when(F.size(unknown) > 0, "unknown key")
        .when(F.exists(prices, lambda p: p.isNotNull() & p.try_cast("double").isNull()), "price")
        .when(F.array_contains(keys, "utc_days") & ((F.coalesce(F.size(o["utc_days"]), F.lit(0)) <= 0) | (F.size(F.array_except(o["utc_days"], week)) > 0)), "days")
        .when(plan & (F.array_contains(keys, "utc_start") != F.array_contains(keys, "utc_end")), "one bound")
        .when(plan & (clock(o["utc_start"]) | clock(o["utc_end"])), "clock")
        .when(volume & ~F.coalesce((n > 0) & (n == F.floor(n)), F.lit(False)), "threshold")
    )


def faults_of(price: Column, outputs: Column) -> Column:
    """Why an entry gives no row: its modality, a price that isn't a number, or an override; null if nothing is wrong."""
    texts = F.array(*[F.try_element_at(price, F.lit(k)) for k in (*KEYS, FEE)])
    each = F.transform(F.from_json(F.try_element_at(price, F.lit("overrides")), "array<string>"), bad_override)
    over = F.get(F.filter(each, lambda f: f.isNotNull()), 0)
    return F.when(bad_modality(outputs), "output modalities").when(F.exists(texts, lambda p: p.isNotNull() & p.try_cast("double").isNull()), "price").when(over.isNotNull(), F.concat(F.lit("override: "), over))


def listing_rows(bodies: DataFrame, source: str, day: str, body: str = "body") -> DataFrame:
    """Rows of every model of the listings in `bodies`: no row for an alias or a variant (an id whose canonical slug is another listed id).

    A listing is one document, so one task reads it; its models are rows from there on. Entries without an id are left out, as are those
    that listing_faults() reports. Overrides of neither a plan nor a volume are kept as unmapped. A body that isn't a listing gives no rows.
    """
    return _listed(bodies, source, day, body).where("fault is null").drop("fault")


def listing_faults(bodies: DataFrame, source: str, body: str = "body") -> DataFrame:
    """(model_id, fault) of entries that give no row, as something in them can't be read."""
    return _listed(bodies, source, "", body).where("fault is not null").select("model_id", "fault")


def _listed(bodies: DataFrame, source: str, day: str, body: str) -> DataFrame:
    data = bodies.select(F.explode(F.from_json(body, f"struct<data:array<{_ENTRY}>>")["data"]).alias("m")).select("m.*").where("id is not null and id <> ''")
    ids = data.select(F.col("id").alias("canonical_slug")).distinct()
    variant = F.col("canonical_slug").isNotNull() & (F.col("canonical_slug") != F.col("id")) & F.col("_listed").isNotNull()
    own = data.join(ids.withColumn("_listed", F.lit(True)), "canonical_slug", "left").where(F.col("alias_target").isNull() & ~variant)
    price = F.coalesce("pricing", F.create_map().cast("map<string,string>"))
    each = F.from_json(F.try_element_at(price, F.lit("overrides")), "array<string>")
    mapped = lambda t: F.size(F.array_intersect(F.json_object_keys(t), F.array(*map(F.lit, ("utc_days", "utc_start", "utc_end", "min_prompt_tokens"))))) > 0
    overrides = F.transform(F.filter(each, mapped), lambda t: F.from_json(t, _OVERRIDE))
    left = F.filter(each, lambda t: ~mapped(t))
    fee = F.try_element_at(price, F.lit(FEE)).try_cast("double")
    rest = F.map_filter(price, lambda k, _: ~k.isin([*KEYS, FEE, "overrides"]))
    name = F.regexp_replace("name", r"^[^:]*: ", "")
    return own.select(
        F.lit(4).alias("schema"),
        F.lit(source).alias("source"),
        F.col("id").alias("model_id"),
        F.lit(day).alias("observed_at"),
        modality(F.col("architecture.output_modalities")).alias("modality"),
        rates_of(lambda k: F.try_element_at(price, F.lit(k)), True).alias("rates"),
        F.when(F.size(override_rows(overrides)) > 0, override_rows(overrides)).alias("overrides"),
        F.when(fee >= 0, F.struct(fee.alias("web_search"))).alias("fees"),
        F.when(F.col("context_length") > 0, F.struct(F.col("context_length").alias("context"))).alias("limits"),
        F.when((F.size(rest) > 0) | (F.size(left) > 0), F.to_json(F.map_concat(rest, F.when(F.size(left) > 0, F.create_map(F.lit("overrides"), F.to_json(left))).otherwise(F.create_map().cast("map<string,string>"))))).alias("unmapped"),
        F.when(name != "", F.struct(name.alias("name"))).alias("provenance"),
        faults_of(price, F.col("architecture.output_modalities")).alias("fault"),
    )
