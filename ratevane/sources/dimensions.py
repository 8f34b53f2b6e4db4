"""Files of dimensions and state: loads that refuse what breaks their contract, and sinks."""

from __future__ import annotations

import math
import tomllib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import real_day, slug, unwrapped, wrapped
from .documents import write_document
from .observations import SHARD_NAME, exists

CATALOG_VERSION = 4
ANNOUNCE = "state/announce"
# Keys of the files, and the source that no section stands for.
ENTRY_KEYS = ("name", "vendor", "curated", "sources")
ALIAS_KEYS = ("from", "to", "canonical", "citation")
RULE_KEYS = ("id", "provider", "effective", "timezone", "statement", "citation")
PROVIDER_KEYS = ("provider", "detector", "detector_url", "scraper", "scraper_url", "kind")
OPTIONAL_KEYS = ("announce_urls", "currency_rate", "vendor")
KINDS = ("first_party", "reseller")
GENERATED = ("openrouter", "OpenRouter", None, "reseller")

_MAP = "map<string,variant>"


def kind(v: Column) -> Column:
    """The type of a variant in words; VOID for JSON's null, null where nothing is."""
    return F.schema_of_variant(v)


def text_of(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def filled(v: Column) -> Column:
    """Whether a variant is a string that isn't empty."""
    return F.coalesce((kind(v) == "STRING") & (text_of(v) != ""), F.lit(False))


def has(m: Column, key: str) -> Column:
    return F.map_contains_key(m, F.lit(key))


def at(m: Column, key: str) -> Column:
    return F.try_element_at(m, F.lit(key))


def given(m: Column, key: str) -> Column:
    """Whether a key stands there with another value than null."""
    return has(m, key) & (F.coalesce(kind(at(m, key)), F.lit("VOID")) != "VOID")


def first_fault(*checks: tuple[Column, str]) -> Column:
    out = F.lit(None).cast("string")
    for bad, name in reversed(checks):
        out = F.when(bad, F.lit(name)).otherwise(out)
    return out


def refuse(rows: DataFrame, fault: str, *label: str) -> DataFrame:
    """`rows` without the fault's column; any fault stops the query with its label."""
    named = F.concat_ws(" ", *[F.col(x) for x in label], F.col(fault))
    kinds = {f.name: f.dataType for f in rows.schema}
    return rows.select(*[F.when(F.col(fault).isNotNull(), F.raise_error(named).cast(kinds[c])).otherwise(F.col(c)).alias(c) for c in rows.columns if c != fault])


def document(spark: SparkSession, path: str) -> DataFrame:
    """(path, v): each document as a variant; null where it isn't JSON. No file gives no rows. Part files of a folder are one document, in the order of their names."""
    files = spark.read.option("ignoreMissingFiles", "true").text(path, wholetext=True).select(F.regexp_replace(F.col("_metadata.file_path"), r"/part-[^/]*$", "").alias("path"), F.col("_metadata.file_path").alias("file"), "value")
    whole = files.groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("file", "value"))), lambda x: x["value"]), "").alias("value"))
    return whole.select("path", F.try_parse_json("value").alias("v"))


def _versioned(doc: DataFrame, key: str) -> DataFrame:
    """(path, m): the object under `key` of files of the catalog's version; another shape stops the query."""
    version = F.try_variant_get("v", "$.version", "int")
    bad = first_fault((F.col("v").isNull(), "isn't JSON"), (~F.coalesce(version == CATALOG_VERSION, F.lit(False)), f"isn't of version {CATALOG_VERSION}"), (F.try_variant_get("v", f"$.{key}", _MAP).isNull(), f"has no {key}"))
    return refuse(doc.select("path", F.try_variant_get("v", f"$.{key}", _MAP).alias("m"), bad.alias("bad")), "bad", "path")


def catalog(spark: SparkSession, path: str, allow_missing: bool = True, strict: bool = True) -> DataFrame:
    """(canonical, name, vendor, curated, source, model_id, fault) of a catalog's entries, a row for each id; one id may stand alone or in a list.

    Keys are closed; vendor is required and may be null; name and vendor aren't empty; curated is a boolean; sources map names to ids, none
    of them empty. A fault stops the query if `strict`. A missing file has no entries, or is an error.
    """
    if not exists(spark, path):
        if not allow_missing:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], "canonical string, name string, vendor string, curated boolean, source string, model_id string, fault string")
    e = _versioned(document(spark, path), "models").select(F.explode("m").alias("canonical", "v")).select("canonical", F.try_variant_get("v", "$", _MAP).alias("e"))
    sources = F.try_variant_get(at(F.col("e"), "sources"), "$", _MAP)
    own = first_fault(
        (F.col("canonical") == "", "empty canonical id"),
        (F.col("e").isNull(), "isn't an object"),
        (F.size(F.array_except(F.map_keys("e"), F.array(*map(F.lit, ENTRY_KEYS)))) > 0, "unknown key"),
        (given(F.col("e"), "name") & ~filled(at(F.col("e"), "name")), "name"),
        (given(F.col("e"), "vendor") & ~filled(at(F.col("e"), "vendor")), "vendor"),
        (~has(F.col("e"), "vendor"), "missing vendor"),
        (~F.coalesce(kind(at(F.col("e"), "curated")) == "BOOLEAN", F.lit(False)), "curated"),
        (F.coalesce(F.size(sources), F.lit(0)) <= 0, "sources"),
    )
    flat = e.select("canonical", text_of(at(F.col("e"), "name")).alias("name"), text_of(at(F.col("e"), "vendor")).alias("vendor"), F.try_variant_get(at(F.col("e"), "curated"), "$", "boolean").alias("curated"), own.alias("own"), F.explode_outer(sources).alias("source", "v"))
    one = kind(F.col("v")) == "STRING"
    ids = F.when(one, F.array(text_of(F.col("v")))).when(kind(F.col("v")) == "ARRAY<STRING>", F.try_variant_get("v", "$", "array<string>"))
    deep = first_fault((F.col("own").isNotNull(), "entry"), (F.coalesce("source", F.lit("")) == "", "empty source"), (F.coalesce(F.size(ids), F.lit(0)) <= 0, "ids"), (F.exists(ids, lambda x: x.isNull() | (x == "")), "empty id"))
    rows = flat.select("canonical", "name", "vendor", "curated", "source", F.explode_outer(ids).alias("model_id"), F.coalesce("own", deep).alias("fault"))
    return refuse(rows.withColumn("f", F.col("fault")), "fault", "canonical").withColumnRenamed("f", "fault") if strict else rows


def aliases(spark: SparkSession, path: str, models: DataFrame | None = None, strict: bool = True) -> DataFrame:
    """(alias, valid_from, valid_to, canonical, citation, fault): half-open ranges with open ends; canonical must be one of `models` where given. A missing file has none."""
    schema = "alias string, valid_from string, valid_to string, canonical string, citation string, fault string"
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    a = _versioned(document(spark, path), "aliases").select(F.explode("m").alias("alias", "v"))
    each = a.select("alias", F.explode_outer(F.try_variant_get("v", "$", "array<variant>")).alias("v")).select("alias", F.try_variant_get("v", "$", _MAP).alias("r"))
    r = F.col("r")
    day = lambda k: ~given(r, k) | F.coalesce((kind(at(r, k)) == "STRING") & real_day(text_of(at(r, k))), F.lit(False))
    own = first_fault(
        (F.col("alias") == "", "empty alias"),
        (r.isNull(), "records"),
        (F.size(F.array_except(F.map_keys(r), F.array(*map(F.lit, ALIAS_KEYS)))) > 0, "unknown key"),
        (~filled(at(r, "canonical")), "canonical"),
        (~has(r, "from") | ~has(r, "to"), "missing bound"),
        (~day("from") | ~day("to"), "bound isn't a day"),
        (F.coalesce(text_of(at(r, "from")) >= text_of(at(r, "to")), F.lit(False)), "empty range"),
        (~F.coalesce(text_of(at(r, "citation")).rlike("^https?://"), F.lit(False)), "citation"),
    )
    rows = each.select("alias", text_of(at(r, "from")).alias("valid_from"), text_of(at(r, "to")).alias("valid_to"), text_of(at(r, "canonical")).alias("canonical"), text_of(at(r, "citation")).alias("citation"), own.alias("fault"))
    if models is not None:
        known = models.select("canonical").distinct().withColumn("_known", F.lit(True))
        rows = rows.join(known, "canonical", "left").withColumn("fault", F.coalesce("fault", F.when(F.col("_known").isNull(), "canonical isn't in the catalog"))).drop("_known")
    rows = rows.select("alias", "valid_from", "valid_to", "canonical", "citation", "fault")
    return refuse(rows.withColumn("f", F.col("fault")), "fault", "alias").withColumnRenamed("f", "fault") if strict else rows


def providers(spark: SparkSession, path: str) -> DataFrame:
    """(source, name, vendor, kind, currency_rate, detector_url, scraper_url, announce_urls) of a TOML file's sections; one of a few dozen sections, so the driver reads it."""
    with open(path.removeprefix("file://"), "rb") as file:
        data = tomllib.load(file)
    import re

    rows = []
    for section, v in data.items():
        rate = v.get("currency_rate") if isinstance(v, dict) else None
        vendor, urls = (v.get("vendor"), v.get("announce_urls", [])) if isinstance(v, dict) else (None, [])
        fault = next(
            (
                name
                for bad, name in (
                    (not isinstance(v, dict), "isn't a table"),
                    (section == GENERATED[0], "is generated"),
                    (re.fullmatch(SHARD_NAME.strip("^$"), section) is None, "can't name a shard"),
                    (isinstance(v, dict) and set(v) - {*PROVIDER_KEYS, *OPTIONAL_KEYS}, "has an unknown key"),
                    (isinstance(v, dict) and set(PROVIDER_KEYS) - set(v), "misses a key"),
                    (isinstance(v, dict) and v.get("kind") not in KINDS, "has another kind"),
                    (isinstance(v, dict) and v.get("kind") == "first_party" and not (isinstance(vendor, str) and vendor), "needs a vendor"),
                    (isinstance(v, dict) and v.get("kind") == "reseller" and "vendor" in v, "must not have a vendor"),
                    (not isinstance(urls, list) or not all(isinstance(u, str) and u for u in urls), "has bad announce_urls"),
                    (rate is not None and (isinstance(rate, bool) or not isinstance(rate, (int, float)) or not math.isfinite(rate) or rate <= 0), "has a bad currency_rate"),
                )
                if bad
            ),
            None,
        )
        if fault:
            raise ValueError(f"{path}: section {section} {fault}")
        rows.append((section, v["provider"], vendor, v["kind"], None if rate is None else float(rate), v["detector_url"], v["scraper_url"], urls))
    return spark.createDataFrame(rows, "source string, name string, vendor string, kind string, currency_rate double, detector_url string, scraper_url string, announce_urls array<string>")


def published_providers(sections: DataFrame) -> DataFrame:
    """(source, name, vendor, kind): the sections and the source that none stands for."""
    extra = sections.sparkSession.createDataFrame([GENERATED], "source string, name string, vendor string, kind string")
    return sections.select("source", "name", "vendor", "kind").unionByName(extra)


def _stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)\.json$", 1)


def absence(spark: SparkSession, folder: str, strict: bool = True) -> DataFrame:
    """(source, model_id, absent_runs, since, fault) of a folder's files, one a source; no folder has none."""
    if not exists(spark, f"{folder}/*.json"):
        return spark.createDataFrame([], "source string, model_id string, absent_runs int, since string, fault string")
    doc = document(spark, f"{folder}/*.json").select(_stem(F.col("path")).alias("source"), F.try_variant_get("v", "$", _MAP).alias("m"))
    each = doc.select("source", "m", F.explode_outer("m").alias("model_id", "v")).where("m is null or model_id is not null").select("source", "model_id", F.col("m").isNull().alias("broken"), F.try_variant_get("v", "$", _MAP).alias("e"))
    runs = at(F.col("e"), "absent_runs")
    own = first_fault((F.col("broken"), "isn't an object"), (F.col("e").isNull(), "entry isn't an object"), (~F.coalesce(kind(runs).isin("BIGINT", "INT", "SMALLINT", "TINYINT") & F.try_variant_get(runs, "$", "int").isin(1, 2), F.lit(False)), "absent_runs isn't 1 or 2"), (~filled(at(F.col("e"), "since")), "since"))
    rows = each.select("source", "model_id", F.try_variant_get(runs, "$", "int").alias("absent_runs"), text_of(at(F.col("e"), "since")).alias("since"), own.alias("fault"))
    return refuse(rows.withColumn("f", F.col("fault")), "fault", "source", "model_id").withColumnRenamed("f", "fault") if strict else rows


def write_absence(state: DataFrame, folder: str, sources: list[str]) -> None:
    """One folder of one line for each of `sources` with entries; those without are emptied, others stay as they are."""
    spark = state.sparkSession
    own = state.where(F.col("source").isin(sources))
    entry = F.map_from_entries(F.array_sort(F.collect_list(F.struct("model_id", F.struct("absent_runs", "since").alias("e")))))
    lines = own.groupBy("source").agg(F.to_json(entry).alias("line"))
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    empty = spark.createDataFrame([(s,) for s in sources], "source string").join(own.select("source").distinct(), "source", "left_anti")
    try:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        lines.unionByName(empty.withColumn("line", F.lit("{}"))).select("line", "source").write.mode("overwrite").partitionBy("source").text(folder)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def channel_files(rows: DataFrame, source: str = "source", url: str = "url") -> DataFrame:
    """`rows` with `file`: the channel's path; where a source's channels share a name, the first 8 digits of the url's SHA-256 stand behind it."""
    stem = slug(F.col(url))
    n = F.count(F.lit(1)).over(Window.partitionBy(source, "_stem"))
    named = rows.withColumn("_stem", stem).withColumn("_n", n)
    file = F.concat(F.lit(ANNOUNCE + "/"), F.col(source), F.lit("/"), F.col("_stem"), F.when(F.col("_n") > 1, F.concat(F.lit("-"), F.substring(F.sha2(url, 256), 1, 8))).otherwise(""), F.lit(".md"))
    return named.withColumn("file", file).drop("_stem", "_n")


def announce(spark: SparkSession, root: str, strict: bool = True) -> DataFrame:
    """(source, url, file, sha, fetched, text, fault) of the committed channels; the index is the authority on their files. No index has none."""
    if not exists(spark, f"{root}/{ANNOUNCE}/index.json"):
        return spark.createDataFrame([], "source string, url string, file string, sha string, fetched string, text string, fault string")
    m = document(spark, f"{root}/{ANNOUNCE}/index.json").select(F.try_variant_get("v", "$", "map<string,map<string,map<string,string>>>").alias("m"))
    m = refuse(m.withColumn("bad", F.when(F.col("m").isNull(), "index isn't an object of objects")), "bad")
    rows = m.select(F.explode("m").alias("source", "u")).select("source", F.explode("u").alias("url", "e")).select("source", "url", at(F.col("e"), "file").alias("said"), at(F.col("e"), "sha256").alias("sha"), at(F.col("e"), "fetched").alias("fetched"))
    rows = channel_files(rows)
    kept = spark.read.text(f"{root}/{ANNOUNCE}/*/*.md", wholetext=True).select(F.regexp_extract(F.col("_metadata.file_path"), f"({ANNOUNCE}/[^/]+/[^/]+\\.md)$", 1).alias("file"), unwrapped(F.col("value")).alias("text")) if exists(spark, f"{root}/{ANNOUNCE}/*/*.md") else spark.createDataFrame([], "file string, text string")
    own = first_fault((F.coalesce("said", "sha", "fetched").isNull() | F.col("said").isNull() | F.col("sha").isNull() | F.col("fetched").isNull(), "misses a key"), (F.col("said") != F.col("file"), "names another file"), (F.col("text").isNull(), "file is missing"))
    out = rows.join(kept, "file", "left").select("source", "url", "file", "sha", "fetched", "text", own.alias("fault"))
    return refuse(out.withColumn("f", F.col("fault")), "fault", "source", "url").withColumnRenamed("f", "fault") if strict else out


def write_announce(channels: DataFrame, folder: str) -> None:
    """The index as rows (source, url, file, sha256, fetched) and each channel's text, wrapped; channels that are gone leave nothing behind, as both are overwritten."""
    named = channel_files(channels.select("source", "url", "sha", "fetched", "text"))
    named.select("source", "url", "file", F.col("sha").alias("sha256"), "fetched").write.mode("overwrite").json(f"{folder}/index")
    named.select("file", wrapped(F.col("text")).alias("text")).write.mode("overwrite").partitionBy("file").text(f"{folder}/text")


def billing_rules(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """(id, provider, effective, timezone, statement, citation, fault): closed keys, ids once, real days, zones and citations. A missing file is an error."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    doc = document(spark, path).select(F.try_variant_get("v", "$.rules", "array<variant>").alias("rules"))
    doc = refuse(doc.withColumn("bad", F.when(F.col("rules").isNull(), "no list of rules")), "bad")
    e = doc.select(F.posexplode("rules").alias("n", "v")).select("n", F.try_variant_get("v", "$", _MAP).alias("e"))
    m = F.col("e")
    zones = F.array(*map(F.lit, sorted(_zones())))
    cited = F.try_variant_get(at(m, "citation"), "$", "array<string>")
    again = F.row_number().over(Window.partitionBy("id").orderBy("n")) > 1
    rows = e.withColumn("id", text_of(at(m, "id"))).withColumn("again", again)
    own = first_fault(
        (m.isNull(), "isn't an object"),
        (F.size(F.array_except(F.map_keys(m), F.array(*map(F.lit, RULE_KEYS)))) > 0, "unknown key"),
        (F.size(F.array_except(F.array(*map(F.lit, RULE_KEYS)), F.map_keys(m))) > 0, "missing key"),
        (~(filled(at(m, "id")) & filled(at(m, "provider")) & filled(at(m, "statement"))), "empty text"),
        (F.col("again"), "id stands twice"),
        (~real_day(text_of(at(m, "effective"))), "effective isn't a day"),
        (~F.coalesce(F.array_contains(zones, text_of(at(m, "timezone"))), F.lit(False)), "unknown zone"),
        (~F.coalesce((kind(at(m, "citation")) == "ARRAY<STRING>") & (F.size(cited) > 0) & ~F.exists(cited, lambda x: x == ""), F.lit(False)), "citation"),
    )
    out = rows.select("id", text_of(at(m, "provider")).alias("provider"), text_of(at(m, "effective")).alias("effective"), text_of(at(m, "timezone")).alias("timezone"), text_of(at(m, "statement")).alias("statement"), cited.alias("citation"), own.alias("fault"))
    return refuse(out.withColumn("f", F.col("fault")), "fault", "id").withColumnRenamed("f", "fault") if strict else out


def _zones() -> set[str]:
    from zoneinfo import available_timezones

    return available_timezones()


def write_catalog(entries: DataFrame, path: str) -> None:
    """The catalog as one document, entries by name, in part files that follow each other; `entries` as catalog() gives them."""
    source = entries.groupBy("canonical", "name", "vendor", "curated", "source").agg(F.array_sort(F.collect_list("model_id")).alias("ids"))
    own = source.groupBy("canonical").agg(F.first("name").alias("name"), F.first("vendor").alias("vendor"), F.first("curated").alias("curated"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", "ids")))).alias("sources"))
    text = lambda x: F.coalesce(F.regexp_replace(F.to_json(F.struct(F.col(x).alias("x"))), r'^\{"x":(.*)\}$', "$1"), F.lit("null"))
    body = F.concat(F.lit('{"curated":'), F.col("curated").cast("string"), F.when(F.col("name").isNotNull(), F.concat(F.lit(',"name":'), text("name"))).otherwise(""), F.lit(',"sources":'), F.to_json("sources"), F.lit(',"vendor":'), F.when(F.col("vendor").isNull(), F.lit("null")).otherwise(text("vendor")), F.lit("}"))
    line = F.concat(text("canonical"), F.lit(":"), body)
    write_document(own.select("canonical", line.alias("member")), path, ["canonical"], head='{"models":{', tail=f'}},"version":{CATALOG_VERSION}}}')
