"""A closed JSON schema, read from its file, as one expression over a line's VARIANT: the first fault at any depth, with its path."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What schema_of_variant() says of each type of JSON.
_KINDS = {"object": ("OBJECT",), "array": ("ARRAY",), "string": ("STRING",), "boolean": ("BOOLEAN",), "null": ("VOID",), "integer": ("BIGINT",), "number": ("BIGINT", "DOUBLE", "FLOAT", "DECIMAL")}


def load_schema(spark: SparkSession, path: str) -> dict:
    """A schema file's object; one document, of a fixed size."""
    found = json.loads(spark.read.text(path, wholetext=True).first()["value"])
    if found.get("type") != "object" or not isinstance(found.get("properties"), dict):
        raise ValueError(f"{path} isn't the schema of an object")
    return found


def resolved(schema: dict, root: dict) -> dict:
    """`schema` with a reference inside the file followed."""
    while "$ref" in schema:
        at = root
        for part in schema["$ref"].removeprefix("#/").split("/"):
            at = at[part]
        schema = at
    return schema


def key_sets(schema: dict) -> dict[str, tuple[str, ...]]:
    """The keys that each object of a schema may have, by its path: '' for the row, `overrides[].when` for what is inside lists."""
    out: dict[str, tuple[str, ...]] = {}

    def walk(own: dict, path: str) -> None:
        own = resolved(own, schema)
        if "properties" in own:
            out[path] = tuple(own["properties"])
            for name, inner in own["properties"].items():
                walk(inner, f"{path}.{name}" if path else name)
        if isinstance(own.get("items"), dict):
            walk(own["items"], f"{path}[]")

    walk(schema, "")
    return out


def _kind_of(v: Column, types: list[str]) -> Column:
    said = F.schema_of_variant(v)
    out = F.lit(False)
    for name in types:
        for kind in _KINDS[name]:
            out = out | said.startswith(kind)
        if name == "integer":  # a number without a fraction counts
            x = F.try_variant_get(v, "$", "double")
            out = out | ((said.startswith("DOUBLE") | said.startswith("DECIMAL")) & (x == F.floor(x)))
    return out


def _first(rules: list[tuple[Column, str | Column]]) -> Column:
    """The name of the first rule that is broken."""
    return F.coalesce(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(name) if isinstance(name, str) else name) for bad, name in rules])


def _fault(v: Column, schema: dict, root: dict, path: str) -> Column:
    own = resolved(schema, root)
    at = path or "row"
    rules: list[tuple[Column, str | Column]] = []
    types = own.get("type")
    if types:
        rules.append((~_kind_of(v, [types] if isinstance(types, str) else types), f"{at}: type"))
    text, number = F.try_variant_get(v, "$", "string"), F.try_variant_get(v, "$", "double")
    if "const" in own:
        rules.append((F.to_json(v) != F.lit(json.dumps(own["const"], ensure_ascii=False)), f"{at}: const"))
    if "enum" in own:
        rules.append((~F.to_json(v).isin([json.dumps(x, ensure_ascii=False) for x in own["enum"]]), f"{at}: enum"))
    if "pattern" in own:
        rules.append((~text.rlike(own["pattern"]), f"{at}: pattern"))
    if "minLength" in own:
        rules.append((F.length(text) < own["minLength"], f"{at}: minLength"))
    for name, broken in (("minimum", lambda x, n: x < n), ("exclusiveMinimum", lambda x, n: x <= n), ("maximum", lambda x, n: x > n)):
        if name in own:
            rules.append((broken(number, own[name]), f"{at}: {name}"))
    if "properties" in own:
        m = F.try_variant_get(v, "$", "map<string,variant>")
        keys = F.map_keys(m)
        if own.get("additionalProperties") is False:
            more = F.array_except(keys, F.array(*map(F.lit, own["properties"])))
            rules.append((F.size(more) > 0, F.concat(F.lit(f"{at}: unknown "), F.array_min(more))))
        for name in own.get("required", ()):
            rules.append((~F.array_contains(keys, name), f"{at}: missing {name}"))
        if "minProperties" in own:
            rules.append((F.size(keys) < own["minProperties"], f"{at}: minProperties"))
        for name, inner in own["properties"].items():
            x = F.try_element_at(m, F.lit(name))
            made = F.when(x.isNotNull(), _fault(x, inner, root, f"{path}.{name}" if path else name))
            rules.append((made.isNotNull(), made))
    if isinstance(own.get("items"), dict) or "minItems" in own or own.get("uniqueItems"):
        items = F.try_variant_get(v, "$", "array<variant>")
        if "minItems" in own:
            rules.append((F.size(items) < own["minItems"], f"{at}: minItems"))
        if "maxItems" in own:
            rules.append((F.size(items) > own["maxItems"], f"{at}: maxItems"))
        if own.get("uniqueItems"):
            texts = F.transform(items, lambda e: F.to_json(e))
            rules.append((F.size(F.array_distinct(texts)) < F.size(texts), f"{at}: uniqueItems"))
        if isinstance(own.get("items"), dict):
            first = F.get(F.filter(F.transform(items, lambda e: _fault(e, own["items"], root, f"{path}[]")), lambda f: f.isNotNull()), 0)
            rules.append((first.isNotNull(), first))
    return _first(rules) if rules else F.lit(None).cast("string")


def contract_fault(line: Column, schema: dict) -> Column:
    """The first fault of a JSON line under a schema, as `path: rule`, unknown keys at every depth too; null for a valid line. What isn't JSON is `row: json`."""
    v = F.try_parse_json(line)
    return F.when(v.isNull(), "row: json").otherwise(_fault(v, schema, schema, ""))


def contract_faults(lines: DataFrame, schema: dict, column: str = "line") -> DataFrame:
    """`lines` with their fault."""
    return lines.withColumn("fault", contract_fault(F.col(column), schema))
