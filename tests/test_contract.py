import json
import random

from pyspark.sql import functions as F

from ratevane.operators import contract

RATE = {"type": "object", "additionalProperties": False, "minProperties": 1, "properties": {"input": {"type": "number", "minimum": 0}, "output": {"type": "number", "minimum": 0}}}
SCHEMA = {
    "type": "object", "additionalProperties": False, "required": ["schema", "id"],
    "properties": {
        "schema": {"const": 4}, "id": {"type": "string", "minLength": 1}, "day": {"type": "string", "pattern": "^[0-9]{4}-[0-9]{2}$"}, "gone": {"const": True}, "rates": {"$ref": "#/$defs/rates"}, "n": {"type": "integer", "exclusiveMinimum": 0},
        "overrides": {"type": "array", "minItems": 1, "items": {"type": "object", "additionalProperties": False, "required": ["when"], "properties": {"when": {"type": "object", "additionalProperties": False, "properties": {"days": {"type": "array", "uniqueItems": True, "items": {"enum": ["mon", "tue"]}}, "zone": {"type": ["string", "null"]}}}, "rates": {"$ref": "#/$defs/rates"}}}},
    },
    "$defs": {"rates": RATE},
}
GOOD = {"schema": 4, "id": "a", "rates": {"input": 1.5, "output": 0}, "n": 3, "overrides": [{"when": {"days": ["mon"], "zone": None}, "rates": {"input": 2}}]}


def broken(value, own, path=""):
    """The first fault, by a walk in Python."""
    own = contract.resolved(own, SCHEMA)
    at = path or "row"
    kinds = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}
    fits = lambda t: isinstance(value, kinds[t]) if t in kinds else isinstance(value, (int, float)) and not isinstance(value, bool) and (t == "number" or value == int(value))
    types = own.get("type")
    if types and not any(map(fits, [types] if isinstance(types, str) else types)):
        return f"{at}: type"
    if "const" in own and (value != own["const"] or type(value) is not type(own["const"])):
        return f"{at}: const"
    if "enum" in own and value not in own["enum"]:
        return f"{at}: enum"
    if "pattern" in own and not __import__("re").search(own["pattern"], value):
        return f"{at}: pattern"
    if "minLength" in own and len(value) < own["minLength"]:
        return f"{at}: minLength"
    if "minimum" in own and value < own["minimum"]:
        return f"{at}: minimum"
    if "exclusiveMinimum" in own and value <= own["exclusiveMinimum"]:
        return f"{at}: exclusiveMinimum"
    if "properties" in own:
        if more := sorted(set(value) - set(own["properties"])):
            return f"{at}: unknown {more[0]}"
        for name in own.get("required", ()):
            if name not in value:
                return f"{at}: missing {name}"
        if len(value) < own.get("minProperties", 0):
            return f"{at}: minProperties"
        for name, inner in own["properties"].items():
            if name in value and (f := broken(value[name], inner, f"{path}.{name}" if path else name)):
                return f
    if isinstance(value, list):
        if len(value) < own.get("minItems", 0):
            return f"{at}: minItems"
        if own.get("uniqueItems") and len({json.dumps(x) for x in value}) < len(value):
            return f"{at}: uniqueItems"
        for x in value:
            if f := broken(x, own["items"], f"{path}[]"):
                return f
    return None


def mutated(rng, value):
    """A copy with one place changed, at any depth."""
    value = json.loads(json.dumps(value))
    at, spots = [value], []
    while at:
        x = at.pop()
        for k in x if isinstance(x, dict) else range(len(x)):
            spots.append((x, k))
            if isinstance(x[k], (dict, list)):
                at.append(x[k])
        spots.append((x, None))
    x, k = rng.choice(spots)
    new = rng.choice([None, True, -1, 0, 2.5, 4, "", "mon", "x", "2026-01", [], {}, ["mon", "mon"], {"input": -1}])
    if k is None:
        x.append(new) if isinstance(x, list) else x.update({rng.choice(["more", "day", "gone", "zone", "output"]): new})
    elif rng.random() < 0.3:
        del x[k]
    else:
        x[k] = new
    return value


def test_faults_at_any_depth(spark, tmp_path):
    rng = random.Random(2)
    rows = [GOOD, {}] + [mutated(rng, GOOD) for _ in range(300)] + [mutated(rng, mutated(rng, GOOD)) for _ in range(200)]
    (tmp_path / "row.json").write_text(json.dumps(SCHEMA))
    schema = contract.load_schema(spark, f"{tmp_path}/row.json")
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(rows)] + [(-1, "not json"), (-2, None)], "i int, line string")
    got = {r.i: r.fault for r in contract.contract_faults(df, schema).select("i", "fault").collect()}
    assert got.pop(-1) == got.pop(-2) == "row: json"
    want = {i: broken(r, SCHEMA) for i, r in enumerate(rows)}
    assert got == want and len(set(want.values())) > 25 and want[0] is None
    assert contract.key_sets(schema)["overrides[].when"] == ("days", "zone") and contract.key_sets(schema)["rates"] == ("input", "output")


def test_details_and_fragments(spark):
    from ratevane.functions import page
    from ratevane.schema import ROW

    interval = "struct<valid_from:string,valid_to:string,observed_at:string,removed:boolean>"
    kinds = {x.split(" ", 1)[0]: x.split(" ", 1)[1] for x in ROW.replace(", ", ",").replace(",", ", ").split(", ") if " " in x and "<" not in x}
    own = {"source": "s", "model_id": "m", "rates": {"input": 1.5}, "currency": "EUR", "limits": {"context": 8}, "overrides": [{"when": {"window": [100, 200], "timezone": "UTC"}, "rates": {"input": 3.0}}], "first_seen": "2026-01-01", "observed_at": "2026-01-02", "removed_at": None, "intervals": [{"valid_from": "2026-01-01", "valid_to": None, "observed_at": "2026-01-02", "removed": None}]}
    fields = ", ".join(f for f in ("source string", "model_id string", "currency string", "first_seen string", "observed_at string", "removed_at string"))
    rates = ROW[ROW.index("rates struct") : ROW.index(", unmapped")]
    flat = spark.createDataFrame([(json.dumps(own),)], "j string").select(F.from_json("j", f"{fields}, {rates}, intervals array<{interval}>").alias("r")).select("r.*")
    assert kinds
    got = [(r.label, r.value) for r in page.detail_rows(flat).orderBy("ord").collect()]
    assert got[0] == ("rate input", "1.5") and ("quoted in", "EUR") in got and ("limit context", "8") in got and got[-1] == ("valid to", "—") and ("override 1" in dict(got)) and "removed" not in dict(got)
    assert dict((r.label, r.number) for r in page.detail_rows(flat, peak=True).collect())["rate input"] == 3.0
    state = spark.createDataFrame([(0, "s/m"), (1, "x/y"), (2, "s/i"), (3, "s/m")], "pos int, key string")
    entries = spark.createDataFrame([("s", "m", None), ("s", "i", "image")], "source string, model_id string, modality string")
    assert [(r.key, r.pos) for r in page.restored(state, entries).collect()] == [("s/m", 0)]
