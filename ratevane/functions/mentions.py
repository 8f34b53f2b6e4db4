"""Which ids a text names whole: one automaton for all ids, with guards at both ends of a hit."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workers import reachable

#: Characters of ids that one automaton, broadcast, holds; more ids are taken in blocks.
BLOCK_CHARS = 16 << 20
EMPHASIS = "_*`"


def visible(text: Column) -> Column:
    """A markdown cell's text: of links what they show, no tags."""
    return F.regexp_replace(F.regexp_replace(text, r"!?\[([^\]]*)\]\([^)]*\)", "$1"), r"<[^>]*>", " ")


def _open_end(text: str, at: int, step: int) -> bool:
    """Whether an id may end beside this place: marks of emphasis are no part of it, a dot or hyphen only before a letter or digit is."""
    while 0 <= at < len(text) and text[at] in EMPHASIS:
        at += step
    if not 0 <= at < len(text):
        return True
    if text[at] in ".-":
        at += step
        return not (0 <= at < len(text) and text[at].isalnum())
    return not text[at].isalnum()


def mentions(df: DataFrame, id_col: str, text_col: str, ids: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(id_col, model_id): each id of `ids` (model_id) that a row's text names whole, in any case, once for each row.

    A text names an id if neither end goes on into a longer one: `_m-2_` names m-2, `m-2_fast`, `xm-2` and `m-2.5` don't. A null text names
    none; an empty or null id is never named. Ids are broadcast in blocks of `block_chars`.
    """
    import ahocorasick

    known = ids.select("model_id").where("model_id <> ''").distinct()
    size = known.agg(F.coalesce(F.sum(F.length("model_id")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-size // block_chars))
    rows = reachable(df).select(id_col, text_col)
    found = []
    for block in range(blocks):
        own = known if blocks == 1 else known.where(F.pmod(F.xxhash64("model_id"), F.lit(blocks)) == block)
        names: dict[str, list[str]] = {}
        for r in own.collect():  # of a bounded size
            names.setdefault(r["model_id"].lower(), []).append(r["model_id"])
        shared = df.sparkSession.sparkContext.broadcast(names)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            machine = ahocorasick.Automaton()
            for low, whole in shared.value.items():
                machine.add_word(low, (len(low), whole))
            machine.make_automaton()
            for batch in batches:
                at, out = [], []
                for i, text in enumerate(batch.column(1).to_pylist() if shared.value else []):
                    low = (text or "").lower()
                    hits = {x for end, (n, whole) in machine.iter(low) if _open_end(low, end - n, -1) and _open_end(low, end + 1, 1) for x in whole}
                    at += [i] * len(hits)
                    out += sorted(hits)
                yield pa.record_batch([batch.column(0).take(pa.array(at, pa.int64())), pa.array(out, pa.string())], names=[id_col, "model_id"])

        found.append(rows.mapInArrow(run, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, model_id string"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
