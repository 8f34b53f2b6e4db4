"""Pages read once for all sources: elements, rows of tables and rows of pipe tables come out of one pass, each with where it stands."""

from __future__ import annotations

import json
import pickle
import tempfile
from collections.abc import Callable, Generator, Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workers import reachable, shared_table
from .literals import Fault, component_tables, objects_in, plain_json, stream_of
from .money import short_references
from .tables import markdown_tables, span_of
from .text import fold_heading

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Opening one of these closes an open one of those before it in the same parent.
CLOSES = {"td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr"), "tbody": ("td", "th", "tr", "thead", "tbody"), "tfoot": ("td", "th", "tr", "tbody", "thead"), "li": ("li",), "p": ("p",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",)}
#: No tag closes implicitly beyond one of these.
BOUNDS = frozenset(("table", "ul", "ol", "dl", "div", "section", "article"))
RAW = frozenset(("script", "style"))
#: Rows and characters of an Arrow batch of what pages hold; rows of a page that stay in memory until the page is read to its end, and bytes of its file beyond these.
BATCH_ROWS, BATCH_CHARS, HELD_ROWS, HELD_BYTES = 2_000, 4_000_000, 5_000, 8_000_000


@dataclass(frozen=True)
class Sel:
    """An element by tag, classes and attributes; its value is its text, or an attribute's. `parent`: only right under an element of that name."""

    tag: str | tuple[str, ...] = ()
    cls: tuple[str, ...] = ()
    attrs: dict[str, str] = field(default_factory=dict)
    value: str = ""
    parent: str = ""
    skip: tuple[str, ...] = ()  # tags whose text isn't part of the value
    sep: str = " "

    @property
    def tags(self) -> tuple[str, ...]:
        return (self.tag,) if isinstance(self.tag, str) else self.tag

    def fits(self, attrs: dict[str, str | None], classes: list[str], above: frozenset[str]) -> bool:
        """Whether an element of the right tag fits."""
        return all(c in classes for c in self.cls) and all(attrs.get(k) == v for k, v in self.attrs.items()) and (not self.parent or self.parent in above) and (not self.value or self.value in attrs)


@dataclass(frozen=True)
class Reading:
    """What a source's pages are read for: elements by name; rows of tables, with elements inside cells (`inner`); rows of pipe tables; tables that a component of script or markup holds; objects in the state of scripts that begin with a text (`objects`). `clean` changes a body first."""

    wanted: dict[str, Sel] = field(default_factory=dict)
    inner: dict[str, Sel] = field(default_factory=dict)
    tables: bool = False
    pipes: bool = False
    component: str = ""
    objects: str = ""
    sep: str = " "
    clean: Callable[[str], str] | None = None


_TABLE = {"table": Sel("table"), "caption": Sel("caption"), "head": Sel("thead"), "foot": Sel("tfoot"), "tr": Sel("tr")}
_ROWS = frozenset((*_TABLE, "cell"))


class Index:
    """A reading's selectors by what an element must have: its tag, else a class, else an attribute."""

    def __init__(self, reading: Reading) -> None:
        table = _TABLE | {"cell": Sel(("td", "th"), sep=reading.sep)} | reading.inner if reading.tables else {}
        self.reading, self.selectors = reading, table | reading.wanted
        read = {"cell", "caption", *reading.inner, *reading.wanted}
        self.texts = frozenset(n for n, s in self.selectors.items() if n in read and not s.value)  # of the others no text is kept, as a table's is as long as the page
        self.by_tag: dict[str, list[tuple[str, Sel]]] = {}
        self.by_class: dict[str, list[tuple[str, Sel]]] = {}
        self.by_attr: dict[str, list[tuple[str, Sel]]] = {}
        for name, s in self.selectors.items():
            for tag in s.tags:
                self.by_tag.setdefault(tag, []).append((name, s))
            if not s.tags and s.cls:
                self.by_class.setdefault(s.cls[0], []).append((name, s))
            elif not s.tags:
                self.by_attr.setdefault(next(iter(s.attrs)), []).append((name, s))

    def names(self, tag: str, attrs: dict[str, str | None], above: frozenset[str]) -> list[str]:
        classes = (attrs.get("class") or "").split()
        near = [*self.by_tag.get(tag, ()), *(x for c in dict.fromkeys(classes) for x in self.by_class.get(c, ())), *(x for a in attrs for x in self.by_attr.get(a, ()))]
        found = {name for name, s in near if s.fits(attrs, classes, above)}
        return [n for n in self.selectors if n in found]


class _Open:
    __slots__ = ("tag", "no", "names", "text", "path", "attrs")

    def __init__(self, tag: str, no: int, attrs: dict, path: dict[str, int]) -> None:
        self.tag, self.no, self.attrs, self.path, self.names, self.text = tag, no, attrs, path, [], {}


class _Walk(HTMLParser):
    """Elements, handed on in lists while the page is read, each in the order of their starts; a row of a table goes whole, with all that it holds.

    The text of an element is that of its text nodes, trimmed, empty ones left out.
    """

    def __init__(self, index: Index, found: Callable[[list[tuple]], None]) -> None:
        super().__init__(convert_charrefs=True)
        self.index, self.found, self.open, self.no, self.out, self.readers, self.rows = index, found, [], 0, [], [], 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        for closing in CLOSES.get(tag, ()):
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i].tag == closing:
                    self._close(i)
                    break
                if self.open[i].tag in BOUNDS:
                    break
        own = dict(attrs)
        parent = self.open[-1] if self.open else None
        above, path = frozenset(parent.names) if parent else frozenset(), parent.path if parent else {}
        self.no += 1
        here = _Open(tag, self.no, own, path)
        here.names = self.index.names(tag, own, above)
        if here.names:
            here.path = {**path, **{n: self.no for n in here.names if n not in path or n != "table"}}
            here.text = {n: [] for n in here.names if n in self.index.texts}
            self.rows += "tr" in here.names
            self.readers.append(here)
        self.open.append(here)
        if tag in VOID:
            self._close(len(self.open) - 1)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if self.open and self.open[-1].tag == tag and tag not in VOID:
            self._close(len(self.open) - 1)

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i].tag == tag:
                self._close(i)
                return
            if self.open[i].tag == "table" and tag != "table":
                return

    def handle_data(self, data: str) -> None:
        text = data.strip()
        if not text or not self.readers:
            return
        inside = self.open[-1]
        for reader in self.readers:
            if inside.tag in RAW and reader is not inside:
                continue
            for name, texts in reader.text.items():
                skip = self.index.selectors[name].skip
                if not skip or not any(o.no > reader.no and o.tag in skip for o in self.open):
                    texts.append(text)

    def _close(self, i: int) -> None:
        for here in reversed(self.open[i:]):
            for name in here.names:
                s = self.index.selectors[name]
                self.out.append((here.no, name, (here.attrs.get(s.value) or "") if s.value else s.sep.join(here.text.get(name, ())), here.path, {k: v or "" for k, v in here.attrs.items()}))
            if here.names:
                self.readers.remove(here)
                self.rows -= "tr" in here.names
        del self.open[i:]
        if not self.rows and len(self.out) >= 100:
            self._hand_on()

    def _hand_on(self) -> None:
        self.found(sorted(self.out, key=lambda r: r[0]))
        self.out = []

    def finish(self) -> None:
        self.close()
        self._close(0)
        self._hand_on()


def _rows_of(found: list[tuple], inner: dict[str, Sel], top: dict[int, list[str]], captions: dict[int, tuple[int, str]]) -> list[dict]:
    """The rows of top-level tables; a table inside a cell is part of that cell's text alone. `top` and `captions` are those of the page's tables so far."""
    outer = {no for no, name, _, path, _ in found if name == "tr" and "cell" not in path}
    rows: dict[int, dict] = {}
    for no, name, value, path, attrs in found:
        if name == "caption" and "table" in path:
            captions[path["table"]] = min(captions.get(path["table"], (no, value)), (no, value))
        if name == "cell" and "table" in path and path.get("tr") in outer:
            row = rows.setdefault(path["tr"], {"table": path["table"], "no": path["tr"], "cells": [], "nos": [], "inner": [], "in_head": False, "in_foot": False})
            row["cells"] += [value] * span_of(attrs.get("colspan"))
            row["nos"].append(no)
            row["in_head"] |= "head" in path
            row["in_foot"] |= "foot" in path
        elif name in inner and "cell" in path and path.get("tr") in rows and path["cell"] in rows[path["tr"]]["nos"]:
            rows[path["tr"]]["inner"].append({"cell": rows[path["tr"]]["nos"].index(path["cell"]), "name": name, "value": value, "no": no})
    out = []
    for no in sorted(rows):
        row = rows[no]
        row["first"] = row["table"] not in top
        row["top"] = top.setdefault(row["table"], row["cells"])
        out.append(row)
    return out


class _Held:
    """A page's rows until it is known that the page can be read: the first in memory, the others in a file of the task's own."""

    def __init__(self) -> None:
        self.rows, self.file = [], None

    def put(self, rows: list[dict]) -> None:
        self.rows += rows
        if len(self.rows) >= HELD_ROWS:
            self.file = self.file or tempfile.SpooledTemporaryFile(HELD_BYTES)
            pickle.dump(self.rows, self.file, pickle.HIGHEST_PROTOCOL)
            self.rows = []

    def __iter__(self) -> Iterator[dict]:
        if self.file:
            end = self.file.tell()
            self.file.seek(0)
            while self.file.tell() < end:
                yield from pickle.load(self.file)
        yield from self.rows

    def drop(self) -> None:
        if self.file:
            self.file.close()
        self.rows, self.file = [], None


_SCHEMA = "source string, run string, url string, kind string, no int, name string, value string, path map<string,int>, attrs map<string,string>, tbl int, cells array<string>, top array<string>, inner array<struct<cell:int,name:string,value:string,no:int>>, caption string, in_head boolean, in_foot boolean, first boolean"
_NAMES = [x.split()[0] for x in _SCHEMA.split(", ")][3:]
_KINDS = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.map_(pa.string(), pa.int32()), pa.map_(pa.string(), pa.string()), pa.int32(), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.struct([("cell", pa.int32()), ("name", pa.string()), ("value", pa.string()), ("no", pa.int32())])), pa.string(), pa.bool_(), pa.bool_(), pa.bool_()]


def _marked(index: Index, text: str) -> Generator[dict, None, bool]:
    """The elements and table rows of a page, once it is read to its end; whether it could be, else its fault alone. Memory is bounded by a row, not by the page's rows."""
    reading, held, top, captions = index.reading, _Held(), {}, {}

    def found(some: list[tuple]) -> None:
        held.put([{"kind": "element", "no": no, "name": name, "value": value, "path": list(path.items()), "attrs": list(attrs.items())} for no, name, value, path, attrs in some if name in reading.wanted])
        if reading.tables:
            held.put([{"kind": "row", "tbl": r["table"], **{k: r[k] for k in ("no", "cells", "top", "inner", "in_head", "in_foot", "first")}} for r in _rows_of(some, reading.inner, top, captions)])

    walk = _Walk(index, found)
    try:
        try:
            walk.feed(short_references(text))
            walk.finish()
        except (AssertionError, ValueError, RecursionError) as fault:
            yield {"kind": "fault", "value": f"markup: {type(fault).__name__}"}
            return False
        for row in held:
            if row["kind"] == "row":
                row["caption"] = captions.get(row["tbl"], (0, None))[1]  # it may stand behind the rows
            yield row
        return True
    finally:
        held.drop()


def page_rows(index: Index, body: str | None) -> Iterator[dict]:
    """What stands on a page. One that can't be read is a single `fault`; an empty one is, too."""
    if not (body or "").strip():
        yield {"kind": "fault", "value": "empty page"}
        return
    reading = index.reading
    text = reading.clean(body) if reading.clean else body
    if index.selectors and not (yield from _marked(index, text)):
        return
    if reading.pipes:
        for t, table in enumerate(markdown_tables(body)):
            for r, cells in enumerate(table):
                if r:
                    yield {"kind": "pipe", "tbl": t, "no": t * 100_000 + r, "cells": cells, "top": table[0]}
    if reading.objects:
        for n, x in enumerate(objects_in(stream_of(body), reading.objects)):
            yield {"kind": "object", "no": n, "value": json.dumps(plain_json(x), ensure_ascii=False)} if not isinstance(x, Fault) else {"kind": "fault", "value": f"literal: {x}"}
    if reading.component:
        for late, source in enumerate((text, stream_of(body))):
            for t, table in enumerate(component_tables(source, reading.component)):
                if isinstance(table, Fault):
                    yield {"kind": "fault", "value": f"literal: {table}"}
                else:
                    for r, cells in enumerate(table[1]):
                        yield {"kind": "component", "tbl": late, "no": t * 100_000 + r, "cells": cells, "top": table[0]}


class Pages:
    """A table of pages (source, url, body, and the run that fetched them as `run`, if there are several), read once.

    `bodies`, `elements`, `rows` and `pipes` are of one source, once of() has chosen it; their `url` holds the run as well, so what is
    grouped by it never mixes two fetches.
    """

    def __init__(self, bodies: DataFrame, read: DataFrame, source: str | None = None) -> None:
        self._bodies, self._read, self.source = bodies, read, source

    @classmethod
    def of_table(cls, pages: DataFrame, readings: dict[str, Reading]) -> Pages:
        """One Arrow pass over the bodies of all sources that are read for something; what it finds is written once, a folder for each source if there are several, which takes a sort."""
        run_ = F.coalesce(F.col("run").cast("string"), F.lit("")) if "run" in pages.columns else F.lit("")
        bodies = pages.select("source", run_.alias("run"), "url", "body").where(F.col("source").isin(list(readings)))

        def made(batch: pa.RecordBatch, at: list[int], found: list[dict]) -> pa.RecordBatch:
            take = pa.array(at, pa.int64())
            columns = [pa.array([r.get(n) for r in found], t) for n, t in zip(_NAMES, _KINDS, strict=True)]
            return pa.RecordBatch.from_arrays([*(batch.column(k).take(take) for k in range(3)), *columns], names=["source", "run", "url", *_NAMES])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            indexes: dict[str, Index] = {}
            for batch in batches:
                at, found, chars = [], [], 0
                for i in range(batch.num_rows):
                    source = batch.column(0)[i].as_py()
                    if source not in indexes:
                        indexes[source] = Index(readings[source])
                    for row in page_rows(indexes[source], batch.column(3)[i].as_py()):
                        at.append(i)
                        found.append(row)
                        chars += len(row.get("value") or "")
                        if len(found) >= BATCH_ROWS or chars >= BATCH_CHARS:
                            yield made(batch, at, found)
                            at, found, chars = [], [], 0
                if found:
                    yield made(batch, at, found)

        return cls(bodies, shared_table(reachable(bodies).mapInArrow(run, _SCHEMA), "pages", *["source"][: len(readings) - 1]))

    def of(self, source: str) -> Pages:
        return Pages(self._bodies.where(F.col("source") == source), self._read.where(F.col("source") == source), source)

    @staticmethod
    def _keyed(df: DataFrame) -> DataFrame:
        return df.withColumn("url", F.struct("run", "url"))

    @property
    def bodies(self) -> DataFrame:
        """(url, body)."""
        return self._keyed(self._bodies).select("url", "body")

    @property
    def elements(self) -> DataFrame:
        """(url, no, name, value, path, attrs) of every element that fits; `path` has for each name the number of the element around it, its own too."""
        return self._keyed(self._read.where("kind = 'element'")).select("url", "no", "name", "value", "path", "attrs")

    @property
    def rows(self) -> DataFrame:
        """(url, table, ord, head, top, cells, inner, caption, in_head, in_foot, first) of the rows of top-level tables.

        `cells` has the texts, spanning ones repeated; `top` those of the table's first row, `head` the same folded; `inner` the elements
        asked for inside cells, as (cell, name, value, no).
        """
        rows = self._keyed(self._read.where("kind = 'row'")).withColumnsRenamed({"tbl": "table", "no": "ord"})
        return rows.select("url", "table", "ord", F.transform("top", fold_heading).alias("head"), "top", "cells", "inner", "caption", "in_head", "in_foot", "first")

    @property
    def pipes(self) -> DataFrame:
        """(url, table, ord, head, cells) of the rows of pipe tables, heading rows left out."""
        return self._keyed(self._read.where("kind = 'pipe'")).select("url", F.col("tbl").alias("table"), F.col("no").alias("ord"), F.transform("top", fold_heading).alias("head"), "cells")

    @property
    def objects(self) -> DataFrame:
        """(url, no, value) of the objects in the state of scripts, as JSON."""
        return self._keyed(self._read.where("kind = 'object'")).select("url", "no", "value")

    @property
    def components(self) -> DataFrame:
        """(url, late, ord, top, cells) of the rows of component tables; `late` is 0 on the page itself, 1 in the state of its scripts."""
        return self._keyed(self._read.where("kind = 'component'")).select("url", F.col("tbl").alias("late"), F.col("no").alias("ord"), "top", "cells")

    @property
    def faults(self) -> DataFrame:
        """(source, run, url, fault) of the pages that can't be read or are empty."""
        return self._read.where("kind = 'fault'").select("source", "run", "url", F.col("value").alias("fault"))

    def present(self) -> list[str]:
        """The sources that have a page: as many as are known, at most."""
        return sorted(r["source"] for r in self._bodies.select("source").distinct().collect())

    @property
    def fetched(self) -> DataFrame:
        """(source, run) of all pages."""
        return self._bodies.select("source", "run").distinct()


def records(rows: DataFrame, record: str, one: tuple[str, ...] = (), many: tuple[str, ...] = ()) -> DataFrame:
    """(url, ord, ...) of every element named `record`: of each name in `one` the first value inside it, of each in `many` all values in order."""
    first = [F.min_by(F.when(F.col("name") == n, F.col("value")), F.when(F.col("name") == n, F.col("no"))).alias(n) for n in one]
    every = [F.transform(F.sort_array(F.collect_list(F.when(F.col("name") == n, F.struct("no", "value")))), lambda s: s["value"]).alias(n) for n in many]
    return rows.withColumn("ord", F.col("path")[record]).where("ord is not null").groupBy("url", "ord").agg(*first, *every)


def inner_of(name: str, cell: int, value: str = "value") -> Column:
    """The first value of an inner element of a cell; null without one."""
    found = F.filter("inner", lambda x: (x["cell"] == cell) & (x["name"] == name))
    return F.get(F.transform(found, lambda x: x[value]), 0)


def column(name: str) -> Column:
    """The text of the cell under a folded heading; null without that heading or cell."""
    return F.get(F.col("cells"), (F.array_position("head", name) - 1).cast("int"))


def plain(body: Column) -> Column:
    """A page's text: scripts, styles and tags gone, white space as one blank."""
    return F.trim(F.regexp_replace(F.regexp_replace(body, r"(?is)<(script|style)\b.*?</\1\s*>|<[^>]*>", " "), r"\s+", " "))
