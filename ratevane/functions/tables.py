"""Tables of pages: markdown pipe tables and HTML tables as rows of cells."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from ..workers import reachable
from .money import short_references

#: Columns that a cell may span.
MAX_SPAN = 1000
_DASHES = re.compile(r":?-+:?")


def markdown_tables(text: str | None) -> list[list[list[str]]]:
    """Blocks of adjacent lines with pipes whose second row is all dashes; its cells are trimmed, the dashes dropped."""
    out, block = [], []

    def close() -> None:
        rows = [[c.strip() for c in line.strip().removeprefix("|").removesuffix("|").split("|")] for line in block]
        if len(rows) >= 2 and all(_DASHES.fullmatch(c) for c in rows[1]):
            out.append([rows[0], *rows[2:]])
        block.clear()

    for line in re.split("\r\n?|\n", text or ""):
        if "|" in line:
            block.append(line)
        else:
            close()
    close()
    return out


def span_of(value: str | None) -> int:
    """How many columns a cell takes by its colspan."""
    return min(MAX_SPAN, max(1, int(value))) if value and value.isdecimal() and len(value) < 10 else 1


class _Tables(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.depth, self.skip, self.tables, self.cell, self.span = 0, 0, [], None, 1

    def _end_cell(self) -> None:
        if self.cell is not None:
            self.tables[-1][-1] += [" ".join(" ".join(self.cell).split())] * self.span
            self.cell = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("script", "style", "noscript"):
            self.skip += 1
        elif tag == "table":
            self.depth += 1
            if self.depth == 1:
                self.tables.append([])
        elif self.depth == 1 and tag == "tr":
            self._end_cell()
            self.tables[-1].append([])
        elif self.depth == 1 and tag in ("td", "th"):
            self._end_cell()
            if not self.tables[-1]:
                self.tables[-1].append([])
            self.cell, self.span = [], span_of(dict(attrs).get("colspan"))

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style", "noscript"):
            self.skip = max(0, self.skip - 1)
        elif tag == "table" and self.depth:
            if self.depth == 1:
                self._end_cell()
            self.depth -= 1
        elif self.depth == 1 and tag in ("td", "th", "tr"):
            self._end_cell()

    def handle_data(self, data: str) -> None:
        if self.cell is not None and not self.skip:
            self.cell.append(data)


def html_tables(text: str | None) -> list[list[list[str]]]:
    """Top-level tables; a table inside a cell is part of that cell's text. Spanning cells repeat. Rows without cells go."""
    parser = _Tables()
    parser.feed(short_references(text or ""))
    parser.close()
    if parser.depth:
        parser._end_cell()
    return [[r for r in t if r] for t in parser.tables]


def tables_of(df: DataFrame, id_col: str, text_col: str, reader: Callable[[str | None], list] = html_tables) -> DataFrame:
    """(id, table_no, row_no, cells): a row for each row of each table of a page, or one row of nulls for a page that can't be read; Arrow batches, no shuffle."""

    def rows_of(text: str | None) -> list[tuple]:
        try:
            return [(t, r, cells) for t, table in enumerate(reader(text)) for r, cells in enumerate(table)]
        except AssertionError:  # what the parser raises on a broken declaration
            return [(None, None, None)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, *row) for i, text in enumerate(batch.column(1).to_pylist()) for row in rows_of(text)]
            take = pa.array([r[0] for r in rows], pa.int64())
            yield pa.record_batch([batch.column(0).take(take), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.list_(pa.string()))], names=[id_col, "table_no", "row_no", "cells"])

    rows = reachable(df).select(id_col, text_col)
    return rows.mapInArrow(run, f"{id_col} {rows.schema[0].dataType.simpleString()}, table_no int, row_no int, cells array<string>")
