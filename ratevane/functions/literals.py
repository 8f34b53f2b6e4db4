"""Literals of scripts and component calls: a recursive-descent parser, tables that components hold, and both as columns.

A value is a list, an object, a text in any quotes, a number, true, false, null or undefined; a component call (`jsx(Name, {...})`), an
element or a fragment stands for a Component. Commas may trail. Whatever else stands there is a Fault with its position.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from ..workers import reachable

#: Values inside values; deeper ones are a fault, not a full stack.
MAX_DEPTH = 200
_NAME = re.compile(r"[A-Za-z_$][\w$.]*")
_ATTRIBUTE = re.compile(r"[A-Za-z_$][\w$:.-]*")
_NUMBER = re.compile(r"[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?")
_CALL = re.compile(r"_?jsxs?$|^createElement$")
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f", "v": "\v", "0": "\0", "\n": ""}
_WORDS = {"true": True, "false": False, "null": None, "undefined": None}


class Fault(ValueError):
    """What can't be read, and where."""

    def __init__(self, what: str, at: int) -> None:
        super().__init__(f"{what} at {at}")
        self.at = at


@dataclass
class Component:
    tag: str
    props: dict


class Reader:
    def __init__(self, text: str) -> None:
        self.text = text

    def blank(self, at: int) -> int:
        """The next place that isn't white space or a comment."""
        text, n = self.text, len(self.text)
        while at < n:
            if text[at].isspace():
                at += 1
            elif text.startswith("//", at):
                end = text.find("\n", at)
                at = n if end < 0 else end
            elif text.startswith("/*", at):
                end = text.find("*/", at + 2)
                if end < 0:
                    raise Fault("open comment", at)
                at = end + 2
            else:
                break
        return at

    def expect(self, sign: str, at: int) -> int:
        at = self.blank(at)
        if not self.text.startswith(sign, at):
            raise Fault(f"no {sign}", at)
        return at + len(sign)

    def value(self, at: int, depth: int = 0) -> tuple[object, int]:
        at = self.blank(at)
        if depth > MAX_DEPTH:
            raise Fault("too deep", at)
        if at >= len(self.text):
            raise Fault("no value", at)
        sign = self.text[at]
        if sign == "[":
            return self.array(at, depth)
        if sign == "{":
            return self.object(at, depth)
        if sign in "\"'`":
            return self.string(at)
        if sign == "<":
            return self.element(at, depth)
        if number := _NUMBER.match(self.text, at):
            if _NAME.match(self.text, number.end()):
                raise Fault("number", at)
            x = float(number.group())
            return (int(x) if x.is_integer() and abs(x) < 1 << 53 else x), number.end()
        if name := _NAME.match(self.text, at):
            return self.word(name.group(), name.end(), at, depth)
        raise Fault(f"{sign!r}", at)

    def word(self, name: str, end: int, at: int, depth: int) -> tuple[object, int]:
        if name in _WORDS:
            return _WORDS[name], end
        if not _CALL.search(name.rpartition(".")[2]):
            raise Fault(f"name {name}", at)
        end = self.blank(self.expect("(", end))
        if self.text[end : end + 1] in ('"', "'"):
            tag, end = self.string(end)
        elif found := _NAME.match(self.text, end):
            tag, end = found.group(), found.end()
        else:
            raise Fault("no component", end)
        props: dict = {}
        children: list = []
        n = 0
        while self.text[(end := self.blank(end)) : end + 1] == ",":
            end = self.blank(end + 1)
            if self.text[end : end + 1] == ")":
                break
            own, end = self.value(end, depth + 1)
            if n == 0:
                props = own if isinstance(own, dict) else {}
            elif name.endswith("createElement"):
                children.append(own)
            n += 1
        end = self.expect(")", end)
        return Component(tag, props | ({"children": children} if children else {})), end

    def array(self, at: int, depth: int) -> tuple[list, int]:
        out, at = [], self.blank(at + 1)
        while self.text[at : at + 1] != "]":
            own, at = self.value(at, depth + 1)
            out.append(own)
            at = self.blank(at)
            if self.text[at : at + 1] == ",":
                at = self.blank(at + 1)
            elif self.text[at : at + 1] != "]":
                raise Fault("open list", at)
        return out, at + 1

    def object(self, at: int, depth: int) -> tuple[dict, int]:
        out, at = {}, self.blank(at + 1)
        while self.text[at : at + 1] != "}":
            if self.text[at : at + 1] in ('"', "'"):
                key, at = self.string(at)
            elif found := _NAME.match(self.text, at) or _NUMBER.match(self.text, at):
                key, at = found.group(), found.end()
            else:
                raise Fault("no key", at)
            out[key], at = self.value(self.expect(":", at), depth + 1)
            at = self.blank(at)
            if self.text[at : at + 1] == ",":
                at = self.blank(at + 1)
            elif self.text[at : at + 1] != "}":
                raise Fault("open object", at)
        return out, at + 1

    def string(self, at: int) -> tuple[str, int]:
        quote, out, start = self.text[at], [], at
        at += 1
        while at < len(self.text):
            sign = self.text[at]
            if sign == quote:
                return "".join(out), at + 1
            if quote == "`" and self.text.startswith("${", at):
                raise Fault("expression in a text", at)
            if sign == "\n" and quote != "`":
                break
            if sign != "\\":
                out.append(sign)
                at += 1
                continue
            mark = self.text[at + 1 : at + 2]
            code = re.compile(r"u\{([0-9a-fA-F]{1,6})\}|u([0-9a-fA-F]{4})|x([0-9a-fA-F]{2})").match(self.text, at + 1)
            if code:
                point = int(next(x for x in code.groups() if x), 16)
                if point > 0x10FFFF:
                    raise Fault("character", at)
                out.append(chr(point))
                at = code.end()
            elif not mark or mark in "ux":
                raise Fault("escape", at)
            else:
                out.append(_ESCAPES.get(mark, mark))
                at += 2
        raise Fault("open text", start)

    def element(self, at: int, depth: int) -> tuple[Component, int]:
        """An element or a fragment, with its children."""
        if depth > MAX_DEPTH:
            raise Fault("too deep", at)
        start, at = at, at + 1
        found = _ATTRIBUTE.match(self.text, at)
        tag = found.group() if found else ""
        props, at = self.attributes(found.end() if found else at, depth)
        if self.text.startswith("/>", at):
            return Component(tag, props), at + 2
        if self.text[at : at + 1] != ">":
            raise Fault("open element", start)
        at += 1
        children: list = []
        while True:
            if at >= len(self.text):
                raise Fault("open element", start)
            if self.text.startswith("</", at):
                end = self.text.find(">", at)
                if end < 0 or self.text[at + 2 : end].strip() != tag:
                    raise Fault("end of another element", at)
                return Component(tag, props | ({"children": children} if children else {})), end + 1
            if self.text[at] == "<":
                own, at = self.element(at, depth + 1)
            elif self.text[at] == "{":
                if self.text[(inside := self.blank(at + 1)) : inside + 1] == "}":  # a comment alone
                    at = inside + 1
                    continue
                own, at = self.value(at + 1, depth + 1)
                at = self.expect("}", at)
            else:
                end = min(x for x in (self.text.find("<", at), self.text.find("{", at), len(self.text)) if x >= 0)
                own, at = self.text[at:end], end
            children.append(own)

    def attributes(self, at: int, depth: int) -> tuple[dict, int]:
        props: dict = {}
        while found := _ATTRIBUTE.match(self.text, at := self.blank(at)):
            at = self.blank(found.end())
            if self.text[at : at + 1] != "=":
                props[found.group()] = True
                continue
            at = self.blank(at + 1)
            if self.text[at : at + 1] == "{":
                props[found.group()], at = self.value(at + 1, depth + 1)
                at = self.expect("}", at)
            else:
                props[found.group()], at = self.string(at) if self.text[at : at + 1] in ('"', "'") else self.element(at, depth + 1)
        return props, at


def parsed(text: str) -> object:
    """The one value that a text is."""
    reader = Reader(text)
    value, end = reader.value(0)
    if (end := reader.blank(end)) != len(text):
        raise Fault("more than a value", end)
    return value


def text_of(value: object) -> str:
    """What a value shows: a component its children, a list its values, no more of an object than its title."""
    if isinstance(value, Component):
        return text_of(value.props.get("children"))
    if isinstance(value, list):
        return "".join(map(text_of, value))
    if isinstance(value, dict):
        return text_of(value.get("title"))
    return "" if value is None or isinstance(value, bool) else str(value)


def plain_json(value: object) -> object:
    """A value as JSON has it; a component is an object of its tag and properties."""
    if isinstance(value, Component):
        return {"component": value.tag, "props": plain_json(value.props)}
    if isinstance(value, list):
        return [plain_json(v) for v in value]
    return {k: plain_json(v) for k, v in value.items()} if isinstance(value, dict) else value


def components(text: str, name: str) -> Iterator[Component | Fault]:
    """Every use of a component in a text, as an element or as a call; one that can't be read is its Fault."""
    reader, at = Reader(text), 0
    use = re.compile(rf"<{re.escape(name)}\b|(?<![\w$])(?:[\w$]+\.)*_?jsxs?\(\s*{re.escape(name)}\s*,")
    while found := use.search(text, at):
        try:
            value, at = reader.element(found.start(), 0) if text[found.start()] == "<" else reader.value(found.start())
            yield value
        except Fault as fault:
            at = found.end()
            yield fault


def component_tables(text: str, name: str) -> list[tuple[list[str], list[list[str]]] | Fault]:
    """(heading, rows) of every component of that name with `columns` and `rows`; what can't be read is its Fault."""
    out: list = []
    for x in components(text, name):
        if isinstance(x, Fault):
            out.append(x)
        elif isinstance(top := x.props.get("columns"), list) and isinstance(rows := x.props.get("rows"), list):
            out.append(([text_of(v) for v in top], [[text_of(v) for v in r] for r in rows if isinstance(r, list)]))
    return out


def objects_in(text: str, start: str) -> Iterator[object]:
    """Every object in a text that begins with `start`; one that can't be read is its Fault."""
    reader, at = Reader(text), 0
    while (at := text.find(start, at)) >= 0:
        try:
            value, at = reader.value(at)
            yield value
        except Fault as fault:
            at += len(start)
            yield fault


def stream_of(body: str) -> str:
    """The script state that a rendered page carries: the texts pushed to it, in order, and a manifest's compiled source."""
    out, mark, at = [], "self.__next_f.push(", 0
    while (at := body.find(mark, at)) >= 0:
        at += len(mark)
        try:
            value, at = Reader(body).value(at)
        except Fault:
            continue
        if isinstance(value, list) and len(value) == 2 and isinstance(value[1], str):
            out.append(value[1])
    for part in re.findall(r'<template data-mint="manifest">(.*?)</template>', body, re.DOTALL):
        try:
            page = json.loads(part)["page"]["mdx"]["mdxSource"]["compiledSource"]
        except (ValueError, KeyError, TypeError):
            continue
        out.append(page if isinstance(page, str) else "")
    return "".join(out)


def unfenced(text: str) -> str:
    """A markdown text without its fenced blocks; a fence that nothing closes fences nothing."""
    out, held, fence = [], [], None
    for line in text.splitlines(keepends=True):
        bare = line.strip()
        run = len(bare) - len(bare.lstrip(bare[0])) if bare and bare[0] in "`~" else 0
        indent = len(line) - len(line.lstrip(" "))
        if fence:
            held.append(line)
            if run >= fence[1] and bare == fence[0] * run and indent <= 3:
                held, fence = [], None
        elif run >= 3 and indent <= 3:
            held, fence = [line], (bare[0], run)
        else:
            out.append(line)
    return "".join(out + held)


def scan_literals(df: DataFrame, column: str) -> DataFrame:
    """`df` with `<column>_json`, the literal in a text column as JSON, and `<column>_fault`, what can't be read of it and where. A null text has neither."""
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, faults = [], []
            for text in batch.column(at).to_pylist():
                value = fault = None
                if text is not None:
                    try:
                        value = json.dumps(plain_json(parsed(text)), ensure_ascii=False)
                    except Fault as found:
                        fault = str(found)
                made.append(value)
                faults.append(fault)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string()), pa.array(faults, pa.string())], names=[*batch.schema.names, f"{column}_json", f"{column}_fault"])

    own = df.schema.simpleString().removeprefix("struct<").removesuffix(">")
    return reachable(df).mapInArrow(run, f"{own}, `{column}_json` string, `{column}_fault` string")
