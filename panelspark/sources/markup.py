"""Rows out of pages: HTML tables, wikitext tables, section trees, embedded objects, labels of cells."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class _Tables(HTMLParser):
    """Rows of all tables of a page; a nested table is its own, and its text isn't its cell's."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[dict] = []
        self.rows: list[tuple] = []
        self.count = 0

    def _end_row(self, t: dict) -> None:
        if t["cells"]:
            self.rows.append((t["no"], t["parent"], t["row"], t["head"], [" ".join("".join(c).split()) for c in t["cells"]]))
            t["row"] += 1
        t["cells"], t["head"], t["into"] = [], True, None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "table":
            self.open.append({"no": self.count, "parent": self.open[-1]["no"] if self.open else None, "row": 0, "cells": [], "head": True, "into": None})
            self.count += 1
        elif self.open and tag == "tr":
            self._end_row(self.open[-1])
        elif self.open and tag in ("td", "th"):
            t = self.open[-1]
            t["head"] = t["head"] and tag == "th"
            t["into"] = []
            t["cells"].append(t["into"])
        elif self.open and self.open[-1]["into"] is not None:
            self.open[-1]["into"].append(" ")

    def handle_endtag(self, tag: str) -> None:
        if not self.open:
            return
        if tag in ("td", "th"):
            self.open[-1]["into"] = None
        elif tag == "tr":
            self._end_row(self.open[-1])
        elif tag == "table":
            self._end_row(self.open.pop())

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1]["into"] is not None:
            self.open[-1]["into"].append(data)

    def of(self, page: str) -> list[tuple]:
        self.feed(page)
        self.close()
        while self.open:
            self._end_row(self.open.pop())
        return self.rows


def _exploded(df: DataFrame, key: str, text: str, parse, names: list[str], schema: str) -> DataFrame:
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([(k, *r) for k, page in zip(batch["_key"], batch["_text"], strict=True) if page for r in parse(page)], columns=[key, *names])

    return df.select(F.col(key).alias("_key"), F.col(text).alias("_text")).mapInPandas(run, f"`{key}` {kind}, {schema}")


def html_tables(df: DataFrame, key: str, html: str) -> DataFrame:
    """(key, table_no, parent_no, row_no, is_header, cells) of each row of each table, nested ones apart; a row without cells is none. Null pages give none."""
    return _exploded(df, key, html, lambda page: _Tables().of(page), ["table_no", "parent_no", "row_no", "is_header", "cells"], "table_no int, parent_no int, row_no int, is_header boolean, cells array<string>")


def _wiki(text: str) -> Iterator[tuple]:
    section, header, cells, heads, inside, no = "", None, [], [], False, 0

    def ended():
        nonlocal header, no
        out = None
        if cells and all(heads):
            header = [*cells]
        elif cells:
            out = (section, no, header, [*cells])
            no += 1
        cells.clear()
        heads.clear()
        return out

    for line in [*text.splitlines(), "|}"]:
        line = line.strip()
        if not inside and (m := re.fullmatch(r"(={2,6})\s*(.*?)\s*\1", line)):
            section = m[2]
        elif line.startswith("{|"):
            inside, header = True, None
        elif inside and line.startswith(("|-", "|}")):
            if row := ended():
                yield row
            inside = not line.startswith("|}")
        elif inside and line[:1] in ("|", "!") and not line.startswith("|+"):
            for part in re.split(r"\|\|" if line[0] == "|" else r"!!|\|\|", line[1:]):
                # Attributes stand before a lone bar; bars in links and templates don't count.
                bare = re.sub(r"\[\[[^\]]*\]\]|\{\{[^}]*\}\}", lambda m: m[0].replace("|", "\0"), part)
                cells.append(bare.rsplit("|", 1)[-1].replace("\0", "|").strip())
                heads.append(line[0] == "!")


def wikitext_tables(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, section, row_no, header, cells) of the data rows of wikitext tables; header is the nearest all-header row above in the table, null without one: then cells are named by position."""
    return _exploded(df, key, text, _wiki, ["section", "row_no", "header", "cells"], "section string, row_no int, header array<string>, cells array<string>")


def by_header(header: Column, cells: Column, names: dict[str, str], layouts: dict[int, list[str]] | None = None) -> Column:
    """Cells as a map by canonical name: from the header's text (lower case, one space) through ``names``; without a header, by the layout for this number of cells. The first of equal names stays; unknown ones go."""
    known = F.create_map(*[F.lit(x) for p in names.items() for x in p])
    label = F.transform(header, lambda h: F.try_element_at(known, F.lower(F.regexp_replace(F.trim(h), r"\s+", " "))))
    for width, layout in (layouts or {}).items():
        label = F.when(header.isNull() & (F.size(cells) == width), F.array(*map(F.lit, layout))).otherwise(label)
    pairs = F.filter(F.arrays_zip(label.alias("k"), cells.alias("v")), lambda p: p["k"].isNotNull())
    first = F.filter(pairs, lambda p, i: (i == 0) | ~F.array_contains(F.transform(F.slice(pairs, F.lit(1), i), lambda q: q["k"]), p["k"]))
    return F.map_from_entries(first)


def by_banner(banner: Column, values: Column, grids: list[tuple[str, list[str]]], other: list[str] | None = None) -> Column:
    """Unlabelled values as a map: the first pattern that the banner or position matches picks the labels; a surplus on either side goes."""
    labels = F.when(F.lit(False), F.array(F.lit("")))
    for pattern, names in grids:
        labels = labels.when(banner.rlike(pattern), F.array(*map(F.lit, names)))
    if other:
        labels = labels.otherwise(F.array(*map(F.lit, other)))
    n = F.least(F.size(labels), F.size(values))
    return F.when(labels.isNotNull() & values.isNotNull(), F.map_from_arrays(F.slice(labels, F.lit(1), n), F.slice(values, F.lit(1), n)))


def section_tree(text: Column, head: str, level: int, title: int) -> Column:
    """array<struct<level, path, body>> of a page cut at headings; ``level`` and ``title`` are groups of the pattern.

    The first entry is the lead (level 0, path ['']). A heading's path holds the open headings of smaller
    levels and itself. ``level`` is a group whose length (``==``) or digit (``h2``) tells the depth. Null: null.
    """
    mark = F.regexp_extract_all(text, F.lit(head), F.lit(level))
    depth = F.transform(mark, lambda m: F.coalesce(m.try_cast("int"), F.char_length(m)))
    titles = F.transform(F.regexp_extract_all(text, F.lit(head), F.lit(title)), lambda t: F.trim(t))
    bodies = F.split(text, head, -1)
    heads = F.zip_with(depth, titles, lambda d, t: F.struct(d.alias("level"), t.alias("title")))
    empty = "array<struct<level:int,title:string>>"
    start = F.struct(F.array().cast(empty).alias("stack"), F.array().cast("array<struct<level:int,path:array<string>>>").alias("out"))

    def step(acc: Column, h: Column) -> Column:
        # Open levels rise, so closing down to a level is a filter.
        stack = F.concat(F.filter(acc["stack"], lambda s: s["level"] < h["level"]), F.array(h))
        one = F.struct(h["level"].alias("level"), F.transform(stack, lambda s: s["title"]).alias("path"))
        return F.struct(stack.alias("stack"), F.concat(acc["out"], F.array(one)).alias("out"))

    found = F.aggregate(heads, start, step)["out"]
    lead = F.array(F.struct(F.lit(0).alias("level"), F.array(F.lit("")).alias("path")))
    return F.zip_with(F.concat(lead, found), bodies, lambda h, b: F.struct(h["level"].alias("level"), h["path"].alias("path"), b.alias("body")))


def embedded_object(page: Column, mark: str) -> Column:
    """The JSON object right after the first match of ``mark`` that one follows, as its text; null where none parses."""
    @F.pandas_udf("string")
    def located(pages: pd.Series) -> pd.Series:
        reader = json.JSONDecoder()

        def one(text: str | None) -> str | None:
            for m in re.finditer(mark, text or ""):
                at = m.end()
                if text[at : at + 1] == "{":
                    try:
                        return text[at : reader.raw_decode(text, at)[1]]
                    except ValueError:
                        continue
            return None

        return pages.map(one, na_action=None).astype(object)

    return located(page)
