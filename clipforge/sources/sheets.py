"""Sheets of ``.xlsx`` workbooks as DataFrames.

A workbook is a zip archive of XML parts, so one file is one task; its rows are streamed
out of the task in batches. Cells are strings as they are stored (shared and inline texts
resolved, booleans ``TRUE`` or ``FALSE``, errors and empty cells null).
"""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = 5000
_SCHEMA = "path string, row_pos long, cells array<string>"


def _tag(e) -> str:
    return e.tag.rpartition("}")[2]


def _text(e) -> str:
    """The text of a rich or plain string; phonetic guides are no part of it."""
    runs = [e, *(r for r in e if _tag(r) == "r")]
    return "".join(t.text or "" for r in runs for t in r if _tag(t) == "t")


def _part(book: zipfile.ZipFile, sheet: str | None) -> str:
    """The archive member of a sheet; the first sheet if no name is given."""
    links = {r.get("Id"): r.get("Target") for r in ET.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    names = {}
    for e in ET.fromstring(book.read("xl/workbook.xml")).iter():
        if _tag(e) == "sheet":
            link = next(v for k, v in e.attrib.items() if k.endswith("}id"))
            names[e.get("name")] = links[link]
    if sheet is not None and sheet not in names:
        raise ValueError(f"no sheet {sheet!r}; sheets found: {list(names)}")
    target = names[sheet] if sheet is not None else next(iter(names.values()))
    return target.lstrip("/") if target.startswith("/") else "xl/" + target


def _column(ref: str | None, following: int) -> int:
    """Column number of a cell reference such as ``AB12``; cells without one follow each other."""
    letters = re.match("[A-Z]*", ref or "")[0]
    if not letters:
        return following
    n = 0
    for c in letters:
        n = 26 * n + ord(c) - 64
    return n - 1


def _cell(c, shared: list[str]) -> str | None:
    kind = c.get("t")
    if kind == "inlineStr":
        return next((_text(e) for e in c if _tag(e) == "is"), None)
    value = next((e.text for e in c if _tag(e) == "v"), None)
    if value is None or kind == "e":
        return None
    if kind == "b":
        return "TRUE" if value == "1" else "FALSE"
    return shared[int(value)] if kind == "s" else value


def rows_of_sheet(raw: bytes, sheet: str | None = None) -> Iterator[list[str | None]]:
    """The rows of a sheet that hold a cell, from the top."""
    with zipfile.ZipFile(io.BytesIO(raw)) as book:
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = [_text(e) for e in ET.fromstring(book.read("xl/sharedStrings.xml")) if _tag(e) == "si"]
        with book.open(_part(book, sheet)) as part:
            for _, e in ET.iterparse(part):
                if _tag(e) != "row":
                    continue
                cells: list[str | None] = []
                for c in e:
                    at = _column(c.get("r"), len(cells))
                    cells += [None] * (at + 1 - len(cells))
                    cells[at] = _cell(c, shared)
                e.clear()
                if any(v is not None for v in cells):
                    yield cells


def _rows(sheet: str | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                held = []
                for pos, cells in enumerate(rows_of_sheet(content, sheet)):
                    held.append((path, pos, cells))
                    if len(held) == BATCH:
                        yield pd.DataFrame(held, columns=["path", "row_pos", "cells"])
                        held = []
                yield pd.DataFrame(held, columns=["path", "row_pos", "cells"])
    return run


def read_sheet(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """The rows below the header row of a sheet (the first sheet if no name is given): one
    string column per header, and ``row_pos`` in file order. An empty header is ``_c<number>``,
    of equal ones the later get ``.<number>``; a sheet without rows has no columns but ``row_pos``."""
    raw = spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(_rows(sheet), _SCHEMA)
    head = raw.where("row_pos = 0").first()
    names, seen = [], {}
    for i, name in enumerate(head["cells"] if head else []):
        name = name if name is not None else f"_c{i}"
        seen[name] = seen.get(name, -1) + 1
        names.append(f"{name}.{seen[name]}" if seen[name] else name)
    cells = [F.get("cells", F.lit(i)).alias(name) for i, name in enumerate(names)]
    return raw.where("row_pos > 0").select(*cells, "row_pos")
