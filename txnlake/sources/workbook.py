"""Excel workbooks: the first sheet of each file, parsed from its XML as a stream, a task for each file.

A sheet has 1,048,576 rows at most, so a file is a bounded task; a folder of files is read by many. Spark's own reader fetches the bytes,
from whatever store it can read. Shared strings are read first; cells then come row by row.
"""

from __future__ import annotations

import datetime as dt
import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Built-in number formats that show dates or times.
DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
BATCH = 2000


def _name(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _parts(book: zipfile.ZipFile, path: str, *names: str) -> Iterator[ElementTree.Element]:
    """The elements of these names, freed as soon as they are used."""
    if path not in book.namelist():
        return
    with book.open(path) as f:
        for _, e in ElementTree.iterparse(f):
            if _name(e.tag) in names:
                yield e
                e.clear()


def _text(e: ElementTree.Element) -> str:
    """The runs of a string, without phonetic ones."""
    return "".join(_text(x) if _name(x.tag) == "r" else x.text or "" for x in e if _name(x.tag) in ("r", "t"))


def _attribute(e: ElementTree.Element, name: str) -> str | None:
    return next((v for k, v in e.attrib.items() if _name(k) == name), None)


def _first_sheet(book: zipfile.ZipFile) -> tuple[str, bool]:
    """Its path, and whether days count from 1904."""
    sheet, since_1904 = None, False
    for e in _parts(book, "xl/workbook.xml", "sheet", "workbookPr"):
        if _name(e.tag) == "workbookPr":
            since_1904 = _attribute(e, "date1904") in ("1", "true")
        elif sheet is None:
            sheet = next((v for k, v in e.attrib.items() if _name(k) == "id" and "}" in k), None)
    targets = {_attribute(e, "Id"): _attribute(e, "Target") for e in _parts(book, "xl/_rels/workbook.xml.rels", "Relationship")}
    target = targets.get(sheet, "worksheets/sheet1.xml")
    return posixpath.normpath(posixpath.join("xl", target)) if not target.startswith("/") else target[1:], since_1904


def _date_styles(book: zipfile.ZipFile) -> list[bool]:
    """For each cell style, whether it shows a date or time."""
    own, out = {}, []
    for e in _parts(book, "xl/styles.xml", "numFmt", "cellXfs"):
        if _name(e.tag) == "numFmt":
            plain = re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", _attribute(e, "formatCode") or "")
            own[_attribute(e, "numFmtId")] = bool(re.search("[dmyhs]", plain, re.I))
        else:
            ids = [_attribute(x, "numFmtId") or "0" for x in e]
            out = [own.get(i, int(i) in DATE_FORMATS) for i in ids]
    return out


def _moment(value: float, since_1904: bool) -> str:
    start = dt.datetime(1904, 1, 1) if since_1904 else dt.datetime(1899, 12, 30)
    if not since_1904 and value < 60:  # the calendar has a 29th of February 1900
        start = dt.datetime(1899, 12, 31)
    at = start + dt.timedelta(seconds=round(value * 86400))
    return at.strftime("%Y-%m-%d") if at.time() == dt.time() else at.strftime("%Y-%m-%d %H:%M:%S")


def _column(reference: str) -> int:
    out = 0
    for c in reference:
        if not c.isalpha():
            break
        out = out * 26 + ord(c.upper()) - 64
    return out - 1


def sheet_rows(content: bytes) -> Iterator[list[str | None]]:
    """The rows of the first sheet as texts; rows without any value are left out.

    Dates are ISO texts, whole numbers have no point, booleans are True or False, and empty cells and errors are None.
    """
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        sheet, since_1904 = _first_sheet(book)
        strings = [_text(e) for e in _parts(book, "xl/sharedStrings.xml", "si")]
        dated = _date_styles(book)

        def value(cell: ElementTree.Element) -> str | None:
            kind, raw = cell.get("t", "n"), next((x.text for x in cell if _name(x.tag) == "v"), None)
            if kind == "inlineStr":
                return "".join(_text(x) for x in cell if _name(x.tag) == "is")
            if raw is None or kind == "e":
                return None
            if kind == "s":
                return strings[int(raw)]
            if kind == "b":
                return str(raw == "1")
            if kind != "n":
                return raw
            style, number = int(cell.get("s", 0)), float(raw)
            if style < len(dated) and dated[style]:
                return _moment(number, since_1904)
            return str(int(number)) if number.is_integer() and abs(number) < 1e15 else repr(number)

        for row in _parts(book, sheet, "row"):
            cells: dict[int, str | None] = {}
            for cell in row:
                at = _column(cell.get("r", "")) if cell.get("r") else max(cells, default=-1) + 1
                found = value(cell)
                cells[at] = found if found != "" else None
            if any(v is not None for v in cells.values()):
                yield [cells.get(i) for i in range(max(cells) + 1)]


def _read(batches):
    def batch(path, number, rows):
        n = len(rows)
        return pa.RecordBatch.from_arrays([pa.array([path] * n, pa.string()), pa.array(range(number - n, number), pa.int64()), pa.array(rows, pa.list_(pa.string()))], names=["file", "row", "cells"])

    for b in batches:
        for path, content in zip(b.column(0).to_pylist(), b.column(1)):
            rows, number = [], 0
            for row in sheet_rows(content.as_py()):
                rows.append(row)
                number += 1
                if len(rows) == BATCH:
                    yield batch(path, number, rows)
                    rows = []
            yield batch(path, number, rows)


def scan(spark: SparkSession, path: str) -> DataFrame:
    """The rows under the names in the first row of each file, all as strings; of several files each has the same header."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    rows = files.mapInArrow(_read, "file string, row long, cells array<string>")
    head = rows.where("row = 0").orderBy("file").first()
    if head is None:
        return spark.createDataFrame([], "value string")
    names = [n if n is not None else f"_c{i}" for i, n in enumerate(head.cells)]
    return rows.where("row > 0").select(*[F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(names)])
