"""Workbooks in the open container format: a zip file of XML parts, read on the executors from whatever store Spark reads."""

from __future__ import annotations

import io
import posixpath
import re
import sys
import zipfile
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.names import quote

# Numbers of the built-in date and time formats, and the epochs of the two date systems.
DATE_FORMATS = {*range(14, 23), *range(45, 48)}
EPOCH, EPOCH_1904 = datetime(1899, 12, 30), datetime(1904, 1, 1)
ROWS = 5000

# Functions of this module travel to executors by value, so that workers need no copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _tag(e) -> str:
    return e.tag.rpartition("}")[2]


def _parts(book: zipfile.ZipFile, name: str, wanted: str):
    """Elements of a part as they are completed; each is dropped after use, so a large part is never held whole."""
    if name not in book.namelist():
        return
    with book.open(name) as part:
        path = []
        for event, e in ElementTree.iterparse(part, ("start", "end")):
            if event == "start":
                path.append(e)
                continue
            path.pop()
            if _tag(e) == wanted:
                yield e
                if path:
                    path[-1].remove(e)


def _plain(e) -> str:
    """Text of a string item: its runs joined, without phonetic hints."""
    return "".join(t.text or "" for child in e if _tag(child) in ("t", "r") for t in ([child] if _tag(child) == "t" else child) if _tag(t) == "t")


class Workbook:
    """Sheets of one workbook by name. Only shared strings and styles are held; rows are read as a stream."""

    def __init__(self, content: bytes):
        self.zip = zipfile.ZipFile(io.BytesIO(content))
        links = {e.get("Id"): e.get("Target") for e in _parts(self.zip, "xl/_rels/workbook.xml.rels", "Relationship")}
        self.sheets = {}
        for e in _parts(self.zip, "xl/workbook.xml", "sheet"):
            link = next((v for k, v in e.attrib.items() if k.endswith("}id")), None)
            self.sheets[e.get("name")] = posixpath.normpath(posixpath.join("/xl", links[link])).lstrip("/")
        old = any(e.get("date1904") in ("1", "true") for e in _parts(self.zip, "xl/workbook.xml", "workbookPr"))
        self.epoch = EPOCH_1904 if old else EPOCH
        self.strings = [_plain(e) for e in _parts(self.zip, "xl/sharedStrings.xml", "si")]
        own = {int(e.get("numFmtId")): e.get("formatCode", "") for e in _parts(self.zip, "xl/styles.xml", "numFmt")}
        dated = {k for k, code in own.items() if re.search(r"[ymdhs]", re.sub(r'"[^"]*"|\\.|\[(?![hms]+\])[^\]]*\]', "", code.lower()))}
        formats = [e for part in _parts(self.zip, "xl/styles.xml", "cellXfs") for e in part]
        self.dates = [int(e.get("numFmtId", 0)) in DATE_FORMATS | dated for e in formats]

    def rows(self, sheet: str):
        """Rows that hold cells, as lists of text or None; a cell that the file leaves out is None."""
        for row in _parts(self.zip, self.sheets[sheet], "row"):
            cells = []
            for c in row:
                at = re.match(r"[A-Z]+", c.get("r", ""))
                place = len(cells)
                if at:
                    place = 0
                    for letter in at[0]:
                        place = place * 26 + ord(letter) - 64
                    place -= 1
                cells += [None] * (place - len(cells)) + [self._value(c)]
            if any(x is not None for x in cells):
                yield cells

    def _value(self, c) -> str | None:
        kind, v = c.get("t", "n"), next((x for x in c if _tag(x) in ("v", "is")), None)
        if v is None:
            return None
        if kind == "inlineStr":
            return _plain(v)
        if v.text is None or kind == "e":
            return None
        if kind == "s":
            return self.strings[int(v.text)]
        if kind == "b":
            return "true" if v.text == "1" else "false"
        style = int(c.get("s", 0))
        if kind == "n" and style < len(self.dates) and self.dates[style]:
            return (self.epoch + timedelta(seconds=round(float(v.text) * 86400))).isoformat(sep=" ")
        return v.text


def _headers(sheet):
    """(path, names) of each workbook."""
    def run(batches):
        for batch in batches:
            out = []
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                book = _open(path, content)
                first = next(book.rows(_sheet(book, sheet, path)), [])
                out.append((path, [x if x is not None else f"Unnamed: {i}" for i, x in enumerate(first)]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in out], pa.string()), pa.array([n for _, n in out], pa.list_(pa.string()))], names=["path", "names"])

    return run


def _body(sheet, names):
    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                book = _open(path, content)
                rows = book.rows(_sheet(book, sheet, path))
                own = {x if x is not None else f"Unnamed: {i}": i for i, x in enumerate(next(rows, []))}
                places, held = [own.get(n) for n in names], []
                for cells in rows:
                    held.append([cells[i] if i is not None and i < len(cells) else None for i in places])
                    if len(held) == ROWS:
                        yield _batch(names, held)
                        held = []
                if held:
                    yield _batch(names, held)

    return run


def _batch(names, rows):
    return pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*rows)], names=list(names))


def _open(path, content) -> Workbook:
    try:
        return Workbook(content)
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError) as e:
        raise ValueError(f"{path} is no workbook: {e}") from e


def _sheet(book: Workbook, sheet, path) -> str:
    names = list(book.sheets)
    if sheet is None:
        return names[0]
    if sheet not in book.sheets:
        raise ValueError(f"{path} has no sheet {sheet!r}; it has {names}")
    return sheet


def sheet_rows(books: DataFrame, sheet: str | None = None) -> DataFrame:
    """Rows of one sheet (default: the first) of each workbook in ``books`` (path, content), as string columns named by its first row.

    Columns are matched by name: one that a workbook lacks is null there. Dates come as text such as 2024-01-31 00:00:00, numbers as
    they are written in the file, truth values as true or false, errors and empty cells as null; rows without any value are
    left out. A workbook is one task, which holds its compressed bytes and its shared strings. A file that is no workbook, or
    lacks the sheet, fails by its name, and so does a name that heads two columns.
    """
    found = books.select("path", "content").mapInArrow(_headers(sheet), "path string, names array<string>")
    # one row per different header, in the order of the first file that has it
    heads = found.groupBy("names").agg(F.min("path").alias("path")).orderBy("path").collect()
    names = list(dict.fromkeys(n for h in heads for n in h["names"]))
    twice = sorted({n for h in heads for n in h["names"] if h["names"].count(n) > 1})
    if twice:
        raise ValueError(f"{heads[0]['path']} has several columns named {twice}")
    if not names:
        raise ValueError("the sheet has no header")
    return books.select("path", "content").mapInArrow(_body(sheet, names), ", ".join(f"{quote(n)} string" for n in names))


def read_workbooks(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """The same for files; ``path`` may be a folder or a pattern."""
    return sheet_rows(spark.read.format("binaryFile").load(path), sheet)
