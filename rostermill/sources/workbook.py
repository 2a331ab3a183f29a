"""Workbook sheets as all-string rows.

A workbook is a zip archive that cannot be split, so its unit of work is one
file: the listing is spread over the tasks, and a task unpacks each of its
workbooks once, streams the XML of all wanted sheets and gives their cells out
as Arrow batches. A sheet has at most 1,048,576 rows by format.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Mapping
from datetime import datetime, timedelta
from typing import NamedTuple
from xml.etree import ElementTree

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rostermill.operators.clean import normalize_nulls
from rostermill.schemas import NA_TOKENS, SHEET_PRIORITY, strings
from rostermill.sources.files import literal_paths

BATCH = 4_096

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_DATE_FORMAT_IDS = {*range(14, 23), 45, 46, 47}
#: what a damaged or foreign file raises; it fails that file only
_BROKEN = (zipfile.BadZipFile, ElementTree.ParseError, KeyError, IndexError, ValueError)
_QUOTED = re.compile(r'"[^"]*"|\[[^\]]*\]|\\.')


def _sheet_parts(book: zipfile.ZipFile) -> dict[str, str]:
    """Sheet name → member of the archive, in workbook order."""
    targets = {
        rel.get("Id"): rel.get("Target")
        for rel in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    }
    out = {}
    for sheet in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet"):
        target = targets[sheet.get(f"{_REL}id")]
        out[sheet.get("name")] = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    return out


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    out = []
    with book.open("xl/sharedStrings.xml") as part:
        for _, item in ElementTree.iterparse(part):
            if item.tag == f"{_MAIN}si":
                runs = [t for t in item.iter(f"{_MAIN}t")]
                phonetic = {id(t) for r in item.iter(f"{_MAIN}rPh") for t in r.iter(f"{_MAIN}t")}
                out.append("".join(t.text or "" for t in runs if id(t) not in phonetic))
                item.clear()
    return out


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Cell style numbers that show a number as a date."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    custom = {
        int(f.get("numFmtId"))
        for f in root.iter(f"{_MAIN}numFmt")
        if re.search(r"[ymdhs]", _QUOTED.sub("", f.get("formatCode", "")).lower())
    }
    formats = root.find(f"{_MAIN}cellXfs")
    return {
        i
        for i, xf in enumerate(formats if formats is not None else [])
        if int(xf.get("numFmtId", "0")) in _DATE_FORMAT_IDS | custom
    }


def _number_text(text: str, is_date: bool, epoch: datetime) -> str:
    number = float(text)
    if is_date:
        moment = epoch + timedelta(seconds=round(number * 86_400))
        return moment.strftime("%Y-%m-%d %H:%M:%S")
    return str(int(number)) if number.is_integer() else repr(number)


def _column_index(ref: str) -> int:
    index = 0
    for ch in ref:
        if not ch.isalpha():
            break
        index = index * 26 + ord(ch.upper()) - 64
    return index - 1


def _cell_text(cell, shared: list[str], dates: set[int], epoch: datetime) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
    value = cell.find(f"{_MAIN}v")
    if value is None or value.text is None:
        return None
    if kind == "s":
        return shared[int(value.text)]
    if kind == "b":
        return "True" if value.text == "1" else "False"
    if kind == "n":
        return _number_text(value.text, int(cell.get("s", "0")) in dates, epoch)
    return value.text


class _Book:
    """An unpacked workbook; what sheets share is read once."""

    def __init__(self, content: bytes):
        self.zip = zipfile.ZipFile(io.BytesIO(content))
        self.parts = _sheet_parts(self.zip)
        self.shared, self.dates = _shared_strings(self.zip), _date_styles(self.zip)
        old_mac = b'date1904="1"' in self.zip.read("xl/workbook.xml")
        self.epoch = datetime(1904, 1, 1) if old_mac else datetime(1899, 12, 30)

    def rows(self, sheet: str) -> Iterator[dict[int, str]]:
        """Cells of each row by column index, header row first."""
        with self.zip.open(self.parts[sheet]) as xml:
            for _, item in ElementTree.iterparse(xml):
                if item.tag != f"{_MAIN}row":
                    continue
                cells = {}
                for i, cell in enumerate(item.iter(f"{_MAIN}c")):
                    ref = cell.get("r")
                    text = _cell_text(cell, self.shared, self.dates, self.epoch)
                    cells[_column_index(ref) if ref else i] = text
                item.clear()
                yield cells


def workbook_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The given workbooks as (path, content)."""
    return (
        spark.read.format("binaryFile").load(literal_paths(paths)).select("path", "content")
    )


def list_sheets(books: DataFrame) -> DataFrame:
    """(path, sheet, position) of every sheet in the readable workbooks."""

    def names(batches):
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"]):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as book:
                        rows += [(path, s, i) for i, s in enumerate(_sheet_parts(book))]
                except _BROKEN:
                    continue
            yield pd.DataFrame(rows, columns=["path", "sheet", "position"])

    return books.mapInPandas(names, "path string, sheet string, position int")


def rank_sheets(sheets: DataFrame, name: str = "sheet") -> DataFrame:
    """Known sheets only, with their load priority (24 fixed names)."""
    spark = sheets.sparkSession
    known = spark.createDataFrame(list(SHEET_PRIORITY.items()), "_sheet string, priority double")
    return sheets.join(F.broadcast(known), sheets[name] == known["_sheet"]).drop("_sheet")


class Sheet(NamedTuple):
    """What is wanted of a sheet."""

    columns: list[str]
    required: list[str] = []
    must_exist: bool = False


def _header(cells: dict[int, str]) -> dict[str, int]:
    """Column name → index. A name's second column is called name.1, the third
    name.2; one without a name is called by its number."""
    at: dict[str, int] = {}
    for index, text in sorted(cells.items()):
        name = (text or "").strip() or f"column {index + 1}"
        twin, number = name, 0
        while twin in at:
            number += 1
            twin = f"{name}.{number}"
        at[twin] = index
    return at


class _Columns:
    """Rows of one sheet gathered column by column."""

    def __init__(self, schema: pa.Schema, sheet: str | None, path: str):
        self.schema, self.sheet, self.path = schema, sheet, path
        self.clear()

    def clear(self) -> None:
        self.cells: dict[str, list] = {}
        self.more: list[list[tuple[str, str]]] = []
        self.lines: list[int] = []

    def add(self, number: int, cells: dict[int, str], at: dict[str, int], more: dict[int, str]) -> None:
        for name, index in at.items():
            self.cells.setdefault(name, []).append(cells.pop(index, None))
        rest = [(more.get(i) or f"column {i + 1}", t) for i, t in sorted(cells.items())]
        self.more.append([(n, t) for n, t in rest if t not in (None, "")])
        self.lines.append(number)

    def batch(self, problem: str | None = None) -> pa.RecordBatch:
        rows = len(self.lines)
        fixed = {
            "_sheet": [self.sheet] * rows, "_file": [self.path] * rows, "_block": [0] * rows,
            "_line": self.lines, "_more": self.more, "_problem": [problem] * rows,
        }
        values = fixed | self.cells
        none = [None] * rows
        arrays = [pa.array(values.get(f.name, none), f.type) for f in self.schema]
        self.clear()
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def _book_batches(
    path: str, content: bytes, sheets: Mapping[str, Sheet], schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    """All wanted sheets of one workbook, unpacked once."""
    out = _Columns(schema, None, path)
    try:
        book = _Book(content)
        for name, want in sheets.items():
            out = _Columns(schema, name, path)
            if name not in book.parts:
                if want.must_exist:
                    raise ValueError(f"no sheet {name}")
                continue
            rows = book.rows(name)
            at = _header(next(rows, {}))
            if missing := sorted(set(want.required) - at.keys()):
                raise ValueError(f"missing columns: {', '.join(missing)}")
            wanted = {c: at[c] for c in want.columns if c in at}
            more = {i: c for c, i in at.items()}
            for number, cells in enumerate(rows):
                if any(v not in (None, "") for v in cells.values()):
                    out.add(number, cells, wanted, more)
                    if len(out.lines) == BATCH:
                        yield out.batch()
            if out.lines:
                yield out.batch()
    except _BROKEN as problem:
        if out.lines:
            yield out.batch()
        out.add(-1, {}, {}, {})
        yield out.batch(f"{type(problem).__name__}: {problem}")


def parse_workbooks(books: DataFrame, sheets: Mapping[str, Sheet]) -> DataFrame:
    """Rows of several sheets of all workbooks, each unpacked once.

    Returns ``_sheet``, the columns that any sheet wants, ``_more`` (the text of
    all other columns by name), position and ``_problem``. Columns are found by
    the names in a sheet's first row; one that is absent gives nulls unless it
    is required. Whole numbers become integer text, date cells
    ``YYYY-MM-DD HH:MM:SS`` text. A workbook that cannot be read, lacks a
    required column or a sheet that must exist gives one row with only its name
    and ``_problem``, so the others go on.
    """
    columns = list(dict.fromkeys(c for s in sheets.values() for c in s.columns))
    texts = [(c, pa.string()) for c in columns]
    place = [("_file", pa.string()), ("_block", pa.int64()), ("_line", pa.int64())]
    more = ("_more", pa.map_(pa.string(), pa.string()))
    schema = pa.schema([("_sheet", pa.string()), *texts, more, *place, ("_problem", pa.string())])
    kinds = strings(["_sheet", *columns]).add("_more", T.MapType(T.StringType(), T.StringType()))
    kinds = kinds.add("_file", "string").add("_block", "long").add("_line", "long").add("_problem", "string")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                yield from _book_batches(path.as_py(), content.as_py(), sheets, schema)

    parsed = books.select("path", "content").mapInArrow(parse, kinds)
    missing = F.array(*[F.lit(t) for t in NA_TOKENS])
    said = F.map_filter("_more", lambda _, text: ~F.array_contains(missing, F.trim(text)))
    return normalize_nulls(parsed.withColumn("_more", said), columns)


def sheet_rows(parsed: DataFrame, sheet: str, columns: list[str]) -> DataFrame:
    """The good rows of one sheet of :func:`parse_workbooks`."""
    good = parsed.where((F.col("_sheet") == sheet) & F.col("_problem").isNull())
    return good.select(*columns, "_file", "_block", "_line", "_more")


def parse_workbook_sheets(
    books: DataFrame,
    sheet: str,
    columns: list[str],
    required: list[str] | None = None,
    sheet_required: bool = False,
) -> DataFrame:
    """:func:`parse_workbooks` of one sheet, without further columns."""
    want = Sheet(columns, required or [], sheet_required)
    return parse_workbooks(books, {sheet: want}).drop("_sheet", "_more")


def read_workbook_sheets(books: DataFrame, sheet: str, columns: list[str]) -> DataFrame:
    """The good rows of :func:`parse_workbook_sheets`."""
    return parse_workbook_sheets(books, sheet, columns).where("_problem IS NULL").drop("_problem")
