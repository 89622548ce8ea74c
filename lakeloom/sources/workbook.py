"""Spreadsheet workbooks in and out, one workbook per task step.

A sheet holds at most 1,048,576 rows by format, so one workbook is a bounded
piece of work; scale comes from many workbooks. Rows stream through Arrow
batches in both directions.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import sys
import zipfile
from collections.abc import Iterator
from decimal import Decimal
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BooleanType, DateType, NumericType, StructType, TimestampNTZType, TimestampType

from lakeloom.session import durable

# Workers receive this module with the job and need no installation.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_ROWS = 1_048_575  # below the header row
# Name spaces of the workbook format and its first day.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
DOC_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
PKG_REL = "{http://schemas.openxmlformats.org/package/2006/relationships}"
EPOCH = dt.datetime(1899, 12, 30)


def _column(ref: str) -> int:
    """Zero-based column of a cell reference such as ``AB12``."""
    n = 0
    for ch in re.match(r"[A-Z]+", ref).group():
        n = n * 26 + ord(ch) - 64
    return n - 1


def _text(node) -> str:
    return "".join(t.text or "" for t in node.iter(f"{MAIN}t"))


def _sheet_part(book: zipfile.ZipFile, sheet: str) -> str | None:
    root = ET.fromstring(book.read("xl/workbook.xml"))
    ids = {s.get("name"): s.get(f"{DOC_REL}id") for s in root.iter(f"{MAIN}sheet")}
    if sheet not in ids:
        return None
    rels = ET.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = next(r.get("Target") for r in rels.iter(f"{PKG_REL}Relationship") if r.get("Id") == ids[sheet])
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def sheet_rows(content: bytes, sheet: str, header_rows: int = 1) -> Iterator[list]:
    """Rows of one sheet as lists of text, header first; nothing if the sheet is absent."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        part = _sheet_part(book, sheet)
        if part is None:
            return
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = [_text(si) for si in ET.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{MAIN}si")]
        with book.open(part) as stream:
            for number, (_, row) in enumerate(
                    (e for e in ET.iterparse(stream) if e[1].tag == f"{MAIN}row"), start=1):
                if number >= header_rows:
                    cells: list = []
                    for at, cell in enumerate(row.iter(f"{MAIN}c")):
                        at = _column(cell.get("r")) if cell.get("r") else at
                        cells += [None] * (at + 1 - len(cells))
                        value = cell.find(f"{MAIN}v")
                        kind = cell.get("t")
                        if kind == "inlineStr":
                            cells[at] = _text(cell)
                        elif value is not None and value.text is not None:
                            cells[at] = shared[int(value.text)] if kind == "s" else value.text
                    yield cells
                row.clear()


def _typed(values: pd.Series, kind) -> pd.Series:
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        days = pd.to_numeric(values, errors="coerce")
        parsed = EPOCH + pd.to_timedelta((days * 86400).round(), unit="s")
        return parsed.dt.date if isinstance(kind, DateType) else parsed
    if isinstance(kind, BooleanType):
        return values.map({"1": True, "0": False, "true": True, "false": False})
    if isinstance(kind, NumericType):
        numbers = pd.to_numeric(values, errors="coerce")
        return numbers.astype("Int64") if kind.typeName() in ("integer", "long", "short", "byte") else numbers
    return values


def read_workbooks(
    spark: SparkSession, path: str, sheet: str, schema: StructType, header_rows: int = 1, batch: int = 10_000,
) -> DataFrame:
    """The named sheet of every workbook below ``path``, columns matched by header text."""
    types = {f.name: f.dataType for f in schema.fields}

    def frame(rows: list[dict]) -> pd.DataFrame:
        table = pd.DataFrame(rows, columns=list(types), dtype="object")
        return pd.DataFrame({c: _typed(table[c], t) for c, t in types.items()})

    def parse(batches):
        for files in batches:
            for content in files["content"]:
                rows, header = [], None
                for cells in sheet_rows(content, sheet, header_rows):
                    if header is None:
                        header = cells
                        continue
                    rows.append(dict(zip(header, cells)))
                    if len(rows) == batch:
                        yield frame(rows)
                        rows = []
                if rows:
                    yield frame(rows)

    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx")
             .option("recursiveFileLookup", True).load(path).select("content"))
    return files.mapInPandas(parse, schema)


def _cell(value) -> str:
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return "<c/>"
    if isinstance(value, bool):
        return f'<c t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float, Decimal)):
        return f"<c><v>{value}</v></c>"
    if isinstance(value, dt.datetime):
        return f"<c><v>{(value - EPOCH).total_seconds() / 86400}</v></c>"
    if isinstance(value, dt.date):
        return f"<c><v>{(dt.datetime(value.year, value.month, value.day) - EPOCH).days}</v></c>"
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'


def _row(values) -> str:
    return "<row>" + "".join(_cell(v) for v in values) + "</row>"


class _Book:
    """One workbook: small cover sheets first, then the named sheet written row by row."""

    def __init__(self, sheet: str, header: list[str], cover: dict[str, list[tuple]]):
        names = [*cover, sheet]
        numbers = range(1, len(names) + 1)
        self.buffer, self.rows = io.BytesIO(), 0
        self.zip = zipfile.ZipFile(self.buffer, "w", zipfile.ZIP_DEFLATED)
        kinds = "application/vnd.openxmlformats-officedocument.spreadsheetml"
        rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        pkg = "http://schemas.openxmlformats.org/package/2006"
        self.zip.writestr("[Content_Types].xml", (
            f'<Types xmlns="{pkg}/content-types"><Default Extension="rels" '
            'ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
            f'<Override PartName="/xl/workbook.xml" ContentType="{kinds}.sheet.main+xml"/>' + "".join(
                f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{kinds}.worksheet+xml"/>' for i in numbers)
            + "</Types>"))
        self.zip.writestr("_rels/.rels", (
            f'<Relationships xmlns="{pkg}/relationships"><Relationship Id="rId1" '
            f'Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>'))
        self.zip.writestr("xl/workbook.xml", (
            f'<workbook xmlns="{MAIN[1:-1]}" xmlns:r="{rel}"><sheets>' + "".join(
                f'<sheet name={quoteattr(n)} sheetId="{i}" r:id="rId{i}"/>' for i, n in zip(numbers, names))
            + "</sheets></workbook>"))
        self.zip.writestr("xl/_rels/workbook.xml.rels", (
            f'<Relationships xmlns="{pkg}/relationships">' + "".join(
                f'<Relationship Id="rId{i}" Type="{rel}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in numbers)
            + "</Relationships>"))
        start = f'<worksheet xmlns="{MAIN[1:-1]}"><sheetData>'
        for i, rows in zip(numbers, cover.values()):
            self.zip.writestr(f"xl/worksheets/sheet{i}.xml", start + "".join(map(_row, rows)) + "</sheetData></worksheet>")
        self.part = self.zip.open(f"xl/worksheets/sheet{len(names)}.xml", "w")
        self.part.write((start + _row(header)).encode())

    def add(self, values) -> None:
        self.part.write(_row(values).encode())
        self.rows += 1

    def close(self) -> bytes:
        self.part.write(b"</sheetData></worksheet>")
        self.part.close()
        self.zip.close()
        return self.buffer.getvalue()


def _store(path: str, name: str, content: bytes, attempt: int) -> None:
    """Write beside the target and move into place, so a repeated task leaves one file."""
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (
        fs.LocalFileSystem(), path)
    store.create_dir(root, recursive=True)
    part = f"{root}/.{name}.{attempt}"
    with store.open_output_stream(part) as out:
        out.write(content)
    store.move(part, f"{root}/{name}")


def export_workbooks(df: DataFrame, path: str, sheet: str, by: str, cover: dict[str, list[tuple]] | None = None,
                     max_rows: int = MAX_ROWS) -> DataFrame:
    """Workbooks ``<by>-<task>-<n>.xlsx`` holding the rows of one value of ``by`` each.

    The rebalance hint splits a value with many rows over several tasks, and a
    full sheet is followed by a further workbook; rows stream, and no task keeps
    more than one workbook. ``cover`` gives small further sheets that go into
    every workbook before the data. Runs at once and returns (file, rows) per workbook.
    """
    names = df.columns
    placed = df.hint("rebalance", by).sortWithinPartitions(by)

    def write(batches):
        context = TaskContext.get()
        task, attempt = context.partitionId(), context.taskAttemptId()
        book, current, number, done = None, None, 0, []

        def finish():
            safe = re.sub(r"[^A-Za-z0-9]", "_", str(current))
            name = f"{safe}-{task:05d}-{number:03d}.xlsx"
            _store(path, name, book.close(), attempt)
            done.append((name, book.rows))

        for batch in batches:
            for values in batch[names].astype("object").itertuples(index=False, name=None):
                value = values[names.index(by)]
                if book is not None and (value != current or book.rows >= max_rows):
                    finish()
                    number, book = number + 1, None
                if book is None:
                    book, current = _Book(sheet, names, cover or {}), value
                book.add(values)
        if book is not None:
            finish()
        yield pd.DataFrame(done, columns=["file", "rows"]).astype({"file": "object", "rows": "int64"})

    return durable(placed.mapInPandas(write, "file string, rows long"), "workbooks")
