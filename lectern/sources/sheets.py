"""Spreadsheet files: rows of a sheet as text, read and written file by file in parallel.

A workbook is a zip archive of XML parts.  Only what tables need is read: the order of sheets, shared and inline
strings, numbers and truth values; formulas count as their stored results, and dates as the numbers that they are.
"""

from __future__ import annotations

import io
import re
import uuid
import zipfile
from collections.abc import Iterator
from itertools import chain
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _column(place: str) -> int:
    """The number of a cell's column from 0: 27 for AB12."""
    n = 0
    for letter in re.match(r"[A-Z]*", place)[0]:
        n = n * 26 + ord(letter) - 64
    return n - 1


def _text(node) -> str:
    return "".join(t.text or "" for t in node.iter(f"{_MAIN}t"))


def sheet_rows(data: bytes, sheet: str | int = 0) -> Iterator[list[str | None]]:
    """The rows of one sheet, by name or place; an empty cell is None, and rows end with their last cell."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        sheets = {s.get("name"): s.get(_LINK) for s in book.iter(f"{_MAIN}sheet")}
        wanted = list(sheets.values())[sheet] if isinstance(sheet, int) else sheets[sheet]
        links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        path = links[wanted].lstrip("/")
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = [_text(s) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_MAIN}si")]
        with z.open(path if path.startswith("xl/") else f"xl/{path}") as part:
            for _, node in ElementTree.iterparse(part):
                if node.tag != f"{_MAIN}row":
                    continue
                row: list[str | None] = []
                for at, cell in enumerate(node.iter(f"{_MAIN}c")):
                    place = _column(cell.get("r")) if cell.get("r") else at
                    row += [None] * (place + 1 - len(row))
                    kind, value = cell.get("t"), cell.find(f"{_MAIN}v")
                    if kind == "inlineStr":
                        row[place] = _text(cell)
                    elif value is not None and value.text is not None:
                        row[place] = shared[int(value.text)] if kind == "s" else value.text
                yield row
                node.clear()


def sheet_file(columns: list[str], rows: Iterator[tuple], name: str = "Sheet1") -> bytes:
    """A workbook of one sheet with a header line; numbers are stored as numbers, all else as text, None as no cell."""

    def cell(v) -> str:
        if v is None:
            return "<c/>"
        if isinstance(v, int | float) and not isinstance(v, bool):
            return f"<c><v>{v!r}</v></c>"
        return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>'

    out = io.BytesIO()
    space = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    package = "http://schemas.openxmlformats.org/package/2006"
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", f'<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{kind}.worksheet+xml"/></Types>')
        z.writestr("_rels/.rels", f'<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{office}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'<workbook {space} xmlns:r="{office}"><sheets><sheet name="{escape(name)}" sheetId="1" r:id="r1"/></sheets></workbook>')
        with z.open("xl/worksheets/sheet1.xml", "w") as part:
            part.write(f"<worksheet {space}><sheetData>".encode())
            for row in chain([columns], rows):
                part.write(f"<row>{''.join(map(cell, row))}</row>".encode())
            part.write(b"</sheetData></worksheet>")
    return out.getvalue()


def read_sheets(spark: SparkSession, path: str | list[str], columns: list[str], sheet: str | int = 0, skip: int = 0) -> DataFrame:
    """The named columns of a sheet of each workbook, as text: the header is the line after `skip` lines.

    Each file is read whole by one task; a column that a file hasn't is null, and rows without a filled cell are left out.
    """

    def run(batches):
        for batch in batches:
            for body in batch.column(0):
                rows = sheet_rows(body.as_py(), sheet)
                for _ in range(skip):
                    next(rows, None)
                header = next(rows, [])
                places = [header.index(c) if c in header else -1 for c in columns]
                found = [[r[p] if 0 <= p < len(r) else None for p in places] for r in rows if any(v not in (None, "") for v in r)]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*found, strict=True)], names=columns)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, ", ".join(f"`{c}` string" for c in columns))


def write_sheets(df: DataFrame, folder: str) -> DataFrame:
    """(file, rows): a workbook in `folder` for each partition of df that has rows, whose numbers stay numbers.

    A partition's rows are held by its task, as a workbook holds a million rows at most.  A task that runs again writes
    a file of another name: read those that the result names.
    """
    names = df.columns

    def run(batches):
        rows = [r for b in batches for r in zip(*(x.to_pylist() for x in b.columns), strict=True)]
        if not rows:
            return
        where, path = fs.FileSystem.from_uri(folder)
        where.create_dir(path, recursive=True)
        file = f"part-{uuid.uuid4().hex}.xlsx"
        with where.open_output_stream(f"{path}/{file}", compression=None) as out:
            out.write(sheet_file(names, iter(rows)))
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{file}"]), pa.array([len(rows)], pa.int64())], names=["file", "rows"])

    return df.mapInArrow(run, "file string, rows bigint")
