"""Workbook (.xlsx) files as a Spark data source (``spark.read.format("workbook")``).

One partition a sheet. A sheet's XML is read as a stream out of the archive, and its
rows go on in Arrow batches of bounded size, so a task's memory does not depend on the
length of the sheet (but for the workbook's table of shared texts, which a cell can
refer to at any place). The driver's worker reads the list of sheets of each file only.
Cells come as text; conversion and filtering are DataFrame functions.
"""

from __future__ import annotations

import json
import posixpath
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from fraudmart.session import ship_package

NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
      "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
      "rel": "http://schemas.openxmlformats.org/package/2006/relationships"}
BATCH_ROWS = 4096
_REF = re.compile(r"([A-Z]+)(\d+)")
_MAIN = f"{{{NS['m']}}}"


def _col_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _texts(item) -> str:
    return "".join(t.text or "" for t in item.iter(_MAIN + "t"))


def _cell_text(cell, shared):
    kind = cell.get("t")
    if kind == "inlineStr":
        return _texts(cell)
    v = cell.find("m:v", NS)
    if v is None or v.text is None:
        return None
    if kind == "s":
        return shared[int(v.text)]
    if kind == "b":
        return "TRUE" if v.text == "1" else "FALSE"
    return v.text


def _elements(stream, tag: str):
    """Elements of a name as they end; each goes from the tree when the next one is asked for."""
    above = []
    for event, e in ET.iterparse(stream, events=("start", "end")):
        if event == "start":
            above.append(e)
            continue
        above.pop()
        if e.tag == tag:
            yield e
            above[-1].clear()


def sheets_of(z: zipfile.ZipFile) -> list[tuple[str, str]]:
    """(name, part of the archive) of the sheets, in order."""
    names, rels = set(z.namelist()), {}
    if "xl/_rels/workbook.xml.rels" in names:
        for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels")).findall("rel:Relationship", NS):
            rels[r.get("Id")] = r.get("Target")
    out = []
    for i, sheet in enumerate(ET.fromstring(z.read("xl/workbook.xml")).findall("m:sheets/m:sheet", NS)):
        target = rels.get(sheet.get(f"{{{NS['r']}}}id"), f"worksheets/sheet{i + 1}.xml")
        out.append((sheet.get("name"), target.lstrip("/") if target.startswith("/") else posixpath.normpath("xl/" + target)))
    return out


def sheet_rows(z: zipfile.ZipFile, part: str) -> Iterator[list[str | None]]:
    """Cell texts of the rows of a sheet, one row at a time."""
    shared = []
    if "xl/sharedStrings.xml" in z.namelist():
        with z.open("xl/sharedStrings.xml") as f:
            shared = [_texts(e) for e in _elements(f, _MAIN + "si")]
    with z.open(part) as f:
        for row in _elements(f, _MAIN + "row"):
            cells = {}
            for c in row.findall("m:c", NS):
                m = _REF.match(c.get("r", ""))
                cells[_col_index(m.group(1)) if m else len(cells)] = _cell_text(c, shared)
            yield [cells.get(i) for i in range(max(cells) + 1 if cells else 0)]


class Sheet(InputPartition):
    def __init__(self, path: str, name: str, part: str):
        super().__init__(None)
        self.path, self.name, self.part = path, name, part


def _open(path: str):
    fs, at = pafs.FileSystem.from_uri(re.sub(r"^file:/+", "/", path))
    return fs.open_input_file(at)


class WorkbookReader(DataSourceReader):
    def __init__(self, paths: list[str], columns: list[str], sheets: str):
        self.paths, self.columns, self.sheets = paths, columns, sheets

    def partitions(self) -> list[InputPartition]:
        found = []
        for path in self.paths:
            with _open(path) as f, zipfile.ZipFile(f) as z:
                own = sheets_of(z)
            found += [Sheet(path, name, part) for name, part in (own[-1:] if self.sheets == "last" else own)]
        return found

    def read(self, sheet: Sheet) -> Iterator[pa.RecordBatch]:
        if sheet is None:  # no sheets at all
            return
        file_name = posixpath.basename(sheet.path)
        schema = pa.schema([(c, pa.string()) for c in ("file_name", "sheet", *self.columns)])
        with _open(sheet.path) as f, zipfile.ZipFile(f) as z:
            rows, out = sheet_rows(z, sheet.part), []
            place = {("" if h is None else str(h)).strip(): i for i, h in enumerate(next(rows, []))}
            at = [place.get(c, -1) for c in self.columns]
            for r in rows:
                if any(v is not None for v in r):
                    out.append([file_name, sheet.name, *[r[i] if 0 <= i < len(r) else None for i in at]])
                if len(out) == BATCH_ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*out)], schema=schema)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*out)], schema=schema)


class WorkbookSource(DataSource):
    """Options: ``paths`` and ``columns`` (JSON lists), ``sheets`` (last / all)."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> str:
        return ", ".join(["file_name string", "sheet string"] + [f"`{c}` string" for c in json.loads(self.options["columns"])])

    def reader(self, schema) -> DataSourceReader:
        return WorkbookReader(json.loads(self.options["paths"]), json.loads(self.options["columns"]), self.options["sheets"])


def read_workbook(spark: SparkSession, path, columns: list[str], sheets: str = "last") -> DataFrame:
    """Rows of every workbook under ``path``; the first row of a sheet is its header.

    Output: ``file_name``, ``sheet``, then ``columns`` as strings (a header that
    is missing gives NULLs). ``sheets="last"`` keeps only the last sheet of each
    file — loading every sheet into one replaced table leaves exactly that;
    ``"all"`` keeps all sheets. Files may be where Arrow's filesystems reach
    (mounted folders, HDFS, S3, GCS).
    """
    ship_package(spark)  # the tasks import this module
    spark.dataSource.register(WorkbookSource)
    listed = spark.read.format("binaryFile").load(path).select("path").collect()  # one small row a file
    return (spark.read.format("workbook").option("paths", json.dumps(sorted(r["path"] for r in listed)))
            .option("columns", json.dumps(columns)).option("sheets", sheets).load())


def excel_date(c) -> Column:
    """A workbook date cell: a day number (days since 1899-12-30), ISO text or
    ``DD.MM.YYYY``; anything else is NULL."""
    col = F.col(c) if isinstance(c, str) else c
    as_num = col.try_cast("double")
    return F.when(as_num.isNotNull(),
                  F.date_add(F.lit("1899-12-30").cast("date"), F.floor(as_num).cast("int"))
                  ).otherwise(F.coalesce(
                      col.try_cast("date"), F.try_to_timestamp(col, F.lit("dd.MM.yyyy")).cast("date")))
