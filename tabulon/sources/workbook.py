"""Spreadsheet workbooks (.xlsx) as a Spark source.

A workbook is a zip of XML parts. A sheet is read row by row as it unpacks, so a task
holds a row at a time besides the workbook's table of shared texts. A zip can't be
split: each file is one partition, and folders of files are read side by side.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterator, Mapping
from datetime import datetime, timedelta
from typing import BinaryIO
from xml.etree import ElementTree

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

ROW_SCHEMA = "file string, sheet_row int, cells array<string>"

#: Fixed values of the file format: namespaces, number formats that are dates, first days of the two calendars.
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_DATE_FORMATS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}
_EPOCH_1900, _EPOCH_1904 = datetime(1899, 12, 30), datetime(1904, 1, 1)
_QUOTED = re.compile(r'"[^"]*"|\\.|\[[^\]]*\]')


def _text(element: ElementTree.Element) -> str:
    """The text runs of a shared or inline string; phonetic hints are no part of it."""
    return "".join(t.text or "" for run in element if run.tag != f"{_MAIN}rPh" for t in run.iter(f"{_MAIN}t"))


def _finished(stream: BinaryIO, tag: str) -> Iterator[ElementTree.Element]:
    """Each element of a tag as it ends; what was read before it is let go."""
    context = ElementTree.iterparse(stream, events=("start", "end"))
    _, root = next(context)
    for event, element in context:
        if event == "end" and element.tag == _MAIN + tag:
            yield element
            element.clear()
            root.clear()


def _shared_texts(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    with book.open("xl/sharedStrings.xml") as part:
        return [_text(e) for e in _finished(part, "si")]


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Numbers of the cell styles that show a date."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    dates = set(_DATE_FORMATS)
    for f in root.iter(f"{_MAIN}numFmt"):
        if re.search("[dy]", _QUOTED.sub("", f.get("formatCode", "")).lower()):
            dates.add(int(f.get("numFmtId", "-1")))
    styles = root.find(f"{_MAIN}cellXfs")
    return {n for n, x in enumerate(styles if styles is not None else ()) if int(x.get("numFmtId", "0")) in dates}


def _sheet_part(book: zipfile.ZipFile, sheet: str | None) -> tuple[str, datetime]:
    """The part that holds the named sheet (None: the first one), and the first day of the book's calendar."""
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    settings = root.find(f"{_MAIN}workbookPr")
    late = settings is not None and settings.get("date1904", "0") in ("1", "true")
    named = {s.get("name"): s.get(_RELATION) for s in root.iter(f"{_MAIN}sheet")}
    if not named or (sheet is not None and sheet not in named):
        raise KeyError(f"The workbook has no sheet {sheet!r}, only {list(named)}")
    relation = named[sheet] if sheet is not None else next(iter(named.values()))
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = next(r.get("Target", "") for r in links if r.get("Id") == relation)
    return (target.lstrip("/") if target.startswith("/") else posixpath.join("xl", target)), _EPOCH_1904 if late else _EPOCH_1900


def _column(reference: str) -> int:
    number = 0
    for letter in reference:
        if not letter.isalpha():
            break
        number = number * 26 + ord(letter.upper()) - 64
    return number - 1


def _day(serial: str, epoch: datetime) -> str:
    """A day number as ISO text; before March 1900 the format counts a day that never was."""
    value = float(serial)
    shift = 1 if epoch == _EPOCH_1900 and value < 60 else 0
    moment = epoch + timedelta(days=shift + int(value), seconds=round(value % 1 * 86_400))
    return moment.strftime("%Y-%m-%d" if moment.time() == datetime.min.time() else "%Y-%m-%d %H:%M:%S")


def sheet_rows(stream: BinaryIO, sheet: str | None = None) -> Iterator[tuple[int, list[str | None]]]:
    """(row number from 1, cells from column A) of one sheet, as text.

    Dates are ISO text, numbers as stored, truth values TRUE and FALSE; empty cells and errors are null. Rows that
    the file leaves out are left out here too.
    """
    with zipfile.ZipFile(stream) as book:
        part, epoch = _sheet_part(book, sheet)
        shared, dates = _shared_texts(book), _date_styles(book)
        with book.open(part) as rows:
            number = 0
            for row in _finished(rows, "row"):
                number = int(row.get("r", number + 1))
                cells: list[str | None] = []
                for cell in row.iter(f"{_MAIN}c"):
                    at = _column(cell.get("r", "")) if cell.get("r") else len(cells)
                    cells += [None] * (at + 1 - len(cells))
                    cells[at] = _value(cell, shared, dates, epoch)
                yield number, cells


def _value(cell: ElementTree.Element, shared: list[str], dates: set[int], epoch: datetime) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        inline = cell.find(f"{_MAIN}is")
        return _text(inline) if inline is not None else None
    value = cell.findtext(f"{_MAIN}v")
    if value is None or kind == "e":
        return None
    if kind == "s":
        return shared[int(value)]
    if kind == "b":
        return "TRUE" if value == "1" else "FALSE"
    return _day(value, epoch) if kind == "n" and int(cell.get("s", "0")) in dates else value


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class WorkbookReader(DataSourceReader):
    def __init__(self, path: str, sheet: str | None):
        self.path, self.sheet = path, sheet

    def partitions(self) -> list[InputPartition]:
        store, path = fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (fs.LocalFileSystem(), self.path)
        info = store.get_file_info(path)
        if info.type == fs.FileType.Directory:
            found = store.get_file_info(fs.FileSelector(path, recursive=True))
            names = [f.path for f in found if f.is_file and f.base_name.endswith(".xlsx") and not f.base_name.startswith(("~", "."))]
        elif info.type == fs.FileType.File:
            names = [path]
        else:
            raise FileNotFoundError(f"No workbook at {self.path}")
        return [_File(n) for n in sorted(names)] or [_File("")]

    def read(self, partition: _File) -> Iterator[tuple]:
        if not partition.path:
            return
        store = fs.FileSystem.from_uri(self.path)[0] if "://" in self.path or self.path.startswith("file:") else fs.LocalFileSystem()
        with store.open_input_file(partition.path) as stream:
            for number, cells in sheet_rows(stream, self.sheet):
                yield partition.path, number, cells


class WorkbookSource(DataSource):
    """``spark.read.format("workbook").option("sheet", name).load(path)``: a row of text cells for each sheet row.

    ``path`` is a workbook or a folder of them, in any store that pyarrow reaches; see :func:`workbook_rows` for
    others. Without ``sheet`` the first sheet counts.
    """

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> str:
        return ROW_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WorkbookReader(self.options["path"], self.options.get("sheet"))


def read_workbook(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """(``file``, ``sheet_row``, ``cells``) of one sheet of every workbook at a path."""
    spark.dataSource.register(WorkbookSource)
    reader = spark.read.format("workbook")
    return (reader.option("sheet", sheet) if sheet else reader).load(path)


def workbook_rows(contents: DataFrame, sheet: str | None = None) -> DataFrame:
    """The same rows from workbooks' bytes: (``path``, ``content``), as Spark's binaryFile source gives them.

    For stores that only Spark's own readers reach; a file's packed bytes are then held by its task.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch["path"].to_pylist(), batch["content"]):
                rows: list[tuple] = []
                for number, cells in sheet_rows(io.BytesIO(content.as_py()), sheet):
                    rows.append((path, number, cells))
                    if len(rows) == 5_000:
                        yield as_batch(rows)
                        rows = []
                if rows:
                    yield as_batch(rows)

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        file, number, cells = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(file, pa.string()), pa.array(number, pa.int32()), pa.array(cells, pa.list_(pa.string()))],
            names=["file", "sheet_row", "cells"])

    return contents.select("path", "content").mapInArrow(run, ROW_SCHEMA)


def published_rows(rows: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """The named columns of published sheets whose header is somewhere below their title lines.

    A file's header is its first row whose trimmed cells hold every name in ``columns``; it says where each column
    is, file by file. Rows below it are kept, unit lines and footers too, with ``file`` and ``sheet_row``, the order
    of publication. A file without a header is an error, not an empty table.
    """
    trimmed = F.transform("cells", lambda c: F.trim(c))
    wanted = F.array(*[F.lit(name) for name in columns])
    marked = rows.withColumn("_names", F.when(F.size(F.array_except(wanted, trimmed)) == 0, trimmed))
    first = F.min(F.when(F.col("_names").isNotNull(), F.struct("sheet_row", "_names")))
    heads = marked.groupBy("file").agg(first.alias("_head")).select(F.col("file").alias("_file"), "_head")
    told = F.concat(F.lit(f"No header row holds all of {list(columns)}: "), F.col("file"))
    head = F.when(F.col("_head").isNull(), F.raise_error(told).cast(heads.schema["_head"].dataType)).otherwise(F.col("_head"))
    placed = rows.join(heads, F.col("file") == F.col("_file")).withColumn("_head", head).filter(F.col("sheet_row") > F.col("_head.sheet_row"))

    def cell(name: str):
        return F.get("cells", (F.array_position("_head._names", F.lit(name)) - 1).cast("int"))

    return placed.select("file", "sheet_row", *[cell(old).alias(new) for old, new in columns.items()])


def read_published_workbook(spark: SparkSession, path: str, columns: Mapping[str, str], sheet: str | None = None) -> DataFrame:
    """Published sheets of one workbook or a folder of them; see :func:`published_rows`."""
    return published_rows(read_workbook(spark, path, sheet), columns)
