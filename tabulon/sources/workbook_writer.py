"""Writing plain workbooks: one sheet of texts, numbers and dates."""

from __future__ import annotations

import math
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from datetime import date
from itertools import chain
from typing import BinaryIO
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_BOOK = 50_000

#: Fixed values of the file format: the parts that every workbook has.
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_DOCUMENT = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_SHEET_TYPE = "application/vnd.openxmlformats-officedocument.spreadsheetml"
_DATE_STYLE = 1


def _parts(sheet: str) -> dict[str, str]:
    return {
        "[Content_Types].xml": f'{_HEAD}<Types xmlns="{_PACKAGE}/content-types">'
        '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        f'<Override PartName="/xl/workbook.xml" ContentType="{_SHEET_TYPE}.sheet.main+xml"/>'
        f'<Override PartName="/xl/styles.xml" ContentType="{_SHEET_TYPE}.styles+xml"/>'
        f'<Override PartName="/xl/worksheets/sheet1.xml" ContentType="{_SHEET_TYPE}.worksheet+xml"/></Types>',
        "_rels/.rels": f'{_HEAD}<Relationships xmlns="{_PACKAGE}/relationships">'
        f'<Relationship Id="r1" Type="{_DOCUMENT}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'{_HEAD}<workbook xmlns="{_MAIN}" xmlns:r="{_DOCUMENT}"><sheets>'
        f'<sheet name={quoteattr(sheet)} sheetId="1" r:id="r1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'{_HEAD}<Relationships xmlns="{_PACKAGE}/relationships">'
        f'<Relationship Id="r1" Type="{_DOCUMENT}/worksheet" Target="worksheets/sheet1.xml"/>'
        f'<Relationship Id="r2" Type="{_DOCUMENT}/styles" Target="styles.xml"/></Relationships>',
        "xl/styles.xml": f'{_HEAD}<styleSheet xmlns="{_MAIN}"><fonts count="1"><font/></fonts><fills count="1"><fill/></fills>'
        '<borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs>'
        '<cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="14" applyNumberFormat="1"/></cellXfs></styleSheet>',
    }


def _cell(value: object) -> str:
    if value is None:
        return "<c/>"
    if isinstance(value, date):
        return f'<c s="{_DATE_STYLE}"><v>{(value - date(1899, 12, 30)).days}</v></c>'
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return f"<c><v>{value!r}</v></c>"
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'


def write_sheet(target: BinaryIO, rows: Iterable[Sequence[object]], sheet: str = "Sheet1") -> None:
    """Write rows of texts, numbers, dates (from March 1900 on) and nulls as they come."""
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as book:
        for name, text in _parts(sheet).items():
            book.writestr(name, text)
        with book.open("xl/worksheets/sheet1.xml", "w") as part:
            part.write(f'{_HEAD}<worksheet xmlns="{_MAIN}"><sheetData>'.encode())
            for row in rows:
                part.write(f"<row>{''.join(map(_cell, row))}</row>".encode())
            part.write(b"</sheetData></worksheet>")


def write_workbooks(
    df: DataFrame, folder: str, order: str, columns: Sequence[str | tuple[str, ...]], above: Sequence[Sequence[object]] = (),
    below: Sequence[Sequence[object]] = (), sheet: str = "Sheet1", rows_per_book: int = ROWS_PER_BOOK,
) -> int:
    """Write the columns (of a tuple the first non-null one) as workbooks of about ``rows_per_book`` rows, in the order of ``order`` (non-null numbers or text).

    Books are cut by range, so their names (the zero-padded first value) sort as their rows do. ``above`` and
    ``below`` are put around every book's rows. A task streams its rows into one file under a name of its own, which
    a repeated task writes again alike. ``folder`` is one that pyarrow reaches from every executor. Returns the
    number of books.
    """
    books = max(1, math.ceil(df.count() / rows_per_book))
    cells = [(c,) if isinstance(c, str) else c for c in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return

        def rows() -> Iterator[Sequence[object]]:
            yield from above
            for batch in chain([first], batches):
                yield from zip(*[_first_known(batch, names) for names in cells])
            yield from below

        store, path = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
        store.create_dir(path, recursive=True)
        name = f"{str(first['_order'][0].as_py()):0>20}.xlsx"
        with store.open_output_stream(f"{path}/{name}") as out:
            write_sheet(_Counted(out), rows(), sheet)
        yield pa.RecordBatch.from_arrays([pa.array([name])], names=["book"])

    cut = df.withColumn("_order", F.col(order)).repartitionByRange(books, "_order").sortWithinPartitions("_order")
    return cut.select("_order", *dict.fromkeys(c for names in cells for c in names)).mapInArrow(run, "book string").count()


def _first_known(batch: pa.RecordBatch, names: Sequence[str]) -> list[object]:
    values = batch[names[0]].to_pylist()
    for name in names[1:]:
        values = [b if a is None else a for a, b in zip(values, batch[name].to_pylist())]
    return values


class _Counted:
    """A stream that only moves forward, as stores take it; zip then writes sizes behind its entries."""

    def __init__(self, out):
        self.out = out

    def write(self, data: bytes) -> int:
        self.out.write(data)
        return len(data)

    def flush(self) -> None:
        self.out.flush()
