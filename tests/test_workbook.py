"""Workbooks: how cells read, sheets with titles and footers, folders, and both ways to reach the files."""

import datetime
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from tabulon.plans.reading_log import SHEET_COLUMNS, publish_official
from tabulon.sources.workbook import published_rows, read_published_workbook, read_workbook, sheet_rows, workbook_rows
from tabulon.sources.workbook_writer import write_sheet, write_workbooks

HEADER = [f" {n} " for n in SHEET_COLUMNS]


def book(path, rows, sheet="PUBLICATION"):
    with open(path, "wb") as out:
        write_sheet(out, rows, sheet)
    return str(path)


def packed(parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)
    out.seek(0)
    return out


MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
LINKS = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def by_hand(rows, settings=""):
    """A workbook as a spreadsheet program writes it: shared texts, styles, left-out cells, two sheets."""
    return {
        "xl/workbook.xml": f'<workbook {MAIN} {LINKS}>{settings}<sheets><sheet name="Notes" sheetId="1" r:id="a"/>'
                           '<sheet name="Data &amp; more" sheetId="2" r:id="b"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                                      '<Relationship Id="a" Target="worksheets/sheet1.xml"/>'
                                      '<Relationship Id="b" Target="/xl/worksheets/other.xml"/></Relationships>',
        "xl/sharedStrings.xml": f"<sst {MAIN}><si><t>plain</t></si><si><r><t>ri</t></r><r><t>ch</t></r><rPh><t>no</t></rPh></si></sst>",
        "xl/styles.xml": f'<styleSheet {MAIN}><numFmts><numFmt numFmtId="170" formatCode="dd\\-mmm\\-yy"/>'
                         '<numFmt numFmtId="171" formatCode="&quot;day&quot;0.00"/></numFmts>'
                         '<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/><xf numFmtId="171"/></cellXfs></styleSheet>',
        "xl/worksheets/sheet1.xml": f"<worksheet {MAIN}><sheetData/></worksheet>",
        "xl/worksheets/other.xml": f"<worksheet {MAIN}><sheetData>{rows}</sheetData></worksheet>",
    }


def test_cells_of_every_kind():
    rows = ('<row r="2"><c r="B2" t="s"><v>0</v></c><c r="D2" t="s"><v>1</v></c><c r="AA2"><v>7.25</v></c></row>'
            '<row r="5"><c t="b"><v>1</v></c><c t="e"><v>#N/A</v></c><c t="str"><v>sum</v></c><c s="1"><v>44201</v></c>'
            '<c s="2"><v>44201.5</v></c><c s="3"><v>44201</v></c><c s="1"><v>59</v></c><c t="inlineStr"><is><t>in</t></is></c><c/></row><row/>')
    got = list(sheet_rows(packed(by_hand(rows)), "Data & more"))
    assert got[0] == (2, [None, "plain", None, "rich", *[None] * 22, "7.25"])
    assert got[1] == (5, ["TRUE", None, "sum", "2021-01-05", "2021-01-05 12:00:00", "44201", "1900-02-28", "in", None])
    assert got[2] == (6, [])
    late = by_hand('<row><c s="1"><v>0</v></c></row>', '<workbookPr date1904="1"/>')
    assert list(sheet_rows(packed(late), "Data & more")) == [(1, ["1904-01-01"])]
    assert list(sheet_rows(packed(by_hand(rows)))) == []
    with pytest.raises(KeyError, match="no sheet 'x'"):
        list(sheet_rows(packed(by_hand(rows)), "x"))


def sheet_lines(days, start=0):
    return [["Title"], [], [], [], [], [], [*HEADER, "Other"], ["Unidades:", "GTQ"],
            *[[d, 7.0 + start + n, "30", 29.5, "n/d", "x"] for n, d in enumerate(days)], ["Fuente: 7"], []]


def test_published_workbooks(spark, tmp_path):
    day = datetime.date(2021, 1, 5)
    book(tmp_path / "a.xlsx", sheet_lines([day, "January 6, 2021", "2020-12-31", "sometime"]))
    book(tmp_path / "b.xlsx", [["moved"], ["x", *HEADER], [None, "06/01/2021", 1, 2, 3, 4], ["y", day, 9, 8, None, 6]])
    rows = read_published_workbook(spark, str(tmp_path), SHEET_COLUMNS, "PUBLICATION")
    assert rows.count() == 9  # unit line, days, footers and the empty last row
    stored = publish_official(spark, str(tmp_path), str(tmp_path / "out"), "PUBLICATION")
    got = {str(r["date"]): (r["exchange_rate_usd_gtq"], r["official_super_gtq"], r["official_regular_gtq"], r["official_diesel_gtq"])
           for r in stored.collect()}
    assert got == {"2021-01-05": (9.0, 8.0, None, 6.0), "2021-01-06": (8.0, 30.0, 29.5, None), "2021-06-01": (1.0, 2.0, 3.0, 4.0)}
    one = publish_official(spark, str(tmp_path / "a.xlsx"), str(tmp_path / "out2"))
    assert {str(r["date"]) for r in one.collect()} == {"2021-01-05", "2021-01-06"}
    # The same rows from bytes that Spark read.
    contents = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(str(tmp_path))
    again = published_rows(workbook_rows(contents, "PUBLICATION"), SHEET_COLUMNS).drop("file")
    assert sorted(map(str, again.collect())) == sorted(map(str, rows.drop("file").collect()))


def test_a_workbook_without_the_header_is_an_error(spark, tmp_path):
    book(tmp_path / "a.xlsx", sheet_lines([datetime.date(2021, 1, 5)]))
    book(tmp_path / "b.xlsx", [["FECHA", "Gasolina Superior"], ["2021-01-05", 3]])
    with pytest.raises(Exception, match="No header row holds all of"):
        read_published_workbook(spark, str(tmp_path), SHEET_COLUMNS).collect()
    with pytest.raises(Exception, match="No workbook at"):
        read_workbook(spark, str(tmp_path / "absent")).collect()
    (tmp_path / "empty").mkdir()
    assert read_workbook(spark, str(tmp_path / "empty")).count() == 0


def test_books_are_cut_by_range_and_keep_the_order(spark, tmp_path):
    df = spark.range(1000).select("id", F.concat(F.lit("t "), "id").alias("t"), F.lit(None).cast("date").alias("d")).repartition(7)
    n = write_workbooks(df, f"file://{tmp_path}/books", "id", [("d", "t"), "id"], [["head"]], [["foot", 1.5]], "S", rows_per_book=150)
    rows = read_workbook(spark, f"file://{tmp_path}/books", "S").orderBy("file", "sheet_row").collect()
    assert n == len({r["file"] for r in rows}) > 3
    assert [r["cells"] for r in rows if r["cells"][0].startswith("t ")] == [[f"t {i}", str(i)] for i in range(1000)]
    assert [r["cells"] for r in rows if r["cells"][0] == "foot"] == [["foot", "1.5"]] * n
    assert write_workbooks(df.limit(0), str(tmp_path / "none"), "id", ["t"]) == 0
