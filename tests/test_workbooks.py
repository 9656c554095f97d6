"""Workbooks: cell kinds, gaps, dates of both systems, unlike headers, broken files."""

from datetime import datetime

import pytest

from tidemark.sources.files import read_sheet
from tidemark.sources.workbooks import Workbook, read_workbooks, sheet_rows
from tidemark.workload.books import letters, workbook_bytes

ROWS = [
    ["id", " name ", "when", "ok", None, "x"],
    [1, " a<&>b ", datetime(2024, 2, 29), True, "loose", 1.5],
    [2, None, datetime(2024, 2, 29, 13, 5, 7), False, None, None],
    [None] * 6,
    [3, "", None, None, None, 10**12]]


def rows_of(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


@pytest.mark.parametrize("inline", [True, False])
@pytest.mark.parametrize("epoch_1904", [True, False])
def test_cells(spark, inline, epoch_1904):
    content = workbook_bytes({"S": ROWS}, inline, epoch_1904)
    df = sheet_rows(spark.createDataFrame([("f", bytearray(content))], "path string, content binary"))
    assert df.columns == ["id", " name ", "when", "ok", "Unnamed: 4", "x"]
    assert rows_of(df) == [
        ("1", " a<&>b ", "2024-02-29 00:00:00", "true", "loose", "1.5"), ("2", None, "2024-02-29 13:05:07", "false", None, None),
        ("3", "", None, None, None, "1000000000000")]


def test_unlike_headers_meet_by_name(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(workbook_bytes({"S": [["id", "a"], [1, "x"]], "T": [["only"], [9]]}))
    (tmp_path / "b.xlsx").write_bytes(workbook_bytes({"S": [["b", "id"], ["y", 2], *[[None, i] for i in range(3, 6000)]]}))
    df = read_workbooks(spark, f"{tmp_path}/*.xlsx")
    assert df.columns == ["id", "a", "b"] and df.count() == 5999
    assert rows_of(df.where("id in ('1', '2', '3')")) == [("1", "x", None), ("2", None, "y"), ("3", None, None)]
    assert rows_of(read_workbooks(spark, f"{tmp_path}/a.xlsx", "T")) == [("9",)]


def test_sheets_are_cleaned_like_others(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(workbook_bytes({"S": ROWS}))
    df = read_sheet(spark, f"{tmp_path}/a.xlsx")
    assert "name" in df.columns and {r.name for r in df.collect()} >= {"a<&>b"}
    with pytest.raises(ValueError, match="old binary"):
        read_sheet(spark, f"{tmp_path}/a.xls")


def test_what_cannot_be_read_fails_by_name(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(b"no zip file")
    with pytest.raises(Exception, match="a.xlsx is no workbook"):
        read_workbooks(spark, f"{tmp_path}/a.xlsx")
    (tmp_path / "b.xlsx").write_bytes(workbook_bytes({"S": [["a"], [1]]}))
    with pytest.raises(Exception, match="b.xlsx has no sheet 'T'"):
        read_workbooks(spark, f"{tmp_path}/b.xlsx", "T")
    (tmp_path / "c.xlsx").write_bytes(workbook_bytes({"S": [["a", "b", "a"], [1, 2, 3]]}))
    with pytest.raises(ValueError, match="several columns"):
        read_workbooks(spark, f"{tmp_path}/c.xlsx")


def test_columns_beyond_z():
    assert [letters(i) for i in (0, 25, 26, 701, 702)] == ["A", "Z", "AA", "ZZ", "AAA"]
    wide = [[f"c{i}" for i in range(800)], [None] * 799 + ["last"]]
    book = Workbook(workbook_bytes({"S": wide}))
    assert list(book.rows("S")) == [wide[0], wide[1]]


def test_formats_that_are_no_dates():
    moment = datetime(2024, 1, 1, 5)
    for code, want in (("0.00", "45292.208333333336"), ('"days" 0', "45292.208333333336"), ("[Red]0", "45292.208333333336"),
                       ("[h]:mm", "2024-01-01 05:00:00"), ("d/m/yy", "2024-01-01 05:00:00")):
        book = Workbook(workbook_bytes({"S": [[moment]]}, formats=(14, code)))
        assert list(book.rows("S")) == [[want]], code
