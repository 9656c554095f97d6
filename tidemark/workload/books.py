"""Workbooks to read: the smallest container that holds a sheet."""

from __future__ import annotations

import io
import sys
import zipfile
from datetime import datetime
from xml.sax.saxutils import escape

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUOTE = {'"': "&quot;"}
HEAD = '<?xml version="1.0" encoding="UTF-8"?>\n'
# The format's namespaces.
MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"


def letters(i: int) -> str:
    out = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        out = chr(65 + r) + out
    return out


def workbook_bytes(sheets: dict[str, list[list]], inline: bool = False, epoch_1904: bool = False, formats=(14, "yyyy\\-mm\\-dd hh:mm")) -> bytes:
    """A workbook of rows of text, numbers, truth values, moments and None, which leaves its cell out."""
    shared, parts = {}, {}
    start = datetime(1904, 1, 1) if epoch_1904 else datetime(1899, 12, 30)

    def cell(r, i, v):
        at = f'r="{letters(i)}{r}"'
        if isinstance(v, bool):
            return f'<c {at} t="b"><v>{int(v)}</v></c>'
        if isinstance(v, datetime):
            return f'<c {at} s="{1 + (v.hour > 0)}"><v>{(v - start).total_seconds() / 86400!r}</v></c>'
        if isinstance(v, str) and inline:
            return f'<c {at} t="inlineStr"><is><t>{escape(v)}</t></is></c>'
        if isinstance(v, str):
            return f'<c {at} t="s"><v>{shared.setdefault(v, len(shared))}</v></c>'
        return f"<c {at}><v>{v!r}</v></c>"

    for k, rows in enumerate(sheets.values(), 1):
        body = "".join(f'<row r="{r}">' + "".join(cell(r, i, v) for i, v in enumerate(row) if v is not None) + "</row>" for r, row in enumerate(rows, 1))
        parts[f"xl/worksheets/sheet{k}.xml"] = f'<worksheet xmlns="{MAIN}"><sheetData>{body}</sheetData></worksheet>'
    named = "".join(f'<sheet name="{escape(n, QUOTE)}" sheetId="{k}" r:id="rId{k}"/>' for k, n in enumerate(sheets, 1))
    dated = ' date1904="1"' if epoch_1904 else ""
    parts["xl/workbook.xml"] = f'<workbook xmlns="{MAIN}" xmlns:r="{REL}"><workbookPr{dated}/><sheets>{named}</sheets></workbook>'
    parts["xl/_rels/workbook.xml.rels"] = f'<Relationships xmlns="{PACKAGE}">' + "".join(
        f'<Relationship Id="rId{k}" Type="{REL}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(sheets) + 1)) + "</Relationships>"
    parts["xl/sharedStrings.xml"] = f'<sst xmlns="{MAIN}">' + "".join(
        f'<si><r><t xml:space="preserve">{escape(x[:1])}</t></r><r><t xml:space="preserve">{escape(x[1:])}</t></r><rPh><t>hint</t></rPh></si>' for x in shared) + "</sst>"
    parts["xl/styles.xml"] = (f'<styleSheet xmlns="{MAIN}"><numFmts><numFmt numFmtId="170" formatCode="{escape(formats[1], QUOTE)}"/></numFmts><cellXfs>'
                              f'<xf numFmtId="0"/><xf numFmtId="{formats[0]}"/><xf numFmtId="170"/></cellXfs></styleSheet>')
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for name, text in parts.items():
            book.writestr(name, HEAD + text)
    return out.getvalue()


def part_book(key, rows):
    """A workbook of the parts of one brand; every fifth size is an empty cell."""
    import datetime as dt

    import pyarrow as pa

    body = [["key", "name", "kind", "size", "listed", "large", "price"]]
    for r in sorted(rows.to_pylist(), key=lambda r: r["p_partkey"]):
        listed = dt.datetime(2024, 1, 1, r["p_size"] % 24) + dt.timedelta(days=r["p_size"])
        body.append([r["p_partkey"], r["p_name"], r["p_type"], r["p_size"] if r["p_size"] % 5 else None, listed, r["p_size"] > 25, r["p_retailprice"]])
    return pa.table({"path": [f"{key[0].as_py()}.xlsx"], "content": pa.array([workbook_bytes({"Notes": [["nothing"]], "Parts": body})], pa.binary())})
