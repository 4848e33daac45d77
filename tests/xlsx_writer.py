"""Minimal .xlsx writer for test fixtures (shared strings, numbers, booleans, date cells)."""

from __future__ import annotations

import datetime as dt
import zipfile
from xml.sax.saxutils import escape

_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def _col(i: int) -> str:
    s = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


def write_xlsx(path: str, sheets: dict[str, list[list]]) -> None:
    shared: list[str] = []
    index: dict[str, int] = {}

    def sst(v: str) -> int:
        if v not in index:
            index[v] = len(shared)
            shared.append(v)
        return index[v]

    sheet_xml = []
    for rows in sheets.values():
        out = []
        for r, row in enumerate(rows, start=1):
            cells = []
            for c, v in enumerate(row):
                ref = f"{_col(c)}{r}"
                if v is None:
                    continue
                if isinstance(v, bool):
                    cells.append(f'<c r="{ref}" t="b"><v>{int(v)}</v></c>')
                elif isinstance(v, dt.date):
                    serial = (v - dt.date(1899, 12, 30)).days
                    cells.append(f'<c r="{ref}" s="1"><v>{serial}</v></c>')
                elif isinstance(v, (int, float)):
                    cells.append(f'<c r="{ref}"><v>{v}</v></c>')
                else:
                    cells.append(f'<c r="{ref}" t="s"><v>{sst(str(v))}</v></c>')
            out.append(f'<row r="{r}">{"".join(cells)}</row>')
        sheet_xml.append(f'<worksheet xmlns="{_MAIN}"><sheetData>{"".join(out)}</sheetData></worksheet>')

    names = list(sheets)
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("[Content_Types].xml", '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"/>')
        z.writestr("xl/workbook.xml",
                   f'<workbook xmlns="{_MAIN}" xmlns:r="{_REL}"><sheets>'
                   + "".join(f'<sheet name="{escape(n)}" sheetId="{i + 1}" r:id="rId{i + 1}"/>' for i, n in enumerate(names))
                   + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels",
                   '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   + "".join(f'<Relationship Id="rId{i + 1}" Target="worksheets/sheet{i + 1}.xml" Type="x"/>'
                             for i in range(len(names)))
                   + "</Relationships>")
        z.writestr("xl/styles.xml",
                   f'<styleSheet xmlns="{_MAIN}"><cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        z.writestr("xl/sharedStrings.xml",
                   f'<sst xmlns="{_MAIN}">' + "".join(f"<si><t>{escape(s)}</t></si>" for s in shared) + "</sst>")
        for i, xml in enumerate(sheet_xml):
            z.writestr(f"xl/worksheets/sheet{i + 1}.xml", xml)
