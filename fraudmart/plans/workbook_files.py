"""Workbook files for checks and tests (the engine itself only reads them)."""

from __future__ import annotations

import zipfile
from xml.sax.saxutils import escape

from fraudmart.sources.workbook import NS as _NS


def write_workbook(path: str, sheets: dict[str, list[list]]) -> None:
    """Minimal .xlsx writer (inline strings, numbers) for test fixtures."""
    def cell_ref(i, j):
        letters, n = "", j + 1
        while n:
            n, r = divmod(n - 1, 26)
            letters = chr(65 + r) + letters
        return f"{letters}{i + 1}"

    def sheet_xml(rows):
        out = []
        for i, row in enumerate(rows):
            cells = []
            for j, v in enumerate(row):
                if v is None:
                    continue
                if isinstance(v, (int, float)) and not isinstance(v, bool):
                    cells.append(f'<c r="{cell_ref(i, j)}"><v>{v}</v></c>')
                else:
                    cells.append(f'<c r="{cell_ref(i, j)}" t="inlineStr"><is><t>{escape(str(v))}</t></is></c>')
            out.append(f'<row r="{i + 1}">{"".join(cells)}</row>')
        return (f'<worksheet xmlns="{_NS["m"]}"><sheetData>{"".join(out)}</sheetData></worksheet>')

    names = list(sheets)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml",
                   '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
                   '<Default Extension="xml" ContentType="application/xml"/>'
                   '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
                   '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
                   + "".join(f'<Override PartName="/xl/worksheets/sheet{i + 1}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
                             for i in range(len(names))) + "</Types>")
        z.writestr("_rels/.rels",
                   f'<Relationships xmlns="{_NS["rel"]}"><Relationship Id="rId1" '
                   'Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" '
                   'Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml",
                   f'<workbook xmlns="{_NS["m"]}" xmlns:r="{_NS["r"]}"><sheets>'
                   + "".join(f'<sheet name="{escape(n)}" sheetId="{i + 1}" r:id="rId{i + 1}"/>'
                             for i, n in enumerate(names)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels",
                   f'<Relationships xmlns="{_NS["rel"]}">'
                   + "".join(f'<Relationship Id="rId{i + 1}" '
                             'Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" '
                             f'Target="worksheets/sheet{i + 1}.xml"/>' for i in range(len(names)))
                   + "</Relationships>")
        for i, n in enumerate(names):
            z.writestr(f"xl/worksheets/sheet{i + 1}.xml", sheet_xml(sheets[n]))
