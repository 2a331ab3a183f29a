"""Writers of small input files for the tests."""

from __future__ import annotations

import zipfile
from xml.sax.saxutils import escape

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def write_report(path, columns, rows, gap=1):
    """A fixed-width report: names, dashes, padded rows."""
    widths = [max([len(c)] + [len(str(r.get(c) or "")) for r in rows]) for c in columns]
    sep = " " * gap
    lines = [sep.join(c.ljust(w) for c, w in zip(columns, widths)), sep.join("-" * w for w in widths)]
    lines += [sep.join(str(r.get(c) or "").ljust(w) for c, w in zip(columns, widths)).rstrip() for r in rows]
    path.write_text("\n".join(lines) + "\n")


def _letter(i):
    out = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        out = chr(65 + r) + out
    return out


def write_workbook(path, sheets):
    """``sheets``: name → list of rows; a cell is text, number, bool, None,
    ("date", serial) or ("shared", text)."""
    shared, parts = [], []
    for rows in sheets.values():
        xml = []
        for r, row in enumerate(rows, start=1):
            cells = []
            for i, value in enumerate(row):
                ref = f"{_letter(i)}{r}"
                if value is None:
                    continue
                if isinstance(value, tuple) and value[0] == "date":
                    cells.append(f'<c r="{ref}" s="1"><v>{value[1]}</v></c>')
                elif isinstance(value, tuple):
                    shared.append(value[1])
                    cells.append(f'<c r="{ref}" t="s"><v>{len(shared) - 1}</v></c>')
                elif isinstance(value, bool):
                    cells.append(f'<c r="{ref}" t="b"><v>{int(value)}</v></c>')
                elif isinstance(value, (int, float)):
                    cells.append(f'<c r="{ref}"><v>{value}</v></c>')
                else:
                    cells.append(f'<c r="{ref}" t="inlineStr"><is><t>{escape(value)}</t></is></c>')
            xml.append(f'<row r="{r}">{"".join(cells)}</row>')
        parts.append(f'<worksheet xmlns="{MAIN}"><sheetData>{"".join(xml)}</sheetData></worksheet>')
    with zipfile.ZipFile(path, "w") as book:
        names = "".join(
            f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, start=1)
        )
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{REL}"><sheets>{names}</sheets></workbook>')
        rels = "".join(
            f'<Relationship Id="rId{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1)
        )
        book.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{rels}</Relationships>")
        items = "".join(f"<si><t>{escape(s)}</t></si>" for s in shared)
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}">{items}</sst>')
        book.writestr("xl/styles.xml", f'<styleSheet xmlns="{MAIN}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        for i, part in enumerate(parts, start=1):
            book.writestr(f"xl/worksheets/sheet{i}.xml", part)
