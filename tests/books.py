"""Workbooks for tests, written with the standard library only."""

import zipfile
from xml.sax.saxutils import escape

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def letters(at):
    name = ""
    at += 1
    while at:
        at, rest = divmod(at - 1, 26)
        name = chr(65 + rest) + name
    return name


class Date(float):
    """A serial number shown as a date."""


class Error(str):
    """An error result."""


def write_book(path, sheets):
    """``sheets`` maps a name to rows; ``None`` is an empty cell and an empty row is left out."""
    shared = []

    def cell(value, column, row):
        at = f'r="{letters(column)}{row}"'
        if isinstance(value, bool):
            return f'<c {at} t="b"><v>{int(value)}</v></c>'
        if isinstance(value, Date):
            return f'<c {at} s="1"><v>{float(value)}</v></c>'
        if isinstance(value, (int, float)):
            return f"<c {at}><v>{value}</v></c>"
        if isinstance(value, Error):
            return f'<c {at} t="e"><v>{value}</v></c>'
        if value.startswith("inline:"):
            return f'<c {at} t="inlineStr"><is><t>{escape(value[7:])}</t></is></c>'
        shared.append(value)
        return f'<c {at} t="s"><v>{len(shared) - 1}</v></c>'

    parts = {}
    for index, rows in enumerate(sheets.values(), 1):
        lines = []
        for number, row in enumerate(rows, 1):
            cells = "".join(cell(v, c, number) for c, v in enumerate(row) if v is not None)
            if cells:
                lines.append(f'<row r="{number}">{cells}</row>')
        parts[f"xl/worksheets/sheet{index}.xml"] = f'<worksheet {MAIN}><sheetData>{"".join(lines)}</sheetData></worksheet>'
    names = "".join(
        f'<sheet name="{escape(name)}" sheetId="{i}" r:id="rId{i}"/>' for i, name in enumerate(sheets, 1)
    )
    links = "".join(
        f'<Relationship Id="rId{i}" Type="sheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1)
    )
    parts["xl/workbook.xml"] = f'<workbook {MAIN} xmlns:r="{REL}"><sheets>{names}</sheets></workbook>'
    parts["xl/_rels/workbook.xml.rels"] = (
        f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>'
    )
    items = "".join(f'<si><t xml:space="preserve">{escape(text)}</t></si>' for text in shared)
    parts["xl/sharedStrings.xml"] = f"<sst {MAIN}>{items}</sst>"
    parts["xl/styles.xml"] = (
        f'<styleSheet {MAIN}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>'
    )
    with zipfile.ZipFile(path, "w") as book:
        for name, content in parts.items():
            book.writestr(name, content)
