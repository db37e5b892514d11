"""A small workbook writer and reader for review tables, on the standard library.

Reviewers open one file, so it is written and read by the driver; a table for people is small.
"""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterable, Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_TYPES = """<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/><Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/></Types>"""
_RELS = """<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/{kind}" Target="{target}"/>{more}</Relationships>"""
_BOOK = f"""<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="{MAIN}" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="{{title}}" sheetId="1" r:id="r1"/></sheets></workbook>"""
#: Fill colours of the header and of rows by bucket.
HEADER_FILL = "4472C4"
BUCKET_FILLS = {"RED": "FF6B6B", "ORANGE": "FFA94D", "YELLOW": "FFD93D", "GREEN": "6BCB77"}


def _letters(n: int) -> str:
    out = ""
    while n:
        n, rest = divmod(n - 1, 26)
        out = chr(65 + rest) + out
    return out


def _cell(column: int, row: int, value, style: int) -> str:
    at = f'r="{_letters(column)}{row}" s="{style}"'
    if value is None:
        return f"<c {at}/>"
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return f"<c {at}><v>{value!r}</v></c>"
    return f'<c {at} t="inlineStr"><is><t xml:space="preserve">{escape(re.sub("[\x00-\x08\x0b\x0c\x0e-\x1f]", "", str(value)))}</t></is></c>'


def write(path: str, header: list[str], rows: Iterable[tuple], title: str = "Issues", colour_by: str | None = "bucket", wrap: str | None = "context_marked", widths: dict[str, int] | None = None) -> int:
    """Write a sheet with a fixed header row and return the number of rows; without rows no file is written."""
    it = iter(rows)
    if (first := next(it, None)) is None:
        return 0
    fills = [HEADER_FILL, *BUCKET_FILLS.values()]
    style_of = {b: i + 3 for i, b in enumerate(BUCKET_FILLS)}
    styles = (
        f'<?xml version="1.0" encoding="UTF-8"?><styleSheet xmlns="{MAIN}"><fonts count="2"><font/><font><b/><color rgb="FFFFFFFF"/></font></fonts><fills count="{len(fills) + 2}"><fill><patternFill patternType="none"/></fill><fill><patternFill patternType="gray125"/></fill>'
        + "".join(f'<fill><patternFill patternType="solid"><fgColor rgb="FF{f}"/></patternFill></fill>' for f in fills)
        + '</fills><borders count="2"><border/><border><left style="thin"/><right style="thin"/><top style="thin"/><bottom style="thin"/></border></borders><cellStyleXfs count="1"><xf/></cellStyleXfs>'
        + f'<cellXfs count="{len(fills) + 2}"><xf borderId="1" applyBorder="1" applyAlignment="1"><alignment vertical="center"/></xf><xf fontId="1" fillId="2" borderId="1" applyFont="1" applyFill="1" applyAlignment="1"><alignment horizontal="center" vertical="center"/></xf><xf borderId="1" applyAlignment="1"><alignment vertical="center" wrapText="1"/></xf>'
        + "".join(f'<xf fillId="{i + 3}" borderId="1" applyFill="1"/>' for i in range(len(BUCKET_FILLS)))
        + "</cellXfs></styleSheet>"
    )
    count = 0
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", _TYPES)
        z.writestr("_rels/.rels", _RELS.format(kind="officeDocument", target="xl/workbook.xml", more=""))
        z.writestr("xl/workbook.xml", _BOOK.format(title=escape(title)))
        z.writestr("xl/_rels/workbook.xml.rels", _RELS.format(kind="worksheet", target="worksheets/sheet1.xml", more='<Relationship Id="r2" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/styles" Target="styles.xml"/>'))
        z.writestr("xl/styles.xml", styles)
        with z.open("xl/worksheets/sheet1.xml", "w") as out:
            cols = "".join(f'<col min="{i}" max="{i}" width="{(widths or {}).get(h, 15)}" customWidth="1"/>' for i, h in enumerate(header, 1))
            out.write(f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{MAIN}"><sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" state="frozen"/></sheetView></sheetViews><cols>{cols}</cols><sheetData>'.encode())
            out.write(f'<row r="1">{"".join(_cell(i, 1, h, 1) for i, h in enumerate(header, 1))}</row>'.encode())
            row = first
            while row is not None:
                count += 1
                cells = []
                for i, (h, v) in enumerate(zip(header, row, strict=True), 1):
                    style = style_of.get(v, 0) if h == colour_by else 2 if h == wrap else 0
                    cells.append(_cell(i, count + 1, v, style))
                out.write(f'<row r="{count + 1}">{"".join(cells)}</row>'.encode())
                row = next(it, None)
            out.write(b"</sheetData></worksheet>")
    return count


def read(path: str) -> Iterator[dict]:
    """Rows from the second on as dicts by header, values as text, numbers as written; rows whose first cell is empty are skipped."""
    tag = lambda name: f"{{{MAIN}}}{name}"
    with zipfile.ZipFile(path) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(tag("t"))) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(tag("si"))]
        header: dict[str, str] = {}
        with z.open("xl/worksheets/sheet1.xml") as sheet:
            for _, row in ElementTree.iterparse(sheet):
                if row.tag != tag("row"):
                    continue
                own = {}
                for c in row.iter(tag("c")):
                    column = re.match("[A-Z]+", c.get("r"))[0]
                    v = c.find(tag("v"))
                    if c.get("t") == "inlineStr":
                        own[column] = "".join(t.text or "" for t in c.iter(tag("t")))
                    elif v is not None:
                        own[column] = shared[int(v.text)] if c.get("t") == "s" else v.text
                row.clear()
                if not header:
                    header = own
                elif own.get("A"):
                    yield {h: own.get(c) for c, h in header.items()}
