"""``.xlsx`` dictionary workbooks → a cells table ``(doc_id, row_no, c0 … c7)``.

An ``.xlsx`` file is a ZIP of XML parts.  Each workbook is read in one task
(``mapInPandas``) with the standard library only: the first worksheet's
cached cell values, shared strings resolved, numbers kept as their text.
The legacy binary ``.xls`` format is not read (no codec available here).
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from typing import Iterator
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .archives import open_random_access

N_CELLS = 8
CELLS_SCHEMA = "doc_id string, row_no long, " + ", ".join(f"c{i} string" for i in range(N_CELLS)) + ", error string"

_NS = {
    "m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
    "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
    "rel": "http://schemas.openxmlformats.org/package/2006/relationships",
}
_REF = re.compile(r"^([A-Z]+)([0-9]+)$")


def _column_index(letters: str) -> int:
    index = 0
    for ch in letters:
        index = index * 26 + (ord(ch) - 64)
    return index - 1


def _first_sheet_path(book: zipfile.ZipFile) -> str:
    workbook = ET.fromstring(book.read("xl/workbook.xml"))
    sheet = workbook.find("m:sheets/m:sheet", _NS)
    rel_id = sheet.get(f"{{{_NS['r']}}}id")
    rels = ET.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    for rel in rels.findall("rel:Relationship", _NS):
        if rel.get("Id") == rel_id:
            target = rel.get("Target")
            return target.lstrip("/") if target.startswith("/") else posixpath.normpath(posixpath.join("xl", target))
    raise KeyError("first worksheet not found")


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    root = ET.fromstring(book.read("xl/sharedStrings.xml"))
    return ["".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")) for si in root.findall("m:si", _NS)]


def sheet_rows(data: bytes) -> Iterator[tuple[int, list[str]]]:
    """(row number, first eight cell texts) of the first worksheet."""
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        strings = _shared_strings(book)
        sheet = ET.fromstring(book.read(_first_sheet_path(book)))
    number = 0
    for row in sheet.iter(f"{{{_NS['m']}}}row"):
        # Row and cell references are optional: without one, the place after the previous holds.
        number = int(row.get("r") or number + 1)
        cells, col = [""] * N_CELLS, -1
        for c in row.findall("m:c", _NS):
            match = _REF.match(c.get("r", ""))
            col = _column_index(match.group(1)) if match else col + 1
            if col >= N_CELLS:
                continue
            kind = c.get("t", "n")
            if kind == "inlineStr":
                value = "".join(t.text or "" for t in c.iter(f"{{{_NS['m']}}}t"))
            else:
                v = c.find("m:v", _NS)
                raw = v.text if v is not None and v.text is not None else ""
                if kind == "s":
                    value = strings[int(raw)] if raw else ""
                elif kind == "b":
                    value = "1" if raw == "1" else "0"
                else:
                    value = raw
            cells[col] = value
        yield number, cells


def _read_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["doc_id", "row_no"] + [f"c{i}" for i in range(N_CELLS)] + ["error"]
    for pdf in batches:
        members = pdf["member"] if "member" in pdf.columns else [None] * len(pdf)
        doc_ids = pdf["doc_id"] if "doc_id" in pdf.columns else pdf["path"]
        for uri, member, doc in zip(pdf["path"], members, doc_ids):
            rows = []
            try:
                with open_random_access(uri) as handle:
                    if member:
                        with zipfile.ZipFile(handle) as archive:
                            data = archive.read(member)
                    else:
                        data = handle.read()
                for number, cells in sheet_rows(data):
                    rows.append((doc, number, *cells, None))
            except (zipfile.BadZipFile, KeyError, ET.ParseError, OSError) as exc:
                rows.append((doc, None, *([None] * N_CELLS), f"unreadable workbook: {exc}"))
            yield pd.DataFrame(rows, columns=columns)


def workbook_cells(workbooks: DataFrame) -> DataFrame:
    """Cells of every ``.xlsx`` in ``workbooks.path`` (one workbook per task).

    Optional columns: ``member`` (read that workbook out of the ZIP at
    ``path``) and ``doc_id`` (the document key to emit; default the path).
    """
    ship_package(workbooks.sparkSession)
    cols = [c for c in ("path", "member", "doc_id") if c in workbooks.columns]
    return workbooks.select(*cols).mapInPandas(_read_cells, CELLS_SCHEMA)


# ------------------------------------------------------------- writing


def _escape(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;")


def _letters(index: int) -> str:
    out = ""
    index += 1
    while index:
        index, rem = divmod(index - 1, 26)
        out = chr(65 + rem) + out
    return out


def xlsx_bytes(rows: list[list[str]]) -> bytes:
    """A minimal single-sheet workbook with inline strings (fixtures, export)."""
    sheet_rows_xml = []
    for r, cells in enumerate(rows, start=1):
        cs = "".join(
            f'<c r="{_letters(i)}{r}" t="inlineStr"><is><t xml:space="preserve">{_escape(v)}</t></is></c>'
            for i, v in enumerate(cells) if v not in (None, "")
        )
        sheet_rows_xml.append(f'<row r="{r}">{cs}</row>')
    sheet = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
             f'<worksheet xmlns="{_NS["m"]}"><sheetData>{"".join(sheet_rows_xml)}</sheetData></worksheet>')
    workbook = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                f'<workbook xmlns="{_NS["m"]}" xmlns:r="{_NS["r"]}"><sheets>'
                '<sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>')
    rels = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
            f'<Relationships xmlns="{_NS["rel"]}"><Relationship Id="rId1" '
            'Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" '
            'Target="worksheets/sheet1.xml"/></Relationships>')
    root_rels = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                 f'<Relationships xmlns="{_NS["rel"]}"><Relationship Id="rId1" '
                 'Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" '
                 'Target="xl/workbook.xml"/></Relationships>')
    types = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
             '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
             '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
             '<Default Extension="xml" ContentType="application/xml"/>'
             '<Override PartName="/xl/workbook.xml" '
             'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
             '<Override PartName="/xl/worksheets/sheet1.xml" '
             'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>')
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", compression=zipfile.ZIP_DEFLATED) as book:
        book.writestr("[Content_Types].xml", types)
        book.writestr("_rels/.rels", root_rels)
        book.writestr("xl/workbook.xml", workbook)
        book.writestr("xl/_rels/workbook.xml.rels", rels)
        book.writestr("xl/worksheets/sheet1.xml", sheet)
    return buffer.getvalue()


def doc_name(doc_id_col: str = "doc_id"):
    return F.regexp_extract(F.col(doc_id_col), r"([^/]+)\.xlsx$", 1)
