"""E-mail, office files and PDF to text, by the standard library, in Arrow batches."""

from __future__ import annotations

import email
import email.policy
import io
import zipfile
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .pdf import pdf_text

HEADERS = ("From", "To", "Cc", "Date", "Subject")
W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def email_text(content: bytes) -> str:
    """Headers that are there, a blank line, the first plain part, and an inventory of attachments."""
    message = email.message_from_bytes(content, policy=email.policy.default)
    head = [f"{name}: {message[name]}" for name in HEADERS if message[name]]
    body, names = None, []
    for part in message.walk():
        if part.is_multipart():
            continue
        if part.get_filename():
            names.append(part.get_filename())
        elif body is None and part.get_content_type() == "text/plain":
            body = part.get_content()
    out = "\n".join(head) + "\n\n" + (body or "").replace("\r\n", "\n")
    return out + (f"\n[[ATTACHMENTS {', '.join(names)}]]" if names else "")


def _parts(archive: zipfile.ZipFile, folder: str, stem: str) -> list[str]:
    names = [n for n in archive.namelist() if n.startswith(f"{folder}/{stem}") and n.endswith(".xml")]
    return sorted(names, key=lambda n: int("".join(filter(str.isdigit, n.rsplit("/", 1)[1])) or 0))


def docx_text(content: bytes) -> str:
    """Paragraphs, then tables as rows of cells between bars."""
    body = ET.fromstring(zipfile.ZipFile(io.BytesIO(content)).read("word/document.xml")).find(f"{W}body")
    words = lambda node: "".join(t.text or "" for t in node.iter(f"{W}t"))
    lines = [words(p) for p in body.findall(f"{W}p")]
    for table in body.findall(f"{W}tbl"):
        for row in table.findall(f"{W}tr"):
            lines.append(" | ".join(" ".join(words(p) for p in cell.findall(f"{W}p")).strip() for cell in row.findall(f"{W}tc")))
    return "\n".join(x for x in lines if x.strip())


def pptx_text(content: bytes) -> str:
    archive, lines = zipfile.ZipFile(io.BytesIO(content)), []
    notes = set(archive.namelist())
    for i, name in enumerate(_parts(archive, "ppt/slides", "slide"), 1):
        lines.append(f"[[SLIDE {i}]]")
        lines += _paragraphs(archive.read(name))
        if (note := f"ppt/notesSlides/notesSlide{i}.xml") in notes:
            said = " ".join(_paragraphs(archive.read(note)))
            if said:
                lines.append(f"[[NOTES]] {said}")
    return "\n".join(lines)


def _paragraphs(xml: bytes) -> list[str]:
    found = ("".join(t.text or "" for t in p.iter(f"{A}t")).strip() for p in ET.fromstring(xml).iter(f"{A}p"))
    return [x for x in found if x]


def xlsx_text(content: bytes) -> str:
    archive, lines = zipfile.ZipFile(io.BytesIO(content)), []
    shared = []
    if "xl/sharedStrings.xml" in archive.namelist():
        shared = ["".join(t.text or "" for t in si.iter(f"{S}t")) for si in ET.fromstring(archive.read("xl/sharedStrings.xml")).findall(f"{S}si")]
    sheets = ET.fromstring(archive.read("xl/workbook.xml")).find(f"{S}sheets")
    for sheet, name in zip(sheets, _parts(archive, "xl/worksheets", "sheet")):
        lines.append(f"[[SHEET {sheet.get('name')}]]")
        for row in ET.fromstring(archive.read(name)).iter(f"{S}row"):
            cells = []
            for c in row.findall(f"{S}c"):
                v, inline = c.find(f"{S}v"), c.find(f"{S}is")
                if inline is not None:
                    cells.append("".join(t.text or "" for t in inline.iter(f"{S}t")))
                elif v is not None and v.text is not None:
                    cells.append(shared[int(v.text)] if c.get("t") == "s" else v.text)
            if any(x.strip() for x in cells):
                lines.append(" | ".join(cells))
    return "\n".join(lines)


PARSERS = {".eml": email_text, ".docx": docx_text, ".pptx": pptx_text, ".xlsx": xlsx_text, ".pdf": pdf_text}


def parse(path: str, content: bytes) -> str | None:
    """The text, or null where the file can't be parsed (it is then quarantined)."""
    parser = PARSERS.get("." + path.rsplit(".", 1)[-1].lower())
    if parser is None:
        return None
    try:
        return parser(bytes(content))
    except (zipfile.BadZipFile, ET.ParseError, ValueError, AttributeError, LookupError, TypeError, RecursionError):
        return None


@F.pandas_udf(StringType())
def rich_text(path: pd.Series, content: pd.Series) -> pd.Series:
    return pd.Series([None if c is None else parse(p, c) for p, c in zip(path, content)], dtype=object)
