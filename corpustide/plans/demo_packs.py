"""A stand-in portal and register over the driver's tables: pages, archives and Office files made by rule from an id."""

from __future__ import annotations

import functools
import io
import json
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import values as V

WORD = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
SHEET = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
RELATION = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
DRAWING = "http://schemas.openxmlformats.org/drawingml/2006/main"
SLIDE = "http://schemas.openxmlformats.org/presentationml/2006/main"


def zipped(members: list[tuple[str, bytes | str]]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in members:
            z.writestr(zipfile.ZipInfo(name), data)
    return out.getvalue()


def docx(heading: str, text: str) -> bytes:
    paragraph = lambda t, more="": f"<w:p><w:pPr>{more}</w:pPr><w:r><w:t>{t}</w:t></w:r></w:p>"
    cells = "".join(f"<w:tc>{paragraph(t)}</w:tc>" for t in (heading, text))
    body = paragraph(heading, '<w:pStyle w:val="h"/>') + paragraph(text, '<w:numPr><w:ilvl w:val="1"/><w:numId w:val="3"/></w:numPr>') + f"<w:tbl><w:tr>{cells}</w:tr></w:tbl>"
    styles = f'<w:styles xmlns:w="{WORD}"><w:style w:styleId="h"><w:name w:val="Heading 2"/></w:style></w:styles>'
    level = '<w:lvl w:ilvl="1"><w:start w:val="4"/><w:numFmt w:val="decimal"/><w:lvlText w:val="%2."/></w:lvl>'
    numbering = f'<w:numbering xmlns:w="{WORD}"><w:abstractNum w:abstractNumId="0">{level}</w:abstractNum><w:num w:numId="3"><w:abstractNumId w:val="0"/></w:num></w:numbering>'
    return zipped([
        ("word/document.xml", f'<w:document xmlns:w="{WORD}"><w:body>{body}</w:body></w:document>'), ("word/styles.xml", styles),
        ("word/numbering.xml", numbering)
    ])


def xlsx(name: str, value: str) -> bytes:
    cells = f'<row><c r="A1" t="inlineStr"><is><t>{name}</t></is></c><c r="C1"><v>{value}</v></c></row><row/><row><c r="A3"><f>A1+1</f></c></row>'
    book = f'<workbook xmlns="{SHEET}" xmlns:r="{RELATION}"><sheets><sheet name="Lapa" r:id="rId1"/></sheets></workbook>'
    related = '<Relationships><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>'
    return zipped([
        ("xl/workbook.xml", book), ("xl/_rels/workbook.xml.rels", related),
        ("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{SHEET}"><sheetData>{cells}</sheetData></worksheet>')
    ])


def pptx(text: str) -> bytes:
    shape = f"<p:sp><p:txBody><a:p><a:r><a:t>{text}</a:t></a:r></a:p></p:txBody></p:sp>"
    slide = f'<p:sld xmlns:p="{SLIDE}" xmlns:a="{DRAWING}"><p:cSld><p:spTree>{shape}</p:spTree></p:cSld></p:sld>'
    show = f'<p:presentation xmlns:p="{SLIDE}" xmlns:r="{RELATION}"><p:sldIdLst><p:sldId r:id="a"/></p:sldIdLst></p:presentation>'
    return zipped([
        ("ppt/presentation.xml", show),
        ("ppt/_rels/presentation.xml.rels", '<Relationships><Relationship Id="a" Target="slides/slide1.xml"/></Relationships>'),
        ("ppt/slides/slide1.xml", slide)
    ])


def pdf(text: str) -> bytes:
    """A page that shows one line."""
    shown = f"BT /F1 12 Tf 72 700 Td ({text}) Tj ET".encode("cp1252")
    objects = [
        b"<< /Type /Catalog /Pages 2 0 R >>", b"<< /Type /Pages /Kids [3 0 R] /Count 1 >>", b"<< /Type /Page /Contents 4 0 R >>",
        b"<< /Length %d >>\nstream\n%s\nendstream" % (len(shown), shown)
    ]
    return b"%PDF-1.4\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % (n, body) for n, body in enumerate(objects, 1))


KINDS = ("docx", "xlsx", "pptx", "ifc", "csv", "edoc", "dwg", "empty", "pdf", "rtf")


def _file(kind: str, name: str, brand: str, size: int) -> bytes:
    if kind == "docx":
        return docx(brand, name)
    if kind == "xlsx":
        return xlsx(name, str(size))
    if kind == "pptx":
        return pptx(name)
    if kind == "ifc":
        return f"ISO-10303-21; A('{name}','{size}','0123456789abcdefghijkl'); B('{brand}','{name}','\\X2\\0101\\X0\\x')".encode()
    if kind == "csv":
        return f"name,brand\n{name},{brand}|{size}\n".encode()
    if kind == "edoc":
        return zipped([("mimetype", "application/x"), ("META-INF/s.xml", "<s/>"), ("a/in.zip", zipped([("deep.md", f" {name} ")])), ("b.txt", brand.encode())])
    if kind == "pdf":
        return pdf(name)
    if kind == "rtf":
        return rf"{{\rtf1\ansi {{\fonttbl x}}{name}\par {brand}}}".encode()
    return b"AC10" if kind == "dwg" else b""


def files(parts: DataFrame) -> DataFrame:
    """(pid, record_id, path, content): a file for each part, of a kind that its number decides."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kinds = [KINDS[k % len(KINDS)] for k in batch["p_partkey"]]
            paths = [f"f/{k}.{'md' if kind == 'empty' else kind}" for k, kind in zip(batch["p_partkey"], kinds)]
            content = [_file(*x) for x in zip(kinds, batch["p_name"], batch["p_brand"], batch["p_size"])]
            yield pd.DataFrame({"pid": batch["p_partkey"].astype(str), "record_id": "r", "path": paths, "content": content})

    return parts.select("p_partkey", "p_name", "p_brand", "p_size").mapInPandas(run, "pid string, record_id string, path string, content binary")


class Portal:
    """Pages by id: one in seven is refused for good; the others list a current, a withheld and an archived record."""

    def page(self, url: str) -> str:
        pid = int(url.rsplit("/", 1)[-1])
        if pid % 7 == 0:
            return V.DENIED_HEADINGS[0]
        now = [{"Id": 1, "Title": f"One {pid}"}, {"Id": 2, "Title": "Hidden", "ShowDownloadIcon": False}]
        return f"{V.PUBLISHED_HEADINGS[1]} <script>var {V.CURRENT_ARRAY} = {json.dumps(now)}; var {V.ARCHIVE_ARRAY} = {json.dumps([{'Id': 3, 'Title': 'Old'}])};</script>"

    def archive(self, pid: str, record: dict) -> bytes:
        if record["id"] == "3":
            return b"<html>no archive</html>"
        return zipped([("a.txt", f"first {pid}"), ("sub/b.txt", "same")])

    def list(self, pid: str, record: dict) -> list[dict]:
        return [{"name": "b.txt"}, {"name": "a.txt"}]

    def file(self, pid: str, record: dict, entry: dict) -> bytes:
        return b"same" if entry["name"] == "b.txt" else f"other {pid}".encode()


@functools.lru_cache(maxsize=1)
def _parts(folder: str):
    """The register's records in the order of their numbers, read once by the process that scans it."""
    import pyarrow.parquet as pq

    return pq.read_table(f"{folder}/part.parquet", columns=["p_partkey", "p_type"]).sort_by("p_partkey").combine_chunks()


def register_page(n: int, folder: str, end: str) -> tuple[list[dict], int, int]:
    """Pages of a register of parts, 500 a page: every hundredth record comes again on the next page."""
    if n == 0:
        _parts.cache_clear()  # a new scan reads the table as it is now
    parts = _parts(folder)
    own = parts.slice(500 * n, 500).to_pylist()
    again = [r for r in parts.slice(500 * (n - 1), 500).to_pylist() if r["p_partkey"] % 100 == 0] if n else []
    return [{"identifier": str(r["p_partkey"]), "type": r["p_type"]} for r in own + again], parts.num_rows, 500
