"""Small Word files from rows: for tests and for queries over plain tables."""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
from pyspark.sql import DataFrame

_NS = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships" xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" xmlns:v="urn:schemas-microsoft-com:vml"'
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def paragraph(text: str, style: str | None = None, bold: bool = False, num_id: int | None = None, image: str | None = None, legacy_image: str | None = None) -> str:
    props = (f"<w:pStyle w:val={quoteattr(style)}/>" if style else "") + (f'<w:numPr><w:ilvl w:val="0"/><w:numId w:val="{num_id}"/></w:numPr>' if num_id is not None else "")
    drawing = f'<w:r><w:drawing><a:blip r:embed="{image}"/></w:drawing></w:r>' if image else ""
    legacy = f'<w:r><w:object><v:imagedata r:id="{legacy_image}"/></w:object></w:r>' if legacy_image else ""
    run = f'<w:r>{"<w:rPr><w:b/></w:rPr>" if bold else ""}<w:t xml:space="preserve">{escape(text)}</w:t></w:r>' if text else ""
    return f"<w:p><w:pPr>{props}</w:pPr>{drawing}{legacy}{run}</w:p>"


def table(rows: list[list[str]]) -> str:
    return "<w:tbl>" + "".join("<w:tr>" + "".join(f"<w:tc>{paragraph(c)}</w:tc>" for c in row) + "</w:tr>" for row in rows) + "</w:tbl>"


def document(body: list[str], title: str | None = None, author: str | None = None, media: dict[str, bytes] | None = None, rels: list[tuple[str, str, bool]] | None = None) -> bytes:
    """A file's bytes; body: paragraphs and tables in order; rels: (id, target, external) of images."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("[Content_Types].xml", "<Types/>")
        z.writestr("word/document.xml", f"<w:document {_NS}><w:body>{''.join(body)}</w:body></w:document>")
        z.writestr("word/_rels/document.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="{i}" Type="{_REL}/image" Target="{t}"{" TargetMode=" + chr(34) + "External" + chr(34) if x else ""}/>' for i, t, x in rels or []) + "</Relationships>")
        core = (f"<title>{escape(title)}</title>" if title else "") + (f"<creator>{escape(author)}</creator>" if author else "")
        z.writestr("docProps/core.xml", f"<core>{core}</core>")
        for name, data in (media or {}).items():
            z.writestr(f"word/media/{name}", data)
    return out.getvalue()


def build_docx(talks: DataFrame) -> DataFrame:
    """(path, content) of (path, turns array<struct<turn, role, text>>): system turns are headings 1, user turns headings 2."""
    styles = {"system": "Heading 1", "user": "Heading 2"}

    def build(batches):
        for batch in batches:
            rows = [{"path": r["path"], "content": document([paragraph(_plain(t["text"] or ""), styles.get(t["role"])) for t in r["turns"]], title=r["path"])} for r in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("path", pa.string()), ("content", pa.binary())]))

    return talks.select("path", "turns").mapInArrow(build, "path string, content binary")


def _plain(text: str) -> str:
    """Without characters that XML can't hold."""
    return "".join(c for c in text if c in "\t\n\r" or " " <= c <= "퟿" or "" <= c <= "�" or c > "￿")
