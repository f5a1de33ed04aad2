"""Word documents as tables: one row per body element, media, relationships and properties.

Files are read as bytes (binaryFile); Python only takes the archive and its
XML apart. Rules about levels, lists, images and empty elements are columns.
"""

from __future__ import annotations

import io
import struct
import zipfile
from collections.abc import Collection, Iterator
from typing import BinaryIO
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import alignment, basename, clean_text, content_type, extension, heading_level, list_kind, run_markers, stem
from ..storage import stored

# Namespaces of the file format.
W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
V = "{urn:schemas-microsoft-com:vml}"
PROPERTIES = {"title": "title", "creator": "author", "subject": "subject", "keywords": "keywords", "created": "created", "modified": "modified"}
#: Formats whose size is read, and the least side that an image needs (one side is enough).
SIZED, LEAST_SIDE = ["png", "jpg", "jpeg", "gif", "bmp"], 50

_RUN = pa.struct([("text", pa.string()), ("bold", pa.bool_()), ("italic", pa.bool_()), ("underline", pa.bool_()), ("vertical", pa.string())])
_REF = pa.struct([("detector", pa.int32()), ("rel_id", pa.string())])
_PARTS = pa.schema([
    ("path", pa.string()), ("part", pa.string()), ("idx", pa.int32()), ("style", pa.string()), ("num_id", pa.string()), ("ilvl", pa.int32()), ("jc", pa.string()), ("runs", pa.list_(_RUN)), ("refs", pa.list_(_REF)), ("cells", pa.list_(pa.list_(pa.string()))),
    ("name", pa.string()), ("value", pa.string()), ("rel_type", pa.string()), ("external", pa.bool_()), ("width", pa.int32()), ("height", pa.int32()), ("data", pa.binary()), ("error", pa.string()),
])
_DDL = "path string, part string, idx int, style string, num_id string, ilvl int, jc string, runs array<struct<text:string,bold:boolean,italic:boolean,underline:boolean,vertical:string>>, refs array<struct<detector:int,rel_id:string>>, cells array<array<string>>, name string, value string, rel_type string, external boolean, width int, height int, data binary, error string"


def image_size(data: bytes) -> tuple[int | None, int | None]:
    """Width and height by the file's header: PNG, GIF, BMP, JPEG; (None, None) if it can't be read."""
    try:
        if data[:8] == b"\x89PNG\r\n\x1a\n":
            return struct.unpack(">II", data[16:24])
        if data[:4] == b"GIF8":
            return struct.unpack("<HH", data[6:10])
        if data[:2] == b"BM":
            w, h = struct.unpack("<ii", data[18:26])
            return w, abs(h)
        if data[:2] == b"\xff\xd8":
            p = 2
            while p + 9 < len(data):
                marker, n = data[p + 1], int.from_bytes(data[p + 2 : p + 4], "big")
                if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                    h, w = struct.unpack(">HH", data[p + 5 : p + 9])
                    return w, h
                p += 2 + n
    except struct.error:
        pass
    return None, None


def _on(properties, name: str) -> bool | None:
    e = properties.find(W + name) if properties is not None else None
    return None if e is None else e.get(W + "val") not in ("0", "false", "none")


def _text(run) -> str:
    marks = {W + "tab": "\t", W + "br": "\n", W + "cr": "\n"}
    return "".join(e.text or "" if e.tag == W + "t" else marks.get(e.tag, "") for e in run)


def _paragraph(p, styles: dict[str, str]) -> dict:
    props = p.find(W + "pPr")
    at = lambda *names: _path(props, names)
    style, num, jc, level = at("pStyle"), at("numPr", "numId"), at("jc"), at("numPr", "ilvl")
    runs = []
    for run in p.iter(W + "r"):
        r = run.find(W + "rPr")
        runs.append({"text": _text(run), "bold": _on(r, "b"), "italic": _on(r, "i"), "underline": _on(r, "u"), "vertical": _path(r, ("vertAlign",))})
    refs = [(1, b.get(R + "embed") or b.get(R + "link")) for b in p.iter(A + "blip")] + [(2, b.get(R + "id") or b.get(R + "pict")) for b in p.iter(V + "imagedata")] + [(3, b.get(R + "id")) for o in p.iter(W + "object") for b in o.iter(V + "imagedata")]
    return {
        "part": "paragraph", "style": styles.get(style, style) if style else "Normal", "num_id": num, "ilvl": int(level) if level and level.isdigit() else 0, "jc": jc, "runs": runs,
        "refs": [{"detector": d, "rel_id": i} for d, i in refs if i],
    }


def _path(e, names) -> str | None:
    for name in names:
        e = e.find(W + name) if e is not None else None
    return None if e is None else e.get(W + "val")


def _table(t) -> dict:
    """The texts of a table's cells; a merged cell repeats in every column and row that it spans."""
    rows: list[list[str]] = []
    for tr in t.findall(W + "tr"):
        cells: list[str] = []
        for tc in tr.findall(W + "tc"):
            text = "\n".join("".join(_text(r) for r in p.iter(W + "r")) for p in tc.findall(W + "p")).strip()
            span = _path(tc, ("tcPr", "gridSpan"))
            merge = next(tc.iterfind(f"{W}tcPr/{W}vMerge"), None)
            if merge is not None and merge.get(W + "val") != "restart" and rows and len(cells) < len(rows[-1]):
                text = rows[-1][len(cells)]  # goes on from the row above
            cells += [text] * (int(span) if span and span.isdigit() else 1)
        rows.append(cells)
    return {"part": "table", "cells": rows}


#: Kinds of rows of a document.
KINDS = ("document", "paragraph", "table", "media", "rel", "property", "error")


def parts(content: bytes | BinaryIO, wanted: Collection[str] = KINDS) -> Iterator[dict]:
    """Rows of one document, of the wanted kinds: body elements, media, relationships, properties, or one error row.

    Only members of the archive that the wanted kinds need are unpacked, and
    the main one, which decides whether the document can be read.
    """
    for row in _parts(content, wanted):
        if row["part"] in wanted:
            yield row


def _parts(content: bytes | BinaryIO, wanted: Collection[str]) -> Iterator[dict]:
    try:
        archive = zipfile.ZipFile(io.BytesIO(content) if isinstance(content, bytes | bytearray) else content)
        names = archive.namelist()
        body = ElementTree.fromstring(archive.read("word/document.xml")).find(W + "body")
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError) as e:
        yield {"part": "error", "error": f"{type(e).__name__}: {e}"}
        return
    yield {"part": "document"}
    styles = {}
    if "word/styles.xml" in names and "paragraph" in wanted:
        for s in ElementTree.fromstring(archive.read("word/styles.xml")).iter(W + "style"):
            name = s.find(W + "name")
            if name is not None:  # built-in headings are stored in lower case
                styles[s.get(W + "styleId")] = (name.get(W + "val") or "").replace("heading ", "Heading ")
    for i, e in enumerate(body if body is not None else ()):
        if e.tag == W + "p" and "paragraph" in wanted:
            yield {"idx": i, **_paragraph(e, styles)}
        elif e.tag == W + "tbl" and "table" in wanted:
            yield {"idx": i, **_table(e)}
    for i, name in enumerate(names):
        if name.startswith("word/media/") and "media" in wanted:
            data = archive.read(name)
            width, height = image_size(data)
            yield {"part": "media", "idx": i, "name": name, "width": width, "height": height, "data": data}
    if "word/_rels/document.xml.rels" in names:
        for i, r in enumerate(ElementTree.fromstring(archive.read("word/_rels/document.xml.rels"))):
            yield {"part": "rel", "idx": i, "name": r.get("Id"), "value": r.get("Target"), "rel_type": (r.get("Type") or "").rpartition("/")[2], "external": r.get("TargetMode") == "External"}
    if "docProps/core.xml" in names:
        for e in ElementTree.fromstring(archive.read("docProps/core.xml")):
            if (key := PROPERTIES.get(e.tag.rpartition("}")[2])) and e.text:
                yield {"part": "property", "name": key, "value": e.text}


def scan(files: DataFrame) -> DataFrame:
    """All parts of documents (path, content)."""

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = [{"path": path, **r} for r in parts(content or b"")]
                for a in range(0, len(rows), 2000):
                    yield pa.RecordBatch.from_pylist(rows[a : a + 2000], schema=_PARTS)

    return files.select("path", "content").mapInArrow(run, _DDL)


class Docx:
    """Tables of a set of documents; doc_id is the path.

    extract_images, extract_tables and preserve_formatting switch parts off;
    min_side is the least side of an image.
    """

    def __init__(self, files: DataFrame, extract_images: bool = True, extract_tables: bool = True, preserve_formatting: bool = True, min_side: int = LEAST_SIDE):
        self.parts = stored(scan(files).withColumnRenamed("path", "doc_id"))  # files are opened once
        self.images_on, self.tables_on, self.format_on, self.min_side = extract_images, extract_tables, preserve_formatting, min_side

    def errors(self) -> DataFrame:
        return self.parts.where("part = 'error'").select("doc_id", "error")

    def documents(self) -> DataFrame:
        """doc_id, stem, title, authors, metadata: the title falls back to the file's name."""
        props = self.parts.where("part = 'property'").groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("metadata"))
        rows = self.parts.select("doc_id").distinct().join(props, "doc_id", "left").withColumn("metadata", F.coalesce("metadata", F.create_map().cast("map<string,string>")))
        author = F.try_element_at("metadata", F.lit("author"))
        return rows.select("doc_id", stem(F.col("doc_id")).alias("stem"), F.coalesce(F.try_element_at("metadata", F.lit("title")), stem(F.col("doc_id"))).alias("title"), F.when(author.isNotNull(), F.array(author)).otherwise(F.array().cast("array<string>")).alias("authors"), "metadata")

    def media(self) -> DataFrame:
        """Images kept: those of a known format whose sides are both too short go; unreadable sizes stay."""
        rows = self.parts.where("part = 'media'").select("doc_id", F.col("idx").alias("media_ord"), F.col("name").alias("media_name"), extension(F.col("name")).alias("ext"), "width", "height", "data")
        small = F.coalesce(F.col("ext").isin(SIZED) & (F.col("width") < self.min_side) & (F.col("height") < self.min_side), F.lit(False))
        return rows.where(~small).withColumn("content_type", content_type(F.col("ext")))

    def relationships(self) -> DataFrame:
        return self.parts.where("part = 'rel'").select("doc_id", F.col("name").alias("rel_id"), F.col("idx").alias("rel_ord"), "rel_type", F.col("value").alias("target"), F.col("external").alias("is_external"))

    def images(self) -> DataFrame:
        return related_images(self.relationships(), self.media())

    def elements(self) -> DataFrame:
        """Elements in document order: a paragraph's images come before its text."""
        text = run_markers(F.col("runs")) if self.format_on else F.array_join(F.transform("runs", lambda r: r["text"]), "")
        empty_rows = F.lit(None).cast("array<array<string>>")
        flag = lambda name: F.exists("runs", lambda r: F.coalesce(r[name], F.lit(False)) & (r["text"] != ""))
        para = self.parts.where("part = 'paragraph'").select(
            "doc_id", "idx", F.lit(1).alias("step"), F.lit(0).alias("i"), F.lit("paragraph").alias("kind"), text.alias("text"), "style", heading_level(F.col("style")).alias("level"), list_kind(F.col("style"), F.col("num_id")).alias("list_type"),
            F.col("ilvl").alias("list_level"), flag("bold").alias("is_bold"), flag("italic").alias("is_italic"), flag("underline").alias("is_underline"), alignment(F.col("jc")).alias("alignment"), F.lit(None).cast("string").alias("rel_id"), empty_rows.alias("rows"),
        )
        streams = [para.where((clean_text(F.col("text")) != "") | F.col("list_type").isNotNull())]
        blank = {"text": "string", "style": "string", "list_type": "string", "alignment": "string"}

        def other(rows: DataFrame, kind: str) -> DataFrame:
            fill = {c: F.lit(None).cast(t) for c, t in blank.items()} | {"level": F.lit(0), "list_level": F.lit(0), "is_bold": F.lit(False), "is_italic": F.lit(False), "is_underline": F.lit(False), "kind": F.lit(kind)}
            return rows.withColumns(fill)

        if self.images_on:
            refs = self.parts.where("part = 'paragraph'").select("doc_id", "idx", F.posexplode("refs").alias("n", "r")).select("doc_id", "idx", "n", "r.detector", "r.rel_id")
            streams.append(other(paragraph_images(refs, self.images()).select("doc_id", "idx", F.lit(0).alias("step"), "i", "rel_id", empty_rows.alias("rows")), "image"))
        if self.tables_on:
            rows = self.parts.where("part = 'table' AND size(cells) > 0")
            streams.append(other(rows.select("doc_id", "idx", F.lit(1).alias("step"), F.lit(0).alias("i"), F.lit(None).cast("string").alias("rel_id"), F.col("cells").alias("rows")), "table"))
        every = streams[0]
        for s in streams[1:]:
            every = every.unionByName(s)
        pos = F.row_number().over(Window.partitionBy("doc_id").orderBy("idx", "step", "i")) - 1
        shape = F.when(F.col("kind") == "table", F.greatest(F.array_max(F.transform("rows", F.size)), F.lit(1)))
        return every.select("*", pos.alias("pos"), F.lit(1).alias("header_rows"), shape.alias("num_cols"), F.lit(None).cast("string").alias("caption")).drop("idx", "step", "i")


def related_images(rels: DataFrame, media: DataFrame) -> DataFrame:
    """(doc_id, rel_id, ..., image_no, filename): relationships joined to media by file name; image relationships without a hit take the first medium whose path ends with their target."""
    inner = rels.where(~F.coalesce("is_external", F.lit(False))).withColumn("base", basename(F.col("target")))
    files = media.withColumn("base", basename(F.col("media_name")))
    hit = inner.join(files, ["doc_id", "base"])
    missed = inner.where(F.col("rel_type") == "image").join(hit.select("doc_id", "rel_id").distinct(), ["doc_id", "rel_id"], "left_anti")
    # ends of media paths as long as the document's targets, so that path ends meet targets by equality
    missed = missed.withColumn("end", F.regexp_replace("target", r"^(\.\./)+|^/", ""))
    lengths = missed.select("doc_id", F.length("end").alias("n")).distinct()
    ends = files.drop("base").join(lengths, "doc_id").where(F.length("media_name") >= F.col("n")).withColumn("end", F.expr("right(media_name, n)")).drop("n")
    tail = missed.join(ends, ["doc_id", "end"]).drop("end")
    first = tail.withColumn("k", F.row_number().over(Window.partitionBy("doc_id", "rel_id").orderBy("media_ord"))).where("k = 1").drop("k")
    both = hit.unionByName(first)
    number = F.row_number().over(Window.partitionBy("doc_id").orderBy("rel_ord", "media_ord"))
    return both.withColumn("image_no", number).withColumn("filename", F.concat(F.format_string("img_%04d", F.col("image_no")), F.when(F.col("ext") == "", "").otherwise(F.concat(F.lit("."), "ext")))).drop("base")


def paragraph_images(refs: DataFrame, images: DataFrame) -> DataFrame:
    """(doc_id, idx, i, rel_id): images of each paragraph, once each, by the first detector that finds them."""
    known = refs.join(images.select("doc_id", "rel_id").distinct(), ["doc_id", "rel_id"], "left_semi")
    order = ("detector", "n") if "n" in refs.columns else ("detector",)
    once = known.withColumn("k", F.row_number().over(Window.partitionBy("doc_id", "idx", "rel_id").orderBy(*order))).where("k = 1")
    return once.withColumn("i", F.row_number().over(Window.partitionBy("doc_id", "idx").orderBy(*order, "rel_id")) - 1).select("doc_id", "idx", "i", "rel_id")


def read_docx(spark: SparkSession, path: str, **options) -> Docx:
    """Documents of a path or pattern; only .docx and .doc files count."""
    files = spark.read.format("binaryFile").load(path).where(F.lower("path").rlike(r"\.docx?$"))
    return Docx(files, **options)
