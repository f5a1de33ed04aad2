"""Package files (ZIP): reading the document's XML, and building packages from rows."""

from __future__ import annotations

import csv
import io
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import content_type, extension, figure_filename, human_size, image_format, package_name

# Columns of the image manifest and fields of the book's metadata.
MANIFEST = ["Filename", "Original Filename", "Chapter", "Figure Number", "Caption", "Alt Text", "Width", "Height", "File Size", "Format"]
BOOK_FIELDS = ["Title", "Authors", "ISBN", "Publisher", "Publication Date", "Created", "Modified", "Chapters", "Tables", "Images"]
WRITE_TRIES = 3


def package_xml(files: DataFrame, prefer: str | None = None) -> DataFrame:
    """(path, name, member, xml, error) of package files or XML files (path, content).

    Of a ZIP the first .xml member whose name lacks "metadata"; with prefer a
    member of that name comes first and any .xml member will do.
    """

    def read(batches):
        for batch in batches:
            out = []
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                member, xml, error = None, None, None
                if content[:2] == b"PK":
                    try:
                        with zipfile.ZipFile(io.BytesIO(content)) as z:
                            names = [n for n in z.namelist() if n.lower().endswith(".xml") and (prefer or "metadata" not in n.lower())]
                            member = prefer if prefer in names else names[0] if names else None
                            xml = z.read(member).decode("utf-8", "replace") if member else None
                    except zipfile.BadZipFile as e:
                        error = str(e)
                else:
                    xml = content.decode("utf-8", "replace")
                out.append({"path": path, "member": member, "xml": xml, "error": error or (None if xml else "no XML found")})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([(c, pa.string()) for c in ("path", "member", "xml", "error")]))

    return files.select("path", "content").mapInArrow(read, "path string, member string, xml string, error string").withColumn("name", package_name(F.col("path")))


def listed(files: DataFrame) -> DataFrame:
    """files (path, ...) with folder and name, the path's parts before and after its last slash."""
    name = F.substring_index("path", "/", -1)
    return files.withColumns({"folder": F.substring(F.col("path"), F.lit(1), F.length("path") - F.length(name) - 1), "name": name})


def media_folder(documents: DataFrame, folders: DataFrame) -> DataFrame:
    """(doc_id, folder, ...): the first of each document's folders that exists, with what folders tells of it.

    documents: doc_id and path of XML files; folders: one row for each folder
    that exists, with any other columns. A document and its own folders meet by
    the name without its end, its folder and the shared ones there by theirs:
    documents are never multiplied, and folders that many documents share are a
    table of their own, which is joined by its size.
    """
    path, whole = F.col("path"), F.struct("folder", *(c for c in folders.columns if c != "folder"))

    def ending(pattern: str, key: str) -> DataFrame:
        """The folders of a pattern by what stands before their end, written in lower case or in mixed."""
        stem, low = F.regexp_extract("folder", pattern, 1), F.endswith(F.col("folder"), F.lit("multimedia"))
        rows = folders.where(F.regexp_like("folder", F.lit(pattern))).groupBy(stem.alias(key))
        return rows.agg(F.first(F.when(low, whole), ignorenulls=True).alias(f"{key}_low"), F.first(F.when(~low, whole), ignorenulls=True).alias(f"{key}_mixed"))

    parent = F.regexp_extract(path, r"^(.*/)", 1)
    rows = documents.select("doc_id", F.concat(parent, package_name(path)).alias("own"), parent.alias("shared"))
    rows = rows.join(ending(r"(?s)^(.*)_(?:multimedia|MultiMedia)\z", "own"), "own", "left").join(ending(r"(?s)^((?:.*/)?)(?:multimedia|MultiMedia)\z", "shared"), "shared", "left")
    tried = F.array("own_low", "shared_low", "own_mixed", "shared_mixed")
    rank = F.array_position(F.transform(tried, lambda f: f.isNotNull()), F.lit(True))
    found = rows.select("doc_id", rank.alias("rank"), F.try_element_at(tried, rank.cast("int")).alias("f")).where("rank > 0")
    return found.groupBy("doc_id").agg(F.min_by("f", "rank").alias("f")).select("doc_id", "f.*")


def media_lookup(documents: DataFrame, files: DataFrame) -> DataFrame:
    """(doc_id, folder, name, path, content): each document's media, from the first of its folders that exists, that is, holds a file.

    documents: doc_id and path of XML files; files: path and content of media.
    A folder's files are given for every document that shares it; to count or
    sum them up, do so by folder first and ask media_folder.
    """
    media = listed(files)
    found = media_folder(documents, media.select("folder").distinct())
    return found.join(media, "folder").select("doc_id", "folder", "name", "path", "content")


def image_manifest(images: DataFrame) -> DataFrame:
    """The manifest's columns for images (doc_id, filename, original, caption, alt_text, width, height, content_type, data)."""
    parsed = figure_filename(F.col("filename"))
    values = [F.col("filename"), F.col("original"), parsed["chapter"], parsed["number"], F.coalesce("caption", F.lit("")), F.coalesce("alt_text", F.lit("")), F.coalesce("width", F.lit(0)), F.coalesce("height", F.lit(0)), human_size(F.octet_length("data")), image_format(F.col("content_type"))]
    return images.select("doc_id", *(v.alias(n) for v, n in zip(values, MANIFEST, strict=True)))


def book_metadata(documents: DataFrame, counts: DataFrame) -> DataFrame:
    """(doc_id, ord, Field, Value): documents (doc_id, title, authors, metadata) unpivoted with counts (n_chapters, n_tables, n_images)."""
    meta = lambda key: F.coalesce(F.try_element_at("metadata", F.lit(key)), F.lit(""))
    rows = documents.join(counts, "doc_id", "left")
    number = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("string")
    values = [F.col("title"), F.array_join("authors", "; "), meta("isbn"), meta("publisher"), meta("pubdate"), meta("created"), meta("modified"), number("n_chapters"), number("n_tables"), number("n_images")]
    pairs = F.array(*(F.struct(F.lit(n).alias("Field"), v.alias("Value")) for n, v in zip(BOOK_FIELDS, values, strict=True)))
    return rows.select("doc_id", F.posexplode(pairs).alias("ord", "p")).select("doc_id", "ord", "p.Field", "p.Value")


def _csv(header: list[str], rows: list[list]) -> str:
    out = io.StringIO()
    writer = csv.writer(out)
    writer.writerow(header)
    writer.writerows(rows)
    return out.getvalue()


def build_packages(xml: DataFrame, images: DataFrame, metadata: DataFrame) -> DataFrame:
    """(doc_id, package, media_count, xml_size, total_size, files): one ZIP for each document.

    xml has doc_id and xml, images the columns of image_manifest(), metadata
    those of book_metadata(). A document's own media are gathered, no more.
    """
    manifest = image_manifest(images).select("doc_id", F.col("Filename").alias("key"), F.struct(*(F.col(c).cast("string") for c in MANIFEST)).alias("row"))
    media = images.select("doc_id", F.col("filename").alias("key"), "data").join(manifest, ["doc_id", "key"]).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("key", "data", "row"))).alias("media"))
    fields = metadata.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("ord", "Field", "Value"))).alias("fields"))
    rows = xml.select("doc_id", "xml").join(media, "doc_id", "left").join(fields, "doc_id", "left")
    kind = pa.schema([("doc_id", pa.string()), ("package", pa.binary()), ("media_count", pa.int32()), ("xml_size", pa.int64()), ("total_size", pa.int64()), ("files", pa.list_(pa.string()))])

    def build(batches):
        for batch in batches:
            for row in batch.to_pylist():
                buffer, names = io.BytesIO(), []
                with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:

                    def put(name: str, data: bytes, z=z, names=names):
                        z.writestr(zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0)), data, zipfile.ZIP_DEFLATED)  # no clock: equal inputs, equal packages
                        names.append(name)

                    text = row["xml"].encode()
                    put("Book.xml", text)
                    media = row["media"] or []
                    for m in media:
                        put(f"multimedia/{m['key']}", m["data"] or b"")
                    if media:
                        put("metadata.csv", _csv(MANIFEST, [list(m["row"].values()) for m in media]).encode())
                    put("book_metadata.csv", _csv(["Field", "Value"], [[f["Field"], f["Value"]] for f in row["fields"] or []]).encode())
                data = buffer.getvalue()
                yield pa.RecordBatch.from_pylist([{"doc_id": row["doc_id"], "package": data, "media_count": len(media), "xml_size": len(text), "total_size": len(data), "files": names}], schema=kind)

    return rows.mapInArrow(build, "doc_id string, package binary, media_count int, xml_size bigint, total_size bigint, files array<string>")


def replaced_member(packages: DataFrame, xml: DataFrame, member: str = "Book.xml") -> DataFrame:
    """(doc_id, package): packages with one member's text replaced by xml (doc_id, xml); the others stay as they are."""
    rows = packages.select("doc_id", "package").join(xml.select("doc_id", "xml"), "doc_id", "left")

    def swap(batches):
        for batch in batches:
            for row in batch.to_pylist():
                data = row["package"]
                if row["xml"] is not None:
                    out = io.BytesIO()
                    with zipfile.ZipFile(io.BytesIO(data)) as old, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as new:
                        for info in old.infolist():
                            new.writestr(info, row["xml"].encode() if info.filename == member else old.read(info), zipfile.ZIP_DEFLATED)
                    data = out.getvalue()
                yield pa.RecordBatch.from_pylist([{"doc_id": row["doc_id"], "package": data}], schema=pa.schema([("doc_id", pa.string()), ("package", pa.binary())]))

    return rows.mapInArrow(swap, "doc_id string, package binary")


def saved_images(images: DataFrame) -> DataFrame:
    """(path, content) of images, one file for each, for write_files()."""
    return images.select(F.concat_ws("/", F.concat(F.col("doc_id"), F.lit("_multimedia")), "filename").alias("path"), F.col("data").alias("content"))


def write_files(rows: DataFrame, folder: str) -> DataFrame:
    """Writes (path, content) as files below a folder that all executors see; returns (path, n_bytes).

    A file gets its name when it is whole, so a lost or repeated task does no
    harm; a refused write is tried again, after 2 and 4 seconds.
    """

    def write(batches):
        import os
        import time
        import uuid

        for batch in batches:
            done = []
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                target = os.path.normpath(os.path.join(folder, path.lstrip("/")))
                if not target.startswith(os.path.normpath(folder) + os.sep):
                    raise ValueError(f"path leaves the folder: {path}")
                os.makedirs(os.path.dirname(target), exist_ok=True)
                for n in range(1, WRITE_TRIES + 1):
                    try:
                        part = f"{target}.{uuid.uuid4().hex}"
                        with open(part, "wb") as f:
                            f.write(content)
                        os.replace(part, target)
                        break
                    except PermissionError:
                        if n == WRITE_TRIES:
                            raise
                        time.sleep(2 * n)
                done.append({"path": target, "n_bytes": len(content)})
            yield pa.RecordBatch.from_pylist(done, schema=pa.schema([("path", pa.string()), ("n_bytes", pa.int64())]))

    return rows.select("path", F.col("content").cast("binary").alias("content")).mapInArrow(write, "path string, n_bytes bigint")


def content_types(names: DataFrame, name: str = "name") -> DataFrame:
    return names.withColumn("content_type", content_type(extension(F.col(name))))
