"""Ordered assembly of numbered elements into one XML text per document.

Every element becomes the text that it opens, holds and closes; the numbering
tells which sections and lists end before it. The texts are joined as a tree:
BLOCK neighbours at a time, then the blocks. So no task sorts all pieces of a
document, and only its blocks meet where its one text is made. References are
resolved by joining those that occur, not by a map of all targets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import BOOK_DEFAULTS, clean_text, escaped, extension, filled, padded, person_name
from ..storage import stored
from .numbering import chapter_code, numbered, sections
from .references import paragraph_xml, row_links, targets

# The document type that packages declare.
PUBLIC_ID = "-//RIS Dev//DTD DocBook V4.3 -Based Variant V1.1//EN"
SYSTEM_ID = "http://LOCALHOST/dtd/V1.1/RittDocBook.dtd"
PROLOG = f'<?xml version="1.0" encoding="UTF-8"?>\n<!DOCTYPE book PUBLIC "{PUBLIC_ID}"\n  "{SYSTEM_ID}">\n'
MEDIA = "multimedia/"
#: Places of neighbouring pieces that are joined first.
BLOCK = 4096


def joined(pieces: DataFrame, order: list[str], text: str = "xml", block: int = BLOCK) -> DataFrame:
    """(doc_id, text): the pieces of each document, joined in order; the first column of order holds places from 0 on."""
    inside = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, text))), lambda p: p[text]), "")
    blocks = pieces.groupBy("doc_id", F.floor(F.col(order[0]) / block).alias("block")).agg(inside.alias(text))
    return blocks.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", text))), lambda p: p[text]), "").alias(text))


def element(tag: str, body, attributes: str = ""):
    return F.concat(F.lit(f"<{tag}{attributes}>"), body, F.lit(f"</{tag}>"))


def book_info(documents: DataFrame, year: str) -> DataFrame:
    """(doc_id, bookinfo): documents have doc_id, title, authors and metadata; year stands for the present one."""

    def meta(key: str, default: str):
        return escaped(F.coalesce(F.try_element_at(F.col("metadata"), F.lit(key)), F.lit(default)))

    def author(name):
        p = person_name(name)
        first = F.when(p["firstname"].isNull(), "").otherwise(element("firstname", escaped(p["firstname"])))
        return element("author", element("personname", F.concat(first, element("surname", escaped(p["surname"])))))

    authors = F.when(F.size(F.coalesce("authors", F.array())) > 0, F.col("authors")).otherwise(F.array(F.lit(BOOK_DEFAULTS["author"])))
    parts = [
        element("isbn", meta("isbn", BOOK_DEFAULTS["isbn"])), element("title", escaped(filled(F.col("title"), BOOK_DEFAULTS["title"]))), element("authorgroup", F.array_join(F.transform(authors, author), "")),
        element("publisher", element("publishername", meta("publisher", BOOK_DEFAULTS["publisher"]))), element("pubdate", meta("pubdate", year)), element("edition", meta("edition", BOOK_DEFAULTS["edition"])),
        element("copyright", F.concat(element("year", meta("copyright_year", year)), element("holder", meta("copyright_holder", BOOK_DEFAULTS["holder"])))),
    ]
    return documents.select("doc_id", element("bookinfo", F.concat(*parts)).alias("bookinfo"))


def column_count(rows):
    """Cells of the longest row, at least 1."""
    return F.greatest(F.coalesce(F.array_max(F.transform(rows, F.size)), F.lit(1)), F.lit(1))


def column_specs(rows):
    return F.transform(F.sequence(F.lit(1), column_count(rows)), lambda i: F.concat(F.lit("c"), i.cast("string")))


def table_xml(elem_id, caption, number, rows, header_rows):
    """A table: title, columns, head rows, body rows; short rows stay short."""

    def row(cells):
        return element("row", F.array_join(F.transform(cells, lambda c: element("entry", escaped(clean_text(c)))), ""))

    def group(tag: str, part):
        return F.when(F.size(part) > 0, element(tag, F.array_join(F.transform(part, row), ""))).otherwise("")

    n, total = F.coalesce(header_rows, F.lit(1)), F.size(rows)
    head = F.slice(rows, 1, F.least(n, total))
    body = F.when(total > n, F.slice(rows, F.least(n, total) + 1, F.greatest(total - n, F.lit(0)))).otherwise(F.slice(rows, 1, 0))
    specs = F.array_join(F.transform(column_specs(rows), lambda c: F.concat(F.lit('<colspec colname="'), c, F.lit('"/>'))), "")
    title = F.coalesce(F.nullif(caption, F.lit("")), F.concat(F.lit("Table "), number.cast("string")))
    inner = F.concat(F.lit('<tgroup cols="'), column_count(rows).cast("string"), F.lit('">'), specs, group("thead", head), group("tbody", body), F.lit("</tgroup>"))
    return F.concat(F.lit('<table id="'), elem_id, F.lit('">'), element("title", escaped(title)), inner, F.lit("</table>"))


def figure_file(elem_id, ext):
    """The figure's file name by convention: its id with a capital, and its suffix."""
    return F.concat(F.initcap(F.substring(elem_id, 1, 1)), F.expr("substring(elem_id, 2)"), F.when(ext == "", "").otherwise(F.concat(F.lit("."), ext)))


def figure_xml(elem_id, caption, number, filename):
    title = F.coalesce(F.nullif(caption, F.lit("")), F.concat(F.lit("Figure "), number.cast("string")))
    data = F.concat(F.lit(f'<imagedata fileref="{MEDIA}'), escaped(filename), F.lit('" width="100%" scalefit="1"/>'))
    return F.concat(F.lit('<figure id="'), elem_id, F.lit('">'), element("title", escaped(title)), element("mediaobject", element("imageobject", data)), F.lit("</figure>"))


def plain_title(c):
    """A heading's text without inline markers."""
    return clean_text(F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"\{su[bp]:(.+?)\}", "$1"), r"\*+(.+?)\*+", "$1"))


def _closing(depth):
    """End tags of the open sections from a depth down to the chapter."""
    return F.when(depth == 3, "</sect3></sect2></sect1>").when(depth == 2, "</sect2></sect1>").when(depth == 1, "</sect1>").otherwise("")


def fragments(rows: DataFrame) -> DataFrame:
    """(doc_id, pos, place, depth, xml) of numbered elements that carry place, links (a map, may be null), doc_title, caption, rows, header_rows and filename."""
    rows = rows.withColumn("first_row", F.col("place") == 0).withColumn("depth_end", F.col("depth_before"))
    own = F.col("own_level")
    at = F.coalesce(F.col("depth_before"), F.lit(0))
    target = F.least(own, F.lit(4)) - 1
    keep = F.least(at, target - 1)  # sections that stay open

    def opened(depth, number, title):
        tag = F.concat(F.lit("sect"), depth.cast("string"))
        return F.concat(F.lit("<"), tag, F.lit(' id="'), chapter_code(), padded("s", number, 4), F.lit('">'), element("title", title))

    between = F.when(at == 3, F.when(keep == 2, "</sect3>").when(keep == 1, "</sect3></sect2>").otherwise("</sect3></sect2></sect1>")).when(at == 2, F.when(keep == 2, "").when(keep == 1, "</sect2>").otherwise("</sect2></sect1>")).when(at == 1, F.when(keep >= 1, "").otherwise("</sect1>")).otherwise("")
    skipped = F.array_join(
        F.transform(
            F.when(F.col("new_sections") > 1, F.sequence(F.lit(1), F.col("new_sections") - 1)).otherwise(F.array().cast("array<bigint>")),
            lambda i: opened(keep + i, F.col("section_no") - F.col("new_sections") + i, F.when(keep + i == 1, "Section").otherwise("Subsection")),
        ),
        "",
    )
    title = escaped(plain_title(F.col("text")))
    chapter_end = F.when(F.col("first_row"), "").otherwise(F.concat(_closing(F.coalesce(F.col("depth_end"), F.lit(0))), F.lit("</chapter>")))
    chapter = F.concat(F.lit('<chapter id="'), chapter_code(), F.lit('">'))
    heading = F.when(own == 1, F.concat(chapter_end, chapter, element("title", title))).when(own > 1, F.concat(between, skipped, opened(target, F.col("section_no"), title)))
    implicit = F.when(F.col("first_row") & (own != 1), F.concat(chapter, element("title", escaped(filled(F.col("doc_title"), "Content"))))).otherwise("")
    para = element("para", paragraph_xml(clean_text(F.col("text")), F.coalesce("links", F.create_map().cast("map<string,string>"))))
    tag = F.when(F.col("own_list") == "bullet", "itemizedlist").otherwise("orderedlist")
    item = F.concat(F.when(F.col("list_start") == 1, F.concat(F.lit("<"), tag, F.lit(">"))).otherwise(""), element("listitem", para), F.when(F.col("list_end"), F.concat(F.lit("</"), tag, F.lit(">"))).otherwise(""))
    body = (
        F.when(F.col("is_heading"), heading).when(F.col("own_list").isNotNull(), item).when(F.col("kind") == "image", figure_xml(F.col("elem_id"), F.col("caption"), F.col("kind_no"), F.col("filename")))
        .when(F.col("kind") == "table", table_xml(F.col("elem_id"), F.col("caption"), F.col("kind_no"), F.col("rows"), F.col("header_rows"))).when(F.trim(F.coalesce("text", F.lit(""))) == "", "").otherwise(para)
    )
    return rows.select("doc_id", "pos", "place", "depth", F.concat(implicit, body).alias("xml"))


def contents(rows: DataFrame) -> DataFrame:
    """(doc_id, toc): the nested table of contents of numbered elements with doc_title."""
    own = sections(rows.withColumn("plain", plain_title(F.col("text"))), "plain")
    first = rows.groupBy("doc_id").agg(F.min_by("own_level", "pos").alias("l"), F.first("doc_title").alias("t")).where("l <> 1")
    implicit = first.select("doc_id", F.lit(-1).cast("int").alias("pos"), F.lit(1).cast("long").alias("chapter_no"), F.lit(0).cast("long").alias("section_no"), F.lit(0).alias("depth"), filled(F.col("t"), "Content").alias("title"), F.lit(True).alias("implicit"))
    every = own.withColumn("pos", F.col("pos").cast("int")).unionByName(implicit)
    order = Window.partitionBy("doc_id").orderBy("chapter_no", "section_no")
    every = every.withColumn("before", F.lag("depth").over(order)).withColumn("after", F.lead("depth").over(order))

    def ends(a, b):
        """End tags between an entry of depth a and the next of depth b (-1: none)."""
        out = F.lit("")
        for depth, tag in ((3, "toclevel3"), (2, "toclevel2"), (1, "toclevel1"), (0, "tocchap")):
            out = F.concat(out, F.when((a >= depth) & (b <= depth), f"</{tag}>").otherwise(""))
        return out

    tag = F.when(F.col("depth") == 0, "tocchap").otherwise(F.concat(F.lit("toclevel"), F.col("depth").cast("string")))
    link = F.when(F.col("depth") == 0, chapter_code()).otherwise(F.concat(chapter_code(), padded("s", F.col("section_no"), 4)))
    entry = F.concat(F.lit("<"), tag, F.lit('><tocentry linkend="'), link, F.lit('">'), escaped(F.col("title")), F.lit("</tocentry>"), ends(F.col("depth"), F.coalesce("after", F.lit(-1))))
    listed = every.select("doc_id", (F.row_number().over(order) - 1).alias("place"), entry.alias("x"))
    return joined(listed, ["place"], "x").select("doc_id", element("toc", F.concat(F.lit("<title>Table of Contents</title>"), F.col("x"))).alias("toc"))


def assemble(elements: DataFrame, documents: DataFrame, year: str) -> DataFrame:
    """(doc_id, xml): elements (numbered here) with media_name and caption columns, documents (doc_id, title, authors, metadata)."""
    rows = numbered(elements, place="place").join(documents.select("doc_id", F.col("title").alias("doc_title")), "doc_id", "left")
    rows = stored(rows.withColumn("filename", figure_file(F.col("elem_id"), extension(F.coalesce("media_name", F.lit(""))))))  # read four times
    pieces = fragments(rows.join(row_links(rows, targets(rows)), ["doc_id", "pos"], "left"))
    last = rows.groupBy("doc_id").agg(F.max_by("depth", "pos").alias("depth"))
    body = joined(pieces.where("xml <> ''"), ["place"]).withColumnRenamed("xml", "body").join(last, "doc_id")
    out = book_info(documents, year).join(body, "doc_id", "left").join(contents(rows), "doc_id", "left")
    inner = F.concat(F.col("bookinfo"), F.coalesce("toc", F.lit("")), F.when(F.col("body").isNull(), "").otherwise(F.concat("body", _closing(F.col("depth")), F.lit("</chapter>"))))
    return out.select("doc_id", F.concat(F.lit(PROLOG), F.lit('<book id="b001">'), inner, F.lit("</book>\n")).alias("xml"))
