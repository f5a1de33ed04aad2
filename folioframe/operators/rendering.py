"""HTML from node tables: each node opens and closes a piece of HTML; the pieces are joined in document order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import escaped
from .assembly import joined
from .structure import subtree_text

__all__ = ["placeholder", "render_html", "subtree_text", "xml_counts"]

# Heading tags of titles by their parent, and classes of plain blocks.
TITLES = {"book": "h1", "bookinfo": "h1", "chapter": "h2", "sect1": "h3", "section": "h3", "sect2": "h4", "sect3": "h5", "figure": "figcaption"}
TITLE_CLASS = {"book": "book-title", "bookinfo": "book-title", "chapter": "chapter-title", "sect1": "section-title", "section": "section-title", "sect2": "section-title", "sect3": "section-title"}
BLOCKS = {"bookinfo": "div", "itemizedlist": "ul", "orderedlist": "ol", "author": "div"}
BARE = {"thead": "thead", "tbody": "tbody", "row": "tr", "listitem": "li"}
NAMES = ["firstname", "surname", "othername"]
LABELLED = ["isbn", "publisher", "pubdate", "copyright"]
#: Elements whose text is shown; what stands in them is text or inline.
TEXTUAL = ["title", "para", "entry", *NAMES, *LABELLED]


def render_html(nodes: DataFrame) -> DataFrame:
    """(doc_id, html) of nodes; text is escaped; unknown elements show their children only."""
    rows = nodes.where("error IS NULL")
    tag, path = F.col("tag"), F.col("path")
    # the textual element that a node stands in: the first of its ancestors
    holders = F.filter(F.transform(path, lambda t, i: F.when(t.isin(TEXTUAL), i)), lambda i: i.isNotNull())
    holder = F.try_element_at(holders, F.lit(1))
    rows = rows.withColumn("holder", holder).withColumn("holder_tag", F.when(holder.isNotNull(), F.try_element_at(path, holder + 1)))
    inline = F.col("holder").isNotNull()
    direct = inline & F.col("holder_tag").isin("para", "entry") & (F.size("path") == F.col("holder") + 1)
    counted = Window.partitionBy("doc_id", F.when(tag.isin("table", "informaltable"), "table").otherwise(tag)).orderBy("node_id")
    rows = rows.withColumn("number", F.row_number().over(counted))
    number = F.col("number")
    attr = lambda name, default: escaped(F.coalesce(F.col("attrs")[name], default if not isinstance(default, str) else F.lit(default)))
    parent, above = F.coalesce(F.try_element_at(path, F.lit(-1)), F.lit("")), F.coalesce(F.try_element_at(path, F.lit(-2)), F.lit(""))
    pick = lambda table, key: F.try_element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), key)
    title = F.coalesce(pick(TITLES, parent), F.lit("h4"))
    css = pick(TITLE_CLASS, parent)
    fileref = F.coalesce(F.col("attrs")["fileref"], F.lit(""))
    cat = lambda *p: F.concat(*(F.lit(x) if isinstance(x, str) else x for x in p))
    cell = F.when(above == "thead", "th").otherwise("td")
    depth = F.size("path").cast("string")
    opening = (
        F.when(direct & (tag == "emphasis"), F.when(F.col("attrs")["role"] == "bold", "<strong>").otherwise("<em>")).when(direct & (tag == "link"), cat('<a href="', F.coalesce(escaped(F.col("attrs")["href"]), F.lit("")), F.when(F.col("attrs")["href"].isNull(), cat("#", attr("linkend", ""))).otherwise(""), '">'))
        .when(inline, "").when(tag == "title", cat("<", title, F.when(css.isNull(), "").otherwise(cat(' class="', css, '"')), ">")).when(tag == "chapter", cat('<section class="chapter" id="', attr("id", cat("ch", depth)), '">'))
        .when(tag.isin("sect1", "sect2", "sect3", "section"), cat('<section class="', tag, '" id="', attr("id", cat("sec", depth)), '">')).when(tag == "para", "<p>").when(tag == "figure", cat('<figure class="figure" id="', attr("id", cat("fig", number.cast("string"))), '">'))
        .when(tag == "imagedata", cat('<img src="/api/media/', escaped(F.regexp_replace(fileref, "^multimedia/", "")), '" alt="Figure" style="max-width: 100%; width: ', attr("width", "auto"), ';">'))
        .when(tag.isin("table", "informaltable"), cat('<table class="docbook-table" id="tbl', number.cast("string"), '">')).when(tag == "entry", cat("<", cell, ">"))
        .when(tag.isin(*BARE), cat("<", pick(BARE, tag), ">")).when(tag.isin(*BLOCKS), cat("<", pick(BLOCKS, tag), ' class="', tag, '">')).when(tag.isin(NAMES), cat('<span class="', tag, '">'))
        .when(tag.isin(LABELLED), cat('<div class="', tag, '"><strong>', F.upper(tag), ":</strong> ")).otherwise("")
    )
    closing = (
        F.when(direct & (tag == "emphasis"), F.when(F.col("attrs")["role"] == "bold", "</strong>").otherwise("</em>")).when(direct & (tag == "link"), "</a>").when(inline, "").when(tag == "title", cat("</", title, ">"))
        .when(tag.isin("chapter", "sect1", "sect2", "sect3", "section"), "</section>").when(tag == "para", "</p>").when(tag == "figure", "</figure>").when(tag.isin("table", "informaltable"), "</table>").when(tag == "entry", cat("</", cell, ">"))
        .when(tag.isin(*BARE), cat("</", pick(BARE, tag), ">")).when(tag.isin(*BLOCKS), cat("</", pick(BLOCKS, tag), ">")).when(tag.isin(NAMES), " </span>").when(tag.isin(LABELLED), "</div>").otherwise("")
    )
    shown = inline | tag.isin(TEXTUAL)
    begin = cat(opening, F.when(shown, escaped(F.col("text"))).otherwise(""))
    finish = cat(closing, F.when(inline, escaped(F.col("tail"))).otherwise(""))
    events = F.array(F.struct(F.col("node_id").alias("at"), F.lit(0).alias("turn"), F.lit(0).alias("inner"), begin.alias("html")), F.struct(F.col("subtree_end").alias("at"), F.lit(1).alias("turn"), (-F.col("node_id")).alias("inner"), finish.alias("html")))
    pieces = rows.select("doc_id", F.explode(events).alias("e")).where("e.html <> ''")
    body = joined(pieces.select("doc_id", "e.*"), ["at", "turn", "inner"], "html").withColumnRenamed("html", "body")
    return body.select("doc_id", cat('<div class="docbook-content">', F.col("body"), "</div>").alias("html"))


def xml_counts(documents: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_chars) of (doc_id, xml)."""
    return documents.select("doc_id", F.size(F.split("xml", "\n", -1)).alias("n_lines"), F.length("xml").alias("n_chars"))


def placeholder(names: DataFrame) -> DataFrame:
    """(name, svg): a stand-in for a medium that is missing."""
    text = F.concat(F.lit("Missing: "), escaped(F.col("name")))
    return names.select("name", F.concat(F.lit('<svg xmlns="http://www.w3.org/2000/svg" width="400" height="300"><rect width="100%" height="100%" fill="#eee"/><text x="50%" y="50%" text-anchor="middle">'), text, F.lit("</text></svg>")).alias("svg"))
