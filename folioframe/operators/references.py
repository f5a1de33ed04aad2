"""References in text to figures and tables: resolving and linking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import REFERENCE, clean_text, escaped, inline_tokens, reference_kind, reference_number, references


def reference_rows(texts: DataFrame, text: str = "text") -> DataFrame:
    """One row per reference: the other columns, ref_no, ref_type, ref_nums, kind and n (the first number)."""
    keep = [c for c in texts.columns if c != text]
    rows = texts.select(*keep, F.posexplode(references(F.col(text))).alias("ref_no", "r")).select(*keep, "ref_no", "r.ref_type", "r.ref_nums")
    return rows.withColumn("kind", reference_kind(F.col("ref_type"))).withColumn("n", reference_number(F.col("ref_nums")))


def targets(rows: DataFrame) -> DataFrame:
    """(doc_id, kind, n, linkend) of the figures and tables of numbered elements."""
    kind = F.when(F.col("kind") == "image", "figure").otherwise("table")
    return rows.where(F.col("kind").isin("image", "table")).select("doc_id", kind.alias("kind"), F.col("global_no").alias("n"), F.col("elem_id").alias("linkend"))


def resolve(refs: DataFrame, ids: DataFrame) -> DataFrame:
    """Adds linkend to references (doc_id, kind, n); null where the document has no such figure or table."""
    return refs.join(ids, ["doc_id", "kind", "n"], "left")


def target_maps(ids: DataFrame) -> DataFrame:
    """(doc_id, links): a document's targets as a map from 'kind n'."""
    return ids.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws(" ", "kind", F.col("n").cast("string")), "linkend"))).alias("links"))


def row_links(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, pos, links): for each element whose text refers to figures or tables of its document, those targets as a map from 'kind n'."""
    texts = rows.select("doc_id", "pos", clean_text(F.col("text")).alias("text")).where(F.col("text").rlike(REFERENCE))
    wanted = reference_rows(texts).select("doc_id", "pos", "kind", "n").distinct()
    found = wanted.join(ids, ["doc_id", "kind", "n"])
    return found.groupBy("doc_id", "pos").agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws(" ", "kind", F.col("n").cast("string")), "linkend"))).alias("links"))


def _target(ref, links):
    kind = F.when(F.lower(ref).startswith("fig"), "figure").otherwise("table")
    return F.try_element_at(links, F.concat_ws(" ", kind, F.coalesce(reference_number(F.regexp_extract(ref, REFERENCE, 2)).cast("string"), F.lit(""))))


def linked_text(text, links):
    """XML of plain text in which each resolvable reference is a link; text between them keeps its place."""
    found = F.regexp_extract_all(text, F.lit(f"({REFERENCE})"), F.lit(1))
    gaps = F.split(text, REFERENCE, -1)

    def link(ref):
        to = _target(ref, links)
        return F.when(to.isNull(), escaped(ref)).otherwise(F.concat(F.lit('<link linkend="'), to, F.lit('">'), escaped(ref), F.lit("</link>")))

    pieces = F.zip_with(F.transform(gaps, escaped), F.transform(found, link), lambda g, r: F.concat(g, F.coalesce(r, F.lit(""))))
    return F.array_join(pieces, "")


def paragraph_xml(text, links):
    """XML of a paragraph's content: inline markers as elements, emphasis that begins with a resolvable reference and references in plain text as links."""

    def part(t):
        body, fmt = t["text"], t["fmt"]
        begins = F.when(F.trim(body).rlike(f"^(?:{REFERENCE})"), _target(F.regexp_extract(F.trim(body), f"({REFERENCE})", 1), links))
        emphasis = F.when(fmt == "bold", F.concat(F.lit('<emphasis role="bold">'), escaped(body), F.lit("</emphasis>"))).otherwise(F.concat(F.lit("<emphasis>"), escaped(body), F.lit("</emphasis>")))
        return (
            F.when(fmt.isNull(), linked_text(body, links)).when(fmt == "subscript", F.concat(F.lit("<subscript>"), escaped(body), F.lit("</subscript>"))).when(fmt == "superscript", F.concat(F.lit("<superscript>"), escaped(body), F.lit("</superscript>")))
            .when(begins.isNotNull(), F.concat(F.lit('<link linkend="'), begins, F.lit('">'), escaped(body), F.lit("</link>"))).otherwise(emphasis)
        )

    return F.array_join(F.transform(inline_tokens(text), part), "")
