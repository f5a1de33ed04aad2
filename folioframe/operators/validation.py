"""Structural rules over a node table, in one pass.

nodes are those of sources.xml.walk_xml, whose columns tell what stands inside
an element; a table of another origin gets them from structure.summarised.
Every rule is a nullable finding of one node, without a join or a shuffle, in
one pass over the nodes; a node's findings are exploded in rule order.
text_findings reads texts for the rules alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.xml import walk_xml

# Elements that the document type leaves out.
EXCLUDED = [
    "informalfigure", "informaltable", "variablelist", "simplelist", "example", "procedure", "div", "span", "b", "i", "u", "bridgehead", "abstract", "sidebar", "tip", "note", "warning", "caution", "important",
]
# Elements that need a title.
TITLED = ["chapter", "sect1", "sect2", "sect3", "sect4", "sect5", "figure", "table", "book"]
# Attributes that elements need.
REQUIRED = {"book": "id", "tgroup": "cols", "imagedata": "fileref", "chapter": "id", "sect1": "id", "sect2": "id", "sect3": "id", "figure": "id", "table": "id"}
# Forms of identifiers.
ID_FORMS = {
    "book": r"^b\d{3}$", "chapter": r"^ch\d{4}$", "sect1": r"^ch\d{4}s\d{4}$", "sect2": r"^ch\d{4}s\d{4}$", "sect3": r"^ch\d{4}s\d{4}$", "figure": r"^ch\d{4}s\d{4}fg\d{2}$", "table": r"^ch\d{4}s\d{4}tb\d{2}$",
}
# The form of figure files, HTML cells, the severities, and what a DOCTYPE may name.
FILE_FORM = r"^Ch\d{4}s\d{4}fg\d{2}\.\w+"
CELLS = ["tr", "td", "th"]
SEVERITIES = ["Error", "Warning", "Info"]
DTD_FILE, DTD_OWNER = "RittDocBook.dtd", "RIS Dev"
DOCTYPES = {"Missing DOCTYPE": "the document has no DOCTYPE", "Invalid DOCTYPE": "the DOCTYPE is another one"}
#: Columns of nodes that findings reads.
READ = ["doc_id", "node_id", "parent_id", "tag", "attrs", "line", "path", "error", "nth", "parent_line", "kids", "descendants", "below", "id_before"]
#: Elements that only single rules are about.
PARTS = ["tgroup", "imagedata"]


def _lookup(table: dict[str, str]):
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in table.items() for x in pair)), F.col("tag"))


def _has(tags: str, tag: str):
    return F.array_contains(tags, tag)


def used_again(rows: DataFrame, order: list[str]) -> DataFrame:
    """The rows (doc_id, ident, ...) whose identifier an earlier row of their document has, by the order of some columns."""
    return rows.withColumn("turn", F.row_number().over(Window.partitionBy("doc_id", "ident").orderBy(*order))).where("turn > 1").drop("turn")


def findings(nodes: DataFrame, documents: DataFrame | None = None, excluded: list[str] = EXCLUDED, titled_tags: list[str] = TITLED, required_attributes: dict[str, str] = REQUIRED) -> DataFrame:
    """All findings: doc_id, node_id, check_ord, line_number, error_type, error_description, severity.

    documents (doc_id, xml) adds those about the document type, on line 1; so
    does a column doctype of the nodes (doctype_problem of their text), without
    a join. Other document types have other excluded elements, elements with
    titles and required attributes.
    """
    tag, attrs = F.col("tag"), F.col("attrs")
    ident = F.coalesce(attrs["id"], F.lit(""))
    form = _lookup(ID_FORMS)
    parent = F.try_element_at("path", F.lit(-1))
    required = _lookup(required_attributes)
    cols = attrs["cols"]
    fileref = F.coalesce(attrs["fileref"], F.lit(""))
    table = (tag == "table") & _has("kids", "tgroup")
    group = (tag == "tgroup") & (F.col("nth") == 1) & parent.eqNullSafe(F.lit("table"))  # a table's first one; what is wrong with it is the table's

    def finding(n: int, kind: str, severity: str, when, text):
        return F.when(when, F.struct(F.lit(n).alias("check_ord"), F.lit(kind).alias("error_type"), text.alias("error_description"), F.lit(severity).alias("severity")))

    def says(*parts):
        return F.concat(*(F.lit(p) if isinstance(p, str) else F.coalesce(p, F.lit("")) for p in parts))

    missing_link = F.when(~_has("kids", "mediaobject"), "mediaobject").when(~_has("below", "mediaobject/imageobject"), "imageobject").when(~_has("below", "mediaobject/imageobject/imagedata"), "imagedata")
    titled = _has("kids", "title") | ((tag == "book") & _has("below", "bookinfo/title"))
    order_wrong = ((tag == "sect2") & ~parent.eqNullSafe(F.lit("sect1"))) | ((tag == "sect3") & ~parent.eqNullSafe(F.lit("sect2")))
    known = F.col("doctype") if "doctype" in nodes.columns else F.lit(None).cast("string")
    checks = [
        finding(0, "XML Parse Error", "Error", F.col("error").isNotNull(), F.col("error")),
        finding(1, "Excluded Element", "Error", tag.isin(excluded), says("<", tag, "> is not part of the document type")),
        finding(2, "Missing Title", "Error", tag.isin(titled_tags) & ~titled, says("<", tag, "> has no title")),
        finding(3, "Missing Attribute", "Error", required.isNotNull() & ~F.array_contains(F.map_keys(attrs), required), says("<", tag, "> has no attribute ", required)),
        finding(4, "Duplicate ID", "Error", (ident != "") & form.isNotNull() & F.arrays_overlap("id_before", F.array(*map(F.lit, ID_FORMS))), says("identifier ", ident, " was used before")),
        finding(5, "Invalid ID Format", "Warning", (ident != "") & form.isNotNull() & ~F.regexp_like(ident, form), says("identifier ", ident, " of <", tag, "> is not of the form ", form)),
        finding(6, "Invalid Figure Structure", "Error", (tag == "figure") & missing_link.isNotNull(), says("figure has no ", missing_link)),
        finding(7, "Invalid Table Structure", "Error", (tag == "table") & ~_has("kids", "tgroup"), says("table has no tgroup")),
        finding(8, "Missing Attribute", "Error", group & cols.isNull(), says("tgroup has no attribute cols")),
        finding(8, "Invalid Attribute Value", "Error", group & cols.isNotNull() & ~(cols.rlike(r"^[0-9]+$") & ~cols.rlike(r"^0+$")), says("cols is no positive number: ", cols)),
        finding(9, "Invalid Table Format", "Error", table & F.arrays_overlap("descendants", F.array(*map(F.lit, CELLS))), says("table holds HTML rows or cells")),
        finding(10, "Invalid Table Structure", "Warning", table & ~_has("below", "tgroup/tbody"), says("tgroup has no tbody")),
        finding(11, "Invalid Section Hierarchy", "Error", order_wrong, says("<", tag, "> stands in <", parent, ">")),
        finding(12, "Missing Attribute", "Error", (tag == "imagedata") & (fileref == ""), says("imagedata has no fileref")),
        *(finding(13, "Missing Attribute", "Warning", (tag == "imagedata") & (fileref != "") & (F.coalesce(attrs[a], F.lit("")) == ""), says(f"imagedata has no {a}")) for a in ("width", "scalefit")),
    ]
    first = F.col("error").isNull() & (F.col("node_id") == 0)
    checks += [finding(14, kind, "Warning", first & (known == kind), F.lit(text)) for kind, text in DOCTYPES.items()]
    found = nodes.select("doc_id", "node_id", "parent_id", "line", "parent_line", F.explode(F.array_compact(F.array(*checks))).alias("f"))
    of_table, of_text = F.col("f.check_ord") == 8, F.col("f.check_ord") == 14
    node, line = F.when(of_table, F.col("parent_id")).when(~of_text, F.col("node_id")), F.when(of_table, F.col("parent_line")).when(of_text, 1).otherwise(F.col("line"))
    found = found.select("doc_id", node.alias("node_id"), "f.check_ord", line.alias("line_number"), "f.error_type", "f.error_description", "f.severity")
    return found.unionByName(doctype_findings(documents, nodes.where("error IS NOT NULL"))) if documents is not None else found


def text_findings(documents: DataFrame, recover: bool = False, excluded: list[str] = EXCLUDED, titled_tags: list[str] = TITLED, required_attributes: dict[str, str] = REQUIRED) -> DataFrame:
    """findings of XML texts (doc_id, xml), those about the document type too, in one pass.

    The reader gives the rules what they read and no other node; equal texts
    that meet in a task are judged once.
    """
    texts = documents.select("doc_id", "xml", doctype_problem(F.coalesce("xml", F.lit(""))).alias("doctype"))
    tags = [*excluded, *titled_tags, *required_attributes, *ID_FORMS, *PARTS]
    nodes = walk_xml(texts, recover=recover, columns=READ, tags=tags, carried=["doctype"], together=True)
    found = findings(nodes, None, excluded, titled_tags, required_attributes)
    return found.select(F.explode("doc_id").alias("doc_id"), *found.columns[1:])


def doctype_problem(xml: Column) -> Column:
    """What is wrong with a text's document type, or null."""
    return F.when(~F.contains(xml, F.lit("<!DOCTYPE")), "Missing DOCTYPE").when(~F.contains(xml, F.lit(DTD_FILE)) & ~F.contains(xml, F.lit(DTD_OWNER)), "Invalid DOCTYPE")


def doctype_findings(documents: DataFrame, broken: DataFrame | None = None) -> DataFrame:
    """Warnings about a missing or other document type of (doc_id, xml)."""
    rows = documents.select(F.col("doc_id").cast("string").alias("doc_id"), doctype_problem(F.coalesce("xml", F.lit(""))).alias("error_type")).where("error_type IS NOT NULL")  # texts are not shuffled
    if broken is not None:
        rows = rows.join(broken.select("doc_id"), "doc_id", "left_anti")
    text = F.when(F.col("error_type") == "Missing DOCTYPE", DOCTYPES["Missing DOCTYPE"]).otherwise(DOCTYPES["Invalid DOCTYPE"])
    return rows.select("doc_id", F.lit(None).cast("int").alias("node_id"), F.lit(14).alias("check_ord"), F.lit(1).alias("line_number"), "error_type", text.alias("error_description"), F.lit("Warning").alias("severity"))


def verifications(nodes: DataFrame) -> DataFrame:
    """Figure files that don't follow the naming convention, for checking by hand."""
    name = F.regexp_extract("fileref", r"([^/]*)$", 1)
    rows = nodes.where("tag = 'imagedata'").withColumn("fileref", F.coalesce(F.col("attrs")["fileref"], F.lit("")))
    rows = rows.where(F.col("fileref").contains("multimedia/") & ~name.rlike(FILE_FORM))
    return rows.select("doc_id", "node_id", F.col("line").alias("line_number"), F.lit("Figure Naming").alias("fix_type"), F.concat(F.lit("rename "), name).alias("fix_description"), F.lit("the name does not follow the convention").alias("verification_reason"), F.lit("ChNNNNsNNNNfgNN.ext").alias("suggestion"))


def validity(found: DataFrame, documents: DataFrame) -> DataFrame:
    """Per document: findings by severity, in all, and whether there is no error."""
    counts = found.groupBy("doc_id").agg(*(F.count_if(F.col("severity") == s).alias(f"n_{s.lower()}") for s in SEVERITIES))
    rows = documents.select(F.col("doc_id").cast("string").alias("doc_id")).join(counts, "doc_id", "left").na.fill(0)
    return rows.withColumn("total", F.col("n_error") + F.col("n_warning") + F.col("n_info")).withColumn("is_valid", F.col("n_error") == 0)
