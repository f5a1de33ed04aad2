"""Nodes held against a document type's rules (sources.dtd)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.xml import walk_xml

#: Columns of nodes that refused reads.
READ = ["doc_id", "node_id", "tag", "attrs", "line", "error", "children", "loose"]


def refused(nodes: DataFrame, rules: DataFrame) -> DataFrame:
    """(doc_id, node_id, tag, line, problem, subject, at): what the rules refuse.

    problem is one of: element not declared; child not allowed (subject: the
    first such child, at: its number among the children, from 0); content is
    incomplete; text not allowed; attribute is missing; attribute value not
    allowed. A node's children are one array in their order, over which its
    model's automaton runs inside an expression. Nothing is shuffled; rules,
    which are of fixed size, go to every task.
    """
    rows = nodes.where("error IS NULL").join(F.broadcast(rules), "tag", "left")
    children = F.col("children")
    start = F.struct(F.lit(0).alias("state"), F.lit(0).alias("i"), F.lit(-1).alias("bad"))

    def step(s, tag):
        to = F.try_element_at(F.col("steps"), F.concat(s["state"].cast("string"), F.lit(" "), tag))
        bad = F.when((s["bad"] < 0) & to.isNull(), s["i"]).otherwise(s["bad"])
        return F.struct(F.coalesce(to, F.lit(-1)).alias("state"), (s["i"] + 1).alias("i"), bad.alias("bad"))

    ran = F.aggregate(children, start, step)
    stray = F.array_position(F.transform(children, lambda t: F.array_contains("allowed", t)), F.lit(False)).cast("int") - 1
    rows = rows.withColumn("ran", F.when(F.col("kind") == "children", ran)).withColumn("stray", F.when(F.col("kind") == "mixed", stray).when((F.col("kind") == "empty") & (F.size("children") > 0), 0).otherwise(-1))
    kind, bad = F.col("kind"), F.when(F.col("kind") == "children", F.col("ran.bad")).otherwise(F.col("stray"))

    def one(problem, when, subject=None, at=None):
        none = F.lit(None)
        return F.when(when, F.struct(F.lit(problem).alias("problem"), (none if subject is None else subject).cast("string").alias("subject"), (none if at is None else at).cast("int").alias("at")))

    single = F.array_compact(F.array(
        one("element not declared", kind.isNull()),
        one("child not allowed", bad >= 0, F.try_element_at("children", bad + 1), bad),
        one("content is incomplete", (kind == "children") & (F.col("ran.bad") < 0) & ~F.array_contains("ends", F.col("ran.state"))),
        one("text not allowed", kind.isin("children", "empty") & F.col("loose")),
    ))
    note = lambda problem, name: F.struct(F.lit(problem).alias("problem"), name.alias("subject"), F.lit(None).cast("int").alias("at"))
    none = F.expr("CAST(array() AS array<string>)")
    missing = F.transform(F.filter(F.coalesce("needed", none), lambda a: ~F.array_contains(F.map_keys("attrs"), a)), lambda a: note("attribute is missing", a))
    wrong = F.filter(F.coalesce(F.map_keys("choices"), none), lambda a: F.array_contains(F.map_keys("attrs"), a) & ~F.array_contains(F.element_at("choices", a), F.try_element_at("attrs", a)))
    wrong = F.transform(wrong, lambda a: note("attribute value not allowed", a))
    return rows.select("doc_id", "node_id", "tag", "line", F.explode(F.concat(single, missing, wrong)).alias("f")).select("doc_id", "node_id", "tag", "line", "f.problem", "f.subject", "f.at")


def texts_refused(documents: DataFrame, rules: DataFrame, recover: bool = False) -> DataFrame:
    """refused of XML texts (doc_id, xml), in one pass; equal texts that meet in a task are judged once."""
    found = refused(walk_xml(documents, recover=recover, columns=READ, together=True), rules)
    return found.select(F.explode("doc_id").alias("doc_id"), *found.columns[1:])
