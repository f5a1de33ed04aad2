"""Structural joins over node tables: which nodes stand inside which, and the text inside them.

Nodes are numbered in preorder, so those inside a node have the numbers from
its own to subtree_end. structural_join merges two sorted inputs with a stack
of the open ancestors, in one pass over a document, and never compares nodes
that don't contain each other. subtree_text needs no pass over a document at
all: characters have places in the document's text stream, which is cut into
blocks; a node's blocks are found by equality, so that a large document is
spread over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Characters of a block of a text stream.
BLOCK = 1 << 16
#: Rows of a batch of pairs.
ROWS = 1 << 16


def structural_join(ancestors: DataFrame, descendants: DataFrame, outermost: bool = False) -> DataFrame:
    """(doc_id, ancestor, descendant): the pairs of nodes of which one stands inside the other.

    ancestors has doc_id, node_id and subtree_end, descendants doc_id and
    node_id. outermost: each ancestor is given once, with its first descendant,
    and memory and result stay linear however deep elements stand in each other.
    """
    one = ancestors.select("doc_id", F.col("node_id").alias("at"), F.lit(0).alias("turn"), F.col("subtree_end").alias("last"))
    two = descendants.select("doc_id", F.col("node_id").alias("at"), F.lit(-1).alias("turn"), F.lit(None).cast("int").alias("last"))
    # a node is no descendant of itself: its descendant row comes before its ancestor row
    ordered = one.unionByName(two).repartition("doc_id").sortWithinPartitions("doc_id", "at", "turn")
    kind = ancestors.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, stack, done = object(), [], 0  # stack: [ancestor, its end]; the first `done` of them have been given
        found: list[tuple] = []
        for batch in batches:
            for name, at, turn, last in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if name != doc:
                    doc, stack, done = name, [], 0
                while stack and stack[-1][1] < at:
                    stack.pop()
                done = min(done, len(stack))
                if turn == 0:
                    stack.append((at, last))
                    continue
                found += [(name, a, at) for a, _ in stack[done:]]
                done = len(stack) if outermost else 0
                if len(found) >= ROWS:
                    yield pairs(found)
                    found = []
        if found:
            yield pairs(found)

    def pairs(found: list[tuple]) -> pa.RecordBatch:
        doc, a, b = zip(*found, strict=True)
        return pa.record_batch([pa.array(doc), pa.array(a, pa.int32()), pa.array(b, pa.int32())], ["doc_id", "ancestor", "descendant"])

    return ordered.mapInArrow(run, f"doc_id {kind}, ancestor int, descendant int")


def summarised(nodes: DataFrame, steps: int = 3) -> DataFrame:
    """nodes of any origin with kids, descendants, below, nth, parent_line, id_before, children and loose, as walk_xml gives them.

    Needs doc_id, node_id, parent_id, tag, attrs, text, tail, line and
    subtree_end. Children are counted by a window over their parent; what stands below is aggregated
    level by level, steps times, and descendants by the structural join.
    """
    siblings = Window.partitionBy("doc_id", "parent_id", "tag").orderBy("node_id")
    ident = F.coalesce(F.col("attrs")["id"], F.lit(""))
    earlier = Window.partitionBy("doc_id", ident).orderBy("node_id").rowsBetween(Window.unboundedPreceding, -1)
    before = F.sort_array(F.collect_set(F.when(ident != "", F.col("tag"))).over(earlier))
    rows = nodes.withColumn("nth", F.row_number().over(siblings).cast("int")).withColumn("id_before", before)
    ways = rows.select("doc_id", "parent_id", "node_id", "tag", "nth", F.array().cast("array<string>").alias("below"))
    for _ in range(steps):
        firsts = ways.where("nth = 1 AND parent_id IS NOT NULL").withColumn("own", F.concat(F.array("tag"), F.transform("below", lambda w: F.concat("tag", F.lit("/"), w))))
        deeper = firsts.groupBy("doc_id", F.col("parent_id").alias("node_id")).agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("node_id", "own"))), lambda x: x["own"])).alias("found"))
        ways = ways.drop("below").join(deeper, ["doc_id", "node_id"], "left").withColumn("below", F.coalesce("found", F.array().cast("array<string>"))).drop("found")
    kids = F.filter("below", lambda w: ~F.contains(w, F.lit("/")))
    shape = ways.select("doc_id", "node_id", kids.alias("kids"), "below")
    inner = rows.where("parent_id IS NOT NULL")
    tags = structural_join(nodes, inner).join(inner.select("doc_id", F.col("node_id").alias("descendant"), "tag"), ["doc_id", "descendant"])
    tags = tags.groupBy("doc_id", F.col("ancestor").alias("node_id")).agg(F.sort_array(F.collect_set("tag")).alias("descendants"))
    lines = nodes.select("doc_id", F.col("node_id").alias("parent_id"), F.col("line").alias("parent_line"))
    filled = lambda c: ~F.coalesce(c, F.lit("")).rlike(r"^[ \t\n\r]*\z")
    under = inner.groupBy("doc_id", F.col("parent_id").alias("node_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("node_id", "tag"))), lambda k: k["tag"]).alias("children"), F.bool_or(filled("tail")).alias("tails"))
    rows = rows.drop("children", "loose", "parent_line", "kids", "below", "descendants")
    out = rows.join(shape, ["doc_id", "node_id"]).join(tags, ["doc_id", "node_id"], "left").join(lines, ["doc_id", "parent_id"], "left").join(under, ["doc_id", "node_id"], "left")
    empty = F.array().cast("array<string>")
    return out.withColumns({"descendants": F.coalesce("descendants", empty), "children": F.coalesce("children", empty), "loose": filled("text") | F.coalesce("tails", F.lit(False))}).drop("tails")


def text_blocks(nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, block, content): the text stream of each document, cut every `block` characters."""
    piece = lambda at, text: F.struct(F.col(at).alias("at"), F.col(text).alias("x"))
    pieces = nodes.where("error IS NULL").select("doc_id", F.explode(F.array(piece("start_char", "text"), piece("end_char", "tail"))).alias("p")).select("doc_id", "p.at", "p.x").where("x <> ''")
    # the blocks that a piece reaches into, and its part there
    first, last = F.floor(F.col("at") / block), F.floor((F.col("at") + F.length("x") - 1) / block)
    cut = pieces.select("doc_id", "at", "x", F.explode(F.sequence(first, last)).alias("block"))
    start = F.greatest(F.col("block") * block - F.col("at"), F.lit(0))
    stop = F.least((F.col("block") + 1) * block - F.col("at"), F.length("x"))
    cut = cut.select("doc_id", "block", F.greatest("at", F.col("block") * block).alias("at"), F.substring("x", start.cast("int") + 1, (stop - start).cast("int")).alias("x"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda p: p["x"])
    return cut.groupBy("doc_id", "block").agg(F.array_join(parts, "").alias("content"))


def subtree_text(nodes: DataFrame, tags: list[str], block: int = BLOCK) -> DataFrame:
    """(doc_id, node_id, tag, content): all text below the elements of some tags, in document order."""
    tops = nodes.where("error IS NULL").where(F.col("tag").isin(tags)).select("doc_id", "node_id", "tag", "start_char", "end_char")
    filled = tops.where("end_char > start_char")
    reached = filled.withColumn("block", F.explode(F.sequence(F.floor(F.col("start_char") / block), F.floor((F.col("end_char") - 1) / block))))
    met = reached.join(text_blocks(nodes, block), ["doc_id", "block"])
    start = F.greatest(F.col("start_char") - F.col("block") * block, F.lit(0))
    stop = F.least(F.col("end_char") - F.col("block") * block, F.lit(block))
    part = F.substring("content", start.cast("int") + 1, (stop - start).cast("int"))
    joined = met.select("doc_id", "node_id", "tag", "block", part.alias("x")).groupBy("doc_id", "node_id", "tag").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "x"))), lambda p: p["x"]), "").alias("content"))
    return joined.unionByName(tops.where("end_char = start_char").select("doc_id", "node_id", "tag", F.lit("").alias("content")))
