"""A training corpus from documents: filter, deduplicate three ways, pack.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of
documents. Between stages the rows are written as Parquet and read again.

Decisions are about rows, not identifiers, which may repeat or be null. Defined
results: the classifier scores null, empty and repeated texts like any other;
of equal texts (null, empty and blank ones are equal) the longest stays, then
the smallest identifier, where a null one is smaller than all others (as in
exact_dedup); of near copies the smallest identifier stays, null ones last; a
null text that stays is null, and is one piece of
the end id when packed; a text whose words all go is empty; long texts are read
whole; an empty table gives an empty result; further columns, whatever their
names, are kept by all stages but the last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.llm import exact_dedup, near_copies, packing, quality, substring_dedup
from folioframe.llm._common import stored, table


def free_name(docs: DataFrame, name: str) -> str:
    """name, with as many strokes as it takes to be no column of docs."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a key of each row, written, and the key's name: identifiers may repeat or be null."""
    row = free_name(docs, "row")
    return stored(docs.withColumn(row, F.monotonically_increasing_id())), row


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays."""
    rows, row = keyed(docs)
    named = rows.select(F.struct(F.col("doc_id").alias("id"), F.col(row).alias("row")).alias("doc_id"), "text")
    gone = exact_dedup.exact_dedup(named).where("not kept").select(F.col("doc_id")["row"].alias(row))
    return rows.join(gone, row, "left_anti").select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked rows the one with the smallest identifier stays."""
    rows, row = keyed(docs)
    gone = near_copies.gone(rows, row).select(F.col("row").alias(row))
    return rows.join(gone, row, "left_anti").select(docs.columns)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of repeated windows go; a text that loses none stays as it is. n_chars, if there is one, is counted anew."""
    others, none = [c for c in docs.columns if c != "text"], free_name(docs, "no text")
    marked = docs.withColumn(none, F.col("text").isNull())
    out = substring_dedup.substring_dedup(marked, carry=(*others, none))
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).when(~F.col("carried")[none], F.col("data").cast("string"))
    out = out.select(*(F.col("carried")[c].alias(c) for c in others), text.alias("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 4096 tokens."""
    pieces = packing.tokenised_pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


STAGES = [
    ("quality classifier", filter_quality),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("substring dedup", drop_repeats),
    ("best-fit packing", pack),
]

#: The classifier can't be written in SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
