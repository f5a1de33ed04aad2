"""Exact deduplication by a content sort.

Sampled splitters range-partition the normalised text (RangePartitioning over
a bounded key: the first code points, a hash of the whole, and a slice number
that is 0 but for hot runs), an external sort puts equal texts next to each
other, and the window operator compares whole neighbouring texts to find the
runs. Only DataFrame functions are used.

A key that more rows share than half a task's part of the table is hot; there
are at most twice as many hot keys as shuffle partitions. They are counted
before the sort, and their rows are cut into slices by a hash of the
identifier, so that no task takes a whole hot run. The slices of a hot run are
then joined by comparing the whole texts of their winners, one row a slice and
text; all other runs are decided by the sort alone.

Defined results: null text counts as empty; empty texts are equal to each
other and to texts of white space only; of rows with equal identifier and text
one stays; a null identifier is smaller than all others; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import partitions, stored

#: The white space that doesn't count: \x20 and \x09 to \x0D.
BLANKS = " \t\n\x0b\x0c\r"
HEAD = 32
#: A run of fewer rows is never cut.
LEAST_HOT = 32


def normalised(text):
    out = F.coalesce(text, F.lit(""))
    for blank in BLANKS:
        out = F.replace(out, F.lit(blank), F.lit(""))
    return out


def content_sort(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of df, from neighbours in the sort: doc_id, points, mix, slices, slice, place, slice_keep, slice_size, text_sha256, norm.

    place counts a run's rows within a slice, the one that stays first. slices
    is null where the run is whole; norm is given for the first rows of slices.
    """
    n = partitions(df.sparkSession)
    rows = df.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("norm"), F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("points"))
    rows = rows.withColumn("mix", F.xxhash64("norm"))
    limit = max(LEAST_HOT, -(-df.count() // (2 * n)))
    hot = rows.groupBy("mix").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > limit)  # fewer than 2 * n
    hot = stored(hot.select("mix", F.ceil(F.col("rows") / limit).cast("int").alias("slices")))
    keyed = rows.join(F.broadcast(hot), "mix", "left")
    keyed = keyed.select("doc_id", "points", "norm", "mix", "slices", F.substring("norm", 1, HEAD).alias("head"), F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("slices")).cast("int"), F.lit(0)).alias("slice"))
    ranged = keyed.repartitionByRange(n, "head", "mix", "slice")
    run = Window.partitionBy("head", "mix", "slice", "norm").orderBy(F.desc("points"), "doc_id")
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    marked = ranged.select("doc_id", "points", "mix", "slices", "slice", "norm", F.row_number().over(run).alias("place"), F.first("doc_id").over(whole).alias("slice_keep"), F.count(F.lit(1)).over(whole).alias("slice_size"))
    return marked.withColumn("text_sha256", F.sha2(F.col("norm").cast("binary"), 256)).withColumn("norm", F.when(F.col("slices").isNotNull() & (F.col("place") == 1), F.col("norm")))


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of df: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal normalised texts the row with the most code points stays, then
    the smallest identifier.
    """
    sorted_rows = stored(content_sort(df, id_col, text_col))
    winners = sorted_rows.where("norm IS NOT NULL")  # one for each slice of a hot run
    joined = winners.groupBy("norm").agg(F.min_by("doc_id", F.struct(-F.col("points"), "doc_id")).alias("keep"), F.sum("slice_size").alias("size"), F.collect_list(F.struct("mix", "slice", "text_sha256")).alias("slices"))
    across = joined.select("keep", "size", F.explode("slices").alias("s")).select("keep", "size", "s.*")
    out = sorted_rows.drop("norm").join(F.broadcast(across), ["mix", "slice", "text_sha256"], "left")
    keep = F.when(F.col("size").isNotNull(), F.col("keep")).otherwise(F.col("slice_keep"))
    return out.select("doc_id", keep.alias("keep_id"), F.coalesce("size", "slice_size").cast("long").alias("group_size"), ((F.col("place") == 1) & F.col("doc_id").eqNullSafe(keep)).alias("kept"), "text_sha256")


ORACLE = r"""
WITH n AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm FROM documents
), w AS (
  SELECT doc_id, norm, first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(t) DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM n
)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM w
"""
