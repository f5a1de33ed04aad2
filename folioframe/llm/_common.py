"""Helpers that the operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import shared_dir, stored

__all__ = ["hot_limit", "id_bytes", "map_slices", "partitions", "shared_dir", "slices", "spread_join", "stored", "table"]

#: A key with fewer rows is never hot.
LEAST_HOT = 64


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hot_limit(spark: SparkSession, rows: int) -> int:
    """Rows from which on a key is hot: half a task's part. So there are fewer hot keys than twice the partitions."""
    return max(LEAST_HOT, -(-rows // (2 * partitions(spark))))


def spread_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join of left with right, which has one row a key, where few keys may hold much of left.

    Their rows of right, fewer than twice the partitions, are broadcast; the
    others meet by a shuffle. left is read several times.
    """
    limit = hot_limit(left.sparkSession, left.count())
    frequent = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows of the key")).where(F.col("rows of the key") > limit).select(*keys)
    hot = stored(right.join(F.broadcast(frequent), keys, "left_semi").withColumn("is hot", F.lit(True)))
    tagged = left.join(F.broadcast(hot), keys, "left")
    columns = [*left.columns, *(c for c in right.columns if c not in keys)]
    cold = tagged.where(F.col("is hot").isNull()).select(left.columns).join(right, keys)
    return tagged.where(F.col("is hot").isNotNull()).select(columns).unionByName(cold.select(columns))


def id_bytes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, data): the identifier and the text's UTF-8 bytes, null counted as empty. Other columns don't matter."""
    return df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("data"))


def slices(batches: Iterator[pa.RecordBatch], column: str = "data", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about `most` bytes of the column, or one row."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).to_pylist()
        start = total = 0
        for i, n in enumerate(sizes):
            if total and total + (n or 0) > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n or 0
        if start < len(sizes):
            yield batch.slice(start)


def map_slices(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, most: int = 4 << 20) -> DataFrame:
    """mapInArrow over bounded slices of df, whose column data holds bytes."""

    def run(batches):
        for part in slices(batches, most=most):
            yield function(part)

    return df.mapInArrow(run, schema)
