"""The state of jobs, folded from their event log."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .reports import TERMINAL

# The states and progress that a conversion goes through.
STAGES = [("pending", 0.0), ("processing", 10.0), ("extracting", 30.0), ("converting", 70.0), ("completed", 100.0)]


def created(files: DataFrame, at) -> DataFrame:
    """First events (pending) of uploaded files (filename), with a new id of 8 characters each."""
    none = F.lit(None)
    return files.select(F.substring(F.expr("uuid()"), 1, 8).alias("job_id"), F.lit(0).cast("long").alias("seq"), at.alias("ts"), "filename", F.lit("pending").alias("status"), F.lit(0.0).alias("progress"), none.cast("string").alias("error"), F.array().cast("array<string>").alias("output_files"), F.create_map().cast("map<string,double>").alias("metrics"))


def parsed_metrics(text):
    """Metrics written as a JSON object of numbers, as a map; null where it is none."""
    return F.from_json(text, "map<string,double>")


def fold(events: DataFrame) -> DataFrame:
    """The latest state of each job by (ts, seq).

    Null and empty values don't overwrite; metrics are merged, later ones win;
    a terminal state stays, whatever comes after it; every event moves
    updated_at.
    """
    order = F.struct("ts", "seq")
    first_end = F.min(F.when(F.col("status").isin(TERMINAL), order))
    ends = events.groupBy("job_id").agg(first_end.alias("ended"))
    # one shuffle on job_id serves both aggregations
    rows = events.join(ends, "job_id").withColumn("order", order).withColumn("live", F.col("ended").isNull() | (F.col("order") <= F.col("ended")))

    def latest(value, when=None):
        ok = F.col("live") & value.isNotNull()
        return F.max_by(F.when(ok if when is None else ok & when, value), F.when(ok if when is None else ok & when, F.col("order")))

    merged = F.aggregate(F.array_sort(F.collect_list(F.when(F.size(F.coalesce("metrics", F.create_map().cast("map<string,double>"))) > 0, F.struct("order", F.map_entries("metrics").alias("m"))))), F.create_map().cast("map<string,double>"), lambda acc, x: F.map_concat(F.map_filter(acc, lambda k, _: ~F.exists(x["m"], lambda e: e["key"] == k)), F.map_from_entries(x["m"])))
    return rows.groupBy("job_id").agg(
        F.min_by("filename", "order").alias("filename"), latest(F.col("status")).alias("status"), latest(F.col("progress")).alias("progress"), F.min("ts").alias("created_at"), F.max("ts").alias("updated_at"),
        F.min(F.when(F.col("status").isin(TERMINAL), F.col("ts"))).alias("completed_at"), latest(F.col("error"), F.col("error") != "").alias("error"), latest(F.col("output_files"), F.size("output_files") > 0).alias("output_files"), merged.alias("metrics"),
    )


def cancel(events: DataFrame, job_ids: list[str], at) -> DataFrame:
    """Events that cancel jobs which have not ended."""
    state = fold(events).where(F.col("job_id").isin(job_ids) & ~F.col("status").isin(TERMINAL))
    return state.select("job_id", F.lit(1 << 40).alias("seq"), at.alias("ts"), "filename", F.lit("cancelled").alias("status"), "progress", F.lit(None).cast("string").alias("error"), F.array().cast("array<string>").alias("output_files"), F.create_map().cast("map<string,double>").alias("metrics"))


#: Place of each state in the sequence.
RANK = {name: i for i, (name, _) in enumerate(STAGES)}


def verdict(before: str | None, after: str) -> str:
    """What a step from one state to the next is, by the sequence of stages."""
    if before in TERMINAL:
        return "after the end"
    if after in TERMINAL and after not in RANK:
        return "stopped"
    if after not in RANK or (before is not None and before not in RANK):
        return "unknown"
    step = RANK[after] - (RANK[before] if before is not None else -1)
    return "repeated" if step == 0 else "next" if step == 1 else "skipped" if step > 1 else "back"


def transitions(events: DataFrame) -> DataFrame:
    """(job_id, seq, ts, before, status, verdict): each event that names a state, held against the sequence of stages.

    Events count by (ts, seq); the first terminal state stays the one before all that follows.
    """
    rows = events.where(F.coalesce("status", F.lit("")) != "").select("job_id", "seq", "ts", "status")
    by = Window.partitionBy("job_id").orderBy("ts", "seq")
    earlier = by.rowsBetween(Window.unboundedPreceding, -1)
    ended = F.first(F.when(F.col("status").isin(TERMINAL), F.col("status")), ignorenulls=True).over(earlier)
    rows = rows.withColumn("before", F.coalesce(ended, F.lag("status").over(by)))
    rank = F.create_map(*(F.lit(x) for pair in RANK.items() for x in pair))
    to, since = F.try_element_at(rank, F.col("status")), F.when(F.col("before").isNull(), -1).otherwise(F.try_element_at(rank, F.col("before")))
    step = to - since
    said = (
        F.when(F.col("before").isin(TERMINAL), "after the end").when(F.col("status").isin(TERMINAL) & to.isNull(), "stopped").when(step.isNull(), "unknown")
        .when(step == 0, "repeated").when(step == 1, "next").when(step > 1, "skipped").otherwise("back")
    )
    return rows.select("job_id", "seq", "ts", "before", "status", said.alias("verdict"))
