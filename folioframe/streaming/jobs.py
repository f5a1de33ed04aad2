"""The job log as a stream: state by job, and a live dashboard."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.reports import TERMINAL, dashboard

_FIELDS = "filename string, status string, progress double, created_at timestamp, updated_at timestamp, completed_at timestamp, error string, output_files array<string>, metrics map<string,double>"
OUTPUT, STATE = f"job_id string, {_FIELDS}", _FIELDS
NAMES = [x.split(" ")[0] for x in _FIELDS.split(", ")]


def step(state: dict, row) -> dict:
    """The state after one event; a terminal state stays, empty values don't overwrite, metrics are merged."""
    out = dict(state)
    out["created_at"] = row.ts if out["created_at"] is None else min(out["created_at"], row.ts)
    out["updated_at"] = row.ts if out["updated_at"] is None else max(out["updated_at"], row.ts)
    out["filename"] = out["filename"] or row.filename
    if out["status"] in TERMINAL:
        return out
    for name in ("status", "progress", "error"):
        value = getattr(row, name)
        if value is not None and value == value and value != "":
            out[name] = value
    if row.output_files is not None and len(row.output_files):
        out["output_files"] = list(row.output_files)
    out["metrics"] = {**(out["metrics"] or {}), **dict(row.metrics or {})}
    if out["status"] in TERMINAL:
        out["completed_at"] = row.ts
    return out


def job_states(events: DataFrame, watermark: str = "1 hour", keep_hours: float = 24) -> DataFrame:
    """A row for each job that a micro-batch touches: its state after the batch.

    State is kept by job_id until the watermark is keep_hours past the job's
    last event. Frames are taken one by one; a job's events count in the order
    of their frames, sorted by (ts, seq) in each.
    """

    def advance(key: tuple, frames: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        if held.hasTimedOut:
            held.remove()
            return
        state = dict(zip(NAMES, held.get if held.exists else [None] * len(NAMES), strict=True))
        for frame in frames:
            for row in frame.sort_values(["ts", "seq"]).itertuples():
                state = step(state, row)
        held.update(tuple(None if state[n] is pd.NaT else state[n] for n in NAMES))
        held.setTimeoutTimestamp(int(max(state["updated_at"].timestamp() * 1000, held.getCurrentWatermarkMs()) + keep_hours * 3_600_000))
        yield pd.DataFrame([{"job_id": key[0], **{n: state[n] for n in NAMES}}])

    return events.withWatermark("ts", watermark).groupBy("job_id").applyInPandasWithState(advance, OUTPUT, STATE, "update", GroupStateTimeout.EventTimeTimeout)


def latest_jobs(events: DataFrame) -> DataFrame:
    """One row a job for the complete output mode: what the dashboard needs of its latest state."""
    order = F.struct("ts", "seq")
    ended, said = F.col("status").isin(TERMINAL), F.coalesce("status", F.lit("")) != ""
    metric = lambda name: F.max_by(F.try_element_at("metrics", F.lit(name)), F.when(F.try_element_at("metrics", F.lit(name)).isNotNull(), order))
    return events.groupBy("job_id").agg(
        F.coalesce(F.min_by("status", F.when(ended, order)), F.max_by("status", F.when(said, order))).alias("status"), F.min("ts").alias("created_at"), F.min(F.when(ended, F.col("ts"))).alias("completed_at"),
        F.create_map(F.lit("images"), metric("images"), F.lit("tables"), metric("tables")).alias("metrics"),
    )


def live_dashboard(events: DataFrame, show: Callable[[DataFrame, int], None]) -> DataStreamWriter:
    """A stream that hands the dashboard over all jobs to show(dashboard, batch) after each micro-batch."""
    return latest_jobs(events).writeStream.outputMode("complete").foreachBatch(lambda jobs, batch: show(dashboard(jobs), batch))
