"""The job log as a stream with state variables, timers, and a dashboard of changes.

A job's events may come out of order. What the watermark has passed is folded
into one state; later events are kept until it passes them, so that the state
after each batch is the one that the batch fold gives, and what is kept for a
job does not grow with its log. A timer removes all of it keep_hours after the
job's last event.

Each row says what the job adds to the dashboard's sums now and what it added
before, so that the dashboard follows from the changes of a batch alone; its
sums are one row for each batch, written before they are shown.

Streams need the RocksDB state store: stateful(spark) sets it.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle

from ..operators.jobs import verdict
from ..operators.reports import IN_PROGRESS, TERMINAL

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SUMS = ["total", "completed", "failed", "in_progress", "images", "tables", "seconds"]
FLAGS = ["skipped", "repeated", "back"]
_EVENT = "ts bigint, seq bigint, filename string, status string, progress double, error string, files string, metrics string"
_STATE = "filename string, status string, progress double, created bigint, updated bigint, completed bigint, error string, files string, metrics string, skipped bigint, repeated bigint, back bigint"
_SHOWN = ", ".join(f"{c} double" for c in SUMS)
OUTPUT = (
    "job_id string, filename string, status string, progress double, created_at timestamp, updated_at timestamp, completed_at timestamp, error string, output_files array<string>, metrics map<string,double>, "
    + ", ".join(f"{c} bigint" for c in FLAGS) + ", " + ", ".join(f"{c} double" for c in SUMS) + ", " + ", ".join(f"was_{c} double" for c in SUMS)
)
_NAMES = [x.split()[0] for x in _STATE.split(", ")]
_EVENTS = [x.split()[0] for x in _EVENT.split(", ")]


def stateful(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    return spark


def after(state: dict, event: dict) -> dict:
    """The state after one event, in the order of (ts, seq)."""
    out = dict(state)
    out["created"] = event["ts"] if out["created"] is None else min(out["created"], event["ts"])
    out["updated"] = event["ts"] if out["updated"] is None else max(out["updated"], event["ts"])
    out["filename"] = out["filename"] or event["filename"]
    if event["status"]:
        said = verdict(out["status"], event["status"])
        if said in FLAGS:
            out[said] += 1
    if event["metrics"] != "{}":  # merged even after the end, as in the batch fold
        out["metrics"] = json.dumps({**json.loads(out["metrics"]), **json.loads(event["metrics"])})
    if out["status"] in TERMINAL:
        return out
    for name in ("status", "progress", "error"):
        if event[name] is not None and event[name] != "":
            out[name] = event[name]
    if event["files"] != "[]":
        out["files"] = event["files"]
    if out["status"] in TERMINAL:
        out["completed"] = event["ts"]
    return out


def adds(state: dict) -> dict[str, float]:
    """What a job adds to the dashboard's sums."""
    metrics, done = json.loads(state["metrics"]), state["status"] == "completed"
    return {
        "total": 1.0, "completed": float(done), "failed": float(state["status"] == "failed"), "in_progress": float(state["status"] in IN_PROGRESS), "images": metrics.get("images") or 0.0, "tables": metrics.get("tables") or 0.0,
        "seconds": (state["completed"] - state["created"]) / 1e6 if done else 0.0,
    }


def _plain(value):
    return None if value is None or (not isinstance(value, list | dict | str) and pd.isna(value)) else value


class JobTracker(StatefulProcessor):
    """State variables of a job: settled (its state up to the watermark), open (events after it), shown (what it added to the dashboard)."""

    def __init__(self, keep_hours: float = 24) -> None:
        self.keep_ms = int(keep_hours * 3_600_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.settled = handle.getValueState("settled", _STATE)
        self.open = handle.getListState("open", _EVENT)
        self.shown = handle.getValueState("shown", _SHOWN)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        events = [dict(zip(_EVENTS, e, strict=True)) for e in self.open.get()]
        for frame in rows:
            events += [{k: _plain(v) for k, v in zip(_EVENTS, row, strict=True)} for row in frame[_EVENTS].itertuples(index=False)]
        events.sort(key=lambda e: (e["ts"], e["seq"]))
        held = self.settled.get()
        state = dict(zip(_NAMES, held, strict=True)) if held else {**dict.fromkeys(_NAMES), "files": "[]", "metrics": "{}", **dict.fromkeys(FLAGS, 0)}
        late = [e for e in events if e["ts"] > watermark]
        for e in events[: len(events) - len(late)]:
            state = after(state, e)
        if len(late) < len(events):
            self.settled.update(tuple(state.values()))
        if late:
            self.open.put([tuple(e.values()) for e in late])
        else:
            self.open.clear()
        for e in late:
            state = after(state, e)
        before = self.shown.get()
        now = adds(state)
        self.shown.update(tuple(now.values()))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(max(state["updated"], watermark) // 1000 + self.keep_ms)
        stamp = lambda us: None if us is None else pd.Timestamp(us, unit="us")
        yield pd.DataFrame([{
            "job_id": key[0], "filename": state["filename"], "status": state["status"], "progress": state["progress"], "created_at": stamp(state["created"]), "updated_at": stamp(state["updated"]), "completed_at": stamp(state["completed"]), "error": state["error"],
            "output_files": json.loads(state["files"]), "metrics": json.loads(state["metrics"]), **{c: state[c] for c in FLAGS}, **now, **{f"was_{c}": v for c, v in zip(SUMS, before or [0.0] * len(SUMS), strict=True)},
        }])

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.settled.clear()
        self.open.clear()
        self.shown.clear()
        return iter(())


def tracked(events: DataFrame, watermark: str = "1 hour", keep_hours: float = 24) -> DataFrame:
    """A row for each job that a micro-batch touches: its state, its flags, and what it adds and added to the dashboard.

    Events later than the watermark are dropped.
    """
    none = F.create_map().cast("map<string,double>")
    rows = events.withWatermark("ts", watermark).select(
        "job_id", F.col("ts").alias("at"), F.unix_micros("ts").alias("ts"), "seq", "filename", "status", "progress", "error", F.to_json(F.coalesce("output_files", F.array().cast("array<string>"))).alias("files"), F.to_json(F.coalesce("metrics", none)).alias("metrics"),
    )
    return rows.groupBy("job_id").transformWithStateInPandas(JobTracker(keep_hours), OUTPUT, "Update", "EventTime")


def change_dashboard(events: DataFrame, folder: str, show: Callable[[DataFrame, int], None], **options) -> DataStreamWriter:
    """A stream that shows the dashboard after each micro-batch, from the changes of that batch and the sums before it.

    folder keeps the sums, a row for each batch; a batch that is run again gives the same sums.
    """
    spark = events.sparkSession

    def update(changes: DataFrame, batch: int) -> None:
        if batch:
            sums = spark.read.schema(_SHOWN).parquet(f"{folder}/batch-{batch - 1}")
        else:
            sums = spark.createDataFrame([tuple([0.0] * len(SUMS))], _SHOWN)
        moved = changes.select(*((F.col(c) - F.col(f"was_{c}")).alias(c) for c in SUMS))
        total = sums.unionByName(moved).agg(*(F.sum(c).alias(c) for c in SUMS))
        total.coalesce(1).write.mode("overwrite").parquet(f"{folder}/batch-{batch}")
        now = spark.read.schema(_SHOWN).parquet(f"{folder}/batch-{batch}")
        mean = F.when(F.col("completed") > 0, F.col("seconds") / F.col("completed")).otherwise(0.0)
        show(now.select(*(F.col(c).cast("bigint").alias(c) for c in SUMS[:-1]), mean.alias("avg_seconds")), batch)

    return tracked(events, **options).writeStream.outputMode("update").foreachBatch(update)
