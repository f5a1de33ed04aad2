"""The job log as a stream with state variables, against the batch fold."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from folioframe.operators import jobs, reports
from folioframe.streaming import tracker
from folioframe.streaming.tracker import change_dashboard, tracked

SCHEMA = "job_id string, seq long, ts timestamp, filename string, status string, progress double, error string, output_files array<string>, metrics map<string,double>"
START = dt.datetime(2024, 1, 1)


def log(n_jobs=12, seed=4):
    """Events of jobs, some out of order, with skipped, repeated and late stages."""
    rng = random.Random(seed)
    out = []
    for j in range(n_jobs):
        names = ["pending"] + rng.choices(["processing", "extracting", "converting", "pending", None], k=rng.randint(1, 5)) + rng.choice([["completed"], ["failed"], ["cancelled", "completed"], []])
        for i, status in enumerate(names):
            out.append((f"j{j}", i, START + dt.timedelta(seconds=10 * i + j), f"j{j}.docx", status, 10.0 * i, rng.choice(["", None, "oops"]), rng.choice([[], [f"j{j}.zip"]]), rng.choice([{}, {"images": float(i)}, {"tables": 2.0, "images": 1.0}])))
    rng.shuffle(out)
    return out


@pytest.fixture
def store(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    yield tracker.stateful(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def batches(spark, folder, parts):
    """A stream of one micro-batch for each part."""
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/{i:03d}")
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(folder))


def finished(stream):
    try:
        stream.processAllAvailable()
        return stream.recentProgress
    finally:
        stream.stop()


def test_stream_equals_the_batch_fold(store, tmp_path):
    rows = log()
    parts = [rows[i::4] for i in range(4)]
    stream = batches(store, tmp_path / "log", parts)
    seen, boards = {}, []
    q = tracked(stream).writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "c1")).foreachBatch(lambda df, _: seen.update({r.job_id: r for r in df.collect()})).start()
    finished(q)
    d = change_dashboard(stream, str(tmp_path / "sums"), lambda board, batch: boards.extend(board.collect())).option("checkpointLocation", str(tmp_path / "c2")).start()
    finished(d)
    events = store.createDataFrame(rows, SCHEMA)
    fold = {r.job_id: r for r in jobs.fold(events).collect()}
    names = ["filename", "status", "progress", "created_at", "updated_at", "completed_at", "error", "output_files", "metrics"]
    plain = lambda r: [r[n] or None for n in names]
    assert {k: plain(r) for k, r in seen.items()} == {k: plain(r) for k, r in fold.items()}
    flags = {(r.job_id, r.verdict): r.n for r in jobs.transitions(events).groupBy("job_id", "verdict").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert all(seen[j][f] == flags.get((j, f), 0) for j in fold for f in tracker.FLAGS) and any(seen[j].skipped for j in fold)
    assert len(boards) >= 4 and boards[-1] == reports.dashboard(jobs.fold(events)).first()


def test_state_is_settled_and_removed(store, tmp_path):
    """What the watermark has passed is one row for each job; a timer removes it keep_hours after the last event."""
    day = dt.timedelta(days=1)
    event = lambda job, i, at: (job, i, at, f"{job}.docx", "processing", 1.0, None, [], {})
    parts = [[event(f"j{j}", i, START + dt.timedelta(seconds=i)) for j in range(5) for i in range(20)], [event("late", 0, START + 2 * day)], [event("later", 0, START + 2 * day)], [event("last", 0, START + 5 * day)], [event("end", 0, START + 5 * day)]]
    q = tracked(batches(store, tmp_path / "log", parts)).writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "c")).foreachBatch(lambda df, _: df.count()).start()
    rows = [p["stateOperators"][0]["numRowsTotal"] for p in finished(q) if p["numInputRows"]]
    assert rows[0] >= 10 and rows[-1] <= 4, rows  # of the first jobs nothing is left


def test_verdicts():
    assert [jobs.verdict(*x) for x in [(None, "pending"), (None, "extracting"), ("pending", "processing"), ("processing", "processing"), ("converting", "processing"), ("processing", "completed"), ("converting", "completed"), ("pending", "failed"), ("failed", "pending"), ("pending", "packaging")]] == ["next", "skipped", "next", "repeated", "back", "skipped", "next", "stopped", "after the end", "unknown"]
