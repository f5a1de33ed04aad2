"""Job logs in batch and as a stream, configuration, and retries."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from folioframe.operators import jobs, reports
from folioframe.plans.config import Config, truth
from folioframe.streaming.jobs import job_states, live_dashboard

SCHEMA = "job_id string, seq long, ts timestamp, filename string, status string, progress double, error string, output_files array<string>, metrics map<string,double>"


def event(job, seq, status, progress, error=None, files=None, metrics=None):
    return (job, seq, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seq), f"{job}.docx", status, progress, error, files or [], metrics or {})


LOG = [
    event("a", 0, "pending", 0.0), event("a", 1, "processing", 10.0), event("a", 2, "extracting", 30.0, metrics={"images": 1.0}), event("a", 3, "converting", 70.0, error=""), event("a", 4, "completed", 100.0, files=["a.zip", "a.docx"], metrics={"tables": 2.0, "images": 3.0}),
    event("b", 0, "pending", 0.0), event("b", 2, "failed", 30.0, error="boom"), event("c", 0, "pending", 0.0), event("c", 1, "cancelled", 5.0), event("c", 5, "completed", 100.0), event("d", 0, "pending", 0.0), event("d", 7, "converting", 70.0),
]


@pytest.fixture(scope="module")
def state(spark):
    return jobs.fold(spark.createDataFrame(LOG, SCHEMA))


def test_fold(state):
    got = {r.job_id: r for r in state.collect()}
    assert {k: (r.status, r.progress) for k, r in got.items()} == {"a": ("completed", 100.0), "b": ("failed", 30.0), "c": ("cancelled", 5.0), "d": ("converting", 70.0)}
    assert got["a"].metrics == {"images": 3.0, "tables": 2.0} and got["a"].output_files == ["a.zip", "a.docx"] and got["a"].error is None and got["b"].error == "boom"
    assert got["c"].updated_at.second == 5 and got["c"].completed_at.second == 1 and got["d"].completed_at is None


def test_reports(state):
    (row,) = reports.dashboard(state).collect()
    assert tuple(row)[:6] == (4, 1, 1, 1, 3, 2) and row.avg_seconds == 4.0
    assert [r.job_id for r in reports.list_jobs(state, "failed").collect()] == ["b"]
    assert len(reports.recent(state, 2).collect()) == 2 and reports.get_job(state, "a").count() == 1
    assert [r.file for r in reports.output_files(state).collect()] == ["a.zip"]
    assert '"total":4' in reports.export_dashboard(state).first().json
    with pytest.raises(ValueError):
        reports.list_jobs(state, "nonsense")


def test_create_and_cancel(spark):
    made = jobs.created(spark.createDataFrame([("x.docx",)], "filename string"), F.current_timestamp()).first()
    assert len(made.job_id) == 8 and made.status == "pending"
    log = spark.createDataFrame(LOG, SCHEMA)
    assert [r.job_id for r in jobs.cancel(log, ["a", "d"], F.lit(dt.datetime(2024, 1, 2))).collect()] == ["d"]


def test_stream(spark, tmp_path):
    spark.createDataFrame(LOG[:8], SCHEMA).coalesce(1).write.parquet(str(tmp_path / "log"))
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "log"))
    q = job_states(stream).writeStream.outputMode("update").format("memory").queryName("states").option("checkpointLocation", str(tmp_path / "c1")).start()
    boards = []
    d = live_dashboard(stream, lambda board, batch: boards.extend(board.collect())).option("checkpointLocation", str(tmp_path / "c2")).start()
    try:
        q.processAllAvailable()
        d.processAllAvailable()
        assert {r.job_id: r.status for r in spark.table("states").collect()} == {"a": "completed", "b": "failed", "c": "pending"}
        a = next(r for r in spark.table("states").collect() if r.job_id == "a")
        assert a.metrics == {"images": 3.0, "tables": 2.0} and a.output_files == ["a.zip", "a.docx"] and a.completed_at.second == 4
        assert boards[-1] == reports.dashboard(jobs.fold(spark.createDataFrame(LOG[:8], SCHEMA))).first(), "jobs are counted, not events"
    finally:
        q.stop()
        d.stop()


def test_config(tmp_path):
    c = Config.from_dict({"docx": {"min_image_size": 7}, "unknown": 1, "year": "1999"})
    assert (c.min_image_size, c.year) == (7, "1999")
    c.save(str(tmp_path / "c.json"))
    assert Config.from_file(str(tmp_path / "c.json")) == c
    assert Config.from_env(env={"FOLIOFRAME_EXTRACT_IMAGES": "no", "FOLIOFRAME_MIN_IMAGE_SIZE": "3"}) == Config(extract_images=False, min_image_size=3)
    assert [truth(x) for x in ("true", "1", "YES", "0", "")] == [True, True, True, False, False]
