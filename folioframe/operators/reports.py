"""Counts, histograms, ordered reports and dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .validation import SEVERITIES

IN_PROGRESS = ["processing", "extracting", "converting", "packaging"]
TERMINAL = ["completed", "failed", "cancelled"]
STATUSES = ["pending", *IN_PROGRESS, *TERMINAL]


def document_counts(elements: DataFrame) -> DataFrame:
    """Text blocks, images, tables and chapters of each document."""
    kind = F.col("kind")
    return elements.groupBy("doc_id").agg(F.count_if(kind == "paragraph").alias("n_text"), F.count_if(kind == "image").alias("n_images"), F.count_if(kind == "table").alias("n_tables"), F.count_if((kind == "paragraph") & (F.col("level") == 1)).alias("n_chapters"))


def severity_histogram(found: DataFrame) -> DataFrame:
    """(severity, n): one row for each severity, zero too, and Total."""
    names = found.sparkSession.createDataFrame([(s,) for s in SEVERITIES], "severity string")
    counts = found.groupBy("severity").agg(F.count(F.lit(1)).alias("n"))
    rows = F.broadcast(names).join(counts, "severity", "left").select("severity", F.coalesce("n", F.lit(0)).alias("n"))
    return rows.rollup("severity").agg(F.sum("n").alias("n")).select(F.coalesce("severity", F.lit("Total")).alias("severity"), "n")


def type_histogram(found: DataFrame, order: str = "seq") -> DataFrame:
    """(error_type, n, first_seq) by falling count, ties by first appearance."""
    return found.groupBy("error_type").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first_seq")).orderBy(F.desc("n"), "first_seq")


def ordered_findings(found: DataFrame) -> DataFrame:
    """Findings with rank, counted within a document: errors, warnings, the rest; in each by node and rule."""
    rank = F.when(F.col("severity") == "Error", 0).when(F.col("severity") == "Warning", 1).otherwise(2)
    return found.withColumn("row_no", F.row_number().over(Window.partitionBy("doc_id").orderBy(rank, F.col("node_id").asc_nulls_last(), "check_ord", "error_description")))


def route(found: DataFrame) -> dict[str, DataFrame]:
    """Findings by severity; what is neither error nor warning, null too, is information."""
    return {"Error": found.where("severity = 'Error'"), "Warning": found.where("severity = 'Warning'"), "Info": found.where("coalesce(severity, 'Info') NOT IN ('Error', 'Warning')")}


def dashboard(jobs: DataFrame) -> DataFrame:
    """One row: jobs by state, images and tables of all jobs, mean seconds of completed jobs (0 if none)."""
    status = F.col("status")
    seconds = (F.unix_micros("completed_at") - F.unix_micros("created_at")) / F.lit(1e6)
    metric = lambda name: F.coalesce(F.sum(F.coalesce(F.try_element_at("metrics", F.lit(name)), F.lit(0.0))), F.lit(0.0)).cast("long")
    return jobs.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(status == "completed").alias("completed"), F.count_if(status == "failed").alias("failed"), F.count_if(status.isin(IN_PROGRESS)).alias("in_progress"),
        metric("images").alias("images"), metric("tables").alias("tables"), F.coalesce(F.avg(F.when((status == "completed") & F.col("completed_at").isNotNull(), seconds)), F.lit(0.0)).alias("avg_seconds"),
    )


def recent(jobs: DataFrame, n: int = 10) -> DataFrame:
    """The n newest jobs with their seconds, null where unfinished."""
    seconds = F.when(F.col("completed_at").isNotNull(), (F.unix_micros("completed_at") - F.unix_micros("created_at")) / F.lit(1e6))
    return jobs.select("job_id", "filename", "status", "created_at", seconds.alias("seconds")).orderBy(F.desc("created_at"), F.desc("job_id")).limit(n)


def list_jobs(jobs: DataFrame, status: str | None = None, limit: int = 50) -> DataFrame:
    """Jobs of a state, newest first."""
    if status is not None and status not in STATUSES:
        raise ValueError(f"no such status: {status}")
    rows = jobs if status is None else jobs.where(F.col("status") == status)
    return rows.orderBy(F.desc("created_at"), F.desc("job_id")).limit(limit)


def get_job(jobs: DataFrame, job_id: str) -> DataFrame:
    return jobs.where(F.col("job_id") == job_id)


def export_dashboard(jobs: DataFrame, limit: int = 1000) -> DataFrame:
    """(json): the dashboard and the newest jobs as one JSON text; at most `limit` jobs."""
    newest = list_jobs(jobs, limit=limit).agg(F.sort_array(F.collect_list(F.struct("created_at", "job_id", "status", "filename")), asc=False).alias("jobs"))
    return dashboard(jobs).select(F.struct("*").alias("stats")).crossJoin(F.broadcast(newest)).select(F.to_json(F.struct("stats", "jobs")).alias("json"))


def preview(elements: DataFrame, n: int = 10, width: int = 80) -> DataFrame:
    return elements.orderBy("doc_id", "pos").limit(n).select("doc_id", "pos", "kind", F.substring("text", 1, width).alias("text"))


def output_files(jobs: DataFrame) -> DataFrame:
    """(job_id, file): files of each job other than the uploaded one."""
    return jobs.select("job_id", "filename", F.explode("output_files").alias("file")).where("file <> filename").select("job_id", "file")
