"""Ordered elements, tables and job logs out of plain tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .xml import tag_scan


#: Page numbers of a slice of a host's elements.
PAGES = 64


def page_elements(pages: DataFrame) -> DataFrame:
    """Elements of each host's pages, ordered by page_id and i: h1 as level 1, li as bullets, p as paragraphs. slice cuts hosts by pages."""
    tags = tag_scan(pages)
    return tags.select(F.col("host").alias("doc_id"), F.lit("paragraph").alias("kind"), "text", F.when(F.col("tag") == "h1", 1).otherwise(0).alias("level"), F.when(F.col("tag") == "li", "bullet").alias("list_type"), "page_id", "i", F.floor(F.col("page_id") / PAGES).alias("slice"))


def conversation_elements(turns: DataFrame) -> DataFrame:
    """Elements of conversations: system turns as level 1, user turns as level 2, the rest as body."""
    level = F.when(F.col("role") == "system", 1).when(F.col("role") == "user", 2).otherwise(0)
    return turns.select(F.col("conv_id").cast("string").alias("doc_id"), F.col("turn").cast("int").alias("pos"), F.lit("paragraph").alias("kind"), "text", level.alias("level"), F.lit(None).cast("string").alias("list_type"))


def text_lines(documents: DataFrame) -> DataFrame:
    """(doc_id, pos, line): the lines of each text."""
    return documents.select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("pos", "line"))


def text_elements(documents: DataFrame) -> DataFrame:
    """Elements of texts, to number deep headings: a line's length decides its kind.

    Lines of up to 12 characters are headings of level 1 to 5, other multiples
    of 7 images, of 5 tables, of 3 list items, the rest paragraphs.
    """
    n = F.length("line")
    short = n <= 12
    kind = F.when(short, "paragraph").when(n % 7 == 0, "image").when(n % 5 == 0, "table").otherwise("paragraph")
    level = F.when(short, n % 5 + 1).otherwise(0)
    listed = F.when(~short & (n % 7 != 0) & (n % 5 != 0) & (n % 3 == 0), F.when(n % 2 == 0, "number").otherwise("bullet"))
    return text_lines(documents).select(F.col("doc_id").cast("string").alias("doc_id"), "pos", kind.alias("kind"), F.col("line").alias("text"), level.alias("level"), listed.alias("list_type"))


def event_jobs(events: DataFrame) -> DataFrame:
    """The jobs table's columns from events: the kind of event stands for the state."""
    names = F.create_map(*(F.lit(x) for x in ("purchase", "completed", "error", "failed", "click", "processing", "view", "converting", "signup", "pending")))
    status = F.coalesce(F.try_element_at(names, F.col("event_type")), F.lit("pending"))
    metrics = F.create_map(F.lit("images"), F.col("user_id").cast("double") % 7, F.lit("tables"), F.col("user_id").cast("double") % 3)
    done = F.when(status.isin("completed", "failed"), F.timestamp_seconds(F.unix_seconds(F.col("ts").cast("timestamp")) + F.col("event_id") % 100))
    return events.select(F.col("event_id").cast("string").alias("job_id"), F.concat(F.lit("file"), F.col("user_id").cast("string"), F.lit(".docx")).alias("filename"), status.alias("status"), F.col("ts").cast("timestamp").alias("created_at"), done.alias("completed_at"), metrics.alias("metrics"))


def event_log(events: DataFrame) -> DataFrame:
    """A job log from events: the user is the job."""
    names = F.create_map(*(F.lit(x) for x in ("click", "processing", "view", "converting", "signup", "pending")))
    status = F.coalesce(F.try_element_at(names, F.col("event_type")), F.lit("extracting"))
    return events.select(F.col("user_id").cast("string").alias("job_id"), F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("ts"), F.concat(F.lit("file"), F.col("user_id").cast("string")).alias("filename"), status.alias("status"), F.col("value").alias("progress"), F.lit(None).cast("string").alias("error"), F.array().cast("array<string>").alias("output_files"), F.create_map(F.col("event_type"), F.col("value")).alias("metrics"))
