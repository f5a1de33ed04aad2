"""python -m folioframe convert PATH [-o DIR] ... | validate PATH [-o DIR]"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .plans.config import Config
from .plans.convert import convert_path, results_json, validate_packages
from .sources.packages import saved_images, write_files
from .sources.workbooks import reports


def _named(rows, suffix: str):
    """(path, content) under the documents' own names."""
    name = F.regexp_replace(F.regexp_extract("doc_id", r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")
    return F.concat(name, F.lit(suffix)).alias("path"), rows


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="folioframe", description=__doc__)
    p.add_argument("action", choices=["convert", "validate"])
    p.add_argument("path", help="files, a folder or a pattern")
    p.add_argument("--out", "-o", default="output", help="a folder that all executors see")
    for name in ("package", "images", "tables"):
        p.add_argument(f"--no-{name}", action="store_true")
    p.add_argument("--json-result", action="store_true")
    p.add_argument("--quiet", "-q", action="store_true")
    o = p.parse_args(args)
    spark = SparkSession.builder.appName("folioframe").getOrCreate()
    if o.action == "validate":
        found, verdict = validate_packages(spark, o.path)
        bad = verdict.where("not is_valid").count()
        if not o.quiet:
            found.orderBy("doc_id", "node_id", "check_ord").show(100, truncate=False)
        return int(bad > 0)
    c = convert_path(spark, o.path, Config(extract_images=not o.no_images, extract_tables=not o.no_tables, create_package=not o.no_package, output_dir=o.out))
    outputs = [(c.xml, "xml", ".xml"), (reports(c.findings, c.verifications, c.documents), "xlsx", "_validation_report.xlsx")] + [(c.packages, "package", "_package.zip")] * (not o.no_package)
    for rows, column, suffix in outputs:
        path, rows = _named(rows, suffix)
        write_files(rows.select(path, F.col(column).cast("binary").alias("content")), o.out).write.format("noop").mode("overwrite").save()
    if not o.no_images:
        write_files(saved_images(c.images.withColumn("doc_id", _named(c.images, "")[0])), o.out).write.format("noop").mode("overwrite").save()
    if o.json_result:
        for row in results_json(c.results).toLocalIterator():
            print(row["json"])
    return int(c.errors.count() > 0)


if __name__ == "__main__":
    sys.exit(main())
