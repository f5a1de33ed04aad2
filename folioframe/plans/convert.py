"""The conversion: documents, elements, XML, findings, packages, results.

Elements, XML and nodes are stored once, as everything else reads them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.assembly import PROLOG, assemble, figure_file
from ..operators.numbering import numbered
from ..operators.reports import document_counts
from ..operators.validation import findings, validity, verifications
from ..sources.docx import Docx, read_docx
from ..sources.packages import book_metadata, build_packages, package_xml
from ..sources.xml import indented, walk_xml
from ..storage import stored
from .config import Config


@dataclass
class Conversion:
    """Tables of a conversion."""

    documents: DataFrame
    elements: DataFrame
    xml: DataFrame
    nodes: DataFrame
    findings: DataFrame
    verifications: DataFrame
    validity: DataFrame
    images: DataFrame
    packages: DataFrame
    results: DataFrame
    errors: DataFrame


def pretty_printed(xml: DataFrame) -> DataFrame:
    """(doc_id, xml) with elements on lines of their own, under the prolog."""
    return indented(xml).select("doc_id", F.concat(F.lit(PROLOG), "pretty", F.lit("\n")).alias("xml"))


def convert(docx: Docx, config: Config | None = None) -> Conversion:
    """All tables of documents. Every occurrence of an image is a figure with a file of its own."""
    config = config or Config()
    documents, elements = stored(docx.documents()), stored(docx.elements())
    related = docx.images().select("doc_id", "rel_id", "media_name", F.col("filename").alias("original"), "content_type", "width", "height", "data")
    named = elements.join(related.select("doc_id", "rel_id", "media_name"), ["doc_id", "rel_id"], "left")
    good = documents.join(docx.errors().select("doc_id"), "doc_id", "left_anti")
    xml = stored(pretty_printed(assemble(named, good, config.year)))
    nodes = stored(walk_xml(xml))
    found = findings(nodes, xml)
    figures = numbered(named).where("kind = 'image'").withColumn("filename", figure_file(F.col("elem_id"), F.regexp_extract(F.coalesce("media_name", F.lit("")), r"\.([^./]*)$", 1)))
    images = figures.select("doc_id", "rel_id", "filename", "caption", F.lit(None).cast("string").alias("alt_text")).join(related.drop("media_name"), ["doc_id", "rel_id"])
    counts = document_counts(elements)
    packages = build_packages(xml, images, book_metadata(good, counts))
    packages = packages if config.create_package else packages.limit(0)
    verdict = validity(found, good)
    results = good.select("doc_id", "stem", "title").join(counts, "doc_id", "left").join(verdict, "doc_id", "left").na.fill(0).withColumn("success", F.lit(True))
    return Conversion(good, elements, xml, nodes, found, verifications(nodes), verdict, images, packages, results, docx.errors())


def convert_path(spark: SparkSession, path: str, config: Config | None = None) -> Conversion:
    config = config or Config()
    options = {"extract_images": config.extract_images, "extract_tables": config.extract_tables, "preserve_formatting": config.preserve_formatting, "min_side": config.min_image_size}
    return convert(read_docx(spark, path, **options), config)


def validate_packages(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(findings, validity) of package or XML files."""
    files = package_xml(spark.read.format("binaryFile").load(path))
    docs = files.select(F.col("path").alias("doc_id"), F.coalesce("xml", F.lit("")).alias("xml"))
    docs = stored(docs)
    found = findings(stored(walk_xml(docs)), docs)
    return found, validity(found, docs)


def results_json(results: DataFrame) -> DataFrame:
    return results.select("doc_id", F.to_json(F.struct("*")).alias("json"))
