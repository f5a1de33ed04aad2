"""Validation reports as workbooks: three sheets for each document, as rows and as XLSX files."""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.reports import ordered_findings
from ..operators.validation import SEVERITIES

# The sheets' column names.
ERROR_COLUMNS = ["Error #", "Severity", "XML File", "Line Number", "Column", "Error Type", "Description"]
CHECK_COLUMNS = ["#", "XML File", "Line", "Fix Type", "Description", "Reason", "Suggestion"]
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_DOC = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PKG = "http://schemas.openxmlformats.org/package/2006"


def error_rows(found: DataFrame) -> DataFrame:
    """doc_id and the columns of the error sheet; what is not known is N/A."""
    line = F.coalesce(F.col("line_number").cast("string"), F.lit("N/A"))
    values = [F.col("row_no").cast("string"), F.col("severity"), F.col("doc_id"), line, F.lit("N/A"), F.col("error_type"), F.col("error_description")]
    return ordered_findings(found).select("doc_id", "row_no", *(v.alias(n) for v, n in zip(values, ERROR_COLUMNS, strict=True)))


def check_rows(checks: DataFrame) -> DataFrame:
    """doc_id and the columns of the sheet of checks by hand."""
    number = F.row_number().over(Window.partitionBy("doc_id").orderBy("node_id"))
    line = F.coalesce(F.col("line_number").cast("string"), F.lit("N/A"))
    values = [number.cast("string"), F.col("doc_id"), line, F.col("fix_type"), F.col("fix_description"), F.col("verification_reason"), F.col("suggestion")]
    return checks.select("doc_id", number.alias("row_no"), *(v.alias(n) for v, n in zip(values, CHECK_COLUMNS, strict=True)))


def summary_rows(found: DataFrame, documents: DataFrame) -> DataFrame:
    """(doc_id, ord, name, n): severities with zeros, their total, then error types by falling count, ties by first appearance."""
    names = F.explode(F.array(*(F.struct(F.lit(i).alias("ord"), F.lit(s).alias("name")) for i, s in enumerate(SEVERITIES))))
    every = documents.select(F.col("doc_id").cast("string").alias("doc_id"), names.alias("s")).select("doc_id", "s.ord", "s.name")
    counts = found.groupBy("doc_id", F.col("severity").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    severities = every.join(counts, ["doc_id", "name"], "left").select("doc_id", "ord", "name", F.coalesce("n", F.lit(0)).alias("n"))
    total = severities.groupBy("doc_id").agg(F.sum("n").alias("n")).select("doc_id", F.lit(3).alias("ord"), F.lit("Total").alias("name"), "n")
    kinds = ordered_findings(found).groupBy("doc_id", "error_type").agg(F.count(F.lit(1)).alias("n"), F.min("row_no").alias("first"))
    order = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("n"), "first"))
    return severities.unionByName(total).unionByName(kinds.select("doc_id", (order + 3).alias("ord"), F.col("error_type").alias("name"), "n"))


def workbook(sheets: dict[str, list[list[str]]]) -> bytes:
    """A minimal XLSX file of text cells."""

    def sheet(rows):
        body = "".join("<row>" + "".join(f'<c t="inlineStr"><is><t xml:space="preserve">{escape(str(c if c is not None else ""))}</t></is></c>' for c in row) + "</row>" for row in rows)
        return f'<worksheet xmlns="{_MAIN}"><sheetData>{body}</sheetData></worksheet>'

    out = io.BytesIO()
    n = range(1, len(sheets) + 1)
    files = {
        "[Content_Types].xml": f'<Types xmlns="{_PKG}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
        + "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in n) + "</Types>",
        "_rels/.rels": f'<Relationships xmlns="{_PKG}/relationships"><Relationship Id="r1" Type="{_DOC}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{_MAIN}" xmlns:r="{_DOC}"><sheets>' + "".join(f'<sheet name="{escape(s)}" sheetId="{i}" r:id="r{i}"/>' for i, s in zip(n, sheets, strict=True)) + "</sheets></workbook>",
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{_PKG}/relationships">' + "".join(f'<Relationship Id="r{i}" Type="{_DOC}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in n) + "</Relationships>",
        **{f"xl/worksheets/sheet{i}.xml": sheet(rows) for i, rows in zip(n, sheets.values(), strict=True)},
    }
    with zipfile.ZipFile(out, "w") as z:
        for name, text in files.items():
            z.writestr(zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0)), text, zipfile.ZIP_DEFLATED)
    return out.getvalue()


def reports(found: DataFrame, checks: DataFrame, documents: DataFrame, generated: str = "") -> DataFrame:
    """(doc_id, xlsx): a workbook for each of documents (doc_id). A document's own findings are gathered, no more."""

    def gathered(rows: DataFrame, columns: list[str], order: str, name: str) -> DataFrame:
        cells = F.struct(F.col(order).alias("o"), F.array(*(F.col(c).cast("string") for c in columns)).alias("c"))
        return rows.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(cells)), lambda x: x["c"]).alias(name))

    rows = documents.select(F.col("doc_id").cast("string").alias("doc_id"))
    for part in (gathered(error_rows(found), ERROR_COLUMNS, "row_no", "errors"), gathered(summary_rows(found, documents), ["name", "n"], "ord", "summary"), gathered(check_rows(checks), CHECK_COLUMNS, "row_no", "checks")):
        rows = rows.join(part, "doc_id", "left")

    def build(batches):
        for batch in batches:
            for r in batch.to_pylist():
                summary = r["summary"] or []
                passed = not any(name == "Error" and n != "0" for name, n in summary)
                head = [["Validation Summary"], [f"Generated: {generated}"], [f"XML File: {r['doc_id']}"], [], [f"Validation Status: {'PASSED' if passed else 'FAILED'}"], [], ["Severity", "Count"]]
                sheets = {"Validation Errors": [ERROR_COLUMNS, *(r["errors"] or [])], "Summary": [*head, *summary[:4], [], ["Error Type", "Count"], *summary[4:]], "Manual Verification": [CHECK_COLUMNS, *(r["checks"] or [])]}
                yield pa.RecordBatch.from_pylist([{"doc_id": r["doc_id"], "xlsx": workbook(sheets)}], schema=pa.schema([("doc_id", pa.string()), ("xlsx", pa.binary())]))

    return rows.mapInArrow(build, "doc_id string, xlsx binary")
