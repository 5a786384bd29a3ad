"""CSV and JSON sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pagetide.operators.normalize import conform, sanitize_document
from pagetide.operators.reports import export_reviews, run_scope
from pagetide.schemas import PAGE_REPORT
from pagetide.sources.landing import LANDED, REPORT_FILE

FORMATS = ("csv", "jsonl")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(
        path, header=True, escape='"', emptyValue="", nullValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def write_jsonl(df: DataFrame, path: str) -> None:
    """One object per line, keys sorted, nulls written, text unescaped."""
    df.select(*sorted(df.columns)).write.mode("overwrite").json(path, ignoreNullFields=False)


def write_page_reports(reports: DataFrame, run_dir: str, order: list[str]) -> None:
    """Page reports of one run in load order, where `read_page_reports` looks for them."""
    write_jsonl(conform(reports.orderBy(*order), PAGE_REPORT), f"{run_dir.rstrip('/')}/{REPORT_FILE}")


def export_table(
    reviews: DataFrame, apps: DataFrame, path: str, output_format: str = "csv", run_id: str | None = None
) -> dict:
    """Write the sorted, joined extract as part files in order, and count its rows on the way."""
    output_format = output_format.lower()
    if output_format not in FORMATS:
        raise ValueError("export format must be 'csv' or 'jsonl'")
    written = Observation("export")
    rows = export_reviews(run_scope(reviews, run_id), apps).observe(written, F.count(F.lit(1)).alias("rows"))
    (write_csv if output_format == "csv" else write_jsonl)(rows, path)
    return {"output_path": path, "format": output_format, "run_id": run_id, "review_count": written.get["rows"]}


def write_sections(sections: dict[str, DataFrame], path: str) -> None:
    """A report as one folder of JSON lines per section, so that per-app lists may be of any length."""
    for name, rows in sections.items():
        write_jsonl(rows, f"{path.rstrip('/')}/{name}")


def sanitize_documents(pages: DataFrame, document: str = "document") -> DataFrame:
    """Documents rewritten without personal author fields, and otherwise as they were."""
    return pages.withColumn(document, sanitize_document(F.col(document)))


def land_pages(pages: DataFrame, path: str) -> None:
    """Land sanitized pages by run. Thousands of pages share a file, unlike the one-document-per-page layout."""
    sanitize_documents(conform(pages, LANDED)).write.mode("append").partitionBy("run_id").parquet(path)
