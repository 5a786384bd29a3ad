"""Run directories: page reports (one JSON line per page) and raw pages (one JSON document per file)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetide.operators.skew import is_small
from pagetide.schemas import PAGE_REPORT
from pagetide.sources.lines import LINE_ORDER, with_line_order

# Names inside a run directory.
REPORT_FILE = "review_pages.jsonl"
PAGE_FILES = "app_*_page_*.json"
_PAGE_PATH = r"([^/]+)/app_([^/]*)_page_(\d+)\.json$"

REPORT_ORDER = ["run_id", *LINE_ORDER]


def _file_path() -> Column:
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def _as_list(paths: str | list[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_page_reports(spark: SparkSession, run_dirs: str | list[str]) -> DataFrame:
    """Page reports of one or more run directories (globs allowed) in file order. The run is named by its directory.

    The report may be one file, or a folder of part files as `write_page_reports` makes it.
    """
    paths = [f"{d.rstrip('/')}/{REPORT_FILE}" for d in _as_list(run_dirs)]
    as_text = T.StructType([T.StructField(field.name, T.StringType()) for field in PAGE_REPORT])
    try:
        rows = spark.read.schema(as_text).option("mode", "FAILFAST").json(paths)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"page report file does not exist: {', '.join(paths)}") from error
        raise
    run_id = F.regexp_extract(_file_path(), rf"([^/]+)/{REPORT_FILE}(?:/[^/]*)?$", 1)
    typed = [
        (run_id if field.name == "run_id" else F.col(field.name).try_cast(field.dataType)).alias(field.name)
        for field in PAGE_REPORT
    ]
    return with_line_order(rows).select(*typed, *LINE_ORDER)


def read_raw_pages(spark: SparkSession, run_dirs: str | list[str], pattern: str = PAGE_FILES) -> DataFrame:
    """Landed documents with run, app and page number taken from their paths."""
    path = _file_path()
    files = spark.read.option("pathGlobFilter", pattern).text(_as_list(run_dirs), wholetext=True)
    return files.select(
        F.regexp_extract(path, r"([^/]+)/[^/]+$", 1).alias("run_id"),
        F.element_at(F.split(path, "/"), -1).alias("file_name"),
        F.nullif(F.regexp_extract(path, _PAGE_PATH, 2), F.lit("")).alias("app_id"),
        F.regexp_extract(path, _PAGE_PATH, 3).try_cast("int").alias("page_number"),
        F.col("value").alias("document"),
    )


def list_raw_pages(spark: SparkSession, run_dirs: str | list[str], pattern: str = PAGE_FILES) -> DataFrame:
    """Runs, names and sizes of the landed documents. The binary source lists files without opening them."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(_as_list(run_dirs))
    return files.select(
        F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("run_id"),
        base_name(F.col("path")).alias("file_name"),
        F.col("length").alias("bytes"),
    )


def list_runs(spark: SparkSession, run_dirs: str | list[str]) -> DataFrame:
    """The runs that have a page report file, an empty one too."""
    files = spark.read.format("binaryFile").load([f"{d.rstrip('/')}/{REPORT_FILE}" for d in _as_list(run_dirs)])
    return files.select(F.regexp_extract("path", rf"([^/]+)/{REPORT_FILE}(?:/[^/]*)?$", 1).alias("run_id")).distinct()


LANDED = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("app_id", T.StringType()),
    T.StructField("app_name", T.StringType()),
    T.StructField("page_number", T.IntegerType()),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("attempt_count", T.IntegerType()),
    T.StructField("fetched_at", T.StringType()),
    T.StructField("raw_json_path", T.StringType()),
    T.StructField("document", T.StringType()),
])


def read_landed_pages(spark: SparkSession, path: str, streaming: bool = False, files_per_batch: int | None = None) -> DataFrame:
    """Pages landed by `land_pages`: many documents per file, one folder per run, so a run filter prunes folders.

    A stream takes all files that are there, or at most `files_per_batch` of them, into a micro-batch.
    """
    reader = (spark.readStream if streaming else spark.read).schema(LANDED)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def loadable(reports: DataFrame) -> DataFrame:
    """Pages that were read and have a raw document."""
    return reports.filter(F.col("status").isin("fetched", "empty") & (F.coalesce("raw_json_path", F.lit("")) != ""))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def attach_documents(reports: DataFrame, files: DataFrame) -> DataFrame:
    """Loadable reports with their document, matched by run and base name, whatever folder the report names.

    The documents are the large side: reports of checked size are broadcast so that documents stay where they are read.
    """
    wanted = loadable(reports).withColumn("file_name", base_name(F.col("raw_json_path")))
    wanted = F.broadcast(wanted) if is_small(wanted) else wanted
    return files.select("run_id", "file_name", "document").join(wanted, ["run_id", "file_name"])


def reports_without_document(reports: DataFrame, files: DataFrame) -> DataFrame:
    wanted = loadable(reports).withColumn("file_name", base_name(F.col("raw_json_path")))
    return wanted.join(files.select("run_id", "file_name"), ["run_id", "file_name"], "left_anti")
