"""The list of apps to follow."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetide.functions import clean_text, parse_bool
from pagetide.schemas import TARGETS
from pagetide.sources.lines import with_row_number

# The header is row 1.
FIRST_DATA_ROW = 2


def read_targets(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """All columns as text, with the row number in the file. Quoted line breaks need `multi_line`."""
    try:
        rows = spark.read.csv(path, header=True, escape='"', multiLine=multi_line)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"target file does not exist: {path}") from error
        raise
    missing = sorted(set(TARGETS.names) - set(rows.columns))
    if missing:
        raise ValueError(f"target file is missing columns: {', '.join(missing)}")
    return with_row_number(rows, FIRST_DATA_ROW).select(*TARGETS.names, "row_number")


def check_targets(rows: DataFrame) -> DataFrame:
    """Typed targets plus `reject_reason`, null for a good row."""
    app_id, active = clean_text(F.col("app_id")), parse_bool(F.col("active"))
    reason = (
        F.when(app_id.isNull(), F.lit("app_id is required"))
        .when(~app_id.rlike("^[0-9]+$"), F.lit("app_id must be numeric"))
        .when(active.isNull(), F.concat(F.lit("Invalid boolean value: "), F.col("active")))
    )
    return rows.select(
        app_id.alias("app_id"),
        clean_text(F.col("app_name")).alias("app_name"),
        active.alias("active"),
        clean_text(F.col("notes")).alias("notes"),
        F.col("row_number").cast("bigint").alias("row_number"),
        reason.alias("reject_reason"),
    )


def valid_targets(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected_targets(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("reject_reason").isNotNull())


def active_targets(targets: DataFrame) -> DataFrame:
    return targets.filter("active")


def load_targets(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Valid targets. In strict mode the first bad row raises; otherwise bad rows are left to `rejected_targets`."""
    checked = check_targets(read_targets(spark, path))
    if strict:
        first = rejected_targets(checked).orderBy("row_number").select("row_number", "reject_reason").first()
        if first is not None:
            raise ValueError(f"Row {first['row_number']}: {first['reject_reason']}")
    return valid_targets(checked)
