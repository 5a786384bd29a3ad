"""Exact positions of rows in line-based files that Spark reads in splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LINE_ORDER = ["_file", "_block", "_line"]


def with_line_order(df: DataFrame) -> DataFrame:
    """Adds columns that sort rows in file order: file name, start of the split, and the row's place in its task.

    One task reads a split from front to back, so the last column rises inside a split. Part files sort by name.
    """
    return df.withColumns({
        "_file": F.col("_metadata.file_name"),
        "_block": F.col("_metadata.file_block_start"),
        "_line": F.monotonically_increasing_id(),
    })


def with_row_number(df: DataFrame, first: int = 1) -> DataFrame:
    """Adds `row_number` per file. Only one row per split is scanned in order, never the rows themselves."""
    placed = with_line_order(df.withColumn("_path", F.col("_metadata.file_path")))
    splits = placed.groupBy("_path", "_block").agg(F.min("_line").alias("_start"), F.count("*").alias("_rows"))
    earlier = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("_path", "_block", "_start", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    return (
        placed.join(offsets, ["_path", "_block"])
        .withColumn("row_number", F.col("_line") - F.col("_start") + F.col("_offset") + first)
        .drop("_path", "_block", "_line", "_start", "_offset")
    )
