"""What several of the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# White space between words is ASCII only; everything else belongs to a word.
WORD = r"[^\x20\x09-\x0D]+"
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bind(value: Column, body) -> Column:
    """`body(value)` with `value` computed once per row, also where `body` uses it inside another lambda."""
    return F.transform(F.array(value), body)[0]


def rank_in_cells(df: DataFrame, cells: list[str], order: list[str], name: str, rows: int, bucket_rows: int = 50_000) -> DataFrame:
    """Adds `name`: the row's place in its cell, from 0 without gaps.

    A cell may hold a large share of all rows, so it is cut into hash buckets of about `bucket_rows`; the place is the start
    of the bucket plus the place inside it. `cells` must not be null; rows equal in `order` are in any order.
    """
    buckets = max(1, -(-rows // bucket_rows))
    keys = [*cells, "__bucket"]
    dealt = df.withColumn("__bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    before = Window.partitionBy(*cells).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    starts = starts.select(*keys, F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    placed = dealt.withColumn("__inside", inside).join(starts, keys)
    return placed.withColumn(name, F.col("__start") + F.col("__inside") - 1).drop("__bucket", "__inside", "__start")
