"""Ordered operators (previous value, running maximum) that survive hot groups.

A hot group is worked on chunk by chunk. Each chunk is reduced to one row, the few chunk rows of a group
are scanned in order, and what they carry goes back to the rows by a broadcast of chunk rows, whose number is
bounded by the number of chunks plus the number of hot groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagetide.operators.skew import CHUNK, lookup_join, split_hot_groups
from pagetide.session import materialise


def ordered_by(order: list[str]) -> Column:
    return F.struct(*order)


def previous_value(
    df: DataFrame, keys: list[str], order: list[str], column: str, output: str, default: Column, hot_rows: int | None = None
) -> DataFrame:
    """`output` = `column` of the row before in the group, `default` in its first row."""
    split = split_hot_groups(df, keys, order, hot_rows)

    def looked_back(rows: DataFrame, groups: list[str]) -> DataFrame:
        window = Window.partitionBy(*groups).orderBy(*order)
        return rows.withColumn("_row", F.row_number().over(window)).withColumn(output, F.lag(column).over(window))

    cold = looked_back(split.cold, keys).withColumn(output, F.when(F.col("_row") == 1, default).otherwise(F.col(output)))
    if split.hot is None:
        return cold.drop("_row")
    chunks = Window.partitionBy(*keys).orderBy(CHUNK)
    local = materialise(looked_back(split.hot, [*keys, CHUNK]), "chunks")
    carried = (
        local.groupBy(*keys, CHUNK)
        .agg(F.max_by(F.struct(F.col(column).alias("v")), ordered_by(order)).alias("_last"))
        .withColumn("_carry", F.lag("_last").over(chunks))
        .drop("_last")
    )
    before = F.when(F.col("_carry").isNull(), default).otherwise(F.col("_carry.v"))
    hot = (
        lookup_join(local, carried, [*keys, CHUNK], "left", derived=True)
        .withColumn(output, F.when(F.col("_row") == 1, before).otherwise(F.col(output)))
    )
    return cold.unionByName(hot.select(*cold.columns)).drop("_row")


def running_max(
    df: DataFrame, keys: list[str], order: list[str], outputs: dict[str, Column], hot_rows: int | None = None
) -> DataFrame:
    """Each output is the largest value of its expression over the group's rows up to this one; nulls are passed over."""
    split = split_hot_groups(df, keys, order, hot_rows)

    def running(rows: DataFrame, groups: list[str]) -> DataFrame:
        window = Window.partitionBy(*groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return rows.withColumns({name: F.max(value).over(window) for name, value in outputs.items()})

    cold = running(split.cold, keys)
    if split.hot is None:
        return cold
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    local = materialise(running(split.hot, [*keys, CHUNK]), "chunks")
    carried = (
        local.groupBy(*keys, CHUNK)
        .agg(*(F.max(name).alias(f"_max_{name}") for name in outputs))
        .select(*keys, CHUNK, *(F.max(f"_max_{name}").over(earlier).alias(f"_carry_{name}") for name in outputs))
    )
    hot = (
        lookup_join(local, carried, [*keys, CHUNK], "left", derived=True)
        .withColumns({name: F.greatest(name, f"_carry_{name}") for name in outputs})
    )
    return cold.unionByName(hot.select(*cold.columns))
