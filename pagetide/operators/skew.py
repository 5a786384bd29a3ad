"""Hot groups and lookups.

One key, app or run may hold a large share of all rows. Aggregations combine before their shuffle and need
nothing here. Two shapes do: a window over such a group, which would put the group into one task, and a
lookup join, whose small side may be broadcast only when it really is small.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetide.session import hot_rows_limit, materialise

CHUNK = "_chunk"

# Hash cells that are counted before keys are. A task sends a row for each at most.
CELLS = 16_384

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024


@dataclass
class Split:
    """`cold` groups fit a task. `hot` rows carry a chunk number: chunks of a group are consecutive in `order`.

    The chunk number depends on where a row was placed, so whatever is computed from `hot` must be materialised before it
    is used in more than one place.
    """

    cold: DataFrame
    hot: DataFrame | None


def split_hot_groups(df: DataFrame, keys: list[str], order: list[str], hot_rows: int | None = None) -> Split:
    """Separate the groups too large for one task and cut them into ordered chunks.

    Finding them costs one pass over the key columns that counts hash cells, a bounded number of rows a task. Only the rows of
    cells with too many rows are counted by key, exactly. Without hot groups the input comes back as it is.
    """
    spark = df.sparkSession
    limit = hot_rows_limit(spark, hot_rows)
    marked = df.withColumn("_group", F.xxhash64(*keys)).withColumn("_cell", F.pmod("_group", F.lit(CELLS)))
    cells = marked.groupBy("_cell").count().filter(F.col("count") > limit).select("_cell").collect()
    if not cells:
        return Split(df, None)
    crowded = F.broadcast(spark.createDataFrame([(row["_cell"],) for row in cells], "_cell long"))
    counts = marked.join(crowded, "_cell", "left_semi").groupBy("_group").count().filter(F.col("count") > limit)
    hot = materialise(counts, "hot-groups")
    total = hot.agg(F.sum("count")).first()[0]
    if total is None:
        return Split(df, None)
    # There is a hot group for every `limit` rows at most, so this side of the joins stays far smaller than the input.
    marked, names = marked.drop("_cell"), hot.select("_group")
    near = F.broadcast(names) if is_small(names) else names
    ranged = marked.join(near, "_group", "left_semi").drop("_group")
    ranged = ranged.repartitionByRange(max(2, -(-total // limit)), *keys, *order)
    cold = marked.join(near, "_group", "left_anti").drop("_group")
    return Split(cold, ranged.withColumn(CHUNK, F.spark_partition_id()))


def row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row: the length of its JSON form, which counts nested values too."""
    return F.octet_length(F.to_json(F.struct(*df.columns))).cast("bigint")


def is_small(df: DataFrame) -> bool:
    """True when the whole of `df` stays within the broadcast bounds. One row of sums per task is all that moves."""
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()
    return rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def lookup_join(left: DataFrame, right: DataFrame, keys: list[str] | str, how: str, derived: bool = False) -> DataFrame:
    """Join a large side to one that may be small.

    A side of checked size is broadcast, so the large side does not move. A larger one is shuffled, and
    adaptive execution splits the partitions of hot keys. The check reads `right` once more; a `derived` side, which is
    costly to compute, is written out first.
    """
    if derived:
        right = materialise(right, "lookup")
    return left.join(F.broadcast(right) if is_small(right) else right, keys, how)
