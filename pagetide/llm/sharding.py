"""K-d tree partitioning of documents into shards of near equal bytes.

A node is split along its widest metadata dimension, at the weighted median, until the leaves reach the target bytes; bytes
are the weights. Dimensions are numbers between 0 and 1 taken from the metadata: size, language, source and id. A document's
place along a dimension is a 48-bit number: 24 bits of the value, scaled to the node, and 24 bits of a hash of the document,
so that a value that many documents share, such as a hot source, can be cut anywhere. All nodes of a level are cut together, in
three rounds: each sums the bytes of 2^16 ranges, keeps the range that holds the median and looks into it. A round moves one
row per range and task, and one row per node comes back to the driver.

Only DataFrame functions. Defined results: null texts have size 1; nulls and repeated rows are documents like others (equal rows
may take each other's slot); an empty table gives an empty table; only the columns named in DIMENSIONS and `text` are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetide.llm.common import rank_in_cells
from pagetide.session import materialise, scratch

DIMENSIONS = ["size", "lang", "source", "doc_id"]
DIGIT, DIGITS = 16, 3
VALUE_STEPS = (1 << 24) - 1


def _unit(name: str, low: Column, high: Column) -> Column:
    span = high - low
    return F.when(span > 0, (F.col(name) - low) / span).otherwise(F.lit(0.0)).alias(name)


def _metadata(docs: DataFrame) -> DataFrame:
    """Size, checksum and the dimensions as numbers between 0 and 1. Names get the place of their hash."""
    of_name = lambda name: F.coalesce(F.crc32(F.col(name).cast("string")) / F.lit(float(1 << 32)), F.lit(0.0))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    size = F.octet_length(text).cast("bigint") + 1
    measured = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        size.alias("bytes"),
        F.crc32(text).alias("text_crc32"),
        F.log(size.cast("double")).alias("at_size"),
        of_name("lang").alias("at_lang"),
        of_name("source").alias("at_source"),
        F.coalesce(F.col("doc_id").cast("double"), F.lit(0.0)).alias("at_doc_id"),
        F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 40).alias("tie"),
    )
    return materialise(measured, "shard-metadata", keep=True)


def _cut(rows: DataFrame, at: list[str], fractions: dict[int, float]) -> tuple[DataFrame, dict[int, tuple]]:
    """Cut every node listed in `fractions`; rows get a new node number. Returns them and the cuts by node."""
    bounds = rows.groupBy("node").agg(
        F.sum("bytes").alias("total"), *[F.min(c).alias(f"low_{c}") for c in at], *[F.max(c).alias(f"high_{c}") for c in at]
    )
    nodes = {row["node"]: row for row in bounds.collect()}
    cuts = {}
    for node, fraction in fractions.items():
        if node in nodes:
            row = nodes[node]
            widest = max(at, key=lambda c: row[f"high_{c}"] - row[f"low_{c}"])
            cuts[node] = [widest, row[f"low_{widest}"], row[f"high_{widest}"], fraction * row["total"], 0]
    spark = rows.sparkSession

    def keyed(cut_rows: list[tuple]) -> DataFrame:
        columns = "node int, along string, low double, high double, prefix bigint"
        return rows.join(F.broadcast(spark.createDataFrame(cut_rows, columns)), "node").withColumn("key", key)

    value = reduce(lambda other, c: F.when(F.col("along") == c, F.col(c)).otherwise(other), at, F.lit(0.0))
    span = F.col("high") - F.col("low")
    step = F.when(span > 0, F.floor((value - F.col("low")) / span * VALUE_STEPS)).otherwise(F.lit(0)).cast("bigint")
    key = F.shiftleft(step, 24) + F.col("tie")
    for digit in range(DIGITS):
        below = DIGIT * (DIGITS - 1 - digit)
        table = keyed([(node, along, low, high, prefix) for node, (along, low, high, _, prefix) in cuts.items()])
        inside = table.filter(F.shiftright("key", below + DIGIT) == F.col("prefix"))
        ranges = inside.groupBy("node", F.shiftright("key", below).alias("range")).agg(F.sum("bytes").alias("bytes"))
        wants = spark.createDataFrame([(node, float(cut[3])) for node, cut in cuts.items()], "node int, want double")
        along = Window.partitionBy("node").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
        before = ranges.withColumn("before", F.coalesce(F.sum("bytes").over(along), F.lit(0))).join(F.broadcast(wants), "node")
        # The last range that starts at or before the wanted bytes holds the median.
        holds = before.filter(F.col("before") <= F.col("want")).groupBy("node").agg(
            F.max("range").alias("range"), F.max_by("before", "range").alias("before"), F.max_by("bytes", "range").alias("own")
        )
        for row in holds.collect():
            cut = cuts[row["node"]]
            cut[3] -= row["before"]
            cut[4] = row["range"]
            if digit == DIGITS - 1 and cut[3] > row["own"] / 2:
                cut[4] += 1  # the document at the median goes to the nearer side
    table = keyed([(node, along, low, high, prefix) for node, (along, low, high, _, prefix) in cuts.items()])
    child = 2 * F.col("node") + F.when(F.col("key") >= F.col("prefix"), 1).otherwise(0)
    return table.withColumn("node", child.cast("int")).drop("along", "low", "high", "prefix", "key"), cuts


def kd_shards(docs: DataFrame, target_bytes: int | None = None, shards: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32 and shard of every document, and its slot in the shard, from 0 without gaps.

    Leaves are cut until they are within `target_bytes`; `shards`, a number of leaves, states the target the other way. A node
    of an odd number of leaves is cut in that proportion.
    """
    rows = _metadata(docs)
    at = [f"at_{name}" for name in DIMENSIONS]
    limits = rows.agg(
        F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("total"),
        *[F.min(c).alias(f"low_{c}") for c in at], *[F.max(c).alias(f"high_{c}") for c in at],
    ).first()
    if shards is None:
        shards = max(1, -(-(limits["total"] or 0) // (target_bytes or 1)))
    scaled = rows.select(
        "doc_id", "bytes", "text_crc32", "tie", F.lit(1).alias("node"),
        *[_unit(c, F.lit(limits[f"low_{c}"]), F.lit(limits[f"high_{c}"])) for c in at],
    )
    leaves, first = {1: shards}, {1: 0}
    with scratch(docs.sparkSession):
        while max(leaves.values()) > 1:
            fractions = {node: (n // 2) / n for node, n in leaves.items() if n > 1}
            cut, _ = _cut(scaled.filter(F.col("node").isin([*fractions])), at, fractions)
            done = scaled.filter(~F.col("node").isin([*fractions]))
            renumbered = done.withColumn("node", 2 * F.col("node"))
            scaled = materialise(cut.select(scaled.columns).unionByName(renumbered), "shard-level")
            below, starts = {}, {}
            for node, n in leaves.items():
                left = n // 2 if n > 1 else n
                below[2 * node], starts[2 * node] = left, first[node]
                if n > 1:
                    below[2 * node + 1], starts[2 * node + 1] = n - left, first[node] + left
            leaves, first = below, starts
        names = docs.sparkSession.createDataFrame([*first.items()], "node int, shard int")
        placed = scaled.join(F.broadcast(names), "node").select("doc_id", F.col("bytes").alias("size"), "text_crc32", "tie", "shard")
        placed = materialise(placed, "sharded", keep=True)
    ranked = rank_in_cells(placed, ["shard"], ["doc_id", "tie", "text_crc32"], "slot", limits["n"])
    return ranked.select("doc_id", "size", "text_crc32", "shard", F.col("slot").cast("bigint").alias("slot"))
