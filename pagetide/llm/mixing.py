"""Mixing sources to target weights by entropy balancing.

Rates stay as close to one as they can, in relative entropy, while each source meets its target of words and no rate exceeds
`cap`. The dual of that problem has one multiplier per source, and its solution tilts the rates exponentially:
`rate = min(cap, exp(multiplier * size / mean size of the source))`. Documents of one source and size have one rate, so the
Newton iterations run over counts by source and size, as one join and one aggregation each, and need no approximation.

Rates become whole copies in two steps. The counts by size are rounded from the largest size down, each taking over what the
sizes above left open, so that a source misses its target by about its smallest documents. The copies of one size are then
dealt out evenly over its documents, by rank. No source and no size is gathered in one task.

Defined results: a null text has size 0; a null source is a source of its own, last in order; repeated rows are documents of
their own; documents without words keep one copy and take nothing; an empty table gives an empty table; only `doc_id`, `text`,
`source` and the columns named in `carry` are read.
"""

from __future__ import annotations

from itertools import count

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagetide.llm.common import WORD, rank_in_cells
from pagetide.session import materialise, scratch

# Relative distance to the target at which Newton stops, far below what rounding to whole documents adds.
TOLERANCE = 1e-7

# Steps after which the bracket around a multiplier is only halved, until the target is met or doubles have no number in between.
NEWTON_STEPS = 100


def order_rank(df: DataFrame, order: list, name: str) -> DataFrame:
    """Adds `name`: the row's place in the whole table, from 0, by sorting ranges of it and adding their sizes."""
    ranged = df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id())
    ranged = materialise(ranged, "ranges", keep=True)
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("__range").count().withColumn("__start", F.coalesce(F.sum("count").over(before), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    placed = ranged.withColumn("__inside", inside).join(starts, "__range")
    return placed.withColumn(name, F.col("__start") + F.col("__inside") - 1).drop("__range", "__start", "__inside", "count")


def targets(sources: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """Adds `weight` and `target` to sources with `key` (null is a marked key), `source_size`.

    The weights repeat along the order of the sources. All words are shared by weight; what a source would get above `cap`
    times its size is shared again by weight among the others, until none is above.
    """
    ordered = order_rank(sources, ["key"], "place")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    weighed = materialise(ordered.withColumn("weight", weight).drop("place"), "weighed-sources", keep=True)
    most = cap * F.col("source_size")
    total, all_weights = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    share, closed = (total or 0) / (all_weights or 1), -1
    while True:
        above = most < share * F.col("weight")
        row = weighed.agg(
            F.count_if(above).alias("n"), F.sum(F.when(above, most)).alias("full"), F.sum(F.when(~above, F.col("weight"))).alias("w")
        ).first()
        if row["n"] in (closed, 0) or not row["w"]:
            break
        closed, share = row["n"], (total - row["full"]) / row["w"]
    return weighed.withColumn("target", F.least(most.cast("double"), F.lit(float(share)) * F.col("weight")))


def multipliers(cells: DataFrame, sources: DataFrame, cap: int) -> DataFrame:
    """`key` and `multiplier` per source; null where only the cap on every document reaches the target, or it is zero."""
    limit = F.log(F.lit(float(cap)))
    open_sources = sources.filter((F.col("target") > 0) & (F.col("target") < cap * F.col("source_size")))
    state = open_sources.select(
        "key", "target", "mean", F.lit(0.0).alias("at"), F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high")
    )
    state = materialise(state, "multipliers")
    for step_number in count():
        scaled = F.col("size") / F.col("mean")
        power = F.col("at") * scaled
        words = F.col("n") * F.col("size")
        moved = (
            cells.join(state, "key")
            .withColumn("rate", F.exp(F.least(power, limit)))
            .groupBy("key", "target", "mean", "at", "low", "high")
            .agg(
                (F.sum(words * F.col("rate")) - F.first("target")).alias("miss"),
                F.sum(F.when(power < limit, words * scaled * F.col("rate")).otherwise(0.0)).alias("slope"),
            )
        )
        low = F.when(F.col("miss") < 0, F.col("at")).otherwise(F.col("low"))
        high = F.when(F.col("miss") > 0, F.col("at")).otherwise(F.col("high"))
        newton = F.col("at") - F.col("miss") / F.col("slope")
        # Where a step leaves the bracket, halve it, or double outwards while it is open.
        middle = (
            F.when(low == float("-inf"), 2 * F.least(high, F.lit(0.0)) - 1)
            .when(high == float("inf"), 2 * F.greatest(low, F.lit(0.0)) + 1)
            .otherwise((low + high) / 2)
        )
        done = (F.abs("miss") <= TOLERANCE * F.col("target")) | (middle == low) | (middle == high)
        inside = (F.col("slope") > 0) & (newton > low) & (newton < high) & (F.abs(newton - F.col("at")) < 8)
        inside = inside & F.lit(step_number < NEWTON_STEPS)
        step = F.when(done, F.col("at")).when(inside, newton).otherwise(middle)
        after = moved.select("key", "target", "mean", step.alias("at"), low.alias("low"), high.alias("high"), done.alias("done"))
        after = materialise(after, "multipliers")
        state = after.drop("done")
        if not after.filter(~F.col("done")).limit(1).count():
            break
    return state.select("key", F.col("at").alias("multiplier"))


def round_cells(rated: DataFrame) -> DataFrame:
    """Whole copies for each source and size, (key, size, n, copies), from the largest size down.

    A source is one group here, of one row per distinct size: at most as many as the words of its longest document.
    """

    def fold(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("size", ascending=False)
        owed, copies = 0.0, []
        for size, n, rate in zip(group["size"], group["n"], group["rate"], strict=True):
            wanted = n * rate
            floor = int(wanted + 1e-9)
            most = floor + 1 if wanted - floor > 1e-9 else floor
            take = min(max(round(wanted + (owed / size if size else 0.0)), floor), most)
            owed += (wanted - take) * size
            copies.append(take)
        return pd.DataFrame({"key": group["key"], "size": group["size"], "n": group["n"], "copies": copies})

    return rated.groupBy("key").applyInPandas(fold, "key string, size bigint, n bigint, copies bigint")


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, `carry`, size, source_size, target, copies and taken (copies times size) of every row."""
    spark = docs.sparkSession
    sized = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.concat(F.when(F.col("source").isNull(), "1").otherwise("0"), F.coalesce(F.col("source").cast("string"), F.lit(""))).alias("key"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        F.xxhash64("text").alias("__text"),
        *carry,
    )
    sized = materialise(sized, "sized-documents", keep=True)
    with scratch(spark):
        cells = materialise(sized.groupBy("key", "size").agg(F.count(F.lit(1)).alias("n")), "size-counts")
        sources = cells.groupBy("key").agg(
            F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("docs")
        )
        sources = targets(sources, weights, cap).withColumn("mean", F.col("source_size") / F.col("docs"))
        sources = materialise(sources.select("key", "source_size", "mean", "target"), "source-targets", keep=True)
        solved = multipliers(cells, sources, cap)
        rate = (
            F.when(F.col("multiplier").isNotNull(), F.least(F.lit(float(cap)), F.exp(F.col("multiplier") * F.col("size") / F.col("mean"))))
            .when(F.col("size") == 0, F.lit(1.0))
            .when(F.col("target") > 0, F.lit(float(cap)))
            .otherwise(F.lit(0.0))
        )
        rated = cells.join(sources, "key").join(solved, "key", "left").select("key", "size", "n", rate.alias("rate"))
        copies = materialise(round_cells(rated), "size-copies", keep=True)
        rows = cells.agg(F.sum("n")).first()[0] or 0
    ranked = rank_in_cells(sized, ["key", "size"], ["doc_id", "__text"], "__rank", rows)
    dealt = ranked.join(copies, ["key", "size"]).join(sources.select("key", "source_size", "target"), "key")
    own = F.expr("((__rank + 1) * copies) div n - (__rank * copies) div n")
    return dealt.select("doc_id", *carry, "size", "source_size", "target", own.alias("copies"), (own * F.col("size")).alias("taken"))
