"""The ordered-version fold.

Versions of a key are taken in load order. A version is accepted when the key is new, when its timestamp is
above that of the current version, or when its text differs from the current text; otherwise nothing changes.
An older version with another text therefore does win, so "latest timestamp" is not the answer.

After any version, accepted or not, the current text equals the text of that version. So:

* a version breaks the run of equal texts when its text differs from that of the version before it;
* inside such an island the current timestamp is the running maximum;
* the maximum of (island, timestamp) over all rows so far gives that running maximum without a second sort,
  because islands are numbered in order.

One exchange on the key and one sort serve all the windows. A hot key is folded in chunks; see `_fold_hot`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagetide.operators.scans import ordered_by
from pagetide.operators.skew import CHUNK, lookup_join, split_hot_groups
from pagetide.session import materialise

OUTCOME = "outcome"
PREVIOUS = "previous_timestamp_updated"

_STORED_RANK = "_rank"


def _number(timestamp: str) -> Column:
    return F.coalesce(F.col(timestamp), F.lit(0).cast("bigint"))


def fold_versions(
    incoming: DataFrame,
    key: str,
    order: list[str],
    timestamp: str,
    text: str,
    stored: DataFrame | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Incoming rows with `outcome` (inserted, updated, unchanged) and the timestamp of the version before them.

    `stored` holds the current version per key (key, timestamp, text). It comes before all incoming rows and has no
    outcome of its own. `order` must be unique within a key.
    """
    rows = incoming.withColumn(_STORED_RANK, F.lit(1))
    if stored is not None:
        current = stored.select(key, timestamp, text).withColumn(_STORED_RANK, F.lit(0))
        rows = rows.unionByName(current, allowMissingColumns=True)
    full_order = [_STORED_RANK, *order]
    split = split_hot_groups(rows, [key], full_order, hot_rows)
    folded = _judge(_fold(split.cold, [key], full_order, timestamp, text), timestamp)
    if split.hot is not None:
        hot = _judge(_fold_hot(split.hot, key, full_order, timestamp, text), timestamp)
        folded = folded.unionByName(hot.select(*folded.columns))
    return folded.filter(F.col(_STORED_RANK) == 1).drop(_STORED_RANK)


def _fold(rows: DataFrame, groups: list[str], order: list[str], timestamp: str, text: str) -> DataFrame:
    """Adds `_first` (first row of the group), `_break`, `_top` (island, timestamp after the row) and `_before`."""
    window = Window.partitionBy(*groups).orderBy(*order)
    so_far = window.rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumns({
            "_first": F.row_number().over(window) == 1,
            "_text_before": F.lag(text).over(window),
        })
        .withColumn("_break", ~F.col("_first") & ~F.col(text).eqNullSafe(F.col("_text_before")))
        .withColumn("_island", F.sum(F.col("_break").cast("bigint")).over(so_far))
        .withColumn("_top", F.max(F.struct(F.col("_island").alias("island"), _number(timestamp).alias("ts"))).over(so_far))
        .withColumn("_before", F.lag("_top.ts").over(window))
        .drop("_text_before", "_island")
    )


def _fold_hot(chunked: DataFrame, key: str, order: list[str], timestamp: str, text: str) -> DataFrame:
    """The fold of a group that is spread over chunks.

    Every chunk is folded on its own and reduced to: its first and last text, the number of breaks inside it, and the
    maximum of its last island. Scanned in chunk order, with the same (island, timestamp) maximum, these give the state
    in which each chunk begins. Only rows before the first break of a chunk can still be affected by that state.
    """
    local = materialise(_fold(chunked, [key, CHUNK], order, timestamp, text), "chunks")
    position = ordered_by(order)
    # A digest says whether two texts are equal, and keeps long texts out of the summaries.
    texts = F.struct(F.sha2(F.col(text).cast("string"), 256).alias("text"))
    summary = local.groupBy(key, CHUNK).agg(
        F.min_by(texts, position).alias("head"),
        F.max_by(texts, position).alias("tail"),
        F.max("_top").alias("top"),
    )
    chunks = Window.partitionBy(key).orderBy(CHUNK)
    so_far = chunks.rowsBetween(Window.unboundedPreceding, 0)
    carried = (
        summary.withColumn("_tail_before", F.lag("tail").over(chunks))
        .withColumn("_opens", F.col("_tail_before").isNull())
        .withColumn("_continues", ~F.col("_opens") & F.col("head.text").eqNullSafe(F.col("_tail_before.text")))
        .withColumn("_island", F.sum(F.col("top.island") + (~F.col("_continues")).cast("bigint")).over(so_far))
        .withColumn("_end", F.max(F.struct(F.col("_island").alias("island"), F.col("top.ts").alias("ts"))).over(so_far))
        .select(key, CHUNK, "_opens", "_continues", F.lag("_end.ts").over(chunks).alias("_carry"))
    )
    in_head = (F.col("_top.island") == 0) & F.col("_continues")
    return (
        lookup_join(local, carried, [key, CHUNK], "left", derived=True)
        .withColumn(
            "_before",
            F.when(F.col("_first"), F.col("_carry"))
            # The row before lies in this chunk. It shares the carried island unless a break came before it.
            .when(in_head | (F.col("_break") & (F.col("_top.island") == 1) & F.col("_continues")),
                  F.greatest("_before", "_carry"))
            .otherwise(F.col("_before")),
        )
        .withColumn("_break", F.col("_break") | (F.col("_first") & ~F.col("_continues") & ~F.col("_opens")))
        .withColumn("_first", F.col("_first") & F.col("_opens"))
        .drop("_opens", "_continues", "_carry", CHUNK)
    )


def _judge(folded: DataFrame, timestamp: str) -> DataFrame:
    accepted = F.col("_break") | (_number(timestamp) > F.col("_before"))
    outcome = (
        F.when(F.col("_first"), F.lit("inserted")).when(accepted, F.lit("updated")).otherwise(F.lit("unchanged"))
    )
    return (
        folded.withColumn(OUTCOME, outcome)
        .withColumn(PREVIOUS, F.when(~F.col("_first"), F.col("_before")))
        .drop("_first", "_break", "_top", "_before")
    )
