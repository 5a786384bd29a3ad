"""Approximate nearest neighbours by a hash-prefix forest.

Each tree names every vector by a long string of bits, the signs of random projections, and keeps the strings sorted. Vectors get
one more component that makes all lengths equal, so that the largest inner product is the smallest angle. A query descends in
every tree to its longest prefix matches and then ascends in all trees at once, one bit at a time, until the prefixes of that
length hold enough candidates; those are scored exactly. How many are enough is measured, not assumed: on a bounded sample of
queries, searched exhaustively, the least number that reaches the wanted recall.

In Spark a tree is a range-partitioned sort. Pass one counts, inside blocks of neighbouring strings, how many share each prefix
length with a query; the sums over trees give the query's depth. Pass two sends each query to the blocks that its prefix range
touches, where its candidates are one slice of the sorted block. Equal vectors are one entry of the index, with as many of their
smallest ids as a result can hold, so a group of copies of any size costs what one vector costs.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, as queries or as candidates,
nor do those without an id or of another length than most; ties go to the smaller id; with fewer candidates than asked for, all
are returned; of rows that repeat an id and a vector one takes part; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetide.session import materialise, scratch

BITS = 63


@dataclass(frozen=True)
class ForestSettings:
    trees: int = 24
    nearest: int = 20
    recall: float = 0.96  # wanted on the calibration queries
    sample: int = 200  # calibration queries at most
    block_rows: int = 20_000
    seed: int = 11


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding as doubles) of the vectors that take part."""
    doubles = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), doubles.alias("embedding")).filter(
        F.col("vec_id").isNotNull()
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("embedding", lambda x: x != 0)
    )
    sizes = rows.groupBy(F.size("embedding").alias("size")).count()
    most = sizes.orderBy(F.desc("count"), "size").first()
    return rows.filter(F.size("embedding") == (most["size"] if most else 0))


def distinct_vectors(rows: DataFrame, ids: int) -> DataFrame:
    """(entry, vector, ids): one row per distinct vector, with the smallest `ids` ids that hold it, in order."""
    rows = rows.select("vec_id", F.transform("embedding", lambda x: x + F.lit(0.0)).alias("vector"))  # one zero only
    own = rows.groupBy("vector", F.pmod(F.xxhash64("vec_id"), F.lit(64)).alias("salt"), "vec_id").agg(F.count(F.lit(1)).alias("n"))
    few = F.row_number().over(Window.partitionBy("vector", "salt").orderBy("vec_id"))
    own = own.withColumn("place", few).filter(F.col("place") <= ids)
    few = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    own = own.withColumn("place", few).filter(F.col("place") <= ids)
    grouped = own.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    return grouped.select(F.col("ids")[0].alias("entry"), "vector", "ids")


class Hasher:
    """The bit strings of vectors in every tree, as numbers whose order is that of the strings."""

    def __init__(self, settings: ForestSettings, size: int, longest: float) -> None:
        rng = np.random.default_rng(settings.seed)
        self.planes = rng.normal(size=(settings.trees, size + 1, BITS))
        self.longest = longest
        self.powers = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.longest**2 - (vectors**2).sum(axis=1), 0))
        level = np.column_stack([vectors, rest])
        return np.stack([((level @ planes) > 0) @ self.powers for planes in self.planes], axis=1)


def common_prefix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading bits, of BITS, that two keys share."""
    differ = np.bitwise_xor(a, b)
    # The exponent of the difference; halves are split off so that doubles hold them exactly.
    high, low = differ >> 32, differ & 0xFFFFFFFF
    length = np.where(high > 0, 32 + np.frexp(high.astype(float))[1], np.frexp(low.astype(float))[1])
    return BITS - length


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.zeros((0, 0))


def _keyed(entries: DataFrame, settings: ForestSettings) -> DataFrame:
    first = entries.select(
        F.size("vector").alias("size"), F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x).alias("square")
    ).agg(F.max("size").alias("size"), F.max("square").alias("square")).first()
    size, longest = first["size"] or 0, float(np.sqrt(first["square"] or 0.0))

    def keys(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher(settings, size, longest)
        for frame in frames:
            if len(frame):
                yield frame.assign(keys=list(hasher.keys(_matrix(frame["vector"]))))

    kind = "entry bigint, vector array<double>, ids array<bigint>, is_query boolean, keys array<bigint>"
    return entries.mapInPandas(keys, kind)


def _exhaustive(index: DataFrame, queries: pd.DataFrame, nearest: int) -> pd.DataFrame:
    """The nearest entries of a few queries, over all entries: each task keeps its own nearest, and those are ranked."""
    asked, own = _matrix(queries["vector"]), queries["entry"].to_numpy()

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            scores = asked @ _matrix(frame["vector"]).T
            entries = frame["entry"].to_numpy()
            scores[own[:, None] == entries[None, :]] = -np.inf
            top = np.argsort(-scores, axis=1)[:, :nearest]
            rows = np.repeat(np.arange(len(own)), top.shape[1])
            yield pd.DataFrame({"query": own[rows], "entry": entries[top.ravel()], "score": scores[rows, top.ravel()]})

    found = index.select("entry", "vector").mapInPandas(search, "query bigint, entry bigint, score double")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "entry"))
    found = found.filter("score > double('-inf')").withColumn("place", place).filter(F.col("place") <= nearest)
    return found.join(index.select("entry", "keys"), "entry").select("query", "entry", "keys").toPandas()


def _levels(blocks: DataFrame, trees: int) -> DataFrame:
    """Per query, over all trees, how many entries share at least 0 .. BITS bits with it, counted inside its blocks."""

    def count(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("key")
        keys, asked = frame["key"].to_numpy(), frame[frame["is_query"]]
        at = asked["key"].to_numpy()
        held = np.empty((len(at), BITS + 1), np.int64)
        for bits in range(BITS + 1):
            low = at >> (BITS - bits) << (BITS - bits)
            high = low + ((1 << (BITS - bits)) - 1)
            held[:, bits] = np.searchsorted(keys, high, side="right") - np.searchsorted(keys, low, side="left") - 1
        return pd.DataFrame({"query": asked["entry"].to_numpy(), "held": pd.Series(list(held), dtype=object)})

    counted = blocks.select("tree", "block", "key", "entry", "is_query").groupBy("tree", "block").applyInPandas(
        count, "query bigint, held array<bigint>"
    )
    sums = [F.sum(F.col("held")[bits]).alias(f"held_{bits}") for bits in range(BITS + 1)]
    return counted.groupBy("query").agg(*sums).select("query", F.array(*[f"held_{bits}" for bits in range(BITS + 1)]).alias("held"))


def _depth(held: Column, enough: float) -> Column:
    """The longest prefix whose matches are enough; 0, which every entry matches, if none is."""
    places = F.transform(held, lambda n, bits: F.when(n >= enough, bits).otherwise(0))
    return F.array_max(places)


def _enough(levels: pd.DataFrame, truth: pd.DataFrame, queries: pd.DataFrame, recall: float) -> float:
    """The least number of candidates that finds the wanted share of the true neighbours."""
    if not len(truth):
        return float("inf")
    own = dict(zip(queries["entry"], queries["keys"], strict=True))
    mine, theirs = np.stack([own[q] for q in truth["query"]]), np.stack(truth["keys"].to_numpy())
    shared = common_prefix(mine, theirs).max(axis=1)
    held = {q: np.asarray(h) for q, h in zip(levels["query"], levels["held"], strict=True)}
    # A neighbour is found when the query's depth is at most the prefix they share in some tree.
    needed = np.sort([held[q][bits] for q, bits in zip(truth["query"], shared, strict=True)])
    return float(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))])


def nearest_neighbours(vectors: DataFrame, is_query: Column, settings: ForestSettings = ForestSettings()) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found for every row for which `is_query` of vec_id holds."""
    spark, k = vectors.sparkSession, settings.nearest
    rows = materialise(usable(vectors), "usable-vectors", keep=True)
    with scratch(spark):
        entries = materialise(distinct_vectors(rows, k + 1), "distinct-vectors")
        asking = rows.filter(is_query).select("vec_id", F.transform("embedding", lambda x: x + F.lit(0.0)).alias("vector"))
        asking = asking.distinct().join(entries.select("entry", "vector"), "vector").select("vec_id", "entry")
        asking = materialise(asking, "asking", keep=True)
        flags = asking.select("entry").distinct().withColumn("is_query", F.lit(True))
        flagged = entries.join(flags, "entry", "left").withColumn("is_query", F.coalesce("is_query", F.lit(False)))
        index = materialise(_keyed(flagged, settings), "forest", keep=True)
        n = index.count()
        blocks = max(1, -(-n // settings.block_rows))
        cuts = [j / blocks for j in range(1, blocks)]
        if cuts:
            bounds = index.agg(*[F.percentile_approx(F.col("keys")[t], F.lit(cuts), F.lit(10_000)) for t in range(settings.trees)])
            bounds = np.array([list(b) for b in bounds.first()], np.int64)
        else:
            bounds = np.zeros((settings.trees, 0), np.int64)
        starts = np.sort(bounds, axis=1)

        def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            """Every entry once per tree, with the block that its string falls into."""
            for frame in frames:
                keys = _matrix(frame["keys"])
                for tree in range(len(starts) if len(frame) else 0):
                    block = np.searchsorted(starts[tree], keys[:, tree], side="right")
                    yield pd.DataFrame({
                        "tree": np.int32(tree), "block": block.astype(np.int32), "key": keys[:, tree], "entry": frame["entry"],
                        "is_query": frame["is_query"],
                    })

        strings = index.select("entry", "keys", "is_query").mapInPandas(
            deal, "tree int, block int, key bigint, entry bigint, is_query boolean"
        )
        levels = materialise(_levels(strings, settings.trees), "levels", keep=True)
        chosen = index.filter("is_query").orderBy(F.xxhash64("entry"), "entry").limit(settings.sample)
        chosen = chosen.select("entry", "vector", "keys").toPandas()
        truth = _exhaustive(index, chosen, k) if len(chosen) else pd.DataFrame({"query": []})
        sample_levels = levels.filter(F.col("query").isin(chosen["entry"].tolist())).toPandas()
        enough = max(_enough(sample_levels, truth, chosen, settings.recall), float(k))
    depths = levels.select(F.col("query").alias("entry"), _depth(F.col("held"), enough).alias("depth"))
    asked = index.filter("is_query").select("entry", "vector", "keys").join(depths, "entry")

    def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A query once per tree and block that its range of strings touches."""
        for frame in frames:
            for tree in range(len(starts) if len(frame) else 0):
                free = BITS - frame["depth"].to_numpy()
                low = _matrix(frame["keys"])[:, tree] >> free << free
                high = low + ((np.int64(1) << free) - 1)
                first = np.searchsorted(starts[tree], low, side="right")
                last = np.searchsorted(starts[tree], high, side="right")
                rows = np.repeat(np.arange(len(frame)), last - first + 1)
                block = np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last, strict=True)])
                yield pd.DataFrame({
                    "tree": np.int32(tree), "block": block.astype(np.int32), "low": low[rows], "high": high[rows],
                    "entry": frame["entry"].to_numpy()[rows], "vector": frame["vector"].to_numpy()[rows],
                })

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keys = _matrix(frame["keys"])
            for tree in range(len(starts) if len(frame) else 0):
                block = np.searchsorted(starts[tree], keys[:, tree], side="right")
                yield pd.DataFrame({
                    "tree": np.int32(tree), "block": block.astype(np.int32), "key": keys[:, tree], "entry": frame["entry"],
                    "vector": frame["vector"],
                })

    def search(key: tuple, held: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        """The nearest entries of each query among its slice of the block; scores are sums in one order, row by row."""
        out = {"query": [], "entry": [], "score": []}
        if len(held) and len(asked):
            held = held.sort_values("key")
            keys, entries, matrix = held["key"].to_numpy(), held["entry"].to_numpy(), _matrix(held["vector"])
            low = np.searchsorted(keys, asked["low"].to_numpy(), side="left")
            high = np.searchsorted(keys, asked["high"].to_numpy(), side="right")
            for entry, vector, a, b in zip(asked["entry"], asked["vector"], low, high, strict=True):
                quick = matrix[a:b] @ vector
                # Rounding differs by the way of summing, so keep what is near the last place, then sum exactly alike.
                worst = np.partition(quick, len(quick) - k - 1)[len(quick) - k - 1] if len(quick) > k + 1 else -np.inf
                near = a + np.flatnonzero(quick >= worst - 1e-9 * max(1.0, abs(worst)))
                exact = (matrix[near] * vector).sum(axis=1)
                out["query"].append(np.full(len(near), entry))
                out["entry"].append(entries[near])
                out["score"].append(exact)
        return pd.DataFrame({
            name: np.concatenate(parts) if parts else np.zeros(0, float if name == "score" else np.int64)
            for name, parts in out.items()
        })

    stored = index.select("entry", "vector", "keys").mapInPandas(
        place, "tree int, block int, key bigint, entry bigint, vector array<double>"
    )
    routed = asked.mapInPandas(route, "tree int, block int, low bigint, high bigint, entry bigint, vector array<double>")
    found = stored.groupBy("tree", "block").cogroup(routed.groupBy("tree", "block")).applyInPandas(
        search, "query bigint, entry bigint, score double"
    )
    found = found.groupBy("query", "entry").agg(F.max("score").alias("score"))
    place_of = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "entry"))
    found = found.withColumn("place", place_of).filter(F.col("place") <= k + 1)
    named = found.join(index.select("entry", "ids"), "entry").select("query", "score", F.explode("ids").alias("vec_id"))
    # Every id of a query's own vector asks the same question; each leaves itself out.
    best = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    named = named.withColumn("place", best).filter(F.col("place") <= k + 1)
    answers = asking.select(F.col("vec_id").alias("query_id"), F.col("entry").alias("query")).join(named, "query")
    answers = answers.filter("query_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).cast("int")
    return answers.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
