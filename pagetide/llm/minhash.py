"""Near-duplicate groups: one-permutation hashing with optimal densification, banded buckets and star-shaped edges.

A document is the set of its word shingles. Rows with equal sets are one class, a node, represented by its smallest doc_id. Each
class gets a one-permutation sketch; an empty bin borrows from the first filled bin of its own random probe sequence. Bands of
the sketch are buckets; buckets of the same members are one. Each bucket links its members to its smallest one, so a bucket of n
members gives n - 1 candidates. Every candidate is confirmed on the full sets.

A star alone can miss a link between two members that are both unlike the centre. All buckets of one centre are one star from then
on, in which a member is one row, however many buckets it shares with the centre; near copies share most of their bands. Stars whose
members are not yet in one component go on: members with too many shingles of their own to have any link leave them, by an exact
bound, and in each further round more of the rest become leads (16, 256 ...) for those members of other components that they share
a bucket with. A lead has met its whole star and leaves it, so only members that were never a lead are left; the star goes on until
these are of one component. Real groups end after one round, and strays at the bound, so the rounds are few.

Defined results: texts without words and null texts have an empty set and are linked with nothing; rows with a null doc_id are
linked with nothing, have a null component and are kept; a repeated row belongs to the same class; rows that share a doc_id but not
their set are judged each by its own set; an empty table gives an empty table; only `doc_id` and `text` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetide.llm.common import rank_in_cells
from pagetide.session import materialise, scratch

CHUNK_BYTES = 1 << 20

# A table of at most so many short rows, as counted, is worked on in one task and broadcast; results are the same either way.
FEW_ROWS = 200_000

# Cells that the shingles of a set are counted by, to bound what two sets share.
CELLS = 128

# A further round has so many times the leads of the one before.
ROUND_GROWTH = 16
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A finalizer that spreads every input bit over the 64 output bits."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _random(n: int, seed: int) -> np.ndarray:
    steps = np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 40)
    return mix(steps * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


class Shingler:
    """64-bit hashes of the word shingles of many texts at once."""

    def __init__(self, words: int) -> None:
        self.words = words
        self.byte, self.place, self.order = _random(256, 1), _random(1 << 12, 2), _random(words, 3)

    def word_hashes(self, buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of every word of the bytes: a random multilinear function of bytes and places."""
        inside = ~_SPACE[buffer]
        edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
        starts, lengths = edges[0::2], edges[1::2] - edges[0::2]
        if not len(starts):
            return starts, np.zeros(0, np.uint64)
        if lengths.max() > len(self.place):
            self.place = _random(int(lengths.max()) * 2, 2)
        first = np.cumsum(lengths) - lengths
        at = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
        return starts, mix(np.add.reduceat(self.byte[buffer[inside]] * self.place[at], first))

    def sets(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The sorted distinct shingle hashes of each text."""
        chunk, size = [], 0
        for text in texts:
            chunk.append((text or "").encode("utf-8", "surrogatepass").lower())
            size += len(chunk[-1])
            if size > CHUNK_BYTES:
                yield from self._chunk(chunk)
                chunk, size = [], 0
        yield from self._chunk(chunk)

    def _chunk(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        if not texts:
            return
        begins = np.cumsum([0, *[len(text) + 1 for text in texts]])
        starts, hashes = self.word_hashes(np.frombuffer(b" ".join(texts) + b" ", np.uint8))
        bounds = np.searchsorted(starts, begins)
        w = self.words
        if len(hashes) >= w:
            n = len(hashes) - w + 1
            joined = np.zeros(n, np.uint64)
            for k in range(w):
                joined += hashes[k : k + n] * self.order[k]
            joined = mix(joined)
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if high - low >= w:
                yield np.unique(joined[low : high - w + 1])
            elif high > low:
                short = (hashes[low:high] * self.order[: high - low]).sum(dtype=np.uint64) + np.uint64(high - low)
                yield mix(np.array([short], np.uint64))
            else:
                yield np.zeros(0, np.uint64)


class Sketcher:
    """One-permutation sketches with optimal densification, folded into band hashes."""

    def __init__(self, bands: int, rows: int) -> None:
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        self.probes = (_random(self.bins * 64, 4) >> np.uint64(20)).reshape(64, self.bins) % np.uint64(self.bins)
        self.weights, self.salt = _random(rows, 5), _random(bands, 6)

    def sketch(self, hashes: np.ndarray) -> np.ndarray:
        """`hashes` are sorted, and a bin is a range of hashes: the first of each bin is its minimum."""
        bins = ((hashes >> np.uint64(32)) * np.uint64(self.bins)) >> np.uint64(32)
        first = np.concatenate(([True], bins[1:] != bins[:-1]))
        filled, values = np.zeros(self.bins, bool), np.zeros(self.bins, np.uint64)
        own = bins[first].astype(np.int64)
        filled[own], values[own] = True, hashes[first]
        empty, result, turn = np.flatnonzero(~filled), values.copy(), 0
        while len(empty):
            probes = self.probes[:, empty] if turn == 0 else mix(self.probes[:, empty] + np.uint64(turn << 32)) % np.uint64(self.bins)
            hit = filled[probes]
            found, at = hit.any(axis=0), hit.argmax(axis=0)
            columns = np.flatnonzero(found)
            result[empty[columns]] = values[probes[at[columns], columns].astype(np.int64)]
            empty, turn = empty[~found], turn + 1
        return result

    def fold(self, sketches: np.ndarray) -> np.ndarray:
        cells = sketches.reshape(len(sketches), self.bands, self.rows)
        return mix((cells * self.weights).sum(axis=2, dtype=np.uint64) + self.salt).view(np.int64)


def signatures(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """doc_id, hash of the text, size of the set, a 128-bit key of the whole set, and the band hashes (none for an empty set)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, sketcher = Shingler(words), Sketcher(bands, rows)
        for batch in batches:
            sizes, keys, sketches, counts = [], [], [], []
            for hashes in shingler.sets(batch.column("text").to_pylist()):
                sizes.append(len(hashes))
                keys.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                counts.append(bands if len(hashes) else 0)
                if len(hashes):
                    sketches.append(sketcher.sketch(hashes))
            folded = sketcher.fold(np.stack(sketches)).ravel() if sketches else np.zeros(0, np.int64)
            offsets = np.cumsum([0, *counts]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("text_key"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(folded)),
                ],
                ["doc_id", "text_key", "n_shingles", "set_key", "bands"],
            )

    signed = "doc_id bigint, text_key string, n_shingles bigint, set_key binary, bands array<bigint>"
    return docs.withColumn("text_key", text_key(F.col("text"))).mapInArrow(sign, signed)


def text_key(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """(node, shingles, cells) of rows that come with the key of the set that stands for the node; rows of another set are passed over.

    `cells` counts the shingles by their last bits.
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            nodes, found, cells = [], [], []
            all_sets = shingler.sets(batch.column("text").to_pylist())
            for node, key, hashes in zip(batch.column("node").to_pylist(), batch.column("set_key").to_pylist(), all_sets, strict=True):
                if xxhash.xxh3_128_digest(hashes.tobytes()) == key:
                    nodes.append(node)
                    found.append(hashes)
                    cells.append(np.bincount((hashes % np.uint64(CELLS)).astype(np.int64), minlength=CELLS))
            offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
            flat = np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)
            counts = np.concatenate(cells).astype(np.int32) if cells else np.zeros(0, np.int32)
            ends = np.arange(len(found) + 1, dtype=np.int32) * np.int32(CELLS)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(nodes, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(counts)),
                ],
                ["node", "shingles", "cells"],
            )

    return docs.select("node", "set_key", "text").mapInArrow(sets, "node bigint, shingles array<bigint>, cells array<int>")


def shared_buckets(members: DataFrame) -> DataFrame:
    """(bucket, node, n, centre) of the buckets with more than one member; of buckets with the same members only one.

    Near copies share most of their bands. The oldest document is the centre: the likeliest to be what the others were copied from.
    """
    hashes = [F.sum(F.xxhash64(F.lit(seed), "node").cast("decimal(38,0)")).alias(f"hash_{seed}") for seed in (1, 2)]
    buckets = members.groupBy("bucket").agg(
        F.min(F.struct("doc_id", "node"))["node"].alias("centre"), F.count(F.lit(1)).alias("rows"), F.min("node").alias("low"),
        F.max("node").alias("high"), *hashes,
    )
    buckets = buckets.filter("low <> high").groupBy("rows", "low", "high", "hash_1", "hash_2").agg(
        F.min(F.struct("bucket", "centre")).alias("first")
    )
    return members.drop("doc_id").join(buckets.select("first.*"), "bucket").distinct()


def few(df: DataFrame, pairs: Column | None = None) -> tuple[DataFrame, int]:
    """A written table, in one partition if it has few rows and these make few `pairs`, and its number of rows."""
    rows, made = df.agg(F.count(F.lit(1)), F.lit(0) if pairs is None else F.coalesce(F.sum(pairs), F.lit(0))).first()
    return (df.coalesce(1) if max(rows, made) <= FEW_ROWS else df), rows


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the edges (a, b): the smallest node reachable.

    Alternates the two star operations until nothing changes: neighbours above a node move to its smallest neighbour, then
    those below do. All of it are joins and minima by node, which combine before their shuffle. Few edges, as counted, are worked
    on in one task.
    """
    near, rows = few(edges)
    if rows <= FEW_ROWS:
        return materialise(near.select("a", "b").mapInArrow(components_of_few, "node bigint, label bigint"), "components", keep=True)
    with scratch(edges.sparkSession):
        stars = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("label"))
        stars, before = materialise(stars.filter("node <> label").distinct(), "stars"), None
        while True:
            stars, _ = few(stars)
            state = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "label").cast("decimal(38,0)"))).first()
            if state == before:
                break
            before = state
            both = stars.unionByName(stars.select(F.col("label").alias("node"), F.col("node").alias("label")))
            low = both.groupBy("node").agg(F.least(F.min("label"), F.col("node")).alias("low"))
            large = both.join(low, "node").filter("label > node").select(F.col("label").alias("node"), F.col("low").alias("label"))
            large = large.filter("node <> label").distinct()
            low = large.groupBy("node").agg(F.min("label").alias("low"))
            joined = large.join(low, "node")
            small = joined.select(F.explode(F.array(
                F.struct(F.col("label").alias("node"), F.col("low").alias("label")),
                F.struct(F.col("node"), F.col("low").alias("label")),
            )).alias("e")).select("e.*")
            stars = materialise(small.filter("node <> label").distinct(), "stars")
        roots = stars.select(F.col("label").alias("node"), "label").distinct()
        return materialise(stars.unionByName(roots), "components", keep=True)


def components_of_few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same for the edges of one task: the smaller root of two that are linked stands for both."""
    above: dict[int, int] = {}

    def root(node: int) -> int:
        while above.setdefault(node, node) != node:
            above[node] = above[above[node]]
            node = above[node]
        return node

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            low, high = sorted((root(a), root(b)))
            above[high] = low
    nodes = list(above)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(list(map(root, nodes)), pa.int64())], ["node", "label"])


def measure(pairs: DataFrame, rows: int, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with `shared`, how many shingles the full sets share, and whether that makes them `linked`.

    `rows` is the number of pairs; few pairs go to the sets, and many meet them in a shuffle.
    """
    near = F.broadcast if rows <= FEW_ROWS else (lambda df: df)
    of_b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b")).join(near(pairs), "b")
    centres = sets.join(near(pairs.select(F.col("a").alias("node")).distinct()), "node", "left_semi")
    both = of_b.join(centres.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a")
    counted = both.select(
        "a", "b", F.size(F.array_intersect("set_a", "set_b")).alias("shared"), (F.size("set_a") + F.size("set_b")).alias("total")
    )
    linked = 100 * F.col("shared") >= percent * (F.col("total") - F.col("shared"))
    return counted.select("a", "b", "shared", linked.alias("linked"))


def by_node(members: DataFrame, *columns: str) -> DataFrame:
    """One row a node, with its stars in the list `met`: one for each of its bands at most."""
    return members.groupBy("node").agg(
        *(F.first(c).alias(c) for c in columns), F.collect_list(F.struct("centre", "of_centre", "least")).alias("met")
    )


def by_star(nodes: DataFrame) -> DataFrame:
    others = [c for c in nodes.columns if c != "met"]
    return nodes.select(*others, F.explode("met").alias("m")).select(*others, "m.*")


def open_members(members: DataFrame) -> DataFrame:
    """The members of those stars that hold more than one component, with the least size in the star.

    All are still to be leads: those that were have left.
    """
    spans = members.groupBy("centre").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min("n").alias("smallest"))
    spans = spans.filter("low <> high").select("centre", "smallest")
    return members.join(spans, "centre").withColumn("least", F.col("smallest")).drop("smallest")


def linkable(members: DataFrame, rows: int, sets: DataFrame, percent: int) -> DataFrame:
    """Those members that can have a link to another one, with `common`: how many of their shingles any other member holds.

    A link shares at least percent / (100 + percent) of the two sizes together, and cannot share more than `common`. The bound
    is exact. The centres count as holders.
    """
    nodes = members.select("node").unionByName(members.select(F.col("centre").alias("node"))).distinct()
    near = F.broadcast if rows <= FEW_ROWS else (lambda df: df)
    held = sets.join(near(nodes), "node", "left_semi").select("node", F.explode("shingles").alias("shingle"))
    holders = held.groupBy("shingle").agg(F.count(F.lit(1)).alias("holders"), F.min("node").alias("node"))
    own = holders.filter("holders = 1").groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    sized = by_node(members, "n", "label", "bands", "cells").join(own, "node", "left")
    sized = sized.withColumn("common", F.col("n") - F.coalesce("own", F.lit(0))).drop("own")
    partner = F.greatest(F.col("least"), F.ceil(percent * F.col("n") / 100))
    return by_star(sized).filter((100 + percent) * F.col("common") >= percent * (F.col("n") + partner))


def still_open(members: DataFrame) -> DataFrame:
    """Those in stars that hold more than one component still."""
    mixed = members.groupBy("centre").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high")
    return members.join(mixed.select("centre"), "centre", "left_semi")


def further_pairs(members: DataFrame, rows: int, leads: int, percent: int) -> DataFrame:
    """Pairs of the first `leads` members of a star with members of other components that share a bucket and may be linked.

    Two nodes meet in many stars; a pair is made in the first of those in which its lead is one.
    Two members share at most what the one with less of it shares with the centre, plus what the one with less of it
    shares with other members outside the centre. They share no more in a cell than the one with fewer shingles there has. Sizes and
    these bounds leave out pairs exactly.
    """
    # A node's stars, one entry a band at most, and those of them that it is a lead of.
    met = F.collect_list(F.struct("centre", "place")).over(Window.partitionBy("node"))
    members = members.withColumn("met", met).withColumn("stars", F.transform("met", lambda x: x["centre"]))
    led = F.transform(F.filter("met", lambda x: x["place"] < leads), lambda x: x["centre"])
    lead = members.filter(F.col("place") < leads).select(
        "centre", *[F.col(name).alias(f"{name}_a") for name in ["node", "n", "common", "of_centre", "label", "bands", "cells"]], led.alias("led")
    )
    if rows <= FEW_ROWS // 8:
        # The leads go to the members, so that the pairs of a hot star are made wherever its members are.
        lead = F.broadcast(lead)
    n, n_a = F.col("n"), F.col("n_a")
    outside = F.least(F.col("common") - F.col("of_centre"), F.col("common_a") - F.col("of_centre_a"))
    measured = F.col("of_centre").isNotNull() & F.col("of_centre_a").isNotNull()
    most = F.when(measured, F.least("of_centre", "of_centre_a") + outside).otherwise(F.least("common", "common_a"))
    in_cells = F.aggregate(F.zip_with("cells", "cells_a", lambda x, y: F.least(x, y)), F.lit(0), lambda total, shared: total + shared)
    pairs = lead.join(members, "centre").filter(
        (F.col("label") != F.col("label_a"))
        & ((F.col("place") >= leads) | (F.col("node") > F.col("node_a")))
        & close(n, n_a, percent)
        & ((100 + percent) * most >= percent * (n + n_a))
        & (F.array_min(F.array_intersect("led", "stars")) == F.col("centre"))
        & F.arrays_overlap("bands", "bands_a")
        & ((100 + percent) * in_cells >= percent * (n + n_a))
    )
    return in_order(pairs.select(F.col("node_a").alias("a"), F.col("node").alias("b"))).distinct()


def in_order(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def close(n: Column, other: Column, percent: int) -> Column:
    """Whether sets of these sizes can be similar enough."""
    return (100 * n >= percent * other) & (100 * other >= percent * n)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, bands: int = 32, rows: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links) and kept (doc_id = component_id) per row.

    At a similarity of exactly 0.8, 32 bands of 5 rows miss a pair with a probability of 3 in a million.
    """
    found = near_duplicate_rows(docs, words, percent, bands, rows)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def near_duplicate_rows(docs: DataFrame, words: int = 5, percent: int = 80, bands: int = 32, rows: int = 5) -> DataFrame:
    """The same with `text_key`, a hash of the text that the verdict is on: a doc_id may stand for several texts."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = materialise(signatures(docs, words, bands, rows), "signatures", keep=True)
    with scratch(spark):
        full = signed.filter("n_shingles > 0 and doc_id is not null")
        classes = full.groupBy("set_key").agg(F.min("doc_id").alias("doc_id")).withColumn("node", F.monotonically_increasing_id())
        classes = materialise(classes, "set-classes", keep=True)
        alone = full.join(classes, ["set_key", "doc_id"])
        members = alone.select("node", "doc_id", F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
        shared = materialise(shared_buckets(members), "shared-buckets")
        nodes = classes.join(shared.select("node").distinct(), "node", "left_semi")
        sets = materialise(shingle_sets(docs.join(nodes, "doc_id"), words), "shingle-sets")
        sizes = shared.select(F.col("node").alias("a"), F.col("n").alias("n_a")).distinct()
        tried = shared.filter("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b"), "n").distinct()
        tried = tried.join(sizes, "a").filter(close(F.col("n"), F.col("n_a"), percent)).select("a", "b")
        tried, rows = few(materialise(tried, "star-pairs"))
        first = materialise(measure(tried, rows, sets, percent).groupBy("a", "b").agg(
            F.max("shared").alias("shared"), F.max("linked").alias("linked")
        ), "measured")
        links = first.filter("linked").select("a", "b")
        of_centre = first.select(F.col("a").alias("centre"), F.col("b").alias("node"), F.col("shared").alias("of_centre"))
        others = shared.filter("node <> centre")
        members = others.select("centre", "node", "n").distinct().join(of_centre, ["centre", "node"], "left")
        shares = others.groupBy("node").agg(F.collect_list("bucket").alias("bands"))
        members = by_node(members.withColumn("least", F.col("n")), "n").join(shares, "node").join(sets.select("node", "cells"), "node")
        members = materialise(members, "memberships")
        labels, leads, tried = components(links), 1, in_order(tried)
        while True:
            labelled = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
            left, rows = few(materialise(open_members(by_star(materialise(labelled, "labelled"))), "open-members"))
            left, rows = few(materialise(still_open(linkable(left, rows, sets, percent)), "open-members"))
            if not rows:
                break
            leads *= ROUND_GROWTH
            # Members of small components come first: once they have met their star, the rest of it is one component.
            sizes = left.groupBy("label").agg(F.count(F.lit(1)).alias("label_rows"))
            sized = left.join(F.broadcast(sizes) if rows <= FEW_ROWS else sizes, "label")
            ranked = rank_in_cells(sized, ["centre"], ["label_rows", "node"], "place", rows).drop("label_rows")
            ranked, _ = few(materialise(ranked, "open-ranked"), F.least(F.col("place"), F.lit(leads)))
            pairs = further_pairs(ranked, rows, leads, percent).join(tried, ["a", "b"], "left_anti")
            pairs, rows = few(materialise(pairs, "further-pairs"))
            found = materialise(measure(pairs, rows, sets, percent), "measured")
            tried = tried.unionByName(pairs)
            links = links.unionByName(found.filter("linked").select("a", "b"))
            # Members that left can have no further link, a lead has met all others, and a star of one component stays one.
            labels, members = components(links), by_node(ranked.filter(F.col("place") >= leads), "n", "bands", "cells")
    named = classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    named = named.join(smallest, "label").select("set_key", "component_id")
    linked = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("set_key"))
    placed = signed.select("doc_id", "text_key", "n_shingles", linked.alias("set_key")).join(named, "set_key", "left")
    component = F.coalesce("component_id", "doc_id")
    return placed.select(
        "doc_id", "text_key", "n_shingles", component.alias("component_id"),
        (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept"),
    )
