"""Conversation prefix trie: which conversations begin with the same turns, and what sharing those turns would save.

A turn is its role and text, known by a 128-bit hash; texts never leave the tasks that read them. The sequences are sorted over the
whole table, by turn ids and then by conversation, into range shards of bounded size. In a shard they are rows of a padded matrix
of turn ids. numpy's lexsort puts them in order; the columns in which a row differs from the one before, OR-accumulated from the
left, mark where nodes start, for every depth; and each node is a run of rows, so that `reduceat` over the starts gives its figures.
A subtree is the same run, and what it saves follows from the common lengths of neighbouring rows alone.

Only nodes on the path of a shard's first or last row can reach into another shard. They are combined over shards by the hash of
their prefix, and the places where one shard ends and the next begins are accounted for once per boundary. As conversations with
equal turns are told apart by their ids, a group of copies of any size spreads over as many shards as it fills.

Defined results: rows without a conv_id take no part; a null turn comes first, turns of equal number go by role and then by the hash
of role and text; a null role or text is empty; repeated rows are turns like any others; conversations without turns end at the root;
an empty table has no nodes, not even a root; only `conv_id`, `turn`, `role` and `text` are read. The ids of one conversation (some 24
bytes a turn) are one row and have to fit a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetide.llm.common import WORD
from pagetide.operators.skew import lookup_join
from pagetide.session import materialise

# Turns and conversations in a shard, and below how many a shard is not split for the sake of more tasks.
SHARD_CELLS, LEAST_CELLS = 1_000_000, 20_000
# Rows a task of the first shuffle gets.
TASK_ROWS = 200_000
WIDTH = 8
OUT_ROWS = 20_000
NODE, BOUNDARY, ENDS = 0, 1, 2

_COLUMNS = {
    "kind": pa.int32(), "shard": pa.int32(), "depth": pa.int64(), "key": pa.binary(), "parent_key": pa.binary(),
    "turn_id": pa.binary(), "conv_id": pa.int64(), "parent_conv_id": pa.int64(), "n_convs": pa.int64(), "n_children": pa.int64(),
    "n_leaves": pa.int64(), "saved_tokens": pa.int64(), "ends_sha256": pa.string(), "words_before": pa.int64(),
    "words_to": pa.int64(), "last_ends": pa.bool_(), "piece": pa.int32(), "ends": pa.string(),
}
_SCHEMA = (
    "kind int, shard int, depth bigint, key binary, parent_key binary, turn_id binary, conv_id bigint, parent_conv_id bigint, "
    "n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string, words_before bigint, "
    "words_to bigint, last_ends boolean, piece int, ends string"
)
NODE_COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "turn_id",
]


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id and a struct of place, id and number of words for every turn."""
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    # The length of the role keeps (role, text) apart from any other cut of the same characters.
    turn_id = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    turn = F.struct(
        F.col("turn").isNotNull().alias("numbered"), F.col("turn").cast("bigint").alias("turn"), role.alias("role"),
        turn_id.alias("id"), F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"),
    )
    return conversations.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("bigint").alias("conv_id"), turn.alias("turn"))


def sequences(conversations: DataFrame, group: int = 1) -> DataFrame:
    """conv_id and its turns in order, as structs. Conversations with the same conv_id - conv_id % group share a task."""
    rows = turn_rows(conversations).withColumn("base", F.col("conv_id") - F.col("conv_id") % group)
    spark = conversations.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-conversations.count() // TASK_ROWS))
    together = rows.repartition(tasks, "base").groupBy("base", "conv_id")
    return together.agg(F.array_sort(F.collect_list("turn")).alias("turns"))


def with_shared_heads(found: DataFrame, longest: int = 4) -> DataFrame:
    """Each conversation begins with the first h turns of its base, h = crc32(conv_id) % longest, in place of its own first h."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest).cast("int")
    own_head = F.when(F.col("conv_id") == F.col("base"), F.slice("turns", 1, longest - 1))
    head = F.coalesce(F.max(own_head).over(Window.partitionBy("base")), F.slice("turns", 1, 0))
    own = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    return found.withColumn("turns", F.concat(F.slice(head, 1, h), own))


def sort_rows(high: np.ndarray, low: np.ndarray, first: np.ndarray, lengths: np.ndarray, conv: np.ndarray) -> np.ndarray:
    """The order of the rows by turn ids and then conv, a block of columns at a time for the rows not yet told apart."""
    order = np.arange(len(conv))
    group, open_rows, column = np.zeros(len(conv), np.int64), np.arange(len(conv)), 0
    while True:
        block = padded(high, low, first, lengths, open_rows, column)
        keys = [conv[open_rows], *(block[:, k] for k in range(block.shape[1] - 1, -1, -1)), group[open_rows]]
        turn = np.lexsort(keys)
        rows = open_rows[turn]
        # The rows of a group fill the places from the group's number on.
        start = np.flatnonzero(np.concatenate(([True], np.diff(group[rows]) != 0)))
        size = np.diff(np.append(start, len(rows)))
        places = np.repeat(group[rows[start]] - start, size) + np.arange(len(rows))
        order[places] = rows
        sorted_block = block[turn]
        other = np.concatenate(([True], (np.diff(group[rows]) != 0) | (sorted_block[1:] != sorted_block[:-1]).any(axis=1)))
        start = np.flatnonzero(other)
        size = np.diff(np.append(start, len(rows)))
        group[rows] = np.repeat(places[start], size)
        column += WIDTH
        longest = np.maximum.reduceat(lengths[rows], start)
        open_rows = rows[np.repeat((size > 1) & (longest > column), size)]
        if not len(open_rows):
            return order


def padded(high: np.ndarray, low: np.ndarray, first: np.ndarray, lengths: np.ndarray, rows: np.ndarray, column: int) -> np.ndarray:
    """WIDTH columns of the matrix of turn ids, two numbers a turn; zeros behind the end of a row."""
    at = column + np.arange(WIDTH)
    inside = at < lengths[rows, None]
    where = np.where(inside, first[rows, None] + at, 0)
    block = np.zeros((len(rows), 2 * WIDTH), np.uint64)
    if len(high):
        block[:, 0::2], block[:, 1::2] = np.where(inside, high[where], 0), np.where(inside, low[where], 0)
    return block


def common_lengths(high: np.ndarray, low: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """How many turns each sorted row has in common with the one before: the columns that the accumulated change mask leaves."""
    common, changed = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), bool)
    changed[:1] = True
    rows, column = np.flatnonzero(lengths > 0), 0
    while len(rows):
        block = padded(high, low, first, lengths, rows, column)
        differs = np.ones((len(rows), WIDTH + 1), bool)
        # The row before may have ended, and then differs in the first column.
        beside = np.flatnonzero(np.diff(rows, prepend=-2) == 1)
        differs[beside, 0] = changed[rows[beside]]
        unequal = block[beside] != block[beside - 1]
        differs[beside, 1:] = unequal[:, 0::2] | unequal[:, 1::2]
        mask = np.logical_or.accumulate(differs, axis=1)[:, 1:]
        common[rows] += (~mask & (column + np.arange(WIDTH) < lengths[rows, None])).sum(axis=1)
        changed[rows] = mask[:, -1]
        column += WIDTH
        rows = rows[lengths[rows] > column]
    return common


class Shard:
    """The sorted rows of one range."""

    def __init__(self, ids: np.ndarray, words: np.ndarray, lengths: np.ndarray, conv: np.ndarray, number: int) -> None:
        self.ids, self.number = ids, number
        high, low = ids[0::2].astype(np.uint64), ids[1::2].astype(np.uint64)
        first = np.cumsum(lengths) - lengths
        order = sort_rows(high, low, first, lengths, conv)
        self.first, self.lengths, self.conv = first[order], lengths[order], conv[order]
        self.common = common_lengths(high, low, self.first, self.lengths)
        self.total = np.concatenate(([0], np.cumsum(words)))
        self.keys = [self.path(0), self.path(len(order) - 1)]

    def words_to(self, rows: np.ndarray, depth: int | np.ndarray) -> np.ndarray:
        return self.total[self.first[rows] + depth] - self.total[self.first[rows]]

    def path(self, row: int) -> list[bytes]:
        """Hashes of all prefixes of a row, from the empty one on."""
        digest, raw = xxhash.xxh3_128(), self.ids[2 * self.first[row] : 2 * (self.first[row] + self.lengths[row])].tobytes()
        found = [digest.digest()]
        for k in range(self.lengths[row]):
            digest.update(raw[16 * k : 16 * k + 16])
            found.append(digest.digest())
        return found

    def nodes(self) -> Iterator[dict[str, list]]:
        """The nodes of each depth, as columns."""
        n, conv, lengths, common = len(self.conv), self.conv, self.lengths, self.common
        leaf = np.append(common[1:] < lengths[:-1], True).astype(np.int64)
        shared = self.words_to(np.arange(n), common)
        above_conv, above_path = np.zeros(n, np.int64), np.zeros(n, np.int8)
        rows, depth = np.arange(n), 0
        while len(rows):
            starts = np.flatnonzero((common[rows] < depth) | (rows == 0)) if depth else np.zeros(1, np.int64)
            first, size = rows[starts], np.diff(np.append(starts, len(rows)))
            smallest = np.minimum.reduceat(conv[rows], starts)
            before = self.words_to(first, max(depth - 1, 0))
            saved = np.add.reduceat(shared[rows], starts) - shared[first] - (size - 1) * before
            children = np.add.reduceat(((common[rows] <= depth) & (lengths[rows] > depth)).astype(np.int64), starts)
            ended = np.add.reduceat((lengths[rows] == depth).astype(np.int64), starts)
            path = np.zeros(len(starts), np.int8)
            path[-1] = 2 * (rows[-1] == n - 1)
            path[0] = 1 if rows[0] == 0 else path[0]
            last = (first + size == n) & (lengths[-1] == depth)
            columns = {
                "kind": [BOUNDARY if p else NODE for p in path.tolist()], "shard": [self.number] * len(starts),
                "depth": [depth] * len(starts), "key": [self.keys[p - 1][depth] if p else None for p in path.tolist()],
                "parent_key": [self.keys[p - 1][depth - 1] if p else None for p in above_path[first].tolist()],
                "turn_id": [self.ids[2 * at : 2 * at + 2].tobytes() for at in (self.first[first] + depth - 1).tolist()] if depth
                else [None],
                "conv_id": smallest.tolist(), "parent_conv_id": above_conv[first].tolist() if depth else [None],
                "n_convs": size.tolist(), "n_children": children.tolist(),
                "n_leaves": np.add.reduceat(leaf[rows], starts).tolist(), "saved_tokens": saved.tolist(),
                "ends_sha256": [None if p else digest_of(conv[f : f + m]) for p, f, m in zip(path.tolist(), first, ended, strict=True)],
                "words_before": before.tolist() if depth else [0], "words_to": self.words_to(first, depth).tolist(),
                "last_ends": last.tolist(), "piece": [None] * len(starts), "ends": [None] * len(starts),
            }
            yield columns
            for at in np.flatnonzero(path):
                yield from self.pieces(depth, columns["key"][at], conv[first[at] : first[at] + ended[at]])
            above_conv[rows], above_path[rows] = np.repeat(smallest, size), np.repeat(path, size)
            depth += 1
            rows = rows[lengths[rows] >= depth]

    def pieces(self, depth: int, key: bytes, ended: np.ndarray) -> Iterator[dict[str, list]]:
        """What of a boundary node's conversations ends in this shard, in order and in short pieces."""
        at = 0
        for start in range(0, len(ended), 256):
            text = ",".join(map(str, ended[start : start + 256].tolist()))
            yield {name: [None] for name in _COLUMNS} | {
                "kind": [ENDS], "shard": [self.number], "depth": [depth], "key": [key], "piece": [at], "ends": [text]
            }
            at += 1


def digest_of(ended: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, ended.tolist())).encode()).hexdigest()


def shard_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard's rows to its nodes, boundary nodes and their ended conversations."""
    parts = [batch for batch in batches if len(batch)]
    if not parts:
        return
    whole = pa.Table.from_batches(parts).combine_chunks()
    lists = whole.column("ids").combine_chunks()
    lengths = lists.value_lengths().to_numpy().astype(np.int64)
    ids = np.frombuffer(b"".join(lists.flatten().to_pylist()), ">u8")
    words = whole.column("words").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    conv = whole.column("conv_id").to_numpy().astype(np.int64)
    shard = Shard(ids, words, lengths, conv, TaskContext.get().partitionId())
    waiting: list[dict[str, list]] = []
    for columns in shard.nodes():
        waiting.append(columns)
        if sum(len(one["kind"]) for one in waiting) >= OUT_ROWS:
            yield _batch(waiting)
            waiting = []
    if waiting:
        yield _batch(waiting)


def _batch(parts: list[dict[str, list]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([value for part in parts for value in part[name]], kind) for name, kind in _COLUMNS.items()], list(_COLUMNS)
    )


def ended_digests(pieces: DataFrame) -> DataFrame:
    """(depth, key, ends_sha256): the pieces of a node go through one task in order and are forgotten at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest = None, None

        def result() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([current[0]], pa.int64()), pa.array([current[1]], pa.binary()), pa.array([digest.hexdigest()])],
                ["depth", "key", "ends_sha256"],
            )

        for batch in batches:
            for depth, key, ends in zip(*(batch.column(name).to_pylist() for name in ("depth", "key", "ends")), strict=True):
                if (depth, key) != current:
                    if current is not None:
                        yield result()
                    current, digest = (depth, key), hashlib.sha256(ends.encode())
                else:
                    digest.update(b"," + ends.encode())
        if current is not None:
            yield result()

    ordered = pieces.repartition("depth", "key").sortWithinPartitions("depth", "key", "shard", "piece")
    return ordered.select("depth", "key", "ends").mapInArrow(run, "depth bigint, key binary, ends_sha256 string")


def combine(boundary: DataFrame) -> DataFrame:
    """Boundary nodes of all shards, each once.

    A node that an earlier shard holds too crosses the boundary in front of its shard. The deepest such node of a shard says how
    much its first row has in common with the last row before it, and every node above it on the path crosses there as well.
    """
    along = Window.partitionBy("depth", "key").orderBy("shard")
    seen = boundary.withColumn("ended_before", F.lag("last_ends").over(along))
    crossing = F.col("ended_before").isNotNull()
    path = F.max(F.when(crossing, F.struct("depth", "words_to", "ended_before"))).over(Window.partitionBy("shard"))
    met = seen.withColumn("deepest", path)

    def corrected(name: str, correction: Column) -> Column:
        return F.sum(F.col(name) + F.when(crossing, correction).otherwise(0)).alias(name)

    return met.groupBy("depth", "key").agg(
        F.min("conv_id").alias("conv_id"), F.first("parent_key").alias("parent_key"), F.first("turn_id").alias("turn_id"),
        F.sum("n_convs").alias("n_convs"),
        corrected("n_children", -(F.col("depth") < F.col("deepest.depth")).cast("bigint")),
        corrected("n_leaves", -F.col("deepest.ended_before").cast("bigint")),
        corrected("saved_tokens", F.col("deepest.words_to") - F.col("words_before")),
    )


def prefix_trie(found: DataFrame, shards: int | None = None) -> DataFrame:
    """The nodes of the trie over sequences (conv_id, turns): NODE_COLUMNS.

    `conv_id` is the smallest conversation that begins with the node's turns, `parent_conv_id` that of the node above (null at the
    root), `n_convs` how many begin so, `n_children` the nodes below, `n_leaves` the childless nodes of its subtree,
    `saved_tokens` the words that one copy of every shared turn of the subtree saves, `ends_sha256` the hash of the ids of those
    conversations that end here, and `turn_id` the 128-bit hash of its last turn.
    """
    rows = found.select("conv_id", F.transform("turns", lambda t: t["id"]).alias("ids"), F.transform("turns", lambda t: t["words"]).alias("words"))
    rows = materialise(rows, "turn-sequences", keep=True)
    if shards is None:
        cells = rows.agg(F.sum(F.size("ids").cast("bigint") + 1)).first()[0] or 0
        wide = rows.sparkSession.sparkContext.defaultParallelism
        shards = max(1, -(-cells // SHARD_CELLS), min(wide, -(-cells // LEAST_CELLS)))
    ranged = rows.repartitionByRange(shards, "ids", "conv_id")
    parts = materialise(ranged.mapInArrow(shard_nodes, _SCHEMA), "trie-parts", keep=True, partition_by=("kind",))
    combined = combine(parts.filter(F.col("kind") == BOUNDARY)).join(ended_digests(parts.filter(F.col("kind") == ENDS)), ["depth", "key"], "left")
    nothing = hashlib.sha256(b"").hexdigest()
    combined = materialise(combined.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(nothing))), "trie-boundary", keep=True)
    parents = combined.select((F.col("depth") + 1).alias("depth"), F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    nodes = parts.filter(F.col("kind") == NODE)
    inner = nodes.filter("parent_key is null")
    outer = lookup_join(nodes.filter("parent_key is not null"), parents, ["depth", "parent_key"], "left")
    edge = lookup_join(combined, parents, ["depth", "parent_key"], "left")
    done = [part.withColumn("parent_conv_id", F.col("above")).select(*NODE_COLUMNS) for part in (outer, edge)]
    return inner.select(*NODE_COLUMNS).unionByName(done[0]).unionByName(done[1])
