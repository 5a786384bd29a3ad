"""Best-fit packing of documents into token sequences, large items matched first.

Documents become token ids in tasks; only the number of pieces per length goes to the driver, which is one number for each
length up to the capacity, whatever the size of the corpus. From these counts follows a plan: pieces above a third of the
capacity are matched greedily, longest first, with the fullest sequence that has room, so at most two of them share one; the
smaller ones then fill the remaining gaps, longest first, each in the smallest gap that fits. A plan row places a range of
ranks of one length, so the plan has a few thousand rows at most; each piece finds its place from its rank among the pieces
of its length, and ranks are computed without gathering a length in one task.

Defined results: null and empty texts are the end token alone; repeated rows are packed each; a null doc_id is a document like
any other; an empty table gives an empty table; only `doc_id` and `text` are read.
"""

from __future__ import annotations

import base64
import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetide.llm.common import rank_in_cells
from pagetide.session import materialise

PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids binary"
BATCH_ROWS = 256


def load_encoding(path: str):
    """The byte-level vocabulary of `path`, as ranks. Strings of special tokens are ordinary text.

    Kept in the library's own registry, so that the tasks of a worker share one.
    """
    import public_tokenizers
    import tiktoken
    from tiktoken.registry import ENCODINGS

    if path not in ENCODINGS:
        with open(path if "/" in path else public_tokenizers.path(path), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        ENCODINGS[path] = tiktoken.Encoding(
            path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
    return ENCODINGS[path]


def token_pieces(docs: DataFrame, tokenizer: str = "byte_bpe_50k.tiktoken", capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """The pieces of every document: doc_id, piece (from 0), start, length and ids, little-endian unsigned 32-bit numbers.

    `tokenizer` is a rank file of the public tokenizers, or a path to one; the default gives the ids of `byte_bpe_50k.json` at
    four times its speed. A document longer than the capacity is cut from its end, so that its first piece is the shorter one.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, end = load_encoding(tokenizer), np.array([end_id], "<u4").tobytes()
        for whole in batches:
            # A few documents at a time: what stands in the memory of the worker is their text and ids.
            for batch in (whole.slice(at, BATCH_ROWS) for at in range(0, len(whole), BATCH_ROWS)):
                rows = []
                for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                    encoded = encoding.encode_to_numpy(text or "").astype("<u4", copy=False).tobytes() + end
                    total = len(encoded) // 4
                    head = total % capacity or capacity
                    starts = [0, *range(head, total, capacity)] if total > capacity else [0]
                    for k, start in enumerate(starts):
                        stop = starts[k + 1] if k + 1 < len(starts) else total
                        rows.append((doc, k, start, stop - start, encoded[4 * start : 4 * stop]))
                columns = zip(*rows, strict=True)
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)],
                    ["doc_id", "piece", "start", "length", "ids"],
                )

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(cut, PIECE_SCHEMA)


class Plan:
    """Where the pieces of each length go, worked out on their counts.

    `gaps` holds the sequences by free room, as ranges of sequence numbers that are filled alike. A row of the plan places
    `count` pieces from `rank` on, `per` to a sequence, from sequence `first` and position `offset` on.
    """

    def __init__(self, capacity: int) -> None:
        self.capacity, self.sequences = capacity, 0
        self.gaps: dict[int, list[tuple[int, int]]] = {}
        self.open: list[int] = []
        self.rows: list[tuple[int, int, int, int, int, int]] = []

    def _free(self, room: int, first: int, count: int) -> None:
        if count and room:
            if room not in self.gaps:
                bisect.insort(self.open, room)
                self.gaps[room] = []
            self.gaps[room].append((first, count))

    def _fill(self, length: int, rank: int, n: int, room: int, first: int, count: int, most: int) -> int:
        """Fill `count` sequences of equal room as far as the `n` pieces go; returns how many were placed."""
        per = min(most, room // length)
        full = min(count, n // per)
        rest = min(per - 1, n - full * per) if full < count else 0
        offset = self.capacity - room
        if full:
            self.rows.append((length, rank, full * per, first, offset, per))
            self._free(room - per * length, first, full)
        if rest:
            self.rows.append((length, rank + full * per, rest, first + full, offset, rest))
            self._free(room - rest * length, first + full, 1)
        used = full + (rest > 0)
        self._free(room, first + used, count - used)
        return full * per + rest

    def place(self, length: int, n: int, most: int) -> None:
        rank = 0
        while rank < n:
            at = bisect.bisect_left(self.open, length)
            if at == len(self.open):
                per = min(most, self.capacity // length)
                count = -(-(n - rank) // per)
                first, self.sequences = self.sequences, self.sequences + count
                rank += self._fill(length, rank, n - rank, self.capacity, first, count, most)
                continue
            room = self.open[at]
            first, count = self.gaps[room].pop()
            if not self.gaps[room]:
                del self.gaps[room], self.open[at]
            rank += self._fill(length, rank, n - rank, room, first, count, most)


def plan(counts: dict[int, int], capacity: int) -> Plan:
    made = Plan(capacity)
    for length in sorted(counts, reverse=True):
        large = 3 * length > capacity
        made.place(length, counts[length], 2 if large else capacity)
    return made


def pack(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """Adds `sequence_id` and `offset` to pieces with doc_id, piece and length. Other columns are carried along."""
    staged = materialise(pieces, "pieces", keep=True)
    counts = {row["length"]: row["count"] for row in staged.groupBy("length").count().collect()}
    rows = np.array(sorted(plan(counts, capacity).rows), np.int64).reshape(-1, 6)
    # A length is at most the capacity, so (length, rank) sort as one number.
    keys = (rows[:, 0] << 48) + rows[:, 1]
    ranked = rank_in_cells(staged, ["length"], ["doc_id", "piece"], "__rank", sum(counts.values()))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("__rank").to_numpy()
            row = rows[np.searchsorted(keys, (length << 48) + rank, side="right") - 1]
            past = rank - row[:, 1]
            names = [name for name in batch.schema.names if name != "__rank"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(name) for name in names], pa.array(row[:, 3] + past // row[:, 5]),
                 pa.array(row[:, 4] + past % row[:, 5] * length)],
                [*names, "sequence_id", "offset"],
            )

    kinds = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in staged.schema)
    return ranked.select(*staged.columns, "__rank").mapInArrow(place, f"{kinds}, sequence_id bigint, offset bigint")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed token sequences themselves: sequence_id, n_tokens and the ids of its pieces in order."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    gathered = packed.groupBy("sequence_id").agg(ordered.alias("parts"))
    return gathered.select(
        "sequence_id",
        F.aggregate("parts", F.lit(0).cast("bigint"), lambda n, part: n + part["length"]).alias("n_tokens"),
        F.aggregate("parts", F.unhex(F.lit("")), lambda ids, part: F.concat(ids, part["ids"])).alias("ids"),
    )
