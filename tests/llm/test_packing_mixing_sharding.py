"""Packing, mixing and sharding against plain versions."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from odd import documents, folder, rows
from tokenizers import Tokenizer

from pagetide.llm.mixing import mix_sources, multipliers
from pagetide.llm.packing import load_encoding, pack, plan, sequences, token_pieces
from pagetide.llm.queries import QUERIES
from pagetide.llm.sharding import kd_shards

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


def test_ids_are_those_of_the_tokenizer(spark, tokenizer):
    texts = [text or "" for _, text, *_ in rows()] + ["'s'll don't ''ve    ́é ²½Ⅷ​ ﻿", "a" * 3000, "\n\n \n x"]
    encoding = load_encoding("byte_bpe_50k.tiktoken")
    for text in texts:
        assert encoding.encode_to_numpy(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("odd", [False, True])
def test_packing_round_trip(spark, tokenizer, tmp_path, odd):
    root = folder(tmp_path / "t", documents=documents(spark)) if odd else TABLES
    docs = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text").collect()
    wanted = Counter()
    for row in docs:
        ids = tokenizer.encode(row["text"] or "", add_special_tokens=False).ids + [2]
        head = len(ids) % 1024 or 1024
        cuts = [0, *range(head, len(ids), 1024)] if len(ids) > 1024 else [0]
        for k, start in enumerate(cuts):
            piece = ids[start : cuts[k + 1] if k + 1 < len(cuts) else None]
            wanted[row["doc_id"], k, start, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes())] += 1
    packed = QUERIES["op4_best_fit_packing"](spark, root).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed) == wanted
    held = defaultdict(list)
    for row in packed:
        held[row["sequence_id"]].append((row["offset"], row["length"]))
    for parts in held.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    assert len(held) == best_fit(Counter(row["length"] for row in packed), 1024)


def best_fit(counts, capacity):
    """Bins of best-fit decreasing, one item at a time."""
    bins = Counter()
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            room = min((room for room in bins if bins[room] and room >= length), default=None)
            if room is None:
                room = capacity
            else:
                bins[room] -= 1
            bins[room - length] += 1
    return sum(bins.values())


@pytest.mark.parametrize("seed", range(8))
def test_plan_is_best_fit(seed):
    rng = random.Random(seed)
    counts = Counter(rng.choice([rng.randint(1, 100), rng.randint(1, 30), 34, 50]) for _ in range(rng.randint(1, 600)))
    made = plan(counts, 100)
    filled, placed = defaultdict(list), Counter()
    for length, rank, count, first, offset, per in made.rows:
        for k in range(count):
            filled[first + k // per].append((offset + k % per * length, length))
            placed[length, rank + k] += 1
    assert placed == Counter((length, k) for length, n in counts.items() for k in range(n))
    for parts in filled.values():
        assert sum(length for _, length in parts) <= 100 and sum(3 * length > 100 for _, length in parts) <= 2
        ends = [offset + length for offset, length in sorted(parts)]
        assert [offset for offset, _ in sorted(parts)] == [0, *ends[:-1]]
    assert len(filled) == made.sequences == best_fit(counts, 100)


def test_packed_sequences_hold_the_ids(spark, tokenizer):
    docs = spark.createDataFrame([(1, "one two"), (2, "three")], "doc_id bigint, text string")
    (only,) = sequences(pack(token_pieces(docs))).collect()
    ids = np.frombuffer(only["ids"], "<u4").tolist()
    plain = [tokenizer.encode(text, add_special_tokens=False).ids + [2] for text in ("one two", "three")]
    assert ids in (plain[0] + plain[1], plain[1] + plain[0]) and only["n_tokens"] == len(ids)


def plain_targets(sizes):
    order = sorted((source for source in sizes if source is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {source: k % 3 + 1 for k, source in enumerate(order)}
    total, full = sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in full]
        share = (total - sum(full.values())) / max(1, sum(weight[s] for s in rest))
        above = [s for s in rest if share * weight[s] > 3 * sizes[s]]
        if not above:
            return {s: full.get(s, share * weight[s]) for s in order}
        full.update({s: 3 * sizes[s] for s in above})


@pytest.mark.parametrize("odd", [False, True])
def test_mixing_meets_targets(spark, tmp_path, odd):
    docs = documents(spark) if odd else spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    if odd:
        docs = docs.unionAll(docs.filter("doc_id = 8"))
    root = folder(tmp_path / "t", documents=docs)
    source = {row["doc_id"]: row["source"] for row in docs.select("doc_id", "source").collect()}
    mixed = QUERIES["op5_mixing"](spark, root).collect()
    assert len(mixed) == docs.count()
    sizes, taken, largest = Counter(), Counter(), Counter()
    for row in mixed:
        name = source[row["doc_id"]]
        sizes[name] += row["size"]
        taken[name] += row["taken"]
        largest[name] = max(largest[name], row["size"])
        assert row["taken"] == row["copies"] * row["size"] and 0 <= row["copies"] <= 3
    targets = plain_targets(sizes)
    for row in mixed:
        name = source[row["doc_id"]]
        assert row["source_size"] == sizes[name] and row["target"] == pytest.approx(targets[name], rel=1e-9)
    for name in sizes:
        assert abs(taken[name] - targets[name]) <= (largest[name] if odd else 0.02 * targets[name])
    again = QUERIES["op5_mixing"](spark, root).collect()
    assert sorted(map(str, again)) == sorted(map(str, mixed))


def test_mixing_carries_columns_and_takes_empty_tables(spark):
    assert mix_sources(documents(spark, [])).count() == 0
    assert mix_sources(documents(spark), carry=("text", "lang")).columns[:3] == ["doc_id", "text", "lang"]


def test_rates_are_tilted_exponentially(spark):
    """Above its size, a source repeats its longer documents before its shorter ones; below, it drops them first."""
    found = [(k, "w " * (k % 50 + 1), "en", "b", 0) for k in range(400)] + [(1000 + k, "w " * 60, "en", "a", 0) for k in range(400)]
    mixed = mix_sources(documents(spark, found)).collect()
    short = [row["copies"] for row in mixed if row["doc_id"] < 400 and row["size"] <= 10]
    long = [row["copies"] for row in mixed if row["doc_id"] < 400 and row["size"] > 40]
    assert sum(long) / len(long) > sum(short) / len(short) >= 1


def plain_multiplier(cells, target, cap):
    """The root of words taken less target, by halving."""
    mean = sum(size * n for size, n in cells) / sum(n for _, n in cells)
    low, high = -1000.0, 1000.0
    for _ in range(200):
        at = (low + high) / 2
        words = sum(n * size * math.exp(min(at * size / mean, math.log(cap))) for size, n in cells)
        low, high = (at, high) if words < target else (low, at)
    return at


@pytest.mark.parametrize("newton_steps", [100, 0])
def test_multipliers_solve_the_dual(spark, monkeypatch, newton_steps):
    monkeypatch.setattr("pagetide.llm.mixing.NEWTON_STEPS", newton_steps)
    cells = {"more": [(1, 50), (7, 20), (400, 2)], "less": [(3, 9), (90, 5)], "nearly all": [(2, 5), (1000, 1)]}
    targets = {"more": 2500.0, "less": 100.0, "nearly all": 3029.0}
    table = spark.createDataFrame([(k, *cell) for k, own in cells.items() for cell in own], "key string, size bigint, n bigint")
    words = {k: sum(size * n for size, n in own) for k, own in cells.items()}
    sources = spark.createDataFrame(
        [(k, words[k], words[k] / sum(n for _, n in cells[k]), targets[k]) for k in cells],
        "key string, source_size bigint, mean double, target double",
    )
    found = {row["key"]: row["multiplier"] for row in multipliers(table, sources, 3).collect()}
    assert set(found) == set(cells)
    for key, at in found.items():
        assert at == pytest.approx(plain_multiplier(cells[key], targets[key], 3), rel=1e-4)


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_shards_are_even_and_gapless(spark, shards):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = kd_shards(docs, shards=shards).collect()
    texts = {row["doc_id"]: (row["text"] or "").encode() for row in docs.collect()}
    assert len(found) == len(texts)
    total, slots = Counter(), defaultdict(list)
    for row in found:
        assert row["size"] == len(texts[row["doc_id"]]) + 1 and row["text_crc32"] == zlib.crc32(texts[row["doc_id"]])
        total[row["shard"]] += row["size"]
        slots[row["shard"]].append(row["slot"])
    assert set(total) == set(range(shards)) and max(total.values()) - min(total.values()) <= max(map(len, texts.values()))
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())


def test_two_shards_split_along_one_dimension(spark):
    """Sizes are equal but for two groups of them, so size is the widest dimension."""
    found = [(k, "x" * (10 if k % 2 else 1000), "en", "s", 0) for k in range(300)]
    sizes = defaultdict(list)
    for row in kd_shards(documents(spark, found), shards=2).collect():
        sizes[row["shard"]].append(row["size"])
    assert max(sizes[0]) <= min(sizes[1]) and abs(sum(sizes[0]) - sum(sizes[1])) <= 1001


def test_shards_of_odd_tables(spark):
    docs = documents(spark)
    found = kd_shards(docs.unionAll(docs), target_bytes=20_000).collect()
    assert len(found) == 2 * docs.count() and {row["size"] for row in found if row["doc_id"] == 1} == {1}
    assert kd_shards(documents(spark, []), shards=8).count() == 0
    one = kd_shards(documents(spark, [(k, "same", "en", "s", 0) for k in range(80)]), shards=8).collect()
    assert set(Counter(row["shard"] for row in one).values()) == {10}
