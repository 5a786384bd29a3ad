"""The fold against the sequential rule, with and without splitting hot keys."""

import random

import pytest
from pyspark.sql import functions as F

from pagetide.operators.fold import fold_versions
from pagetide.operators.scans import previous_value, running_max

SCHEMA = "k string, seq long, ts long, text string"


def sequential(rows, stored=()):
    state = {k: (ts or 0, text) for k, ts, text in stored}
    result = {}
    for k, seq, ts, text in sorted(rows, key=lambda row: row[1]):
        number = ts or 0
        if k not in state:
            result[seq] = ("inserted", None)
            state[k] = (number, text)
        elif number > state[k][0] or text != state[k][1]:
            result[seq] = ("updated", state[k][0])
            state[k] = (number, text)
        else:
            result[seq] = ("unchanged", state[k][0])
    return result


def random_rows(seed, count, keys, hot_share, texts=("a", "b", "", None)):
    rng = random.Random(seed)
    rows = []
    for seq in range(count):
        key = "hot" if rng.random() < hot_share else f"k{rng.randrange(keys)}"
        rows.append((key, seq, rng.choice([None, *range(6)]), rng.choice(texts)))
    return rows


def folded(spark, rows, stored=None, hot_rows=None):
    df = spark.createDataFrame(rows, SCHEMA)
    current = None if stored is None else spark.createDataFrame(stored, "k string, ts long, text string")
    out = fold_versions(df, "k", ["seq"], "ts", "text", current, hot_rows)
    return {r["seq"]: (r["outcome"], r["previous_timestamp_updated"]) for r in out.collect()}


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("hot_rows", [None, 25])
def test_fold_equals_sequential_rule(spark, seed, hot_rows):
    rows = random_rows(seed, 600, 60, 0.4)
    assert folded(spark, rows, hot_rows=hot_rows) == sequential(rows)


@pytest.mark.parametrize("texts", [("same",), ("a", "a", "a", "a", "a", "a", "a", "b")])
def test_hot_key_with_islands_longer_than_a_chunk(spark, texts):
    rng = random.Random(5)
    rows = [("hot", seq, rng.randrange(50), rng.choice(texts)) for seq in range(400)]
    assert folded(spark, rows, hot_rows=10) == sequential(rows)


@pytest.mark.parametrize("hot_rows", [None, 25])
def test_fold_over_stored_versions(spark, hot_rows):
    rows = random_rows(11, 500, 50, 0.4)
    stored = [(f"k{i}", 3 if i % 3 else None, "a" if i % 2 else None) for i in range(0, 50, 2)] + [("hot", 2, "b")]
    assert folded(spark, rows, stored, hot_rows) == sequential(rows, stored)


@pytest.mark.parametrize("hot_rows", [None, 20])
def test_previous_value_and_running_max(spark, hot_rows):
    rng = random.Random(3)
    rows = [("hot" if i % 3 == 0 else f"k{i % 7}", i, rng.choice([None, *range(9)]), rng.choice("ab")) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    before, top, expected_before, expected_top = {}, {}, {}, {}
    for k, seq, ts, text in rows:
        expected_before[seq] = before.get(k, "*")
        before[k] = text
        if ts is not None:
            top[k] = max(top.get(k, ts), ts)
        expected_top[seq] = top.get(k)
    out = previous_value(df, ["k"], ["seq"], "text", "before", F.lit("*"), hot_rows)
    assert {r["seq"]: r["before"] for r in out.collect()} == expected_before
    out = running_max(df, ["k"], ["seq"], {"top": F.col("ts")}, hot_rows)
    assert {r["seq"]: r["top"] for r in out.collect()} == expected_top


def test_previous_value_keeps_a_null_before_it(spark):
    rows = [("hot", i, i, None if i % 2 else "x") for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = previous_value(df, ["k"], ["seq"], "text", "before", F.lit("*"), 5).collect()
    assert {r["seq"]: r["before"] for r in out} == {i: "*" if i == 0 else (None if (i - 1) % 2 else "x") for i in range(40)}


def test_cold_fold_needs_one_exchange_and_one_sort(spark):
    df = spark.createDataFrame(random_rows(1, 50, 10, 0), SCHEMA)
    out = fold_versions(df, "k", ["seq"], "ts", "text")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1
