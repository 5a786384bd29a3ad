import pytest
from pyspark.sql import functions as F

from pagetide.operators import quality, skew
from pagetide.operators.normalize import conform
from pagetide.schemas import REVIEW_CHANGES
from pagetide.session import materialise, scratch, sized_shuffle


@pytest.mark.parametrize("how", ["left", "left_anti", "left_semi", "inner"])
def test_lookup_join_is_the_same_with_and_without_broadcast(spark, monkeypatch, how):
    left = spark.createDataFrame([(i % 5, i) for i in range(40)], "k long, v long")
    right = spark.createDataFrame([(0, "a"), (1, "b"), (9, "c")], "k long, name string")
    small = skew.lookup_join(left, right, "k", how)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = skew.lookup_join(left, right, "k", how)
        assert "Broadcast" not in large._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, large.collect())) == sorted(map(tuple, small.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_broadcast_bounds(spark, monkeypatch):
    numbers = spark.range(10)
    assert skew.is_small(numbers)
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 200)
    assert skew.is_small(numbers)
    assert not skew.is_small(numbers.withColumn("text", F.lit("twelve bytes")))
    assert not skew.is_small(numbers.withColumn("nested", F.array(F.struct(F.lit("twelve bytes")))))
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 9)
    assert not skew.is_small(numbers)


def test_only_hot_groups_are_cut(spark):
    rows = [("hot", i) for i in range(90)] + [(f"k{i}", i) for i in range(90)]
    split = skew.split_hot_groups(spark.createDataFrame(rows, "k string, seq long"), ["k"], ["seq"], 20)
    assert split.cold.count() == 90 and split.cold.filter("k = 'hot'").count() == 0
    chunks = split.hot.groupBy(skew.CHUNK).agg(F.min("seq").alias("lo"), F.max("seq").alias("hi"), F.count("*").alias("n")).orderBy(skew.CHUNK).collect()
    assert len(chunks) > 1 and sum(c["n"] for c in chunks) == 90
    assert all(a["hi"] < b["lo"] for a, b in zip(chunks, chunks[1:]))


def test_scratch_and_shuffle_scopes(spark):
    with scratch(spark):
        copy = materialise(spark.range(5), "t")
        kept = materialise(spark.range(3), "t", keep=True)
        assert copy.count() == 5
    assert kept.count() == 3
    with pytest.raises(Exception):
        spark.read.schema(copy.schema).parquet(*copy.inputFiles()).count()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with sized_shuffle(spark, 10 * 2**40):
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(10 * 2**40 // 2**27)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_constraint_report(spark):
    changes = conform(
        spark.createDataFrame(
            [("r", "1", "7", "inserted", "p"), ("r", "1", "7", "updated", "p"), ("r", "2", "8", "deleted", "q"), ("r", None, "7", None, None)],
            "run_id string, recommendationid string, app_id string, change_type string, source_page_key string",
        ),
        REVIEW_CHANGES,
    )
    apps = spark.createDataFrame([("7",)], "app_id string")
    found = {r["constraint"]: r["violations"] for r in quality.constraint_report({"review_changes": changes, "apps": apps}).collect()}
    assert found["unique review_changes(run_id, recommendationid)"] == 1
    assert found["check review_changes.change_type"] == 1
    assert found["reference review_changes.app_id"] == 1
    assert (found["not null review_changes.recommendationid"], found["not null review_changes.change_type"]) == (1, 1)
    assert found["unique apps(app_id)"] == 0
    with pytest.raises(ValueError, match="check review_changes.change_type: 1"):
        quality.enforce({"review_changes": changes})
    kept, aside = quality.quarantine(changes, "app_id", apps, "app_id")
    assert (kept.count(), aside.count()) == (3, 1)
