import json
import random

import pytest
from pyspark.sql import functions as F

from fixtures import payload, review
from pagetide.operators.merges import merge_reviews
from pagetide.operators.normalize import conform
from pagetide.plans.standins import REVIEWS_IN_ORDER
from pagetide.plans.store import CHANGES, StaleRead, Store
from pagetide.schemas import DEFAULTS
from pagetide.sinks.files import land_pages
from pagetide.sources.landing import LANDED, read_landed_pages
from pagetide.streaming.upsert import PAGE_ORDER, landed_reviews, merge_load, once, stream_pages, stream_reviews

KEEP = ["recommendationid", "run_id", "review", "timestamp_updated"]


def versions(spark, seed=1, count=120):
    rng = random.Random(seed)
    rows = [
        (f"k{rng.randrange(15)}" if i % 3 else "hot", f"run-{i // 40}", "7", rng.choice(["a", "b", None]), rng.randrange(5), i)
        for i in range(count)
    ]
    df = spark.createDataFrame(
        rows, "recommendationid string, run_id string, app_id string, review string, timestamp_updated long, event_id long"
    )
    return conform(df, REVIEWS_IN_ORDER, DEFAULTS["reviews"])


def table(df):
    return sorted(tuple(row) for row in df.select(*KEEP).fillna("?").collect())


def test_stream_equals_batch_and_replays_change_nothing(spark, tmp_path):
    rows = versions(spark)
    source = tmp_path / "in"
    for run in range(3):
        rows.filter(F.col("run_id") == f"run-{run}").coalesce(1).write.parquet(str(source / f"part={run}"))
    store = Store(spark, str(tmp_path / "store"))
    for run in range(3):
        # One folder per micro-batch, so that the batches come in run order.
        stream = spark.readStream.schema(REVIEWS_IN_ORDER).parquet(str(source / f"part={run}"))
        stream_reviews(stream, store, str(tmp_path / f"checkpoint-{run}"), ["event_id"], hot_rows=10).awaitTermination()
    expected = merge_reviews(None, rows, ["event_id"]).table
    assert table(store.read("reviews")) == table(expected)
    changes = merge_reviews(None, rows, ["event_id"]).changes.drop("changed_at")
    assert sorted(map(repr, store.read("review_changes").drop("changed_at").collect())) == sorted(map(repr, changes.collect()))

    load = store.last_load()
    once(store, str(tmp_path / "checkpoint-2"), merge_load(store, ["event_id"]))(rows.filter("run_id = 'run-2'"), 0)
    assert store.last_load() == load and table(store.read("reviews")) == table(expected)


def test_unpublished_load_is_invisible(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    rows = merge_reviews(None, versions(spark), ["event_id"]).table
    store.publish({"reviews": ("changes", rows)})
    rows.write.parquet(str(tmp_path / "store" / "reviews" / "part=torn"))
    assert store.read("reviews").count() == rows.count()
    store.publish({"reviews": ("changes", rows)}, "again")
    assert store.read("reviews").count() == rows.count()


def test_splitting_a_load_gives_the_same_table(spark):
    rows = versions(spark, seed=4)
    first, second = rows.filter("event_id < 50"), rows.filter("event_id >= 50")
    stored = merge_reviews(None, first, ["event_id"]).table
    for hot_rows in (None, 15):
        whole = merge_reviews(None, rows, ["event_id"]).table
        assert table(merge_reviews(stored, second, ["event_id"], hot_rows=hot_rows).table) == table(whole)
        replay = merge_reviews(whole, whole.withColumn("event_id", F.lit(999)), ["event_id"], hot_rows=hot_rows)
        assert {r["outcome"] for r in replay.outcomes.collect()} == {"unchanged"}


def test_landed_pages_stream_into_the_table(spark, tmp_path):
    def pages(run, text, code=200):
        document = json.dumps(payload([review("1", text=text, updated=3), review("2", text="same", updated=1)]))
        return spark.createDataFrame(
            [(run, "730", 1, code, document), (run, "730", 2, 500, document)],
            "run_id string, app_id string, page_number int, status_code int, document string",
        )

    landed, store = str(tmp_path / "landed"), Store(spark, str(tmp_path / "store"))
    for run, text in (("r1", "first"), ("r2", "second")):
        land_pages(pages(run, text), landed)
        stream = landed_reviews(spark, landed)
        stream_reviews(stream, store, str(tmp_path / "checkpoint"), PAGE_ORDER).awaitTermination()
    rows = {r["recommendationid"]: (r["review"], r["run_id"]) for r in store.read("reviews").collect()}
    assert rows == {"1": ("second", "r2"), "2": ("same", "r1")}
    batch = merge_reviews(None, landed_reviews(spark, landed, streaming=False), PAGE_ORDER).table
    assert table(batch) == table(store.read("reviews"))


def test_new_checkpoints_and_second_sources_lose_nothing(spark, tmp_path):
    rows, store = versions(spark), Store(spark, str(tmp_path / "store"))
    for run, checkpoint in enumerate(("a", "b", "a2")):
        folder = str(tmp_path / f"in-{run}")
        rows.filter(F.col("run_id") == f"run-{run}").coalesce(1).write.parquet(folder)
        stream = spark.readStream.schema(REVIEWS_IN_ORDER).parquet(folder)
        stream_reviews(stream, store, str(tmp_path / checkpoint), ["event_id"]).awaitTermination()
    assert table(store.read("reviews")) == table(merge_reviews(None, rows, ["event_id"]).table)


def test_two_writers_never_share_a_load(spark, tmp_path, monkeypatch):
    rows = merge_reviews(None, versions(spark), ["event_id"]).table
    one, other = (Store(spark, str(tmp_path / "store")) for _ in range(2))
    half = F.col("recommendationid") < "k5"
    before, taken = one._commit, []

    def late(load, lines):
        """The other writer commits just before."""
        if not taken:
            taken.append(other.publish({"reviews": (CHANGES, rows.filter(half))}))
        return before(load, lines)

    monkeypatch.setattr(one, "_commit", late)
    assert (one.publish({"reviews": (CHANGES, rows.filter(~half))}), taken) == (2, [1])
    assert table(one.read("reviews")) == table(rows)
    with pytest.raises(StaleRead):
        one.publish({"reviews": (CHANGES, rows)}, computed_from=1)
    assert one.compact("reviews") == 3 and one.vacuum() == 2 and table(other.read("reviews")) == table(rows)


def test_stream_fills_all_tables(spark, tmp_path):
    landed, store = str(tmp_path / "landed"), Store(spark, str(tmp_path / "store"))
    for run, text in (("r1", "first"), ("r2", "second")):
        document = json.dumps(payload([review("1", text=text, updated=3), review("2", text="same", updated=1)], cursor=""))
        pages = spark.createDataFrame([(run, "77", 1, 200, document)], "run_id string, app_id string, page_number int, status_code int, document string")
        land_pages(conform(pages, LANDED), landed)
        stream = read_landed_pages(spark, landed, streaming=True)
        stream_pages(stream, store, str(tmp_path / "checkpoint"), "https://x.example", landed).awaitTermination()
    assert [r["run_id"] for r in store.read("runs").orderBy("run_id").collect()] == ["r1", "r2"]
    assert [(r["app_id"], r["first_seen_run_id"], r["last_seen_run_id"]) for r in store.read("apps").collect()] == [("77", "r1", "r2")]
    assert store.read("pages").count() == 2 and store.read("reviews").count() == 2
    changes = store.read("review_changes").collect()
    assert len(changes) == 3 and all(row["changed_at"] for row in changes)
    keys = {row["page_key"] for row in store.read("pages").collect()}
    assert {row["source_page_key"] for row in store.read("reviews").collect()} <= keys
