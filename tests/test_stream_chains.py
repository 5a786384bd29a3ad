import json
import random

import pytest
from pyspark.sql import functions as F

from fixtures import payload, review
from pagetide.operators.normalize import conform
from pagetide.operators.pages import report_landed_pages
from pagetide.operators.sync import advance_sync_state, app_progress
from pagetide.plans.load import load_pages
from pagetide.plans.store import CHANGES, FULL, Store
from pagetide.schemas import PAGE_REPORT, SYNC_STATE
from pagetide.sinks.files import land_pages
from pagetide.sources.landing import LANDED, read_landed_pages
from pagetide.streaming.upsert import close_runs, page_load, stream_pages

BASE = "https://x.example"
COLUMNS = "run_id string, app_id string, page_number int, status_code int, document string"
PAGE = ["run_id", "app_id", "page_number", "cursor", "next_cursor", "status", "terminal_reason", "review_count", "request_url"]
STATE = [c for c in SYNC_STATE.names if c not in ("last_started_at", "last_completed_at", "updated_at")]


def document(run, app, page, kind):
    reviews = [] if kind == "empty" else [
        review(f"{app}-{page}-{k}", text=f"{run} text", updated=1000 - 10 * page + k) for k in range(2)
    ]
    return json.dumps(payload(reviews, cursor="" if kind == "last" else f"c{page}", success=0 if kind == "bad" else 1))


# Per run and app: what its pages are like, in order. None is a page that never came.
RUNS = {
    ("r1", "10"): ["ok", "ok", "ok", "last", "ok"], ("r1", "20"): ["ok", "empty", "ok"], ("r1", "30"): ["bad", "ok"],
    ("r1", "40"): ["ok", None, "ok", None, "last"], ("r2", "10"): ["ok", "ok"], ("r2", "50"): [None, "ok", "empty"],
    ("r2", "20"): ["ok", "ok", "ok", "ok", "bad", "ok"],
}


def pages(spark):
    rows = [
        (run, app, page, 200, document(run, app, page, kind))
        for (run, app), kinds in RUNS.items() for page, kind in enumerate(kinds, 1) if kind
    ]
    return rows, named(spark.createDataFrame(rows, COLUMNS))


def named(df):
    name = F.format_string("app_%s_page_%04d.json", "app_id", "page_number")
    return conform(df.withColumn("file_name", name).withColumn("raw_json_path", name), LANDED)


def rows_of(df, columns):
    return sorted(tuple(row) for row in df.select(*[F.col(c).cast("string") for c in columns]).fillna("?").collect())


def single_load(store, landed):
    """One run at once, and its state."""
    reports = conform(report_landed_pages(landed, store.read("sync_state"), BASE), PAGE_REPORT)
    load_pages(store, reports, landed.select("run_id", "file_name", "document"), ["run_id", "page_number"], "/landed")
    update = advance_sync_state(store.read("sync_state"), app_progress(reports, ["run_id", "page_number"]))
    store.publish({"sync_state": (CHANGES, update.states)})


def start(spark, path):
    store = Store(spark, str(path))
    state = conform(spark.createDataFrame([("20", 975)], "app_id string, complete_through_timestamp_updated bigint"), SYNC_STATE)
    store.publish({"sync_state": (FULL, state)})
    return store


@pytest.mark.parametrize("seed, hot_rows", [(2, 2)])
def test_pages_dealt_over_loads_in_any_order(spark, tmp_path, seed, hot_rows):
    rows, landed = pages(spark)
    whole, store, parts = start(spark, tmp_path / "whole"), start(spark, tmp_path / "parts"), [[], [], []]
    for run in ("r1", "r2"):
        single_load(whole, landed.filter(F.col("run_id") == run))
    for row in rows:
        # A run's pages come in any order, and the next run's after them.
        parts[random.Random(f"{seed}{row}").randrange(2) if row[0] == "r1" else 2].append(row)
    for part in parts:
        load = page_load(store, BASE, "/landed", hot_rows=hot_rows)
        load(named(spark.createDataFrame(part, COLUMNS)), f"batch-{part}")
    close_runs(store, BASE, "/landed")
    assert rows_of(store.read("pages"), PAGE) == rows_of(whole.read("pages"), PAGE)
    counted = [c for c in whole.read("runs").columns if c != "loaded_at"]
    assert rows_of(store.read("runs"), counted) == rows_of(whole.read("runs"), counted)
    assert rows_of(store.read("sync_state"), STATE) == rows_of(whole.read("sync_state"), STATE)
    for table in ("apps", "reviews"):
        columns = [c for c in whole.read(table).columns if c != "run_id"]
        assert rows_of(store.read(table), columns) == rows_of(whole.read(table), columns)
    assert store.read("waiting_pages").filter("document is not null").isEmpty()


def test_a_run_streamed_page_by_page(spark, tmp_path):
    landed, store = str(tmp_path / "landed"), Store(spark, str(tmp_path / "store"))
    for page, kind in ((3, "ok"), (1, "ok"), (2, "empty")):
        land_pages(named(spark.createDataFrame([("r1", "77", page, 200, document("r1", "77", page, kind))], COLUMNS)), landed)
        if page == 2:
            assert [row["page_number"] for row in store.read("pages").collect()] == [1]
        stream_pages(read_landed_pages(spark, landed, True, 1), store, str(tmp_path / "checkpoint"), BASE, landed).awaitTermination()
    found = {row["page_number"]: (row["cursor"], row["terminal_reason"]) for row in store.read("pages").collect()}
    assert found == {1: ("*", None), 2: ("c1", "empty_page")}
    run, state = store.read("runs").first(), store.read("sync_state").first()
    assert (run["page_count"], run["app_count"], run["review_count"], run["reviews_inserted"]) == (2, 1, 2, 2)
    assert (state["complete_through_timestamp_updated"], state["backlogged"], state["last_page_count"]) == (991, False, 2)
    assert store.read("reviews").count() == 2 and store.read("waiting_pages").filter("document is not null").isEmpty()


def test_late_pages_are_placed_by_number(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    load = page_load(store, BASE, "/landed")

    def land(token, *found):
        rows = [("r1", "77", page, 200, document("r1", "77", page, kind)) for page, kind in found]
        load(named(spark.createDataFrame(rows, COLUMNS)), token)

    land("a", (1, "ok"), (4, "ok"))
    close_runs(store, BASE, "/landed", "r1")
    land("b", (3, "ok"), (1, "ok"), (5, "ok"))
    found = {row["page_number"]: row["cursor"] for row in store.read("pages").collect()}
    assert found == {1: "*", 3: "c1", 4: "c1", 5: "c4"}
    chain = store.read("page_chains").first()
    assert (chain["last_page"], chain["page_count"], chain["review_count"]) == (5, 4, 8)
