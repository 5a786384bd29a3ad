"""Figures kept load by load give the report that counting the tables gives."""

import pytest
from fixtures import SHOP, land, report, review

from pagetide.plans.daily import rebuild_figures, validate
from pagetide.plans.load import load_runs
from pagetide.plans.snapshot import import_tables
from pagetide.plans.store import FULL, Store


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def metrics(store, run_id=None, recount=False):
    return sorted((m["section"], str(m["name"]), str(m["label"]), m["value"]) for m in validate(store, run_id, recount)["metrics"].collect())


def same(store, *runs):
    for run in (None, *runs):
        assert metrics(store, run) == metrics(store, run, recount=True)


def test_figures_follow_replaced_reviews_and_pages(spark, store, tmp_path):
    first = land(tmp_path, "run-1", [(report("run-1"), [review("1"), review("2", text=""), review("3")])])
    load_runs(spark, store, first)
    same(store, "run-1")
    # Reviews move to another run, get and lose their text; one stays.
    second = land(tmp_path, "run-2", [
        (report("run-2"), [review("1", text="", updated=5), review("2", text="now with text", updated=5), review("4")]),
    ])
    load_runs(spark, store, second)
    same(store, "run-1", "run-2")
    # The same run again: its pages and changes are replaced, nothing counts twice.
    load_runs(spark, store, second)
    same(store, "run-1", "run-2")
    for table in ("reviews", "figures"):
        store.compact(table)
    assert store.in_step("figures", ["reviews", "pages", "review_changes"])
    same(store, "run-1", "run-2", "no such run")


def test_report_reads_no_row_of_the_large_tables(spark, store, tmp_path):
    load_runs(spark, store, land(tmp_path, "run-1", [(report("run-1"), [review("1")])]))
    read = " ".join(validate(store)["metrics"].inputFiles())
    assert "/figures/" in read and not any(f"/{table}/" in read for table in ("reviews", "pages", "review_changes"))


def test_what_is_written_past_the_figures_is_counted(spark, store, tmp_path):
    load_runs(spark, store, land(tmp_path, "run-1", [(report("run-1"), [review("1"), review("2")])]))
    row = store.read("reviews").filter("recommendationid = '2'")
    row.selectExpr("*", "1 as line").drop("line").write.parquet(str(tmp_path / "old" / "reviews"))
    tables = {"reviews": spark.read.parquet(str(tmp_path / "old" / "reviews")).selectExpr(
        "* except (recommendationid)", "'9' as recommendationid"
    )}
    import_tables(store, tables.get)
    assert not store.in_step("figures", ["reviews"])
    assert ("counts", "reviews", "None", 3) in metrics(store)
    store.compact("figures")
    assert not store.in_step("figures", ["reviews"])
    rebuild_figures(store)
    assert store.in_step("figures", ["reviews"])
    same(store, "run-1")


def test_repeated_keys_are_counted_and_go_when_replaced(spark, store, tmp_path):
    run = land(tmp_path, "run-1", [(report("run-1"), [review("1"), review("2")])])
    load_runs(spark, store, run)
    rows = store.read("reviews")
    twice = spark.createDataFrame([*rows.collect(), *rows.filter("recommendationid = '1'").collect()], rows.schema)
    store.publish({"reviews": (FULL, twice)})
    rebuild_figures(store)
    assert ("quality", "duplicate_recommendationids", "None", 1) in metrics(store)
    same(store, "run-1")
    load_runs(spark, store, land(tmp_path, "run-2", [(report("run-2"), [review("1", text="other", updated=9)])]))
    assert ("quality", "duplicate_recommendationids", "None", 0) in metrics(store)
    same(store, "run-1", "run-2")


def test_empty_store_reports_zeros(store):
    assert metrics(store) == metrics(store, recount=True) and {value for *_, value in metrics(store)} == {0}
    assert SHOP not in {name for _, name, *_ in metrics(store)}
