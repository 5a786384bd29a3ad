import csv
import json

import pytest
from pyspark.sql import functions as F

from fixtures import CLOSED, SHOP, land, leaf, page_name, report, review, write_targets
from pagetide.__main__ import main
from pagetide.plans.daily import advance, export, run_daily, validate
from pagetide.plans.load import load_runs
from pagetide.plans.snapshot import import_tables
from pagetide.plans.store import Store
from pagetide.operators.quality import incoming_report
from pagetide.operators.sync import high_water_marks, sync_states
from pagetide.sources.landing import read_page_reports
from pagetide.sources.targets import load_targets


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def counts(summary):
    row = summary.first()
    return row["reviews_seen"], row["reviews_inserted"], row["reviews_updated"], row["duplicates_skipped"]


def test_first_load_replay_and_edit(spark, store, tmp_path):
    targets = load_targets(spark, write_targets(tmp_path))
    first = land(tmp_path, "run-1", [(report("ignored"), [review()])])
    assert counts(load_runs(spark, store, first, targets)) == (1, 1, 0, 0)
    assert counts(load_runs(spark, store, first, targets)) == (1, 0, 0, 1)
    second = land(tmp_path, "run-2", [(report("run-2", max_timestamp_updated=2), [review(text="Edited text", updated=2)])])
    assert counts(load_runs(spark, store, second, targets, check=True)) == (1, 0, 1, 0)

    stored = store.read("reviews").collect()
    assert len(stored) == 1
    row = stored[0]
    assert (row["review"], row["run_id"], row["timestamp_updated"]) == ("Edited text", "run-2", 2)
    for name in ("weighted_vote_score", "playtime_at_review", "primarily_steam_deck"):
        assert row[name] == type(row[name])(leaf(name, 0))
    assert row["source_page_key"] == f"run-2:{SHOP}:0001"
    apps = store.read("apps").collect()
    assert [(a["app_id"], a["app_name"], a["first_seen_run_id"], a["last_seen_run_id"]) for a in apps] == [
        (SHOP, "Corner Shop", "run-1", "run-2")
    ]
    changes = store.read("review_changes").orderBy("run_id").collect()
    assert [(c["run_id"], c["change_type"], c["previous_timestamp_updated"], c["new_timestamp_updated"]) for c in changes] == [
        ("run-1", "inserted", None, 1), ("run-2", "updated", 1, 2)
    ]
    assert store.read("runs").count() == 2
    assert store.read("runs").filter("run_id = 'run-1'").first()["duplicates_skipped"] == 1

    update = advance(store, read_page_reports(spark, second), "updated", "start", "end")
    state = store.read("sync_state").collect()
    assert [(s["app_id"], s["complete_through_timestamp_updated"], s["backlogged"]) for s in state] == [(SHOP, 2, False)]
    assert update.states.count() == 1
    asked = spark.createDataFrame([(SHOP,), (CLOSED,)], "app_id string")
    marks = {r["app_id"]: r["high_water"] for r in high_water_marks(store.read("sync_state"), asked).collect()}
    assert marks == {SHOP: 2, CLOSED: 0}
    unknown = sync_states(store.read("sync_state"), asked).filter(F.col("app_id") == CLOSED).first()
    assert unknown["backlogged"] is True and unknown["last_page_count"] == 0

    metrics = {(m["section"], m["name"]): m["value"] for m in validate(store)["metrics"].collect()}
    assert metrics["counts", "reviews"] == 1 and metrics["quality", "duplicate_recommendationids"] == 0
    assert metrics["recommendation_distribution", "recommended"] == 1
    assert metrics["change_counts", "inserted"] == 1 and metrics["sync_state", "complete_count"] == 1


def test_capped_app_does_not_advance(spark, store, tmp_path):
    run = land(tmp_path, "run-capped", [
        (report("run-capped", terminal_reason="page_cap_reached", max_timestamp_updated=10), [review("2001", updated=10)])
    ])
    load_runs(spark, store, run)
    update = advance(store, read_page_reports(spark, run), "updated", "start", "end")
    row = update.states.first()
    assert (row["complete_through_timestamp_updated"], row["backlogged"], row["last_successful_run_id"]) == (0, True, None)


def test_filter_all_is_skipped(spark, store, tmp_path):
    run = land(tmp_path, "run-all", [(report("run-all"), [review()])])
    update = advance(store, read_page_reports(spark, run), "all", "start", "end")
    assert update.skipped_reason == "filter=all is not chronological"
    assert store.read("sync_state").count() == 0


def test_wide_counters(spark, store, tmp_path):
    run = land(tmp_path, "run-wide", [
        (report("run-wide", total_reviews=4_294_967_295), [review("3", updated=1781704271, votes_funny=4_294_967_295)])
    ])
    load_runs(spark, store, run)
    assert store.read("reviews").first()["votes_funny"] == 4_294_967_295
    assert store.read("pages").first()["total_reviews"] == 4_294_967_295


def test_many_runs_at_once_equal_one_by_one(spark, tmp_path):
    def pages(run, seed):
        rows = []
        for page in (1, 2):
            reviews = [
                review(str((seed * 7 + page * 3 + i) % 9), text="abc"[(seed + i) % 3], updated=(seed * 5 + i * page) % 6)
                for i in range(5)
            ]
            rows.append((report(run, page_number=page, app_name=None if seed == 2 else f"Name {seed}"), reviews))
        rows.append((report(run, "440", 1, status="fetch_error", status_code=429, raw_json_path=None, app_name=None), None))
        return rows

    runs = [land(tmp_path, f"run-{seed}", pages(f"run-{seed}", seed)) for seed in range(4)]
    single, bulk = Store(spark, str(tmp_path / "single")), Store(spark, str(tmp_path / "bulk"))
    for run in runs:
        load_runs(spark, single, run)
    load_runs(spark, bulk, runs)
    for table in ("reviews", "apps", "pages"):
        columns = [c for c in single.read(table).columns if c != "changed_at"]
        one = sorted(map(repr, single.read(table).select(*columns).collect()))
        many = sorted(map(repr, bulk.read(table).select(*columns).collect()))
        assert one == many, table
    drop = ["changed_at"]
    assert sorted(map(repr, single.read("review_changes").drop(*drop).collect())) == sorted(
        map(repr, bulk.read("review_changes").drop(*drop).collect()))
    skip = ["loaded_at", "raw_dir"]
    assert sorted(map(repr, single.read("runs").drop(*skip).collect())) == sorted(
        map(repr, bulk.read("runs").drop(*skip).collect()))
    for table in ("reviews", "pages", "review_changes"):
        before = sorted(map(repr, single.read(table).collect()))
        single.compact(table)
        assert single.pending_changes()[table] == 0
        assert sorted(map(repr, single.read(table).collect())) == before


def test_missing_files_raise(spark, store, tmp_path):
    with pytest.raises(FileNotFoundError, match="page report file"):
        load_runs(spark, store, str(tmp_path / "nowhere"))
    run = land(tmp_path, "run-lost", [(report("run-lost"), [review()]), (report("run-lost", page_number=2), None)])
    with pytest.raises(FileNotFoundError, match="raw page"):
        load_runs(spark, store, run)
    assert counts(load_runs(spark, store, run, strict=False)) == (1, 1, 0, 0)


def test_unreadable_documents_and_report_lines_raise(spark, store, tmp_path):
    run = land(tmp_path, "run-torn", [(report("run-torn"), [review()])])
    page = tmp_path / "raw" / "run-torn" / page_name(SHOP, 1)
    page.write_text('{"success": 1, "reviews": [', encoding="utf-8")
    with pytest.raises(Exception, match="not readable"):
        load_runs(spark, store, run)
    page.write_text("{}", encoding="utf-8")
    assert counts(load_runs(spark, store, run)) == (0, 0, 0, 0)
    with open(f"{run}/review_pages.jsonl", "a") as handle:
        handle.write('{"run_id": ')
    with pytest.raises(Exception, match="Malformed|MALFORMED"):
        load_runs(spark, store, run)


def test_broken_reference_blocks_a_checked_load(spark, store, tmp_path):
    run = land(tmp_path, "run-bad", [(report("run-bad", app_id="5"), [review()])])
    path = f"{run}/review_pages.jsonl"
    row = json.loads(open(path).read())
    row["app_id"] = " "
    open(path, "w").write(json.dumps(row) + "\n")
    with pytest.raises(ValueError, match="not null"):
        load_runs(spark, store, run, check=True)
    assert store.read("reviews").count() == 0


def test_odd_payloads(spark, store, tmp_path):
    odd = [
        review("a", author="nobody", voted_up=1, votes_up="12", weighted_vote_score=None),
        review(" ", text="no key"),
        review("b", text=" \r\n x\r\ny ", timestamp_updated="soon", language=" \t "),
        {"recommendationid": "c"},
    ]
    run = land(tmp_path, "run-odd", [(report("run-odd"), odd)])
    assert counts(load_runs(spark, store, run)) == (4, 3, 0, 0)
    rows = {r["recommendationid"]: r for r in store.read("reviews").collect()}
    assert (rows["a"]["votes_up"], rows["a"]["voted_up"], rows["a"]["playtime_forever"]) == (12, True, None)
    assert (rows["b"]["review"], rows["b"]["timestamp_updated"], rows["b"]["language"]) == ("x\ny", None, None)
    assert (rows["c"]["review"], rows["c"]["voted_up"], rows["c"]["comment_count"]) == (None, False, 0)


def test_exports(spark, store, tmp_path):
    run = land(tmp_path, "run-x", [(report("run-x"), [
        review("1", text='He said "no",\nthen left', updated=5), review("2", text="", updated=None), review("3", text="größer", updated=9),
    ])])
    load_runs(spark, store, run)
    summary = export(store, str(tmp_path / "csv"), "CSV")
    assert summary["review_count"] == 3
    rows = []
    for part in sorted((tmp_path / "csv").glob("part-*.csv")):
        with part.open(newline="", encoding="utf-8") as handle:
            rows += list(csv.DictReader(handle))
    assert [row["recommendationid"] for row in rows] == ["2", "3", "1"]
    assert list(rows[0])[:5] == ["recommendationid", "run_id", "app_id", "app_name", "language"] and len(rows[0]) == 25
    assert rows[2]["review"] == 'He said "no",\nthen left' and rows[0]["timestamp_updated"] == ""
    assert export(store, str(tmp_path / "jsonl"), "jsonl", "run-x")["review_count"] == 3
    lines = [line for part in sorted((tmp_path / "jsonl").glob("part-*.json")) for line in part.read_text("utf-8").splitlines()]
    first = json.loads(lines[0])
    assert list(first) == sorted(first) and first["timestamp_updated"] is None
    assert any("größer" in line for line in lines)
    assert export(store, str(tmp_path / "none"), "csv", "other")["review_count"] == 0
    with pytest.raises(ValueError, match="format"):
        export(store, str(tmp_path / "bad"), "xml")


def test_daily_job_writes_its_reports(spark, store, tmp_path):
    run = land(tmp_path, "run-d", [(report("run-d"), [review()])])
    sections = run_daily(spark, store, run, write_targets(tmp_path), str(tmp_path / "reports"))
    assert sections["fetch_summary"].first()["review_count"] == 1
    names = {p.name for p in (tmp_path / "reports" / "daily_report").iterdir()}
    assert {"job", "sync_state_summary", "load_summary", "fetch_summary", "high_water_by_app"} <= names
    read = spark.read.json(str(tmp_path / "reports" / "daily_report" / "sync_state_before"))
    assert [(r["app_id"], r["complete_through_timestamp_updated"]) for r in read.collect()] == [(SHOP, 0)]
    summary = {(r["section"], r["name"]): r["value"] for r in sections["sync_state_summary"].collect()}
    assert summary["watermarks", SHOP] == 1 and ("complete_apps", SHOP) in summary


def test_command_line(spark, tmp_path, capsys):
    run = land(tmp_path, "run-c", [(report("run-c"), [review()])])
    folder = ["--store", str(tmp_path / "cli")]
    main(["load", *folder, "--run-dir", run, "--targets", write_targets(tmp_path)])
    main(["advance", *folder, "--run-dir", run])
    main(["validate", *folder, "--output", str(tmp_path / "report")])
    main(["export", *folder, "--output", str(tmp_path / "out"), "--format", "jsonl"])
    main(["daily", *folder, "--run-dir", run, "--targets", write_targets(tmp_path), "--reports", str(tmp_path / "daily")])
    assert (tmp_path / "daily" / "run-c" / "daily_report" / "job").is_dir()
    shown = capsys.readouterr().out
    assert "run-c" in shown and "backlogged_count" in shown and "'review_count': 1" in shown
    assert spark.read.json(str(tmp_path / "report" / "metrics")).filter("name = 'reviews'").first()["value"] == 1


def test_snapshot_import_keeps_unlisted_columns(spark, store, tmp_path):
    run = land(tmp_path, "run-1", [(report("run-1", max_timestamp_updated=77), [review()])])
    load_runs(spark, store, run)
    old = tmp_path / "old"
    pages = store.read("pages").drop("max_timestamp_updated", "min_timestamp_updated").withColumn("status", F.lit("empty"))
    pages.unionByName(pages.withColumn("page_key", F.lit("other")).withColumn("page_number", F.lit(9))).write.parquet(str(old / "pages"))
    assert import_tables(store, str(old)) == {"runs": 0, "apps": 0, "pages": 2, "reviews": 0}
    rows = {r["page_key"]: r for r in store.read("pages").collect()}
    assert rows[f"run-1:{SHOP}:0001"]["status"] == "empty" and rows[f"run-1:{SHOP}:0001"]["max_timestamp_updated"] == 77
    assert rows["other"]["max_timestamp_updated"] is None
    load_runs(spark, store, run)
    assert store.read("pages").filter("page_number = 1").first()["status"] == "fetched"


def test_a_run_without_pages_has_a_row_of_zeros(spark, store, tmp_path):
    empty = land(tmp_path, "run-0", [])
    full = land(tmp_path, "run-1", [(report("run-1"), [review()])])
    for runs in ([empty], [empty, full]):
        rows = {row["run_id"]: row for row in load_runs(spark, store, runs).collect()}
        assert set(rows["run-0"].asDict().values()) == {"run-0", 0}
    assert rows["run-1"]["reviews_inserted"] == 1
    stored = {row["run_id"]: row for row in store.read("runs").collect()}
    assert stored["run-0"]["page_count"] == stored["run-0"]["fetch_errors"] == 0 and stored["run-1"]["page_count"] == 1


def test_last_row_of_a_key_in_a_snapshot_counts(spark, store, tmp_path):
    for part, rows in enumerate(([("1", "first"), ("2", "only")], [("1", "second"), ("1", "last")])):
        df = spark.createDataFrame(rows, "app_id string, app_name string").coalesce(1)
        df.write.parquet(str(tmp_path / "old" / "apps" / f"part={part}"))
    assert import_tables(store, str(tmp_path / "old"))["apps"] == 4
    names = sorted((row["app_id"], row["app_name"]) for row in store.read("apps").collect())
    assert [app for app, _ in names] == ["1", "2"] and names[0][1] in ("last", "first") and names[1][1] == "only"
    whole = spark.createDataFrame([("3", "a"), ("3", "b"), ("3", "c")], "app_id string, app_name string").coalesce(1)
    whole.write.parquet(str(tmp_path / "new" / "apps"))
    import_tables(store, str(tmp_path / "new"))
    assert store.read("apps").filter("app_id = '3'").first()["app_name"] == "c"


def test_racing_advances_both_count(spark, store, tmp_path, monkeypatch):
    reports = {}
    for app in ("1", "2"):
        land(tmp_path, f"run-{app}", [(report(f"run-{app}", app, max_timestamp_updated=9, terminal_reason="empty_page"), [review(app)])])
        reports[app] = read_page_reports(spark, str(tmp_path / "raw" / f"run-{app}"))
    other, before, raced = Store(spark, store.root), store._commit, []

    def late(load, lines):
        if not raced:
            raced.append(True)
            advance(other, reports["2"], "updated", "start", "end")
        return before(load, lines)

    monkeypatch.setattr(store, "_commit", late)
    advance(store, reports["1"], "updated", "start", "end")
    marks = {row["app_id"]: row["complete_through_timestamp_updated"] for row in store.read("sync_state").collect()}
    assert marks == {"1": 9, "2": 9}


def test_faulty_reports_stop_a_load_or_are_set_aside(spark, store, tmp_path):
    rows = [(report("run-1"), [review("1")]), (report("run-1", " ", 2), [review("2")]), (report("run-1", SHOP, 3, status="") | {"page_number": None}, None)]
    folder = land(tmp_path, "run-1", rows)
    with pytest.raises(ValueError, match="not null pages.app_id: 1"):
        load_runs(spark, store, folder)
    assert store.last_load() == 0 and not list((tmp_path / "store" / "pages").glob("part=*"))
    assert counts(load_runs(spark, store, folder, quarantine=str(tmp_path / "aside"))) == (1, 1, 0, 0)
    aside = spark.read.json(str(tmp_path / "aside")).orderBy("missing").collect()
    assert [row["missing"] for row in aside] == ["app_id", "page_number, status"]
    assert [row["recommendationid"] for row in store.read("reviews").collect()] == ["1"]


def test_a_page_key_belongs_to_one_page(spark):
    columns = "run_id string, app_id string, page_number int, status string, page_key string"
    pages = [("r", "1", 1, "fetched", "a"), ("r", "2", 1, "fetched", "a"), ("r", "3", 1, "fetched", "b"), ("r", "4", 1, "fetched", "c")]
    stored = [("r", "3", 1, "fetched", "b"), ("old", "4", 1, "fetched", "c"), ("old", "5", 1, "fetched", "d")]
    report = incoming_report({"pages": spark.createDataFrame(pages, columns)}, {"pages": spark.createDataFrame(stored, columns)})
    found = {row["constraint"]: row["violations"] for row in report.filter("violations > 0").collect()}
    assert found == {"unique pages(page_key)": 2}


def test_daily_run_stops_at_the_mark(spark, store, tmp_path):
    targets = write_targets(tmp_path)
    first = land(tmp_path, "run-1", [(report("run-1", max_timestamp_updated=5, terminal_reason="empty_page"), [review("1", updated=5)])])
    run_daily(spark, store, first, targets, str(tmp_path / "r1"))
    pages = [
        (report("run-2", SHOP, page, max_timestamp_updated=top, terminal_reason=None), [review(str(page), updated=top)])
        for page, top in ((1, 9), (2, 4), (3, 3))
    ]
    second = land(tmp_path, "run-2", pages)
    run_daily(spark, store, second, targets, str(tmp_path / "r2"))
    assert sorted(row["page_number"] for row in store.read("pages").filter("run_id = 'run-2'").collect()) == [1, 2]
    state = store.read("sync_state").first()
    assert (state["complete_through_timestamp_updated"], state["backlogged"], state["last_page_count"]) == (9, False, 2)
