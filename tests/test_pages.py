import json

from pyspark.sql import functions as F

from fixtures import PRIVATE, payload, review
from pagetide.operators import sync
from pagetide.operators.pages import report_landed_pages
from pagetide.plans.load import load_pages
from pagetide.plans.store import Store
from pagetide.schemas import SYNC_STATE
from pagetide.sinks.files import land_pages, sanitize_documents, write_page_reports
from pagetide.sources.landing import REPORT_ORDER, read_landed_pages, read_page_reports

PAGE = "run_id string, app_id string, app_name string, page_number int, status_code int, attempt_count int, fetched_at string, raw_json_path string, document string"


def landed(spark, documents, app="730", codes=None):
    rows = [
        ("r1", app, "One", i, (codes or {}).get(i, 200), 1, "now", f"/p{i}", json.dumps(d) if d is not None else None)
        for i, d in enumerate(documents, start=1)
    ]
    return spark.createDataFrame(rows, PAGE)


def state(spark, **marks):
    rows = [(app.lstrip("a"), mark, False) for app, mark in marks.items()]
    df = spark.createDataFrame(rows, "app_id string, complete_through_timestamp_updated long, backlogged boolean")
    return sync.normalized_state(df)


def reports(spark, documents, marks=None, **options):
    codes = options.pop("codes", None)
    out = report_landed_pages(landed(spark, documents, codes=codes), state(spark, **(marks or {"a1": 0})), "https://x.example", **options)
    return out.orderBy("page_number").collect()


def page(*times, cursor):
    return payload([review(str(t), updated=t) for t in times], cursor=cursor)


def test_pages_end_at_the_empty_page(spark):
    rows = reports(spark, [page(3, cursor="n1"), page(cursor="n2"), page(9, cursor="n3")])
    assert [(r["status"], r["terminal_reason"], r["cursor"], r["next_cursor"]) for r in rows] == [
        ("fetched", None, "*", "n1"), ("empty", "empty_page", "n1", "n2")
    ]
    assert rows[1]["request_url"].endswith("cursor=n1") and rows[0]["max_timestamp_updated"] == 3


def test_delta_stop_at_the_high_water_mark(spark):
    documents = [page(9, 8, cursor="a"), page(5, 4, cursor="b"), page(3, cursor="c")]
    rows = reports(spark, documents, {"a730": 5})
    assert [r["terminal_reason"] for r in rows] == [None, "caught_up_to_existing_reviews"]
    assert [r["terminal_reason"] for r in reports(spark, documents, {"a730": 5}, disable_delta_stop=True)] == [None] * 3
    assert [r["terminal_reason"] for r in reports(spark, documents, {"a730": 5}, review_filter="recent")] == [None] * 3
    assert len(reports(spark, documents, {"a7": 5})) == 3


def test_cap_beats_missing_cursor_and_errors_keep_their_review_count(spark):
    assert [r["terminal_reason"] for r in reports(spark, [page(1, cursor="")], page_cap=1)] == ["page_cap_reached"]
    assert [r["terminal_reason"] for r in reports(spark, [page(1, cursor=" ")])] == ["missing_next_cursor"]
    assert [r["terminal_reason"] for r in reports(spark, [page(1, cursor="x"), page(2, cursor="x")])] == [None, "cursor_not_advancing"]
    failed = payload([review()], cursor="c", success=2)
    rows = reports(spark, [failed, page(1, cursor="d")])
    assert [(r["status"], r["terminal_reason"], r["review_count"]) for r in rows] == [("fetch_error", "fetch_error", 1)]
    rows = reports(spark, [None], codes={1: 429})
    assert [(r["status"], r["retryable"], r["error_message"], r["response_bytes"]) for r in rows] == [
        ("fetch_error", True, "HTTP 429", 0)
    ]


def test_hot_app_is_chained_in_chunks(spark):
    documents = [page(100 - i, cursor=f"c{i}") for i in range(60)]
    rows = reports(spark, documents, hot_rows=10)
    assert [r["cursor"] for r in rows] == ["*"] + [f"c{i}" for i in range(59)]


def test_landing_drops_personal_fields_and_keeps_the_input(spark, tmp_path):
    pages = landed(spark, [page(1, cursor="a")])
    before = pages.first()["document"]
    document = sanitize_documents(pages).first()["document"]
    assert set(json.loads(document)["reviews"][0]["author"]) == {
        "playtime_forever", "playtime_last_two_weeks", "playtime_at_review", "last_played"
    }
    assert not [value for value in PRIVATE.values() if value in document] and pages.first()["document"] == before
    kept, given = json.loads(document), json.loads(before)
    for one, other in zip(kept["reviews"], given["reviews"], strict=True):
        one.pop("author"), other.pop("author")
    assert kept == given
    land_pages(pages, str(tmp_path / "landed"))
    read = spark.read.parquet(str(tmp_path / "landed"))
    assert read.select("run_id").first()[0] == "r1" and not [value for value in PRIVATE.values() if value in read.first()["document"]]


def test_odd_documents_are_sanitized_without_loss(spark):
    odd = ['{"reviews":[{"author":"somebody","more":1.5},"text",null],"new":{"a":[true,null]}}', '{"reviews":7}', "{}", "[1]", "torn {", None]
    pages = spark.createDataFrame([(text,) for text in odd], "document string")
    read = [row["document"] and json.loads(row["document"]) for row in sanitize_documents(pages).collect()]
    assert read == [{"reviews": [{"more": 1.5}, "text", None], "new": {"a": [True, None]}}, {"reviews": 7}, {}, None, None, None]


def test_landed_pages_are_reported_and_loaded(spark, tmp_path):
    pages = landed(spark, [page(9, 8, cursor="a"), page(5, cursor="b"), page(3, cursor="c")])
    land_pages(pages.withColumn("file_name", F.concat(F.lit("p"), "page_number")), str(tmp_path / "landed"))
    files = read_landed_pages(spark, str(tmp_path / "landed"))
    made = report_landed_pages(files, state(spark, a730=5), "https://x.example")
    store = Store(spark, str(tmp_path / "store"))
    summary = load_pages(store, made, files, ["run_id", "page_number"], str(tmp_path / "landed")).first()
    assert (summary["pages_upserted"], summary["reviews_inserted"]) == (2, 3)
    assert {r["terminal_reason"] for r in store.read("pages").collect()} == {None, "caught_up_to_existing_reviews"}
    write_page_reports(made, str(tmp_path / "run-w"), ["page_number"])
    back = read_page_reports(spark, str(tmp_path / "run-w")).orderBy(*REPORT_ORDER).collect()
    assert [(r["run_id"], r["page_number"], r["max_timestamp_updated"]) for r in back] == [("run-w", 1, 9), ("run-w", 2, 5)]


def test_watermark_over_several_runs(spark):
    rows = [
        ("r1", "7", 1, "empty_page", 10, 5, 1), ("r2", "7", 1, None, 50, 40, 2), ("r2", "7", 2, "page_cap_reached", 30, 20, 3),
        ("r3", "7", 1, "missing_next_cursor", 8, 2, None), ("r4", "7", 1, "missing_next_cursor", 60, 2, 4),
        ("r5", "7", 1, "empty_page", 70, 1, 1), ("r5", "7", 2, None, None, None, 0), ("r1", " ", 1, "empty_page", 1, 1, 1),
    ]
    reports = spark.createDataFrame(
        rows, "run_id string, app_id string, page_number int, terminal_reason string, max_timestamp_updated long, min_timestamp_updated long, review_count long"
    )
    progress = sync.app_progress(reports, ["page_number"])
    empty = spark.createDataFrame([], SYNC_STATE)
    for hot_rows in (None, 2):
        history = sync.sync_history(empty, progress, hot_rows).orderBy("last_run_id").collect()
        assert [(h["complete_through_timestamp_updated"], h["backlogged"], h["last_successful_run_id"]) for h in history] == [
            (10, False, "r1"), (10, True, "r1"), (10, False, "r3"), (60, False, "r4"), (60, True, "r4")
        ]
    assert history[4]["last_terminal_reason"] == "unknown"
    stored, step = empty, None
    for run in ("r1", "r2", "r3", "r4", "r5"):
        step = sync.advance_sync_state(stored, progress.filter(F.col("run_id") == run), "updated", "s", "e")
        stored = step.table
    at_once = sync.advance_sync_state(empty, progress, "recent", "s", "e")
    assert [tuple(r) for r in stored.collect()] == [tuple(r) for r in at_once.table.collect()]
    assert at_once.states.first()["last_page_count"] == 2
