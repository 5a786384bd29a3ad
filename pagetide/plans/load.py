"""Loading landed runs into the tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetide.operators.figures import FIGURED, changed_figures
from pagetide.operators.merges import (
    incoming_pages,
    merge_apps,
    merge_reviews,
    merge_runs,
    seen_apps,
)
from pagetide.operators.normalize import explode_reviews, normalize_reviews, page_rows, parse_payload
from pagetide.operators.quality import incoming_report, refuse, split_reports
from pagetide.operators.reports import fetch_summary, load_summary
from pagetide.plans.store import CHANGES, FULL, StaleRead, Store
from pagetide.session import materialise, scratch, sized_shuffle
from pagetide.sources.landing import (
    REPORT_ORDER,
    attach_documents,
    list_raw_pages,
    list_runs,
    read_page_reports,
    read_raw_pages,
    reports_without_document,
)


def utc_now() -> str:
    return datetime.now(timezone.utc).isoformat()


def incoming_reviews(reports: DataFrame, files: DataFrame, order: list[str], strict: bool = True) -> DataFrame:
    """All reviews of the loaded runs as table rows, with their load order."""
    pages = parse_payload(attach_documents(reports, files), strict=strict).drop("document")
    return normalize_reviews(explode_reviews(pages), [*order, "pos"])


def load_runs(
    spark: SparkSession,
    store: Store,
    run_dirs: str | list[str],
    targets: DataFrame | None = None,
    targets_path: str | None = None,
    strict: bool = True,
    check: bool = True,
    hot_rows: int | None = None,
    quarantine: str | None = None,
    cut: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Load one or more run directories (a page report file and one file per page) and return one summary row per run.

    `cut` may leave out reports. Reports that lack what a stored row must have are written to the folder `quarantine`; without one
    they stop the load.
    """
    where = (run_dirs if isinstance(run_dirs, str) else ",".join(run_dirs)).rstrip("/")
    reports, files = read_page_reports(spark, run_dirs), read_raw_pages(spark, run_dirs)
    reports = cut(reports) if cut else reports
    names = list_raw_pages(spark, run_dirs)
    size = names.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    with sized_shuffle(spark, size):
        return load_pages(
            store, reports, files, REPORT_ORDER, where, targets, targets_path, strict, check, hot_rows, names,
            run_ids=list_runs(spark, run_dirs), quarantine=quarantine,
        )


def load_pages(
    store: Store,
    reports: DataFrame,
    files: DataFrame,
    order: list[str],
    raw_dir: str,
    targets: DataFrame | None = None,
    targets_path: str | None = None,
    strict: bool = True,
    check: bool = True,
    hot_rows: int | None = None,
    file_names: DataFrame | None = None,
    token: str | None = None,
    computed_from: int | None = None,
    also: dict[str, tuple[str, DataFrame]] | None = None,
    fold_runs: Callable[[DataFrame, DataFrame], DataFrame] = merge_runs,
    run_ids: DataFrame | None = None,
    quarantine: str | None = None,
) -> DataFrame:
    """Load page reports and their documents (run_id, file_name, document), wherever they were landed.

    `file_names` (run_id, file_name) lists the documents where that is cheaper than reading the names off `files`.

    `order` sorts the reports in load order and starts with the run. Several runs are folded in one job, in run-id order,
    with the same result as loading them one by one. In strict mode a report without its document, or with one that is no
    JSON, raises; `check` tests every constraint on the rows of the load before anything becomes visible. If another load is published meanwhile, this one
    is merged again, on top of it. A `token` names the load, see `Store.publish`. Reports that were made from the stored tables
    name the last load that they know of (`computed_from`); then StaleRead is left to the caller. `also` are writes to other tables
    that become visible with this load, and `fold_runs` puts the run rows into the stored ones. `run_ids` names the runs, which get
    their row though they have no pages.
    """
    if quarantine:
        reports, aside = split_reports(materialise(reports, "all-reports", keep=True))
        aside.write.mode("append").json(quarantine)
    while True:
        with scratch(store.spark):
            try:
                return _load(
                    store, reports, files, file_names, order, raw_dir, targets, targets_path, strict, check, hot_rows, token,
                    computed_from, also or {}, fold_runs, run_ids,
                )
            except StaleRead:
                if computed_from is not None:
                    raise


def _load(
    store: Store,
    reports: DataFrame,
    files: DataFrame,
    file_names: DataFrame | None,
    order: list[str],
    raw_dir: str,
    targets: DataFrame | None,
    targets_path: str | None,
    strict: bool,
    check: bool,
    hot_rows: int | None,
    token: str | None,
    computed_from: int | None,
    also: dict[str, tuple[str, DataFrame]],
    fold_runs: Callable[[DataFrame, DataFrame], DataFrame],
    run_ids: DataFrame | None,
) -> DataFrame:
    loaded_at = utc_now()
    reports = materialise(reports, "reports")
    last = store.last_load() if computed_from is None else computed_from
    stored = store.read_all(["runs", "apps", "figures", *FIGURED])
    if strict:
        lost = reports_without_document(reports, files if file_names is None else file_names).select("raw_json_path").first()
        if lost is not None:
            raise FileNotFoundError(f"raw page does not exist: {lost['raw_json_path']}")

    reviews = materialise(incoming_reviews(reports, files, order, strict), "reviews")
    # The fold feeds the table, the change log and the counters, so its result is written once.
    merge = merge_reviews(stored["reviews"], reviews, [*order, "pos"], loaded_at, hot_rows).stored_once()

    seen = reviews.groupBy("run_id").agg(F.count("*").alias("reviews_seen"))
    summary = materialise(load_summary(reports, merge.outcomes, seen, run_ids), "summary", keep=True)
    counters = fetch_summary(reports, ["run_id"]).select("run_id", "fetch_errors", "rate_limited_pages")
    runs = summary.join(counters, "run_id", "left").select(
        "run_id",
        F.lit(raw_dir).alias("raw_dir"),
        F.lit(targets_path).cast("string").alias("targets_path"),
        F.lit(loaded_at).alias("loaded_at"),
        F.col("apps_upserted").alias("app_count"),
        F.col("pages_upserted").alias("page_count"),
        F.col("reviews_seen").alias("review_count"),
        "reviews_inserted", "reviews_updated", "duplicates_skipped", "fetch_errors", "rate_limited_pages",
    )
    pages = materialise(incoming_pages(stored["pages"], page_rows(reports, order), order), "pages")
    written = {"reviews": merge.current, "pages": pages, "review_changes": merge.changes}
    writes = {
        "runs": (FULL, fold_runs(stored["runs"], runs)),
        "apps": (FULL, merge_apps(stored["apps"], seen_apps(reports, order, targets))),
        "pages": (CHANGES, pages),
        "reviews": (CHANGES, merge.changed),
        "review_changes": (CHANGES, merge.changes),
        "figures": (CHANGES, changed_figures(stored["figures"], stored, written)),
        **also,
    }
    def verify(written: dict[str, DataFrame]) -> None:
        refuse(incoming_report(written, {name: stored[name] for name in ("pages", "reviews")}))

    store.publish(writes, token, computed_from=last, verify=verify if check else None)
    store.compact_pending()
    return summary

