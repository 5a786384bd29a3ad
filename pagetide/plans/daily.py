"""The daily job after the pages have landed: load, advance the state, validate, report, export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetide.functions import mask_url
from pagetide.operators.figures import FIGURED, all_figures, report_of_figures
from pagetide.operators.pages import cut_at_marks
from pagetide.operators.reports import (
    capped_apps,
    fetch_summary,
    sync_state_list,
    terminal_reasons,
    validation_report,
)
from pagetide.operators.sync import (
    SyncUpdate,
    advance_sync_state,
    app_progress,
    high_water_marks,
    summarize_update,
    sync_states,
)
from pagetide.plans.load import load_runs, utc_now
from pagetide.plans.store import CHANGES, FULL, StaleRead, Store
from pagetide.session import materialise, sized_shuffle
from pagetide.sinks.files import export_table, write_sections
from pagetide.sources.landing import REPORT_ORDER, read_page_reports
from pagetide.sources.targets import active_targets, load_targets


VALIDATED = ["reviews", "apps", "pages", "review_changes", "sync_state"]


def validate(store: Store, run_id: str | None = None, recount: bool = False) -> dict[str, DataFrame]:
    """The validation report: long-form metrics and the list of app states. It runs when it is read, best with `sized_shuffle`.

    It is put together from the figures that the loads keep. With `recount`, or if something was written past them, as by an
    import, the tables are counted; `rebuild_figures` brings the figures in step again.
    """
    tables = store.read_all([*VALIDATED, "figures"])
    if not recount and store.in_step("figures", list(FIGURED)):
        metrics = report_of_figures(tables["figures"], tables["apps"], tables["sync_state"], run_id)
        return {"metrics": metrics, "sync_states": sync_state_list(tables["sync_state"])}
    metrics = validation_report(
        tables["reviews"], tables["apps"], tables["pages"], tables["review_changes"], tables["sync_state"], run_id
    )
    return {"metrics": metrics, "sync_states": sync_state_list(tables["sync_state"])}


def rebuild_figures(store: Store) -> None:
    """Count the figures of the validation report anew."""
    while True:
        last = store.last_load()
        try:
            with sized_shuffle(store.spark, store.size(*FIGURED)):
                store.publish({"figures": (FULL, all_figures(store.read_all(list(FIGURED))))}, computed_from=last)
            return
        except StaleRead:
            continue


def export(store: Store, path: str, output_format: str = "csv", run_id: str | None = None) -> dict:
    with sized_shuffle(store.spark, store.size("reviews", "apps")):
        return export_table(store.read("reviews"), store.read("apps"), path, output_format, run_id)


def advance(
    store: Store, reports: DataFrame, review_filter: str, started_at: str, completed_at: str
) -> SyncUpdate:
    """Advance and publish the state for the reported runs; returns the stored update.

    Only the apps concerned are written. If another load is published meanwhile, the state is advanced again from there.
    """
    progress = materialise(app_progress(reports, REPORT_ORDER), "progress")
    while True:
        last = store.last_load()
        update = advance_sync_state(store.read("sync_state"), progress, review_filter, started_at, completed_at, utc_now())
        if update.skipped_reason:
            return update
        update = SyncUpdate(materialise(update.states, "states"), update.table)
        try:
            store.publish({"sync_state": (CHANGES, update.states)}, computed_from=last)
            return update
        except StaleRead:
            continue


def run_daily(
    spark: SparkSession,
    store: Store,
    run_dir: str,
    targets_path: str,
    report_path: str,
    review_filter: str = "updated",
    disable_delta_stop: bool = False,
    quarantine: str | None = None,
) -> dict[str, DataFrame]:
    """Load a landed run and write the validation and daily reports as sections under `report_path`.

    With `review_filter` "updated" an app's pages behind the one that reaches its stored mark are left out, unless the stop is disabled.
    """
    started_at = utc_now()
    targets = load_targets(spark, targets_path)
    active = active_targets(targets)
    state = materialise(store.read("sync_state"), "state")
    before = sync_states(state, active)
    uses_marks = review_filter == "updated" and not disable_delta_stop
    marks = materialise(high_water_marks(state, active if uses_marks else active.limit(0)), "marks")

    cut = (lambda reports: cut_at_marks(reports, marks)) if uses_marks else None
    loaded = load_runs(spark, store, run_dir, targets, targets_path, quarantine=quarantine, cut=cut)
    reports = read_page_reports(spark, run_dir)
    reports = materialise(cut(reports) if cut else reports, "reports")
    update = advance(store, reports, review_filter, started_at, utc_now())

    validation = validate(store)
    job = spark.range(1).select(
        F.lit(started_at).alias("started_at"),
        F.lit(utc_now()).alias("completed_at"),
        F.lit(targets_path).alias("targets_path"),
        F.lit(run_dir).alias("raw_dir"),
        mask_url(F.lit(store.root)).alias("store"),
        F.lit(review_filter).alias("review_filter"),
        F.lit(uses_marks).alias("delta_stop_enabled"),
        F.lit(update.skipped_reason).cast("string").alias("sync_skipped_reason"),
    )
    sections = {
        "job": job,
        "high_water_by_app": marks,
        "sync_state_before": before,
        "sync_state_summary": summarize_update(update),
        "fetch_summary": fetch_summary(reports),
        "terminal_reasons": terminal_reasons(reports),
        "capped_apps": capped_apps(reports),
        "load_summary": loaded,
    }
    with sized_shuffle(spark, store.size(*VALIDATED)):
        write_sections(validation, f"{report_path.rstrip('/')}/validation_report")
    write_sections(sections, f"{report_path.rstrip('/')}/daily_report")
    return {**sections, **validation}
