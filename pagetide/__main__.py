"""Command line: `spark-submit pagetide/__main__.py <command>` or `python -m pagetide <command>`."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from pagetide.plans.daily import VALIDATED, advance, export, rebuild_figures, run_daily, validate
from pagetide.plans.load import load_runs, utc_now
from pagetide.plans.snapshot import import_tables
from pagetide.plans.store import Store
from pagetide.session import build_session, sized_shuffle
from pagetide.sinks.files import write_sections
from pagetide.sources.landing import read_page_reports
from pagetide.sources.targets import load_targets


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="pagetide")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, *options: tuple[str, dict]) -> None:
        sub = commands.add_parser(name)
        sub.add_argument("--store", required=True)
        for flag, settings in options:
            sub.add_argument(flag, **settings)

    run_dir = ("--run-dir", {"required": True, "nargs": "+"})
    targets = ("--targets", {})
    run_id = ("--run-id", {})
    review_filter = ("--review-filter", {"default": "updated", "choices": ["all", "recent", "updated"]})
    quarantine = ("--quarantine", {"help": "folder for page reports that cannot be stored; without it they stop the load"})
    command("load", run_dir, targets, quarantine, ("--no-check", {"action": "store_true"}))
    command("advance", run_dir, review_filter, ("--started-at", {}), ("--completed-at", {}))
    command("validate", run_id, ("--output", {}), ("--recount", {"action": "store_true"}))
    command("export", run_id, ("--output", {"required": True}), ("--format", {"default": "csv", "choices": ["csv", "jsonl"]}))
    command("import", ("--snapshot", {"required": True}))
    command("daily", run_dir, ("--targets", {"required": True}), ("--reports", {"required": True}), review_filter,
            ("--disable-delta-stop", {"action": "store_true"}), quarantine)
    return parser


def show(rows: DataFrame) -> None:
    """Print all rows, taking them from Spark a partition at a time."""
    for row in rows.toLocalIterator():
        print("  ".join(f"{name}={value}" for name, value in row.asDict().items()))


def _execute(spark: SparkSession, args: argparse.Namespace) -> None:
    store = Store(spark, args.store)
    if args.command == "load":
        targets = load_targets(spark, args.targets) if args.targets else None
        show(load_runs(
            spark, store, args.run_dir, targets, args.targets, check=not args.no_check, quarantine=args.quarantine
        ))
    elif args.command == "advance":
        now = utc_now()
        advance(store, read_page_reports(spark, args.run_dir), args.review_filter, args.started_at or now, args.completed_at or now)
    elif args.command == "validate":
        sections = validate(store, args.run_id, args.recount)
        with sized_shuffle(spark, store.size(*VALIDATED)):
            if args.output:
                write_sections(sections, args.output)
            show(sections["metrics"])
    elif args.command == "export":
        print(export(store, args.output, args.format, args.run_id))
    elif args.command == "import":
        print(import_tables(store, args.snapshot))
        rebuild_figures(store)
    else:
        for run_dir in args.run_dir:
            report_path = f"{args.reports.rstrip('/')}/{run_dir.rstrip('/').rsplit('/', 1)[-1]}"
            run_daily(
                spark, store, run_dir, args.targets, report_path, args.review_filter, args.disable_delta_stop, args.quarantine
            )


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    _execute(build_session(), args)


if __name__ == "__main__":
    main()
