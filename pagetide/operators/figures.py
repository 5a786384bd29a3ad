"""Figures of the validation report, kept load by load instead of counted over the tables.

A figure is a count under a kind, a run, an app and a label. A load knows the rows that it writes and looks up the stored rows that
they replace, so the figures after it are those before it, plus its own, less those of the replaced rows. There is one figure per
run, app and flag for reviews, per run and status for pages, and per run and type for changes, so a report reads few rows whatever
the tables hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetide.operators.quality import duplicate_keys
from pagetide.operators.reports import recommendation, report_of, run_scope
from pagetide.operators.skew import lookup_join
from pagetide.schemas import FIGURES, KEYS
from pagetide.session import materialise

# The tables that have figures, with the columns that these are counted by; those of reviews are derived.
FIGURED = {
    "reviews": [],
    "pages": [*KEYS["pages"], "status"],
    "review_changes": [*KEYS["review_changes"], "change_type"],
}

NAME = ["kind", "run_id", "app_id", "label"]
VALUES = ["n", "no_text", "no_language"]


def _named(rows: DataFrame, kind: str, **columns: Column) -> DataFrame:
    absent = {"run_id": F.lit(None), "app_id": F.lit(None), "label": F.lit(None), "no_text": F.lit(0), "no_language": F.lit(0)}
    named = {"kind": F.lit(kind), "n": F.col("n"), **absent, **columns}
    return rows.select(*(named[name].cast("bigint" if name in VALUES else "string").alias(name) for name in [*NAME, *VALUES]))


def narrow(table: str, rows: DataFrame) -> DataFrame:
    """What figures are counted by. Of texts, only whether they are missing."""
    if table != "reviews":
        return rows.select(*FIGURED[table])
    no_text = F.col("review").isNull() | (F.col("review") == "")
    return rows.select(
        "recommendationid", "run_id", "app_id", recommendation().alias("label"), no_text.alias("no_text"),
        F.col("language").isNull().alias("no_language"),
    )


def figures_of(table: str, rows: DataFrame) -> DataFrame:
    """The figures of some narrow rows of a table. Every aggregation combines before its shuffle."""
    run = F.col("run_id")
    if table == "pages":
        return _named(rows.groupBy("run_id", "status").agg(F.count("*").alias("n")), "pages", run_id=run, label=F.col("status"))
    if table == "review_changes":
        counted = rows.groupBy("run_id", "change_type").agg(F.count("*").alias("n"))
        return _named(counted, "review_changes", run_id=run, label=F.col("change_type"))
    counted = rows.groupBy("run_id", "app_id", "label").agg(
        F.count("*").alias("n"), F.count_if("no_text").alias("no_text"), F.count_if("no_language").alias("no_language")
    )
    figures = _named(counted, "reviews", run_id=run, **{name: F.col(name) for name in ("app_id", "label", "no_text", "no_language")})
    in_run = duplicate_keys(rows, ["run_id", "recommendationid"]).groupBy("run_id").agg(F.count("*").alias("n"))
    overall = duplicate_keys(rows, ["recommendationid"]).agg(F.count("*").alias("n"))
    return figures.unionByName(_named(in_run, "run duplicates", run_id=run)).unionByName(_named(overall, "duplicates"))


def _replaced(table: str, stored: DataFrame, written: DataFrame, figures: DataFrame) -> DataFrame | None:
    """Stored rows with the key of a written one. A run that has no figures has no pages and changes either, and nothing is read."""
    keys = KEYS[table]
    if "run_id" in keys:
        known = figures.filter((F.col("kind") == table) & (F.col("n") != 0)).select("run_id").distinct()
        if lookup_join(written.select("run_id").distinct(), known, "run_id", "left_semi").isEmpty():
            return None
    return lookup_join(narrow(table, stored), written.select(*keys).distinct(), keys, "left_semi", derived=True)


def changed_figures(figures: DataFrame, stored: dict[str, DataFrame], written: dict[str, DataFrame]) -> DataFrame:
    """The figures that a load changes, with their new values.

    `written` has one row per key and table, as it becomes visible.
    """
    parts = []
    for table, rows in written.items():
        rows = materialise(narrow(table, rows), "written")
        parts.append(figures_of(table, rows))
        gone = _replaced(table, stored[table], rows, figures)
        if gone is not None:
            less = figures_of(table, materialise(gone, "replaced"))
            parts.append(less.withColumns({name: -F.col(name) for name in VALUES}))
    moved = parts[0]
    for part in parts[1:]:
        moved = moved.unionByName(part)
    moved = keyed_figures(moved).filter(" or ".join(f"{name} <> 0" for name in VALUES))
    moved = materialise(moved, "moved-figures")
    before = lookup_join(figures.select(*FIGURES.names), moved.select("figure"), "figure", "left_semi")
    return keyed_figures(before.select(*NAME, *VALUES).unionByName(moved.select(*NAME, *VALUES)))


def keyed_figures(figures: DataFrame) -> DataFrame:
    """One row per figure, summed up, with its name in one column that is never null."""
    summed = figures.groupBy(*NAME).agg(*(F.sum(name).alias(name) for name in VALUES))
    return summed.withColumn("figure", F.to_json(F.struct(*NAME))).select(*FIGURES.names)


def all_figures(tables: dict[str, DataFrame]) -> DataFrame:
    """The figures of whole tables, counted anew."""
    parts = [figures_of(table, narrow(table, tables[table])) for table in FIGURED]
    return keyed_figures(parts[0].unionByName(parts[1]).unionByName(parts[2]))


def report_of_figures(figures: DataFrame, apps: DataFrame, state: DataFrame, run_id: str | None = None) -> DataFrame:
    """The validation report from stored figures, equal to the one counted over the tables."""
    def of(kind: str, *by: str) -> DataFrame:
        rows = run_scope(figures, run_id).filter(F.col("kind") == kind)
        return rows.groupBy(*by).agg(*(F.sum(name).alias(name) for name in VALUES)).filter("n <> 0")

    return report_of(
        of("reviews", "app_id", "label").withColumnRenamed("label", "flag"),
        of("run duplicates" if run_id else "duplicates").select("n"),
        of("pages", "label").withColumnRenamed("label", "status"),
        of("review_changes", "label").withColumnRenamed("label", "change_type"),
        apps,
        state,
    )
