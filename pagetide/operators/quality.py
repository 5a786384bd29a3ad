"""Checks for what a database would enforce: keys, references, enums, required columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetide.operators.skew import lookup_join
from pagetide.schemas import ENUMS, FOREIGN_KEYS, KEYS, NOT_NULL


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)


def _parent_keys(column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Semi and anti joins need no distinct keys."""
    return parent.select(F.col(parent_column).alias(column)).filter(F.col(column).isNotNull())


def fk_violations(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose reference has no parent. A null reference is allowed."""
    keys = _parent_keys(column, parent, parent_column)
    return lookup_join(child.filter(F.col(column).isNotNull()), keys, column, "left_anti")


def fk_valid(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    return lookup_join(child, _parent_keys(column, parent, parent_column), column, "left_semi")


def fk_violation_counts(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Violations per missing parent. Child rows are combined by key first, so a hot key is one row in the join."""
    per_key = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    return per_key.join(_parent_keys(column, parent, parent_column), column, "left_anti")


def check_violations(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Rows with a value outside the enum; null passes, as it does in a database check."""
    return df.filter(~F.col(column).isin(allowed))


def not_null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Null rows per required column, all columns in one pass."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return counts.unpivot([], columns, "column_name", "null_rows")


def constraint_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Every constraint of the contract with its number of offending rows (or keys, for uniqueness)."""
    spark = next(iter(tables.values())).sparkSession
    report = spark.createDataFrame([], "constraint string, violations long")

    def add(name: str, counted: DataFrame) -> None:
        nonlocal report
        report = report.unionByName(counted.select(F.lit(name).alias("constraint"), F.col("n").alias("violations")))

    for table, df in tables.items():
        add(f"unique {table}({', '.join(KEYS[table])})", duplicate_keys(df, KEYS[table]).agg(F.count("*").alias("n")))
        if not NOT_NULL[table]:
            continue
        nulls = not_null_violations(df, NOT_NULL[table])
        report = report.unionByName(nulls.select(
            F.concat(F.lit(f"not null {table}."), "column_name").alias("constraint"),
            F.col("null_rows").alias("violations"),
        ))
    for (table, column), allowed in ENUMS.items():
        if table in tables:
            add(f"check {table}.{column}", check_violations(tables[table], column, allowed).agg(F.count("*").alias("n")))
    for child, column, parent, parent_column in FOREIGN_KEYS:
        if child in tables and parent in tables:
            counted = fk_violation_counts(tables[child], column, tables[parent], parent_column)
            add(f"reference {child}.{column}", counted.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")))
    return report


def incoming_report(written: dict[str, DataFrame], stored: dict[str, DataFrame]) -> DataFrame:
    """The constraints that the rows of one load can break, with the number of offending rows or keys.

    Only the rows of the load are looked at. A reference is looked up in the load first and, for the few keys that are left, among
    the stored rows of `stored`; keys are combined before each lookup. Primary keys hold by the merges, page keys are checked.
    """
    spark = next(iter(written.values())).sparkSession
    report = spark.createDataFrame([], "constraint string, violations long")

    def add(name: str, counted: DataFrame) -> None:
        nonlocal report
        report = report.unionByName(counted.select(F.lit(name).alias("constraint"), F.col("n").cast("long").alias("violations")))

    for table, df in written.items():
        if NOT_NULL[table]:
            nulls = not_null_violations(df, NOT_NULL[table])
            report = report.unionByName(nulls.select(
                F.concat(F.lit(f"not null {table}."), "column_name").alias("constraint"), F.col("null_rows").alias("violations")
            ))
    for (table, column), allowed in ENUMS.items():
        if table in written:
            add(f"check {table}.{column}", check_violations(written[table], column, allowed).agg(F.count("*").alias("n")))
    for child, column, parent, parent_column in FOREIGN_KEYS:
        if child in written and (parent in written or parent in stored):
            open_keys = written[child].filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
            for parents in (written.get(parent), stored.get(parent)):
                if parents is not None:
                    open_keys = open_keys.join(_parent_keys(column, parents, parent_column), column, "left_anti")
            add(f"reference {child}.{column}", open_keys.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")))
    if "pages" in written:
        own = written["pages"].select("page_key", F.struct(*KEYS["pages"]).alias("page"))
        # A key is taken by another page of the load, or by a stored page that is not the same one.
        pages = own.groupBy("page_key").agg(F.count("*").alias("rows"), F.min("page").alias("page"))
        twice = pages.filter("rows > 1").select("page_key")
        if "pages" in stored:
            others = stored["pages"].select("page_key", F.struct(*KEYS["pages"]).alias("other"))
            taken = others.join(pages, "page_key").filter(F.col("other") != F.col("page")).select("page_key")
            twice = twice.unionByName(taken).distinct()
        add("unique pages(page_key)", twice.agg(F.count("*").alias("n")))
    return report


def enforce(tables: dict[str, DataFrame]) -> None:
    """Raise if whole tables break a constraint."""
    refuse(constraint_report(tables))


def refuse(report: DataFrame) -> None:
    """Raise if a report has violations."""
    broken = report.filter("violations > 0").orderBy("constraint").collect()
    if broken:
        raise ValueError("; ".join(f"{row['constraint']}: {row['violations']}" for row in broken))


# What a page report must have for its rows to be stored.
REQUIRED = ["run_id", "app_id", "page_number", "status"]


def split_reports(reports: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Reports to load, and those to set aside with the columns they lack (`missing`). One pass, no join."""
    lacking = F.filter(
        F.array(*(F.when(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "", F.lit(c)) for c in REQUIRED)),
        lambda name: name.isNotNull(),
    )
    marked = reports.withColumn("missing", F.array_join(lacking, ", "))
    return marked.filter("missing = ''").drop("missing"), marked.filter("missing <> ''")


def quarantine(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> tuple[DataFrame, DataFrame]:
    """Rows to keep (reference found or null) and rows to set aside."""
    found = parent.select(F.col(parent_column).alias(column)).filter(F.col(column).isNotNull()).distinct().withColumn("_found", F.lit(True))
    marked = lookup_join(df, found, column, "left", derived=True)
    valid = F.col("_found").isNotNull() | F.col(column).isNull()
    return marked.filter(valid).select(*df.columns), marked.filter(~valid).select(*df.columns)
