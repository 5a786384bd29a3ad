"""Importing the tables of another store."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pagetide.operators.merges import import_snapshot
from pagetide.operators.normalize import conform
from pagetide.plans.store import FULL, StaleRead, Store
from pagetide.schemas import IMPORT_COLUMNS, TABLES
from pagetide.session import folder_bytes, sized_shuffle
from pagetide.sources.lines import LINE_ORDER, with_line_order


def parquet_tables(store: Store, root: str) -> Callable[[str], DataFrame | None]:
    """Tables as Parquet folders under `root`, with their line order; an absent one is None.

    For a database, pass a reader over `read.jdbc`.
    """

    def read(table: str) -> DataFrame | None:
        try:
            return with_line_order(store.spark.read.parquet(f"{root.rstrip('/')}/{table}"))
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    return read


def import_tables(store: Store, source: str | Callable[[str], DataFrame | None]) -> dict[str, int]:
    """Import runs, apps, pages and reviews; returns the rows read per table, 0 for an absent one.

    Of rows with one key the last in file order counts. If another load is published meanwhile, the import starts again on top of it.
    """
    read = parquet_tables(store, source) if isinstance(source, str) else source
    size = folder_bytes(store.spark, [source]) if isinstance(source, str) else 0
    while True:
        counts, writes, last = {}, {}, store.last_load()
        for table, columns in IMPORT_COLUMNS.items():
            snapshot = read(table)
            if snapshot is None:
                counts[table] = 0
                continue
            order = [name for name in LINE_ORDER if name in snapshot.columns]
            typed = conform(snapshot, T.StructType([*TABLES[table], *(snapshot.schema[name] for name in order)]))
            counts[table] = typed.count()
            writes[table] = (FULL, import_snapshot(store.read(table), typed, columns, order))
        if not writes:
            return counts
        try:
            with sized_shuffle(store.spark, size + store.size(*writes)):
                store.publish(writes, computed_from=last)
            return counts
        except StaleRead:
            continue
