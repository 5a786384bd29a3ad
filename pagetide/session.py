"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Rows of one group (key, app, run ...) beyond which the group is split over several tasks.
HOT_ROWS_SETTING = "spark.pagetide.hotGroupRows"
HOT_ROWS_DEFAULT = 500_000

# What one shuffle partition should hold at most.
PARTITION_BYTES = 128 * 1024 * 1024


def build_session(app_name: str = "pagetide", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Call sites in error messages cost a stack walk per column expression while a plan is built.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def hot_rows_limit(spark: SparkSession, override: int | None = None) -> int:
    if override is not None:
        return override
    return int(spark.conf.get(HOT_ROWS_SETTING, str(HOT_ROWS_DEFAULT)))


@contextmanager
def sized_shuffle(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """Enough shuffle partitions for the input, never fewer than set. Adaptive execution merges those that stay small."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    needed = -(-input_bytes // PARTITION_BYTES)
    spark.conf.set(name, str(max(int(before), needed)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def folder_bytes(spark: SparkSession, folders: Iterable[str]) -> int:
    """Bytes of the files under some folders; 0 for one that does not exist."""
    total = 0
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        total += fs.getContentSummary(path).getLength() if fs.exists(path) else 0
    return total


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach. Only a single-machine session may go without naming one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        shared = tempfile.mkdtemp(prefix="pagetide-scratch-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/")


_scopes = threading.local()


def materialise(df: DataFrame, name: str, keep: bool = False, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write once, read back: cuts the lineage, fixes row-dependent columns, and lets later reads prune columns.

    The copy lives in the shared scratch folder, so a lost executor loses nothing. Inside `scratch` it is deleted at the
    end, unless `keep` is set.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/pagetide-{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    open_scopes = getattr(_scopes, "open", [])
    if open_scopes and not keep:
        open_scopes[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the copies made inside, once the job that needs them is done or has failed."""
    _scopes.open = [*getattr(_scopes, "open", []), []]
    try:
        yield
    finally:
        *outer, paths = _scopes.open
        _scopes.open = outer
        for folder in paths:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
