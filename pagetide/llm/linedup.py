"""Line deduplication over levelled sorted runs of line keys.

A line's key is the 128-bit hash of the line, stripped and lower-cased in ASCII. A run is a table of (key, documents, largest
doc_id), bucketed and sorted by key, so that merging and anti-joining runs needs no shuffle of the runs. A new batch makes a
run of level 0; two runs of one level are merged into one of the next, so a key is rewritten once per level.

Batches come in falling doc_id order. A key that the runs already hold in `min_docs` documents is settled: its largest holder
is known, and every later batch loses the line. Each new batch is merge-anti-joined with the settled keys of the runs and adds
what is left. When all batches are in, the runs are merged and decide for the documents seen before the key was settled.

Defined results: null and empty texts are one empty line; rows are the documents that are counted, also when they repeat a
doc_id; all rows that carry the largest doc_id of a key keep it; a null doc_id is smaller than any other; an empty table gives
an empty table; only `doc_id`, `text` and the columns named in `carry` are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetide.session import materialise, scratch, scratch_root

SPACE = " \t\n\v\f\r"


def _keys(lines: pa.Array, min_chars: int) -> tuple[np.ndarray, list[bytes]]:
    """Which lines are long enough to count, and the hashes of those."""
    stripped = pc.ascii_lower(pc.ascii_trim(lines, SPACE))
    counted = pc.greater_equal(pc.utf8_length(stripped), min_chars)
    long = pc.filter(stripped, counted).cast(pa.binary()).to_pylist()
    return counted.to_numpy(zero_copy_only=False), [xxhash.xxh3_128_digest(line) for line in long]


def line_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, key) once per document and key."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = pc.split_pattern(pc.fill_null(batch.column("text"), ""), "\n")
            rows = pc.list_parent_indices(lines).to_numpy()
            counted, hashes = _keys(lines.flatten(), min_chars)
            rows = rows[counted]
            fresh = dict.fromkeys(zip(rows.tolist(), hashes, strict=True))
            doc = pa.array([row for row, _ in fresh], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pc.take(batch.column("doc_id"), doc), pa.array([key for _, key in fresh], pa.binary())], ["doc_id", "key"]
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(keys, "doc_id bigint, key binary")


class LineRuns:
    """The runs of all batches added so far."""

    def __init__(self, spark: SparkSession, min_docs: int) -> None:
        self.spark, self.min_docs = spark, min_docs
        self.root = f"{scratch_root(spark)}/line-runs-{uuid.uuid4().hex}"
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: dict[int, str] = {}

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        writer = rows.write.bucketBy(self.buckets, "key").sortBy("key").option("path", f"{self.root}/{name}")
        writer.saveAsTable(name)
        return name

    def _delete(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE {name}")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def add(self, keys: DataFrame) -> None:
        """Add the (doc_id, key) rows of a batch whose doc_ids are not above those of the batches before."""
        new = keys.groupBy("key").agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("largest"))
        for name in self.levels.values():
            settled = self.spark.table(name).filter(F.col("docs") >= self.min_docs).select("key")
            new = new.join(settled.hint("merge"), "key", "left_anti")
        run, level = self._write(new), 0
        while level in self.levels:
            run, level = self._merge(self.levels.pop(level), run), level + 1
        self.levels[level] = run

    def _merge(self, one: str, other: str) -> str:
        """Two sorted runs into one."""
        a, b = self.spark.table(one), self.spark.table(other)
        merged = a.join(b.hint("merge"), "key", "full_outer").select(
            "key",
            (F.coalesce(a["docs"], F.lit(0)) + F.coalesce(b["docs"], F.lit(0))).alias("docs"),
            F.greatest(a["largest"], b["largest"]).alias("largest"),
        )
        run = self._write(merged)
        self._delete(one)
        self._delete(other)
        return run

    def repeated(self) -> DataFrame:
        """(key, largest) of the keys in `min_docs` documents or more, from all runs merged into one."""
        runs = [self.levels[level] for level in sorted(self.levels)]
        self.levels = {max(self.levels): reduce(self._merge, runs)}
        return self.spark.table(*self.levels.values()).filter(F.col("docs") >= self.min_docs).select("key", "largest")

    def drop(self) -> None:
        for name in self.levels.values():
            self._delete(name)
        self.levels = {}


def drop_lines(docs: DataFrame, repeated: DataFrame, min_chars: int, carry: list[str]) -> DataFrame:
    """Take the lines out whose keys stand in the `dropped` array of the document."""
    schema = T.StructType(
        [docs.schema[name] for name in ["doc_id", *carry]]
        + [T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
    )

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            n_lines = pc.add(pc.count_substring(texts, "\n"), 1).cast(pa.int64())
            n_dropped = np.zeros(len(texts), np.int64)
            touched = np.flatnonzero(pc.is_valid(batch.column("dropped")).to_numpy(zero_copy_only=False))
            replaced = []
            for row in touched.tolist():
                gone = set(batch.column("dropped")[row].as_py())
                lines = texts[row].as_py().split("\n")
                counted, hashes = _keys(pa.array(lines, pa.string()), min_chars)
                drop = np.zeros(len(lines), bool)
                drop[counted] = [key in gone for key in hashes]
                n_dropped[row] = drop.sum()
                replaced.append("\n".join([line for line, out in zip(lines, drop, strict=True) if not out]))
            if len(touched):
                mask = np.zeros(len(texts), bool)
                mask[touched] = True
                texts = pc.replace_with_mask(texts, pa.array(mask), pa.array(replaced, texts.type))
            kept = [batch.column(name) for name in ["doc_id", *carry]]
            yield pa.RecordBatch.from_arrays([*kept, texts, n_lines, pa.array(n_dropped)], schema.names)

    per_doc = repeated.groupBy("doc_id").agg(F.collect_set("key").alias("dropped"))
    per_doc = per_doc.withColumnRenamed("doc_id", "__doc")
    joined = docs.join(per_doc, F.col("doc_id").eqNullSafe(F.col("__doc")), "left")
    return joined.select("doc_id", *carry, "text", "dropped").mapInArrow(clean, schema)


def dedup_lines(
    docs: DataFrame, min_docs: int = 3, min_chars: int = 20, carry: tuple[str, ...] = (), batches: int = 4
) -> DataFrame:
    """Documents without the lines that `min_docs` documents share, which stay only in the largest doc_id that holds them.

    Returns doc_id, `carry`, text, n_lines (before) and n_dropped. The documents are taken as `batches` of falling doc_id.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), *carry)
    cuts = [k / batches for k in range(1, batches)]
    bounds = docs.agg(F.percentile_approx("doc_id", F.lit(cuts) if cuts else F.lit([0.5]), F.lit(1000)).alias("at")).first()["at"]
    bounds = sorted(set(bounds or []))[: len(cuts)]
    number = reduce(lambda a, b: a + b, [F.when(F.col("doc_id") > bound, 1).otherwise(0) for bound in bounds], F.lit(0))
    runs = LineRuns(spark, min_docs)
    with scratch(spark):
        keys = line_keys(docs, min_chars)
        staged = materialise(keys.withColumn("batch", number), "line-keys", partition_by=["batch"])
        for batch in range(len(bounds), -1, -1):
            runs.add(staged.filter(F.col("batch") == batch).select("doc_id", "key"))
        found = staged.select("doc_id", "key").join(runs.repeated(), "key")
        gone = found.filter(~F.col("doc_id").eqNullSafe(F.col("largest"))).select("doc_id", "key")
        gone = materialise(gone, "dropped-lines", keep=True)
    runs.drop()
    return drop_lines(docs, gone, min_chars, list(carry))
