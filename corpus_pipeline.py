"""The corpus pipeline: raw documents to packed training sequences.

Defined results: a null or empty text fails the quality rules and goes; a null doc_id is a document like any other that is linked with
nothing; repeated rows, and rows that share a doc_id, are judged each by their own text; texts are taken whole; an empty table gives
an empty table; only the columns of `documents` are read, whatever others there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetide.llm.common import DOCUMENT_COLUMNS, table
from pagetide.llm.linedup import dedup_lines
from pagetide.llm.minhash import near_duplicate_rows, text_key
from pagetide.llm.mixing import mix_sources
from pagetide.llm.packing import pack, token_pieces
from pagetide.llm.quality import quality_rules
from pagetide.session import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; the others keep the lines that passed."""
    judged = quality_rules(docs, carry=("lang", "source")).filter("kept")
    return judged.select(
        "doc_id", F.col("cleaned_text").alias("text"), "lang", "source", F.length("cleaned_text").cast("bigint").alias("n_chars")
    )


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three documents share stay in the document with the largest doc_id only; no document goes."""
    kept = dedup_lines(docs, carry=("lang", "source"))
    return kept.withColumn("n_chars", F.length("text").cast("bigint")).select(*DOCUMENT_COLUMNS)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest doc_id.

    Texts go, not ids: of rows with one doc_id, those go whose own text is a near-duplicate.
    """
    gone = near_duplicate_rows(docs).filter("not kept").select("doc_id", "text_key").distinct()
    keyed = docs.withColumn("text_key", text_key(F.col("text").cast("string")))
    return keyed.join(gone, ["doc_id", "text_key"], "left_anti").select(*DOCUMENT_COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    mixed = mix_sources(docs, carry=("text", "lang", "source", "n_chars"))
    copies = mixed.withColumn("copy", F.explode(F.array_repeat(F.lit(True), F.col("copies").cast("int"))))
    return copies.select(*DOCUMENT_COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes in the training sequences."""
    pieces = token_pieces(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(pieces)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("minhash_near_dedup", near),
    ("mixing", mix),
    ("best_fit_packing", packing),
]

# Newton iterations and best-fit packing cannot be stated in SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, f"pipeline-{name}", keep=True)
    return docs
