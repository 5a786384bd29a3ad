"""One registered query per operator, with the parameters of production, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetide.llm.ann import nearest_neighbours
from pagetide.llm.common import table
from pagetide.llm.decontam import find_contamination
from pagetide.llm.htmltext import extract_text
from pagetide.llm.langid import identify_languages, train_language_model
from pagetide.llm.linedup import dedup_lines
from pagetide.llm.minhash import near_duplicates
from pagetide.llm.mixing import mix_sources
from pagetide.llm.ngrams import remainder
from pagetide.llm.packing import pack, token_pieces
from pagetide.llm.quality import quality_rules
from pagetide.llm.sharding import kd_shards
from pagetide.llm.toxicity import score_toxicity, train_toxicity_model
from pagetide.llm.trie import prefix_trie, sequences, with_shared_heads
from pagetide.llm.whitening import fit_whitening, identity_error, whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@_query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "chars_before",
        "chars_after",
    )


@_query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@_query
def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=2)


@_query
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_pieces(table(spark, sf_dir, "documents"))
    return pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


@_query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


@_query
def op3_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards(table(spark, sf_dir, "documents"), shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@_query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify_languages(docs, train_language_model(docs))
    held_out = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


@_query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_toxicity(docs, train_toxicity_model(docs, table(spark, sf_dir, "labels")))
    held_out = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


@_query
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


@_query
def op6_hash_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@_query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    model = fit_whitening(vectors)
    explained = F.array(*[F.lit(float(value) / model.trace) for value in model.eigenvalues]).cast("array<double>")
    each = whiten(vectors, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
        explained[F.col("at")].alias("explained"), F.lit(identity_error(vectors, model)).alias("identity_error"),
    )


@_query
def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rebuilt = with_shared_heads(sequences(table(spark, sf_dir, "conversations"), group=20))
    return prefix_trie(rebuilt).drop("turn_id")


@_query
def op13_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, span: n + span["past_word"] - span["first_word"])
    names = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(names.cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )
