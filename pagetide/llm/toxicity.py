"""Toxicity: a linear classifier on character n-grams, whose features are scaled by naive Bayes log-count ratios.

A feature is the presence of an n-gram in the whole text, times the log-ratio of the shares of toxic and other documents that
hold it. Ratios shrink by their certainty, so that long texts do not add up noise and rare toxic words still have features; the
certainty is measured on the n-gram's own documents, by how far their labels are from those of the sample. A logistic
regression on the scaled features is trained in numpy on a bounded sample of labelled documents, in which both labels weigh
the same; for scoring, ratio and weight fold into one number per bucket, and every whole text is scored in its task.

Defined results: null and empty texts get the score of a text without features; with nothing to learn from, the score is 0;
rows are judged one by one, so repeated rows get equal results; a document with both labels counts as toxic; an empty
table gives an empty table; only `doc_id` and `text` are read, and `doc_id` and `toxic` of the labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetide.llm.ngrams import Grams, bounded_sample, remainder


@dataclass(frozen=True)
class ToxicitySettings:
    orders: tuple[int, ...] = (3, 4, 5)
    bits: int = 22
    sample_per_label: int = 3000  # labelled documents that the training takes of each label
    sample_chars: int = 20_000  # longer documents are not taken for training
    smoothing: float = 1.0
    least_documents: int = 3
    least_error: float = 2.0  # standard errors by which an n-gram's toxic documents must differ from their share of the sample
    half_error: float = 8.0  # standard errors at which a log-ratio counts half
    penalty: float = 1e-4
    steps: int = 400


@dataclass(frozen=True)
class ToxicityModel:
    settings: ToxicitySettings
    buckets: np.ndarray
    weights: np.ndarray
    bias: float


def fit(texts: list[str], toxic: list[int], settings: ToxicitySettings) -> ToxicityModel | None:
    labels = np.array(toxic, float)
    if not len(labels):
        return None
    grams = Grams(settings.orders, settings.bits)
    held = [np.unique(np.concatenate(list(grams.parts(text)))) for text in texts]
    size = 1 << settings.bits
    with_label = [np.zeros(size, np.float32), np.zeros(size, np.float32)]
    for buckets, label in zip(held, toxic, strict=True):
        with_label[label][buckets] += 1
    other, bad = with_label
    n_bad, n_other, a = labels.sum(), len(labels) - labels.sum(), settings.smoothing
    ratio = np.log((bad + a) / (n_bad + 2 * a)) - np.log((other + a) / (n_other + 2 * a))
    n, share = bad + other, (n_bad + a) / (len(labels) + 2 * a)
    error = np.abs(bad - n * share) / np.sqrt(np.maximum(n, 1) * share * (1 - share))
    chosen = (n >= settings.least_documents) & (error >= settings.least_error)
    ratio *= error**2 / (error**2 + settings.half_error**2)
    place = np.full(size, -1, np.int32)
    buckets = np.flatnonzero(chosen)
    place[buckets] = np.arange(len(buckets))
    rows, columns = [], []
    for k, own in enumerate(held):
        found = place[own]
        found = found[found >= 0]
        rows.append(np.full(len(found), k))
        columns.append(found)
    rows, columns = np.concatenate(rows), np.concatenate(columns)
    scale = ratio[buckets]
    values = scale[columns]
    both = n_bad > 0 and n_other > 0
    weights, bias = np.zeros(len(buckets)), 0.0 if both else float(np.log((n_bad + a) / (n_other + a)))
    part = np.where(labels == 1, 1 / max(n_bad, 1), 1 / max(n_other, 1)) / (2 if both else 1)
    # Full-batch descent with a step per weight by the size of its past gradients.
    past, past_bias = np.full(len(buckets), 1e-8), 1e-8
    for _ in range(settings.steps if len(buckets) else 0):
        z = np.bincount(rows, values * weights[columns], len(labels)) + bias
        miss = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - labels) * part
        slope = np.bincount(columns, values * miss[rows], len(buckets)) + settings.penalty * weights
        past, past_bias = past + slope**2, past_bias + miss.sum() ** 2
        weights -= 0.1 * slope / np.sqrt(past)
        bias -= 0.1 * miss.sum() / np.sqrt(past_bias)
    return ToxicityModel(settings, buckets, (weights * scale).astype(np.float32), bias)


def train_toxicity_model(
    docs: DataFrame, labels: DataFrame, settings: ToxicitySettings = ToxicitySettings(), folds: int = 3, held_out: int = 1
) -> ToxicityModel | None:
    """Fit on labelled documents outside the held-out fold. Takes a bounded sample; both bounds are settings."""
    known = labels.filter("toxic in (0, 1) and doc_id is not null").filter(remainder(F.col("doc_id"), folds) != held_out)
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = bounded_sample(known, "toxic", settings.sample_per_label)
    short = docs.filter(F.length("text") <= settings.sample_chars).select("doc_id", "text")
    sample = short.join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text").toPandas().sort_values(["doc_id", "text"])
    return fit(sample["text"].tolist(), sample["toxic"].tolist(), settings)


def score_toxicity(docs: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """doc_id and score of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = shared.value
        if learned:
            grams = Grams(learned.settings.orders, learned.settings.bits)
            table = np.zeros(1 << learned.settings.bits, np.float32)
            table[learned.buckets] = learned.weights
        for batch in batches:
            scores = []
            for text in batch.column("text").to_pylist():
                z = -np.inf
                if learned:
                    found = [buckets[table[buckets] != 0] for buckets in grams.parts(text or "")]
                    z = learned.bias + float(table[np.unique(np.concatenate(found))].sum(dtype=np.float64))
                scores.append(float(1 / (1 + np.exp(-np.clip(z, -50, 50)))) if np.isfinite(z) else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(score, "doc_id bigint, score double")
