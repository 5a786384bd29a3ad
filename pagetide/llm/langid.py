"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text is the mean of the embeddings of its character n-grams. Embeddings and softmax are trained by stochastic gradient
descent in numpy, on a bounded sample of labelled documents. The softmax is linear, so for prediction both fold into one row
of class scores per bucket, and every whole text is scored in its task. A temperature fitted on documents kept out of
the descent calibrates the scores; below the calibrated `reject` score a prediction is marked as rejected. It is the least score
at or above which the wanted share of those documents is right; if there is none, every prediction is rejected.

Defined results: a text without letters, or null, is `und` with score 0; so is every text if there is nothing to learn from;
rows are judged one by one, so repeated rows get equal results; an empty table gives an empty table; only `doc_id`, `text`
and `lang` are read, `lang` for training alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetide.llm.ngrams import Grams, bounded_sample, remainder

UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageSettings:
    orders: tuple[int, ...] = (1, 2, 3, 4)
    bits: int = 18
    width: int = 16
    sample_per_language: int = 1000  # documents that the training takes of each language
    sample_chars: int = 20_000  # longer documents are not taken for training
    epochs: int = 4
    rate: float = 0.5
    precision: float = 0.99  # wanted among accepted predictions


@dataclass(frozen=True)
class LanguageModel:
    settings: LanguageSettings
    languages: list[str]
    table: np.ndarray  # class scores by bucket
    bias: np.ndarray
    temperature: float
    reject: float


def _softmax(scores: np.ndarray) -> np.ndarray:
    raised = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return raised / raised.sum(axis=-1, keepdims=True)


def reject_below(scores: np.ndarray, right: np.ndarray, precision: float) -> float:
    """The least score at or above which the wanted share of predictions is right; infinite, which accepts none, if there is none."""
    order = np.argsort(-scores, kind="stable")
    ranked, shares = scores[order], np.cumsum(right[order]) / np.arange(1, len(scores) + 1)
    # Equal scores are accepted together, so only the last of them counts.
    last = np.append(ranked[1:] < ranked[:-1], True)[:len(ranked)]
    enough = np.flatnonzero(last & (shares >= precision))
    return float(ranked[enough[-1]]) if len(enough) else float("inf")


def fit(texts: list[str], langs: list[str], settings: LanguageSettings) -> LanguageModel | None:
    """Every fifth document calibrates; the others train."""
    languages = sorted(set(langs))
    if not languages:
        return None
    rng, grams = np.random.default_rng(7), Grams(settings.orders, settings.bits)
    number = {lang: k for k, lang in enumerate(languages)}
    bags, wanted = [], []
    for text, lang in zip(texts, langs, strict=True):
        buckets, counts = np.unique(np.concatenate(list(grams.parts(text))), return_counts=True)
        if len(buckets):
            bags.append((buckets, (counts / counts.sum()).astype(np.float32)))
            wanted.append(number[lang])
    embeddings = rng.normal(0, 0.1, (1 << settings.bits, settings.width)).astype(np.float32)
    weights, bias = np.zeros((settings.width, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    order = rng.permutation(len(bags))
    kept_out, train = order[::5] if len(order) >= 50 else order, order[np.arange(len(order)) % 5 > 0] if len(order) >= 50 else order
    steps, done = settings.epochs * len(train), 0
    for _ in range(settings.epochs):
        for k in rng.permutation(train):
            rate = settings.rate * (1 - done / steps)
            done += 1
            buckets, shares = bags[k]
            mean = shares @ embeddings[buckets]
            error = _softmax(mean @ weights + bias)
            error[wanted[k]] -= 1
            back = weights @ error
            weights -= rate * np.outer(mean, error)
            bias -= 0.1 * rate * error
            # Scaled so that the mean moves by `rate` whatever the number of n-grams.
            embeddings[buckets] -= np.outer(shares * (rate / float(shares @ shares)), back)
    scores = np.array([bags[k][1] @ embeddings[bags[k][0]] @ weights + bias for k in kept_out]).reshape(-1, len(languages))
    truth = np.array(wanted)[kept_out] if len(kept_out) else np.zeros(0, int)
    temperatures = np.geomspace(0.02, 20, 60)
    losses = [-np.log(_softmax(scores / t)[np.arange(len(truth)), truth] + 1e-9).mean() if len(truth) else 0 for t in temperatures]
    temperature = float(temperatures[int(np.argmin(losses))])
    chances = _softmax(scores / temperature)
    top, right = chances.max(axis=1), chances.argmax(axis=1) == truth
    reject = reject_below(top, right, settings.precision)
    return LanguageModel(settings, languages, (embeddings @ weights).astype(np.float32), bias, temperature, reject)


def train_language_model(docs: DataFrame, settings: LanguageSettings = LanguageSettings(), folds: int = 5) -> LanguageModel | None:
    """Fit on documents with a language whose id is not in fold 0. Takes a bounded sample; both bounds are settings."""
    labelled = docs.filter("lang is not null and text is not null and doc_id is not null")
    labelled = labelled.filter((remainder(F.col("doc_id"), folds) != 0) & (F.length("text") <= settings.sample_chars))
    chosen = bounded_sample(labelled.select("doc_id", "lang", "text"), "lang", settings.sample_per_language)
    sample = chosen.select("doc_id", "lang", "text").toPandas().sort_values(["doc_id", "text"])
    return fit(sample["text"].tolist(), sample["lang"].tolist(), settings)


def identify_languages(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """doc_id, lang_pred, score and rejected of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        letter, learned = regex.compile(r"\p{L}"), shared.value
        grams = Grams(learned.settings.orders, learned.settings.bits) if learned else None
        for batch in batches:
            langs, scores, rejected = [], [], []
            for text in batch.column("text").to_pylist():
                if not learned or not text or not letter.search(text):
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    rejected.append(True)
                    continue
                total, n = np.zeros(len(learned.languages)), 0
                for buckets in grams.parts(text):
                    total += learned.table[buckets].sum(axis=0)
                    n += len(buckets)
                chances = _softmax((total / n + learned.bias) / learned.temperature)
                best = int(chances.argmax())
                langs.append(learned.languages[best])
                scores.append(float(chances[best]))
                rejected.append(bool(chances[best] < learned.reject))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(predict, "doc_id bigint, lang_pred string, score double, rejected boolean")
