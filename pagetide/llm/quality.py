"""Quality rules, line first: lines that fail a rule go, and a document that loses too much text is rejected.

Only DataFrame functions. Everything is computed within the row, so there is no shuffle and no group can be hot.

Defined results: a null text has no lines and no words; documents without words fail the base rules; repeated rows are judged
one by one; an empty table gives an empty table; only `doc_id`, `text` and the
`carry` are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetide.llm.common import WORD, bind

# Characters and phrases that the line rules look for.
SYMBOLS = r"[#*$%&|<>]"
LINE_SYMBOLS = r"[#*$%&<>{}=~^\\]"
# Marks that end or divide sentences, also of Indic, Arabic, Ethiopic, Burmese, Khmer, Tibetan, Mongolian and Armenian script; the
# letters of Thai and Lao stand for one, as these scripts have none.
ASCII_MARKS = r"[.!?:;]"
OTHER_MARKS = r"[…。！？｡．।॥؟؛۔።፧፨။၊។៕།༎᠃։\x{0E01}-\x{0E2E}\x{0E81}-\x{0EAE}]"
SHOUTS = r"[!?]"
MENU_MARKS = r"[|»›→•·]"
BOILERPLATE = (
    r"(?i)(all rights reserved|cookie policy|privacy policy|terms of (use|service)|enable javascript|lorem ipsum|click here|"
    r"sign in to|log in to|subscribe to our|add to cart|share this|skip to content)"
)

WINDOW = 5


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules. A line fails when it goes beyond any of them."""

    shouts_percent: int = 25  # exclamation and question marks against words
    menu_percent: int = 25  # separators of menus against words
    symbol_percent: int = 10  # symbols against characters
    min_words: int = 10
    max_repeat_percent: int = 20
    max_lost_percent: int = 60  # of the characters of lines with words


def repeated_words(words: Column, n_words: Column) -> Column:
    """Words inside five-word windows that occur twice or more in the text, the first occurrence included."""
    windows = F.when(
        n_words >= WINDOW,
        F.transform(F.sequence(F.lit(0), n_words - WINDOW), lambda i: F.xxhash64(*[words[i + k] for k in range(WINDOW)])),
    ).otherwise(F.array().cast("array<bigint>"))

    def covered(found: Column) -> Column:
        start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
        total = F.aggregate(
            F.array_sort(found),
            start,
            lambda a, at: F.struct(
                (at + WINDOW).alias("end"), (a["n"] + at + WINDOW - F.greatest(a["end"], at)).alias("n")
            ),
        )
        return total["n"]

    def positions(pairs: Column) -> Column:
        last = F.size(pairs) - 1
        twin = lambda k: (
            ((k > 0) & (pairs[F.greatest(k - 1, F.lit(0))]["hash"] == pairs[k]["hash"]))
            | ((k < last) & (pairs[F.least(k + 1, last)]["hash"] == pairs[k]["hash"]))
        )
        return F.transform(F.filter(F.sequence(F.lit(0), last), twin), lambda k: pairs[k]["at"])

    def count(hashes: Column) -> Column:
        pairs = F.transform(hashes, lambda x, i: F.struct(x.alias("hash"), i.alias("at")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            bind(F.sort_array(pairs), lambda s: bind(positions(s), covered))
        )

    return bind(windows, count)


def line_passes(line: Column, rules: LineRules) -> Column:
    """Punctuation, navigation and boilerplate rules on a line that has a word."""
    n_words = F.regexp_count(line, F.lit(WORD))
    # Found at the first mark; the wide class, costly for each character, sees only lines without an ASCII one.
    punctuation = (line.rlike(ASCII_MARKS) | line.rlike(OTHER_MARKS)) & (
        100 * F.regexp_count(line, F.lit(SHOUTS)) <= rules.shouts_percent * n_words
    )
    navigation = 100 * F.regexp_count(line, F.lit(MENU_MARKS)) <= rules.menu_percent * n_words
    boilerplate = (100 * F.regexp_count(line, F.lit(LINE_SYMBOLS)) <= rules.symbol_percent * F.length(line)) & ~line.rlike(
        BOILERPLATE
    )
    return punctuation & navigation & boilerplate


def quality_rules(docs: DataFrame, rules: LineRules = LineRules(), carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, `carry`, the base figures, `cleaned_text` (the lines that passed, with blank lines between them
    untouched), the characters before and after, and the verdict `kept`."""
    text = F.col("text")
    parts = docs.select("doc_id", "text", *carry).select(
        "doc_id",
        *carry,
        "text",
        F.coalesce(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.array().cast("array<string>")).alias("words"),
        F.coalesce(F.split("text", "\n"), F.array().cast("array<string>")).alias("lines"),
    )
    judged = parts.select(
        "doc_id",
        *carry,
        F.size("words").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.coalesce(F.regexp_count("text", F.lit(SYMBOLS)), F.lit(0)).cast("bigint").alias("n_symbols"),
        repeated_words(F.col("words"), F.size("words")).cast("bigint").alias("n_repeat_words"),
        F.transform(
            "lines",
            lambda x: F.struct(
                x.alias("line"), x.rlike(WORD).alias("worded"), (~x.rlike(WORD) | line_passes(x, rules)).alias("passes")
            ),
        ).alias("judged"),
        text.isNull().alias("no_text"),
    )
    worded = F.filter("judged", lambda x: x["worded"])
    characters = lambda lines: F.length(F.array_join(F.transform(lines, lambda x: x["line"]), "")).cast("bigint")
    counted = judged.select(
        "doc_id",
        *carry,
        F.col("n_words").cast("bigint").alias("n_words"),
        "word_chars",
        "n_symbols",
        bind(
            F.transform(worded, lambda x: x["line"]), lambda x: F.size(x) - F.size(F.array_distinct(x))
        ).cast("bigint").alias("n_dup_lines"),
        "n_repeat_words",
        ((F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))).alias(
            "base_failed"
        ),
        characters(worded).alias("chars_before"),
        characters(F.filter("judged", lambda x: x["worded"] & x["passes"])).alias("chars_after"),
        F.when(
            ~F.col("no_text"),
            F.array_join(F.transform(F.filter("judged", lambda x: x["passes"]), lambda x: x["line"]), "\n"),
        ).alias("cleaned_text"),
    )
    lost = F.col("chars_before") - F.col("chars_after")
    verdict = ~F.col("base_failed") & (100 * lost <= rules.max_lost_percent * F.col("chars_before"))
    # Always true. It keeps filters on the verdict above this projection; below it they would compute every figure again,
    # and split the text anew for each word.
    verdict = verdict & (F.monotonically_increasing_id() >= 0)
    return counted.withColumn("kept", verdict)
