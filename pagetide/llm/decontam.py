"""Benchmark decontamination: one Aho-Corasick automaton over normalised test items, scanning every text once.

A text is normalised to its words, lower-cased where they are ASCII, with one space before and after each. A window is `words`
consecutive words of an item; an item of fewer words is one window. The windows, each once whatever the number of items holding it,
are the patterns of the automaton, with their spaces, so that only whole words match. The places of matches in the normalised text
are word numbers, and these lead back to places in the original one. Nothing is shuffled: the test items go to the tasks.

The automaton has a bound, `window_bytes`, which is checked: items whose windows are larger together are dealt into several
automata by hash, one after the other, each of a pass of its own over the texts, and a document's hits of all passes are united.

Defined results: a null text has no words and no hits; an item without words has no window; items with equal ids are one item, and
an item with a null id marks words but is in no list of items; repeated documents are judged each; without items nothing is hit; an
empty table of documents gives an empty table. Other columns are carried along as named by `carry`.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetide.session import materialise, scratch

# Words are ASCII letters and digits and whatever is not ASCII; A-Z counts as a-z. Fixed by the contract.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_FOLD = bytes(
    code + 32 if 0x41 <= code <= 0x5A else code if code > 0x7F or 0x30 <= code <= 0x39 or 0x61 <= code <= 0x7A else 32
    for code in range(256)
)

WINDOW_BYTES = 8 * 1024 * 1024
BATCH_ROWS = 512
# Automata of this worker, by what they were made from.
_BUILT: dict[tuple, tuple] = {}


def folded(text: str | None) -> bytes:
    """The text's bytes, with spaces for what is in no word. Places are those of the original bytes."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)


def words_column(text: Column) -> Column:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), upper, lower), F.lit(WORD), F.lit(0))


def item_windows(items: DataFrame, words: int = 10, key: str = "item_id", text: str = "text") -> DataFrame:
    """(window, items): each distinct window, words with single spaces, and the sorted distinct ids of the items that hold it."""
    found = items.select(F.col(key).alias("item"), words_column(F.col(text).cast("string")).alias("words"))
    n = F.size("words")
    at = F.sequence(F.lit(1), F.greatest(n - words + 1, F.lit(1)))
    windows = F.when(n > 0, F.transform(at, lambda k: F.array_join(F.slice("words", k, words), " ")))
    each = found.select("item", F.explode(windows).alias("window"))
    return each.groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("items"))


def automaton(windows: Sequence[tuple[str, list]]) -> tuple[ahocorasick.Automaton, list[list]]:
    """The automaton over the bytes of all windows, and the items of each."""
    key = tuple(windows[0][0:1]) + tuple(windows[-1][0:1]) + (len(windows), hash(tuple(window for window, _ in windows)))
    if key not in _BUILT:
        _BUILT.clear()
        made = ahocorasick.Automaton()
        for number, (window, _) in enumerate(windows):
            pattern = f" {window} ".encode().decode("latin-1")
            made.add_word(pattern, (number, window.count(" ") + 1, len(pattern)))
        made.make_automaton()
        _BUILT[key] = made
    return _BUILT[key], [items for _, items in windows]


def scan(text: str | None, made: ahocorasick.Automaton | None) -> tuple[int, np.ndarray, set[int]]:
    """Number of words, (first, past) word numbers of the merged hits, and the numbers of the windows that occur."""
    parts = folded(text).split()
    if made is None or not parts:
        return len(parts), np.zeros((0, 2), np.int64), set()
    normal = b" " + b" ".join(parts) + b" "
    ends, counts, sizes, seen = [], [], [], set()
    for end, (number, count, size) in made.iter(normal.decode("latin-1")):
        ends.append(end)
        counts.append(count)
        sizes.append(size)
        seen.add(number)
    if not ends:
        return len(parts), np.zeros((0, 2), np.int64), seen
    # The word that begins behind the k-th space is word k.
    spaces = np.flatnonzero(np.frombuffer(normal, np.uint8) == 32)
    first = np.searchsorted(spaces, np.array(ends) - np.array(sizes) + 1)
    marks = np.zeros(len(parts) + 1, np.int64)
    np.add.at(marks, first, 1)
    np.add.at(marks, first + np.array(counts), -1)
    return len(parts), ranges(np.cumsum(marks[:-1]) > 0), seen


def ranges(hit: np.ndarray) -> np.ndarray:
    edges = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).view(np.int8)))
    return edges.reshape(-1, 2)


def in_original(text: str, spans: np.ndarray) -> list[tuple[int, int]]:
    """The spans of words as code points of the original text: from the first letter of a word to the end of another."""
    if not len(spans):
        return []
    source = folded(text)
    inside = ranges(np.frombuffer(source, np.uint8) != 32)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    return list(zip(points[inside[spans[:, 0], 0]].tolist(), points[inside[spans[:, 1] - 1, 1]].tolist(), strict=True))


def _pass(docs: DataFrame, windows: list[tuple[str, list]], item_type: str, names: list[str]) -> DataFrame:
    """One scan of every text, keeping the columns of `names`. What earlier passes hit is united with what this one does."""
    kinds = {field.name: field.dataType.simpleString() for field in docs.schema}
    later = "spans" in docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, items_of = automaton(windows) if windows else (None, [])
        for whole in batches:
            for batch in (whole.slice(at, BATCH_ROWS) for at in range(0, len(whole), BATCH_ROWS)):
                totals, spans, items = [], [], []
                before = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist(), strict=True) if later else None
                for text in batch.column("text").to_pylist():
                    n, found, seen = scan(text, made)
                    own = {item for number in seen for item in items_of[number]}
                    if before is not None:
                        old_spans, old_items = next(before)
                        hit = np.zeros(n, bool)
                        for first, past in [*((s["first_word"], s["past_word"]) for s in old_spans), *found.tolist()]:
                            hit[first:past] = True
                        found, own = ranges(hit), own | set(old_items)
                    points = in_original(text, found)
                    totals.append(n)
                    spans.append([
                        {"first_word": first, "past_word": past, "start": start, "end": end}
                        for (first, past), (start, end) in zip(found.tolist(), points, strict=True)
                    ])
                    items.append(sorted(own))
                kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("first_word", "past_word", "start", "end")]))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(name) for name in names], pa.array(totals, pa.int64()), pa.array(spans, kind),
                     pa.array(items, pa.list_(_ARROW.get(item_type, pa.string())))],
                    [*names, "n_words", "spans", "items"],
                )

    span = "struct<first_word: bigint, past_word: bigint, start: bigint, end: bigint>"
    schema = ", ".join(f"`{name}` {kinds[name]}" for name in names)
    return docs.mapInArrow(run, f"{schema}, n_words bigint, spans array<{span}>, items array<{item_type}>")


_ARROW = {"bigint": pa.int64(), "string": pa.string()}


def find_contamination(
    docs: DataFrame, items: DataFrame, words: int = 10, carry: Sequence[str] = ("doc_id",), window_bytes: int = WINDOW_BYTES
) -> DataFrame:
    """`carry`, n_words, spans and items of every document.

    A span is a longest run of hit words: their numbers (first_word to past_word, without it) and their place in the text, in code
    points (start to end, without it). `items` are the sorted ids of the items with a window in the text.
    """
    numeric = dict(items.dtypes)["item_id"] in ("tinyint", "smallint", "int", "bigint")
    item_type = "bigint" if numeric else "string"
    keyed = items.select(F.col("item_id").cast(item_type).alias("item_id"), F.col("text"))
    own = [name for name in carry if name != "text"]
    scanned = docs.select(*own, F.col("text").cast("string").alias("text"))
    with scratch(docs.sparkSession):
        windows = materialise(item_windows(keyed, words), "benchmark-windows")
        size = F.octet_length("window") + 16 + F.when(F.lit(numeric), 8 * F.size("items")).otherwise(
            F.aggregate(F.col("items").cast("array<string>"), F.lit(0), lambda n, item: n + F.octet_length(item) + 8)
        )
        parts = max(1, -(-(windows.agg(F.sum(size)).first()[0] or 0) // window_bytes))
        for part in range(parts):
            some = windows.filter(F.pmod(F.xxhash64("window"), F.lit(parts)) == part) if parts > 1 else windows
            rows = sorted((row["window"], row["items"]) for row in some.collect())
            last = part == parts - 1
            scanned = _pass(scanned, rows, item_type, list(carry) if last else [*own, "text"])
            if not last:
                scanned = materialise(scanned, "scanned", keep=True)
    return scanned


def without_contamination(found: DataFrame) -> DataFrame:
    """The texts (of rows that carry `text`) without their hit spans. What is left of a text is joined as it is."""
    past = F.concat(F.array(F.lit(0).cast("bigint")), F.transform("spans", lambda s: s["end"]))
    until = F.concat(F.transform("spans", lambda s: s["start"]), F.array(F.length("text").cast("bigint")))
    pieces = F.transform(
        F.arrays_zip(past.alias("past"), until.alias("until")),
        lambda gap: F.substring(F.col("text"), gap["past"].cast("int") + 1, (gap["until"] - gap["past"]).cast("int")),
    )
    return found.withColumn("text", F.array_join(pieces, ""))
