"""Hashed character n-grams of whole texts, in numpy inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A longer text is worked on in parts that overlap by the longest n-gram less one character, so none is lost or counted twice.
PART = 500_000
BLANK = 32


class Grams:
    """Buckets of the character n-grams of lower-cased text, in which everything but letters is one blank."""

    def __init__(self, orders: tuple[int, ...], bits: int) -> None:
        self.orders, self.shift = orders, np.uint64(64 - bits)
        self.letters = np.arange(0x110000, dtype=np.uint32)
        alpha = np.fromiter((chr(code).isalpha() for code in range(0x30000)), bool, 0x30000)
        self.letters[:0x30000][~alpha] = BLANK

    def codes(self, text: str) -> np.ndarray:
        codes = self.letters[np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)]
        blank = codes == BLANK
        return codes[np.concatenate(([True], ~(blank[1:] & blank[:-1])))].astype(np.uint64)

    def parts(self, text: str) -> Iterator[np.ndarray]:
        codes = self.codes(text)
        reach = max(self.orders) - 1
        for start in range(0, max(len(codes) - reach, 1), PART):
            yield self._buckets(codes[start : start + PART + reach], last=start + PART >= len(codes) - reach)

    def _buckets(self, codes: np.ndarray, last: bool) -> np.ndarray:
        grams, found = codes, []
        for n in range(1, max(self.orders) + 1):
            if n > 1:
                grams = grams[:-1] * np.uint64(0x100000001B3) + codes[n - 1 :]
            if n in self.orders:
                own = grams if last else grams[:PART]
                found.append((own * np.uint64(0x9E3779B97F4A7C15)) >> self.shift)
        return np.concatenate(found).astype(np.int64)


def remainder(doc_id: Column, folds: int) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds))


def bounded_sample(rows: DataFrame, label: str, most: int) -> DataFrame:
    """Rows (doc_id, label): all of a label with up to `most` rows, else about `most` of them, chosen by hash.

    The same rows come every time. Labels are few; their counts are all that goes to the driver.
    """
    counts = rows.groupBy(label).count()
    unit = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    return rows.join(F.broadcast(counts), label).filter(unit * F.col("count") <= most).drop("count")
