"""Small tables with everything that data may hold: nulls, empty and long texts, ties, repeated rows, clashing names."""

import random

import duckdb
from pyspark.sql import functions as F

from compare import compare

NAMES = [
    "n_words", "kept", "size", "rank", "node", "bucket", "component_id", "key", "copies", "length", "batch", "dropped", "n", "a",
    "b", "shard", "slot", "target", "words", "lines", "piece", "ids", "score", "keys", "entry", "host", "blocks", "place",
]
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()) + str(rng.randint(0, 60)) for _ in range(n))


def rows(with_null_id=True):
    base = words(1, 120)
    near = base.split(" ")
    near[5] = "CHANGED"
    shared = "This line stands in many of the documents."
    found = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, " \t\n \x0b\r ", "en", "a", 7),
        (4, words(2, 30_000), "en", "b", None),
        (5, base, "fr", "b", 1),
        (6, base.upper(), None, "b", 2),
        (7, " ".join(near), "de", None, 3),
        (8, f"{shared}\n{words(3, 20)}.\n{shared}\n short ", "en", "c", 4),
        (9, f"  {shared.lower()}\t\n{words(4, 20)}.", "en", "é", 4),
        (10, f"{shared}\n{words(5, 20)}.", "es", "z", 4),
        (11, "one", "en", "z", 4),
        (12, "ONE", "en", "z", 4),
        (13, "menu | home | about\n" * 5, "en", "z", 4),
        (14, "eins zwei drei vier fünf " * 30, "de", "z", 4),
        (15, "Ünï çödé ﬁ 日本語 　  <|endoftext|> 'll 12½ \U0001F600 it's\x1c!!.", "en", "z", 4),
        (16, "a b c d e f g h i j k l. " + "x" * 50_000, "en", "z", 4),
        (17, f"{shared}\n{shared}\n\n\n", "en", "z", 4),
    ]
    return found + ([(None, f"{shared}\nno id here", "en", "c", 9), (None, base, "en", "c", 9)] if with_null_id else [])


def clashing(df):
    """The same table with columns whose names the operators use for themselves."""
    return df.select("*", *[F.lit("x").alias(name) for name in NAMES if name not in df.columns])


def documents(spark, found=None):
    return clashing(spark.createDataFrame(rows() if found is None else found, DOCUMENTS))


def folder(root, **tables):
    for name, df in tables.items():
        df.write.parquet(f"{root}/{name}.parquet")
    return str(root)


def against_sql(spark, root, query, sql, *tables):
    connection = duckdb.connect()
    for name in tables or ("documents",):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{root}/{name}.parquet/*.parquet')")
    return compare(spark, connection, str(root), query, sql)
