"""Embedding whitening against a plain eigensolver; prefix trie and decontamination against their DuckDB statements."""

import random

import numpy as np
import pytest
from odd import against_sql, clashing, documents, folder
from pyspark.sql import functions as F

from pagetide.llm.decontam import find_contamination, without_contamination
from pagetide.llm.oracles import ORACLES
from pagetide.llm.queries import QUERIES
from pagetide.llm.trie import NODE_COLUMNS, prefix_trie, sequences, with_shared_heads
from pagetide.llm.whitening import fit_whitening, leading_eigenpairs, whiten

OP11, OP12, OP13 = "op11_embedding_whitening", "op12_conversation_prefix_trie", "op13_benchmark_decontamination"
VECTORS = "vec_id bigint, embedding array<float>, label int"
TURNS = "conv_id bigint, turn bigint, role string, text string"


def plain_whitening(rows, components=32):
    """From the contract, with numpy's own eigensolver. Returns vec_id lists, x, eigenvalues and axes."""
    kept = [(k, v) for k, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.floor(64 * np.array([v for _, v in kept], np.float32).astype(float)).astype(np.int64) + 1_000_000
    y = x - x.sum(axis=0) / len(x)
    values, axes = np.linalg.eigh(y.T @ y / len(x))
    return [k for k, _ in kept], x, values[::-1][:components], axes[:, ::-1][:, :components], np.trace(y.T @ y / len(x))


def check_whitening(found, rows):
    ids, x, values, axes, trace = plain_whitening(rows)
    n, dims = x.shape
    table = {}
    for row in found:
        table.setdefault(row["component"], []).append(row)
    assert sorted(table) == list(range(1, min(32, dims) + 1))
    deviation = ((n * x - x.sum(axis=0)).astype(object) ** 2).sum(axis=1)
    y = x - x.sum(axis=0) / n
    for component, part in table.items():
        assert sorted((row["vec_id"], row["deviation"]) for row in part) == sorted(zip(ids, deviation, strict=True))
        assert all(row["n"] == n and row["identity_error"] <= 1e-9 for row in part)
        assert all(abs(row["explained"] - values[component - 1] / trace) <= 1e-10 for row in part)
    wanted = y @ (axes / np.sqrt(values))
    for component, part in table.items():
        got = {row["vec_id"]: row["whitened"] for row in part}
        own = np.array([got[k] for k in ids])
        sign = np.sign(own @ wanted[:, component - 1])
        assert np.abs(own * sign - wanted[:, component - 1]).max() < 1e-6


def test_whitening_of_the_smallest_table(spark):
    small = "/root/testdata/sf0.001"
    rows = [(row["vec_id"], row["embedding"]) for row in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    check_whitening(QUERIES[OP11](spark, small).collect(), rows)


def test_odd_vectors(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(k, [float(c) for c in v], k) for k, v in enumerate(rng.normal(size=(60, 5)).astype(np.float32) * [1, 2, 3, 4, 5])]
    odd = [(100, None, 1), (101, [1.0, None, 0.0, 0.0, 0.0], 1), (102, [float("nan")] + [0.0] * 4, 1), (103, [float("inf")] + [0.0] * 4, None)]
    other = [(104, [], 1), (105, [1.0, 2.0], 1)]
    repeated = [(k + 1000, v, label) for k, v, label in rows[:7]]
    df = clashing(spark.createDataFrame(rows + odd + other + repeated, VECTORS)).withColumn("vector", F.lit("x")).withColumn("key", F.lit(1))
    root = folder(tmp_path / "t", embeddings=df)
    found = QUERIES[OP11](spark, root)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check_whitening(found.collect(), [(k, v) for k, v, _ in rows + repeated])


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [0.5, 0.25], 1)], [(1, [2.0, 2.0], 1), (2, [2.0, 2.0], 1)]])
def test_nothing_to_whiten(spark, tmp_path, rows):
    root = folder(tmp_path / "t", embeddings=spark.createDataFrame(rows, VECTORS))
    assert QUERIES[OP11](spark, root).count() == 0


def test_constant_dimensions_give_no_component(spark):
    rng = np.random.default_rng(4)
    rows = [(k, [float(a), 3.0, float(b)]) for k, (a, b) in enumerate(rng.normal(size=(50, 2)))]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    model = fit_whitening(df)
    assert len(model.eigenvalues) == 2
    assert all(len(row["whitened"]) == 2 for row in whiten(df, model).collect())


def test_large_entries_stay_exact(spark):
    rows = [(k, [k * 1e13, -k * 7e11 + 0.5]) for k in range(6)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    model = fit_whitening(df)
    x = [[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v in rows]
    assert model.sums == [sum(column) for column in zip(*x, strict=True)]
    for row in whiten(df, model).collect():
        exact = sum((6 * c - s) ** 2 for c, s in zip(x[row["vec_id"]], model.sums, strict=True))
        assert row["deviation"] == (exact if exact < 2**63 else None)


@pytest.mark.parametrize("seed", range(4))
def test_eigenpairs(seed):
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.normal(size=(40, 40)))
    spectra = [np.repeat([5.0, 4, 1, 0.5], 10), 10.0 ** -np.arange(40), 1 + 1e-12 * np.arange(40), np.zeros(40)]
    matrix = (q * spectra[seed]) @ q.T
    matrix = (matrix + matrix.T) / 2
    values, vectors = leading_eigenpairs(matrix, 25)
    scale = max(np.abs(matrix).max(), 1e-300)
    assert np.abs(values - np.linalg.eigvalsh(matrix)[::-1][:25]).max() <= 1e-13 * scale
    assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-13 * scale
    assert np.abs(vectors.T @ vectors - np.eye(25)).max() <= 1e-12


def turns(seed, convs, most=7, texts=3):
    rng = random.Random(seed)
    return [
        (c, t, rng.choice(["user", "assistant"]), " ".join(["word"] * rng.randint(0, texts)))
        for c in convs for t in range(rng.randint(1, most))
    ]


def odd_turns():
    rows = turns(1, range(0, 90)) + turns(2, range(200, 230), 1, 1) + turns(3, [-45, -40, -1, 500])
    rows += [(300, None, "user", "first of all"), (300, 5, None, None), (300, 5, "user", None), (300, None, "user", "a tie"), (300, 2, "a", " \t\n")]
    rows += [(None, 1, "user", "nobody's"), (301, 1, "user", "x" * 20_000), (302, 1, "user", "x" * 20_000), (303, 1, "us", "er:x")]
    # A long group of copies, and a long conversation twice.
    rows += [(c, t, "user", f"copy {t}") for c in range(400, 470) for t in range(4)]
    rows += [(c, t, "user", f"long {t}") for c in (600, 601, 639) for t in range(60)]
    return rows + rows[:25]


@pytest.mark.parametrize("hot", ["1", "4", "64"])
def test_odd_conversations(spark, tmp_path, monkeypatch, hot):
    """However many shards there are, results are those of SQL."""
    monkeypatch.setattr("pagetide.llm.trie.SHARD_CELLS", 4000 // int(hot))
    monkeypatch.setattr("pagetide.llm.trie.LEAST_CELLS", 10**9)
    root = folder(tmp_path / "t", conversations=clashing(spark.createDataFrame(odd_turns(), TURNS)))
    assert against_sql(spark, root, QUERIES[OP12], ORACLES[OP12], "conversations") is None


@pytest.mark.parametrize("seed", range(3))
def test_shards_do_not_change_the_nodes(spark, seed):
    df = spark.createDataFrame(turns(seed, range(120), 5, 1), TURNS)
    found = sequences(df)
    wanted = sorted(prefix_trie(found, 1).collect(), key=str)
    assert sorted(prefix_trie(found, 37).collect(), key=str) == wanted
    assert prefix_trie(found, 3).columns == NODE_COLUMNS


def test_no_conversations(spark, tmp_path):
    root = folder(tmp_path / "t", conversations=spark.createDataFrame([], TURNS))
    assert QUERIES[OP12](spark, root).count() == 0


def test_turnless_conversation_ends_at_the_root(spark):
    rows = [(c, 0, "user", "only turn") for c in (21, 22, 23, 24)]
    found = with_shared_heads(sequences(spark.createDataFrame(rows, TURNS), group=20))
    assert min(len(row["turns"]) for row in found.collect()) == 0
    root = prefix_trie(found).filter("depth = 0").first()
    assert root["n_convs"] == 4 and root["parent_conv_id"] is None and root["n_children"] == 1


def items(spark, rows):
    return clashing(spark.createDataFrame(rows, "item_id bigint, text string"))


TEN = "alpha beta gamma delta epsilon zeta eta theta iota kappa"


def odd_items():
    return [
        (1, f"{TEN} lambda mu"), (2, None), (3, ""), (4, "!!! ..."), (5, "one"), (6, TEN.upper()), (10, "Ünï çödé ﬁ 日本語"),
        (7, "eins zwei drei"), (7, "vier fünf eins"), (None, "d e f g"), (8, "x" * 50_000), (9, "eins zwei drei"), (-3, "b c"),
    ]


def odd_documents(spark):
    more = [
        (50, f"{TEN.replace(' ', ', ')}; Lambda--MU {TEN} {TEN}", "en", "a", 1), (51, "theta iota kappa lambda mu", "en", "a", 1),
        (52, f"x{TEN} {TEN}x", "en", "a", 1), (53, "One one ONE\x00one\x7fone onE_one ones", "en", "a", 1),
    ]
    base = documents(spark)
    extra = spark.createDataFrame(more, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return base.unionByName(clashing(extra)).unionAll(base.filter("doc_id in (11, 14)"))


def test_odd_documents_and_items(spark, tmp_path):
    root = folder(tmp_path / "t", documents=odd_documents(spark), benchmark=items(spark, odd_items()))
    assert against_sql(spark, root, QUERIES[OP13], ORACLES[OP13], "documents", "benchmark") is None


def test_several_automata(spark):
    docs, bench = odd_documents(spark), items(spark, odd_items())
    wanted = sorted(find_contamination(docs, bench).collect(), key=str)
    assert sorted(find_contamination(docs, bench, window_bytes=20_000).collect(), key=str) == wanted


@pytest.mark.parametrize("docs, bench", [([], [(1, "one")]), (None, []), (None, [(1, None)])])
def test_no_documents_or_no_items(spark, tmp_path, docs, bench):
    root = folder(tmp_path / "t", documents=documents(spark, docs), benchmark=items(spark, bench))
    found = QUERIES[OP13](spark, root).collect()
    assert all(row["n_hit"] == 0 and row["n_items"] == 0 and not row["contaminated"] for row in found)
    assert bool(found) == (docs is None)


def test_spans_lie_in_the_original_text(spark):
    text = f"Été déjà: '{TEN.title()}' fin. \U0001F600 {TEN.replace(' ', ' - ')}!"
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    found = find_contamination(docs, items(spark, [(1, TEN)]), carry=("doc_id", "text"))
    row = found.first()
    assert [text[s["start"] : s["end"]] for s in row["spans"]] == [TEN.title(), TEN.replace(" ", " - ")]
    assert [(s["first_word"], s["past_word"]) for s in row["spans"]] == [(2, 12), (14, 24)] and row["n_words"] == 24
    assert without_contamination(found).first()["text"] == "Été déjà: '' fin. \U0001F600 !"


def test_item_ids_of_other_types(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string")
    found = find_contamination(docs, spark.createDataFrame([("q/1", "b"), ("q/0", "c d"), ("p", "c")], "item_id string, text string"))
    assert found.first()["items"] == ["p", "q/1"]
