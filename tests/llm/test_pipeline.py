"""Each stage of the pipeline on what its predecessor kept, against a plain version."""

from collections import Counter

import duckdb
import pytest
from odd import clashing, documents, folder

import __spark_entry__ as driver
import corpus_pipeline
from pagetide.llm.common import DOCUMENT_COLUMNS
from pagetide.llm.oracles import ORACLES
from pagetide.session import materialise

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(materialise(stage(spark, kept[-1], TABLES), name))
    return kept


def in_sql(statement, docs):
    connection = duckdb.connect()
    connection.register("documents", docs.select("doc_id", "text").toArrow())
    result = connection.execute(statement)
    names = [column[0] for column in result.description]
    return [dict(zip(names, row, strict=True)) for row in result.fetchall()]


def test_columns(stages):
    assert all(docs.columns == DOCUMENT_COLUMNS for docs in stages[:-1])
    for docs in stages[:-1]:
        assert all(row["n_chars"] == len(row["text"]) for row in docs.collect())


def test_rejected_documents_go(stages):
    judged = in_sql(ORACLES["op8_quality_rules"], stages[0])
    assert {row["doc_id"] for row in judged if row["kept"]} == {row["doc_id"] for row in stages[1].collect()}


def test_shared_lines_go(stages):
    import hashlib

    wanted = {(row["doc_id"], row["kept_sha256"]) for row in in_sql(ORACLES["op2_line_dedup"], stages[1])}
    assert {(row["doc_id"], hashlib.sha256(row["text"].encode()).hexdigest()) for row in stages[2].collect()} == wanted


def test_one_of_each_group_of_near_duplicates_stays(stages):
    sets = {}
    for row in stages[2].collect():
        words = row["text"].encode().lower().split()
        sets[row["doc_id"]] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())
    label = {doc: doc for doc in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    assert {row["doc_id"] for row in stages[3].collect()} == {doc for doc in sets if label[doc] == doc}


def test_copies_follow_the_targets(stages):
    words = lambda rows: sum(len(row["text"].split()) for row in rows)
    before, after = stages[3].collect(), stages[4].collect()
    assert max(Counter(row["doc_id"] for row in after).values()) <= 3
    assert {row["text"] for row in after} <= {row["text"] for row in before}
    assert abs(words(after) - words(before)) <= 0.05 * words(before)


def test_every_copy_is_packed(stages):
    copies = Counter(row["doc_id"] for row in stages[4].collect())
    firsts = Counter(row["doc_id"] for row in stages[5].collect() if row["piece"] == 0)
    assert firsts == copies
    held = Counter()
    for row in stages[5].collect():
        held[row["sequence_id"]] += row["length"]
    assert max(held.values()) <= 1024 and len(held) <= 1.02 * sum(held.values()) / 1024 + 1


def test_run_is_its_stages(spark, stages):
    assert driver.queries()["pipeline"](spark, TABLES).count() == stages[5].count()
    assert "pipeline" not in driver.oracle_sql() and corpus_pipeline.ORACLE_SQL is None


def test_odd_documents_pass_through(spark, tmp_path):
    docs = clashing(documents(spark))
    root = folder(tmp_path / "t", documents=docs.unionAll(docs.filter("doc_id in (5, 8)")))
    assert corpus_pipeline.run(spark, root).count() > 0
    assert corpus_pipeline.run(spark, folder(tmp_path / "e", documents=documents(spark, []))).count() == 0


def test_operators_are_registered_by_number():
    numbers = sorted(int(name[2:].split("_")[0]) for name in driver.queries() if name.startswith("op") and name[2].isdigit())
    assert numbers == list(range(1, 14))
