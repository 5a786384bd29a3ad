"""Quality rules, line dedup and near-duplicates against their DuckDB statements."""

import random

import duckdb
import pytest
from compare import compare, connect
from odd import against_sql, documents, folder, rows, words
from pyspark.sql import functions as F

from pagetide.llm import minhash
from pagetide.llm.linedup import LineRuns, dedup_lines, line_keys
from pagetide.llm.minhash import Shingler, Sketcher, components, near_duplicate_rows, near_duplicates, text_key
from pagetide.llm.oracles import ORACLES
from pagetide.llm.quality import quality_rules
from pagetide.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_smallest_tables(spark, name):
    small = "/root/testdata/sf0.001"
    assert compare(spark, connect(small), small, QUERIES[name], ORACLES[name]) is None


@pytest.mark.parametrize("name", ["op2_line_dedup", "op8_quality_rules"])
def test_odd_documents(spark, tmp_path, name):
    odd = documents(spark)
    root = folder(tmp_path / "t", documents=odd.unionAll(odd.filter("doc_id in (5, 8, 13)")))
    assert against_sql(spark, root, QUERIES[name], ORACLES[name]) is None


def test_odd_near_duplicates(spark, tmp_path):
    root = folder(tmp_path / "t", documents=documents(spark, rows(with_null_id=False)))
    name = "op10_minhash_near_dedup"
    assert against_sql(spark, root, QUERIES[name], ORACLES[name]) is None


@pytest.mark.parametrize("name", ["op2_line_dedup", "op8_quality_rules", "op10_minhash_near_dedup"])
def test_empty_table(spark, tmp_path, name):
    root = folder(tmp_path / "t", documents=documents(spark, []))
    assert QUERIES[name](spark, root).count() == 0


def test_rejected_and_cleaned_text(spark):
    docs = spark.createDataFrame(
        [(1, "Home | About | News\nThe quick brown fox jumps over the lazy dog, and then it sleeps.\nPrivacy policy."),
         (2, "Buy now | cheap | pills\nwww | top | best\nfoo | bar | baz | qux | quux")],
        "doc_id bigint, text string",
    )
    one, two = quality_rules(docs).orderBy("doc_id").collect()
    assert one["kept"] and one["cleaned_text"] == "The quick brown fox jumps over the lazy dog, and then it sleeps."
    assert not two["kept"] and not two["base_failed"]


def test_clean_texts_of_other_scripts_stay(spark, tmp_path):
    texts = [
        "यह एक साफ और छोटा वाक्य है जो दो पंक्तियों में है।\nयहाँ दूसरी पंक्ति भी पूरी तरह साफ लिखी गई है।",
        "هل هذا نص عربي نظيف من عدة كلمات طويلة جدا هنا؟\nنعم، هذا نص نظيف؛ وفيه أكثر من عشر كلمات",
        "یہ اردو کا ایک صاف ستھرا جملہ ہے جو یہاں لکھا گیا ہے۔", "ይህ ንጹህ የአማርኛ ጽሑፍ ነው እና ከአስር በላይ ቃላት አሉት እዚህ ላይ።",
        "นี่ คือ ข้อความ ภาษา ไทย ที่ สะอาด และ มี คำ มาก กว่า สิบ คำ", "ဒါ ဟာ သန့်ရှင်းတဲ့ စာသား တစ်ခု ဖြစ်ပြီး စကားလုံး ဆယ်လုံး ထက် ပို ပါ တယ် ။",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert all(row["kept"] and row["cleaned_text"] == texts[row["doc_id"]] for row in quality_rules(docs).collect())
    root = folder(tmp_path / "t", documents=documents(spark, [(k, text, "xx", "a", 1) for k, text in enumerate(texts)]))
    assert against_sql(spark, root, QUERIES["op8_quality_rules"], ORACLES["op8_quality_rules"]) is None


def test_filter_on_the_verdict_stays_above(spark):
    plan = quality_rules(documents(spark)).filter("kept").select("doc_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" in plan or plan.index("Filter") < plan.index("Project", plan.index("Filter"))


def test_line_runs_settle_and_merge(spark):
    docs = spark.createDataFrame([(k, f"a line that all of the documents hold\nline of its own {k:05d} ...") for k in range(8)], "doc_id bigint, text string")
    keys = line_keys(docs, 20)
    runs = LineRuns(spark, 3)
    for low in (6, 4, 2, 0):
        runs.add(keys.filter(F.col("doc_id").between(low, low + 1)))
    assert list(runs.levels) == [2]
    assert [row["largest"] for row in runs.repeated().collect()] == [7]
    # The fourth batch finds the key settled and adds its own lines alone.
    stored = spark.table(runs.levels[2])
    assert stored.agg(F.max("docs")).first()[0] == 4 and stored.count() == 9
    runs.drop()


@pytest.mark.parametrize("batches", [1, 3])
def test_batches_do_not_change_the_result(spark, batches):
    docs = documents(spark)
    wanted = sorted(dedup_lines(docs).collect(), key=str)
    assert sorted(dedup_lines(docs, batches=batches).collect(), key=str) == wanted


def test_carried_columns(spark):
    kept = dedup_lines(documents(spark), carry=("lang", "kept"))
    assert kept.columns == ["doc_id", "lang", "kept", "text", "n_lines", "n_dropped"]


def test_null_ids_and_repeated_rows_of_near_duplicates(spark):
    docs = documents(spark)
    found = near_duplicates(docs.unionAll(docs.filter("doc_id = 7")), words=2).collect()
    assert sorted(row["doc_id"] for row in found if row["component_id"] == 5) == [5, 6, 7, 7]
    assert all(row["component_id"] is None and row["kept"] for row in found if row["doc_id"] is None)
    assert all(row["kept"] for row in found if row["doc_id"] in (1, 2, 3))


def test_texts_that_share_a_doc_id(spark):
    one, other, third = (words(seed, 60) for seed in (21, 22, 23))
    near = one.replace(one.split(" ")[30], "changed", 1)
    found = [(5, one), (7, near), (7, other), (5, third), (9, other), (9, third)]
    docs = spark.createDataFrame(found, "doc_id bigint, text string")
    rows_ = near_duplicates(docs, words=2)
    got = sorted((row["doc_id"], row["component_id"], row["kept"]) for row in rows_.collect())
    assert got == [(5, 5, True), (5, 5, True), (7, 5, False), (7, 7, True), (9, 5, False), (9, 7, False)]
    rows_ = near_duplicate_rows(docs, words=2).filter("kept").join(docs.withColumn("text_key", text_key(F.col("text"))), ["doc_id", "text_key"])
    assert sorted(row["text"] for row in rows_.collect()) == sorted([one, other, third])


def test_links_that_a_star_misses(spark):
    """A chain: each text is close to the next only, and the first is the centre of shared buckets."""
    words, found = [f"w{k}" for k in range(300)], []
    for k in range(12):
        found.append((k, " ".join(words[8 * k : 8 * k + 200])))
    chain = near_duplicates(spark.createDataFrame(found, "doc_id bigint, text string"), words=1)
    assert {row["component_id"] for row in chain.collect()} == {0}


def test_a_group_of_strays_is_left_alone(spark):
    base = [f"w{k}" for k in range(100)]
    found = [(0, " ".join(base))]
    for k in range(1, 41):
        own = list(base)
        for at in range(0, 100, 7 if k % 2 else 20):
            own[at] = f"own{k}x{at}"
        found.append((k, " ".join(own)))
    rows_ = near_duplicates(spark.createDataFrame(found, "doc_id bigint, text string"), words=1).collect()
    sets = {k: set(text.split()) for k, text in found}
    label = {k: k for k in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a] = min(label[a], label[b])
    assert {row["doc_id"]: row["component_id"] for row in rows_} == label


def test_members_that_outlast_their_bucket_are_measured(spark):
    """Twins behind more strays than a round has centres; the strays leave a round late, as helpers that leave first hold their words."""
    base, found = [f"w{k}" for k in range(176)], []
    own = lambda name, n: [f"{name}x{k}" for k in range(n)]
    for k in range(60):
        found.append((k, [f"h{k}a", f"h{k}b", *own(f"s{k}", 22)]))
        found += [(100 + 2 * k + i, [f"h{k}{side}", *own(f"o{k}{side}", 23)]) for i, side in enumerate("ab")]
    for k in range(6):
        found += [(300 + 2 * k + i, [f"t{k}a", f"t{k}b", *own(f"t{k}{side}", 22)]) for i, side in enumerate("ab")]
    texts = [(k, " ".join(base + more)) for k, more in found]
    rows_ = near_duplicates(spark.createDataFrame(texts, "doc_id bigint, text string"), words=1).collect()
    sets = {k: set(text.split()) for k, text in texts}
    linked = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert linked == [(300 + 2 * k, 301 + 2 * k) for k in range(6)]
    assert {row["doc_id"]: row["component_id"] for row in rows_} == {k: k for k in sets} | {b: a for a, b in linked}


def test_a_member_is_one_row_a_star(spark, monkeypatch):
    """Near copies share most of their 32 buckets with their centre; rounds carry them once a star, not once a bucket."""
    base = [f"w{k}" for k in range(200)]
    texts = [(k, " ".join(f"own{k}x{at}" if at % 40 == k % 40 or k % 3 == 0 and at % 9 == 4 else w for at, w in enumerate(base))) for k in range(80)]
    carried, write = [], minhash.materialise

    def counted(df, name, **options):
        written = write(df, name, **options)
        if name == "open-members":
            carried.append(written.count())
        return written

    monkeypatch.setattr(minhash, "materialise", counted)
    rows_ = near_duplicates(spark.createDataFrame(texts, "doc_id bigint, text string"), words=1).collect()
    assert 0 < max(carried) <= 6 * len(texts)
    sets = {k: set(text.split()) for k, text in texts}
    edges = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    label = {k: k for k in sets}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert {row["doc_id"]: row["component_id"] for row in rows_} == label


@pytest.mark.parametrize("few_rows", [0, 1000])
def test_components_in_one_task_and_over_many(spark, monkeypatch, few_rows):
    monkeypatch.setattr("pagetide.llm.minhash.FEW_ROWS", few_rows)
    rng = random.Random(8)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(500 + k, 501 + k) for k in range(30)]
    edges = [(a, b) for a, b in edges if a != b]
    label = {node: node for edge in edges for node in edge}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted((row["node"], row["label"]) for row in found) == sorted(label.items())


def test_shingles_and_sketches():
    shingler = Shingler(2)
    one, other, none, single, spaced = shingler.sets(["a b c a b", "A  B\tc\na b", None, "word", " x\x0by "])
    assert list(one) == list(other) and len(one) == 3 and len(none) == 0 and len(single) == 1 and len(spaced) == 1
    sketcher = Sketcher(8, 4)
    assert (sketcher.sketch(one) == sketcher.sketch(other)).all() and set(sketcher.sketch(one)) <= set(one)


def test_statement_agrees_with_a_plain_count():
    figures = duckdb.sql(ORACLES["op8_quality_rules"].replace("FROM documents", "FROM (SELECT 1 AS doc_id, 'a b c d e f a b c d e' AS text)"))
    assert dict(zip(figures.columns, figures.fetchall()[0]))["n_repeat_words"] == 10
