"""HTML extraction, nearest neighbours, language and toxicity against brute force and held-out rows."""

import html
import math
import random
import re
import time
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import pytest
from odd import clashing, documents, folder
from pyspark.sql import functions as F

from pagetide.llm.ann import ForestSettings, common_prefix, nearest_neighbours
from pagetide.llm.htmltext import DEEPEST, Page, TreeSettings, extract_text, low_branches, parse_pages
from pagetide.llm.langid import identify_languages, reject_below, train_language_model
from pagetide.llm.ngrams import Grams
from pagetide.llm.queries import QUERIES
from pagetide.llm.toxicity import ToxicitySettings, fit, score_toxicity, train_toxicity_model

SMALL, MIDDLE = "/root/testdata/sf0.01", "/root/testdata/sf0.1"
PAGES = "page_id bigint, url string, html string"


def article(source):
    """The paragraphs of these pages' article, by plain patterns."""
    inner = re.search(r"<article>(.*?)(?:</article>|\Z)", source, re.DOTALL)[1]
    parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inner).replace("<br>", " "))
    return "\n".join(part for part in (" ".join(html.unescape(part).split()) for part in parts) if part)


def test_pages_give_their_article(spark):
    source = {row["page_id"]: row for row in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    found = QUERIES["op1_html_extraction"](spark, SMALL).collect()
    assert len(found) == len(source)
    for row in found:
        assert row["text"] == article(source[row["page_id"]]["html"]) and row["url"] == source[row["page_id"]]["url"]
        assert row["n_chars"] == len(row["text"])


def blocks(source):
    return [text for _, _, text in Page(source).main_text()[0]]


def test_parts_that_are_not_the_article():
    source = (
        '<body class="home has-sidebar"><header class=site>Site</header><div id="wrap" class="with-sidebar"><div class="cookie-notice">'
        "We use cookies</div><main><header><h1>Title &amp; more</h1></header><p>One<br>two <i>three</i>four<ul><li>a<li>b</ul>"
        '<p>x &lt; y &nbsp;  z<aside>side</aside><div class="adSlot ad">buy</div><section id="comments"><article class="comment">bad'
        '</article></section><form>name <input></form><script>if (a < b) "</p>";</script></main></div><footer>f</footer>'
    )
    assert blocks(source) == ["Title & more", "One two threefour", "a", "b", "x < y z"]


@pytest.mark.parametrize(
    ("source", "wanted"),
    [
        ('<div id="content" class="has-sidebar"><p>All of it.<div class="sidebar-left">side</div></div>', ["All of it."]),
        ('<div class="post no-comments"><p>All of it.</div>', ["All of it."]),
        ('<article><p>One two three.<div class="related-work">Four.</div><p class="notice-period">Five.</article>', ["One two three.", "Four.", "Five."]),
        ('<div class="legal"><p>The law in full.</div><div class="share">tweet</div>', ["The law in full."]),
        ("<div><p>A long text of the page, in many words.</div><article>Teaser</article>", ["A long text of the page, in many words.", "Teaser"]),
    ],
)
def test_text_under_names_of_parts(source, wanted):
    assert blocks(source) == wanted


@pytest.mark.parametrize(
    ("source", "wanted"),
    [
        ("", []), ("plain text", ["plain text"]), ("a < b <3 &am", ["a < b <3 &am"]), ("<p>cut &amp", ["cut &"]), ("<p>x</", ["x</"]),
        ("<!-- gone --><div>a<!-- b", ["a"]), ("<div hidden>no</div><div>yes</div>", ["yes"]), ("</p></div>x", ["x"]),
        ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]), ('<p title="a > b">c', ["c"]), ("<script>never closed", []),
        ("<div role=navigation>menu</div><p>caf&eacute; &#233;&#xe9;", ["café éé"]),
    ],
)
def test_broken_markup(source, wanted):
    assert blocks(source) == wanted


@pytest.mark.parametrize(
    ("source", "wanted"),
    [
        ('<div title="A hidden gem">Text.</div>', ["Text."]), ('<article aria-label="The hidden costs of war">Text.', ["Text."]),
        ('<div data-id="sidebar"><p>Text.</div><div data-role="banner" data-class=ad>More.</div>', ["Text.", "More."]),
        ("<form action=/ id=f><h1>T</h1><article><p>Text.<button>Go</button><input></article><select><option>1</select></form>", ["Text."]),
        ("<body><form><fieldset><div>A whole page in one form.</div></fieldset></form>", ["A whole page in one form."]),
        ("<p>One <span hidden>two</span><span class=advert>buy <span>now</span></span>three<a role=navigation>menu</a>.", ["One three."]),
        ("<div><p>One <span hidden>two</div><div>three</div>", ["One", "three"]), ("<p>a<span class=ad/>b<i hidden>c<p>d", ["ab", "d"]),
        ('<p>a <em class="my-comment">b</em> <img class=ad> <code class="token comment">c</code>', ["a b c"]),
    ],
)
def test_attributes_by_name_forms_and_inline_parts(source, wanted):
    assert blocks(source) == wanted


@pytest.mark.parametrize("tag", ["div", "blockquote", "p><div", "td", "section"])
def test_deep_pages_take_little_memory_and_time(tag):
    source = f"<{tag}>" * 50_000 + "deep" + "".join(f"<{tag}>x</{tag.split('><')[0]}></q></em></li>" for _ in range(2_000))
    tracemalloc.start()
    began = time.process_time()
    found = Page(source).main_text()[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [text for _, _, text in found] == ["deep"] + ["x"] * 2_000
    assert max(len(path) for path, _, _ in found) <= DEEPEST + 1
    assert peak < 100e6 and time.process_time() - began < 30


def test_importance_is_that_of_a_plain_count(spark):
    rng = random.Random(5)
    found = []
    for k in range(30):
        shape = "<i>" + "".join(f"<{rng.choice(['p', 'ul'])}>{rng.choice(['a', 'b', 'c', str(k)])}" for _ in range(rng.randint(1, 3)))
        found.append((k, "http://one.example/", f"<h1>{k}</h1><div class=x>{shape}</div><div class=y><p>same</p><p>{rng.choice('ab')}</p></div>"))
    found += found[:4]
    texts, styles, shown = defaultdict(lambda: defaultdict(set)), defaultdict(lambda: defaultdict(set)), defaultdict(set)
    for _, _, source in found:
        kept, arranged = Page(source).main_text()
        body = tuple(map(str, kept))
        for path, _, text in kept:
            for branch in path:
                shown[branch].add(body)
                texts[branch][text].add(body)
        for branch, style in arranged:
            styles[branch][style].add(body)
    importance = {}
    for branch, pages in shown.items():
        n = len(pages)
        if n >= 5:
            content = sum(1 - math.log(len(on)) / math.log(n) for on in texts[branch].values()) / len(texts[branch])
            shape = sum(-len(on) / n * math.log(len(on) / n) / math.log(n) for on in styles[branch].values())
            importance[branch] = 0.1 * shape + 0.9 * content
    parsed = parse_pages(spark.createDataFrame(found, PAGES)).withColumn("host", F.lit("one.example"))
    for least in (0.2, 0.5, 0.8):
        low = {row["branch"] for row in low_branches(parsed, TreeSettings(least_importance=least)).collect()}
        assert low == {branch for branch, value in importance.items() if value < least}
    assert len(importance) > 4


def test_style_tree_removes_what_all_pages_of_a_host_share(spark):
    def page(k):
        own = f"<div class=body><p>Paragraph {k} of its own.</p><p>More text {k * 7} that only this page has.</p></div>"
        return f"<body><div class=top>The same words on every page.</div>{own}<div class=low>Brought to you by us.</div></body>"

    found = [(k, "https://one.example/x", page(k)) for k in range(8)] + [(20, "https://two.example/", page(20)), (21, None, page(21))]
    text = {row["page_id"]: row["text"] for row in extract_text(spark.createDataFrame(found, PAGES)).collect()}
    for k in range(8):
        assert text[k] == f"Paragraph {k} of its own.\nMore text {k * 7} that only this page has."
    assert "The same words" in text[20] and "Brought to you" in text[21]
    kept = extract_text(spark.createDataFrame(found, PAGES), TreeSettings(least_pages=100)).collect()
    assert all("The same words" in row["text"] for row in kept)


def test_copies_of_one_page_stay_whole(spark):
    found = [(k, "http://one.example/", "<h1>Title</h1><div class=a><p>All there is.</p></div>") for k in range(9)]
    assert {row["text"] for row in extract_text(spark.createDataFrame(found, PAGES)).collect()} == {"Title\nAll there is."}


def test_thin_pages_lose_what_their_host_shares(spark):
    def page(own):
        return f"<div class=a><p>{own}</div><div class=b><p>{'The same long text on every page of this host. ' * 9}</div>"

    own = [f"Short {k}." if k % 2 else f"Own text number {k}. " * 40 for k in range(8)]
    found = [(k, "http://one.example/", page(own[min(k, 7)])) for k in range(40)]
    text = {row["page_id"]: row["text"] for row in extract_text(spark.createDataFrame(found, PAGES)).collect()}
    assert text == {k: own[min(k, 7)].strip() for k in range(40)}


def test_odd_pages(spark):
    long = "<p>" + "word " * 200_000
    found = [(1, None, None), (2, "not a url", ""), (None, "http://x.example", "<p>a"), (4, "http://x.example", long), (4, "http://x.example", "<p>b")]
    rows = extract_text(clashing(spark.createDataFrame(found, PAGES))).collect()
    assert sorted((row["page_id"] or 0, row["n_chars"]) for row in rows) == [(0, 1), (1, 0), (2, 0), (4, 1), (4, 999_999)]
    assert extract_text(spark.createDataFrame([], PAGES)).count() == 0


def nearest(vectors, asked, k):
    """Brute force: (query, ids) in order."""
    ids = np.array([key for key, _ in vectors])
    matrix = np.array([vector for _, vector in vectors], float)
    found = {}
    for row in np.flatnonzero(np.isin(ids, list(asked))):
        scores = (matrix * matrix[row]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -scores)) if j != row][:k]
        found[int(ids[row])] = [(int(ids[j]), float(scores[j])) for j in order]
    return found


@pytest.mark.parametrize("tables", [SMALL, MIDDLE])
def test_recall(spark, tables):
    vectors = [(row["vec_id"], row["embedding"]) for row in spark.read.parquet(f"{tables}/embeddings.parquet").collect()]
    wanted = nearest(vectors, {key for key, _ in vectors if key % 20 == 0}, 20)
    found = {}
    for row in sorted(QUERIES["op6_hash_prefix_forest"](spark, tables).collect(), key=lambda row: row["rank"]):
        found.setdefault(row["query_id"], []).append((row["vec_id"], row["score"]))
        assert row["rank"] == len(found[row["query_id"]])
    assert found.keys() == wanted.keys()
    hits = [len({key for key, _ in found[q]} & {key for key, _ in wanted[q]}) / 20 for q in wanted]
    assert sum(hits) / len(hits) >= 0.9
    exact = dict(vectors)
    for q, rows in found.items():
        assert all(score == pytest.approx(float(np.dot(np.array(exact[q], float), exact[key])), abs=1e-12) for key, score in rows)
        assert rows == sorted(rows, key=lambda row: (-row[1], row[0]))


def test_small_and_odd_vectors_are_searched_exactly(spark):
    rng = np.random.default_rng(3)
    good = [(k, [float(x) for x in rng.normal(size=5).astype(np.float32)]) for k in range(1, 16)]
    good += [(k, good[0][1]) for k in range(100, 160)] + [(200, [x * 3 for x in good[1][1]])]
    bad = [(20, None), (40, [0.0] * 5), (60, [1.0, None, 1.0, 1.0, 1.0]), (80, [float("nan")] * 5), (300, [float("inf")] * 5), (320, [1.0]), (None, good[0][1]), (340, [])]
    table = spark.createDataFrame(good + bad + [good[3]], "vec_id bigint, embedding array<float>")
    asked = {key for key, _ in good if key % 20 == 0} | {1, 2}
    found = {}
    for row in nearest_neighbours(clashing(table), (F.col("vec_id") % 20 == 0) | F.col("vec_id").isin(1, 2)).orderBy("query_id", "rank").collect():
        found.setdefault(row["query_id"], []).append((row["vec_id"], row["score"]))
    wanted = nearest(good, asked, 20)
    assert {q: [key for key, _ in rows] for q, rows in found.items()} == {q: [key for key, _ in rows] for q, rows in wanted.items()}
    assert nearest_neighbours(table.limit(0), F.lit(True)).count() == 0
    one = spark.createDataFrame([(20, [1.0, 2.0])], "vec_id bigint, embedding array<float>")
    assert nearest_neighbours(one, F.lit(True)).count() == 0


def test_blocks_do_not_change_what_is_found(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    key = lambda row: (row["query_id"], row["rank"])
    whole = sorted(nearest_neighbours(table, F.col("vec_id") % 20 == 0).collect(), key=key)
    cut = sorted(nearest_neighbours(table, F.col("vec_id") % 20 == 0, ForestSettings(block_rows=60)).collect(), key=key)
    same = len({(r["query_id"], r["vec_id"]) for r in whole} & {(r["query_id"], r["vec_id"]) for r in cut})
    assert same >= 0.95 * len(whole)


def test_common_prefix():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 62, 500) * 2 + 1
    b = a ^ (1 << rng.integers(0, 63, 500))
    plain = [63 - int(x ^ y).bit_length() for x, y in zip(a.tolist(), b.tolist())]
    assert common_prefix(a, b).tolist() == plain and common_prefix(a, a).tolist() == [63] * 500


def test_grams_are_whole_and_each_once(monkeypatch):
    text = "Ab c-d éf" * 400
    whole = np.concatenate(list(Grams((1, 3), 20).parts(text)))
    monkeypatch.setattr("pagetide.llm.ngrams.PART", 37)
    cut = np.concatenate(list(Grams((1, 3), 20).parts(text)))
    assert sorted(whole.tolist()) == sorted(cut.tolist())


def test_languages_of_held_out_documents(spark):
    lang = {row["doc_id"]: row["lang"] for row in spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "lang").collect()}
    found = QUERIES["op7_language_id"](spark, MIDDLE).collect()
    assert len(found) == len(lang)
    assert all(row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0) and 0 <= row["score"] <= 1 for row in found)
    held = [row["lang_pred"] == lang[row["doc_id"]] for row in found if row["held_out"]]
    assert sum(held) / len(held) >= 0.99
    accepted = [row["lang_pred"] == lang[row["doc_id"]] for row in found if row["held_out"] and not row["rejected"]]
    assert sum(accepted) / len(accepted) >= 0.99 and len(accepted) >= 0.9 * len(held)


def test_rejection_is_the_least_score_of_the_wanted_precision():
    rng = np.random.default_rng(3)
    for _ in range(200):
        scores = rng.integers(1, 12, rng.integers(0, 30)) / 12
        right = rng.random(len(scores)) < scores
        reaching = [at for at in scores if right[scores >= at].mean() >= 0.9]
        assert reject_below(scores, right, 0.9) == (min(reaching) if reaching else math.inf)


def test_odd_texts_have_a_language(spark):
    docs = documents(spark)
    found = {row["doc_id"]: row for row in identify_languages(docs, train_language_model(docs)).collect()}
    assert {found[k]["lang_pred"] for k in (1, 2, 3)} == {"und"} and found[4]["lang_pred"] != "und"
    assert len(found) == docs.select("doc_id").distinct().count()
    nothing = documents(spark, [(1, "text", None, "s", 1)])
    assert [row["lang_pred"] for row in identify_languages(nothing, train_language_model(nothing)).collect()] == ["und"]
    empty = documents(spark, [])
    assert identify_languages(empty, train_language_model(empty)).count() == 0


def test_toxicity_of_held_out_documents(spark):
    toxic = {row["doc_id"]: row["toxic"] for row in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    found = [row for row in QUERIES["op9_toxicity"](spark, MIDDLE).collect() if row["held_out"] and row["doc_id"] in toxic]
    caught = [row["predicted"] for row in found if toxic[row["doc_id"]]]
    blamed = [row["predicted"] for row in found if not toxic[row["doc_id"]]]
    assert sum(caught) / len(caught) >= 0.7 and sum(blamed) / len(blamed) <= 0.01


def test_rare_toxic_words_of_a_full_sample_have_features(spark):
    """3,000 documents of each label; one toxic document in a hundred has words of its own and none of the common toxic ones."""
    rng = random.Random(1)
    plain = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(400)]

    def text(words):
        return " ".join([*rng.choices(plain, k=7), *words, *rng.choices(plain, k=23)])

    rare, common = ["zyxwvu", "qrstuz"], ["klmnop", "mnoplk", "pponml"]
    texts = [text(rare if k % 100 == 0 else common) for k in range(3000)] + [text([]) for _ in range(3000)]
    model = fit(texts, [1] * 3000 + [0] * 3000, ToxicitySettings())
    new = spark.createDataFrame([(k, text(rare if k % 2 else [])) for k in range(40)], "doc_id bigint, text string")
    found = {row["doc_id"]: row["score"] for row in score_toxicity(new, model).collect()}
    assert all((found[k] >= 0.7) == (k % 2 == 1) for k in found) and len(found) == 40


def test_odd_texts_have_a_score(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(5, 0), (5, 1), (8, 0), (None, 1), (9, None), (10, 0), (77, 1)], "doc_id bigint, toxic int")
    found = score_toxicity(docs, train_toxicity_model(docs, labels)).collect()
    assert len(found) == docs.count() and all(0 <= row["score"] <= 1 for row in found)
    none = train_toxicity_model(docs, labels.limit(0))
    assert none is None and {row["score"] for row in score_toxicity(docs, none).collect()} == {0.0}
    assert score_toxicity(documents(spark, []), none).count() == 0
