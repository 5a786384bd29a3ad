"""How often page documents, which are nearly all bytes of a load, are parsed and written."""

import json

from pyspark.sql import functions as F

from fixtures import payload, review
from pagetide.operators.normalize import conform
from pagetide.plans.load import incoming_reviews
from pagetide.plans.store import Store
from pagetide.schemas import PAGE_REPORT
from pagetide.session import scratch
from pagetide.sinks.files import sanitize_documents
from pagetide.sources.landing import LANDED
from pagetide.streaming.chains import CARRIED, take_pages


def landed(spark, path, *documents):
    rows = [("r1", "10", n, 200, text) for n, text in enumerate(documents, 1)]
    name = F.concat(F.lit("p"), "page_number")
    df = spark.createDataFrame(rows, "run_id string, app_id string, page_number int, status_code int, document string")
    conform(df.withColumn("file_name", name).withColumn("raw_json_path", name), LANDED).write.parquet(path)
    return spark.read.schema(LANDED).parquet(path)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_document_is_parsed_once_to_be_sanitized(spark, tmp_path):
    pages = landed(spark, str(tmp_path / "landed"), json.dumps(payload([review()], cursor="a")))
    # Spark writes a parsed document as parse_json or as the static call that replaces it.
    text = plan(sanitize_documents(pages)).lower().replace("_", "")
    assert text.count("parsejson(") == 1


def test_only_documents_of_loadable_reports_are_parsed(spark, tmp_path):
    files = landed(spark, str(tmp_path / "landed"), json.dumps(payload([review("1"), review("2")], cursor="a")), "torn {")
    files.filter("page_number = 1").withColumn("status", F.when(F.col("page_number") == 1, "fetched")).write.parquet(str(tmp_path / "reports"))
    reports = conform(spark.read.parquet(str(tmp_path / "reports")), PAGE_REPORT)
    rows = incoming_reviews(reports, files, ["run_id", "page_number"])
    lines = plan(rows).splitlines()
    join = next(n for n, line in enumerate(lines) if "Join" in line)
    assert not [line for line in lines[join:] if "from_json" in line]
    assert [tuple(row) for row in rows.select("recommendationid", "pos").orderBy("pos").collect()] == [("1", 0), ("2", 1)]


def test_landed_documents_are_not_copied_to_be_taken(spark, tmp_path):
    files = landed(spark, str(tmp_path / "landed"), *(json.dumps(payload([review(str(n))], cursor=f"c{n}")) for n in range(3)))
    store = Store(spark, str(tmp_path / "store"))
    with scratch(spark):
        taken = take_pages(files, store.read_all(CARRIED), "https://x.example")
        assert set(files.inputFiles()) <= set(taken.documents.inputFiles())
        assert taken.reports.count() == taken.documents.count() == 3
