"""Every registered query against its DuckDB statement on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as driver
from pagetide.operators import normalize
from pagetide.plans.oracles import ORACLES
from pagetide.plans.queries import QUERIES
from pagetide.plans.standins import Standins
from compare import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    assert compare(spark, connection, FOLDER, QUERIES[name], ORACLES[name]) is None


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_times_of_large_order_keys(spark, tmp_path):
    """The keys of large tables give years of five digits; sf0.1 at 60 times its size ends at 9,000,000."""
    keys = [1, 1999, 2000, 2_054_540, 2_054_541, 2_054_542, 2_100_000, 9_000_000, 54_000_000]
    rows = [(key, line) for key in keys for line in range(1, 8)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int").write.parquet(str(tmp_path / "lineitem.parquet"))
    large = duckdb.connect()
    large.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{tmp_path}/lineitem.parquet/*.parquet')")
    assert compare(spark, large, str(tmp_path), QUERIES["timestamp_iso"], ORACLES["timestamp_iso"]) is None


@pytest.fixture
def large_keys(spark, tmp_path):
    """Documents of pages around the 10,000th, and updated around the end of year 9999."""
    keys = [0, 199, 1_999_799, 1_999_800, 1_999_801, 2_000_001, 10_000_001, 10_000_201, 6_805_467_589, 6_805_467_590, 10_000_000_001]
    rows = [(key, f"text {key}", "en", "src1", 9) for key in keys]
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, columns).write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


@pytest.mark.parametrize("name", ["normalize_reviews", "raw_path_join"])
def test_landed_documents_of_large_keys(spark, large_keys, name):
    large = duckdb.connect()
    large.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{large_keys}/documents.parquet/*.parquet')")
    assert compare(spark, large, large_keys, QUERIES[name], ORACLES[name]) is None


def test_rows_of_large_keys_are_stored_whole(spark, large_keys):
    """What a load stores names the whole page number, and no year beyond 9999, whatever the statements do."""
    exploded = normalize.explode_reviews(normalize.parse_payload(Standins(spark, large_keys).payload_pages()))
    rows = {r["recommendationid"]: r for r in normalize.normalize_reviews(exploded).collect()}
    assert rows["1999799"]["source_page_key"].endswith(":src1:9999")
    assert rows["10000201"]["source_page_key"].endswith(":src1:50002")
    assert rows["6805467589"]["updated_at_iso"].startswith("9999-12-31T23:59")
    assert rows["6805467590"]["timestamp_updated"] > 0 and rows["6805467590"]["updated_at_iso"] is None
