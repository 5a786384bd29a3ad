import pytest
from pyspark.sql import functions as F

from pagetide import functions as fn

NBSP = " "


def values(spark, inputs, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, c {kind}")
    return [row[0] for row in df.orderBy("i").select(expression(F.col("c"))).collect()]


def test_clean_text(spark):
    inputs = [None, "", "  ", " a  b\t\n c ", f"a{NBSP}{NBSP}b", "\x1ca\x1fb\x1d", f"{NBSP}　", "plain"]
    assert values(spark, inputs, fn.clean_text) == [None, None, None, "a b c", "a b", "a b", None, "plain"]


def test_clean_review_text(spark):
    inputs = [None, "", " \r\n ", "a\r\nb\rc\n", f"{NBSP}\ta  b {NBSP}", "\x1cx\x1f", "a" + " " * 5000 + "b  ", "\x0ba\x0c"]
    expected = [None, "", "", "a\nb\nc", "a  b", "x", "a" + " " * 5000 + "b", "a"]
    assert values(spark, inputs, fn.clean_review_text) == expected


def test_white_space_is_that_of_python(spark):
    spaces = [chr(i) for i in range(1, 0x3100) if chr(i).isspace()]
    others = ["\u200b", "\ufeff", "\x00", "\x1b"]
    inputs = [f"{c}x{c}{c}y{c}" for c in spaces + others]
    assert values(spark, inputs, fn.clean_review_text) == [
        t.replace("\r\n", "\n").replace("\r", "\n").strip() for t in inputs
    ]
    assert values(spark, inputs, fn.clean_text) == [" ".join(t.split()) for t in inputs]


def test_timestamp_iso_in_any_time_zone(spark):
    inputs = [None, 0, -1, 1_600_000_000, 253_402_300_799, 253_402_300_800, -62_135_596_800, -62_135_596_801, 2**62]
    expected = [
        None, "1970-01-01T00:00:00+00:00", "1969-12-31T23:59:59+00:00", "2020-09-13T12:26:40+00:00",
        "9999-12-31T23:59:59+00:00", None, "0001-01-01T00:00:00+00:00", None, None,
    ]
    for zone in ("UTC", "America/Los_Angeles"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert values(spark, inputs, fn.timestamp_iso, "long") == expected
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_lenient_casts(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        inputs = [None, "", " 5 ", "0.75", "abc", "4294967295", "-3", "1.0d", "1e3", "nan", "99999999999999999999"]
        assert values(spark, inputs, fn.int_or_none) == [None, None, 5, None, None, 4294967295, -3, None, None, None, None]
        assert values(spark, inputs, fn.int_or_zero) == [0, 0, 5, 0, 0, 4294967295, -3, 0, 0, 0, 0]
        floats = values(spark, inputs, fn.float_or_none)
        assert floats[:9] == [None, None, 5.0, 0.75, None, 4294967295.0, -3.0, None, 1000.0]
        assert floats[9] != floats[9]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_truthy_and_parse_bool(spark):
    assert values(spark, [None, "", "true", "false", "1", "0", "yes"], fn.truthy) == [
        False, False, True, False, True, False, True
    ]
    words = [None, " ", " TRUE ", "y", "Active", "1", "0", "No", "inactive", "maybe"]
    assert values(spark, words, fn.parse_bool) == [True, True, True, True, True, True, False, False, False, None]


def test_mask_url(spark):
    inputs = [
        "postgresql:///reviews", "postgresql://me:secret@host:5432/db", "postgresql://me@host:5432/db",
        "https://u:p@ss:w@host/x", "no scheme @ here", None,
    ]
    assert values(spark, inputs, fn.mask_url) == [
        "postgresql:///reviews", "postgresql://me:***@host:5432/db", "postgresql://***@host:5432/db",
        "https://u:***@host/x", "no scheme @ here", None,
    ]


def test_page_key_never_cuts_numbers(spark):
    keys = values(spark, [1, 999, 1000, 12345, None], lambda c: fn.page_key(F.lit("r"), F.lit("7"), c), "int")
    assert keys == ["r:7:0001", "r:7:0999", "r:7:1000", "r:7:12345", "r:7:0000"]


def test_request_url_encodes_the_cursor(spark):
    urls = values(spark, ["AoIIPw==", "*", "a b~c/+"], lambda c: fn.request_url("https://x.example/list/", F.lit("730"), c))
    head = "https://x.example/list/730?json=1&filter=updated&language=english&purchase_type=all&review_type=all&num_per_page=100&cursor="
    assert urls == [head + "AoIIPw%3D%3D", head + "%2A", head + "a+b~c%2F%2B"]


def test_response_bytes(spark):
    assert values(spark, [None, "", "aé"], fn.response_bytes) == [0, 0, 3]


def reason(spark, status, count, next_cursor, cursor, page, cap=0, reached=False):
    columns = [F.lit(status), F.lit(count), F.lit(next_cursor), F.lit(cursor), F.lit(page)]
    return spark.range(1).select(fn.terminal_reason(*columns, cap, F.lit(reached))).first()[0]


def test_terminal_reason_rules_in_order(spark):
    assert reason(spark, "fetch_error", 0, None, "*", 1, 1) == "fetch_error"
    assert reason(spark, "fetched", 0, None, "*", 1, 1) == "empty_page"
    assert reason(spark, "fetched", 5, "", "*", 1, 1) == "page_cap_reached"
    assert reason(spark, "fetched", 5, "", "*", 1) == "missing_next_cursor"
    assert reason(spark, "fetched", 5, None, "*", 1) == "missing_next_cursor"
    assert reason(spark, "fetched", 5, "*", "*", 1) == "cursor_not_advancing"
    assert reason(spark, "fetched", 5, "b", "a", 1) is None
    assert reason(spark, "fetched", 5, "", "*", 1, 1, True) == "caught_up_to_existing_reviews"
    assert reason(spark, "fetch_error", 5, "b", "a", 1, 0, True) == "fetch_error"


def test_page_status_and_retry(spark):
    df = spark.createDataFrame(
        [("1", 200, 3), ("1", 200, 0), ("true", 200, 1), ("0", 200, 2), (None, 200, 2), ("x", 200, 1), ("1", 429, 1), (None, None, 0)],
        "success string, code int, reviews int",
    )
    status = fn.raw_status(F.col("success"), F.col("code"))
    out = df.select(fn.page_status(status, F.col("reviews")), fn.retryable(F.col("code"))).collect()
    assert [row[0] for row in out] == ["fetched", "empty", "fetched"] + ["fetch_error"] * 5
    assert [row[1] for row in out] == [False] * 6 + [True, False]


def test_review_bounds_pass_over_unreadable_values(spark):
    df = spark.createDataFrame(
        [([("5",), ("soon",), (None,), ("12",)],), ([("x",)],), ([],), (None,)], "reviews array<struct<timestamp_updated:string>>"
    )
    newest, oldest = fn.review_bounds(F.col("reviews"))
    assert [tuple(row) for row in df.select(newest, oldest).collect()] == [(12, 5), (None, None), (None, None), (None, None)]
