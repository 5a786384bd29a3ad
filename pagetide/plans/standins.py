"""The engine's tables as views over the driver's tables, so that every operator runs on data that grows with them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetide.functions import page_key, timestamp_iso
from pagetide.operators.normalize import conform
from pagetide.schemas import DEFAULTS, PAGES, REVIEWS

SOURCES = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "labels": "doc_id bigint, quality int, toxic int",
    "lineitem": "l_orderkey bigint, l_linenumber int",
    "pages": "page_id bigint, url string, html string",
}

# A review row with the position that orders the versions.
REVIEWS_IN_ORDER = T.StructType([*REVIEWS.fields, T.StructField("event_id", T.LongType())])

_SECOND_ZERO = "timestamp_ntz'1970-01-01 00:00:00'"


def day(ts: str) -> Column:
    return F.replace(F.col(ts).cast("date").cast("string"), F.lit("-"), F.lit(""))


def text(column: str) -> Column:
    return F.col(column).cast("string")


@dataclass
class Standins:
    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        """A driver table under its known schema, which saves the job that would read it from a file footer."""
        return self.spark.read.schema(SOURCES[name]).parquet(f"{self.folder}/{name}.parquet")

    def reviews(self) -> DataFrame:
        """Documents as reviews: some without language, text or time; quality labels as votes."""
        joined = self.table("documents").join(self.table("labels").select("doc_id", "quality"), "doc_id", "left")
        stamp = F.when(F.col("doc_id") % 11 != 0, 1_600_000_000 + (F.col("doc_id") * 7919) % 1_000_000)
        rows = joined.select(
            text("doc_id").alias("recommendationid"),
            F.concat(F.lit("run-"), (F.col("doc_id") % 7).cast("string")).alias("run_id"),
            F.col("source").alias("app_id"),
            F.when(F.col("lang") != "es", F.col("lang")).alias("language"),
            F.when(F.col("doc_id") % 50 == 0, F.lit("")).otherwise(F.col("text")).alias("review"),
            (F.coalesce("quality", F.lit(0)) == 1).alias("voted_up"),
            stamp.alias("timestamp_updated"),
            timestamp_iso(stamp).alias("updated_at_iso"),
            F.col("n_chars").alias("votes_up"),
            (F.col("n_chars") % 5).alias("votes_funny"),
        )
        return conform(rows, REVIEWS, DEFAULTS["reviews"])

    def apps(self) -> DataFrame:
        """Every source but one, which leaves reviews without an app."""
        sources = self.table("documents").select("source").distinct().filter("source <> 'src7'")
        return sources.select(
            F.col("source").alias("app_id"), F.upper("source").alias("app_name"), F.lit(True).alias("active"),
            F.lit(None).cast("string").alias("notes"), F.lit("run-0").alias("first_seen_run_id"),
            F.lit("run-6").alias("last_seen_run_id"),
        )

    def targets(self) -> DataFrame:
        """Customers as a target list, with blank and non-numeric ids and unknown flags."""
        flags = {"BUILDING": "true", "MACHINERY": "0", "AUTOMOBILE": " Yes ", "FURNITURE": "inactive"}
        flag = F.when(F.col("c_nationkey") == 13, F.lit("maybe"))
        for segment, word in flags.items():
            flag = flag.when(F.col("c_mktsegment") == segment, F.lit(word))
        number = text("c_custkey")
        return self.table("customer").select(
            F.when(F.col("c_custkey") % 29 == 0, F.lit("  "))
            .when(F.col("c_custkey") % 31 == 0, F.concat(F.lit("id-"), number))
            .otherwise(F.concat(F.lit(" "), number, F.lit(" "))).alias("app_id"),
            F.col("c_name").alias("app_name"),
            flag.alias("active"),
            F.when(F.col("c_nationkey") % 5 != 0, F.concat(F.lit("nation  "), text("c_nationkey"))).alias("notes"),
            (F.col("c_custkey") + 2).alias("row_number"),
        )

    def _events(self) -> DataFrame:
        return self.table("events").withColumns({
            "k": F.get_json_object("props", "$.k").cast("bigint"),
            "run_id": day("ts"),
            "app_id": text("user_id"),
            "page_number": (F.hour("ts") * 60 + F.minute("ts") + 1).cast("int"),
        })

    def page_reports(self) -> DataFrame:
        """Events as page reports. `event_id` is their load order; a page number may repeat within an app's run."""
        events = self._events().withColumn("epoch", F.expr(f"timestampdiff(SECOND, {_SECOND_ZERO}, ts)"))
        kind, k = F.col("event_type"), F.col("k")
        fetched = ~kind.isin("error", "signup")
        file_name = F.format_string("app_%s_page_%04d.json", "app_id", "page_number")
        return events.select(
            "event_id", "event_type", "k", "run_id", "app_id",
            F.when(kind != "click", F.concat(F.lit("App "), F.col("app_id"))).alias("app_name"),
            "page_number",
            F.lit(None).cast("string").alias("request_url"),
            F.lit(None).cast("string").alias("cursor"),
            F.when(k % 13 != 0, F.concat(F.lit("c"), (k % 4).cast("string"))).alias("next_cursor"),
            F.when(kind == "error", "fetch_error").when(kind == "signup", "empty").otherwise("fetched").alias("status"),
            F.when(kind != "error", 200).when(k % 10 == 9, 429).otherwise(500).alias("status_code"),
            timestamp_iso(F.col("epoch")).alias("fetched_at"),
            F.when(kind != "error", F.concat(F.lit("/landed/"), F.col("run_id"), F.lit("/"), file_name)).alias("raw_json_path"),
            (k * 100).alias("response_bytes"),
            F.when(fetched, k).otherwise(F.lit(0)).alias("review_count"),
            (k + 4_294_967_296).alias("total_reviews"),
            F.lit(None).cast("bigint").alias("total_positive"),
            F.lit(None).cast("bigint").alias("total_negative"),
            F.when(fetched, F.col("epoch")).alias("max_timestamp_updated"),
            F.when(fetched, F.col("epoch") - k).alias("min_timestamp_updated"),
            (1 + k % 3).cast("int").alias("attempt_count"),
            F.when(kind == "error", F.lit("  failed \t again ")).alias("error_message"),
            F.when(kind == "error", "fetch_error").when(kind == "signup", "empty_page")
            .when(kind == "purchase", "caught_up_to_existing_reviews").when(kind == "view", "page_cap_reached")
            .alias("terminal_reason"),
        )

    def pages(self) -> DataFrame:
        keyed = self.page_reports().withColumn(
            "page_key", page_key(F.col("run_id"), F.col("app_id"), F.col("page_number"))
        )
        return keyed.select("event_id", "event_type", "k", *PAGES.names)

    def measured_pages(self) -> DataFrame:
        """Pages as they are before classification: no end reason, and `raw_status` instead of a final status."""
        status = F.when(F.col("event_type") == "error", F.lit("fetch_error")).otherwise(F.lit("fetched"))
        return self.page_reports().select(
            "event_id", "run_id", "app_id", "page_number", status.alias("raw_status"), "status_code", "next_cursor",
            "review_count", "max_timestamp_updated",
        )

    def versions(self, hot_share: bool = False) -> DataFrame:
        """Events as successive versions of reviews; with `hot_share`, one review holds a third of them."""
        k = F.col("k")
        key = F.when(k != 99, (F.col("user_id") * 10 + k % 10).cast("string"))
        if hot_share:
            key = F.when(F.col("event_id") % 3 == 0, F.lit("hot")).otherwise(key)
        rows = self._events().select(
            key.alias("recommendationid"), "run_id", "app_id",
            F.when(k % 17 == 0, F.lit(None)).when(k % 19 == 0, F.lit("")).otherwise(F.col("event_type")).alias("review"),
            F.when(k % 23 != 0, F.floor("value")).cast("bigint").alias("timestamp_updated"),
            page_key(F.col("run_id"), F.col("app_id"), F.col("page_number")).alias("source_page_key"),
            "event_id",
        )
        return conform(rows, REVIEWS_IN_ORDER, DEFAULTS["reviews"])

    def state(self) -> DataFrame:
        """All customers as apps with a stored state."""
        custkey, sound = F.col("c_custkey"), F.col("c_acctbal") >= 0
        return self.table("customer").select(
            custkey.cast("string").alias("app_id"),
            F.when(F.col("c_nationkey") % 5 != 0, 1_704_000_000 + custkey * 1000).alias("complete_through_timestamp_updated"),
            (~sound).alias("backlogged"),
            F.lit("20231231").alias("last_run_id"),
            F.when(sound, F.lit("20231231")).alias("last_successful_run_id"),
            F.when(sound, F.lit("empty_page")).otherwise(F.lit("fetch_error")).alias("last_terminal_reason"),
            custkey.alias("last_seen_max_timestamp_updated"),
            F.col("c_nationkey").cast("bigint").alias("last_page_count"),
            F.lit(None).cast("bigint").alias("last_review_count"),
        )

    def payload_pages(self) -> DataFrame:
        """Documents packed into raw page documents with personal author fields and a field that the contract does not name. A page covers 200 document ids at most."""
        doc = F.col("doc_id")
        as_text = doc.cast("string")
        review = F.struct(
            doc.alias("order"),
            F.concat(F.lit(" "), as_text).alias("recommendationid"),
            F.struct(
                F.concat(F.lit("person-"), as_text).alias("account"),
                F.lit("someone").alias("personaname"),
                (doc * 3).alias("playtime_forever"),
                F.when(doc % 4 != 0, doc % 60).alias("playtime_last_two_weeks"),
                (doc * 2).alias("playtime_at_review"),
                (1_700_000_000 + doc).alias("last_played"),
            ).alias("author"),
            F.col("lang").alias("language"),
            F.concat(F.lit("\t "), F.col("text"), F.lit(" \r\nend\r\n ")).alias("review"),
            (1_500_000_000 + doc).alias("timestamp_created"),
            F.when(doc % 11 != 0, (1_600_000_000 + doc * 37).cast("string")).otherwise(F.lit("soon")).alias("timestamp_updated"),
            (doc % 2 == 0).alias("voted_up"),
            F.col("n_chars").alias("votes_up"),
            F.lit("x").alias("votes_funny"),
            F.concat(F.lit("0."), as_text).alias("weighted_vote_score"),
            (doc % 3 == 0).alias("steam_purchase"),
            F.concat(F.lit("reply to "), as_text).alias("developer_response"),
        )
        number = (F.floor(doc / 200) + 1).cast("int")
        grouped = self.table("documents").groupBy(
            F.concat(F.lit("run-"), (doc % 7).cast("string")).alias("run_id"),
            F.col("source").alias("app_id"),
            number.alias("page_number"),
        ).agg(F.array_sort(F.collect_list(review)).alias("reviews"))
        payload = F.struct(
            F.when(F.col("page_number") % 4 == 3, 0).otherwise(1).alias("success"),
            F.concat(F.lit("c"), text("page_number")).alias("cursor"),
            F.struct(F.size("reviews").alias("num_reviews"), F.lit(4_294_967_295).alias("total_reviews")).alias("query_summary"),
            F.transform("reviews", lambda r: r.dropFields("order")).alias("reviews"),
        )
        return grouped.select(
            "run_id", "app_id", "page_number",
            F.format_string("app_%s_page_%04d.json", "app_id", "page_number").alias("file_name"),
            F.lit("2026-06-15T00:00:00+00:00").alias("fetched_at"),
            F.when(F.col("page_number") % 10 == 9, 429).otherwise(200).alias("status_code"),
            F.to_json(payload).alias("document"),
        )

