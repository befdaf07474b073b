"""Queries ST1 and ST2: file streams over the event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.plans import catalogue as C
from shelfwise.plans.registry import query
from shelfwise.session import path_kind, scratch_dir
from shelfwise.streaming import ingest, reviews


def _stream(spark, sf, name):
    """The stream of a table that is one file or a folder of parts."""
    source = spark.readStream.schema(C.table(spark, sf, name).schema)
    path = f"{sf}/{name}.parquet"
    if path_kind(spark, path) == "folder":
        return source.parquet(path)
    return source.option("pathGlobFilter", f"{name}.parquet").parquet(sf)


@query("st1_review_stream", """SELECT user_id AS appid, strftime(ts, '%Y-%m') AS month, count(*) AS review_count,
  count(*) FILTER (WHERE event_type IN ('click', 'view', 'purchase')) AS positive_count,
  count(*) FILTER (WHERE event_type NOT IN ('click', 'view', 'purchase')) AS negative_count,
  count(*) FILTER (WHERE event_type = 'purchase') AS steam_purchase_count,
  count(*) FILTER (WHERE event_type = 'signup') AS early_access_count,
  round_even(CAST(sum(CAST(floor(value) AS BIGINT)) AS DOUBLE) / count(*) / 60, 2) AS avg_playtime_at_review_hrs
  FROM events WHERE ts >= TIMESTAMP '2024-01-04' GROUP BY 1, 2""")
def st1(spark, sf):
    kind = F.col("event_type")
    events = _stream(spark, sf, "events").withColumn("appid", F.col("user_id"))
    days = reviews.day_totals(
        events, "appid", F.col("ts"), "31 days", kind.isin("click", "view", "purchase"), kind == "purchase", kind == "signup",
        F.floor("value").cast("bigint"), start="2024-01-04 00:00:00")
    folder = scratch_dir(spark, "panel")
    reviews.write_day_totals(days, folder, scratch_dir(spark, "stream"), "appid", "31 days").awaitTermination()
    return reviews.read_month_panel(spark, folder, "appid", days.schema)


@query("st2_incremental_ingest", """SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT *, row_number() OVER (
  PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS r FROM lineitem) WHERE r = 1""")
def st2(spark, sf):
    lines = _stream(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    folder = scratch_dir(spark, "ingest")
    ingest.ingest_new(lines, folder, scratch_dir(spark, "stream"), "l_orderkey",
                      ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]).awaitTermination()
    return ingest.read_ingested(spark, folder, lines.schema).select("l_orderkey", "l_linenumber", "l_partkey")
