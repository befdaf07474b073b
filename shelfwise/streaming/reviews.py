"""ST1: the monthly panel over arriving reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from shelfwise.functions.rounding import round_to
from shelfwise.operators.groups import top_k_per_key
from shelfwise.session import discard, path_kind


def day_totals(stream: DataFrame, key: str, ts: Column, lateness: str, voted_up: Column, purchased: Column,
               early: Column, minutes: Column, start: str | None = None) -> DataFrame:
    """Totals per item and day; the state of a day is dropped once it is later than the watermark."""
    rows = stream.select(
        F.col(key), ts.cast("timestamp").alias("ts"), voted_up.alias("v"), purchased.alias("p"), early.alias("a"),
        minutes.alias("m"))
    if start:
        rows = rows.where(F.col("ts") >= F.lit(start).cast("timestamp"))
    return (
        rows.withWatermark("ts", lateness).groupBy(key, F.window("ts", "1 day").alias("w")).agg(
            F.count(F.lit(1)).alias("review_count"), F.count_if("v").alias("positive_count"),
            F.count_if(~F.col("v")).alias("negative_count"), F.count_if("p").alias("steam_purchase_count"),
            F.count_if("a").alias("early_access_count"), F.sum("m").alias("minutes"))
        .select(key, F.col("w.start").alias("day"), "review_count", "positive_count", "negative_count",
                "steam_purchase_count", "early_access_count", "minutes")
    )


COUNTS = ("review_count", "positive_count", "negative_count", "steam_purchase_count", "early_access_count")


def write_day_totals(days: DataFrame, folder: str, checkpoint: str, key: str | None = None, lateness: str | None = None,
                     trigger: dict | None = None) -> StreamingQuery:
    """Keeps the last version of the open days, and the months' sums of the days that closed.

    A day is closed once its end lies ``lateness`` before the latest day seen: by then the stream drops its late rows. Batch n
    reads the open days of batch n - 1 and writes its own open days and the sums of those that close with it, each under its
    number. So a batch works on the open days alone, however long the stream has run, and one that is run again after a failure
    writes the same again. Open days of earlier batches are deleted. ``key`` is the first column if not given; without
    ``lateness``, which is that of the stream, no day closes.
    """
    schema, key = days.schema, key or days.columns[0]

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = spark.read.schema(schema).parquet(f"{folder}/open/batch={batch_id - 1}") if batch_id else batch.limit(0)
        versions = batch.withColumn("_new", F.lit(1)).unionByName(before.withColumn("_new", F.lit(0)))
        merged, path = _stored(top_k_per_key(versions, [key, "day"], [F.desc("_new")], 1).drop("_new"), f"{folder}/merged/batch={batch_id}")
        closed = F.lit(False)
        if lateness:
            end = merged.agg(F.max("day")).scalar() - F.expr(f"INTERVAL {lateness}")
            closed = F.coalesce(F.col("day") + F.expr("INTERVAL 1 day") <= end, F.lit(False))
        merged.where(~closed).write.mode("overwrite").parquet(f"{folder}/open/batch={batch_id}")
        _months(merged.where(closed), key).write.mode("overwrite").parquet(f"{folder}/closed/batch={batch_id}")
        discard(spark, path)
        discard(spark, f"{folder}/open/batch={batch_id - 2}")

    return (
        days.writeStream.outputMode("update").foreachBatch(store)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    )


def _stored(df: DataFrame, path: str) -> tuple[DataFrame, str]:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _months(days: DataFrame, key: str) -> DataFrame:
    return days.groupBy(key, F.date_format("day", "yyyy-MM").alias("month")).agg(*[F.sum(c).alias(c) for c in (*COUNTS, "minutes")])


def read_month_panel(spark: SparkSession, folder: str, key: str, schema: T.StructType | None = None) -> DataFrame:
    """Closed and open days rolled up to months.

    With the ``schema`` of the day totals a stream that has had no rows gives none; without it that is an error.
    """
    last = batches(spark, f"{folder}/open")
    if not last:
        if schema is None:
            raise FileNotFoundError(f"no day totals in {folder}")
        days, closed = spark.createDataFrame([], schema), None
    else:
        path = f"{folder}/open/batch={max(last)}"
        days = spark.read.schema(schema).parquet(path) if schema is not None else spark.read.parquet(path)
        closed = spark.read.schema(_months(days, key).schema).parquet(f"{folder}/closed/batch=*")
    sums = _months(days, key)
    if closed is not None:
        sums = sums.unionByName(closed)
    return sums.groupBy(key, "month").agg(
        *[F.sum(c).alias(c) for c in COUNTS], round_to(F.sum("minutes") / F.sum("review_count") / 60, 2).alias("avg_playtime_at_review_hrs"))


def batches(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the batches that a folder holds."""
    if path_kind(spark, folder) == "none":
        return []
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)
    return sorted(int(s.getPath().getName().split("=")[1]) for s in found)
