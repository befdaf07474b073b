"""Streams over many batches: same results as one pass, and batches that do not read the history."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shelfwise.streaming import ingest, reviews

EVENTS = "appid long, ts timestamp, up boolean, minutes long"


def _files(spark, tmp_path, parts, schema):
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/part{i:03d}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")


def test_first_rows_of_keys_over_batches(spark, tmp_path):
    rng = random.Random(1)
    parts = [[(rng.randint(0, 60), rng.randint(0, 9), i * 1000 + j) for j in range(40)] for i in range(5)]
    parts[2].append((None, 1, -1))
    stream = _files(spark, tmp_path, parts, "k long, o long, v long")
    query = ingest.ingest_new(stream, f"{tmp_path}/out", f"{tmp_path}/check", "k", ["o", "v"])
    query.awaitTermination()
    want = {}
    for rows in parts:
        best = {}
        for k, o, v in rows:
            best[k] = min(best.get(k, (o, v)), (o, v))
        for k, x in best.items():
            want.setdefault(k, x)
    got = ingest.read_ingested(spark, f"{tmp_path}/out", stream.schema).collect()
    assert len(got) == len(want) and {r.k: (r.o, r.v) for r in got} == want
    progress = [p for p in query.recentProgress if p["numInputRows"]]
    assert len(progress) == 5
    # A batch updates the keys it holds; stored rows are no input of it.
    for p, rows in zip(progress, parts):
        assert p["numInputRows"] == len(rows) and p["stateOperators"][0]["numRowsUpdated"] == len({r[0] for r in rows})
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "").find("RocksDB") < 0
    # More files later: the state goes on from the checkpoint.
    spark.createDataFrame([(7, 0, 1), (999, 0, 1)], "k long, o long, v long").write.parquet(f"{tmp_path}/in/part100")
    ingest.ingest_new(stream, f"{tmp_path}/out", f"{tmp_path}/check", "k", ["o", "v"]).awaitTermination()
    assert ingest.read_ingested(spark, f"{tmp_path}/out", stream.schema).count() == len(want) + (7 not in want) + 1


def test_panel_over_batches_keeps_only_open_days(spark, tmp_path):
    start, rng = dt.datetime(2024, 1, 1), random.Random(3)
    parts = []
    for b in range(8):
        rows = [(rng.randint(1, 3), start + dt.timedelta(days=10 * b + rng.randint(0, 9), hours=rng.randint(0, 23)), rng.random() < 0.5, rng.randint(0, 900))
                for _ in range(30)]
        late = [(1, start + dt.timedelta(days=10 * b - 4), True, 60)] if b else []  # within the lateness
        parts.append(rows + late)
    parts[-1].append((1, start, True, 10 ** 6))  # far too late, left out
    stream = _files(spark, tmp_path, parts, EVENTS)
    days = reviews.day_totals(stream, "appid", F.col("ts"), "15 days", F.col("up"), F.lit(False), F.lit(False), F.col("minutes"))
    folder = f"{tmp_path}/panel"
    reviews.write_day_totals(days, folder, f"{tmp_path}/check", "appid", "15 days").awaitTermination()
    got = {(r.appid, r.month): (r.review_count, r.positive_count) for r in reviews.read_month_panel(spark, folder, "appid", days.schema).collect()}
    want = {}
    for rows in parts:
        for a, t, up, m in rows:
            if m < 10 ** 6:
                n, p = want.get((a, f"{t:%Y-%m}"), (0, 0))
                want[a, f"{t:%Y-%m}"] = (n + 1, p + up)
    assert got == want
    kept = reviews.batches(spark, f"{folder}/open")
    assert len(kept) == 2  # the last one, and the one before it
    sizes = spark.read.parquet(f"{folder}/open/batch={kept[-1]}")
    assert sizes.agg(F.countDistinct("day")).first()[0] <= 26  # open days, not eighty
    assert spark.read.parquet(f"{folder}/closed").count() > 0


def test_panel_of_a_repeated_batch(spark, tmp_path):
    """A batch that is stored twice gives what it gave once."""
    rows = [(1, dt.datetime(2024, 1, d), True, 60) for d in range(1, 29)]
    stream = _files(spark, tmp_path, [rows[:14], rows[14:]], EVENTS)
    days = reviews.day_totals(stream, "appid", F.col("ts"), "3 days", F.col("up"), F.lit(False), F.lit(False), F.col("minutes"))
    for n in ("a", "b"):
        # The second run starts over with a new checkpoint, in the same folder.
        reviews.write_day_totals(days, f"{tmp_path}/panel", f"{tmp_path}/check{n}", "appid", "3 days").awaitTermination()
        got = reviews.read_month_panel(spark, f"{tmp_path}/panel", "appid", days.schema).collect()
        assert [(r.appid, r.month, r.review_count, r.avg_playtime_at_review_hrs) for r in got] == [(1, "2024-01", 28, 1.0)]
