"""Cases beyond the usual parameters: many neighbours, low limits, tables in parts, empty streams, absent classes."""

import types

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from shelfwise import vocab
from shelfwise.functions import parsing as P
from shelfwise.operators import aggregates as A, filters as R, joins as J, metrics as E, neighbours as N, profile as PR
from shelfwise.session import path_kind, scratch_dir

SQL = entry.oracle_sql()


def test_more_neighbours_than_a_fixed_index_has(spark):
    v = spark.range(60).select("id", F.array(F.cos(F.col("id") / 60), F.sin(F.col("id") / 60)).alias("v"))
    got = N.nearest(v, v.where("id = 0"), "id", "v", 20, skip_self=True).collect()
    assert [r.item_id for r in sorted(got, key=lambda r: r["rank"])] == list(range(1, 21))


@pytest.mark.parametrize("mode", ["master", "stage1"])
def test_near_constant_below_one_half(spark, mode):
    rows = [(i, "a" if i < 40 else str(i), None if i < 50 else i) for i in range(100)]
    df = spark.createDataFrame(rows, "id int, text string, holes int")
    got = {r["column"]: r.near_constant for r in PR.near_constant(df, ["id", "text", "holes"], mode, limit=0.35).collect()}
    assert got == {"id": False, "text": True, "holes": mode == "master"}
    got = {r["column"]: r.near_constant for r in PR.near_constant(df, ["text"], mode, limit=0.45).collect()}
    assert got == {"text": False}


@pytest.mark.parametrize("name,table", [("st1_review_stream", "events"), ("st2_incremental_ingest", "lineitem")])
def test_streams_read_folders_and_nothing(spark, sf, tmp_path, name, table):
    want = entry.queries()[name](spark, sf).toPandas()
    rows = spark.read.parquet(f"{sf}/{table}.parquet")
    rows.repartition(3).write.parquet(f"{tmp_path}/parts/{table}.parquet")
    got = entry.queries()[name](spark, f"{tmp_path}/parts").toPandas()
    assert sorted(map(tuple, got.values)) == sorted(map(tuple, want.values))
    rows.limit(0).write.parquet(f"{tmp_path}/none/{table}.parquet")
    empty = entry.queries()[name](spark, f"{tmp_path}/none")
    assert empty.columns == list(want.columns) and empty.count() == 0


def test_path_kind(spark, tmp_path):
    (tmp_path / "f").write_text("x")
    assert [path_kind(spark, str(p)) for p in (tmp_path, tmp_path / "f", tmp_path / "g")] == ["folder", "file", "none"]


def test_no_machine_local_scratch_on_a_cluster():
    conf = types.SimpleNamespace(get=lambda *a: None, set=lambda *a: None)
    cluster = types.SimpleNamespace(conf=conf, sparkContext=types.SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(cluster, "x")
    shared = types.SimpleNamespace(conf=types.SimpleNamespace(get=lambda *a: "hdfs://host/x/"), sparkContext=cluster.sparkContext)
    assert scratch_dir(shared, "y").startswith("hdfs://host/x/y-")


def test_macro_f1_over_classes_that_occur(spark):
    df = spark.createDataFrame([(0, 0), (2, 2), (2, 2)], "label int, pred int")
    assert E.summary(E.confusion(df, "label", "pred", 3)).first().f1 == 1.0
    df = spark.createDataFrame([(0, 0), (2, 1)], "label int, pred int")
    assert E.summary(E.confusion(df, "label", "pred", 3)).first().f1 == pytest.approx(1 / 3)


def test_safe_bool_of_numbers_and_text(spark):
    df = spark.sql("SELECT 2 AS i, 0.0D AS d, CAST(1.5 AS DECIMAL(4,2)) AS c, '2' AS t, 'Yes' AS y, true AS b, CAST(NULL AS INT) AS n")
    assert list(df.select(*[P.safe_bool(F.col(c)) for c in df.columns]).first()) == [True, False, True, False, True, True, False]


def test_slug_of_a_column(spark):
    names = [*vocab.GENRES, *vocab.CATEGORIES, *vocab.TAGS]
    got = spark.createDataFrame([(n,) for n in names], "n string").select("n", P.slug(F.col("n")).alias("s")).collect()
    assert {r.n: r.s for r in got} == {n: vocab.slug(n) for n in names}


def test_pseudonym_counts_see_padding(spark):
    df = spark.createDataFrame([("A", "1"), (" A", "2"), (" NULL ", "3"), ("  ", "")], "name string, pid string")
    assert A.pseudonym_stats(df, {"name": "pid"}).first().asDict() == {"n_rows": 4, "name_names": 1, "name_ids": 2}


def test_refresh_blanks_unrefreshed_text(spark):
    df = spark.createDataFrame([(1, None, 5), (2, "x", 0)], "id int, dev string, score int")
    fresh = spark.createDataFrame([(2, "y")], "id int, dev string")
    got = J.refresh(df, fresh, "id", F.col("score") == 0, {"dev": F.col("fresh.dev")}, ["dev"]).orderBy("id").collect()
    assert [r.dev for r in got] == ["", "y"]


def test_roles():
    want = {"appid": "id", "label": "target_label", "ccu": "target_raw", "positive": "outcome_postlaunch", "ts_x": "timeseries_postlaunch",
            "release_year": "analysis_temporal", "genre_a": "feature_tag", "is_free": "feature_tag", "price_tier": "feature_categorical",
            "num_tags": "feature_derived", "price": "feature_numeric"}
    assert {c: R.role_of(c) for c in want} == want
    assert [R.stage_of(R.role_of(c)) for c in ("appid", "ts_x", "positive", "price", "genre_a")] == ["meta", "post", "post", "pre", "pre"]


@pytest.mark.parametrize("name", [n for n in entry.queries() if n not in SQL and n[0] == "m"])
def test_queries_without_sql_run(spark, sf, name):
    assert entry.queries()[name](spark, sf).count() > 0
