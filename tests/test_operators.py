"""Operators on small hand-made and skewed frames, against brute force."""

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import aggregates as A, filters as R, groups as G, joins as J, metrics as E, neighbours as N
from shelfwise.operators import ordered as O, profile as PR, scoring as Z, shrinkage as H
from shelfwise.operators.models import Features
from shelfwise.sources import delimited as D
from shelfwise.streaming import ingest, reviews


def test_group_sizes_with_hot_and_null_keys(spark):
    names = ["hot"] * 400 + [None] * 300 + [f"n{i % 150}" for i in range(500)]
    df = spark.createDataFrame(list(enumerate(names)), "appid long, developer string")
    got = {r["appid"]: (r["dev_game_count"], r["dev_experience"]) for r in A.with_experience(df, "developer", "dev").collect()}
    assert len(got) == len(names)
    for i, n in enumerate(names):
        count = 1 if n is None else names.count(n)
        assert got[i] == (count, "AAA" if count >= 10 else "Establecido" if count >= 3 else "Novato")


@pytest.mark.parametrize("n", [1, 2, 3, 10, 101, 3000])
def test_median_matches_brute_force(spark, n):
    rng = random.Random(n)
    rows = [("a", float(rng.choice([0, 1, rng.randint(0, 50), rng.random() * 1e6]))) for _ in range(n)]
    rows += [("b", 5.0)] * n + [("c", None)]
    got = {r["k"]: r["median"] for r in O.grouped_median(spark.createDataFrame(rows, "k string, v double"), "k", "v").collect()}
    assert got == {"a": statistics.median(v for k, v in rows if k == "a"), "b": 5.0}


def test_split_takes_exact_share(spark):
    labels = [0] * 700 + [1] * 33 + [2] * 4
    df = spark.createDataFrame(list(enumerate(labels)), "appid long, label int")
    out = O.stratified_test_flag(df, "label", "appid").where("is_test").groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in out} == {0: 140, 1: 6}


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(5000)
    a, b = (sorted(r["id"] for r in O.sample_n(df, "id", 777, 3).collect()) for _ in range(2))
    assert len(a) == 777 and a == b
    assert O.sample_n(df.limit(5), "id", 777, 3).count() == 5


def test_near_constant_modes(spark):
    rows = [(i, 1 if i == 0 else 0, 1 if i < 2 else 0, None, "x" if i == 0 else "y") for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, c999 int, c998 int, gone int, word string")
    flags = lambda m: {r["column"]: r["near_constant"] for r in PR.near_constant(df, df.columns, m).collect()}
    assert flags("master") == {"id": False, "c999": True, "c998": False, "gone": True, "word": True}
    assert flags("stage1") == {"id": False, "c999": True, "c998": False, "gone": True, "word": True}


def test_impute_uses_median_between_integers(spark):
    df = spark.createDataFrame([(1, 2, "a", 1), (2, 5, None, None), (3, None, "b", 0)], "id int, v int, s string, is_x int")
    got = [tuple(r) for r in PR.impute(df, ["is_x"]).orderBy("id").collect()]
    assert got == [(1, 2.0, "a", 1), (2, 5.0, "", 0), (3, 3.5, "b", 0)]


def test_prior_of_single_item_is_global(spark):
    rows = [(0, "solo", 2)] + [(i, "many", i % 2) for i in range(1, 10)] + [(10, None, 1)]
    df = spark.createDataFrame(rows, "appid long, developer string, label int")
    got = {r["appid"]: r["dev_success_prior"] for r in H.leave_one_out_prior(df).collect()}
    p0 = sum(r[2] >= 1 for r in rows) / len(rows)
    assert got[0] == round(p0, 4) and got[10] is None
    s = sum(r[2] >= 1 for r in rows if r[1] == "many")
    assert got[1] == round((s - 1 + p0 * 12) / (8 + 12), 4)


def test_beta_fit_edges(spark):
    flat = spark.createDataFrame([("a", 2, 1), ("b", 4, 2)], "d string, n long, k long")
    assert H.beta_fit(flat).first()["kappa"] == 50.0
    wild = spark.createDataFrame([("a", 2, 0), ("b", 4, 4)], "d string, n long, k long")
    assert H.beta_fit(wild).first()["kappa"] == 1.0


def test_published_confusion_gives_published_scores(spark):
    matrix = [[290, 125, 14], [55, 756, 36], [18, 92, 178]]
    rows = [(i, j, n) for i, r in enumerate(matrix) for j, n in enumerate(r)]
    out = E.summary(spark.createDataFrame(rows, "actual int, predicted int, n long")).first()
    assert (round(out["accuracy"], 4), round(out["f1"], 4)) == (0.7826, 0.7510)


def test_auc_counts_ties_half(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.5), (0, 0.5), (0, 0.1)], "y int, s double")
    assert E.auc(df, F.col("y"), F.col("s")) == pytest.approx(0.875)


def test_panel_without_votes(spark):
    df = spark.createDataFrame([(1, "2024-01", 0, 0, 0, 0, 0, 0.0), (1, "2024-02", 0, 0, 0, 0, 0, 1.5)], """appid long, month string,
      review_count long, positive_count long, negative_count long, steam_purchase_count long, early_access_count long,
      avg_playtime_at_review_hrs double""")
    r = A.collapse_panel(df).first()
    assert (r["ts_positive_ratio"], r["ts_months_active"], r["ts_avg_playtime_hrs"]) == (0.0, 0, 0.75)


def test_search(spark):
    df = spark.createDataFrame([(1, "a b%c"), (2, "abc"), (3, "B%X")], "id int, name string")
    assert [r["id"] for r in R.search_names(df, "b%", "name", "id").collect()] == [1, 3]
    assert R.search_names(df, "b", "name", "id").count() == 0


def test_candidates_fall_back_without_ranking(spark):
    ranked = spark.createDataFrame([("a", 0.1), ("b", -2.0), ("z", 9.0)], "feature string, coef double")
    allowed = spark.createDataFrame([("a",), ("b",), ("c",)], "feature string")
    assert [r["feature"] for r in J.candidates(ranked, allowed, "feature", "coef").collect()] == ["b", "a"]
    assert [r["feature"] for r in J.candidates(ranked.limit(0), allowed, "feature", "coef").collect()] == ["a", "b", "c"]


def test_quoted_fields(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('appid;developer;note\n1;"ELI;BETH";a\n2;Plain;"he said ""x""\nnext line"\n')
    rows = D.read_typed(spark, str(path), "appid int, developer string, note string").orderBy("appid").collect()
    assert [tuple(r) for r in rows] == [(1, "ELI;BETH", "a"), (2, "Plain", 'he said "x"\nnext line')]


@pytest.mark.parametrize("block_rows", [7, 4096])
def test_neighbours_match_brute_force(spark, block_rows):
    rng = np.random.default_rng(1)
    # Tight clusters, many copies of one vector, and a zero vector.
    v = np.concatenate([rng.normal(c, 0.05, (40, 6)) for c in rng.normal(0, 1, (4, 6))] + [np.ones((60, 6)), np.zeros((1, 6))])
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "id long, v array<double>")
    got = {}
    for r in N.nearest(df, df, "id", "v", 5, pivots=6, block_rows=block_rows).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["item_id"])
    n = np.linalg.norm(v, axis=1, keepdims=True)
    u = v / np.where(n > 0, n, 1)
    sims = np.round(u @ u.T, 12)
    for i in range(len(v)):
        want = np.sort(-sims[i])[:5]
        assert np.allclose(-sims[i][got[i]], want, atol=1e-9) and len(set(got[i])) == 5


def _toy():
    f = Features(("price", "supported_languages", "num_tags"), ("tag_a", "tag_b", "tag_c"), ("controller_support", "price_tier"))
    return Z.Schema(f, {"price": 10.0, "supported_languages": 4.0, "controller_support": "none", "price_tier": "Mid"},
                    ("tag_a", "tag_b", "tag_c"))


def _toy_score(s):
    z = (-0.05 * s["price"] + 0.03 * s["supported_languages"] + 0.2 * s["num_tags"] + 0.5 * s["tag_a"] - 0.9 * s["tag_b"]
         + 0.7 * s["tag_a"] * s["tag_c"] + 0.4 * (s["controller_support"] == "full"))
    return 1 / (1 + np.exp(-z))


def _toy_scorer(df):
    c = F.col
    z = (-0.05 * c("price") + 0.03 * c("supported_languages") + 0.2 * c("num_tags") + 0.5 * c("tag_a") - 0.9 * c("tag_b")
         + 0.7 * c("tag_a") * c("tag_c") + 0.4 * (c("controller_support") == "full").cast("double"))
    return df.withColumn("p_hit", 1 / (1 + F.exp(-z)))


def _brute_package(state, rounds=3, beam=4):
    def moves(s):
        out = []
        for d in (-5, -3, 3, 5):
            n = round(min(60.0, max(0.0, s["price"] + d)), 2)
            if abs(n - s["price"]) > 1e-6:
                out.append(("price", n))
        out += [("supported_languages", s["supported_languages"] + d) for d in (4, 8)]
        if s["controller_support"] != "full":
            out.append(("controller_support", "full"))
        return out + [(t, 1 - s[t]) for t in ("tag_a", "tag_b", "tag_c")]

    front, best = [(_toy_score(state), state, [])], (_toy_score(state), [])
    seen = {tuple(state.values())}
    for _ in range(rounds):
        found = []
        for _, s, path in front:
            for f, v in moves(s):
                if f in path:
                    continue
                n = {**s, f: v}
                n["num_tags"] = n["tag_a"] + n["tag_b"] + n["tag_c"]
                if tuple(n.values()) not in seen:
                    seen.add(tuple(n.values()))
                    found.append((_toy_score(n), n, path + [f]))
        found.sort(key=lambda x: -x[0])
        front = found[:beam]
        if front and front[0][0] > best[0]:
            best = (front[0][0], front[0][2])
    return best


def test_package_matches_brute_force(spark):
    rows = [(1, 20.0, 3, 0, 1, 0, "none"), (2, 0.0, 9, 1, 0, 0, "full"), (3, 58.0, 0, 0, 0, 1, None)]
    df = spark.createDataFrame(rows, "id int, price double, supported_languages int, tag_a int, tag_b int, tag_c int, controller_support string")
    states = Z.normalise(df, _toy(), "id").drop("raw_price")
    got = {r["id"]: r for r in Z.best_package(states, _toy(), _toy_scorer, "id").collect()}
    for i, price, langs, a, b, c, ctl in rows:
        s = {"price": price, "supported_languages": langs, "tag_a": a, "tag_b": b, "tag_c": c, "num_tags": a + b + c,
             "controller_support": ctl or "none"}
        p, path = _brute_package(s)
        assert got[i]["phit_despues"] == pytest.approx(p, abs=6e-5)
        assert [m["feature"] for m in got[i]["cambios"]] == path


def test_what_if_and_explanation(spark):
    df = spark.createDataFrame([(1, 20.0, 1)], "id int, price double, tag_b int")
    states = Z.normalise(df, _toy(), "id").drop("raw_price")
    top = Z.what_if(states, _toy(), _toy_scorer, "id").orderBy("rank").collect()
    assert len(top) == 6 and top[0]["feature"] == "tag_a" and top[0]["desc"] == "Añadir 'A'"
    why = {r["feature"]: r["delta"] for r in Z.explain(states, _toy(), _toy_scorer, "id").collect()}
    assert set(why) == {"price", "tag_b"} and why["tag_b"] < 0


def test_review_stream_over_several_batches(spark, tmp_path):
    rows = [(i % 3, 1_704_067_200 + i * 7200, i % 2 == 0, i) for i in range(600)]
    df = spark.createDataFrame(rows, "appid long, e long, up boolean, m long").withColumn("ts", F.timestamp_seconds("e"))
    for i in range(3):
        df.where((F.col("e") >= 1_704_067_200 + i * 200 * 7200) & (F.col("e") < 1_704_067_200 + (i + 1) * 200 * 7200)) \
            .coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    days = reviews.day_totals(stream, "appid", F.col("ts"), "60 days", F.col("up"), ~F.col("up"), F.lit(False), F.col("m"))
    reviews.write_day_totals(days, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = {tuple(r) for r in reviews.read_month_panel(spark, str(tmp_path / "out"), "appid").collect()}
    c = F.col
    want = {tuple(r) for r in A.review_panel(df, "appid", c("e"), c("up"), ~c("up"), F.lit(False), c("m")).collect()}
    assert got == want


def test_ingest_skips_keys_of_earlier_batches(spark, tmp_path):
    for part in ([(1, "a"), (2, "b"), (2, "c")], [(2, "z"), (3, "d")]):
        spark.createDataFrame(part, "k long, v string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k long, v string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    ingest.ingest_new(stream, str(tmp_path / "out"), str(tmp_path / "cp"), "k", ["v"]).awaitTermination()
    rows = ingest.read_ingested(spark, str(tmp_path / "out")).collect()
    assert sorted(r["k"] for r in rows) == [1, 2, 3]
