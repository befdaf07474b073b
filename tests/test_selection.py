"""Selection by narrowing and by radix, and the metric tree: many levels on small tables."""

import hashlib
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import neighbours as N, ordered as O

VALUES = {
    "spread": lambda rng, i: rng.random() * 10 ** rng.randint(-300, 300),
    "halves": lambda rng, i: float(rng.random() < 0.5),
    "heavy": lambda rng, i: 7.0 if rng.random() < 0.3 else rng.random() * 14,
    "signed": lambda rng, i: rng.gauss(0, 1e9),
    "ends": lambda rng, i: rng.choice([float("-inf"), float("inf"), 1.0, 2.0]),
    "places": lambda rng, i: float(i // 3),
}


@pytest.fixture(scope="module")
def numbers(spark):
    rng = random.Random(9)
    table = {k: [f(rng, i) for i in range(6000)] for k, f in VALUES.items()}
    rows = [(i, *[table[k][i] if rng.random() < 0.9 else rng.choice([None, float("nan")]) for k in VALUES], None) for i in range(6000)]
    df = spark.createDataFrame(rows, "id long, " + ", ".join(f"{k} double" for k in VALUES) + ", gone double").repartition(4).cache()
    want = {k: statistics.median(r[j] for r in rows if r[j] is not None and r[j] == r[j]) for j, k in enumerate(VALUES, 1)}
    yield df, want
    df.unpersist()


@pytest.mark.parametrize("small", [8, 300])
def test_medians_by_narrowing(spark, numbers, monkeypatch, small):
    df, want = numbers
    monkeypatch.setattr(O, "SMALL", small)
    passes = []
    counted = O._counted
    monkeypatch.setattr(O, "_counted", lambda *a: passes.append(1) or counted(*a))
    assert O.medians(df, {c: F.col(c) for c in [*VALUES, "gone"]}) == want
    assert len(passes) <= 4 * len(VALUES) + 2  # each pass leaves a hundredth
    long = df.unpivot(["id"], [*VALUES, "gone"], "k", "v")
    assert {r["k"]: r["median"] for r in O.grouped_median(long, "k", "v").collect()} == want
    assert {r["column"]: r["median"] for r in O.column_medians(df, ["heavy"]).collect()} == {"heavy": want["heavy"]}


def test_medians_of_nothing(spark):
    none = spark.createDataFrame([], "k int, v double")
    assert O.medians(none, {"v": F.col("v")}) == {} and O.grouped_median(none, "k", "v").count() == 0


def test_median_of_integers_and_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 4), (3, 2), (3, None)], "k int, v int")
    assert {r["k"]: r["median"] for r in O.grouped_median(df, "k", "v").collect()} == {None: 2.5, 3: 2.0}


def _order(key, seed):
    return hashlib.md5(f"{seed}-{key}".encode()).hexdigest(), key


@pytest.mark.parametrize("digits,small", [(1, 3), (2, 1), (4, 10_000)])
def test_cut_by_radix(spark, digits, small):
    rng = random.Random(digits)
    rows = [(i, rng.choice(["a", "b", None])) for i in range(3000)] + [(9000, "one")]
    df = spark.createDataFrame(rows, "id long, g string").repartition(3)
    cuts = O.hash_cutoff(df, "id", 5, F.floor(F.col("_total") * 0.37), ["g"], digits, small)
    got = {r["g"]: tuple(r["_cut"]) for r in cuts.collect()}
    for g in ("a", "b", None):
        keys = sorted(_order(i, 5) for i, x in rows if x == g)
        assert got[g] == keys[int(len(keys) * 0.37) - 1]
    assert "one" not in got  # 0.37 of one row is none
    if small < 10:
        # More than one level was needed: the cut is looked up by a prefix longer than the first one.
        text = cuts._jdf.queryExecution().optimizedPlan().toString()
        assert f"substring(_h" in text and f", 1, {digits})" not in text.split("Join")[-1]


def test_cut_among_copies_of_a_key(spark):
    df = spark.createDataFrame([(7,)] * 50 + [(8,)] * 30, "id long")
    first = min(_order(7, 1), _order(8, 1))
    n = 50 if first[1] == 7 else 30
    for take in (1, n, n + 1):
        cut = O.hash_cutoff(df, "id", 1, F.lit(take).cast("long"), small=5).first()["_cut"]
        assert tuple(cut) == (first if take <= n else max(_order(7, 1), _order(8, 1)))


def _clustered(spark, n, clusters, seed=3):
    rng = np.random.default_rng(seed)
    at = rng.normal(size=(clusters, 12))
    v = at[rng.integers(0, clusters, n)] + rng.normal(scale=0.02, size=(n, 12))
    return v, spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")


def test_tree_visits_few_leaves_of_clustered_items(spark, monkeypatch):
    monkeypatch.setattr(N, "LEAF_ROWS", 50)
    shares = []
    for n, clusters in ((2000, 20), (4000, 40)):
        v, df = _clustered(spark, n, clusters)
        queries = df.where("id % 20 = 0")
        seen = {}
        got = {}
        for r in N.nearest(df, queries, "id", "v", 4, skip_self=True, report=seen).collect():
            got.setdefault(r["query_id"], {})[r["rank"]] = r["item_id"]
        u = v / np.linalg.norm(v, axis=1, keepdims=True)
        for q in range(0, n, 20):
            s = np.round(u @ u[q], 12)
            s[q] = -2
            want = sorted(range(n), key=lambda i: (-s[i], i))[:4]
            assert np.allclose([s[got[q][i + 1]] for i in range(4)], s[want], atol=1e-11)
        assert seen["pairs"] == n * n // 20 and seen["leaves"] == N.pivot_count(n)
        shares.append(seen["visited"] / seen["pairs"])
    print(shares)
    assert shares[0] < 0.05 and shares[1] < 0.75 * shares[0]  # twice the rows cost far less than four times the pairs


def test_pivots_grow_with_the_root():
    assert [N.pivot_count(n) for n in (0, 1, 2047, 4096, 10 ** 6)] == [1, 1, 1, 2, 488]
    assert N.pivot_count(10 ** 8) == 10 ** 4 and N.pivot_count(10 ** 12) == N.MAX_PIVOTS


def test_tree_without_structure_or_with_few_items(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rng.normal(size=(90, 8)))], "id long, v array<double>")
    far = N.nearest(df, df, "id", "v", 3, pivots=30)
    flat = N.nearest(df, df, "id", "v", 3)
    assert sorted(map(tuple, far.collect())) == sorted(map(tuple, flat.collect()))
    few = N.nearest(df.where("id < 3"), df, "id", "v", 5, pivots=3)
    assert few.count() == 270 and few.agg(F.max("rank")).first()[0] == 3
