"""Work that is done only when asked for, and bounds of tasks on large tables."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from shelfwise.operators import models as M, neighbours as N, nets, scoring as Z
from tests.test_operators import _toy, _toy_scorer


@pytest.fixture(scope="module")
def rings(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1200, 2))
    y = np.digitize(np.linalg.norm(x, axis=1), [0.8, 1.5])
    df = spark.createDataFrame([(i, a.tolist(), int(b)) for i, (a, b) in enumerate(zip(x, y))], "appid long, v array<double>, label int")
    return df.select("appid", array_to_vector("v").alias("features"), "label").cache()


def test_a_model_is_fitted_when_asked_for(rings, monkeypatch):
    def never(*a, **b):
        raise AssertionError("the net was not asked for")

    monkeypatch.setattr(nets, "fit", never)
    models = M.fit_classifiers(rings, 3)
    assert list(models) == ["lr", "fourier", "svm", "mlp"]
    scored = M.apply_classifiers(models, rings, ["lr", "svm"])
    assert {"pred_lr", "probs_lr", "pred_svm", "probs_svm"} <= set(scored.columns)
    assert models["lr"] is models["lr"]
    with pytest.raises(AssertionError):
        models["mlp"]
    with pytest.raises(KeyError):
        models["none"]


def test_a_net_has_few_tasks_and_learns_from_pieces(rings, monkeypatch):
    monkeypatch.setattr(nets, "TASK_ROWS", 100)
    monkeypatch.setattr(nets, "TASKS", 3, raising=False)
    assert nets.blocks(rings, "appid", 10).select("task").distinct().count() == 3
    model = nets.fit(rings, 3, hidden=(16, 8), max_epochs=60, rate=0.01)
    right = model.transform(rings).agg(F.avg((F.col("pred_mlp") == F.col("label")).cast("double"))).first()[0]
    assert right > 0.9


def test_a_walk_goes_over_every_piece():
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(900, 4)), rng.integers(0, 3, 900)
    flat = nets.first_weights([4, 5, 3], 1)
    whole = nets.Walk(flat, [4, 5, 3], 7, 1e-3, 1e-4)
    whole.over(x, y)
    assert np.array_equal(whole.flat, nets.local_steps(flat, [4, 5, 3], x, y, 7, 1e-3, 1e-4))
    steps = whole.t
    whole.over(x[:500], y[:500])
    assert (whole.rows, whole.t) == (1400, steps + 3)


def test_neighbours_take_few_queries_at_a_time():
    pdf = pd.DataFrame({"id": range(1000)})
    got = list(N.pieces(iter([pdf, pdf[:0]]), N.RING_PIECE // 2))
    assert max(map(len, got)) == 2 and pd.concat(got).id.tolist() == list(range(1000))
    assert [len(p) for p in N.pieces(iter([pdf]), 10 * N.RING_PIECE)] == [1] * 1000


def test_a_package_round_shuffles_states_and_not_moves(spark):
    rows = [(i, float(i % 60), i % 20, i % 2) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, price double, supported_languages int, tag_a int")
    found = Z.best_package(Z.normalise(df, _toy(), "id").drop("raw_price"), _toy(), _toy_scorer, "id", rounds=1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan
    assert found.count() == 300
