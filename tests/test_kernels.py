"""The kernel machine: its dual solver, the cascade, probabilities, and how it is written and read."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array

from shelfwise.operators import kernels, metrics as E, models as M
from shelfwise.operators.stages import FourierMap, KernelMachineModel, rbf_kernel


def _table(spark, x, y):
    df = spark.createDataFrame([(i, a.tolist(), int(b)) for i, (a, b) in enumerate(zip(x, y))], "appid long, v array<double>, label int")
    return df.select("appid", array_to_vector("v").alias("features"), "label").cache()


@pytest.fixture(scope="module")
def shells(spark):
    """Three classes by distance from the origin in twelve dimensions."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 12))
    return _table(spark, x, np.digitize(np.linalg.norm(x, axis=1), [3.1, 3.7]))


def _auc(model, df, name="kernel"):
    probs = vector_to_array(f"prob_{name}")
    return E.auc_ovr_macro(model.transform(df), "label", [probs[i] for i in range(3)])


def test_solver_reaches_the_least_dual():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 3))
    y = np.where(np.linalg.norm(x, axis=1) + rng.normal(size=60) * 0.3 > 1.6, 1.0, -1.0)
    k, c = rbf_kernel(x, x, 0.4), rng.uniform(1, 5, 60)
    alpha, worst = kernels.solve(k, y, c, np.zeros(60), 1e-6)
    q = k * np.outer(y, y)
    slow, step = np.zeros(60), 1 / np.linalg.norm(q, 2)
    for _ in range(60_000):  # projected gradient
        slow = np.clip(slow - (q @ slow - 1) * step, 0, c)
    cost = lambda a: a @ q @ a / 2 - a.sum()
    assert worst <= 1e-6 and cost(alpha) == pytest.approx(cost(slow), abs=1e-4) and cost(alpha) <= cost(slow) + 1e-6
    again, _ = kernels.solve(k, y, c, alpha, 1e-6)
    assert (again == alpha).all()


def test_groups_merge_in_order_within_the_bound(monkeypatch):
    monkeypatch.setattr(kernels, "GROUP", 10)
    assert kernels._merged({0: 4, 1: 5, 2: 2, 5: 8, 6: 12}) == {0: 0, 1: 0, 2: 1, 5: 1, 6: 2}
    assert kernels._merged({}) == {}


def test_cascade_beats_fourier_features_on_shells(spark, shells, monkeypatch):
    train, test = shells.where("appid % 5 > 0"), shells.where("appid % 5 = 0")
    model = kernels.fit(train, 3)
    assert model.getOrDefault("stopped") and model.getOrDefault("residual") <= 1e-3 and model.getOrDefault("groups") == 1
    assert M.convergence(model) == (model.getOrDefault("iterations"), True) and model.getOrDefault("iterations") == 2
    fourier = FourierMap.fit(train)
    rough = M.logistic("svm", 10.0, train.count(), weighted=False, features="fourier").fit(fourier.transform(train))
    exact = _auc(model, test)
    assert exact > _auc(PipelineModel([fourier, rough]), test, "svm") and exact > 0.9, exact
    out = model.transform(test).select(vector_to_array("prob_kernel").alias("p"), "pred_kernel", "label").collect()
    assert all(abs(sum(r.p) - 1) < 1e-12 and int(np.argmax(r.p)) == r.pred_kernel for r in out)
    # Probabilities are right on the mean.
    for k in range(3):
        assert np.mean([r.p[k] for r in out]) == pytest.approx(np.mean([r.label == k for r in out]), abs=0.05)
    # Twelve shards end in the same machine.
    monkeypatch.setattr(kernels, "SHARD", 160)
    small = kernels.fit(train, 3)
    assert small.getOrDefault("stopped") and small.getOrDefault("groups") == 1
    a, b = (np.array([r.f for r in m.decisions(test, "f").orderBy("appid").collect()]) for m in (model, small))
    assert np.abs(a - b).max() < 0.05
    # Groups that may not merge decide together.
    monkeypatch.setattr(kernels, "GROUP", 300)
    many = kernels.fit(train, 3)
    assert many.getOrDefault("groups") > 1 and _auc(many, test) > 0.85, _auc(many, test)


def test_noise_bounds_and_edge_cases(spark, shells, monkeypatch, tmp_path):
    rng = np.random.default_rng(2)
    noise = _table(spark, np.repeat(rng.normal(size=(80, 2)), 3, axis=0), rng.integers(0, 3, 240))
    model = kernels.fit(noise, 3)
    assert model.getOrDefault("stopped")
    few = kernels.fit(shells, 3, max_rows=50)
    assert len(few.getOrDefault("coefs")) <= 150
    one = kernels.fit(shells.where("label = 1 AND appid < 200"), 3)
    assert {r.pred_kernel for r in one.transform(shells.limit(20)).collect()} == {1.0}
    none = kernels.fit(shells.limit(0), 3)
    assert {tuple(r.p) for r in none.transform(shells.limit(5)).select(vector_to_array("prob_kernel").alias("p")).collect()} == {(1 / 3,) * 3}
    assert model.transform(noise.limit(0)).count() == 0
    PipelineModel([model]).write().overwrite().save(f"{tmp_path}/k")
    again = PipelineModel.load(f"{tmp_path}/k").stages[0]
    assert isinstance(again, KernelMachineModel)
    cols = ["appid", vector_to_array("prob_kernel").alias("p"), "pred_kernel"]
    assert again.transform(noise).select(*cols).orderBy("appid").collect() == model.transform(noise).select(*cols).orderBy("appid").collect()
