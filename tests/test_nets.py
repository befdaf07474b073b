"""The ReLU net: gradients, early stopping, several tasks, and how it is written and read."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from shelfwise.operators import metrics as E, models as M, nets
from shelfwise.operators.scoring import Schema
from shelfwise.operators.stages import FourierMap, ReluNetModel
from shelfwise.sources import bundle as B


def test_gradient_matches_differences():
    rng = np.random.default_rng(0)
    layers = [4, 5, 3, 3]
    flat, x, y = nets.first_weights(layers, 1), rng.normal(size=(20, 4)), rng.integers(0, 3, 20)

    def cost(f):
        net = nets.unpacked(f, layers)
        return nets.loss(net, x, y).mean() + 0.3 / 2 / 20 * sum((w ** 2).sum() for w, _ in net)

    g = nets.gradient(nets.unpacked(flat, layers), x, y, 0.3)
    for i in range(0, len(flat), 3):
        up, down = flat.copy(), flat.copy()
        up[i] += 1e-6
        down[i] -= 1e-6
        assert g[i] == pytest.approx((cost(up) - cost(down)) / 2e-6, abs=1e-6)


@pytest.fixture(scope="module")
def ring(spark):
    """Three classes by distance from the origin, which no line separates."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 2))
    y = np.digitize(np.linalg.norm(x, axis=1), [0.8, 1.5])
    df = spark.createDataFrame([(i, a.tolist(), int(b)) for i, (a, b) in enumerate(zip(x, y))], "appid long, v array<double>, label int")
    return df.select("appid", array_to_vector("v").alias("features"), "label").cache()


def _auc(model, df):
    probs = vector_to_array("prob_mlp")
    return E.auc_ovr_macro(model.transform(df), "label", [probs[i] for i in range(3)])


@pytest.mark.parametrize("task_rows", [20_000, 400])
def test_net_learns_rings_and_stops_early(spark, ring, monkeypatch, task_rows):
    monkeypatch.setattr(nets, "TASK_ROWS", task_rows)
    train, test = ring.where("appid % 5 > 0"), ring.where("appid % 5 = 0")
    assert nets.blocks(train, "appid", 10).select("task").distinct().count() == -(-2400 // task_rows)
    model = nets.fit(train, 3, hidden=(24, 12), max_epochs=150, patience=5, rate=0.01)
    assert model.getOrDefault(model.stopped) and model.getOrDefault(model.iterations) < 150
    assert M.convergence(model) == (model.getOrDefault(model.iterations), True)
    linear = M.logistic("mlp", 1.0, 2400.0, weighted=False).fit(train)
    assert _auc(model, test) > 0.98 > 0.8 > _auc(linear, test)
    out = model.transform(test).select(vector_to_array("prob_mlp").alias("p"), "pred_mlp")
    assert all(abs(sum(r.p) - 1) < 1e-12 and int(np.argmax(r.p)) == r.pred_mlp for r in out.collect())


def test_limit_and_few_rows(spark, ring):
    model = nets.fit(ring.where("appid < 40"), 3, hidden=(4,), max_epochs=2)
    assert model.getOrDefault(model.iterations) == 2 and not model.getOrDefault(model.stopped)
    assert model.transform(ring.limit(0)).count() == 0
    assert nets.fit(ring.limit(0), 3, hidden=(4,)).getOrDefault("iterations") == 0


def test_own_stages_score_alike_after_reading(spark, ring, tmp_path):
    net = nets.fit(ring.where("appid < 300"), 3, hidden=(4,), max_epochs=2)
    fourier = FourierMap.fit(ring)
    PipelineModel([fourier, net]).write().overwrite().save(f"{tmp_path}/p")
    again = PipelineModel.load(f"{tmp_path}/p")
    assert isinstance(again.stages[0], FourierMap) and isinstance(again.stages[1], ReluNetModel)
    cols = ["appid", vector_to_array("fourier").alias("f"), vector_to_array("prob_mlp").alias("p"), "pred_mlp"]
    score = lambda m: m.transform(ring).select(*cols).orderBy("appid").collect()
    assert score(again) == score(PipelineModel([fourier, net]))


def test_bundle_comes_back_as_it_was(spark, ring, tmp_path):
    features = M.Features(("price",), ("tag_a", "tag_b"), ("kind",))
    items = spark.createDataFrame([(1.0, 1, 0, "x"), (2.5, 0, 1, "y"), (4.0, 1, 1, "x")], "price double, tag_a int, tag_b int, kind string")
    stages = {"pre": M.fit_preprocessor(items, features), "fourier": FourierMap.drawn(2, 0.5, 8), "mlp": nets.fit(ring.where("appid < 99"), 3, hidden=(3,), max_epochs=1)}
    saved = B.Bundle(stages, Schema(features, {"price": 2.5, "kind": "x", "tag_a": 0.0}, ("tag_b",)))
    B.save_bundle(spark, saved, f"{tmp_path}/b")
    again = B.load_bundle(spark, f"{tmp_path}/b")
    assert again.schema == saved.schema and list(again.stages) == list(stages)
    for name, df in (("pre", items), ("fourier", ring), ("mlp", ring)):
        assert sorted(map(str, stages[name].transform(df).collect())) == sorted(map(str, again.stages[name].transform(df).collect()))
    with pytest.raises(FileNotFoundError):
        B.load_bundle(spark, f"{tmp_path}/none")
    missing = B.read_reports(spark, f"{tmp_path}/none", {"metrics": "modelo string"})
    assert missing["metrics"].count() == 0
