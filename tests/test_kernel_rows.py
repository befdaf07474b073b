"""The kernel machine on all rows: no row is left out, groups of many shards, and vectors that are kept as a table."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from shelfwise.operators import kernels
from shelfwise.operators.ordered import md5_order


@pytest.fixture(scope="module")
def shells(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 6))
    y = np.digitize(np.linalg.norm(x, axis=1), [2.0, 2.6])
    df = spark.createDataFrame([(i, a.tolist(), int(b)) for i, (a, b) in enumerate(zip(x, y))], "appid long, v array<double>, label int")
    return df.select("appid", array_to_vector("v").alias("features"), "label").cache()


def _decisions(model, df):
    return np.array([r.f for r in model.decisions(df, "f").orderBy("appid").collect()])


def test_no_row_is_left_out(spark):
    # The last hundredth of the rows by the hash of their key is a class of its own, somewhere else.
    late = F.substring(md5_order(F.col("id"), 13), 1, 2) >= "fd"
    at = F.when(late, 5.0).otherwise(F.col("id") % 10 / 10)
    df = spark.range(21_000).select(F.col("id").alias("appid"), array_to_vector(F.array(at, F.lit(1.0))).alias("features"), late.cast("int").alias("label"))
    model = kernels.fit(df, 2, gamma=1.0)
    assert model.getOrDefault("stopped")
    far = _decisions(model, df.where("label = 1").limit(1))[0]
    assert far[1] > 0 > far[0]


def test_a_table_of_vectors_decides_alike(spark, shells, monkeypatch, tmp_path):
    train, test = shells.where("appid % 5 > 0"), shells.where("appid % 5 = 0")
    model = kernels.fit(train, 3)
    monkeypatch.setattr(kernels, "MODEL_ROWS", 10)
    wide = kernels.fit(train, 3)
    assert wide.getOrDefault("table") and not wide.getOrDefault("coefs")
    assert np.abs(_decisions(model, test) - _decisions(wide, test)).max() < 1e-9
    assert wide.decisions(test.limit(0), "f").count() == 0
    got = wide.transform(test).select("appid", "label", vector_to_array("prob_kernel").alias("p"), "pred_kernel").orderBy("appid")
    want = model.transform(test).select(vector_to_array("prob_kernel").alias("p"), "appid").orderBy("appid")
    rows = got.collect()
    assert np.abs(np.array([r.p for r in rows]) - np.array([r.p for r in want.collect()])).max() < 1e-6
    assert all(int(np.argmax(r.p)) == r.pred_kernel for r in rows)
    PipelineModel([wide]).write().overwrite().save(f"{tmp_path}/k")
    again = PipelineModel.load(f"{tmp_path}/k").stages[0]
    assert again.getOrDefault("table").startswith(str(tmp_path))
    assert (_decisions(again, test) == _decisions(wide, test)).all()


def test_groups_of_many_rows_settle_in_many_tasks(spark, shells, monkeypatch):
    train, test = shells.where("appid % 5 > 0"), shells.where("appid % 5 = 0")
    monkeypatch.setattr(kernels, "SHARD", 120)
    model = kernels.fit(train, 3)
    monkeypatch.setattr(kernels, "LOCAL_ROWS", 200)
    wide = kernels.fit(train, 3)
    for name in ("stopped", "groups", "iterations"):
        assert wide.getOrDefault(name) == model.getOrDefault(name)
    assert np.abs(_decisions(model, test) - _decisions(wide, test)).max() < 0.05
    # A group that has no room for more rows ends, and says by how much they break the conditions.
    monkeypatch.setattr(kernels, "GROUP", 150)
    full = kernels.fit(train, 3)
    monkeypatch.setattr(kernels, "LOCAL_ROWS", 16_384)
    local = kernels.fit(train, 3)
    assert full.getOrDefault("groups") == local.getOrDefault("groups") > 1
    assert full.getOrDefault("residual") == pytest.approx(local.getOrDefault("residual"), abs=0.01)
