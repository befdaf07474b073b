"""The fit on Fourier features that are not stored: the same model as Spark's, its steps, and how it is written."""

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from shelfwise.operators import blocks, linear, models as M, nets


def _rows(spark, x, y):
    df = spark.createDataFrame([(i, a.tolist(), int(b)) for i, (a, b) in enumerate(zip(x, y))], "appid long, v array<double>, label int")
    return df.select("appid", array_to_vector("v").alias("features"), "label").cache()


@pytest.mark.parametrize("labels", [[0, 1, 2], [0, 2]])
def test_many_rows_give_the_same_model_without_stored_features(spark, monkeypatch, tmp_path, labels):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 4))
    near = np.digitize(np.linalg.norm(x, axis=1) + rng.normal(size=900) * 0.2, [1.6, 2.2])
    rows = _rows(spark, x, np.array(labels)[np.minimum(near, len(labels) - 1)])
    kept = M.fit_classifiers(rows, 3, max_iter=40)["svm"]
    monkeypatch.setattr(linear, "KEPT_ROWS", 100)
    monkeypatch.setattr(blocks, "ROWS", 300)
    models = M.fit_classifiers(rows, 3, max_iter=40)
    stored = []
    monkeypatch.setattr(blocks, "written", lambda df, purpose, was=blocks.written: stored.append(df.columns) or was(df, purpose))
    lean = models["svm"]
    # Only the rows themselves were written.
    assert stored == [["n", "x", "y", "w"]]
    assert M.convergence(lean) == M.convergence(kept) == (40, False)
    assert np.abs(lean.coefficientMatrix.toArray() - kept.coefficientMatrix.toArray()).max() < 1e-6
    assert np.abs(lean.interceptVector.toArray() - kept.interceptVector.toArray()).max() < 1e-6
    out = M.apply_classifiers({"fourier": models["fourier"], "svm": lean}, rows, ["svm"])
    want = M.apply_classifiers({"fourier": models["fourier"], "svm": kept}, rows, ["svm"])
    a, b = (df.select("pred_svm", "probs_svm", "appid").orderBy("appid").collect() for df in (out, want))
    assert [r.pred_svm for r in a] == [r.pred_svm for r in b]
    PipelineModel([lean]).write().overwrite().save(f"{tmp_path}/m")
    again = PipelineModel.load(f"{tmp_path}/m").stages[0]
    assert M.convergence(again) == (None, None)
    got = M.apply_classifiers({"fourier": models["fourier"], "svm": again}, rows, ["svm"]).select("pred_svm", "probs_svm", "appid")
    assert got.orderBy("appid").collect() == a


def test_one_label_is_left_to_spark(spark, monkeypatch):
    monkeypatch.setattr(linear, "KEPT_ROWS", 1)
    rows = _rows(spark, np.arange(8.0).reshape(4, 2), [1, 1, 1, 1])
    models = M.fit_classifiers(rows, 3)
    assert {r.pred_svm for r in M.apply_classifiers(models, rows, ["svm"]).collect()} == {1.0}


def test_the_solver_ends_where_the_slope_is_level():
    rng = np.random.default_rng(1)
    q = rng.normal(size=(12, 12))
    q = q @ q.T + np.eye(12)
    want = rng.normal(size=12)
    loss = lambda x: (float((x - want) @ q @ (x - want) / 2 + 1.0), q @ (x - want))
    got, took = linear.minimise(loss, np.zeros(12), 500, 1e-9)
    assert np.abs(got - want).max() < 1e-4 and 0 < took < 500
    assert linear.minimise(loss, want, 500, 1e-9)[1] == 0
    assert linear.minimise(loss, np.zeros(12), 2, 1e-9)[1] == 2


def test_no_reader_of_a_net_s_rows_holds_many_blocks(spark, monkeypatch):
    written = []
    monkeypatch.setattr(blocks, "written", lambda df, purpose, was=blocks.written: written.append(was(df, purpose)) or written[-1])
    rows = spark.range(90_000).select(F.col("id").alias("appid"), array_to_vector(F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: F.rand(5) + i)).alias("features"),
                                      (F.col("id") % 3).cast("int").alias("label"))
    data = nets.blocks(rows, "appid", 10)
    assert data.agg(F.sum("n")).first()[0] == 90_000 and len(written) == 1
    groups = [pq.read_metadata(f.removeprefix("file://")) for f in data.inputFiles()]
    sizes = [m.row_group(i).total_byte_size for m in groups for i in range(m.num_row_groups)]
    assert sum(sizes) > 30e6 and max(sizes) < 25e6
    got = data.where("NOT held").first()
    x = blocks.opened(bytes(got.x), got.n, 64)
    assert x.shape == (got.n, 64) and (np.floor(x) == np.arange(1, 65)).all()


def test_blocks_open_as_they_were():
    x = np.arange(30.0).reshape(10, 3)
    assert (blocks.opened(blocks.squeezed(x), 10, 3) == x).all()
    assert (blocks.opened(blocks.squeezed(x[::2]), 5, 3) == x[::2]).all()
    assert [(p.start, p.stop) for p in blocks.pieces(blocks.ROWS + 1)] == [(0, blocks.ROWS), (blocks.ROWS, blocks.ROWS + 1)]
