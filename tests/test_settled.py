"""Steps that all fitted models share: flags settled by counts, cuts found once, scores written once."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F
from pyspark.util import PythonEvalType

from shelfwise.operators import models as M, ordered as O, profile as PR
from shelfwise.operators.stages import FourierMap

ROWS = [(0, 1, 0, None, 7, None, 0.5), (1, 1, 1, 1, 7, None, 0.5), (0, 1, None, None, 8, None, 0.5), (1, 1, None, 1, 9, None, None)]
SCHEMA = "both int, ones int, holes long, known short, many int, gone int, real double"


LONG = [(0, int(i < 2), -1, 2, i % 2, None, 1.0) for i in range(1000)]


@pytest.mark.parametrize("mode,rows", [("master", ROWS), ("stage1", ROWS), ("master", []), ("stage1", LONG)])
def test_flags_are_settled_without_sketches(spark, monkeypatch, mode, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    flat = {r["column"] for r in PR.near_constant(df, df.columns, mode).where("near_constant").collect()}
    asked, near = [], PR.near_constant
    monkeypatch.setattr(PR, "near_constant", lambda d, cols, m: asked.extend(cols) or near(d, cols, m))
    assert PR.kept_columns(df, df.columns, mode) == [c for c in df.columns if c not in flat]
    assert "real" in asked and not {"both", "ones", "gone"} & set(asked)
    assert PR.kept_columns(df, [], mode) == []


def test_cuts_of_a_split_are_found_once(spark):
    df = spark.range(500).select(F.col("id").alias("appid"), F.when(F.col("id") % 7 > 0, F.col("id") % 3).alias("label"))
    out = O.stratified_test_flag(df, "label", "appid")
    assert "Aggregate" not in out._jdf.queryExecution().optimizedPlan().toString()
    sizes = {r["label"]: r["n"] for r in df.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    got = out.where("is_test").groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()
    assert {r["label"]: r["n"] for r in got} == {k: n // 5 for k, n in sizes.items()}


def test_a_fold_is_scored_once(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("array<double>")
    def scored(i):
        calls.add(1)
        p = (i * 37 % 100) / 100
        return [p, (1 - p) / 2, (1 - p) / 2]

    rows = spark.range(0, 120, 1, 2).select((F.col("id") % 3).cast("int").alias("label"), array_to_vector(scored("id")).alias("prob_lr"))
    assert 0 <= M.MacroAuc(3)._evaluate(rows) <= 1
    assert calls.value == 120


def test_vectors_are_mapped_without_an_object_for_each_row(spark):
    x = np.random.default_rng(3).normal(size=(40, 3)) * (np.arange(40)[:, None] % 3 > 0)
    rows = [(i, Vectors.sparse(3, {}) if i % 3 == 0 else Vectors.dense(v)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, ["id", "features"])
    stage = FourierMap.drawn(3, 0.7, n=5)
    out = stage.transform(df.repartition(7))
    assert f"], {PythonEvalType.SQL_SCALAR_ARROW_UDF}" in out._jdf.queryExecution().executedPlan().toString()
    w, b = np.array(stage.getOrDefault("weights")).reshape(3, 5), np.array(stage.getOrDefault("shift"))
    got = {r["id"]: r["fourier"].toArray() for r in out.collect()}
    assert len(got) == 40 and all(np.allclose(got[i], np.sqrt(0.4) * np.cos(v @ w + b), rtol=0, atol=1e-12) for i, v in enumerate(x))
    assert stage.transform(df.where("id < 0")).collect() == []


def test_vectors_of_different_lengths_are_refused(spark):
    mixed = spark.createDataFrame([(Vectors.dense(1.0, 2.0, 3.0),), (Vectors.dense(1.0, 2.0),), (Vectors.dense(1.0, 2.0, 3.0, 4.0),)], ["features"]).coalesce(1)
    with pytest.raises(Exception, match="different lengths"):
        FourierMap.drawn(3, 0.7, n=5).transform(mixed).collect()
