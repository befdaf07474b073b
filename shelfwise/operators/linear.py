"""Fits a multinomial logistic regression on Fourier features that are computed again at every pass, not stored.

Spark's own solver keeps all features: of a wide map that is many times the size of the rows. Here the rows lie in blocks of numbers;
a pass is one job whose tasks map a block at a time and sum loss and gradient. The steps are those of Spark's solver: L-BFGS with
strong Wolfe line search on centred and scaled features, an L2 penalty on the unscaled weights, and the same ends.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseMatrix, Vectors
from pyspark.sql import DataFrame, functions as F

from shelfwise.operators import blocks
from shelfwise.operators.stages import FourierMap

#: Steps that the solver remembers, and values of the loss that must have ceased to fall.
MEMORY, VALUES = 10, 20
#: Up to so many rows Spark's solver keeps the features, 20 GB at 256 of them; beyond that they would fill the disks.
KEPT_ROWS = 10_000_000
Loss = Callable[[np.ndarray], tuple[float, np.ndarray]]


class NoStep(Exception):
    """No step along this direction meets the conditions."""


def _between(l: tuple, r: tuple) -> float:
    """Least point of the cubic through two (t, value, slope), off the ends."""
    d1 = l[2] + r[2] - 3 * (l[1] - r[1]) / (l[0] - r[0])
    d2 = np.sqrt(max(d1 * d1 - l[2] * r[2], 0.0))
    t = r[0] - (r[0] - l[0]) * (r[2] + d2 - d1) / (r[2] - l[2] + 2 * d2)
    return float(np.clip(t, l[0] + 0.1 * (r[0] - l[0]), l[0] + 0.9 * (r[0] - l[0])))


def line_search(phi: Callable[[float], tuple], t: float) -> float:
    """A step that meets the strong Wolfe conditions; ``phi`` gives (t, value, slope)."""
    start = low = phi(0.0)
    _, f0, s0 = start
    if s0 > 0:
        raise NoStep

    def zoom(low: tuple, high: tuple) -> float:
        for _ in range(10):
            c = phi(_between(high, low) if low[0] > high[0] else _between(low, high))
            if c[1] > f0 + 1e-4 * c[0] * s0 or c[1] >= low[1]:
                high = c
                continue
            if abs(c[2]) <= 0.9 * abs(s0):
                return c[0]
            if c[2] * (high[0] - low[0]) >= 0:
                high = low
            low = c
        raise NoStep

    for i in range(10):
        c = phi(t)
        if not np.isfinite(c[1]):
            t /= 2
            continue
        if c[1] > f0 + 1e-4 * t * s0 or (c[1] >= low[1] and i):
            return zoom(low, c)
        if abs(c[2]) <= 0.9 * abs(s0):
            return c[0]
        if c[2] >= 0:
            return zoom(c, low)
        low, t = c, t * 1.5
    raise NoStep


def _direction(g: np.ndarray, memory: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    d, shares = g.copy(), []
    for s, y in memory:
        shares.append((s @ d) / (s @ y))
        d -= shares[-1] * y
    if memory:
        s, y = memory[0]
        d *= (s @ y) / (y @ y)
    for (s, y), a in zip(memory[::-1], shares[::-1]):
        d += (a - (y @ d) / (s @ y)) * s
    return -d


def minimise(loss: Loss, x: np.ndarray, max_iter: int, tolerance: float) -> tuple[np.ndarray, int]:
    """The least point, and the steps taken."""
    last: list = [None, None]

    def at(x: np.ndarray) -> tuple[float, np.ndarray]:
        if last[0] is None or not np.array_equal(last[0], x):
            last[0], last[1] = x, loss(x)
        return last[1]

    f, g = at(x)
    first, seen, memory, took, failed = f, [np.inf], [], 0, False
    while took < max_iter and np.linalg.norm(g) > max(tolerance * f, 1e-8) and (len(seen) < 2 or abs(f - max(seen)) > tolerance * first):
        d = _direction(g, memory)

        def phi(t: float) -> tuple:
            v, dv = at(x + t * d)
            return t, v, float(dv @ d)

        try:
            t = line_search(phi, 1.0 if took else 1.0 / np.linalg.norm(d))
            if t * np.linalg.norm(g) < 1e-10:
                raise NoStep
        except NoStep:
            if failed:
                break
            failed, memory = True, []
            continue
        new = x + t * d
        f, after = at(new)
        memory = [(new - x, after - g), *memory][:MEMORY]
        x, g, took, failed = new, after, took + 1, False
        seen = [*seen, f][-VALUES:]
    return x, took


def stored_rows(df: DataFrame, weight: str) -> DataFrame:
    """(n, x, y, w): rows as blocks of numbers."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            x, y, w = blocks.flat(b.column(0)), b.column(1).to_numpy(), b.column(2).to_numpy()
            for p in blocks.pieces(len(y)):
                yield pa.RecordBatch.from_pydict({"n": pa.array([len(y[p])], pa.int32()), "x": [blocks.squeezed(x[p])], "y": [y[p].tobytes()], "w": [w[p].tobytes()]})

    rows = df.select(vector_to_array("features"), F.col("label").cast("int"), F.col(weight).cast("double"))
    return blocks.written(rows.mapInArrow(pack, "n int, x binary, y binary, w binary"), "linear")


def fit(df: DataFrame, fourier: FourierMap, estimator: LogisticRegression) -> LogisticRegressionModel:
    """What ``estimator`` fits on the Fourier features of the rows; needs a weight column and two labels or more."""
    shift = np.array(fourier.getOrDefault(fourier.shift))
    freq = np.array(fourier.getOrDefault(fourier.weights)).reshape(-1, len(shift))
    width, n_out = freq.shape
    data = stored_rows(df, estimator.getWeightCol())

    def summed(size: int, of: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum of a vector of ``size`` numbers over all blocks, as ``of`` gives it for a block's features, labels and weights."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for b in batches:
                for n, x, y, w in zip(b.column(0).to_pylist(), b.column(1), b.column(2), b.column(3)):
                    x, y, w = blocks.opened(x.as_buffer(), n, width), np.frombuffer(y.as_buffer(), np.int32), np.frombuffer(w.as_buffer())
                    for a in range(0, n, 256):
                        total += of(fourier_of(x[a:a + 256]), y[a:a + 256], w[a:a + 256])
            yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(size), pa.int32()), "v": total})

        # As many rows as the vector has numbers.
        got = np.zeros(size)
        for r in data.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
            got[r["i"]] = r["v"]
        return got

    fourier_of = FourierMap.mapped(freq, shift)
    classes = int(df.agg(F.max("label")).first()[0]) + 1

    def moments(z: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
        return np.concatenate([w @ z, w @ (z * z), np.bincount(y, w, classes), [w.sum(), w @ w]])

    got = summed(2 * n_out + classes + 2, moments)
    weight, squares = got[-2:]
    mean = got[:n_out] / weight
    var = (got[n_out:2 * n_out] - weight * mean * mean) / (weight - squares / weight)
    dev = np.sqrt(np.maximum(var, 0.0))
    inverse = np.divide(1.0, dev, out=np.zeros(n_out), where=dev > 0)
    centre, penalty = mean * inverse, estimator.getRegParam() * inverse * inverse

    def loss(flat: np.ndarray) -> tuple[float, np.ndarray]:
        beta, start = flat[:-classes].reshape(classes, n_out), flat[-classes:]
        slopes, offsets = (beta * inverse).T.copy(), start - beta @ centre

        def part(z: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
            m = z @ slopes + offsets
            m -= m.max(axis=1, keepdims=True)
            e = np.exp(m)
            s, at = e.sum(axis=1), np.arange(len(y))
            d = e / s[:, None]
            d[at, y] -= 1.0
            d *= w[:, None]
            return np.concatenate([(d.T @ z).ravel(), d.sum(axis=0), [w @ (np.log(s) - m[at, y])]])

        got = summed(len(flat) + 1, part) / weight
        by, sums = got[:n_out * classes].reshape(classes, n_out), got[n_out * classes:-1]
        g = by * inverse - np.outer(sums, centre) + penalty * beta
        return float(got[-1] + 0.5 * (penalty * beta * beta).sum()), np.concatenate([g.ravel(), sums])

    at_first = np.log1p(got[2 * n_out:-2])
    x0 = np.concatenate([np.zeros(n_out * classes), at_first - at_first.mean()])
    best, took = minimise(loss, x0, estimator.getMaxIter(), estimator.getTol())
    beta = best[:-classes].reshape(classes, n_out)
    start = best[-classes:] - beta @ centre
    spark = df.sparkSession
    made = spark._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        estimator.uid, _py2java(spark.sparkContext, DenseMatrix(classes, n_out, (beta * inverse).ravel(order="F"))),
        _py2java(spark.sparkContext, Vectors.dense(start - start.mean())), classes, True)
    model = estimator._copyValues(LogisticRegressionModel(made))
    model.took = took, took < estimator.getMaxIter()
    return model
