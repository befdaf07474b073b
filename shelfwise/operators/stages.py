"""Transformers of our own, with parameters that Spark ML pipelines write and read like those of any other stage."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import DataFrame, functions as F

from shelfwise.operators.blocks import flat
from shelfwise.session import materialise


def _param(name: str, doc: str, kind: Callable) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=kind)


def _map_vectors(df: DataFrame, col: str, out: str, fn: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """``out`` is the vector that ``fn`` makes of each row of a (rows, width) matrix.

    Batches stay flat Arrow buffers on both ways; an object for each row takes several times as long as the map itself.
    """
    @F.arrow_udf("array<double>")
    def apply(v: pa.Array) -> pa.Array:
        if not len(v):
            return pa.array([], pa.list_(pa.float64()))
        widths = np.diff(v.offsets.to_numpy())
        if v.null_count or (widths != widths[0]).any():
            raise ValueError("vectors of different lengths")
        rows = np.asarray(fn(v.flatten().to_numpy().reshape(len(v), widths[0])), dtype=np.float64)
        ends = pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32())
        return pa.ListArray.from_arrays(ends, pa.array(rows.ravel()))

    return df.withColumn(out, array_to_vector(apply(vector_to_array(col))))


def scale_gamma(df: DataFrame, col: str = "features") -> tuple[int, float]:
    """Dimensions, and 1 / (dimensions * variance of all entries); 1 where nothing varies."""
    v = vector_to_array(col)
    per = df.select(F.size(v).alias("d"), F.aggregate(v, F.lit(0.0), lambda a, x: a + x).alias("s"),
                    F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x).alias("q"))
    r = per.agg(F.max("d").alias("d"), F.sum("d").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).first()
    var = r["q"] / r["n"] - (r["s"] / r["n"]) ** 2 if r["n"] else 0.0
    return r["d"] or 0, 1.0 / (r["d"] * var) if var > 0 else 1.0


def rbf_kernel(a: np.ndarray, b: np.ndarray, gamma: float) -> np.ndarray:
    """RBF kernel plus one, which stands for the intercept."""
    d = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2.0 * a @ b.T
    return np.exp(-gamma * np.maximum(d, 0.0)) + 1.0


#: Series of sin(pi r) / r in the square of r; exact to the last digits for half a turn.
SINE = [(-1) ** i * np.pi ** (2 * i + 1) / math.factorial(2 * i + 1) for i in range(11)]


class FourierMap(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """M6: random Fourier features of the RBF kernel (Rahimi and Recht, 2007).

    A linear model on them approximates a kernel classifier and stays linear in the rows.
    """

    weights = _param("weights", "frequencies, row by row", TypeConverters.toListFloat)
    shift = _param("shift", "phases", TypeConverters.toListFloat)
    inputCol = _param("inputCol", "vector column", TypeConverters.toString)
    outputCol = _param("outputCol", "vector column to add", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, weights=None, shift=None, inputCol="features", outputCol="fourier"):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        self._setDefault(inputCol="features", outputCol="fourier")

    @classmethod
    def drawn(cls, dims: int, gamma: float, n: int = 256, seed: int = 42) -> FourierMap:
        rng = np.random.default_rng(seed)
        weights = rng.normal(0.0, np.sqrt(2.0 * gamma), (dims, n))
        return cls(weights=weights.ravel().tolist(), shift=rng.uniform(0.0, 2.0 * np.pi, n).tolist())

    @classmethod
    def fit(cls, df: DataFrame, n: int = 256, seed: int = 42) -> FourierMap:
        """gamma is 1 / (dimensions * variance of all entries)."""
        width, gamma = scale_gamma(df)
        return cls.drawn(width, gamma, n, seed)

    @staticmethod
    def mapped(w: np.ndarray, b: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
        """The map of a (rows, width) matrix by frequencies and phases, a few rows at a time, which stay in the cache."""
        w, b, scale = w / (2 * np.pi), b / (2 * np.pi), np.sqrt(2.0 / len(b))

        def cosines(x: np.ndarray) -> np.ndarray:
            out = np.empty((len(x), len(b)))
            for a in range(0, len(x), 256):
                # cos(2 pi r) = 1 - 2 sin(pi r)^2, r being the rest of a turn; np.cos takes three times as long.
                p = out[a:a + 256]
                r = x[a:a + 256] @ w
                r += b
                r -= np.rint(r)
                q = r * r
                np.multiply(q, SINE[-1], out=p)
                for c in SINE[-2:0:-1]:
                    p += c
                    p *= q
                p += SINE[0]
                p *= r
                p *= p
                p *= -2.0 * scale
                p += scale
            return out

        return cosines

    def _transform(self, dataset: DataFrame) -> DataFrame:
        b = np.array(self.getOrDefault(self.shift))
        w = np.array(self.getOrDefault(self.weights)).reshape(-1, len(b))
        return _map_vectors(dataset, self.getOrDefault(self.inputCol), self.getOrDefault(self.outputCol), self.mapped(w, b))


class ReluNetModel(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """M7: a fitted net of ReLU layers with a softmax output; see ``nets.fit``."""

    layers = _param("layers", "widths from input to output", TypeConverters.toListInt)
    weights = _param("weights", "matrices and biases, layer by layer", TypeConverters.toListFloat)
    name = _param("name", "suffix of the output columns pred_ and prob_", TypeConverters.toString)
    iterations = _param("iterations", "epochs until the fit ended", TypeConverters.toInt)
    stopped = _param("stopped", "whether the fit ended before its limit", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, layers=None, weights=None, name=None, iterations=None, stopped=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        from shelfwise.operators.nets import probabilities, unpacked

        name = self.getOrDefault(self.name)
        net = unpacked(np.array(self.getOrDefault(self.weights)), self.getOrDefault(self.layers))
        out = _map_vectors(dataset, "features", f"prob_{name}", lambda x: probabilities(net, x))
        probs = vector_to_array(f"prob_{name}")
        return out.withColumn(f"pred_{name}", (F.array_position(probs, F.array_max(probs)) - 1).cast("double"))


#: Rows of a block of vectors, and blocks of a task: each pair of blocks is one piece of a kernel matrix (8 MB).
KERNEL_BLOCK, KERNEL_TASK = 1024, 64


class _KernelWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        table = self.instance.getOrDefault("table")
        if table:
            self.sparkSession.read.parquet(table).write.parquet(f"{path}/vectors")


class _KernelReader(DefaultParamsReader):
    def load(self, path: str) -> KernelMachineModel:
        model = super().load(path)
        return model._set(table=f"{path}/vectors") if model.getOrDefault("table") else model


class KernelMachineModel(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """M6: a fitted kernel machine with a joint sigmoid for its classes; see ``kernels.fit``.

    The support vectors are a parameter or, if they are many, blocks of numbers in the shared folder: then blocks of rows meet all
    blocks of vectors, and the sums of a row's pieces are its decisions. Such a model is written and read with its blocks.
    """

    vectors = _param("vectors", "support vectors, row by row", TypeConverters.toListFloat)
    coefs = _param("coefs", "weight of each vector for each class, row by row", TypeConverters.toListFloat)
    classes = _param("classes", "number of classes", TypeConverters.toInt)
    gamma = _param("gamma", "width of the kernel", TypeConverters.toFloat)
    slopes = _param("slopes", "weights of the decisions in the log odds of each class, row by row", TypeConverters.toListFloat)
    offsets = _param("offsets", "offset of each class's log odds", TypeConverters.toListFloat)
    name = _param("name", "suffix of the output columns pred_ and prob_", TypeConverters.toString)
    residual = _param("residual", "worst violation of the optimality conditions over the fitted rows", TypeConverters.toFloat)
    groups = _param("groups", "machines whose mean decides", TypeConverters.toInt)
    iterations = _param("iterations", "levels of the cascade", TypeConverters.toInt)
    stopped = _param("stopped", "whether no row violates by more than the tolerance", TypeConverters.toBoolean)
    table = _param("table", "folder of the blocks of vectors (x, coef), empty if they are a parameter", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, vectors=None, coefs=None, classes=None, gamma=None, slopes=None, offsets=None, name=None, residual=None,
                 groups=None, iterations=None, stopped=None, table=None):
        super().__init__()
        self._setDefault(table="")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def write(self) -> _KernelWriter:
        return _KernelWriter(self)

    @classmethod
    def read(cls) -> _KernelReader:
        return _KernelReader(cls)

    @staticmethod
    def decide(x: np.ndarray, vectors: np.ndarray, coef: np.ndarray, gamma: float) -> np.ndarray:
        """Decisions (rows, classes), a few rows at a time so that a piece of the kernel matrix takes at most 32 MB."""
        step = max(1, (1 << 22) // max(1, len(vectors)))
        return np.concatenate([rbf_kernel(x[a:a + step], vectors, gamma) @ coef for a in range(0, len(x), step)] or [np.zeros((0, coef.shape[1]))])

    def _machine(self):
        coef = np.array(self.getOrDefault(self.coefs)).reshape(-1, self.getOrDefault(self.classes))
        vectors = np.array(self.getOrDefault(self.vectors)).reshape(len(coef), -1) if len(coef) else None
        gamma, decide = self.getOrDefault(self.gamma), self.decide
        return lambda x: decide(x, vectors, coef, gamma) if vectors is not None else np.zeros((len(x), coef.shape[1]))

    def _met(self, dataset: DataFrame, out: str) -> DataFrame:
        """Decisions by a table of vectors; what the tasks hold does not grow with either side."""
        spark, classes, gamma, decide = dataset.sparkSession, self.getOrDefault(self.classes), self.getOrDefault(self.gamma), self.decide
        rows = materialise(dataset.withColumn("_row", F.monotonically_increasing_id()), "kernel_asked")

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                ids, x = b.column(0).to_numpy(), flat(b.column(1))
                for a in range(0, len(ids), KERNEL_BLOCK):
                    yield pa.RecordBatch.from_pydict({"first": [int(ids[a])], "ids": [ids[a:a + KERNEL_BLOCK].tobytes()], "q": [x[a:a + KERNEL_BLOCK].tobytes()]})

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                sums, named = {}, {}
                for first, ids, q, x, coef in zip(*(b.column(i) for i in range(5))):
                    first, c = first.as_py(), np.frombuffer(coef.as_buffer()).reshape(-1, classes)
                    n = len(ids.as_buffer()) // 8
                    f = decide(np.frombuffer(q.as_buffer()).reshape(n, -1), np.frombuffer(x.as_buffer()).reshape(len(c), -1), c, gamma)
                    sums[first] = sums[first] + f if first in sums else f
                    named[first] = ids.as_py()
                yield pa.RecordBatch.from_pydict({"first": pa.array(list(sums), pa.int64()), "ids": pa.array(list(named.values()), pa.binary()),
                                                  "f": pa.array([f.tobytes() for f in sums.values()], pa.binary())})

        def total(t: pa.Table) -> pa.Table:
            f = sum(np.frombuffer(p.as_buffer()) for p in t.column("f"))
            ids = np.frombuffer(t.column("ids")[0].as_buffer(), np.int64)
            ends = pa.array(np.arange(len(ids) + 1) * classes, pa.int32())
            return pa.table({"_row": ids, out: pa.ListArray.from_arrays(ends, pa.array(f))})

        asked = materialise(rows.select("_row", vector_to_array("features")).mapInArrow(pack, "first long, ids binary, q binary"), "kernel_blocks")
        vectors = spark.read.parquet(self.getOrDefault(self.table)).select("x", "coef")
        n, cores = asked.count(), spark.sparkContext.defaultParallelism
        asked, vectors = asked.repartition(max(min(n, cores), -(-n // KERNEL_TASK), 1)), vectors.repartition(max(1, -(-vectors.count() // KERNEL_TASK)))
        sums = asked.crossJoin(vectors).mapInArrow(partial, "first long, ids binary, f binary")
        found = materialise(sums.groupBy("first").applyInArrow(total, f"_row long, `{out}` array<double>"), "kernel_decided")
        return rows.join(found, "_row").drop("_row")

    def decisions(self, dataset: DataFrame, out: str) -> DataFrame:
        """``out`` is the array of the classes' decisions."""
        if self.getOrDefault(self.table):
            return self._met(dataset, out)
        return _map_vectors(dataset, "features", out, self._machine()).withColumn(out, vector_to_array(out))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        name, machine = self.getOrDefault(self.name), self._machine()
        offsets = np.array(self.getOrDefault(self.offsets))
        slopes = np.array(self.getOrDefault(self.slopes)).reshape(len(offsets), -1)

        def softmax(f: np.ndarray) -> np.ndarray:
            z = f @ slopes.T + offsets
            e = np.exp(z - z.max(axis=1, keepdims=True))
            return e / e.sum(axis=1, keepdims=True)

        if self.getOrDefault(self.table):
            met = self._met(dataset, "_f").withColumn("_f", array_to_vector("_f"))
            out = _map_vectors(met, "_f", f"prob_{name}", softmax).drop("_f")
        else:
            out = _map_vectors(dataset, "features", f"prob_{name}", lambda x: softmax(machine(x)))
        probs = vector_to_array(f"prob_{name}")
        return out.withColumn(f"pred_{name}", (F.array_position(probs, F.array_max(probs)) - 1).cast("double"))
