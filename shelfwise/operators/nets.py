"""Fits a net of ReLU layers on all cores by local mini-batches and averaged weights, with early stopping.

Training rows lie in compressed blocks of numbers in the shared folder (``blocks``), of which a task opens one at a time. An epoch
is one job: each task takes the weights of the last epoch, goes through its blocks in mini-batches, and sends the weights that it
reached, weighted by its rows; Spark sums them weight by weight. In the same job the held-back blocks report the loss of the weights that came in. The fit ends when that has
not fallen for ``patience`` epochs, and the best weights are kept. The driver holds one set of weights.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from shelfwise.operators import blocks as B
from shelfwise.operators.ordered import fold_of
from shelfwise.operators.stages import ReluNetModel

#: Rows that keep one task busy, and that it holds at a time; more rows make more tasks, up to ``TASKS``.
TASK_ROWS = 100_000
#: Of more tasks' weights the mean gains little, while an epoch of larger tasks takes more steps: large tables need fewer epochs.
TASKS = 24
BATCH = 200
#: Mini-batches of a task between two averages, at least.
STEPS = 50


def unpacked(flat: np.ndarray, layers: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    net, at = [], 0
    for a, b in zip(layers, layers[1:]):
        net.append((flat[at:at + a * b].reshape(a, b), flat[at + a * b:at + a * b + b]))
        at += a * b + b
    return net


def first_weights(layers: Sequence[int], seed: int) -> np.ndarray:
    """Uniform in +-sqrt(6 / (inputs + outputs)) of each layer."""
    rng = np.random.default_rng(seed)
    parts = []
    for a, b in zip(layers, layers[1:]):
        reach = np.sqrt(6.0 / (a + b))
        parts.append(rng.uniform(-reach, reach, a * b + b))
    return np.concatenate(parts)


def _forward(net: list, x: np.ndarray) -> list[np.ndarray]:
    out = [x]  # what each layer gives on
    for i, (w, b) in enumerate(net):
        z = out[-1] @ w
        z += b
        out.append(np.maximum(z, 0.0, out=z) if i < len(net) - 1 else z)
    return out


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    e /= e.sum(axis=1, keepdims=True)
    return e


def probabilities(net: list, x: np.ndarray) -> np.ndarray:
    return _softmax(_forward(net, x)[-1])


def loss(net: list, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Log loss of each row."""
    return -np.log(np.maximum(probabilities(net, x)[np.arange(len(y)), y], 1e-15))


def gradient(net: list, x: np.ndarray, y: np.ndarray, penalty: float) -> np.ndarray:
    """Of the mean log loss and penalty / 2 times the squared weights, flat like the weights."""
    acts = _forward(net, x)
    d = _softmax(acts[-1])
    d[np.arange(len(y)), y] -= 1.0
    d /= len(y)
    parts = []
    for i in range(len(net) - 1, -1, -1):
        w, _ = net[i]
        parts.append(np.concatenate([(acts[i].T @ d + penalty / len(y) * w).ravel(), d.sum(axis=0)]))
        if i:
            d = d @ w.T
            d *= acts[i] > 0
    return np.concatenate(parts[::-1])


def local_steps(flat: np.ndarray, layers: Sequence[int], x: np.ndarray, y: np.ndarray, seed: int, rate: float, penalty: float) -> np.ndarray:
    """Adam over shuffled mini-batches: all rows once, and again until there are ``STEPS`` of them."""
    walk = Walk(flat, layers, seed, rate, penalty)
    walk.over(x, y)
    return walk.flat


class Walk:
    """The weights of a task and the state of Adam while it goes through its rows, piece by piece."""

    def __init__(self, flat: np.ndarray, layers: Sequence[int], seed: int, rate: float, penalty: float):
        self.flat, self.layers, self.rate, self.penalty = flat.copy(), layers, rate, penalty
        self.rng, self.m, self.v, self.t, self.rows = np.random.default_rng(seed), np.zeros_like(flat), np.zeros_like(flat), 0, 0

    def over(self, x: np.ndarray, y: np.ndarray) -> None:
        """All rows of a piece once; those of the first piece again until there are ``STEPS`` mini-batches."""
        self.rows += len(y)
        more = True
        while more:
            order = self.rng.permutation(len(y))
            for a in range(0, len(y), BATCH):
                rows = order[a:a + BATCH]
                g = gradient(unpacked(self.flat, self.layers), x[rows], y[rows], self.penalty)
                self.t += 1
                self.m *= 0.9
                self.m += 0.1 * g
                self.v *= 0.999
                self.v += 0.001 * g * g
                reach = self.v / (1 - 0.999 ** self.t)
                np.sqrt(reach, out=reach)
                reach += 1e-8
                move = self.m / (1 - 0.9 ** self.t)
                move *= self.rate
                move /= reach
                self.flat -= move
            more = self.t < STEPS


def blocks(train: DataFrame, key: str, share: int) -> DataFrame:
    """(task, held, n, x, y): rows as blocks of numbers; one row in ``share`` is held back, by the hash of its key."""
    held = fold_of(F.col(key), share, seed=11) == 0
    rows = train.select(held.alias("held"), vector_to_array("features").alias("x"), F.col("label").cast("int").alias("y"))
    tasks = max(1, min(TASKS, -(-train.count() // TASK_ROWS)))
    dealt = rows.repartition(tasks)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        for batch in batches:
            if not len(batch):
                continue
            back, x, y = batch.column(0).to_numpy(zero_copy_only=False), B.flat(batch.column(1)), batch.column(2).to_numpy()
            for held_back in (False, True):
                rows = np.flatnonzero(back == held_back)
                for p in B.pieces(len(rows)):
                    some = rows[p]
                    yield pa.RecordBatch.from_pydict({
                        "task": pa.array([task], pa.int32()), "held": [held_back], "n": pa.array([len(some)], pa.int32()),
                        "x": [B.squeezed(x[some])], "y": [y[some].astype(np.int32).tobytes()]})

    return B.written(dealt.mapInArrow(pack, "task int, held boolean, n int, x binary, y binary"), "net")


def sums(i: Sequence[int], v: Sequence[float]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"i": pa.array(i, pa.int32()), "v": pa.array(v, pa.float64())})


def fit(train: DataFrame, classes: int, key: str = "appid", hidden: Sequence[int] = (64, 32), name: str = "mlp", max_epochs: int = 600,
        patience: int = 10, tolerance: float = 1e-4, rate: float = 1e-3, penalty: float = 1e-4, held_back: int = 10, seed: int = 42) -> ReluNetModel:
    """M7: rows with ``features``, ``label`` (0, 1, ...) and ``key``; one row in ``held_back`` only tells when to stop.

    Without held-back rows the fit runs to its limit. Rows are not weighted.
    """
    width = train.select(F.max(F.size(vector_to_array("features")))).first()[0]
    layers = [width or 0, *hidden, classes]
    data = blocks(train, key, held_back)
    flat = best = first_weights(layers, seed)
    least, since, epoch = np.inf, 0, 0
    size = len(flat)

    def step(now: np.ndarray, epoch: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            xs, ys, total, seen, held_rows, walk = [], [], 0.0, 0, 0, None

            def go() -> None:
                walk.over(np.concatenate(xs), np.concatenate(ys))
                xs.clear()
                ys.clear()

            for batch in batches:
                for task, held, n, x, y in zip(*(batch.column(c).to_pylist() for c in ("task", "held", "n")), batch.column("x"), batch.column("y")):
                    x, y = B.opened(x.as_buffer(), n, width), np.frombuffer(y.as_buffer(), np.int32)
                    if held:
                        total, seen = total + float(loss(unpacked(now, layers), x, y).sum()), seen + n
                        continue
                    walk = walk or Walk(now, layers, seed + 7919 * epoch + task, rate, penalty)
                    if xs and held_rows + n > TASK_ROWS:
                        go()
                        held_rows = 0
                    xs.append(x)
                    ys.append(y)
                    held_rows += n
            if xs:
                go()
            if walk:
                yield sums(range(size + 1), [*(walk.flat * walk.rows), float(walk.rows)])
            yield sums([size + 1, size + 2], [total, float(seen)])

        return run

    while epoch < max_epochs and since < patience and width:
        sent = data.mapInArrow(step(flat, epoch), "i int, v double").groupBy("i").agg(F.sum("v").alias("v"))
        # As many rows as the net has weights, and three.
        got = np.zeros(size + 3)
        for r in sent.collect():
            got[r["i"]] = r["v"]
        rows, total, seen = got[size:]
        if seen:
            since = 0 if total / seen < least - tolerance else since + 1
            if total / seen < least:
                least, best = total / seen, flat
        else:
            best = flat
        if not rows:
            break
        flat = got[:size] / rows
        epoch += 1
    if least == np.inf:
        best = flat
    return ReluNetModel(layers=[int(n) for n in layers], weights=best.tolist(), name=name, iterations=epoch, stopped=epoch < max_epochs)
