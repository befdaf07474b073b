"""Fits a kernel machine with probabilities by a cascade of local dual solvers.

Training rows are dealt to shards. Each shard finds its own support vectors; groups of shards then merge theirs and solve again
from the multipliers they had, as long as a merged group has at most ``GROUP`` rows. Last, every group tests all rows of its shards
against its own machine, takes in those that break the optimality conditions, and solves until none is left: in one task if its shards
have at most ``LOCAL_ROWS`` rows, else its shards are tested by many tasks and the worst rows go to the one that solves. Groups that
cannot merge (noisy labels make nearly every row a support vector) stay side by side, and the decision is their mean weighted
by rows. Classes are taken one against the rest; an intercept is part of the kernel, so the dual has box constraints only.
Probabilities come from one joint sigmoid of the decisions, fitted on held-back rows.

A machine is fitted on all rows but the held-back ones (``max_rows``, chosen by the hash of their key, if that is given), and the sigmoid
on every held-back row. No task holds more than a group's shards; more than ``MODEL_ROWS`` support vectors are kept as a table. Noisy
labels make the vectors grow with the rows, and the decisions with rows times vectors. Rows without a label are left out; equal rows count each; without rows all classes get
the same probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from shelfwise.operators import metrics
from shelfwise.operators.blocks import flat
from shelfwise.operators.groups import top_k_per_key
from shelfwise.operators.ordered import fold_of, md5_order
from shelfwise.operators.stages import KERNEL_BLOCK, KernelMachineModel, rbf_kernel, scale_gamma
from shelfwise.session import materialise, scratch_dir

#: Rows of a shard, and of a merged group: what bounds a local kernel matrix (32 MB).
SHARD, GROUP = 1000, 2000
#: Rows that one task tests against its group's machine, and support vectors that a model holds as a parameter.
LOCAL_ROWS, MODEL_ROWS = 16_384, 16_384
STATE = "grp int, id long, x array<double>, y int, c double, alpha array<double>, residual double"


def violation(g: np.ndarray, alpha: np.ndarray, c: np.ndarray) -> np.ndarray:
    """How far each multiplier is from its optimality condition; ``g`` is the dual's gradient."""
    return np.where(g < 0, np.where(alpha < c, -g, 0.0), np.where(alpha > 0, g, 0.0))


def solve(k: np.ndarray, y: np.ndarray, c: np.ndarray, alpha: np.ndarray, tolerance: float) -> tuple[np.ndarray, float]:
    """Multipliers in [0, c] that minimise half of a'Qa less their sum, Q being y y' times the kernel matrix, and the worst violation.

    Moves, one by one, the multipliers that violate most to their best values; then all that lie between their bounds go together
    towards the least point of theirs, as far as the bounds allow. Ends when none violates by more than ``tolerance``, or after 60 rounds.
    """
    alpha, q = np.clip(alpha, 0.0, c), k * np.outer(y, y)
    g = q @ alpha - 1.0
    for _ in range(60):
        for _ in range(2 * len(y)):
            v = violation(g, alpha, c)
            i = int(v.argmax())
            if v[i] <= tolerance:
                return alpha, float(v[i])
            best = min(max(alpha[i] - g[i] / q[i, i], 0.0), c[i])
            g += (best - alpha[i]) * q[i]
            alpha[i] = best
        for _ in range(10):
            free = np.flatnonzero((alpha > 0) & (alpha < c))
            if not len(free):
                break
            move = np.linalg.solve(q[np.ix_(free, free)] + 1e-9 * np.eye(len(free)), -g[free])
            with np.errstate(divide="ignore", invalid="ignore"):
                reach = np.where(move > 0, (c[free] - alpha[free]) / move, np.where(move < 0, -alpha[free] / move, np.inf))
            t = min(1.0, float(reach.min()))
            alpha[free] = np.clip(alpha[free] + t * move, 0.0, c[free])
            stop = free[reach <= t * (1 + 1e-12)]
            alpha[stop] = np.where(move[reach <= t * (1 + 1e-12)] > 0, c[stop], 0.0)
            g = q @ alpha - 1.0
            if t == 1.0:
                break
    return alpha, float(violation(g, alpha, c).max(initial=0.0))


def _solved(pdf: pd.DataFrame, classes: int, gamma: float, tolerance: float) -> tuple[np.ndarray, float]:
    """Multipliers (rows, classes) of all one-against-rest problems on these rows."""
    x, label, c = np.stack(pdf.x.to_numpy()), pdf.y.to_numpy(), pdf.c.to_numpy()
    alpha = np.stack(pdf.alpha.to_numpy()).astype(float)
    kernel, worst = rbf_kernel(x, x, gamma), 0.0
    for j in range(classes):
        alpha[:, j], left = solve(kernel, np.where(label == j, 1.0, -1.0), c, alpha[:, j], tolerance)
        worst = max(worst, left)
    return alpha, worst


def _support(pdf: pd.DataFrame, alpha: np.ndarray, worst: float) -> pd.DataFrame:
    out = pdf.assign(alpha=list(alpha), residual=worst)
    return out[(alpha > 0).any(axis=1)]


def _merge(classes: int, gamma: float, tolerance: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", ignore_index=True)
        return _support(pdf, *_solved(pdf, classes, gamma, tolerance))

    return run


def _signs(y: pd.Series, classes: int) -> np.ndarray:
    return np.where(y.to_numpy()[:, None] == np.arange(classes), 1.0, -1.0)


def _outside(rows: pd.DataFrame, held: pd.DataFrame, classes: int, gamma: float) -> np.ndarray:
    """How far each row that is not held breaks the optimality conditions of the machine of the held ones."""
    coef = np.stack(held.alpha.to_numpy()) * _signs(held.y, classes)
    short = 1.0 - _signs(rows.y, classes) * KernelMachineModel.decide(np.stack(rows.x.to_numpy()), np.stack(held.x.to_numpy()), coef, gamma)
    return np.where(rows.id.isin(held.id), 0.0, short.max(axis=1))


def _settle(classes: int, gamma: float, tolerance: float):
    def run(rows: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        rows, held = rows.sort_values("id", ignore_index=True), held.sort_values("id", ignore_index=True)
        while True:
            alpha, worst = _solved(held, classes, gamma, tolerance)
            held = held.assign(alpha=list(alpha))
            outside = _outside(rows, held, classes, gamma)
            breach = np.argsort(-outside, kind="stable")[:int((outside > tolerance).sum())]
            room = GROUP - len(held)
            if not len(breach) or room <= 0:
                return _support(held, alpha, max(worst, float(outside.max(initial=0.0))))
            held = pd.concat([held, rows.iloc[breach[:room]]], ignore_index=True)

    return run


def _settle_wide(members: DataFrame, held: DataFrame, classes: int, gamma: float, tolerance: float) -> DataFrame:
    """What ``_settle`` does, for groups of too many rows for a task; ``members`` has the column ``shard``, whose rows a task tests."""
    def solved(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", ignore_index=True)
        alpha, worst = _solved(pdf, classes, gamma, tolerance)
        return pdf.assign(alpha=list(alpha), residual=worst)

    def tested(rows: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = rows.drop(columns="shard").assign(residual=_outside(rows, held, classes, gamma)) if len(rows) and len(held) else rows.drop(columns="shard")
        return out[out.residual > tolerance]

    shards, done = materialise(members.select("grp", "shard").distinct(), "kernel_shards"), None
    while True:
        held = materialise(held.groupBy("grp").applyInPandas(solved, STATE), "kernel_wide")
        each = held.join(shards, "grp").groupBy("shard")
        breach = materialise(members.groupBy("shard").cogroup(each).applyInPandas(tested, STATE), "kernel_breach")
        # One row per group.
        room = {r["grp"]: GROUP - r["count"] for r in held.groupBy("grp").count().collect()}
        worst = {r["grp"]: r["w"] for r in breach.groupBy("grp").agg(F.max("residual").alias("w")).collect()}
        more = [g for g in room if g in worst and room[g] > 0]
        ended = held.where(~F.col("grp").isin(more)).where(F.exists("alpha", lambda a: a > 0))
        rest = F.coalesce(F.element_at(F.create_map(F.lit(-1), F.lit(0.0), *[F.lit(v) for g in worst if g not in more for v in (g, worst[g])]), F.col("grp")), F.lit(0.0))
        ended = ended.withColumn("residual", F.greatest("residual", rest))
        done = ended if done is None else done.unionByName(ended)
        if not more:
            return done
        space = F.element_at(F.create_map(*[F.lit(v) for g in more for v in (g, room[g])]), F.col("grp"))
        taken = top_k_per_key(breach.where(F.col("grp").isin(more)), ["grp"], [F.desc("residual"), "id"], GROUP, rank="_r").where(F.col("_r") <= space).drop("_r")
        held = held.where(F.col("grp").isin(more)).unionByName(taken)
        members = members.where(F.col("grp").isin(more))


def _merged(sizes: dict[int, int]) -> dict[int, int]:
    """The group that each group joins: neighbours merge while they have at most ``GROUP`` rows together."""
    out, now, held = {}, -1, GROUP + 1
    for g in sorted(sizes):
        if held + sizes[g] > GROUP:
            now, held = now + 1, 0
        out[g], held = now, held + sizes[g]
    return out


def _moved(df: DataFrame, into: dict[int, int]) -> DataFrame:
    # One row per shard.
    table = df.sparkSession.createDataFrame(list(into.items()), "grp int, _into int")
    return df.join(F.broadcast(table), "grp", "left").withColumn("grp", F.col("_into")).drop("_into")


def _placed(rows: DataFrame, order: list) -> DataFrame:
    """``id``: the place of a row in the order. The sort is by ranges; only the numbers of rows of its parts meet."""
    at = F.monotonically_increasing_id()
    held = materialise(rows.orderBy(*order).select(at.alias("at"), *rows.columns), "kernel_order")
    part, first, ends = F.shiftright("at", 33), 0, []
    for r in sorted(held.groupBy(part.alias("part")).count().collect()):
        ends.append((r["part"], first))
        first += r["count"]
    table = held.sparkSession.createDataFrame(ends, "_part long, _first long")
    return held.join(F.broadcast(table), part == F.col("_part")).withColumn("id", F.col("_first") + F.col("at").bitwiseAND((1 << 33) - 1)).drop("_part", "_first", "at")


def _kept(last: DataFrame, classes: int, share: dict[int, float]) -> str:
    """The folder of the support vectors and their weights as blocks of numbers."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            grp, y = b.column(0).to_numpy(), b.column(1).to_numpy()
            if not len(y):
                continue
            x, coef = flat(b.column(2)), flat(b.column(3)) * np.where(y[:, None] == np.arange(classes), 1.0, -1.0) * np.array([share[g] for g in grp])[:, None]
            for a in range(0, len(y), KERNEL_BLOCK):
                yield pa.RecordBatch.from_pydict({"x": [x[a:a + KERNEL_BLOCK].tobytes()], "coef": [coef[a:a + KERNEL_BLOCK].tobytes()]})

    path = scratch_dir(last.sparkSession, "kernel_vectors")
    last.select("grp", "y", "x", "alpha").mapInArrow(pack, "x binary, coef binary").write.option("parquet.block.size", 16 << 20).parquet(path)
    return path


def _sigmoid(scored: DataFrame, classes: int) -> tuple[list[float], list[float]]:
    """Weights (classes, classes) and offsets from held-back decisions (column ``f``) to log odds, one joint sigmoid for all classes.

    Targets are kept off 0 and 1 by one row that each class is thought to have besides (Platt, 1999).
    """
    counts = {r["y"]: r["n"] for r in scored.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return np.eye(classes).ravel().tolist(), [0.0] * classes
    # One entry per class.
    n = F.element_at(F.create_map(*[F.lit(v) for pair in counts.items() for v in pair]), F.col("y"))
    targets = F.array(*[F.struct(F.lit(float(j)).alias("label"), (F.when(F.col("y") == j, n + 1.0).otherwise(1.0) / (n + classes)).alias("w")) for j in range(classes)])
    rows = scored.select(array_to_vector("f").alias("v"), F.explode(targets).alias("e")).select("v", "e.label", "e.w")
    fitted = LogisticRegression(featuresCol="v", labelCol="label", weightCol="w", family="multinomial").fit(rows)
    return fitted.coefficientMatrix.toArray().ravel().tolist(), fitted.interceptVector.toArray().tolist()


def fit(train: DataFrame, classes: int, key: str = "appid", cost: float = 10.0, gamma: float | None = None, name: str = "kernel",
        held_back: int = 5, max_rows: int | None = None, tolerance: float = 1e-3) -> KernelMachineModel:
    """M6: rows with ``features``, ``label`` (0, 1, ...) and ``key``; classes weigh alike; one row in ``held_back`` fits the sigmoid.

    ``gamma`` is 1 / (dimensions * variance of all entries) unless given.
    """
    width, found = scale_gamma(train)
    gamma = found if gamma is None else gamma
    named = train.where("label IS NOT NULL").select(F.col(key).alias("key"), vector_to_array("features").alias("x"), F.col("label").cast("int").alias("y"))
    dealt = metrics.class_weights(named.withColumn("held", fold_of(F.col("key"), held_back, seed=13) == 0), "y", "c")
    rows = materialise(dealt.withColumn("c", F.col("c") * cost), "kernel_rows")
    order = [md5_order(F.col("key"), 13), F.col("x"), F.col("y")]
    chosen = rows.where(~F.col("held")).select("key", "x", "y", "c")
    if max_rows is not None:
        chosen = chosen.orderBy(*order).limit(max_rows)
    fitted = _placed(chosen, order).drop("key")
    n = fitted.count()
    shards = max(1, -(-n // SHARD))
    start = fitted.select((F.col("id") % shards).cast("int").alias("grp"), "id", "x", "y", "c", F.array_repeat(F.lit(0.0), classes).alias("alpha"), F.lit(0.0).alias("residual"))
    step = _merge(classes, gamma, tolerance)
    state = materialise(start.groupBy("grp").applyInPandas(step, STATE), "kernel")
    levels, home = 1, {s: s for s in range(shards)}
    while True:
        sizes = {r["grp"]: r["count"] for r in state.groupBy("grp").count().collect()}
        into = _merged(sizes)
        home = {s: into[g] for s, g in home.items() if g in into}
        if len(set(into.values())) == len(into):
            break
        state = materialise(_moved(state, into).groupBy("grp").applyInPandas(step, STATE), "kernel")
        levels += 1
    vectors, coef, worst, table = np.zeros((0, width)), np.zeros((0, classes)), 0.0, ""
    if sizes:
        members = _moved(start.withColumn("shard", F.col("grp")), home)
        counts = {r["grp"]: r["count"] for r in members.groupBy("grp").count().collect()}
        share = {g: k / n for g, k in counts.items()}
        wide = F.col("grp").isin([g for g, k in counts.items() if k > LOCAL_ROWS])
        moved = _moved(state, into)
        last = members.where(~wide).drop("shard").groupBy("grp").cogroup(moved.where(~wide).groupBy("grp")).applyInPandas(_settle(classes, gamma, tolerance), STATE)
        if max(counts.values()) > LOCAL_ROWS:
            last = last.unionByName(_settle_wide(members.where(wide), moved.where(wide), classes, gamma, tolerance))
        last = materialise(last, "kernel_last")
        found = last.agg(F.count(F.lit(1)).alias("n"), F.max("residual").alias("worst")).first()
        worst = float(found["worst"])
        if found["n"] > MODEL_ROWS:
            table = _kept(last, classes, share)
        else:
            pdf = last.toPandas().sort_values(["grp", "id"])
            vectors = np.stack(pdf.x.to_numpy())
            coef = np.stack(pdf.alpha.to_numpy()) * _signs(pdf.y, classes) * pdf.grp.map(share).to_numpy()[:, None]
    model = KernelMachineModel(vectors=vectors.ravel().tolist(), coefs=coef.ravel().tolist(), classes=classes, gamma=float(gamma), slopes=np.eye(classes).ravel().tolist(),
                               offsets=[0.0] * classes, name=name, residual=worst, groups=len(set(home.values())), iterations=levels, stopped=worst <= tolerance, table=table)
    held = rows.where("held").select(array_to_vector("x").alias("features"), "y")
    slopes, offsets = _sigmoid(materialise(model.decisions(held, "f").select("y", "f"), "kernel_held"), classes)
    return model._set(slopes=slopes, offsets=offsets)
