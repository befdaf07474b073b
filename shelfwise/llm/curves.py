"""Approximate nearest neighbours from several shifted Hilbert orderings.

Each ordering projects the vectors on a few random directions, shifts the grid and sorts by the Hilbert key; Spark range-partitions
the sort, so every vector has a rank in every ordering. Candidates of a query are the vectors within a window of ranks around it
in any ordering; windows are read in blocks of ranks, and each block returns its nearest few with true distances. The lists of
all blocks and orderings are merged and ranked.

The window is not a guess: some queries (at most ``calibration``) are searched by brute force over all vectors, and the window is
the smallest rank distance within which ``target`` of their true neighbours lie in some ordering. Where vectors have no
structure that a curve can follow, the window grows to a share of all rows; where they have, it stays small.

Equal vectors are one entry that keeps its ``k`` + 1 smallest ids, so a vector that a third of all rows share costs one row.
Directions and grid come from a sample of at most about ``sample`` vectors; every vector is indexed.

Defined cases: rows with a null id, and vectors that are null, zero, hold null or non-finite components, or have another length
than most, take no part; ties go to the smaller id; with fewer candidates than ``k`` all are returned; repeated rows of one id
and vector count once, and the same id with several vectors counts with its nearest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.llm.common import stored
from shelfwise.operators.groups import top_k_per_key

CURVES = 4
AXES = 6
BITS = 8
BLOCK = 2048


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions on the Hilbert curve of integer grid points (rows), at most 63 bits in all.

    From the highest bit down, each axis either inverts or exchanges the low bits of the first axis; then a Gray code over
    the axes orders the cells of a level.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        high, low = 1 << level, (1 << level) - 1
        for axis in range(n):
            set_ = (x[axis] & high) > 0
            swap = np.where(set_, 0, (x[0] ^ x[axis]) & low)
            x[0] = np.where(set_, x[0] ^ low, x[0] ^ swap)
            x[axis] ^= swap
    for axis in range(1, n):
        x[axis] ^= x[axis - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] & (1 << level)) > 0, (1 << level) - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in range(n):
            key = (key << 1) | ((x[axis] >> level) & 1)
    return key


def usable(v: Column) -> Column:
    """True for vectors that take part."""
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(column) -> np.ndarray:
    return np.array([np.asarray(v, np.float64) for v in column])


def _nearest(q: np.ndarray, x: np.ndarray, ids: list, k: int) -> list[tuple[int, int, float]]:
    """(query, id, distance) of the ``k`` nearest ids of each query; ties to smaller ids. Distances are exact."""
    out = []
    rough = (q ** 2).sum(1)[:, None] + (x ** 2).sum(1)[None] - 2 * q @ x.T
    bound = np.partition(rough, min(k, rough.shape[1]) - 1, axis=1)[:, min(k, rough.shape[1]) - 1] + 1e-6 * (1 + (q ** 2).sum(1))
    for i, near in enumerate(rough <= bound[:, None]):
        at = np.flatnonzero(near)
        d = np.sqrt(((x[at] - q[i]) ** 2).sum(1))
        pairs = sorted((float(v), int(j)) for v, group in zip(d, at) for j in ids[group])
        out += [(i, j, v) for v, j in pairs[:k]]
    return out


def _grid(sample: np.ndarray, curves: int, axes: int, bits: int, seed: int = 11) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Directions, origins and cell sizes for each ordering."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(curves):
        basis, _ = np.linalg.qr(rng.normal(size=(sample.shape[1], min(axes, sample.shape[1]))))
        p = sample @ basis
        low, high = p.min(0), p.max(0)
        width = np.maximum(high - low, 1e-9) * 1.25
        out.append((basis, low - rng.uniform(0, 0.25, len(low)) * np.maximum(high - low, 1e-9), width / (1 << bits)))
    return out


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding", target: float = 0.95,
            calibration: int = 64, sample: int = 4096, curves: int = CURVES, axes: int = AXES, bits: int = BITS,
            block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest other rows found for each row where ``is_query`` holds."""
    spark = vectors.sparkSession
    out_schema = "query_id long, rank int, vec_id long, score double"
    rows = vectors.where(usable(F.col(vector)) & F.col(vec_id).isNotNull()).select(
        F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if length is None:
        return spark.createDataFrame([], out_schema)
    rows = rows.where(F.size("v") == length.n)
    ids = top_k_per_key(rows.select("v", "id").distinct(), ["v"], ["id"], k + 1).groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    groups, _ = stored(ids.select(F.monotonically_increasing_id().alias("gid"), "v", "ids"), "vectors")
    queries, _ = stored(rows.where("q").select("v", "id").distinct().join(groups.select("gid", "v"), "v").select("gid", "id"), "queries")
    asked = queries.select("gid").distinct()
    n = groups.count()

    hashed = F.shiftrightunsigned(F.xxhash64("gid"), 11) / F.lit(float(1 << 53))
    grid = _grid(_matrix(r.v for r in groups.where(hashed < sample / n).select("v").limit(2 * sample).collect() or groups.limit(1).collect()),
                 curves, axes, bits)

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = _matrix(pdf.v)
            for c, (basis, low, cell) in enumerate(grid):
                cells = np.clip((x @ basis - low) / cell, 0, (1 << bits) - 1).astype(np.int64)
                yield pd.DataFrame({"curve": c, "key": hilbert_keys(cells, bits), "gid": pdf.gid})

    def numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        at = 0
        for pdf in batches:
            yield pdf[["curve", "gid"]].assign(part=TaskContext.get().partitionId(), at=np.arange(at, at + len(pdf)))
            at += len(pdf)

    parts = max(1, min(4096, n * curves // 50_000))
    order = groups.select("gid", "v").mapInPandas(keyed, "curve int, key long, gid long").repartitionByRange(
        parts, "curve", "key", "gid").sortWithinPartitions("curve", "key", "gid")
    order, _ = stored(order.mapInPandas(numbered, "curve int, gid long, part int, at long"), "order")
    before, total = [], 0
    for r in order.groupBy("part").count().orderBy("part").collect():
        before.append((r.part, total))
        total += r["count"]
    offsets = spark.createDataFrame(before, "part int, before long")
    ranks, _ = stored(order.join(F.broadcast(offsets), "part").select(
        "curve", "gid", (F.col("before") + F.col("at") - F.col("curve").cast("long") * n).alias("r")), "ranks")  # a row for each of ``parts``

    chosen = [(r.gid, r.v) for r in asked.orderBy(F.xxhash64("gid")).limit(calibration).join(groups, "gid").select("gid", "v").collect()]
    if not chosen:
        return spark.createDataFrame([], out_schema)
    probe = _matrix(v for _, v in chosen)

    def brute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i in range(0, len(pdf), block):
                part = pdf.iloc[i:i + block]
                found = _nearest(probe, _matrix(part.v), [[g] for g in part.gid], k + 1)
                yield pd.DataFrame([(chosen[q][0], g, d) for q, g, d in found], columns=["q", "gid", "d"])

    true = top_k_per_key(groups.select("gid", "v").mapInPandas(brute, "q long, gid long, d double"), ["q"], ["d", "gid"], k + 1)
    true, _ = stored(true.where("q != gid").select("q", "gid"), "calibration")
    near = true.join(ranks.withColumnRenamed("r", "r1"), "gid").join(ranks.select("curve", F.col("gid").alias("q"), F.col("r").alias("r2")), ["curve", "q"])
    gaps = sorted(r.gap for r in near.groupBy("q", "gid").agg(F.min(F.abs(F.col("r1") - F.col("r2"))).alias("gap")).collect())
    reach = gaps[min(len(gaps) - 1, int(np.ceil(target * len(gaps))))] if gaps else 0

    blocks = ranks.join(groups, "gid").select("curve", F.floor(F.col("r") / block).cast("long").alias("block"), "r", "v", "ids")
    windows = ranks.join(asked, "gid").join(groups.select("gid", "v"), "gid").select(
        F.col("curve").alias("c"), F.explode(F.sequence(F.floor(F.greatest(F.lit(0), F.col("r") - reach) / block).cast("long"),
                                      F.floor(F.least(F.lit(n - 1), F.col("r") + reach) / block).cast("long"))).alias("b"), "gid", F.col("v").alias("qv"))

    def search(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(q) and len(x):
            vectors_, ids_, gids = _matrix(x.v), list(x.ids), q.gid.tolist()
            for i in range(0, len(q), 256):
                found += [(gids[i + a], b, d) for a, b, d in _nearest(_matrix(q.qv.iloc[i:i + 256]), vectors_, ids_, k + 1)]
        return pd.DataFrame(found, columns=["gid", "vec_id", "score"])

    found = windows.groupBy("c", "b").cogroup(blocks.groupBy("curve", "block")).applyInPandas(search, "gid long, vec_id long, score double")
    merged = top_k_per_key(found.groupBy("gid", "vec_id").agg(F.min("score").alias("score")), ["gid"], ["score", "vec_id"], k + 1)
    pairs = queries.join(merged, "gid").where("id != vec_id").groupBy(F.col("id").alias("query_id"), "vec_id").agg(F.min("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return pairs.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
