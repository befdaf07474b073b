"""Per-group values put back on every row, without one task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# A key is hot above 1/HOT_KEYS of all rows, so there are fewer hot keys than this.
HOT_KEYS = 10_000
SALTS = 1_024


def attach_by_key(df: DataFrame, table: DataFrame, key: str, size_col: str, spread: Sequence[str],
                  drop_size: bool = False) -> DataFrame:
    """Left join of a per-key ``table`` to ``df``; ``size_col`` holds the rows of ``df`` per key.

    The sizes tell which keys are hot. Hot keys are fewer than ``HOT_KEYS``, so
    their part of the table is broadcast. Rows of hot or null keys take a salt
    from the hash of ``spread`` and go evenly over the partitions of the second
    join, where only the other keys can match.
    """
    values = [c for c in table.columns if c != key]
    total = table.agg(F.sum(size_col)).scalar()
    hot = table.where(F.col(size_col) * HOT_KEYS > total)
    hot = hot.select(F.col(key).alias("_hk"), F.struct(*values).alias("_hot"))
    rest = table.select(F.col(key).alias("_ck"), F.lit(0).alias("_cs"), F.struct(*values).alias("_cold"))
    spare = F.col("_hot").isNotNull() | F.col(key).isNull()
    salt = F.when(spare, 1 + F.pmod(F.xxhash64(*spread), F.lit(SALTS))).otherwise(0).cast("int")
    out = (
        df.join(F.broadcast(hot), F.col(key) == F.col("_hk"), "left")
        .withColumn("_salt", salt)
        .join(rest, (F.col(key) == F.col("_ck")) & (F.col("_salt") == F.col("_cs")), "left")
        .withColumn("_v", F.coalesce("_hot", "_cold"))
    )
    keep = [c for c in values if not (drop_size and c == size_col)]
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *[F.col(f"_v.{c}").alias(c) for c in keep])


def group_totals(df: DataFrame, key: str, spread: Sequence[str], aggs: dict[str, Column],
                 size_col: str = "_n", source: DataFrame | None = None) -> DataFrame:
    """Whole-group aggregates on every row (null keys get null).

    ``source`` may give the same rows by a shorter way than ``df``.
    """
    exprs = [F.count(F.lit(1)).alias(size_col)] + [v.alias(k) for k, v in aggs.items()]
    table = (df if source is None else source).where(F.col(key).isNotNull()).groupBy(key).agg(*exprs)
    return attach_by_key(df, table, key, size_col, spread, drop_size=True)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row per key in a total order."""
    return top_k_per_key(df, keys, order, 1)


def top_k_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], k: int,
                  rank: str | None = None) -> DataFrame:
    """First ``k`` rows per key.

    The filter on the row number lets Spark cut every key to ``k`` rows on the
    map side, so a hot key sends ``k`` rows per task.
    """
    from pyspark.sql import Window

    name = rank or "_rank"
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= k)
    return out if rank else out.drop(name)
