"""Running sums and ranks inside groups of any size, without a window over a whole group.

Rows are range-partitioned by group and order, so a hot group is cut over many tasks. Each task's share of a group is summed
alone; the sums of the earlier shares of the group, one row per task and group, are added to it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from shelfwise.llm.common import stored


def running_sums(df: DataFrame, group: Sequence[str], order: Sequence[str], sums: dict[str, str],
                 per_group: DataFrame | None = None) -> DataFrame:
    """``df`` with, for each ``out: value`` of ``sums``, the total of ``value`` over the earlier rows of the group.

    ``group`` may be empty: then all rows are one group. Group columns and values are not null. Rows that agree in all of ``order``
    have no defined order among them. ``per_group`` has one row per group and adds its columns; it is joined to the shares of
    the groups, never to their rows.
    """
    held, _ = stored(df.repartitionByRange(*group, *order).withColumn("_part", F.spark_partition_id()), "ranges")
    share = ["_part", *group]
    local = Window.partitionBy(*share).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = held.groupBy(*share).agg(*[F.sum(v).alias(f"_s_{out}") for out, v in sums.items()])
    # One row per task and group.
    earlier = Window.partitionBy(*(group or [F.lit(0)])).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shares = totals.select(*share, *[F.coalesce(F.sum(f"_s_{out}").over(earlier), F.lit(0)).alias(f"_o_{out}") for out in sums])
    if per_group is not None:
        shares = shares.join(per_group, list(group))
    mine = held.withColumns({f"_l_{out}": F.coalesce(F.sum(v).over(local), F.lit(0)) for out, v in sums.items()})
    both = mine.join(shares, share)
    return both.withColumns({out: F.col(f"_l_{out}") + F.col(f"_o_{out}") for out in sums}).drop(
        "_part", *[f"{p}{out}" for out in sums for p in ("_l_", "_o_")])
