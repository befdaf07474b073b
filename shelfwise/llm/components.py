"""Connected components of an edge table, by alternating star contractions.

Every round hangs the neighbours of a node on the smallest node among them, first over all neighbours, then over the smaller
ones. The minimum per node is combined before the shuffle and put back by a join that Spark splits where a hub is skewed; no
neighbour list is ever gathered. Each round is a table in the shared scratch folder; the number of rounds grows with the
logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.common import stored
from shelfwise.session import discard


def _signature(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return r.n, r.x


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): every node of an edge but the roots themselves, with the smallest node of its component.

    Ids may be of any orderable type. Edges with a null end and loops are left out; repeated edges count once; no edges
    give no rows.
    """
    spark = edges.sparkSession
    start = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    now, path = stored(start, "edges")
    last, seen = None, _signature(now)
    while seen != last and seen[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a AND b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.unionByName(low.where("a != m").select("a", F.col("m").alias("b"))).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        after, new = stored(small, "edges")
        discard(spark, path)
        now, path, last, seen = after, new, seen, _signature(after)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
