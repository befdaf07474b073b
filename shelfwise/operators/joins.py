"""Joins, upserts and set operations.

No join is hinted here: Spark broadcasts a side only when its size is known to
be small, and splits skewed partitions of the streamed side at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise import vocab
from shelfwise.operators.groups import first_per_key


def join_catalogue(meta: DataFrame, tags: DataFrame, key: str = "appid") -> DataFrame:
    return meta.join(tags, key, "inner")


def left_join_zero(df: DataFrame, other: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Left join, absent numbers become 0."""
    return df.join(other.select(key, *cols), key, "left").na.fill(0, list(cols))


def unseen(ids: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return ids.join(done.select(key).distinct(), key, "left_anti")


def only_targets(rows: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    return rows.join(targets.select(key).distinct(), key, "left_semi")


def complete_panel(meta: DataFrame, panel: DataFrame, key: str = "appid",
                   month: str = vocab.DEFAULT_PANEL_MONTH) -> DataFrame:
    """One zero row for every item without panel rows."""
    missing = unseen(meta.select(key).distinct(), panel, key)
    zeros = [
        F.col(key) if f.name == key else F.lit(month if f.name == "month" else 0).cast(f.dataType).alias(f.name)
        for f in panel.schema.fields
    ]
    return panel.unionByName(missing.select(*zeros))


def refresh(df: DataFrame, fresh: DataFrame, key: str, stale: Column, rules: dict[str, Column],
            blank: Sequence[str] = ()) -> DataFrame:
    """Overwrite columns of stale rows from ``fresh`` (unique on key).

    ``rules`` maps a column to its new value, written over ``fresh.<col>``
    and null where the old value stays. Text columns in ``blank`` get '' for
    null on every row, refreshed or not.
    """
    new = fresh.select(F.col(key).alias("_fk"), F.struct(*[c for c in fresh.columns if c != key]).alias("fresh"))
    out = df.withColumn("_stale", stale).join(new, (F.col(key) == F.col("_fk")) & F.col("_stale"), "left")
    cols = [
        F.coalesce(F.when(F.col("_fk").isNotNull(), rules[c]), F.col(c)).alias(c) if c in rules else F.col(f"`{c}`")
        for c in df.columns
    ]
    return out.select(*cols).na.fill("", list(blank)) if blank else out.select(*cols)


def metadata_rules() -> dict[str, Column]:
    """First developer and publisher if any, the date, the score if present, platforms."""
    first_name = lambda c: F.try_element_at(F.col(c), F.lit(1))
    rules = {
        "developer": first_name("fresh.developers"),
        "publisher": first_name("fresh.publishers"),
        "release_date": F.coalesce("fresh.release_date", F.lit("")),
        "metacritic_score": F.col("fresh.metacritic_score"),
    }
    for p in ("windows", "mac", "linux"):
        rules[f"platform_{p}"] = F.coalesce(F.col(f"fresh.platform_{p}"), F.lit(False)).cast("int")
    return rules


def candidates(ranked: DataFrame, allowed: DataFrame, feature: str, weight: str, n: int = 12) -> DataFrame:
    """Allowed features by absolute weight; without a ranking, the first allowed ones."""
    hit = ranked.join(allowed.select(feature).distinct(), feature, "left_semi").select(feature, weight)
    spare = allowed.select(feature, F.lit(None).cast("double").alias(weight)).distinct()
    none_ranked = ranked.limit(1).agg(F.count(F.lit(1)).alias("c")).scalar() == 0
    return hit.unionByName(spare.where(none_ranked)).orderBy(F.desc(F.abs(F.col(weight))), feature).limit(n)


def prefer_current(current: DataFrame, backup: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Union of both; the current row wins per key."""
    both = current.withColumn("_src", F.lit(0)).unionByName(backup.withColumn("_src", F.lit(1)), True)
    return first_per_key(both, [key], ["_src", *order]).drop("_src")


def difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``a`` that ``b`` lacks."""
    return a.select(key).subtract(b.select(key))


def append_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=True)


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()
