"""Market aggregates and the monthly panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise import vocab
from shelfwise.functions import features as X, parsing as P
from shelfwise.functions.rounding import round_to
from shelfwise.operators.groups import group_totals
from shelfwise.operators.ordered import medians


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def distinct_valid(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """A2: distinct valid names per column, as (column, n_distinct) rows.

    Exact counts go through distinct (column, name) pairs, which spread over
    all tasks; the approximate form needs no shuffle of names.
    """
    long = df.select(*cols).unpivot([], list(cols), "column", "name")
    name = F.when(P.is_valid_text(F.col("name")), P.strip(F.col("name")))
    count = F.approx_count_distinct(name) if approx else F.count_distinct(name)
    return long.groupBy("column").agg(count.alias("n_distinct"))


def flag_totals(df: DataFrame, flags: Sequence[str], n: int = 10, prefix: str = "genre_") -> DataFrame:
    """Rows with each flag equal to '1', largest first."""
    wide = df.agg(*[F.count_if(P.strip(F.col(f"`{c}`").cast("string")) == "1").alias(c) for c in flags])
    long = wide.unpivot([], list(flags), "genre", "n").where(F.col("n") > 0)
    return long.withColumn("genre", F.replace("genre", F.lit(prefix), F.lit(""))) \
        .orderBy(F.desc("n"), "genre").limit(n)


def with_experience(df: DataFrame, who: str, prefix: str, key: str = "appid",
                    source: DataFrame | None = None) -> DataFrame:
    """A4: items of the same producer on every row, and its tier; no producer counts as one item."""
    out = group_totals(df, who, [key], {"_gc": F.count(key)}, source=source)
    count = F.coalesce(F.col("_gc"), F.lit(1)).cast("int")
    return out.withColumn(f"{prefix}_game_count", count).drop("_gc").withColumn(
        f"{prefix}_experience", X.experience_tier(F.col(f"{prefix}_game_count"))
    )


def review_panel(reviews: DataFrame, key: str, epoch: Column, voted_up: Column, purchased: Column, early: Column,
                 minutes: Column, start: int | None = vocab.REVIEW_START_EPOCH) -> DataFrame:
    """A5: one row per item and month from single reviews."""
    rows = reviews.select(
        F.col(key), epoch.alias("_e"), F.coalesce(voted_up, F.lit(False)).alias("_v"),
        F.coalesce(purchased, F.lit(False)).alias("_p"), F.coalesce(early, F.lit(False)).alias("_a"),
        F.coalesce(minutes, F.lit(0)).alias("_m"),
    )
    if start is not None:
        rows = rows.where(F.col("_e") >= start)
    return rows.groupBy(key, P.month_of_epoch(F.col("_e")).alias("month")).agg(
        F.count(F.lit(1)).alias("review_count"),
        F.count_if("_v").alias("positive_count"),
        F.count_if(~F.col("_v")).alias("negative_count"),
        F.count_if("_p").alias("steam_purchase_count"),
        F.count_if("_a").alias("early_access_count"),
        round_to(F.sum("_m") / F.count(F.lit(1)) / 60, 2).alias("avg_playtime_at_review_hrs"),
    )


def collapse_panel(panel: DataFrame, key: str = "appid") -> DataFrame:
    """One row per item from its months.

    Hours are summed as decimals, so the mean does not depend on the order of the rows.
    """
    sums = {
        "ts_total_reviews": "review_count", "ts_positive": "positive_count", "ts_negative": "negative_count",
        "ts_steam_purchase": "steam_purchase_count", "ts_early_access": "early_access_count",
    }
    hours = F.col("avg_playtime_at_review_hrs").cast("decimal(28,10)")
    out = panel.groupBy(key).agg(
        *[F.sum(c).cast("bigint").alias(n) for n, c in sums.items()],
        F.count_if(F.col("review_count") > 0).alias("ts_months_active"),
        round_to(F.sum(hours).cast("double") / F.count(hours), 2).alias("ts_avg_playtime_hrs"),
    )
    votes = F.col("ts_positive") + F.col("ts_negative")
    return out.withColumn(
        "ts_positive_ratio", F.when(votes > 0, round_to(F.col("ts_positive") / votes, 3)).otherwise(0.0)
    )


def class_shares(df: DataFrame, label: str) -> DataFrame:
    """Rows and share per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", round_to(F.col("n") / counts.agg(F.sum("n")).scalar(), 3))


def fixed_counts(df: DataFrame, tests: dict[str, Column], name: str, count: str = "n") -> DataFrame:
    """Counts for a fixed list of conditions in one pass; empty ones stay as 0."""
    wide = df.agg(*[F.count_if(t).alias(k) for k, t in tests.items()])
    return wide.unpivot([], list(tests), name, count)


def market_split(df: DataFrame, label_name: str = "label_name") -> DataFrame:
    """A8."""
    return fixed_counts(df, {c: F.col(label_name) == c for c in vocab.LABEL_NAMES.values()}, "clase")


def price_histogram(df: DataFrame, price: str = "price", bins: Sequence[float] = vocab.PRICE_BINS,
                    labels: Sequence[str] = vocab.PRICE_BIN_LABELS) -> DataFrame:
    """Half-open bins over the price floored at 0."""
    p = X.clip(F.col(price), low=0.0)
    tests = {n: (p >= lo) & (p < hi) for n, lo, hi in zip(labels, bins, bins[1:])}
    return fixed_counts(df, tests, "label", "count")


def owners_by_flag(df: DataFrame, flags: Sequence[str], owners: str, label: str, min_rows: int = 30,
                   n: int = 12) -> DataFrame:
    """Per flag the rows, median owners and share of the top class; ``df`` is read several times."""
    wanted = [F.count_if(F.col(f"`{c}`") == 1).alias(f"n{i}") for i, c in enumerate(flags)]
    wanted += [F.count_if((F.col(f"`{c}`") == 1) & (F.col(label) == 2)).alias(f"h{i}") for i, c in enumerate(flags)]
    wanted += [F.count_if((F.col(f"`{c}`") == 1) & F.col(label).isNotNull()).alias(f"l{i}") for i, c in enumerate(flags)]
    counts = df.agg(*wanted).first()
    often = [i for i in range(len(flags)) if counts[f"n{i}"] >= min_rows]
    # Flags are columns, so a median per flag is one more expression of the same pass.
    found = medians(df, {flags[i]: F.when(F.col(f"`{flags[i]}`") == 1, F.col(owners)) for i in often})
    rows = [(flags[i], counts[f"n{i}"], counts[f"h{i}"], counts[f"l{i}"], found[flags[i]]) for i in often if flags[i] in found]
    stats = df.sparkSession.createDataFrame(rows, "genre string, n bigint, hits bigint, labelled bigint, median double")
    return stats.select(
        P.pretty_label(F.col("genre")).alias("genero"), "n", F.col("median").cast("bigint").alias("owners_mediana"),
        round_to(F.try_divide("hits", "labelled") * 100, 1).alias("pct_hit"),
    ).orderBy(F.desc("owners_mediana"), "genero").limit(n)


def hits_by_quarter(df: DataFrame, quarter: Column, label: Column, min_rows: int = 20) -> DataFrame:
    """Share of the top class and of the upper two classes per quarter."""
    return (
        df.select(quarter.alias("q"), label.alias("_l")).where(F.col("q").isin(*vocab.QUARTERS))
        .groupBy("q").agg(
            F.count(F.lit(1)).alias("n"),
            round_to(F.avg((F.col("_l") == 2).cast("double")) * 100, 1).alias("pct_hit"),
            round_to(F.avg((F.col("_l") >= 1).cast("double")) * 100, 1).alias("pct_exito"),
        ).where(F.col("n") >= min_rows)
    )


def funnel_counts(catalogue: DataFrame, df: DataFrame, complete: Column, modelled: Column) -> DataFrame:
    """Rows of the catalogue as it stands, then those of the joined table that are complete and modelled."""
    return df.agg(F.count_if(complete).alias("n_metadata"), F.count_if(modelled).alias("n_train")).select(
        catalogue.agg(F.count(F.lit(1)).alias("n")).scalar().alias("n_catalogo"), "n_metadata", "n_train")


def segment_classes(df: DataFrame, tier: str, value: str, label: str) -> DataFrame:
    """A24."""
    return df.where(F.col(tier) == value).groupBy(X.label_name(F.col(label)).alias("clase")) \
        .agg(F.count(F.lit(1)).alias("count"))


def pseudonym_stats(df: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """Rows, distinct trimmed names and distinct pseudonyms of the names as they stand.

    Fewer pseudonyms than names is a collision, more are names that differ in padding only. Blank names and the word
    'null' are left out.
    """
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for name, pid in pairs.items():
        known = P.is_valid_text(F.col(name))
        aggs += [F.count_distinct(F.when(known, P.strip(F.col(name)))).alias(f"{name}_names"),
                 F.count_distinct(F.when(known, F.col(pid))).alias(f"{name}_ids")]
    return df.agg(*aggs)


def scaling_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean and population standard deviation of each numeric, one pass."""
    wide = df.agg(*[e for c in cols for e in (F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))])
    stacked = ", ".join(f"'{c}', `m_{c}`, `s_{c}`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {stacked}) AS (feature, mean, scale)")


def master_audit(df: DataFrame, near_constant: int, label: str = "label") -> DataFrame:
    """A27."""
    nulls = sum((F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns), F.lit(0))
    n = F.count(F.lit(1))
    share = lambda k: round_to(F.count_if(F.col(label) == k) / n, 3)
    return df.agg(
        n.alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"), nulls.alias("n_nulls"),
        *[share(k).alias(f"share_{v.lower()}") for k, v in vocab.LABEL_NAMES.items()],
        F.lit(near_constant).alias("n_near_constant"),
    )
