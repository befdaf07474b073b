"""Success priors per producer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise import vocab
from shelfwise.functions.rounding import round_to
from shelfwise.operators.groups import group_totals


def leave_one_out_prior(df: DataFrame, who: str = "developer", label: str = "label", key: str = "appid",
                        strength: float = vocab.PRIOR_STRENGTH, null_prior: str = "median",
                        name: str = "dev_success_prior", source: DataFrame | None = None,
                        global_name: str | None = None) -> DataFrame:
    """Share of viable items among the other items of the producer, pulled to the global share.

    Rows without a producer keep null, to be imputed with the median later
    (``null_prior='median'``), or take the global share (``'global'``).
    ``source`` may give the same rows by a shorter way than ``df``; ``global_name`` adds the global share as a column.
    """
    viable = (F.col(label) >= 1).cast("int")
    source = df if source is None else source
    p0 = source.agg(F.avg(viable).alias("p0")).scalar()
    out = group_totals(df.withColumn("_y", viable), who, [key], {"_gn": F.count(label), "_gs": F.sum("_y")},
                       source=source.withColumn("_y", viable))
    out = out.withColumn("_p0", p0)
    a0, b0 = F.col("_p0") * strength, (1 - F.col("_p0")) * strength
    prior = round_to((F.col("_gs") - F.col("_y") + a0) / (F.col("_gn") - 1 + a0 + b0), 4)
    if null_prior == "global":
        prior = F.coalesce(prior, round_to("_p0", 4))
    out = out.withColumn(name, prior)
    if global_name:
        out = out.withColumn(global_name, round_to("_p0", 4))
    return out.drop("_y", "_gn", "_gs", "_p0")


def producer_counts(df: DataFrame, who: str, viable: Column) -> DataFrame:
    """Items and viable items per producer; no name is one producer of its own."""
    name = F.when(F.coalesce(F.col(who), F.lit("")) == "", vocab.UNKNOWN).otherwise(F.col(who))
    return df.groupBy(name.alias(who)).agg(F.count(F.lit(1)).alias("n"), F.sum(viable.cast("int")).alias("k"))


def beta_fit(counts: DataFrame, min_items: int = 2, flat: float = 50.0) -> DataFrame:
    """Beta prior by moments from producers with several items, as one row."""
    rate = F.col("k") / F.col("n")
    row = counts.where(F.col("n") >= min_items).agg(F.avg(rate).alias("m"), F.var_samp(rate).alias("v"))
    m, v = F.col("m"), F.col("v")
    kappa = F.when(v > 0, F.greatest(F.try_divide(m * (1 - m), v) - 1, F.lit(1.0))).otherwise(F.lit(flat))
    return row.withColumn("kappa", kappa).select(
        "m", "v", "kappa", (m * F.col("kappa")).alias("alpha"), ((1 - m) * F.col("kappa")).alias("beta"))


def posterior(counts: DataFrame, fit: DataFrame, who: str) -> DataFrame:
    """Raw and shrunk success share per producer."""
    rows = counts.withColumn("_f", fit.select(F.struct("alpha", "beta").alias("f")).scalar())
    raw = F.col("k") / F.col("n")
    shrunk = (F.col("k") + F.col("_f.alpha")) / (F.col("n") + F.col("_f.alpha") + F.col("_f.beta"))
    return rows.select(who, "n", "k", raw.alias("p_raw"), shrunk.alias("p_shrunk"),
                       round_to(F.abs(raw - shrunk), 3).alias("shrinkage"))
