"""The feature tables: one row per item.

Each is a short chain of written tables, so no later step plans or computes an earlier one again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise import vocab
from shelfwise.functions import features as X, parsing as P
from shelfwise.operators.aggregates import collapse_panel, with_experience
from shelfwise.operators.filters import columns_with_prefix, metadata_complete, with_estimate
from shelfwise.operators.groups import first_per_key
from shelfwise.operators.joins import join_catalogue, left_join_zero
from shelfwise.operators.profile import impute
from shelfwise.operators.shrinkage import leave_one_out_prior
from shelfwise.session import materialise


def producer_columns(first: DataFrame, tags: DataFrame, cuts: tuple[float, float] | None = None) -> DataFrame:
    """Sizes and tiers of the producers of each item, by ``appid``; with ``cuts`` also the success prior, of items with owners only.

    Only keys and names go through the joins by producer. The prior counts the items that have owners and tags, once for each row of tags.
    """
    rows = first.select("appid", "developer", "publisher", *(["owners_lower_bound"] if cuts else []))
    out = with_experience(with_estimate(rows) if cuts else rows, "developer", "dev", source=first.select("appid", "developer"))
    out = with_experience(out, "publisher", "pub", source=first.select("appid", "publisher"))
    if cuts:
        label = X.success_label(F.col("owners_lower_bound"), *cuts).alias("label")
        # Written once: the prior reads it for the totals, the hot keys and the global share.
        sold = materialise(join_catalogue(with_estimate(rows), tags.select("appid")).select("appid", "developer", label), "sold")
        out = leave_one_out_prior(out.select("*", label), source=sold).drop("owners_lower_bound", "label")
    return out.drop("developer", "publisher")


def enriched(meta: DataFrame, tags: DataFrame, text: DataFrame | None, order: list[str],
             cuts: tuple[float, float] | None = None) -> DataFrame:
    """Items with tags: producer sizes over the whole catalogue, release parts, tiers, text length.

    The de-duplicated catalogue is written once; the producer tables read few columns of it each. With ``cuts`` only items with
    owners, and with ``dev_success_prior``.
    """
    first = materialise(first_per_key(meta, ["appid"], order), "catalogue")
    made = producer_columns(first, tags, cuts)
    out = (with_estimate(first) if cuts else first).join(made, "appid")
    out = out.withColumns(P.release_parts(F.col("release_date")))
    out = out.withColumn("price_tier", X.price_tier(F.col("price"), F.col("is_free")))
    if text is not None:
        # Only lengths leave the scan, never the texts.
        lengths = text.select("appid", P.text_length(F.col("short_description")).alias("short_desc_len"))
        lengths = first_per_key(lengths, ["appid"], ["short_desc_len"])
        out = left_join_zero(out, lengths, "appid", ["short_desc_len"])
    return join_catalogue(out, tags)


def with_flag_sums(df: DataFrame) -> DataFrame:
    groups = {p: columns_with_prefix(df, p) for p in ("genre_", "tag_", "cat_")}
    flags = {c: F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("int") for cs in groups.values() for c in cs}
    early = [c for c in ("genre_early_access", "tag_early_access") if c in df.columns]
    return df.withColumns(flags).withColumns({
        "num_genres": X.flag_sum(groups["genre_"]), "num_tags": X.flag_sum(groups["tag_"]),
        "num_categories": X.flag_sum(groups["cat_"]), "is_early_access": X.any_flag(early)})


def build_master(meta: DataFrame, tags: DataFrame, text: DataFrame | None, panel: DataFrame | None,
                 order: list[str] = ["appid"], cuts: tuple[float, float] = (vocab.FLOP_MAX_OWNERS, vocab.HIT_MIN_OWNERS),
                 numbers_with_nulls: list[str] | None = None) -> DataFrame:
    """L1: the modelling table.

    Producer sizes are taken before the owners filter, the success prior after
    it. ``order`` fixes which copy of an item counts as the first;
    ``numbers_with_nulls`` saves the pass that looks for columns to impute.
    """
    df = enriched(meta, tags, text, order, cuts)
    if panel is not None:
        ts = collapse_panel(panel)
        df = left_join_zero(df, ts, "appid", [c for c in ts.columns if c != "appid"])
    df = with_flag_sums(df)
    df = df.withColumn("price", X.clip(F.col("price"), high=vocab.PRICE_CAP))
    df = df.withColumn("label", X.success_label(F.col("owners_lower_bound"), *cuts))
    df = df.withColumn("label_name", X.label_name(F.col("label")))
    # Written once: the look for nulls and the medians read the columns they need.
    df = materialise(df.select(*[F.col(f"`{c}`") for c in df.columns if c != "dev_success_prior"], "dev_success_prior"), "labelled")
    return impute(df, columns_with_prefix(df, vocab.FLAG_PREFIXES), numbers_with_nulls)


def build_stage1(meta: DataFrame, tags: DataFrame, text: DataFrame, order: list[str] = ["appid"],
                 numbers_with_nulls: list[str] | None = None) -> DataFrame:
    """All items with complete metadata and whether they sell (``tiene_ventas``)."""
    df = with_flag_sums(enriched(meta, tags, text, order))
    df = df.withColumn("price", X.clip(F.col("price"), high=vocab.PRICE_CAP))
    df = df.withColumn("tiene_ventas", (F.col("owners_lower_bound") > 0).cast("int"))
    df = materialise(df, "items")
    df = impute(df, columns_with_prefix(df, vocab.FLAG_PREFIXES), numbers_with_nulls)
    return df.where(metadata_complete())
