"""Landed JSON payloads to typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise import vocab
from shelfwise.functions import features as X, parsing as P

STORE_SCHEMA = """
success boolean, data struct<
  type: string, name: string, developers: array<string>, publishers: array<string>,
  release_date: struct<date: string, coming_soon: boolean>, is_free: string,
  price_overview: struct<final: string>, platforms: struct<windows: string, mac: string, linux: string>,
  pc_requirements: struct<minimum: string>, metacritic: struct<score: string>,
  achievements: struct<total: string>, dlc: array<bigint>, supported_languages: string,
  controller_support: string, genres: array<struct<description: string>>,
  categories: array<struct<description: string>>, short_description: string, detailed_description: string>
"""
ESTIMATE_SCHEMA = "owners string, ccu string, positive string, negative string, userscore string, tags string"
REVIEWS_SCHEMA = """
success int, reviews array<struct<timestamp_created: bigint, voted_up: boolean, steam_purchase: boolean,
  written_during_early_access: boolean, author: struct<playtime_at_review: bigint>>>
"""


def store_items(raw: DataFrame, key: str = "appid", payload: str = "store") -> DataFrame:
    """Parsed store payloads of released base items; the payload filter comes first."""
    parsed = raw.withColumn("_s", F.from_json(payload, STORE_SCHEMA))
    return parsed.where(F.col("_s.success") & (F.col("_s.data.type") == "game")).select(
        *[c for c in raw.columns if c != payload], F.col("_s.data").alias("s"))


def estimates(raw: DataFrame, payload: str = "estimate") -> DataFrame:
    """Parsed market estimates; ``tags`` is a map of votes, or a list."""
    e = raw.withColumn("e", F.from_json(payload, ESTIMATE_SCHEMA)).drop(payload)
    as_map = F.map_keys(F.from_json("e.tags", "map<string, string>"))
    as_list = F.from_json("e.tags", "array<string>")
    tags = F.when(F.startswith(F.ltrim("e.tags"), F.lit("[")), as_list).otherwise(as_map)
    return e.withColumn("tag_names", F.coalesce(tags, F.array().cast("array<string>")))


def metadata_rows(items: DataFrame, key: str = "appid") -> DataFrame:
    """Catalogue rows from joined store (``s``) and estimate (``e``) structs."""
    count = lambda c: P.safe_int(F.col(c))
    free = P.safe_bool(F.col("s.is_free"))
    flag = lambda c: P.safe_bool(F.col(c)).cast("int")
    return items.select(
        key,
        F.coalesce(P.strip(F.col("s.name")), F.lit("")).alias("name"),
        P.join_names(F.col("s.developers")).alias("developer"),
        P.join_names(F.col("s.publishers")).alias("publisher"),
        P.released_date_text(F.col("s.release_date.date"), F.col("s.release_date.coming_soon")).alias("release_date"),
        P.price_usd(F.col("s.price_overview.final"), free).alias("price"),
        free.cast("int").alias("is_free"),
        P.owners_lower_bound(F.col("e.owners")).alias("owners_lower_bound"),
        count("e.ccu").alias("ccu"),
        X.rating_percent(count("e.positive"), count("e.negative")).alias("rating_porcentaje"),
        count("e.positive").alias("positive"),
        count("e.negative").alias("negative"),
        count("s.metacritic.score").alias("metacritic_score"),
        count("e.userscore").alias("hub_followers"),
        count("s.achievements.total").alias("total_achievements"),
        F.coalesce(F.size("s.dlc"), F.lit(0)).cast("bigint").alias("total_dlcs"),
        P.language_count(F.col("s.supported_languages")).cast("bigint").alias("supported_languages"),
        F.coalesce("s.controller_support", F.lit("none")).alias("controller_support"),
        flag("s.platforms.windows").alias("platform_windows"),
        flag("s.platforms.mac").alias("platform_mac"),
        flag("s.platforms.linux").alias("platform_linux"),
        P.min_ram_gb(F.col("s.pc_requirements.minimum")).alias("min_ram_gb"),
    )


def tag_rows(items: DataFrame, key: str = "appid") -> DataFrame:
    """0/1 columns of the fixed genre, category and tag vocabularies."""
    genres = F.transform("s.genres", lambda g: g["description"])
    cats = F.transform("s.categories", lambda c: c["description"])
    return items.select(
        key, *P.multi_hot(genres, vocab.GENRES, "genre_"), *P.multi_hot(cats, vocab.CATEGORIES, "cat_"),
        *P.multi_hot(F.col("tag_names"), vocab.TAGS, "tag_"))


def text_rows(items: DataFrame, key: str = "appid") -> DataFrame:
    return items.select(
        key, P.strip_html(F.col("s.short_description")).alias("short_description"),
        P.strip_html(F.col("s.detailed_description")).alias("about_the_game"),
        F.lit("").alias("reviews_text_sample"))


def review_rows(raw: DataFrame, key: str = "appid", payload: str = "reviews") -> DataFrame:
    """One row per review of successful pages."""
    page = raw.withColumn("_p", F.from_json(payload, REVIEWS_SCHEMA)).where(F.col("_p.success") == 1)
    return page.select(key, F.explode("_p.reviews").alias("r")).select(
        key, F.coalesce("r.timestamp_created", F.lit(0)).alias("timestamp_created"),
        F.coalesce("r.voted_up", F.lit(False)).alias("voted_up"),
        F.coalesce("r.steam_purchase", F.lit(False)).alias("steam_purchase"),
        F.coalesce("r.written_during_early_access", F.lit(False)).alias("written_during_early_access"),
        F.coalesce("r.author.playtime_at_review", F.lit(0)).alias("playtime_at_review"))
