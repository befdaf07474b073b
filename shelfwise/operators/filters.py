"""Row filters and column choices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise import vocab
from shelfwise.functions.parsing import is_valid_text


def valid_names(df: DataFrame, col: str) -> DataFrame:
    return df.where(is_valid_text(F.col(col)))


def with_estimate(df: DataFrame, owners: str = "owners_lower_bound") -> DataFrame:
    return df.where(F.col(owners) > 0)


def metadata_complete() -> Column:
    """Known quarter, runs on Windows, at least one genre or tag, and a description."""
    return (
        (F.col("release_quarter") != vocab.UNKNOWN)
        & (F.col("platform_windows") == 1)
        & (F.col("num_genres") + F.col("num_tags") >= 1)
        & (F.col("short_desc_len") > 0)
    )


def quality_items(df: DataFrame, min_owners: int = 10_000, min_reviews: int = 10) -> DataFrame:
    return df.where(
        (F.col("owners_lower_bound") >= min_owners) & (F.col("positive") + F.col("negative") >= min_reviews)
    )


def is_stale(df: DataFrame) -> Column:
    """No developer or no critic score; an absent score column counts as 0."""
    score = F.col("metacritic_score") if "metacritic_score" in df.columns else F.lit(0)
    return (F.coalesce(F.col("developer"), F.lit("")) == "") | (score == 0)


def needs_backfill() -> Column:
    return (F.col("owners_lower_bound") == 0) & (F.col("positive") > 0)


def search_names(df: DataFrame, query: str, name: str, key: str, limit: int = 20) -> DataFrame:
    """Literal, case-insensitive substring search; queries under two characters find nothing."""
    if not query or len(query) < 2:
        return df.where(F.lit(False))
    return df.where(F.contains(F.lower(name), F.lit(query.lower()))).orderBy(key).limit(limit)


def lookup(df: DataFrame, key: str, value, columns: Sequence[str]) -> DataFrame:
    return df.where(F.col(key) == value).select(*columns)


def clean_headers(df: DataFrame) -> tuple[DataFrame, list[tuple[str, str]]]:
    """Dots dropped and blanks to '_' in column names; also what changed."""
    new = [c.replace(".", "").replace(" ", "_") for c in df.columns]
    return df.toDF(*new), [(a, b) for a, b in zip(df.columns, new) if a != b]


def columns_with_prefix(df: DataFrame, prefixes: str | Sequence[str]) -> list[str]:
    p = (prefixes,) if isinstance(prefixes, str) else tuple(prefixes)
    return [c for c in df.columns if c.startswith(p)]


def role_of(col: str) -> str:
    """The role that the rule table gives a column; a name of its own counts before a prefix."""
    by_name = {c: role for role, names in vocab.ROLE_NAMES for c in names}
    by_prefix = (role for role, prefixes in vocab.ROLE_PREFIXES if col.startswith(prefixes))
    return by_name.get(col) or next(by_prefix, vocab.OTHER_ROLE)


def stage_of(role: str) -> str:
    return vocab.ROLE_STAGES.get(role, "meta")


def keep_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns that exist, in the order given, each once."""
    return df.select(*[F.col(f"`{c}`") for c in dict.fromkeys(columns) if c in df.columns])


def prevalence(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Mean of each flag in one pass, as (flag, prevalence) rows."""
    wide = df.agg(*[F.avg(F.col(f"`{c}`").cast("double")).alias(c) for c in flags])
    return wide.unpivot([], list(flags), "flag", "prevalence")


def actionable_flags(df: DataFrame, flags: Sequence[str], low: float = 0.05, high: float = 0.95) -> DataFrame:
    """Flags worth changing: not too rare, not too common, no platform, not the free flag."""
    usable = [c for c in flags if not c.startswith("platform_") and c != "is_free"]
    return prevalence(df, usable).where(F.col("prevalence").between(low, high))


def without_unknown(df: DataFrame, feature: str = "feature") -> DataFrame:
    return df.where(~F.col(feature).contains(vocab.UNKNOWN))
