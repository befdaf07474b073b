"""Column expressions that turn raw text into typed values."""

from __future__ import annotations

from functools import reduce
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from shelfwise import vocab
from shelfwise.functions.rounding import round_to


def strip(c: Column) -> Column:
    """Outer white space removed; ``trim`` would remove blanks only."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def is_valid_text(c: Column) -> Column:
    """True for text that is neither blank nor the word 'null'; null gives False."""
    s = strip(c)
    return F.coalesce((s != "") & (F.lower(s) != "null"), F.lit(False))


def owners_lower_bound(c: Column) -> Column:
    """'20,000 .. 50,000' -> 20000; anything unreadable -> 0."""
    low = strip(F.split_part(c, F.lit(".."), F.lit(1)))
    return F.coalesce(F.regexp_replace(low, "[,. ]", "").try_cast("bigint"), F.lit(0).cast("bigint"))


def min_ram_gb(c: Column) -> Column:
    """First '<n> GB RAM' or '<n> MB RAM' of a requirement text, in GB."""
    pattern = r"(\d+(?:\.\d+)?)\s*(gb|mb)\s*ram"
    low = F.lower(c)
    size = F.regexp_extract(low, pattern, 1).try_cast("double")
    in_mb = F.regexp_extract(low, pattern, 2) == "mb"
    return F.coalesce(F.when(in_mb, round_to(size / 1024, 2)).otherwise(size), F.lit(0.0))


def language_count(c: Column) -> Column:
    """Languages in a comma list, without the audio note and without tags."""
    text = F.regexp_replace(c, r"(?i)languages with[^\n]*", "")
    parts = F.split(F.regexp_replace(text, r"<[^>]+>", ""), ",")
    return F.coalesce(F.size(F.filter(parts, lambda p: strip(p) != "")), F.lit(0))


def strip_html(c: Column) -> Column:
    return F.coalesce(strip(F.regexp_replace(c, r"<[^>]+>", " ")), F.lit(""))


def safe_int(c: Column, default: int = 0) -> Column:
    return F.coalesce(c.try_cast("bigint"), F.lit(default).cast("bigint"))


def safe_double(c: Column, default: float = 0.0) -> Column:
    return F.coalesce(c.try_cast("double"), F.lit(default))


def safe_bool(c: Column) -> Column:
    """Numbers but zero -> True; text true/1/yes in any case -> True; other text and null -> False."""
    kind = F.typeof(c)  # known when the plan is made, so one branch is left
    number = kind.isin("tinyint", "smallint", "int", "bigint", "float", "double") | kind.startswith("decimal")
    return F.coalesce(F.when(number, c.try_cast("double") != 0).otherwise(
        F.lower(c.cast("string")).isin("true", "1", "yes")), F.lit(False))


def slug(c: Column) -> Column:
    """Column-name form of a vocabulary entry, as ``vocab.slug``."""
    return F.translate(F.lower(c), " -/", "___")


def month_of_epoch(c: Column) -> Column:
    """Epoch seconds -> 'yyyy-MM' in UTC, whatever the session time zone."""
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(c / 86400).cast("int"))
    return F.date_format(day, "yyyy-MM")


DATE_FORMATS = ("yyyy-MM-dd", "MMM d, yyyy", "d MMM, yyyy")


def parse_date(c: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First format that fits, else null. One format gives the strict mode."""
    return F.coalesce(*[F.try_to_date(c, f) for f in formats])


def release_parts(c: Column, formats: Sequence[str] = DATE_FORMATS) -> dict[str, Column]:
    """Year, month and quarter of a dirty date; unreadable -> 0, 0, unknown."""
    d = parse_date(c, formats)
    return {
        "release_year": F.coalesce(F.year(d), F.lit(0)),
        "release_month": F.coalesce(F.month(d), F.lit(0)),
        "release_quarter": F.coalesce(F.concat(F.lit("Q"), F.quarter(d).cast("string")), F.lit(vocab.UNKNOWN)),
    }


def released_date_text(date: Column, coming_soon: Column) -> Column:
    """Empty text for announced items, else the date text."""
    return F.when(F.coalesce(coming_soon, F.lit(False)), "").otherwise(F.coalesce(date, F.lit("")))


def price_usd(cents: Column, is_free: Column) -> Column:
    return F.when(F.coalesce(is_free, F.lit(False)), 0.0).otherwise(safe_double(cents) / 100.0)


def join_names(names: Column) -> Column:
    return F.coalesce(F.array_join(names, ", "), F.lit(""))


def multi_hot(names: Column, vocabulary: Sequence[str], prefix: str) -> list[Column]:
    """One 0/1 column per vocabulary entry; a null list gives zeros."""
    return [
        F.coalesce(F.array_contains(names, v), F.lit(False)).cast("int").alias(prefix + vocab.slug(v))
        for v in vocabulary
    ]


def pseudonym(c: Column) -> Column:
    """16 hex digits of SHA-256 of the value as it stands; nothing to hide -> ''."""
    empty = c.isNull() | (strip(c) == "") | (F.lower(c) == "null")
    return F.when(empty, "").otherwise(F.substring(F.sha2(c, 256), 1, 16))


def text_length(c: Column) -> Column:
    return F.length(F.coalesce(c, F.lit("")))


def pretty_label(c: Column) -> Column:
    """'tag_open_world' -> 'Open World', 'genre_rpg' -> 'RPG'."""
    bare = F.regexp_replace(c, "^(" + "|".join(vocab.FLAG_PREFIXES) + ")", "")
    words = F.filter(F.split(F.replace(bare, F.lit("_"), F.lit(" ")), r"\s+"), lambda w: w != "")
    return F.array_join(
        F.transform(words, lambda w: F.when(F.lower(w).isin(*vocab.ACRONYMS), F.upper(w)).otherwise(F.initcap(w))),
        " ",
    )


def feature_label(c: Column) -> Column:
    """Label of a flag, or the display name of another feature."""
    is_flag = reduce(lambda a, b: a | b, [c.startswith(p) for p in vocab.FLAG_PREFIXES])
    names = F.create_map(*[F.lit(x) for kv in vocab.NICE_LABELS.items() for x in kv])
    return F.when(is_flag, pretty_label(c)).otherwise(F.coalesce(F.try_element_at(names, c), c))
