"""Column expressions of the feature table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from shelfwise import vocab
from shelfwise.functions.rounding import round_to


def rating_percent(positive: Column, negative: Column) -> Column:
    total = positive + negative
    return F.when(total > 0, round_to(positive / total * 100, 2)).otherwise(0.0)


def price_tier(price: Column, is_free: Column | None = None, cuts: tuple[float, float] = (10, 20)) -> Column:
    p = F.coalesce(price, F.lit(0.0))
    free = p <= 0
    if is_free is not None:
        free = F.coalesce(F.lower(is_free.cast("string")).isin("true", "1", "1.0"), F.lit(False)) | free
    f2p, budget, mid, premium = vocab.PRICE_TIERS
    return F.when(free, f2p).when(p < cuts[0], budget).when(p < cuts[1], mid).otherwise(premium)


def experience_tier(count: Column, cuts: tuple[int, int] = (3, 10)) -> Column:
    return (
        F.when(count >= cuts[1], vocab.TIER_TOP)
        .when(count >= cuts[0], vocab.TIER_ESTABLISHED)
        .otherwise(vocab.TIER_NOVICE)
    )


def success_label(
    owners: Column, flop_max: float = vocab.FLOP_MAX_OWNERS, hit_min: float = vocab.HIT_MIN_OWNERS
) -> Column:
    return F.when(owners >= hit_min, 2).when(owners >= flop_max, 1).otherwise(0)


def label_name(label: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in vocab.LABEL_NAMES.items() for x in kv]), label)


def clip(c: Column, low: float | None = None, high: float | None = None) -> Column:
    """Bounds that leave null as null (``least`` and ``greatest`` would not)."""
    out = c
    if high is not None:
        out = F.when(out > high, F.lit(high).cast("double")).otherwise(out)
    if low is not None:
        out = F.when(out < low, F.lit(low).cast("double")).otherwise(out)
    return out


def flag_sum(cols: Sequence[str | Column]) -> Column:
    """Number of set flags; a null flag counts as not set."""
    parts = [F.coalesce(F.col(f"`{c}`") if isinstance(c, str) else c, F.lit(0)) for c in cols]
    return reduce(lambda a, b: a + b, parts, F.lit(0)).cast("int")


def any_flag(cols: Sequence[str]) -> Column:
    return (flag_sum(cols) > 0).cast("int")


def md5_order(key: Column, seed: int) -> Column:
    """A repeatable pseudo-random sort key that other engines can reproduce."""
    return F.md5(F.concat(F.lit(f"{seed}-"), key.cast("string")))
