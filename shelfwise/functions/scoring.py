"""Column expressions applied to model output."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from shelfwise import vocab
from shelfwise.functions.features import clip
from shelfwise.functions.rounding import round_to

CLASSES = tuple(vocab.LABEL_NAMES.values())


def model_price(price: Column) -> Column:
    """Price a model sees: floored at zero and capped where training data ends."""
    return clip(F.coalesce(price, F.lit(0.0)), 0.0, vocab.MODEL_PRICE_CAP)


def overprice_factor(price: Column, ceiling: float = vocab.MODEL_PRICE_CAP, scale: float = 40.0) -> Column:
    p = F.coalesce(price, F.lit(0.0))
    return F.when(p <= ceiling, 1.0).otherwise(F.greatest(F.lit(0.02), F.exp(-(p - ceiling) / scale)))


def argmax_class(probs: Column, names: Sequence[str] = CLASSES) -> Column:
    """Name of the largest entry; the first one on a tie."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.array_position(probs, F.array_max(probs)).cast("int"))


def shift_to_flop(probs: Column, factor: Column) -> Column:
    """Hit mass times ``factor``; what is lost goes to Flop. Four decimals."""
    flop, fair, hit = (round_to(probs[i], 4) for i in range(3))
    return F.when(factor < 1.0, F.array(round_to(flop + hit * (1 - factor), 4), fair, round_to(hit * factor, 4))) \
        .otherwise(F.array(flop, fair, hit))


def margin_top2(probs: Column) -> Column:
    ranked = F.sort_array(probs, asc=False)
    return round_to(ranked[0] - ranked[1], 4)


def models_disagree(classes: Sequence[Column]) -> Column:
    return F.size(F.array_distinct(F.array(*classes))) > 1


def uncertainty_level(margin: Column, disagree: Column, cuts: tuple[float, float] = (0.12, 0.30)) -> Column:
    return (
        F.when(disagree | (margin < cuts[0]), vocab.LEVEL_HIGH)
        .when(margin < cuts[1], vocab.LEVEL_MEDIUM)
        .otherwise(vocab.LEVEL_LOW)
    )


def two_stage_funnel(p_traction: Column, probs: Column) -> Mapping[str, Column]:
    """Probability of no traction and of each class given traction."""
    out = {vocab.NO_TRACTION: round_to(1 - p_traction, 4)}
    for i, name in enumerate(CLASSES):
        out[name] = round_to(p_traction * probs[i], 4)
    return out


def viability(probs: Column) -> Column:
    return probs[1] + probs[2]


def gross_revenue(owners: Column, price: Column, share: float = 0.70) -> Column:
    return owners * price * share


def owners_from_log(y: Column) -> Column:
    """Back-transform of a log1p target: floored at zero and cut to an integer."""
    return F.greatest(F.lit(0.0), F.expm1(y)).cast("bigint")


def odds_ratio(coef: Column) -> Column:
    return F.exp(coef)
