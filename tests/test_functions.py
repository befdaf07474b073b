"""Edge cases of column functions on small frames."""

import math

import pytest
from pyspark.sql import functions as F

from shelfwise import vocab
from shelfwise.functions import features as X, parsing as P, scoring as K


def one(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_owners(spark):
    got = one(spark, ["100,000,000 .. 200,000,000", "", "abc", None], P.owners_lower_bound)
    assert got == [100_000_000, 0, 0, 0]


def test_ram(spark):
    assert one(spark, ["Memory: 8 GB RAM", "512 MB RAM", "Memory: 8 GB", None], P.min_ram_gb) == [8.0, 0.5, 0.0, 0.0]


def test_languages(spark):
    text = "English, Spanish, French<br>Languages with full audio: English"
    assert one(spark, [text, "", None], P.language_count) == [3, 0, 0]


def test_pseudonym(spark):
    got = one(spark, ["Valve", " Valve", None, "  ", "NULL"], P.pseudonym)
    assert got[0] == "094db509c61fd2da" and got[1] not in ("", got[0]) and got[2:] == ["", "", ""]


def test_dates(spark):
    for text, want in [("Jan 5, 2020", [2020, 1, "Q1"]), ("Coming soon", [0, 0, vocab.UNKNOWN]), (None, [0, 0, vocab.UNKNOWN])]:
        df = spark.createDataFrame([(text,)], "v string").select(*P.release_parts(F.col("v")).values())
        assert list(df.first()) == want


def test_price_tiers(spark):
    got = one(spark, [0.0, 9.99, 10.0, 19.99, 20.0, None], X.price_tier, "double")
    assert got == ["F2P", "Budget", "Mid", "Mid", "Premium", "F2P"]
    assert one(spark, [30.0], lambda c: X.price_tier(c, F.lit(True)), "double") == ["F2P"]


def test_tiers_and_labels(spark):
    assert one(spark, [2, 3, 9, 10], X.experience_tier, "int") == ["Novato", "Establecido", "Establecido", "AAA"]
    assert one(spark, [199_999, 200_000, 999_999, 1_000_000], X.success_label, "int") == [0, 1, 1, 2]


def test_clip_keeps_null(spark):
    assert one(spark, [None, 300.0, -1.0], lambda c: X.clip(c, 0.0, 200.0), "double") == [None, 200.0, 0.0]


def test_overprice(spark):
    got = one(spark, [70.0, 200.0, 1000.0], K.overprice_factor, "double")
    assert got[0] == 1.0 and got[1] == pytest.approx(0.0388, abs=1e-4) and got[2] == 0.02


def test_uncertainty(spark):
    got = one(spark, [0.11, 0.12, 0.30], lambda c: K.uncertainty_level(c, F.lit(False)), "double")
    assert got == ["alta", "media", "baja"]
    assert one(spark, [0.9], lambda c: K.uncertainty_level(c, F.lit(True)), "double") == ["alta"]


def test_funnel_sums_to_one(spark):
    df = spark.createDataFrame([([0.2, 0.5, 0.3], 0.37)], "p array<double>, t double")
    row = df.select(*K.two_stage_funnel(F.col("t"), F.col("p")).values()).first()
    assert math.isclose(sum(row), 1.0, abs_tol=2e-4)


def test_labels(spark):
    assert one(spark, ["tag_open_world", "genre_rpg", "tag_action_rpg"], P.pretty_label) == ["Open World", "RPG", "Action RPG"]
    assert one(spark, ["price", "tag_vr", "other"], P.feature_label) == ["Precio", "VR", "other"]


def test_vocabulary_names():
    assert vocab.flag_columns("tag_", vocab.TAGS)[30] == "tag_point_&_click"
    assert "cat_shared_split_screen_co_op" in vocab.flag_columns("cat_", vocab.CATEGORIES)
    assert [len(v) for v in (vocab.GENRES, vocab.CATEGORIES, vocab.TAGS)] == [14, 14, 50]
