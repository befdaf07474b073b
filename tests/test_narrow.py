"""Wide tables on the way to the feature tables: what is shuffled by producer, and how columns are profiled."""

from pyspark.sql import functions as F

from shelfwise.operators import profile as PR
from shelfwise.plans import catalogue as C, master as B


def test_flags_of_lines_are_shuffled_as_one_number(spark, tmp_path):
    lines = [(1, 10, "A", "O", 0.1), (1, 11, None, "F", 0.0), (2, 12, None, None, None), (3, 99, "R", "F", 0.0), (None, 10, "N", "O", 0.0)]
    parts = [(10, "PROMO", "Brand#3"), (11, "SMALL", None), (12, None, "Brand#25")]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_returnflag string, l_linestatus string, l_discount double") \
        .write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(parts, "p_partkey long, p_type string, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    df = C.tags(spark, str(tmp_path))
    got = {r["appid"]: r for r in df.collect()}
    assert df.columns == ["appid", *C.FLAGS] and {t for _, t in df.dtypes[1:]} == {"int"}
    assert set(got) == {1, 2, None}
    assert [got[1][c] for c in ("genre_promo", "genre_small", "genre_large", "genre_early_access", "cat_a", "cat_r", "cat_o", "cat_f", "tag_brand_3", "tag_brand_4")] \
        == [1, 1, 0, 1, 1, 0, 1, 1, 1, 0]
    # A flag is null where its column is null on all lines.
    assert [got[2][c] for c in ("genre_promo", "genre_early_access", "cat_n", "cat_f", "tag_brand_25", "tag_brand_1")] == [None, None, None, None, 1, 0]
    assert got[None]["cat_n"] == 1 and got[None]["genre_promo"] == 1
    assert "partial_bit_or" in df._jdf.queryExecution().executedPlan().toString()


def test_producers_are_joined_without_the_other_columns(spark):
    rows = [(1, "a", "p", 10, "x" * 50), (2, "a", None, 0, "y"), (3, "a", "p", 500, "z"), (4, "b", "q", 5, "u"), (5, None, "q", 500, "v"), (None, "b", "q", 500, "w")]
    first = spark.createDataFrame(rows, "appid long, developer string, publisher string, owners_lower_bound long, name string")
    # Item 3 is tagged twice and counts twice, item 2 has no owners, item 4 no tags.
    tags = spark.createDataFrame([(1,), (2,), (3,), (3,), (5,), (None,)], "appid long")
    made = B.producer_columns(first, tags, (100, 400))
    assert made.columns == ["appid", "dev_game_count", "dev_experience", "pub_game_count", "pub_experience", "dev_success_prior"]
    got = {r["appid"]: r for r in made.collect()}
    assert {k: (r["dev_game_count"], r["pub_game_count"]) for k, r in got.items() if k} == {1: (3, 2), 3: (3, 2), 4: (1, 2), 5: (1, 2)}
    p0 = 3 / 4  # of 1, 3, 3 and 5
    assert got[1]["dev_success_prior"] == round((2 - 0 + 12 * p0) / (3 - 1 + 12), 4)
    assert got[3]["dev_success_prior"] == round((2 - 1 + 12 * p0) / (3 - 1 + 12), 4)
    assert got[5]["dev_success_prior"] is None
    plain = {r["appid"]: r["dev_game_count"] for r in B.producer_columns(first, tags).collect()}
    assert {k: plain[k] for k in (1, 2, 3, 4, 5)} == {1: 3, 2: 3, 3: 3, 4: 1, 5: 1}


def test_wide_tables_are_profiled_in_compiled_pieces(spark):
    cols = [f"c{i}" for i in range(40)]
    df = spark.range(2000).select(*[F.when(F.col("id") % 2000 >= i, i).otherwise(F.col("id")).alias(c) for i, c in enumerate(cols)])
    shares = PR.top_shares(df, cols)
    got = {r["column"]: (r["top_share"], r["single_value"]) for r in shares.collect()}
    assert list(got) and set(got) == set(cols)
    assert got["c0"] == (1.0, True) and got["c30"] == (1970 / 2000, False)
    plan = shares._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("stack(") + plan.count("Generate ") >= 3
