"""The four catalogue tables, bound to the order and product tables of a data folder.

Every binding has its twin in ANSI SQL, for checks on another engine.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfwise.functions import features as X
from shelfwise.functions.rounding import round_to

# Cut points for the bound owner figures: 28 / 52 / 20 % of the orders.
FLOP_MAX, HIT_MIN = 140_000, 400_000
PART_TYPES = ("STANDARD", "PROMO", "LARGE", "ECONOMY", "SMALL", "MEDIUM")
BRANDS = tuple(range(1, 26))
GENRE_FLAGS = tuple(f"genre_{t.lower()}" for t in PART_TYPES) + ("genre_early_access",)
CAT_FLAGS = ("cat_a", "cat_n", "cat_r", "cat_o", "cat_f")
TAG_FLAGS = tuple(f"tag_brand_{b}" for b in BRANDS)
FLAGS = GENRE_FLAGS + CAT_FLAGS + TAG_FLAGS


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def item_names(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with the customer as developer and its nation as publisher."""
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    nation = table(spark, sf, "nation")
    return orders.join(customer, orders.o_custkey == customer.c_custkey, "left") \
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")


def metadata(spark: SparkSession, sf: str) -> DataFrame:
    """games_metadata, one row per order."""
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.sum("l_quantity").cast("bigint").alias("qty"), F.count(F.lit(1)).alias("n_lines"))
    df = item_names(spark, sf).join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    whole = F.floor("o_totalprice").cast("bigint")
    positive, negative = F.floor(F.col("o_totalprice") / 1000).cast("bigint"), F.col("o_custkey") % 50
    free = F.col("o_orderpriority") == "5-LOW"
    return df.select(
        F.col("o_orderkey").alias("appid"),
        F.concat("c_mktsegment", F.lit(" "), F.col("o_orderkey").cast("string")).alias("name"),
        F.col("c_name").alias("developer"), F.col("n_name").alias("publisher"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("release_date"),
        F.when(free, 0.0).otherwise(round_to(F.abs("c_acctbal") / 100, 2)).alias("price"),
        free.cast("int").alias("is_free"),
        F.when(F.col("o_totalprice") < 20000, 0).otherwise(whole).cast("bigint").alias("owners_lower_bound"),
        (F.col("o_custkey") % 1000).alias("ccu"),
        X.rating_percent(positive, negative).alias("rating_porcentaje"),
        positive.alias("positive"), negative.alias("negative"),
        (F.col("o_orderkey") % 101).alias("metacritic_score"), F.lit(0).cast("bigint").alias("hub_followers"),
        F.coalesce("qty", F.lit(0)).alias("total_achievements"), F.coalesce("n_lines", F.lit(0)).alias("total_dlcs"),
        (F.col("o_custkey") % 29).alias("supported_languages"),
        F.when(F.col("o_orderstatus") == "F", "full").when(F.col("o_orderstatus") == "P", "partial")
        .otherwise("none").alias("controller_support"),
        (F.col("o_orderpriority") != "4-NOT SPECIFIED").cast("int").alias("platform_windows"),
        (F.col("o_orderpriority") == "2-HIGH").cast("int").alias("platform_mac"),
        (F.col("o_orderpriority") == "3-MEDIUM").cast("int").alias("platform_linux"),
        F.pow(F.lit(2.0), (F.col("o_custkey") % 5).cast("double")).alias("min_ram_gb"),
    )


METADATA_SQL = """
SELECT o.o_orderkey AS appid, c.c_mktsegment || ' ' || CAST(o.o_orderkey AS VARCHAR) AS name,
  c.c_name AS developer, n.n_name AS publisher, strftime(o.o_orderdate, '%Y-%m-%d') AS release_date,
  CASE WHEN o.o_orderpriority = '5-LOW' THEN 0.0 ELSE round_even(abs(c.c_acctbal) / 100, 2) END AS price,
  CAST(o.o_orderpriority = '5-LOW' AS INTEGER) AS is_free,
  CAST(CASE WHEN o.o_totalprice < 20000 THEN 0 ELSE floor(o.o_totalprice) END AS BIGINT) AS owners_lower_bound,
  o.o_custkey % 1000 AS ccu,
  CASE WHEN floor(o.o_totalprice / 1000) + o.o_custkey % 50 > 0
    THEN round_even(floor(o.o_totalprice / 1000) / (floor(o.o_totalprice / 1000) + o.o_custkey % 50) * 100, 2) ELSE 0.0 END
    AS rating_porcentaje,
  CAST(floor(o.o_totalprice / 1000) AS BIGINT) AS positive, o.o_custkey % 50 AS negative,
  o.o_orderkey % 101 AS metacritic_score, CAST(0 AS BIGINT) AS hub_followers,
  CAST(coalesce(l.qty, 0) AS BIGINT) AS total_achievements, CAST(coalesce(l.n_lines, 0) AS BIGINT) AS total_dlcs,
  o.o_custkey % 29 AS supported_languages,
  CASE o.o_orderstatus WHEN 'F' THEN 'full' WHEN 'P' THEN 'partial' ELSE 'none' END AS controller_support,
  CAST(o.o_orderpriority <> '4-NOT SPECIFIED' AS INTEGER) AS platform_windows,
  CAST(o.o_orderpriority = '2-HIGH' AS INTEGER) AS platform_mac,
  CAST(o.o_orderpriority = '3-MEDIUM' AS INTEGER) AS platform_linux,
  pow(2.0, o.o_custkey % 5) AS min_ram_gb
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS qty, count(*) AS n_lines FROM lineitem GROUP BY 1) l
  ON o.o_orderkey = l.l_orderkey
"""


def _bits(tests: dict[str, Column], known: dict[str, Column]) -> Column:
    """One number with a bit for each flag whose test holds, and one for each group of flags whose column is not null."""
    at = {name: i for i, name in enumerate((*FLAGS, *_KNOWN))}
    parts = [F.when(test, F.lit(1 << at[name]).cast("bigint")).otherwise(F.lit(0).cast("bigint")) for name, test in (tests | known).items()]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


#: Groups of flags that come from one column, and are null where that is null on all lines of an order.
_KNOWN = {"_type": GENRE_FLAGS[:-1], "_discount": GENRE_FLAGS[-1:], "_return": CAT_FLAGS[:3], "_status": CAT_FLAGS[3:], "_brand": TAG_FLAGS}


def tags(spark: SparkSession, sf: str) -> DataFrame:
    """games_tags: flags of the part types and brands and of the line states of an order.

    The flags of a line are the bits of one number until the order is known, so a line or order is shuffled as 16 bytes.
    """
    discount, state, status, kind, brand = (F.col(c) for c in ("l_discount", "l_returnflag", "l_linestatus", "p_type", "p_brand"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", _bits(
        {"genre_early_access": discount >= 0.095, **{f"cat_{s.lower()}": state == s for s in "ANR"},
         **{f"cat_{s.lower()}": status == s for s in "OF"}},
        {"_discount": discount.isNotNull(), "_return": state.isNotNull(), "_status": status.isNotNull()}).alias("_line"))
    part = table(spark, sf, "part").select("p_partkey", _bits(
        {**{f"genre_{t.lower()}": kind == t for t in PART_TYPES}, **{f"tag_brand_{b}": brand == f"Brand#{b}" for b in BRANDS}},
        {"_type": kind.isNotNull(), "_brand": brand.isNotNull()}).alias("_part"))
    df = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("l_orderkey").alias("appid")) \
        .agg(F.bit_or(F.col("_line").bitwiseOR(F.col("_part"))).alias("_bits"))
    bit = {name: F.shiftright("_bits", i).bitwiseAND(F.lit(1).cast("bigint")) for i, name in enumerate((*FLAGS, *_KNOWN))}
    return df.select("appid", *[F.when(bit[group] == 1, bit[f].cast("int")).alias(f) for group, flags in _KNOWN.items() for f in flags])


def _max_flag(test: str, name: str) -> str:
    return f"max(CAST({test} AS INTEGER)) AS {name}"


TAGS_SQL = "SELECT l_orderkey AS appid, " + ", ".join(
    [_max_flag(f"p_type = '{t}'", f"genre_{t.lower()}") for t in PART_TYPES]
    + [_max_flag("l_discount >= 0.095", "genre_early_access")]
    + [_max_flag(f"l_returnflag = '{s}'", f"cat_{s.lower()}") for s in "ANR"]
    + [_max_flag(f"l_linestatus = '{s}'", f"cat_{s.lower()}") for s in "OF"]
    + [_max_flag(f"p_brand = 'Brand#{b}'", f"tag_brand_{b}") for b in BRANDS]
) + " FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey"


def text(spark: SparkSession, sf: str) -> DataFrame:
    """games_text: document i describes item i; later items have none."""
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("appid"), F.col("text").alias("short_description"),
        F.lit("").alias("about_the_game"), F.lit("").alias("reviews_text_sample"))


TEXT_SQL = """SELECT doc_id AS appid, text AS short_description, '' AS about_the_game, '' AS reviews_text_sample
FROM documents"""


def panel(spark: SparkSession, sf: str) -> DataFrame:
    """games_timeseries: lines per order and month of shipment."""
    lines = table(spark, sf, "lineitem")
    return lines.groupBy(F.col("l_orderkey").alias("appid"), F.date_format("l_shipdate", "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("review_count"),
        F.count_if(F.col("l_returnflag") != "R").alias("positive_count"),
        F.count_if(F.col("l_returnflag") == "R").alias("negative_count"),
        F.count_if(F.col("l_linestatus") == "O").alias("steam_purchase_count"),
        F.count_if(F.col("l_discount") >= 0.095).alias("early_access_count"),
        round_to(F.sum("l_quantity") / F.count(F.lit(1)) / 60, 2).alias("avg_playtime_at_review_hrs"))


PANEL_SQL = """
SELECT l_orderkey AS appid, strftime(l_shipdate, '%Y-%m') AS month, count(*) AS review_count,
  count(*) FILTER (WHERE l_returnflag <> 'R') AS positive_count,
  count(*) FILTER (WHERE l_returnflag = 'R') AS negative_count,
  count(*) FILTER (WHERE l_linestatus = 'O') AS steam_purchase_count,
  count(*) FILTER (WHERE l_discount >= 0.095) AS early_access_count,
  round_even(sum(l_quantity) / count(*) / 60, 2) AS avg_playtime_at_review_hrs
FROM lineitem GROUP BY 1, 2
"""
