"""Queries X1-X33: column functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise import vocab
from shelfwise.functions import features as X, parsing as P, scoring as K
from shelfwise.functions.rounding import round_to
from shelfwise.operators import filters as R, profile as PR
from shelfwise.plans import catalogue as C, catalogue_sql as S
from shelfwise.plans.registry import query


def _orders(spark, sf):
    return C.table(spark, sf, "orders")


_PRICE = "o_totalprice"


@query("x1_owners_lower_bound", """SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN 0
  ELSE CAST(floor(o_totalprice) AS BIGINT) END AS owners FROM orders""")
def x1(spark, sf):
    low = F.floor(_PRICE)
    text = F.when(F.col("o_orderpriority") == "5-LOW", "abc").otherwise(
        F.concat(F.format_number(low, 0), F.lit(" .. "), F.format_number(low * 2, 0)))
    return _orders(spark, sf).select("o_orderkey", P.owners_lower_bound(text).alias("owners"))


@query("x2_min_ram_gb", """SELECT o_orderkey, CASE o_custkey % 4 WHEN 0 THEN 0.0
  WHEN 1 THEN round_even((o_custkey % 4096) / 1024, 2) ELSE (o_custkey % 64) + 0.5 END AS ram FROM orders""")
def x2(spark, sf):
    k = F.col("o_custkey")
    text = F.when(k % 4 == 0, F.concat(F.lit("Memory: "), k, F.lit(" GB"))) \
        .when(k % 4 == 1, F.concat(F.lit("CPU: 2 GHz, "), k % 4096, F.lit("MB ram"))) \
        .otherwise(F.concat(F.lit("Memory: "), k % 64, F.lit(".5 GB RAM, or 99 GB RAM")))
    return _orders(spark, sf).select("o_orderkey", P.min_ram_gb(text).alias("ram"))


@query("x3_language_count", """SELECT doc_id, CAST(len(list_filter(string_split(regexp_replace(regexp_replace(text,
  '(?i)languages with[^\\n]*', '', 'g'), '<[^>]+>', '', 'g'), ','), lambda x: regexp_matches(x, '\\S'))) AS INTEGER) AS n_parts
  FROM documents""")
def x3(spark, sf):
    return C.table(spark, sf, "documents").select("doc_id", P.language_count(F.col("text")).alias("n_parts"))


@query("x4_strip_html", """SELECT page_id, md5(regexp_replace(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '^\\s+', ''),
  '\\s+$', '')) AS digest, CAST(length(regexp_replace(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '^\\s+', ''),
  '\\s+$', '')) AS INTEGER) AS n_chars FROM pages""")
def x4(spark, sf):
    text = P.strip_html(F.col("html"))
    return C.table(spark, sf, "pages").select("page_id", F.md5(text).alias("digest"), F.length(text).alias("n_chars"))


@query("x5_safe_casts", """SELECT event_id, coalesce(try_cast(regexp_extract(props, '\\d+') AS BIGINT), 0) AS k,
  CASE WHEN event_type = 'click' THEN -1 ELSE CAST(user_id AS BIGINT) END AS i,
  CASE WHEN event_type = 'view' THEN 0.0 ELSE value END AS d, event_type IN ('click', 'signup') AS b,
  CAST(floor(value) AS BIGINT) % 3 <> 0 AS n FROM events""")
def x5(spark, sf):
    e = F.col("event_type")
    k = F.get_json_object("props", "$.k")
    return C.table(spark, sf, "events").select(
        "event_id", P.safe_int(k).alias("k"),
        P.safe_int(F.when(e == "click", "1.0").otherwise(F.col("user_id").cast("string")), -1).alias("i"),
        P.safe_double(F.when(e == "view", "n/a").otherwise(F.col("value").cast("string"))).alias("d"),
        P.safe_bool(F.when(e == "click", "YES").when(e == "signup", "true").when(e == "error", "no")).alias("b"),
        P.safe_bool(F.floor("value") % 3).alias("n"))


@query("x6_price_usd", """SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN 0.0
  ELSE CAST(round(o_totalprice * 100) AS BIGINT) / 100.0 END AS price FROM orders""")
def x6(spark, sf):
    cents = F.rint(F.col(_PRICE) * 100).cast("bigint")
    return _orders(spark, sf).select("o_orderkey", P.price_usd(cents, F.col("o_orderpriority") == "5-LOW").alias("price"))


@query("x7_rating_percent", """SELECT o_orderkey, CASE WHEN o_custkey % 50 + o_orderkey % 70 > 0 THEN round_even(
  CAST(o_custkey % 50 AS DOUBLE) / (o_custkey % 50 + o_orderkey % 70) * 100, 2) ELSE 0.0 END AS rating FROM orders""")
def x7(spark, sf):
    return _orders(spark, sf).select(
        "o_orderkey", X.rating_percent(F.col("o_custkey") % 50, F.col("o_orderkey") % 70).alias("rating"))


@query("x8_join_names", """SELECT o_orderkey, CASE WHEN o_custkey % 4 = 0 THEN '' ELSE o_orderstatus || ', ' || o_orderpriority
  END AS names FROM orders""")
def x8(spark, sf):
    names = F.when(F.col("o_custkey") % 4 != 0, F.array("o_orderstatus", "o_orderpriority"))
    return _orders(spark, sf).select("o_orderkey", P.join_names(names).alias("names"))


@query("x11_month_of_epoch", "SELECT event_id, strftime(ts, '%Y-%m') AS month FROM events")
def x11(spark, sf):
    epoch = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return C.table(spark, sf, "events").select("event_id", P.month_of_epoch(epoch).alias("month"))


@query("x12_release_parts", """SELECT o_orderkey, CAST(CASE WHEN o_custkey % 4 = 3 THEN 0 ELSE year(o_orderdate) END AS INTEGER)
  AS release_year, CAST(CASE WHEN o_custkey % 4 = 3 THEN 0 ELSE month(o_orderdate) END AS INTEGER) AS release_month,
  CASE WHEN o_custkey % 4 = 3 THEN 'Desconocido' ELSE 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) END AS release_quarter
  FROM orders""")
def x12(spark, sf):
    d, k = F.col("o_orderdate"), F.col("o_custkey") % 4
    text = F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "MMM d, yyyy")) \
        .when(k == 2, F.date_format(d, "d MMM, yyyy")).otherwise("Coming soon")
    parts = P.release_parts(text)
    return _orders(spark, sf).select("o_orderkey", *[v.alias(n) for n, v in parts.items()])


@query("x13_price_tier", """SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' OR p <= 0 THEN 'F2P' WHEN p < 10 THEN 'Budget'
  WHEN p < 20 THEN 'Mid' ELSE 'Premium' END AS price_tier FROM (SELECT *, CAST(o_custkey % 40 AS DOUBLE) AS p FROM orders)""")
def x13(spark, sf):
    p = (F.col("o_custkey") % 40).cast("double")
    free = F.when(F.col("o_orderpriority") == "5-LOW", "1.0").otherwise("0")
    return _orders(spark, sf).select("o_orderkey", X.price_tier(p, free).alias("price_tier"))


@query("x14_experience_tier", """SELECT o_custkey, CASE WHEN n >= 10 THEN 'AAA' WHEN n >= 3 THEN 'Establecido' ELSE 'Novato' END
  AS tier FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)""")
def x14(spark, sf):
    counts = _orders(spark, sf).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("o_custkey", X.experience_tier(F.col("n")).alias("tier"))


@query("x15_success_label", """SELECT o_orderkey, CASE WHEN o_totalprice >= 400000 THEN 2 WHEN o_totalprice >= 140000 THEN 1
  ELSE 0 END AS label, CASE WHEN o_totalprice >= 400000 THEN 'Hit' WHEN o_totalprice >= 140000 THEN 'Rentable' ELSE 'Flop' END
  AS label_name FROM orders""")
def x15(spark, sf):
    label = X.success_label(F.col(_PRICE), C.FLOP_MAX, C.HIT_MIN)
    return _orders(spark, sf).select("o_orderkey", label.alias("label"), X.label_name(label).alias("label_name"))


@query("x16_clip", """SELECT event_id, CASE WHEN v > 200 THEN 200.0 ELSE v END AS capped, CASE WHEN v < 0 THEN 0.0 ELSE v END AS floored,
  CASE WHEN v > 70 THEN 70.0 WHEN v < 0 THEN 0.0 ELSE v END AS both FROM (
  SELECT event_id, CASE WHEN event_type = 'view' THEN NULL ELSE value - 20 END AS v FROM events)""")
def x16(spark, sf):
    v = F.when(F.col("event_type") != "view", F.col("value") - 20)
    return C.table(spark, sf, "events").select(
        "event_id", X.clip(v, high=200.0).alias("capped"), X.clip(v, low=0.0).alias("floored"),
        X.clip(v, 0.0, 70.0).alias("both"))


@query("x17_flag_sums", f"""WITH {S.RAW} SELECT appid, {' + '.join(C.GENRE_FLAGS)} AS num_genres,
  {' + '.join(C.TAG_FLAGS)} AS num_tags, {' + '.join(C.CAT_FLAGS)} AS num_categories FROM tags""")
def x17(spark, sf):
    t = C.tags(spark, sf)
    return t.select("appid", *[X.flag_sum(R.columns_with_prefix(t, p)).alias(n) for n, p in (
        ("num_genres", "genre_"), ("num_tags", "tag_"), ("num_categories", "cat_"))])


@query("x18_any_flag", f"WITH {S.RAW} SELECT appid, CAST(genre_early_access + tag_brand_1 > 0 AS INTEGER) AS early FROM tags")
def x18(spark, sf):
    return C.tags(spark, sf).select("appid", X.any_flag(["genre_early_access", "tag_brand_1"]).alias("early"))


@query("x19_text_length", "SELECT doc_id, CAST(length(text) AS INTEGER) AS n FROM documents")
def x19(spark, sf):
    return C.table(spark, sf, "documents").select("doc_id", P.text_length(F.col("text")).alias("n"))


@query("x20_pseudonym", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '' ELSE substr(sha256(name), 1, 16) END AS pid
  FROM (SELECT *, CASE WHEN o_orderstatus = 'F' THEN ' ' || o_orderpriority ELSE o_orderpriority END AS name FROM orders)""")
def x20(spark, sf):
    name = F.when(F.col("o_orderstatus") == "P", F.when(F.col("o_custkey") % 2 == 0, " ").otherwise("Null")) \
        .when(F.col("o_orderstatus") == "F", F.concat(F.lit(" "), "o_orderpriority")).otherwise(F.col("o_orderpriority"))
    return _orders(spark, sf).select("o_orderkey", P.pseudonym(name).alias("pid"))


@query("x21_strip_lower", "SELECT o_orderkey, lower(o_orderpriority) AS name FROM orders")
def x21(spark, sf):
    padded = F.concat(F.lit("\t "), "o_orderpriority", F.lit(" \n"))
    return _orders(spark, sf).select("o_orderkey", F.lower(P.strip(padded)).alias("name"))


@query("x22_labels", """SELECT p_partkey, upper(substr(w1, 1, 1)) || substr(w1, 2) || ' ' || upper(substr(w2, 1, 1)) || substr(w2, 2)
  || ' RPG' AS flag_label, CASE WHEN p_partkey % 2 = 0 THEN 'Precio' ELSE p_name END AS feature_label FROM (
  SELECT *, split_part(p_name, ' ', 1) AS w1, split_part(p_name, ' ', 2) AS w2 FROM part)""")
def x22(spark, sf):
    flag = F.concat(F.lit("tag_"), F.translate("p_name", " ", "_"), F.lit("_rpg"))
    other = F.when(F.col("p_partkey") % 2 == 0, "price").otherwise(F.col("p_name"))
    return C.table(spark, sf, "part").select("p_partkey", P.pretty_label(flag).alias("flag_label"),
                                             P.feature_label(other).alias("feature_label"))


@query("x23_impute", """SELECT event_id, CASE WHEN event_type = 'click' THEN (SELECT median(value) FROM events
  WHERE event_type <> 'click') ELSE value END AS value, CASE WHEN event_type = 'view' THEN 0 ELSE 1 END AS is_other,
  CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS kind FROM events""")
def x23(spark, sf):
    e = F.col("event_type")
    df = C.table(spark, sf, "events").select(
        "event_id", F.when(e != "click", F.col("value")).alias("value"), F.when(e != "view", 1).alias("is_other"),
        F.when(e != "error", e).alias("kind"))
    return PR.impute(df, ["is_other"])


@query("x24_log_target", """SELECT o_orderkey, round_even(ln(1 + o_totalprice), 6) AS y,
  CAST(floor(o_totalprice) AS BIGINT) AS owners FROM orders""")
def x24(spark, sf):
    y = F.log1p(F.floor(_PRICE))
    return _orders(spark, sf).select("o_orderkey", round_to(F.log1p(_PRICE), 6).alias("y"),
                                     K.owners_from_log(y + 1e-9).alias("owners"))


@query("x25_overprice_factor", """SELECT event_id, round_even(CASE WHEN value <= 70 THEN 1.0
  ELSE greatest(0.02, exp(-(value - 70) / 40)) END, 6) AS factor FROM events""")
def x25(spark, sf):
    return C.table(spark, sf, "events").select("event_id", round_to(K.overprice_factor(F.col("value")), 6).alias("factor"))


@query("x26_odds_ratio", "SELECT event_id, round_even(exp(value / 100), 6) AS odds FROM events")
def x26(spark, sf):
    return C.table(spark, sf, "events").select("event_id", round_to(K.odds_ratio(F.col("value") / 100), 6).alias("odds"))


# Class probabilities from three components of a vector.
_PROBS_SQL = """probs AS (SELECT vec_id, a / (a + b + c) AS p0, b / (a + b + c) AS p1, c / (a + b + c) AS p2,
  1 - a / (a + b + c) AS pt, 40.0 + vec_id % 100 AS price FROM (SELECT vec_id,
  CAST(embedding[1] AS DOUBLE) * embedding[1] + 0.001 AS a, CAST(embedding[2] AS DOUBLE) * embedding[2] + 0.001 AS b,
  CAST(embedding[3] AS DOUBLE) * embedding[3] + 0.001 AS c FROM embeddings))"""
_ARGMAX = "CASE WHEN p0 >= p1 AND p0 >= p2 THEN 'Flop' WHEN p1 >= p2 THEN 'Rentable' ELSE 'Hit' END"


def _probs(spark, sf):
    sq = lambda i: F.col("embedding")[i].cast("double") * F.col("embedding")[i] + 0.001
    raw = C.table(spark, sf, "embeddings").select("vec_id", *[sq(i).alias(n) for i, n in enumerate("abc")])
    total = F.col("a") + F.col("b") + F.col("c")
    probs = F.array(*[F.col(n) / total for n in "abc"])
    return raw.select("vec_id", probs.alias("probs"), (1 - F.col("a") / total).alias("pt"),
                      (40.0 + F.col("vec_id") % 100).alias("price"))


@query("x27_argmax_class", f"WITH {_PROBS_SQL} SELECT vec_id, {_ARGMAX} AS clase FROM probs")
def x27(spark, sf):
    return _probs(spark, sf).select("vec_id", K.argmax_class(F.col("probs")).alias("clase"))


@query("x28_uncertainty", f"""WITH {_PROBS_SQL}, m AS (SELECT vec_id, round_even(greatest(p0, p1, p2) - (p0 + p1 + p2
  - greatest(p0, p1, p2) - least(p0, p1, p2)), 4) AS margin, {_ARGMAX} <> 'Flop' AS apart FROM probs)
  SELECT vec_id, margin, apart, CASE WHEN apart OR margin < 0.12 THEN 'alta' WHEN margin < 0.30 THEN 'media' ELSE 'baja' END
  AS nivel FROM m""")
def x28(spark, sf):
    p = _probs(spark, sf).withColumn("margin", K.margin_top2(F.col("probs"))).withColumn(
        "apart", K.models_disagree([K.argmax_class(F.col("probs")), F.lit("Flop")]))
    return p.select("vec_id", "margin", "apart", K.uncertainty_level(F.col("margin"), F.col("apart")).alias("nivel"))


_R = "round_even({}, 4)"
_SHIFT_SQL = f"""{_PROBS_SQL}, f AS (SELECT *, CASE WHEN price <= 70 THEN 1.0 ELSE greatest(0.02, exp(-(price - 70) / 40)) END AS f
  FROM probs), s AS (SELECT vec_id, pt, CASE WHEN f < 1 THEN {_R.format(_R.format('p0') + ' + ' + _R.format('p2') + ' * (1 - f)')}
  ELSE {_R.format('p0')} END AS p0, {_R.format('p1')} AS p1,
  CASE WHEN f < 1 THEN {_R.format(_R.format('p2') + ' * f')} ELSE {_R.format('p2')} END AS p2 FROM f)"""


def _shifted(spark, sf):
    p = _probs(spark, sf)
    return p.withColumn("probs", K.shift_to_flop(F.col("probs"), K.overprice_factor(F.col("price"))))


@query("x29_shift_to_flop", f"WITH {_SHIFT_SQL} SELECT vec_id, p0, p1, p2, {_ARGMAX} AS clase FROM s")
def x29(spark, sf):
    return _shifted(spark, sf).select("vec_id", *[F.col("probs")[i].alias(f"p{i}") for i in range(3)],
                                      K.argmax_class(F.col("probs")).alias("clase"))


@query("x30_two_stage_funnel", f"""WITH {_SHIFT_SQL} SELECT vec_id, round_even(1 - pt, 4) AS notraccion, {', '.join(
    _R.format(f'pt * p{i}') + ' AS ' + n for i, n in enumerate(('flop', 'rentable', 'hit')))} FROM s""")
def x30(spark, sf):
    f = K.two_stage_funnel(F.col("pt"), F.col("probs"))
    return _shifted(spark, sf).select("vec_id", *[v.alias(k.lower()) for k, v in f.items()])


@query("x31_viability", f"WITH {_PROBS_SQL} SELECT vec_id, round_even(p1 + p2, 6) AS viability FROM probs")
def x31(spark, sf):
    return _probs(spark, sf).select("vec_id", round_to(K.viability(F.col("probs")), 6).alias("viability"))


@query("x32_gross_revenue", f"""WITH {S.RAW} SELECT appid, round_even(owners_lower_bound * price * 0.70, 2) AS revenue FROM meta""")
def x32(spark, sf):
    return C.metadata(spark, sf).select(
        "appid", round_to(K.gross_revenue(F.col("owners_lower_bound"), F.col("price")), 2).alias("revenue"))


@query("x33_unreleased_date", """SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN ''
  ELSE strftime(o_orderdate, '%Y-%m-%d') END AS release_date FROM orders""")
def x33(spark, sf):
    d = P.released_date_text(F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderpriority") == "1-URGENT")
    return _orders(spark, sf).select("o_orderkey", d.alias("release_date"))
