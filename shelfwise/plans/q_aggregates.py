"""Queries A1-A27 and the feature tables themselves."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise import vocab
from shelfwise.functions import features as X, parsing as P
from shelfwise.functions.rounding import round_to
from shelfwise.operators import aggregates as A, filters as R, ordered as O, profile as PR, shrinkage as H
from shelfwise.plans import catalogue as C, catalogue_sql as S
from shelfwise.plans.data import master, stage1, stored
from shelfwise.plans.q_rows import _COMPLETE_SQL, _NAMES_SQL, _enriched, _names
from shelfwise.plans.q_sources import REVIEWS_SQL, review_payloads
from shelfwise.plans.registry import query
from shelfwise.session import materialise
from shelfwise.sources import payloads as L, tables as T

_FLAG_COLS = C.FLAGS + ("is_free", "is_early_access", "platform_windows", "platform_mac", "platform_linux")


@query("a1_row_count", "SELECT count(*) AS n FROM lineitem")
def a1(spark, sf):
    return A.row_count(C.table(spark, sf, "lineitem"))


@query("a2_distinct_valid", f"""WITH {S.RAW} SELECT 'developer' AS "column", count(DISTINCT developer) AS n_distinct FROM meta
  UNION ALL SELECT 'publisher', count(DISTINCT publisher) FROM meta""")
def a2(spark, sf):
    return A.distinct_valid(C.metadata(spark, sf), ["developer", "publisher"])


@query("a3_flag_totals", f"""WITH {S.RAW} SELECT replace(genre, 'genre_', '') AS genre, CAST(sum(v) AS BIGINT) AS n
  FROM (UNPIVOT tags ON COLUMNS('genre_.*') INTO NAME genre VALUE v) GROUP BY 1 ORDER BY n DESC, genre LIMIT 10""")
def a3(spark, sf):
    return A.flag_totals(C.tags(spark, sf), C.GENRE_FLAGS)


@query("a4_group_sizes", f"""WITH {S.RAW} SELECT appid, CAST(n AS INTEGER) AS dev_game_count, {S._tier('n')} AS dev_experience
  FROM (SELECT appid, CASE WHEN developer IS NULL THEN 1 ELSE count(*) OVER (PARTITION BY developer) END AS n
    FROM (SELECT appid, CASE WHEN appid % 7 = 0 THEN NULL ELSE developer END AS developer FROM meta))""")
def a4(spark, sf):
    m = C.metadata(spark, sf).select("appid", F.when(F.col("appid") % 7 != 0, F.col("developer")).alias("developer"))
    return A.with_experience(m, "developer", "dev").drop("developer")


@query("a5_review_panel", f"""SELECT appid, strftime(make_timestamp(timestamp_created * 1000000), '%Y-%m') AS month,
  count(*) AS review_count, count(*) FILTER (WHERE voted_up) AS positive_count,
  count(*) FILTER (WHERE NOT voted_up) AS negative_count, count(*) FILTER (WHERE steam_purchase) AS steam_purchase_count,
  count(*) FILTER (WHERE written_during_early_access) AS early_access_count,
  round_even(CAST(sum(playtime_at_review) AS DOUBLE) / count(*) / 60, 2) AS avg_playtime_at_review_hrs
  FROM ({REVIEWS_SQL}) WHERE timestamp_created >= 1704067200 + 86400 * 3 GROUP BY 1, 2""")
def a5(spark, sf):
    c = F.col
    return A.review_panel(L.review_rows(review_payloads(spark, sf)), "appid", c("timestamp_created"), c("voted_up"),
                          c("steam_purchase"), c("written_during_early_access"), c("playtime_at_review"),
                          vocab.REVIEW_START_EPOCH + 86400 * 3)


@query("a6_collapse_panel", f"WITH {S.RAW} {S.COLLAPSED}")
def a6(spark, sf):
    return A.collapse_panel(C.panel(spark, sf))


@query("a7_class_shares", f"""WITH {S.RAW} SELECT {S.LABEL} AS label, count(*) AS n,
  round_even(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM meta), 3) AS share FROM meta GROUP BY 1""")
def a7(spark, sf):
    m = C.metadata(spark, sf).select(X.success_label(F.col("owners_lower_bound"), C.FLOP_MAX, C.HIT_MIN).alias("label"))
    return A.class_shares(m, "label")


@query("a8_market_split", f"""WITH {S.RAW} SELECT c.clase, count(m.appid) AS n FROM (VALUES ('Flop', 0), ('Rentable', 1), ('Hit', 2))
  c(clase, k) LEFT JOIN (SELECT appid, {S.LABEL} AS label FROM meta) m ON m.label = c.k GROUP BY 1""")
def a8(spark, sf):
    m = C.metadata(spark, sf).select(
        X.label_name(X.success_label(F.col("owners_lower_bound"), C.FLOP_MAX, C.HIT_MIN)).alias("label_name"))
    return A.market_split(m)


_BINS = list(zip(vocab.PRICE_BIN_LABELS, vocab.PRICE_BINS, vocab.PRICE_BINS[1:]))


@query("a9_price_histogram", "SELECT b.label, count(e.event_id) AS \"count\" FROM (VALUES "
       + ", ".join(f"('{n}', {lo}, {hi})" for n, lo, hi in _BINS)
       + ") b(label, lo, hi) LEFT JOIN events e ON greatest(e.value - 1, 0) >= b.lo AND greatest(e.value - 1, 0) < b.hi GROUP BY 1")
def a9(spark, sf):
    return A.price_histogram(C.table(spark, sf, "events").select((F.col("value") - 1).alias("price")))


@query("a10_owners_by_flag", f"""WITH {S.RAW}, g AS (SELECT genre, count(*) AS n, median(owners_lower_bound) AS med,
  round_even(avg(CAST(label = 2 AS INTEGER)) * 100, 1) AS pct_hit FROM (UNPIVOT (SELECT owners_lower_bound, {S.LABEL} AS label,
  {', '.join(C.GENRE_FLAGS)} FROM meta JOIN tags USING (appid)) ON {', '.join(C.GENRE_FLAGS)} INTO NAME genre VALUE v)
  WHERE v = 1 GROUP BY 1 HAVING count(*) >= 30) SELECT upper(substr(genre, 7, 1)) || replace(substr(genre, 8), '_a', ' A') AS genero,
  n, CAST(floor(med) AS BIGINT) AS owners_mediana, pct_hit FROM g ORDER BY owners_mediana DESC, genero LIMIT 12""")
def a10(spark, sf):
    m = C.metadata(spark, sf).select("appid", "owners_lower_bound", X.success_label(
        F.col("owners_lower_bound"), C.FLOP_MAX, C.HIT_MIN).alias("label"))
    rows = m.join(C.tags(spark, sf), "appid").select("owners_lower_bound", "label", *C.GENRE_FLAGS)
    return A.owners_by_flag(materialise(rows, "flags"), C.GENRE_FLAGS, "owners_lower_bound", "label")


@query("a11_hits_by_quarter", """SELECT 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS q, count(*) AS n,
  round_even(avg(CAST(o_totalprice >= 400000 AS INTEGER)) * 100, 1) AS pct_hit,
  round_even(avg(CAST(o_totalprice >= 140000 AS INTEGER)) * 100, 1) AS pct_exito FROM orders GROUP BY 1 HAVING count(*) >= 20""")
def a11(spark, sf):
    return A.hits_by_quarter(C.table(spark, sf, "orders"), F.concat(F.lit("Q"), F.quarter("o_orderdate").cast("string")),
                             X.success_label(F.col("o_totalprice"), C.FLOP_MAX, C.HIT_MIN))


_DEV = f"""{S.RAW}, lab AS (SELECT appid, developer, {S.LABEL} AS label FROM meta WHERE owners_lower_bound > 0),
  p0 AS (SELECT avg(CAST(label >= 1 AS INTEGER)) AS p FROM lab)"""


def _labelled(spark, sf):
    m = R.with_estimate(C.metadata(spark, sf))
    return m.select("appid", "developer", X.success_label(F.col("owners_lower_bound"), C.FLOP_MAX, C.HIT_MIN).alias("label"))


@query("a12_success_prior", f"""WITH {_DEV}, d AS (SELECT developer, count(*) AS n, sum(CAST(label >= 1 AS INTEGER)) AS s FROM lab
  GROUP BY 1) SELECT appid, developer, label, round_even((s - CAST(label >= 1 AS INTEGER) + p * 12.0) / (n - 1 + p * 12.0
  + (1 - p) * 12.0), 4) AS dev_success_prior, round_even(p, 4) AS global_prior FROM lab JOIN d USING (developer), p0""")
def a12(spark, sf):
    return H.leave_one_out_prior(_labelled(spark, sf), global_name="global_prior")


_FIT = f"""{_DEV}, d AS (SELECT developer, count(*) AS n, CAST(sum(CAST(label >= 1 AS INTEGER)) AS BIGINT) AS k FROM lab GROUP BY 1),
  mv AS (SELECT avg(k / n) AS m, var_samp(k / n) AS v FROM d WHERE n >= 2),
  fit AS (SELECT m, v, CASE WHEN v > 0 THEN greatest(m * (1 - m) / v - 1, 1.0) ELSE 50.0 END AS kappa FROM mv)"""


def _fit(spark, sf):
    counts = H.producer_counts(_labelled(spark, sf), "developer", F.col("label") >= 1)
    return counts, H.beta_fit(counts)


@query("a13_beta_fit", f"""WITH {_FIT} SELECT round_even(m, 8) AS m, round_even(v, 8) AS v, round_even(kappa, 6) AS kappa,
  round_even(m * kappa, 6) AS alpha, round_even((1 - m) * kappa, 6) AS beta FROM fit""")
def a13(spark, sf):
    fit = _fit(spark, sf)[1]
    return fit.select(round_to("m", 8).alias("m"), round_to("v", 8).alias("v"),
                      *[round_to(c, 6).alias(c) for c in ("kappa", "alpha", "beta")])


@query("a14_posterior", f"""WITH {_FIT} SELECT developer, n, k, round_even(k / n, 6) AS p_raw,
  round_even((k + m * kappa) / (n + m * kappa + (1 - m) * kappa), 6) AS p_shrunk,
  round_even(abs(k / n - (k + m * kappa) / (n + m * kappa + (1 - m) * kappa)), 3) AS shrinkage FROM d, fit""")
def a14(spark, sf):
    counts, fit = _fit(spark, sf)
    return H.posterior(counts, fit, "developer").select(
        "developer", "n", "k", round_to("p_raw", 6).alias("p_raw"), round_to("p_shrunk", 6).alias("p_shrunk"), "shrinkage")


_HOLES_SQL = """holes AS (SELECT o_orderkey, CASE WHEN o_custkey % 5 = 0 THEN NULL WHEN o_custkey % 5 = 1 THEN ' '
  ELSE o_orderpriority END AS priority, CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE o_totalprice END AS price,
  o_orderstatus FROM orders)"""


def _holes(spark, sf):
    k = F.col("o_custkey")
    return C.table(spark, sf, "orders").select(
        "o_orderkey", F.when(k % 5 == 1, " ").when(k % 5 != 0, F.col("o_orderpriority")).alias("priority"),
        F.when(k % 3 != 0, F.col("o_totalprice")).alias("price"), "o_orderstatus")


@query("a15_null_profile", f"""WITH {_HOLES_SQL}, c AS (SELECT 'priority' AS "column", count(*) FILTER (WHERE priority IS NULL) AS nulls,
  count(*) FILTER (WHERE trim(priority) = '') AS blanks, count(*) AS n FROM holes UNION ALL
  SELECT 'price', count(*) FILTER (WHERE price IS NULL), 0, count(*) FROM holes)
  SELECT "column", nulls, blanks, round_even(CAST(nulls * 100 AS DOUBLE) / n, 1) AS pct_nulls,
  round_even(CAST(blanks * 100 AS DOUBLE) / n, 1) AS pct_blanks FROM c""")
def a15(spark, sf):
    return PR.null_profile(_holes(spark, sf))


@query("a16_domains", f"""WITH {_HOLES_SQL}, v AS (SELECT 'priority' AS "column", priority AS value, count(*) AS n FROM holes GROUP BY 2
  UNION ALL SELECT 'o_orderstatus', o_orderstatus, count(*) FROM holes GROUP BY 2)
  SELECT "column", value, n, true AS present FROM (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC,
  value NULLS FIRST) AS r FROM v) WHERE r <= 10 UNION ALL SELECT 'absent', NULL, 0, false""")
def a16(spark, sf):
    return PR.domains(_holes(spark, sf), ["priority", "o_orderstatus", "absent"])


# One column of each kind: informative, constant, one odd value, all null.
_NEAR_SQL = """near AS (SELECT CAST(o_orderkey AS DOUBLE) AS vary, 7 AS same, CASE WHEN o_orderkey = 5 THEN 1 ELSE 0 END AS odd,
  CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE 1 END AS half, CAST(NULL AS INTEGER) AS gone, o_orderstatus AS status,
  CASE WHEN o_orderkey = 9 THEN 'x' ELSE 'y' END AS text FROM orders)"""
_NEAR_COLS = ("vary", "same", "odd", "half", "gone", "status", "text")


def _near(spark, sf):
    k = F.col("o_orderkey")
    return C.table(spark, sf, "orders").select(
        k.cast("double").alias("vary"), F.lit(7).alias("same"), F.when(k == 5, 1).otherwise(0).alias("odd"),
        F.when(k % 2 != 0, 1).alias("half"), F.lit(None).cast("int").alias("gone"), F.col("o_orderstatus").alias("status"),
        F.when(k == 9, "x").otherwise("y").alias("text"))


def _near_sql(cols, nulls: bool) -> str:
    part = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", coalesce(max(n) / sum(n) >= 0.999 OR count(*) < 2, true) AS near_constant FROM "
        f"(SELECT {c}, count(*) AS n FROM near {'' if nulls else f'WHERE {c} IS NOT NULL'} GROUP BY 1)" for c in cols)
    return f"WITH {_NEAR_SQL} {part}"


@query("a17_near_constant", _near_sql(_NEAR_COLS, True))
def a17(spark, sf):
    return PR.near_constant(_near(spark, sf), _NEAR_COLS)


@query("a18_near_constant_flags", _near_sql(("odd", "half", "gone"), False))
def a18(spark, sf):
    return PR.near_constant(_near(spark, sf), ["odd", "half", "gone"], "flags")


@query("a19_near_constant_stage1", _near_sql(_NEAR_COLS, False))
def a19(spark, sf):
    return PR.near_constant(_near(spark, sf), _NEAR_COLS, "stage1")


# Roles spelled out once more, so that the twin does not lean on the library's rule table.
_ROLE_SQL = """CASE WHEN c IN ('appid', 'name', 'developer', 'publisher', 'release_date') THEN 'id'
  WHEN c IN ('label', 'label_name') THEN 'target_label' WHEN c IN ('owners_lower_bound', 'ccu') THEN 'target_raw'
  WHEN c IN ('positive', 'negative', 'rating_porcentaje', 'metacritic_score') THEN 'outcome_postlaunch'
  WHEN starts_with(c, 'ts_') THEN 'timeseries_postlaunch' WHEN c IN ('release_year', 'release_month') THEN 'analysis_temporal'
  WHEN regexp_matches(c, '^(genre|cat|tag|platform|is)_') THEN 'feature_tag'
  WHEN c IN ('dev_experience', 'pub_experience', 'controller_support', 'price_tier', 'release_quarter') THEN 'feature_categorical'
  WHEN c IN ('dev_game_count', 'pub_game_count', 'dev_success_prior', 'num_genres', 'num_tags', 'num_categories') THEN 'feature_derived'
  ELSE 'feature_numeric' END"""
_TEXT_COLS = "name, developer, publisher, release_date, controller_support, dev_experience, pub_experience, release_quarter, price_tier, label_name"
_PROFILE_SQL = f"""{S.MASTER}, cells AS (UNPIVOT (SELECT COLUMNS(*)::VARCHAR FROM master) ON COLUMNS(*) INTO NAME c VALUE x),
  profile AS (SELECT c, count(*) AS n_unique, count(*) < 2 OR max(k) / sum(k) >= 0.999 AS flat
    FROM (SELECT c, x, count(*) AS k FROM cells GROUP BY ALL) GROUP BY 1)"""


@query("a20_dictionary", f"""WITH {_PROFILE_SQL}, nonzero AS (SELECT c, round_even(avg(CAST(x <> 0 AS INTEGER)) * 100, 1) AS pct_nonzero
  FROM (UNPIVOT (SELECT COLUMNS(* EXCLUDE ({_TEXT_COLS}))::DOUBLE FROM master) ON COLUMNS(*) INTO NAME c VALUE x) GROUP BY 1),
  roles AS (SELECT *, {_ROLE_SQL} AS role FROM profile LEFT JOIN nonzero USING (c))
  SELECT c AS "column", role, CASE WHEN starts_with(role, 'feature_') THEN 'pre' WHEN ends_with(role, '_postlaunch') THEN 'post' ELSE 'meta' END AS etapa,
  n_unique, pct_nonzero, role <> 'id' AND flat AS near_constant, starts_with(role, 'feature_') AND NOT flat AS use_as_feature FROM roles""")
def a20(spark, sf):
    return PR.dictionary(stored(spark, sf, "master")).drop("position", "dtype")


_NUM = ("price", "total_achievements", "total_dlcs", "supported_languages", "min_ram_gb", "owners_lower_bound", "ccu", "rating_porcentaje",
        "positive", "negative", "metacritic_score", "hub_followers")


@query("a21_numeric_defaults", f"WITH {S.RAW} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(median({c}) AS DOUBLE) AS median, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM meta"
    for c in _NUM))
def a21(spark, sf):
    return PR.numeric_defaults(materialise(C.metadata(spark, sf).select(*_NUM), "numbers"), _NUM)


@query("a21_category_defaults", f"WITH {S.MASTER}, c AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n FROM master GROUP BY 2" for c in vocab.CATEGORICAL_COLS)
    + """) SELECT "column", value, n, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) = 1 AS is_default FROM c""")
def a21_categories(spark, sf):
    return PR.category_defaults(stored(spark, sf, "master"), vocab.CATEGORICAL_COLS)


@query("a22_prevalence", f"""WITH {S.RAW} SELECT flag, round_even(avg(CAST(v AS DOUBLE)), 6) AS prevalence
  FROM (UNPIVOT tags ON COLUMNS(* EXCLUDE (appid)) INTO NAME flag VALUE v) GROUP BY 1""")
def a22(spark, sf):
    return R.prevalence(C.tags(spark, sf), C.FLAGS).select("flag", round_to("prevalence", 6).alias("prevalence"))


@query("a23_funnel_counts", f"""WITH {S.ENRICHED} SELECT (SELECT count(*) FROM meta) AS n_catalogo, count(*) FILTER (WHERE {_COMPLETE_SQL}) AS n_metadata,
  count(*) FILTER (WHERE owners_lower_bound > 0) AS n_train FROM enriched""")
def a23(spark, sf):
    return A.funnel_counts(C.metadata(spark, sf), _enriched(spark, sf), R.metadata_complete(), F.col("owners_lower_bound") > 0)


@query("a24_segment_classes", f"""WITH {S.MASTER} SELECT label_name AS clase, count(*) AS "count" FROM master
  WHERE dev_experience = 'AAA' GROUP BY 1""")
def a24(spark, sf):
    return A.segment_classes(stored(spark, sf, "master"), "dev_experience", "AAA", "label")


@query("a25_pseudonym_stats", f"""SELECT count(*) AS n_rows, count(DISTINCT CASE WHEN v THEN trim(name) END) AS name_names,
  count(DISTINCT CASE WHEN v THEN sha256(name) END) AS name_ids FROM (
  SELECT name, trim(name) <> '' AND lower(trim(name)) <> 'null' AS v FROM ({_NAMES_SQL} UNION ALL SELECT o_orderkey, o_orderpriority FROM orders))""")
def a25(spark, sf):
    bare = C.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("name"))
    return A.pseudonym_stats(T.pseudonymised(_names(spark, sf).unionByName(bare), {"name": "pid"}), {"name": "pid"})


@query("a26_scaling_stats", f"WITH {S.RAW} " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round_even(avg({c}), 6) AS mean, round_even(stddev_pop({c}), 6) AS scale FROM meta" for c in _NUM))
def a26(spark, sf):
    return A.scaling_stats(C.metadata(spark, sf), _NUM).select(
        "feature", round_to("mean", 6).alias("mean"), round_to("scale", 6).alias("scale"))


@query("a27_master_audit", f"""WITH {_PROFILE_SQL} SELECT count(*) AS n_rows, 83 AS n_columns, CAST(0 AS BIGINT) AS n_nulls, {', '.join(
    f"round_even(CAST(count(*) FILTER (WHERE label = {k}) AS DOUBLE) / count(*), 3) AS share_{v.lower()}"
    for k, v in vocab.LABEL_NAMES.items())}, (SELECT CAST(count(*) AS INTEGER) FROM profile WHERE flat) AS n_near_constant FROM master""")
def a27(spark, sf):
    m = stored(spark, sf, "master")
    near = len(m.columns) - len(PR.kept_columns(m, m.columns))
    return A.master_audit(m, near)


@query("l1_master", f"WITH {S.MASTER} SELECT * FROM master")
def l1(spark, sf):
    return master(spark, sf)


_STAGE1_OUT = ("appid", "name", "owners_lower_bound", *vocab.STAGE1_NUMERIC, *vocab.CATEGORICAL_COLS, *_FLAG_COLS)


@query("l1_stage1", f"""WITH {S.ENRICHED} SELECT {', '.join(_STAGE1_OUT)}, CAST(owners_lower_bound > 0 AS INTEGER) AS tiene_ventas
  FROM enriched WHERE {_COMPLETE_SQL}""")
def l1_stage1(spark, sf):
    return stage1(spark, sf).select(*_STAGE1_OUT, "tiene_ventas")
