"""Queries P1-P19, J1-J9, U1-U4, T1-T9 and W1-W3."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise import vocab
from shelfwise.functions import features as X, parsing as P
from shelfwise.functions.rounding import round_to
from shelfwise.operators import aggregates as A, filters as R, groups as G, joins as J, ordered as O
from shelfwise.plans import catalogue as C, catalogue_sql as S
from shelfwise.plans.data import stage1, stored
from shelfwise.plans.master import enriched, with_flag_sums
from shelfwise.plans.q_sources import store_payloads
from shelfwise.plans.registry import query
from shelfwise.session import scratch_dir
from shelfwise.sources import delimited as D, payloads as L

_LINE_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
               "l_linestatus", "l_shipdate"]


@query("p1_dedupe_keep_first", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(_LINE_ORDER)}) AS rn
  FROM lineitem) WHERE rn = 1""")
def p1(spark, sf):
    out = G.first_per_key(C.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], _LINE_ORDER)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


_NAMES_SQL = """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '  ' WHEN o_orderpriority = '2-HIGH' THEN ' NULL '
  ELSE ' ' || o_orderpriority END AS name FROM orders"""


def _names(spark, sf):
    name = F.when(F.col("o_orderstatus") == "P", "  ").when(F.col("o_orderpriority") == "2-HIGH", " NULL ") \
        .otherwise(F.concat(F.lit(" "), "o_orderpriority"))
    return C.table(spark, sf, "orders").select("o_orderkey", name.alias("name"))


@query("p2_valid_names", f"SELECT * FROM ({_NAMES_SQL}) WHERE trim(name) <> '' AND lower(trim(name)) <> 'null'")
def p2(spark, sf):
    return R.valid_names(_names(spark, sf), "name")


@query("p3_with_estimate", f"WITH {S.RAW} SELECT appid, owners_lower_bound FROM meta WHERE owners_lower_bound > 0")
def p3(spark, sf):
    return R.with_estimate(C.metadata(spark, sf)).select("appid", "owners_lower_bound")


_COMPLETE_SQL = """release_quarter <> 'Desconocido' AND platform_windows = 1 AND num_genres + num_tags >= 1
  AND short_desc_len > 0"""


def _enriched(spark, sf):
    return with_flag_sums(enriched(C.metadata(spark, sf), C.tags(spark, sf), C.text(spark, sf), ["appid"]))


@query("p4_metadata_complete", f"""WITH {S.ENRICHED} SELECT count(*) AS n_before,
  count(*) FILTER (WHERE {_COMPLETE_SQL}) AS n_after FROM enriched""")
def p4(spark, sf):
    return _enriched(spark, sf).agg(F.count(F.lit(1)).alias("n_before"), F.count_if(R.metadata_complete()).alias("n_after"))


@query("p5_quality_items", f"""WITH {S.RAW} SELECT appid FROM meta WHERE owners_lower_bound >= 30000
  AND positive + negative >= 60""")
def p5(spark, sf):
    return R.quality_items(C.metadata(spark, sf), 30_000, 60).select("appid")


@query("p6_base_items", "SELECT o_orderkey AS appid FROM orders WHERE o_custkey % 11 <> 0 AND o_orderstatus <> 'P'")
def p6(spark, sf):
    return L.store_items(store_payloads(spark, sf)).select("appid")


@query("p7_stale_rows", f"WITH {S.RAW} SELECT appid, developer FROM meta WHERE developer = '' OR metacritic_score = 0")
def p7(spark, sf):
    m = C.metadata(spark, sf)
    return m.where(R.is_stale(m)).select("appid", "developer")


@query("p8_needs_backfill", f"WITH {S.RAW} SELECT appid, positive FROM meta WHERE owners_lower_bound = 0 AND positive > 0")
def p8(spark, sf):
    return C.metadata(spark, sf).where(R.needs_backfill()).select("appid", "positive")


# Names of one item in fifty hold the separator.
_PEOPLE_SQL = """SELECT o_orderkey AS appid, CASE WHEN o_orderkey % 50 = 0 THEN 'A;' ELSE '' END
  || CAST(o_custkey AS VARCHAR) AS developer FROM orders"""
_BROKEN = "developer LIKE '%;%'"


def _people_file(spark, sf):
    dev = F.concat(F.when(F.col("o_orderkey") % 50 == 0, "A;").otherwise(""), F.col("o_custkey").cast("string"))
    df = C.table(spark, sf, "orders").select(F.col("o_orderkey").alias("appid"), dev.alias("developer"))
    return D.write_csv(df, scratch_dir(spark, "people"), "people")


@query("p9_token_validity", f"""SELECT count(*) FILTER (WHERE NOT {_BROKEN}) AS total, count(*) FILTER (WHERE {_BROKEN})
  AS invalid, count(DISTINCT CASE WHEN NOT {_BROKEN} THEN developer END) AS names FROM ({_PEOPLE_SQL})""")
def p9(spark, sf):
    tokens, header = D.read_lines(spark, _people_file(spark, sf))
    return D.line_counts(tokens, header, "developer")


@query("p10_parser_validity", f"""SELECT count(*) AS total, CAST(0 AS BIGINT) AS invalid, count(DISTINCT developer) AS names
  FROM ({_PEOPLE_SQL})""")
def p10(spark, sf):
    return D.parsed_counts(D.read_typed(spark, _people_file(spark, sf), "appid bigint, developer string"), "appid", "developer")


@query("p11_integrity_audit", f"""SELECT count(*) FILTER (WHERE NOT {_BROKEN}) AS lines_total,
  count(DISTINCT CASE WHEN NOT {_BROKEN} THEN developer END) AS lines_names,
  count(*) FILTER (WHERE {_BROKEN}) AS lines_invalid, count(*) AS parsed_total, count(DISTINCT developer) AS parsed_names,
  CAST(0 AS BIGINT) AS parsed_invalid, count(*) FILTER (WHERE {_BROKEN}) = 0 AS agree,
  count(*) FILTER (WHERE {_BROKEN}) AS row_difference FROM ({_PEOPLE_SQL})""")
def p11(spark, sf):
    return D.integrity_audit(spark, _people_file(spark, sf), "appid bigint, developer string", "appid", "developer")


@query("p12_search_names", """SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'ring')
  ORDER BY p_partkey LIMIT 20""")
def p12(spark, sf):
    return R.search_names(C.table(spark, sf, "part"), "RING", "p_name", "p_partkey").select("p_partkey", "p_name")


@query("p13_point_lookup", f"WITH {S.RAW} SELECT appid, name, price, controller_support FROM meta WHERE appid = 100")
def p13(spark, sf):
    return R.lookup(C.metadata(spark, sf), "appid", 100, ["appid", "name", "price", "controller_support"])


@query("p14_clean_headers", """SELECT c_custkey AS ccustkey, c_name, c_acctbal AS caccount_balance FROM customer""")
def p14(spark, sf):
    raw = C.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal") \
        .toDF("c.custkey", "c name", "c.account balance")
    return R.clean_headers(raw)[0]


@query("p15_column_families", f"WITH {S.RAW} SELECT {', '.join(C.GENRE_FLAGS + C.CAT_FLAGS)} FROM tags")
def p15(spark, sf):
    t = C.tags(spark, sf)
    return t.select(*R.columns_with_prefix(t, ("genre_", "cat_")))


_META_ROLES = (
    ("appid", "id", "meta"), ("name", "id", "meta"), ("developer", "id", "meta"), ("publisher", "id", "meta"), ("release_date", "id", "meta"),
    ("owners_lower_bound", "target_raw", "meta"), ("ccu", "target_raw", "meta"), ("positive", "outcome_postlaunch", "post"),
    ("negative", "outcome_postlaunch", "post"), ("rating_porcentaje", "outcome_postlaunch", "post"), ("metacritic_score", "outcome_postlaunch", "post"),
    ("controller_support", "feature_categorical", "pre"), ("platform_windows", "feature_tag", "pre"), ("platform_mac", "feature_tag", "pre"),
    ("platform_linux", "feature_tag", "pre"), ("is_free", "feature_tag", "pre"), ("price", "feature_numeric", "pre"),
    ("hub_followers", "feature_numeric", "pre"), ("total_achievements", "feature_numeric", "pre"), ("total_dlcs", "feature_numeric", "pre"),
    ("supported_languages", "feature_numeric", "pre"), ("min_ram_gb", "feature_numeric", "pre"))


@query("p16_roles", f"""WITH {S.RAW} SELECT t.*, n_rows FROM (VALUES {', '.join(map(str, _META_ROLES))}) t(column_name, role, etapa)
  JOIN (SELECT c AS column_name, count(*) AS n_rows FROM (UNPIVOT (SELECT COLUMNS(*)::VARCHAR FROM meta) ON COLUMNS(*) INTO NAME c VALUE x)
    GROUP BY 1) USING (column_name)""")
def p16(spark, sf):
    m = C.metadata(spark, sf)
    counts = m.agg(*[F.count(c).alias(c) for c in m.columns]).unpivot([], m.columns, "column_name", "n_rows")
    roles = spark.createDataFrame([(c, R.role_of(c), R.stage_of(R.role_of(c))) for c in m.columns],
                                  "column_name string, role string, etapa string")
    return roles.join(counts, "column_name")


@query("p17_keep_list", f"WITH {S.RAW} SELECT appid, name, price, is_free FROM meta")
def p17(spark, sf):
    return R.keep_columns(C.metadata(spark, sf), ["appid", "name", "price", "appid", "no_such_column", "is_free"])


@query("p18_actionable_flags", f"""WITH {S.RAW} SELECT flag, round_even(avg(CAST(v AS DOUBLE)), 6) AS prevalence
  FROM (UNPIVOT tags ON COLUMNS(* EXCLUDE (appid)) INTO NAME flag VALUE v) GROUP BY 1
  HAVING avg(CAST(v AS DOUBLE)) BETWEEN 0.05 AND 0.95""")
def p18(spark, sf):
    return R.actionable_flags(C.tags(spark, sf), C.FLAGS).select("flag", round_to("prevalence", 6).alias("prevalence"))


# Weight of a flag: mean owners with it, in millions, less the mean over all flags set.
_EFFECTS_SQL = f"""effects AS (SELECT feature, round_even(avg(owners_lower_bound) / 1e6, 6) - 0.24 AS coef FROM (
  UNPIVOT (SELECT owners_lower_bound, {', '.join(C.FLAGS)} FROM meta JOIN tags USING (appid))
  ON {', '.join(C.FLAGS)} INTO NAME feature VALUE v) WHERE v = 1 GROUP BY 1)"""


def flag_effects(spark, sf):
    df = J.join_catalogue(C.metadata(spark, sf), C.tags(spark, sf))
    wide = df.agg(*[(round_to(F.avg(F.when(F.col(f) == 1, F.col("owners_lower_bound"))) / 1e6, 6) - 0.24).alias(f)
                    for f in C.FLAGS])
    return wide.unpivot([], list(C.FLAGS), "feature", "coef")


@query("p19_without_unknown", """SELECT 'c_' || CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Desconocido'
  ELSE o_orderpriority END AS feature, count(*) AS n FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED' GROUP BY 1""")
def p19(spark, sf):
    name = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", vocab.UNKNOWN).otherwise(F.col("o_orderpriority"))
    df = C.table(spark, sf, "orders").groupBy(F.concat(F.lit("c_"), name).alias("feature")).agg(F.count(F.lit(1)).alias("n"))
    return R.without_unknown(df)


@query("j1_inner_join", f"WITH {S.RAW} SELECT appid, name, genre_promo, cat_r, tag_brand_7 FROM meta JOIN tags USING (appid)")
def j1(spark, sf):
    return J.join_catalogue(C.metadata(spark, sf), C.tags(spark, sf)).select("appid", "name", "genre_promo", "cat_r", "tag_brand_7")


@query("j2_left_join_panel", f"""WITH {S.RAW}, ts AS ({S.COLLAPSED}) SELECT appid,
  coalesce(ts_total_reviews, 0) AS ts_total_reviews, coalesce(ts_positive_ratio, 0) AS ts_positive_ratio
  FROM meta LEFT JOIN ts USING (appid)""")
def j2(spark, sf):
    return J.left_join_zero(C.metadata(spark, sf).select("appid"), A.collapse_panel(C.panel(spark, sf)), "appid",
                            ["ts_total_reviews", "ts_positive_ratio"])


@query("j3_left_join_text", f"""WITH {S.RAW} SELECT appid, CAST(coalesce(length(short_description), 0) AS INTEGER)
  AS short_desc_len FROM meta LEFT JOIN txt USING (appid)""")
def j3(spark, sf):
    lengths = C.text(spark, sf).select("appid", P.text_length(F.col("short_description")).alias("short_desc_len"))
    return J.left_join_zero(C.metadata(spark, sf).select("appid"), lengths, "appid", ["short_desc_len"])


@query("j4_unseen_ids", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def j4(spark, sf):
    done = C.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return J.unseen(C.table(spark, sf, "orders").select("o_orderkey"), done, "o_orderkey")


@query("j5_complete_panel", f"""WITH {S.RAW} SELECT appid, month, review_count, avg_playtime_at_review_hrs FROM panel
  UNION ALL SELECT appid, '2024-01', 0, 0.0 FROM meta WHERE appid NOT IN (SELECT appid FROM panel)""")
def j5(spark, sf):
    return J.complete_panel(C.metadata(spark, sf), C.panel(spark, sf)).select(
        "appid", "month", "review_count", "avg_playtime_at_review_hrs")


@query("j6_only_targets", """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
  WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 400000)""")
def j6(spark, sf):
    targets = C.table(spark, sf, "orders").where("o_totalprice > 400000").select(F.col("o_orderkey").alias("l_orderkey"))
    return J.only_targets(C.table(spark, sf, "lineitem"), targets, "l_orderkey").select(
        "l_orderkey", "l_linenumber", "l_extendedprice")


@query("j7_metadata_refresh", f"""WITH {S.RAW} SELECT appid,
  CASE WHEN hit AND o_custkey % 2 = 0 THEN 'New ' || CAST(o_custkey AS VARCHAR) ELSE developer END AS developer,
  publisher, CASE WHEN hit THEN '2020-01-01' ELSE release_date END AS release_date,
  CASE WHEN hit AND o_custkey % 3 = 0 THEN 77 ELSE metacritic_score END AS metacritic_score,
  CASE WHEN hit THEN CAST(o_custkey % 2 = 0 AS INTEGER) ELSE platform_mac END AS platform_mac
  FROM (SELECT m.* EXCLUDE (developer), CASE WHEN appid % 5 = 1 THEN '' ELSE developer END AS developer, o_custkey,
    (metacritic_score = 0 OR developer = '' OR appid % 5 = 1) AND appid % 2 = 0 AS hit
    FROM meta m JOIN orders ON appid = o_orderkey)""")
def j7(spark, sf):
    m = C.metadata(spark, sf).withColumn("developer", F.when(F.col("appid") % 5 != 1, F.col("developer")))
    cust = F.col("o_custkey")
    fresh = C.table(spark, sf, "orders").where("o_orderkey % 2 = 0").select(
        F.col("o_orderkey").alias("appid"),
        F.when(cust % 2 == 0, F.array(F.concat(F.lit("New "), cust.cast("string")), F.lit("Second")))
        .otherwise(F.array().cast("array<string>")).alias("developers"),
        F.array().cast("array<string>").alias("publishers"), F.lit("2020-01-01").alias("release_date"),
        F.when(cust % 3 == 0, F.lit(77).cast("bigint")).alias("metacritic_score"),
        F.lit(True).alias("platform_windows"), (cust % 2 == 0).alias("platform_mac"), F.lit(False).alias("platform_linux"))
    return J.refresh(m, fresh, "appid", R.is_stale(m), J.metadata_rules(), ["developer", "publisher", "release_date"]).select(
        "appid", "developer", "publisher", "release_date", "metacritic_score", "platform_mac")


@query("j8_backfill_owners", f"""WITH {S.RAW} SELECT appid, CASE WHEN owners_lower_bound = 0 AND positive > 0
  THEN positive * 1000 ELSE owners_lower_bound END AS owners_lower_bound FROM meta""")
def j8(spark, sf):
    m = C.metadata(spark, sf)
    fresh = C.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("appid"), (F.floor(F.col("o_totalprice") / 1000) * 1000).cast("bigint").alias("owners"))
    return J.refresh(m, fresh, "appid", R.needs_backfill(), {"owners_lower_bound": F.col("fresh.owners")}).select(
        "appid", "owners_lower_bound")


@query("j9_ranked_candidates", f"""WITH {S.RAW}, {_EFFECTS_SQL} SELECT feature, round_even(coef, 6) + 0.0 AS coef FROM effects
  WHERE feature IN (SELECT flag FROM (UNPIVOT tags ON COLUMNS(* EXCLUDE (appid)) INTO NAME flag VALUE v) GROUP BY 1
    HAVING avg(CAST(v AS DOUBLE)) BETWEEN 0.05 AND 0.95) ORDER BY abs(coef) DESC, feature LIMIT 12""")
def j9(spark, sf):
    allowed = R.actionable_flags(C.tags(spark, sf), C.FLAGS).withColumnRenamed("flag", "feature")
    return J.candidates(flag_effects(spark, sf), allowed, "feature", "coef").select("feature", round_to("coef", 6).alias("coef"))


@query("u1_prefer_current", """SELECT o_orderkey AS appid, CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice ELSE 0.0 END
  AS owners FROM orders""")
def u1(spark, sf):
    o = C.table(spark, sf, "orders").select(F.col("o_orderkey").alias("appid"), F.col("o_totalprice").alias("owners"))
    return J.prefer_current(o.where("appid % 3 <> 0"), o.withColumn("owners", F.lit(0.0)), "appid", ["owners"])


@query("u2_difference", "SELECT c_custkey AS id FROM customer EXCEPT SELECT user_id FROM events")
def u2(spark, sf):
    return J.difference(C.table(spark, sf, "customer").select(F.col("c_custkey").alias("id")),
                        C.table(spark, sf, "events").select(F.col("user_id").alias("id")), "id")


@query("u3_append", """SELECT item_id AS id, text, NULL::VARCHAR AS lang FROM benchmark
  UNION ALL SELECT doc_id, text, lang FROM documents""")
def u3(spark, sf):
    return J.append_rows(C.table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), "text"),
                         C.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text", "lang"))


@query("u4_distinct", "SELECT DISTINCT text FROM documents")
def u4(spark, sf):
    return J.distinct_values(C.table(spark, sf, "documents"), ["text"])


@query("t1_sorted_panel", f"WITH {S.RAW} SELECT * FROM panel ORDER BY appid, month")
def t1(spark, sf):
    return C.panel(spark, sf).orderBy("appid", "month")


@query("t2_top_flags", f"""WITH {S.RAW} SELECT replace(genre, 'tag_', '') AS genre, CAST(sum(v) AS BIGINT) AS n
  FROM (UNPIVOT tags ON COLUMNS('tag_.*') INTO NAME genre VALUE v) GROUP BY 1 ORDER BY n DESC, genre LIMIT 10""")
def t2(spark, sf):
    return A.flag_totals(C.tags(spark, sf), C.TAG_FLAGS, 10, "tag_")


@query("t3_top_groups", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_custkey LIMIT 12")
def t3(spark, sf):
    counts = C.table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return O.top_n(counts, [F.desc("n"), "o_custkey"], 12)


@query("t4_both_ends", f"""WITH {S.RAW}, {_EFFECTS_SQL}
  (SELECT feature, round_even(coef, 3) + 0.0 AS coef, 'positivos' AS side FROM effects ORDER BY effects.coef DESC, feature LIMIT 8)
  UNION ALL (SELECT feature, round_even(coef, 3) + 0.0, 'negativos' FROM effects ORDER BY effects.coef, feature LIMIT 8)""")
def t4(spark, sf):
    return O.both_ends(flag_effects(spark, sf), "coef", "feature", 8).select("feature", round_to("coef", 3).alias("coef"), "side")


@query("t5_top_by_abs", f"""WITH {S.RAW}, {_EFFECTS_SQL} SELECT feature, round_even(coef, 6) + 0.0 AS coef FROM effects
  ORDER BY abs(effects.coef) DESC, feature LIMIT 12""")
def t5(spark, sf):
    return O.top_by_abs(flag_effects(spark, sf), "coef", "feature", 12).select("feature", round_to("coef", 6).alias("coef"))


@query("t6_extremes", """(SELECT o_custkey, count(*) AS n, 'largest' AS side FROM orders GROUP BY 1
  ORDER BY n DESC, o_custkey LIMIT 5) UNION ALL (SELECT o_custkey, count(*), 'smallest' FROM orders GROUP BY 1
  HAVING count(*) <= 3 ORDER BY o_custkey LIMIT 5)""")
def t6(spark, sf):
    counts = C.table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    small = O.top_n(counts.where("n <= 3"), ["o_custkey"], 5).withColumn("side", F.lit("smallest"))
    return O.top_n(counts, [F.desc("n"), "o_custkey"], 5).withColumn("side", F.lit("largest")).unionByName(small)


@query("t7_first_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1000")
def t7(spark, sf):
    return O.top_n(C.table(spark, sf, "orders"), [F.desc("o_totalprice"), "o_orderkey"], 1000).select("o_orderkey", "o_totalprice")


@query("t8_seeded_sample", f"""WITH {S.MASTER} SELECT appid, round_even(price, 2) AS price, owners_lower_bound, label_name, name FROM master
  ORDER BY md5('7-' || CAST(appid AS VARCHAR)), appid LIMIT 1200""")
def t8(spark, sf):
    rows = O.sample_n(stored(spark, sf, "master"), "appid", 1200, 7)
    return rows.select("appid", round_to("price", 2).alias("price"), "owners_lower_bound", "label_name", "name")


@query("t9_first_examples", f"""WITH n AS ({_NAMES_SQL}) SELECT o_orderkey, trim(name) AS name,
  CASE WHEN trim(name) = '' OR lower(name) = 'null' THEN '' ELSE substr(sha256(name), 1, 16) END AS name_id, o_clerk_like AS other,
  substr(sha256(o_clerk_like), 1, 16) AS other_id FROM (SELECT n.*, o_orderstatus || ' ' || o_orderpriority AS o_clerk_like
    FROM n JOIN orders USING (o_orderkey)) WHERE trim(name) <> '' ORDER BY o_orderkey LIMIT 5""")
def t9(spark, sf):
    other = C.table(spark, sf, "orders").select("o_orderkey", F.concat_ws(" ", "o_orderstatus", "o_orderpriority").alias("other"))
    rows = _names(spark, sf).join(other, "o_orderkey").where((P.strip(F.col("name")) != "") & (P.strip(F.col("other")) != ""))
    first = O.top_n(rows, ["o_orderkey"], 5)
    return first.select("o_orderkey", P.strip(F.col("name")).alias("name"), P.pseudonym(F.col("name")).alias("name_id"),
                        P.strip(F.col("other")).alias("other"), P.pseudonym(F.col("other")).alias("other_id"))


@query("w1_group_totals", """SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice,
  count(*) OVER (PARTITION BY l_suppkey) AS supplier_lines,
  sum(l_quantity) OVER (PARTITION BY l_suppkey) AS supplier_quantity FROM lineitem""")
def w1(spark, sf):
    df = C.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice")
    return G.group_totals(df, "l_suppkey", ["l_orderkey", "l_linenumber"], {
        "supplier_lines": F.count(F.lit(1)), "supplier_quantity": F.sum("l_quantity")}).drop("l_quantity")


@query("w2_first_per_text", """SELECT doc_id, source, n_chars FROM (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""")
def w2(spark, sf):
    # Copies of a text meet by its digest, so that whole texts are not sorted.
    docs = C.table(spark, sf, "documents").select("doc_id", "source", "n_chars", F.sha2("text", 256).alias("digest"))
    return G.first_per_key(docs, ["digest"], ["doc_id"]).drop("digest")


@query("w3_top_k_per_group", """SELECT l_suppkey, rank, l_orderkey, l_linenumber, l_extendedprice FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber,
    l_partkey, l_quantity) AS INTEGER) AS rank FROM lineitem) WHERE rank <= 4""")
def w3(spark, sf):
    order = [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]
    return G.top_k_per_key(C.table(spark, sf, "lineitem"), ["l_suppkey"], order, 4, rank="rank").select(
        "l_suppkey", "rank", "l_orderkey", "l_linenumber", "l_extendedprice")
