"""Queries S1-S16: readers, writers and payloads."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from shelfwise import vocab
from shelfwise.functions import parsing as P
from shelfwise.operators import aggregates as A, metrics
from shelfwise.plans import catalogue as C, catalogue_sql as S
from shelfwise.plans.data import master
from shelfwise.plans.registry import query
from shelfwise.session import scratch_dir
from shelfwise.sources import delimited as D, payloads as L, tables as T


def _as_csv(spark, df, name):
    return D.write_csv(df, scratch_dir(spark, "csv"), name)


@query("s1_load_csv", "SELECT conv_id, turn, role, text FROM conversations")
def s1(spark, sf):
    path = _as_csv(spark, C.table(spark, sf, "conversations"), "conversations")
    return D.read_typed(spark, path, "conv_id bigint, turn bigint, role string, text string")


@query("s2_read_inferred", "SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def s2(spark, sf):
    return D.read_inferred(spark, _as_csv(spark, C.table(spark, sf, "supplier"), "supplier"))


@query("s3_raw_lines", """SELECT CAST(5 AS INTEGER) AS n_tokens, CAST(c_custkey AS VARCHAR) AS first_token,
  c_name AS second_token FROM customer""")
def s3(spark, sf):
    path = _as_csv(spark, C.table(spark, sf, "customer"), "customer")
    tokens, header = D.read_lines(spark, path)
    return tokens.select(F.size("tokens").alias("n_tokens"), D.token_at(header, "c_custkey").alias("first_token"),
                         D.token_at(header, "c_name").alias("second_token"))


@query("s4_read_table", "SELECT p_partkey, p_name, p_retailprice FROM part")
def s4(spark, sf):
    name = f"shelf_{uuid.uuid4().hex}"
    T.save_table(C.table(spark, sf, "part"), name, scratch_dir(spark, "table"))
    return T.read_table(spark, name).select("p_partkey", "p_name", "p_retailprice")


@query("s5_column_pruned", "SELECT o_orderkey, o_totalprice FROM orders")
def s5(spark, sf):
    path = _as_csv(spark, C.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice"), "orders")
    return D.read_columns(spark, path, "o_orderkey bigint, o_orderpriority string, o_totalprice double",
                          ["o_orderkey", "o_totalprice"])


# Landed payloads are written by Spark from the order and part tables.
_CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"


def store_payloads(spark, sf):
    data = """struct(
      IF(o_orderstatus = 'P', 'dlc', 'game') AS type, concat(' Item ', o_orderkey, ' ') AS name,
      array(concat('Dev ', o_custkey % 7), concat('Dev ', o_custkey % 5)) AS developers,
      array(concat('Pub ', o_custkey % 3)) AS publishers,
      struct(date_format(o_orderdate, 'MMM d, yyyy') AS date, o_orderpriority = '1-URGENT' AS coming_soon) AS release_date,
      o_orderpriority = '5-LOW' AS is_free, struct(CAST(round(o_totalprice * 100) AS BIGINT) AS final) AS price_overview,
      struct(true AS windows, o_custkey % 2 = 0 AS mac, o_custkey % 3 = 0 AS linux) AS platforms,
      struct(concat('OS: any<br>Memory: ', 1 + o_custkey % 16, IF(o_custkey % 4 = 0, ' MB', ' GB'),
        IF(o_custkey % 5 = 0, '', ' RAM')) AS minimum) AS pc_requirements,
      struct(o_custkey % 100 AS score) AS metacritic, struct(o_custkey % 60 AS total) AS achievements,
      sequence(1L, 1L + o_custkey % 3) AS dlc,
      concat('English, French', IF(o_custkey % 2 = 0, ', <b>Spanish</b>', ''), '<br>Languages with full audio: English')
        AS supported_languages,
      IF(o_custkey % 3 = 0, 'full', null) AS controller_support,
      array(struct(IF(o_custkey % 2 = 0, 'Indie', 'Action') AS description), struct('RPG' AS description)) AS genres,
      array(struct(IF(o_custkey % 2 = 0, 'Co-op', 'Shared/Split Screen Co-op') AS description)) AS categories,
      concat('<p>Short ', o_orderkey, '</p>') AS short_description, concat('Long<br/>', o_orderkey) AS detailed_description)"""
    return C.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("appid"),
        F.expr(f"to_json(struct(o_custkey % 11 <> 0 AS success, {data} AS data))").alias("store"))


def estimate_payloads(spark, sf):
    body = """concat('{"owners": "', format_number(floor(o_totalprice / 20000) * 20000, 0), ' .. ',
      format_number(floor(o_totalprice / 20000) * 20000 + 20000, 0), '", "ccu": ', o_custkey % 1000, ', "positive": ',
      o_custkey % 500, ', "negative": ', o_custkey % 40, ', "userscore": 0, "tags": ',
      CASE o_custkey % 3 WHEN 0 THEN '{"Indie": 10, "Point & Click": 4}' WHEN 1 THEN '["VR", "2D"]' ELSE '[]' END, '}')"""
    return C.table(spark, sf, "orders").select(F.col("o_orderkey").alias("appid"), F.expr(body).alias("estimate"))


_GAMES = "FROM orders WHERE o_custkey % 11 <> 0 AND o_orderstatus <> 'P'"


@query("s6_store_payloads", f"""SELECT o_orderkey AS appid, 'Item ' || CAST(o_orderkey AS VARCHAR) AS name,
  'Dev ' || CAST(o_custkey % 7 AS VARCHAR) || ', Dev ' || CAST(o_custkey % 5 AS VARCHAR) AS developer,
  'Pub ' || CAST(o_custkey % 3 AS VARCHAR) AS publisher,
  CASE WHEN o_orderpriority = '1-URGENT' THEN '' ELSE strftime(o_orderdate, '%b %-d, %Y') END AS release_date,
  CASE WHEN o_orderpriority = '5-LOW' THEN 0.0 ELSE {_CENTS} / 100.0 END AS price,
  CAST(o_orderpriority = '5-LOW' AS INTEGER) AS is_free,
  CAST(floor(o_totalprice / 20000) * 20000 AS BIGINT) AS owners_lower_bound, o_custkey % 1000 AS ccu,
  CASE WHEN o_custkey % 500 + o_custkey % 40 > 0
    THEN round_even(CAST(o_custkey % 500 AS DOUBLE) / (o_custkey % 500 + o_custkey % 40) * 100, 2) ELSE 0.0 END AS rating_porcentaje,
  o_custkey % 500 AS positive, o_custkey % 40 AS negative, o_custkey % 100 AS metacritic_score,
  CAST(0 AS BIGINT) AS hub_followers, o_custkey % 60 AS total_achievements, 1 + o_custkey % 3 AS total_dlcs,
  CAST(CASE WHEN o_custkey % 2 = 0 THEN 3 ELSE 2 END AS BIGINT) AS supported_languages,
  CASE WHEN o_custkey % 3 = 0 THEN 'full' ELSE 'none' END AS controller_support, 1 AS platform_windows,
  CAST(o_custkey % 2 = 0 AS INTEGER) AS platform_mac, CAST(o_custkey % 3 = 0 AS INTEGER) AS platform_linux,
  CASE WHEN o_custkey % 5 = 0 THEN 0.0 WHEN o_custkey % 4 = 0 THEN round_even((1 + o_custkey % 16) / 1024, 2)
    ELSE CAST(1 + o_custkey % 16 AS DOUBLE) END AS min_ram_gb {_GAMES}""")
def s6(spark, sf):
    items = L.store_items(store_payloads(spark, sf)).join(L.estimates(estimate_payloads(spark, sf)), "appid", "left")
    return L.metadata_rows(items)


@query("s7_estimate_payloads", """SELECT o_orderkey AS appid, CAST(floor(o_totalprice / 20000) * 20000 AS BIGINT) AS owners,
  o_custkey % 1000 AS ccu, o_custkey % 500 AS positive, o_custkey % 40 AS negative,
  CASE o_custkey % 3 WHEN 0 THEN 'Indie|Point & Click' WHEN 1 THEN '2D|VR' ELSE '' END AS tags FROM orders""")
def s7(spark, sf):
    from shelfwise.functions import parsing as P

    e = L.estimates(estimate_payloads(spark, sf))
    return e.select("appid", P.owners_lower_bound(F.col("e.owners")).alias("owners"),
                    *[P.safe_int(F.col(f"e.{c}")).alias(c) for c in ("ccu", "positive", "negative")],
                    F.array_join(F.array_sort("tag_names"), "|").alias("tags"))


def review_payloads(spark, sf):
    """Review pages of one user each."""
    review = F.struct(
        F.unix_timestamp(F.col("ts").cast("timestamp")).alias("timestamp_created"),
        F.col("event_type").isin("click", "view", "purchase").alias("voted_up"),
        (F.col("event_type") == "purchase").alias("steam_purchase"),
        (F.col("event_type") == "signup").alias("written_during_early_access"),
        F.struct(F.floor("value").cast("bigint").alias("playtime_at_review")).alias("author"))
    # Event ids are unique, so a page holds 100 reviews at most, however busy the user.
    pages = C.table(spark, sf, "events").groupBy(F.col("user_id").alias("appid"), F.floor(F.col("event_id") / 100).alias("h")) \
        .agg(F.collect_list(review).alias("reviews"))
    return pages.select("appid", F.to_json(F.struct(F.lit(1).alias("success"), "reviews")).alias("reviews"))


REVIEWS_SQL = """SELECT user_id AS appid, CAST(floor(epoch(ts)) AS BIGINT) AS timestamp_created,
  event_type IN ('click', 'view', 'purchase') AS voted_up, event_type = 'purchase' AS steam_purchase,
  event_type = 'signup' AS written_during_early_access, CAST(floor(value) AS BIGINT) AS playtime_at_review FROM events"""


@query("s8_review_payloads", REVIEWS_SQL)
def s8(spark, sf):
    return L.review_rows(review_payloads(spark, sf))


@query("s9_typed_export", f"WITH {S.RAW} SELECT * FROM panel")
def s9(spark, sf):
    paths = D.export_tables(scratch_dir(spark, "export"), C.metadata(spark, sf), C.tags(spark, sf), C.text(spark, sf),
                            C.panel(spark, sf), "_v1")
    schema = """appid bigint, month string, review_count bigint, positive_count bigint, negative_count bigint,
      steam_purchase_count bigint, early_access_count bigint, avg_playtime_at_review_hrs double"""
    return D.read_typed(spark, paths["games_timeseries"], schema, multi_line=False)


@query("s10_save_table", "SELECT o_custkey AS developer, count(*) AS n FROM orders GROUP BY 1")
def s10(spark, sf):
    name, path = f"shelf_{uuid.uuid4().hex}", scratch_dir(spark, "table")
    T.save_table(C.table(spark, sf, "region"), name, path)
    counts = C.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("developer")).agg(F.count(F.lit(1)).alias("n"))
    T.save_table(counts, name, path)
    return spark.table(name)


@query("s11_master_export", f"WITH {S.MASTER} SELECT * FROM master")
def s11(spark, sf):
    folder = scratch_dir(spark, "master")
    T.export_master(master(spark, sf), folder)
    return spark.read.parquet(f"{folder}/dataset_ml")


def _quality_scores(spark, sf):
    """Documents with a known quality and a threshold rule on their length."""
    d = C.table(spark, sf, "documents").join(C.table(spark, sf, "labels"), "doc_id")
    return d.select("doc_id", F.col("quality").alias("label"), (F.col("n_chars") >= 900).cast("int").alias("pred"),
                    (F.col("n_chars") / (F.col("n_chars") + 900)).alias("score"))


_CONF_SQL = """SELECT CAST(a.i AS INTEGER) AS actual, CAST(b.i AS INTEGER) AS predicted, count(x.doc_id) AS n
  FROM range(2) a(i) CROSS JOIN range(2) b(i) LEFT JOIN (SELECT l.doc_id, quality AS q, CAST(n_chars >= 900 AS INTEGER) AS p
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id) x ON x.q = a.i AND x.p = b.i GROUP BY 1, 2"""


@query("s12_write_report", _CONF_SQL)
def s12(spark, sf):
    folder = scratch_dir(spark, "report")
    T.write_report(metrics.confusion(_quality_scores(spark, sf), "label", "pred", 2), folder, "confusion")
    return T.read_report(spark, folder, "confusion", "actual int, predicted int, n bigint")


@query("s13_model_store", """SELECT o_orderkey, CAST((SELECT count(DISTINCT p.o_orderpriority) FROM orders p
  WHERE p.o_orderpriority < o.o_orderpriority) AS DOUBLE) AS priority_index FROM orders o""")
def s13(spark, sf):
    orders = C.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    path = scratch_dir(spark, "model")
    indexer = StringIndexer(inputCol="o_orderpriority", outputCol="priority_index", stringOrderType="alphabetAsc")
    T.save_model(Pipeline(stages=[indexer]).fit(orders), path)
    return T.load_model(path).transform(orders).select("o_orderkey", "priority_index")


@query("s14_input_contract", """SELECT * FROM (VALUES ('games_metadata', 'present', true, ''),
  ('games_metadata', 'required_columns', true, '22 columns'), ('games_metadata', 'has_rows', (SELECT count(*) > 0 FROM orders), ''),
  ('games_tags', 'present', true, ''), ('games_tags', 'required_columns', true, '38 columns'), ('games_tags', 'flag_columns', true, '7'),
  ('games_tags', 'has_rows', (SELECT count(*) > 0 FROM lineitem JOIN part ON l_partkey = p_partkey), ''),
  ('games_extra', 'present', false, '')) t(table_name, check_name, ok, detail)""")
def s14(spark, sf):
    tables = {"games_metadata": C.metadata(spark, sf), "games_tags": C.tags(spark, sf)}
    required = {"games_metadata": ["appid", "name", "developer", "publisher", "price", "controller_support"],
                "games_tags": ["appid"], "games_extra": ["appid"]}
    return T.contract_checks(tables, required, {"games_tags": "genre_"}, spark)


@query("s15_pseudonymised_copy", """SELECT *, substr(sha256(c_name), 1, 16) AS dev_id,
  substr(sha256(c_mktsegment), 1, 16) AS pub_id FROM customer""")
def s15(spark, sf):
    path = scratch_dir(spark, "anon")
    T.pseudonymised(C.table(spark, sf, "customer"), {"c_name": "dev_id", "c_mktsegment": "pub_id"}).write.parquet(path)
    return spark.read.parquet(path)


@query("s16_read_reports", f"SELECT 'confusion' AS report, count(*) AS n_rows FROM ({_CONF_SQL}) "
       "UNION ALL SELECT 'absent', 0")
def s16(spark, sf):
    folder, schema = scratch_dir(spark, "report"), "actual int, predicted int, n bigint"
    T.write_report(metrics.confusion(_quality_scores(spark, sf), "label", "pred", 2), folder, "confusion")
    out = None
    for name in ("confusion", "absent"):
        row = A.row_count(T.read_report(spark, folder, name, schema)).select(F.lit(name).alias("report"), F.col("n").alias("n_rows"))
        out = row if out is None else out.unionByName(row)
    return out


@query("x9_multi_hot", f"""SELECT o_orderkey AS appid, {', '.join(
    [f"CAST({t} AS INTEGER) AS {c}" for t, c in (
        ("o_custkey % 2 = 0", "genre_indie"), ("o_custkey % 2 <> 0", "genre_action"), ("true", "genre_rpg"),
        ("o_custkey % 2 = 0", "cat_co_op"), ("o_custkey % 2 <> 0", "cat_shared_split_screen_co_op"),
        ("o_custkey % 3 = 0", '"tag_point_&_click"'), ("o_custkey % 3 = 0", "tag_indie"), ("o_custkey % 3 = 1", "tag_vr"),
        ("o_custkey % 3 = 1", "tag_2d"))]
    + ["CAST(79 AS INTEGER) AS n_columns"])} {_GAMES}""")
def x9(spark, sf):
    items = L.store_items(store_payloads(spark, sf)).join(L.estimates(estimate_payloads(spark, sf)), "appid", "left")
    rows = L.tag_rows(items)
    return rows.select("appid", "genre_indie", "genre_action", "genre_rpg", "cat_co_op", "cat_shared_split_screen_co_op",
                       "`tag_point_&_click`", "tag_indie", "tag_vr", "tag_2d", F.lit(len(rows.columns)).alias("n_columns"))


@query("x10_flag_names", """SELECT v AS vocabulary, regexp_replace(lower(v), '[ /-]', '_', 'g') AS slug, count(*) AS n
  FROM (SELECT p_name AS v FROM part) GROUP BY 1""")
def x10(spark, sf):
    names = C.table(spark, sf, "part").groupBy(F.col("p_name").alias("vocabulary")).agg(F.count(F.lit(1)).alias("n"))
    return names.select("vocabulary", P.slug(F.col("vocabulary")).alias("slug"), "n")
