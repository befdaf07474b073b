"""Queries M1-M24 and J10: splits, models, evaluation and scenario scoring.

Results of fitted models have no SQL twin; their plain parts do.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from shelfwise import vocab
from shelfwise.functions import features as X, parsing as P, scoring as K
from shelfwise.functions.rounding import round_to
from shelfwise.operators import filters as R, metrics as E, models as M, neighbours as N, ordered as O, scoring as Z
from shelfwise.plans import catalogue as C, catalogue_sql as S, training as T
from shelfwise.plans.data import stored
from shelfwise.plans.q_aggregates import _PROFILE_SQL, _ROLE_SQL
from shelfwise.plans.q_sources import _CONF_SQL, _quality_scores
from shelfwise.plans.registry import query
from shelfwise.session import materialise, scratch_dir
from shelfwise.sources import bundle as B

CLASSES = list(vocab.LABEL_NAMES.values())


@query("m1_select_features", f"""WITH {_PROFILE_SQL}, roles AS (SELECT c, flat, {_ROLE_SQL} AS role FROM profile)
  SELECT c AS feature, CASE role WHEN 'feature_tag' THEN 'boolean' WHEN 'feature_categorical' THEN 'categorical' ELSE 'numeric' END AS kind
  FROM roles WHERE starts_with(role, 'feature_') AND (role = 'feature_categorical' OR NOT flat)""")
def m1(spark, sf):
    return M.feature_catalogue(stored(spark, sf, "master"), T.features(spark, sf))


@query("m2_preprocess", f"""WITH {S.RAW} SELECT appid, round_even((price - (SELECT avg(price) FROM meta)) / (SELECT stddev_pop(price) FROM meta), 6) + 0.0
  AS z_price, CAST(platform_mac AS DOUBLE) AS mac, CAST(controller_support = 'full' AS DOUBLE) AS is_full,
  CAST(controller_support = 'none' AS DOUBLE) AS is_none, CAST(controller_support = 'partial' AS DOUBLE) AS is_partial FROM meta""")
def m2(spark, sf):
    m = C.metadata(spark, sf).select("appid", "price", "platform_mac", "controller_support")
    f = M.Features(("price",), ("platform_mac",), ("controller_support",))
    v = vector_to_array("features")
    return M.preprocess(M.fit_preprocessor(m, f), m).select(
        "appid", round_to(v[0], 6).alias("z_price"), v[1].alias("mac"),
        *[v[2 + i].alias(f"is_{c}") for i, c in enumerate(("full", "none", "partial"))])


@query("m3_stratified_split", f"""WITH {S.RAW}, l AS (SELECT appid, {S.LABEL} AS label FROM meta), r AS (SELECT *,
  row_number() OVER (PARTITION BY label ORDER BY md5('42-' || CAST(appid AS VARCHAR)), appid) AS rn,
  count(*) OVER (PARTITION BY label) AS n FROM l) SELECT appid, label, rn <= floor(n * 0.2) AS is_test FROM r""")
def m3(spark, sf):
    m = C.metadata(spark, sf).select("appid", X.success_label(F.col("owners_lower_bound"), C.FLOP_MAX, C.HIT_MIN).alias("label"))
    return O.stratified_test_flag(m, "label", "appid")


@query("m4_class_weights", f"""WITH {S.RAW}, l AS (SELECT appid, {S.LABEL} AS label FROM meta), c AS (SELECT label, count(*) AS n
  FROM l GROUP BY 1) SELECT appid, label, round_even((SELECT CAST(sum(n) AS DOUBLE) FROM c) / ((SELECT count(*) FROM c) * n), 6) AS weight
  FROM l JOIN c USING (label)""")
def m4(spark, sf):
    m = C.metadata(spark, sf).select("appid", X.success_label(F.col("owners_lower_bound"), C.FLOP_MAX, C.HIT_MIN).alias("label"))
    return E.class_weights(m, "label").withColumn("weight", round_to("weight", 6))


def _model_metrics(spark, sf, name):
    t = T.trained(spark, sf)
    return M.compare_models(materialise(M.apply_classifiers(t.models, t.test, [name]).drop("features"), "scored"), 3, [name], t.models)


@query("m5_logistic")
def m5(spark, sf):
    return _model_metrics(spark, sf, "lr")


@query("m6_kernel_features")
def m6(spark, sf):
    return _model_metrics(spark, sf, "svm")


@query("m6_kernel_machine")
def m6_machine(spark, sf):
    t, model = T.trained(spark, sf), T.kernel_machine(spark, sf)
    scored = materialise(M.apply_classifiers({"kernel": model}, t.test, ["kernel"]).drop("features"), "scored")
    return M.compare_models(scored, 3, ["kernel"], {"kernel": model}).withColumns(
        {"kkt_residual": round_to(F.lit(model.getOrDefault("residual")), 6), "groups": F.lit(model.getOrDefault("groups"))})


@query("m7_perceptron")
def m7(spark, sf):
    return _model_metrics(spark, sf, "mlp")


@query("m8_owners_regressor")
def m8(spark, sf):
    t = T.trained(spark, sf)
    return E.regression_metrics(t.owners.transform(t.test), F.col("log_owners"), F.col("pred_owners"))


_REPORT_SQL = f"""conf AS ({_CONF_SQL}), rep AS (SELECT c AS clase, tp / pred AS precision, tp / sup AS recall, 2 * tp / (pred + sup) AS f1, sup, tp
  FROM (SELECT a.c, CAST(sum(CASE WHEN actual = a.c AND predicted = a.c THEN n ELSE 0 END) AS BIGINT) AS tp,
    CAST(sum(CASE WHEN actual = a.c THEN n ELSE 0 END) AS BIGINT) AS sup, CAST(sum(CASE WHEN predicted = a.c THEN n ELSE 0 END) AS BIGINT) AS pred
    FROM conf, (VALUES (0), (1)) a(c) GROUP BY 1))"""
_AUC_SQL = """auc AS (SELECT (sum(CASE WHEN quality = 1 THEN r ELSE 0 END) - p * (p + 1) / 2.0) / (p * q) AS auc FROM (
  SELECT quality, rank() OVER (ORDER BY n_chars) + (count(*) OVER (PARTITION BY n_chars) - 1) / 2.0 AS r,
    sum(quality) OVER () AS p, sum(1 - quality) OVER () AS q FROM documents d JOIN labels l ON d.doc_id = l.doc_id) GROUP BY p, q)"""


@query("m9_classification_metrics", f"""WITH {_REPORT_SQL}, {_AUC_SQL} SELECT round_even(auc, 4) AS auc_ovr_macro,
  round_even((SELECT avg(f1) FROM rep), 4) AS f1_macro, round_even((SELECT CAST(sum(tp) AS DOUBLE) / sum(sup) FROM rep), 4) AS accuracy FROM auc""")
def m9(spark, sf):
    s = F.col("score")
    return E.classification_metrics(_quality_scores(spark, sf), "label", "pred", [1 - s, s])


@query("m9_confusion", _CONF_SQL)
def m9_confusion(spark, sf):
    return E.confusion(_quality_scores(spark, sf), "label", "pred", 2)


@query("m10_class_report", f"""WITH {_REPORT_SQL} SELECT CAST(clase AS INTEGER) AS clase, round_even(precision, 6) AS precision,
  round_even(recall, 6) AS recall, round_even(f1, 6) AS f1, sup AS support FROM rep""")
def m10(spark, sf):
    rep = E.class_report(E.confusion(_quality_scores(spark, sf), "label", "pred", 2))
    return rep.select("clase", *[round_to(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("m11_binary_metrics", f"""WITH {_REPORT_SQL}, {_AUC_SQL} SELECT round_even(auc, 4) AS auc,
  round_even((SELECT f1 FROM rep WHERE clase = 1), 4) AS f1, round_even((SELECT CAST(sum(tp) AS DOUBLE) / sum(sup) FROM rep), 4) AS accuracy FROM auc""")
def m11(spark, sf):
    return E.binary_metrics(_quality_scores(spark, sf), "label", "pred", F.col("score"))


@query("m12_regression_metrics", """SELECT round_even(1 - sum(pow(a - p, 2)) / (var_pop(a) * count(*)), 4) AS r2_log,
  CAST(floor(avg(abs((exp(a) - 1) - (exp(p) - 1)))) AS BIGINT) AS mae_owners FROM (SELECT ln(1 + o_totalprice) AS a,
  12 + o_custkey % 3 * 0.1 AS p FROM orders)""")
def m12(spark, sf):
    return E.regression_metrics(C.table(spark, sf, "orders"), F.log1p("o_totalprice"), 12 + F.col("o_custkey") % 3 * 0.1)


@query("m13_grid_search")
def m13(spark, sf):
    t = T.trained(spark, sf)
    return M.grid_search(t.train, 3, "appid")[0].withColumn("auc_ovr_macro", round_to("auc_ovr_macro", 4))


def _coefs(spark, sf):
    t = T.served(spark, sf)
    return M.coefficients(t.rows, t.models["lr"], M.feature_names(t.pre, t.features), CLASSES)


@query("m14_coefficients")
def m14(spark, sf):
    return _coefs(spark, sf)


@query("m15_importance_panel")
def m15(spark, sf):
    hit = R.without_unknown(_coefs(spark, sf).where(F.col("clase") == "Hit"))
    ends = O.both_ends(hit, "coef_logodds", "feature", 8)
    is_flag = F.col("feature").rlike("^(" + "|".join(vocab.FLAG_PREFIXES) + ")")
    label = F.when(is_flag, P.pretty_label(F.col("feature"))).otherwise(F.replace("feature", F.lit("_"), F.lit(" ")))
    return ends.select("side", label.alias("feature"), round_to("coef_logodds", 3).alias("coef"))


@query("m16_traction_model")
def m16(spark, sf):
    scored = materialise(T.traction(spark, sf)[2].select("label", "pred_s1", "score"), "scored")
    return E.binary_metrics(scored, "label", "pred_s1", F.col("score"))


@query("m17_model_comparison")
def m17(spark, sf):
    t = T.trained(spark, sf)
    return M.compare_models(materialise(M.apply_classifiers(t.models, t.test).drop("features"), "scored"), 3, models=t.models)


def _scored(spark, sf):
    b = T.bundle(spark, sf)
    states = Z.normalise(T.scenarios(spark, sf), b.schema, "scenario")
    return Z.score(T.apply_bundle(b, states), b.schema, M.MODELS, "mlp", F.col("pred_owners"), F.col("p_traction"), (C.FLOP_MAX, C.HIT_MIN))


@query("m18_batch_scoring")
def m18(spark, sf):
    return _scored(spark, sf).select(
        "scenario", *[f"clase_{m}" for m in M.MODELS], "owners_estimados", "clase_por_owners", round_to("traccion", 4).alias("traccion"),
        "margen_top2", "desacuerdo", "nivel", "embudo_notraccion", "embudo_flop", "embudo_rentable", "embudo_hit")


@query("m19_normalise", """SELECT c_custkey AS scenario, round_even(abs(c_acctbal) / 80, 2) AS raw_price,
  least(round_even(abs(c_acctbal) / 80, 2), 70.0) AS price, CASE WHEN round_even(abs(c_acctbal) / 80, 2) <= 0 THEN 'F2P'
  WHEN round_even(abs(c_acctbal) / 80, 2) < 10 THEN 'Budget' WHEN round_even(abs(c_acctbal) / 80, 2) < 20 THEN 'Mid' ELSE 'Premium' END AS price_tier,
  CAST(c_custkey % 20 AS DOUBLE) AS supported_languages, 3.0 AS min_ram_gb,
  CAST(c_custkey % 2 AS DOUBLE) AS num_genres, CAST(CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS num_tags,
  CASE WHEN c_custkey % 4 = 0 THEN 'Q2' ELSE 'Q' || CAST(c_custkey % 4 AS VARCHAR) END AS release_quarter,
  0.0 AS is_early_access FROM customer""")
def m19(spark, sf):
    f = M.Features(("price", "supported_languages", "min_ram_gb", "num_genres", "num_tags"),
                   ("genre_promo", "genre_early_access", "tag_brand_3", "is_early_access"), ("price_tier", "release_quarter"))
    schema = Z.Schema(f, {"price": 9.0, "supported_languages": 5.0, "min_ram_gb": 3.0, "price_tier": "Mid", "release_quarter": "Q2"}, ())
    planned = T.scenarios(spark, sf).withColumn("price", round_to(F.abs("price"), 2))
    return Z.normalise(planned, schema, "scenario").select(
        "scenario", "raw_price", "price", "price_tier", "supported_languages", "min_ram_gb", "num_genres", "num_tags",
        "release_quarter", "is_early_access")


def _states(spark, sf):
    return Z.normalise(T.scenarios(spark, sf), T.scenario_schema(spark, sf), "scenario").drop("raw_price")


@query("s13_fitted_bundle", """SELECT output, (SELECT count(*) FROM customer) AS n_rows, (SELECT count(*) FROM customer) AS n_alike
  FROM (VALUES ('probs_lr'), ('probs_svm'), ('probs_mlp'), ('pred_owners'), ('p_traction')) t(output)""")
def s13_bundle(spark, sf):
    """Scores of the written and reloaded models beside those of the models themselves, bit for bit."""
    bundle, folder = T.bundle(spark, sf), scratch_dir(spark, "bundle")
    B.save_bundle(spark, bundle, folder)
    again = B.load_bundle(spark, folder)
    outputs = ["probs_lr", "probs_svm", "probs_mlp", "pred_owners", "p_traction"]

    def scores(b):
        rows = T.apply_bundle(b, Z.normalise(T.scenarios(spark, sf), b.schema, "scenario"))
        return rows.select("scenario", F.explode(F.create_map(*[x for c in outputs for x in (F.lit(c), F.col(c).cast("string"))])).alias("output", "v"))

    mine, theirs = scores(bundle), scores(again).withColumnRenamed("v", "w")
    return mine.join(theirs, ["scenario", "output"]).groupBy("output").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("v") == F.col("w")).alias("n_alike"))


_REPORTS = {"metrics": "modelo string, auc_ovr_macro double, f1_macro double, accuracy double, iterations int, converged boolean",
            "coefficients": "clase string, feature string, coef_logodds double, odds_ratio double, intercept_clase double, abs_impact double",
            **{f"confusion_{m}": "actual int, predicted int, n bigint" for m in M.MODELS},
            **{f"class_report_{m}": "clase int, precision double, recall double, f1 double, support bigint, tp bigint, predicted bigint" for m in M.MODELS}}
_TEST_SQL = f"{S.MASTER}, c AS (SELECT label, CAST(floor(count(*) * 0.2) AS BIGINT) AS n FROM master GROUP BY label)"


def _test_scores(spark, sf):
    t = T.trained(spark, sf)
    return materialise(M.apply_classifiers(t.models, t.test).drop("features"), "scored")


@query("s16_training_reports", f"""WITH {_TEST_SQL} SELECT r AS report, CAST(CASE WHEN r = 'metrics' OR r = 'coefficients' THEN 3 WHEN r = 'absent' THEN 0
  ELSE (SELECT sum(n) FROM c) END AS BIGINT) AS total, true AS as_written FROM (VALUES {", ".join(f"('{r}')" for r in (*_REPORTS, "absent"))}) t(r)""")
def s16_reports(spark, sf):
    """The reports of a training run, written and read back: models, classes or test rows that each covers."""
    folder, written = scratch_dir(spark, "reports"), M.training_reports(_test_scores(spark, sf), 3, _coefs(spark, sf), T.trained(spark, sf).models)
    B.write_reports(written, folder)
    found = B.read_reports(spark, folder, {**_REPORTS, "absent": "n bigint"})
    size = {"metrics": F.count_distinct("modelo"), "coefficients": F.count_distinct("clase"), "absent": F.count("n"),
            **{f"confusion_{m}": F.sum("n") for m in M.MODELS}, **{f"class_report_{m}": F.sum("support") for m in M.MODELS}}
    out = None
    for name, df in found.items():
        first = written.get(name, df)
        alike = df.exceptAll(first.select(df.columns)).isEmpty() and df.count() == first.count()
        row = df.agg(size[name].cast("bigint").alias("total")).select(F.lit(name).alias("report"), "total", F.lit(alike).alias("as_written"))
        out = row if out is None else out.unionByName(row)
    return out


@query("m17_class_support", f"""WITH {_TEST_SQL} SELECT modelo, label AS clase, n AS support, true AS f1_from_counts
  FROM c, (VALUES ('lr'), ('svm'), ('mlp')) m(modelo)""")
def m17_support(spark, sf):
    """Confusion and report of every fitted model: test rows per class, and whether F1 follows from the counts."""
    scored, out = _test_scores(spark, sf), None
    for m in M.MODELS:
        rep = E.class_report(E.confusion(scored, "label", f"pred_{m}", 3))
        f1 = F.try_divide(2 * F.col("tp"), F.col("support") + F.col("predicted"))
        row = rep.select(F.lit(m).alias("modelo"), "clase", "support", (F.abs(F.col("f1") - F.coalesce(f1, F.lit(0.0))) < 1e-12).alias("f1_from_counts"))
        out = row if out is None else out.unionByName(row)
    return out


def _fit_facts(spark, sf, name):
    """What must hold of a fitted classifier on the held-out rows."""
    t = T.trained(spark, sf)
    models = {"kernel": T.kernel_machine(spark, sf)} if name == "kernel" else t.models
    scored = M.apply_classifiers(models, t.test, [name])
    probs, pred = F.col(f"probs_{name}"), F.col(f"pred_{name}")
    total = F.aggregate(probs, F.lit(0.0), lambda a, p: a + p)
    counts = [F.count_if(F.col("label") == k) for k in range(3)]
    return scored.agg(
        F.count(F.lit(1)).alias("n_test"), F.greatest(*counts).alias("n_majority"), F.count_if(F.abs(total - 1) < 1e-9).alias("n_sum_to_one"),
        F.count_if(F.element_at(probs, (pred + 1).cast("int")) == F.array_max(probs)).alias("n_argmax")).withColumn("converged", F.lit(bool(M.convergence(models[name])[1])))


_FACTS_SQL = f"WITH {_TEST_SQL}, s AS (SELECT CAST(sum(n) AS BIGINT) AS n, max(n) AS m FROM c) " \
    "SELECT n AS n_test, m AS n_majority, n AS n_sum_to_one, n AS n_argmax, true AS converged FROM s"
for _id, _model in (("m5_logistic", "lr"), ("m6_kernel", "svm"), ("m6_kernel_machine", "kernel"), ("m7_relu_net", "mlp")):
    query(f"{_id}_facts", _FACTS_SQL)(lambda spark, sf, m=_model: _fit_facts(spark, sf, m))


@query("m20_what_if")
def m20(spark, sf):
    return Z.what_if(_states(spark, sf), T.scenario_schema(spark, sf), T.hit_scorer(T.served(spark, sf)), "scenario")


@query("m21_best_package")
def m21(spark, sf):
    return Z.best_package(_states(spark, sf), T.scenario_schema(spark, sf), T.hit_scorer(T.served(spark, sf)), "scenario")


@query("m22_explanation")
def m22(spark, sf):
    return Z.explain(_states(spark, sf), T.scenario_schema(spark, sf), T.hit_scorer(T.served(spark, sf)), "scenario")


@query("m23_similar_items")
def m23(spark, sf):
    t, schema = T.served(spark, sf), T.scenario_schema(spark, sf)
    items = M.preprocess(t.pre, stored(spark, sf, "master")).select("appid", vector_to_array("features").alias("v"))
    asked = M.preprocess(t.pre, Z.normalise(T.scenarios(spark, sf), schema, "scenario")) \
        .select(F.col("scenario").alias("appid"), vector_to_array("features").alias("v"))
    near = N.nearest(items, asked, "appid", "v", 8)
    meta = stored(spark, sf, "master").select(F.col("appid").alias("item_id"), "name", "developer", "label_name",
                                              "owners_lower_bound", "price")
    return near.join(meta, "item_id").withColumnRenamed("query_id", "scenario")


@query("j10_nearest_vectors", """SELECT query_id, CAST(rank AS INTEGER) AS rank, item_id, round_even(s, 3) AS similarity FROM (
  SELECT a.vec_id AS query_id, b.vec_id AS item_id, s, row_number() OVER (PARTITION BY a.vec_id ORDER BY s DESC, b.vec_id) AS rank
  FROM embeddings a CROSS JOIN embeddings b, LATERAL (SELECT round_even(list_cosine_similarity(
    CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 12) AS s) WHERE a.vec_id <> b.vec_id) WHERE rank <= 8""")
def j10(spark, sf):
    v = C.table(spark, sf, "embeddings").select("vec_id", "embedding")
    return N.nearest(v, v, "vec_id", "embedding", 8, skip_self=True)


@query("m24_owner_thresholds", """SELECT o_orderkey, CASE WHEN e >= 400000 THEN 'Hit' WHEN e >= 140000 THEN 'Rentable'
  ELSE 'Flop' END AS clase FROM (SELECT o_orderkey, CAST(floor(o_totalprice * 0.9) AS BIGINT) AS e FROM orders)""")
def m24(spark, sf):
    estimate = K.owners_from_log(F.log1p(F.floor(F.col("o_totalprice") * 0.9)) + 1e-12)
    return C.table(spark, sf, "orders").select(
        "o_orderkey", X.label_name(X.success_label(estimate, C.FLOP_MAX, C.HIT_MIN)).alias("clase"))
