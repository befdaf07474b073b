"""L2: fitted models of a session, and the scenario tables they score."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, lru_cache

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise import vocab
from shelfwise.functions.rounding import round_to
from shelfwise.operators import filters as R, kernels, models as M, ordered as O, profile as PR
from shelfwise.operators.scoring import Schema, Scorer
from shelfwise.plans import catalogue as C
from shelfwise.plans.data import stored, version
from shelfwise.session import materialise
from shelfwise.sources.bundle import Bundle

SEED, TEST_SHARE = 42, 0.2


@dataclass
class Trained:
    """Models fitted on the training rows, each when it is first asked for."""

    features: M.Features
    pre: PipelineModel
    models: M.Classifiers
    train: DataFrame
    test: DataFrame

    @cached_property
    def owners(self):
        return M.owners_regressor().fit(self.train)


@dataclass
class Served:
    """Models fitted on all rows when they are first asked for, for scoring and explaining."""

    features: M.Features
    pre: PipelineModel
    models: M.Classifiers
    rows: DataFrame

    @cached_property
    def owners(self):
        return M.owners_regressor().fit(self.rows)


@lru_cache(maxsize=2)
def _features(key: tuple, sf: str, name: str) -> M.Features:
    df = stored(SparkSession.active(), sf, name)
    if name == "master":
        return M.select_features(df)
    flags = PR.kept_columns(df, R.columns_with_prefix(df, vocab.FLAG_PREFIXES), "stage1")
    return M.Features(tuple(c for c in vocab.STAGE1_NUMERIC if c in df.columns), tuple(flags),
                      tuple(c for c in vocab.CATEGORICAL_COLS if c in df.columns))


def features(spark: SparkSession, sf: str, name: str = "master") -> M.Features:
    return _features(version(spark, sf), sf, name)


def split(df: DataFrame, label: str) -> DataFrame:
    return O.stratified_test_flag(df, label, "appid", SEED, TEST_SHARE)


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    return stored(spark, sf, "master").withColumn("log_owners", F.log1p(F.col("owners_lower_bound").cast("double")))


@lru_cache(maxsize=2)
def _trained(key: tuple, sf: str) -> Trained:
    spark = SparkSession.active()
    f = features(spark, sf)
    df = split(_labelled(spark, sf), "label")
    pre = M.fit_preprocessor(df.where(~F.col("is_test")), f)
    rows = materialise(M.preprocess(pre, df).select("appid", "label", "log_owners", "is_test", "features"), "train")
    train, test = rows.where(~F.col("is_test")), rows.where("is_test")
    return Trained(f, pre, M.fit_classifiers(train, len(vocab.LABEL_NAMES)), train, test)


def trained(spark: SparkSession, sf: str) -> Trained:
    """Models fitted on the training rows only, for evaluation on the others."""
    return _trained(version(spark, sf), sf)


@lru_cache(maxsize=2)
def _kernel_machine(key: tuple, sf: str):
    return kernels.fit(trained(SparkSession.active(), sf).train, len(vocab.LABEL_NAMES))


def kernel_machine(spark: SparkSession, sf: str):
    """M6: the kernel machine, fitted on the training rows."""
    return _kernel_machine(version(spark, sf), sf)


@lru_cache(maxsize=2)
def _served(key: tuple, sf: str) -> Served:
    spark = SparkSession.active()
    f, df = features(spark, sf), _labelled(spark, sf)
    pre = M.fit_preprocessor(df, f)
    rows = materialise(M.preprocess(pre, df).select("appid", "label", "log_owners", "features"), "served")
    return Served(f, pre, M.fit_classifiers(rows, len(vocab.LABEL_NAMES)), rows)


def served(spark: SparkSession, sf: str) -> Served:
    return _served(version(spark, sf), sf)


@lru_cache(maxsize=2)
def _served_traction(key: tuple, sf: str):
    spark = SparkSession.active()
    f, df = features(spark, sf, "stage1"), stored(spark, sf, "stage1").withColumn("label", F.col("tiene_ventas"))
    pre = M.fit_preprocessor(df, f)
    rows = materialise(M.preprocess(pre, df).select("appid", "label", "features"), "served1")
    return pre, M.logistic("s1", 1.0, float(rows.count()), family="binomial", weighted=False).fit(rows)


def served_traction(spark: SparkSession, sf: str):
    """The first-stage preprocessor and model, fitted on all rows."""
    return _served_traction(version(spark, sf), sf)


@lru_cache(maxsize=2)
def _traction(key: tuple, sf: str):
    """The first-stage model; its test rows come scored."""
    spark = SparkSession.active()
    f = features(spark, sf, "stage1")
    df = split(stored(spark, sf, "stage1").withColumn("label", F.col("tiene_ventas")), "label")
    pre = M.fit_preprocessor(df.where(~F.col("is_test")), f)
    rows = materialise(M.preprocess(pre, df).select("appid", "label", "is_test", "features"), "train1")
    train = rows.where(~F.col("is_test"))
    model = M.logistic("s1", 1.0, float(train.count()), family="binomial", weighted=False).fit(train)
    scored = model.transform(rows.where("is_test")).withColumn("score", vector_to_array("prob_s1")[1])
    return pre, model, scored


def traction(spark: SparkSession, sf: str):
    return _traction(version(spark, sf), sf)


@lru_cache(maxsize=2)
def _schema(key: tuple, sf: str) -> Schema:
    spark = SparkSession.active()
    df, f = stored(spark, sf, "master"), features(spark, sf)
    # One row per feature.
    defaults = {r["column"]: r["median"] for r in PR.numeric_defaults(df, f.numeric).collect()}
    modes = PR.category_defaults(df, f.categorical).where("is_default")
    defaults.update({r["column"]: r["value"] for r in modes.collect()})
    mutable = {r["flag"] for r in R.actionable_flags(df, f.flags).collect()}
    return Schema(f, defaults, tuple(c for c in f.flags if c in mutable))


def scenario_schema(spark: SparkSession, sf: str) -> Schema:
    return _schema(version(spark, sf), sf)


def bundle(spark: SparkSession, sf: str) -> Bundle:
    """All models that serve scenarios, with their schema."""
    t = served(spark, sf)
    s1_pre, s1_model = served_traction(spark, sf)
    return Bundle({"pre": t.pre, **t.models, "owners": t.owners, "s1_pre": s1_pre, "s1": s1_model}, scenario_schema(spark, sf))


def apply_bundle(b: Bundle, states: DataFrame) -> DataFrame:
    """Normalised scenarios with pred_ and probs_ of every classifier, pred_owners and p_traction."""
    rows = M.apply_classifiers(b.stages, b.stages["owners"].transform(M.preprocess(b.stages["pre"], states)))
    rows = M.preprocess(b.stages["s1_pre"], rows.drop("features"))
    return b.stages["s1"].transform(rows).withColumn("p_traction", vector_to_array("prob_s1")[1])


def scenarios(spark: SparkSession, sf: str) -> DataFrame:
    """One planned item per customer: a few choices are given, the rest take defaults."""
    k = F.col("c_custkey")
    return C.table(spark, sf, "customer").select(
        k.alias("scenario"), round_to(F.abs("c_acctbal") / 80, 2).alias("price"), (k % 20).alias("supported_languages"),
        F.when(k % 3 == 0, "full").otherwise("none").alias("controller_support"),
        F.when(k % 4 != 0, F.concat(F.lit("Q"), (k % 4).cast("string"))).alias("release_quarter"),
        (k % 2).alias("genre_promo"), (k % 5 == 0).cast("int").alias("tag_brand_3"), F.lit(1).alias("no_such_feature"))


def hit_scorer(t: Trained | Served, model: str = "mlp") -> Scorer:
    """P(Hit) of one model; the input columns stay."""
    def score(df: DataFrame) -> DataFrame:
        out = M.apply_classifiers(t.models, M.preprocess(t.pre, df), [model])
        return out.withColumn("p_hit", F.col(f"probs_{model}")[2]).select(*[F.col(f"`{c}`") for c in df.columns], "p_hit")

    return score
