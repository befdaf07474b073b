"""Feature selection, preprocessing, classifiers, regressors and searches on Spark ML."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, functions as F

from shelfwise import vocab
from shelfwise.operators import linear, metrics, nets
from shelfwise.operators.filters import columns_with_prefix
from shelfwise.operators.ordered import fold_of
from shelfwise.operators.profile import kept_columns, numeric_columns
from shelfwise.operators.stages import FourierMap, KernelMachineModel, ReluNetModel
from shelfwise.session import materialise


@dataclass(frozen=True)
class Features:
    numeric: tuple[str, ...]
    flags: tuple[str, ...]
    categorical: tuple[str, ...]

    @property
    def all(self) -> list[str]:
        return [*self.numeric, *self.flags, *self.categorical]


def select_features(df: DataFrame, mode: str = "master") -> Features:
    """M1: columns known before launch that carry information."""
    categorical = [c for c in vocab.CATEGORICAL_COLS if c in df.columns]
    flags = columns_with_prefix(df, vocab.FLAG_PREFIXES)
    out = {*vocab.ID_COLS, *vocab.LABEL_COLS, *vocab.TARGET_COLS, *vocab.POSTLAUNCH_COLS, *vocab.TEMPORAL_COLS,
           *categorical, *flags}
    numeric = [c for c in numeric_columns(df) if c not in out and not c.startswith("ts_")]
    kept = set(kept_columns(df, numeric + flags, mode))
    return Features(tuple(c for c in numeric if c in kept), tuple(c for c in flags if c in kept), tuple(categorical))


def feature_catalogue(df: DataFrame, features: Features) -> DataFrame:
    rows = [(c, k) for k, cs in (("numeric", features.numeric), ("boolean", features.flags),
                                 ("categorical", features.categorical)) for c in cs]
    return df.sparkSession.createDataFrame(rows, "feature string, kind string")


def fit_preprocessor(df: DataFrame, features: Features, out: str = "features") -> PipelineModel:
    """M2: numbers standardised with the population deviation, flags as they are, categories one-hot.

    A category unknown at fit time gives zeros.
    """
    stats = df.agg(*[e for c in features.numeric for e in (F.avg(c), F.stddev_pop(c))]).first() or []
    scaled = []
    for i, c in enumerate(features.numeric):
        mean, dev = float(stats[2 * i] or 0.0), float(stats[2 * i + 1] or 0.0)
        scaled.append(f"(CAST(`{c}` AS DOUBLE) - {mean!r}D) / {dev if dev > 0 else 1.0!r}D AS `_z{i}`")
    stages = [SQLTransformer(statement="SELECT " + ", ".join(["*", *scaled]) + " FROM __THIS__")]
    # Flags keep their names: a second name for each would multiply what the optimizer infers about sums of flags.
    inputs = [f"_z{i}" for i in range(len(features.numeric))] + list(features.flags)
    if features.categorical:
        index = [f"_i{i}" for i in range(len(features.categorical))]
        hot = [f"_o{i}" for i in range(len(features.categorical))]
        stages += [
            StringIndexer(inputCols=list(features.categorical), outputCols=index, handleInvalid="keep",
                          stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=index, outputCols=hot, dropLast=True),
        ]
        inputs += hot
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=inputs, outputCol=out)]).fit(df)


def preprocess(pre: PipelineModel, df: DataFrame) -> DataFrame:
    """The input columns and the feature vector, without the helper columns."""
    return pre.transform(df).select(*[F.col(f"`{c}`") for c in df.columns], "features")


def feature_names(pre: PipelineModel, features: Features) -> list[str]:
    names = [*features.numeric, *features.flags]
    if features.categorical:
        for c, labels in zip(features.categorical, pre.stages[1].labelsArray):
            names += [f"{c}_{v}" for v in labels]
    return names


def _outputs(estimator, name: str):
    return estimator.setPredictionCol(f"pred_{name}").setProbabilityCol(f"prob_{name}") \
        .setRawPredictionCol(f"raw_{name}").setFeaturesCol("features").setLabelCol("label")


def logistic(name: str = "lr", c: float = 1.0, weight_sum: float = 1.0, family: str = "multinomial",
             weighted: bool = True, max_iter: int = 2000, features: str = "features") -> LogisticRegression:
    """L2 penalty 1/(2C) against the summed loss, as Spark's mean loss needs it divided by the weight sum."""
    est = _outputs(LogisticRegression(family=family, maxIter=max_iter, tol=1e-6, standardization=False,
                                      regParam=1.0 / (c * weight_sum)), name).setFeaturesCol(features)
    return est.setWeightCol("weight") if weighted else est


def owners_regressor(max_iter: int = 100, seed: int = 42) -> GBTRegressor:
    """M8: boosted trees on the log1p target."""
    return GBTRegressor(featuresCol="features", labelCol="log_owners", predictionCol="pred_owners", maxIter=max_iter,
                        maxDepth=5, stepSize=0.1, seed=seed)


class Classifiers(Mapping):
    """M5-M7 on rows with ``features`` and ``label``: the fitted model of each family, each fitted when it is first asked for.

    The solvers stop on their tolerance; the limits are for models that don't get there, see ``convergence``.
    """

    NAMES = ("lr", "fourier", "svm", "mlp")

    def __init__(self, train: DataFrame, classes: int, max_iter: int = 2000, key: str = "appid"):
        self.train, self.classes, self.max_iter, self.key = train, classes, max_iter, key
        self.fitted: dict = {}

    def __getitem__(self, name: str):
        if name not in self.NAMES:
            raise KeyError(name)
        if name not in self.fitted:
            self.fitted[name] = self._fit(name)
        return self.fitted[name]

    def __iter__(self):
        return iter(self.NAMES)

    def __len__(self) -> int:
        return len(self.NAMES)

    def _fit(self, name: str):
        if name == "mlp":
            return nets.fit(self.train, self.classes, self.key)
        weighted = metrics.class_weights(self.train, "label")
        if name == "fourier":
            return FourierMap.fit(weighted)
        # One row; the vector length comes from the data.
        n = weighted.count()
        if name == "lr":
            return logistic("lr", 1.0, n, max_iter=self.max_iter).fit(weighted)
        est = logistic("svm", 10.0, n, max_iter=self.max_iter, features="fourier")
        if n > linear.KEPT_ROWS and self.train.select("label").distinct().count() > 1:
            return linear.fit(weighted, self["fourier"], est)
        return est.fit(self["fourier"].transform(weighted))


def fit_classifiers(train: DataFrame, classes: int, max_iter: int = 2000, key: str = "appid") -> Classifiers:
    return Classifiers(train, classes, max_iter, key)


MODELS = ("lr", "svm", "mlp")


def apply_classifiers(models: Mapping, df: DataFrame, names: Sequence[str] = MODELS) -> DataFrame:
    """pred_<m> and probs_<m> (array) of each model."""
    for m in names:
        if m == "svm":
            df = models["fourier"].transform(df)
        df = models[m].transform(df).withColumn(f"probs_{m}", vector_to_array(f"prob_{m}")) \
            .drop(f"prob_{m}", f"raw_{m}", "fourier")
    return df


def convergence(model) -> tuple[int | None, bool | None]:
    """Iterations that a fitted classifier took, and whether it stopped before its limit; unknown for a loaded model."""
    if isinstance(model, (ReluNetModel, KernelMachineModel)):
        return model.getOrDefault(model.iterations), model.getOrDefault(model.stopped)
    if hasattr(model, "took"):
        return model.took
    if not model.hasSummary:
        return None, None
    summary = model.summary() if callable(model.summary) else model.summary
    return summary.totalIterations, summary.totalIterations < model.getMaxIter()


def compare_models(scored: DataFrame, classes: int, names: Sequence[str] = MODELS, models: Mapping | None = None) -> DataFrame:
    """One metrics row per model; with ``models`` also their iterations and whether they converged."""
    out = None
    for m in names:
        row = metrics.classification_metrics(scored, "label", f"pred_{m}", [F.col(f"probs_{m}")[i] for i in range(classes)])
        row = row.select(F.lit(m).alias("modelo"), "*")
        if models:
            took, ended = convergence(models[m])
            row = row.withColumns({"iterations": F.lit(took).cast("int"), "converged": F.lit(ended).cast("boolean")})
        out = row if out is None else out.unionByName(row)
    return out


def training_reports(scored: DataFrame, classes: int, coefs: DataFrame, models: Mapping | None = None, names: Sequence[str] = MODELS) -> dict[str, DataFrame]:
    """Metrics of all models, confusion and class report of each, and coefficients, by report name."""
    out = {"metrics": compare_models(scored, classes, names, models), "coefficients": coefs}
    for m in names:
        out[f"confusion_{m}"] = metrics.confusion(scored, "label", f"pred_{m}", classes)
        out[f"class_report_{m}"] = metrics.class_report(out[f"confusion_{m}"])
    return out


def coefficients(df: DataFrame, model: LogisticRegressionModel, names: Sequence[str],
                 classes: Sequence[str]) -> DataFrame:
    """One row per class and feature; as large as the model."""
    matrix, intercept = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    rows = [(c, f, float(matrix[i, j]), float(intercept[i])) for i, c in enumerate(classes) for j, f in enumerate(names)]
    table = df.sparkSession.createDataFrame(
        rows, "clase string, feature string, coef_logodds double, intercept_clase double")
    return table.select("clase", "feature", "coef_logodds", F.exp("coef_logodds").alias("odds_ratio"),
                        "intercept_clase", F.abs("coef_logodds").alias("abs_impact"))


class MacroAuc(Evaluator):
    """Mean one-against-rest AUC of a scored fold."""

    def __init__(self, classes: int, prob: str = "prob_lr", label: str = "label"):
        super().__init__()
        self.classes, self.prob, self.label = classes, prob, label

    def _evaluate(self, dataset: DataFrame) -> float:
        probs, names = vector_to_array(self.prob), [f"p{i}" for i in range(self.classes)]
        # Written once: each class's curve sorts its scores, which reads them several times.
        scored = materialise(dataset.select(self.label, *[probs[i].alias(n) for i, n in enumerate(names)]), "fold")
        return metrics.auc_ovr_macro(scored, self.label, [F.col(n) for n in names])

    def isLargerBetter(self) -> bool:
        return True


def grid_search(train: DataFrame, classes: int, key: str, grid: Sequence[float] = (0.1, 1.0, 10.0), folds: int = 3,
                max_iter: int = 1000, parallelism: int = 2) -> tuple[DataFrame, Model]:
    """Mean macro AUC per C, and the best model refitted on all rows."""
    rows = metrics.class_weights(train, "label").withColumn("fold", fold_of(F.col(key), folds)).persist()
    n = rows.count()
    est = logistic("lr", 1.0, n, max_iter=max_iter)
    # Folds train on (folds - 1) / folds of the rows.
    part = n * (folds - 1) / folds
    params = ParamGridBuilder().addGrid(est.regParam, [1.0 / (c * part) for c in grid]).build()
    cv = CrossValidator(estimator=est, estimatorParamMaps=params, evaluator=MacroAuc(classes), numFolds=folds,
                        foldCol="fold", parallelism=parallelism).fit(rows)
    table = train.sparkSession.createDataFrame(
        [(float(c), float(m)) for c, m in zip(grid, cv.avgMetrics)], "c double, auc_ovr_macro double")
    rows.unpersist()
    return table, cv.bestModel
