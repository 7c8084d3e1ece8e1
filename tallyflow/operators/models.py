"""Spark ML models, their searches and their result tables.

Feature preparation is one pipeline; the metrics come from ``evaluation`` so that every
model is judged by the same exact aggregations.
"""

from __future__ import annotations


import random
import sys
from collections.abc import Callable, Mapping, Sequence
from multiprocessing.pool import ThreadPool
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import PythonEvalType, inheritable_thread_target

from tallyflow.operators import evaluation as ev
from tallyflow.session import cut_lineage, spread

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# More distinct values than this do not go through an in-memory index; hash them instead.
MAX_CATEGORIES = 10_000

# Most rows of a task of a fit, on average.
TASK_ROWS = 500_000

# Counted rows of a task of a fit, and fits of a search that run beside each other: on few rows their jobs are short.
COUNTED_ROWS, PARALLEL_FITS = 100_000, 8

# Values that the boosting search draws from: those of the reference, as far as Spark's trees have the parameter.
# A leaf of half the rows, the last share there, is beyond Spark's range by a hair.
BOOSTING = {
    "maxIter": [1, 4, 8, 16, 32, 64, 100, 200], "maxDepth": list(range(2, 31, 2)), "stepSize": [1.0, 0.5, 0.25, 0.1, 0.05, 0.01, 0.001],
    "minWeightFractionPerNode": [0.1, 0.2, 0.3, 0.4, 0.4999],
}


def check_cardinality(df: DataFrame, columns: Sequence[str], limit: int = MAX_CATEGORIES) -> None:
    """Refuse a category column whose values would not fit the driver-side index."""
    if not columns:
        return
    sizes = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first().asDict()
    large = {c: n for c, n in sizes.items() if n > limit}
    if large:
        raise ValueError(f"too many categories to index, use hashed features: {large}")


def indexers(columns: Sequence[str]) -> StringIndexer:
    """Frequency-ordered index of several columns; unseen values get an extra index."""
    return StringIndexer(
        inputCols=list(columns), outputCols=["idx_" + c for c in columns], handleInvalid="keep",
        stringOrderType="frequencyDesc",
    )


def encoders(columns: Sequence[str], drop_last: bool = True) -> OneHotEncoder:
    return OneHotEncoder(
        inputCols=["idx_" + c for c in columns], outputCols=["enc_" + c for c in columns],
        handleInvalid="keep", dropLast=drop_last,
    )


def assembler(columns: Sequence[str], prefix: str = "") -> VectorAssembler:
    names = [f"{prefix}_{c}" for c in columns] if prefix else list(columns)
    return VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep")


def feature_stages(df: DataFrame, categorical: Sequence[str], numeric: Sequence[str]) -> list:
    check_cardinality(df, categorical)
    stages: list = []
    if categorical:
        stages += [indexers(categorical), encoders(categorical)]
    return [*stages, VectorAssembler(inputCols=[*["enc_" + c for c in categorical], *numeric], outputCol="features", handleInvalid="skip")]


def prepare(train: DataFrame, others: Sequence[DataFrame], categorical: Sequence[str], numeric: Sequence[str]) -> list[DataFrame]:
    """Feature vectors of the training rows and of the other frames, from one fitted pipeline."""
    model = Pipeline(stages=feature_stages(train, categorical, numeric)).fit(train)
    return [model.transform(d) for d in (train, *others)]


def probability(df: DataFrame) -> DataFrame:
    """Rows with ``score``, the predicted probability of class 1."""
    return df.withColumn("score", vector_to_array("probability")[1])


def score_rows(model: Transformer, rows: DataFrame, label: str = "label") -> DataFrame:
    """(score, label) pairs of a model on rows; counted rows weigh as many as they stand for."""
    out = probability(model.transform(rows))
    return ev.scored(out, F.col("score"), F.col(label), *([F.col("n")] if "n" in rows.columns else []))


def counted(rows: DataFrame, key: str | None = None, folds: int = 1) -> DataFrame:
    """(label, features, fold, n): rows of equal label and features as one with their number; the fold is a digest of ``key``.

    Where splits and sums of a fit take ``n`` as the weight, the fit is that of all rows. The number of these rows is bounded by
    the combinations of values that the features have, whatever the number of rows; rows that are all different stay as many.
    """
    fold = F.pmod(F.xxhash64(key), F.lit(folds)).cast("int") if key else F.lit(0)
    return spread(rows.groupBy("label", "features", fold.alias("fold")).agg(F.count(F.lit(1)).cast("double").alias("n")), COUNTED_ROWS)


def logistic(l1: bool = True, strength: float = 1.0, rows: int = 1, **options) -> LogisticRegression:
    """Logistic regression with the inverse strength C of a summed loss: regParam = 1 / (C rows)."""
    return LogisticRegression(
        regParam=1.0 / (strength * rows), elasticNetParam=1.0 if l1 else 0.0, standardization=False, **options
    )


def sampled_grid(choices: Mapping[str, Sequence[Any] | Callable[[random.Random], Any]], n: int, seed: int) -> list[dict[str, Any]]:
    """``n`` seeded random draws of named parameters."""
    rng = random.Random(seed)
    return [
        {name: (c(rng) if callable(c) else rng.choice(list(c))) for name, c in choices.items()} for _ in range(n)
    ]


def param_maps(estimator: Estimator, grid: Sequence[Mapping[str, Any]]) -> list[dict]:
    return [{estimator.getParam(k): v for k, v in point.items()} for point in grid]


def search(
    estimator: Estimator,
    grid: Sequence[Mapping[str, Any]],
    train: DataFrame,
    folds: int = 3,
    metric: str = "areaUnderROC",
    seed: int = 30,
    parallelism: int = 2,
):
    """Cross-validated search: (best model, list of (parameters, mean metric)). ``counted`` rows bring their weights and folds."""
    if metric in ("areaUnderROC", "areaUnderPR"):
        evaluator = BinaryClassificationEvaluator(metricName=metric)
    else:
        evaluator = RegressionEvaluator(metricName=metric)
    own = {}
    if "n" in train.columns:
        estimator, evaluator, own = estimator.copy({estimator.weightCol: "n"}), evaluator.setWeightCol("n"), {"foldCol": "fold"}
    cv = CrossValidator(
        estimator=estimator, estimatorParamMaps=param_maps(estimator, grid), evaluator=evaluator,
        numFolds=folds, seed=seed, parallelism=parallelism, **own,
    ).fit(train)
    return cv.bestModel, list(zip(grid, cv.avgMetrics))


def logistic_search(train: DataFrame, n: int = 8, folds: int = 3, seed: int = 30):
    """Random search over C ~ Exp(1) and the penalty."""
    rows = train.count()
    draws = sampled_grid({"C": lambda r: max(r.expovariate(1.0), 1e-3), "l1": [0.0, 1.0]}, n, seed)
    grid = [{"regParam": 1.0 / (d["C"] * rows), "elasticNetParam": d["l1"]} for d in draws]
    return search(LogisticRegression(standardization=False), grid, train, folds, seed=seed)


class BaggedForest(RandomForestClassifier):
    """A random forest that draws the rows of a tree, with replacement, from counted rows too.

    A row of number n comes Poisson(n) times to a tree, as n rows come Poisson(1) times each. Every tree is a fit of its own on
    these draws as weights; rows without ``n`` are fitted together, as by Spark.
    """

    def _fit(self, dataset: DataFrame):
        if "n" not in dataset.columns:
            return super()._fit(dataset)
        trees, seed = self.getNumTrees(), self.getSeed()
        rows = cut_lineage(dataset.select("label", "features", _draws(trees, seed)("n", F.monotonically_increasing_id()).alias("w")))
        drawn = rows.agg(*[F.sum(F.col("w")[k]).alias(str(k)) for k in range(trees)]).first()
        subset = "sqrt" if self.getFeatureSubsetStrategy() == "auto" and trees > 1 else self.getFeatureSubsetStrategy()

        def tree(k: int):
            one = RandomForestClassifier(
                numTrees=1, bootstrap=False, featureSubsetStrategy=subset, weightCol="weight", seed=seed + k, maxDepth=self.getMaxDepth(),
                maxBins=self.getMaxBins(), impurity=self.getImpurity(), minInfoGain=self.getMinInfoGain(),
                # so many drawn rows are the least of a leaf
                minWeightFractionPerNode=min(max(self.getMinInstancesPerNode() / max(drawn[k] or 0, 1), self.getMinWeightFractionPerNode()), 0.4999),
            )
            return one.fit(rows.select("label", "features", F.col("w")[k].alias("weight")).where("weight > 0"))

        with ThreadPool(PARALLEL_FITS) as pool:
            fitted = pool.map(inheritable_thread_target(dataset.sparkSession)(tree), range(trees))
        context = dataset.sparkSession.sparkContext
        kinds = context._jvm.org.apache.spark.ml.classification
        made = context._gateway.new_array(kinds.DecisionTreeClassificationModel, trees)
        for k, model in enumerate(fitted):
            made[k] = model._java_obj.trees()[0]
        model = RandomForestClassificationModel(kinds.RandomForestClassificationModel(self.uid, made, fitted[0].numFeatures, max(m.numClasses for m in fitted)))
        model = self._copyValues(model._resetUid(self.uid))
        model._transfer_params_to_java()
        return model


def _draws(trees: int, seed: int):
    """For each row the numbers of its draws by ``trees`` trees, of its number and its place."""

    def drawn(n: pa.Array, place: pa.Array) -> pa.Array:
        found = np.random.default_rng([seed, place[0].as_py()]).poisson(n.to_numpy()[:, None], (len(n), trees)) if len(n) else np.zeros((0, trees))
        return pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * trees, pa.int32()), pa.array(found.ravel().astype(float)))

    return F.arrow_udf(drawn, "array<double>", PythonEvalType.SQL_SCALAR_ARROW_UDF)


def forest_search(train: DataFrame, key: str, n: int = 5, folds: int = 3, seed: int = 30):
    """Random search over forests, on counted rows where they are a third of the rows or fewer."""
    rows = counted(train, key, folds)
    sizes = rows.agg(F.count("n"), F.sum("n")).first()
    if sizes[0] * 3 > (sizes[1] or 0):
        rows = spread(train, TASK_ROWS)
    grid = sampled_grid({"numTrees": [4, 8, 16, 32], "maxDepth": [2, 4, 6, 8, 10], "minInstancesPerNode": [1, 5, 20]}, n, seed)
    return search(BaggedForest(seed=seed), grid, rows, folds, seed=seed)


def boosting_search(train: DataFrame, key: str, n: int = 20, folds: int = 3, seed: int = 30):
    """Random search over the reference's values of boosted trees, on counted rows. A split sees 1 to all but one of the features."""
    rows = counted(train, key, folds)
    subsets = [str(i) for i in range(1, max(len(feature_names(rows)), 2))]
    grid = sampled_grid({**BOOSTING, "featureSubsetStrategy": subsets}, n, seed)
    return search(GBTClassifier(seed=seed), grid, rows, folds, seed=seed, parallelism=PARALLEL_FITS)


def regression_search(estimator: Estimator, choices: Mapping[str, Sequence[Any]], train: DataFrame, n: int = 5, folds: int = 3, seed: int = 30):
    return search(estimator, sampled_grid(choices, n, seed), train, folds, "rmse", seed)


def sweep(
    spark: SparkSession, make: Callable[..., Estimator], values: Mapping[str, Sequence[Any]], train: DataFrame, test: DataFrame
) -> DataFrame:
    """One parameter at a time: (param, value, set, auc) on train and test."""
    evaluator = BinaryClassificationEvaluator()
    rows = []
    for name, options in values.items():
        for v in options:
            model = make(**{name: v}).fit(train)
            for part, data in (("train", train), ("test", test)):
                rows.append((name, float(v), part, float(evaluator.evaluate(model.transform(data)))))
    return spark.createDataFrame(rows, "param string, value double, `set` string, auc double")


def regressors(seed: int = 30) -> dict[str, Estimator]:
    return {
        "decision_tree": DecisionTreeRegressor(seed=seed),
        "random_forest": RandomForestRegressor(seed=seed),
        "gradient_boosting": GBTRegressor(seed=seed, maxIter=10),
        "linear": LinearRegression(),
        "elastic_net": LinearRegression(regParam=1.0, elasticNetParam=0.5),
        "huber": LinearRegression(loss="huber", regParam=0.0001),
        "ridge": LinearRegression(regParam=0.01, elasticNetParam=0.0),
    }


def compare_regressors(train: DataFrame, test: DataFrame, models: Mapping[str, Estimator] | None = None) -> DataFrame:
    """(model, rmse) on the test rows."""
    evaluator = RegressionEvaluator(metricName="rmse")
    rows = [(name, float(evaluator.evaluate(m.fit(train).transform(test)))) for name, m in (models or regressors()).items()]
    return train.sparkSession.createDataFrame(rows, "model string, rmse double")


def classification_metrics(scored: DataFrame) -> DataFrame:
    """One row: AUC, average precision, calibration (labels over predictions), accuracy, log-loss. The model scores each row once."""
    scored = cut_lineage(scored)
    parts = [
        ev.roc_auc(scored),
        ev.average_precision(scored),
        ev.calibration(scored, "actual_over_predicted"),
        ev.accuracy(scored),
        ev.errors(scored),
    ]
    out = parts[-1]
    for p in parts[:-1]:
        name = p.columns[0]
        out = out.withColumn(name, p.select(name).scalar())
    return out


def metric_rows(spark: SparkSession, found: Sequence[Mapping[str, Any]], name: str) -> DataFrame:
    """Result table of one named row of metrics per model."""
    if not found:
        return spark.createDataFrame([], f"{name} string")
    metrics = [c for c in max(found, key=len) if c != name]
    schema = ", ".join([f"{name} string", *[f"{m} double" for m in metrics]])
    return spark.createDataFrame([tuple([r[name], *[r.get(m) for m in metrics]]) for r in found], schema)


def per_label(train: DataFrame, test: DataFrame, labels: Sequence[str], make: Callable[[], Estimator]) -> DataFrame:
    """One model per label column; (label_name, metrics...). A label with one class only has null metrics."""
    found = []
    # a label with one class only has no model
    ends = train.agg(*[F.struct(F.min(c), F.max(c)).alias(c) for c in labels]).first()
    for name in labels:
        if ends[name][0] == ends[name][1]:
            found.append({"label_name": name})
            continue
        model = make().fit(train.withColumn("label", F.col(name).cast("double")))
        found.append({"label_name": name, **classification_metrics(score_rows(model, test, name)).first().asDict()})
    return metric_rows(train.sparkSession, found, "label_name")


def feature_names(df: DataFrame, features: str = "features") -> list[str]:
    """Names of the vector slots, from the column's metadata."""
    attrs = df.schema[features].metadata["ml_attr"]
    slots = [a for group in attrs.get("attrs", {}).values() for a in group]
    named = {a["idx"]: a["name"] for a in slots}
    return [named.get(i, f"f{i}") for i in range(attrs["num_attrs"])]


def weights_table(model, prepared: DataFrame) -> DataFrame:
    """(feature, weight) of a linear model's coefficients or a forest's importances."""
    linear = hasattr(model, "coefficients")
    values = (model.coefficients if linear else model.featureImportances).toArray()
    names = feature_names(prepared)
    rows = [(n, float(v)) for n, v in zip(names, values)]
    return prepared.sparkSession.createDataFrame(rows, "feature string, weight double")


def hashed_click_model(
    rows: DataFrame, columns: Sequence[str], label: str, weight: str, buckets: int = 2**12, reg: float = 0.01
) -> PipelineModel:
    """Weighted logistic click model on hashed features."""
    hasher = FeatureHasher(inputCols=list(columns), outputCol="features", numFeatures=buckets, categoricalCols=list(columns))
    model = LogisticRegression(labelCol=label, weightCol=weight, regParam=reg, maxIter=20)
    return Pipeline(stages=[hasher, model]).fit(rows)


