"""Training, selection and scoring with Spark ML."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from scorelake.functions import vocab
from scorelake.operators.evaluate import auc_of, ratio, score_curve
from scorelake.operators.insight import feature_groups
from scorelake.operators.prepare import fit_preprocess
from scorelake.operators.sampling import random_oversample, stratified_kfold
from scorelake.sizing import join_lookup, kept

MAX_DEPTH = 30
#: Folds fitted at once: a fit is a chain of short jobs that leaves cores idle between them.
PARALLEL_FOLDS = 3
METRIC_NAMES = ["accuracy", "precision", "recall", "f1", "auc", "avg_precision"]


def random_forest(trees: int = 100, depth: int | None = 10, min_rows: int = 1, seed: int = 42,
                  features: str = "features", label: str = "label") -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol=features, labelCol=label, numTrees=trees, maxDepth=min(depth or MAX_DEPTH, MAX_DEPTH),
        minInstancesPerNode=min_rows, seed=seed, cacheNodeIds=False,
    )


def gradient_boosting(trees: int = 100, depth: int = 3, rate: float = 0.1, seed: int = 42,
                      features: str = "features", label: str = "label") -> GBTClassifier:
    return GBTClassifier(featuresCol=features, labelCol=label, maxIter=trees, maxDepth=depth, stepSize=rate, seed=seed)


def balanced_weight(df: DataFrame, target: str, out: str = "weight") -> DataFrame:
    """Add n / (k * n_class) per row."""
    counts = df.groupBy(F.col(target).alias("__class")).agg(F.count(F.lit(1)).alias("__n"))
    whole = counts.agg((F.sum("__n") / F.count(F.lit(1))).alias("share")).scalar()
    weights = counts.select("__class", (whole / F.col("__n")).alias(out))
    return join_lookup(df, weights, lambda a, b: a[target].eqNullSafe(b["__class"])).drop("__class")


def logistic(max_iter: int = 1000, features: str = "features", label: str = "label", weight: str | None = None) -> LogisticRegression:
    model = LogisticRegression(featuresCol=features, labelCol=label, maxIter=max_iter)
    return model.setWeightCol(weight) if weight else model


def vectorize(df: DataFrame, columns: Sequence[str], target: str, keep: Sequence[str] = (), out: str = "features") -> DataFrame:
    """Rows with a dense feature vector and a double label."""
    assembler = VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid="keep")
    named = df.withColumn("label", F.col(target).cast("double"))
    return assembler.transform(named).select(*keep, "label", out)


def batch_score(df: DataFrame, model, out: str = "prediction_probability") -> DataFrame:
    """Probability of class 1 for every row, in the plan of ``df``."""
    scored = model.transform(df).withColumn(out, vector_to_array("probability")[1])
    return scored.select(*df.columns, out)


def evaluate_scored(df: DataFrame, y: str, score: str) -> DataFrame:
    """The six metrics of one scored table in one row. Class 1 needs a score above one half."""
    curve = score_curve(df, y, score)
    up = F.col("score") > 0.5

    def total(c: str, cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0))

    below = F.col("negatives") - F.col("fp")
    step = F.col("pos") / F.col("positives") * F.col("tp") / (F.col("tp") + F.col("fp"))
    sums = curve.agg(
        total("pos", up).alias("tp"), total("neg", up).alias("fp"), total("pos", ~up).alias("fn"), total("neg", ~up).alias("tn"),
        F.try_divide(F.sum(F.col("pos").cast("double") * (below + F.col("neg") / 2)),
                     F.max("positives").cast("double") * F.max("negatives")).alias("auc"),
        F.coalesce(F.sum(step), F.lit(0.0)).alias("avg_precision"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return sums.select(
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"), ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"), "auc", "avg_precision",
    )


def metrics_of(df: DataFrame, y: str, score: str) -> dict[str, float]:
    return {k: (float("nan") if v is None else float(v)) for k, v in evaluate_scored(df, y, score).first().asDict().items()}


def each_fold(spark, folds: int, work: Callable[[int], object]) -> list:
    """``work`` of every fold, a few at once, in fold order."""
    with ThreadPoolExecutor(min(folds, PARALLEL_FOLDS)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), range(folds)))


# Importance-based selection -------------------------------------------------------------------


def importances(data: DataFrame, columns: Sequence[str], trees: int, seed: int, depth: int = 5,
                features: str = "features") -> dict[str, float]:
    values = random_forest(trees, depth, seed=seed, features=features).fit(data).featureImportances.toArray()
    return dict(zip(columns, (float(v) for v in values)))


def _subset(data: DataFrame, columns: Sequence[str], wanted: Sequence[str]) -> DataFrame:
    from pyspark.ml.feature import VectorSlicer

    index = {c: i for i, c in enumerate(columns)}
    slicer = VectorSlicer(inputCol="features", outputCol="part", indices=[index[c] for c in wanted])
    return slicer.transform(data).select("label", F.col("part").alias("features"))


def rfe(df: DataFrame, target: str, columns: Sequence[str], n: int = 20, step: int = 1, trees: int = 50, seed: int = 42) -> list[str]:
    """Drop the least important features, refitting each time, until ``n`` remain."""
    data = kept(vectorize(df, columns, target))
    left = list(columns)
    try:
        while len(left) > n:
            weight = importances(_subset(data, columns, left), left, trees, seed)
            drop = sorted(left, key=lambda c: (weight[c], c))[: min(step, len(left) - n)]
            left = [c for c in left if c not in drop]
    finally:
        data.unpersist()
    return left


def rfecv(df: DataFrame, target: str, columns: Sequence[str], row_id: str, n: int = 20, folds: int = 5,
          step: int = 1, trees: int = 50, seed: int = 42) -> list[str]:
    """The feature count from ``n`` up with the best mean fold accuracy, then ``rfe`` to that count."""
    data = kept(stratified_kfold(df, target, row_id, folds, seed))
    sizes = sorted({max(n, len(columns) - i * step) for i in range((len(columns) - n) // step + 2)})

    def scores(fold: int) -> dict[int, float]:
        train, val = data.where(F.col("fold") != fold), data.where(F.col("fold") == fold)
        left, found = list(columns), {}
        while True:
            fitted = random_forest(trees, 5, seed=seed).fit(vectorize(train, left, target))
            guess = fitted.transform(vectorize(val, left, target))
            found[len(left)] = guess.agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0] or 0.0
            if len(left) <= n:
                return found
            weight = dict(zip(left, fitted.featureImportances.toArray()))
            drop = sorted(left, key=lambda c: (weight[c], c))[: min(step, len(left) - n)]
            left = [c for c in left if c not in drop]

    try:
        by_fold = each_fold(df.sparkSession, folds, scores)
    finally:
        data.unpersist()
    score = {s: sum(f[s] for f in by_fold if s in f) for s in sizes}
    best = max(sizes, key=lambda s: (score[s], -s))
    return rfe(df, target, columns, best, step, trees, seed)


def select_from_model(df: DataFrame, target: str, columns: Sequence[str], n: int = 20, trees: int = 100, seed: int = 42) -> list[str]:
    """Features at least as important as the mean, at most ``n`` of them, in input order."""
    weight = importances(vectorize(df, columns, target), columns, trees, seed)
    limit = float(np.mean(list(weight.values())))
    best = sorted((c for c in columns if weight[c] >= limit), key=lambda c: (-weight[c], c))[:n]
    return [c for c in columns if c in best]


def select_features(df: DataFrame, target: str, columns: Sequence[str], row_id: str, method: str = "rfe", n: int = 20) -> list[str]:
    from scorelake.operators.prepare import select_k_best

    if method == "rfe":
        return rfe(df, target, columns, n)
    if method == "rfecv":
        return rfecv(df, target, columns, row_id, n)
    if method == "selectkbest":
        best = {r["feature"] for r in select_k_best(df, target, columns, n).collect()}
        return [c for c in columns if c in best]
    if method == "model":
        return select_from_model(df, target, columns, n)
    raise ValueError(f"unknown method: {method}")


def feature_importance(spark, model, names: Sequence[str], top: int = 20) -> DataFrame:
    """``(feature, importance)`` ranked; names are cut or padded to the model's width."""
    values = [float(v) for v in model.featureImportances.toArray()]
    labels = list(names[: len(values)]) + [f"Feature_{i}" for i in range(len(names), len(values))]
    rows = spark.createDataFrame(list(zip(labels, values)), "feature string, importance double")
    return rows.orderBy(F.desc("importance"), "feature").limit(top)


# Cross validation ------------------------------------------------------------------------------


def cross_validate_balanced(df: DataFrame, target: str, columns: Sequence[str], row_id: str,
                            make: Callable[[], object] | None = None, folds: int = 5, seed: int = 42,
                            balance: bool = True) -> DataFrame:
    """``(metric, mean, std)`` over folds; only training rows are balanced, deviation is over folds."""
    data = kept(stratified_kfold(df, target, row_id, folds, seed))

    def metrics(fold: int) -> dict[str, float]:
        train, val = data.where(F.col("fold") != fold), data.where(F.col("fold") == fold)
        top = train.agg(F.max(F.col(target).cast("double"))).first()[0]
        if balance:
            train = random_oversample(train, target, row_id, seed + fold)
        fitted = (make() if make else random_forest(50, 5, seed=seed)).fit(with_classes(_fit_rows(train, columns, target, make), top))
        return metrics_of(batch_score(vectorize(val, columns, target), fitted), "label", "prediction_probability")

    try:
        rows = each_fold(df.sparkSession, folds, metrics)
    finally:
        data.unpersist()
    names = ["accuracy", "auc", "precision", "recall", "f1"]
    out = [(m, float(np.mean([r[m] for r in rows])), float(np.std([r[m] for r in rows]))) for m in names]
    return df.sparkSession.createDataFrame(out, "metric string, mean double, std double")


def _fit_rows(train: DataFrame, columns: Sequence[str], target: str, make) -> DataFrame:
    keep = ["weight"] if "weight" in train.columns else []
    return vectorize(train, columns, target, keep)


def with_classes(data: DataFrame, top: float | None) -> DataFrame:
    """``data`` with its largest label noted, so that a fit need not draw and join balanced rows once more to find it."""
    if top is None or top < 0 or top != int(top):
        return data
    noted = F.col("label").alias("label", metadata={"ml_attr": {"type": "nominal", "num_vals": int(top) + 1}})
    return data.select(*[noted if c == "label" else c for c in data.columns])


def predictive_power(df: DataFrame, target: str, columns: Sequence[str], row_id: str, folds: int = 5, seed: int = 42,
                     groups: Mapping[str, Sequence[str]] = vocab.POWER_GROUPS, max_iter: int = 1000) -> DataFrame:
    """``(group, mean_auc, std_auc)`` of a class-weighted logistic model, on all features and per group."""
    data = kept(stratified_kfold(df, target, row_id, folds, seed))
    sets = {"all": list(columns)} | {g: m for g, m in feature_groups(columns, groups).items() if m}
    scores: dict[str, list[float]] = {name: [] for name in sets}
    try:
        for fold in range(folds):
            train = balanced_weight(data.where(F.col("fold") != fold), target)
            val = data.where(F.col("fold") == fold)
            for name, members in sets.items():
                fitted = logistic(max_iter, weight="weight").fit(vectorize(train, members, target, ["weight"]))
                scored = batch_score(vectorize(val, members, target), fitted)
                scores[name].append(auc_of(score_curve(scored, "label", "prediction_probability")).first()["auc"])
    finally:
        data.unpersist()
    out = [(name, float(np.mean(v)), float(np.std(v))) for name, v in scores.items()]
    return df.sparkSession.createDataFrame(out, "`group` string, mean_auc double, std_auc double")


# Training --------------------------------------------------------------------------------------


@dataclass
class TrainedModel:
    name: str
    preprocess: PipelineModel
    classifier: object
    metrics: dict[str, float] = field(default_factory=dict)
    params: dict[str, str] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        return self.classifier.transform(self.preprocess.transform(df))

    def save(self, path: str) -> None:
        PipelineModel([*self.preprocess.stages, self.classifier]).write().overwrite().save(path)


def train_scoring_model(parts: DataFrame, target: str, numeric: Sequence[str], categorical: Sequence[str],
                        kind: str = "RandomForest", split: str = "split", preprocess: PipelineModel | None = None,
                        **params) -> TrainedModel:
    """Fit on split = train, report six metrics each on val and test. ``preprocess`` is one already fitted on the same train rows."""
    train = parts.where(F.col(split) == "train")
    preprocess = fit_preprocess(train, numeric, categorical) if preprocess is None else preprocess
    estimator = gradient_boosting(**params) if kind == "GradientBoosting" else random_forest(**params)
    data = kept(preprocess.transform(train).select(F.col(target).cast("double").alias("label"), "features"))
    try:
        classifier = estimator.fit(data)
    finally:
        data.unpersist()
    out = TrainedModel(kind, preprocess, classifier, params={k: str(v) for k, v in params.items()})
    for name in ("val", "test"):
        scored = batch_score(parts.where(F.col(split) == name), out)
        out.metrics |= {f"{name}_{m}": v for m, v in metrics_of(scored, target, "prediction_probability").items()}
    return out


def compare_models(models: Sequence[TrainedModel]) -> TrainedModel:
    """Best validation AUC; the earlier model wins a tie."""
    return max(models, key=lambda m: m.metrics["val_auc"])


def best_run(metrics: DataFrame, metric: str = "val_auc", order: str = "start_time") -> DataFrame:
    """The run with the highest value of a metric, from a run table."""
    rows = metrics.where((F.col("kind") == "metric") & (F.col("key") == metric))
    value = F.col("value").try_cast("double")
    best = rows.agg(F.min(F.struct((-value).alias("m"), F.col(order), F.col("run_id"), F.col("name"))).alias("b"))
    return best.select("b.run_id", "b.name", (-F.col("b.m")).alias(metric))


# Run table -------------------------------------------------------------------------------------

RUN_SCHEMA = "run_id string, name string, start_time timestamp_ntz, kind string, key string, value string"


def run_rows(spark, name: str, start_time, params: Mapping[str, object], metrics: Mapping[str, float], run_id: str | None = None) -> DataFrame:
    run = run_id or uuid.uuid4().hex
    rows = [(run, name, start_time, "param", k, str(v)) for k, v in params.items()]
    rows += [(run, name, start_time, "metric", k, repr(float(v))) for k, v in metrics.items()]
    return spark.createDataFrame(rows, RUN_SCHEMA)


def record_run(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").partitionBy("name").parquet(path)


def latest_runs(runs: DataFrame) -> DataFrame:
    """Rows of the newest run of each name. The newest run per name is an aggregate, then joined back."""
    newest = runs.groupBy(F.col("name").alias("__name")).agg(
        F.max(F.struct("start_time", "run_id")).alias("last")
    )
    same = (runs["name"] == newest["__name"]) & (runs["run_id"] == newest["last"]["run_id"])
    return runs.join(newest, same, "left_semi")


def search_runs(runs: DataFrame, name_contains: str, metric: str) -> DataFrame:
    """``(run_id, name, start_time, metric)`` of runs whose name holds a text, newest first."""
    rows = runs.where(F.contains("name", F.lit(name_contains)) & (F.col("kind") == "metric") & (F.col("key") == metric))
    order = Window.partitionBy("name").orderBy(F.desc("start_time"), "run_id")
    return rows.select("run_id", "name", "start_time", F.col("value").try_cast("double").alias(metric),
                       F.row_number().over(order).alias("recency"))
