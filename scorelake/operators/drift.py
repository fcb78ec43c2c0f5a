"""Training statistics and drift."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorelake.functions import vocab
from scorelake.operators.aggregates import with_share
from scorelake.operators.joins import align_distributions
from scorelake.operators.profile import clean_number, long_stats, q, value_counts
from scorelake.operators.quantiles import exact_quantiles


def latest_time(log: DataFrame, ts: str, event_date: str = "event_date") -> dt.datetime | None:
    """Newest time; on a log kept by day only the last day is read for it."""
    if event_date in log.columns:
        last = log.agg(F.max(event_date)).first()[0]
        log = log.where(F.col(event_date) == F.lit(last))
    return log.agg(F.max(ts).cast("timestamp_ntz")).first()[0]


def recent(log: DataFrame, days: int = 30, as_of: dt.datetime | None = None, ts: str = "timestamp",
           event_date: str = "event_date") -> DataFrame:
    """Rows of the last ``days`` before ``as_of`` (default: the newest row).

    The limit is a literal, so it reaches the scan, and it prunes ``event_date`` partitions if present.
    """
    end = as_of or latest_time(log, ts, event_date)
    if end is None:
        return log
    start = end - dt.timedelta(days=days)
    rows = log.where(F.col(ts) >= F.lit(start).cast("timestamp_ntz"))
    return rows.where(F.col(event_date) >= F.lit(start.date())) if event_date in log.columns else rows


def features_map(features: Column) -> Column:
    """JSON text to a map of strings; bad JSON is an empty map."""
    empty = F.create_map().cast("map<string,string>")
    return F.coalesce(F.from_json(features, T.MapType(T.StringType(), T.StringType())), empty)


def parse_features(log: DataFrame, numeric: Sequence[str] = (), categorical: Sequence[str] = (),
                   features: str = "features") -> DataFrame:
    """Typed feature columns from the JSON column, which is parsed once per row."""
    parsed = log.withColumn("features_dict", features_map(F.col(features)))
    value = lambda name: F.try_element_at("features_dict", F.lit(name))
    out = {c: value(c).try_cast("double") for c in numeric} | {c: value(c) for c in categorical}
    return parsed.withColumns(out)


def is_number(kind: T.DataType) -> bool:
    return isinstance(kind, (T.NumericType, T.BooleanType))


def as_number(c: str, kind: T.DataType) -> Column:
    return q(c).cast("int").cast("double") if isinstance(kind, T.BooleanType) else clean_number(q(c))


@dataclass(frozen=True)
class FeatureStats:
    """Statistics of a table: one row per numeric feature, one per (categorical feature, value)."""

    numeric: DataFrame
    categorical: DataFrame
    n_samples: int
    timestamp: dt.datetime | None

    @property
    def features(self) -> DataFrame:
        return self.numeric.select("feature").unionByName(self.categorical.select("feature").distinct())

    @property
    def categorical_summary(self) -> DataFrame:
        return self.categorical.groupBy("feature").agg(
            F.count(F.lit(1)).alias("n_unique"),
            F.min(F.struct((-F.col("n")).alias("m"), "value"))["value"].alias("most_common"),
        )


NUMERIC_SCHEMA = ("feature string, n bigint, mean double, median double, std double, min double, max double, "
                  "q1 double, q3 double")
CATEGORICAL_SCHEMA = "feature string, value string, n bigint, share double"


def numeric_stats(df: DataFrame, features: Sequence[str], quartiles: bool = True) -> DataFrame:
    """All numeric features in one pass (plus the exact quartiles); features without data are left out."""
    if not features:
        return df.sparkSession.createDataFrame([], NUMERIC_SCHEMA)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    data = df.select([as_number(c, kinds[c]).alias(c) for c in features])
    stats = {
        "n": lambda c: F.count(q(c)),
        "mean": lambda c: F.avg(q(c)),
        "std": lambda c: F.coalesce(F.stddev_samp(q(c)), F.lit(0.0)),
        "min": lambda c: F.min(q(c)),
        "max": lambda c: F.max(q(c)),
    }
    if quartiles:
        cuts = exact_quantiles(data, features, [0.25, 0.5, 0.75])
        for i, name in enumerate(("q1", "median", "q3")):
            stats[name] = lambda c, i=i: F.max(F.lit(cuts[c][i]).cast("double"))
    return long_stats(data, features, stats, "feature").where(F.col("n") > 0)


def distributions(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(feature, value, n, share)`` of all categorical features from one pass."""
    if not features:
        return df.sparkSession.createDataFrame([], CATEGORICAL_SCHEMA)
    counts = value_counts(df, features).groupBy(F.col("column").alias("feature"), "value").agg(
        F.count(F.lit(1)).alias("n"))
    return with_share(counts, ["feature"])


def feature_stats(df: DataFrame, features: Sequence[str], timestamp: dt.datetime | None = None,
                  quartiles: bool = True) -> FeatureStats:
    kinds = {f.name: f.dataType for f in df.schema.fields}
    have = [c for c in features if c in kinds]
    numeric = [c for c in have if is_number(kinds[c])]
    return FeatureStats(
        numeric_stats(df, numeric, quartiles), distributions(df, [c for c in have if c not in numeric]),
        df.count(), timestamp,
    )


def numeric_drift(training: DataFrame, current: DataFrame, limit: float = vocab.DRIFT_STD_LIMIT) -> DataFrame:
    """Mean shift in training deviations; a constant training feature never drifts."""
    now = current.select("feature", F.col("mean").alias("current_mean"), F.col("std").alias("current_std"))
    both = training.select("feature", F.col("mean").alias("train_mean"), F.col("std").alias("train_std")).join(now, "feature")
    spread = F.col("train_std") > 0
    shift = F.when(spread, F.abs(F.col("train_mean") - F.col("current_mean")) / F.col("train_std"))
    out = both.withColumns({"score": shift, "drift_limit": F.when(spread, F.lit(limit))})
    return out.withColumn("drift_detected", F.coalesce(F.col("score") > limit, F.lit(False)))


def js_divergence(pairs: DataFrame, by: str = "feature", p: str = "p", q: str = "q",
                  epsilon: float = vocab.JS_EPSILON) -> DataFrame:
    """``(by, js)``: Jensen-Shannon divergence in nats between two aligned distributions, capped at 1.

    Weights need not add to 1. Zeros become epsilon and both sides are rescaled before the logs.
    """
    mass = pairs.groupBy(by).agg(F.sum(p).alias("__p"), F.sum(q).alias("__q"))

    def clip(c: str, total: str) -> Column:
        share = F.coalesce(F.try_divide(F.col(c), F.col(total)), F.lit(0.0))
        return F.least(F.lit(1.0), F.greatest(F.lit(epsilon), share))

    first = pairs.join(mass, by).select(by, clip(p, "__p").alias("__a"), clip(q, "__q").alias("__b"))
    rescale = first.groupBy(by).agg(F.sum("__a").alias("__sa"), F.sum("__b").alias("__sb"))
    unit = first.join(rescale, by).select(by, (F.col("__a") / F.col("__sa")).alias("a"), (F.col("__b") / F.col("__sb")).alias("b"))
    mid = (F.col("a") + F.col("b")) / 2
    part = F.col("a") * F.log(F.col("a") / mid) + F.col("b") * F.log(F.col("b") / mid)
    return unit.groupBy(by).agg(F.least(F.lit(1.0), F.sum(part) / 2).alias("js"))


def new_categories(training: DataFrame, current: DataFrame) -> DataFrame:
    """``(feature, value)`` seen now and not in training, compared as text."""
    return current.select("feature", "value").join(training.select("feature", "value"), ["feature", "value"], "left_anti")


def categorical_drift(training: DataFrame, current: DataFrame, limit: float = vocab.DRIFT_JS_LIMIT) -> DataFrame:
    """Divergence, category counts and number of new categories per feature present on both sides."""
    pairs = align_distributions(training, current, ["feature", "value"], "share")
    counts = pairs.groupBy("feature").agg(
        F.count_if(F.col("p") > 0).alias("n_categories_train"),
        F.count_if(F.col("q") > 0).alias("n_categories_current"),
        F.count_if((F.col("q") > 0) & (F.col("p") == 0)).alias("n_new_categories"),
    ).where((F.col("n_categories_train") > 0) & (F.col("n_categories_current") > 0))
    found = counts.join(js_divergence(pairs), "feature")
    return found.withColumns({
        "score": F.col("js"), "drift_limit": F.lit(limit), "drift_detected": F.col("js") > limit,
    }).drop("js")


def feature_drift(training: FeatureStats, current: FeatureStats, std_limit: float = vocab.DRIFT_STD_LIMIT,
                  js_limit: float = vocab.DRIFT_JS_LIMIT) -> DataFrame:
    """One row per feature present on both sides; columns of the other type are NULL."""
    numbers = numeric_drift(training.numeric, current.numeric, std_limit).withColumn("type", F.lit("numeric"))
    groups = categorical_drift(training.categorical, current.categorical, js_limit).withColumn("type", F.lit("categorical"))
    return numbers.unionByName(groups, allowMissingColumns=True)


def drift_report(drift: DataFrame, n_features: int, n_samples: int, timestamp: dt.datetime | None = None,
                 limit: float = vocab.DRIFT_REPORT_LIMIT) -> DataFrame:
    """One report row. The score divides by every training feature, analysed or not."""
    names = F.array_compact(F.sort_array(F.collect_list(F.when(F.col("drift_detected"), F.col("feature")))))
    one = drift.agg(F.count_if(F.col("drift_detected")).alias("drifted"), names.alias("features_with_drift"))
    empty = F.lit(n_features == 0 or n_samples == 0)
    score = F.coalesce(F.try_divide(F.col("drifted"), F.lit(n_features)), F.lit(0.0))
    return one.select(
        F.lit(timestamp).cast("timestamp_ntz").alias("timestamp"),
        F.when(empty, F.lit("error")).otherwise(F.lit("ok")).alias("status"),
        F.when(empty, F.lit("Dados insuficientes para análise de drift")).alias("message"),
        F.when(~empty, score).alias("drift_score"),
        (~empty & (score > limit)).alias("drift_detected"),
        F.lit(n_samples).cast("bigint").alias("n_samples_analyzed"),
        F.lit(n_features).cast("bigint").alias("features_analyzed"),
        "features_with_drift",
    )


def latest_report(reports: DataFrame) -> DataFrame:
    """The newest report row."""
    fields = F.struct(*[F.col(c) for c in reports.columns])
    return reports.agg(F.max_by(fields, "timestamp").alias("r")).where(F.col("r").isNotNull()).select("r.*")


def drift_histogram(rows: DataFrame, feature: str, training: DataFrame, bins: int = 20) -> DataFrame:
    """Counts per equal-width bin of recent values, with the training mean and one deviation each side."""
    value = clean_number(q(feature))
    ends = rows.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).first()
    lo, hi = ends["lo"], ends["hi"]
    if lo is None:
        return rows.sparkSession.createDataFrame([], (
            "bin bigint, bin_low double, bin_high double, n bigint, train_mean double, minus_std double, plus_std double"))
    width = (hi - lo) / bins or 1.0
    bucket = F.least(F.lit(bins), F.width_bucket(value, F.lit(lo), F.lit(lo + width * bins), F.lit(bins))).cast("bigint")
    counts = rows.where(value.isNotNull()).groupBy(bucket.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    line = training.where(F.col("feature") == feature).select(
        F.col("mean").alias("train_mean"), (F.col("mean") - F.col("std")).alias("minus_std"),
        (F.col("mean") + F.col("std")).alias("plus_std"))
    lines = line.agg(F.first(F.struct("*"))).scalar()
    return counts.select(
        "bin", (F.lit(lo) + (F.col("bin") - 1) * width).alias("bin_low"), (F.lit(lo) + F.col("bin") * width).alias("bin_high"),
        "n", lines["train_mean"].alias("train_mean"), lines["minus_std"].alias("minus_std"), lines["plus_std"].alias("plus_std"),
    )


def drift_category_table(training: DataFrame, current: DataFrame, feature: str) -> DataFrame:
    """``(categoria, fonte, distribuicao)``: training and production share of each category."""
    one = F.col("feature") == feature
    pairs = align_distributions(training.where(one), current.where(one), ["value"], "share")
    return pairs.select(F.col("value").alias("categoria"), F.inline(F.array(
        F.struct(F.lit("Treinamento").alias("fonte"), F.col("p").alias("distribuicao")),
        F.struct(F.lit("Produção").alias("fonte"), F.col("q").alias("distribuicao")),
    )))


def drift_band(score: Column) -> Column:
    return (
        F.when(score < vocab.DRIFT_WATCH_LIMIT, F.lit("stable"))
        .when(score <= vocab.DRIFT_ALERT_LIMIT, F.lit("watch"))
        .otherwise(F.lit("significant"))
    )
