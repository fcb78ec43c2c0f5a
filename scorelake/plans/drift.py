"""Drift check of a prediction log against training statistics."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from scorelake.functions import vocab
from scorelake.operators.drift import (
    FeatureStats, drift_report, feature_drift, feature_stats, latest_report, latest_time, parse_features, recent,
)
from scorelake.sources.readers import read_optional
from scorelake.sources.writers import append_drift_report


def check_drift(log: DataFrame, training: FeatureStats, days: int = 30, as_of: dt.datetime | None = None,
                features: str | None = "features", js_limit: float = vocab.DRIFT_JS_LIMIT) -> tuple[DataFrame, DataFrame]:
    """(one row per feature, one report row) for the last ``days`` of the log.

    With ``features`` the values come from that JSON column, typed as in training; else from columns.
    """
    end = as_of or latest_time(log, "timestamp")
    rows = recent(log, days, end)
    numeric = _names(training.numeric)
    categorical = _names(training.categorical)
    if features is not None:
        rows = parse_features(rows, numeric, categorical, features)
    now = feature_stats(rows, [*numeric, *categorical], end, quartiles=False)
    drift = feature_drift(training, now, js_limit=js_limit)
    return drift, drift_report(drift, len(numeric) + len(categorical), now.n_samples, end)


def latest_or_check(spark: SparkSession, root: str, log: DataFrame, training: FeatureStats, **options) -> DataFrame:
    """The newest stored report, or a new one, which is then stored, when there is none."""
    stored = read_optional(spark, f"{root}/reports", kind="parquet")
    if stored is None:
        _, report = check_drift(log, training, **options)
        append_drift_report(report, root)
        stored = spark.read.parquet(f"{root}/reports")
    return latest_report(stored)


def _names(stats: DataFrame) -> Sequence[str]:
    """Feature names, one per modelled column."""
    return sorted(r[0] for r in stats.select("feature").distinct().collect())
