"""Writing tables (A5-A10, A12). Appends add files; nothing is rewritten."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.functions import vocab
from scorelake.operators.drift import CATEGORICAL_SCHEMA, NUMERIC_SCHEMA, FeatureStats
from scorelake.sources.readers import read_optional


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: str | None = None) -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def write_features(features: DataFrame, full: DataFrame, root: str, target: str, row_id: str = "row_id") -> None:
    """Features, target and the whole processed table; ``row_id`` ties them together."""
    write_table(features.drop(target), f"{root}/features")
    write_table(full.select(row_id, target), f"{root}/target")
    write_table(full, f"{root}/complete")


def write_splits(parts: DataFrame, path: str, split: str = "split") -> None:
    write_table(parts, path, partition_by=split)


def write_insights(correlations: DataFrame, importance: DataFrame, root: str) -> None:
    write_table(correlations, f"{root}/feature_correlations")
    write_table(importance, f"{root}/category_importance")


def prediction_rows(df: DataFrame, ts: Column, candidate_id: Column, prediction: Column, probability: Column,
                    features: Column, segment: Column) -> DataFrame:
    """Rows of the prediction log. ``features`` is a struct or map and is stored as JSON text."""
    return df.select(
        ts.alias("timestamp"), candidate_id.cast("string").alias("candidate_id"), prediction.cast("int").alias("prediction"),
        probability.alias("prediction_probability"), F.to_json(features, {"ignoreNullFields": "false"}).alias("features"),
        F.coalesce(F.nullif(segment, F.lit("")), F.lit(vocab.SEGMENT_DEFAULT)).alias("segment"),
    )


def append_predictions(rows: DataFrame, path: str) -> None:
    """Append to the log, one folder per day so recent reads skip old days."""
    write_table(rows.withColumn("event_date", F.to_date("timestamp")), path, "append", "event_date")


def metric_rows(spark, metrics: dict[str, float], timestamp: dt.datetime) -> DataFrame:
    data = [(timestamp, k, float(v)) for k, v in metrics.items()]
    return spark.createDataFrame(data, "timestamp timestamp_ntz, metric string, value double")


def append_metrics(rows: DataFrame, path: str) -> None:
    write_table(rows.select("timestamp", "metric", "value"), path, "append")


def set_baseline(rows: DataFrame, path: str) -> None:
    """Store ``(metric, value)`` rows as the baseline, in place of the one before."""
    write_table(rows.select("metric", "value"), path)


def save_training_stats(stats: FeatureStats, root: str) -> None:
    spark = stats.numeric.sparkSession
    write_table(stats.numeric, f"{root}/numeric")
    write_table(stats.categorical, f"{root}/categorical")
    meta = spark.createDataFrame([(stats.timestamp, stats.n_samples)], "timestamp timestamp_ntz, n_samples bigint")
    write_table(meta, f"{root}/meta")


def load_training_stats(spark, root: str) -> FeatureStats:
    """Stored statistics; empty when nothing is stored."""
    meta = read_optional(spark, f"{root}/meta", kind="parquet")
    if meta is None:
        return FeatureStats(
            spark.createDataFrame([], NUMERIC_SCHEMA), spark.createDataFrame([], CATEGORICAL_SCHEMA), 0, None)
    row = meta.first()
    return FeatureStats(
        spark.read.parquet(f"{root}/numeric"), spark.read.parquet(f"{root}/categorical"), row["n_samples"], row["timestamp"])


def append_drift_report(report: DataFrame, root: str, mode: str = "append") -> None:
    """Append the report and its history line ``(timestamp, overall_drift)``; a stream's batch folder is overwritten instead."""
    write_table(report, f"{root}/reports", mode)
    write_table(report.select("timestamp", F.col("drift_score").alias("overall_drift")), f"{root}/history", mode)


def append_alerts(alerts: DataFrame, path: str, mode: str = "append") -> None:
    write_table(alerts, path, mode)
