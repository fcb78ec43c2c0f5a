"""Streaming log, rollup, drift, alerts and request limit.

Each job takes a streaming DataFrame and returns a ``DataStreamWriter`` or a streaming DataFrame; the
caller names the checkpoint folder, which must be shared storage on a cluster.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

from scorelake.functions import vocab
from scorelake.operators.aggregates import rollup_stats
from scorelake.operators.drift import FeatureStats
from scorelake.operators.monitor import drift_alerts, metric_drop_alerts, role_limit
from scorelake.plans.drift import check_drift
from scorelake.sources.readers import read_optional
from scorelake.sources.writers import append_alerts, append_drift_report
from scorelake.worker import WindowLimit

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def read_log_stream(spark, path: str, schema, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def event_time(df: DataFrame, ts: str = "timestamp", delay: str = "1 day") -> DataFrame:
    """Event time as TIMESTAMP (a watermark takes no other type) with its watermark."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def stream_prediction_log(stream: DataFrame, path: str, checkpoint: str, key: str = "candidate_id",
                          delay: str = "1 day") -> DataStreamWriter:
    """Append each prediction once: repeats of an id within the watermark are dropped."""
    rows = event_time(stream, delay=delay).dropDuplicatesWithinWatermark([key])
    dated = rows.withColumn("event_date", F.to_date("timestamp")).withColumn(
        "timestamp", F.col("timestamp").cast("timestamp_ntz"))
    return dated.writeStream.outputMode("append").format("parquet").partitionBy("event_date").option(
        "path", path).option("checkpointLocation", checkpoint)


def stream_daily_rollup(stream: DataFrame, delay: str = "1 day", segment: str = "segment") -> DataFrame:
    """Rollup per day and segment. Use update or complete mode to see the still open days."""
    timed = event_time(stream, delay=delay)
    rows = timed.groupBy(F.window("timestamp", "1 day").alias("w"), segment).agg(*rollup_stats())
    return rows.select(F.to_date("w.start").alias("date"), segment, "quantidade", "taxa_aprovacao", "prob_media")


def stream_recent_drift(stream: DataFrame, log_path: str, training: FeatureStats, report_root: str, alert_path: str,
                        checkpoint: str, days: int = 30, alert_limit: float = vocab.DRIFT_ALERT_LIMIT) -> DataStreamWriter:
    """Per trigger: add the batch to the log, then re-evaluate drift over the trailing period.

    A replayed batch overwrites its own folder, so retries do not double rows.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.withColumn("event_date", F.to_date("timestamp")).write.mode("overwrite").partitionBy("event_date").parquet(
            f"{log_path}/batch={batch_id}")
        log = spark.read.parquet(log_path).drop("batch")
        _, report = check_drift(log, training, days)
        report = report.withColumn("batch_id", F.lit(batch_id)).persist()
        try:
            if report.first() is not None:
                append_drift_report(report, f"{report_root}/batch={batch_id}", "overwrite")
                append_alerts(drift_alerts(report, alert_limit), f"{alert_path}/batch={batch_id}", "overwrite")
        finally:
            report.unpersist()

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)


def stream_alerts(metrics: DataFrame, history_path: str, alert_path: str, checkpoint: str,
                  limit: float = vocab.ACCURACY_DROP_LIMIT) -> DataStreamWriter:
    """Per trigger: add metric rows to the history and write the alerts their entries raise."""
    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        start = batch.agg(F.min("timestamp")).first()[0]
        if start is None:
            return
        batch.write.mode("overwrite").parquet(f"{history_path}/batch={batch_id}")
        history = read_optional(spark, history_path, kind="parquet").drop("batch")
        before = history.where(F.col("timestamp") < F.lit(start)).agg(F.max("timestamp")).first()[0]
        span = history.where(F.col("timestamp") >= F.lit(before or start))
        metric_drop_alerts(span, limit).write.mode("overwrite").parquet(f"{alert_path}/batch={batch_id}")

    return metrics.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)


def stream_fixed_window_limit(stream: DataFrame, key: str, ts: str, order: str, role: Column | None = None,
                              limits: Mapping[str, int] = vocab.ROLE_LIMITS,
                              window_seconds: int = vocab.LIMIT_WINDOW_SECONDS) -> DataFrame:
    """Request limit with keyed state; rows of a trigger are taken in event-time order per key."""
    limit = role_limit(role if role is not None else F.lit(""), limits)
    rows = stream.select(
        F.col(key).alias("key"), F.col(order).alias("id"), F.unix_micros(F.col(ts).cast("timestamp")).alias("t"),
        limit.cast("bigint").alias("limit"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    out = (f"key {kinds['key']}, id {kinds['id']}, t bigint, window_start bigint, position bigint, allowed boolean")
    return rows.groupBy("key").transformWithStateInPandas(
        statefulProcessor=WindowLimit(window_seconds * 1_000_000), outputStructType=out, outputMode="append",
        timeMode="none")
