"""Grouped statistics and rollups (G)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.operators.joins import attach_group_stats


def group_success_rate(df: DataFrame, key: str = "recrutador", target: str = "target_sucesso") -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.avg(target).alias("taxa_sucesso_recrutador"), F.count(target).alias("total_candidatos_recrutador")
    )


def above_mean_flag(df: DataFrame, value: str, out: str, source: DataFrame | None = None) -> DataFrame:
    """1 when the value exceeds the mean over rows. The mean is a scalar subquery."""
    mean = (df if source is None else source).agg(F.avg(value)).scalar()
    return df.withColumn(out, F.coalesce(F.col(value) > mean, F.lit(False)).cast("int"))


def category_stats(df: DataFrame, key: str, target: str, days: str | None = None) -> DataFrame:
    """Popularity, success rate and mean duration per category, in one pass."""
    stats = {"popularidade": F.count(F.lit(1)), "taxa_sucesso": F.avg(target)}
    if days is not None:
        stats["tempo_medio"] = F.avg(days)
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*[c.alias(n) for n, c in stats.items()])


def group_flag_rate(df: DataFrame, key: str, flag: str, out: str) -> DataFrame:
    return attach_group_stats(df, key, {out: F.avg(F.col(flag).cast("int"))})


def value_distribution(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., value, n, share)`` over non-NULL values; shares add to 1 within ``by``."""
    counts = df.where(F.col(column).isNotNull()).groupBy(*by, F.col(column).alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return with_share(counts, by)


def with_share(counts: DataFrame, by: Sequence[str] = (), n: str = "n", share: str = "share") -> DataFrame:
    """Share of each count in its group. Totals are re-aggregated, so no group meets in one task."""
    if not by:
        total = counts.agg(F.sum(n)).scalar()
        return counts.withColumn(share, F.col(n) / total)
    totals = counts.groupBy(*by).agg(F.sum(n).alias("__total"))
    return counts.join(totals, list(by)).withColumn(share, F.col(n) / F.col("__total")).drop("__total")


def rollup_stats(prediction: str = "prediction", probability: str = "prediction_probability") -> list[Column]:
    return [
        F.count(prediction).alias("quantidade"),
        (F.avg(prediction) * 100).alias("taxa_aprovacao"),
        (F.avg(probability) * 100).alias("prob_media"),
    ]


def segment_rollup(log: DataFrame, segment: str = "segment") -> DataFrame:
    rows = log.where(F.col(segment).isNotNull()).groupBy(segment).agg(*rollup_stats())
    return rows.orderBy(F.desc("quantidade"), segment)


def daily_rollup(log: DataFrame, ts: str = "timestamp") -> DataFrame:
    return log.where(F.col(ts).isNotNull()).groupBy(F.to_date(ts).alias("date")).agg(*rollup_stats())


def prediction_summary(log: DataFrame) -> DataFrame:
    """One row: count, period, class shares in % and mean probability."""
    return log.agg(
        F.count(F.lit(1)).alias("count"),
        F.min("timestamp").alias("start"),
        F.max("timestamp").alias("end"),
        (F.avg((F.col("prediction") == 1).cast("int")) * 100).alias("positive_rate"),
        (F.avg((F.col("prediction") == 0).cast("int")) * 100).alias("negative_rate"),
        F.avg("prediction_probability").alias("average_probability"),
    )


def segment_counts(log: DataFrame, segment: str = "segment") -> DataFrame:
    """Rows per segment: the second half of the prediction summary."""
    return log.where(F.col(segment).isNotNull()).groupBy(segment).agg(F.count(F.lit(1)).alias("n"))


def approval_kpis(log: DataFrame) -> DataFrame:
    return log.agg(
        F.count(F.lit(1)).alias("total"),
        (F.avg((F.col("prediction") == 1).cast("int")) * 100).alias("taxa_aprovacao"),
        (F.avg("prediction_probability") * 100).alias("prob_media"),
    )


def outcome_counts(log: DataFrame) -> DataFrame:
    label = F.when(F.col("prediction") == 1, F.lit("Aprovado")).otherwise(F.lit("Reprovado"))
    return log.where(F.col("prediction").isNotNull()).groupBy(label.alias("resultado")).agg(
        F.count(F.lit(1)).alias("n")
    )


def zero_variance_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """Columns with at most one distinct non-NULL value: minimum equals maximum, one pass, no shuffle."""
    names = list(columns or df.columns)
    row = df.agg(*[
        F.coalesce(F.min(f"`{c}`") == F.max(f"`{c}`"), F.lit(True)).alias(f"z{i}") for i, c in enumerate(names)
    ]).first()
    return [c for i, c in enumerate(names) if row[f"z{i}"]]


def zero_variance_table(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    names = list(columns or df.columns)
    one = df.agg(*[
        F.coalesce(F.min(f"`{c}`") == F.max(f"`{c}`"), F.lit(True)).alias(c) for c in names
    ])
    return one.unpivot([], names, "column", "zero_variance")


def service_rollup(requests: DataFrame, error: Column, latency_seconds: Column) -> DataFrame:
    """Request count, error share in % and mean latency in ms."""
    return requests.agg(
        F.count(F.lit(1)).alias("request_count"),
        F.coalesce(F.avg(error.cast("int")) * 100, F.lit(0.0)).alias("error_rate"),
        F.coalesce(F.avg(latency_seconds) * 1000, F.lit(0.0)).alias("average_latency"),
    )
