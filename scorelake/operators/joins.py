"""Joins (F): fact to dimensions, group statistics back to rows, aligned key sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.sizing import join_lookup


def left_join(
    df: DataFrame, other: DataFrame, key: str, suffixes: tuple[str, str] = ("_x", "_y"), null_safe: bool = True
) -> DataFrame:
    """Left equi join where a NULL key matches a NULL key; clashing names get suffixes.

    The right side is broadcast only when it is measured to be small.
    """
    clash = [c for c in other.columns if c in df.columns and c != key]
    left = df.withColumnsRenamed({c: c + suffixes[0] for c in clash})
    right = other.withColumnsRenamed({c: c + suffixes[1] for c in clash} | {key: "__key"})

    def on(a: DataFrame, b: DataFrame) -> Column:
        return a[key].eqNullSafe(b["__key"]) if null_safe else a[key] == b["__key"]

    return join_lookup(left, right, on).drop("__key")


def join_jobs(df: DataFrame, jobs: DataFrame | None) -> DataFrame:
    return df if jobs is None else left_join(df, jobs, "job_id")


def join_applicants(df: DataFrame, applicants: DataFrame | None) -> DataFrame:
    if applicants is None or "applicant_id" not in df.columns or "applicant_id" not in applicants.columns:
        return df
    return left_join(df, applicants, "applicant_id")


def attach_group_stats(
    df: DataFrame, key: str, stats: Mapping[str, Column], source: DataFrame | None = None
) -> DataFrame:
    """Aggregate by ``key`` and join back; NULL keys form no group and get NULL.

    ``source`` fits the statistics on other rows, for instance the training split only.
    """
    base = df if source is None else source
    groups = base.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key")).agg(
        *[c.alias(n) for n, c in stats.items()]
    )
    return join_lookup(df, groups, lambda a, b: a[key] == b["__key"]).drop("__key")


def attach_target(features: DataFrame, target: DataFrame, row_id: str = "row_id") -> DataFrame:
    return features.join(target, row_id, "left")


def align_distributions(
    first: DataFrame, second: DataFrame, keys: Sequence[str], value: str, names: tuple[str, str] = ("p", "q")
) -> DataFrame:
    """Union of the keys of two distributions, a missing side as 0."""
    a = first.select(*keys, F.col(value).alias(names[0]))
    b = second.select(*keys, F.col(value).alias(names[1]))
    joined = a.join(b, list(keys), "full_outer")
    return joined.select(*keys, *[F.coalesce(F.col(n), F.lit(0.0)).alias(n) for n in names])


def compare_metrics(current: DataFrame, baseline: DataFrame, name: str = "metric", value: str = "value") -> DataFrame:
    """Current minus baseline over the union of metric names."""
    both = align_distributions(current, baseline, [name], value, ("current", "baseline"))
    return both.withColumn("delta", F.col("current") - F.col("baseline"))
