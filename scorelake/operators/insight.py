"""Feature and target relations (I)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorelake.functions import vocab
from scorelake.operators.aggregates import with_share
from scorelake.operators.profile import correlations, long_stats, numeric_columns, q


def target_correlations(df: DataFrame, target: str, columns: Sequence[str] | None = None,
                        top: int | None = None) -> DataFrame:
    """Pearson r of each feature with the target, strongest first."""
    names = list(columns or [c for c in numeric_columns(df) if c != target])
    rows = correlations(df, [(c, target) for c in names]).select(F.col("first").alias("feature"), F.col("r").alias("correlation"))
    ordered = rows.orderBy(F.desc_nulls_last(F.abs("correlation")), "feature")
    return ordered if top is None else ordered.limit(top)


def feature_groups(columns: Sequence[str], groups: Mapping[str, Sequence[str]] = vocab.INSIGHT_GROUPS) -> dict[str, list[str]]:
    """Names in each group: a name belongs to every group one of whose terms it contains."""
    return {g: [c for c in columns if any(t in c for t in terms)] for g, terms in groups.items()}


def group_importance(df: DataFrame, target: str, columns: Sequence[str] | None = None,
                     groups: Mapping[str, Sequence[str]] = vocab.INSIGHT_GROUPS) -> DataFrame:
    """Mean absolute correlation per feature group; undefined correlations do not count."""
    names = list(columns or [c for c in numeric_columns(df) if c != target])
    members = feature_groups(names, groups)
    tags = F.array_compact(F.array(*[F.when(F.col("feature").isin(m), F.lit(g)) for g, m in members.items() if m]))
    rows = target_correlations(df, target, names).select(F.explode(tags).alias("categoria"), "correlation")
    return rows.groupBy("categoria").agg(
        F.count(F.lit(1)).alias("features"), F.avg(F.abs("correlation")).alias("importancia_media")
    )


def side_rate(flag: Column, side: int, target: Column) -> Column:
    return F.avg(F.when(flag.cast("int") == side, target)) * 100


def flag_success_rates(df: DataFrame, flags: Sequence[str], target: str, missing: float | None = None) -> DataFrame:
    """Success % when a flag is 1 and when it is 0. ``missing`` fills a side with no rows."""
    def rate(side: int):
        def make(c: str) -> Column:
            r = side_rate(q(c), side, F.col(target))
            return r if missing is None else F.coalesce(r, F.lit(missing))
        return make

    return long_stats(df, flags, {"rate_when_1": rate(1), "rate_when_0": rate(0)}, "feature")


def attrition_rates(df: DataFrame, target: str, terms: Sequence[str] = vocab.ATTRITION_NAME_TERMS) -> DataFrame:
    names = [c for c in df.columns if any(t in c for t in terms)]
    return flag_success_rates(df, names, target, missing=0.0)


def lift(df: DataFrame, flags: Sequence[str], target: str) -> DataFrame:
    """Success rate when the flag is 1 over the overall rate; NULL on a zero base or a missing side."""
    def make(c: str) -> Column:
        ratio = F.try_divide(side_rate(q(c), 1, F.col(target)), F.avg(target) * 100)
        return F.when(side_rate(q(c), 0, F.col(target)).isNotNull(), ratio)

    return long_stats(df, flags, {"lift": make}, "feature")


def category_distribution(df: DataFrame, category: str) -> DataFrame:
    counts = df.where(F.col(category).isNotNull()).groupBy(category).agg(F.count(F.lit(1)).alias("n"))
    rows = df.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("pct", F.col("n") / rows * 100)


def top_k_per_category(df: DataFrame, category: str, value: str, k: int = 5) -> DataFrame:
    """Most frequent values in each category with their % of the category's rows.

    Only counts reach the window; the base of the % is every row of the category.
    """
    counts = df.groupBy(category, value).agg(F.count(F.lit(1)).alias("n"))
    shares = with_share(counts.where(F.col(category).isNotNull()), [category], share="pct").where(F.col(value).isNotNull())
    order = Window.partitionBy(category).orderBy(F.desc("n"), value)
    ranked = shares.withColumn("position", F.row_number().over(order)).where(F.col("position") <= k)
    return ranked.withColumn("pct", F.col("pct") * 100)
