"""Leakage detection (J)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.functions import vocab
from scorelake.operators.profile import (
    correlations, few_valued, numeric_columns, q, text_columns, value_counts,
)

FEW = 10


def _counts(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    rows = value_counts(df.where(F.col(target).isNotNull()), columns, [target])
    return rows.groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n"), F.min(target).alias("lo"), F.max(target).alias("hi")
    )


def few_valued_exact(df: DataFrame, columns: Sequence[str], few: int = FEW) -> list[str]:
    """Columns with fewer than ``few`` distinct non-NULL values."""
    maybe = few_valued(df, columns, few)
    if not maybe:
        return []
    counted = value_counts(df, maybe).distinct().groupBy("column").agg(F.count(F.lit(1)).alias("d")).collect()
    wide = {r["column"] for r in counted if r["d"] >= few}
    return [c for c in maybe if c not in wide]


def pure_categories(df: DataFrame, target: str, min_rows: int = 10, few: int = FEW,
                    narrow: Sequence[str] | None = None) -> DataFrame:
    """Categories whose rows all share one target value, over text or few-valued columns."""
    names = [c for c in df.columns if c != target]
    text = text_columns(df)
    small = few_valued_exact(df, [c for c in names if c not in text], few) if narrow is None else narrow
    used = [c for c in names if c in text or c in small]
    if not used:
        kind = df.schema[target].dataType.simpleString()
        return df.sparkSession.createDataFrame([], f"column string, category string, target {kind}, n bigint")
    pure = _counts(df, target, used).where((F.col("lo") == F.col("hi")) & (F.col("n") > min_rows))
    return pure.select("column", F.col("value").alias("category"), F.col("lo").alias("target"), "n")


def high_correlation(df: DataFrame, target: str, limit: float = 0.9, few: int = FEW,
                     narrow: Sequence[str] | None = None) -> DataFrame:
    """Numeric columns with at least ``few`` distinct values and abs(r) above the limit."""
    names = [c for c in numeric_columns(df) if c != target]
    small = few_valued_exact(df, names, few) if narrow is None else narrow
    wide = [c for c in names if c not in small]
    if not wide:
        return df.sparkSession.createDataFrame([], "column string, r double")
    rows = correlations(df, [(c, target) for c in wide])
    return rows.where(F.abs("r") > limit).select(F.col("first").alias("column"), "r")


def suspicious_names(columns: Sequence[str], target: str, flagged: Sequence[str] = (),
                     terms: Sequence[str] = vocab.LEAKY_NAME_TERMS) -> list[tuple[str, str]]:
    """(column, first term found) for names that hold a telling term and are not flagged yet."""
    hits = {}
    for term in terms:
        for c in columns:
            if term in c.lower() and c != target and c not in flagged:
                hits.setdefault(c, term)
    return list(hits.items())


def future_dates(columns: Sequence[str], terms: Sequence[str] = vocab.FUTURE_DATE_TERMS) -> list[str]:
    return [c for c in columns if "data" in c.lower() and any(t in c.lower() for t in terms)]


def leakage_report(df: DataFrame, target: str, limit: float = 0.9) -> DataFrame:
    """``(step, column, reason)``: every finding, repeats kept."""
    names = [c for c in df.columns if c != target]
    text = text_columns(df)
    small = few_valued_exact(df, [c for c in names if c not in text])
    pure = pure_categories(df, target, narrow=small).select(
        F.lit(1).alias("step"), "column",
        F.concat(F.lit("Categoria '"), "category", F.lit("' tem 100% de associação com target="),
                 F.col("target").cast("string")).alias("reason"),
    )
    strong = high_correlation(df, target, limit, narrow=small).select(
        F.lit(1).alias("step"), "column",
        F.concat(F.lit("Alta correlação com target: "), F.format_string("%.3f", "r")).alias("reason"),
    )
    found = pure.unionByName(strong)
    flagged = found.select("column").distinct()
    named = suspicious_names(df.columns, target)
    out = found
    if named:
        rows = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(t).alias("term")) for c, t in named])
        fresh = df.sparkSession.range(1).select(F.inline(rows)).join(flagged, "column", "left_anti")
        out = out.unionByName(fresh.select(
            F.lit(2).alias("step"), "column",
            F.concat(F.lit("Nome suspeito contendo '"), "term", F.lit("'")).alias("reason")))
    dates = future_dates(df.columns)
    if dates:
        rows = F.array(*[F.struct(F.lit(c).alias("column")) for c in dates])
        out = out.unionByName(df.sparkSession.range(1).select(F.inline(rows)).select(
            F.lit(3).alias("step"), "column", F.lit("Data possivelmente futura à decisão").alias("reason")))
    return out


def leaking_columns(report: DataFrame) -> DataFrame:
    return report.select("column").distinct()
