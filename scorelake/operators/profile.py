"""Data-quality profile (H). Per-column statistics share one aggregate wherever one pass can do."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorelake.operators.aggregates import with_share
from scorelake.operators.quantiles import clean_number, exact_quantiles

PAIRS_PER_PASS = 300


def q(name: str) -> Column:
    return F.col(f"`{name}`")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def long_stats(df: DataFrame, columns: Sequence[str], stats: dict, key: str = "column") -> DataFrame:
    """``stats`` maps a result name to a function of a column name; all run in one aggregate."""
    packed = df.agg(*[
        F.struct(F.lit(c).alias(key), *[make(c).alias(n) for n, make in stats.items()]).alias(f"s{i}")
        for i, c in enumerate(columns)
    ])
    return packed.select(F.inline(F.array(*[f"s{i}" for i in range(len(columns))])))


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return long_stats(df, list(columns or df.columns), {
        "missing": lambda c: F.count_if(q(c).isNull()),
        "missing_pct": lambda c: F.avg(q(c).isNull().cast("int")) * 100,
    })


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each distinct row, NULL equal to NULL."""
    groups = df.groupBy(*[q(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("__n"))
    return groups.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicates"))


def iqr_outliers(df: DataFrame, columns: Sequence[str] | None = None, factor: float = 1.5) -> DataFrame:
    """Count and share of values strictly outside Q1 - factor*IQR .. Q3 + factor*IQR."""
    names = list(columns or numeric_columns(df))
    quartiles = exact_quantiles(df, names, [0.25, 0.75])
    names = [c for c in names if quartiles[c][0] is not None]

    def outside(c: str) -> Column:
        q1, q3 = quartiles[c]
        low, high = q1 - factor * (q3 - q1), q3 + factor * (q3 - q1)
        return F.coalesce(~clean_number(q(c)).between(low, high), F.lit(False))

    return long_stats(df, names, {
        "outliers": lambda c: F.count_if(outside(c)),
        "outlier_pct": lambda c: F.avg(outside(c).cast("int")) * 100,
    })


def class_balance(df: DataFrame, target: str, warn_ratio: float = 10.0) -> DataFrame:
    """Count and % per class, with the max/min ratio and a warning flag on every row."""
    counts = df.where(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    whole = counts.agg(F.struct(F.sum("n").alias("t"), (F.max("n") / F.min("n")).alias("r"))).scalar()
    return counts.select(
        target, "n", (F.col("n") / whole["t"] * 100).alias("pct"), whole["r"].alias("ratio"),
        (whole["r"] > warn_ratio).alias("extreme"),
    )


def flag_rate(df: DataFrame, flag: str) -> DataFrame:
    return df.agg((F.avg(F.col(flag).cast("double")) * 100).alias("rate"))


def few_valued(df: DataFrame, columns: Sequence[str], limit: int) -> list[str]:
    """Columns that may have at most ``limit`` distinct values; a wide sketch margin, never a miss."""
    row = df.agg(*[F.approx_count_distinct(q(c)).alias(f"d{i}") for i, c in enumerate(columns)]).first()
    return [c for i, c in enumerate(columns) if row[f"d{i}"] <= 10 * limit + 50]


def value_counts(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Non-NULL values of many columns as rows ``(column, value, keep...)``, ready to aggregate."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), q(c).cast("string").alias("value")) for c in columns])
    long = df.select(*[q(k) for k in keep], F.inline(pairs))
    return long.where(F.col("value").isNotNull())


def low_variance(df: DataFrame, columns: Sequence[str] | None = None, distinct: int = 5,
                 share: float = 0.95, top: int = 5) -> DataFrame:
    """Columns with at most ``distinct`` values where one holds more than ``share`` of them."""
    names = few_valued(df, list(columns or df.columns), distinct)
    if not names:
        return df.sparkSession.createDataFrame([], "column string, top_pct double")
    counts = value_counts(df, names).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    per = counts.groupBy("column").agg(
        F.count(F.lit(1)).alias("values"), (F.max("n") / F.sum("n")).alias("top_share")
    )
    hit = (F.col("values") <= distinct) & (F.col("top_share") > share)
    return per.where(hit).select("column", (F.col("top_share") * 100).alias("top_pct")).orderBy(
        F.desc("top_pct"), "column").limit(top)


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    names = list(columns or numeric_columns(df))
    quarts = exact_quantiles(df, names, [0.25, 0.5, 0.75])
    stats = {
        "count": lambda c: F.count(clean_number(q(c))),
        "mean": lambda c: F.avg(clean_number(q(c))),
        "std": lambda c: F.stddev_samp(clean_number(q(c))),
        "min": lambda c: F.min(clean_number(q(c))),
    }
    for i, name in enumerate(("q1", "median", "q3")):
        stats[name] = lambda c, i=i: F.max(F.lit(quarts[c][i]).cast("double"))
    stats["max"] = lambda c: F.max(clean_number(q(c)))
    return long_stats(df, names, stats)


def describe_categorical(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, unique, top and freq per column; the smallest value wins a tie."""
    names = list(columns or text_columns(df))
    counts = value_counts(df, names).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("column").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.min(F.struct((-F.col("n")).alias("m"), "value"))["value"].alias("top"),
        F.max("n").alias("freq"),
    )


def pearson(a: Column, b: Column) -> Column:
    """Correlation over complete pairs; NULL when undefined."""
    both_a, both_b = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    spread = F.stddev_pop(both_a) * F.stddev_pop(both_b)
    return F.try_divide(F.covar_pop(a, b), spread)


def correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """``(first, second, r)`` for the named pairs, a few hundred per pass."""
    out = None
    for start in range(0, len(pairs), PAIRS_PER_PASS):
        part = pairs[start:start + PAIRS_PER_PASS]
        one = df.agg(*[
            F.struct(F.lit(a).alias("first"), F.lit(b).alias("second"),
                     pearson(clean_number(q(a)), clean_number(q(b))).alias("r")).alias(f"s{i}")
            for i, (a, b) in enumerate(part)
        ])
        rows = one.select(F.inline(F.array(*[f"s{i}" for i in range(len(part))])))
        out = rows if out is None else out.unionByName(rows)
    return out


def upper_pairs(columns: Sequence[str]) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """All ordered pairs. Half is computed, the other half mirrored."""
    names = list(columns or numeric_columns(df))
    pairs = upper_pairs(names) + [(c, c) for c in names]
    half = correlations(df, pairs)
    both = F.when(F.col("first") == F.col("second"), F.array(F.struct("first", "second", "r"))).otherwise(
        F.array(F.struct("first", "second", "r"),
                F.struct(F.col("second").alias("first"), F.col("first").alias("second"), F.col("r")))
    )
    return half.select(F.inline(both))


def strong_pairs(df: DataFrame, columns: Sequence[str] | None = None, limit: float = 0.5) -> DataFrame:
    names = list(columns or numeric_columns(df))
    return correlations(df, upper_pairs(names)).where(F.abs("r") > limit)


def completeness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Share in % of values that are not NULL, '' or '{}'."""
    def filled(c: str) -> Column:
        return F.coalesce(~q(c).cast("string").isin("", "{}"), F.lit(False))

    return long_stats(df, list(columns or df.columns), {
        "completeness_pct": lambda c: F.avg(filled(c).cast("int")) * 100,
    })


def column_types(df: DataFrame) -> DataFrame:
    """Declared type and non-NULL count per column."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return long_stats(df, df.columns, {
        "type": lambda c: F.max(F.lit(kinds[c])), "non_null": lambda c: F.count(q(c)),
    })


def class_shares(df: DataFrame, target: str, by: str) -> DataFrame:
    """Share in % of each class within each group."""
    counts = df.groupBy(by, target).agg(F.count(F.lit(1)).alias("n"))
    return with_share(counts, [by], share="pct").withColumn("pct", F.col("pct") * 100)
