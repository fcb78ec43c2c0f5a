"""Label codes and one-hot columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorelake.functions import vocab
from scorelake.sizing import join_lookup, small_table

MAX_LEVELS = 10


def label_codes(df: DataFrame, column: str, missing: str = vocab.UNSPECIFIED, marks: int = 256) -> DataFrame:
    """``(value, code)``: 0-based rank of each distinct value in sorted order.

    A vocabulary too wide for one task is cut at values drawn by hash, then ranked inside each cut.
    """
    values = df.select(F.coalesce(F.col(column).cast("string"), F.lit(missing)).alias("value")).distinct()
    small = small_table(values)
    if small is not None:
        return small.select("value", (F.row_number().over(Window.orderBy("value")) - 1).cast("bigint").alias("code"))
    drawn = values.orderBy(F.md5(F.col("value").cast("binary"))).limit(marks).collect()
    cuts = F.array(*[F.lit(r["value"]) for r in drawn])
    lead = values.withColumn("lead", F.size(F.filter(cuts, lambda m: m < F.col("value"))))
    sizes = lead.groupBy("lead").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("lead").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    placed = join_lookup(lead, sizes.select("lead", before.alias("before")), "lead", "inner")
    place = F.row_number().over(Window.partitionBy("lead").orderBy("value"))
    return placed.select("value", (F.col("before") + place - 1).cast("bigint").alias("code"))


def label_encode(df: DataFrame, column: str, missing: str = vocab.UNSPECIFIED, out: str | None = None) -> DataFrame:
    codes = label_codes(df, column, missing)
    joined = join_lookup(
        df, codes, lambda a, b: F.coalesce(a[column].cast("string"), F.lit(missing)) == b["value"]
    )
    return joined.withColumn(out or f"{column}_encoded", F.col("code")).drop("value", "code")


def levels(df: DataFrame, column: str, limit: int = MAX_LEVELS) -> list[str] | None:
    """Sorted distinct non-NULL values, or None when there are more than ``limit``."""
    rows = df.select(F.col(column).cast("string")).where(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()
    return sorted(r[0] for r in rows) if len(rows) <= limit else None


def onehot_columns(column: str, values: Sequence[str]) -> dict[str, Column]:
    text = F.col(column).cast("string")
    return {f"{column}_{v}": F.coalesce((text == v).cast("int"), F.lit(0)) for v in values}


def onehot(df: DataFrame, column: str, limit: int = MAX_LEVELS, drop_first: bool = False) -> DataFrame:
    """One 0/1 column per value when there are at most ``limit``; a NULL row is all 0."""
    found = levels(df, column, limit)
    if not found:
        return df
    return df.withColumns(onehot_columns(column, found[1:] if drop_first else found))


def onehot_drop_first(df: DataFrame, columns: Sequence[str], limit: int = MAX_LEVELS) -> DataFrame:
    for c in columns:
        df = onehot(df, c, limit, drop_first=True).drop(c)
    return df


def plain_name(text: str) -> str:
    return re.sub(r"\W+", "_", text).strip("_")
