"""Reading tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorelake.operators.aggregates import value_distribution
from scorelake.operators.profile import missing_profile


def read_keyed_json(spark: SparkSession, path: str, record: T.StructType | str, key: str = "id",
                    per_line: bool = False) -> DataFrame:
    """``{id: record}`` documents as one row per id.

    A file is one document, and one task however large; with ``per_line`` every line is one, and files
    split. Land the result as Parquet before heavy use.
    """
    shape = record.simpleString() if isinstance(record, T.StructType) else record
    text = spark.read.text(path, wholetext=not per_line)
    parsed = text.select(F.from_json("value", f"map<string,{shape}>").alias("m"))
    return parsed.select(F.explode("m").alias(key, "record")).select(key, "record.*")


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None, kind: str | None = None,
               **options) -> DataFrame:
    """A Parquet, CSV or JSON table. Text formats need a schema, so no pass is spent on inference."""
    kind = kind or path.rstrip("/").rsplit(".", 1)[-1].lower()
    if kind == "parquet":
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    if kind not in ("csv", "json"):
        raise ValueError(f"unknown format: {kind}")
    if schema is None:
        raise ValueError(f"{kind} needs a schema")
    if kind == "csv":
        options = {"header": True, "enforceSchema": False} | options
    return spark.read.schema(schema).options(**options).format(kind).load(path)


def read_optional(spark: SparkSession, path: str, schema=None, **options) -> DataFrame | None:
    """The table, or None when there is none at the path. Other errors are raised."""
    try:
        return read_table(spark, path, schema, **options)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    lost = [n for n in names if n not in df.columns]
    if lost:
        raise ValueError(f"columns not found: {', '.join(lost)}")
    return df


def load_labelled(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(table, class shares in %, NULL counts of columns that have any); fails without the target."""
    require_columns(df, target)
    shares = value_distribution(df, target).select("value", (F.col("share") * 100).alias("pct"))
    return df, shares, missing_profile(df).where(F.col("missing") > 0)


def read_class_report(report: DataFrame, positive: str = "1") -> DataFrame:
    """Precision, recall, F1 of the positive class and the accuracy, from a report table with a ``class`` column.

    The accuracy row comes first; without one the weighted average's precision stands in.
    """
    require_columns(report, "class", "precision", "recall", "f1_score")
    label = F.col("class").cast("string")
    pick = lambda name, value: F.max(F.when(label == name, F.col(value)))
    row = report.agg(
        pick(positive, "precision").alias("precision"), pick(positive, "recall").alias("recall"),
        pick(positive, "f1_score").alias("f1_score"),
        F.coalesce(pick("accuracy", "precision"), pick("weighted avg", "precision")).alias("accuracy"),
    )
    return row.where(F.col("precision").isNotNull())
