"""Registry of queries over the given tables and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under a name, with the SQL that must give the same rows."""
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6, *only: str) -> DataFrame:
    """Doubles rounded for comparison; adding zero turns -0.0 into 0.0."""
    names = [f.name for f in df.schema.fields if f.dataType.simpleString() == "double" and (not only or f.name in only)]
    return df.withColumns({n: F.round(F.col(n), digits) + F.lit(0.0) for n in names}) if names else df


def r(expr: str, digits: int = 6) -> str:
    """The same rounding in SQL."""
    return f"(round({expr}, {digits}) + 0.0)"


def joined(terms: Column, sep: str = "|") -> Column:
    return F.array_join(terms, sep)


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def any_of(expr: str, terms) -> str:
    return "(" + " OR ".join(f"contains({expr}, {quote(t)})" for t in terms) + ")"


def bit(expr: str) -> str:
    return f"CAST(coalesce({expr}, false) AS INTEGER)"


def sql_map(expr: str, pairs) -> str:
    whens = " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in pairs.items())
    return f"CASE {expr} {whens} ELSE {expr} END"
