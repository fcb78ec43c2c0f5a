"""Size checks that decide whether a table may be broadcast.

A table becomes a literal relation only after Spark has measured it: at most
``max_rows`` rows and ``max_bytes`` bytes as text. Nothing is fetched before that. Anything larger stays a
distributed table and is joined by shuffle, where AQE splits hot keys.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_ROWS = 20_000
MAX_BYTES = 8 << 20
SPREAD_BYTES = 256 << 20


def small_table(df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> DataFrame | None:
    """``df`` as a local relation when it is proven small, else None."""
    row = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    head = df.limit(max_rows + 1).persist()  # measured and fetched from one evaluation
    try:
        seen = head.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row), F.lit(0)).alias("size")).first()
        if seen["n"] > max_rows or seen["size"] > max_bytes:
            return None
        got = head.toArrow()
    finally:
        head.unpersist()
    if got.num_rows > max_rows:  # a lost block is computed again and may differ
        return None
    return df.sparkSession.createDataFrame(got, schema=df.schema)


def spread(df: DataFrame, max_bytes: int = SPREAD_BYTES) -> DataFrame:
    """Deal a small scan out to every core before heavy per-row work.

    A file of one row group is one task. Only an input whose planned size is below ``max_bytes`` is
    dealt out; a large one is never shuffled for this.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if size < max_bytes else df


def kept(df: DataFrame) -> DataFrame:
    """``df`` persisted for repeated passes, on at least one partition per core. The caller unpersists."""
    data = df.persist()
    data.count()
    cores = df.sparkSession.sparkContext.defaultParallelism
    if data.rdd.getNumPartitions() >= cores:
        return data
    wide = data.repartition(cores).persist()
    wide.count()
    data.unpersist()
    return wide


def join_lookup(
    df: DataFrame,
    lookup: DataFrame,
    on: Callable[[DataFrame, DataFrame], Column] | str | Sequence[str],
    how: str = "left",
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Join an aggregate back onto its source without shuffling the source.

    When the lookup is proven small it is broadcast, so a hot key costs nothing.
    Otherwise both sides shuffle and AQE splits skewed partitions.
    """
    small = small_table(lookup, max_rows)
    right = lookup if small is None else F.broadcast(small)
    cond = on(df, right) if callable(on) else on
    return df.join(right, cond, how)
