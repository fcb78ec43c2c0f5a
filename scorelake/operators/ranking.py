"""Global ranks without a global sort.

``hash_cuts`` finds the rows that hold given ranks inside each class by counting hash buckets and
ranking only the buckets where a cut falls. ``number_rows`` gives every row its rank from bucket
offsets. ``running_by_value`` gives running sums in value order from range partitions and their offsets. None of them
puts a class, or the table, into one task.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorelake.session import landed
from scorelake.sizing import join_lookup

BUCKET_ROWS = 1_000_000
HEX_TABLE_ROWS = 70_000


def row_hash(row_id: Column, seed: int) -> Column:
    return F.md5(F.concat(row_id.cast("string"), F.lit(f"#{seed}")).cast("binary"))


def hash_int(text: Column, digits: int = 15) -> Column:
    """Leading hex digits of a hash as a BIGINT."""
    return F.conv(F.substring(text, 1, digits), 16, 10).cast("bigint")


def hash_unit(text: Column) -> Column:
    """A hash as a double in [0, 1)."""
    return hash_int(text, 12) / F.lit(float(16**12))


def hex_digits(rows: int) -> int:
    """Prefix length that gives about as many buckets as rows per bucket."""
    return min(6, max(1, math.ceil(math.log(max(rows, 1), 16) / 2)))


def hash_cuts(df: DataFrame, group: str, row_id: str, cuts: DataFrame, seed: int, digits: int) -> DataFrame:
    """``(group, zero_cuts, marks)``: the hash and id found at each rank ``k`` of ``cuts(group, cut, k)``.

    Only the (class, prefix) buckets where a cut falls are sorted.
    """
    keyed = df.select(
        F.col(group).alias("g"), F.col(row_id).alias("id"), row_hash(F.col(row_id), seed).alias("h")
    ).withColumn("b", F.substring("h", 1, digits))
    sizes = keyed.groupBy("g", "b").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("g").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    upto = sizes.withColumn("upto", F.sum("n").over(order))
    wanted = cuts.select(F.col(group).alias("g"), "cut", "k")
    hits = (
        upto.alias("u")
        .join(wanted.alias("w"), F.col("u.g").eqNullSafe(F.col("w.g")))
        .where((F.col("w.k") > F.col("u.upto") - F.col("u.n")) & (F.col("w.k") <= F.col("u.upto")))
        .select("u.g", "u.b", "w.cut", (F.col("w.k") - F.col("u.upto") + F.col("u.n")).alias("need"))
    )
    inside = join_lookup(
        keyed, hits.withColumnsRenamed({"g": "g2", "b": "b2"}),
        lambda left, right: left["b"].eqNullSafe(right["b2"]) & left["g"].eqNullSafe(right["g2"]),
        "inner",
    )
    place = F.row_number().over(Window.partitionBy("g", "cut").orderBy("h", "id"))
    marks = inside.withColumn("place", place).where(F.col("place") == F.col("need"))
    packed = marks.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("h", "id"))).alias("marks"))
    zeros = wanted.groupBy("g").agg(F.count_if(F.col("k") <= 0).cast("int").alias("zero_cuts"))
    return (
        zeros.alias("z")
        .join(packed.alias("p"), F.col("z.g").eqNullSafe(F.col("p.g")), "left")
        .select(F.col("z.g").alias(group), "z.zero_cuts", "p.marks")
    )


def cut_index(df: DataFrame, group: str, row_id: str, cuts: DataFrame, seed: int, rows: int, out: str) -> DataFrame:
    """Add ``out``: how many cuts of its class each row lies beyond. The rows themselves do not shuffle."""
    marks = hash_cuts(df, group, row_id, cuts, seed, hex_digits(rows)).withColumnRenamed(group, "__g")
    joined = join_lookup(df, marks, lambda left, right: left[group].eqNullSafe(right["__g"]))
    me = F.struct(row_hash(F.col(row_id), seed).alias("h"), F.col(row_id).alias("id"))
    beyond = F.coalesce(F.size(F.filter("marks", lambda m: m < me)), F.lit(0))
    return joined.withColumn(out, F.col("zero_cuts") + beyond).drop("__g", "zero_cuts", "marks")


def number_rows(df: DataFrame, row_id: str, seed: int, rows: int, out: str) -> DataFrame:
    """Add ``out``: 0-based position of each row in hash order."""
    keyed = df.withColumn("__h", row_hash(F.col(row_id), seed)).withColumn(
        "__b", F.substring("__h", 1, min(4, hex_digits(rows)))
    )
    sizes = keyed.groupBy("__b").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)) - F.col("__n")
    offsets = sizes.select("__b", before.alias("__before"))
    placed = join_lookup(keyed, offsets, "__b", "inner", HEX_TABLE_ROWS)
    place = F.row_number().over(Window.partitionBy("__b").orderBy("__h", row_id))
    return placed.withColumn(out, F.col("__before") + place - 1).drop("__h", "__b", "__n", "__before")


def running_by_value(
    df: DataFrame, value: str, sums: Mapping[str, Column], bucket_rows: int = BUCKET_ROWS
) -> tuple[DataFrame, dict[str, int]]:
    """One row per distinct value with each sum and its running total ``cum_*`` from the highest down.

    Returns the table and the grand totals. Distinct values are range-partitioned in descending order (NaN ranks above
    every number, as Spark orders it; infinities are ordinary values) into about one partition per ``bucket_rows`` rows;
    the partitioned table is landed so that its partition numbers stay fixed, each partition's sums make one small row,
    and a partition's offset is the sum of the partitions before it. There is no bucket limit and no split list.
    """
    base = df.select(F.col(value).cast("double").alias("value"), *[c.alias(n) for n, c in sums.items()]).where(
        F.col("value").isNotNull()
    )
    groups = base.groupBy("value").agg(F.count(F.lit(1)).alias("__rows"), *[F.sum(n).alias(n) for n in sums]).persist()
    try:
        head = groups.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in ("__rows", *sums)]).first().asDict()
        rows = head.pop("__rows")
        parts = max(1, math.ceil(rows / max(1, bucket_rows)))
        ranged = landed(groups.drop("__rows").repartitionByRange(parts, F.desc("value")).withColumn("__part", F.spark_partition_id()))
    finally:
        groups.unpersist()
    part_sums = ranged.groupBy("__part").agg(*[F.sum(n).alias(n) for n in sums])
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, 0)  # one row per partition
    offsets = part_sums.select("__part", *[(F.sum(n).over(before) - F.col(n)).alias(f"above_{n}") for n in sums])
    placed = join_lookup(ranged, offsets, "__part", "inner")
    order = Window.partitionBy("__part").orderBy(F.desc("value")).rowsBetween(Window.unboundedPreceding, 0)
    totals = {f"cum_{n}": F.sum(n).over(order) + F.col(f"above_{n}") for n in sums}
    return placed.withColumns(totals).drop("__part", *[f"above_{n}" for n in sums]), head
