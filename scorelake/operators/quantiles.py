"""Exact linear-interpolated quantiles at any size, on one path: a sketch brackets each wanted rank, running counts over
range partitions select the value inside the bracket. No task gathers a column and only the answers reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorelake.session import landed
from scorelake.sizing import join_lookup

#: Sketch accuracy: its rank error is at most rows / ACCURACY, so a bracket holds about 6 rows in ACCURACY.
ACCURACY = 10_000
#: Distinct bracket values that one range partition holds.
BUCKET_ROWS = 1_000_000


def clean_number(c: Column) -> Column:
    """Double with NaN as NULL."""
    d = c.cast("double")
    return F.when(~F.isnan(d), d)


def finite(c: str) -> Column:
    return F.when(F.abs(F.col(c)) < math.inf, F.col(c))


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    accuracy: int = ACCURACY,
    bucket_rows: int = BUCKET_ROWS,
) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles of each column (NaN and NULL left out; infinities are values), exact at every size.

    One path in two passes over the data, plus one small aggregate:

    1. one aggregate gives each column's count and, from a mergeable quantile sketch (``percentile_approx``, rank
       error at most ``n / accuracy``), a bracket of values around every wanted rank;
    2. one aggregate counts the rows below and up to each bracket; a bracket that does not hold its rank (which the
       sketch's bound rules out) becomes the whole column, so the answer never depends on the sketch being right;
    3. the rows inside the brackets, as (bracket, value, count), are range-partitioned; sums per partition give
       offsets, running sums inside a partition find the value at each rank. Only those values reach the driver.
    """
    if not columns:
        return {}
    data = df.select([clean_number(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(columns)])
    margin = 3.0 / accuracy
    edges = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-margin, margin)})
    head = data.agg(*[F.struct(F.count(c).alias("n"), F.percentile_approx(c, edges, accuracy).alias("at")).alias(c) for c in data.columns]).first()
    brackets = []  # (column, rank, lo, hi)
    for c in data.columns:
        n, at = head[c]["n"], head[c]["at"]
        if not n:
            continue
        value_at = dict(zip(edges, at))
        for p in probs:
            spot = p * (n - 1)
            for r in sorted({math.floor(spot), math.ceil(spot)}):
                q = r / max(1, n - 1)
                lo = value_at[min(1.0, max(0.0, _near(edges, q - margin, "lo")))]
                hi = value_at[min(1.0, max(0.0, _near(edges, q + margin, "hi")))]
                brackets.append((c, r, lo, hi))
    brackets = list(dict.fromkeys(brackets))
    found = _select_in_brackets(data, brackets, {c: head[c]["n"] for c in data.columns}, bucket_rows)
    out: dict[str, list[float | None]] = {}
    for c in data.columns:
        n = head[c]["n"]
        if not n:
            out[c] = [None] * len(probs)
            continue
        values = []
        for p in probs:
            spot = p * (n - 1)
            lo, hi = found[c, math.floor(spot)], found[c, math.ceil(spot)]
            part = spot - math.floor(spot)
            values.append(lo if lo == hi or part == 0 else (1 - part) * lo + part * hi if math.isinf(lo) or math.isinf(hi) else lo + (hi - lo) * part)
        out[c] = values
    return {name: out[f"c{i}"] for i, name in enumerate(columns)}


def _near(edges: list[float], q: float, side: str) -> float:
    """The sketch probability nearest to ``q`` on the safe side (below for a lower bracket end, above for an upper one)."""
    if side == "lo":
        below = [e for e in edges if e <= q + 1e-12]
        return below[-1] if below else edges[0]
    above = [e for e in edges if e >= q - 1e-12]
    return above[0] if above else edges[-1]


def _select_in_brackets(data: DataFrame, brackets, counts: dict[str, int], bucket_rows: int) -> dict[tuple[str, int], float]:
    """Value at each (column, rank) of ``brackets``: checked brackets, then running counts over range partitions."""
    if not brackets:
        return {}
    checks = [
        F.struct(F.count_if(F.col(c) < F.lit(lo)).alias("below"), F.count_if(F.col(c) <= F.lit(hi)).alias("upto")).alias(f"b{i}")
        for i, (c, r, lo, hi) in enumerate(brackets)
    ]
    got = data.agg(*checks).first()
    keys = []  # (column, rank, lo, hi, below, rows inside)
    for i, (c, r, lo, hi) in enumerate(brackets):
        below, upto = got[f"b{i}"]["below"], got[f"b{i}"]["upto"]
        if not below <= r < upto:  # not held: the whole column is the bracket
            lo, hi, below, upto = -math.inf, math.inf, 0, counts[c]
        keys.append((c, r, lo, hi, below, upto - below))
    slots = [F.when(F.col(c).between(lo, hi), F.struct(F.lit(i).alias("k"), F.col(c).alias("v"))) for i, (c, r, lo, hi, _, _) in enumerate(keys)]
    inside = data.select(F.explode(F.array_compact(F.array(*slots))).alias("s")).select("s.*").groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    parts = max(1, math.ceil(sum(k[5] for k in keys) / max(1, bucket_rows)))
    ranged = landed(inside.repartitionByRange(parts, "k", "v").withColumn("__part", F.spark_partition_id()))
    per_part = ranged.groupBy("__part", "k").agg(F.sum("n").alias("m"))  # at most partitions x brackets rows
    earlier = Window.partitionBy("k").orderBy("__part").rowsBetween(Window.unboundedPreceding, 0)
    offsets = per_part.select("__part", "k", (F.sum("m").over(earlier) - F.col("m")).alias("before"))
    need = F.create_map(*[x for i, key in enumerate(keys) for x in (F.lit(i), F.lit(key[1] - key[4] + 1))])
    upto = F.sum("n").over(Window.partitionBy("__part", "k").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)) + F.col("before")
    hits = (
        join_lookup(ranged, offsets, ["__part", "k"], "inner")
        .select("k", "v", "n", upto.alias("upto"))
        .where((F.col("upto") - F.col("n") < need[F.col("k")]) & (need[F.col("k")] <= F.col("upto")))
        .select("k", "v").collect()  # one row per bracket
    )
    return {(keys[h["k"]][0], keys[h["k"]][1]): h["v"] for h in hits}
