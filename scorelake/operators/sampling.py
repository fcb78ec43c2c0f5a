"""Splits, folds and class balancing (K). Every draw is a hash of a row id and a seed."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorelake.operators.aggregates import with_share
from scorelake.operators.profile import numeric_columns
from scorelake.operators.ranking import cut_index, hash_int, hash_unit, number_rows, row_hash
from scorelake.sizing import small_table
from scorelake.worker import nearest

SEED = 42
BALANCE_RATIO = 5.0
BLOCK_ROWS = 20_000
BLOCK_BYTES = 64 << 20


def class_counts(df: DataFrame, target: str) -> DataFrame:
    """Rows per class; a literal table when there are few classes, so the rows are counted once."""
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    small = small_table(counts)
    return counts if small is None else small


def total_rows(counts: DataFrame) -> int:
    return counts.agg(F.sum("n")).first()[0] or 0


def quotas(counts: DataFrame, size: str, wanted: Column, target: str, out: str) -> DataFrame:
    """Share ``wanted`` rows over classes in proportion to ``size``; largest remainders get the rest.

    Whole-number arithmetic; the table has one row per class.
    """
    total = F.sum(size).over(Window.partitionBy())
    product = F.col(size).cast("decimal(19,0)") * F.col("__wanted").cast("decimal(19,0)")
    parts = counts.withColumns({"__wanted": wanted, "__total": total}).withColumns({
        "__base": F.floor(product / F.col("__total").cast("decimal(19,0)")).cast("bigint"),
    })
    rest = product - F.col("__base").cast("decimal(19,0)") * F.col("__total").cast("decimal(19,0)")
    parts = parts.withColumn("__rest", rest)
    place = F.row_number().over(Window.orderBy(F.desc("__rest"), target))
    spare = F.col("__wanted") - F.sum("__base").over(Window.partitionBy())
    parts = parts.withColumns({"__place": place, "__spare": spare})
    extra = (F.col("__place") <= F.col("__spare")).cast("bigint")
    return parts.withColumn(out, F.col("__base") + extra).drop(
        "__wanted", "__total", "__base", "__rest", "__place", "__spare"
    )


def whole(fraction: float, size: str) -> Column:
    return F.ceil(F.lit(fraction) * F.sum(size).over(Window.partitionBy()))


def split_quotas(counts: DataFrame, target: str, test_size: float, val_size: float) -> DataFrame:
    """``(class, n, n_test, n_val)``."""
    tested = quotas(counts, "n", whole(test_size, "n"), target, "n_test")
    left = tested.withColumn("__left", F.col("n") - F.col("n_test"))
    return quotas(left, "__left", whole(val_size, "__left"), target, "n_val").drop("__left")


def stratified_split(df: DataFrame, target: str, row_id: str, test_size: float = 0.2, val_size: float = 0.25,
                     seed: int = SEED) -> DataFrame:
    """Add ``split``: test, val or train, class shares kept. ``row_id`` must be unique."""
    counts = class_counts(df, target)
    sizes = split_quotas(counts, target, test_size, val_size)
    cuts = sizes.select(target, F.inline(F.array(
        F.struct(F.lit(0).alias("cut"), F.col("n_test").alias("k")),
        F.struct(F.lit(1).alias("cut"), (F.col("n_test") + F.col("n_val")).alias("k")),
    )))
    cut = cut_index(df, target, row_id, cuts, seed, total_rows(counts), "__cut")
    name = F.when(F.col("__cut") == 0, "test").when(F.col("__cut") == 1, "val").otherwise("train")
    return cut.withColumn("split", name).drop("__cut")


def stratified_kfold(df: DataFrame, target: str, row_id: str, k: int = 5, seed: int = SEED) -> DataFrame:
    """Add ``fold`` 0..k-1. Class counts of two folds differ by at most one."""
    if k < 2:
        raise ValueError("k must be at least 2")
    counts = class_counts(df, target)
    cuts = counts.select(
        target, "n", F.explode(F.sequence(F.lit(0), F.lit(k - 2))).alias("cut")
    )
    size = F.floor(F.col("n") / k)
    upto = (F.col("cut") + 1) * size + F.least(F.col("cut") + 1, F.col("n") % k)
    cuts = cuts.select(target, "cut", upto.cast("bigint").alias("k"))
    return cut_index(df, target, row_id, cuts, seed, total_rows(counts), "fold")


def two_classes(df: DataFrame, target: str) -> None:
    """Balancing is for two classes: other classes and rows without a label would vanish, so they are refused."""
    seen = class_counts(df, target).select(target).limit(4).collect()
    if any(r[0] is None for r in seen):
        raise ValueError(f"{target} has NULL labels; drop or fill them before balancing")
    if len(seen) > 2:
        raise ValueError(f"{target} has more than two classes; balancing is for two")


def extremes(df: DataFrame, target: str):
    """(majority class, its rows, minority class, its rows); the smaller class value wins a tie."""
    big, small = F.struct((-F.col("n")).alias("m"), target), F.struct(F.col("n").alias("m"), F.col(target).alias("c"))
    row = class_counts(df.where(F.col(target).isNotNull()), target).agg(
        F.min(big).alias("big"), F.min(small).alias("small")
    ).first()
    if row["big"] is None:
        return None
    return row["big"][1], -row["big"][0], row["small"][1], row["small"][0]


def random_oversample(df: DataFrame, target: str, row_id: str, seed: int = SEED, out: str = "draw") -> DataFrame:
    """Majority rows plus as many minority draws with replacement.

    ``draw`` is NULL on a majority row and the draw number on a drawn one. Draws are hashes, so no
    minority row is hotter than chance makes it.
    """
    two_classes(df, target)
    found = extremes(df, target)
    if found is None or found[0] == found[2]:
        return df.withColumn(out, F.lit(None).cast("bigint"))
    major, n_major, minor, n_minor = found
    numbered = number_rows(df.where(F.col(target) == minor), row_id, seed, n_minor, "__number")
    token = F.md5(F.concat(F.lit(f"draw-{seed}-"), F.col("id").cast("string")).cast("binary"))
    draws = df.sparkSession.range(n_major).select(
        (hash_int(token) % F.lit(n_minor)).alias("__number"), F.col("id").alias(out)
    )
    drawn = numbered.join(draws, "__number").drop("__number")
    kept = df.where(F.col(target) == major).withColumn(out, F.lit(None).cast("bigint"))
    return kept.unionByName(drawn)


def minority_neighbours(rows: DataFrame, row_id: str, features: Sequence[str], k: int, n_rows: int,
                        block_rows: int = BLOCK_ROWS, seed: int = SEED) -> DataFrame:
    """``(id, other, dist, point)``: exact k nearest neighbours of every row (squared distance; ties by id).

    Pivot (Voronoi) cells: about ``n_rows / block_rows`` pivots drawn by least hash of the id, every row in the cell
    of its nearest pivot. Round one finds each row's k nearest in its own cell. Round two visits only the cells whose
    lower bound on the distance, ``max(d(x, p) - radius, (d(x, p) - d(x, own pivot)) / 2)``, is within the k-th distance
    found so far; the winners of both rounds are merged per row. No task compares all rows, and the pivots and radii that
    reach the driver number ``n_rows / block_rows``.
    """
    return _pivot_rounds(rows, row_id, features, k, n_rows, block_rows, seed)[0]


def _pivot_rounds(rows: DataFrame, row_id: str, features: Sequence[str], k: int, n_rows: int, block_rows: int, seed: int):
    """(neighbours, requests): the result and the (row, cell) visits of round two, which tests count."""
    vec = F.array(*[F.col(f"`{c}`").cast("double") for c in features])
    base = rows.select(F.col(row_id).alias("id"), vec.alias("point"))
    id_type = rows.schema[row_id].dataType.simpleString()
    names = ["id", "other", "dist", "point"]
    schema = f"id {id_type}, other {id_type}, dist double, point array<double>"
    cells = max(1, math.ceil(n_rows / block_rows))
    drawn = base.select("point", row_hash(F.col("id"), seed).alias("h")).orderBy("h").limit(4 * cells).collect()  # 4 x cells rows
    pivots = []
    for r in drawn:
        if r["point"] not in pivots:
            pivots.append(r["point"])
        if len(pivots) == cells:
            break
    pivot = np.array(pivots if pivots else [[0.0] * len(features)], dtype=np.float64)

    def distances(points: np.ndarray) -> np.ndarray:
        return np.sqrt(((points[:, None, :] - pivot[None, :, :]) ** 2).sum(-1))

    def assign(frame_iter):
        for frame in frame_iter:
            pts = np.stack(frame["point"].to_numpy()) if len(frame) else np.zeros((0, len(features)))
            d = distances(pts) if len(frame) else np.zeros((0, len(pivot)))
            own = d.argmin(1) if len(frame) else np.zeros(0, np.int64)
            yield frame.assign(cell=own.astype(np.int64), r=d[np.arange(len(frame)), own] if len(frame) else np.zeros(0))

    placed = base.mapInPandas(assign, f"id {id_type}, point array<double>, cell long, r double")
    radius = np.zeros(len(pivot))
    for row in placed.groupBy("cell").agg(F.max("r").alias("r")).collect():  # one row per cell
        radius[row["cell"]] = row["r"]

    def own_cell(frame: pd.DataFrame) -> pd.DataFrame:
        found = nearest(frame["id"].to_numpy(), np.stack(frame["point"].to_numpy()), frame["id"].to_numpy(), np.stack(frame["point"].to_numpy()), k)
        return pd.DataFrame(found, columns=names)

    first = placed.groupBy("cell").applyInPandas(own_cell, schema)
    if len(pivot) == 1:
        return first, None
    reach = first.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.max("dist").alias("kth"))
    asked = placed.join(reach, "id", "left").select("id", "point", "cell", F.when(F.col("n") >= k, F.col("kth")).alias("kth"))

    def requests(frame_iter):
        for frame in frame_iter:
            if not len(frame):
                continue
            pts = np.stack(frame["point"].to_numpy())
            d = distances(pts)
            own = frame["cell"].to_numpy()
            mine = d[np.arange(len(frame)), own]
            bound = np.maximum(d - radius[None, :], (d - mine[:, None]) / 2)
            limit = np.sqrt(frame["kth"].fillna(np.inf).to_numpy())
            visit = (bound <= limit[:, None] * (1 + 1e-9) + 1e-12)
            visit[np.arange(len(frame)), own] = False
            q, c = np.nonzero(visit)
            yield pd.DataFrame({"id": frame["id"].to_numpy()[q], "point": frame["point"].to_numpy()[q], "cell": c.astype(np.int64)})

    visits = asked.mapInPandas(requests, f"id {id_type}, point array<double>, cell long")
    pool = placed.select(F.col("id").alias("pool_id"), F.col("point").alias("pool_point"), F.col("cell").alias("pool_cell"))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame(columns=names)
        found = nearest(left["id"].to_numpy(), np.stack(left["point"].to_numpy()),
                        right["pool_id"].to_numpy(), np.stack(right["pool_point"].to_numpy()), k)
        return pd.DataFrame(found, columns=names)

    second = visits.groupBy("cell").cogroup(pool.groupBy("pool_cell")).applyInPandas(meet, schema)
    order = Window.partitionBy("id").orderBy("dist", "other")
    both = first.unionByName(second).withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place")
    return both, visits


def smote(df: DataFrame, target: str, row_id: str, features: Sequence[str], k: int = 5, seed: int = SEED) -> DataFrame:
    """``(target, features..., base_id, neighbour_id, u)``: synthetic minority rows that even the classes.

    Each lies between a minority row and one of its k nearest minority rows. Minority rows with a NULL feature are neither bases nor
    neighbours; the draws spread over the complete rows, so the classes come out even. Fewer than two complete rows make none.
    """
    usable = [c for c in features if c in numeric_columns(df)]
    if len(usable) != len(features):
        raise ValueError("smote needs numeric features; use random_oversample")
    two_classes(df, target)
    found = extremes(df, target)
    label = df.schema[target].dataType.simpleString()
    _, n_major, minor, n_minor = found or (None, 0, None, 0)
    complete = df.where(F.col(target).eqNullSafe(F.lit(minor))).dropna(subset=list(features))
    need, n_minor = n_major - n_minor, complete.count() if n_major > n_minor else 0
    if n_minor < 2:
        kind = df.schema[row_id].dataType.simpleString()
        none = [F.lit(None).cast(kind).alias(c) for c in ("base_id", "neighbour_id")]
        return df.where(F.lit(False)).select(target, *[F.col(f"`{c}`").cast("double").alias(c) for c in features], *none, F.lit(None).cast("double").alias("u"), F.lit(None).cast("bigint").alias("draw"))
    near = minority_neighbours(complete, row_id, features, k, n_minor)
    per_row = near.groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("dist", "other", "point"))).alias("near")
    )
    mine = complete.select(F.col(row_id).alias("id"), F.array(*[F.col(f"`{c}`").cast("double") for c in features]).alias("here"))
    numbered = number_rows(mine, "id", seed, n_minor, "number").join(per_row, "id")
    token = F.md5(F.concat(F.lit(f"smote-{seed}-"), F.col("id").cast("string")).cast("binary"))
    draws = df.sparkSession.range(need).select(
        (hash_int(token) % F.lit(n_minor)).alias("number"), hash_int(F.reverse(token), 8).alias("pick"),
        hash_unit(F.md5(token.cast("binary"))).alias("u"), F.col("id").alias("draw"),
    )
    pairs = numbered.join(draws, "number").withColumn(
        "mate", F.col("near")[(F.col("pick") % F.size("near")).cast("int")]
    )
    made = F.zip_with("here", F.col("mate.point"), lambda a, b: a + F.col("u") * (b - a))
    built = pairs.select("id", "mate", "u", "draw", made.alias("made"))
    return built.select(
        F.lit(minor).cast(label).alias(target), *[F.col("made")[i].alias(c) for i, c in enumerate(features)],
        F.col("id").alias("base_id"), F.col("mate.other").alias("neighbour_id"), "u", "draw",
    )


def balance_if_needed(df: DataFrame, target: str, row_id: str, ratio: float = BALANCE_RATIO, seed: int = SEED,
                      features: Sequence[str] | None = None) -> DataFrame:
    """Balance only when majority/minority exceeds ``ratio``: synthetic rows when all ``features`` are
    numeric, else draws with replacement."""
    two_classes(df, target)
    found = extremes(df, target)
    if found is None or found[3] == 0 or found[1] / found[3] <= ratio:
        return df.withColumn("draw", F.lit(None).cast("bigint"))
    if features and set(features) <= set(numeric_columns(df)):
        extra = smote(df, target, row_id, features, seed=seed)
        if extra.isEmpty():  # too few complete rows to draw between
            return random_oversample(df, target, row_id, seed).select(target, *features, "draw")
        base = df.select(target, *features).withColumn("draw", F.lit(None).cast("bigint"))
        return base.unionByName(extra.select(target, *features, "draw"))
    return random_oversample(df, target, row_id, seed)


def split_and_balance(df: DataFrame, target: str, row_id: str, seed: int = SEED, **sizes) -> DataFrame:
    """Split, then balance the train rows only."""
    parts = stratified_split(df, target, row_id, seed=seed, **sizes)
    train = balance_if_needed(parts.where(F.col("split") == "train"), target, row_id, seed=seed)
    rest = parts.where(F.col("split") != "train").withColumn("draw", F.lit(None).cast("bigint"))
    return rest.unionByName(train)


def split_class_shares(parts: DataFrame, target: str, split: str = "split") -> DataFrame:
    counts = parts.where(F.col(target).isNotNull()).groupBy(split, target).agg(F.count(F.lit(1)).alias("n"))
    return with_share(counts, [split], share="pct").withColumn("pct", F.col("pct") * 100)
