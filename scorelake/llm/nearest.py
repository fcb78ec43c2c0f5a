"""Approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are scaled to length one, so the largest cosine is the least distance. Each of ``TABLES`` tables hashes a vector by ``DIMS``
Gaussian projections cut into slots of ``WIDTH``. A query visits its own bucket and the perturbed buckets nearest to it in order of
estimated success: the sum of squared distances to the slots moved into. Each visited bucket ranks its rows by exact cosine; lists of
all buckets and tables are merged. A query that finds too few rows is compared with all rows in blocks.

The fixed probe count covers about the same share of the rows at every size, as weakly clustered vectors need it: recall on the given
tables is about 0.94 (see the README).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorelake.llm.common import landed

TABLES, DIMS, WIDTH, PROBES = 6, 4, 1.0, 80
CHUNK = 1024
SEED = 42


def family(size: int, tables: int = TABLES, dims: int = DIMS, width: float = WIDTH, seed: int = SEED):
    """Projections (tables, size, dims) and shifts (tables, dims) of the p-stable family."""
    rng = np.random.default_rng(seed)
    return rng.standard_normal((tables, size, dims)), rng.uniform(0, width, (tables, dims))


def moves(dims: int) -> np.ndarray:
    return np.array(list(product((-2, -1, 0, 1, 2), repeat=dims)))


def bucket_key(table: int, slots: np.ndarray) -> np.ndarray:
    """One number for a table and slot numbers between -2048 and 2047."""
    key = np.full(len(slots), table, np.int64)
    for k in range(slots.shape[1]):
        key = key * 4096 + (slots[:, k].clip(-2048, 2047) + 2048)
    return key


def probe_order(place: np.ndarray, steps: np.ndarray, probes: int) -> np.ndarray:
    """Numbers of the ``probes`` most promising moves of each query; ``place`` is its position in units of slots."""
    inside = place - np.floor(place)
    cost = np.zeros((len(place), len(steps)))
    for m in range(place.shape[1]):
        d = steps[:, m]
        gap = np.where(d > 0, d - inside[:, [m]], np.where(d < 0, inside[:, [m]] - d - 1, 0))
        cost += gap**2
    return np.argsort(cost, axis=1, kind="stable")[:, :probes]


def matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, size).astype(np.float64)


def best(query: np.ndarray, row: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best distinct rows of each query, ties to the smaller row id."""
    order = np.lexsort((row, -score, query))
    q, r = query[order], row[order]
    fresh = np.concatenate([[True], (q[1:] != q[:-1]) | (r[1:] != r[:-1])]) if len(q) else np.zeros(0, bool)
    order, q = order[fresh], q[fresh]
    first = np.concatenate([[True], q[1:] != q[:-1]]) if len(q) else np.zeros(0, bool)
    rank = np.arange(len(q)) - np.maximum.accumulate(np.where(first, np.arange(len(q)), 0))
    return order[rank < k]


def rank_buckets(source: Iterator[pa.RecordBatch], k: int, size: int) -> Iterator[pa.RecordBatch]:
    """Exact cosines inside each bucket of a partition sorted by (cell, part, is_query desc); best rows of each query so far."""
    names = ["query_id", "vec_id", "score"]
    got = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
    asked: tuple | None = None  # cell, part, query ids, unit vectors

    def shrink():
        use = best(*got, k)
        return [g[use] for g in got]

    for batch in source:
        if not batch.num_rows:
            continue
        cell, part, vec, ask = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "part", "vec_id", "ask")]
        x = matrix(batch.column("vector"), size)
        norm = np.sqrt((x * x).sum(1))
        new = np.flatnonzero(np.concatenate([[True], (cell[1:] != cell[:-1]) | (part[1:] != part[:-1])]))
        for a, b in zip(new.tolist(), [*new[1:].tolist(), len(cell)]):
            if asked is None or asked[:2] != (cell[a], part[a]):
                asked = (cell[a], part[a], np.empty(0, np.int64), np.empty((0, size)), np.empty(0))
            m = a + int(ask[a:b].sum())
            if m > a:
                asked = (*asked[:2], np.concatenate([asked[2], vec[a:m]]), np.concatenate([asked[3], x[a:m]]), np.concatenate([asked[4], norm[a:m]]))
            if b > m and len(asked[2]):
                for i in range(0, len(asked[2]), 256):
                    score = np.einsum("qd,vd->qv", asked[3][i:i + 256], x[m:b]) / (asked[4][i:i + 256, None] * norm[None, m:b])
                    score[asked[2][i:i + 256, None] == vec[None, m:b]] = -np.inf
                    width = min(b - m, 4 * k)
                    near = np.argpartition(-score, width - 1, axis=1)[:, :width] if width < b - m else np.tile(np.arange(b - m), (len(score), 1))
                    # A tie at the edge of the cut could hide a smaller id: such rows are kept whole.
                    value = np.take_along_axis(score, near, 1)
                    edge = np.flatnonzero((score >= value.min(1)[:, None]).sum(1) > width)
                    q = np.repeat(np.arange(len(score)), width)
                    c = near.ravel()
                    for e in edge.tolist():
                        more = np.flatnonzero(score[e] >= value[e].min())
                        q, c = np.concatenate([q, np.full(len(more), e)]), np.concatenate([c, more])
                    s = score[q, c]
                    ok = np.isfinite(s)
                    got = [np.concatenate([u, v]) for u, v in zip(got, (asked[2][i:i + 256][q[ok]], vec[m:b][c[ok]], s[ok]))]
                if len(got[0]) > 400_000:
                    got = shrink()
    got = shrink()
    if len(got[0]):
        yield pa.RecordBatch.from_arrays([pa.array(g) for g in got], names)


def _ranked(rows: DataFrame, k: int, size: int) -> DataFrame:
    ready = rows.repartition("cell", "part").sortWithinPartitions("cell", "part", F.desc("ask"))
    return ready.mapInArrow(lambda source: rank_buckets(source, k, size), "query_id long, vec_id long, score double")


def usable(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, vector): rows with an id and a non-zero vector of finite numbers; rows that repeat both count once."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    return embeddings.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("vector")).where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)))


def nearest(embeddings: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding", chunk: int = CHUNK,
            probes: int = PROBES) -> DataFrame:
    """Each query's (ids divisible by ``every``) nearest rows: query_id, rank, vec_id, score; ties to the smaller id.

    Rows without an id, and null, zero or non-finite vectors take no part; vectors of another length than the most common one neither.
    All rows with the query's own id are its own. Other columns are ignored; an empty table gives no rows.
    """
    spark = embeddings.sparkSession
    base = usable(embeddings, id_col, vector_col)
    top = base.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "size").first()
    size = top["size"] if top else 1
    base = base.where(F.size("vector") == size)
    made, steps = family(size), moves(DIMS)

    def hash_rows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                x = matrix(part.column("vector"), size)
                unit = x / np.sqrt((x * x).sum(1))[:, None]
                for t in range(TABLES):
                    place = (unit @ made[0][t] + made[1][t]) / WIDTH
                    slots = np.floor(place).astype(np.int64)
                    n = len(slots)
                    yield pa.RecordBatch.from_arrays([pa.array(bucket_key(t, slots)), part.column("vec_id"), pa.array(np.zeros(n, bool)), part.column("vector")], ["cell", "vec_id", "ask", "vector"])
                    own = np.flatnonzero(part.column("vec_id").to_numpy() % every == 0)
                    if len(own):
                        pick = probe_order(place[own], steps, probes)
                        cells = bucket_key(t, (slots[own][:, None, :] + steps[pick]).reshape(-1, DIMS))
                        who = pa.array(np.repeat(own, pick.shape[1]))
                        yield pa.RecordBatch.from_arrays([pa.array(cells), part.column("vec_id").take(who), pa.array(np.ones(len(cells), bool)), part.column("vector").take(who)], ["cell", "vec_id", "ask", "vector"])

    rows = base.mapInArrow(hash_rows, "cell long, vec_id long, ask boolean, vector array<double>")
    # Buckets with many rows or queries are cut on both sides; every part of one side meets every part of the other.
    held = rows.groupBy("cell").agg(F.count_if("ask").alias("asks"), F.count_if(~F.col("ask")).alias("rows"))
    big = held.where((F.col("asks") > chunk) | (F.col("rows") > chunk)).select("cell", F.ceil(F.col("asks") / chunk).alias("na"), F.ceil(F.col("rows") / chunk).alias("nr"))
    wide = rows.join(big, "cell", "left").withColumns({"na": F.greatest(F.coalesce("na", F.lit(1)), F.lit(1)), "nr": F.greatest(F.coalesce("nr", F.lit(1)), F.lit(1))})
    mine = F.pmod(F.xxhash64("vec_id"), F.when(F.col("ask"), F.col("na")).otherwise(F.col("nr")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.when(F.col("ask"), F.col("nr")).otherwise(F.col("na")) - 1))
    cut = wide.withColumn("mine", mine).withColumn("other", other)
    part = F.when(F.col("ask"), F.col("mine") * F.col("nr") + F.col("other")).otherwise(F.col("other") * F.col("nr") + F.col("mine"))
    found = landed(_ranked(cut.select("cell", part.alias("part"), "vec_id", "ask", "vector"), k, size))
    n = base.count()
    queries = base.where(F.col("vec_id") % every == 0)
    enough = found.groupBy("query_id").agg(F.count_distinct("vec_id").alias("n")).where(F.col("n") >= min(k, max(n - 1, 0))).select(F.col("query_id").alias("vec_id"))
    short = queries.join(enough, "vec_id", "left_anti")
    if n > 1 and not short.isEmpty():
        parts = max(1, -(-n // chunk))
        all_rows = base.select(F.lit(0).cast("long").alias("cell"), F.pmod(F.xxhash64("vec_id"), F.lit(parts)).alias("part"), "vec_id", F.lit(False).alias("ask"), "vector")
        asks = short.select(F.lit(0).cast("long").alias("cell"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"), "vec_id", F.lit(True).alias("ask"), "vector")
        found = found.union(_ranked(all_rows.union(asks), k, size))
    merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return merged.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
