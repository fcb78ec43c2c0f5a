"""Near-duplicate embeddings by cross-polytope hashing after fast Hadamard rotations.

Plan:

* Exact copies fold first: one aggregate by the vector itself gives each distinct valid vector its least id and its
  number of copies, so a vector held by a third of all rows costs one row a task (partial aggregation).
* Each distinct vector, as a unit vector in doubles padded to a power of two, is rotated ``ROUNDS`` times by random signs
  and a fast Walsh-Hadamard transform per table; its hash is the coordinate of largest magnitude with its sign (one of
  ``2 d`` vertices of the cross-polytope). ``k`` hashes make a bucket; ``k`` grows with the number of distinct vectors so
  that buckets stay small at every size.
* Multiprobe: besides its home bucket a vector visits the ``PROBES`` buckets whose hashes differ in one place, in order of
  estimated success (the smallest gap between the largest magnitude and the one that would replace it).
* A pair is a candidate in a bucket where one of them lives and the other lives or visits. Each bucket's candidates are
  verified by exact cosine on the original vectors in doubles; a verified pair counts once, in the first table and bucket
  where it meets (every vector carries its home and probe buckets of all tables, so this is decided locally).
* Rows are partitioned and sorted by bucket; a task verifies many small buckets at once as arrays of pairs, and cuts a
  large bucket into blocks. It sends per-vector link counts and, per row, the least id linked to it there; components
  come from rounds of star joins (the library's own helper) and reach back to every row.

Defined cases: null, zero, NaN or infinite vectors (or null components) link with nothing: n_links 0, their own id as
component, kept. A row with a null vec_id takes no part either: n_links 0, null component, null kept. Repeated rows (same id) are separate rows
with the same result. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.llm.common import Shipped, landed
from scorelake.llm.simhash import components

THRESHOLD = 0.95
TABLES = 6
PROBES = 6
ROUNDS = 3
SEED = 1234
#: Expected vectors a bucket holds at most; the number of hashes a bucket joins grows with the log of the distinct vectors.
BUCKET_ROWS = 8
#: Vectors of one bucket compared at once, so memory stays bounded for a large group of near copies.
BLOCK = 2048
#: Copies of one vector above which the rows reach their group by a broadcast of a bounded table.
HOT_COPIES = 100_000
MAX_HOT = 200_000


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row (length a power of two), scaled to keep lengths."""
    n, d = x.shape
    h = 1
    y = x.copy()
    while h < d:
        y = y.reshape(n, d // (2 * h), 2, h)
        a, b = y[:, :, 0, :], y[:, :, 1, :]
        y = np.concatenate([a + b, a - b], axis=2)
        h *= 2
    return y.reshape(n, d) / np.sqrt(d)


class Hasher:
    """Signs of all rotations, drawn once from ``SEED``."""

    def __init__(self, dims: int, tables: int, hashes: int, probes: int, rounds: int = ROUNDS, seed: int = SEED):
        self.pad = 1 << max(1, int(np.ceil(np.log2(max(dims, 2)))))
        self.dims, self.tables, self.hashes, self.probes = dims, tables, hashes, probes
        rng = np.random.default_rng(seed)
        self.signs = rng.choice([-1.0, 1.0], size=(tables, hashes, rounds, self.pad))

    def codes(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(home, probes): bucket numbers per table, shapes (n, tables) and (n, tables, probes); -1 for no probe."""
        n = len(unit)
        x0 = np.zeros((n, self.pad))
        x0[:, :self.dims] = unit
        span = 2 * self.pad
        home = np.zeros((n, self.tables), np.int64)
        probe = np.full((n, self.tables, self.probes), -1, np.int64)
        for t in range(self.tables):
            best = np.zeros((n, self.hashes), np.int64)
            alt = np.zeros((n, self.hashes, 2), np.int64)
            gap = np.zeros((n, self.hashes, 2))
            for k in range(self.hashes):
                x = x0
                for s in self.signs[t, k]:
                    x = hadamard(x * s)
                mag = np.abs(x)
                order = np.argsort(-mag, axis=1, kind="stable")[:, :3]
                vertex = lambda j: order[:, j] * 2 + (np.take_along_axis(x, order[:, j:j + 1], 1)[:, 0] < 0)
                top = np.take_along_axis(mag, order, 1)
                best[:, k] = vertex(0)
                alt[:, k, 0], alt[:, k, 1] = vertex(1), vertex(2)
                gap[:, k, 0], gap[:, k, 1] = top[:, 0] - top[:, 1], top[:, 0] - top[:, 2]
            weight = span ** np.arange(self.hashes)
            home[:, t] = (best * weight).sum(1)
            # One hash changed to its second or third vertex, cheapest first.
            flat_gap = gap.reshape(n, -1)
            pick = np.argsort(flat_gap, axis=1, kind="stable")[:, :self.probes]
            place, which = pick // 2, pick % 2
            changed = np.take_along_axis(alt.reshape(n, -1), pick, 1)
            was = np.take_along_axis(best, place, 1)
            probe[:, t, :pick.shape[1]] = home[:, t:t + 1] + (changed - was) * weight[place]
        return home, probe


def _meets(home_a, probe_a, home_b, probe_b) -> np.ndarray:
    """Per table: does a pair meet (one lives where the other lives or visits)? Shapes (..., tables)."""
    return (home_a == home_b) | (home_a[..., None] == probe_b).any(-1) | (home_b[..., None] == probe_a).any(-1)


def _pairs_of_buckets(bounds: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs (i < j) of rows inside each bucket ``[bounds[k], bounds[k + 1])``, in pieces of about ``limit`` pairs.
    A bucket larger than ``BLOCK`` rows is cut into blocks, so no piece holds more than ``BLOCK`` x ``BLOCK`` pairs."""
    sizes = np.diff(bounds)
    small = np.flatnonzero((sizes > 1) & (sizes <= BLOCK))
    pairs = sizes[small] * (sizes[small] - 1) // 2
    start = 0
    while start < len(small):
        stop = start + max(1, int(np.searchsorted(np.cumsum(pairs[start:]), limit, side="right")))
        rows = np.concatenate([np.arange(bounds[k], bounds[k + 1]) for k in small[start:stop]])
        ends = np.repeat(bounds[small[start:stop] + 1], sizes[small[start:stop]])
        count = ends - rows - 1
        a = np.repeat(rows, count)
        first = np.cumsum(count) - count
        b = a + 1 + (np.arange(len(a)) - np.repeat(first, count))
        yield a, b
        start = stop
    for k in np.flatnonzero(sizes > BLOCK):
        lo, hi = int(bounds[k]), int(bounds[k + 1])
        for s in range(lo, hi, BLOCK):
            for r in range(s, hi, BLOCK):
                a, b = np.meshgrid(np.arange(s, min(s + BLOCK, hi)), np.arange(r, min(r + BLOCK, hi)), indexing="ij")
                keep = a < b
                yield a[keep], b[keep]


def _bucket_links(box: Shipped, threshold: float, tables: int, probes: int):
    """Rows sorted by (table, bucket) in, (id, links, root) out: verified links counted where a pair first meets, and each
    row's least linked id in its part. A bucket cut by a batch border waits for the next batch."""

    def verify(t, code, ids, lives, copies, unit, homes, probe):
        n = len(ids)
        count = np.zeros(n, np.int64)
        label = np.arange(n)
        bounds = np.concatenate([[0], np.flatnonzero((t[1:] != t[:-1]) | (code[1:] != code[:-1])) + 1, [n]])
        found_a, found_b = [], []
        for a, b in _pairs_of_buckets(bounds, 1 << 20):
            cos = np.einsum("ij,ij->i", unit[a], unit[b])
            keep = (cos >= threshold) & (lives[a] | lives[b])
            a, b = a[keep], b[keep]
            if not len(a):
                continue
            found_a.append(a)
            found_b.append(b)
            table, here = t[a], code[a]
            rows = np.arange(len(a))
            # Counted where the pair first meets: no earlier table, and in this table no smaller bucket.
            meet = _meets(homes[a], probe[a], homes[b], probe[b])
            first = ~np.where(np.arange(tables)[None, :] < table[:, None], meet, False).any(1)
            ha, hb = homes[a, table], homes[b, table]
            pa_, pb_ = probe[a, table], probe[b, table]
            at_a = (ha == hb) | (pb_ == ha[:, None]).any(1)  # the pair meets in a's home bucket
            at_b = (ha == hb) | (pa_ == hb[:, None]).any(1)  # ... in b's home bucket
            big = np.iinfo(np.int64).max
            least = np.minimum(np.where(at_a, ha, big), np.where(at_b, hb, big))
            first &= least == here
            np.add.at(count, a[first], copies[b[first]])
            np.add.at(count, b[first], copies[a[first]])
            del rows
        if found_a:
            a, b = np.concatenate(found_a), np.concatenate(found_b)
            while True:  # least label over verified links, spread until nothing changes
                low = np.minimum(label[a], label[b])
                new = label.copy()
                np.minimum.at(new, a, low)
                np.minimum.at(new, b, low)
                new = new[new]
                if (new == label).all():
                    break
                label = new
        least = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(least, label, ids)
        root = least[label]
        out = (count > 0) | (root != ids)
        return pa.RecordBatch.from_arrays([pa.array(ids[out]), pa.array(count[out]), pa.array(root[out])], ["id", "links", "root"])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in source:
            if not batch.num_rows:
                continue
            data = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            data = data.combine_chunks()
            t, code = data["t"].to_numpy(), data["code"].to_numpy()
            last = np.flatnonzero((t == t[-1]) & (code == code[-1]))[0]
            ready, held = data.slice(0, last), data.slice(last)
            if ready.num_rows:
                yield _verify_table(ready, verify, tables, probes)
        if held is not None and held.num_rows:
            yield _verify_table(held, verify, tables, probes)

    return run


def _verify_table(data: pa.Table, verify, tables: int, probes: int) -> pa.RecordBatch:
    n = data.num_rows
    unit = data["unit"].combine_chunks().flatten().to_numpy().reshape(n, -1)
    homes = data["homes"].combine_chunks().flatten().to_numpy().reshape(n, tables)
    probe = data["probes"].combine_chunks().flatten().to_numpy().reshape(n, tables, probes)
    return verify(data["t"].to_numpy(), data["code"].to_numpy(), data["id"].to_numpy(), data["lives"].to_numpy(zero_copy_only=False),
                  data["m"].to_numpy(), unit, homes, probe)


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD,
                    tables: int = TABLES, probes: int = PROBES, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per row: vec_id, n_links (other vectors linked directly), component_id (least vec_id reachable), kept."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    valid = F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) \
        & F.exists("v", lambda x: x != 0)
    rows = landed(rows.withColumn("ok", F.coalesce(valid, F.lit(False)) & F.col("vec_id").isNotNull()))
    good = rows.where("ok")
    groups = landed(good.groupBy("v").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("m")))
    n = groups.count()
    dims = groups.select(F.max(F.size("v"))).first()[0] or 1
    pad = 1 << max(1, int(np.ceil(np.log2(max(dims, 2)))))
    hashes = max(1, int(np.ceil(np.log(max(n, 1) / bucket_rows) / np.log(2 * pad))))
    box = Shipped(spark, Hasher(dims, tables, hashes, probes))

    def code(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            if not batch.num_rows:
                continue
            lists = batch.column(0)
            width = box.value.dims
            flat = np.zeros((batch.num_rows, width))
            for i, v in enumerate(lists.to_pylist()):
                flat[i, :len(v)] = v
            unit = flat / np.linalg.norm(flat, axis=1, keepdims=True)
            home, probe = box.value.codes(unit)
            yield pa.RecordBatch.from_arrays([
                batch.column(1), batch.column(2), pa.array(list(unit), pa.list_(pa.float64())),
                pa.array(list(home), pa.list_(pa.int64())), pa.array(list(probe.reshape(len(unit), -1)), pa.list_(pa.int64()))],
                ["id", "m", "unit", "homes", "probes"])

    coded = landed(groups.select("v", "id", "m").mapInArrow(code, "id long, m long, unit array<double>, homes array<long>, probes array<long>"))
    per_table = coded.select("*", F.posexplode("homes").alias("t", "home"))
    lives = per_table.select("t", F.col("home").alias("code"), F.lit(True).alias("lives"), "id", "m", "unit", "homes", "probes")
    visits = per_table.select("t", F.explode(F.slice("probes", F.col("t") * probes + 1, probes)).alias("code"), F.lit(False).alias("lives"),
                              "id", "m", "unit", "homes", "probes").where("code >= 0")
    placed = lives.unionByName(visits)
    # Buckets without a home row hold no candidate pair.
    homed = placed.groupBy("t", "code").agg(F.max(F.col("lives").cast("int")).alias("h")).where("h = 1").select("t", "code")
    sorted_rows = placed.join(homed, ["t", "code"], "left_semi").repartition("t", "code").sortWithinPartitions("t", "code")
    linked = sorted_rows.select("t", "code", "lives", "id", "m", "unit", "homes", "probes").mapInArrow(
        _bucket_links(box, threshold, tables, probes), "id long, links long, root long")
    linked = landed(linked)
    counts = linked.groupBy("id").agg(F.sum("links").alias("links"))
    edges = linked.where("root != id").select(F.col("id").alias("a"), F.col("root").alias("b"))
    roots = components(edges).select(F.col("fp").alias("id"), F.col("root").alias("component"))
    per_group = groups.select("v", "id", "m").join(counts, "id", "left").join(roots, "id", "left").select(
        "v", (F.col("m") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    found = _attach(good.select("vec_id", "v"), per_group, "v", HOT_COPIES, MAX_HOT, groups)
    lone = rows.where(~F.col("ok")).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = found.unionByName(lone)
    return out.select("vec_id", F.col("n_links").cast("long").alias("n_links"), F.col("component_id").cast("long").alias("component_id"),
                      (F.col("vec_id") == F.col("component_id")).alias("kept"))


def _attach(rows: DataFrame, per_group: DataFrame, key: str, hot_copies: int, max_hot: int, groups: DataFrame) -> DataFrame:
    """Each row with its group's values: groups of many copies by a broadcast (at most ``max_hot`` rows), the rest by shuffle."""
    limit = max(hot_copies, -(-rows.count() // max_hot))
    hot = groups.where(F.col("m") > limit).select(key)
    hot_values = F.broadcast(per_group.join(F.broadcast(hot), key))
    by_broadcast = rows.join(hot_values, key)
    rest = rows.join(F.broadcast(hot), key, "left_anti").join(per_group, key)
    return by_broadcast.unionByName(rest).drop(key)
