"""SimHash near-duplicates by a self-join of binary tries.

Fingerprints of 64 bits are cut into six parts. Two fingerprints that differ in at most four bits agree in two whole parts,
so for each of the 15 pairs of parts a binary trie starts with the bits of that pair: node pairs that leave an
exact prefix are pruned at once. Inside such a unit node pairs are traversed together from the root of the rest: the
differing bits add up, pairs beyond the budget are dropped, pairs that cannot exceed it are taken whole.
A unit with more fingerprints than a task should hold is cut into its child node pairs by Spark, four bits at a time.
Links are reduced to spanning forests inside tasks and joined into components by rounds of joins.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.llm.common import batches, landed, shielded, texts_of

SHINGLE = 4
MAX_BITS = 4
UNIT_ROWS = 4096
CHUNK_BYTES = 8 << 20
#: Parts of the fingerprint, highest bits first.
CUTS = (0, 11, 22, 33, 43, 54, 64)


def fingerprint_of(text: str, size: int = SHINGLE) -> int:
    """Majority bits of the XXH64 (seed 42) hashes of all word shingles, repeats included; 0 without words."""
    import xxhash

    words = text.encode().lower().split()  # bytes: only A-Z change, only the six ASCII blanks split
    if not words:
        return 0
    if len(words) <= size:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    flat = b" ".join(words)
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], stops[:-1] + 1])
    digest = xxhash.xxh64_digest
    raw = b"".join([digest(flat[a:b], 42) for a, b in zip(starts[:len(words) - size + 1].tolist(), stops[size - 1:].tolist())])
    bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1)
    return int.from_bytes(np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(bits)).tobytes(), "big")


def with_fingerprints(docs: DataFrame, text_col: str = "text", size: int = SHINGLE, out: str = "__fp") -> DataFrame:
    """``docs`` with the fingerprint as a signed 64-bit number; a null text is empty."""
    from pyspark.sql import types as T

    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.LongType())])
    text_at, names = docs.columns.index(text_col), schema.names

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(source, text_col, CHUNK_BYTES):
            fp = np.array([fingerprint_of(t, size) for t in texts_of(part.column(text_at))], np.uint64).view(np.int64)
            yield from pa.Table.from_arrays([*part.columns, pa.array(fp)], names).combine_chunks().to_batches()

    return docs.mapInArrow(run, schema)


def _bits_moved(fp: F.Column, first: tuple[int, int]) -> F.Column:
    """The fingerprint with the two named parts in front."""
    spans = [(CUTS[i], CUTS[i + 1]) for i in (*first, *[i for i in range(6) if i not in first])]
    out, at = F.lit(0).cast("long"), 0
    for a, b in spans:
        part = F.shiftrightunsigned(F.shiftleft(fp, a), 64 - (b - a))
        out = out.bitwiseOR(F.shiftleft(part, 64 - at - (b - a)))
        at += b - a
    return out


def units(fps: DataFrame) -> DataFrame:
    """15 rows a fingerprint: (unit, side, fp, moved, depth, diff). A unit is one exact prefix of one trie."""
    rows = []
    for k, pair in enumerate(combinations(range(6), 2)):
        depth = sum(CUTS[i + 1] - CUTS[i] for i in pair)
        moved = _bits_moved(F.col("fp"), pair)
        rows.append(F.struct(
            F.shiftleft(F.shiftrightunsigned(moved, 64 - depth), 8).bitwiseOR(F.lit(k).cast("long")).alias("unit"), F.lit(0).cast("byte").alias("side"), F.col("fp").alias("fp"),
            moved.alias("moved"), F.lit(depth).cast("byte").alias("depth"), F.lit(0).cast("byte").alias("diff")))
    return fps.select(F.explode(F.array(*rows)).alias("u")).select("u.*")


def split_units(rows: DataFrame) -> DataFrame:
    """Cut each unit (side 0: with itself; 1 and 2: across) into the node pairs four bits further down."""
    mine = F.expr("cast(shiftrightunsigned(moved, 60 - depth) & 15 as int)")
    to = F.explode(F.sequence(F.lit(0), F.lit(15))).alias("other")
    wide = rows.select("*", mine.alias("mine"), to)
    a = F.when(F.col("side") == 0, F.least("mine", "other")).when(F.col("side") == 1, F.col("mine")).otherwise(F.col("other"))
    b = F.when(F.col("side") == 0, F.greatest("mine", "other")).when(F.col("side") == 1, F.col("other")).otherwise(F.col("mine"))
    side = F.when(F.col("side") != 0, F.col("side")).when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1).otherwise(2)
    diff = F.col("diff") + F.bit_count(F.col("mine").bitwiseXOR(F.col("other")))
    # The path of a unit is hashed: equal hashes of two units would only add comparisons, never links beyond the budget.
    cut = wide.select(F.xxhash64("unit", a, b, F.lit("split")).alias("unit"), side.cast("byte").alias("side"), "fp", "moved", (F.col("depth") + 4).cast("byte").alias("depth"), diff.cast("byte").alias("diff"))
    return cut.where(F.col("diff") <= MAX_BITS)


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def trie_links(order: np.ndarray, starts: np.ndarray, stops: np.ndarray, other: np.ndarray, others: np.ndarray, depth: np.ndarray, diff: np.ndarray,
               left: np.ndarray, right: np.ndarray, budget: int = MAX_BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Traverse node pairs ([starts, stops) of ``left``, [other, others) of ``right``; both sorted inside a node) from their
    depth downwards. Yields links as places in ``left`` and ``right``; ``order`` is true for pairs of a node with itself."""
    todo = [(order, starts, stops, other, others, depth, diff)]
    while todo:
        same, a0, a1, b0, b1, d, err = todo.pop()
        if len(a0) > 200_000:
            half = len(a0) // 2
            todo += [tuple(x[:half] for x in (same, a0, a1, b0, b1, d, err)), tuple(x[half:] for x in (same, a0, a1, b0, b1, d, err))]
            continue
        keep = np.where(same, a1 - a0 > 1, (a1 > a0) & (b1 > b0))
        same, a0, a1, b0, b1, d, err = (x[keep] for x in (same, a0, a1, b0, b1, d, err))
        if not len(a0):
            continue
        # Whole node pairs that cannot exceed the budget: one link a member keeps them connected.
        whole = err + 64 - d <= budget
        for i in np.flatnonzero(whole).tolist():
            if same[i]:
                yield np.full(a1[i] - a0[i] - 1, a0[i]), np.arange(a0[i] + 1, a1[i])
            else:
                yield np.arange(a0[i], a1[i]), np.full(a1[i] - a0[i], b0[i])
                yield np.full(b1[i] - b0[i], a0[i]), np.arange(b0[i], b1[i])
        # Small node pairs are leaf pages: their fingerprints are compared at once.
        area = (a1 - a0) * (b1 - b0)
        page = ~whole & (area <= 64)
        if page.any():
            n = area[page]
            at = np.repeat(np.flatnonzero(page), n)
            k = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
            wide = (b1 - b0)[at]
            i, j = a0[at] + k // wide, b0[at] + k % wide
            ok = (popcount(left[i] ^ right[j]) <= budget) & (~same[at] | (i < j))
            yield i[ok], j[ok]
        rest = ~whole & ~page
        same, a0, a1, b0, b1, d, err = (x[rest] for x in (same, a0, a1, b0, b1, d, err))
        if not len(a0):
            continue
        am, bm = _middle(left, a0, a1, d), _middle(right, b0, b1, d)
        nxt = []
        for same2, x, y, e in ((same, (a0, am), (b0, bm), 0), (same, (am, a1), (bm, b1), 0), (np.zeros(len(a0), bool), (a0, am), (bm, b1), 1), (np.zeros(len(a0), bool), (am, a1), (b0, bm), 1)):
            part = [same2, x[0], x[1], y[0], y[1], d + 1, err + e]
            take = part[6] <= budget
            if x[0] is am and y[0] is b0:
                take = take & ~same  # a node with itself meets its two halves once
            nxt.append([v[take] for v in part])
        todo.append(tuple(np.concatenate([p[k] for p in nxt]) for k in range(7)))


def _middle(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """First place in each sorted node whose bit at ``depth`` is 1."""
    lo, hi = lo.copy(), hi.copy()
    shift = (63 - depth).astype(np.uint64)
    while True:
        live = np.flatnonzero(lo < hi)
        if not len(live):
            return lo
        mid = (lo[live] + hi[live]) // 2
        one = (values[mid] >> shift[live]) & np.uint64(1) == 1
        hi[live[one]] = mid[one]
        lo[live[~one]] = mid[~one] + 1


def forest(a: np.ndarray, b: np.ndarray, n: int, parent: np.ndarray) -> np.ndarray:
    """Places of those links that join two parts not joined before; ``parent`` is kept up to date."""
    used = []
    for k, (i, j) in enumerate(zip(a.tolist(), b.tolist())):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        while parent[j] != j:
            parent[j] = parent[parent[j]]
            j = parent[j]
        if i != j:
            parent[max(i, j)] = min(i, j)
            used.append(k)
    return np.array(used, np.int64)


def join_units(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links inside the units of a partition sorted by (unit, side, moved), as a spanning forest of each run of units."""
    names = ["unit", "side", "fp", "moved", "depth", "diff"]
    held: list[pa.Table] = []

    def work(data: pa.Table):
        unit, side, fp, moved, depth, diff = [data[c].combine_chunks().to_numpy(zero_copy_only=False) for c in names]
        moved, fp = moved.view(np.uint64), fp.astype(np.int64)
        new = np.flatnonzero(np.concatenate([[True], (unit[1:] != unit[:-1]) | (side[1:] != side[:-1])]))
        ends = np.concatenate([new[1:], [len(unit)]])
        own = np.flatnonzero((side[new] == 0) & (ends - new > 1))
        nxt = np.minimum(np.arange(len(new)) + 1, len(new) - 1)
        cross = np.flatnonzero((side[new] == 1) & (side[new[nxt]] == 2) & (unit[new] == unit[new[nxt]]))
        one, two = np.concatenate([own, cross]), np.concatenate([own, nxt[cross]])
        if not len(one):
            return
        same = np.arange(len(one)) < len(own)
        values, where = np.unique(fp, return_inverse=True)
        parent = list(range(len(values)))
        got = []
        for i, j in trie_links(same, new[one], ends[one], new[two], ends[two], depth[new[one]].astype(np.int64), diff[new[one]].astype(np.int64), moved, moved):
            a, b = where[i], where[j]
            if len(a):
                link = np.unique(np.minimum(a, b) * len(values) + np.maximum(a, b))
                a, b = link // len(values), link % len(values)
                use = forest(a, b, len(values), parent)
                if len(use):
                    got.append((values[a[use]], values[b[use]]))
        if got:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([g[0] for g in got])), pa.array(np.concatenate([g[1] for g in got]))], ["a", "b"])

    rows = 0
    for batch in source:
        if not batch.num_rows:
            continue
        held.append(pa.Table.from_batches([batch]))
        rows += batch.num_rows
        if rows >= 200_000:
            data = pa.concat_tables(held)
            unit = data["unit"].to_numpy()
            cut = int(np.searchsorted(unit != unit[-1], False)) if unit[0] != unit[-1] else 0
            # Units before the last one are complete.
            cut = int(np.flatnonzero(unit != unit[-1])[-1]) + 1 if cut or unit[0] != unit[-1] else 0
            if cut:
                yield from work(data.slice(0, cut))
                held, rows = [data.slice(cut)], len(unit) - cut
    if held:
        yield from work(pa.concat_tables(held))


def links(fps: DataFrame, unit_rows: int = UNIT_ROWS) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints ``fp`` within the bit budget."""
    rows = units(fps)
    out = None
    while True:
        big = rows.groupBy("unit").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > unit_rows).select("unit")
        # Few units can be large: each holds over ``unit_rows`` rows; they are joined by shuffle all the same.
        if big.isEmpty():
            small, rows = rows, None
        else:
            small = rows.join(big, "unit", "left_anti")
            rows = landed(split_units(rows.join(big, "unit", "left_semi").where("depth <= 60")))
        ready = small.repartition("unit").sortWithinPartitions("unit", "side", "moved")
        part = ready.mapInArrow(join_units, "a long, b long")
        out = part if out is None else out.union(part)
        if rows is None:
            return out


def components(edges: DataFrame) -> DataFrame:
    """(fp, root) of every linked fingerprint: rounds of pointing nodes to the least neighbour, each round landed.

    Large star then small star; a round pre-aggregates per node, so a hub costs one row a task.
    """
    # Equal tables have equal row counts and sums of row hashes; both halves of the hash are summed apart.
    h = F.xxhash64("u", "v")
    mark = [F.count(F.lit(1)), F.sum(F.shiftright(h, 32)), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF)))]
    now, seen = landed(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()), None
    while True:
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        star = large.join(down, "u")
        small = star.select("v", "m").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        nxt = landed(down.select("u", F.col("m").alias("v")).union(small).distinct())
        before, seen = seen, tuple(nxt.agg(*mark).first())
        now = nxt
        if seen == before:
            return now.select(F.col("u").alias("fp"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, fp, component_id (least id reachable through links of at most four bits).

    Texts without words, null ones too, have fingerprint 0 and are linked like any other. Repeated ids stay as rows;
    a null id never names a component unless all its members are null. Other columns are ignored.
    """
    marked = landed(with_fingerprints(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))).select("doc_id", F.col("__fp").alias("fp")))
    classes = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    joined = components(links(classes.select("fp")))
    named = classes.join(joined, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(named.join(least, "root").select("fp", "component_id"), "fp", "left")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: least id, then least place in the landed table; null ids last. Columns stay as they are
    (also columns named like the helper columns)."""
    docs, back = shielded(docs)
    names = docs.columns
    marked = landed(with_fingerprints(docs.withColumn("__row", F.monotonically_increasing_id()), text_col))
    # Ids are compared as numbers; a row without one comes after all others.
    keys = marked.select("__row", "__fp", F.col(id_col).cast("long").alias("__id"))
    classes = keys.select(F.col("__fp").alias("fp")).distinct()
    joined = components(links(classes))
    rooted = keys.join(joined, keys["__fp"] == joined["fp"], "left").select("__row", "__id", F.coalesce("root", "__fp").alias("root"))
    first = F.struct(F.col("__id").isNull().alias("late"), F.col("__id").alias("id"), F.col("__row").alias("row"))
    kept = rooted.groupBy("root").agg(F.min(first).alias("first")).select(F.col("first.row").alias("__row"))
    return back(marked.join(kept, "__row", "left_semi").select(*[F.col(f"`{n}`") for n in names]))
