"""Prefix trie of conversations, with rollups over each node's subtree.

Every conversation is rebuilt first: the first ``h`` turns of the group's first conversation (``c - c % 20``), then its own
turns after its first ``h``, with ``h = crc32(decimal c) % 4``. Each distinct sequence of the first ``d`` rebuilt turns is a
node of depth ``d``; the root (``d = 0``) holds every conversation.

Plan (all Spark; no group larger than one conversation, one node's aggregate or a bounded join key):

* membership rows: one per rebuilt conversation and depth. A node's key is the exact sum of two 64-bit hashes of
  (place, role, text) over its turns, as two decimals: equal prefixes have equal keys, and two different prefixes share
  both sums with a chance of about 2^-128 per pair. A parent's key is its child's key less the last turn's hashes.
* nodes: one aggregate of membership rows by key (partial aggregation, so a node held by a third of all conversations
  costs one row a task).
* subtree rollups (``n_leaves``, ``saved_tokens``): each node is represented by its smallest member. Along every
  conversation's own path, the values of the nodes it represents are summed from the bottom up (a window over one
  conversation); a node's subtree total is the sum of these path totals over its members at its depth, because every
  node below it is represented by exactly one conversation that passes through it.
* parents: a child joins its parent by key; parents with more children than one task should take are joined by a
  broadcast of a table whose size is bounded by the node count over that limit.
* ends digest: conversations ending at a node, streamed in (node, conv_id) order through one SHA-256 per node.

Defined cases: rows with a null conv_id belong to no conversation; null role or text is empty; turns are ordered by
turn (null first), then role, then text, and repeated rows are separate turns; an empty table gives no rows; other
columns are not read, so clashing names do not matter; very long texts are hashed and counted by the JVM only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorelake.llm.common import landed

# Fixed values of the contract.
GROUP = 20
SHARED_MOD = 4
WORDS = r"[^\x20\x09-\x0D]+"
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()

#: Children of one parent that one task joins by shuffle; parents with more are joined by broadcast.
HOT_CHILDREN = 100_000
#: Most rows of that broadcast; the per-task limit rises with the node count to keep it.
MAX_HOT = 200_000

TWO_64 = 18446744073709551616


def _unsigned(h: F.Column) -> F.Column:
    d = h.cast("decimal(20,0)")
    return F.when(h < 0, d + F.expr(f"CAST('{TWO_64}' AS DECIMAL(20,0))")).otherwise(d)


def rebuilt(convs: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
            group: int = GROUP, shared_mod: int = SHARED_MOD) -> DataFrame:
    """(conv_id, pos, role, text): the rebuilt turns of every conversation, ``pos`` from 0. A conversation whose rebuilt turns
    are none has no row here (see :func:`conversation_ids`)."""
    turns = convs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("c"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    order = Window.partitionBy("c").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    turns = turns.select("c", (F.row_number().over(order) - 1).alias("pos"), "role", "text")
    ids = conversation_ids(convs, id_col, group, shared_mod)
    base = turns.select(F.col("c").alias("b"), "pos", "role", "text")
    # At most ``shared_mod - 1`` turns of the group's first conversation go to each of at most ``group`` conversations.
    prefix = ids.join(base, (base["b"] == ids["b"]) & (base["pos"] < ids["h"])).select("c", "pos", "role", "text")
    taken = prefix.groupBy("c").agg(F.count(F.lit(1)).alias("m"))
    own = turns.join(ids.select("c", "h"), "c").where(F.col("pos") >= F.col("h")).join(taken, "c", "left")
    own = own.select("c", (F.coalesce("m", F.lit(0)) + F.col("pos") - F.col("h")).alias("pos"), "role", "text")
    return prefix.unionByName(own).withColumnRenamed("c", "conv_id")


def conversation_ids(convs: DataFrame, id_col: str = "conv_id", group: int = GROUP, shared_mod: int = SHARED_MOD) -> DataFrame:
    """(c, b, h): every distinct conversation id, its group's first id and its shared turn count."""
    c = F.col(id_col).cast("long")
    ids = convs.where(c.isNotNull()).select(c.alias("c")).distinct()
    return ids.select("c", (F.col("c") - F.col("c") % group).alias("b"), (F.crc32(F.col("c").cast("string").cast("binary")) % shared_mod).alias("h"))


def membership(convs: DataFrame, **names) -> DataFrame:
    """(c, depth, k1, k2, p1, p2, words, is_end): one row per rebuilt conversation and depth 0 .. its length."""
    turns = rebuilt(convs, **names)
    ids = conversation_ids(convs, names.get("id_col", "conv_id"))
    h1 = _unsigned(F.xxhash64(F.lit("trie-a"), "pos", "role", "text"))
    h2 = _unsigned(F.xxhash64(F.lit("trie-b"), "pos", "role", "text"))
    path = Window.partitionBy("c").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("c")
    rows = turns.select(F.col("conv_id").alias("c"), "pos", "text", h1.alias("h1"), h2.alias("h2"))
    rows = rows.select("c", (F.col("pos") + 1).alias("depth"), F.sum("h1").over(path).alias("k1"), F.sum("h2").over(path).alias("k2"), "h1", "h2",
                       F.regexp_count("text", F.lit(WORDS)).cast("long").alias("words"), F.count(F.lit(1)).over(whole).alias("n"))
    key = "decimal(38,0)"
    deep = rows.select("c", "depth", F.col("k1").cast(key).alias("k1"), F.col("k2").cast(key).alias("k2"),
                       (F.col("k1") - F.col("h1")).cast(key).alias("p1"), (F.col("k2") - F.col("h2")).cast(key).alias("p2"),
                       "words", (F.col("depth") == F.col("n")).alias("is_end"))
    lengths = turns.groupBy(F.col("conv_id").alias("c")).agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast(key)
    root = ids.join(lengths, "c", "left").select("c", F.lit(0).cast("long").alias("depth"), zero.alias("k1"), zero.alias("k2"),
                                                F.lit(None).cast(key).alias("p1"), F.lit(None).cast(key).alias("p2"),
                                                F.lit(0).cast("long").alias("words"), F.col("n").isNull().alias("is_end"))
    return deep.unionByName(root)


def _digests(ends: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256) of nodes where conversations end: their ids ascending, comma-joined, streamed through SHA-256."""
    keyed = ends.select(F.concat_ws(":", "depth", "k1", "k2").alias("node"), "c")

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest, first = None, None, True
        out_nodes, out_hex = [], []
        for batch in source:
            for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k != node:
                    if node is not None:
                        out_nodes.append(node)
                        out_hex.append(digest.hexdigest())
                    node, digest, first = k, hashlib.sha256(), True
                digest.update(str(c).encode() if first else b"," + str(c).encode())
                first = False
            if len(out_nodes) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(out_nodes, pa.string()), pa.array(out_hex, pa.string())], ["node", "ends_sha256"])
                out_nodes, out_hex = [], []
        if node is not None:
            out_nodes.append(node)
            out_hex.append(digest.hexdigest())
        if out_nodes:
            yield pa.RecordBatch.from_arrays([pa.array(out_nodes, pa.string()), pa.array(out_hex, pa.string())], ["node", "ends_sha256"])

    ordered = keyed.repartition("node").sortWithinPartitions("node", "c")
    return ordered.mapInArrow(run, "node string, ends_sha256 string")


def _with_parents(nodes: DataFrame, hot_children: int, max_hot: int) -> DataFrame:
    """``nodes`` with parent_conv_id: hot parents by a broadcast of bounded size, the rest by a shuffle join on the key."""
    parents = nodes.select(F.col("depth").alias("pd"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    counts = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("pd"), "p1", "p2").agg(F.count(F.lit(1)).alias("n_children"))
    limit = max(hot_children, -(-nodes.count() // max_hot))
    hot = counts.where(F.col("n_children") > limit).select("pd", "p1", "p2")
    # At most nodes / limit <= max_hot rows, each a few numbers.
    hot_parents = F.broadcast(parents.join(F.broadcast(hot), ["pd", "p1", "p2"]))
    child = nodes.withColumn("pd", F.col("depth") - 1)
    by_broadcast = child.join(hot_parents, ["pd", "p1", "p2"])
    rest = child.join(F.broadcast(hot), ["pd", "p1", "p2"], "left_anti").join(parents, ["pd", "p1", "p2"], "left")
    named = by_broadcast.unionByName(rest).drop("pd")
    mine = counts.select(F.col("pd").alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"), "n_children")
    return named.join(mine, ["depth", "k1", "k2"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))


def trie(convs: DataFrame, hot_children: int = HOT_CHILDREN, max_hot: int = MAX_HOT, **names) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 (see module)."""
    member = landed(membership(convs, **names))
    nodes = member.groupBy("depth", "k1", "k2").agg(
        F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.first("p1").alias("p1"), F.first("p2").alias("p2"),
        F.max("words").alias("words"))
    nodes = landed(_with_parents(landed(nodes), hot_children, max_hot))
    # Rollups along each conversation's own path: values of the nodes it represents, summed from the bottom up.
    reps = nodes.select(F.col("conv_id").alias("c"), "depth", ((F.col("n_convs") - 1) * F.col("words")).alias("w"),
                        (F.col("n_children") == 0).cast("long").alias("leaf"))
    up = Window.partitionBy("c").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    paths = member.select("c", "depth", "k1", "k2").join(reps, ["c", "depth"], "left").select(
        "depth", "k1", "k2", F.sum(F.coalesce("w", F.lit(0))).over(up).alias("sw"), F.sum(F.coalesce("leaf", F.lit(0))).over(up).alias("sl"))
    rolled = paths.groupBy("depth", "k1", "k2").agg(F.sum("sw").cast("long").alias("saved_tokens"), F.sum("sl").cast("long").alias("n_leaves"))
    digests = _digests(member.where("is_end").select("depth", "k1", "k2", "c"))
    out = nodes.join(rolled, ["depth", "k1", "k2"]).withColumn("node", F.concat_ws(":", "depth", "k1", "k2")).join(digests, "node", "left")
    return out.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", F.col("n_convs").cast("long").alias("n_convs"),
                      "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"))
