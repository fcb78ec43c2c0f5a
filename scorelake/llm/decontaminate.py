"""Benchmark decontamination with suffix arrays of the training text.

The training table is read in shards of whole documents. For each shard a suffix array orders the suffixes of its text;
every suffix of every benchmark item is binary-searched in it, which gives the longest verbatim match, its place, and
for matches of a window's length the range of all places. Words that no benchmark item has cannot be part of a match, so
only runs of benchmark words that are as long as the shortest window enter the array; no match is lost.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorelake.llm.common import Shipped, batches, texts_of, shielded

WINDOW = 13
SHARD_BYTES = 8 << 20
BENCHMARK_BYTES = 16 << 20
WORD_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    """Lower-case A-Z, then words of digits, letters a-z and characters from U+0080 on."""
    return text.encode().translate(WORD_TABLE).split()


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes ordered by their first ``depth`` numbers at least, by prefix doubling."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64) + 1
    step = 1
    while True:
        nxt = np.zeros(n, np.int64)
        nxt[:max(0, n - step)] = rank[step:]
        key = rank * (n + 2) + nxt
        order = np.argsort(key, kind="stable")
        step *= 2
        sorted_key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])]) + 1
        if step >= depth or rank.max(initial=0) == n:
            return order


class TestSuffixes:
    """Suffixes and windows of one block of benchmark items."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.words: dict[bytes, int] = {}
        self.names = sorted({name for name, _ in items})
        at = {name: k for k, name in enumerate(self.names)}
        rows: dict[tuple[int, ...], set[int]] = {}
        for name, text in items:
            ids = tuple(self.words.setdefault(w, len(self.words) + 1) for w in words_of(text))
            if ids:
                rows.setdefault(ids, set()).add(at[name])
        self.depth = max(map(len, rows), default=0)
        suffixes: dict[tuple[int, ...], int] = {}
        need: dict[tuple[int, ...], set[int]] = {}
        for ids, who in rows.items():
            size = min(window, len(ids))
            for k in range(len(ids)):
                suffixes.setdefault(ids[k:], len(suffixes))
                if k + size <= len(ids):
                    need.setdefault(ids[k:k + size], set()).update(who)
        self.shortest = min(map(len, need), default=0)
        self.suffixes = self._grid(list(suffixes), self.depth)
        self.windows = self._grid(list(need), max(map(len, need), default=0))
        self.sizes = np.array([len(w) for w in need], np.int64)
        self.owners = [np.array(sorted(w), np.int64) for w in need.values()]

    @staticmethod
    def _grid(rows, width) -> np.ndarray:
        out = np.zeros((len(rows), width), np.int32)
        for i, r in enumerate(rows):
            out[i, :len(r)] = r
        return out


def search(text: np.ndarray, order: np.ndarray, rows: np.ndarray, after: bool) -> np.ndarray:
    """Binary search of each row (0 ends it) in the suffix array: the first suffix not below it, or with ``after`` the
    first beyond all that start with it."""
    width = rows.shape[1]
    lengths = (rows > 0).sum(1)
    padded = np.concatenate([text, np.zeros(width, text.dtype)])
    lo, hi = np.zeros(len(rows), np.int64), np.full(len(rows), len(order), np.int64)
    span = np.arange(width)
    while True:
        live = np.flatnonzero(lo < hi)
        if not len(live):
            return lo
        mid = (lo[live] + hi[live]) // 2
        seen = padded[order[mid][:, None] + span]
        want = rows[live]
        differ = (seen != want) & (span < lengths[live][:, None])
        first = differ.argmax(1)
        some = differ.any(1)
        pick = np.arange(len(live))
        less = np.where(some, seen[pick, first] < want[pick, first], after)
        lo[live[less]] = mid[less] + 1
        hi[live[~less]] = mid[~less]


def common_length(text: np.ndarray, order: np.ndarray, at: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Words shared by each row and the suffix at array place ``at`` (out of range: none)."""
    width = rows.shape[1]
    ok = (at >= 0) & (at < len(order))
    padded = np.concatenate([text, np.zeros(width, text.dtype)])
    seen = padded[order[np.clip(at, 0, len(order) - 1)][:, None] + np.arange(width)]
    same = np.cumprod((seen == rows) & (rows > 0), axis=1).sum(1)
    return np.where(ok, same, 0)


def match_shard(texts: list[str], bench: TestSuffixes) -> tuple[list[int], list[list[int]], list[list[int]], np.ndarray]:
    """For each text: number of words, hit intervals (flat start, stop word places), items found, and its longest match
    (words, place of its first word)."""
    n_words, starts, pieces, where = [], [], [], []
    get = bench.words.get
    for d, t in enumerate(texts):
        words = words_of(t)
        n_words.append(len(words))
        if len(words) < bench.shortest or not bench.shortest:
            continue
        ids = np.fromiter(map(get, words, repeat(0)), np.int32, len(words))
        edge = np.flatnonzero(np.diff(np.concatenate([[False], ids > 0, [False]]).view(np.int8)))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if b - a >= bench.shortest:
                pieces.append(ids[a:b])
                where.append((d, a, b - a))
    hits: list[list[int]] = [[] for _ in texts]
    found: list[list[int]] = [[] for _ in texts]
    best = np.zeros((len(texts), 2), np.int64)
    if not pieces:
        return n_words, hits, found, best
    doc, begin, size = np.array(where, np.int64).T
    offset = np.cumsum(size + 1) - size - 1
    text = np.zeros(int(offset[-1] + size[-1] + 1), np.int32)
    for o, p in zip(offset.tolist(), pieces):
        text[o:o + len(p)] = p
    order = suffix_array(text, bench.depth)
    low = search(text, order, bench.suffixes, False)
    at = np.concatenate([low - 1, low])
    longest = common_length(text, order, at, np.concatenate([bench.suffixes, bench.suffixes]))
    some = np.flatnonzero(longest)
    place = order[at[some]]
    run = np.searchsorted(offset, place, side="right") - 1
    for k in np.argsort(longest[some], kind="stable").tolist():
        best[doc[run[k]]] = longest[some[k]], begin[run[k]] + place[k] - offset[run[k]]
    lo, hi = search(text, order, bench.windows, False), search(text, order, bench.windows, True)
    mark = np.zeros(len(text) + 1, np.int64)
    pairs = []
    for w in np.flatnonzero(hi > lo).tolist():
        places = order[lo[w]:hi[w]]
        mark[places] += 1
        np.subtract.at(mark, places + bench.sizes[w], 1)
        docs = np.unique(doc[np.searchsorted(offset, places, side="right") - 1])
        for item in bench.owners[w].tolist():
            pairs.append(np.stack([docs, np.full(len(docs), item)]))
    if pairs:
        for d, item in np.unique(np.concatenate(pairs, axis=1), axis=1).T.tolist():
            found[d].append(item)
        inside = np.concatenate([[False], np.cumsum(mark)[:-1] > 0, [False]]).view(np.int8)
        edge = np.flatnonzero(np.diff(inside))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            k = int(np.searchsorted(offset, a, side="right")) - 1
            hits[doc[k]] += [int(begin[k] + a - offset[k]), int(begin[k] + b - offset[k])]
    return n_words, hits, found, best


def merged(a: list[int], b: list[int]) -> list[int]:
    """Union of two flat interval lists."""
    out: list[int] = []
    for s, e in sorted([*zip(a[::2], a[1::2]), *zip(b[::2], b[1::2])]):
        if out and s <= out[-1]:
            out[-1] = max(out[-1], e)
        else:
            out += [s, e]
    return out


STATE = [("__n_words", T.LongType()), ("__hits", T.ArrayType(T.LongType())), ("__items", T.ArrayType(T.StringType())),
         ("__longest", T.LongType()), ("__longest_at", T.LongType())]
KINDS = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.int64(), pa.int64()]


def match_items(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                window: int = WINDOW, block_bytes: int = BENCHMARK_BYTES) -> DataFrame:
    """``docs`` with ``__n_words``, ``__hits`` (flat start, stop word places inside occurring windows), ``__items`` (ids of items
    with such windows), ``__longest`` and ``__longest_at`` (the longest verbatim match found and its first word).

    The benchmark's bytes are measured first; each block of at most about ``block_bytes`` is broadcast in turn, and a later
    block adds to what earlier ones found. Null texts have no words; a null item id counts as the empty text; rows repeating an item
    id count as one item; an empty benchmark finds nothing. Columns of any other name stay as they are.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text") + F.octet_length("item"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    out = docs
    for b in range(blocks):
        rows = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b)
        out = _match_block(out, Shipped(spark, TestSuffixes([(r["item"], r["text"]) for r in rows.collect()], window)), text_col, b == 0)
    return out


def _match_block(docs: DataFrame, bench, text_col: str, first: bool) -> DataFrame:
    kept = [f for f in docs.schema.fields if f.name not in dict(STATE)] if not first else docs.schema.fields
    schema = T.StructType([*kept, *[T.StructField(n, k) for n, k in STATE]])
    names, text_at, width = schema.names, [f.name for f in kept].index(text_col), len(kept)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = bench.value
        for part in batches(source, text_col, SHARD_BYTES):
            n, hits, found, best = match_shard(texts_of(part.column(text_at)), t)
            found = [[t.names[i] for i in row] for row in found]
            longest, place = best[:, 0].tolist(), best[:, 1].tolist()
            if not first:
                old = [part.column(width + k).to_pylist() for k in range(5)]
                hits = [merged(a, b) for a, b in zip(old[1], hits)]
                found = [sorted({*a, *b}) for a, b in zip(old[2], found)]
                place = [p if m > o else q for m, o, p, q in zip(longest, old[3], place, old[4])]
                longest = [max(m, o) for m, o in zip(longest, old[3])]
            cols = [part.column(k) for k in range(width)] + [pa.array(v, k) for v, k in zip((n, hits, found, longest, place), KINDS)]
            yield from pa.Table.from_arrays(cols, names).combine_chunks().to_batches()

    return docs.mapInArrow(run, schema)


def hit_words() -> F.Column:
    at = F.sequence(F.lit(0), F.size("__hits") - 2, F.lit(2))
    gaps = F.transform(at, lambda i: F.element_at("__hits", (i + 2).cast("int")) - F.element_at("__hits", (i + 1).cast("int")))
    return F.when(F.size("__hits") > 0, F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)).otherwise(F.lit(0).cast("long"))


def is_contaminated(share: int = 20) -> F.Column:
    """One word in ``share`` or more lies inside benchmark windows."""
    return (hit_words() > 0) & (share * hit_words() >= F.col("__n_words"))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document the counts, the digest of its items' ids sorted as strings, and the verdict."""
    got = match_items(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark)
    return got.select(
        "doc_id", F.col("__n_words").alias("n_words"), hit_words().alias("n_hit"), F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("__items"), ",").cast("binary"), 256).alias("items_sha256"), is_contaminated().alias("contaminated"),
        F.col("__longest").alias("longest_words"), F.col("__longest_at").alias("longest_at"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without contaminated rows, columns unchanged (also columns named like the helper columns)."""
    inner, back = shielded(docs)
    return back(match_items(inner, benchmark).where(~is_contaminated()).drop(*[n for n, _ in STATE]))


def digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
