"""Quality classifier by co-training.

Two views see different things: the text view counts hashed character trigrams, the page view has metadata (source, language, length) and
layout (lines, letter cases, signs, blanks, repetition). Each view is a logistic model trained in numpy. Round by round each scores an
unlabelled pool and hands its most confident rows to the other view as pseudo-labels. Both are then calibrated on labelled rows
kept aside, and a last logistic model over the two calibrated log odds gives the probability that a document is good.

Models are fitted on bounded samples (``FIT_ROWS`` labelled rows and ``POOL_ROWS`` others, least hashes of the id); scoring covers
every whole text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorelake.llm.common import Shipped, batches, shielded

FIT_ROWS, POOL_ROWS = 5000, 3000
ROUNDS, HANDED = 4, 300
REJECT_BELOW = 0.3
GRAMS = 2048
TEXT_SIZE = GRAMS + 14 * 20
#: Sizes of the one-hot groups of the page view.
GROUPS = (64, 16, 20, 12, 14, 9, 9, 9, 9 * 16)
CHUNK_BYTES = 4 << 20


def log_bucket(x, most: int):
    return np.minimum(most - 1, np.log2(np.maximum(x, 0) + 1).astype(np.int64))


def text_view(raw: bytes) -> np.ndarray:
    """Root frequencies of hashed trigrams, and one cell for how many different ones a text of this length has."""
    out = np.zeros(TEXT_SIZE, np.float32)
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    n = max(0, len(b) - 2)
    if n:
        h = ((b[:-2] * np.uint32(40503) + b[1:-1] * np.uint32(2654435) + b[2:] * np.uint32(97787)) * np.uint32(2654435761)) >> np.uint32(21)
        count = np.bincount(h, minlength=GRAMS)
        out[:GRAMS] = np.sqrt(count / n)
        out[GRAMS + int(log_bucket(np.count_nonzero(count) * 1.4, 14)) * 20 + int(log_bucket(n * 1.0, 20))] = 1
    return out


UPPER = np.array([65 <= b <= 90 for b in range(256)])
SIGN = np.array([33 <= b < 48 or 58 <= b < 65 or 91 <= b < 97 or 123 <= b < 127 for b in range(256)])
CODES = np.zeros(256, np.int64)
CODES[UPPER] = 1
CODES[SIGN] = 2
CODES[[9, 11, 12, 13, 32]] = 3
CODES[10] = 4


def page_view(raw: bytes, source: str | None, lang: str | None) -> np.ndarray:
    """Numbers of the set cells, one a group."""
    n = len(raw)
    kinds = np.bincount(CODES[np.frombuffer(raw, np.uint8)], minlength=5)
    lines = int(kinds[4]) + 1
    words = raw.split()
    share = lambda x: min(8, int(9 * (x / n) ** 0.5)) if n else 0
    cells = [zlib.crc32((source or "").encode()) % 64, zlib.crc32((lang or "").encode()) % 16, int(log_bucket(n, 20)), int(log_bucket(lines, 12)),
             int(log_bucket(n / lines, 14)), share(kinds[1]), share(kinds[2]), share(kinds[3]),
             (min(8, int(9 * len(set(words)) / len(words))) if words else 0) * 16 + int(log_bucket(len(words), 16))]
    return np.array(cells) + np.cumsum((0, *GROUPS[:-1]))


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, start: np.ndarray | None = None, steps: int = 150, rate: float = 0.1, penalty: float = 1e-4) -> np.ndarray:
    """Weights (the last is the constant) by Adam on the whole sample."""
    w = np.zeros(x.shape[1] + 1, np.float64) if start is None else start.copy()
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        d = (sigmoid(x @ w[:-1].astype(x.dtype) + w[-1]) - y) / max(1, len(y))
        g = np.concatenate([x.T @ d.astype(x.dtype), [d.sum()]]) + penalty * np.concatenate([w[:-1], [0]])
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w


class QualityModel:
    """Both views with their calibrations, and the weights that combine them."""

    def __init__(self):
        self.text, self.page = np.zeros(TEXT_SIZE + 1), np.zeros(sum(GROUPS) + 1)
        self.scale = [np.array([1.0, 0.0]), np.array([1.0, 0.0])]
        self.mix = np.array([0.5, 0.5, 0.0])

    def views(self, raw: bytes, source, lang) -> tuple[float, float]:
        """Log odds of the two views."""
        return float(text_view(raw) @ self.text[:-1] + self.text[-1]), float(self.page[:-1][page_view(raw, source, lang)].sum() + self.page[-1])

    def combine(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        z = [s[0] * v + s[1] for s, v in zip(self.scale, (np.asarray(a), np.asarray(b)))]
        return sigmoid(self.mix[0] * z[0] + self.mix[1] * z[1] + self.mix[2])

    def fit(self, text: np.ndarray, page: np.ndarray, labels: np.ndarray) -> QualityModel:
        """Rows of both views; ``labels`` -1 marks the pool. A third of the labelled rows only calibrates."""
        labelled = np.flatnonzero(labels >= 0)
        if len(labelled) < 2 or len(set(labels[labelled])) < 2:
            # Nothing to learn from: every document keeps the share of good ones.
            share = labels[labelled].mean() if len(labelled) else 1.0
            self.mix = np.array([0.0, 0.0, float(np.log((share + 1e-3) / (1 - share + 1e-3)))])
            return self
        aside = labelled[2::3] if len(labelled) >= 30 else labelled
        train = np.setdiff1d(labelled, aside) if len(labelled) >= 30 else labelled
        pool = np.flatnonzero(labels < 0)
        views = (text, page)
        sets = [(train, labels[train]), (train, labels[train])]
        given = [np.zeros(len(labels), bool), np.zeros(len(labels), bool)]
        weights: list = [None, None]
        share = labels[train].mean()
        for turn in range(ROUNDS + 1):
            for k in (0, 1):
                weights[k] = logistic(views[k][sets[k][0]], sets[k][1], weights[k], 150 if turn == 0 else 50)
            if turn == ROUNDS:
                break
            for k in (0, 1):
                free = pool[~given[1 - k][pool]]
                if not len(free):
                    continue
                p = sigmoid(views[k][free] @ weights[k][:-1].astype(views[k].dtype) + weights[k][-1])
                order = np.argsort(p, kind="stable")
                bad, good = order[:max(1, round(HANDED * (1 - share)))], order[::-1][:max(1, round(HANDED * share))]
                bad, good = bad[p[bad] < 0.05], good[p[good] > 0.95]
                new = np.concatenate([free[bad], free[good]])
                given[1 - k][new] = True
                sets[1 - k] = (np.concatenate([sets[1 - k][0], new]), np.concatenate([sets[1 - k][1], np.zeros(len(bad)), np.ones(len(good))]))
        self.text, self.page = weights
        odds = [v[aside] @ w[:-1].astype(v.dtype) + w[-1] for v, w in zip(views, weights)]
        self.scale = [logistic(np.asarray(o, np.float64)[:, None], labels[aside], steps=300) for o in odds]
        z = np.stack([s[0] * o + s[1] for s, o in zip(self.scale, odds)], 1)
        self.mix = logistic(z, labels[aside], np.array([0.5, 0.5, 0.0]), steps=300)
        return self


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, pool_rows: int = POOL_ROWS) -> QualityModel:
    """Fit on the documents whose labelled ids have the least hashes, and a pool of others. Ids with two labels or none are not used;
    an id on several document rows is fitted on its least row."""
    spark = docs.sparkSession
    ids = F.col("doc_id").cast("long")
    known = labels.select(ids.alias("id"), F.col("quality").cast("int").alias("y")).where("id IS NOT NULL AND y IN (0, 1)")
    known = known.groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("most")).where("y = most").select("id", "y")
    first = known.orderBy(F.xxhash64("id"), "id").limit(fit_rows).collect()
    others = docs.select(ids.alias("id")).where("id IS NOT NULL").distinct().orderBy(F.xxhash64("id", F.lit(1)), "id").limit(pool_rows).collect()
    chosen = {r["id"]: -1 for r in others} | {r["id"]: r["y"] for r in first}
    sample = spark.createDataFrame(list(chosen.items()), "id long, y int")
    picked = docs.select(ids.alias("id"), *view_columns(docs)).join(F.broadcast(sample), "id")  # at most fit_rows + pool_rows rows
    width = TEXT_SIZE * 2

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(source, "text", CHUNK_BYTES):
            rows = list(zip(part["text"].to_pylist(), part["source"].to_pylist(), part["lang"].to_pylist()))
            a = [text_view((t or "").encode()).astype(np.float16).tobytes() for t, _, _ in rows]
            b = [page_view((t or "").encode(), s, c).tolist() for t, s, c in rows]
            yield pa.RecordBatch.from_arrays([part["id"].combine_chunks(), part["y"].combine_chunks(), pa.array(a, pa.binary()), pa.array(b, pa.list_(pa.int32()))], ["id", "y", "grams", "cells"])

    # An id on several rows: its least (text, source, lang) stands for it, so the fit does not depend on partitioning.
    least = F.min(F.struct(F.coalesce("text", F.lit("")).alias("t"), "text", "source", "lang", "y"))
    picked = picked.groupBy("id").agg(least.alias("m")).select("id", "m.text", "m.source", "m.lang", "m.y")
    got = picked.mapInArrow(run, "id long, y int, grams binary, cells array<int>").toArrow().sort_by("id")
    text = np.zeros((got.num_rows, TEXT_SIZE), np.float32)
    page = np.zeros((got.num_rows, sum(GROUPS)), np.float32)
    for i, (g, c) in enumerate(zip(got["grams"].to_pylist(), got["cells"].to_pylist())):
        assert len(g) == width
        text[i] = np.frombuffer(g, np.float16)
        page[i, c] = 1
    return QualityModel().fit(text, page, got["y"].to_numpy())


def view_columns(docs: DataFrame, text_col: str = "text") -> list[F.Column]:
    """Text, source and language; a missing metadata column counts as null."""
    have = {c.lower() for c in docs.columns}
    return [F.col(text_col).alias("text"), *[(F.col(c).cast("string") if c in have else F.lit(None).cast("string")).alias(c) for c in ("source", "lang")]]


def _scored(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``docs`` with ``__text_odds``, ``__page_odds`` and ``__quality``."""
    box = Shipped(docs.sparkSession, model)
    extra = ["__text_odds", "__page_odds", "__quality"]
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, T.DoubleType()) for n in extra]])
    names, place = schema.names, {c: i for i, c in enumerate(docs.columns)}

    def column(part: pa.Table, name: str) -> list:
        return part.column(place[name]).cast(pa.string()).to_pylist() if name in place else [None] * part.num_rows

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(source, "text", CHUNK_BYTES):
            odds = np.array([box.value.views((t or "").encode(), s, c) for t, s, c in zip(column(part, "text"), column(part, "source"), column(part, "lang"))]).reshape(-1, 2)
            cols = [*part.columns, pa.array(odds[:, 0]), pa.array(odds[:, 1]), pa.array(box.value.combine(odds[:, 0], odds[:, 1]))]
            yield from pa.Table.from_arrays(cols, names).combine_chunks().to_batches()

    return docs.mapInArrow(run, schema)


def score(docs: DataFrame, model: QualityModel, reject_below: float = REJECT_BELOW) -> DataFrame:
    """Per document the probability of each view and of both, and whether it stays. Null texts are scored as empty ones."""
    odds = lambda c: F.lit(1.0) / (1 + F.exp(-F.col(c)))
    rows = _scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), *view_columns(docs)), model)
    return rows.select("doc_id", odds("__text_odds").alias("text_score"), odds("__page_odds").alias("page_score"), F.col("__quality").alias("score"), (F.col("__quality") >= reject_below).alias("kept"))


def keep_good(docs: DataFrame, model: QualityModel, reject_below: float = REJECT_BELOW) -> DataFrame:
    """``docs`` without rejected rows, columns unchanged (also columns named like the helper columns)."""
    inner, back = shielded(docs)
    return back(_scored(inner, model).where(F.col("__quality") >= reject_below).drop("__text_odds", "__page_odds", "__quality"))
