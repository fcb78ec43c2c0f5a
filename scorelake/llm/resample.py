"""Importance resampling towards a target distribution of hashed word n-grams.

Features are hashed into buckets. Counts come from batch concatenation: the texts of an Arrow batch are lower-cased
(A-Z) and joined with a separator that is no word character, one regular-expression pass finds every word of the batch,
document offsets are found for all word starts at once with ``searchsorted``, n-grams that would cross a document
border are masked out, and buckets are counted with ``bincount``. Corpus and target bucket counts are summed by Spark
(at most ``buckets`` rows reach the driver); the per-bucket gain table (``buckets`` numbers) is broadcast and a second pass
gives each document the floored mean gain of its features. A Gumbel key from the id's SHA-256 is added, and the documents
with enough words are ranked by a global sort: range partitions, counts per partition, offsets.

Defined cases: a null text has no words (weight 0, n_features 0); a null doc_id still counts towards the corpus counts
but is never drawn (score and rank null); repeated rows are separate documents (ties: smaller doc_id, then the rest of
the row); an empty table gives no rows; extra columns are not read; a very long text is one row of a batch of its own.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.llm.common import Shipped, batches, landed, texts_of

# Fixed values of the contract.
WORD = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
SMOOTH = 10_000
SEED_TEXT = "2024:"
MIN_WORDS = 20
SHARE_PERCENT = 10
NGRAMS = (1, 1)

CHUNK_BYTES = 8 << 20
SEPARATOR = b"\x00"
UPPER, LOWER = bytes(range(65, 91)), bytes(range(97, 123))
CASE = bytes.maketrans(UPPER, LOWER)


def features(texts: list[str], ngrams: tuple[int, int] = NGRAMS, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, bucket, n_words) of one batch: the document and bucket of every feature, and each document's word count."""
    raw = [t.encode() for t in texts]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    offsets = np.cumsum(sizes + len(SEPARATOR)) - sizes - len(SEPARATOR)  # where each text starts in the joined batch
    joined = SEPARATOR.join(raw).translate(CASE)
    found = [(m.start(), m.group()) for m in re.finditer(WORD, joined)]
    starts = np.fromiter((s for s, _ in found), np.int64, len(found))
    doc = np.searchsorted(offsets, starts, side="right") - 1
    n_words = np.bincount(doc, minlength=len(raw)).astype(np.int64)
    words = [w for _, w in found]
    docs, cells = [], []
    for n in range(ngrams[0], ngrams[1] + 1):
        if len(words) < n:
            continue
        ok = doc[n - 1:] == doc[:len(doc) - n + 1]  # an n-gram must start and end in one document
        at = np.flatnonzero(ok)
        if n == 1:
            distinct = pa.array(words, pa.binary()).dictionary_encode()
            crc = np.fromiter((zlib.crc32(w) for w in distinct.dictionary.to_pylist()), np.int64, len(distinct.dictionary))
            cell = (crc % buckets)[distinct.indices.to_numpy()]
        else:
            cell = np.fromiter((zlib.crc32(b" ".join(words[i:i + n])) % buckets for i in at.tolist()), np.int64, len(at))
        docs.append(doc[at])
        cells.append(cell[at] if n == 1 else cell)
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), n_words
    return np.concatenate(docs), np.concatenate(cells), n_words


def bucket_counts(texts: DataFrame, text_col: str = "text", ngrams: tuple[int, int] = NGRAMS, buckets: int = BUCKETS) -> np.ndarray:
    """Feature counts per bucket over all rows: each batch sends its non-empty buckets; Spark sums them."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(source, "text", CHUNK_BYTES):
            _, cell, _ = features(texts_of(part["text"]), ngrams, buckets)
            count = np.bincount(cell, minlength=buckets)
            hit = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(hit.astype(np.int64)), pa.array(count[hit].astype(np.int64))], ["bucket", "n"])

    summed = texts.select(F.col(text_col).alias("text")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in summed.collect():  # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray, smooth: int = SMOOTH) -> np.ndarray:
    """floor(1000 ln((t+1)(S+smooth) / ((s+1)(T+smooth)))) per bucket, in doubles."""
    s_all, t_all = float(corpus.sum()), float(target.sum())
    return np.floor(1000.0 * np.log((target + 1.0) * (s_all + smooth) / ((corpus + 1.0) * (t_all + smooth))))


def weights(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", ngrams: tuple[int, int] = NGRAMS) -> DataFrame:
    """doc_id, n_words, n_features, weight (floored mean gain of a document's features; none: 0) of every row."""
    box = Shipped(docs.sparkSession, gain)
    names = ["doc_id", "n_words", "n_features", "weight"]

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(source, "text", CHUNK_BYTES):
            n = part.num_rows
            doc, cell, n_words = features(texts_of(part["text"]), ngrams, len(box.value))
            count = np.bincount(doc, minlength=n)
            total = np.bincount(doc, weights=box.value[cell], minlength=n)
            weight = np.where(count > 0, np.floor(total / np.maximum(count, 1)), 0.0).astype(np.int64)
            yield pa.RecordBatch.from_arrays([part["id"].combine_chunks(), pa.array(n_words), pa.array(count.astype(np.int64)), pa.array(weight)], names)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def gumbel(id_col: F.Column, seed_text: str = SEED_TEXT) -> F.Column:
    """floor(-1000 ln(-ln((h + 0.5) / 2^32))), h the first 8 hex digits of sha256(seed_text + id) as unsigned."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(seed_text), id_col.cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def global_rank(rows: DataFrame, order: list[F.Column]) -> DataFrame:
    """``rows`` with ``rank`` (1, 2, ... in ``order``) by a global sort: range partitions are numbered, rows are counted per
    partition, and each partition's offset is the sum of the counts before it. No row meets the others in one task."""
    placed = landed(rows.orderBy(*order).select("*", F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("__mid")))
    counts = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__mid").alias("__first"))
    before = counts.select("__part", "__first", (F.sum("__n").over(_running()) - F.col("__n")).alias("__offset"))  # one row per partition
    ranked = placed.join(F.broadcast(before), "__part")
    return ranked.select(*[c for c in rows.columns], (F.col("__offset") + F.col("__mid") - F.col("__first") + 1).alias("rank"))


def _running():
    from pyspark.sql import Window

    return Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
             share_percent: int = SHARE_PERCENT, min_words: int = MIN_WORDS, ngrams: tuple[int, int] = NGRAMS, buckets: int = BUCKETS) -> DataFrame:
    """Every document: doc_id, n_features, weight, score, rank (drawn: 1, 2, ...; undrawn: null), all long."""
    gain = gains(bucket_counts(docs, text_col, ngrams, buckets), bucket_counts(target, target_text, ngrams, buckets))
    scored = weights(docs, gain, id_col, text_col, ngrams).withColumn("score", (F.col("weight") + gumbel(F.col("doc_id"))).cast("long"))
    scored = landed(scored.withColumn("__drawable", (F.col("n_words") >= min_words) & F.col("doc_id").isNotNull()))
    draw = scored.where("__drawable").count() * share_percent // 100
    # Drawable rows sort first, so their places are 1 .. N; rows equal in every column take their places in any order.
    ranked = global_rank(scored, [F.col("__drawable").desc(), F.col("score").desc(), F.col("doc_id").asc(), F.col("n_features"), F.col("weight")])
    rank = F.when(F.col("__drawable") & (F.col("rank") <= draw), F.col("rank"))
    return ranked.select("doc_id", "n_features", "weight", "score", rank.cast("long").alias("rank"))
