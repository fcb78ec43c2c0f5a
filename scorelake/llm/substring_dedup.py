"""Substring dedup over sliding sentence spans.

From every sentence starts a run of consecutive sentences: at least two, and on until it has ``MIN_WORDS`` words; a single sentence
of ``LONG_WORDS`` words is long enough alone. Runs are hashed to 96 bits and joined over the whole corpus. The first
occurrence of a hash is the earliest one in the document with the least id; sentences covered by any other occurrence are removed.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.llm.common import batches, texts_of

MIN_SENTENCES, MIN_WORDS, LONG_WORDS = 2, 15, 24
CHUNK_BYTES = 4 << 20
STOPS = re.compile(r"(?<=[.!?。！？])\s+|\s*\n\s*")


def sentences(text: str) -> list[tuple[int, int, str, int]]:
    """(start, stop, normal form, words) of each sentence; the blanks after it belong to it. Pieces without words join the one before."""
    out: list[tuple[int, int, str, int]] = []
    start = 0
    for stop in [*[m.end() for m in STOPS.finditer(text)], len(text)]:
        if stop == start:
            continue
        words = text[start:stop].lower().split()
        if words or not out:
            out.append((start, stop, " ".join(words), len(words)))
        else:
            a, _, form, n = out.pop()
            out.append((a, stop, form, n))
        start = stop
    return out


def runs(text: str, least: int = MIN_SENTENCES, min_words: int = MIN_WORDS, long_words: int = LONG_WORDS) -> list[tuple[int, int, int, int, bool]]:
    """(hash, second hash, first sentence, sentence after the last, whether the text has it for the first time) of the run that starts
    at each sentence, if the text is long enough."""
    import xxhash

    parts = sentences(text)
    raw = [xxhash.xxh3_128_digest(p[2]) for p in parts]
    n, out, stop, words = len(parts), [], 0, 0
    seen: set[bytes] = set()
    for i in range(n):
        # Two pointers: the end never moves back.
        while stop < n and not (words >= min_words and stop - i >= least) and not (stop - i == 1 and words >= long_words):
            words += parts[stop][3]
            stop += 1
        if (words >= min_words and stop - i >= least) or (stop - i == 1 and words >= long_words):
            key = xxhash.xxh3_128_digest(b"".join(raw[i:stop]))[:12]
            out.append((*struct.unpack("<qi", key), i, stop, key not in seen))
            seen.add(key)
        words -= parts[i][3]
    return out


def run_table(docs: DataFrame) -> DataFrame:
    """One row per run: (h, k, id, sum, start, stop, lead) of ``docs(id, text, sum)``."""
    names = ["h", "k", "id", "sum", "start", "stop", "lead"]

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(source, "text", CHUNK_BYTES):
            h, k, ids, sums, start, stop, lead = [], [], [], [], [], [], []
            for t, i, s in zip(texts_of(part["text"]), part["id"].to_pylist(), part["sum"].to_pylist()):
                found = runs(t)
                if found:
                    a, b, c, d, e = zip(*found)
                    h += a
                    k += b
                    start += c
                    stop += d
                    lead += e
                    ids += [i] * len(a)
                    sums += [s] * len(a)
            yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(k, pa.int32()), pa.array(ids, pa.int64()), pa.array(sums, pa.int64()),
                                              pa.array(start, pa.int32()), pa.array(stop, pa.int32()), pa.array(lead, pa.bool_())], names)

    return docs.mapInArrow(run, "h long, k int, id long, sum long, start int, stop int, lead boolean")


def covered(docs: DataFrame) -> DataFrame:
    """(id, sum, spans): sentence ranges of each text covered by runs that are not the first of their hash."""
    table = run_table(docs)
    repeated = table.groupBy("h", "k").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first")).where("n > 1").select("h", "k", "first")
    later = table.join(repeated, ["h", "k"]).where(~(F.col("id").eqNullSafe(F.col("first")) & F.col("lead")))
    return later.groupBy("id", "sum").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_sentences, n_removed, removed (code point ranges ``start:stop``, comma-joined) and the text left.

    Null texts are empty. Rows that share an id count as one document, so one does not erase the other; null ids come last, and rows
    without an id do not erase each other. A text may repeat itself: its later spans go. Other columns are ignored.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    base = base.withColumn("sum", F.crc32(F.col("text").cast("binary")))
    spans = covered(base).withColumnsRenamed({"id": "id2", "sum": "sum2"})
    both = base.join(spans, base["id"].eqNullSafe(spans["id2"]) & (base["sum"] == spans["sum2"]), "left").select("id", "text", "spans")
    names = ["doc_id", "n_sentences", "n_removed", "removed", "text"]

    def cut(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(source, "text", CHUNK_BYTES):
            total, gone, ranges, left = [], [], [], []
            for t, rows in zip(part["text"].to_pylist(), part["spans"].to_pylist()):
                parts = sentences(t)
                drop = bytearray(len(parts))
                for s in rows or ():
                    drop[s["start"]:s["stop"]] = b"\1" * (s["stop"] - s["start"])
                total.append(len(parts))
                gone.append(sum(drop))
                joined: list[list[int]] = []
                for p, d in zip(parts, drop):
                    if d and joined and joined[-1][1] == p[0]:
                        joined[-1][1] = p[1]
                    elif d:
                        joined.append([p[0], p[1]])
                ranges.append(",".join(f"{a}:{b}" for a, b in joined))
                left.append("".join([t[p[0]:p[1]] for p, d in zip(parts, drop) if not d]))
            yield pa.RecordBatch.from_arrays([part["id"].combine_chunks(), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(ranges, pa.string()), pa.array(left, pa.string())], names)

    return both.mapInArrow(cut, "doc_id long, n_sentences long, n_removed long, removed string, text string")
