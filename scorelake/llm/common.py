"""Shared pieces: reading tables, landing results, tokenizer files and bounded memo tables."""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorelake.session import landed, scratch_dir

__all__ = ["shielded", "Shipped", "table", "landed", "scratch_dir", "batches", "tokenizer_path", "read_text", "UnitCache", "PieceMemo", "LibraryUnits", "texts_of", "crc_mod", "text_bytes", "pieces_at", "coded_words", "gathered", "strung", "least_texts"]


class Shipped:
    """A value broadcast with its classes, so executors need no copy of this package (a plain broadcast names classes by module).
    Each Python worker unpacks it once and keeps it for its next tasks."""

    def __init__(self, spark: SparkSession, value):
        self.own = value
        self.held = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def __getstate__(self):
        return {"held": self.held}

    def drop(self) -> None:
        """Frees the value on all executors, once no plan needs it any more."""
        self.held.destroy()

    @property
    def value(self):
        if "own" in self.__dict__:
            return self.own
        kept = self.held.__dict__  # the worker's own broadcast object, which outlives the task
        if "unpacked" not in kept:
            kept["unpacked"] = cloudpickle.loads(self.held.value)
        return kept["unpacked"]


def shielded(df: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with every column whose name starts with ``__`` (the prefix of this package's helper columns, in any case)
    renamed to a free name, and a function that gives those columns their names back."""
    taken = {c.lower() for c in df.columns}
    moved = {}
    for c in df.columns:
        if c.startswith("__"):
            i = 0
            while f"user{i}{c}".lower() in taken:
                i += 1
            moved[c] = f"user{i}{c}"
            taken.add(moved[c].lower())
    if not moved:
        return df, lambda out: out
    return df.withColumnsRenamed(moved), lambda out: out.withColumnsRenamed({v: k for k, v in moved.items()})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file; only the driver reads it."""
    try:
        from public_tokenizers import path
        return path(name)
    except ImportError:
        import os

        return os.path.join(os.environ.get("PUBLIC_TOKENIZERS", "/opt/tokenizers"), name)


def read_text(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def crc_mod(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text (crc 0)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % n


def texts_of(column: pa.Array) -> list[str]:
    """Texts of an Arrow column, null as empty."""
    return [t if t is not None else "" for t in column.to_pylist()]


def least_texts(texts: DataFrame, limit: int) -> list[str]:
    """At most ``limit`` different texts, those with the least hashes, in that order. Hashes alone are ranked, so tasks send numbers to the
    driver; then the chosen texts are fetched."""
    h = F.xxhash64("text")
    chosen = texts.select(h.alias("h")).distinct().orderBy("h").limit(limit).collect()
    if not chosen:
        return []
    wanted = texts.sparkSession.createDataFrame([(r["h"],) for r in chosen], "h long")
    rows = texts.select("text", h.alias("h")).join(F.broadcast(wanted), "h").groupBy("h").agg(F.min("text").alias("text"))  # at most ``limit`` rows
    return [r["text"] for r in sorted(rows.collect(), key=lambda r: r["h"])]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(raw, bounds): the UTF-8 bytes of all texts (none null); text i has those from ``bounds[i]`` to ``bounds[i + 1]``."""
    texts = texts.cast(pa.string())
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]]
    return raw, bounds - bounds[0]


def pieces_at(raw: np.ndarray, first: np.ndarray) -> pa.Array:
    """The pieces of ``raw`` that start at ``first`` (ascending, from 0) and end where the next one starts."""
    return pa.Array.from_buffers(pa.string(), len(first), [None, pa.py_buffer(np.append(first, len(raw)).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(raw))])


def coded_words(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(codes, bounds, words): lower-cased (A-Z) words between the six ASCII blanks as codes into the distinct words; text i has codes
    ``bounds[i]`` to ``bounds[i + 1]``. Null texts have none."""
    import pyarrow.compute as pc

    raw, bounds = text_bytes(pc.fill_null(texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts, ""))
    shown = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    starts = shown.copy()
    starts[1:] &= ~shown[:-1]
    edges = bounds[:-1][np.diff(bounds) > 0]
    starts[edges] = shown[edges]
    letters = raw[shown]
    letters[(letters >= 65) & (letters <= 90)] |= 32
    coded = pc.dictionary_encode(pieces_at(letters, np.flatnonzero(starts[shown])))
    return coded.indices.to_numpy(), np.searchsorted(np.flatnonzero(starts), bounds), coded.dictionary


def gathered(codes: np.ndarray, values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, sizes): the little-endian 32-bit ids of ``values`` in the order of ``codes``, and how many each code gives."""
    lengths = np.fromiter(map(len, values), np.int64, len(values)) // 4
    sizes = lengths[codes]
    return strung(np.frombuffer(b"".join(values), "<u4"), (np.cumsum(lengths) - lengths)[codes], sizes), sizes


def strung(flat: np.ndarray, start: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Runs of ``flat`` one behind the other: run i has ``sizes[i]`` values from place ``start[i]``."""
    total = int(sizes.sum())
    kind = np.int32 if max(total, len(flat)) < 1 << 31 else np.int64  # half the memory where it serves
    place = np.repeat((start - (np.cumsum(sizes) - sizes)).astype(kind), sizes)
    place += np.arange(total, dtype=kind)
    return flat[place]


def batches(source: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.Table]:
    """Runs of whole rows of about ``limit`` text bytes; one longer row makes a run of its own."""
    for batch in source:
        data = pa.Table.from_batches([batch])
        if not data.num_rows:
            continue
        import pyarrow.compute as pc

        sizes = pc.fill_null(pc.binary_length(data[text]), 0).to_numpy()
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < len(sizes):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield data.slice(start, stop - start)
            start = stop


class UnitCache:
    """Results for text pieces, in two generations of at most ``limit`` entries each.

    A piece used again moves to the young generation, so frequent pieces stay while rare ones are
    dropped. Memory is bounded; a dropped piece is only computed again.
    """

    def __init__(self, limit: int = 400_000, text_limit: int = 24 << 20, weigh: Callable | None = None):
        self.limit, self.text_limit = limit, text_limit
        self.weigh = weigh or (lambda keys, values: sum(map(len, keys)))  # bytes a generation counts for entries
        self.young: dict = {}
        self.old: dict = {}
        self.size = 0

    def get(self, units: set, compute: Callable[[list], list]) -> dict:
        """A mapping that holds every piece of ``units``."""
        if len(self.young) > self.limit or self.size > self.text_limit:
            self.old, self.young, self.size = self.young, {}, 0
        need = units - self.young.keys()
        again = need & self.old.keys()
        for u in again:
            self.young[u] = self.old.pop(u)
        fresh = list(need - again)
        made = compute(fresh)
        self.young.update(zip(fresh, made))
        self.size += self.weigh(again, [self.young[u] for u in again]) + self.weigh(fresh, made)
        return self.young


class PieceMemo:
    """Ids of text pieces as flat arrays, without a Python object a piece. Beyond ``limit`` pieces or ``text_limit`` bytes of their
    text only those of the last call stay: memory is bounded, and a dropped piece is only computed again."""

    def __init__(self, limit: int = 600_000, text_limit: int = 24 << 20):
        self.limit, self.text_limit = limit, text_limit
        self.clear()

    def clear(self) -> None:
        self.texts, self.ids, self.bounds = pa.array([], pa.string()), np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def get(self, units: pa.Array, compute: Callable[[list[str]], list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start, sizes): the ids of distinct piece i are ``sizes[i]`` values of ``ids`` from ``start[i]``."""
        import pyarrow.compute as pc

        at = pc.index_in(units, value_set=self.texts)
        lost = at.is_null().to_numpy(zero_copy_only=False)
        place = at.fill_null(0).to_numpy().astype(np.int64)
        if lost.any():
            fresh = units.filter(pa.array(lost))
            made = compute(fresh.to_pylist())
            place[lost] = len(self.texts) + np.arange(len(fresh))
            self.texts = pa.concat_arrays([self.texts, fresh])
            self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(np.fromiter(map(len, made), np.int64, len(made)) // 4)])
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(made), "<u4")])
        ids, start, sizes = self.ids, self.bounds[place], self.bounds[place + 1] - self.bounds[place]
        if len(self.texts) > self.limit or self.texts.nbytes > self.text_limit:
            self.texts, self.ids, self.bounds = units, strung(ids, start, sizes), np.concatenate([[0], np.cumsum(sizes)])
        return ids, start, sizes


class LibraryUnits:
    """Broadcast holder of a tokenizers file: each Python worker builds the tokenizer and its memo once."""

    def __init__(self, spec: str):
        self.spec = spec

    def __getstate__(self):
        return {"spec": self.spec}

    def tokenizer(self):
        if "made" not in self.__dict__:
            import os

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self.made = Tokenizer.from_str(self.spec)
            self.__dict__.setdefault("memo", PieceMemo())
        return self.made

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text, by the library itself."""
        made, out = self.tokenizer(), []
        for i in range(0, len(texts), 4000):
            out += [array("I", e.ids).tobytes() for e in made.encode_batch_fast(texts[i:i + 4000], add_special_tokens=False)]
        return out
