"""Token-ID output: ids in fixed-width bit packing.

A tokenised corpus is a folder of two Parquet tables. ``blocks`` holds one row per block of whole documents:
shard, block, position of its first id inside the shard, its ``doc_id`` list, their lengths and the ids packed
in the least number of bits that holds the vocabulary. ``shards`` holds one row per shard with the position of
its first id in the whole corpus. Positions are block offsets, so any range of ids is read by pruning blocks
and unpacking those alone. Spark's committer writes both tables, so a lost executor leaves no half file.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scorelake.llm.common import Shipped, LibraryUnits, batches, pieces_at, read_text, strung, text_bytes

BLOCK_IDS = 1 << 16
CHUNK_BYTES = 8 << 20
# A blank beside other white space: only there does a cut before a blank change the library's pieces.
BLANKS = "\t\n\x0b\x0c\r\x1c-\x1f \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
NEAR_BLANK = f"[{BLANKS}] | [{BLANKS}]"
# Pieces that the library may take as lines, and how many of them one call takes.
LINES = rf"\A ?[^{BLANKS}]+(\n[^{BLANKS}]+)*\z"
TOGETHER = 64
# Kinds of bytes beside which the splitter surely cuts: letters and digits (and the first bytes of U+00C0 to U+023F), marks, the apostrophe.
LETTER, MARK, APOSTROPHE = 1, 2, 3
KINDS = np.zeros(256, np.uint8)
KINDS[33:127] = MARK
KINDS[[k for k in range(128) if chr(k).isalnum()] + [*range(0xC3, 0xC9)]] = LETTER
KINDS[ord("'")] = APOSTROPHE
BLOCKS = "shard int, block int, start long, n_ids long, bits int, doc_ids array<long>, lengths array<int>, packed binary"


def bits_for(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as little-endian bit fields: 64 ids make ``bits`` words of 64 bits."""
    rows = -(-len(ids) // 64)
    grid = np.zeros((rows, 64), np.uint64)
    grid.ravel()[:len(ids)] = ids
    out = np.zeros((rows, bits), np.uint64)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        out[:, word] |= grid[:, j] << np.uint64(shift)
        if shift + bits > 64:
            out[:, word + 1] |= grid[:, j] >> np.uint64(64 - shift)
    return out.astype("<u8").tobytes()


def unpack(packed: bytes, bits: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a block; only the words that hold them are read."""
    first, last = start // 64, -(-stop // 64)
    words = np.frombuffer(packed, "<u8", count=(last - first) * bits, offset=first * bits * 8).reshape(-1, bits)
    mask = np.uint64((1 << bits) - 1)
    grid = np.empty((len(words), 64), np.uint32)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        v = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            v = v | (words[:, word + 1] << np.uint64(64 - shift))
        grid[:, j] = v & mask
    return grid.ravel()[start - first * 64:stop - first * 64]


class LineUnits(LibraryUnits):
    """Ids of pieces of text, many to a call of the library where its rules allow, with a memo in each Python worker."""

    def tokenizer(self):
        made = super().tokenizer()
        if "line" not in self.__dict__:
            rules = json.loads(self.spec)
            cuts, added = rules["pre_tokenizer"] or {}, rules["added_tokens"]
            alone = rules["normalizer"] is None and cuts.get("type") == "ByteLevel" and cuts.get("use_regex", True) and not cuts["add_prefix_space"]
            alone = alone and not any(t["single_word"] or t["lstrip"] or t["rstrip"] or re.search(f"[{BLANKS}]", t["content"]) for t in added)
            line = made.encode("\n", add_special_tokens=False).ids
            self.line = int(line[0]) if alone and len(line) == 1 else None
            self.marks = [t["content"] for t in added]
        return made

    def cut(self, units: list[str]) -> list[bytes]:
        """Ids of each unit. Units with no white space but a blank in front and lone line ends inside are given to the library as lines: a byte-level
        splitter always cuts around a lone line end, whose id then tells where a unit ends. Others, and units with special tokens, go one by one."""
        texts, out = pa.array(units, pa.string()), [b""] * len(units)
        fit = pc.match_substring_regex(texts, LINES) if self.line is not None else pa.array(np.zeros(len(units), bool))
        for mark in self.marks:
            fit = pc.and_not(fit, pc.match_substring(texts, mark))
        lines = pc.add(pc.count_substring(texts, "\n"), 1).to_numpy()
        fit = fit.to_numpy(zero_copy_only=False)
        joint = np.flatnonzero(fit).tolist()
        for s in range(0, len(joint), TOGETHER * 64):
            some = joint[s:s + TOGETHER * 64]
            parts = ["\n".join([units[k] for k in some[i:i + TOGETHER]]) + "\n" for i in range(0, len(some), TOGETHER)]
            raw = b"".join(self.ids(parts))
            stops = np.flatnonzero(np.frombuffer(raw, "<u4") == self.line)[np.cumsum(lines[some]) - 1] * 4
            for k, a, b in zip(some, [0, *(stops + 4).tolist()], stops.tolist()):
                out[k] = raw[a:b]
        rest = np.flatnonzero(~fit).tolist()
        for k, ids in zip(rest, self.ids([units[k] for k in rest])):
            out[k] = ids
        return out


def piece_starts(raw: np.ndarray, bounds: np.ndarray, fine: bool) -> np.ndarray:
    """Where pieces start in the bytes of texts without a blank beside other white space: at each text, at each blank, and if ``fine`` also where
    the splitter always cuts: between a letter or digit and an ASCII mark (not behind an apostrophe, which may begin a contraction), and
    around a lone line end. Letters are ASCII and U+00C0 to U+023F; beside other characters nothing more is cut."""
    starts = raw == 32
    if fine:
        kind = KINDS[raw]
        lead = np.flatnonzero((raw >= 0xC3) & (raw <= 0xC8))
        kind[lead + 1] = LETTER
        signs = lead[(raw[lead] == 0xC3) & ((raw[lead + 1] & 0xDF) == 0x97)]  # the signs of times and division among these letters
        kind[signs] = kind[signs + 1] = 0
        letter = kind == LETTER
        starts[1:] |= letter[:-1] & (kind[1:] >= MARK)
        starts[1:] |= (kind[:-1] == MARK) & letter[1:]
        lines = np.flatnonzero(raw[1:-1] == 10) + 1
        lines = lines[(kind[lines - 1] > 0) & (kind[lines + 1] > 0)]
        starts[lines] = starts[lines + 1] = True
    starts[bounds[:-1][np.diff(bounds) > 0]] = True
    return np.flatnonzero(starts)


def encode_texts(box: LineUnits, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(ids, lengths) of whole texts as the library gives them. Pieces that no byte-level splitter joins are encoded once each. Texts where
    a blank meets other white space, or with a special token, go whole."""
    box.tokenizer()
    odd = pc.match_substring_regex(texts, NEAR_BLANK)
    for mark in box.marks if box.line is not None else []:
        odd = pc.or_(odd, pc.match_substring(texts, mark))
    odd = odd.to_numpy(zero_copy_only=False)
    raw, bounds = text_bytes(pc.if_else(pa.array(odd), pa.scalar("", texts.type), texts) if odd.any() else texts)
    first = piece_starts(raw, bounds, box.line is not None)
    at = np.searchsorted(first, bounds)
    coded = pc.dictionary_encode(pieces_at(raw, first))
    flat, start, sizes = box.memo.get(coded.dictionary, box.cut)
    codes = coded.indices.to_numpy()
    start, sizes = start[codes], sizes[codes]
    whole = np.flatnonzero(odd)
    if len(whole):
        more = box.ids(texts.take(pa.array(whole)).to_pylist())
        long = np.fromiter(map(len, more), np.int64, len(more)) // 4
        start = np.insert(start, at[whole], len(flat) + np.cumsum(long) - long)
        sizes = np.insert(sizes, at[whole], long)
        flat = np.concatenate([flat, np.frombuffer(b"".join(more), "<u4")])
        at = at + np.concatenate([[0], np.cumsum(odd)])
    return strung(flat, start, sizes), np.diff(np.concatenate([[0], np.cumsum(sizes)])[at])


def write_tokens(docs: DataFrame, path: str, tokenizer_file: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
                 block_ids: int = BLOCK_IDS) -> None:
    """Write the ids of every whole text, each document closed by ``end_id``, in ascending id order.

    A null text is empty (its only id is ``end_id``). Rows that repeat an id all stay, ordered by text; null ids come
    first. Other columns are ignored. An empty table gives an empty corpus.
    """
    spark = docs.sparkSession
    spec = read_text(tokenizer_file)
    from tokenizers import Tokenizer

    bits = bits_for(max(Tokenizer.from_str(spec).get_vocab_size(), end_id + 1))
    box = Shipped(spark, LineUnits(spec))
    end = np.uint32(end_id)
    names = [c.split()[0] for c in BLOCKS.split(", ")]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, start = TaskContext.get().partitionId(), 0, 0
        ids, held = [], []

        def flush():
            nonlocal block, start
            flat = np.concatenate(held)
            row = [shard, block, start, len(flat), bits, list(ids), [len(h) for h in held], pack(flat, bits)]
            block, start = block + 1, start + len(flat)
            ids.clear(), held.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

        size = 0
        for part in batches(source, "text", CHUNK_BYTES):
            flat, lengths = encode_texts(box.value, pc.fill_null(part["text"].combine_chunks(), ""))
            stops = np.cumsum(lengths).tolist()
            for doc, a, b in zip(part["id"].to_pylist(), [0, *stops], stops):
                ids.append(doc)
                held.append(np.append(flat[a:b], end))
                size += b - a + 1
                if size >= block_ids:
                    yield flush()
                    size = 0
        if ids:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    ordered = rows.repartitionByRange("id").sortWithinPartitions("id", "text")
    ordered.mapInArrow(run, BLOCKS).write.option("compression", "zstd").parquet(f"{path}/blocks")
    sizes = spark.read.parquet(f"{path}/blocks").groupBy("shard").agg(F.sum("n_ids").alias("n_ids"), F.count("*").alias("n_blocks"))
    upto = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0))  # one row a shard
    sizes.withColumn("shard_start", upto - F.col("n_ids")).write.parquet(f"{path}/shards")


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Blocks with ``first``, the position of their first id in the corpus."""
    shards = spark.read.parquet(f"{path}/shards").select("shard", "shard_start")
    return spark.read.parquet(f"{path}/blocks").join(shards, "shard").withColumn("first", F.col("shard_start") + F.col("start"))


def read_documents(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32 (and the ids, if asked for)."""
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids

    def run(source):
        for batch in source:
            for doc_ids, lengths, first, bits, n, packed in zip(*[batch.column(c).to_pylist() for c in ("doc_ids", "lengths", "first", "bits", "n_ids", "packed")]):
                flat = unpack(packed, bits, 0, n)
                ends = np.cumsum(np.array(lengths, np.int64))
                starts = ends - np.array(lengths, np.int64)
                cols = [pa.array(doc_ids, pa.int64()), pa.array(first + starts), pa.array(ends - starts)]
                cols.append(pa.array([zlib.crc32(flat[a:b].astype("<u4").tobytes()) for a, b in zip(starts, ends)], pa.int64()))
                if with_ids:
                    cols.append(pa.array([flat[a:b].tolist() for a, b in zip(starts, ends)], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(cols, names)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return read_blocks(spark, path).select("doc_ids", "lengths", "first", "bits", "n_ids", "packed").mapInArrow(run, schema)


def read_range(spark: SparkSession, path: str, start: int, count: int) -> DataFrame:
    """Random access: ids at corpus positions ``start`` to ``start + count``, as rows (position, id)."""
    stop = start + count

    def run(source):
        for batch in source:
            for first, bits, n, packed in zip(*[batch.column(c).to_pylist() for c in ("first", "bits", "n_ids", "packed")]):
                a, b = max(0, start - first), min(n, stop - first)
                if b > a:
                    yield pa.RecordBatch.from_arrays([pa.array(first + np.arange(a, b)), pa.array(unpack(packed, bits, a, b).astype(np.int64))], ["position", "id"])

    hit = read_blocks(spark, path).where((F.col("first") < stop) & (F.col("first") + F.col("n_ids") > start))
    return hit.select("first", "bits", "n_ids", "packed").mapInArrow(run, "position long, id long")
