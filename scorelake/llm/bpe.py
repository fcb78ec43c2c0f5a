"""BPE encoding and decoding with a pair occurrence index.

All distinct words of a partition are laid out in one array of symbols. The index maps active pairs to every
place where they occur; ranks are applied in ascending order, and each merge updates the lists of the neighbouring
pairs. A pair can only hold symbols made by earlier merges, so a new pair always ranks later than the merge
that made it, and one ascending pass is exact (checked when the file is read).

Consecutive ranks whose merges make no symbol used among them form a group: no new pair of a group arises while it
is applied. The index is kept by group, and all places of a group merge together, a place after those beside it
that rank lower.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.llm.common import Shipped, UnitCache, batches, gathered, read_text

CHUNK_BYTES = 1 << 20
MEMO_BYTES = 16 << 20  # keys and values of the piece memo, per Python worker
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, spare = {}, 256
    for b in range(256):
        if b in keep:
            letters[b] = chr(b)
        else:
            letters[b], spare = chr(spare), spare + 1
    return [letters[b] for b in range(256)]


class PairIndexBPE:
    """A BPE vocabulary with word ends, read from a tokenizers file."""

    def __init__(self, spec: str):
        self.spec = spec

    def __getstate__(self):
        return {"spec": self.spec}

    @staticmethod
    def fits(rules: dict) -> bool:
        """Whether a tokenizers file has the rules that this class follows."""
        model, first, cuts = rules["model"], rules.get("normalizer") or {}, (rules.get("pre_tokenizer") or {}).get("pretokenizers", [])
        blank = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
        split = {"type": "Split", "pattern": {"Regex": PIECES.replace(r"\p{White_Space}", r"\s")}, "behavior": "Removed", "invert": True}
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges"))
        return (model.get("type") == "BPE" and plain and first.get("normalizers") == [{"type": "NFC"}, blank, {"type": "Lowercase"}] and len(cuts) == 2 and cuts[0] == split
                and cuts[1]["type"] == "ByteLevel" and not cuts[1]["add_prefix_space"] and not cuts[1]["use_regex"]
                and not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in rules["added_tokens"]))

    def ready(self) -> PairIndexBPE:
        if "vocab" in self.__dict__:
            return self
        import regex

        data = json.loads(self.spec)
        model = data["model"]
        self.vocab = model["vocab"]
        end = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        size = max([*self.vocab.values(), *self.special.values()]) + 1
        self.tokens = [""] * size
        for word, i in [*self.vocab.items(), *self.special.items()]:
            self.tokens[i] = word
        letters = byte_letters()
        self.byte_id = np.array([self.vocab.get(c, -1) for c in letters], np.int64)
        self.last_id = np.array([self.vocab.get(c + end, -1) for c in letters], np.int64)
        self.size = size
        left, right, made = [], [], []
        born: dict[int, int] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            new = self.vocab[a + b]
            left.append(self.vocab[a])
            right.append(self.vocab[b])
            made.append(new)
            if born.get(left[-1], -1) >= rank or born.get(right[-1], -1) >= rank or new in born:
                raise ValueError("the merge list uses a symbol before it is made; one ascending pass would not be exact")
            born[new] = rank
        self.left, self.right, self.made = (np.array(x, np.int64) for x in (left, right, made))
        keys = self.left * size + self.right
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.none = len(keys)  # the rank of pairs that never merge
        used = np.full(size, self.none, np.int64)
        ranks = np.arange(self.none)
        np.minimum.at(used, self.left, ranks)
        np.minimum.at(used, self.right, ranks)
        self.group = np.zeros(self.none + 1, np.int64)
        first, group = self.none, 0
        for rank, use in enumerate(used[self.made].tolist()):
            if rank >= first:
                first, group = self.none, group + 1
            self.group[rank] = group
            first = min(first, use)
        self.group[self.none] = group + 1
        words = [t.encode() + b" " for t in self.tokens]
        self.token_bytes = pa.array(words, pa.large_binary())
        self.token_sizes = np.array([len(w) for w in words], np.int64)
        self.pieces = regex.compile(PIECES + r"|\n")
        self.marks = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.cache = UnitCache(300_000, MEMO_BYTES, lambda keys, values: sum(map(len, keys)) * 2 + sum(map(len, values)) + 200 * len(keys))
        return self

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, ``none`` if it never merges."""
        if not self.none:
            return np.zeros(len(a), np.int64)
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], self.none)

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word by the pair occurrence index over all of them."""
        ids, bounds = self.encode_flat([w.encode() for w in words])
        return [ids[a:b] for a, b in zip(bounds, bounds[1:])]

    def encode_flat(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): ids of all words, word i from ``bounds[i]`` to ``bounds[i + 1]``."""
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        flat = np.frombuffer(b"".join(raw), np.uint8)
        n = len(flat)
        ends = np.cumsum(lengths)
        sym = self.byte_id[flat]
        last = ends[lengths > 0] - 1
        sym[last] = self.last_id[flat[last]]
        nxt = np.arange(1, n + 1)
        prv = np.arange(-1, n - 1)
        nxt[last] = -1
        prv[(ends - lengths)[lengths > 0]] = -1
        # The rank of the pair that starts at each place; one more place stands for "no neighbour".
        rank = np.full(n + 1, self.none, np.int64)
        lists: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def add(at: np.ndarray) -> None:
            group = self.group[rank[at]]
            ok = rank[at] < self.none
            at, group = at[ok], group[ok]
            if not len(at):
                return
            order = np.argsort(group, kind="stable")
            at, group = at[order], group[order]
            cuts = np.flatnonzero(group[1:] != group[:-1]) + 1
            for g, part in zip(group[np.concatenate([[0], cuts])].tolist(), np.split(at, cuts)):
                if g in lists:
                    lists[g].append(part)
                else:
                    lists[g] = [part]
                    heapq.heappush(heap, g)

        start = np.flatnonzero(nxt >= 0)
        rank[start] = self.ranks(sym[start], sym[start + 1])
        add(start)
        while heap:
            g = heapq.heappop(heap)
            found = lists.pop(g)
            at = np.concatenate(found)
            at = np.sort(at[self.group[rank[at]] == g])
            at = at[np.diff(at, prepend=-1) > 0]
            changed = []
            while len(at):
                # Runs of places side by side with one rank (overlapping occurrences) merge from the left, every second one, as soon as
                # both neighbours of the run rank higher.
                r = rank[at]
                joined = np.zeros(len(at), bool)
                joined[1:] = (nxt[at[:-1]] == at[1:]) & (r[1:] == r[:-1])
                heads = np.flatnonzero(~joined)
                tails = np.append(heads[1:], len(at)) - 1
                ready = (rank[prv[at[heads]]] > r[heads]) & (rank[nxt[at[tails]]] > r[tails])
                run = np.cumsum(~joined) - 1
                pick = ready[run] & ((np.arange(len(at)) - heads[run]) % 2 == 0)
                left, which = at[pick], r[pick]
                to = nxt[left]
                after = nxt[to]
                sym[left], sym[to] = self.made[which], -1
                rank[to] = self.none
                nxt[left] = after
                more = after >= 0
                prv[after[more]] = left[more]
                before = prv[left]
                near = np.concatenate([before[before >= 0], left])
                then = nxt[near]
                rank[near] = np.where(then >= 0, self.ranks(sym[near], sym[then]), self.none)
                changed.append(near)
                at = at[self.group[rank[at]] == g]
            if changed:
                add(np.concatenate(changed))
        alive = sym >= 0
        counts = np.concatenate([[0], np.cumsum(alive)])
        return sym[alive].astype(np.uint32), counts[np.concatenate([[0], ends])]

    def units(self, raw: list[str]) -> list[bytes]:
        """Ids, as little-endian 32-bit numbers, of pieces that hold no ASCII white space.

        The pieces go through the letter rules as one text, a line end behind each: no rule joins letters across it.
        """
        marked = [k for k, u in enumerate(raw) if self.marks.search(u)] if self.marks and self.marks.search("\n".join(raw)) else []
        plain, special = list(raw), {}
        for k in marked:  # each part between special tokens becomes a piece of its own
            parts = self.marks.split(raw[k])
            plain[k], special[k] = "", (len(plain), parts)
            plain += parts[::2]
        # Final sigma: the library lower-cases letter by letter.
        text = unicodedata.normalize("NFC", "\n".join(plain)).replace("Σ", "σ").lower()
        found = pa.array(self.pieces.findall(text), pa.string()).dictionary_encode()
        words = found.dictionary.to_pylist()
        codes = found.indices.to_numpy()
        ids, bounds = self.encode_flat([b"" if w == "\n" else w.encode() for w in words])
        sizes = np.diff(bounds)[codes]
        stop = np.cumsum(sizes)
        shift = bounds[codes] - (stop - sizes)
        flat = ids[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))].astype("<u4").tobytes()
        line = words.index("\n") if "\n" in words else -1
        ends = np.append(stop[codes == line], len(flat) // 4) * 4
        at = [0, *ends.tolist()]
        out = [flat[a:b] for a, b in zip(at, at[1:])] if plain else []
        for k, (first, parts) in special.items():
            row = [out[first + i // 2] if i % 2 == 0 else np.uint32(self.special[s]).astype("<u4").tobytes() for i, s in enumerate(parts)]
            out[k] = b"".join(row)
        return out[:len(raw)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of whole texts, text i from ``bounds[i]`` to ``bounds[i + 1]``; each distinct piece between ASCII blanks is encoded once."""
        self.ready()
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = pc.dictionary_encode(split.flatten())
        at = split.offsets.to_numpy().astype(np.int64)
        units = coded.dictionary.to_pylist()
        known = self.cache.get(set(units), self.units)
        ids, sizes = gathered(coded.indices.to_numpy(), [known[u] for u in units])
        return ids, np.concatenate([[0], np.cumsum(sizes)])[at - at[0]]

    def decode(self, ids) -> str:
        """Tokens joined by blanks: this file names no decoder."""
        self.ready()
        return " ".join([self.tokens[i] for i in ids])

    def decoded(self, ids: np.ndarray, bounds: np.ndarray) -> list[memoryview]:
        """The UTF-8 bytes of ``decode`` for each text's ids."""
        data = self.token_bytes.take(pa.array(ids)).buffers()[2]
        blob = memoryview(b"" if data is None else data)
        at = np.concatenate([[0], np.cumsum(self.token_sizes[ids])])[bounds].tolist()
        return [blob[a:max(a, b - 1)] for a, b in zip(at, at[1:])]


def bpe(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
        with_decoded: bool | None = None) -> DataFrame:
    """Encode and decode every whole text: doc_id, n_tokens, ids_sha256, decoded_sha256; with ``with_ids`` also ``ids``, and with
    ``with_decoded`` (by default as ``with_ids``) also ``decoded``.

    A null text is empty: no ids, an empty decoded text. Every row gives a row, repeated and null ids included; other
    columns are ignored, so clashing names do not matter. Ids of a chunk are built as one buffer with offsets.
    """
    with_decoded = with_ids if with_decoded is None else with_decoded
    box = Shipped(docs.sparkSession, PairIndexBPE(read_text(tokenizer_file)))
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids + ["decoded"] * with_decoded

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(source, "text", CHUNK_BYTES):
            ids, bounds = box.value.encode(part["text"].combine_chunks())
            at, flat = (bounds * 4).tolist(), memoryview(ids.astype("<u4").tobytes())
            texts = box.value.decoded(ids, bounds)
            a = [hashlib.sha256(flat[s:e]).hexdigest() for s, e in zip(at, at[1:])]
            b = [hashlib.sha256(t).hexdigest() for t in texts]
            cols = [part["id"].combine_chunks(), pa.array(np.diff(bounds), pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]
            if with_ids:
                cols.append(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int64))))
            if with_decoded:
                cols.append(pa.array([str(t, "utf-8") for t in texts], pa.string()))
            del ids, flat, texts, a, b
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<long>" * with_ids + ", decoded string" * with_decoded
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
