"""Secret scans: base patterns plus a linear-chain conditional random field.

Texts are cut into tokens of bytes (runs of letters, digits and ``+/_.-`` or single signs) with whole-array operations. The field
tags each token as outside, begin or inside of a secret from its shape, neighbouring words and features of its text. It is trained in
numpy on a bounded sample whose labels come from the base patterns. Decoding is exact Viterbi: a token whose
margin for "outside" exceeds anything transitions could gain is outside in the best path, so chains are cut there and only
the rest is decoded, all pieces in lockstep.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.llm.common import Shipped, batches, least_texts, texts_of

#: Fixed patterns of the base rules.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "model")
CHUNK_BYTES = 2 << 20
FIT_DOCS = 3000
OUT, BEGIN, INSIDE = 0, 1, 2


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, stop, start of the value) of base matches in order: leftmost, non-overlapping for each kind."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end() - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(out)


def _tables():
    kind = np.full(256, 2, np.uint8)
    count = np.zeros(256, np.int64)
    for b in range(256):
        c = chr(b)
        if b <= 32:
            kind[b] = 0
        elif b >= 128 or c.isalnum() or c in "+/_.-":
            kind[b] = 1
        # Counters of 12 bits each: lower, upper, digit, other, hex letter or digit.
        group = 0 if "a" <= c <= "z" else 1 if "A" <= c <= "Z" else 2 if "0" <= c <= "9" else 3
        count[b] = (1 << (12 * group)) | ((1 << 48) if c in "0123456789abcdef" else 0)
    return kind, count


KIND_TABLE, COUNT_TABLE = _tables()
LENGTH_EDGES = np.array([2, 3, 5, 8, 12, 16, 20, 32])
SIZES = (32 * 9, 4 * 2 * 9, 1024, 1024, 1024, 16, 36)


def tokens(flat: np.ndarray, doc_at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop, text) of the tokens of joined texts; ``doc_at`` are the texts' byte offsets (blank between texts)."""
    kind = KIND_TABLE[flat]
    cut = np.empty(len(flat), bool)
    cut[:1] = True
    np.not_equal(kind[1:], kind[:-1], out=cut[1:])
    cut |= kind == 2
    at = np.flatnonzero(cut)
    stop = np.concatenate([at[1:], [len(flat)]])
    real = kind[at] > 0
    start, stop = at[real], stop[real]
    return start, stop, np.searchsorted(doc_at, start, side="right") - 1


def features(flat: np.ndarray, start: np.ndarray, stop: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Feature numbers of each token, one row a feature family."""
    n = len(start)
    if not n:
        return np.zeros((len(SIZES), 0), np.int32)
    size = stop - start
    bounds = np.empty(2 * n, np.int64)
    bounds[::2], bounds[1::2] = start, stop
    total = np.add.reduceat(np.concatenate([COUNT_TABLE[flat], [0]]), bounds)[::2]
    low, up, digit, other, hexa = [(total >> (12 * k)) & 4095 for k in range(5)]
    bucket = np.digitize(size, LENGTH_EDGES)
    high = flat[start] >= 128
    shape = (low > 0) + 2 * (up > 0) + 4 * (digit > 0) + 8 * (other > 0) + 16 * high
    share = np.minimum(3, digit * 4 // np.maximum(size, 1))
    last = len(flat) - 1
    word = size * 31
    for k in range(4):
        word = word * 131 + np.where(size > k, flat[np.minimum(start + k, last)] | 32, 0)
    word = word * 131 + (flat[stop - 1] | 32)
    word = ((word * 2654435761) >> 8) & 1023
    inside = lambda d: np.concatenate([[False] * d, doc[d:] == doc[:-d]]) if n > d else np.zeros(n, bool)
    before = lambda d: np.where(inside(d), np.concatenate([np.zeros(min(d, n), np.int64), word[:max(0, n - d)]]), 0)
    after = np.where(np.concatenate([doc[1:] == doc[:-1], [False]]), np.concatenate([word[1:], [0]]), 0)
    mixed = (digit > 0) & (low + up > 0)
    in_doc = np.bincount(doc, weights=mixed, minlength=n_docs)
    many = np.digitize(in_doc, [1, 3, 10])[doc]
    file = many * 4 + np.minimum(3, bucket // 2)
    mix = np.minimum(3, np.minimum(digit, low + up)) * 9 + bucket
    return np.stack([shape * 9 + bucket, (share * 2 + (hexa == size)) * 9 + bucket, before(1), before(2), after, file, mix]).astype(np.int32)


class SecretField:
    """Weights of the field: one table of three tags for each feature family, and transitions."""

    def __init__(self):
        self.weights = [np.zeros((n, 3)) for n in SIZES]
        self.trans = np.zeros((3, 3))

    def emissions(self, feats: np.ndarray) -> np.ndarray:
        out = np.zeros((feats.shape[1], 3))
        for w, f in zip(self.weights, feats):
            out += w[f]
        return out

    def fit(self, feats: np.ndarray, tags: np.ndarray, steps: int = 60, rate: float = 0.15, penalty: float = 2e-4) -> SecretField:
        """Adam on the penalised likelihood; feats (families, pieces, length), tags (pieces, length) with -1 as filling."""
        pieces, length = tags.shape
        if not pieces:
            return self
        real = tags >= 0
        total = real.sum()
        moments = [[np.zeros_like(w), np.zeros_like(w)] for w in [*self.weights, self.trans]]
        for step in range(1, steps + 1):
            e = self.emissions(feats.reshape(len(SIZES), -1)).reshape(pieces, length, 3)
            e[~real] = 0
            a = np.zeros((length, pieces, 3))
            b = np.zeros((length, pieces, 3))
            a[0] = e[:, 0]
            for t in range(1, length):
                s = a[t - 1][:, :, None] + self.trans
                m = s.max(1)
                nxt = m + np.log(np.exp(s - m[:, None]).sum(1)) + e[:, t]
                a[t] = np.where(real[:, t, None], nxt, a[t - 1])
            for t in range(length - 2, -1, -1):
                s = self.trans + (b[t + 1] + e[:, t + 1])[:, None, :]
                m = s.max(2)
                b[t] = np.where(real[:, t + 1, None], m + np.log(np.exp(s - m[:, :, None]).sum(2)), 0)
            top = a[-1].max(1)
            z = top + np.log(np.exp(a[-1] - top[:, None]).sum(1))
            p = np.exp(a + b - z[None, :, None]).transpose(1, 0, 2)
            gold = np.zeros_like(p)
            np.put_along_axis(gold, np.maximum(tags, 0)[:, :, None], 1, 2)
            d = np.where(real[:, :, None], p - gold, 0) / total
            flow = np.zeros((3, 3))
            for t in range(1, length):
                ok = real[:, t]
                q = np.exp(a[t - 1][ok][:, :, None] + self.trans + (b[t][ok] + e[ok, t])[:, None, :] - z[ok][:, None, None])
                flow += q.sum(0)
                np.subtract.at(flow, (tags[ok, t - 1], tags[ok, t]), 1)
            grads = [np.stack([np.bincount(f.ravel(), weights=d[:, :, k].ravel(), minlength=n) for k in range(3)], 1) for f, n in zip(feats, SIZES)] + [flow / total]
            for w, g, mm in zip([*self.weights, self.trans], grads, moments):
                g = g + penalty / 100 * w
                mm[0] = 0.9 * mm[0] + 0.1 * g
                mm[1] = 0.99 * mm[1] + 0.01 * g * g
                w -= rate * (mm[0] / (1 - 0.9**step)) / (np.sqrt(mm[1] / (1 - 0.99**step)) + 1e-8)
        return self

    def viterbi(self, e: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Best tags of all tokens; a new text starts a new chain."""
        n = len(e)
        tags = np.zeros(n, np.int8)
        if not n:
            return tags
        t = self.trans
        gain = max(max(t[p, y] - t[p, 0] for p in range(3)) + max(t[y, q] - t[0, q] for q in range(3)) for y in (1, 2))
        gain = max(gain, *[t[y, q] - t[0, q] for y in (1, 2) for q in range(3)], *[t[p, y] - t[p, 0] for y in (1, 2) for p in range(3)], 0.0)
        open_ = e[:, 0] - np.maximum(e[:, 1], e[:, 2]) <= gain
        new = np.concatenate([[True], (doc[1:] != doc[:-1])])
        at = np.flatnonzero(open_)
        if not len(at):
            return tags
        begin = at[np.concatenate([[True], (np.diff(at) > 1) | new[at[1:]]])]
        end = np.concatenate([[True], (np.diff(at) > 1) | new[at[1:]]])
        stop = np.concatenate([at[np.flatnonzero(end)[1:] - 1], at[-1:]]) + 1
        size = stop - begin
        order = np.argsort(-size, kind="stable")
        begin, stop, size = begin[order], stop[order], size[order]
        score = e[begin] + np.where(new[begin][:, None], 0, t[0])
        back = []
        for k in range(1, int(size[0])):
            m = int(np.searchsorted(-size, -k, side="left"))  # pieces longer than k
            s = score[:m, :, None] + t
            back.append(s.argmax(1).astype(np.int8))
            score[:m] = s.max(1) + e[begin[:m] + k]
        follows = (stop < n) & ~new[np.minimum(stop, n - 1)]
        best = (score + np.where(follows[:, None], t[:, 0], 0)).argmax(1)
        for k in range(int(size[0]) - 1, -1, -1):
            m = int(np.searchsorted(-size, -k, side="left"))
            tags[begin[:m] + k] = best[:m]
            if k:
                best[:m] = back[k - 1][np.arange(m), best[:m]]
        return tags


def joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    at = np.cumsum([0, *[len(r) + 1 for r in raw]])[:-1]
    return np.frombuffer(b" ".join(raw) or b" ", np.uint8), at


def byte_place(text: str, place: int) -> int:
    return place if text.isascii() else len(text[:place].encode())


def fit_field(texts: list[str], length: int = 48) -> SecretField:
    """Train on pieces of ``length`` tokens: all that hold a base match, twice as many (1000 at least) spread over the rest, and
    as many of the rest again with the longest tokens, which look most like secrets."""
    flat, at = joined(texts)
    start, stop, doc = tokens(flat, at)
    feats = features(flat, start, stop, doc, len(texts))
    tags = np.zeros(len(start), np.int64)
    for d, t in enumerate(texts):
        for _, _, end, value in base_spans(t):
            a, b = at[d] + byte_place(t, value), at[d] + byte_place(t, end)
            i, j = np.searchsorted(start, a), np.searchsorted(start, b)
            if j > i:
                tags[i:j] = INSIDE
                tags[i] = BEGIN
    rows, keep, plain = [], [], []
    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else []
    for a, b in zip(first, [*first[1:], len(doc)]):
        for s in range(a, b, length):
            (keep if tags[s:min(b, s + length)].any() else plain).append(len(rows))
            rows.append((s, min(b, s + length)))
    want = max(1000, 2 * len(keep))
    size = stop - start
    hard = sorted(plain, key=lambda r: -int(size[rows[r][0]:rows[r][1]].max()))[:want]
    plain = sorted({*hard, *plain[::max(1, len(plain) // want)]})
    use = [rows[k] for k in sorted(keep + plain)]
    grid, gold = np.zeros((len(SIZES), len(use), length), np.int32), np.full((len(use), length), -1, np.int64)
    for r, (a, b) in enumerate(use):
        grid[:, r, :b - a], gold[r, :b - a] = feats[:, a:b], tags[a:b]
    return SecretField().fit(grid, gold)


def find_spans(texts: list[str], field: SecretField) -> list[list[tuple[int, int, int]]]:
    """(start, kind, stop) in code points of each text: base spans, and model spans that no base span covers."""
    flat, at = joined(texts)
    start, stop, doc = tokens(flat, at)
    tags = field.viterbi(field.emissions(features(flat, start, stop, doc, len(texts))), doc)
    out = [[(a, k, b) for a, k, b, _ in base_spans(t)] for t in texts]
    hit = np.flatnonzero(tags)
    if len(hit):
        head = np.concatenate([[True], (np.diff(hit) > 1) | (tags[hit[1:]] == BEGIN) | (doc[hit[1:]] != doc[hit[:-1]])])
        heads = np.flatnonzero(head)
        for i, j in zip(hit[heads].tolist(), hit[np.concatenate([heads[1:] - 1, [len(hit) - 1]])].tolist()):
            d = int(doc[i])
            raw = flat[at[d]:stop[j]]
            a, b = int(start[i] - at[d]), int(stop[j] - at[d])
            if not texts[d].isascii():
                more = np.cumsum((raw & 192) == 128)
                a, b = a - int(more[a - 1] if a else 0), b - int(more[b - 1])
            if not any(x < b and a < y for x, k, y in out[d] if k < 3):
                out[d].append((a, 3, b))
    return [sorted(s) for s in out]


def sample_texts(docs: DataFrame, limit: int = FIT_DOCS, max_bytes: int = 20_000) -> list[str]:
    """At most ``limit`` texts to fit on: least hashes of the text among texts of at most ``max_bytes``, half of them with a sign
    that assigns. The bound is the one limit here; scanning reads every whole text."""
    short = docs.select("text").where(F.octet_length("text").between(1, max_bytes))
    hinted = short.where(F.lower("text").rlike("akia|(password|secret|token|key)[\"']? *[:=]"))
    return [t for part in (hinted, short) for t in least_texts(part, limit // 2)]


def fit(docs: DataFrame, text_col: str = "text", limit: int = FIT_DOCS) -> SecretField:
    return fit_field(sample_texts(docs.select(F.col(text_col).alias("text")), limit))


def line(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame, field: SecretField, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document counts of base matches, the digest of base spans, and all spans as ``kind:start:end``.

    Null texts are empty and hold nothing; every row gives a row; other columns are ignored.
    """
    model = Shipped(docs.sparkSession, field)
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(source, "text", CHUNK_BYTES):
            found = find_spans(texts_of(part["text"]), model.value)
            base = [[s for s in row if s[1] < 3] for row in found]
            counts = [pa.array([sum(s[1] == k for s in row) for row in base], pa.int64()) for k in range(3)]
            sha = pa.array([hashlib.sha256(line(row).encode()).hexdigest() for row in base], pa.string())
            yield pa.RecordBatch.from_arrays([part["id"].combine_chunks(), *counts, sha, pa.array([line(r) for r in found], pa.string())], names)

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def redact(docs: DataFrame, field: SecretField, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each found span replaced by ``mark``; overlapping spans become one mark, null texts stay null, other columns stay."""
    model = Shipped(docs.sparkSession, field)
    at = docs.columns.index(text_col)

    def clean(text: str, spans: list[tuple[int, int, int]]) -> str:
        out, place, k = [], 0, 0
        while k < len(spans):
            a, _, b = spans[k]
            k += 1
            while k < len(spans) and spans[k][0] < b:
                b = max(b, spans[k][2])
                k += 1
            out += [text[place:a], mark]
            place = b
        return "".join([*out, text[place:]])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(source, text_col, CHUNK_BYTES):
            raw = part.column(at).to_pylist()
            found = find_spans([t or "" for t in raw], model.value)
            new = [None if t is None else clean(t, s) for t, s in zip(raw, found)]
            yield from part.set_column(at, part.schema.field(at), pa.array(new, part.schema.field(at).type)).combine_chunks().to_batches()

    return docs.mapInArrow(run, docs.schema)
