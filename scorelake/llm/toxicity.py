"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as a hashed word vector and the mean of hashed vectors of its character pieces (3 and 5 bytes, with word ends). Two GRUs read
each window of words in both directions, attention pools their states, a logistic unit scores the window. All windows of a text
overlap by a third; the text's score is the calibrated maximum. Learning: texts are labelled, windows are not, so each
epoch trains on the highest window of every text. The fit uses a bounded sample of labelled rows; scoring reads whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.llm.common import Shipped, batches, crc_mod, texts_of

WINDOW, STRIDE = 48, 32
HIDDEN = 16
WORD_ROWS, WORD_DIMS = 16384, 8
CHAR_ROWS, CHAR_DIMS = 16384, 12
FIT_TOXIC, FIT_CLEAN = 1500, 2000
CHUNK_BYTES = 3 << 20
THRESHOLD = 0.3


def words_of(text: str) -> list[bytes]:
    return text.encode().lower().split()


class Lexicon:
    """Distinct words of a chunk, their hashed word row and the rows of their character pieces."""

    def __init__(self, docs: list[list[bytes]]):
        seen = {w: i for i, w in enumerate(sorted(set().union(*docs)))}  # sorted: the same numbering under every hash seed
        self.ids = [np.fromiter(map(seen.__getitem__, d), np.int32, len(d)) for d in docs]
        raw = [b" " + w + b" " for w in seen] or [b"  "]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        flat = np.frombuffer(b"".join(raw) + b"     ", np.uint8).astype(np.uint64)
        first = np.cumsum(sizes) - sizes
        total = int(sizes.sum())
        owner = np.repeat(np.arange(len(raw)), sizes)
        left = (first + sizes)[owner] - np.arange(total)  # bytes left in the word
        mul = np.uint64(0x9E3779B97F4A7C15)
        self.parts = []
        for n in (3, 5):
            h = np.zeros(total, np.uint64)
            for k in range(n):
                h = (h * np.uint64(257) + flat[k:k + total]) * mul
            ok = left >= n
            self.parts.append((owner[ok], ((h[ok] + np.uint64(n)) * mul >> np.uint64(50)).astype(np.int64)))
        weight = np.cumsum(np.concatenate([[0], flat[:total] * ((np.arange(total) - first[owner] + 1).astype(np.uint64) * mul | np.uint64(1))]).astype(np.uint64))
        self.word = ((weight[first + sizes] - weight[first]) * mul >> np.uint64(50)).astype(np.int64)
        self.size = len(raw)
        both = [np.concatenate([p[k] for p in self.parts]) for k in (0, 1)]
        order = np.argsort(both[0], kind="stable")
        self.owner, self.piece = both[0][order], both[1][order]
        self.count = np.bincount(self.owner, minlength=self.size)


def sigmoid(x):
    return 0.5 * (np.tanh(0.5 * x) + 1)


class ToxicNet:
    """The network: parameters by name, forward pass over windows, and training."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        d, h = WORD_DIMS + CHAR_DIMS, HIDDEN
        self.p = {"word": rng.normal(0, 0.1, (WORD_ROWS, WORD_DIMS)), "char": rng.normal(0, 0.1, (CHAR_ROWS, CHAR_DIMS)), "att": rng.normal(0, 0.3, (2 * h, h)),
                  "v": rng.normal(0, 0.3, h), "out": rng.normal(0, 0.3, 2 * h), "bias": np.full(1, -1.0)}
        for s in "fb":
            self.p |= {s + "x": rng.normal(0, d**-0.5, (d, 3 * h)), s + "h": rng.normal(0, h**-0.5, (h, 3 * h)), s + "b": np.zeros(3 * h)}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.scale = np.array([1.0, 0.0])

    def inputs(self, lex: Lexicon) -> np.ndarray:
        """Vector of each distinct word."""
        out = np.zeros((lex.size, WORD_DIMS + CHAR_DIMS), np.float32)
        out[:, :WORD_DIMS] = self.p["word"][lex.word]
        has = np.flatnonzero(lex.count)
        if len(has):
            starts = np.concatenate([[0], np.cumsum(lex.count[has])[:-1]])
            for a in range(0, len(has), 50_000):  # in slices, so that memory stays small
                b = min(len(has), a + 50_000)
                lo, hi = starts[a], starts[b] if b < len(has) else len(lex.piece)
                out[has[a:b], WORD_DIMS:] = np.add.reduceat(self.p["char"][lex.piece[lo:hi]], starts[a:b] - lo, axis=0)
            out[:, WORD_DIMS:] /= np.sqrt(np.maximum(lex.count, 1))[:, None]
        return out

    def _gru(self, side: str, gate: np.ndarray, win: np.ndarray, keep: list | None) -> np.ndarray:
        """States (length, windows, hidden); ``gate`` has the input part of each word's gates, windows are -1 where no word is."""
        h, (n, length) = HIDDEN, win.shape
        state = np.zeros((n, h), np.float32)
        out = np.zeros((length, n, h), np.float32)
        wide = self.p[side + "h"]
        for t in range(length) if side == "f" else range(length - 1, -1, -1):
            real = (win[:, t] >= 0)[:, None]
            x = gate[win[:, t]]
            u = state @ wide[:, :2 * h]
            z, r = sigmoid(x[:, :h] + u[:, :h]), sigmoid(x[:, h:2 * h] + u[:, h:])
            c = np.tanh(x[:, 2 * h:] + (r * state) @ wide[:, 2 * h:])
            new = np.where(real, (1 - z) * state + z * c, state)
            if keep is not None:
                keep.append((t, state, z, r, c, real))
            state = out[t] = new
        return out

    def gates(self, words: np.ndarray) -> dict[str, np.ndarray]:
        """Input part of the gates of each distinct word, for both directions."""
        return {s: words @ self.p[s + "x"] + self.p[s + "b"] for s in "fb"}

    def windows(self, gates: dict[str, np.ndarray], win: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Log odds of each window of word numbers."""
        p = self.p
        sides = []
        for s in "fb":
            memo = [] if keep is not None else None
            sides.append(self._gru(s, gates[s], win, memo))
            if keep is not None:
                keep[s] = memo
        states = np.concatenate(sides, 2)
        u = np.tanh(states @ p["att"])
        score = np.where((win >= 0).T, u @ p["v"], -1e9)
        a = np.exp(score - score.max(0))
        a /= a.sum(0)
        pooled = np.einsum("tn,tnh->nh", a, states)
        if keep is not None:
            keep |= {"states": states, "u": u, "a": a, "pooled": pooled}
        return pooled @ p["out"] + p["bias"][0]

    def gradients(self, lex: Lexicon, win: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
        """Backpropagation through time of the weighted logistic loss."""
        p, h = self.p, HIDDEN
        words = self.inputs(lex)
        keep: dict = {}
        d = (sigmoid(self.windows(self.gates(words), win, keep)) - y) * weight
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["out"], g["bias"] = keep["pooled"].T @ d, np.array([d.sum()], np.float32)
        dp = d[:, None] * p["out"]
        states, a, u = keep["states"], keep["a"], keep["u"]
        da = np.einsum("nh,tnh->tn", dp, states)
        ds = a * (da - (a * da).sum(0))
        du = ds[:, :, None] * p["v"] * (1 - u * u)
        g["v"] = np.einsum("tn,tnh->h", ds, u)
        g["att"] = np.einsum("tni,tnj->ij", states, du)
        dstates = a[:, :, None] * dp + du @ p["att"].T
        dwords = np.zeros_like(words)
        for k, s in enumerate("fb"):
            wide = p[s + "h"]
            carry = np.zeros((len(win), h), np.float32)
            dgate = np.zeros((len(words), 3 * h), np.float32)
            for t, state, z, r, c, real in reversed(keep[s]):
                dn = carry + dstates[t][:, k * h:(k + 1) * h]
                live = dn * real
                dc = live * z * (1 - c * c)
                dz = live * (c - state) * z * (1 - z)
                drs = dc @ wide[:, 2 * h:].T
                dr = drs * state * r * (1 - r)
                flow = np.concatenate([dz, dr], 1)
                g[s + "h"][:, :2 * h] += state.T @ flow
                g[s + "h"][:, 2 * h:] += (r * state).T @ dc
                carry = np.where(real, live * (1 - z) + drs * r + flow @ wide[:, :2 * h].T, dn)
                ok = real[:, 0]
                np.add.at(dgate, win[ok, t], np.concatenate([flow, dc], 1)[ok])
            g[s + "b"] = dgate.sum(0)
            g[s + "x"] = words.T @ dgate
            dwords += dgate @ p[s + "x"].T
        np.add.at(g["word"], lex.word, dwords[:, :WORD_DIMS])
        back = dwords[:, WORD_DIMS:] / np.sqrt(np.maximum(lex.count, 1))[:, None]
        np.add.at(g["char"], lex.piece, back[lex.owner])
        return g

    def fit(self, texts: list[str], labels: np.ndarray, weight: np.ndarray, epochs: int = 6, batch: int = 48, rate: float = 0.02) -> ToxicNet:
        """Train on the highest window of each text; a fifth of the texts calibrates the maximum. ``weight`` restores the shares of the classes."""
        if not len(texts) or len(set(labels.tolist())) < 2:
            self.scale = np.array([0.0, 3.0 if len(texts) and labels.all() else -3.0])
            return self
        rng = np.random.default_rng(11)
        docs = [words_of(t) for t in texts]
        lex = Lexicon(docs)
        cuts = [cut(i) for i in lex.ids]
        # First guess of the telling window: log odds of its word and character rows by document frequency.
        odds = np.zeros(lex.size, np.float32)
        for rows, size in ((lex.word, WORD_ROWS), (lex.piece, CHAR_ROWS)):
            count = np.zeros((2, size))
            at = np.concatenate([np.searchsorted(lex.owner, np.arange(lex.size)), [len(lex.owner)]])
            for ids, y in zip(lex.ids, labels):
                have = np.unique(ids)
                hit = np.unique(rows[have] if rows is lex.word else np.concatenate([lex.piece[at[i]:at[i + 1]] for i in have.tolist()] or [np.zeros(0, np.int64)]))
                count[int(y), hit] += 1
            n = np.bincount(labels.astype(int), minlength=2)
            value = np.log((count[1] + 0.5) / (n[1] + 1)) - np.log((count[0] + 0.5) / (n[0] + 1))
            if rows is lex.word:
                odds = np.maximum(odds, value[rows])
                self.p["word"][:, 0] = value / 2
            else:
                np.maximum.at(odds, lex.owner, value[lex.piece].astype(np.float32))
                self.p["char"][:, 0] = value / 2
        chosen = [w[np.where(w >= 0, odds[w], 0).max(1).argmax()] for w in cuts]
        test = np.arange(len(texts)) % 5 == 4
        train = np.flatnonzero(~test)
        even = np.where(labels == 1, 0.5 / max(1, labels[train].sum()), 0.5 / max(1, (1 - labels[train]).sum())) * len(train)
        m = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in self.p.items()}
        # A small sample goes round more often, in smaller steps' worth of texts.
        batch = int(min(batch, max(16, len(train) // 12)))
        epochs = max(epochs, -(-120 * batch // len(train)))
        step = 0
        for epoch in range(epochs):
            if epoch:
                top, _ = self.peaks(lex, cuts)
                chosen = [w[t] for w, t in zip(cuts, top)]
            order = rng.permutation(train)
            for s in range(0, len(order), batch):
                rows = order[s:s + batch]
                win = np.stack([chosen[r] for r in rows])
                used, local = np.unique(win, return_inverse=True)
                small = lex_part(lex, used[used >= 0])
                win = local.reshape(win.shape) - int(used[0] < 0)
                g = self.gradients(small, win, labels[rows].astype(np.float32), (even[rows] / len(rows)).astype(np.float32))
                step += 1
                for k, w in self.p.items():
                    m[k][0] += 0.1 * (g[k] - m[k][0])
                    m[k][1] += 0.01 * (g[k] ** 2 - m[k][1])
                    w -= (rate if epoch < epochs - 2 else rate / 4) * (m[k][0] / (1 - 0.9**step)) / (np.sqrt(m[k][1] / (1 - 0.99**step)) + 1e-6)
        peak = self.peaks(lex, cuts)[1]
        self.scale = calibrate(peak[test], labels[test], weight[test])
        return self

    def peaks(self, lex: Lexicon, cuts: list[np.ndarray]) -> tuple[list[int], np.ndarray]:
        """For each text its highest window and that window's log odds."""
        gates = self.gates(self.inputs(lex))
        flat = np.concatenate(cuts)
        odds = np.concatenate([self.windows(gates, flat[s:s + 8192]) for s in range(0, len(flat), 8192)]).astype(np.float64)
        first = np.cumsum([0, *[len(c) for c in cuts[:-1]]])
        return [int(odds[f:f + len(c)].argmax()) for f, c in zip(first, cuts)], np.maximum.reduceat(odds, first)

    def score(self, texts: list[str]) -> np.ndarray:
        """Probability of each text."""
        lex = Lexicon([words_of(t) for t in texts])
        peak = self.peaks(lex, [cut(i) for i in lex.ids])[1]
        return 1 / (1 + np.exp(-np.clip(self.scale[0] * peak + self.scale[1], -30, 30)))


def lex_part(lex: Lexicon, used: np.ndarray) -> Lexicon:
    """The lexicon of some of its words, numbered anew in their order."""
    part = Lexicon.__new__(Lexicon)
    at = np.searchsorted(lex.owner, used)
    count = lex.count[used]
    part.size, part.word, part.count = len(used), lex.word[used], count
    part.owner = np.repeat(np.arange(len(used)), count)
    part.piece = lex.piece[np.repeat(at - np.cumsum(count) + count, count) + np.arange(int(count.sum()))]
    return part


def cut(ids: np.ndarray) -> np.ndarray:
    """Windows of word numbers, filled with -1; the last one ends with the text. A text without words has one empty window."""
    n = len(ids)
    if n <= WINDOW:
        out = np.full((1, WINDOW), -1, np.int32)
        out[0, :n] = ids
        return out
    starts = np.arange(0, n - WINDOW, STRIDE)
    return ids[np.concatenate([starts, [n - WINDOW]])[:, None] + np.arange(WINDOW)]


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 400) -> np.ndarray:
    """Scale and shift of log odds by weighted logistic regression."""
    w, m, v = np.array([1.0, 0.0]), np.zeros(2), np.zeros(2)
    weight = weight / max(weight.sum(), 1e-9)
    for step in range(1, steps + 1):
        d = (1 / (1 + np.exp(-np.clip(w[0] * x + w[1], -30, 30))) - y) * weight
        g = np.array([d @ x, d.sum()]) + 1e-4 * np.array([w[0] - 1, w[1]])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return w


def held_out() -> F.Column:
    return crc_mod("doc_id", 4) == 2


def fit(docs: DataFrame, labels: DataFrame, toxic_rows: int = FIT_TOXIC, clean_rows: int = FIT_CLEAN) -> ToxicNet:
    """Fit on at most so many labelled rows of each class (least hashes of the id), never on held-out ids. Ids with two labels are not used;
    an id on several document rows is fitted on its least text."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("y")).where("doc_id IS NOT NULL AND y IN (0, 1)").where(~held_out())
    known = known.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("most")).where("y = most").select("doc_id", "y")
    total = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = [r for y, n in ((1, toxic_rows), (0, clean_rows)) for r in known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n).collect()]
    sample = docs.sparkSession.createDataFrame([(r["doc_id"], r["y"]) for r in rows], "id long, y int")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "id")  # at most toxic_rows + clean_rows rows
    # An id on several rows: the least text stands for it, so the fit does not depend on partitioning.
    got = texts.groupBy("id").agg(F.min("text").alias("text"), F.first("y").alias("y")).toArrow().sort_by("id")
    y = got["y"].to_numpy().astype(np.float64)
    n = np.bincount(y.astype(int), minlength=2)
    weight = np.where(y == 1, total.get(1, 0) / max(1, n[1]), total.get(0, 0) / max(1, n[0]))
    order = np.random.default_rng(3).permutation(len(y))
    raw = got["text"].to_pylist()
    return ToxicNet().fit([raw[i] for i in order], y[order], weight[order])


def score(docs: DataFrame, model: ToxicNet, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted. Null texts are empty; every row gives a row; only the text is read."""
    box = Shipped(docs.sparkSession, model)
    names = ["doc_id", "held_out", "score", "predicted"]

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(source, "text", CHUNK_BYTES):
            s = box.value.score(texts_of(part["text"]))
            yield pa.RecordBatch.from_arrays([part["doc_id"].combine_chunks(), part["held_out"].combine_chunks(), pa.array(s), pa.array((s >= threshold).astype(np.int32))], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
