"""Language-model scoring: a small causal self-attention model in numpy over the subword ids of a public tokenizer.

Words are cut into subwords by the tokenizers library, each distinct word once. The model has one attention layer: token and place vectors
give queries, keys and values, a mask hides later tokens, and the attended vector predicts the class of the next subword; the
subword inside its class follows from smoothed counts over all training texts. Classes group subwords that occur in the same training texts.
Texts are read in windows of ``WINDOW`` ids that overlap by ``WINDOW - STRIDE``; each id is scored once, in the first window that reaches it.

Every training text is learned from. Subword ids of all texts are landed once. Classes come from a low-rank sketch of which training texts hold
which subwords, summed by Spark. The layer starts from a fit on a few texts on the driver and then sees every window of every training text
once, in ``len(ROUNDS)`` rounds: in a round each partition trains a copy on its own texts, and the changes are averaged by Spark.

A word's probability is the base probability below, whose counts hold which whole words are frequent, times the lift of its first subword's
class: how much likelier the attention layer takes that class to be here than over all training words. A constant share keeps the
lift from running away; it is fitted by expectation steps on a histogram of the lifts of all training words, each taken before its copy of
the layer learned from it. A text's score is the sum over its
words and its end; ``attention_score`` is that of the subword model alone.

The base score is add-one unigram. Word counts cover all training documents. The most frequent words are broadcast (a
fixed number); rarer words are looked up by a shuffle join on the word's hash, after counting them per document.
"""

from __future__ import annotations

import json
import re
import string
from array import array
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorelake.llm.bpe import PairIndexBPE
from scorelake.llm.common import Shipped, LibraryUnits, PieceMemo, coded_words, crc_mod, landed, pieces_at, read_text, strung, text_bytes

WINDOW, STRIDE = 24, 18
DIM, CLASSES = 8, 16
FREQUENT = 200_000
FIT_TEXTS = 600
CHUNK_BYTES = 2 << 20
#: Windows scored at once: their attention weights stay in the processor's cache.
BLOCK = 192
#: Text counted or cut at once: a larger share of its words is repeated.
COUNT_BYTES, CUT_BYTES = 16 << 20, 12 << 20
#: Rows read from a file at once, and rows in an Arrow batch between Spark and Python: whole texts in buffers of many MB come and go and
#: leave the memory in and outside the heap in pieces, which add up.
ARROW_ROWS = 500
ROWS_AT_ONCE = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
#: Words kept in a worker's memo.
MEMO_WORDS = 400_000
#: Marks cut off a word's end.
MARKS = string.punctuation
#: Words whose library rules before the cut are lower case alone, and how many of them one call of the library takes.
LATIN = re.compile("[!-~\u00a1-\u024f]+")
TOGETHER = 32
#: Sixteenths of the training texts in each round, and the windows and number of copies a round is dealt to.
ROUNDS = (1, 3, 4, 8)
COPY_WINDOWS, COPIES = 50_000, 256
#: Texts side by side in the sums by id.
SIDE = 64
#: Width of the sketch; bins of the histogram of lifts, over -LIFT to LIFT.
SKETCH, BINS, LIFT = 20, 2_000, 20.0
BLANKS = {"Regex": r"\s+"}
LOG10 = float(np.log(10))


def is_training() -> F.Column:
    return crc_mod("doc_id", 7) != 2


@contextmanager
def small_batches(spark: SparkSession):
    """Inside, tasks read at most ``ARROW_ROWS`` rows at once and get no more in an Arrow batch."""
    before = {name: spark.conf.get(name) for name in ROWS_AT_ONCE}
    try:
        for name, rows in before.items():
            spark.conf.set(name, min(int(rows), ARROW_ROWS) if int(rows) > 0 else ARROW_ROWS)
        yield
    finally:
        for name, rows in before.items():
            spark.conf.set(name, rows)


def runs(source: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.Table]:
    """Runs of whole rows of about ``limit`` bytes of column ``text``, across Arrow batches: their size changes no run. A longer row is a run of its own."""
    held, size = [], 0
    for batch in source:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch[text]), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < len(ends):
            base = int(ends[start - 1]) if start else 0
            stop = max(start if held else start + 1, int(np.searchsorted(ends, base + limit - size, side="right")))
            if stop > start:
                held.append(batch.slice(start, stop - start))
                size += int(ends[stop - 1]) - base
            if stop < len(ends):
                yield pa.Table.from_batches(held)
                held, size = [], 0
            start = stop
    if held:
        yield pa.Table.from_batches(held)


def count_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n) over all texts; tasks count first, so a frequent word costs one row a task."""
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in runs(source, "text", COUNT_BYTES):
            codes, _, words = coded_words(part["text"])
            yield pa.RecordBatch.from_arrays([words.cast(pa.binary()), pa.array(np.bincount(codes, minlength=len(words)))], ["word", "n"])
            pa.default_memory_pool().release_unused()

    return docs.select(F.col(text_col).alias("text")).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, limit: int) -> tuple[int, int, pa.Table]:
    """(occurrences, words, table): how many there are in ``counts`` (word, n, h), and the ``limit`` most frequent words, ties to the least hash.
    One pass sums by size of the count, to an eighth of a power of two; only words of the sizes that hold the wanted ones are then sorted."""
    size = F.floor(F.log2("n") * 8)
    sums = counts.groupBy(size.alias("size")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()  # at most 8 * 63 rows
    taken, least = 0, 0
    for r in sorted(sums, key=lambda r: -r["size"]):
        if taken < limit:
            taken, least = taken + r["v"], r["size"]
    top = counts.where(size >= least).orderBy(F.desc("n"), "h").limit(limit).select("word", "n").toArrow()
    return sum(r["n"] for r in sums), sum(r["v"] for r in sums), top


class SubwordBox(LibraryUnits):
    """Subword ids of words, each after a blank, with a memo in each Python worker."""

    def prepare(self) -> None:
        """The pair index where the file has its rules, and then no tokenizer of the library in this worker."""
        if "index" not in self.__dict__:
            self.index = PairIndexBPE(self.spec) if PairIndexBPE.fits(json.loads(self.spec)) else None
        if self.index:
            self.__dict__.setdefault("memo", PieceMemo())
        else:
            self.tokenizer()

    def tokenizer(self):
        made = super().tokenizer()
        if "index" not in self.__dict__:
            self.prepare()
        if not self.index and "bare" not in self.__dict__:
            self.bare = self.split_mark = None
            rules = json.loads(self.spec)
            steps = lambda rule, inner: [] if rule is None else rule.get(inner, [rule])
            first, cuts = steps(rules["normalizer"], "normalizers"), steps(rules["pre_tokenizer"], "pretokenizers")
            lower = {"Lowercase"} <= {r["type"] for r in first} <= {"NFC", "Replace", "Lowercase"} and all(r.get("pattern", BLANKS) == BLANKS for r in first)
            alone = all(r["type"] == "Split" or (r["type"] == "ByteLevel" and not r["add_prefix_space"]) for r in cuts)
            marks = [t["content"] for t in rules["added_tokens"] if t["special"] and not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"])]
            if lower and alone and marks:
                from tokenizers import Tokenizer

                self.split_mark = marks[0]
                self.bare = Tokenizer.from_str(json.dumps(rules | {"normalizer": None}))
        return made

    def cut(self, units: list[str]) -> list[bytes]:
        """Ids of each unit: a word, which stands after a blank, or the marks at a word's end, written with a blank behind.

        Many words go through the library in one call where its rules allow: a special token, which always stands alone, parts them. The rules
        that only change case are then applied here. All other units go one by one. A file with the rules of the pair index goes through that.
        """
        if self.index:
            return self.index.ready().units([u[:-1] if u[-1] == " " else u for u in units])
        texts = [u[:-1] if u[-1] == " " else " " + u for u in units]
        joint = [k for k, u in enumerate(units) if LATIN.fullmatch(u) and self.split_mark not in u] if self.bare else []
        out: list = [None] * len(units)
        if joint:
            parts = [self.split_mark.join([texts[k] for k in joint[s:s + TOGETHER]]).lower() + self.split_mark for s in range(0, len(joint), TOGETHER)]
            parting = self.bare.token_to_id(self.split_mark)
            raw = b"".join([array("I", e.ids).tobytes() for s in range(0, len(parts), 1000) for e in self.bare.encode_batch_fast(parts[s:s + 1000], add_special_tokens=False)])
            stops = (np.flatnonzero(np.frombuffer(raw, "<u4") == parting) * 4).tolist()
            for k, a, b in zip(joint, [0, *[x + 4 for x in stops]], stops, strict=False):
                out[k] = raw[a:b]
        rest = [k for k, ids in enumerate(out) if ids is None]
        for k, ids in zip(rest, self.ids([texts[k] for k in rest])):
            out[k] = ids
        return out

    def words(self, words: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each of some different words."""
        ids, sizes = self.coded(pa.array(words, pa.binary()).cast(pa.string()))
        ends = np.cumsum(sizes)
        return [ids[a:b].astype("<u4").tobytes() for a, b in zip(ends - sizes, ends)]

    def coded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes): the ids of different words one behind the other, and how many each has. Marks at a word's end are subwords of
        their own, so that the same word with and without them is cut once."""
        self.prepare()
        self.memo.limit = MEMO_WORDS
        core = pc.ascii_rtrim(words, MARKS)
        size, full = (pc.binary_length(x).to_numpy(zero_copy_only=False) for x in (core, words))
        cores = pc.dictionary_encode(pc.if_else(pa.array(size > 0), core, words))
        marked = np.flatnonzero((size > 0) & (size < full))
        raw, bounds = text_bytes(words)
        halves = pieces_at(raw, np.stack([bounds[:-1], bounds[:-1] + np.where(size > 0, size, full)], 1).ravel())
        ends = pc.dictionary_encode(halves.take(pa.array(2 * marked + 1)))
        units = pa.concat_arrays([cores.dictionary, pc.binary_join_element_wise(ends.dictionary, "", " ")])
        flat, start, sizes = self.memo.get(units, self.cut)
        more = np.zeros(len(words), np.int64)
        more[marked] = 1
        at = np.arange(len(words)) + np.cumsum(more) - more
        pieces = np.empty(len(words) + len(marked), np.int64)
        pieces[at] = cores.indices.to_numpy()
        pieces[at[marked] + 1] = len(cores.dictionary) + ends.indices.to_numpy()
        sizes = sizes[pieces]
        return strung(flat, start[pieces], sizes), np.add.reduceat(sizes, at) if len(at) else sizes


def unpacked(part: pa.Table, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, bounds, begin): landed ids of some texts, where each text starts among them, and where words and ends begin."""
    lengths = pc.binary_length(part["marks"]).to_numpy()
    ids = np.frombuffer(b"".join(part["ids"].to_pylist()), kind).astype(np.int64)
    begin = np.flatnonzero(np.frombuffer(b"".join(part["marks"].to_pylist()), np.uint8))
    return ids, np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]), begin


def id_sums(texts: DataFrame, kind: str, size: int, width: int, values) -> np.ndarray:
    """Sums over all texts of ``values(rows, has, h, local, begins)``, a few texts at a time, by id: at most ``size`` rows reach the driver.

    ``rows`` are the ids of these texts, ``has`` which of the texts (columns) holds which of them, ``h`` the texts' hashes; ``local`` numbers their ids
    by place in ``rows``, in order, and ``begins`` those that begin a word."""
    names = ["id", *[f"x{i}" for i in range(width)]]

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen, place = np.zeros((size, width)), np.zeros(size, bool), np.zeros(size, np.int64)
        for part in runs(source, "ids", CHUNK_BYTES // 4):
            ids, bounds, begin = unpacked(part, kind)
            h = part["h"].to_numpy()
            for s in range(0, len(h), SIDE):
                cut = bounds[s:s + SIDE + 1]
                mine = ids[cut[0]:cut[-1]]
                seen[mine] = True
                rows = np.flatnonzero(seen)
                seen[rows] = False
                place[rows] = np.arange(len(rows))
                local = place[mine]
                flags = np.zeros(len(rows) * SIDE, np.uint8)  # bytes stay in the processor's cache while they are set
                flags[local * SIDE + np.repeat(np.arange(len(cut) - 1), np.diff(cut))] = 1
                has = flags.reshape(-1, SIDE)[:, :len(cut) - 1]
                first, last = np.searchsorted(begin, cut[[0, -1]])
                total[rows] += values(rows, has, h[s:s + SIDE], local, local[begin[first:last] - cut[0]])
        hit = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(hit), *[pa.array(np.ascontiguousarray(total[hit, i])) for i in range(width)]], names)

    rows = texts.mapInArrow(run, "id long, " + ", ".join(f"{c} double" for c in names[1:])).groupBy("id").agg(*[F.sum(c).alias(c) for c in names[1:]]).toArrow()
    out = np.zeros((size, width))
    out[rows["id"].to_numpy()] = np.stack([rows[c].to_numpy() for c in names[1:]], 1)
    return out


def least_ids(texts: DataFrame, kind: str, limit: int) -> list[np.ndarray]:
    """Ids of at most ``limit`` different texts (h, ids), those with the least hashes, in that order. Hashes alone are ranked."""
    chosen = texts.select("h").distinct().orderBy("h").limit(limit).collect()
    if not chosen:
        return []
    wanted = texts.sparkSession.createDataFrame([(r["h"],) for r in chosen], "h long")
    rows = texts.select("h", "ids").join(F.broadcast(wanted), "h").groupBy("h").agg(F.min("ids").alias("ids")).collect()  # at most ``limit`` rows
    return [np.frombuffer(r["ids"], kind).astype(np.int64) for r in sorted(rows, key=lambda r: r["h"])]


def count_subwords(texts: DataFrame, kind: str, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How often each subword occurs in all training texts, how often it begins a word or end, and how many texts hold it."""
    def numbers(rows, has, h, local, begins):
        return np.stack([np.bincount(local, minlength=len(rows)), np.bincount(begins, minlength=len(rows)), has.sum(1)], 1)

    got = id_sums(texts, kind, size, 3, numbers)
    return got[:, 0].astype(np.int64), got[:, 1].astype(np.int64), got[:, 2]


def shared_text_classes(spark, texts: DataFrame, often: np.ndarray, n_texts: int, kind: str, size: int, end: int, dims: int = 12, turns: int = 15, seed: int = 3) -> np.ndarray | None:
    """Class of each id: spherical k-means over a low-rank sketch of which training texts hold it (``often``: how many). The end has a class of its
    own; ids in fewer than two of the texts share the last class. None if the texts hold too little.

    With X the (id, text) table of ``1 / sqrt(ids of the text)``, rows scaled to length one: X times random signs (bits of the text's hash), then
    X X' times an orthonormal basis of that; each is one pass of sums by id.
    """
    often = np.where(np.arange(size) == end, 0, often)
    use = np.flatnonzero(often >= 2)
    groups = CLASSES - 2
    if len(use) < 4 * groups or n_texts < SKETCH:
        return None
    used = Shipped(spark, often >= 2)

    def weights(rows, has):
        mine, has = used.value[rows].astype(float), has.astype(float)
        return has, mine[:, None], 1 / np.sqrt(np.maximum(mine @ has, 1))[:, None]

    def signs(rows, has, h, local, begins):
        has, mine, a = weights(rows, has)
        sign = ((h[:, None] >> np.arange(SKETCH)) & 1) * 2.0 - 1
        return has @ np.concatenate([sign * a, a * a], 1) * mine

    first = id_sums(texts, kind, size, SKETCH + 1, signs)[use]
    norm = np.sqrt(first[:, -1:])
    q = np.linalg.qr(first[:, :-1] / norm)[0]
    basis = np.zeros((size, SKETCH))
    basis[use] = q / norm
    shared = Shipped(spark, basis)

    def again(rows, has, h, local, begins):
        has, mine, a = weights(rows, has)
        return has @ (has.T @ shared.value[rows] * (a * a)) * mine

    y = id_sums(texts, kind, size, SKETCH, again)[use] / norm
    used.drop(), shared.drop()
    gram = q.T @ y
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    top = np.argsort(-values, kind="stable")[:dims]
    z = y @ vectors[:, top] / np.sqrt(np.maximum(values[top], 1e-12))
    z /= np.linalg.norm(z, axis=1, keepdims=True) + 1e-9
    rng = np.random.default_rng(seed)
    weight = np.sqrt(often[use])
    middle = z[rng.choice(len(z), groups, replace=False, p=weight / weight.sum())]
    for _ in range(turns):
        near = (z @ middle.T).argmax(1)
        for k in range(groups):
            if (near == k).any():
                middle[k] = weight[near == k] @ z[near == k]
                middle[k] /= np.linalg.norm(middle[k]) + 1e-9
    cls = np.full(size, CLASSES - 1)
    cls[use], cls[end] = near, CLASSES - 2
    return cls


def learn(spark, model: AttentionLM, texts: DataFrame, n_ids: int, kind: str) -> AttentionLM:
    """Train on every window of ``texts`` (h, doc_id, ids, marks) and fit the share: each round's copies start from the same parameters, see their texts
    in hash order, and are averaged row by row over the windows of the copies that changed the row."""
    names = list(model.p)
    flat = lambda p: np.concatenate([p[n].ravel() for n in names]).reshape(-1, DIM)
    lifts, seen = np.zeros(BINS), 0
    schema = "row long, weight double, " + ", ".join(f"d{i} double" for i in range(DIM))
    for k, share in enumerate(ROUNDS):
        windows = n_ids * share // 16 // WINDOW + 1
        copies = max(1, min(COPIES, windows // COPY_WINDOWS))
        batch = max(96, min(768, windows // copies // 400))
        shared, height, rate = Shipped(spark, model), len(flat(model.p)), 0.02 / (k + 2)

        def run(source: Iterator[pa.RecordBatch], shared=shared, height=height, rate=rate, batch=batch) -> Iterator[pa.RecordBatch]:
            mine, count = shared.value.copy(), 0
            start, steps, hist = flat(mine.p), mine.adam(), np.zeros(BINS)
            for part in runs(source, "ids", CHUNK_BYTES // 4):
                ids, bounds, begin = unpacked(part, kind)
                context, target, word = mine.cut(ids, bounds, begin)
                order = np.random.default_rng(9).permutation(len(context))
                for s in range(0, len(order), batch):
                    pick = order[s:s + batch]
                    keep: dict = {}
                    g = mine.gradients(context[pick], target[pick], keep)
                    t = target[pick][word[pick]]
                    lift = keep["hit"][word[pick]] - mine.usual[mine.cls[t]]
                    hist += np.bincount(np.clip((lift + LIFT) * (BINS / 2 / LIFT), 0, BINS - 1).astype(np.int64), minlength=BINS)
                    steps(g, rate * len(pick) / batch)
                    count += len(pick)
            change = (flat(mine.p) - start).astype(np.float64)
            hit = np.flatnonzero(change.any(1))
            bins = np.flatnonzero(hist)
            d = np.concatenate([change[hit] * count, np.repeat(hist[bins, None], DIM, 1)])
            cols = [np.concatenate([hit, height + bins]), np.full(len(d), float(count)), *np.ascontiguousarray(d.T)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["row", "weight", *[f"d{i}" for i in range(DIM)]])

        below = sum(ROUNDS[:k])
        mine = texts.where(F.pmod(F.shiftright(F.xxhash64("h", "doc_id"), 32), F.lit(16)).between(below, below + share - 1))
        made = mine.repartition(copies, "h", "doc_id").sortWithinPartitions("h", "doc_id", "ids").mapInArrow(run, schema)  # equal texts spread by id
        got = made.groupBy("row").agg(F.sum("weight").alias("weight"), *[F.sum(f"d{i}").alias(f"d{i}") for i in range(DIM)]).toArrow()  # a row a subword
        shared.drop()
        row, d = got["row"].to_numpy(), np.stack([got[f"d{i}"].to_numpy() for i in range(DIM)], 1)
        real = row < height
        now = flat(model.p).astype(np.float64)
        now[row[real]] += d[real] / got["weight"].to_numpy()[real, None]
        lifts[row[~real] - height] += d[~real, 0]
        model, at = model.copy(), 0
        for n in names:
            size = model.p[n].size
            model.p[n] = now.ravel()[at:at + size].reshape(model.p[n].shape).astype(np.float32)
            at += size
    return model.fit_share((np.arange(BINS) + 0.5) * (2 * LIFT / BINS) - LIFT, lifts)


class AttentionLM:
    """Parameters, window scores and training. ``end`` closes every text; ``start`` stands before its first id."""

    def __init__(self, counts: np.ndarray, end: int, begins: np.ndarray, cls: np.ndarray | None = None, seed: int = 5):
        size = len(counts) + 1
        self.end, self.start = end, size - 1
        smooth = np.concatenate([counts, [0]]) + 0.5
        smooth[self.start] = 0  # never a target
        p = smooth / smooth.sum()
        order = np.argsort(-p, kind="stable")
        self.cls = np.empty(size, np.int64)
        if cls is None:  # classes of about equal mass; the most frequent ids stand alone
            self.cls[order] = np.minimum(CLASSES - 1, (np.cumsum(p[order]) - p[order] / 2) * CLASSES).astype(np.int64)
        else:
            self.cls[:-1], self.cls[-1] = cls, CLASSES - 1
        mass = np.bincount(self.cls, weights=p, minlength=CLASSES)
        self.inside = np.log(np.maximum(p, 1e-300) / np.maximum(mass[self.cls], 1e-300)).astype(np.float32)
        words = np.bincount(self.cls[:-1], weights=begins + 1e-3, minlength=CLASSES) + 1e-3
        self.usual = np.log(words / words.sum())  # of the class that begins a word
        self.share = 0.5
        rng = np.random.default_rng(seed)
        draw = lambda *s: rng.normal(0, 0.3, s).astype(np.float32)
        self.p = {"emb": draw(size, DIM), "pos": draw(WINDOW, DIM), "q": draw(DIM, DIM), "k": draw(DIM, DIM), "v": draw(DIM, DIM), "own": draw(DIM, DIM), "out": draw(DIM, CLASSES),
                  "bias": np.log(np.maximum(mass, 1e-9)).astype(np.float32)}
        self.mask = np.where(np.tri(WINDOW, dtype=bool), 0, -1e9).astype(np.float32)

    def windows(self, ids: np.ndarray) -> np.ndarray:
        """Class log probabilities after each place of windows of context ids (n, WINDOW)."""
        p = self.p
        x = p["emb"][ids] + p["pos"]
        q, k, v = x @ p["q"], x @ p["k"], x @ p["v"]
        a = np.matmul(q, k.transpose(0, 2, 1))
        a *= DIM**-0.5
        a += self.mask
        a -= a.max(2, keepdims=True)
        np.exp(a, out=a)
        a /= a.sum(2, keepdims=True)
        h = np.tanh(np.matmul(a, v) + x @ p["own"])
        z = h @ p["out"] + p["bias"]
        z -= z.max(2, keepdims=True)
        z -= np.log(np.exp(z).sum(2, keepdims=True))
        return z

    def class_scores(self, context: np.ndarray, target: np.ndarray, skip: int) -> np.ndarray:
        """Log probability of each target id after places ``skip`` on of windows of context ids: the forward pass alone.

        The exponents of a block need no shift while they are far from overflow.
        """
        p = self.p
        if "wide" not in self.__dict__:
            # Keys, values, queries and own parts of all token vectors and places: linear, so taken once and added in a window.
            wide = np.concatenate([p["k"], p["v"], p["q"] * DIM**-0.5, p["own"]], 1)
            self.wide = p["emb"] @ wide, p["pos"] @ wide
            self.tri = np.tri(WINDOW, dtype=np.float32)
        n = len(context)
        y = self.wide[0].take(context, axis=0)
        y += self.wide[1]
        a = np.matmul(y[:, skip:, 2 * DIM:3 * DIM], y[:, :, :DIM].transpose(0, 2, 1))
        if max(a.max(), -a.min()) > 60:
            a += self.mask[skip:]
            a -= a.max(2, keepdims=True)
        np.exp(a, out=a)
        a *= self.tri[skip:]
        h = np.matmul(a, y[:, :, DIM:2 * DIM])
        h /= (a.reshape(-1, WINDOW) @ np.ones(WINDOW, np.float32)).reshape(n, -1, 1)
        h += y[:, skip:, 3 * DIM:]
        z = np.tanh(h, out=h).reshape(-1, DIM) @ p["out"]
        z += p["bias"]
        if max(z.max(), -z.min()) > 60:
            z -= z.max(1, keepdims=True)
        flat = target[:, skip:].ravel()
        hit = z.ravel().take(np.arange(0, z.size, CLASSES) + self.cls.take(flat)) + self.inside.take(flat)
        np.exp(z, out=z)
        return (hit - np.log(z @ np.ones(CLASSES, np.float32))).reshape(n, WINDOW - skip)

    def log_probs(self, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Natural log probability of each id; text i has ids ``bounds[i]`` to ``bounds[i + 1]``, its end included."""
        n = np.diff(bounds)
        more = np.maximum(0, -(-(n - WINDOW) // STRIDE))
        out = np.zeros(len(ids), np.float32)
        later = np.repeat(np.arange(len(n)), more)
        turn = np.arange(len(later)) - np.repeat(np.cumsum(more) - more, more) + 1
        # The first window of a text scores all its places, later ones those that no window reached before.
        for skip, doc, begin in ((0, np.arange(len(n)), bounds[:-1]), (WINDOW - STRIDE, later, bounds[later] + turn * STRIDE)):
            for s in range(0, len(doc), BLOCK):
                d = doc[s:s + BLOCK]
                place = begin[s:s + BLOCK, None] + np.arange(WINDOW)
                target = ids[np.minimum(place, len(ids) - 1)]
                context = np.where(place == bounds[d][:, None], self.start, ids[np.clip(place - 1, 0, len(ids) - 1)])
                real = (place < bounds[d + 1][:, None])[:, skip:]
                out[place[:, skip:][real]] = self.class_scores(context, target, skip)[real]
        return out

    def fit(self, texts: list[np.ndarray], steps: int = 250, batch: int = 96, rate: float = 0.02) -> AttentionLM:
        """Adam on random windows of the sample (arrays of ids, each with its end)."""
        if not texts:
            return self
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        context, target, _ = self.cut(np.concatenate(texts), bounds, np.zeros(0, np.int64))
        rng, move = np.random.default_rng(9), self.adam()
        for step in range(1, steps + 1):
            pick = rng.integers(0, len(context), batch)
            move(self.gradients(context[pick], target[pick]), rate * (1 - step / (steps + 1)))
        return self

    def copy(self) -> AttentionLM:
        out = object.__new__(AttentionLM)
        out.__dict__ |= self.__dict__ | {"p": {k: v.copy() for k, v in self.p.items()}}
        out.__dict__.pop("wide", None)
        return out

    def cut(self, ids: np.ndarray, bounds: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Training windows side by side over all texts: context ids, target ids (-1 beyond a text), and which targets begin a word."""
        n = -(-np.diff(bounds) // WINDOW)
        doc = np.repeat(np.arange(len(n)), n)
        turn = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
        place = (bounds[doc] + turn * WINDOW)[:, None] + np.arange(WINDOW)
        real = place < bounds[doc + 1][:, None]
        safe = np.minimum(place, len(ids) - 1)
        context = np.where(place == bounds[doc][:, None], self.start, ids[np.maximum(safe - 1, 0)])
        first = np.zeros(len(ids), bool)
        first[begin] = True
        return np.where(real, context, self.end), np.where(real, ids[safe], -1), first[safe] & real

    def adam(self):
        """A function that moves the parameters by one step of Adam, given gradients and a rate."""
        small = [k for k in self.p if k != "emb"]
        joined = lambda p: np.concatenate([p[k].ravel() for k in small])
        emb, rest = self.p["emb"], joined(self.p)  # the small parameters move as one array
        at = 0
        for k in small:
            shape, size = self.p[k].shape, self.p[k].size
            self.p[k], at = rest[at:at + size].reshape(shape), at + size
        m = [np.zeros_like(emb), np.zeros_like(emb), np.zeros_like(rest), np.zeros_like(rest)]
        self.__dict__.pop("wide", None)
        step = 0

        def move(g: dict, rate: float) -> None:
            nonlocal step
            step += 1
            at, slope = g["emb"]
            # Of the token vectors only those in the batch move.
            for where, new, w, mean, square in ((at, slope, emb, *m[:2]), (slice(None), joined(g), rest, *m[2:])):
                first, second = mean[where], square[where]
                first += 0.1 * (new - first)
                second += 0.01 * (new**2 - second)
                mean[where], square[where] = first, second
                w[where] -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)

        return move

    def lifts(self, ids: np.ndarray, bounds: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Natural log probability of each id, and of each word and end the log of its class's lift; ``bounds`` are the texts' among the
        ids, ``sizes`` how many ids each word has."""
        tokens = self.log_probs(ids, bounds).astype(np.float64)
        begin = np.cumsum(sizes) - sizes
        first = ids[begin]
        return tokens, tokens[begin] - self.inside[first] - self.usual[self.cls[first]]

    def gain(self, lift: np.ndarray) -> np.ndarray:
        """Log of what a word's base probability is multiplied by."""
        return np.logaddexp(np.log(self.share), np.log1p(-self.share) + lift)

    def fit_share(self, lift: np.ndarray, times: np.ndarray, turns: int = 20) -> AttentionLM:
        """Weight of the unchanged base probability, by expectation steps over lifts that occur ``times`` times."""
        self.share = 0.5
        for _ in range(turns if times.sum() else 0):
            self.share = float(np.clip(np.average(np.exp(np.log(self.share) - self.gain(lift)), weights=times), 1e-6, 1 - 1e-6))
        return self

    def gradients(self, context: np.ndarray, target: np.ndarray, keep: dict | None = None) -> dict:
        """Mean slope of the loss over all targets, for ``emb`` as (ids, slopes); ``keep`` takes each target's class log probability as ``hit``.

        A block of windows at a time stays in the processor's cache; exponents are shifted only where they could overflow."""
        p, n_real = self.p, max(1, int((target >= 0).sum()))
        wide = np.concatenate([p["k"], p["v"], p["q"] * DIM**-0.5, p["own"]], 1)
        tri, ones, each, own_dims = np.tri(WINDOW, dtype=np.float32), np.ones(WINDOW, np.float32), np.ones(CLASSES, np.float32), np.ones(DIM, np.float32)
        back, out_back = np.ascontiguousarray(wide.T), np.ascontiguousarray(p["out"].T)
        g = {"out": 0, "bias": 0, "pos": 0, "wide": 0}
        moves, hits = [], []
        for s in range(0, len(context), BLOCK):
            ids, flat = context[s:s + BLOCK], target[s:s + BLOCK].ravel()
            n, real, row = len(ids), (flat >= 0).astype(np.float32), np.ones(len(flat), np.float32)
            spot = np.arange(0, len(flat) * CLASSES, CLASSES) + self.cls.take(flat, mode="clip")  # each target's class in the flat table of classes
            x = p["emb"].take(ids, axis=0)
            x += p["pos"]
            x = x.reshape(-1, DIM)
            y = (x @ wide).reshape(n, WINDOW, 4 * DIM)
            key, value, query, own = (y[:, :, i:i + DIM] for i in range(0, 4 * DIM, DIM))
            a = np.matmul(query, key.transpose(0, 2, 1))
            if max(a.max(), -a.min()) > 60:
                a += self.mask
                a -= a.max(2, keepdims=True)
            np.exp(a, out=a)
            a *= tri
            a *= (1 / (a.reshape(-1, WINDOW) @ ones)).reshape(n, WINDOW, 1)
            found = np.matmul(a, value)
            h = found + own
            h = np.tanh(h, out=h).reshape(-1, DIM)
            z = h @ p["out"]
            z += p["bias"]
            if max(z.max(), -z.min()) > 60:
                z -= z.max(1, keepdims=True)
            hit = z.ravel().take(spot)
            np.exp(z, out=z)
            total = z @ each
            hits.append((hit - np.log(total)).reshape(n, WINDOW))
            z *= (real / total)[:, None]
            z.reshape(-1)[spot] -= real
            g["out"] += h.T @ z
            g["bias"] += row @ z
            du = z @ out_back
            h *= h
            du *= np.subtract(1, h, out=h)
            level = du * found.reshape(-1, DIM) @ own_dims
            du = du.reshape(n, WINDOW, DIM)
            da = np.matmul(du, value.transpose(0, 2, 1))
            da -= level.reshape(n, WINDOW, 1)
            da *= a
            dy = np.empty_like(y)
            np.matmul(da.transpose(0, 2, 1), query, out=dy[:, :, :DIM])
            np.matmul(a.transpose(0, 2, 1), du, out=dy[:, :, DIM:2 * DIM])
            np.matmul(da, key, out=dy[:, :, 2 * DIM:3 * DIM])
            dy[:, :, 3 * DIM:] = du
            dy = dy.reshape(-1, 4 * DIM)
            g["wide"] += x.T @ dy
            dx = dy @ back
            g["pos"] += dx.reshape(n, WINDOW, DIM).sum(0)
            moves.append(dx)
        if keep is not None:
            keep["hit"] = np.concatenate(hits)
        g = {k: v / np.float32(n_real) for k, v in g.items()}
        g["k"], g["v"], g["q"], g["own"] = np.split(g.pop("wide"), 4, axis=1)
        g["q"] = g["q"] * np.float32(DIM**-0.5)
        ids = context.ravel()
        order = np.argsort(ids.astype(np.uint16) if len(self.cls) <= 1 << 16 else ids, kind="stable")  # short numbers sort by digits
        ids = ids[order]
        cuts = np.flatnonzero(np.diff(ids, prepend=-1))
        slopes = np.add.reduceat((np.concatenate(moves) if len(moves) > 1 else moves[0]).take(order, axis=0), cuts, axis=0) / np.float32(n_real)
        some = slopes.any(1)
        g["emb"] = ids[cuts][some], slopes[some]
        return g


def score(docs: DataFrame, tokenizer_file: str, frequent: int = FREQUENT, fit_texts: int = FIT_TEXTS) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, attention_score (log10), n_subwords.

    A null text is empty: its only token is the end. Without training texts every count is zero. Rows that repeat an id are scored apart; a
    null id counts as the empty text for the split. Counts, classes, the attention layer and the share are learned from all training texts; the
    layer's first parameters come from at most ``fit_texts`` of them (least hashes of the text). Other columns are ignored.
    """
    with small_batches(docs.sparkSession):
        return score_rows(docs, tokenizer_file, frequent, fit_texts)


def score_rows(docs: DataFrame, tokenizer_file: str, frequent: int, fit_texts: int) -> DataFrame:
    """The rows of ``score``: all steps in Python run and land here, and only the lookup of rare words is left to the plan that is returned."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    train = rows.where(is_training())
    counts = landed(count_words(train).withColumn("h", F.xxhash64("word")))
    n_texts = train.count()
    n_all, v_all, top = most_frequent(counts, frequent)  # a fixed number of words
    # The end is a token of every training text.
    n_all, v_all = n_all + n_texts, v_all + (n_texts > 0)
    spec = read_text(tokenizer_file)
    box = Shipped(spark, SubwordBox(spec))
    size = box.value.tokenizer().get_vocab_size() + 1  # the last id is the end of a text
    end = size - 1
    rest = float(n_all + v_all + 1)
    kind = "<u2" if size <= 1 << 16 else "<u4"
    common = Shipped(spark, (top["word"].combine_chunks().cast(pa.string()), top["n"].to_numpy()))
    names = ["key", "doc_id", "held_out", "n_tokens", "n_known", "base", "n_subwords", "h", "octets", "ids", "marks", "rare"]

    def cut(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in runs(source, "text", CUT_BYTES):
            ids, bounds, places, (codes, first, words) = subword_ids(box.value, part["text"], end)
            # Counts of the frequent words and the end; -1 marks words to be looked up, kept with their text.
            often, n_often = common.value
            times = np.append(np.append(n_often, -1)[pc.index_in(words, value_set=often).fill_null(len(often)).to_numpy()], n_texts)
            sizes = np.diff(np.append(first, len(codes)))
            base = np.where(times >= 0, np.log(np.maximum(times, 0) + 1.0) - np.log(rest), 0)
            marks = np.zeros(len(ids), np.uint8)
            marks[np.cumsum(places) - places] = 1
            n = part.num_rows
            packed = lambda x: pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((bounds * x.itemsize).astype(np.int32)), pa.py_buffer(x)])
            lost = np.flatnonzero((times < 0)[codes])
            rare = pa.ListArray.from_arrays(pa.array(np.searchsorted(lost, np.append(first, len(codes))).astype(np.int32)), words.cast(pa.binary()).take(pa.array(codes[lost])))
            whole = [part["key"].combine_chunks(), part["doc_id"].combine_chunks(), part["held_out"].combine_chunks(), pa.array(sizes, pa.int64()),
                     pa.array(np.add.reduceat((times > 0).astype(np.int64)[codes], first)), pa.array(np.add.reduceat(base[codes], first) / LOG10), pa.array(np.diff(bounds)),
                     part["h"].combine_chunks(), part["octets"].combine_chunks(), packed(ids.astype(kind)), packed(marks), rare]
            yield pa.RecordBatch.from_arrays(whole, names)
            pa.default_memory_pool().release_unused()

    keyed = rows.withColumn("held_out", ~is_training()).withColumns({"key": F.monotonically_increasing_id(), "h": F.xxhash64("text"), "octets": F.octet_length("text")})
    schema = "key long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, n_subwords long, h long, octets int, ids binary, marks binary, rare array<binary>"
    texts = landed(keyed.mapInArrow(cut, schema))
    training = texts.where(~F.col("held_out"))
    learned = training.select("h", "doc_id", "ids", "marks")
    sub, begins, often = count_subwords(learned, kind, size)
    n_ids = int(sub.sum())
    model = AttentionLM(sub, end, begins, shared_text_classes(spark, learned, often, n_texts, kind, size, end) if n_ids else None)
    model.fit(least_ids(training.where(F.col("octets") < 50_000), kind, fit_texts))
    if n_ids:
        model = learn(spark, model, learned, n_ids, kind)
    shared = Shipped(spark, model)

    def attend(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in runs(source, "ids", CHUNK_BYTES // 4):
            ids, bounds, begin = unpacked(part, kind)
            tokens, lift = shared.value.lifts(ids, bounds, np.diff(np.append(begin, len(ids))))
            gain = np.add.reduceat(shared.value.gain(lift), np.searchsorted(begin, bounds[:-1])) / LOG10
            same = [part[c].combine_chunks() for c in scalars]
            yield pa.RecordBatch.from_arrays([*same, pa.array(gain), pa.array(np.add.reduceat(tokens, bounds[:-1]) / LOG10)], [*scalars, "gain", "attention_score"])

    scalars = ["key", "doc_id", "held_out", "n_tokens", "n_known", "base", "n_subwords"]
    schema = "key long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, n_subwords long, gain double, attention_score double"
    scored = landed(texts.select(*scalars, "ids", "marks").mapInArrow(attend, schema))
    shared.drop(), box.drop(), common.drop()
    lost = texts.select("key", F.explode("rare").alias("word")).select("key", F.xxhash64("word").alias("h"))
    # A partition of the counts is a hash table of two numbers a word: rows of rare words need no sort.
    found = lost.join(counts.select("h", F.col("n").alias("c")).hint("shuffle_hash"), "h", "left").withColumn("c", F.coalesce("c", F.lit(0).cast("long")))
    more = found.select("key", (F.col("c") > 0).cast("long").alias("n_known"), F.log10((F.col("c") + 1.0) / rest).alias("base"))
    both = scored.unionByName(more, allowMissingColumns=True)
    one = [F.max(c).alias(c) for c in ("doc_id", "held_out", "n_tokens", "attention_score", "n_subwords", "gain")]
    out = both.groupBy("key").agg(*one, *[F.sum(c).alias(c) for c in ("n_known", "base")])
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n_all).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), (F.col("base") + F.col("gain")).alias("score"),
                      "attention_score", "n_subwords")


def subword_ids(box: SubwordBox, texts: pa.Array, end: int):
    """(ids, bounds, sizes, (codes, first, words)): ids of all texts, each closed by ``end``; where each text starts among them; how many ids each
    word and end has; and the words as codes (the last code is the end) with each text's first place."""
    codes, at, words = coded_words(texts)
    n = len(at) - 1
    codes = np.insert(codes, at[1:], len(words))
    flat, each = box.coded(words)
    flat, each = np.append(flat, np.uint32(end)), np.append(each, 1)
    sizes = each[codes]
    ids = strung(flat, (np.cumsum(each) - each)[codes], sizes)
    first = at[:-1] + np.arange(n)
    bounds = np.concatenate([np.cumsum(sizes)[first] - sizes[first], [len(ids)]])
    return ids, bounds, sizes, (codes, first, words)
