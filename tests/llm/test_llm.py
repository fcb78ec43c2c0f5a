"""Operators of the pipeline against plain versions, on small rows with nulls, empty and long texts, ties, repeats and odd columns."""

import hashlib
import os
import re
import subprocess
import sys
import zlib
from collections import Counter, defaultdict
from math import log10

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from scorelake.llm import bpe, cotrain, decontaminate, lm, nearest, queries, secrets, simhash, substring_dedup, token_output, toxicity
from scorelake.llm.common import tokenizer_path

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
ODD = ["", " ", "a  b", "foo \n bar", "x<|endoftext|>y <|startoftext|>", "É ÀB ΟΔΟΣ don't WE'LL", "\n\n x\ty ", "\x1c a\x1f b", "日本語 12345 🙂", "a.\nb,\n\nc. d.\ne ###.", "w" * 5000, "lang " * 3000]


@pytest.fixture(scope="module")
def docs(spark):
    """Given documents plus odd ones: null and repeated ids, null texts, repeated rows, and columns with clashing names."""
    odd = [(10_000 + i, t) for i, t in enumerate(ODD)] + [(None, "no id here"), (None, None), (20_000, None), (20_001, "same row twice"), (20_001, "same row twice"), (20_001, "same id again")]
    base = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    more = spark.createDataFrame([(i, t, None, None, None) for i, t in odd], base.schema)
    return base.unionByName(more).withColumns({"id": F.lit("x"), "sum": F.lit(1), "word": F.lit(2), "fp": F.lit(3), "y": F.lit(0)}).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def empty(docs):
    return docs.where(F.lit(False))


def test_bpe_as_the_library(docs, rows):
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    want = Counter()
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        text = tok.decode(ids, skip_special_tokens=False)
        want[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter(map(tuple, bpe.bpe(docs, path).collect())) == want
    assert bpe.bpe(empty(docs), path).count() == 0


def test_overlapping_pairs_merge_from_the_left():
    spec = '{"model": {"vocab": {"a": 0, "a</w>": 1, "aa": 2, "aaa</w>": 3, "aaaa": 4}, "merges": [["a", "a"], ["aa", "a</w>"], ["aa", "aa"]], "end_of_word_suffix": "</w>"}, "added_tokens": []}'
    got = bpe.PairIndexBPE(spec).ready().encode_words(["aaa", "aaaa", "aaaaa", ""])
    assert [g.tolist() for g in got] == [[3], [2, 0, 1], [2, 3], []]


def test_token_files_round_trip(spark, docs, rows):
    from scorelake.llm.common import scratch_dir
    from tokenizers import Tokenizer

    path, file = scratch_dir(spark), tokenizer_path("byte_bpe_50k.json")
    token_output.write_tokens(docs, path, file, block_ids=500)
    tok = Tokenizer.from_file(file)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    start, want, flat = 0, [], []
    for i, t in order:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
        flat += ids
    assert sorted(map(tuple, token_output.read_documents(spark, path).collect()), key=lambda r: r[1]) == want
    some = token_output.read_range(spark, path, 1234, 3000).orderBy("position").collect()
    assert [tuple(r) for r in some] == list(zip(range(1234, 4234), flat[1234:4234]))
    token_output.write_tokens(empty(docs), other := scratch_dir(spark), file)
    assert token_output.read_documents(spark, other).count() == 0


@pytest.mark.parametrize("bits", [1, 7, 16, 17, 32])
def test_packing(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 777, dtype=np.uint64)
    packed = token_output.pack(ids, bits)
    assert (token_output.unpack(packed, bits, 0, 777) == ids).all() and (token_output.unpack(packed, bits, 130, 500) == ids[130:500]).all()


def plain_contamination(rows, items):
    words = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    windows = defaultdict(set)
    for i, t in items:
        w = words.findall((t or "").translate(low))
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k:k + n])].add(str(i))
    sizes = {len(w) for w in windows}
    for i, t in rows:
        w = words.findall((t or "").translate(low))
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k:k + n])]
        yield i, len(w), len(hit), len(found), decontaminate.digest(list(found)), bool(hit) and 20 * len(hit) >= len(w)


@pytest.mark.parametrize("block", [16 << 20, 2000])
def test_decontamination(spark, docs, rows, block):
    given = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    items = given + [(900, "Same ROW twice"), (901, "row"), (902, None), (903, "..."), (901, "row")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.match_items(docs, bench, block_bytes=block).select(
        "doc_id", "__n_words", decontaminate.hit_words(), F.size("__items").cast("long"), F.sha2(F.array_join(F.array_sort("__items"), ",").cast("binary"), 256), decontaminate.is_contaminated())
    assert Counter(map(tuple, got.collect())) == Counter(plain_contamination(rows, items))
    clean = decontaminate.decontaminate(docs, bench)
    assert clean.columns == docs.columns
    assert clean.count() == sum(not r[-1] for r in plain_contamination(rows, items))
    assert decontaminate.decontaminate(docs, bench.limit(0)).count() == docs.count()


def test_long_matches_are_found(spark):
    words = [f"w{i}" for i in range(60)]
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    one = spark.createDataFrame([(5, "x y " + " ".join(words[10:45]) + " z")], "doc_id long, text string")
    row = decontaminate.contamination(one, bench).first()
    assert (row["n_hit"], row["longest_words"], row["longest_at"]) == (35, 35, 2)


def plain_components(rows):
    import xxhash

    fps = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        h = [xxhash.xxh64_intdigest(b" ".join(w[k:k + 4]), 42) for k in range(max(1, len(w) - 3))] if w else []
        fps.append(sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64)))
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return fps, [least.get(root(i)) for i in range(len(rows))], len({root(i) for i in range(len(rows))})


def test_simhash(docs, rows):
    fps, least, groups = plain_components(rows)
    got = simhash.near_duplicates(docs).collect()
    assert Counter((r["doc_id"], r["fp"] & (2**64 - 1), r["component_id"]) for r in got) == Counter((d, f, c) for (d, _), f, c in zip(rows, fps, least))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == groups
    assert simhash.near_duplicates(empty(docs)).count() == 0


@pytest.mark.parametrize("unit_rows", [4096, 40])
def test_trie_join_loses_no_link(spark, unit_rows):
    rng = np.random.default_rng(unit_rows)
    values = {int(v) for v in rng.integers(0, 2**63, 100)}
    for v in list(values)[:40]:
        for _ in range(12):
            x = v
            for b in rng.integers(0, 64, rng.integers(1, 6)):
                x ^= 1 << int(b)
            values.add(x)
    values = np.array(sorted(values), np.uint64)
    close = np.bitwise_count(values[:, None] ^ values[None, :]) <= 4
    seen, want = set(), []
    for i in range(len(values)):
        if i not in seen:
            group, todo = {i}, [i]
            while todo:
                new = set(np.flatnonzero(close[todo.pop()]).tolist()) - group
                group |= new
                todo += new
            seen |= group
            want.append(sorted(values[list(group)].view(np.int64).tolist()))
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    roots = {r["fp"]: r["root"] for r in simhash.components(simhash.links(df, unit_rows)).collect()}
    got = defaultdict(list)
    for v in values.view(np.int64).tolist():
        got[roots.get(v, v)].append(v)
    assert sorted(map(sorted, got.values())) == sorted(want)


def test_secrets(docs, rows):
    field = secrets.fit(docs)
    got = secrets.scan(docs, field).collect()
    want = Counter()
    for i, t in rows:
        spans = []
        rules = [(re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 12),
                 (re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18), (re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 16)]
        for k, (rule, ok) in enumerate(rules):
            spans += [(m.start(), k, m.end()) for m in rule.finditer(t or "") if ok(m)]
        n = Counter(k for _, k, _ in spans)
        want[i, n[0], n[1], n[2], hashlib.sha256(",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans)).encode()).hexdigest()] += 1
    assert Counter(tuple(r)[:5] for r in got) == want
    clean = secrets.redact(docs, field)
    assert clean.schema == docs.schema and clean.count() == docs.count()
    again = secrets.scan(clean, field)
    assert again.agg(F.sum(F.col("n_assign") + F.col("n_access") + F.col("n_hex"))).first()[0] == 0
    assert secrets.scan(empty(docs), secrets.fit(empty(docs))).count() == 0


def test_viterbi_is_exact():
    rng = np.random.default_rng(4)
    field = secrets.SecretField()
    field.trans = rng.normal(0, 1, (3, 3))
    e, doc = rng.normal(0, 1, (400, 3)), np.repeat(np.arange(40), 10)
    e[:, 0] += rng.choice([0, 3, 9], 400)
    got = field.viterbi(e, doc)
    for d in range(40):
        part = e[doc == d]
        score, back = part[0], []
        for x in part[1:]:
            s = score[:, None] + field.trans
            back.append(s.argmax(0))
            score = s.max(0) + x
        path = [int(score.argmax())]
        for b in back[::-1]:
            path.append(int(b[path[-1]]))
        assert got[doc == d].tolist() == path[::-1]


def test_substring_dedup_removes_later_passages_only(spark):
    passage = "One two three four five six seven. Eight nine ten eleven twelve thirteen fourteen. Fifteen sixteen seventeen eighteen nineteen twenty."
    own = ["Alpha beta gamma delta epsilon zeta eta theta. Iota kappa lambda mu nu xi omicron pi.", "Red orange yellow green blue indigo violet black. White grey pink brown cyan teal lime navy."]
    rows = [(2, f"{own[1]} {passage} The end."), (1, f"{own[0]} {passage}"), (3, None), (4, ""), (5, passage + "\n" + passage), (None, passage), (6, "Short one. Short one.")]
    got = {r["doc_id"]: r for r in substring_dedup.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["n_removed"] == 0 and got[1]["text"] == rows[1][1]
    assert passage not in got[2]["text"] and got[2]["text"].startswith(own[1]) and got[2]["n_removed"] == 3
    assert got[5]["text"].strip() == "" and got[None]["text"].strip() == "" and got[6]["n_removed"] == 0
    assert got[3]["n_sentences"] == 0 and got[4]["text"] == ""


def test_substring_dedup_against_plain(docs, rows):
    first = {}
    found = []
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        runs = substring_dedup.runs(t or "")
        found.append((i, t, runs))
        for h, k, *_ in runs:
            first.setdefault((h, k), i)
    want = Counter()
    for i, t, runs in found:
        gone = {s for h, k, a, b, lead in runs if not (first[h, k] == i and lead) for s in range(a, b)}
        want[i, len(substring_dedup.sentences(t or "")), len(gone), "".join((t or "")[p[0]:p[1]] for n, p in enumerate(substring_dedup.sentences(t or "")) if n not in gone)] += 1
    got = substring_dedup.dedup_substrings(docs).select("doc_id", "n_sentences", "n_removed", "text").collect()
    assert Counter(map(tuple, got)) == want
    assert substring_dedup.dedup_substrings(empty(docs)).count() == 0


def test_nearest_recall_and_scores(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    bad = spark.createDataFrame([(50_000, None, 1), (50_050, [0.0] * 64, 1), (50_100, [float("nan")] * 64, 1), (None, [1.0] * 64, 1), (50_150, [1.0] * 3, 1), (50_200, [None] + [1.0] * 63, 1)], table.schema)
    got = nearest.nearest(table.unionByName(bad)).collect()
    raw = table.collect()
    ids, x = np.array([r["vec_id"] for r in raw]), np.array([r["embedding"] for r in raw], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    exact = {(int(i), int(j)): float(v) for i, row in zip(ids[ids % 50 == 0], x[ids % 50 == 0] @ x.T) for j, v in zip(ids, row) if i != j}
    want = set()
    for q in ids[ids % 50 == 0].tolist():
        want |= {(q, j) for j in sorted((j for i, j in exact if i == q), key=lambda j: (-exact[q, j], j))[:5]}
    have = {(r["query_id"], r["vec_id"]) for r in got}
    assert len(have & want) >= 0.9 * len(want) and len(have) == len(want)
    assert all(abs(r["score"] - exact[r["query_id"], r["vec_id"]]) < 1e-12 for r in got)


def test_nearest_small_tables_hot_vectors_and_ties(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [-1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r["vec_id"], r["rank"]) for r in nearest.nearest(few).orderBy("rank").collect()] == [(2, 1), (1, 2)]
    hot = spark.range(700).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("embedding"))
    got = nearest.nearest(hot, chunk=64).where("query_id = 100").orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [0, 1, 2, 3, 4]
    assert nearest.nearest(few.limit(0)).count() == 0


def test_lm_base_scores_and_windows(docs, rows):
    got = lm.score(docs, tokenizer_path("word_bpe_49k.json"), frequent=500, fit_texts=40).collect()
    count = Counter()
    for i, t in rows:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2:
            count.update((t or "").encode().lower().split())
            count[None] += 1
    n, v = sum(count.values()), len(count)
    want = Counter()
    for i, t in rows:
        w = [*(t or "").encode().lower().split(), None]
        base = sum(log10((count[x] + 1) / (n + v + 1)) for x in w)
        want[i, zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2, len(w), sum(count[x] > 0 for x in w), n, round(base, 5)] += 1
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in got) == want
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in got)
    held = [(r["score"], r["base_score"], r["n_tokens"]) for r in got if r["held_out"]]
    assert sum(h[0] for h in held) > sum(h[1] for h in held) - 0.05 * sum(h[2] for h in held)
    big = docs.sparkSession.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    held = lm.score(big, tokenizer_path("word_bpe_49k.json")).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert held[0] > held[1] + 0.1 * held[2]  # the context is worth a tenth of a decade a token at least
    assert lm.score(empty(docs), tokenizer_path("word_bpe_49k.json")).count() == 0


def test_lm_scores_each_id_once():
    rng = np.random.default_rng(1)
    counts = rng.integers(1, 50, 60)
    model = lm.AttentionLM(counts, 59, counts)
    ids, bounds = rng.integers(0, 59, 200), np.array([0, 1, 30, 130, 200])
    got = model.log_probs(ids, bounds)
    for a, b in zip(bounds, bounds[1:]):
        for i in range(a, b):
            turn = max(0, -(-(i - a - lm.WINDOW + 1) // lm.STRIDE))
            begin = a + turn * lm.STRIDE
            context = np.zeros((1, lm.WINDOW), np.int64)
            context[0, :i - begin + 1] = [model.start if j == a else ids[j - 1] for j in range(begin, i + 1)]
            assert abs(model.windows(context)[0, i - begin, model.cls[ids[i]]] + model.inside[ids[i]] - got[i]) < 1e-3


def test_tasks_need_no_copy_of_the_package(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {str(tmp_path / "shared")!r}).getOrCreate()
from scorelake.llm import queries
print("rows", [queries.QUERIES[q](spark, {SF!r}).count() for q in ("op3_token_output", "op4_decontaminate", "op6_bpe")])
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows [200, 200, 200]" in out.stdout, out.stderr[-2000:]


def held_out_auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    n = label.sum()
    return (rank[label == 1].sum() - n * (n + 1) / 2) / (n * (len(label) - n))


def test_toxicity_held_out(spark):
    big = SF.replace("0.001", "0.1")
    docs, labels = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    model = toxicity.fit(docs, labels)
    known = toxicity.score(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), model).join(labels, "doc_id").where("held_out").toPandas()
    assert held_out_auc(known["score"].to_numpy(), known["toxic"].to_numpy()) > 0.97
    odd = spark.createDataFrame([(1, None), (1, ""), (None, "x " * 5000)], "doc_id long, text string")
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in toxicity.score(odd, model).collect())
    assert toxicity.score(odd, toxicity.fit(odd, labels.limit(0))).count() == 3


def test_quality_held_out(spark, docs):
    big = SF.replace("0.001", "0.1")
    given, labels = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    half = labels.where("crc32(cast(doc_id AS string)) % 2 = 0")
    model = cotrain.fit(given, half)
    rest = cotrain.score(given.join(labels.join(half, "doc_id", "left_anti").select("doc_id"), "doc_id", "left_semi"), model).join(labels, "doc_id").toPandas()
    assert held_out_auc(rest["score"].to_numpy(), rest["quality"].to_numpy()) > 0.97
    assert rest["kept"][rest["quality"] == 1].mean() > 0.98
    kept = cotrain.keep_good(docs, model)
    assert kept.schema == docs.schema
    assert cotrain.score(docs, model).count() == docs.count()
    assert cotrain.keep_good(docs, cotrain.fit(docs, labels.limit(0))).count() == docs.count()
    assert cotrain.keep_good(empty(docs), model).count() == 0


def test_pipeline_keeps_columns_and_runs(spark, docs):
    now = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, SF)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
            out = out.persist()
            assert out.count() <= now.count()
        now = out
    assert now.count() > 0 and len(corpus_pipeline.STAGES) == 5


def test_registered():
    import __spark_entry__

    assert set(queries.QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 11))


def test_words_cut_together_equal_words_cut_alone():
    from scorelake.llm.common import read_text

    words = ["abc", "abc.", "...", "a.b,%%", "<|startoftext|>", "x<|startoftext|>y", "x<", "1İx", "Éa", "straße***", "ßσς", "日本", "é", "\x1c", "don't", "it's.", "Σας", "\x7f", "a\x85b", "1234", "'"]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        box = lm.SubwordBox(read_text(tokenizer_path(name)))
        for word, ids in zip(words, box.words([w.encode() for w in words])):
            core = word.rstrip(lm.MARKS) or word
            parts = [" " + core] + ([word[len(core):]] if len(core) < len(word) else [])
            assert ids == b"".join(box.ids(parts)), word


def test_lm_learns_from_every_training_text(spark, monkeypatch):
    """Each round's copies together see every window of every training text once, and the sketch counts every text."""
    rows = [(i, " ".join(f"w{(i * j) % 40}" for j in range(60))) for i in range(70)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    asked, share = [], lm.AttentionLM.fit_share
    monkeypatch.setattr(lm.AttentionLM, "fit_share", lambda self, lift, times: asked.append(times.sum()) or share(self, lift, times))
    got = lm.score(docs, tokenizer_path("word_bpe_49k.json"), fit_texts=5)
    training = [t for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    assert asked == [sum(len(t.split()) + 1 for t in training)]  # words and ends of all training texts, not of five
    scores = {r["doc_id"]: r["score"] for r in got.collect()}
    again = {r["doc_id"]: r["score"] for r in lm.score(docs.repartition(7), tokenizer_path("word_bpe_49k.json"), fit_texts=5).collect()}
    assert len(scores) == 70 and all(abs(scores[i] - again[i]) < 1e-3 for i in scores)
