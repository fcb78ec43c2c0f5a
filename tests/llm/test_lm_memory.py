"""What keeps the language model's tasks small: short Arrow batches, few words to sort, ids taken from the landed table."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from scorelake.llm import lm
from scorelake.llm.common import batches


def test_lm_runs_do_not_depend_on_arrow_batches():
    rng = np.random.default_rng(3)
    for limit in (1, 40, 1000):
        rows = ["x" * int(n) for n in rng.integers(0, 60, 300)] + [None, "", "y" * 500, "", "z"]
        whole = pa.RecordBatch.from_pydict({"i": list(range(len(rows))), "text": rows})
        want = [part["i"].to_pylist() for part in batches(iter([whole]), "text", limit)]
        for step in (1, 7, 100):
            cut = [whole.slice(i, step) for i in range(0, len(rows), step)]
            assert [part["i"].to_pylist() for part in lm.runs(iter([whole.slice(0, 0), *cut]), "text", limit)] == want
    assert list(lm.runs(iter([]), "text", 5)) == []


def test_lm_tasks_get_short_batches(spark, monkeypatch):
    """Every task of the score gets at most ARROW_ROWS rows at once, and the session's own setting is back afterwards."""
    settings = lambda: [int(spark.conf.get(name)) for name in lm.ROWS_AT_ONCE]
    before, seen = settings(), []
    plain = lm.landed
    monkeypatch.setattr(lm, "landed", lambda df: (seen.append(max(settings())), plain(df))[1])
    docs = spark.range(60).select(F.col("id").alias("doc_id"), F.concat(F.lit("a word "), F.col("id").cast("string")).alias("text"))
    from scorelake.llm.common import tokenizer_path

    out = lm.score(docs, tokenizer_path("word_bpe_49k.json"), frequent=3, fit_texts=5)
    assert len(seen) == 3 and max(seen) <= lm.ARROW_ROWS and settings() == before
    assert "MapInArrow" not in out._jdf.queryExecution().toString() and out.count() == 60


def test_lm_most_frequent_words(spark):
    """Equal to a full sort, whatever the limit; words of rarer sizes are not sorted."""
    rng = np.random.default_rng(4)
    n = rng.zipf(1.4, 500).clip(max=10**6)
    counts = spark.createDataFrame([(bytearray(f"w{i}".encode()), int(c)) for i, c in enumerate(n)], "word binary, n long").withColumn("h", F.xxhash64("word"))
    for limit in (0, 1, 7, 100, 499, 500, 900):
        total, v, top = lm.most_frequent(counts, limit)
        want = [(bytes(r["word"]), r["n"]) for r in counts.orderBy(F.desc("n"), "h").limit(limit).collect()]
        assert (total, v) == (int(n.sum()), 500)
        assert list(zip(top["word"].to_pylist(), top["n"].to_pylist())) == want
    assert lm.most_frequent(counts.where("n < 0"), 5)[:2] == (0, 0)


def test_lm_least_ids(spark):
    """Ids of the texts with the least hashes, equal texts once."""
    rows = [(h, bytearray(np.arange(h % 5 + 1, dtype="<u2").tobytes())) for h in (9, -4, 9, 2, 7, -4)]
    got = lm.least_ids(spark.createDataFrame(rows, "h long, ids binary"), "<u2", 3)
    assert [g.tolist() for g in got] == [[0, 1], [0, 1, 2], [0, 1, 2]]
    assert lm.least_ids(spark.createDataFrame([], "h long, ids binary"), "<u2", 3) == []
