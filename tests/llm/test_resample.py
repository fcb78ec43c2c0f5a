"""Importance resampling against its SQL statement and a plain per-word version, on odd rows."""

import math
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from scorelake.llm import queries, resample

SF = "/root/testdata/sf0.001"
COLS = ["doc_id", "n_features", "weight", "score", "rank"]
ODD = ["", None, "Hello WORLD, hello! 123 abc-def", "ÉTÉ été ΟΔΟΣ", "x" * 6000, "lang " * 3000, "a\x00b c", "one two"]


def plain(docs: pd.DataFrame, bench: pd.DataFrame) -> pd.DataFrame:
    con = duckdb.connect()
    con.register("documents", docs)
    con.register("benchmark", bench)
    return con.sql(queries.OP13_SQL).df()


def same(got, want):
    a = got[COLS].astype("Int64").sort_values(COLS, na_position="last").reset_index(drop=True).astype(str)
    b = want[COLS].astype("Int64").sort_values(COLS, na_position="last").reset_index(drop=True).astype(str)
    assert a.equals(b), a.compare(b) if a.shape == b.shape else (a.shape, b.shape)


def test_features_by_plain_words():
    texts = ["Ab cd", "", "ef GH ij", "k"]
    doc, cell, n_words = resample.features(texts)
    words = [re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.encode().translate(resample.CASE)) for t in texts]
    assert n_words.tolist() == [len(w) for w in words]
    assert cell.tolist() == [zlib.crc32(x) % 10_000 for w in words for x in w]
    assert doc.tolist() == [i for i, w in enumerate(words) for _ in w]
    # bigrams never cross a document border
    doc2, cell2, _ = resample.features(texts, (2, 2))
    assert doc2.tolist() == [0, 2, 2] and cell2[0] == zlib.crc32(b"ab cd") % 10_000


def test_gains_and_gumbel_as_stated():
    s, t = np.array([3, 0]), np.array([0, 5])
    g = resample.gains(s, t)
    assert g[0] == math.floor(1000 * math.log(1 * (3 + 10_000) / (4 * (5 + 10_000))))


def test_resample_equals_sql_on_odd_rows(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    extra = [(50_000 + i, t) for i, t in enumerate(ODD)] + [(None, "null id " * 30), (60_000, "same row " * 15), (60_000, "same row " * 15)]
    docs = base.unionByName(spark.createDataFrame(extra, base.schema))
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    clashing = docs.withColumns({"rank": F.lit(1), "__part": F.lit(2), "score": F.lit("x")})
    got = resample.resample(clashing, bench).toPandas()
    same(got, plain(docs.toPandas().astype({"doc_id": "Int64"}), bench.toPandas()))
    assert got["rank"].notna().sum() == (got.doc_id.notna() & (got.n_features >= 20)).sum() * 10 // 100
    drawn = got[got["rank"].notna()].sort_values("rank")
    assert drawn["rank"].tolist() == list(range(1, len(drawn) + 1))
    assert got[got.doc_id.isna()]["rank"].isna().all()


def test_resample_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert resample.resample(docs, bench).count() == 0
