"""Embedding near-duplicates against all pairs by exact cosine (SQL twin), on odd rows and planted near copies."""

import duckdb
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from scorelake.llm import embed_dedup, queries

SF = "/root/testdata/sf0.001"
COLS = ["vec_id", "n_links", "component_id", "kept"]


def plain(frame: pd.DataFrame) -> pd.DataFrame:
    con = duckdb.connect()
    con.register("embeddings", frame)
    return con.sql(queries.OP12_SQL).df()


def same(got, want):
    norm = lambda f: f[COLS].astype({"vec_id": "Int64", "n_links": "Int64", "component_id": "Int64", "kept": "boolean"}).sort_values(COLS[:3]).reset_index(drop=True).astype(str)
    a, b = norm(got), norm(want)
    assert a.equals(b), a.compare(b) if a.shape == b.shape else (a.shape, b.shape)


def planted(n=3000, dims=48, seed=5):
    """Random vectors, groups of near copies of several sizes (chains included), exact copies and odd vectors."""
    rng = np.random.default_rng(seed)
    rows = [rng.normal(size=dims) for _ in range(n)]
    for g, size in enumerate([2, 3, 10, 60, 200]):
        base = rng.normal(size=dims)
        rows += [base + rng.normal(scale=0.12, size=dims) * np.linalg.norm(base) / np.sqrt(dims) for _ in range(size)]
    rows += [rows[7]] * 300  # a vector with many exact copies
    out = [(i, [float(x) for x in v]) for i, v in enumerate(rows)]
    out += [(10_000, None), (10_001, [0.0] * dims), (10_002, [float("nan")] + [1.0] * (dims - 1)), (10_003, [None] + [1.0] * (dims - 1)),
            (10_004, [float("inf")] * dims), (None, [float(x) for x in rows[3]]), (10_005, [float(x) for x in rows[3]])]
    return out


def test_embed_dedup_equals_all_pairs(spark):
    data = planted()
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumns({"id": F.lit(1), "v": F.lit("x"), "m": F.lit(2.0)})
    got = embed_dedup.near_duplicates(df).toPandas()
    frame = df.select("vec_id", "embedding").toPandas().astype({"vec_id": "Int64"})
    want = plain(frame)
    assert want.n_links.sum() > 2000
    same(got, want)


def test_embed_dedup_given_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    same(embed_dedup.near_duplicates(df).toPandas(), plain(df.toPandas()))


def test_hadamard_keeps_lengths_and_is_its_own_inverse():
    x = np.random.default_rng(1).normal(size=(5, 16))
    y = embed_dedup.hadamard(x)
    assert np.allclose(np.linalg.norm(y, axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(embed_dedup.hadamard(y), x)


def test_embed_dedup_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embed_dedup.near_duplicates(df).count() == 0
