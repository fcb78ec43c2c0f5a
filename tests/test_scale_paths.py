"""The paths that only large tables take, forced on small ones and checked against brute force."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorelake import sizing
from scorelake.operators import encode, evaluate, joins, monitor, quantiles, ranking, sampling
from scorelake.worker import walk_chunk


@pytest.fixture
def scores(spark):
    rng = random.Random(7)
    # A third of the rows share one score.
    rows = [(i, rng.random() < 0.3, 0.25 if rng.random() < 0.33 else round(rng.random() ** 3, 3)) for i in range(4000)]
    return spark.createDataFrame([(i, int(y), s) for i, y, s in rows], "id int, y int, s double"), rows


def test_curve_in_buckets(scores):
    df, rows = scores
    one = evaluate.score_curve(df, "y", "s").collect()
    many = evaluate.score_curve(df, "y", "s", bucket_rows=300).collect()
    assert sorted(one) == sorted(many)
    pos, neg = [s for _, y, s in rows if y], [s for _, y, s in rows if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    auc = evaluate.roc_auc(df, "y", "s", bucket_rows=300).first()[0]
    assert abs(auc - wins / (len(pos) * len(neg))) < 1e-12


def test_auc_of_few_rows(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8)], "y int, s double")
    assert evaluate.roc_auc(df, "y", "s").first()[0] == 0.75
    same = spark.createDataFrame([(0, 0.5), (1, 0.5), (1, 0.5)], "y int, s double")
    assert evaluate.roc_auc(same, "y", "s").first()[0] == 0.5


@pytest.mark.parametrize("accuracy, rows", [(10_000, 10), (20, 1), (10_000, 10**6), (3, 7)])
def test_quantiles(spark, accuracy, rows):
    rng = np.random.default_rng(3)
    a = np.concatenate([rng.lognormal(0, 4, 3000), np.full(1500, 2.5), [1e300, -1e300]])
    b = rng.integers(0, 4, len(a)).astype(float)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double").union(
        spark.createDataFrame([(None, float("nan"))], "a double, b double"))
    got = quantiles.exact_quantiles(df, ["a", "b"], [0.0, 0.25, 0.5, 0.9, 1.0], accuracy=accuracy, bucket_rows=rows)
    for name, data in (("a", a), ("b", b)):
        want = np.quantile(data, [0.0, 0.25, 0.5, 0.9, 1.0])
        assert np.allclose(got[name], want, rtol=1e-9)


def test_empty_column_has_no_quantile(spark):
    df = spark.createDataFrame([(None,)], "a double")
    assert quantiles.exact_quantiles(df, ["a"], [0.5])["a"] == [None]


def brute_limit(rows, window):
    out, state = {}, {}
    for i, key, t, limit in sorted(rows, key=lambda r: (r[2], r[0])):
        start, used = state.get(key, (None, 0))
        if start is None or t - start > window:
            start, used = t, 0
        used += 1
        state[key] = (start, used)
        out[i] = (start, used, used <= limit)
    return out


@pytest.mark.parametrize("chunk", [None, 30, 61, 500, 100_000])
def test_request_limit(spark, chunk):
    rng = random.Random(11)
    rows, t = [], 0
    for i in range(1500):
        t += rng.choice([0, 1, 2, 5, 30, 61, 200])
        key = 0 if rng.random() < 0.6 else rng.choice([1, 2, None])
        rows.append((i, key, t, rng.choice([2, 5])))
    base = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(i, k, base + dt.timedelta(seconds=s), n) for i, k, s, n in rows], "id int, k int, ts timestamp_ntz, lim int")
    got = monitor.fixed_window_limit(df, "k", "ts", F.col("lim"), "id", 60, chunk_seconds=chunk).collect()
    want = brute_limit(rows, 60)
    assert len(got) == len(rows)
    for r in got:
        start, used, ok = want[r["id"]]
        assert (r["window_start"], r["position"], r["allowed"]) == (base + dt.timedelta(seconds=start), used, ok)


def test_busy_key_is_cut(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(i, 1 if i % 4 else 2, base + dt.timedelta(seconds=i)) for i in range(2000)]
    df = spark.createDataFrame(rows, "id int, k int, ts timestamp_ntz")
    whole = monitor.fixed_window_limit(df, "k", "ts", F.lit(5), "id", 60)
    parts = monitor.fixed_window_limit(df, "k", "ts", F.lit(5), "id", 60, chunk_rows=100)
    assert sorted(whole.collect()) == sorted(parts.collect())


def test_request_limit_fixture(spark):
    base = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(i, "a", base + dt.timedelta(seconds=s)) for i, s in enumerate([0, 10, 59, 61])], "id int, k string, ts timestamp_ntz")
    got = {r["id"]: r["allowed"] for r in monitor.fixed_window_limit(df, "k", "ts", F.lit(2), "id").collect()}
    assert got == {0: True, 1: True, 2: False, 3: True}


def test_walk_chunk():
    _, close, count = walk_chunk(np.array([0, 5, 12, 30]), 10)
    assert close.tolist() == [40, 40, 40, 40] and count.tolist() == [1, 1, 1, 1]


def test_neighbours_in_blocks(spark):
    rng = np.random.default_rng(5)
    pts = rng.normal(size=(120, 3))
    pts[10] = pts[11]
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(pts)], "id int, a double, b double, c double")
    for block in (1000, 25):
        got = sampling.minority_neighbours(df, "id", ["a", "b", "c"], 4, 120, block).collect()
        assert len(got) == 480
        for r in got:
            assert abs(((pts[r["id"]] - pts[r["other"]]) ** 2).sum() - r["dist"]) < 1e-9
        by = {}
        for r in got:
            by.setdefault(r["id"], set()).add(r["other"])
        for i in range(120):
            order = sorted((((pts[i] - pts[j]) ** 2).sum(), j) for j in range(120) if j != i)
            assert by[i] == {j for _, j in order[:4]}


def test_smote_lies_between(spark):
    rng = np.random.default_rng(1)
    rows = [(i, 1 if i < 20 else 0, float(rng.normal()), float(rng.normal())) for i in range(100)]
    df = spark.createDataFrame(rows, "id int, y int, a double, b double")
    made = sampling.smote(df, "y", "id", ["a", "b"]).collect()
    assert len(made) == 60
    at = {r[0]: r[2:] for r in rows}
    for m in made:
        p, n = at[m["base_id"]], at[m["neighbour_id"]]
        assert 0 <= m["u"] < 1 and m["base_id"] < 20 and m["neighbour_id"] < 20
        assert abs(m["a"] - (p[0] + m["u"] * (n[0] - p[0]))) < 1e-9
    with pytest.raises(ValueError):
        sampling.smote(df.withColumn("t", F.lit("x")), "y", "id", ["a", "t"])


def test_split_sizes(spark):
    df = spark.createDataFrame([(i, int(i >= 70)) for i in range(100)], "id int, y int")
    parts = sampling.stratified_split(df, "y", "id")
    got = {(r["split"], r["y"]): r["count"] for r in parts.groupBy("split", "y").count().collect()}
    assert got == {("train", 0): 42, ("val", 0): 14, ("test", 0): 14, ("train", 1): 18, ("val", 1): 6, ("test", 1): 6}


def test_split_without_small_tables(spark, monkeypatch):
    df = spark.createDataFrame([(i, None if i % 5 == 0 else i % 3) for i in range(400)], "id int, y int")
    want = sorted(map(str, sampling.stratified_split(df, "y", "id").collect()))
    for mod in (sizing, sampling):
        monkeypatch.setattr(mod, "small_table", lambda df, *a, **k: None)
    assert sorted(map(str, sampling.stratified_split(df, "y", "id").collect())) == want


def test_folds_are_even(spark):
    df = spark.createDataFrame([(i, int(i % 7 == 0)) for i in range(233)], "id int, y int")
    rows = sampling.stratified_kfold(df, "y", "id", 5).groupBy("y", "fold").count().collect()
    for y in (0, 1):
        sizes = [r["count"] for r in rows if r["y"] == y]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_small_classes_split(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "id int, y int")
    rows = sampling.stratified_split(df, "y", "id").collect()
    assert len(rows) == 3 and {r["split"] for r in rows} <= {"train", "val", "test"}


def test_oversample_evens_classes(spark):
    df = spark.createDataFrame([(i, int(i < 10)) for i in range(100)], "id int, y int")
    out = sampling.random_oversample(df, "y", "id")
    assert {r["y"]: r["count"] for r in out.groupBy("y").count().collect()} == {0: 90, 1: 90}
    assert sampling.balance_if_needed(df.where("id < 30"), "y", "id").count() == 30


def test_numbers_are_dense(spark):
    df = spark.range(1000)
    got = sorted(r["n"] for r in ranking.number_rows(df, "id", 1, 1000, "n").collect())
    assert got == list(range(1000))


def test_label_codes_wide(spark, monkeypatch):
    df = spark.createDataFrame([(f"v{i % 97:03d}",) for i in range(500)] + [(None,)], "c string")
    want = sorted(encode.label_codes(df, "c").collect())
    monkeypatch.setattr(encode, "small_table", lambda df: None)
    assert sorted(encode.label_codes(df, "c", marks=7).collect()) == want


def test_join_large_side(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, k string")
    other = spark.createDataFrame([("a", 10), (None, 20)], "k string, v int")
    want = sorted(joins.left_join(df, other, "k").collect())
    assert [r["v"] for r in want] == [10, 20, None]
    monkeypatch.setattr(sizing, "small_table", lambda df, *a: None)
    assert sorted(joins.left_join(df, other, "k").collect()) == want


def test_small_table_bounds(spark):
    assert sizing.small_table(spark.range(10), 5) is None
    assert sizing.small_table(spark.range(10), 10).count() == 10
    assert sizing.small_table(spark.range(1000), 5000, max_bytes=100) is None
