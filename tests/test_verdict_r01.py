"""Faults found in the first round: each must stay mended."""

import math

import pytest
from pyspark.sql import functions as F

from scorelake import session, sizing
from scorelake.operators import quantiles, ranking, sampling


def test_quantiles_with_infinities_are_the_same_on_both_paths(spark):
    values = [float(i) for i in range(51)]
    for extra in ([math.inf], [-math.inf, -math.inf], [math.inf, -math.inf, math.nan]):
        df = spark.createDataFrame([(v,) for v in values + extra], "x double")
        probs = [0.0, 0.25, 0.5, 0.75, 1.0]
        clean = sorted(v for v in values + extra if not math.isnan(v))
        want = []
        for p in probs:
            spot = p * (len(clean) - 1)
            lo, hi, part = clean[math.floor(spot)], clean[math.ceil(spot)], spot - math.floor(spot)
            want.append(lo if lo == hi or part == 0 else (1 - part) * lo + part * hi)
        assert quantiles.exact_quantiles(df, ["x"], probs, accuracy=20, bucket_rows=1)["x"] == pytest.approx(want)


def test_nan_scores_rank_highest_in_buckets(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 1), (math.nan, 1), (0.7, 0), (0.9, 1)], "s double, y int")
    sums = {"pos": F.col("y"), "rows": F.lit(1)}
    key = lambda r: (math.isnan(r["value"]), 0 if math.isnan(r["value"]) else r["value"], r["cum_pos"], r["cum_rows"])
    one = sorted(key(r) for r in ranking.running_by_value(df, "s", sums)[0].collect())
    many = sorted(key(r) for r in ranking.running_by_value(df, "s", sums, bucket_rows=1)[0].collect())
    assert one == many


def test_a_wide_table_is_measured_before_it_is_fetched(spark, monkeypatch):
    wide = spark.range(300).select("id", F.repeat(F.lit("x"), 100_000).alias("text"))
    monkeypatch.setattr(type(wide), "toArrow", lambda self: pytest.fail("fetched"))
    assert sizing.small_table(wide) is None
    assert sizing.small_table(spark.range(30_000)) is None


def test_balancing_refuses_what_it_would_lose(spark):
    three = spark.range(100).select("id", (F.col("id") % 3).alias("y"), F.rand(1).alias("a"))
    with pytest.raises(ValueError, match="two classes"):
        sampling.random_oversample(three, "y", "id")
    missing = spark.range(10).select("id", F.when(F.col("id") > 2, 1).when(F.col("id") == 2, 0).alias("y"), F.rand(1).alias("a"))
    with pytest.raises(ValueError, match="NULL"):
        sampling.balance_if_needed(missing, "y", "id")


def test_synthetic_rows_even_the_classes_with_missing_features(spark):
    rows = spark.range(110).select("id", (F.col("id") >= 95).cast("int").alias("y"), F.when(F.col("id") % 2 == 0, F.col("id") * 1.0).alias("a"), F.rand(2).alias("b"))
    made = sampling.smote(rows, "y", "id", ["a", "b"])
    assert made.count() == 95 - 15


def test_a_minority_of_one_row_is_drawn_again(spark):
    rows = spark.range(11).select("id", (F.col("id") == 0).cast("int").alias("y"), F.rand(2).alias("a"))
    out = sampling.balance_if_needed(rows, "y", "id", features=["a"])
    assert {r["y"]: r["count"] for r in out.groupBy("y").count().collect()} == {0: 10, 1: 10}


def test_one_fold_is_refused(spark):
    with pytest.raises(ValueError):
        sampling.stratified_kfold(spark.range(4).select("id", F.lit(1).alias("y")), "y", "id", 1)


def test_a_cluster_without_a_shared_folder_is_refused():
    class Session:
        class conf:  # noqa: N801
            @staticmethod
            def get(key, default=None):
                return {"spark.master": "spark://host:7077"}.get(key, default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_dir(Session)


def test_a_replayed_report_does_not_double(spark, tmp_path):
    from scorelake.sources import writers

    report = spark.range(1).select(F.current_timestamp().alias("timestamp"), F.lit(0.5).alias("drift_score"))
    for _ in range(2):
        writers.append_drift_report(report, f"{tmp_path}/batch=0", "overwrite")
    assert spark.read.parquet(f"{tmp_path}/batch=0/reports").count() == 1
