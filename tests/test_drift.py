"""Drift values worked out by hand, and the stores behind them."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from scorelake.operators import drift as dr
from scorelake.operators import monitor as mon
from scorelake.plans.drift import check_drift, latest_or_check
from scorelake.sources import readers, writers

NOW = dt.datetime(2024, 1, 31)


def js(spark, p, q):
    keys = sorted(set(p) | set(q))
    df = spark.createDataFrame([("f", k, float(p.get(k, 0)), float(q.get(k, 0))) for k in keys], "feature string, value string, p double, q double")
    return dr.js_divergence(df).first()["js"]


def test_js(spark):
    assert js(spark, {"a": 1}, {"a": 1}) == 0
    assert math.isclose(js(spark, {"a": 1}, {"b": 1}), math.log(2), abs_tol=1e-6)
    assert math.isclose(js(spark, {"a": 3, "b": 1}, {"a": 6, "b": 2}), 0, abs_tol=1e-12)
    assert 0 < js(spark, {"a": 0.7, "b": 0.3}, {"a": 0.2, "b": 0.8}) < 1


@pytest.fixture
def log(spark):
    rows = [(NOW - dt.timedelta(days=d), "c", 1, 0.5, f'{{"idade": {a}, "experiencia": "{e}"}}', "s")
            for d, a, e in ((1, 32, "junior"), (2, 27, "junior"), (3, 38, "senior"), (4, 33, "senior"), (60, 99, "old"))]
    return spark.createDataFrame(rows, "timestamp timestamp_ntz, candidate_id string, prediction int, prediction_probability double, features string, segment string")


def training(spark):
    numbers = spark.createDataFrame([("idade", 100, 30.0, 30.0, 5.0, 20.0, 40.0, 27.0, 33.0)], dr.NUMERIC_SCHEMA)
    groups = spark.createDataFrame([("experiencia", "junior", 50, 0.5), ("experiencia", "senior", 50, 0.5)], dr.CATEGORICAL_SCHEMA)
    return dr.FeatureStats(numbers, groups, 100, NOW)


def test_drift_of_both_kinds(spark, log):
    drift, report = check_drift(log, training(spark), 30, NOW)
    rows = {r["feature"]: r for r in drift.collect()}
    assert rows["idade"]["current_mean"] == 32.5 and rows["idade"]["score"] == 0.5 and not rows["idade"]["drift_detected"]
    assert rows["experiencia"]["score"] == 0 and rows["experiencia"]["n_new_categories"] == 0
    one = report.first()
    assert (one["status"], one["drift_score"], one["n_samples_analyzed"], one["features_analyzed"]) == ("ok", 0.0, 4, 2)


def test_report_without_data(spark, log):
    _, report = check_drift(log.where("1 = 0"), training(spark), 30, NOW)
    row = report.first()
    assert row["status"] == "error" and row["drift_detected"] is False and row["drift_score"] is None


def test_latest_or_check(spark, log, tmp_path):
    root = str(tmp_path / "r")
    first = latest_or_check(spark, root, log, training(spark), as_of=NOW).first()
    again = latest_or_check(spark, root, log.where("1 = 0"), training(spark)).first()
    assert first == again and first["timestamp"] == NOW
    base = spark.createDataFrame([("accuracy", 0.9)], "metric string, value double")
    writers.set_baseline(base, str(tmp_path / "b"))
    writers.set_baseline(base, str(tmp_path / "b"))
    assert spark.read.parquet(str(tmp_path / "b")).count() == 1


def test_stats_store(spark, tmp_path):
    df = spark.createDataFrame([(1.0, True, "a"), (3.0, False, "a"), (None, None, None)], "x double, b boolean, c string")
    stats = dr.feature_stats(df, ["x", "b", "c", "absent"], NOW)
    writers.save_training_stats(stats, str(tmp_path / "s"))
    back = writers.load_training_stats(spark, str(tmp_path / "s"))
    rows = {r["feature"]: r for r in back.numeric.collect()}
    assert rows["x"]["mean"] == 2.0 and rows["x"]["median"] == 2.0 and rows["b"]["mean"] == 0.5 and back.n_samples == 3
    assert [tuple(r) for r in back.categorical.collect()] == [("c", "a", 2, 1.0)]
    assert writers.load_training_stats(spark, str(tmp_path / "none")).n_samples == 0


def test_one_row_has_zero_deviation(spark):
    row = dr.feature_stats(spark.createDataFrame([(4.0,)], "x double"), ["x"]).numeric.first()
    assert row["std"] == 0.0 and row["q1"] == 4.0


def test_log_by_day(spark, log, tmp_path):
    path = str(tmp_path / "log")
    writers.append_predictions(log, path)
    back = spark.read.parquet(path)
    assert dr.latest_time(back, "timestamp") == NOW - dt.timedelta(days=1)
    kept = dr.recent(back, 10)
    assert kept.count() == 4
    plan = kept._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "PushedFilters: [IsNotNull(timestamp), GreaterThanOrEqual(timestamp" in plan


def test_baseline(spark):
    now = spark.createDataFrame([("a", 0.9), ("b", 0.5)], "metric string, value double")
    base = spark.createDataFrame([("a", 0.8), ("c", 0.1)], "metric string, value double")
    got = {r["metric"]: round(r["delta"], 6) for r in mon.baseline_delta(now, base).collect()}
    assert got == {"a": 0.1, "b": 0.5, "c": -0.1}
    assert {r["delta"] for r in mon.baseline_delta(now, base.where("1 = 0")).collect()} == {0.0}


def test_accuracy_alerts(spark):
    rows = [(NOW + dt.timedelta(days=i), "accuracy", v) for i, v in enumerate([0.9, 0.8, 0.79, 0.5])] + [(NOW + dt.timedelta(days=4), "f1", 0.3)]
    history = spark.createDataFrame(rows, "timestamp timestamp_ntz, metric string, value double")
    assert mon.metric_drop_alerts(history).count() == 2
    assert mon.metric_drop_alerts(history, last_only=True).count() == 0
    # An entry without the metric counts as 1.
    assert {round(r["drop"], 2) for r in mon.metric_drops(history).collect()} == {0.1, 0.01, 0.29, -0.5}


def test_readers(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"10": {"nome": "Ana", "n": 1}, "11": {"nome": "Bia", "n": 2}}')
    rows = sorted(readers.read_keyed_json(spark, str(tmp_path / "a.json"), "struct<nome:string,n:int>").collect())
    assert [tuple(r) for r in rows] == [("10", "Ana", 1), ("11", "Bia", 2)]
    assert readers.read_optional(spark, str(tmp_path / "none.parquet")) is None
    with pytest.raises(ValueError):
        readers.load_labelled(spark.range(1), "y")
    with pytest.raises(ValueError):
        readers.read_class_report(spark.range(1))


def test_service_alerts(spark):
    roll = spark.createDataFrame([(10, 2.0, 150.0)], "request_count long, error_rate double, average_latency double")
    assert [r["kind"] for r in mon.service_alerts(roll).collect()] == ["error_rate"]


def test_bad_json_is_empty(spark):
    df = spark.createDataFrame([('{"k": "1.5"}',), ("{bad",), (None,)], "features string")
    got = [(r["k"], r["c"]) for r in dr.parse_features(df, ["k"], ["c"]).collect()]
    assert got == [(1.5, None), (None, None), (None, None)]
    assert dr.parse_features(df).where(F.size("features_dict") == 0).count() == 2
