"""Steps that may read their input once only, counted by the rows that pass a Python column."""

import datetime as dt
import threading

from pyspark.sql import functions as F

from scorelake.operators import modeling as ml
from scorelake.operators.evaluate import score_curve
from scorelake.plans.features import prospect_features
from scorelake.sizing import small_table


def counted(spark, df, column):
    """``df`` with ``column`` passed through a function that counts its rows, and the counter."""
    seen = spark.sparkContext.accumulator(0)

    def look(v):
        seen.add(1)
        return v

    kind = df.schema[column].dataType
    return df.withColumn(column, F.udf(look, kind).asNondeterministic()(F.col(column))), seen


def test_feature_plan_reads_its_input_once(spark):
    rows = [(i, i % 3, f"r{i % 4}" if i % 5 else None, ["Aprovado", "Desistiu"][i % 2], dt.datetime(2024, 1, 1 + i), dt.datetime(2024, 2, 1)) for i in range(20)]
    df = spark.createDataFrame(rows, "row_id long, job_id long, recrutador string, situacao string, data_candidatura timestamp_ntz, ultima_atualizacao timestamp_ntz")
    df = df.withColumn("comentario", F.lit("interessado"))
    jobs = spark.createDataFrame([(0, "Analista", "TI"), (1, "Gerente", "RH")], "job_id long, titulo string, area_vaga string")
    watched, seen = counted(spark, df, "recrutador")
    got = prospect_features(watched, jobs).collect()
    assert seen.value == 20 and len(got) == 20
    assert {r["recrutador_encoded"] for r in got} == {0, 1, 2, 3, 4}


def test_small_table_evaluates_once(spark):
    watched, seen = counted(spark, spark.range(30), "id")
    assert small_table(watched, 30).count() == 30 and seen.value == 30
    assert small_table(spark.range(31), 30) is None


def matrix(spark, n=120):
    return spark.createDataFrame([(i, int(i % 4 == 0), float(i % 7), float(i % 4 == 0) + i % 3) for i in range(n)], "row_id long, y int, a double, b double")


def test_fits_know_the_classes_and_folds_run_together(spark, monkeypatch):
    fit_rows, seen, gate = ml.with_classes, [], threading.Barrier(2)

    def watched(data, top):
        gate.wait(120)  # both folds are here at once
        out = fit_rows(data, top)
        seen.append(out.schema["label"].metadata)
        return out

    monkeypatch.setattr(ml, "with_classes", watched)
    out = ml.cross_validate_balanced(matrix(spark), "y", ["a", "b"], "row_id", lambda: ml.random_forest(3, 3), folds=2)
    assert out.count() == 5 and [m["ml_attr"]["num_vals"] for m in seen] == [2, 2]


def test_rfecv_folds_run_together(spark, monkeypatch):
    forest, gate, calls = ml.random_forest, threading.Barrier(2), []

    def watched(*args, **kwargs):
        calls.append(1)
        if len(calls) <= 2:
            gate.wait(120)
        return forest(*args, **kwargs)

    monkeypatch.setattr(ml, "random_forest", watched)
    assert set(ml.rfecv(matrix(spark), "y", ["a", "b"], "row_id", n=1, folds=2, trees=3)) <= {"a", "b"}


def test_curves_read_their_rows_once(spark):
    watched, seen = counted(spark, matrix(spark).select("y", F.col("b").alias("score")), "score")
    assert score_curve(watched, "y", "score").count() == 4 and seen.value == 120


def test_second_model_takes_the_fitted_preparation(spark, monkeypatch):
    parts = matrix(spark).withColumns({"split": F.when(F.col("row_id") % 5 < 3, "train").when(F.col("row_id") % 5 == 3, "val").otherwise("test"), "c": (F.col("row_id") % 3).cast("string")})
    fits, fit = [], ml.fit_preprocess
    monkeypatch.setattr(ml, "fit_preprocess", lambda *a: fits.append(a) or fit(*a))
    first = ml.train_scoring_model(parts, "y", ["a", "b"], ["c"], trees=3, depth=3)
    again = ml.train_scoring_model(parts, "y", ["a", "b"], ["c"], preprocess=first.preprocess, trees=3, depth=3)
    assert len(fits) == 1 and again.metrics == first.metrics
