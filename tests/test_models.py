"""Properties of selection, training and the run table."""

import datetime as dt

import numpy as np
import pytest

from scorelake.operators import leakage, modeling as ml, prepare as prep, sampling

NAMES = [f"f{i}" for i in range(6)]


@pytest.fixture(scope="module")
def matrix(spark):
    rng = np.random.default_rng(42)
    x = rng.normal(size=(400, 6))
    y = (x[:, 0] + x[:, 2] + x[:, 5] > 0).astype(int)
    rows = [(i, *map(float, r), int(v)) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "row_id int, " + ", ".join(f"{n} double" for n in NAMES) + ", y int").cache()


def test_rfe_returns_n(matrix):
    assert set(ml.rfe(matrix, "y", NAMES, n=3, step=2, trees=10)) == {"f0", "f2", "f5"}


def test_kbest_and_model(matrix):
    assert set(ml.select_features(matrix, "y", NAMES, "row_id", "selectkbest", 3)) == {"f0", "f2", "f5"}
    assert set(ml.select_features(matrix, "y", NAMES, "row_id", "model", 3)) <= {"f0", "f2", "f5"}
    with pytest.raises(ValueError):
        ml.select_features(matrix, "y", NAMES, "row_id", "none")


def test_cross_validation(matrix):
    out = {r["metric"]: r for r in ml.cross_validate_balanced(matrix, "y", NAMES, "row_id", lambda: ml.random_forest(5, 3), folds=3).collect()}
    assert set(out) == {"accuracy", "auc", "precision", "recall", "f1"}
    assert all(0 <= r["mean"] <= 1 and r["std"] >= 0 for r in out.values()) and out["auc"]["mean"] > 0.7


def test_training_and_store(spark, matrix, tmp_path):
    from pyspark.ml import PipelineModel

    parts = sampling.stratified_split(matrix, "y", "row_id")
    model = ml.train_scoring_model(parts, "y", NAMES, [], trees=10, depth=4)
    assert len(model.metrics) == 12 and model.metrics["val_auc"] > 0.7
    model.save(str(tmp_path / "m"))
    back = PipelineModel.load(str(tmp_path / "m"))
    mine, theirs = (sorted(ml.batch_score(matrix.select("row_id", *NAMES), m).select("row_id", "prediction_probability").collect()) for m in (model, back))
    assert mine == theirs
    worse = ml.TrainedModel("other", None, None, {"val_auc": 0.1})
    assert ml.compare_models([worse, model]) is model and ml.compare_models([model]) is model


def test_run_table(spark, tmp_path):
    path = str(tmp_path / "runs")
    for i, auc in enumerate((0.7, 0.9)):
        ml.record_run(ml.run_rows(spark, "RandomForest", dt.datetime(2024, 1, 1 + i), {"trees": 10}, {"val_auc": auc}, f"r{i}"), path)
    runs = spark.read.parquet(path)
    assert {r["run_id"] for r in ml.latest_runs(runs).collect()} == {"r1"}
    assert ml.best_run(runs).first()["run_id"] == "r1"
    assert [r["val_auc"] for r in ml.search_runs(runs, "Forest", "val_auc").orderBy("recency").collect()] == [0.9, 0.7]


def test_leak_is_found(spark):
    rng = np.random.default_rng(42)
    rows = [(int(v), float(rng.normal()), float(0.9 * v + rng.normal() * 0.05), "s" if v else "n") for v in rng.integers(0, 2, 100)]
    df = spark.createDataFrame(rows, "target int, noise double, leaky double, resultado string")
    found = {r["column"] for r in leakage.leaking_columns(leakage.leakage_report(df, "target")).collect()}
    assert found == {"leaky", "resultado"}


def test_unseen_level_is_zero(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", 3.0), (None, None)], "c string, x double")
    model = prep.fit_preprocess(train, ["x"], ["c"])
    new = spark.createDataFrame([("zzz", 2.0), ("a", None)], "c string, x double")
    vec = [r["features"].toArray().tolist() for r in model.transform(new).collect()]
    assert vec[0] == [0.0, 0.0, 0.0, 0.0] and vec[1] == [0.0, 1.0, 0.0, 0.0]


def test_roles_and_assembly(spark):
    df = spark.createDataFrame([(1, "x", "t", 2.0, True, "k")], "job_id int, data_final string, comentario string, valor double, ok boolean, cat string")
    roles = prep.feature_roles(df.withColumnRenamed("valor", "v"), "y", ["cat"])
    assert roles.numeric == ["v"] and "ok" in roles.categorical and "cat" not in roles.categorical
    names = prep.assemble_features(["area_vaga_B", "area_vaga_A", "menciona_cliente", "area_vaga_encoded", "dias_no_pipeline"])
    assert names == ["dias_no_pipeline", "area_vaga_encoded", "area_vaga_A", "area_vaga_B", "menciona_cliente"]


def test_importance_names(spark, matrix):
    model = ml.random_forest(5, 3).fit(ml.vectorize(matrix, NAMES, "y"))
    got = ml.feature_importance(spark, model, NAMES[:4]).collect()
    assert len(got) == 6 and {"Feature_4", "Feature_5"} <= {r["feature"] for r in got}
    assert len(ml.feature_importance(spark, model, NAMES + ["more"], top=2).collect()) == 2
