"""Running sums by value through range partitions: equal to a plain version for every partition size, NaN and infinities included."""

import math
import random

import pytest
from pyspark.sql import functions as F

from scorelake.operators import evaluate, ranking


def plain(values, labels):
    """Per distinct value (NaN above all, as one value): sums and running sums from the highest down."""
    key = lambda v: (1, 0.0) if math.isnan(v) else (0, v)
    groups = {}
    for v, y in zip(values, labels):
        k = key(v)
        pos, rows = groups.get(k, (0, 0))
        groups[k] = (pos + y, rows + 1)
    out, cum_pos, cum_rows = [], 0, 0
    for k in sorted(groups, reverse=True):
        cum_pos += groups[k][0]
        cum_rows += groups[k][1]
        out.append((k, groups[k][0], groups[k][1], cum_pos, cum_rows))
    return out


def frames():
    rng = random.Random(7)
    nan_heavy = [math.nan] * 40 + [rng.choice([0.1, 0.2, 0.3]) for _ in range(30)]
    infinite = [math.inf] * 7 + [-math.inf] * 9 + [rng.random() for _ in range(50)] + [math.nan] * 3
    ties = [0.5] * 100 + [0.25] * 3
    return {"nan_heavy": nan_heavy, "infinite": infinite, "ties": ties, "one": [1.0], "empty": []}


@pytest.mark.parametrize("name", sorted(frames()))
@pytest.mark.parametrize("bucket_rows", [1, 2, 7, 10**6])
def test_running_sums_equal_plain(spark, name, bucket_rows):
    values = frames()[name]
    labels = [i % 2 for i in range(len(values))]
    df = spark.createDataFrame(list(zip(values, labels)) + [(None, 1)], "s double, y int")
    got, totals = ranking.running_by_value(df, "s", {"pos": F.col("y"), "rows": F.lit(1)}, bucket_rows=bucket_rows)
    key = lambda v: (1, 0.0) if math.isnan(v) else (0, v)
    rows = sorted(((key(r["value"]), r["pos"], r["rows"], r["cum_pos"], r["cum_rows"]) for r in got.collect()), reverse=True)
    assert rows == plain(values, labels)
    assert totals == {"pos": sum(labels), "rows": len(values)}


def test_auc_the_same_at_every_partition_size(spark):
    rng = random.Random(3)
    data = [(rng.choice([rng.random(), math.nan, math.inf, -math.inf, 0.5]), rng.randint(0, 1)) for _ in range(500)]
    df = spark.createDataFrame(data, "s double, y int")
    one = evaluate.roc_auc(df, "y", "s").first()[0]
    assert evaluate.roc_auc(df, "y", "s", bucket_rows=1).first()[0] == pytest.approx(one)
    assert evaluate.average_precision(df, "y", "s", bucket_rows=3).first()[0] == pytest.approx(evaluate.average_precision(df, "y", "s").first()[0])


def test_quantile_bracket_not_held_falls_back_to_the_whole_column(spark, monkeypatch):
    """A sketch that answers wrongly only costs work: brackets that miss their rank become the whole column."""
    import numpy as np

    from scorelake.operators import quantiles

    real = F.percentile_approx
    monkeypatch.setattr(F, "percentile_approx", lambda c, p, a: F.array(*[F.lit(0.0) for _ in p]))
    values = [float(x) for x in np.random.default_rng(2).normal(size=500)] + [math.inf, -math.inf, math.nan]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = quantiles.exact_quantiles(df, ["x"], [0.1, 0.5, 0.99], bucket_rows=3)["x"]
    monkeypatch.setattr(F, "percentile_approx", real)
    clean = np.array([v for v in values if not math.isnan(v)])
    assert got == pytest.approx(list(np.quantile(clean, [0.1, 0.5, 0.99])))


@pytest.mark.parametrize("rows", [1, 3, 10**6])
def test_metric_drops_carry_across_partitions(spark, rows):
    """Previous entries found across range partitions equal a plain pass in time order, per key and over all."""
    import datetime as dt

    from scorelake.operators import monitor

    rng = random.Random(4)
    start = dt.datetime(2024, 1, 1)
    data = []
    for i in range(60):
        ts = start + dt.timedelta(hours=rng.randint(0, 40))
        data.append((ts, rng.choice(["accuracy", "f1"]), rng.random(), rng.choice(["a", "b", None])))
    df = spark.createDataFrame(data, "timestamp timestamp, metric string, value double, model string")
    for by in ((), ("model",)):
        got = [tuple(r) for r in monitor.metric_drops(df, "accuracy", by, rows_per_part=rows).collect()]
        want = []
        keys = {tuple(d[3] for _ in by) for d in data}
        for key in keys:
            mine = [d for d in data if tuple(d[3] for _ in by) == key]
            stamps = sorted({d[0] for d in mine})
            values = [max([d[2] for d in mine if d[0] == ts and d[1] == "accuracy"], default=None) for ts in stamps]
            values = [1.0 if v is None else v for v in values]
            for k in range(1, len(stamps)):
                want.append((*key, stamps[k], values[k - 1], values[k], values[k - 1] - values[k]))
        assert sorted(got, key=str) == sorted(want, key=str)


def test_pivot_neighbours_equal_brute_force_and_visit_less(spark):
    """Exact k nearest with ties and repeated points; round two visits well under half of all pairs."""
    import numpy as np

    from scorelake.operators import sampling

    rng = np.random.default_rng(8)
    centers = rng.normal(scale=10, size=(12, 4))
    pts = np.concatenate([c + rng.normal(size=(100, 4)) for c in centers])
    pts[5] = pts[6] = pts[7]  # repeated rows
    pts[20:24] = np.round(pts[20:24])  # ties on a grid
    n, k = len(pts), 5
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(pts)], "id long, a double, b double, c double, d double")
    got, visits = sampling._pivot_rounds(df, "id", ["a", "b", "c", "d"], k, n, 100, 7)
    by = {}
    for r in got.collect():
        by.setdefault(r["id"], []).append((r["dist"], r["other"]))
    for i in range(n):
        gap = ((pts - pts[i]) ** 2).sum(1)
        order = sorted((gap[j], j) for j in range(n) if j != i)[:k]
        assert [j for _, j in sorted(by[i])] == [j for _, j in order]
    sizes = {r["cell"]: r["n"] for r in visits.groupBy("cell").count().withColumnRenamed("count", "n").collect()}
    assert sum(sizes.values()) < n * 12 / 2  # rows asked of other cells, against asking every cell
