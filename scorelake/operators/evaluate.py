"""Evaluation and threshold analysis over a scored table (M)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.functions import vocab
from scorelake.operators.ranking import running_by_value

METRICS = ["accuracy", "precision", "recall", "f1"]


def ratio(a: Column, b: Column, empty: float = 0.0) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(empty))


def confusion_counts(y: Column, predicted: Column) -> list[Column]:
    return [
        F.count_if((y == 1) & (predicted == 1)).alias("tp"),
        F.count_if((y == 0) & (predicted == 1)).alias("fp"),
        F.count_if((y == 1) & (predicted == 0)).alias("fn"),
        F.count_if((y == 0) & (predicted == 0)).alias("tn"),
    ]


def confusion_matrix(df: DataFrame, y: str, predicted: Column) -> DataFrame:
    """``(actual, predicted, n)``, all four cells."""
    one = df.agg(*confusion_counts(F.col(y), predicted))
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(n).alias("n")) for a, p, n in cells
    ])))


def metric_columns() -> dict[str, Column]:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return {
        "accuracy": ratio(tp + tn, tp + fp + fn + tn),
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1": ratio(2 * tp, 2 * tp + fp + fn),
    }


def binary_metrics(df: DataFrame, y: str, predicted: Column) -> DataFrame:
    one = df.agg(*confusion_counts(F.col(y), predicted))
    return one.select(*[c.alias(n) for n, c in metric_columns().items()])


def score_curve(df: DataFrame, y: str, score: str, **kw) -> DataFrame:
    """Per distinct score: ``pos, neg`` there and ``tp, fp`` at or above it, with class totals."""
    rows, totals = running_by_value(
        df, score, {"pos": (F.col(y) == 1).cast("bigint"), "neg": (F.col(y) == 0).cast("bigint")}, **kw
    )
    return rows.select(
        F.col("value").alias("score"), "pos", "neg", F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
        F.lit(totals["pos"]).cast("bigint").alias("positives"), F.lit(totals["neg"]).cast("bigint").alias("negatives"),
    )


def auc_of(curve: DataFrame) -> DataFrame:
    """Each positive wins against the negatives below it and half of those it ties with."""
    below = F.col("negatives") - F.col("fp")
    wins = F.sum(F.col("pos").cast("double") * (below + F.col("neg") / 2))
    pairs = F.max("positives").cast("double") * F.max("negatives")
    return curve.agg(F.try_divide(wins, pairs).alias("auc"))


def roc_auc(df: DataFrame, y: str, score: str, **kw) -> DataFrame:
    return auc_of(score_curve(df, y, score, **kw))


def average_precision(df: DataFrame, y: str, score: str, **kw) -> DataFrame:
    step = F.col("pos") / F.col("positives") * F.col("tp") / (F.col("tp") + F.col("fp"))
    return score_curve(df, y, score, **kw).agg(F.coalesce(F.sum(step), F.lit(0.0)).alias("average_precision"))


def classification_report(df: DataFrame, y: str, predicted: Column) -> DataFrame:
    """One row per class, then accuracy, macro avg and weighted avg."""
    one = df.agg(*confusion_counts(F.col(y), predicted))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def side(hit: Column, wrong: Column, missed: Column) -> list[Column]:
        return [ratio(hit, hit + wrong), ratio(hit, hit + missed), ratio(2 * hit, 2 * hit + wrong + missed)]

    zero, one_ = side(tn, fn, fp), side(tp, fp, fn)
    n0, n1 = tn + fp, tp + fn
    total = n0 + n1
    accuracy = ratio(tp + tn, total)
    names = ("precision", "recall", "f1_score")

    def line(label: str, values: Sequence[Column], support: Column) -> Column:
        return F.struct(F.lit(label).alias("class"), *[v.alias(n) for n, v in zip(names, values)], support.alias("support"))

    rows = [
        line("0", zero, n0),
        line("1", one_, n1),
        line("accuracy", [accuracy] * 3, total),
        line("macro avg", [(a + b) / 2 for a, b in zip(zero, one_)], total),
        line("weighted avg", [ratio(a * n0 + b * n1, total) for a, b in zip(zero, one_)], total),
    ]
    return one.select(F.inline(F.array(*rows)))


def pr_points(curve: DataFrame) -> DataFrame:
    return curve.select(
        F.col("score").alias("threshold"),
        ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        ratio(F.col("tp"), F.col("positives"), 1.0).alias("recall"),
    )


def pr_curve(df: DataFrame, y: str, score: str, **kw) -> DataFrame:
    """One point per distinct score, and the closing point (precision 1, recall 0) without a threshold."""
    points = pr_points(score_curve(df, y, score, **kw))
    end = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(end)


def roc_points(curve: DataFrame) -> DataFrame:
    return curve.select(
        F.col("score").alias("threshold"),
        ratio(F.col("fp"), F.col("negatives")).alias("fpr"),
        ratio(F.col("tp"), F.col("positives")).alias("tpr"),
    )


def roc_curve(df: DataFrame, y: str, score: str, **kw) -> DataFrame:
    return roc_points(score_curve(df, y, score, **kw))


def f1_of(precision: Column, recall: Column) -> Column:
    return ratio(2 * precision * recall, precision + recall)


def best_f1_of(curve: DataFrame) -> DataFrame:
    """Highest F1 on the curve, the lowest score on ties; 0.5 when no score beats the end point."""
    f1 = ratio(2 * F.col("tp"), F.col("tp") + F.col("fp") + F.col("positives"))
    best = curve.agg(F.min(F.struct((-f1).alias("m"), F.col("score"))).alias("b"))
    none = F.col("b").isNull()
    return best.select(
        F.when(none, 0.5).otherwise(F.col("b.score")).alias("threshold"),
        F.when(none, 0.0).otherwise(-F.col("b.m")).alias("f1"),
    )


def best_f1_threshold(df: DataFrame, y: str, score: str, **kw) -> DataFrame:
    return best_f1_of(score_curve(df, y, score, **kw))


def youden_of(curve: DataFrame) -> DataFrame:
    """Highest tpr - fpr, the highest score on ties. Compared as whole numbers, so ties are exact."""
    gain = F.col("tp").cast("decimal(19,0)") * F.col("negatives").cast("decimal(19,0)") - F.col("fp").cast(
        "decimal(19,0)") * F.col("positives").cast("decimal(19,0)")
    best = curve.agg(F.max(F.struct(gain.alias("m"), "score", "tp", "fp", "positives", "negatives")).alias("b"))
    return best.select(
        F.col("b.score").alias("threshold"),
        (ratio(F.col("b.tp"), F.col("b.positives")) - ratio(F.col("b.fp"), F.col("b.negatives"))).alias("j"),
    )


def youden_threshold(df: DataFrame, y: str, score: str, **kw) -> DataFrame:
    return youden_of(score_curve(df, y, score, **kw))


def threshold_counts(df: DataFrame, y: str, score: str, thresholds: Sequence[float]) -> DataFrame:
    """Confusion counts at each threshold from one pass: rows are binned by how many thresholds they reach."""
    marks = sorted(thresholds)
    reached = F.lit(0)
    for t in marks:
        reached = reached + (F.col(score) >= t).cast("int")
    bins = df.where(F.col(score).isNotNull()).groupBy(reached.alias("reached")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg")
    )
    each = bins.select("reached", "pos", "neg", F.posexplode(F.array(*[F.lit(t) for t in marks])).alias("i", "threshold"))
    up = F.col("reached") > F.col("i")

    def total(cond: Column, n: str) -> Column:
        return F.sum(F.when(cond, F.col(n)).otherwise(0))

    return each.groupBy("threshold").agg(
        total(up, "pos").alias("tp"), total(up, "neg").alias("fp"), total(~up, "pos").alias("fn"), total(~up, "neg").alias("tn"))


def threshold_grid(df: DataFrame, y: str, score: str, thresholds: Sequence[float] = vocab.GRID_THRESHOLDS) -> DataFrame:
    counts = threshold_counts(df, y, score, thresholds)
    return counts.select("threshold", *[c.alias(n) for n, c in metric_columns().items()])


def best_grid_of(grid: DataFrame) -> DataFrame:
    best = grid.agg(F.min(F.struct((-F.col("f1")).alias("m"), "threshold")).alias("b"))
    return best.select("b.threshold")


def recommended_threshold(df: DataFrame, y: str, score: str, **kw) -> DataFrame:
    """Mean of the best F1, best Youden and best grid thresholds; finite thresholds only."""
    curve = score_curve(df, y, score, **kw)
    grid = threshold_grid(df, y, score)
    f1 = best_f1_of(curve).select(F.col("threshold").alias("f1_threshold"))
    youden = youden_of(curve).select(F.col("threshold").alias("youden_threshold"))
    found = f1.select(
        "f1_threshold", youden.scalar().alias("youden_threshold"), best_grid_of(grid).scalar().alias("grid_threshold")
    )
    mean = (F.col("f1_threshold") + F.col("youden_threshold") + F.col("grid_threshold")) / 3
    return found.withColumn("recommended", mean)


def threshold_table(df: DataFrame, y: str, score: str, thresholds: Sequence[float] = vocab.CHOSEN_THRESHOLDS) -> DataFrame:
    counts = threshold_counts(df, y, score, thresholds)
    positive = F.col("tp") + F.col("fp")
    share = ratio(positive * 100, positive + F.col("fn") + F.col("tn"))
    metrics = [F.round(c, 4).alias(n) for n, c in metric_columns().items()]
    return counts.select("threshold", *metrics, positive.alias("positivos_preditos"), F.round(share, 4).alias("pct_positivos"))


def threshold_comparison(df: DataFrame, y: str, score: str, chosen: float, default: float = 0.5) -> DataFrame:
    """``(metric, at_default, at_chosen, difference, pct_change)``; NULL change on a zero base."""
    both = threshold_grid(df, y, score, [default, chosen] if default != chosen else [default])
    side = {
        name: F.max(F.struct(F.when(F.col("threshold") == t, F.lit(1)).otherwise(0).alias("hit"),
                             *METRICS)).alias(name)
        for name, t in (("a", default), ("b", chosen))
    }
    one = both.agg(*side.values())
    rows = [
        F.struct(F.lit(m).alias("metric"), F.col(f"a.{m}").alias("at_default"), F.col(f"b.{m}").alias("at_chosen"))
        for m in ("accuracy", "precision", "recall", "f1")
    ]
    auc = roc_auc(df, y, score).select(F.lit("auc").alias("metric"), F.col("auc").alias("at_default"), F.col("auc").alias("at_chosen"))
    out = one.select(F.inline(F.array(*rows))).unionByName(auc)
    gap = F.col("at_chosen") - F.col("at_default")
    return out.withColumns({
        "difference": gap,
        "pct_change": F.when(F.col("metric") != "auc", F.try_divide(gap, F.col("at_default")) * 100),
    })
