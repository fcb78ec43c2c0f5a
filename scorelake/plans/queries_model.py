"""Queries of sampling (K), preparation and models (L) and evaluation (M)."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorelake.functions import vocab
from scorelake.functions.scoring import apply_threshold
from scorelake.operators import evaluate as ev
from scorelake.operators import modeling as ml
from scorelake.operators import prepare as prep
from scorelake.operators import sampling as smp
from scorelake.plans import stand_ins as si
from scorelake.plans.registry import query, r, rounded, table
from scorelake.session import landed

C = F.col

# K ---------------------------------------------------------------------------------------------


def hash_sql(expr, seed=42):
    return f"md5(CAST({expr} AS VARCHAR) || '#{seed}')"


SPLIT = """sizes AS (SELECT o_orderstatus AS c, count(*) AS n FROM orders GROUP BY 1),
t AS (SELECT *, CAST(ceil(0.2 * sum(n) OVER ()) AS BIGINT) AS want, CAST(sum(n) OVER () AS BIGINT) AS total FROM sizes),
t2 AS (SELECT *, CAST(n AS HUGEINT) * want // total AS base, CAST(n AS HUGEINT) * want % total AS rest FROM t),
t3 AS (SELECT c, n, base + CAST(row_number() OVER (ORDER BY rest DESC, c) <= want - sum(base) OVER () AS INTEGER) AS n_test FROM t2),
v AS (SELECT *, CAST(n - n_test AS BIGINT) AS lft FROM t3),
v1 AS (SELECT *, CAST(ceil(0.25 * sum(lft) OVER ()) AS BIGINT) AS want, CAST(sum(lft) OVER () AS BIGINT) AS total FROM v),
v2 AS (SELECT *, CAST(lft AS HUGEINT) * want // total AS base, CAST(lft AS HUGEINT) * want % total AS rest FROM v1),
v3 AS (SELECT c, n, n_test, base + CAST(row_number() OVER (ORDER BY rest DESC, c) <= want - sum(base) OVER () AS INTEGER) AS n_val FROM v2),
ranked AS (SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY """ + hash_sql("o_orderkey") + """, o_orderkey) AS rn FROM orders),
parts AS (SELECT o_orderkey, o_orderstatus, CASE WHEN rn <= n_test THEN 'test' WHEN rn <= n_test + n_val THEN 'val' ELSE 'train' END AS split
  FROM ranked JOIN v3 ON c = o_orderstatus)"""


def split_orders(spark, sf):
    return smp.stratified_split(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", "o_orderkey")


@query("stratified_split", f"WITH {SPLIT} SELECT * FROM parts")
def _(spark, sf):
    return split_orders(spark, sf)


@query("split_class_shares", f"WITH {SPLIT} SELECT split, o_orderstatus, count(*) AS n, {r('count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY split)')} AS pct FROM parts GROUP BY 1, 2")
def _(spark, sf):
    return rounded(smp.split_class_shares(split_orders(spark, sf), "o_orderstatus"))


@query("stratified_kfold", f"""WITH ranked AS (SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {hash_sql('o_orderkey')}, o_orderkey) AS rn,
  count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders), cuts AS (SELECT unnest([1, 2, 3, 4]) AS f)
  SELECT o_orderkey, o_orderstatus, CAST((SELECT count(*) FROM cuts WHERE rn > f * (n // 5) + least(f, n % 5)) AS INTEGER) AS fold FROM ranked""")
def _(spark, sf):
    return smp.stratified_kfold(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", "o_orderkey")


def hex_int(text):
    return f"CAST(('0x' || substr({text}, 1, 15)) AS BIGINT)"


def oversample_sql(source, y, rid, seed=42):
    return f"""sizes AS (SELECT {y} AS c, count(*) AS n FROM {source} WHERE {y} IS NOT NULL GROUP BY 1),
  major AS (SELECT c, n FROM sizes ORDER BY n DESC, c LIMIT 1), minor AS (SELECT c, n FROM sizes ORDER BY n, c LIMIT 1),
  numbered AS (SELECT *, row_number() OVER (ORDER BY {hash_sql(rid, seed)}, {rid}) - 1 AS number FROM {source} WHERE {y} = (SELECT c FROM minor)),
  draws AS (SELECT j AS draw, {hex_int(f"md5('draw-{seed}-' || CAST(j AS VARCHAR))")} % (SELECT n FROM minor) AS number FROM range((SELECT n FROM major)) AS t(j)),
  balanced AS (SELECT {rid}, {y}, NULL::BIGINT AS draw FROM {source} WHERE {y} = (SELECT c FROM major)
    UNION ALL SELECT {rid}, {y}, draw FROM numbered JOIN draws USING (number))"""


@query("random_oversample", f"WITH {oversample_sql('labels', 'quality', 'doc_id')} SELECT doc_id, quality, draw FROM balanced")
def _(spark, sf):
    return smp.random_oversample(table(spark, sf, "labels").select("doc_id", "quality"), "quality", "doc_id")


@query("balance_if_needed", f"WITH {oversample_sql('labels', 'quality', 'doc_id')} SELECT quality, count(*) AS n FROM balanced GROUP BY 1")
def _(spark, sf):
    return smp.balance_if_needed(table(spark, sf, "labels").select("doc_id", "quality"), "quality", "doc_id").groupBy("quality").agg(
        F.count(F.lit(1)).alias("n"))


DIMS = [f"e{i}" for i in range(64)]


def vectors(spark, sf):
    """Embedding dimensions as columns; the label is one class against the rest."""
    return table(spark, sf, "embeddings").select(
        "vec_id", (C("label") == 0).cast("int").alias("y"), *[C("embedding")[i].cast("double").alias(n) for i, n in enumerate(DIMS)])


@query("smote")
def _(spark, sf):
    made = smp.smote(vectors(spark, sf), "y", "vec_id", DIMS)
    return made.select("draw", "y", "base_id", "neighbour_id", "u", *DIMS[:4])


@query("split_and_balance")
def _(spark, sf):
    df = smp.split_and_balance(table(spark, sf, "labels").select("doc_id", "quality"), "quality", "doc_id")
    return df.groupBy("split", "quality").agg(F.count(F.lit(1)).alias("n"), F.count("draw").alias("drawn"))


# L ---------------------------------------------------------------------------------------------



def holes(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.when(C("l_discount") > 0.02, C("l_extendedprice")).alias("price"), F.when(C("l_tax") > 0.03, C("l_quantity")).alias("qty"))


HOLES_SQL = "holes AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_discount > 0.02 THEN l_extendedprice END AS price, CASE WHEN l_tax > 0.03 THEN l_quantity END AS qty FROM lineitem)"


@query("impute_median", f"WITH {HOLES_SQL} SELECT l_orderkey, l_linenumber, l_partkey, {r('coalesce(price, (SELECT median(price) FROM holes))', 4)} AS price, {r('coalesce(qty, (SELECT median(qty) FROM holes))', 4)} AS qty FROM holes")
def _(spark, sf):
    return rounded(prep.impute_median(holes(spark, sf), ["price", "qty"]), 4)


@query("impute_constant", "SELECT event_id, coalesce(nullif(event_type, 'view'), 'missing') AS event_type FROM events")
def _(spark, sf):
    df = table(spark, sf, "events").select("event_id", F.nullif("event_type", F.lit("view")).alias("event_type"))
    return prep.impute_constant(df, ["event_type"])


@query("standard_scale", f"SELECT l_orderkey, l_linenumber, l_partkey, {r('(l_quantity - (SELECT avg(l_quantity) FROM lineitem)) / (SELECT stddev_pop(l_quantity) FROM lineitem)')} AS l_quantity, "
       f"{r('(l_extendedprice - (SELECT avg(l_extendedprice) FROM lineitem)) / (SELECT stddev_pop(l_extendedprice) FROM lineitem)')} AS l_extendedprice, 0.0::DOUBLE AS one FROM lineitem")
def _(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", F.lit(1.0).alias("one"))
    return rounded(prep.standard_scale(df, ["l_quantity", "l_extendedprice", "one"]))


ORDER_NUM = ["valor", "dias_no_pipeline", "mes", "tamanho", "preco", "saldo", "job_id"]
ORDER_CAT = ["tipo_contratacao", "area_vaga", "segmento"]


def training_table(spark, sf):
    from scorelake.operators.joins import join_applicants

    joined = join_applicants(si.labelled_jobs(spark, sf), si.applicants(spark, sf))
    return joined.select("row_id", "target_sucesso", "valor", "dias_no_pipeline", F.month("data_candidatura").alias("mes"), "tamanho", "preco", "saldo",
                         "job_id", "tipo_contratacao", "area_vaga", "segmento")


TRAINING = si.LABELLED_JOBS + """, training AS (SELECT j.*, CAST(month(data_candidatura) AS INTEGER) AS mes, c_acctbal AS saldo, c_mktsegment AS segmento
  FROM labelled_jobs j LEFT JOIN customer ON c_custkey = applicant_id)"""
CODES = "CASE tipo_contratacao WHEN '1-URGENT' THEN '1.0|0.0|0.0|0.0' WHEN '2-HIGH' THEN '0.0|1.0|0.0|0.0' WHEN '3-MEDIUM' THEN '0.0|0.0|1.0|0.0' WHEN '4-NOT SPECIFIED' THEN '0.0|0.0|0.0|1.0' ELSE '0.0|0.0|0.0|0.0' END"


@query("onehot_ignore_unknown", f"WITH {TRAINING} SELECT tipo_contratacao, count(*) AS n, 4 AS width, {CODES} AS code FROM training GROUP BY 1")
def _(spark, sf):
    from pyspark.ml.functions import vector_to_array

    df = training_table(spark, sf)
    known = df.where(C("tipo_contratacao") != "5-LOW")
    model = prep.fit_preprocess(known, [], ["tipo_contratacao"])
    vec = model.transform(df).select("tipo_contratacao", vector_to_array("features").alias("v"))
    return vec.groupBy("tipo_contratacao").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width"), F.max(F.array_join("v", "|")).alias("code"))


FILLED = "filled AS (SELECT row_id, " + ", ".join(f"coalesce({c}, (SELECT median({c}) FROM training))::DOUBLE AS {c}" for c in ORDER_NUM) + " FROM training)"
WIDTH = "CAST(" + " + ".join(f"(SELECT count(DISTINCT coalesce({c}, 'missing')) FROM training)" for c in ORDER_CAT) + f" + {len(ORDER_NUM)} AS INTEGER)"


@query("preprocess_fit", f"WITH {TRAINING}, {FILLED} SELECT row_id, {WIDTH} AS width, " + ", ".join(
    f"{r(f'({c} - (SELECT avg({c}) FROM filled)) / (SELECT stddev_pop({c}) FROM filled)')} AS v{i}" for i, c in enumerate(ORDER_NUM)) + " FROM filled")
def _(spark, sf):
    from pyspark.ml.functions import vector_to_array

    df = training_table(spark, sf)
    model = prep.fit_preprocess(df, ORDER_NUM, ORDER_CAT)
    vec = model.transform(df).select("row_id", vector_to_array("features").alias("v"))
    return rounded(vec.select("row_id", F.size("v").alias("width"), *[C("v")[i].alias(f"v{i}") for i in range(len(ORDER_NUM))]))


@query("assemble_features")
def _(spark, sf):
    from scorelake.plans.features import prospect_features

    full = landed(prospect_features(si.plan_input(spark, sf), si.jobs(spark, sf)))
    return rounded(prep.feature_matrix(full, "target_sucesso"))


ANOVA = "anova AS (" + " UNION ALL ".join(
    f"SELECT 'e{i}' AS feature, label AS y, embedding[{i + 1}]::DOUBLE AS x FROM embeddings" for i in range(64)) + """),
g AS (SELECT feature, y, count(*) AS n, avg(x) AS m, var_pop(x) AS v FROM anova GROUP BY 1, 2),
t AS (SELECT feature, avg(x) AS grand, count(*) AS total, count(DISTINCT y) AS k FROM anova GROUP BY 1),
f AS (SELECT feature, (sum(n * (m - grand) ** 2) / (max(k) - 1)) / (sum(n * v) / (max(total) - max(k))) AS f FROM g JOIN t USING (feature) GROUP BY 1)"""


def labelled_vectors(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "label", *[C("embedding")[i].cast("double").alias(n) for i, n in enumerate(DIMS)])


@query("select_k_best", f"WITH {ANOVA} SELECT feature, {r('f', 5)} AS f FROM f ORDER BY f.f DESC, feature LIMIT 20")
def _(spark, sf):
    return rounded(prep.select_k_best(labelled_vectors(spark, sf), "label", DIMS, 20), 5)


@query("drop_feature_roles", f"WITH {si.LABELLED_JOBS} SELECT tipo_contratacao, valor, area_vaga, tamanho, row_id, target_sucesso FROM labelled_jobs")
def _(spark, sf):
    df = si.labelled_jobs(spark, sf).drop("ultima_atualizacao", "applicant_id", "dias_no_pipeline", "preco", "titulo", "recrutador")
    return prep.drop_feature_roles(df, "target_sucesso", ["situacao", "categoria_situacao"], ["row_id"])


TREE_FEATURES = ["valor", "dias_no_pipeline", "mes", "tamanho", "preco", "saldo"]


def tree_table(spark, sf):
    """Numeric features with a label that depends on them, so a model has something to learn."""
    df = prep.impute_median(landed(training_table(spark, sf)), TREE_FEATURES)
    y = ((C("valor") > 250000) & (C("dias_no_pipeline") > 200) | (C("target_sucesso") == 1) & (C("tamanho") > 40)).cast("int")
    return df.select("row_id", y.alias("y"), *TREE_FEATURES, *ORDER_CAT)


def names(spark, found):
    return spark.createDataFrame([(i, n) for i, n in enumerate(found)], "position int, feature string")


@query("rfe")
def _(spark, sf):
    return names(spark, ml.rfe(tree_table(spark, sf), "y", TREE_FEATURES, n=3, trees=10))


@query("rfecv")
def _(spark, sf):
    return names(spark, ml.rfecv(tree_table(spark, sf), "y", TREE_FEATURES, "row_id", n=4, folds=3, trees=5))


@query("select_from_model")
def _(spark, sf):
    return names(spark, ml.select_from_model(tree_table(spark, sf), "y", TREE_FEATURES, n=4, trees=20))


def scored_sample(spark, sf, model):
    data = ml.vectorize(tree_table(spark, sf), TREE_FEATURES, "y", ["row_id"])
    return rounded(ml.batch_score(data, model).select("row_id", "label", "prediction_probability"))


@query("train_random_forest")
def _(spark, sf):
    data = ml.vectorize(tree_table(spark, sf), TREE_FEATURES, "y")
    return scored_sample(spark, sf, ml.random_forest(20, 5).fit(data))


@query("train_gbt")
def _(spark, sf):
    data = ml.vectorize(tree_table(spark, sf), TREE_FEATURES, "y")
    return scored_sample(spark, sf, ml.gradient_boosting(10).fit(data))


@query("train_logistic_balanced")
def _(spark, sf):
    df = prep.standard_scale(tree_table(spark, sf), TREE_FEATURES)
    weighted = ml.balanced_weight(df, "y")
    model = ml.logistic(weight="weight").fit(ml.vectorize(weighted, TREE_FEATURES, "y", ["weight"]))
    data = ml.vectorize(df, TREE_FEATURES, "y", ["row_id"])
    return rounded(ml.batch_score(data, model).select("row_id", "label", "prediction_probability"))


@query("cross_validate_balanced")
def _(spark, sf):
    return rounded(ml.cross_validate_balanced(tree_table(spark, sf), "y", TREE_FEATURES, "row_id", lambda: ml.random_forest(5, 4), folds=3))


@query("predictive_power")
def _(spark, sf):
    df = prep.standard_scale(tree_table(spark, sf), TREE_FEATURES)
    return rounded(ml.predictive_power(df, "y", TREE_FEATURES, "row_id", folds=3, groups={"Tempo": ["dias", "mes"], "Valor": ["valor", "preco"]}, max_iter=50))


def split_trees(spark, sf):
    return landed(smp.stratified_split(tree_table(spark, sf), "y", "row_id"))


def metric_table(spark, models):
    rows = [(m.name, k, v) for m in models for k, v in sorted(m.metrics.items())]
    return rounded(spark.createDataFrame(rows, "model string, metric string, value double"))


@query("train_scoring_model")
def _(spark, sf):
    model = ml.train_scoring_model(split_trees(spark, sf), "y", TREE_FEATURES, ORDER_CAT, trees=20, depth=5)
    return metric_table(spark, [model])


@query("compare_models")
def _(spark, sf):
    parts = split_trees(spark, sf)
    models = []
    for kind, p in (("RandomForest", {"trees": 10, "depth": 4}), ("GradientBoosting", {"trees": 5})):
        fitted = models[0].preprocess if models else None  # both models take the same train rows
        models.append(ml.train_scoring_model(parts, "y", TREE_FEATURES, ORDER_CAT, kind, preprocess=fitted, **p))
    best = ml.compare_models(models).name
    return metric_table(spark, models).withColumn("best", F.lit(best))


@query("feature_importance")
def _(spark, sf):
    model = ml.random_forest(20, 5).fit(ml.vectorize(tree_table(spark, sf), TREE_FEATURES, "y"))
    return rounded(ml.feature_importance(spark, model, TREE_FEATURES[:5]))


@query("batch_score")
def _(spark, sf):
    parts = split_trees(spark, sf)
    model = ml.train_scoring_model(parts, "y", TREE_FEATURES, ORDER_CAT, trees=10, depth=4)
    return rounded(ml.batch_score(parts.select("row_id", "y", *TREE_FEATURES, *ORDER_CAT), model).select("row_id", "y", "prediction_probability"))


# Runs stand-in: every day of the log is a run named after its segment.
RUNS = """runs AS (SELECT event_type || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id, event_type AS name, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS start_time,
  'metric' AS kind, 'val_auc' AS "key", avg(value) AS v, count(*) AS n FROM events GROUP BY 1, 2, 3)"""


def runs(spark, sf):
    day = F.to_date("ts")
    one = table(spark, sf, "events").groupBy(
        F.concat_ws("-", "event_type", day.cast("string")).alias("run_id"), C("event_type").alias("name"), day.cast("timestamp_ntz").alias("start_time")
    ).agg(F.avg("value").alias("v"), F.count(F.lit(1)).alias("n"))
    metric = F.struct(F.lit("metric").alias("kind"), F.lit("val_auc").alias("key"), C("v").cast("string").alias("value"))
    param = F.struct(F.lit("param").alias("kind"), F.lit("rows").alias("key"), C("n").cast("string").alias("value"))
    return one.select("run_id", "name", "start_time", F.inline(F.array(metric, param)))


@query("latest_runs", f"WITH {RUNS} SELECT run_id, name, start_time, n FROM runs QUALIFY row_number() OVER (PARTITION BY name ORDER BY start_time DESC) = 1")
def _(spark, sf):
    rows = ml.latest_runs(runs(spark, sf)).where(C("kind") == "param")
    return rows.select("run_id", "name", "start_time", C("value").cast("bigint").alias("n"))


@query("search_runs", f"WITH {RUNS} SELECT run_id, name, start_time, {r('v')} AS val_auc, CAST(row_number() OVER (PARTITION BY name ORDER BY start_time DESC) AS INTEGER) AS recency FROM runs WHERE contains(name, 'i')")
def _(spark, sf):
    return rounded(ml.search_runs(runs(spark, sf), "i", "val_auc"))


@query("best_run", f"WITH {RUNS} SELECT run_id, name, {r('v')} AS val_auc FROM runs ORDER BY v DESC LIMIT 1")
def _(spark, sf):
    return rounded(ml.best_run(runs(spark, sf)))


# M ---------------------------------------------------------------------------------------------

AT = 0.05
CELLS = "sum(CAST(y = 1 AND score >= {t} AS INTEGER)) AS tp, sum(CAST(y = 0 AND score >= {t} AS INTEGER)) AS fp, sum(CAST(y = 1 AND score < {t} AS INTEGER)) AS fn, sum(CAST(y = 0 AND score < {t} AS INTEGER)) AS tn"
ACC, PRE, REC, F1 = ("coalesce((tp + tn) / nullif(tp + fp + fn + tn, 0), 0.0)", "coalesce(tp / nullif(tp + fp, 0), 0.0)", "coalesce(tp / nullif(tp + fn, 0), 0.0)",
                     "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0)")
METRICS = f"{r(ACC)} AS accuracy, {r(PRE)} AS \"precision\", {r(REC)} AS recall, {r(F1)} AS f1"


@query("confusion_matrix", f"WITH {si.SCORED} SELECT a AS actual, p AS predicted, (SELECT count(*) FROM scored WHERE y = a AND CAST(score >= {AT} AS INTEGER) = p) AS n FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) t(a, p)")
def _(spark, sf):
    return ev.confusion_matrix(si.scored(spark, sf), "y", apply_threshold(C("score"), AT))


@query("binary_metrics", f"WITH {si.SCORED}, c AS (SELECT {CELLS.format(t=AT)} FROM scored) SELECT {METRICS} FROM c")
def _(spark, sf):
    return rounded(ev.binary_metrics(si.scored(spark, sf), "y", apply_threshold(C("score"), AT)))


@query("roc_auc", f"""WITH {si.SCORED}, k AS (SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS avg_rank FROM scored)
  SELECT {r('(sum(avg_rank) FILTER (WHERE y = 1) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * (count(*) - sum(y)))')} AS auc FROM k""")
def _(spark, sf):
    return rounded(ev.roc_auc(si.scored(spark, sf), "y", "score"))


CURVE = si.SCORED + """, g AS (SELECT score, sum(y) AS pos, count(*) - sum(y) AS neg FROM scored GROUP BY 1),
curve AS (SELECT score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS pt, sum(neg) OVER () AS nt FROM g WINDOW w AS (ORDER BY score DESC))"""


@query("average_precision", f"WITH {CURVE} SELECT {r('sum(pos / pt * tp / (tp + fp))')} AS average_precision FROM curve")
def _(spark, sf):
    return rounded(ev.average_precision(si.scored(spark, sf), "y", "score"))


@query("classification_report", f"""WITH {si.SCORED}, c AS (SELECT {CELLS.format(t=AT)} FROM scored), s AS (
  SELECT *, coalesce(tn / nullif(tn + fn, 0), 0.0) AS p0, coalesce(tn / nullif(tn + fp, 0), 0.0) AS r0, coalesce(2 * tn / nullif(2 * tn + fn + fp, 0), 0.0) AS f0,
    {PRE} AS p1, {REC} AS r1, {F1} AS f1, tn + fp AS n0, tp + fn AS n1, {ACC} AS a FROM c)
  SELECT '0' AS "class", {r('p0')} AS "precision", {r('r0')} AS recall, {r('f0')} AS f1_score, CAST(n0 AS BIGINT) AS support FROM s
  UNION ALL SELECT '1', {r('p1')}, {r('r1')}, {r('f1')}, CAST(n1 AS BIGINT) FROM s
  UNION ALL SELECT 'accuracy', {r('a')}, {r('a')}, {r('a')}, CAST(n0 + n1 AS BIGINT) FROM s
  UNION ALL SELECT 'macro avg', {r('(p0 + p1) / 2')}, {r('(r0 + r1) / 2')}, {r('(f0 + f1) / 2')}, CAST(n0 + n1 AS BIGINT) FROM s
  UNION ALL SELECT 'weighted avg', {r('(p0 * n0 + p1 * n1) / (n0 + n1)')}, {r('(r0 * n0 + r1 * n1) / (n0 + n1)')}, {r('(f0 * n0 + f1 * n1) / (n0 + n1)')}, CAST(n0 + n1 AS BIGINT) FROM s""")
def _(spark, sf):
    return rounded(ev.classification_report(si.scored(spark, sf), "y", apply_threshold(C("score"), AT)))


@query("pr_curve", f"WITH {CURVE} SELECT {r('score', 9)} AS threshold, {r('tp / (tp + fp)', 9)} AS \"precision\", {r('tp / pt', 9)} AS recall FROM curve UNION ALL SELECT NULL, 1.0, 0.0")
def _(spark, sf):
    return rounded(ev.pr_curve(si.scored(spark, sf), "y", "score"), 9)


@query("roc_curve", f"WITH {CURVE} SELECT {r('score', 9)} AS threshold, {r('fp / nt', 9)} AS fpr, {r('tp / pt', 9)} AS tpr FROM curve")
def _(spark, sf):
    return rounded(ev.roc_curve(si.scored(spark, sf), "y", "score"), 9)


BEST_F1 = "(SELECT score FROM curve ORDER BY 2 * tp / (tp + fp + pt) DESC, score LIMIT 1)"
YOUDEN = "(SELECT score FROM curve ORDER BY CAST(tp AS HUGEINT) * nt - CAST(fp AS HUGEINT) * pt DESC, score DESC LIMIT 1)"


@query("best_f1_threshold", f"WITH {CURVE} SELECT {r('score', 9)} AS threshold, {r('2 * tp / (tp + fp + pt)')} AS f1 FROM curve ORDER BY 2 * tp / (tp + fp + pt) DESC, score LIMIT 1")
def _(spark, sf):
    out = ev.best_f1_threshold(si.scored(spark, sf), "y", "score")
    return rounded(rounded(out, 6, "f1"), 9, "threshold")


@query("youden_threshold", f"WITH {CURVE} SELECT {r('score', 9)} AS threshold, {r('tp / pt - fp / nt')} AS j FROM curve WHERE score = {YOUDEN}")
def _(spark, sf):
    out = ev.youden_threshold(si.scored(spark, sf), "y", "score")
    return rounded(rounded(out, 6, "j"), 9, "threshold")


def grid_sql(marks):
    return "marks AS (SELECT unnest([" + ", ".join(f"{t!r}::DOUBLE" for t in marks) + f"]) AS t), c AS (SELECT t, {CELLS.format(t='t')} FROM scored, marks GROUP BY t)"


@query("threshold_grid", f"WITH {si.SCORED}, {grid_sql(vocab.GRID_THRESHOLDS)} SELECT {r('t')} AS threshold, {METRICS} FROM c")
def _(spark, sf):
    return rounded(ev.threshold_grid(si.scored(spark, sf), "y", "score"))


@query("recommended_threshold", f"""WITH {CURVE}, {grid_sql(vocab.GRID_THRESHOLDS)}, b AS (SELECT {BEST_F1} AS f, {YOUDEN} AS y, (SELECT t FROM c ORDER BY {F1} DESC, t LIMIT 1) AS g)
  SELECT {r('f')} AS f1_threshold, {r('y')} AS youden_threshold, {r('g')} AS grid_threshold, {r('(f + y + g) / 3')} AS recommended FROM b""")
def _(spark, sf):
    return rounded(ev.recommended_threshold(si.scored(spark, sf), "y", "score"))


@query("threshold_table", f"""WITH {si.SCORED}, {grid_sql(vocab.CHOSEN_THRESHOLDS)} SELECT t AS threshold, {r(ACC, 4)} AS accuracy, {r(PRE, 4)} AS "precision", {r(REC, 4)} AS recall, {r(F1, 4)} AS f1,
  CAST(tp + fp AS BIGINT) AS positivos_preditos, {r('(tp + fp) * 100 / (tp + fp + fn + tn)', 4)} AS pct_positivos FROM c""")
def _(spark, sf):
    return rounded(ev.threshold_table(si.scored(spark, sf), "y", "score"), 4)


def compare_sql():
    lines = []
    for name, e in (("accuracy", ACC), ("precision", PRE), ("recall", REC), ("f1", F1)):
        lines.append(f"SELECT '{name}' AS metric, (SELECT {e} FROM c WHERE t = 0.05) AS a, (SELECT {e} FROM c WHERE t = 0.25) AS b")
    auc = "(SELECT sum(pos * (nt - fp + neg / 2)) / (max(pt) * max(nt)) FROM curve)"
    lines.append(f"SELECT 'auc', {auc}, {auc}")
    return " UNION ALL ".join(lines)


@query("threshold_comparison", f"""WITH {CURVE}, {grid_sql([0.05, 0.25])}, m AS ({compare_sql()}) SELECT metric, {r('a')} AS at_default, {r('b')} AS at_chosen, {r('b - a')} AS difference,
  {r("CASE WHEN metric <> 'auc' THEN (b - a) / nullif(a, 0) * 100 END", 4)} AS pct_change FROM m""")
def _(spark, sf):
    out = ev.threshold_comparison(si.scored(spark, sf), "y", "score", 0.25, 0.05)
    return rounded(rounded(out, 4, "pct_change"), 6, "at_default", "at_chosen", "difference")


@query("evaluate_scored", f"""WITH {CURVE}, c AS (SELECT {CELLS.format(t=0.25)} FROM (SELECT event_id, y, score / 2 AS score FROM scored)) SELECT {METRICS},
  (SELECT {r('sum(pos * (nt - fp + neg / 2)) / (max(pt) * max(nt))')} FROM curve) AS auc, (SELECT {r('sum(pos / pt * tp / (tp + fp))')} FROM curve) AS avg_precision FROM c""")
def _(spark, sf):
    return rounded(ml.evaluate_scored(si.scored(spark, sf), "y", "score"))
