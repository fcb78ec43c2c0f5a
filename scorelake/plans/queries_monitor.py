"""Queries of sources and sinks (A), drift and monitoring (O), streams (S)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from scorelake.operators import drift as dr
from scorelake.operators import monitor as mon
from scorelake.operators.aggregates import service_rollup, value_distribution
from scorelake.operators.evaluate import classification_report
from scorelake.operators.insight import group_importance, target_correlations
from scorelake.plans import stand_ins as si
from scorelake.plans.drift import check_drift
from scorelake.plans.queries_model import ACC, CELLS, F1, PRE, REC, SPLIT, split_orders
from scorelake.plans.queries_tables import CORRS, FEATURE_SQL, FEATURES, GROUP_OF, feats
from scorelake.plans.registry import query, r, rounded, table
from scorelake.session import scratch_dir as scratch
from scorelake.sources import readers, writers
from scorelake.streaming import jobs

C = F.col
SPLIT_AT = "TIMESTAMP '2024-01-16'"


# A ---------------------------------------------------------------------------------------------


@query("read_keyed_json", "SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS titulo, CAST(p_size AS BIGINT) AS tamanho FROM part")
def _(spark, sf):
    path = scratch(spark) + "/keyed"
    entry = F.concat(F.lit('"'), C("p_partkey").cast("string"), F.lit('":'), F.to_json(F.struct(C("p_name").alias("titulo"), C("p_size").alias("tamanho"))))
    # A thousand records per document, one document per line.
    docs = table(spark, sf, "part").groupBy(F.floor(C("p_partkey") / 1000).alias("b")).agg(
        F.concat(F.lit("{"), F.array_join(F.collect_list(entry), ","), F.lit("}")).alias("value"))
    docs.select("value").write.text(path)
    return readers.read_keyed_json(spark, path, "struct<titulo:string,tamanho:bigint>", per_line=True)


CSV_SCHEMA = "o_orderkey bigint, o_totalprice double, o_orderpriority string"


@query("read_table", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def _(spark, sf):
    path = scratch(spark) + "/orders.csv"
    table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority").write.option("header", True).csv(path)
    return readers.read_table(spark, path, CSV_SCHEMA)


@query("read_optional", "SELECT 'customer' AS name, count(*) AS n FROM customer UNION ALL SELECT 'absent', 0")
def _(spark, sf):
    out = None
    for name, file in (("customer", "customer"), ("absent", "no_such_table")):
        df = readers.read_optional(spark, f"{sf}/{file}.parquet")
        row = (spark.range(1).select(F.lit(name).alias("name"), F.lit(0).cast("bigint").alias("n")) if df is None
               else df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n"))
        out = row if out is None else out.unionByName(row)
    return out


@query("load_labelled", f"SELECT 'class' AS kind, CAST(quality AS VARCHAR) AS name, {r('count(*) * 100.0 / sum(count(*)) OVER ()')} AS pct FROM labels GROUP BY quality "
       f"UNION ALL SELECT 'missing', 'toxic', {r('count(*) FILTER (WHERE toxic = 1) * 100.0 / count(*)')} FROM labels")
def _(spark, sf):
    df = table(spark, sf, "labels").withColumn("toxic", F.nullif("toxic", F.lit(1)))
    _, shares, missing = readers.load_labelled(df, "quality")
    a = shares.select(F.lit("class").alias("kind"), C("value").cast("string").alias("name"), "pct")
    b = missing.select(F.lit("missing").alias("kind"), C("column").alias("name"), C("missing_pct").alias("pct"))
    return rounded(a.unionByName(b))


@query("write_features", f"WITH {si.LABELLED} SELECT row_id, valor, dias_no_pipeline, target_sucesso FROM labelled")
def _(spark, sf):
    root = scratch(spark)
    df = si.labelled(spark, sf).select("row_id", "valor", "dias_no_pipeline", "target_sucesso")
    writers.write_features(df, df, root, "target_sucesso")
    return spark.read.parquet(f"{root}/features").join(spark.read.parquet(f"{root}/target"), "row_id")


@query("write_splits", f"WITH {SPLIT} SELECT split, count(*) AS n FROM parts GROUP BY 1")
def _(spark, sf):
    path = scratch(spark) + "/splits"
    writers.write_splits(split_orders(spark, sf), path)
    return spark.read.parquet(path).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("write_insights", f"WITH {FEATURE_SQL}, k AS ({CORRS}), g AS ({GROUP_OF}) SELECT 'feature' AS kind, feature AS name, {r('correlation')} AS value FROM k "
       f"UNION ALL SELECT 'categoria', categoria, {r('avg(abs(correlation))')} FROM g JOIN k USING (feature) GROUP BY 2")
def _(spark, sf):
    root = scratch(spark)
    df = feats(spark, sf)
    writers.write_insights(target_correlations(df, "target_sucesso", FEATURES), group_importance(df, "target_sucesso", FEATURES), root)
    a = spark.read.parquet(f"{root}/feature_correlations").select(F.lit("feature").alias("kind"), C("feature").alias("name"), C("correlation").alias("value"))
    b = spark.read.parquet(f"{root}/category_importance").select(F.lit("categoria").alias("kind"), C("categoria").alias("name"), C("importancia_media").alias("value"))
    return rounded(a.unionByName(b))


@query("append_predictions", f"""WITH {si.LOG} SELECT "timestamp", candidate_id, prediction, {r('prediction_probability')} AS prediction_probability,
  '{{"valor":' || CAST(CAST(prediction_probability * 1000 AS BIGINT) AS VARCHAR) || ',"segmento":"' || segment || '"}}' AS features, coalesce(nullif(nullif(segment, 'view'), 'click'), 'default') AS segment FROM log""")
def _(spark, sf):
    path = scratch(spark) + "/log"
    log = si.prediction_log(spark, sf)
    packed = F.struct(F.rint(C("prediction_probability") * 1000).cast("bigint").alias("valor"), C("segment").alias("segmento"))
    segment = F.when(C("segment") == "view", F.lit("")).otherwise(F.nullif("segment", F.lit("click")))
    rows = writers.prediction_rows(log, C("timestamp"), C("candidate_id"), C("prediction"), C("prediction_probability"), packed, segment)
    writers.append_predictions(rows, path)
    return rounded(spark.read.parquet(path).drop("event_date"))


@query("append_metrics", f"WITH {si.HISTORY} SELECT \"timestamp\", metric, {r('value')} AS value FROM history")
def _(spark, sf):
    path = scratch(spark) + "/metrics"
    rows = si.metric_history(spark, sf)
    for name in ("accuracy", "precision", "volume"):
        writers.append_metrics(rows.where(C("metric") == name), path)
    return rounded(spark.read.parquet(path))


@query("read_class_report", f"WITH {si.SCORED}, c AS (SELECT {CELLS.format(t=0.05)} FROM scored) SELECT {r(PRE)} AS \"precision\", {r(REC)} AS recall, {r(F1)} AS f1_score, {r(ACC)} AS accuracy FROM c")
def _(spark, sf):
    report = classification_report(si.scored(spark, sf), "y", (C("score") >= 0.05).cast("int"))
    return rounded(readers.read_class_report(report))


# O ---------------------------------------------------------------------------------------------

MAX_TS = '(SELECT max("timestamp") FROM log)'


@query("recent", f"WITH {si.LOG} SELECT candidate_id, \"timestamp\" FROM log WHERE \"timestamp\" >= {MAX_TS} - INTERVAL 7 DAY")
def _(spark, sf):
    return dr.recent(si.prediction_log(spark, sf), 7).select("candidate_id", "timestamp")


@query("parse_features", f"WITH {si.LOG} SELECT candidate_id, try_cast(json_extract_string(CASE WHEN CAST(candidate_id AS BIGINT) % 10 = 0 THEN '{{}}' ELSE features END, '$.k') AS DOUBLE) AS k, NULL::VARCHAR AS absent FROM log")
def _(spark, sf):
    log = si.prediction_log(spark, sf)
    broken = F.when(C("candidate_id").cast("bigint") % 10 == 0, F.lit("{not json")).otherwise(C("features"))
    return dr.parse_features(log.withColumn("features", broken), ["k"], ["absent"]).select("candidate_id", "k", "absent")


def halves(spark, sf):
    """Training before and production from the middle of January, with the JSON feature as a column."""
    rows = dr.parse_features(si.prediction_log(spark, sf), ["k"]).withColumn("hora", F.date_format("timestamp", "HH"))
    cut = C("timestamp") < F.lit(si.SPLIT_TIME)
    return rows.where(cut), rows.where(~cut)


HALVES = si.LOG + f""",
rows AS (SELECT *, CAST(json_extract_string(features, '$.k') AS DOUBLE) AS k, strftime("timestamp", '%H') AS hora FROM log),
train AS (SELECT * FROM rows WHERE "timestamp" < {SPLIT_AT}), prod AS (SELECT * FROM rows WHERE "timestamp" >= {SPLIT_AT})"""
NUMERIC = ["prediction_probability", "k"]
CATEGORICAL = ["segment", "hora"]
DRIFT_FEATURES = NUMERIC + CATEGORICAL


def stats_sql(c, source):
    return (f"SELECT '{c}' AS feature, count({c}) AS n, {r(f'avg({c})')} AS mean, {r(f'median({c})')} AS median, {r(f'coalesce(stddev_samp({c}), 0.0)')} AS std, {r(f'min({c})')} AS \"min\", "
            f"{r(f'max({c})')} AS \"max\", {r(f'quantile_cont({c}, 0.25)')} AS q1, {r(f'quantile_cont({c}, 0.75)')} AS q3 FROM {source}")


@query("feature_stats", f"WITH {HALVES} " + " UNION ALL ".join(stats_sql(c, "train") for c in NUMERIC))
def _(spark, sf):
    return rounded(dr.feature_stats(halves(spark, sf)[0], DRIFT_FEATURES).numeric)


def shares_sql(source):
    one = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS value, count(*) AS n FROM {source} WHERE {c} IS NOT NULL GROUP BY 2" for c in CATEGORICAL)
    return f"SELECT feature, value, n, n / sum(n) OVER (PARTITION BY feature) AS share FROM ({one})"


@query("feature_distributions", f"WITH {HALVES} SELECT feature, value, n, {r('share')} AS share FROM ({shares_sql('train')})")
def _(spark, sf):
    return rounded(dr.feature_stats(halves(spark, sf)[0], DRIFT_FEATURES).categorical)


@query("categorical_summary", f"WITH {HALVES}, s AS ({shares_sql('train')}), k AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) AS rn FROM s) "
       "SELECT feature, count(*) AS n_unique, max(CASE WHEN rn = 1 THEN value END) AS most_common FROM k GROUP BY 1")
def _(spark, sf):
    return dr.feature_stats(halves(spark, sf)[0], DRIFT_FEATURES).categorical_summary


@query("training_stats_store", f"WITH {HALVES} SELECT feature, n FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, count({c}) AS n FROM train" for c in DRIFT_FEATURES) + ")")
def _(spark, sf):
    root = scratch(spark)
    writers.save_training_stats(dr.feature_stats(halves(spark, sf)[0], DRIFT_FEATURES, si.SPLIT_TIME), root)
    back = writers.load_training_stats(spark, root)
    counts = back.categorical.groupBy("feature").agg(F.sum("n").alias("n"))
    return back.numeric.select("feature", "n").unionByName(counts)


MOMENTS = "m AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, (SELECT avg({c}) FROM train) AS tm, (SELECT stddev_samp({c}) FROM train) AS ts, (SELECT avg({c}) FROM prod) AS pm, (SELECT stddev_samp({c}) FROM prod) AS ps" for c in NUMERIC) + ")"


@query("numeric_drift", f"WITH {HALVES}, {MOMENTS} SELECT feature, {r('tm')} AS train_mean, {r('ts')} AS train_std, {r('pm')} AS current_mean, {r('ps')} AS current_std, "
       f"{r('abs(tm - pm) / ts')} AS score, 2.0::DOUBLE AS drift_limit, CAST(abs(tm - pm) / ts > 2 AS INTEGER) AS drift_detected FROM m")
def _(spark, sf):
    train, prod = (dr.numeric_stats(x, NUMERIC, quartiles=False) for x in halves(spark, sf))
    out = dr.numeric_drift(train, prod)
    return rounded(out.withColumn("drift_detected", C("drift_detected").cast("int")))


JS = f"""tr AS ({shares_sql('train')}), pr AS ({shares_sql('prod')}),
pq AS (SELECT coalesce(tr.feature, pr.feature) AS feature, coalesce(tr.value, pr.value) AS value, coalesce(tr.share, 0.0) AS p0, coalesce(pr.share, 0.0) AS q0
  FROM tr FULL JOIN pr ON tr.feature = pr.feature AND tr.value = pr.value),
eps AS (SELECT *, least(1.0, greatest(1e-10, p0)) AS pe, least(1.0, greatest(1e-10, q0)) AS qe FROM pq),
un AS (SELECT *, pe / sum(pe) OVER (PARTITION BY feature) AS p, qe / sum(qe) OVER (PARTITION BY feature) AS q FROM eps),
js AS (SELECT feature, least(1.0, sum(p * ln(p / ((p + q) / 2)) + q * ln(q / ((p + q) / 2))) / 2) AS js,
  count(*) FILTER (WHERE p0 > 0) AS nt, count(*) FILTER (WHERE q0 > 0) AS nc, count(*) FILTER (WHERE q0 > 0 AND p0 = 0) AS nn FROM un GROUP BY 1)"""


def category_shares(spark, sf):
    return tuple(dr.distributions(x, CATEGORICAL) for x in halves(spark, sf))


@query("js_divergence", f"WITH {HALVES}, {JS} SELECT feature, {r('js')} AS js FROM js")
def _(spark, sf):
    from scorelake.operators.joins import align_distributions

    train, prod = category_shares(spark, sf)
    return rounded(dr.js_divergence(align_distributions(train, prod, ["feature", "value"], "share")))


@query("categorical_drift", f"WITH {HALVES}, {JS} SELECT feature, nt AS n_categories_train, nc AS n_categories_current, nn AS n_new_categories, {r('js')} AS score, 0.05::DOUBLE AS drift_limit, CAST(js > 0.05 AS INTEGER) AS drift_detected FROM js")
def _(spark, sf):
    out = dr.categorical_drift(*category_shares(spark, sf))
    return rounded(out.withColumn("drift_detected", C("drift_detected").cast("int")))


LETTER = "SELECT DISTINCT lower(substring(text, 1, 2)) AS value FROM documents WHERE lang = "


@query("new_categories", f"SELECT 'inicio' AS feature, value FROM ({LETTER} 'fr') WHERE value NOT IN ({LETTER} 'en')")
def _(spark, sf):
    docs = table(spark, sf, "documents").select("lang", F.lower(F.substring("text", 1, 2)).alias("inicio"))
    a, b = (dr.distributions(docs.where(C("lang") == x), ["inicio"]) for x in ("en", "fr"))
    return dr.new_categories(a, b)


DRIFT = f"""{HALVES}, {MOMENTS}, {JS}, drift AS (
  SELECT feature, 'numeric' AS type, abs(tm - pm) / ts AS score, 2.0::DOUBLE AS drift_limit, CAST(abs(tm - pm) / ts > 2 AS INTEGER) AS drift_detected FROM m
  UNION ALL SELECT feature, 'categorical', js, 0.05::DOUBLE, CAST(js > 0.05 AS INTEGER) FROM js)"""


def drift_rows(spark, sf):
    train, prod = halves(spark, sf)
    return dr.feature_drift(dr.feature_stats(train, DRIFT_FEATURES, quartiles=False), dr.feature_stats(prod, DRIFT_FEATURES, quartiles=False))


@query("feature_drift", f"WITH {DRIFT} SELECT feature, type, {r('score')} AS score, drift_limit, drift_detected FROM drift")
def _(spark, sf):
    out = drift_rows(spark, sf).select("feature", "type", "score", "drift_limit", C("drift_detected").cast("int").alias("drift_detected"))
    return rounded(out)


def moved(spark, sf):
    """A history with real drift: each day of orders against the rest, by priority and price band."""
    train = table(spark, sf, "orders").where(F.year("o_orderdate") < 1997)
    prod = table(spark, sf, "orders").where((F.year("o_orderdate") >= 1997) & (C("o_totalprice") > 450000))
    pick = ["o_totalprice", "o_orderpriority", "band"]
    band = F.when(C("o_totalprice") > 400000, "alto").when(C("o_totalprice") > 150000, "medio").otherwise("baixo")
    return train.withColumn("band", band), prod.withColumn("band", band), pick


@query("drift_report", f"""WITH base AS (SELECT *, CASE WHEN o_totalprice > 400000 THEN 'alto' WHEN o_totalprice > 150000 THEN 'medio' ELSE 'baixo' END AS band FROM orders),
  train AS (SELECT * FROM base WHERE year(o_orderdate) < 1997), prod AS (SELECT * FROM base WHERE year(o_orderdate) >= 1997 AND o_totalprice > 450000),
  b AS (SELECT band, count(*) / (SELECT count(*) FROM train) AS p FROM train GROUP BY 1), c AS (SELECT band, count(*) / (SELECT count(*) FROM prod) AS q FROM prod GROUP BY 1),
  bad AS (SELECT 'band' AS f)
  SELECT 'ok' AS status, {r('1 / 3')} AS drift_score, 1 AS drift_detected, (SELECT count(*) FROM prod) AS n_samples_analyzed, 3::BIGINT AS features_analyzed, 'band' AS features_with_drift,
    TIMESTAMP '2024-01-16' AS "timestamp" FROM bad WHERE (SELECT count(*) FROM b) = 3 AND (SELECT max(q) FROM c WHERE band = 'alto') = 1
    AND (SELECT abs(avg(o_totalprice) - (SELECT avg(o_totalprice) FROM prod)) / stddev_samp(o_totalprice) FROM train) <= 2""")
def _(spark, sf):
    train, prod, pick = moved(spark, sf)
    now = dr.feature_stats(prod, pick, quartiles=False)
    drift = dr.feature_drift(dr.feature_stats(train, pick, quartiles=False), now)
    out = dr.drift_report(drift, len(pick), now.n_samples, si.SPLIT_TIME)
    return rounded(out.select("timestamp", "status", "drift_score", C("drift_detected").cast("int").alias("drift_detected"), "n_samples_analyzed", "features_analyzed",
                              F.array_join("features_with_drift", "|").alias("features_with_drift")))


# One report per day: score = share of segments whose daily share lies more than 0.02 from one fifth.
REPORTS = si.LOG + """, seg AS (SELECT CAST(CAST("timestamp" AS DATE) AS TIMESTAMP) AS ts, segment, count(*) AS n FROM log GROUP BY 1, 2),
sh AS (SELECT ts, segment, n / sum(n) OVER (PARTITION BY ts) AS share FROM seg),
reports AS (SELECT ts AS "timestamp", count(*) FILTER (WHERE abs(share - 0.2) > 0.02) / 5 AS drift_score FROM sh GROUP BY 1)"""


def reports(spark, sf):
    log = si.prediction_log(spark, sf).withColumn("timestamp", F.to_date("timestamp").cast("timestamp_ntz"))
    shares = value_distribution(log, "segment", ["timestamp"])
    hit = F.abs(C("share") - 0.2) > 0.02
    return shares.groupBy("timestamp").agg(
        (F.count_if(hit) / 5).alias("drift_score"), F.array_compact(F.sort_array(F.collect_list(F.when(hit, C("value"))))).alias("features_with_drift"))


@query("append_drift_report", f"WITH {REPORTS} SELECT \"timestamp\", {r('drift_score')} AS overall_drift FROM reports")
def _(spark, sf):
    root = scratch(spark)
    writers.append_drift_report(reports(spark, sf), root)
    return rounded(spark.read.parquet(f"{root}/history"))


@query("latest_report", f"WITH {REPORTS} SELECT \"timestamp\", {r('drift_score')} AS drift_score FROM reports ORDER BY 1 DESC LIMIT 1")
def _(spark, sf):
    return rounded(dr.latest_report(reports(spark, sf)).select("timestamp", "drift_score"))


@query("drift_histogram", f"""WITH {HALVES}, e AS (SELECT min(prediction_probability) AS lo, (max(prediction_probability) - min(prediction_probability)) / 20 AS w FROM prod),
  b AS (SELECT least(20, CAST(floor((prediction_probability - lo) / w) AS BIGINT) + 1) AS bin, lo, w FROM prod, e),
  s AS (SELECT avg(prediction_probability) AS m, stddev_samp(prediction_probability) AS d FROM train)
  SELECT bin, count(*) AS n, {r('any_value(lo) + (bin - 1) * any_value(w)')} AS bin_low, {r('any_value(lo) + bin * any_value(w)')} AS bin_high,
    {r('any_value(m)')} AS train_mean, {r('any_value(m - d)')} AS minus_std, {r('any_value(m + d)')} AS plus_std FROM b, s GROUP BY bin""")
def _(spark, sf):
    train, prod = halves(spark, sf)
    return rounded(dr.drift_histogram(prod, "prediction_probability", dr.numeric_stats(train, NUMERIC, quartiles=False)))


@query("drift_category_table", f"WITH {HALVES}, {JS} SELECT value AS categoria, 'Treinamento' AS fonte, {r('p0')} AS distribuicao FROM pq WHERE feature = 'segment' UNION ALL SELECT value, 'Produção', {r('q0')} FROM pq WHERE feature = 'segment'")
def _(spark, sf):
    return rounded(dr.drift_category_table(*category_shares(spark, sf), "segment"))


@query("drift_band", f"WITH {REPORTS} SELECT \"timestamp\", CASE WHEN drift_score < 0.1 THEN 'stable' WHEN drift_score <= 0.3 THEN 'watch' ELSE 'significant' END AS band FROM reports")
def _(spark, sf):
    return reports(spark, sf).select("timestamp", dr.drift_band(C("drift_score")).alias("band"))


@query("metrics_window", f"WITH {si.HISTORY} SELECT \"timestamp\", metric, {r('value')} AS value FROM history WHERE \"timestamp\" >= (SELECT max(\"timestamp\") FROM history) - INTERVAL 5 DAY")
def _(spark, sf):
    return rounded(mon.metrics_window(si.metric_history(spark, sf), 5))


@query("metrics_wide", f"WITH {si.HISTORY} SELECT \"timestamp\", {r('accuracy')} AS accuracy, {r(chr(34) + 'precision' + chr(34))} AS \"precision\", {r('volume')} AS volume FROM days")
def _(spark, sf):
    return rounded(mon.metrics_wide(si.metric_history(spark, sf), ["accuracy", "precision", "volume"]))


@query("latest_metrics", f"WITH {si.HISTORY} SELECT \"timestamp\", metric, {r('value')} AS value FROM history WHERE \"timestamp\" = (SELECT max(\"timestamp\") FROM history)")
def _(spark, sf):
    return rounded(mon.latest_metrics(si.metric_history(spark, sf)))


@query("baseline_delta", f"""WITH {si.HISTORY}, cur AS (SELECT * FROM history WHERE "timestamp" = (SELECT max("timestamp") FROM history) AND metric <> 'volume'),
  base AS (SELECT * FROM history WHERE "timestamp" = (SELECT min("timestamp") FROM history) AND metric <> 'accuracy')
  SELECT coalesce(cur.metric, base.metric) AS metric, {r('coalesce(cur.value, 0.0) - coalesce(base.value, 0.0)')} AS delta FROM cur FULL JOIN base ON cur.metric = base.metric""")
def _(spark, sf):
    history = si.metric_history(spark, sf)
    first = history.agg(F.min("timestamp")).scalar()
    base = history.where((C("timestamp") == first) & (C("metric") != "accuracy")).select("metric", "value")
    current = mon.latest_metrics(history).where(C("metric") != "volume").select("metric", "value")
    return rounded(mon.baseline_delta(current, base))


@query("drift_alerts", f"WITH {REPORTS} SELECT \"timestamp\", 'drift' AS type, 'Drift detectado com score ' || format('{{:.2f}}', drift_score) AS message, {r('drift_score')} AS drift_score FROM reports WHERE drift_score > 0.3")
def _(spark, sf):
    out = mon.drift_alerts(reports(spark, sf))
    score = F.get_json_object("details", "$.drift_score").cast("double")
    return rounded(out.select("timestamp", "type", "message", score.alias("drift_score")))


DROPS = si.HISTORY + """, drops AS (SELECT "timestamp", accuracy, lag(accuracy) OVER (ORDER BY "timestamp") AS previous FROM days)"""


@query("metric_drops", f"WITH {DROPS} SELECT \"timestamp\", {r('previous')} AS previous, {r('accuracy')} AS \"current\", {r('previous - accuracy')} AS \"drop\" FROM drops WHERE previous IS NOT NULL")
def _(spark, sf):
    return rounded(mon.metric_drops(si.metric_history(spark, sf)))


@query("metric_drop_alerts", f"WITH {DROPS} SELECT \"timestamp\", 'accuracy' AS type, {r('previous - accuracy')} AS \"drop\" FROM drops WHERE previous - accuracy > 0.02")
def _(spark, sf):
    out = mon.metric_drop_alerts(si.metric_history(spark, sf), 0.02)
    return rounded(out.select("timestamp", "type", F.get_json_object("details", "$.drop").cast("double").alias("drop")))


def alerts(spark, sf):
    return mon.all_alerts(mon.drift_alerts(reports(spark, sf)), mon.metric_drop_alerts(si.metric_history(spark, sf), 0.02))


ALL_ALERTS = f"""WITH {DROPS}, {REPORTS[len(si.LOG) + 2:]},
alerts AS (SELECT "timestamp", 'drift' AS type FROM reports WHERE drift_score > 0.3 UNION ALL SELECT "timestamp", 'accuracy' FROM drops WHERE previous - accuracy > 0.02)"""


@query("all_alerts", ALL_ALERTS + ' SELECT "timestamp", type FROM alerts')
def _(spark, sf):
    return alerts(spark, sf).select("timestamp", "type")


@query("recent_alerts", ALL_ALERTS + ' SELECT "timestamp", type FROM alerts WHERE "timestamp" >= (SELECT max("timestamp") FROM alerts) - INTERVAL 7 DAY')
def _(spark, sf):
    return mon.recent_alerts(alerts(spark, sf), 7).select("timestamp", "type")


@query("service_alerts", f"""WITH s AS (SELECT avg(CAST(event_type = 'error' AS INTEGER)) * 100 AS e, avg(value / 1000) * 1000 AS l FROM events)
  SELECT 'error_rate' AS kind, {r('e')} AS value, 1.0::DOUBLE AS "limit" FROM s WHERE e > 1 UNION ALL SELECT 'latency', {r('l')}, 40.0::DOUBLE FROM s WHERE l > 40""")
def _(spark, sf):
    rollup = service_rollup(table(spark, sf, "events"), C("event_type") == "error", C("value") / 1000)
    return rounded(mon.service_alerts(rollup, latency_limit=40.0))


@query("prune_predictions", f"WITH {si.LOG} SELECT candidate_id FROM log WHERE \"timestamp\" >= {MAX_TS} - INTERVAL 10 DAY")
def _(spark, sf):
    return mon.prune_predictions(si.prediction_log(spark, sf), 10).select("candidate_id")


WINDOW = 259_200  # three days, so that users of the sparse request log run into their limits
LIMITS = {"purchase": 4, "view": 2}
LIMIT_SQL = f"""WITH RECURSIVE req AS (SELECT event_id, user_id, epoch_us(ts) AS t, CASE event_type WHEN 'purchase' THEN 4 WHEN 'view' THEN 2 ELSE 10 END AS lim,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
  walk AS (SELECT *, t AS start, 1 AS pos FROM req WHERE rn = 1 UNION ALL
    SELECT r.*, CASE WHEN r.t - w.start > {WINDOW}000000 THEN r.t ELSE w.start END, CASE WHEN r.t - w.start > {WINDOW}000000 THEN 1 ELSE w.pos + 1 END
    FROM walk w JOIN req r ON r.user_id = w.user_id AND r.rn = w.rn + 1)
  SELECT event_id, user_id, make_timestamp(start) AS window_start, CAST(pos AS BIGINT) AS position, CAST(pos <= lim AS INTEGER) AS allowed FROM walk"""


@query("fixed_window_limit", LIMIT_SQL)
def _(spark, sf):
    out = mon.fixed_window_limit(table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type"), "user_id", "ts",
                                 mon.role_limit(C("event_type"), LIMITS), "event_id", WINDOW)
    return out.select("event_id", "user_id", "window_start", "position", C("allowed").cast("int").alias("allowed"))


# S ---------------------------------------------------------------------------------------------


def replay(spark, sf, root, parts=1):
    """The log as a file stream: written once as Parquet files, then read as a stream."""
    path = f"{root}/source"
    log = si.prediction_log(spark, sf)
    log.repartitionByRange(parts, "timestamp").write.parquet(path)
    return jobs.read_log_stream(spark, path, log.schema)


@query("stream_prediction_log", f"WITH {si.LOG} SELECT candidate_id, \"timestamp\", segment FROM log")
def _(spark, sf):
    root = scratch(spark)
    path = f"{root}/source"
    log = si.prediction_log(spark, sf)
    log.write.parquet(path)
    log.where(C("segment") == "view").write.mode("append").parquet(path)  # repeats to drop
    stream = jobs.read_log_stream(spark, path, log.schema)
    done = jobs.stream_prediction_log(stream, f"{root}/log", f"{root}/checkpoint", delay="40 days").trigger(availableNow=True).start()
    done.awaitTermination()
    return spark.read.parquet(f"{root}/log").select("candidate_id", "timestamp", "segment")


@query("stream_daily_rollup", f"""WITH {si.LOG} SELECT CAST("timestamp" AS DATE) AS date, segment, count(prediction) AS quantidade, {r('avg(prediction) * 100')} AS taxa_aprovacao,
  {r('avg(prediction_probability) * 100')} AS prob_media FROM log GROUP BY 1, 2""")
def _(spark, sf):
    root = scratch(spark)
    rows = jobs.stream_daily_rollup(replay(spark, sf, root))

    def keep(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{root}/out")

    rows.writeStream.outputMode("complete").option("checkpointLocation", f"{root}/checkpoint").foreachBatch(keep).trigger(
        availableNow=True).start().awaitTermination()
    return rounded(spark.read.parquet(f"{root}/out"))


@query("stream_recent_drift")
def _(spark, sf):
    root = scratch(spark)
    training = dr.feature_stats(halves(spark, sf)[0], DRIFT_FEATURES[:3], quartiles=False)
    log = si.prediction_log(spark, sf).withColumn("features", F.to_json(F.struct(
        F.get_json_object("features", "$.k").alias("k"), C("prediction_probability"), C("segment"))))
    log.repartitionByRange(2, "timestamp").write.parquet(f"{root}/source")
    stream = jobs.read_log_stream(spark, f"{root}/source", log.schema, max_files=1)
    jobs.stream_recent_drift(stream, f"{root}/log", training, f"{root}/reports", f"{root}/alerts", f"{root}/checkpoint").trigger(
        availableNow=True).start().awaitTermination()
    out = spark.read.parquet(f"{root}/reports/*/reports")
    return rounded(out.select("batch_id", "timestamp", "drift_score", "n_samples_analyzed", "features_analyzed"))


@query("stream_alerts", f"WITH {DROPS} SELECT \"timestamp\", 'accuracy' AS type, {r('previous - accuracy')} AS \"drop\" FROM drops WHERE previous - accuracy > 0.02")
def _(spark, sf):
    root = scratch(spark)
    history = si.metric_history(spark, sf).persist()
    marks = [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 11), dt.datetime(2024, 1, 21), dt.datetime(2100, 1, 1)]
    try:
        for a, b in zip(marks, marks[1:]):
            part = history.where((C("timestamp") >= a) & (C("timestamp") < b))
            part.coalesce(1).write.mode("append").parquet(f"{root}/source")
            stream = jobs.read_log_stream(spark, f"{root}/source", history.schema)
            jobs.stream_alerts(stream, f"{root}/history", f"{root}/alerts", f"{root}/checkpoint", 0.02).trigger(availableNow=True).start().awaitTermination()
    finally:
        history.unpersist()
    out = spark.read.parquet(f"{root}/alerts")
    return rounded(out.select("timestamp", "type", F.get_json_object("details", "$.drop").cast("double").alias("drop")))


@query("stream_fixed_window_limit", LIMIT_SQL)
def _(spark, sf):
    root = scratch(spark)
    source = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    source.coalesce(1).write.parquet(f"{root}/source")
    stream = jobs.read_log_stream(spark, f"{root}/source", source.schema)
    for key, value in jobs.ROCKSDB.items():
        spark.conf.set(key, value)
    rows = jobs.stream_fixed_window_limit(stream, "user_id", "ts", "event_id", C("event_type"), LIMITS, WINDOW)
    rows.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint").trigger(
        availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/out").select(
        C("id").alias("event_id"), C("key").alias("user_id"), F.timestamp_micros("window_start").cast("timestamp_ntz").alias("window_start"),
        "position", C("allowed").cast("int").alias("allowed"))


@query("check_drift", f"WITH {DRIFT} SELECT feature, type, {r('score')} AS score, drift_limit, drift_detected FROM drift WHERE feature IN ('k', 'prediction_probability', 'segment')")
def _(spark, sf):
    train, _ = halves(spark, sf)
    training = dr.feature_stats(train, DRIFT_FEATURES[:3], quartiles=False)
    log = si.prediction_log(spark, sf).withColumn("features", F.to_json(F.struct(
        F.get_json_object("features", "$.k").alias("k"), C("prediction_probability"), C("segment"))))
    newer = log.where(C("timestamp") >= F.lit(si.SPLIT_TIME))
    drift, _ = check_drift(newer.drop("prediction_probability", "segment"), training)
    return rounded(drift.select("feature", "type", "score", "drift_limit", C("drift_detected").cast("int").alias("drift_detected")))
