"""Queries of joins (F), aggregates (G), profile (H), insight (I) and leakage (J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorelake.functions import text, vocab
from scorelake.operators import aggregates as agg
from scorelake.operators import insight, joins, leakage, profile
from scorelake.plans import stand_ins as si
from scorelake.plans.features import prospect_features
from scorelake.plans.registry import query, quote, r, rounded, table

C = F.col
NUMS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

# F ---------------------------------------------------------------------------------------------


@query("join_jobs", f"WITH {si.PROSPECTS} SELECT row_id, job_id, p_name AS titulo, p_type AS area_vaga, p_size AS tamanho FROM prospects LEFT JOIN part ON p_partkey IS NOT DISTINCT FROM job_id")
def _(spark, sf):
    return joins.join_jobs(si.prospects(spark, sf), si.jobs(spark, sf)).select("row_id", "job_id", "titulo", "area_vaga", "tamanho")


@query("join_applicants", f"WITH {si.PROSPECTS} SELECT row_id, applicant_id, c_mktsegment AS segmento, c_acctbal AS saldo FROM prospects LEFT JOIN customer ON c_custkey IS NOT DISTINCT FROM applicant_id")
def _(spark, sf):
    return joins.join_applicants(si.prospects(spark, sf), si.applicants(spark, sf)).select("row_id", "applicant_id", "segmento", "saldo")


@query("join_suffixes", """SELECT a.event_id AS row_id, a.user_id, a.value AS value_x, b.value AS value_y FROM events a LEFT JOIN (
  SELECT user_id, max(value) AS value FROM events WHERE event_type = 'purchase' GROUP BY user_id) b ON a.user_id IS NOT DISTINCT FROM b.user_id""")
def _(spark, sf):
    events = table(spark, sf, "events")
    best = events.where(C("event_type") == "purchase").groupBy("user_id").agg(F.max("value").alias("value"))
    left = events.select(C("event_id").alias("row_id"), "user_id", "value")
    return joins.left_join(left, best, "user_id")


@query("attach_group_stats", f"""WITH {si.LABELLED}, g AS (SELECT recrutador, avg(target_sucesso) AS taxa, count(*) AS n FROM labelled WHERE recrutador IS NOT NULL GROUP BY 1)
  SELECT row_id, recrutador, {r('taxa')} AS taxa, n FROM labelled LEFT JOIN g USING (recrutador)""")
def _(spark, sf):
    out = joins.attach_group_stats(si.labelled(spark, sf), "recrutador", {"taxa": F.avg("target_sucesso"), "n": F.count(F.lit(1))})
    return rounded(out.select("row_id", "recrutador", "taxa", "n"))


@query("attach_group_stats_fitted", f"""WITH {si.LABELLED}, g AS (SELECT tipo_contratacao, avg(target_sucesso) AS taxa FROM labelled
  WHERE year(data_candidatura) < 1997 GROUP BY 1) SELECT row_id, tipo_contratacao, {r('taxa')} AS taxa FROM labelled LEFT JOIN g USING (tipo_contratacao)""")
def _(spark, sf):
    df = si.labelled(spark, sf)
    early = df.where(F.year("data_candidatura") < 1997)
    out = joins.attach_group_stats(df, "tipo_contratacao", {"taxa": F.avg("target_sucesso")}, early)
    return rounded(out.select("row_id", "tipo_contratacao", "taxa"))


@query("attach_target", "SELECT d.doc_id AS row_id, n_chars, quality FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def _(spark, sf):
    docs = table(spark, sf, "documents").select(C("doc_id").alias("row_id"), "n_chars")
    return joins.attach_target(docs, table(spark, sf, "labels").select(C("doc_id").alias("row_id"), "quality"))


def dist_sql(where):
    return f"SELECT source AS value, count(*) / sum(count(*)) OVER () AS share FROM documents WHERE {where} GROUP BY source"


@query("align_distributions", f"""SELECT coalesce(a.value, b.value) AS value, {r('coalesce(a.share, 0.0)')} AS p, {r('coalesce(b.share, 0.0)')} AS q
  FROM ({dist_sql("lang = 'en'")}) a FULL JOIN ({dist_sql("lang = 'de'")}) b ON a.value = b.value""")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    a, b = (agg.value_distribution(docs.where(C("lang") == x), "source") for x in ("en", "de"))
    return rounded(joins.align_distributions(a, b, ["value"], "share"))


@query("compare_maps", f"""WITH a AS (SELECT source AS metric, avg(n_chars) AS value FROM documents WHERE lang = 'en' GROUP BY 1),
  b AS (SELECT source AS metric, avg(n_chars) AS value FROM documents WHERE lang = 'de' GROUP BY 1)
  SELECT coalesce(a.metric, b.metric) AS metric, {r('coalesce(a.value, 0.0)', 4)} AS "current", {r('coalesce(b.value, 0.0)', 4)} AS baseline,
    {r('coalesce(a.value, 0.0) - coalesce(b.value, 0.0)', 4)} AS delta FROM a FULL JOIN b ON a.metric = b.metric""")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    a, b = (docs.where(C("lang") == x).groupBy(C("source").alias("metric")).agg(F.avg("n_chars").alias("value")) for x in ("en", "de"))
    return rounded(joins.compare_metrics(a, b), 4)


# G ---------------------------------------------------------------------------------------------


@query("group_success_rate", f"WITH {si.LABELLED} SELECT recrutador, {r('avg(target_sucesso)')} AS taxa_sucesso_recrutador, count(*) AS total_candidatos_recrutador FROM labelled WHERE recrutador IS NOT NULL GROUP BY 1")
def _(spark, sf):
    return rounded(agg.group_success_rate(si.labelled(spark, sf)))


@query("above_mean_flag", f"WITH {si.LABELLED} SELECT row_id, CAST(dias_no_pipeline > (SELECT avg(dias_no_pipeline) FROM labelled) AS INTEGER) AS tempo_acima_media FROM labelled")
def _(spark, sf):
    return agg.above_mean_flag(si.labelled(spark, sf), "dias_no_pipeline", "tempo_acima_media").select("row_id", "tempo_acima_media")


@query("category_popularity", f"WITH {si.LABELLED_JOBS}, g AS (SELECT area_vaga, count(*) AS popularidade_area FROM labelled_jobs WHERE area_vaga IS NOT NULL GROUP BY 1) SELECT row_id, popularidade_area FROM labelled_jobs LEFT JOIN g USING (area_vaga)")
def _(spark, sf):
    out = joins.attach_group_stats(si.labelled_jobs(spark, sf), "area_vaga", {"popularidade_area": F.count(F.lit(1))})
    return out.select("row_id", "popularidade_area")


@query("category_rate", f"WITH {si.LABELLED_JOBS}, g AS (SELECT tipo_contratacao, avg(target_sucesso) AS taxa FROM labelled_jobs GROUP BY 1) SELECT row_id, {r('taxa')} AS taxa_sucesso_contratacao FROM labelled_jobs LEFT JOIN g USING (tipo_contratacao)")
def _(spark, sf):
    out = joins.attach_group_stats(si.labelled(spark, sf), "tipo_contratacao", {"taxa_sucesso_contratacao": F.avg("target_sucesso")})
    return rounded(out.select("row_id", "taxa_sucesso_contratacao"))


@query("category_mean_duration", f"WITH {si.LABELLED_JOBS} SELECT area_vaga, count(*) AS popularidade, {r('avg(target_sucesso)')} AS taxa_sucesso, {r('avg(dias_no_pipeline)')} AS tempo_medio FROM labelled_jobs WHERE area_vaga IS NOT NULL GROUP BY 1")
def _(spark, sf):
    return rounded(agg.category_stats(si.labelled_jobs(spark, sf), "area_vaga", "target_sucesso", "dias_no_pipeline"))


@query("group_flag_rate", f"WITH g AS (SELECT role, avg(CAST(contains(lower(text), 'the') AS INTEGER)) AS rate FROM conversations GROUP BY 1) SELECT conv_id, turn, {r('rate')} AS rate FROM conversations JOIN g USING (role)")
def _(spark, sf):
    df = table(spark, sf, "conversations").withColumn("flag", text.contains_any(F.lower("text"), ["the"]))
    return rounded(agg.group_flag_rate(df, "role", "flag", "rate").select("conv_id", "turn", "rate"))


@query("value_distribution", f"SELECT source AS value, count(*) AS n, {r('count(*) / sum(count(*)) OVER ()')} AS share FROM documents GROUP BY 1")
def _(spark, sf):
    return rounded(agg.value_distribution(table(spark, sf, "documents"), "source"))


@query("value_distribution_by", f"SELECT lang, source AS value, count(*) AS n, {r('count(*) / sum(count(*)) OVER (PARTITION BY lang)')} AS share FROM documents GROUP BY 1, 2")
def _(spark, sf):
    return rounded(agg.value_distribution(table(spark, sf, "documents"), "source", ["lang"]))


ROLL = f"count(prediction) AS quantidade, {r('avg(prediction) * 100')} AS taxa_aprovacao, {r('avg(prediction_probability) * 100')} AS prob_media"


@query("segment_rollup", f"WITH {si.LOG} SELECT segment, {ROLL} FROM log WHERE segment IS NOT NULL GROUP BY 1")
def _(spark, sf):
    return rounded(agg.segment_rollup(si.prediction_log(spark, sf)))


@query("daily_rollup", f"WITH {si.LOG} SELECT CAST(\"timestamp\" AS DATE) AS date, {ROLL} FROM log GROUP BY 1")
def _(spark, sf):
    return rounded(agg.daily_rollup(si.prediction_log(spark, sf)))


@query("prediction_summary", f"""WITH {si.LOG} SELECT count(*) AS "count", min("timestamp") AS "start", max("timestamp") AS "end",
  {r('avg(CAST(prediction = 1 AS INTEGER)) * 100')} AS positive_rate, {r('avg(CAST(prediction = 0 AS INTEGER)) * 100')} AS negative_rate,
  {r('avg(prediction_probability)')} AS average_probability FROM log""")
def _(spark, sf):
    return rounded(agg.prediction_summary(si.prediction_log(spark, sf)))


@query("segment_counts", f"WITH {si.LOG} SELECT segment, count(*) AS n FROM log WHERE segment IS NOT NULL GROUP BY 1")
def _(spark, sf):
    return agg.segment_counts(si.prediction_log(spark, sf))


@query("approval_kpis", f"WITH {si.LOG} SELECT count(*) AS total, {r('avg(CAST(prediction = 1 AS INTEGER)) * 100')} AS taxa_aprovacao, {r('avg(prediction_probability) * 100')} AS prob_media FROM log")
def _(spark, sf):
    return rounded(agg.approval_kpis(si.prediction_log(spark, sf)))


@query("outcome_counts", f"WITH {si.LOG} SELECT CASE WHEN prediction = 1 THEN 'Aprovado' ELSE 'Reprovado' END AS resultado, count(*) AS n FROM log GROUP BY 1")
def _(spark, sf):
    return agg.outcome_counts(si.prediction_log(spark, sf))


def flat(df):
    """Some constant columns beside the real ones."""
    return df.withColumns({"one": F.lit(1), "none": F.lit(None).cast("int"), "sometimes": F.when(C("l_quantity") > 25, 7)})


ZERO = {c: f"count(DISTINCT {c}) <= 1" for c in ["l_quantity", "l_discount", "l_returnflag"]} | {
    "one": "true", "none": "true", "sometimes": "true"}


@query("zero_variance_columns", " UNION ALL ".join(f"SELECT {quote(c)} AS \"column\", CAST({e} AS INTEGER) AS zero_variance FROM lineitem" for c, e in ZERO.items()
                                                    if e != "true") + "".join(f" UNION ALL SELECT {quote(c)}, 1" for c, e in ZERO.items() if e == "true"))
def _(spark, sf):
    out = agg.zero_variance_table(flat(table(spark, sf, "lineitem")), list(ZERO))
    return out.withColumn("zero_variance", C("zero_variance").cast("int"))


@query("service_rollup", f"SELECT count(*) AS request_count, {r("avg(CAST(event_type = 'error' AS INTEGER)) * 100")} AS error_rate, {r('avg(value / 1000) * 1000')} AS average_latency FROM events")
def _(spark, sf):
    return rounded(agg.service_rollup(table(spark, sf, "events"), C("event_type") == "error", C("value") / 1000))


# H ---------------------------------------------------------------------------------------------

# A table with gaps: lines joined to the few orders in a price band.
GAPS = """gaps AS (SELECT l_quantity, nullif(l_returnflag, 'A') AS l_returnflag, CASE WHEN l_discount > 0.05 THEN l_tax END AS l_tax,
  nullif(nullif(l_linestatus, 'O'), 'x') AS l_linestatus FROM lineitem)"""


def gaps(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_quantity", F.nullif("l_returnflag", F.lit("A")).alias("l_returnflag"),
        F.when(C("l_discount") > 0.05, C("l_tax")).alias("l_tax"), F.nullif("l_linestatus", F.lit("O")).alias("l_linestatus"))


GAP_COLUMNS = ["l_quantity", "l_returnflag", "l_tax", "l_linestatus"]


@query("missing_profile", f"WITH {GAPS} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing, {r(f'(count(*) - count({c})) * 100.0 / count(*)')} AS missing_pct FROM gaps" for c in GAP_COLUMNS))
def _(spark, sf):
    return rounded(profile.missing_profile(gaps(spark, sf)))


@query("duplicate_rows", f"WITH {GAPS} SELECT CAST((SELECT count(*) FROM gaps) - (SELECT count(*) FROM (SELECT DISTINCT * FROM gaps)) AS BIGINT) AS duplicates")
def _(spark, sf):
    return profile.duplicate_rows(gaps(spark, sf))


def iqr_sql(c, source):
    return (f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS outliers, "
            f"{r(f'count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) * 100.0 / count(*)')} AS outlier_pct FROM {source}, "
            f"(SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {source})")


SKEWED = "skewed AS (SELECT l_quantity * l_quantity * l_discount AS a, l_extendedprice * l_tax AS b, l_quantity FROM lineitem)"


@query("iqr_outliers", f"WITH {SKEWED} " + " UNION ALL ".join(iqr_sql(c, "skewed") for c in ("a", "b", "l_quantity")))
def _(spark, sf):
    df = si.numbers(spark, sf).select(
        (C("l_quantity") * C("l_quantity") * C("l_discount")).alias("a"), (C("l_extendedprice") * C("l_tax")).alias("b"), "l_quantity")
    return rounded(profile.iqr_outliers(df))


@query("class_balance", f"""WITH c AS (SELECT quality, count(*) AS n FROM labels WHERE quality IS NOT NULL GROUP BY 1) SELECT quality, n,
  {r('n * 100.0 / (SELECT sum(n) FROM c)')} AS pct, {r('(SELECT max(n) / min(n) FROM c)')} AS ratio,
  CAST((SELECT max(n) / min(n) FROM c) > 10 AS INTEGER) AS extreme FROM c""")
def _(spark, sf):
    out = profile.class_balance(table(spark, sf, "labels"), "quality")
    return rounded(out.withColumn("extreme", C("extreme").cast("int")))


@query("flag_rate", f"SELECT {r('avg(toxic) * 100')} AS rate FROM labels")
def _(spark, sf):
    return rounded(profile.flag_rate(table(spark, sf, "labels"), "toxic"))


LOWVAR = """lowvar AS (SELECT CAST(l_quantity >= 50 AS INTEGER) AS big, CAST(l_discount > 0.2 AS INTEGER) AS deal, l_returnflag, l_quantity,
  CASE WHEN l_tax > 0.07 THEN 'x' WHEN l_tax < 0.01 THEN NULL ELSE 'y' END AS band FROM lineitem)"""


@query("low_variance", f"WITH {LOWVAR}, v AS (" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM lowvar" for c in ("big", "deal", "l_returnflag", "l_quantity", "band")) +
       f"""), c AS (SELECT "column", value, count(*) AS n FROM v WHERE value IS NOT NULL GROUP BY 1, 2)
  SELECT "column", {r('max(n) * 100.0 / sum(n)')} AS top_pct FROM c GROUP BY 1 HAVING count(*) <= 5 AND max(n) / sum(n) > 0.95 ORDER BY 2 DESC, 1 LIMIT 5""")
def _(spark, sf):
    df = table(spark, sf, "lineitem").select(
        (C("l_quantity") >= 50).cast("int").alias("big"), (C("l_discount") > 0.2).cast("int").alias("deal"), "l_returnflag", "l_quantity",
        F.when(C("l_tax") > 0.07, "x").when(C("l_tax") < 0.01, None).otherwise("y").alias("band"))
    return rounded(profile.low_variance(df))


def describe_sql(c, source):
    return (f"SELECT '{c}' AS \"column\", count({c}) AS \"count\", {r(f'avg({c})', 4)} AS mean, {r(f'stddev_samp({c})', 4)} AS std, {r(f'min({c})', 4)} AS \"min\", "
            f"{r(f'quantile_cont({c}, 0.25)', 4)} AS q1, {r(f'quantile_cont({c}, 0.5)', 4)} AS median, {r(f'quantile_cont({c}, 0.75)', 4)} AS q3, {r(f'max({c})', 4)} AS \"max\" FROM {source}")


@query("describe_numeric", " UNION ALL ".join(describe_sql(c, "lineitem") for c in NUMS))
def _(spark, sf):
    return rounded(profile.describe_numeric(si.numbers(spark, sf)), 4)


@query("describe_categorical", "WITH v AS (SELECT 'lang' AS \"column\", lang AS value FROM documents UNION ALL SELECT 'source', source FROM documents UNION ALL SELECT 'doc', CAST(doc_id AS VARCHAR) FROM documents), "
       "c AS (SELECT \"column\", value, count(*) AS n FROM v GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY \"column\" ORDER BY n DESC, value) AS rn FROM c) "
       "SELECT \"column\", CAST(sum(n) AS BIGINT) AS \"count\", count(*) AS \"unique\", max(CASE WHEN rn = 1 THEN value END) AS top, max(n) AS freq FROM k GROUP BY 1")
def _(spark, sf):
    df = table(spark, sf, "documents").select("lang", "source", C("doc_id").cast("string").alias("doc"))
    return profile.describe_categorical(df)


@query("correlation_matrix", " UNION ALL ".join(f"SELECT '{a}' AS \"first\", '{b}' AS second, {r(f'corr({a}, {b})')} AS r FROM lineitem" for a in NUMS for b in NUMS))
def _(spark, sf):
    return rounded(profile.correlation_matrix(si.numbers(spark, sf)))


LINKED = "linked AS (SELECT l_quantity, l_extendedprice, l_quantity * 2 + l_tax AS twice, l_extendedprice / l_quantity AS price FROM lineitem)"
LINKED_NAMES = ["l_quantity", "l_extendedprice", "twice", "price"]


def linked(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_quantity", "l_extendedprice", (C("l_quantity") * 2 + C("l_tax")).alias("twice"), (C("l_extendedprice") / C("l_quantity")).alias("price"))


@query("strong_pairs", f"WITH {LINKED}, p AS (" + " UNION ALL ".join(
    f"SELECT '{a}' AS \"first\", '{b}' AS second, corr({a}, {b}) AS r FROM linked" for a, b in profile.upper_pairs(LINKED_NAMES)) + f") SELECT \"first\", second, {r('r')} AS r FROM p WHERE abs(r) > 0.5")
def _(spark, sf):
    return rounded(profile.strong_pairs(linked(spark, sf)))


@query("completeness", f"""WITH v AS (SELECT props, nullif(event_type, 'view') AS event_type, CASE WHEN event_id % 4 = 0 THEN '' WHEN event_id % 4 = 1 THEN '{{}}' ELSE 'x' END AS extra FROM events) """ +
       " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {r(f'count(*) FILTER (WHERE {c} NOT IN (' + quote('') + ', ' + quote('{}') + ')) * 100.0 / count(*)')} AS completeness_pct FROM v" for c in ("props", "event_type", "extra")))
def _(spark, sf):
    df = table(spark, sf, "events").select(
        "props", F.nullif("event_type", F.lit("view")).alias("event_type"),
        F.when(C("event_id") % 4 == 0, "").when(C("event_id") % 4 == 1, "{}").otherwise("x").alias("extra"))
    return rounded(profile.completeness(df))


KINDS = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string", "value": "double", "props": "string"}


@query("column_types", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", '{k}' AS type, count({c}) AS non_null FROM events" for c, k in KINDS.items()))
def _(spark, sf):
    return profile.column_types(table(spark, sf, "events"))


# I ---------------------------------------------------------------------------------------------

FEATURES = ["dias_no_pipeline", "mes_candidatura", "valor", "tamanho_vaga", "preco_area", "urgente_engajamento", "constante_tempo"]
FEATURE_SQL = si.LABELLED_JOBS + """,
feats AS (SELECT row_id, dias_no_pipeline, CAST(month(data_candidatura) AS INTEGER) AS mes_candidatura, valor, tamanho AS tamanho_vaga,
  preco AS preco_area, CAST(tipo_contratacao = '1-URGENT' AS INTEGER) AS urgente_engajamento, 3 AS constante_tempo,
  CAST(dias_no_pipeline = 0 AS INTEGER) AS menciona_desistencia, CAST(valor > 400000 AS INTEGER) AS menciona_outra_proposta, 1 AS recusou,
  target_sucesso FROM labelled_jobs)"""


def feats(spark, sf):
    return si.labelled_jobs(spark, sf).select(
        "row_id", "dias_no_pipeline", F.month("data_candidatura").alias("mes_candidatura"), "valor", C("tamanho").alias("tamanho_vaga"),
        C("preco").alias("preco_area"), (C("tipo_contratacao") == "1-URGENT").cast("int").alias("urgente_engajamento"), F.lit(3).alias("constante_tempo"),
        (C("dias_no_pipeline") == 0).cast("int").alias("menciona_desistencia"), (C("valor") > 400000).cast("int").alias("menciona_outra_proposta"),
        F.lit(1).alias("recusou"), "target_sucesso")


def safe_corr(a, b):
    return f"CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE corr({a}, {b}) END"


CORRS = " UNION ALL ".join(f"SELECT '{c}' AS feature, {safe_corr(c, 'target_sucesso')} AS correlation FROM feats" for c in FEATURES)


@query("target_correlations", f"WITH {FEATURE_SQL}, k AS ({CORRS}) SELECT feature, {r('correlation')} AS correlation FROM k ORDER BY abs(correlation) DESC NULLS LAST, feature LIMIT 5")
def _(spark, sf):
    return rounded(insight.target_correlations(feats(spark, sf), "target_sucesso", FEATURES, 5))


GROUP_OF = " UNION ALL ".join(f"SELECT {quote(g)} AS categoria, {quote(f)} AS feature" for g, terms in vocab.INSIGHT_GROUPS.items() for f in FEATURES if any(t in f for t in terms))


@query("feature_groups", f"WITH {FEATURE_SQL}, k AS ({CORRS}), g AS ({GROUP_OF}) SELECT categoria, feature, {r('correlation')} AS correlation FROM g JOIN k USING (feature)")
def _(spark, sf):
    members = insight.feature_groups(FEATURES)
    tags = F.array_compact(F.array(*[F.when(C("feature").isin(m), F.lit(g)) for g, m in members.items() if m]))
    rows = insight.target_correlations(feats(spark, sf), "target_sucesso", FEATURES)
    return rounded(rows.select(F.explode(tags).alias("categoria"), "feature", "correlation"))


@query("group_importance", f"WITH {FEATURE_SQL}, k AS ({CORRS}), g AS ({GROUP_OF}) SELECT categoria, count(*) AS features, {r('avg(abs(correlation))')} AS importancia_media FROM g JOIN k USING (feature) GROUP BY 1")
def _(spark, sf):
    return rounded(insight.group_importance(feats(spark, sf), "target_sucesso", FEATURES))


FLAGS = ["urgente_engajamento", "menciona_desistencia", "menciona_outra_proposta", "recusou"]


def rates_sql(c, fill=""):
    one, zero = (f"avg(CASE WHEN {c} = {v} THEN target_sucesso END) * 100" for v in (1, 0))
    if fill:
        one, zero = f"coalesce({one}, {fill})", f"coalesce({zero}, {fill})"
    return f"SELECT '{c}' AS feature, {r(one)} AS rate_when_1, {r(zero)} AS rate_when_0 FROM feats"


@query("flag_success_rates", f"WITH {FEATURE_SQL} " + " UNION ALL ".join(rates_sql(c) for c in FLAGS))
def _(spark, sf):
    return rounded(insight.flag_success_rates(feats(spark, sf), FLAGS, "target_sucesso"))


@query("attrition_rates", f"WITH {FEATURE_SQL} " + " UNION ALL ".join(rates_sql(c, "0.0") for c in FLAGS[1:]))
def _(spark, sf):
    return rounded(insight.attrition_rates(feats(spark, sf), "target_sucesso"))


@query("lift", f"WITH {FEATURE_SQL} " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {r(f'CASE WHEN count(*) FILTER (WHERE {c} = 0) > 0 THEN avg(CASE WHEN {c} = 1 THEN target_sucesso END) / avg(target_sucesso) END')} AS lift FROM feats" for c in FLAGS))
def _(spark, sf):
    return rounded(insight.lift(feats(spark, sf), FLAGS, "target_sucesso"))


@query("category_distribution", f"WITH {si.LABELLED} SELECT categoria_situacao, count(*) AS n, {r('count(*) * 100.0 / (SELECT count(*) FROM labelled)')} AS pct FROM labelled GROUP BY 1")
def _(spark, sf):
    return rounded(insight.category_distribution(si.labelled(spark, sf), "categoria_situacao"))


@query("top_k_per_category", f"""WITH c AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY 1, 2),
  k AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, source) AS position, sum(n) OVER (PARTITION BY lang) AS total FROM c)
  SELECT lang, source, n, {r('n * 100.0 / total')} AS pct, CAST(position AS INTEGER) AS position FROM k WHERE position <= 5""")
def _(spark, sf):
    return rounded(insight.top_k_per_category(table(spark, sf, "documents"), "lang", "source"))


# J ---------------------------------------------------------------------------------------------

LEAKY = si.LABELLED_JOBS + """,
leaky AS (SELECT target_sucesso, situacao, tipo_contratacao, area_vaga, valor, tamanho, target_sucesso * 100 + tamanho * 0.01 AS nota,
  CASE WHEN target_sucesso = 1 AND tamanho > 25 THEN 1 ELSE 2 END AS etapa, dias_no_pipeline AS data_resultado FROM labelled_jobs)"""


def leaky(spark, sf):
    y = C("target_sucesso")
    return si.labelled_jobs(spark, sf).select(
        "target_sucesso", "situacao", "tipo_contratacao", "area_vaga", "valor", "tamanho", (y * 100 + C("tamanho") * 0.01).alias("nota"),
        F.when((y == 1) & (C("tamanho") > 25), 1).otherwise(2).alias("etapa"), C("dias_no_pipeline").alias("data_resultado"))


NAMES = ["situacao", "tipo_contratacao", "area_vaga", "valor", "tamanho", "nota", "etapa", "data_resultado"]
TEXTS = ["situacao", "tipo_contratacao", "area_vaga"]
PURE = "long AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS category, target_sucesso AS y, {'true' if c in TEXTS else f'(SELECT count(DISTINCT {c}) < 10 FROM leaky)'} AS used FROM leaky" for c in NAMES) + """),
pure AS (SELECT "column", category, min(y) AS target, count(*) AS n FROM long WHERE used AND category IS NOT NULL GROUP BY 1, 2 HAVING min(y) = max(y) AND count(*) > 10),
strong AS (""" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", corr({c}, target_sucesso) AS r, count(DISTINCT {c}) AS d FROM leaky" for c in NAMES if c not in TEXTS) + ")"


@query("pure_categories", f"WITH {LEAKY}, {PURE} SELECT * FROM pure")
def _(spark, sf):
    return leakage.pure_categories(leaky(spark, sf), "target_sucesso")


@query("high_correlation", f"WITH {LEAKY}, {PURE} SELECT \"column\", {r('r')} AS r FROM strong WHERE d >= 10 AND abs(r) > 0.9")
def _(spark, sf):
    return rounded(leakage.high_correlation(leaky(spark, sf), "target_sucesso"))


REPORT = f"""WITH {LEAKY}, {PURE}, found AS (
  SELECT 1 AS step, "column", 'Categoria ''' || category || ''' tem 100% de associação com target=' || CAST(target AS VARCHAR) AS reason FROM pure
  UNION ALL SELECT 1, "column", 'Alta correlação com target: ' || format('{{:.3f}}', r) FROM strong WHERE d >= 10 AND abs(r) > 0.9),
named AS (""" + " UNION ALL ".join(f"SELECT {quote(c)} AS \"column\", {quote(t)} AS term" for c, t in leakage.suspicious_names(NAMES, "target_sucesso")) + """),
report AS (SELECT * FROM found UNION ALL SELECT 2, "column", 'Nome suspeito contendo ''' || term || '''' FROM named WHERE "column" NOT IN (SELECT "column" FROM found)
""" + "".join(f" UNION ALL SELECT 3, {quote(c)}, 'Data possivelmente futura à decisão'" for c in leakage.future_dates(NAMES)) + ")"


@query("suspicious_names", REPORT + " SELECT * FROM report WHERE step = 2")
def _(spark, sf):
    return leakage.leakage_report(leaky(spark, sf), "target_sucesso").where("step = 2")


@query("future_dates", REPORT + " SELECT * FROM report WHERE step = 3 AND EXISTS (SELECT 1 FROM leaky)")
def _(spark, sf):
    return leakage.leakage_report(leaky(spark, sf), "target_sucesso").where("step = 3")


@query("leakage_report", REPORT + " SELECT * FROM report")
def _(spark, sf):
    return leakage.leakage_report(leaky(spark, sf), "target_sucesso")


@query("leaking_columns", REPORT + " SELECT DISTINCT \"column\" FROM report")
def _(spark, sf):
    return leakage.leaking_columns(leakage.leakage_report(leaky(spark, sf), "target_sucesso"))


# The whole feature plan ------------------------------------------------------------------------

PLAN_COLUMNS = {
    "dias_no_pipeline": "int", "mes_candidatura": "int", "dia_semana_candidatura": "int", "fim_do_mes": "int", "tamanho_comentario": "int",
    "qtd_palavras_comentario": "int", "categoria_situacao": "string", "target_sucesso": "int", "recrutador_encoded": "bigint",
    "taxa_sucesso_recrutador": "double", "total_candidatos_recrutador": "bigint", "recrutador_alto_desempenho": "int", "popularidade_area": "bigint",
    "taxa_sucesso_area": "double", "tempo_medio_pipeline_area": "double", "tempo_acima_media": "int", "taxa_sucesso_contratacao": "double",
}


@query("prospect_features", f"""WITH {si.LABELLED_JOBS}, base AS (SELECT l.*, text AS comentario FROM labelled_jobs l LEFT JOIN documents ON doc_id = row_id),
  rec AS (SELECT CAST(recrutador AS VARCHAR) AS k, avg(target_sucesso) AS tr, count(*) AS nr FROM base WHERE recrutador IS NOT NULL GROUP BY 1),
  codes AS (SELECT k, row_number() OVER (ORDER BY k) - 1 AS code FROM (SELECT DISTINCT coalesce(CAST(recrutador AS VARCHAR), {quote(vocab.UNSPECIFIED)}) AS k FROM base)),
  area AS (SELECT area_vaga, avg(target_sucesso) AS ta, count(*) AS na, avg(dias_no_pipeline) AS da FROM base WHERE area_vaga IS NOT NULL GROUP BY 1),
  con AS (SELECT tipo_contratacao, avg(target_sucesso) AS tc FROM base GROUP BY 1)
  SELECT row_id, dias_no_pipeline, CAST(month(data_candidatura) AS INTEGER) AS mes_candidatura, CAST(isodow(data_candidatura) - 1 AS INTEGER) AS dia_semana_candidatura,
    CAST(day(data_candidatura) > 25 AS INTEGER) AS fim_do_mes, CAST(coalesce(length(comentario), 0) AS INTEGER) AS tamanho_comentario,
    CAST(coalesce(len(regexp_extract_all(comentario, '\\S+')), 0) AS INTEGER) AS qtd_palavras_comentario, categoria_situacao, target_sucesso,
    code AS recrutador_encoded, {r('tr')} AS taxa_sucesso_recrutador, nr AS total_candidatos_recrutador,
    CAST(coalesce(round(tr, 9) > round((SELECT avg(tr) FROM base JOIN rec ON k = CAST(recrutador AS VARCHAR)), 9), false) AS INTEGER) AS recrutador_alto_desempenho,
    na AS popularidade_area, {r('ta')} AS taxa_sucesso_area, {r('da')} AS tempo_medio_pipeline_area,
    CAST(dias_no_pipeline > (SELECT avg(dias_no_pipeline) FROM base) AS INTEGER) AS tempo_acima_media, {r('tc')} AS taxa_sucesso_contratacao
  FROM base LEFT JOIN rec ON rec.k = CAST(recrutador AS VARCHAR) LEFT JOIN codes ON codes.k = coalesce(CAST(recrutador AS VARCHAR), {quote(vocab.UNSPECIFIED)})
  LEFT JOIN area USING (area_vaga) LEFT JOIN con USING (tipo_contratacao)""")
def _(spark, sf):
    out = prospect_features(si.plan_input(spark, sf), si.jobs(spark, sf))
    return rounded(out.select("row_id", *[C(n).cast(k).alias(n) for n, k in PLAN_COLUMNS.items()]))
