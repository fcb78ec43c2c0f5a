"""The given tables in their domain roles: prospects, prediction log, scored table, metric history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.functions import categorize, dates
from scorelake.plans.registry import table
from scorelake.sizing import spread

SPLIT_TIME = dt.datetime(2024, 1, 16)
STATUS = {"F": "Aprovado", "P": "Prospect", "O": "Desistiu"}
CATEGORIES = {"F": "sucesso", "P": "em_andamento", "O": "fracasso"}


def prospects(spark, sf) -> DataFrame:
    """Orders as prospects; job, recruiter and update date come from the order's lines."""
    orders = table(spark, sf, "orders")
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("row_id")).agg(
        F.min("l_partkey").alias("job_id"), F.min("l_suppkey").alias("recrutador"),
        F.max("l_shipdate").alias("ultima_atualizacao"))
    status = F.col("o_orderstatus")
    facts = orders.select(
        F.col("o_orderkey").alias("row_id"), F.col("o_custkey").alias("applicant_id"),
        F.when(status == "F", STATUS["F"]).when(status == "P", STATUS["P"]).when(status == "O", STATUS["O"]).alias("situacao"),
        F.col("o_orderdate").alias("data_candidatura"), F.col("o_orderpriority").alias("tipo_contratacao"),
        F.col("o_totalprice").alias("valor"))
    return facts.join(lines, "row_id", "left")


def jobs(spark, sf) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("job_id"), F.col("p_name").alias("titulo"), F.col("p_type").alias("area_vaga"),
        F.col("p_size").alias("tamanho"), F.col("p_retailprice").alias("preco"))


def applicants(spark, sf) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("applicant_id"), F.col("c_mktsegment").alias("segmento"), F.col("c_acctbal").alias("saldo"))


def labelled(spark, sf) -> DataFrame:
    """Prospects with status category, label and days under way."""
    category = categorize.classify_status(F.col("situacao"))
    return prospects(spark, sf).withColumns({
        "categoria_situacao": category, "target_sucesso": categorize.binary_target(category),
        "dias_no_pipeline": dates.elapsed_days(F.col("data_candidatura"), F.col("ultima_atualizacao")).cast("int"),
    })


def labelled_jobs(spark, sf) -> DataFrame:
    from scorelake.operators.joins import join_jobs

    return join_jobs(labelled(spark, sf), jobs(spark, sf))


def plan_input(spark, sf) -> DataFrame:
    """Prospects with a comment text, ready for the feature plan."""
    comments = table(spark, sf, "documents").select(F.col("doc_id").alias("row_id"), F.col("text").alias("comentario"))
    return prospects(spark, sf).drop("valor").join(comments, "row_id", "left").withColumn("recrutador", F.col("recrutador").cast("string"))


PROSPECTS = """lines AS (
  SELECT l_orderkey AS row_id, min(l_partkey) AS job_id, min(l_suppkey) AS recrutador, max(l_shipdate) AS ultima_atualizacao
  FROM lineitem GROUP BY l_orderkey),
prospects AS (
  SELECT o_orderkey AS row_id, o_custkey AS applicant_id,
    CASE o_orderstatus WHEN 'F' THEN 'Aprovado' WHEN 'P' THEN 'Prospect' WHEN 'O' THEN 'Desistiu' END AS situacao,
    o_orderdate AS data_candidatura, o_orderpriority AS tipo_contratacao, o_totalprice AS valor,
    job_id, recrutador, ultima_atualizacao
  FROM orders LEFT JOIN lines ON lines.row_id = o_orderkey)"""

DAYS = ("CAST(least(365, greatest(0, coalesce(floor((epoch_us(ultima_atualizacao) - epoch_us(data_candidatura)) / 86400000000.0), 0)))"
        " AS INTEGER)")

LABELLED = PROSPECTS + f""",
labelled AS (
  SELECT *, CASE situacao WHEN 'Aprovado' THEN 'sucesso' WHEN 'Prospect' THEN 'em_andamento' WHEN 'Desistiu' THEN 'fracasso'
    ELSE 'indefinido' END AS categoria_situacao,
    CAST(situacao = 'Aprovado' AS INTEGER) AS target_sucesso, {DAYS} AS dias_no_pipeline
  FROM prospects)"""

LABELLED_JOBS = LABELLED + """,
labelled_jobs AS (
  SELECT l.*, p_name AS titulo, p_type AS area_vaga, p_size AS tamanho, p_retailprice AS preco
  FROM labelled l LEFT JOIN part ON p_partkey = l.job_id)"""


def prediction_log(spark, sf) -> DataFrame:
    """Events as a prediction log."""
    return table(spark, sf, "events").select(
        F.col("ts").alias("timestamp"), F.col("event_id").cast("string").alias("candidate_id"),
        F.col("event_type").isin("purchase", "signup").cast("int").alias("prediction"),
        (F.col("value") / 1000).alias("prediction_probability"), F.col("props").alias("features"),
        F.col("event_type").alias("segment"))


LOG = """log AS (
  SELECT ts AS "timestamp", CAST(event_id AS VARCHAR) AS candidate_id,
    CAST(event_type IN ('purchase', 'signup') AS INTEGER) AS prediction, value / 1000 AS prediction_probability,
    props AS features, event_type AS segment
  FROM events)"""


def scored(spark, sf) -> DataFrame:
    """Events as a scored table: label from the event type, score from the value."""
    return table(spark, sf, "events").select(
        "event_id", F.col("event_type").isin("purchase", "signup").cast("int").alias("y"), (F.col("value") / 1000).alias("score"))


SCORED = """scored AS (
  SELECT event_id, CAST(event_type IN ('purchase', 'signup') AS INTEGER) AS y, value / 1000 AS score FROM events)"""


def metric_history(spark, sf) -> DataFrame:
    """A metric history from the log: one entry per day, accuracy of the rule 'probability >= 0.05', precision, volume."""
    log = prediction_log(spark, sf)
    guess = (F.col("prediction_probability") >= 0.05).cast("int")
    days = log.groupBy(F.to_date("timestamp").cast("timestamp_ntz").alias("timestamp")).agg(
        F.avg((guess == F.col("prediction")).cast("int")).alias("accuracy"),
        F.try_divide(F.count_if((guess == 1) & (F.col("prediction") == 1)), F.count_if(guess == 1)).alias("precision"),
        F.count(F.lit(1)).cast("double").alias("volume"))
    return days.unpivot("timestamp", ["accuracy", "precision", "volume"], "metric", "value")


HISTORY = LOG + """,
days AS (
  SELECT CAST(CAST("timestamp" AS DATE) AS TIMESTAMP) AS "timestamp",
    avg(CAST(CAST(prediction_probability >= 0.05 AS INTEGER) = prediction AS INTEGER)) AS accuracy,
    count(*) FILTER (WHERE prediction_probability >= 0.05 AND prediction = 1) * 1.0e0
      / nullif(count(*) FILTER (WHERE prediction_probability >= 0.05), 0) AS "precision",
    CAST(count(*) AS DOUBLE) AS volume
  FROM log GROUP BY 1),
history AS (
  SELECT "timestamp", 'accuracy' AS metric, accuracy AS value FROM days
  UNION ALL SELECT "timestamp", 'precision', "precision" FROM days
  UNION ALL SELECT "timestamp", 'volume', volume FROM days)"""


def numbers(spark, sf) -> DataFrame:
    """Numeric line columns for profiles."""
    return table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def requests(spark, sf) -> DataFrame:
    """Orders, customers and nations as scoring requests, with values the rules must catch."""
    orders = spread(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice"))
    customers = table(spark, sf, "customer")
    seg = F.col("c_mktsegment")
    key = F.col("o_orderkey")
    return orders.join(customers, orders["o_custkey"] == customers["c_custkey"]).select(
        key.alias("row_id"),
        F.when(key % 13 == 0, F.lit("n/a")).otherwise((key % 110).cast("string")).alias("idade"),
        F.when(key % 17 == 0, F.lit(None)).otherwise(((key % 25 - 1) / 2).cast("string")).alias("experiencia"),
        F.when(key % 7 == 0, F.lit(None)).otherwise((key % 9) / 4).alias("tempo_desempregado"),
        (key % 33).cast("int").alias("anos_estudo"),
        F.col("c_acctbal").alias("salario_anterior"),
        F.when(key % 5 == 0, "Mestrado").when(key % 5 == 1, "ENSINO MÉDIO").when(key % 5 == 2, "").when(
            key % 5 == 3, "superior").otherwise("curso livre").alias("educacao"),
        F.when(seg == "MACHINERY", "Engenharia").when(seg == "BUILDING", " tecnologia ").when(
            seg == "FURNITURE", "none").when(seg == "HOUSEHOLD", "comercial").alias("area_formacao"),
        F.when(key % 3 == 0, "Python, SQL ,git").when(key % 3 == 1, "java").alias("habilidades"),
        F.when(key % 4 != 0, F.concat(F.lit("V"), key.cast("string"))).alias("vaga_id"),
        F.when(key % 4 != 1, F.lit("Analista")).alias("vaga_titulo"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "TI").when(F.col("o_orderpriority") == "2-HIGH", "engenharia").when(
            F.col("o_orderpriority") == "3-MEDIUM", "Vendas").when(F.col("o_orderpriority") == "5-LOW", "outra").alias("vaga_area"),
        F.when(F.col("o_orderstatus") == "F", "Sênior").when(F.col("o_orderstatus") == "O", "pl").otherwise(
            F.lit("jr")).alias("vaga_senioridade"),
        (F.col("o_totalprice") / 500000.0).alias("p"),
    )


REQUESTS = """requests AS (
  SELECT o_orderkey AS row_id,
    CASE WHEN o_orderkey % 13 = 0 THEN 'n/a' ELSE CAST(o_orderkey % 110 AS VARCHAR) END AS idade,
    CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST((o_orderkey % 25 - 1) / 2 AS VARCHAR) END AS experiencia,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE (o_orderkey % 9) / 4 END AS tempo_desempregado,
    CAST(o_orderkey % 33 AS INTEGER) AS anos_estudo, c_acctbal AS salario_anterior,
    CASE o_orderkey % 5 WHEN 0 THEN 'Mestrado' WHEN 1 THEN 'ENSINO MÉDIO' WHEN 2 THEN '' WHEN 3 THEN 'superior' ELSE 'curso livre' END AS educacao,
    CASE c_mktsegment WHEN 'MACHINERY' THEN 'Engenharia' WHEN 'BUILDING' THEN ' tecnologia ' WHEN 'FURNITURE' THEN 'none'
      WHEN 'HOUSEHOLD' THEN 'comercial' END AS area_formacao,
    CASE o_orderkey % 3 WHEN 0 THEN 'Python, SQL ,git' WHEN 1 THEN 'java' END AS habilidades,
    CASE WHEN o_orderkey % 4 <> 0 THEN 'V' || CAST(o_orderkey AS VARCHAR) END AS vaga_id,
    CASE WHEN o_orderkey % 4 <> 1 THEN 'Analista' END AS vaga_titulo,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'TI' WHEN '2-HIGH' THEN 'engenharia' WHEN '3-MEDIUM' THEN 'Vendas' WHEN '5-LOW' THEN 'outra' END AS vaga_area,
    CASE o_orderstatus WHEN 'F' THEN 'Sênior' WHEN 'O' THEN 'pl' ELSE 'jr' END AS vaga_senioridade,
    o_totalprice / 500000.0 AS p
  FROM orders JOIN customer ON c_custkey = o_custkey)"""
