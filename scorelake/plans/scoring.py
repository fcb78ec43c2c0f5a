"""Scoring requests: clean, score, explain, log. One plan over any number of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.functions import scoring
from scorelake.functions.clean import preprocess_batch
from scorelake.operators.modeling import batch_score
from scorelake.sources.writers import prediction_rows

JOB_FIELDS = ("vaga_id", "vaga_titulo", "vaga_area", "vaga_senioridade")


def text_or_null(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def number_or_null(df: DataFrame, name: str) -> Column:
    return F.col(name).try_cast("double") if name in df.columns else F.lit(None).cast("double")


def decide(scored: DataFrame, probability: str = "prediction_probability") -> DataFrame:
    """Add the decision, match score, job info and explanation to rows that carry a probability."""
    p = F.col(probability)
    job = [text_or_null(scored, n) for n in JOB_FIELDS]
    matched = F.col("match_area") if "match_area" in scored.columns else F.lit(0)
    skills = F.col("habilidades") if "habilidades" in scored.columns else F.array().cast("array<string>")
    named = scoring.recommend(p)
    out = scored.withColumns({
        **named,
        "vaga_info": scoring.job_info(*job),
        "match_score": scoring.match_score(p, scoring.has_job(*job), matched),
    })
    return scoring.with_explanation(
        out, F.col("prediction"), p, number_or_null(scored, "experiencia"), text_or_null(scored, "area_formacao"),
        number_or_null(scored, "tempo_desempregado"), skills, job[1], job[2], job[3],
    )


def score_requests(requests: DataFrame, model) -> DataFrame:
    """Clean the requests, score all of them, decide and explain."""
    return decide(batch_score(preprocess_batch(requests), model))


def log_rows(decided: DataFrame, candidate_id: str, timestamp: Column, features: list[str], segment: Column | None = None) -> DataFrame:
    return prediction_rows(
        decided, timestamp, F.col(candidate_id), F.col("prediction"), F.col("prediction_probability"),
        F.struct(*features), segment if segment is not None else F.lit(None).cast("string"),
    )
