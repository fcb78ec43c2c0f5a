"""Scoring output rules (N)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.functions import vocab
from scorelake.functions.clean import map_lookup


def recommend(probability: Column) -> dict[str, Column]:
    hit = probability >= 0.5
    return {
        "prediction": hit.cast("int"),
        "recommendation": F.when(hit, F.lit(vocab.RECOMMENDED)).otherwise(F.lit(vocab.NOT_RECOMMENDED)),
    }


def apply_threshold(probability: Column, threshold: float) -> Column:
    limit = min(max(threshold, 0.01), 0.99)
    return (probability >= limit).cast("int")


def blank(c: Column) -> Column:
    return F.coalesce(c == "", F.lit(True))


def has_job(job_id: Column, title: Column, area: Column, seniority: Column) -> Column:
    return ~(blank(job_id) & blank(title) & blank(area) & blank(seniority))


def job_info(job_id: Column, title: Column, area: Column, seniority: Column) -> Column:
    filled = {"id": job_id, "titulo": title, "area": area, "senioridade": seniority}
    fields = [
        F.coalesce(F.nullif(c, F.lit("")), F.lit(vocab.JOB_INFO_DEFAULTS[n])).alias(n) for n, c in filled.items()
    ]
    return F.when(has_job(job_id, title, area, seniority), F.struct(*fields))


def match_score(probability: Column, with_job: Column, matched: Column, boost: float = vocab.AREA_MATCH_BOOST) -> Column:
    raised = F.when(matched == 1, F.least(F.lit(1.0), probability * boost)).otherwise(probability)
    return F.when(with_job, raised)


def confidence_band(probability: Column) -> Column:
    return (
        F.when(probability > 0.9, F.lit("alta"))
        .when(probability > 0.7, F.lit("boa"))
        .when(probability > 0.5, F.lit("moderada"))
        .otherwise(F.lit("baixa"))
    )


def known_area(c: Column) -> Column:
    """Trimmed area, or NULL for a placeholder."""
    kept = F.trim(c)
    return F.when(~F.lower(kept).isin("string", "none", ""), kept)


def soft_area_match(education_area: Column, job_area: Column) -> Column:
    a, b = F.lower(known_area(education_area)), F.lower(known_area(job_area))
    return F.coalesce((a == b) | F.contains(b, a) | F.contains(a, b), F.lit(False))


def one_decimal(c: Column) -> Column:
    """Fixed one-decimal text, half to even."""
    return F.when(c.isNotNull(), F.format_string("%.1f", F.bround(c, 1)))


def years_text(years: Column) -> Column:
    return F.coalesce(F.concat(one_decimal(years), F.lit(" anos")), F.lit("não especificada"))


def seniority_fit(seniority: Column, years: Column) -> Column:
    """``(ok, reason)``: whether the experience fits the level asked for, and why."""
    level = F.lower(seniority)
    text = years_text(years)

    def short(name: str, least: int) -> Column:
        return F.concat(
            F.lit(f"A vaga requer senioridade {name}, mas o candidato possui "), text,
            F.lit(f" de experiência (geralmente esperado {least}+ anos)."),
        )

    too_senior = F.coalesce(level.isin("senior", "sênior") & (years < 6), F.lit(False))
    too_mid = F.coalesce(level.isin("pleno", "pl") & (years < 3), F.lit(False))
    above = F.coalesce(level.isin("junior", "jr") & (years > 5), F.lit(False))
    surplus = F.concat(
        F.lit("O candidato possui "), text,
        F.lit(" de experiência, superior ao geralmente esperado para uma vaga junior."),
    )
    reason = (
        F.when(too_senior, short("senior", 6)).when(too_mid, short("pleno", 3)).when(above, surplus)
        .otherwise(F.lit(""))
    )
    return F.struct((~(too_senior | too_mid)).alias("ok"), reason.alias("reason"))


def education_text(education: Column) -> Column:
    return F.when(blank(education), F.lit(vocab.EDUCATION_PHRASE_MISSING)).otherwise(
        F.coalesce(map_lookup(education, vocab.EDUCATION_PHRASES), F.lit(vocab.EDUCATION_PHRASE_OTHER))
    )


def _bullets(title: str, points: list[Column], tail: str = "\n") -> Column:
    """A titled list of the points that are not NULL, or an empty text."""
    lines = F.concat_ws("\n", *[F.concat(F.lit("• "), p) for p in points])
    return F.coalesce(F.concat(F.lit(title + "\n"), F.nullif(lines, F.lit("")), F.lit(tail)), F.lit(""))


def with_explanation(
    df: DataFrame,
    prediction: Column,
    probability: Column,
    years: Column,
    education_area: Column,
    unemployed: Column,
    skills: Column,
    title: Column,
    job_area: Column,
    seniority: Column,
    out: str = "comment",
) -> DataFrame:
    """Add the explanation of each decision: strengths and cautions, or reasons and advice.

    Shared parts are columns of their own, in steps, so each is worked out once per row.
    """
    first = df.withColumns({
        "__area": known_area(education_area), "__wanted": known_area(job_area), "__years": years_text(years),
        "__band": confidence_band(probability), "__title": F.nullif(title, F.lit("")), "__level": F.nullif(seniority, F.lit("")),
    })
    fit = seniority_fit(seniority, years)
    area, wanted, text, band = F.col("__area"), F.col("__wanted"), F.col("__years"), F.col("__band")
    low_area, low_wanted = F.lower(area), F.lower(wanted)
    second = first.withColumns({
        "__matched": F.coalesce(F.contains(low_wanted, low_area) | F.contains(low_area, low_wanted), F.lit(False)),
        "__caution": F.when(~fit["ok"], fit["reason"]),
        "__place": F.concat(
            F.coalesce(F.concat(F.lit(" na área de "), wanted), F.lit("")),
            F.coalesce(F.concat(F.lit(", nível "), F.col("__level")), F.lit("")), F.lit(".\n\n")),
    })
    matched, caution, place = F.col("__matched"), F.col("__caution"), F.col("__place")
    said, asked = F.coalesce(area, F.lit("None")), F.coalesce(wanted, F.lit("None"))

    strengths = _bullets("Pontos fortes:", [
        F.when(matched, F.concat(F.lit("Formação em "), area, F.lit(" compatível com a área da vaga ("), wanted, F.lit(")"))),
        F.when(years > 3, F.concat(F.lit("Experiência sólida de "), text)),
        F.when(unemployed < 0.5, F.lit("Curto período sem emprego, indicando atualização profissional")),
        F.when(F.size(skills) > 0, F.concat(F.lit("Competências relevantes: "), F.array_join(F.slice(skills, 1, 3), ", "))),
    ], "\n\n")
    cautions = _bullets("Áreas de atenção:", [
        F.when(~matched, F.concat(F.lit("Formação em "), said, F.lit(" diferente da área da vaga ("), asked, F.lit(")"))),
        caution,
    ])
    positive = F.concat(
        F.lit("Análise indica "), band, F.lit(" compatibilidade com a vaga"),
        F.coalesce(F.concat(F.lit(" de "), F.col("__title")), F.lit("")), place, strengths, cautions)

    reasons = _bullets("Principais considerações:", [
        F.when(~matched, F.concat(
            F.lit("Incompatibilidade entre a formação do candidato ("), area, F.lit(") e a área da vaga ("), wanted, F.lit(")"))),
        F.when(area.isNull(), F.concat(F.lit("Candidato não especificou área de formação para vaga na área de "), wanted)),
        F.when(wanted.isNull(), F.concat(F.lit("Candidato com formação em "), area, F.lit(", mas área da vaga não especificada"))),
        caution,
        F.when(years < 2, F.concat(F.lit("Experiência limitada de apenas "), text)),
        F.when(unemployed > 1, F.concat(F.lit("Período de "), one_decimal(unemployed), F.lit(" anos sem emprego formal na área"))),
    ])
    verdict = F.when(probability < 0.5, F.lit("não atender completamente aos requisitos")).otherwise(
        F.lit("atender apenas parcialmente aos requisitos"))
    advice = (
        F.when(probability < 0.3, F.lit("\nSugerimos avaliar outros candidatos mais alinhados com os requisitos da posição."))
        .when(probability < 0.5, F.lit("\nO candidato não é recomendado para esta posição, mas pode ser considerado para outras funções mais alinhadas com seu perfil."))
        .otherwise(F.lit("\nO candidato atende apenas parcialmente aos requisitos, podendo necessitar de treinamento adicional ou supervisão mais próxima."))
    )
    negative = F.concat(
        F.lit("O perfil apresenta "), band, F.lit(" probabilidade de "), verdict,
        F.coalesce(F.concat(F.lit(" da posição de "), F.col("__title")), F.lit("")), place, reasons, advice)
    text_out = F.trim(F.when(prediction == 1, positive).otherwise(negative), F.lit(" \n\t\r"))
    helpers = ("area", "wanted", "years", "band", "title", "level", "matched", "caution", "place")
    return second.withColumn(out, text_out).drop(*[f"__{h}" for h in helpers])
