"""Hand-written rows for the per-row rules."""

import math

import pytest
from pyspark.sql import functions as F

from scorelake.functions import categorize, clean, dates, scoring, text
from scorelake.plans.scoring import decide


def values(spark, items, column, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, c {kind}")
    return [r[0] for r in rows.orderBy("i").select(column.alias("v")).collect()]


def test_salary(spark):
    texts = ["Pretensão R$ 5.500,00", "R$ 5000", "8k", None, "cerca de 3.200 reais", "salário atual 4.100", "nada"]
    assert values(spark, texts, text.extract_salary(F.col("c"))) == [5500.0, 500.0, 8000.0, None, 3200.0, 4100.0, None]


def test_days(spark):
    assert values(spark, ["disponível em 15 dias", "1 DIA", "logo", None], text.extract_days(F.col("c"))) == [15, 1, None, None]


def test_engagement(spark):
    texts = ["candidato interessado", "não tem interesse", "contratado", "não foi contratado", "desistiu da contratação", None, "SEM interesse"]
    assert values(spark, texts, text.engagement_flag(F.col("c"))) == [True, False, True, True, False, False, False]


def test_terms(spark):
    texts = ["sap e java", "javascript", "JAVA, front-end e ci/cd", "javaé", None]
    assert values(spark, texts, text.extract_terms(F.col("c"))) == [["java", "sap"], ["javascript"], ["java", "front-end", "ci/cd"], [], []]


def test_sentiment(spark):
    texts = ["aprovado e motivado", "não, reprovado", None, "Excelente"]
    # "reprovado" does not hold "aprovado"; "não" and "reprovado" each count once.
    assert values(spark, texts, text.keyword_sentiment(F.col("c"))) == [0.4, -0.4, 0.0, 0.2]


def test_regex_flags(spark):
    df = text.with_lower(spark.createDataFrame([(0, "Fala INGLÊS"), (1, "SALÁRIO alto"), (2, "R$ 10"), (3, None), (4, "Outra Oferta")], "i int, c string"), "c")
    flags = text.regex_flags(F.col("c"), F.col("__low"))
    got = {r["i"]: r for r in df.select("i", *[v.alias(k) for k, v in flags.items()]).collect()}
    assert got[0]["menciona_ingles"] and got[1]["menciona_valores"] and got[2]["menciona_valores"] and got[4]["menciona_outra_proposta"]
    assert not any(v for k, v in got[3].asDict().items() if k != "i")


def test_literal_starts():
    assert text.literal_starts("contrata|pj") == ["contrata", "pj"]
    assert text.literal_starts(r"R\$|valor") == ["r$", "valor"]
    assert text.literal_starts("ingl[eê]s") == ["ingl"]
    assert text.literal_starts("ab*c") is None
    assert text.literal_starts("(a|b)c") is None


def test_status_and_reclassify(spark):
    assert values(spark, ["Aprovado", "Desistiu", "Prospect", None, "xyz"], categorize.classify_status(F.col("c"))) == [
        "sucesso", "fracasso", "em_andamento", "indefinido", "indefinido"]
    texts = ["não aprovado pelo cliente", "aguardando retorno", "foi aprovado", "no aprovado", None]
    got = values(spark, texts, categorize.reclassify(F.lit("indefinido"), F.col("c")))
    assert got == ["fracasso", "em_andamento", "sucesso", "sucesso", "indefinido"]


def test_ladders(spark):
    titles = ["Desenvolvedor Java Sênior", "Analista SAP Jr", "Estagiário", None, "DBA Oracle", "Engenheiro de Dados"]
    assert values(spark, titles, categorize.seniority_from_title(F.col("c"))) == ["Senior", "Junior", "Não Especificado", "Não Especificado", "Não Especificado", "Não Especificado"]
    assert values(spark, titles, categorize.area_from_title(F.col("c"))) == ["Desenvolvimento", "SAP", "Outros", "Não Especificado", "Database", "Data/BI"]


def test_contract_rank(spark):
    assert values(spark, ["CLT Full", "PJ/Autônomo, CLT Full", "Estágio", None], categorize.contract_rank(F.col("c"))) == [2, 1, 0, 0]


def test_elapsed_days(spark):
    ends = ["2024-01-02 00:10:00", "2023-12-27 00:00:00", "2025-02-05 00:00:00", None]
    start = F.lit("2024-01-01 23:50:00").cast("timestamp_ntz")
    assert values(spark, ends, dates.elapsed_days(start, F.col("c").cast("timestamp_ntz"))) == [0, 0, 365, 0]


def test_dates_fall_back(spark):
    df = dates.with_dates(spark.createDataFrame([("03-02-2021",), ("bad",)], "datacandidatura string"))
    rows = df.collect()
    assert str(rows[0]["data_candidatura"]) == "2021-02-03 00:00:00" and rows[1]["data_candidatura"] is None
    assert rows[0]["data_atualizacao"] == rows[0]["data_candidatura"]
    empty = dates.with_dates(spark.createDataFrame([(1,)], "x int")).first()
    assert str(empty["data_candidatura"]) == "2021-01-01 00:00:00"


def test_constraints(spark):
    df = spark.createDataFrame([(17, -1.0, "mestrado"), (30, 2.0, "curso")], "idade int, experiencia double, educacao string")
    got = [r["violations"] for r in clean.check_constraints(df).orderBy("idade").collect()]
    assert got == [["idade_fora_do_intervalo", "experiencia_negativa"], ["educacao_invalida"]]


def test_preprocess_keeps_age_and_experience(spark):
    df = spark.createDataFrame([("28", "5", "mestrado", "TI", "tecnologia", ["Python"])],
                               "idade string, experiencia string, educacao string, vaga_area string, area_formacao string, habilidades array<string>")
    row = clean.preprocess_batch(df).first()
    assert (row["idade"], row["experiencia"], row["educacao"], row["match_area"], row["skill_python"], row["skill_java"]) == (28.0, 5.0, "pos_graduacao", 1, 1, 0)


CASES = [
    ((5.0, "tecnologia", 0.5, 0.85, "Desenvolvedor Python", "tecnologia", "pleno"),
     "Análise indica boa compatibilidade com a vaga de Desenvolvedor Python na área de tecnologia, nível pleno.\n\nPontos fortes:\n"
     "• Formação em tecnologia compatível com a área da vaga (tecnologia)\n• Experiência sólida de 5.0 anos"),
    ((1.2, "administracao", 2.0, 0.35, "Analista de Marketing", "marketing", "junior"),
     "O perfil apresenta baixa probabilidade de não atender completamente aos requisitos da posição de Analista de Marketing na área de marketing, nível junior.\n\n"
     "Principais considerações:\n• Incompatibilidade entre a formação do candidato (administracao) e a área da vaga (marketing)\n"
     "• Experiência limitada de apenas 1.2 anos\n• Período de 2.0 anos sem emprego formal na área\n\n"
     "O candidato não é recomendado para esta posição, mas pode ser considerado para outras funções mais alinhadas com seu perfil."),
    ((3.0, None, None, 0.48, "Analista de Dados", None, None),
     "O perfil apresenta baixa probabilidade de não atender completamente aos requisitos da posição de Analista de Dados.\n\n\n"
     "O candidato não é recomendado para esta posição, mas pode ser considerado para outras funções mais alinhadas com seu perfil."),
]


@pytest.mark.parametrize("case, expected", CASES)
def test_explanations(spark, case, expected):
    df = spark.createDataFrame([case], "experiencia double, area_formacao string, tempo_desempregado double, prediction_probability double, "
                               "vaga_titulo string, vaga_area string, vaga_senioridade string")
    assert decide(df).first()["comment"] == expected


def test_decision(spark):
    df = spark.createDataFrame([(0.7, 1, "x"), (0.9, 1, "x"), (0.4, 0, None)], "prediction_probability double, match_area int, vaga_area string")
    rows = decide(df).orderBy("prediction_probability").collect()
    assert [r["prediction"] for r in rows] == [0, 1, 1]
    assert rows[0]["match_score"] is None and rows[0]["vaga_info"] is None
    assert math.isclose(rows[1]["match_score"], 0.84) and rows[2]["match_score"] == 1.0
    assert rows[1]["vaga_info"]["titulo"] == "não especificado"


def test_threshold_is_clamped(spark):
    assert values(spark, [0.005, 0.985, 0.995], scoring.apply_threshold(F.col("c"), 2.0), "double") == [0, 0, 1]


def test_lexicon_wide_and_small_agree(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "bom bom ruim"), (2, "nada"), (3, None)], "id int, t string")
    lexicon = spark.createDataFrame([("bom", 1.0), ("ruim", -1.0)], "token string, polarity double")
    small = sorted(text.lexicon_sentiment(docs, "id", "t", lexicon).collect())
    monkeypatch.setattr(text, "small_table", lambda df: None)
    wide = sorted(text.lexicon_sentiment(docs, "id", "t", lexicon).collect())
    assert small == wide and math.isclose(small[0]["sentiment"], 1 / 3) and small[1]["sentiment"] == 0
