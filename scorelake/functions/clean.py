"""Row cleaning and request rules (B)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorelake.functions import vocab


def map_lookup(key: Column, table: Mapping[str, str]) -> Column:
    pairs = "\x1f".join(f"{k}\x1e{v}" for k, v in table.items())
    return F.try_element_at(F.str_to_map(F.lit(pairs), F.lit("\x1f"), F.lit("\x1e")), key)


def first_present(df: DataFrame, names: Sequence[str]) -> Column | None:
    return next((F.col(n) for n in names if n in df.columns), None)


def coerce_numeric(c: Column, default: float | None = None) -> Column:
    number = c.try_cast("double")
    return number if default is None else F.coalesce(number, F.lit(float(default)))


def normalize_values(c: Column, table: Mapping[str, str]) -> Column:
    low = F.lower(c)
    return F.coalesce(map_lookup(low, table), low)


def normalize_education(c: Column, table: Mapping[str, str] = vocab.EDUCATION_REQUEST_ALIASES) -> Column:
    return normalize_values(F.nullif(c, F.lit("")), table)


def education_valid(c: Column, table: Mapping[str, str] = vocab.EDUCATION_REQUEST_ALIASES) -> Column:
    return F.coalesce(normalize_education(c, table).isin(vocab.EDUCATION_LEVELS), F.lit(True))


def request_rules() -> dict[str, Column]:
    """Name of each broken rule -> condition that breaks it."""
    c = F.col
    return {
        "idade_ausente": c("idade").isNull(),
        "idade_fora_do_intervalo": ~c("idade").between(18, 100),
        "experiencia_ausente": c("experiencia").isNull(),
        "experiencia_negativa": c("experiencia") < 0,
        "tempo_desempregado_negativo": c("tempo_desempregado") < 0,
        "salario_anterior_negativo": c("salario_anterior") < 0,
        "anos_estudo_fora_do_intervalo": ~c("anos_estudo").between(0, 30),
        "educacao_invalida": ~education_valid(c("educacao")),
    }


def violations(rules: Mapping[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules.items()]))


def check_constraints(df: DataFrame, rules: Mapping[str, Column] | None = None) -> DataFrame:
    """Add ``violations`` and ``valid``; rules naming absent columns do not apply."""
    rules = request_rules() if rules is None else rules
    columns = set(df.columns)
    kept = {k: v for k, v in rules.items() if rule_column(k) is None or rule_column(k) in columns}
    out = df.withColumn("violations", violations(kept))
    return out.withColumn("valid", F.size("violations") == 0)


def rule_column(rule: str) -> str | None:
    for name in ("tempo_desempregado", "salario_anterior", "anos_estudo", "experiencia", "educacao", "idade"):
        if rule.startswith(name):
            return name
    return None


def normalize_list(c: Column, dtype: T.DataType) -> Column:
    """Comma text to a trimmed array; arrays stay; anything else is an empty array."""
    if isinstance(dtype, T.ArrayType):
        return c
    if isinstance(dtype, T.StringType):
        return F.coalesce(F.transform(F.split(c, ","), lambda s: F.trim(s)), F.array().cast("array<string>"))
    return F.array().cast("array<string>")


def skill_onehot(skills: Column, vocabulary: Sequence[str] = vocab.PROFILE_SKILLS) -> dict[str, Column]:
    low = F.transform(skills, F.lower)
    return {
        f"skill_{s}": F.coalesce(F.array_contains(low, s), F.lit(False)).cast("int") for s in vocabulary
    }


def ratio_features(age: Column, experience: Column, unemployed: Column) -> dict[str, Column]:
    floor_age = F.greatest(F.lit(1.0), age)
    return {
        "idade": floor_age,
        "experiencia_por_idade": experience / floor_age,
        "experiencia_ativa": experience - F.coalesce(unemployed, F.lit(0.0)),
    }


def area_match(education_area: Column, job_area: Column) -> Column:
    return F.coalesce((F.lower(education_area) == F.lower(job_area)).cast("int"), F.lit(0))


def clamp_nonneg(c: Column) -> Column:
    return F.greatest(F.lit(0.0), c)


def align_schema(df: DataFrame, required: Sequence[str], fill: float = 0) -> DataFrame:
    return df.select([F.col(f"`{c}`") if c in df.columns else F.lit(fill).alias(c) for c in required])


def fill_job_fields(df: DataFrame) -> DataFrame:
    out = {}
    if "vaga_id" in df.columns:
        out["vaga_id"] = F.coalesce("vaga_id", F.lit("desconhecido"))
    if "vaga_titulo" in df.columns:
        out["vaga_titulo"] = F.lower(F.coalesce("vaga_titulo", F.lit("")))
    if "vaga_area" in df.columns:
        out["vaga_area"] = normalize_values(F.coalesce("vaga_area", F.lit("")), vocab.AREA_ALIASES)
    if "vaga_senioridade" in df.columns:
        out["vaga_senioridade"] = normalize_values(
            F.coalesce("vaga_senioridade", F.lit("")), vocab.SENIORITY_ALIASES
        )
    return df.withColumns(out) if out else df


def to_int_flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("int")


def preprocess_batch(df: DataFrame, required: Sequence[str] | None = None) -> DataFrame:
    """Every cleaning rule over any number of rows, in one projection chain."""
    cols = set(df.columns)
    numeric = {n: coerce_numeric(F.col(n), d) for n, d in vocab.NUMERIC_DEFAULTS.items() if n in cols}
    out = df.withColumns(numeric) if numeric else df
    if "educacao" in cols:
        out = out.withColumn("educacao", normalize_values(F.col("educacao"), vocab.EDUCATION_ALIASES))
    if "habilidades" in cols:
        out = out.withColumn("habilidades", normalize_list(F.col("habilidades"), df.schema["habilidades"].dataType))
        out = out.withColumns(skill_onehot(F.col("habilidades")))
    out = fill_job_fields(out)
    if {"area_formacao", "vaga_area"} <= cols:
        out = out.withColumn("match_area", area_match(F.col("area_formacao"), F.col("vaga_area")))
    if {"idade", "experiencia"} <= cols:
        unemployed = F.col("tempo_desempregado") if "tempo_desempregado" in cols else F.lit(0.0)
        ratios = ratio_features(F.col("idade"), F.col("experiencia"), unemployed)
        if "tempo_desempregado" in cols:
            ratios["experiencia_ativa"] = clamp_nonneg(ratios["experiencia_ativa"])
        else:
            ratios.pop("experiencia_ativa")
        out = out.withColumns(ratios)
    return out if required is None else align_schema(out, required)
