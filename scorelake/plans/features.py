"""From joined prospects to the labelled feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.functions import categorize, dates, text, vocab
from scorelake.functions.clean import first_present
from scorelake.operators.aggregates import above_mean_flag
from scorelake.operators.encode import label_codes, levels, onehot_columns
from scorelake.operators.joins import join_applicants, join_jobs
from scorelake.session import landed
from scorelake.sizing import join_lookup, small_table


def joined(prospects: DataFrame, jobs: DataFrame | None = None, applicants: DataFrame | None = None) -> DataFrame:
    return join_applicants(join_jobs(prospects, jobs), applicants)


def with_temporal(df: DataFrame) -> DataFrame:
    out = dates.with_dates(df)
    start = F.col("data_candidatura")
    return out.withColumns({
        "dias_no_pipeline": dates.elapsed_days(start, F.col("data_atualizacao")),
        **dates.calendar_parts(start), **dates.month_edges(start),
    })


def with_text(df: DataFrame, comment: str = "comentario") -> DataFrame:
    c, low = F.col(comment), F.col("__low")
    return text.with_lower(df, comment).withColumns({
        "sentimento_comentario": text.keyword_sentiment(c),
        "pretensao_salarial_extraida": text.extract_salary(c),
        "disponibilidade_dias": text.extract_days(c),
        "engajamento_positivo": text.engagement_flag(c),
        "fit_cultural": text.culture_flag(c),
        "habilidades_tecnicas": F.coalesce(text.extract_terms(c), F.array().cast("array<string>")),
        **text.term_flags(low),
        **text.regex_flags(c, low),
        "tamanho_comentario": text.text_length(c),
    }).drop("__low")


def with_categories(df: DataFrame, comment: str = "comentario") -> DataFrame:
    """Ladders, status category, label and codes. An existing category column is kept."""
    out = df
    if "titulo_vaga" in df.columns:
        title = F.col("titulo_vaga")
        out = out.withColumns({
            "senioridade_vaga": categorize.seniority_from_title(title), "area_vaga": categorize.area_from_title(title)})
    out = out.withColumn("tipo_contratacao", categorize.contract_type(df))
    if "categoria_situacao" not in df.columns:
        status = first_present(df, vocab.STATUS_NAMES)
        if status is not None:
            out = out.withColumn("categoria_situacao", categorize.classify_status(status))
    if "categoria_situacao" in out.columns:
        if comment in out.columns:
            out = out.withColumn("categoria_situacao", categorize.reclassify(F.col("categoria_situacao"), F.col(comment)))
        out = out.withColumn("target_sucesso", categorize.binary_target(F.col("categoria_situacao")))
    return out


def group_table(df: DataFrame) -> DataFrame:
    """``(column, value, n, n_target, target, days, engaged)`` per value of every grouping column, from one pass.

    Everything the codes, one-hot columns and group rates need. It is landed, so that its many readers do not
    aggregate the source again; when it is small it becomes a literal table.
    """
    keys = [c for c in vocab.ENCODED_COLUMNS if c in df.columns]
    none = F.lit(None).cast("double")
    has = set(df.columns)
    rows = df.select(
        F.inline(F.array(*[F.struct(F.lit(k).alias("column"), F.col(k).cast("string").alias("value")) for k in keys])),
        (F.col("target_sucesso") if "target_sucesso" in has else none).alias("y"),
        (F.col("dias_no_pipeline") if "dias_no_pipeline" in has else none).alias("d"),
        (F.col("engajamento_positivo").cast("int") if "engajamento_positivo" in has else none).alias("e"),
    )
    grouped = landed(rows.groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n"), F.count("y").alias("n_target"), F.avg("y").alias("target"), F.avg("d").alias("days"),
        F.avg("e").alias("engaged")))
    small = small_table(grouped)
    return grouped if small is None else small


def with_codes(df: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    groups = group_table(df) if groups is None else groups
    for c in vocab.ENCODED_COLUMNS:
        if c in df.columns:
            values = groups.where(F.col("column") == c).select(F.col("value").alias(c))
            codes = label_codes(values, c)
            key = F.coalesce(F.col(c).cast("string"), F.lit(vocab.UNSPECIFIED))
            df = df.withColumn("__key", key).join(codes.withColumnsRenamed({"value": "__key", "code": f"{c}_encoded"}), "__key", "left").drop("__key")
            if c in vocab.ONEHOT_COLUMNS:
                found = levels(values, c)
                df = df.withColumns(onehot_columns(c, found)) if found else df
    return df


def with_aggregates(df: DataFrame, comment: str = "comentario", fit_on: DataFrame | None = None,
                    groups: DataFrame | None = None, rows: DataFrame | None = None) -> DataFrame:
    """Group statistics and flags. ``fit_on`` fits the group rates on other rows, such as train only. ``rows`` are the rows of
    ``df`` before columns were joined to them, if at hand: the mean over rows is cheaper there."""
    out = df
    has = set(df.columns)
    if groups is None or fit_on is not None:
        groups = group_table(df if fit_on is None else fit_on)

    def attach(out: DataFrame, key: str, stats: dict[str, str]) -> DataFrame:
        mine = groups.where((F.col("column") == key) & F.col("value").isNotNull()).select(
            F.col("value").alias("__value"), *[F.col(s).alias(n) for n, s in stats.items()])
        return join_lookup(out, mine, lambda a, b: a[key].cast("string") == b["__value"]).drop("__value")

    if {"recrutador", "target_sucesso"} <= has:
        stats = {"taxa_sucesso_recrutador": "target", "total_candidatos_recrutador": "n_target"}
        if "engajamento_positivo" in has:
            stats["taxa_engajamento_recrutador"] = "engaged"
        out = attach(out, "recrutador", stats)
        mine = groups.where((F.col("column") == "recrutador") & F.col("value").isNotNull())
        if fit_on is None:
            # Mean over rows of the group rate, from the groups themselves.
            mean = mine.agg(F.sum(F.col("target") * F.col("n")) / F.sum("n")).scalar()
        else:
            mean = out.agg(F.avg("taxa_sucesso_recrutador")).scalar()
        above = F.col("taxa_sucesso_recrutador") > mean
        out = out.withColumn("recrutador_alto_desempenho", F.coalesce(above, F.lit(False)).cast("int"))
    if "area_vaga" in has:
        stats = {"popularidade_area": "n", "taxa_sucesso_area": "target"}
        if "dias_no_pipeline" in has:
            stats["tempo_medio_pipeline_area"] = "days"
        out = attach(out, "area_vaga", stats)
    if {"area_vaga", "dias_no_pipeline"} <= has:
        out = above_mean_flag(out, "dias_no_pipeline", "tempo_acima_media", df if rows is None else rows)
    if "tipo_contratacao" in has:
        out = attach(out, "tipo_contratacao", {"taxa_sucesso_contratacao": "target"})
        out = out.withColumn("ranking_contratacao", categorize.contract_rank(F.col("tipo_contratacao")))
    if comment in has:
        flags = text.keyword_group_flags(F.col("__low"))
        out = text.with_lower(out, comment).withColumns({"qtd_palavras_comentario": text.word_count(F.col(comment)), **flags}).drop("__low")
    if {"menciona_valores", "engajamento_positivo"} <= has and "menciona_outra_proposta" in out.columns:
        out = out.withColumn("risco_desistencia", text.withdrawal_risk(
            F.col("menciona_outra_proposta"), F.col("menciona_valores"), F.col("engajamento_positivo")))
    return out


def prospect_features(prospects: DataFrame, jobs: DataFrame | None = None, applicants: DataFrame | None = None) -> DataFrame:
    """Temporal, text, category, code and group features of joined prospects. The joined rows are landed: the groups, the mean
    and the result each read them, whatever the number of groups."""
    base = landed(with_categories(with_text(with_temporal(joined(prospects, jobs, applicants)))))
    groups = group_table(base)
    return with_aggregates(with_codes(base, groups), groups=groups, rows=base)
