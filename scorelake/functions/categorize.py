"""Ladders, statuses and the success label."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.functions import vocab
from scorelake.functions.text import contains_any


def ladder(text: Column, steps: Sequence[tuple[str, Sequence[str]]], otherwise: str, missing: str) -> Column:
    """First step with a substring hit wins."""
    low = F.lower(text)
    chain = F.when(text.isNull(), F.lit(missing))
    for label, terms in steps:
        chain = chain.when(contains_any(low, terms), F.lit(label))
    return chain.otherwise(F.lit(otherwise))


def seniority_from_title(title: Column, steps=vocab.SENIORITY_LADDER) -> Column:
    return ladder(title, steps, vocab.UNSPECIFIED, vocab.UNSPECIFIED)


def area_from_title(title: Column, steps=vocab.AREA_LADDER) -> Column:
    return ladder(title, steps, vocab.AREA_OTHER, vocab.UNSPECIFIED)


def contract_type(df: DataFrame, nested: str = "informacoes_basicas", field: str = "tipo_contratacao") -> Column:
    """Nested field when its struct is present on the row, else the flat column, else a default."""
    default = F.lit(vocab.UNSPECIFIED)
    flat = F.col(field) if field in df.columns else default
    if nested not in df.columns:
        return flat
    inner = F.col(nested)
    names = {f.name for f in getattr(df.schema[nested].dataType, "fields", [])}
    value = F.coalesce(inner[field], default) if field in names else default
    return F.when(inner.isNotNull(), value).otherwise(flat)


def contract_rank(contract: Column, ranks: Sequence[tuple[str, int]] = vocab.CONTRACT_RANKS) -> Column:
    chain = F.when(contract.isNull(), F.lit(0))
    for key, rank in ranks:
        chain = chain.when(F.contains(contract, F.lit(key)), F.lit(rank))
    return chain.otherwise(F.lit(0))


def classify_status(status: Column, categories: Mapping[str, Sequence[str]] = vocab.STATUS_CATEGORIES) -> Column:
    chain = None
    for name, members in categories.items():
        hit = status.isin(list(members))
        chain = F.when(hit, F.lit(name)) if chain is None else chain.when(hit, F.lit(name))
    return chain.otherwise(F.lit(vocab.STATUS_UNDEFINED))


def binary_target(category: Column, success: str = "sucesso") -> Column:
    return F.coalesce((category == success).cast("int"), F.lit(0))


def reclassify(
    category: Column,
    text: Column,
    success: Sequence[str] = vocab.RECLASSIFY_SUCCESS,
    denials: Sequence[str] = vocab.RECLASSIFY_SUCCESS_DENIALS,
    failure: Sequence[str] = vocab.RECLASSIFY_FAILURE,
    progress: Sequence[str] = vocab.RECLASSIFY_PROGRESS,
) -> Column:
    """New category for undefined rows, read from the comment; others keep theirs."""
    low = F.lower(text)
    return (
        F.when(category != vocab.STATUS_UNDEFINED, category)
        .when(contains_any(low, success) & ~contains_any(low, denials), F.lit("sucesso"))
        .when(contains_any(low, failure), F.lit("fracasso"))
        .when(contains_any(low, progress), F.lit("em_andamento"))
        .otherwise(category)
    )
