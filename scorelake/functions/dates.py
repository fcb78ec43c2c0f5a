"""Date rules (C)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.functions import vocab


def parse_ts(text: Column, formats: Sequence[str] = vocab.DATE_FORMATS) -> Column:
    """First format that parses, else NULL."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats]).cast("timestamp_ntz")


def with_dates(
    df: DataFrame,
    applied: Sequence[str] = vocab.APPLICATION_DATE_NAMES,
    updated: Sequence[str] = vocab.UPDATE_DATE_NAMES,
    formats: Sequence[str] = vocab.DATE_FORMATS,
) -> DataFrame:
    """Add ``data_candidatura`` and ``data_atualizacao`` from the first column present."""

    def pick(names: Sequence[str]) -> Column | None:
        for name in names:
            if name in df.columns:
                kind = df.schema[name].dataType.simpleString()
                return parse_ts(F.col(name), formats) if kind == "string" else F.col(name).cast("timestamp_ntz")
        return None

    start = pick(applied)
    if start is None:
        start = F.lit(vocab.FALLBACK_DATE).cast("timestamp_ntz")
    end = pick(updated)
    return df.withColumns({"data_candidatura": start, "data_atualizacao": start if end is None else end})


def elapsed_days(start: Column, end: Column, cap: int = 365) -> Column:
    """Whole elapsed days, NULL as 0, clipped to 0..cap. Not a count of midnights."""
    gap = F.extract(F.lit("DAY"), end - start)
    return F.least(F.lit(cap), F.greatest(F.lit(0), F.coalesce(gap, F.lit(0))))


def calendar_parts(ts: Column) -> dict[str, Column]:
    return {
        "mes_candidatura": F.month(ts),
        "ano_candidatura": F.year(ts),
        "dia_semana_candidatura": F.weekday(ts),
        "trimestre_candidatura": F.quarter(ts),
    }


def month_edges(ts: Column) -> dict[str, Column]:
    day = F.dayofmonth(ts)
    return {
        "fim_do_mes": F.coalesce(day > 25, F.lit(False)).cast("int"),
        "inicio_do_mes": F.coalesce(day <= 5, F.lit(False)).cast("int"),
    }


def event_date(ts: Column) -> Column:
    return F.to_date(ts)
