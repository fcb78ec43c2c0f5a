"""Model preparation (L1-L7): imputing, scaling, encoding, feature lists, ANOVA selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorelake.functions import vocab
from scorelake.operators.aggregates import zero_variance_columns
from scorelake.operators.profile import clean_number, q
from scorelake.operators.quantiles import exact_quantiles

MISSING_LEVEL = "missing"


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    found = exact_quantiles(df, columns, [0.5])
    return {c: v[0] for c, v in found.items() if v[0] is not None}


def impute_median(df: DataFrame, columns: Sequence[str], fitted: Mapping[str, float] | None = None) -> DataFrame:
    """Fill NULL and NaN with the column median, fitted here or on the training rows."""
    values = medians(df, columns) if fitted is None else fitted
    return df.withColumns({c: F.coalesce(clean_number(q(c)), F.lit(values[c])) for c in columns if c in values})


def impute_constant(df: DataFrame, columns: Sequence[str], value: str = MISSING_LEVEL) -> DataFrame:
    return df.withColumns({c: F.coalesce(q(c).cast("string"), F.lit(value)) for c in columns})


def scale_stats(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of every column from one pass."""
    row = df.agg(*[
        F.struct(F.avg(clean_number(q(c))).alias("m"), F.stddev_pop(clean_number(q(c))).alias("s")).alias(f"s{i}")
        for i, c in enumerate(columns)
    ]).first()
    return {c: (row[f"s{i}"]["m"] or 0.0, row[f"s{i}"]["s"] or 1.0) for i, c in enumerate(columns)}


def scaled(c: Column, mean: float, deviation: float) -> Column:
    return (c - F.lit(mean)) / F.lit(deviation)


def standard_scale(df: DataFrame, columns: Sequence[str], fitted: Mapping[str, tuple[float, float]] | None = None) -> DataFrame:
    """(x - mean) / population deviation; a constant column is only centred."""
    stats = scale_stats(df, columns) if fitted is None else fitted
    return df.withColumns({c: scaled(clean_number(q(c)), *stats[c]) for c in columns})


@dataclass(frozen=True)
class FeatureRoles:
    ids: list[str]
    dates: list[str]
    texts: list[str]
    categorical: list[str]
    numeric: list[str]

    @property
    def features(self) -> list[str]:
        return self.categorical + self.numeric


def feature_roles(df: DataFrame, target: str, leaking: Sequence[str] = (), ids: Sequence[str] = vocab.ID_COLUMNS,
                  texts: Sequence[str] = vocab.TEXT_COLUMNS) -> FeatureRoles:
    """Sort columns into roles by name and declared type; leaking, id and text columns are not features."""
    removed = {*ids, *texts, *leaking, target}
    dates = [c for c in df.columns if "data" in c.lower()]
    kinds = {f.name: f.dataType for f in df.schema.fields}
    categorical = [c for c in df.columns if c not in removed and isinstance(kinds[c], (T.StringType, T.BooleanType))]
    numeric = [
        c for c in df.columns
        if c not in removed and c not in dates and isinstance(kinds[c], T.NumericType)
    ]
    return FeatureRoles(list(ids), dates, list(texts), categorical, numeric)


def drop_feature_roles(df: DataFrame, target: str, leaking: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    roles = feature_roles(df, target, leaking)
    kept = {*roles.features, *keep, target}
    return df.select([q(c) for c in df.columns if c in kept])


def assemble_features(columns: Sequence[str], numeric: Sequence[str] = vocab.NUMERIC_FEATURES,
                      flags: Sequence[str] = vocab.BOOLEAN_FEATURES, encoded: Sequence[str] = vocab.ENCODED_COLUMNS,
                      onehot: Sequence[str] = vocab.ONEHOT_COLUMNS) -> list[str]:
    """Present features of each kind, without repeats: numeric, codes, one-hot (sorted), flags."""
    have = set(columns)
    wanted = list(numeric) + [f"{c}_encoded" for c in encoded]
    wanted += sorted(c for c in columns if any(c.startswith(f"{p}_") for p in onehot))
    wanted += list(flags)
    return [c for c in dict.fromkeys(wanted) if c in have]


def feature_matrix(df: DataFrame, target: str | None, row_id: str = "row_id") -> DataFrame:
    """Final features: medians filled, flags as 0/1, constant columns dropped, numeric ones scaled."""
    names = assemble_features(df.columns)
    numeric = [c for c in vocab.NUMERIC_FEATURES if c in names]
    flags = [c for c in vocab.BOOLEAN_FEATURES if c in names]
    keep = [c for c in (row_id, target) if c and c in df.columns]
    base = df.select(*keep, *[q(c) for c in names])
    base = base.withColumns({c: F.coalesce(q(c).cast("int"), F.lit(0)) for c in flags})
    base = impute_median(base, numeric)
    constant = set(zero_variance_columns(base, names))
    base = base.drop(*constant)
    return standard_scale(base, [c for c in numeric if c not in constant])


def fit_preprocess(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                   out: str = "features") -> PipelineModel:
    """Median fill and scaling for numbers, fill and one-hot for categories; unseen levels are all zeros."""
    filled = medians(train, numeric) if numeric else {}
    numeric = [c for c in numeric if c in filled]
    stats = scale_stats(impute_median(train, numeric, filled), numeric) if numeric else {}
    parts = ["*"]
    for c in numeric:
        m, s = stats[c]
        x = f"CAST(`{c}` AS DOUBLE)"
        parts.append(f"(COALESCE(nanvl({x}, NULL), {filled[c]!r}D) - ({m!r}D)) / {s!r}D AS `__n_{c}`")
    parts += [f"COALESCE(CAST(`{c}` AS STRING), '{MISSING_LEVEL}') AS `__c_{c}`" for c in categorical]
    stages = [SQLTransformer(statement=f"SELECT {', '.join(parts)} FROM __THIS__")]
    if categorical:
        stages += [
            StringIndexer(inputCols=[f"__c_{c}" for c in categorical], outputCols=[f"__i_{c}" for c in categorical],
                          handleInvalid="keep", stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=[f"__i_{c}" for c in categorical], outputCols=[f"__o_{c}" for c in categorical],
                          handleInvalid="error", dropLast=True),
        ]
    inputs = [f"__n_{c}" for c in numeric] + [f"__o_{c}" for c in categorical]
    # The indexer gives unseen levels one extra, last index; dropping the last column makes them zeros.
    stages.append(VectorAssembler(inputCols=inputs, outputCol=out, handleInvalid="keep"))
    return Pipeline(stages=stages).fit(train)


def anova_f(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """``(feature, f)``: ANOVA F of each feature over the classes, from one grouped pass."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), q(c).cast("double").alias("x")) for c in columns])
    rows = df.select(F.col(target), F.inline(pairs))
    long = rows.groupBy(target, "feature").agg(F.count("x").alias("n"), F.avg("x").alias("m"), F.var_pop("x").alias("v"))
    grand = long.groupBy("feature").agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("k"), (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("grand")
    )
    both = long.join(grand, "feature")
    sums = both.groupBy("feature").agg(
        F.sum(F.col("n") * F.pow(F.col("m") - F.col("grand"), 2)).alias("between"),
        F.sum(F.col("n") * F.col("v")).alias("within"), F.max("rows").alias("rows"), F.max("k").alias("k"),
    )
    top = F.try_divide(F.col("between"), F.col("k") - 1)
    bottom = F.try_divide(F.col("within"), F.col("rows") - F.col("k"))
    return sums.select("feature", F.try_divide(top, bottom).alias("f"))


def select_k_best(df: DataFrame, target: str, columns: Sequence[str], k: int = 20) -> DataFrame:
    return anova_f(df, target, columns).orderBy(F.desc_nulls_last("f"), "feature").limit(k)
