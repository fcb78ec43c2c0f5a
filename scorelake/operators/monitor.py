"""Metrics history, alerts, retention and the request limit."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorelake.functions import vocab
from scorelake.operators.drift import recent
from scorelake.operators.joins import compare_metrics
from scorelake.session import landed
from scorelake.sizing import join_lookup
from scorelake.worker import chain_chunks, decide_requests, summarise_chunks

CHUNK_ROWS = 20_000_000
#: History entries that one range partition of ``metric_drops`` holds.
ROWS_PER_PART = 1_000_000
ALL_TIME = 10_000_000_000


def metrics_window(history: DataFrame, days: int, as_of: dt.datetime | None = None) -> DataFrame:
    """History entries of the last ``days``; all of them when days is not positive."""
    return history if days <= 0 else recent(history, days, as_of, "timestamp")


def metrics_wide(history: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """One column per metric, newest first. Known names make the pivot a single aggregate."""
    return history.groupBy("timestamp").pivot("metric", list(metrics)).agg(F.first("value", ignorenulls=True)).orderBy(
        F.desc("timestamp"))


def latest_metrics(history: DataFrame) -> DataFrame:
    newest = history.agg(F.max("timestamp")).scalar()
    return history.where(F.col("timestamp") == newest)


def baseline_delta(current: DataFrame, baseline: DataFrame) -> DataFrame:
    """``(metric, delta)``: current minus baseline; all zero while no baseline is stored."""
    stored = baseline.agg(F.count(F.lit(1))).scalar()
    both = compare_metrics(current, baseline)
    return both.select("metric", F.when(stored == 0, F.lit(0.0)).otherwise(F.col("delta")).alias("delta"))


def alert_rows(df: DataFrame, ts: Column, kind: str, message: Column, details: Mapping[str, Column]) -> DataFrame:
    packed = F.to_json(F.struct(*[c.alias(n) for n, c in details.items()]), {"ignoreNullFields": "false"})
    return df.select(ts.alias("timestamp"), F.lit(kind).alias("type"), message.alias("message"), packed.alias("details"))


def drift_alerts(reports: DataFrame, limit: float = vocab.DRIFT_ALERT_LIMIT) -> DataFrame:
    hot = reports.where(F.col("drift_score") > limit)
    message = F.format_string("Drift detectado com score %.2f", F.col("drift_score"))
    return alert_rows(hot, F.col("timestamp"), "drift", message, {
        "drift_score": F.col("drift_score"), "features_affected": F.col("features_with_drift"),
        "report_timestamp": F.col("timestamp").cast("string"),
    })


def metric_drops(history: DataFrame, metric: str = "accuracy", by: Sequence[str] = (), rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Previous minus current value for every consecutive pair of entries; a missing value counts as 1.

    Entries are range-partitioned by (``by``, time) and landed, so partition numbers stay fixed. Inside a partition the
    previous entry is the one before; the first entry of a partition takes the last entry of the nearest earlier
    partition of its key (one small row per partition and key). No window holds a whole key or the whole history.
    """
    entries = history.groupBy(*by, "timestamp").agg(
        F.max(F.when(F.col("metric") == metric, F.col("value"))).alias("found")
    ).withColumn("value", F.coalesce("found", F.lit(vocab.DEFAULT_BASE_METRIC))).drop("found")
    parts = max(1, -(-entries.count() // max(1, rows_per_part)))
    ranged = landed(entries.repartitionByRange(parts, *by, "timestamp").withColumn("__part", F.spark_partition_id()))
    lasts = ranged.groupBy("__part", *by).agg(F.max_by("value", "timestamp").alias("__last"))
    carried = lasts.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(by)], F.col("__part").alias("__p"),
                           F.lag("__last").over(Window.partitionBy(*by).orderBy("__part")).alias("__carry"))
    same = lambda left, right: functools.reduce(
        lambda a, b: a & b, [left[c].eqNullSafe(right[f"__k{i}"]) for i, c in enumerate(by)], left["__part"] == right["__p"])
    joined = join_lookup(ranged, carried, same, "inner").drop("__p", *[f"__k{i}" for i in range(len(by))])
    before = F.lag("value").over(Window.partitionBy("__part", *by).orderBy("timestamp"))
    pairs = joined.withColumn("previous", F.coalesce(before, F.col("__carry"))).where(F.col("previous").isNotNull())
    return pairs.select(*by, "timestamp", "previous", F.col("value").alias("current"),
                        (F.col("previous") - F.col("value")).alias("drop"))


def metric_drop_alerts(history: DataFrame, limit: float = vocab.ACCURACY_DROP_LIMIT, metric: str = "accuracy",
                       last_only: bool = False) -> DataFrame:
    """Alerts for falls above the limit, over every pair of entries or the newest pair only."""
    pairs = metric_drops(history, metric)
    if last_only:
        newest = history.agg(F.max("timestamp")).scalar()
        pairs = pairs.where(F.col("timestamp") == newest)
    message = F.format_string("Queda na acurácia detectada: %.3f", F.col("drop"))
    return alert_rows(pairs.where(F.col("drop") > limit), F.col("timestamp"), "accuracy", message, {
        "previous_accuracy": F.col("previous"), "current_accuracy": F.col("current"), "drop": F.col("drop"),
        "timestamp": F.col("timestamp").cast("string"),
    })


def service_alerts(rollup: DataFrame, error_limit: float = vocab.ERROR_RATE_LIMIT,
                   latency_limit: float = vocab.LATENCY_LIMIT_MS) -> DataFrame:
    """``(kind, value, limit)`` for an error rate or mean latency above its limit."""
    checks = F.array(
        F.struct(F.lit("error_rate").alias("kind"), F.col("error_rate").alias("value"), F.lit(error_limit).alias("limit")),
        F.struct(F.lit("latency").alias("kind"), F.col("average_latency").alias("value"), F.lit(latency_limit).alias("limit")),
    )
    keep = [c for c in rollup.columns if c not in ("request_count", "error_rate", "average_latency")]
    return rollup.select(*keep, F.inline(checks)).where(F.col("value") > F.col("limit"))


def all_alerts(*alerts: DataFrame) -> DataFrame:
    out = alerts[0]
    for more in alerts[1:]:
        out = out.unionByName(more)
    return out


def recent_alerts(alerts: DataFrame, days: int = 7, as_of: dt.datetime | None = None) -> DataFrame:
    return recent(alerts, days, as_of, "timestamp")


def prune_predictions(log: DataFrame, days: int = 90, as_of: dt.datetime | None = None, ts: str = "timestamp") -> DataFrame:
    """Rows that stay after dropping those older than ``days``."""
    return recent(log, days, as_of, ts)


# Request limit ---------------------------------------------------------------------------------


def role_limit(role: Column, limits: Mapping[str, int] = vocab.ROLE_LIMITS, other: int = vocab.ROLE_LIMIT_OTHER) -> Column:
    chain = None
    for name, n in limits.items():
        chain = F.when(role == name, F.lit(n)) if chain is None else chain.when(role == name, F.lit(n))
    return F.lit(other) if chain is None else chain.otherwise(F.lit(other))


def fixed_window_limit(requests: DataFrame, key: str, ts: str, limit: Column, order: str,
                       window_seconds: int = vocab.LIMIT_WINDOW_SECONDS, chunk_seconds: int | None = None,
                       chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Add ``window_start, position, allowed``: a key's window opens at its first request and closes when
    more than ``window_seconds`` have passed; request number k in it is allowed if k <= limit.

    Each key is read in time order as a stream of rows, so no key is held in memory. A key with more
    than ``chunk_rows`` requests is cut into time chunks that run on different tasks: each chunk is
    summed up as "window closing time on entry -> closing time on exit", those small summaries are
    chained per key, and every chunk then runs on its own from its known entry. ``order`` breaks ties.
    """
    window = window_seconds * 1_000_000
    base = requests.withColumns({
        "__g": F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit("")),
        "__t": F.unix_micros(F.col(ts).cast("timestamp")), "__limit": limit.cast("bigint"),
    })
    span = chunk_seconds or _chunk_span(base, "__g", chunk_rows)
    cut = base.withColumn("__chunk", F.floor(F.col("__t") / F.lit(span * 1_000_000)).cast("bigint"))
    if span < ALL_TIME:
        rows = cut.select("__g", "__chunk", "__t").repartition("__g", "__chunk").sortWithinPartitions("__g", "__chunk", "__t")
        summary = rows.mapInArrow(
            lambda batches: summarise_chunks(batches, window),
            "g string, chunk bigint, n bigint, first bigint, last bigint, upto array<bigint>, close array<bigint>, count array<bigint>")
        entries = summary.repartition("g").sortWithinPartitions("g", "chunk").mapInArrow(
            chain_chunks, "__eg string, __echunk bigint, __open bigint, __used bigint")
        cut = cut.join(entries, (F.col("__g") == F.col("__eg")) & (F.col("__chunk") == F.col("__echunk"))).drop("__eg", "__echunk")
    else:
        cut = cut.withColumns({"__open": F.lit(None).cast("bigint"), "__used": F.lit(0).cast("bigint")})
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in requests.schema.fields)
    ordered = cut.repartition("__g", "__chunk").sortWithinPartitions("__g", "__chunk", "__t", order)
    done = ordered.mapInArrow(
        lambda batches: decide_requests(batches, window), kinds + ", window_start bigint, position bigint, allowed boolean")
    return done.withColumn("window_start", F.timestamp_micros("window_start").cast("timestamp_ntz"))


def _chunk_span(base: DataFrame, key: str, chunk_rows: int) -> int:
    """Chunk length in seconds that keeps the busiest (key, chunk) near ``chunk_rows``.

    One chunk covers all time unless a key is measured to hold more rows than that.
    """
    per_key = base.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min("__t").alias("lo"), F.max("__t").alias("hi"))
    top = per_key.agg(F.max("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).first()
    span, busiest = ALL_TIME, top["n"] or 0
    while busiest > chunk_rows and span > 1:
        whole = min(span, (top["hi"] - top["lo"]) // 1_000_000 + 1)
        span = max(1, int(whole * chunk_rows / (2 * busiest)))
        slot = F.floor(F.col("__t") / F.lit(span * 1_000_000))
        busiest = base.groupBy(key, slot).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    return span
