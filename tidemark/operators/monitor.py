"""Monitoring queries over a request log and over gauge samples.

The log has one row per request: ts, endpoint, method, status, duration_s, cached,
stage, fallback_type, score. Every figure is a grouped or windowed aggregate with
map-side partials over a bounded set of series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.functions.columns import ratio, status_class
from tidemark.functions.timegrid import (
    as_time,
    bucket_counts,
    bucket_quantile,
    bucket_rows,
    exact_quantiles,
    running_by_time,
    sliding,
    step_of,
)

# Histogram bounds in seconds, score bounds, windows and limits.
REQUEST_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)
STAGE_BOUNDS = {
    "recommendation": (0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.0, 5.0),
    "retrieval": (0.001, 0.005, 0.01, 0.025, 0.05, 0.1),
    "ranking": (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5),
}
INFERENCE_BOUNDS = (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0)
CACHE_BOUNDS = (0.001, 0.005, 0.01, 0.025, 0.05, 0.1)
STAGE_QUANTILES = {"recommendation": 0.95, "retrieval": 0.5, "ranking": 0.5}
SCORE_BOUNDS = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
SCORE_MEAN_RANGE = (0.3, 0.9)
QUANTILES = (0.5, 0.95, 0.99)
SLOWEST = 10
FALLBACK_RATE_LIMIT = 0.1
STAGE_SLA_HOURS = {"generate": 2, "extract": 1, "features": 3, "train": 4, "evaluate": 1, "deploy": 1}
MINUTE = 60


def is_server_error(status: Column) -> Column:
    return status_class(status) == "5xx"


def _bucketed(log: DataFrame, width: str) -> Column:
    return F.window("ts", width)["start"].alias("window_start")


# ---------------------------------------------------------------- traffic


def request_counts(log: DataFrame, width: str = "1 hour") -> DataFrame:
    return log.groupBy(_bucketed(log, width), "endpoint", "method", status_class(F.col("status")).alias("status")).agg(
        F.count("*").alias("requests"))


def request_steps(log: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Requests and server errors per grid step and series."""
    return log.groupBy(step_of(F.col("ts")).alias("step"), *keys).agg(
        F.count("*").alias("requests"), F.count_if(is_server_error(F.col("status"))).alias("errors"))


def request_rate(log: DataFrame, window: int = 5 * MINUTE) -> DataFrame:
    """Requests per second of each (endpoint, method, status) series."""
    steps = request_steps(log, ["endpoint", "method", status_class(F.col("status")).alias("status")])
    return sliding(steps, ["endpoint", "method", "status"], {"rate": F.sum("requests")}, window).withColumn("rate", F.col("rate") / window)


def error_rate(log: DataFrame, window: int = 5 * MINUTE) -> DataFrame:
    """Percent of requests that failed with a 5xx status."""
    steps = request_steps(log, [])
    sums = sliding(steps, [], {"errors": F.sum("errors"), "requests": F.sum("requests")}, window)
    return sums.select("eval_at", ratio(F.col("errors") * 100, F.col("requests")).alias("error_percent"))


def recommendations_served(log: DataFrame) -> DataFrame:
    return log.filter(F.col("cached").isNotNull()).groupBy("endpoint", "cached").agg(F.count("*").alias("served"))


def endpoints(log: DataFrame, pattern: str | None = None) -> DataFrame:
    """Distinct endpoints, optionally those fully matching ``pattern``."""
    if pattern is not None:
        log = log.filter(F.col("endpoint").rlike(f"^(?:{pattern})$"))
    return log.select("endpoint").distinct()


def active_requests(log: DataFrame) -> DataFrame:
    """Requests in flight per endpoint and minute: starts, ends, open at the end, and the peak.

    Starts and ends are summed per instant first and then run up in two levels, by
    minute and within a minute.
    """
    ended = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + F.round(F.col("duration_s") * 1_000_000).cast("bigint"))
    moves = F.array(F.struct(F.col("ts").cast("timestamp").alias("at"), F.lit(1).alias("move")),
                    F.struct(ended.alias("at"), F.lit(-1).alias("move")))
    flat = log.select("endpoint", F.explode(moves).alias("_m")).select("endpoint", "_m.at", "_m.move")
    instants = flat.groupBy("endpoint", "at").agg(
        F.sum("move").alias("move"), F.count_if(F.col("move") > 0).alias("starts"), F.count_if(F.col("move") < 0).alias("ends"))
    minute = F.date_trunc("minute", "at")
    open_now = running_by_time(instants, ["endpoint"], "at", minute, "move", "active")
    return open_now.groupBy("endpoint", minute.cast("timestamp_ntz").alias("minute")).agg(
        F.sum("starts").alias("starts"), F.sum("ends").alias("ends"), F.max_by("active", "at").alias("active_at_end"),
        F.max("active").alias("peak"))


# ---------------------------------------------------------------- latency


def latency_histogram(log: DataFrame, keys: Sequence[str | Column] = ("endpoint",), bounds: Sequence[float] = REQUEST_BOUNDS) -> DataFrame:
    """Cumulative counts per upper bound and series."""
    counted = log.groupBy(*keys).agg(bucket_counts(F.col("duration_s"), bounds).alias("counts"))
    return bucket_rows(counted, "counts", bounds)


def inference_histogram(log: DataFrame) -> DataFrame:
    """Durations of each model stage, as cumulative counts per upper bound and stage."""
    return latency_histogram(log.filter(F.col("stage").isNotNull()), ["stage"], INFERENCE_BOUNDS)


def cache_histogram(log: DataFrame) -> DataFrame:
    """Durations of cache operations per endpoint: a hit is a ``get``, a miss a ``set``."""
    operation = F.when(F.col("cached"), "get").otherwise("set").alias("operation")
    return latency_histogram(log.filter(F.col("cached").isNotNull()), [operation, "endpoint"], CACHE_BOUNDS)


def histogram_quantiles(
    log: DataFrame, keys: Sequence[str | Column] = ("endpoint",), quantiles: Sequence[float] = QUANTILES,
    bounds: Sequence[float] = REQUEST_BOUNDS,
) -> DataFrame:
    """Quantiles read off the histogram, one column ``p<percent>`` each."""
    counted = log.groupBy(*keys).agg(bucket_counts(F.col("duration_s"), bounds).alias("counts"))
    named = {f"p{int(round(q * 100))}": bucket_quantile(F.col("counts"), q, bounds) for q in quantiles}
    return counted.withColumns(named).drop("counts")


def latency_percentiles(log: DataFrame, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """Exact quantiles per endpoint from the raw durations."""
    return exact_quantiles(log.select("endpoint", "duration_s"), "endpoint", "duration_s", quantiles)


def slowest_endpoints(log: DataFrame, n: int = SLOWEST) -> DataFrame:
    return histogram_quantiles(log, quantiles=(0.95,)).orderBy(F.desc("p95"), "endpoint").limit(n)


def windowed_quantiles(log: DataFrame, width: str = "1 day", quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """Histogram quantiles of each endpoint in each window of the log."""
    return histogram_quantiles(log, [_bucketed(log, width), "endpoint"], quantiles)


def latency_breakdown(log: DataFrame) -> DataFrame:
    """The watched quantile of each stage at each endpoint, all stages in one pass."""
    counts = [bucket_counts(F.when(F.col("stage") == s, F.col("duration_s")), b).alias(s) for s, b in STAGE_BOUNDS.items()]
    rows = [F.struct(F.lit(s).alias("stage"), F.lit(STAGE_QUANTILES[s]).alias("quantile"),
                     bucket_quantile(F.col(s), STAGE_QUANTILES[s], b).alias("seconds")) for s, b in STAGE_BOUNDS.items()]
    unfolded = log.groupBy("endpoint").agg(*counts).select("endpoint", F.explode(F.array(*rows)).alias("_r"))
    return unfolded.select("endpoint", "_r.*").filter(F.col("seconds").isNotNull())


# ---------------------------------------------------------------- cache, fallback, scores


def cache_hit_rate(log: DataFrame, width: str = "1 day") -> DataFrame:
    """Hits, misses, operations and the hit rate (0 without operations) per window."""
    hits, misses = F.count_if(F.col("cached")), F.count_if(~F.col("cached"))
    return log.groupBy(_bucketed(log, width)).agg(
        hits.alias("hits"), misses.alias("misses"), (hits + misses).alias("operations"),
        F.coalesce(ratio(hits, hits + misses), F.lit(0.0)).alias("hit_rate"))


def fallback_usage(log: DataFrame, window: int = 10 * MINUTE) -> DataFrame:
    """Fallbacks per second of each (type, endpoint), and whether that is too many."""
    used = log.filter(F.col("fallback_type").isNotNull())
    steps = request_steps(used, ["fallback_type", "endpoint"])
    used = sliding(steps, ["fallback_type", "endpoint"], {"used": F.sum("requests")}, window)
    rates = used.withColumn("rate", F.col("used") / window)
    return rates.withColumn("frequent", F.col("rate") > FALLBACK_RATE_LIMIT)


def score_distribution(log: DataFrame, width: str = "1 day") -> DataFrame:
    """Score histogram per window, with the mean and whether it is out of range."""
    scored = log.filter(F.col("score").isNotNull())
    counted = scored.groupBy(_bucketed(log, width)).agg(
        bucket_counts(F.col("score"), SCORE_BOUNDS).alias("counts"), F.avg("score").alias("mean_score"))
    flagged = counted.withColumn("anomaly", ~F.col("mean_score").between(*SCORE_MEAN_RANGE))
    return bucket_rows(flagged, "counts", SCORE_BOUNDS)


# ---------------------------------------------------------------- gauges, summaries, runs


def gauge_steps(samples: DataFrame) -> DataFrame:
    """Samples of each (metric, instance) folded to grid steps.

    ``rise`` is what a counter grew by up to and in the step: a value below the one
    before it is a restart from 0, so it counts whole. A step's samples are few.
    """
    order = F.sort_array(F.collect_list(F.struct("ts", "value")))
    folded = samples.filter("value IS NOT NULL").groupBy(step_of(F.col("ts")).alias("step"), "metric", "instance").agg(
        F.max(F.struct("ts", "value")).alias("latest"), F.sum("value").alias("total"), F.count("value").alias("n"),
        F.min("value").alias("low"), F.max("value").alias("high"), order.alias("_seen"))
    before = F.lag(F.col("latest.value")).over(W.partitionBy("metric", "instance").orderBy("step"))

    def grown(was: Column, now: Column) -> Column:
        return F.when(was.isNull(), 0.0).when(now >= was, now - was).otherwise(now)

    start = F.struct(F.col("_before").alias("was"), F.lit(0.0).alias("rise"))
    rise = F.aggregate("_seen", start, lambda a, s: F.struct(
        s["value"].cast("double").alias("was"), (a["rise"] + grown(a["was"], s["value"])).alias("rise")), lambda a: a["rise"])
    return folded.withColumn("_before", before.cast("double")).withColumn("rise", rise).drop("_seen", "_before")


def slide_gauges(steps: DataFrame, window: int) -> DataFrame:
    moved = sliding(steps, ["metric", "instance"], {
        "latest": F.max("latest"), "total": F.sum("total"), "n": F.sum("n"), "low": F.min("low"), "high": F.max("high")}, window)
    return moved.select("eval_at", "metric", "instance", F.col("latest.value").alias("last_value"),
                        ratio(F.col("total"), F.col("n")).alias("mean_value"), "low", "high")


def gauge_windows(samples: DataFrame, window: int) -> DataFrame:
    """Last, mean, lowest and highest sample of each (metric, instance) over a sliding window."""
    return slide_gauges(gauge_steps(samples), window)


def series_summary(series: DataFrame, keys: Sequence[str], value: str, at: str) -> DataFrame:
    """Mean, max, sum and last non-null value of each series."""
    last = F.max_by(value, F.when(F.col(value).isNotNull(), F.col(at)))
    return series.groupBy(*keys).agg(
        F.avg(value).alias("mean"), F.max(value).alias("max"), F.sum(value).alias("sum"), last.alias("last"))


def sla_misses(runs: DataFrame) -> DataFrame:
    """Stage runs (run_id, stage, seconds) longer than their stage may take."""
    allowed = F.create_map(*[F.lit(x) for pair in STAGE_SLA_HOURS.items() for x in pair])
    limit = (F.try_element_at(allowed, F.col("stage")) * 3600).cast("double")
    return runs.withColumn("limit_seconds", limit).filter(F.col("seconds") > F.col("limit_seconds"))


def cache_lost(log: DataFrame, window: int = 5 * MINUTE) -> DataFrame:
    """Windows with health checks and whether they saw no cache operation at all."""
    steps = log.groupBy(step_of(F.col("ts")).alias("step")).agg(
        F.count_if(F.col("endpoint") == "/health").alias("health"), F.count("cached").alias("operations"))
    counts = sliding(steps, [], {"health": F.sum("health"), "operations": F.sum("operations")}, window)
    return counts.filter("health > 0").withColumn("lost", F.col("operations") == 0)


def timed(evaluated: DataFrame) -> DataFrame:
    """Grid seconds as timestamps."""
    return evaluated.withColumn("eval_at", as_time(F.col("eval_at")))
