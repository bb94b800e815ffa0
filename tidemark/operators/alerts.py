"""Alert rules as data: metrics on a time grid, breaches, firing alerts and routing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tidemark.functions.columns import micros, ratio
from tidemark.functions.timegrid import STEP_SECONDS, bucket_counts, bucket_quantile_of, running_by_time, sliding, step_of
from tidemark.operators.monitor import MINUTE, REQUEST_BOUNDS, STAGE_BOUNDS, gauge_steps, is_server_error, slide_gauges
from tidemark.session import stage

# Name, test, threshold(s), seconds it must hold, severity, component.
# ``outside`` means below the first threshold or above the second.
RULES = (
    ("HighErrorRate", ">", 5.0, None, 300, "critical", "api"),
    ("ServiceDown", "==", 0.0, None, 60, "critical", "api"),
    ("RedisConnectionFailure", ">", 0.0, None, 300, "critical", "cache"),
    ("HighLatency", ">", 0.2, None, 300, "warning", "api"),
    ("LowCacheHitRate", "<", 0.30, None, 600, "warning", "cache"),
    ("ModelScoreAnomaly", "outside", 0.3, 0.9, 600, "warning", "model"),
    ("HighActiveConnections", ">", 150.0, None, 300, "warning", "api"),
    ("SlowRecommendationGeneration", ">", 0.5, None, 300, "warning", "recommendations"),
    ("FrequentFallbackUsage", ">", 0.1, None, 600, "warning", "recommendations"),
    ("HighMemoryUsage", ">", 90.0, None, 300, "warning", "system"),
    ("HighCPUUsage", ">", 90.0, None, 300, "warning", "system"),
    ("ContainerRestartLoop", ">", 3.0, None, 900, "warning", "system"),
    ("LowRequestRate", "<", 1.0, None, 600, "warning", "api"),
)
RULE_SCHEMA = (
    "alertname string, test string, threshold double, threshold_high double, hold_seconds bigint, severity string, component string"
)


def rules(spark: SparkSession, rows: Sequence[tuple] = RULES) -> DataFrame:
    return spark.createDataFrame(list(rows), RULE_SCHEMA)


def _series(df: DataFrame, alertname: str, value: str, *labels: str) -> DataFrame:
    series = F.concat_ws(",", *labels) if labels else F.lit("")
    return df.select(F.lit(alertname).alias("alertname"), series.alias("series"), "eval_at", F.col(value).cast("double").alias("value"))


def _several(df: DataFrame, values: dict[str, Column], series: Column) -> DataFrame:
    """Figures of several rules from the same rows; a rule has none where its value is null."""
    each = [F.when(v.isNotNull(), F.struct(F.lit(n).alias("alertname"), v.cast("double").alias("value"))) for n, v in values.items()]
    flat = df.select("eval_at", series.alias("series"), F.explode(F.array_compact(F.array(*each))).alias("_m"))
    return flat.select("_m.alertname", "series", "eval_at", "_m.value")


def step_totals(log: DataFrame) -> DataFrame:
    """Everything the request rules need, in one pass over the log.

    One row per (step, endpoint, fallback type): the raw log may be huge, this table
    only grows with the time covered and the number of endpoints.
    """
    made = F.when(F.col("stage") == "recommendation", F.col("duration_s"))
    return log.groupBy(step_of(F.col("ts")).alias("step"), "endpoint", "fallback_type").agg(
        F.count("*").alias("requests"),
        F.count_if(is_server_error(F.col("status"))).alias("errors"),
        F.count_if("cached").alias("hits"),
        F.count("cached").alias("operations"),
        F.sum("score").alias("score_sum"),
        F.count("score").alias("scores"),
        bucket_counts(F.col("duration_s"), REQUEST_BOUNDS).alias("latency"),
        bucket_counts(made, STAGE_BOUNDS["recommendation"]).alias("made"),
    )


def whole_steps(totals: DataFrame) -> DataFrame:
    """The step totals of all endpoints together, for the rules without labels."""
    made = len(STAGE_BOUNDS["recommendation"]) + 1
    plain = ("requests", "errors", "hits", "operations", "score_sum", "scores")
    return totals.groupBy("step").agg(
        *[F.sum(c).alias(c) for c in plain],
        F.sum(F.when(F.col("endpoint") == "/health", F.col("requests"))).alias("health"),
        F.array(*[F.sum(F.get("made", F.lit(i))) for i in range(made)]).alias("made"))


def low_request_rate(totals: DataFrame, window: int = 10 * MINUTE) -> DataFrame:
    """Requests per second at every grid step from the first to the last; silence counts as 0."""
    counts = sliding(totals.select("step", "requests"), [], {"requests": F.sum("requests")}, window)
    span = totals.agg(F.min("step").alias("first"), F.max("step").alias("last"))
    day = F.lit(86_400).cast("bigint")  # by days first, so that no row holds the whole time
    days = span.select("last", F.explode(F.sequence("first", "last", day)).alias("from"))
    until = F.least(F.col("from") + day - STEP_SECONDS, F.col("last"))
    grid = days.select(F.explode(F.sequence("from", until, F.lit(STEP_SECONDS).cast("bigint"))).alias("eval_at"))
    return grid.join(counts, "eval_at", "left").select("eval_at", (F.coalesce("requests", F.lit(0)) / window).alias("rate"))


def active_at_steps(log: DataFrame) -> DataFrame:
    """Requests in flight at each grid step where that number changed, run up day by day."""
    start = micros(F.col("ts"))
    end = start + F.round(F.col("duration_s") * 1_000_000).cast("bigint")
    size = F.lit(STEP_SECONDS * 1_000_000.0)
    moves = F.array(*[F.struct((F.ceil(at / size) * STEP_SECONDS).cast("bigint").alias("eval_at"), F.lit(m).alias("move"))
                      for at, m in ((start, 1), (end, -1))])
    steps = log.select(F.explode(moves).alias("_m")).groupBy("_m.eval_at").agg(F.sum("_m.move").alias("move"))
    day = F.floor(F.col("eval_at") / 86400)
    return running_by_time(steps, [], "eval_at", day, "move", "active").select("eval_at", "active")


def _buckets(counts: str, bounds: Sequence[float]) -> dict[str, Column]:
    return {f"_c{i}": F.sum(F.get(counts, F.lit(i))) for i in range(len(bounds) + 1)}


def _p95(buckets: dict[str, Column], bounds: Sequence[float]) -> Column:
    """Null without observations."""
    return bucket_quantile_of([F.col(c) for c in buckets], 0.95, bounds)


def request_metrics(totals: DataFrame) -> list[DataFrame]:
    """The figures of the request rules, all from the step totals; rules with one window and
    one set of labels share its pass."""
    short, middle, long = 5 * MINUTE, 10 * MINUTE, 30 * MINUTE
    whole, none = stage(whole_steps(totals), "whole-steps"), F.lit("")
    latency, made = _buckets("latency", REQUEST_BOUNDS), _buckets("made", STAGE_BOUNDS["recommendation"])

    def sums(rows: DataFrame, window: int, *columns: str, keys: Sequence[str] = (), **more: Column) -> DataFrame:
        return sliding(rows, keys, {c: F.sum(c) for c in columns} | more, window)

    recent = sums(whole.select("step", "errors", "requests", "health", "operations", "made"), short, "errors", "requests", "health", "operations", **made)
    by_endpoint = sliding(totals.select("step", "endpoint", "latency"), ["endpoint"], latency, short)
    hits = sums(whole.filter("operations > 0").select("step", "hits", "operations"), middle, "hits", "operations")
    scores = sums(whole.filter("scores > 0").select("step", "score_sum", "scores"), long, "score_sum", "scores")
    labels = ["fallback_type", "endpoint"]
    used = sums(totals.filter("fallback_type IS NOT NULL").select("step", *labels, "requests"), middle, "requests", keys=labels)
    return [
        _several(recent, {
            "HighErrorRate": ratio(F.col("errors") * 100, F.col("requests")),
            "RedisConnectionFailure": F.when(F.col("health") > 0, (F.col("operations") == 0).cast("int")),
            "SlowRecommendationGeneration": _p95(made, STAGE_BOUNDS["recommendation"]),
        }, none),
        _several(by_endpoint, {"HighLatency": _p95(latency, REQUEST_BOUNDS)}, F.concat_ws(",", "endpoint")),
        _series(hits.withColumn("rate", ratio(F.col("hits"), F.col("operations"))), "LowCacheHitRate", "rate"),
        _series(scores.withColumn("mean", ratio(F.col("score_sum"), F.col("scores"))), "ModelScoreAnomaly", "mean"),
        _series(used.withColumn("rate", F.col("requests") / middle), "FrequentFallbackUsage", "rate", *labels),
        _series(low_request_rate(whole), "LowRequestRate", "rate"),
    ]


def gauge_metrics(steps: DataFrame) -> list[DataFrame]:
    """The figures of the host rules, from the gauge steps."""
    metric, short = F.col("metric"), slide_gauges(steps.filter(F.col("metric").isin("up", "memory_percent", "cpu_percent")), 5 * MINUTE)
    restarts = sliding(steps.filter(metric == "restarts").select("step", "instance", "rise"), ["instance"], {"grown": F.sum("rise")}, 15 * MINUTE)
    cpu = short.filter(metric == "cpu_percent").groupBy("eval_at").agg(F.avg("mean_value").alias("mean_value"))
    hosts = short.filter(metric.isin("up", "memory_percent"))
    return [
        _several(hosts, {
            "ServiceDown": F.when(metric == "up", F.col("last_value")), "HighMemoryUsage": F.when(metric == "memory_percent", F.col("last_value")),
        }, F.concat_ws(",", "instance")),
        _series(cpu, "HighCPUUsage", "mean_value"),
        _series(restarts, "ContainerRestartLoop", "grown", "instance"),
    ]


def alert_metrics(log: DataFrame, gauges: DataFrame) -> DataFrame:
    """The figure each rule tests: (alertname, series, eval_at, value), long form.

    The step tables are staged, so thirteen rules read the raw log twice (once for
    its totals, once for requests in flight) and the samples once.
    """
    totals, samples = stage(step_totals(log), "request-steps"), stage(gauge_steps(gauges), "gauge-steps")
    active = _series(active_at_steps(log), "HighActiveConnections", "active")
    return reduce(DataFrame.unionByName, [*request_metrics(totals), *gauge_metrics(samples), active])


def breaches(metrics: DataFrame, rule_rows: DataFrame) -> DataFrame:
    """Every metric row with its rule and whether it breaks it. Rules are a fixed short table."""
    v, low, high = F.col("value"), F.col("threshold"), F.col("threshold_high")
    broken = (
        F.when(F.col("test") == ">", v > low).when(F.col("test") == "<", v < low).when(F.col("test") == "==", v == low)
        .when(F.col("test") == "outside", (v < low) | (v > high))
    )
    return metrics.join(F.broadcast(rule_rows), "alertname").withColumn("breached", F.coalesce(broken, F.lit(False)))


def firing(breached: DataFrame, step: int = STEP_SECONDS) -> DataFrame:
    """Rows at which an alert fires: breached at every grid step for its hold time.

    A streak is a run of breached steps without a gap; a missing step ends it. The
    window holds the grid steps of one series, whose number depends on the time
    covered and not on the traffic.
    """
    bad = breached.filter("breached")
    order = W.partitionBy("alertname", "series").orderBy("eval_at")
    streak = F.col("eval_at") - F.row_number().over(order) * step
    marked = bad.withColumn("_streak", streak)
    since = F.min("eval_at").over(W.partitionBy("alertname", "series", "_streak"))
    return marked.withColumn("active_since", since).filter(F.col("eval_at") - F.col("active_since") >= F.col("hold_seconds")).drop("_streak")


def route(fired: DataFrame) -> DataFrame:
    """Drop inhibited alerts and group the rest: (eval_at, alertname, severity, component, alerts).

    A critical alert hides warnings of the same name and component; ServiceDown
    hides every other alert.
    """
    critical = fired.filter("severity = 'critical'").select("eval_at", "alertname", "component", F.lit("warning").alias("severity")).distinct()
    down = fired.filter("alertname = 'ServiceDown'").select("eval_at").distinct()
    heard = fired.join(critical, ["eval_at", "alertname", "component", "severity"], "left_anti")
    others = heard.filter("alertname <> 'ServiceDown'").join(down, "eval_at", "left_anti")
    kept = heard.filter("alertname = 'ServiceDown'").unionByName(others)
    return kept.groupBy("eval_at", "alertname", "severity", "component").agg(F.count("*").alias("alerts"))
