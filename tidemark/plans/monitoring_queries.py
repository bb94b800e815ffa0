"""Monitoring, alerting and profile queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.timegrid import as_time
from tidemark.operators import alerts, monitor, profile, sketches
from tidemark.plans.check_tables import add_table
from tidemark.plans.feature_queries import rounded
from tidemark.plans.registry import query
from tidemark.plans.tables import Tables

_STEP = "(ceil(epoch_us(ts) / 30000000.0::DOUBLE) * 30)::BIGINT AS step"
_CLASS = "(status // 100)::VARCHAR || 'xx'"
add_table("req_steps", f"SELECT *, {_STEP} FROM requests")
add_table("gauge_steps", f"SELECT *, {_STEP} FROM gauges")


def _at(seconds: str = "step + 30 * i") -> str:
    return f"make_timestamp(({seconds}) * 1000000)"


def timed(df: DataFrame) -> DataFrame:
    return rounded(monitor.timed(df))


# ---------------------------------------------------------------- traffic


@query("request_counts", f"""SELECT date_trunc('hour', ts) AS window_start, endpoint, method, {_CLASS} AS status, count(*) AS requests
    FROM requests GROUP BY 1, 2, 3, 4""")
def request_counts(t: Tables) -> DataFrame:
    out = monitor.request_counts(t.requests)
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("request_rate", f"""SELECT {_at()} AS eval_at, endpoint, method, {_CLASS} AS status, round(count(*) / 300.0::DOUBLE, 6) AS rate
    FROM req_steps, range(0, 10) r(i) GROUP BY 1, 2, 3, 4""")
def request_rate(t: Tables) -> DataFrame:
    return timed(monitor.request_rate(t.requests))


@query("error_rate", f"""SELECT {_at()} AS eval_at, round(100.0::DOUBLE * count(*) FILTER (status BETWEEN 500 AND 599) / count(*), 6)
      AS error_percent FROM req_steps, range(0, 10) r(i) GROUP BY 1""")
def error_rate(t: Tables) -> DataFrame:
    return timed(monitor.error_rate(t.requests))


@query("recs_served", "SELECT endpoint, cached, count(*) AS served FROM requests WHERE cached IS NOT NULL GROUP BY 1, 2")
def recs_served(t: Tables) -> DataFrame:
    return monitor.recommendations_served(t.requests)


@query("endpoint_list", "SELECT DISTINCT endpoint FROM requests WHERE regexp_full_match(endpoint, '/(events|health).*')")
def endpoint_list(t: Tables) -> DataFrame:
    return monitor.endpoints(t.requests, "/(events|health).*")


@query("active_requests", """
    WITH moves AS (SELECT endpoint, ts AS moment, 1 AS move FROM requests
      UNION ALL SELECT endpoint, ts + to_microseconds(round(duration_s * 1000000)::BIGINT), -1 FROM requests),
    instants AS (SELECT endpoint, moment, sum(move) AS move, count(*) FILTER (move > 0) AS starts, count(*) FILTER (move < 0) AS ends
      FROM moves GROUP BY endpoint, moment),
    open_now AS (SELECT *, sum(move) OVER (PARTITION BY endpoint ORDER BY moment) AS active FROM instants)
    SELECT endpoint, date_trunc('minute', moment) AS minute, sum(starts)::BIGINT AS starts, sum(ends)::BIGINT AS ends,
      arg_max(active, moment)::BIGINT AS active_at_end, max(active)::BIGINT AS peak FROM open_now GROUP BY 1, 2""")
def active_requests(t: Tables) -> DataFrame:
    return monitor.active_requests(t.requests)


# ---------------------------------------------------------------- latency


def counts_sql(value: str, bounds: tuple, having: str = "true") -> str:
    return "[" + ", ".join(f"count(*) FILTER ({having} AND {value} <= {b})" for b in bounds) + f", count({value}) FILTER ({having})]"


def quantile_sql(counted: str, keys: str, q: float, bounds: tuple) -> str:
    """(keys, v): the quantile of rows (keys, c) where c lists cumulative counts."""
    ups, lows = ", ".join(f"{b}::DOUBLE" for b in bounds), ", ".join(f"{b}::DOUBLE" for b in (0.0, *bounds))
    partition = f"PARTITION BY {keys}" if keys else ""
    return f"""
      SELECT {keys + "," if keys else ""} CASE WHEN le IS NULL THEN lower_end ELSE lower_end + (le - lower_end) * ({q}::DOUBLE * total - prev) / (cum - prev) END AS v
      FROM (SELECT {keys + "," if keys else ""} unnest(c) AS cum, unnest([{ups}, NULL]) AS le, unnest([{lows}]) AS lower_end,
              unnest(list_prepend(0::BIGINT, c[:-2])) AS prev, c[len(c)] AS total FROM ({counted}))
      WHERE total > 0 AND cum >= {q}::DOUBLE * total
      QUALIFY row_number() OVER ({partition} ORDER BY le NULLS LAST) = 1"""


_BY_ENDPOINT = f"SELECT endpoint, {counts_sql('duration_s', monitor.REQUEST_BOUNDS)} AS c FROM requests GROUP BY endpoint"


@query("latency_histogram", f"""
    SELECT endpoint, unnest([{", ".join(f"{b}::DOUBLE" for b in monitor.REQUEST_BOUNDS)}, 'inf'::DOUBLE]) AS le, unnest(c) AS cumulative
    FROM ({_BY_ENDPOINT})""")
def latency_histogram(t: Tables) -> DataFrame:
    return monitor.latency_histogram(t.requests)


def _histogram_sql(keys: str, columns: str, where: str, bounds: tuple) -> str:
    labels = ", ".join(f"{b}::DOUBLE" for b in bounds)
    return f"""SELECT {columns}, unnest([{labels}, 'inf'::DOUBLE]) AS le, unnest(c) AS cumulative
      FROM (SELECT {keys}, {counts_sql('duration_s', bounds)} AS c FROM requests WHERE {where} GROUP BY ALL)"""


@query("inference_histogram", _histogram_sql("stage", "stage", "stage IS NOT NULL", monitor.INFERENCE_BOUNDS))
def inference_histogram(t: Tables) -> DataFrame:
    return monitor.inference_histogram(t.requests)


@query("cache_histogram", _histogram_sql(
    "CASE WHEN cached THEN 'get' ELSE 'set' END AS operation, endpoint", "operation, endpoint", "cached IS NOT NULL", monitor.CACHE_BOUNDS))
def cache_histogram(t: Tables) -> DataFrame:
    return monitor.cache_histogram(t.requests)


@query("histogram_quantile", f"""
    SELECT endpoint, round(a.v, 6) AS p50, round(b.v, 6) AS p95, round(d.v, 6) AS p99
    FROM ({quantile_sql(_BY_ENDPOINT, "endpoint", 0.5, monitor.REQUEST_BOUNDS)}) a
    JOIN ({quantile_sql(_BY_ENDPOINT, "endpoint", 0.95, monitor.REQUEST_BOUNDS)}) b USING (endpoint)
    JOIN ({quantile_sql(_BY_ENDPOINT, "endpoint", 0.99, monitor.REQUEST_BOUNDS)}) d USING (endpoint)""")
def histogram_quantile(t: Tables) -> DataFrame:
    return rounded(monitor.histogram_quantiles(t.requests))


@query("latency_percentiles", """
    SELECT endpoint, quantile, round(CASE quantile WHEN 0.5 THEN q[1] WHEN 0.95 THEN q[2] ELSE q[3] END, 6) AS duration_s
    FROM (SELECT endpoint, quantile_cont(duration_s, [0.5, 0.95, 0.99]) AS q FROM requests GROUP BY endpoint),
      (VALUES (0.5::DOUBLE), (0.95::DOUBLE), (0.99::DOUBLE)) v(quantile)""")
def latency_percentiles(t: Tables) -> DataFrame:
    return rounded(monitor.latency_percentiles(t.requests))


@query("slowest_endpoints", f"""SELECT endpoint, round(v, 6) AS p95 FROM ({quantile_sql(_BY_ENDPOINT, "endpoint", 0.95, monitor.REQUEST_BOUNDS)})
    ORDER BY v DESC, endpoint LIMIT 10""")
def slowest_endpoints(t: Tables) -> DataFrame:
    return rounded(monitor.slowest_endpoints(t.requests))


def _stage_sql(stage: str) -> str:
    bounds, q = monitor.STAGE_BOUNDS[stage], monitor.STAGE_QUANTILES[stage]
    counted = f"SELECT endpoint, {counts_sql('duration_s', bounds, chr(39).join(('stage = ', stage, '')))} AS c FROM requests GROUP BY endpoint"
    return f"SELECT endpoint, '{stage}' AS stage, {q}::DOUBLE AS quantile, round(v, 6) AS seconds FROM ({quantile_sql(counted, 'endpoint', q, bounds)})"


@query("latency_breakdown", " UNION ALL ".join(_stage_sql(s) for s in monitor.STAGE_BOUNDS))
def latency_breakdown(t: Tables) -> DataFrame:
    return rounded(monitor.latency_breakdown(t.requests))


_BY_DAY = f"""SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, endpoint, {counts_sql('duration_s', monitor.REQUEST_BOUNDS)} AS c
    FROM requests GROUP BY 1, 2"""


@query("windowed_quantiles", "SELECT window_start, endpoint, " + ", ".join(
    f"round(max(v) FILTER (q = {p}), 6) AS p{p}" for p in (50, 95, 99)) + " FROM (" + " UNION ALL ".join(
    f"SELECT *, {p} AS q FROM ({quantile_sql(_BY_DAY, 'window_start, endpoint', p / 100, monitor.REQUEST_BOUNDS)})" for p in (50, 95, 99))
    + ") GROUP BY 1, 2")
def windowed_quantiles(t: Tables) -> DataFrame:
    return rounded(monitor.windowed_quantiles(t.requests))


# ---------------------------------------------------------------- cache, fallback, scores


@query("cache_hit_rate", """
    SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, count(*) FILTER (cached) AS hits, count(*) FILTER (NOT cached) AS misses,
      count(cached) AS operations, round(CASE WHEN count(cached) = 0 THEN 0 ELSE count(*) FILTER (cached) / count(cached)::DOUBLE END, 6)::DOUBLE
      AS hit_rate FROM requests GROUP BY 1""")
def cache_hit_rate(t: Tables) -> DataFrame:
    return rounded(monitor.cache_hit_rate(t.requests).withColumn("window_start", F.col("window_start").cast("timestamp_ntz")))


@query("fallback_usage", f"""
    SELECT {_at()} AS eval_at, fallback_type, endpoint, count(*) AS used, round(count(*) / 600.0::DOUBLE, 6) AS rate,
      count(*) / 600.0::DOUBLE > 0.1 AS frequent
    FROM req_steps, range(0, 20) r(i) WHERE fallback_type IS NOT NULL GROUP BY 1, 2, 3""")
def fallback_usage(t: Tables) -> DataFrame:
    return timed(monitor.fallback_usage(t.requests))


@query("score_distribution", f"""
    SELECT window_start, round(mean_score, 6) AS mean_score, mean_score < 0.3 OR mean_score > 0.9 AS anomaly,
      unnest([{", ".join(f"{b}::DOUBLE" for b in monitor.SCORE_BOUNDS)}, 'inf'::DOUBLE]) AS le, unnest(c) AS cumulative
    FROM (SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, avg(score) AS mean_score, {counts_sql('score', monitor.SCORE_BOUNDS)} AS c
          FROM requests WHERE score IS NOT NULL GROUP BY 1)""")
def score_distribution(t: Tables) -> DataFrame:
    out = monitor.score_distribution(t.requests)
    return rounded(out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")))


@query("cache_lost", f"""
    SELECT {_at()} AS eval_at, count(*) FILTER (endpoint = '/health') AS health, count(cached) AS operations, count(cached) = 0 AS lost
    FROM req_steps, range(0, 10) r(i) GROUP BY 1 HAVING count(*) FILTER (endpoint = '/health') > 0""")
def cache_lost(t: Tables) -> DataFrame:
    return timed(monitor.cache_lost(t.requests))


# ---------------------------------------------------------------- gauges, summaries, runs


@query("gauge_rules", f"""
    SELECT {_at()} AS eval_at, metric, instance, arg_max(value, ts) AS last_value, round(avg(value), 6) AS mean_value,
      min(value) AS low, max(value) AS high
    FROM gauge_steps, range(0, 10) r(i) GROUP BY 1, 2, 3""")
def gauge_rules(t: Tables) -> DataFrame:
    return timed(monitor.gauge_windows(t.gauges, 300))


@query("series_summary", """
    SELECT endpoint, round(avg(requests), 6) AS mean, max(requests) AS max, sum(requests)::BIGINT AS sum, arg_max(requests, hour) AS last
    FROM (SELECT endpoint, date_trunc('hour', ts) AS hour, count(*) AS requests FROM requests GROUP BY 1, 2) GROUP BY endpoint""")
def series_summary(t: Tables) -> DataFrame:
    hourly = t.requests.groupBy("endpoint", F.date_trunc("hour", "ts").alias("hour")).agg(F.count("*").alias("requests"))
    return rounded(monitor.series_summary(hourly, ["endpoint"], "requests", "hour"))


@query("sla_misses", """
    SELECT run_id, stage, round(seconds, 6) AS seconds, limit_seconds FROM (
      SELECT event_id AS run_id, value * 60 AS seconds,
        CASE event_type WHEN 'click' THEN 'generate' WHEN 'view' THEN 'extract' WHEN 'purchase' THEN 'features'
          WHEN 'signup' THEN 'evaluate' ELSE 'train' END AS stage,
        CASE event_type WHEN 'click' THEN 7200 WHEN 'view' THEN 3600 WHEN 'purchase' THEN 10800 WHEN 'signup' THEN 3600
          ELSE 14400 END::DOUBLE AS limit_seconds FROM events) WHERE seconds > limit_seconds""")
def sla_misses(t: Tables) -> DataFrame:
    """Events stand for stage runs."""
    kind = F.col("event_type")
    stage = (F.when(kind == "click", "generate").when(kind == "view", "extract").when(kind == "purchase", "features")
             .when(kind == "signup", "evaluate").otherwise("train"))
    runs = t.raw("events").select(F.col("event_id").alias("run_id"), stage.alias("stage"), (F.col("value") * 60).alias("seconds"))
    return rounded(monitor.sla_misses(runs))


# ---------------------------------------------------------------- alerts


def _p95_sql(where: str, keys: str, bounds: tuple) -> str:
    inner = ("endpoint, " if keys else "") + "step + 30 * i AS eval_at"
    counted = f"SELECT {inner}, {counts_sql('duration_s', bounds)} AS c FROM req_steps, range(0, 10) r(i) WHERE {where} GROUP BY ALL"
    return quantile_sql(counted, "endpoint, eval_at" if keys else "eval_at", 0.95, bounds)


_T = "step + 30 * i AS eval_at"
add_table("alert_values", f"""
    SELECT 'HighErrorRate' AS alertname, '' AS series, {_T}, 100.0::DOUBLE * count(*) FILTER (status >= 500) / count(*) AS value
      FROM req_steps, range(0, 10) r(i) GROUP BY 3
    UNION ALL SELECT 'ServiceDown', instance, {_T}, arg_max(value, ts) FROM gauge_steps, range(0, 10) r(i) WHERE metric = 'up' GROUP BY 2, 3
    UNION ALL SELECT 'RedisConnectionFailure', '', {_T}, (count(cached) = 0)::INTEGER::DOUBLE FROM req_steps, range(0, 10) r(i)
      GROUP BY 3 HAVING count(*) FILTER (endpoint = '/health') > 0
    UNION ALL SELECT 'HighLatency', endpoint, eval_at, v FROM ({_p95_sql("true", "endpoint", monitor.REQUEST_BOUNDS)})
    UNION ALL SELECT 'LowCacheHitRate', '', {_T}, (count(*) FILTER (cached))::DOUBLE / count(cached) FROM req_steps, range(0, 20) r(i)
      WHERE cached IS NOT NULL GROUP BY 3
    UNION ALL SELECT 'ModelScoreAnomaly', '', {_T}, avg(score) FROM req_steps, range(0, 60) r(i) WHERE score IS NOT NULL GROUP BY 3
    UNION ALL SELECT 'HighActiveConnections', '', step, sum(move) OVER (ORDER BY step)::DOUBLE FROM (
      SELECT step, sum(move) AS move FROM (SELECT step, 1 AS move FROM req_steps UNION ALL
        SELECT (ceil((epoch_us(ts) + round(duration_s * 1000000)::BIGINT) / 30000000.0::DOUBLE) * 30)::BIGINT, -1 FROM requests) GROUP BY step)
    UNION ALL SELECT 'SlowRecommendationGeneration', '', eval_at, v
      FROM ({_p95_sql("stage = 'recommendation'", "", monitor.STAGE_BOUNDS["recommendation"])})
    UNION ALL SELECT 'FrequentFallbackUsage', fallback_type || ',' || endpoint, {_T}, count(*) / 600.0::DOUBLE FROM req_steps, range(0, 20) r(i)
      WHERE fallback_type IS NOT NULL GROUP BY 2, 3
    UNION ALL SELECT 'HighMemoryUsage', instance, {_T}, arg_max(value, ts) FROM gauge_steps, range(0, 10) r(i)
      WHERE metric = 'memory_percent' GROUP BY 2, 3
    UNION ALL SELECT 'HighCPUUsage', '', eval_at, avg(v) FROM (SELECT instance, {_T}, avg(value) AS v FROM gauge_steps, range(0, 10) r(i)
      WHERE metric = 'cpu_percent' GROUP BY 1, 2) GROUP BY 3
    UNION ALL SELECT 'ContainerRestartLoop', instance, {_T}, sum(CASE WHEN was IS NULL THEN 0 WHEN value >= was THEN value - was ELSE value END)
      FROM (SELECT *, lag(value) OVER (PARTITION BY instance ORDER BY ts, value) AS was FROM gauge_steps WHERE metric = 'restarts'),
        range(0, 30) r(i) GROUP BY 2, 3
    UNION ALL SELECT 'LowRequestRate', '', g.eval_at, coalesce(n, 0) / 600.0::DOUBLE
      FROM (SELECT unnest(range(min(step), max(step) + 1, 30)) AS eval_at FROM req_steps) g
      LEFT JOIN (SELECT {_T}, count(*) AS n FROM req_steps, range(0, 20) r(i) GROUP BY 1) c USING (eval_at)""")

add_table("alert_rules", """
    SELECT * FROM (VALUES ('HighErrorRate', 300, 'critical', 'api'), ('ServiceDown', 60, 'critical', 'api'),
      ('RedisConnectionFailure', 300, 'critical', 'cache'), ('HighLatency', 300, 'warning', 'api'),
      ('LowCacheHitRate', 600, 'warning', 'cache'), ('ModelScoreAnomaly', 600, 'warning', 'model'),
      ('HighActiveConnections', 300, 'warning', 'api'), ('SlowRecommendationGeneration', 300, 'warning', 'recommendations'),
      ('FrequentFallbackUsage', 600, 'warning', 'recommendations'), ('HighMemoryUsage', 300, 'warning', 'system'),
      ('HighCPUUsage', 300, 'warning', 'system'), ('ContainerRestartLoop', 900, 'warning', 'system'),
      ('LowRequestRate', 600, 'warning', 'api')) r(alertname, hold, severity, component)""")

add_table("alert_broken", """
    SELECT *, CASE alertname WHEN 'HighErrorRate' THEN value > 5 WHEN 'ServiceDown' THEN value = 0
        WHEN 'RedisConnectionFailure' THEN value > 0 WHEN 'HighLatency' THEN value > 0.2::DOUBLE WHEN 'LowCacheHitRate' THEN value < 0.3::DOUBLE
        WHEN 'ModelScoreAnomaly' THEN value < 0.3::DOUBLE OR value > 0.9::DOUBLE WHEN 'HighActiveConnections' THEN value > 150
        WHEN 'SlowRecommendationGeneration' THEN value > 0.5 WHEN 'FrequentFallbackUsage' THEN value > 0.1::DOUBLE
        WHEN 'HighMemoryUsage' THEN value > 90 WHEN 'HighCPUUsage' THEN value > 90 WHEN 'ContainerRestartLoop' THEN value > 3
        ELSE value < 1 END AS breached
    FROM alert_values JOIN alert_rules USING (alertname)""")

add_table("alert_fired", """
    SELECT *, min(eval_at) OVER (PARTITION BY alertname, series, streak) AS active_since FROM (
      SELECT *, eval_at - 30 * row_number() OVER (PARTITION BY alertname, series ORDER BY eval_at) AS streak FROM alert_broken WHERE breached)
    QUALIFY eval_at - active_since >= hold""")


@query("alert_breaches", f"""
    SELECT alertname, series, count(*) AS evaluations, count(*) FILTER (breached) AS breaches,
      {_at("min(eval_at) FILTER (breached)")} AS first_breach, round(max(value), 6) AS highest, round(min(value), 6) AS lowest
    FROM alert_broken GROUP BY 1, 2""")
def alert_breaches(t: Tables) -> DataFrame:
    """Per rule and series, how often it was evaluated and broken."""
    rows = alerts.breaches(alerts.alert_metrics(t.requests, t.gauges), alerts.rules(t.spark))
    return rounded(rows.groupBy("alertname", "series").agg(
        F.count("*").alias("evaluations"), F.count_if("breached").alias("breaches"),
        as_time(F.min(F.when(F.col("breached"), F.col("eval_at")))).alias("first_breach"),
        F.max("value").alias("highest"), F.min("value").alias("lowest")))


def fired(t: Tables) -> DataFrame:
    return alerts.firing(alerts.breaches(alerts.alert_metrics(t.requests, t.gauges), alerts.rules(t.spark)))


@query("alerts_firing", f"""
    SELECT alertname, series, severity, {_at("active_since")} AS active_since, {_at("min(eval_at)")} AS fired_at,
      {_at("max(eval_at)")} AS last_at, count(*) AS steps FROM alert_fired GROUP BY alertname, series, severity, active_since""")
def alerts_firing(t: Tables) -> DataFrame:
    """Each span over which an alert fired."""
    return fired(t).groupBy("alertname", "series", "severity", as_time(F.col("active_since")).alias("active_since")).agg(
        as_time(F.min("eval_at")).alias("fired_at"), as_time(F.max("eval_at")).alias("last_at"), F.count("*").alias("steps"))


@query("alerts_routed", """
    SELECT alertname, severity, component, count(DISTINCT eval_at) AS steps, count(*) AS alerts FROM alert_fired f
    WHERE NOT (severity = 'warning' AND EXISTS (SELECT 1 FROM alert_fired c WHERE c.severity = 'critical' AND c.eval_at = f.eval_at
        AND c.component = f.component AND c.alertname = f.alertname))
      AND NOT (alertname <> 'ServiceDown' AND eval_at IN (SELECT eval_at FROM alert_fired WHERE alertname = 'ServiceDown'))
    GROUP BY 1, 2, 3""")
def alerts_routed(t: Tables) -> DataFrame:
    """Grid steps and alerts each group was notified for."""
    return alerts.route(fired(t)).groupBy("alertname", "severity", "component").agg(
        F.count("*").alias("steps"), F.sum("alerts").alias("alerts"))


# ---------------------------------------------------------------- sketches


@query("sketched_quantiles", """
    SELECT d.day AS last_day, d.endpoint, q.name AS quantile, count(*) AS n, true AS within
    FROM (SELECT DISTINCT ts::DATE AS day, endpoint FROM requests) d
      JOIN requests r ON r.endpoint = d.endpoint AND r.ts::DATE BETWEEN d.day - 6 AND d.day,
      (VALUES ('p50'), ('p95'), ('p99')) q(name)
    WHERE d.day % 7 = 0 GROUP BY 1, 2, 3""".replace("d.day % 7 = 0", "day(d.day) % 7 = 0"))
def sketched_quantiles(t: Tables) -> DataFrame:
    """Quantiles of seven days merged from daily sketches, and whether each has a rank in the
    raw durations within 3 % of the one asked for."""
    log, wanted = t.requests.select("ts", "endpoint", "duration_s"), {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    daily = sketches.daily_sketches(log, ["endpoint"], "ts", value="duration_s")
    found = sketches.quantiles(sketches.merged(daily, ["endpoint"], 7).filter(F.dayofmonth("last_day") % 7 == 0), wanted)
    rows = found.select("last_day", "endpoint", F.explode(F.array(*[
        F.struct(F.lit(n).alias("quantile"), F.lit(q).alias("rank"), F.col(n).alias("estimate")) for n, q in wanted.items()])).alias("_q")).select(
        "last_day", "endpoint", "_q.*")
    raw = log.select("endpoint", "duration_s", F.explode(F.transform(F.sequence(F.lit(0), F.lit(6)), lambda i: F.date_add(F.to_date("ts"), i))).alias("last_day"))
    ranks = raw.join(rows, ["last_day", "endpoint"]).groupBy("last_day", "endpoint", "quantile", "rank").agg(
        F.count("*").alias("n"), F.count_if(F.col("duration_s") <= F.col("estimate")).alias("upto"), F.count_if(F.col("duration_s") < F.col("estimate")).alias("under"))
    fits = (F.col("upto") / F.col("n") >= F.col("rank") - 0.03) & (F.col("under") / F.col("n") <= F.col("rank") + 0.03)
    return ranks.select("last_day", "endpoint", "quantile", "n", fits.alias("within"))


@query("sketched_viewers", """
    SELECT d.day AS last_day, d.movie_id, count(DISTINCT i.user_id) AS viewers, true AS within
    FROM (SELECT DISTINCT "timestamp"::DATE AS day, movie_id FROM interactions WHERE event_type = 'view') d
      JOIN interactions i ON i.movie_id = d.movie_id AND i.event_type = 'view' AND i."timestamp"::DATE BETWEEN d.day - 29 AND d.day
    WHERE day(d.day) IN (10, 20, 30) GROUP BY 1, 2""")
def sketched_viewers(t: Tables) -> DataFrame:
    """Viewers of an item in thirty days merged from daily sketches: the exact number, and
    whether the estimate is within 8 % of it, or 1."""
    views = t.interactions.filter("event_type = 'view'").select("timestamp", "movie_id", "user_id")
    daily = sketches.daily_sketches(views, ["movie_id"], "timestamp", ids="user_id")
    at = F.dayofmonth("last_day").isin(10, 20, 30)
    found = sketches.distinct_ids(sketches.merged(daily, ["movie_id"], 30).filter(at), "estimate")
    once = views.select("movie_id", "user_id", F.to_date("timestamp").alias("day")).distinct()
    spread = once.select("movie_id", "user_id", F.explode(F.transform(F.sequence(F.lit(0), F.lit(29)), lambda i: F.date_add("day", i))).alias("last_day"))
    exact = spread.filter(at).groupBy("last_day", "movie_id").agg(F.count_distinct("user_id").alias("viewers"))
    off = F.abs(F.col("estimate") - F.col("viewers"))
    return found.join(exact, ["last_day", "movie_id"]).select(
        "last_day", "movie_id", "viewers", (off <= F.greatest(F.lit(1.0), F.col("viewers") * 0.08)).alias("within"))


# ---------------------------------------------------------------- profiles


@query("profile_users", """SELECT 'age_group' AS attribute, age_group AS value, count(*) AS users FROM users GROUP BY 2
    UNION ALL SELECT 'region', region, count(*) FROM users GROUP BY 2""")
def profile_users(t: Tables) -> DataFrame:
    return profile.profile_users(t.users)


@query("top_genres", """SELECT genre, count(*) AS items FROM (SELECT unnest(genres) AS genre FROM items) GROUP BY genre
    ORDER BY items DESC, genre LIMIT 10""")
def top_genres(t: Tables) -> DataFrame:
    return profile.top_genres(t.items)


@query("profile_items", """
    SELECT count(*) AS items, min(y)::INTEGER AS min_release_year, max(y)::INTEGER AS max_release_year, round(avg(y), 6) AS mean_release_year,
      min(m) AS min_duration_minutes, max(m) AS max_duration_minutes, round(avg(m), 6) AS mean_duration_minutes
    FROM (SELECT year(release_date) AS y, duration_seconds / 60 AS m FROM items)""")
def profile_items(t: Tables) -> DataFrame:
    items = t.items.select(F.year("release_date").alias("release_year"), (F.col("duration_seconds") / 60).alias("duration_minutes"))
    return rounded(profile.profile_items(items))


@query("profile_events", """
    SELECT CASE WHEN grouping(event_type) = 1 THEN 'all' ELSE event_type END AS event_type, count(*) AS events,
      count(*) FILTER (event_type = 'view') AS views, count(rating) AS ratings,
      round(avg(watch_time_seconds) FILTER (event_type = 'view'), 6) AS mean_watch_time, round(avg(rating), 6) AS mean_rating,
      coalesce(sum(watch_time_seconds) FILTER (event_type = 'view'), 0)::BIGINT AS watch_time
    FROM (SELECT event_type, watch_time_seconds, rating FROM interactions) GROUP BY ROLLUP (event_type)""")
def profile_events(t: Tables) -> DataFrame:
    return rounded(profile.profile_events(t.interactions))
