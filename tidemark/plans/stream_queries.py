"""Streaming jobs run to the end of what is there; each must equal its batch result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.plans.ingest_queries import NOW, records_of
from tidemark.plans.registry import query
from tidemark.plans.tables import Tables, request_log
from tidemark.session import scratch_path
from tidemark.sources.events import file_stream
from tidemark.streaming import jobs


def _folders(t: Tables, label: str) -> tuple[str, str]:
    base = scratch_path(t.spark, label)
    return f"{base}/table", f"{base}/checkpoint"


def event_stream(t: Tables) -> DataFrame:
    return file_stream(t.spark, t.sf_dir, t.raw("events").schema, "events.parquet")


BATCHES, FILE_ROWS = 4, 50_000  # batches of a stream of dealt rows, and rows of a file, about


def _streamed(t: Tables, rows: DataFrame, label: str, form: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """``rows``, in the given form, written to a folder as files dealt without regard to time, and
    read back as a stream of four batches, of as many files as keep a file at a bounded size.

    Rows are dealt before they are formed, so that all tasks share that work."""
    folder = scratch_path(t.spark, label)
    files = max(1, -(-rows.count() // (BATCHES * FILE_ROWS)))
    formed = form(rows.repartition(BATCHES * files))
    formed.write.parquet(folder)
    return file_stream(t.spark, folder, formed.schema, "*.parquet", files_per_batch=files)


def _deliver(t: Tables, rows: DataFrame, at: str, label: str, run: Callable[[DataFrame], None]) -> None:
    """``rows`` in four deliveries in order of time, each taken by a stream run of its own
    that goes on from the last."""
    folder, day = scratch_path(t.spark, label), F.dayofmonth(at)
    schema = T.StructType(rows.schema.fields)
    for first, last in ((1, 8), (9, 15), (16, 22), (23, 31)):
        rows.filter(day.between(first, last)).write.mode("append").parquet(folder)
        run(file_stream(t.spark, folder, schema, "*.parquet"))


@query("stream_ingest", """
    SELECT event_type, CASE WHEN errors = '' THEN 'good' ELSE 'quarantine' END AS outcome, errors, count(*) AS events,
      count(DISTINCT id) AS event_ids
    FROM (SELECT CASE WHEN event_id % 29 = 0 THEN NULL ELSE event_type END AS event_type,
            CASE WHEN event_id % 29 = 0 THEN 'record.corrupt;event_type.unknown' ELSE errors END AS errors, event_id AS id FROM checked_events)
    GROUP BY 1, 2, 3""")
def stream_ingest(t: Tables) -> DataFrame:
    path, checkpoint = _folders(t, "ingest")
    jobs.drain(jobs.ingest(_streamed(t, t.raw("events"), "records", records_of), path, checkpoint, NOW))
    written = [jobs.ingested(t.spark, path, o).withColumn("outcome", F.lit(o)) for o in ("good", "quarantine")]
    return written[0].unionByName(written[1]).groupBy("event_type", "outcome", F.array_join("errors", ";").alias("errors")).agg(
        F.count("*").alias("events"), F.count_distinct("event_id").alias("event_ids"))


@query("stream_dedup", "SELECT event_id, user_id, event_type, \"timestamp\" FROM interactions")
def stream_dedup(t: Tables) -> DataFrame:
    """Each event once, some twice, some three times."""
    once = t.interactions.select("event_id", "user_id", "event_type", "timestamp")
    again = once.unionByName(once.filter("event_id % 3 = 0")).unionByName(once.filter("event_id % 7 = 0"))
    path, checkpoint = _folders(t, "dedup")
    jobs.drain(jobs.dedup(_streamed(t, again, "repeated"), path, checkpoint))
    return t.spark.read.parquet(path).drop("batch")


@query("stream_request_windows", """
    WITH panes AS (
      SELECT time_bucket(INTERVAL 30 SECOND, ts) + INTERVAL 30 SECOND AS pane_end, endpoint, count(*) AS requests,
        count(*) FILTER (status >= 500) AS errors, count(*) FILTER (cached) AS hits, count(cached) AS operations,
        count(*) FILTER (duration_s <= 0.1) AS within_100ms FROM requests GROUP BY 1, 2),
    windows AS (
      SELECT width, endpoint, pane_end + to_seconds(30 * i) AS window_end, sum(requests) AS requests, sum(errors) AS errors, sum(hits) AS hits,
        sum(operations) AS operations, sum(within_100ms) AS within_100ms
      FROM panes, (VALUES (300), (600), (1800)) w(width), range(0, 60) r(i) WHERE i * 30 < width GROUP BY 1, 2, 3)
    SELECT width::INTEGER AS width, endpoint, date_trunc('hour', window_end)::TIMESTAMP AS hour, count(*) AS windows, sum(requests)::BIGINT AS requests,
      max(requests)::BIGINT AS most, sum(errors)::BIGINT AS errors, sum(hits)::BIGINT AS hits, sum(operations)::BIGINT AS operations,
      sum(within_100ms)::BIGINT AS within_100ms
    FROM windows GROUP BY 1, 2, 3""")
def stream_request_windows(t: Tables) -> DataFrame:
    """Windows of 5, 10 and 30 minutes moved on by 30 seconds, summed up by hour."""
    base = scratch_path(t.spark, "request-panes")

    def run(log: DataFrame) -> None:
        jobs.drain(jobs.request_panes(log, f"{base}/panes", f"{base}/windows", f"{base}/checkpoint"))

    _deliver(t, t.requests, "ts", "request-deliveries", run)
    out = jobs.latest_windows(t.spark, f"{base}/windows", ["width", "endpoint"], "window_end")
    within = F.get("latency_counts", F.lit(4))
    return out.groupBy("width", "endpoint", F.date_trunc("hour", "window_end").cast("timestamp_ntz").alias("hour")).agg(
        F.count("*").alias("windows"), F.sum("requests").alias("requests"), F.max("requests").alias("most"), F.sum("errors").alias("errors"),
        F.sum("hits").alias("hits"), F.sum("operations").alias("operations"), F.sum(within).alias("within_100ms"))


@query("stream_coarse_windows", """
    SELECT time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 5 MINUTE * i AS window_start, endpoint, count(*) AS requests,
      count(*) FILTER (status >= 500) AS errors, count(*) FILTER (cached) AS hits, count(cached) AS operations,
      count(*) FILTER (duration_s <= 0.1) AS within_100ms
    FROM requests, range(0, 2) r(i) GROUP BY 1, 2""")
def stream_coarse_windows(t: Tables) -> DataFrame:
    path, checkpoint = _folders(t, "request-windows")
    jobs.drain(jobs.request_windows(request_log(event_stream(t)), path, checkpoint))
    out = jobs.latest_windows(t.spark, path, ["endpoint"])
    return out.withColumn("within_100ms", F.get("latency_counts", F.lit(4))).drop("latency_counts")


@query("stream_daily_counts", """
    SELECT date_trunc('day', "timestamp")::TIMESTAMP AS window_start, kind, id, count(*) AS events, count(*) FILTER (event_type = 'view') AS views
    FROM (SELECT "timestamp", event_type, 'user' AS kind, user_id AS id FROM interactions
          UNION ALL SELECT "timestamp", event_type, 'item', movie_id FROM interactions WHERE movie_id IS NOT NULL) GROUP BY 1, 2, 3""")
def stream_daily_counts(t: Tables) -> DataFrame:
    path, checkpoint = _folders(t, "daily-counts")
    _deliver(t, t.interactions, "timestamp", "interaction-deliveries", lambda rows: jobs.drain(jobs.daily_counts(rows, path, checkpoint)))
    return jobs.latest_windows(t.spark, path, ["kind", "id"])


def arrival(rows: DataFrame) -> DataFrame:
    """Three deliveries: up to day 10, up to day 20, and the rest with the late rows of the first."""
    day = F.dayofmonth("timestamp")
    late = (day <= 10) & (F.col("event_id") % 10 == 0)
    return rows.withColumn("arrival", F.when(late | (day > 20), 3).when(day > 10, 2).otherwise(1))


@query("stream_late_correction", """
    SELECT "timestamp"::DATE AS day, count(*) FILTER (NOT (day("timestamp") <= 10 AND event_id % 10 = 0)) AS streamed,
      count(*) AS corrected FROM interactions GROUP BY 1""")
def stream_late_correction(t: Tables) -> DataFrame:
    """Windows miss the rows that came after their watermark; the raw table puts them right."""
    folder = scratch_path(t.spark, "deliveries")
    (windows, checkpoint), (raw, raw_checkpoint) = _folders(t, "late-windows"), _folders(t, "late-raw")
    rows = t.interactions.select("event_id", "timestamp")
    for number in (1, 2, 3):
        arrival(rows).filter(F.col("arrival") == number).drop("arrival").write.mode("append").parquet(folder)

        def stream() -> DataFrame:
            return file_stream(t.spark, folder, T.StructType(rows.schema.fields), "*.parquet")

        jobs.drain(jobs.windowed(stream(), "timestamp", "1 day", [], [F.count("*").alias("streamed")], windows, checkpoint, "1 day"))
        jobs.drain(jobs.keep_raw(stream(), raw, raw_checkpoint))
    streamed = jobs.latest_windows(t.spark, windows, []).select(F.to_date("window_start").alias("day"), "streamed")
    corrected = t.spark.read.parquet(raw).groupBy(F.to_date("timestamp").alias("day")).agg(F.count("*").alias("corrected"))
    return corrected.join(streamed, "day", "left")
