"""Reading, decoding, routing, validating and archiving events."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window as W, functions as F

from tidemark.functions.columns import endpoint_template as template_of, status_class as class_of
from tidemark.operators import validate
from tidemark.plans.check_tables import add_table
from tidemark.plans.feature_queries import rounded
from tidemark.plans.registry import query
from tidemark.plans.tables import Tables
from tidemark.session import scratch_path, stage
from tidemark.sources import archive, events as sources, record_log
from tidemark.sources.schemas import CORRUPT
from tidemark.streaming.jobs import drain, into_batches

NOW = "2024-01-28 00:00:00"


def raw_events(events: DataFrame) -> DataFrame:
    """The events as they might arrive, with faults placed by id and by ``k``."""
    e, k = F.col("event_id"), F.get_json_object("props", "$.k").cast("bigint")
    kind = F.col("event_type")
    is_view, is_rating = kind.isin("view", "click"), kind == "purchase"
    is_skip, is_search = kind == "error", kind == "signup"
    devices = F.array(*[F.lit(d) for d in ("mobile", "tablet", "desktop", "tv", "fridge", None)])
    queries = F.array(F.lit("   "), F.lit("  action movies "), F.repeat(F.lit("q"), 1001), F.lit(None), F.lit("drama"))
    watched = F.floor(F.col("value") * 10)
    return events.select(
        "event_id",
        F.when(is_view, "view").when(is_rating, "rating").when(is_skip, "skip").otherwise("search").alias("event_type"),
        F.when(e % 97 == 0, "").when(e % 89 == 0, F.lit(None)).when(e % 83 == 0, F.repeat(F.lit("u"), 256))
        .otherwise(F.concat(F.lit("user_"), F.col("user_id").cast("string"))).alias("user_id"),
        F.when(~is_search, F.when(e % 79 == 0, "").otherwise(F.concat(F.lit("movie_"), k.cast("string")))).alias("movie_id"),
        F.col("ts").alias("timestamp"),
        F.when(
            is_view,
            F.when(e % 11 == 0, 86401 + k).when(e % 13 == 0, -1 - k).when(e % 17 == 0, 86400)
            .when(e % 19 == 0, F.lit(None)).otherwise(F.floor(F.col("value") * 60)),
        ).alias("watch_time_seconds"),
        F.when(is_view, F.when(e % 31 == 0, F.repeat(F.lit("s"), 256))
               .when(e % 2 == 0, F.concat(F.lit("session_"), e.cast("string")))).alias("session_id"),
        F.when(is_view, F.get(devices, (k % 6).cast("int"))).alias("device"),
        F.when(is_rating, F.when(k % 10 == 0, 0.0).when(k % 10 == 1, 6.0).when(k % 10 == 2, 3.5)
               .otherwise((1 + e % 5).cast("double"))).alias("rating"),
        F.when(is_search, F.get(queries, (k % 5).cast("int"))).alias("query"),
        F.when(is_search, k - 5).alias("results_count"),
        F.when(is_skip, F.when(k % 7 == 2, -watched - 1).otherwise(watched)).alias("watch_duration_seconds"),
        F.when(is_skip, F.when(k % 7 == 0, 0).when(k % 7 == 1, watched).otherwise(5400)).alias("movie_duration_seconds"),
    )


add_table("raw_events", """
    SELECT event_id, kind AS event_type,
      CASE WHEN event_id % 97 = 0 THEN '' WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 83 = 0 THEN repeat('u', 256)
        ELSE 'user_' || uid END AS user_id,
      CASE WHEN kind <> 'search' THEN CASE WHEN event_id % 79 = 0 THEN '' ELSE 'movie_' || k END END AS movie_id,
      ts AS "timestamp",
      CASE WHEN kind = 'view' THEN CASE WHEN event_id % 11 = 0 THEN 86401 + k WHEN event_id % 13 = 0 THEN -1 - k
        WHEN event_id % 17 = 0 THEN 86400 WHEN event_id % 19 = 0 THEN NULL ELSE floor(value * 60) END END::BIGINT
        AS watch_time_seconds,
      CASE WHEN kind = 'view' THEN CASE WHEN event_id % 31 = 0 THEN repeat('s', 256)
        WHEN event_id % 2 = 0 THEN 'session_' || event_id END END AS session_id,
      CASE WHEN kind = 'view' THEN ['mobile','tablet','desktop','tv','fridge',NULL][k % 6 + 1] END AS device,
      CASE WHEN kind = 'rating' THEN CASE k % 10 WHEN 0 THEN 0 WHEN 1 THEN 6 WHEN 2 THEN 3.5
        ELSE 1 + event_id % 5 END END::DOUBLE AS rating,
      CASE WHEN kind = 'search' THEN ['   ','  action movies ',repeat('q', 1001),NULL,'drama'][k % 5 + 1] END AS query,
      CASE WHEN kind = 'search' THEN k - 5 END AS results_count,
      CASE WHEN kind = 'skip' THEN CASE WHEN k % 7 = 2 THEN -w - 1 ELSE w END END AS watch_duration_seconds,
      CASE WHEN kind = 'skip' THEN CASE k % 7 WHEN 0 THEN 0 WHEN 1 THEN w ELSE 5400 END END AS movie_duration_seconds
    FROM (SELECT event_id, ts, value, user_id AS uid, (props->>'$.k')::BIGINT AS k, floor(value * 10)::BIGINT AS w,
            CASE event_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'view' WHEN 'purchase' THEN 'rating'
              WHEN 'error' THEN 'skip' ELSE 'search' END AS kind FROM events)""")


def _raw(t: Tables) -> DataFrame:
    return raw_events(t.raw("events"))


# ---------------------------------------------------------------- validation

_BAD_ID = "({c} IS NULL OR length({c}) NOT BETWEEN 1 AND 255)"
_COMMON_SQL = [
    ("user_id.length", _BAD_ID.format(c="user_id")),
    ("timestamp.invalid", "\"timestamp\" IS NULL"),
    ("timestamp.future", f"\"timestamp\" > TIMESTAMP '{NOW}'"),
]
_MOVIE_SQL = [("movie_id.length", _BAD_ID.format(c="movie_id"))]
_RULES_SQL = {
    "view": _COMMON_SQL + _MOVIE_SQL + [
        ("watch_time_seconds.range", "watch_time_seconds IS NULL OR watch_time_seconds < 0 OR watch_time_seconds > 86400"),
        ("session_id.length", "length(session_id) > 255"),
        ("device.unknown", "device NOT IN ('mobile', 'tablet', 'desktop', 'tv')"),
    ],
    "rating": _COMMON_SQL + _MOVIE_SQL + [("rating.range", "rating IS NULL OR rating NOT IN (1, 2, 3, 4, 5)")],
    "search": _COMMON_SQL + [
        ("query.empty", "query IS NULL OR trim(query) = ''"),
        ("query.length", "query IS NULL OR length(query) > 1000"),
        ("results_count.negative", "results_count IS NULL OR results_count < 0"),
    ],
    "skip": _COMMON_SQL + _MOVIE_SQL + [
        ("watch_duration_seconds.negative", "watch_duration_seconds IS NULL OR watch_duration_seconds < 0"),
        ("movie_duration_seconds.positive", "movie_duration_seconds IS NULL OR movie_duration_seconds <= 0"),
        ("watch_duration_seconds.after_end", "watch_duration_seconds > movie_duration_seconds"),
    ],
}


def _validate_sql(kind: str) -> str:
    flags = ", ".join(f"CASE WHEN {bad} THEN '{code}' END" for code, bad in _RULES_SQL[kind])
    return f"SELECT event_id, event_type, concat_ws(';', {flags}) AS errors FROM raw_events WHERE event_type = '{kind}'"


def _register_validation(kind: str) -> None:
    @query(f"validate_{kind}", _validate_sql(kind))
    def run(t: Tables) -> DataFrame:
        rows = _raw(t).filter(F.col("event_type") == kind)
        checked = validate.validate_events(rows, kind, NOW)
        return checked.select("event_id", "event_type", F.array_join("errors", ";").alias("errors"))


for _kind in ("view", "rating", "search", "skip"):
    _register_validation(_kind)

add_table("checked_events", " UNION ALL ".join(_validate_sql(k) for k in _RULES_SQL))


@query("quarantine", "SELECT event_id, event_type, errors FROM checked_events WHERE errors <> ''")
def quarantine(t: Tables) -> DataFrame:
    bad = validate.bad_rows(validate.validate_mixed(_raw(t), NOW))
    return bad.select("event_id", "event_type", F.array_join("errors", ";").alias("errors"))


@query(
    "ingest_outcomes",
    """SELECT event_type, CASE WHEN errors = '' THEN 'success' ELSE 'error' END AS status, count(*) AS events
       FROM checked_events GROUP BY 1, 2""",
)
def ingest_outcomes(t: Tables) -> DataFrame:
    return validate.outcomes(validate.validate_mixed(_raw(t), NOW))


@query(
    "normalise_ts",
    """
    SELECT event_id, CASE event_id % 5
      WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('millisecond', ts)
      WHEN 2 THEN date_trunc('second', ts) - INTERVAL 2 HOUR WHEN 3 THEN ts ELSE NULL END AS at
    FROM events""",
)
def normalise_ts(t: Tables) -> DataFrame:
    """ISO text with Z, with milliseconds, with an offset, with a space, and bad text."""
    second = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    text = (
        F.when(F.col("event_id") % 5 == 0, F.concat(second, F.lit("Z")))
        .when(F.col("event_id") % 5 == 1, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z")))
        .when(F.col("event_id") % 5 == 2, F.concat(second, F.lit("+02:00")))
        .when(F.col("event_id") % 5 == 3, F.col("ts").cast("string"))
        .otherwise(F.concat(F.lit("not a time "), second))
    )
    rows = t.raw("events").select("event_id", text.alias("text"))
    return rows.select("event_id", validate.normalise_timestamp("text").cast("timestamp_ntz").alias("at"))


@query(
    "validate_items",
    """
    SELECT movie_id, concat_ws(';', CASE WHEN movie_id % 10 = 0 THEN 'genres.empty' END,
      CASE WHEN movie_id % 10 = 1 THEN 'genres.unknown' END,
      CASE WHEN 1890 + movie_id % 150 NOT BETWEEN 1900 AND 2030 THEN 'release_year.range' END,
      CASE WHEN p_size * 6 > 240 OR p_size * 6 < 5 THEN 'duration_minutes.range' END,
      CASE WHEN p_retailprice / 1000 > 1 OR p_retailprice < 0 THEN 'popularity_score.range' END) AS errors
    FROM (SELECT p_partkey AS movie_id, * FROM part)""",
)
def validate_items(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    names = F.array(*[F.lit(g) for g in validate.GENRES])
    one = F.get(names, (k % len(validate.GENRES)).cast("int"))
    items = t.raw("part").select(
        k.alias("movie_id"),
        F.when(k % 10 == 0, F.array().cast("array<string>"))
        .when(k % 10 == 1, F.array(one, F.lit("Widgets"))).otherwise(F.array(one)).alias("genres"),
        (1890 + k % 150).alias("release_year"),
        (F.col("p_size") * 6).alias("duration_minutes"),
        (F.col("p_retailprice") / 1000).alias("popularity_score"),
    )
    return validate.validate_items(items).select("movie_id", F.array_join("errors", ";").alias("errors"))


@query(
    "validate_users",
    """
    SELECT c_custkey AS user_id, CASE WHEN c_custkey % 6 < 5 THEN '' ELSE 'age_group.unknown' END AS errors,
      CASE WHEN c_nationkey % 7 < 6 THEN '' ELSE 'region.unknown' END AS warnings FROM customer""",
)
def validate_users(t: Tables) -> DataFrame:
    ages = F.array(*[F.lit(a) for a in validate.AGE_GROUPS], F.lit("unknown"))
    regions = F.array(*[F.lit(r) for r in validate.REGIONS], F.lit("Atlantis"))
    users = t.raw("customer").select(
        F.col("c_custkey").alias("user_id"),
        F.get(ages, (F.col("c_custkey") % 6).cast("int")).alias("age_group"),
        F.get(regions, F.col("c_nationkey") % 7).alias("region"),
    )
    checked = validate.validate_users(users)
    return checked.select("user_id", F.array_join("errors", ";").alias("errors"),
                          F.array_join("warnings", ";").alias("warnings"))


@query(
    "clamp_score",
    """SELECT event_id, CASE WHEN event_id % 13 <> 0 THEN round(least(greatest(value / 300 - 0.2, 0), 1), 6)::DOUBLE END AS score,
         event_id % 13 <> 0 AND (value / 300 - 0.2 < 0 OR value / 300 - 0.2 > 1) AS was_clamped FROM events""",
)
def clamp_score(t: Tables) -> DataFrame:
    scored = t.raw("events").select("event_id", F.when(F.col("event_id") % 13 != 0, F.col("value") / 300 - 0.2).alias("score"))
    return rounded(validate.clamp_score(scored))


@query("status_class", "SELECT status, (status // 100)::VARCHAR || 'xx' AS class, count(*) AS requests FROM requests GROUP BY status")
def status_class(t: Tables) -> DataFrame:
    return t.requests.groupBy("status", class_of(F.col("status")).alias("class")).agg(F.count("*").alias("requests"))


@query(
    "endpoint_template",
    r"""SELECT regexp_replace(path, '([^/]*?)s*/(?:[0-9]+|[^/]*_[0-9]+)(/|$)', '{\1_id}\2') AS template,
          count(*) AS requests FROM requests GROUP BY 1""",
)
def endpoint_template(t: Tables) -> DataFrame:
    return t.requests.groupBy(template_of(F.col("path")).alias("template")).agg(F.count("*").alias("requests"))


# ---------------------------------------------------------------- reading and writing


def records(t: Tables) -> DataFrame:
    return records_of(t.raw("events"))


def records_of(events: DataFrame) -> DataFrame:
    """Topic records of the raw events; every 29th value is cut short."""
    rows = raw_events(events)
    fields = [c for c in rows.columns if c != "event_id"]
    whole = F.to_json(F.struct(F.col("event_id").cast("string").alias("event_id"), *fields))
    return rows.select(
        sources.topic_of(F.col("event_type")).alias("topic"),
        (F.col("event_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.when(F.col("event_id") % 29 == 0, F.substring(whole, 1, 12)).otherwise(whole).alias("value"),
    )


@query(
    "decode_events",
    """
    SELECT event_id AS "offset", event_id % 29 = 0 AS corrupt,
      CASE WHEN event_id % 29 <> 0 THEN user_id END AS user_id,
      CASE WHEN event_id % 29 <> 0 THEN event_type END AS event_type,
      CASE WHEN event_id % 29 <> 0 THEN watch_time_seconds END AS watch_time_seconds,
      CASE WHEN event_id % 29 <> 0 THEN rating END AS rating,
      CASE WHEN event_id % 29 <> 0 THEN length(query) END::INTEGER AS query_length
    FROM raw_events""",
)
def decode_events(t: Tables) -> DataFrame:
    out = sources.decode(records(t))
    return out.select("offset", F.col(CORRUPT).isNotNull().alias("corrupt"), "user_id", "event_type",
                      "watch_time_seconds", "rating", F.length("query").alias("query_length"))


@query("file_metadata", "SELECT event_id, 'events.parquet' AS source_file FROM events")
def file_metadata(t: Tables) -> DataFrame:
    out = sources.with_origin(t.raw("events").select("event_id", "_metadata"))
    return out.select("event_id", F.element_at(F.split("_source_file", "/"), -1).alias("source_file"))


@query(
    "cap_per_topic",
    """SELECT topic, "partition", "offset" FROM (
         SELECT 'movie-events-' || event_type AS topic, (event_id % 3)::INTEGER AS "partition", event_id AS "offset",
           row_number() OVER (PARTITION BY event_type ORDER BY event_id % 3, event_id) AS rn FROM raw_events)
       WHERE rn <= 1000""",
)
def cap_per_topic(t: Tables) -> DataFrame:
    return sources.cap_per_topic(records(t).select("topic", "partition", "offset"), 1000)


@query("resume_per_topic", """
    SELECT topic, "partition", "offset", ((rn - 1) // least_cap)::INTEGER AS run FROM (
      SELECT 'movie-events-' || event_type AS topic, (event_id % 3)::INTEGER AS "partition", event_id AS "offset",
        row_number() OVER (PARTITION BY event_type ORDER BY event_id % 3, event_id) AS rn,
        (SELECT max(n) FROM (SELECT count(*) AS n FROM raw_events GROUP BY event_type)) // 3 + 1 AS least_cap FROM raw_events)""")
def resume_per_topic(t: Tables) -> DataFrame:
    """Runs in sequence, each going on where the last one stopped, until all is read."""
    every = records(t).select("topic", "partition", "offset")
    cap = every.groupBy("topic").count().agg(F.max("count")).first()[0] // 3 + 1
    runs, after = [], None
    for number in range(3):
        taken = stage(sources.cap_per_topic(every, cap, after), "run")
        runs.append(taken.withColumn("run", F.lit(number)))
        after = stage(sources.next_offsets(taken, after), "offsets")
    return reduce(DataFrame.unionByName, runs)


@query("topic_stream", """
    SELECT 'movie-events-' || event_type AS _kafka_topic, (event_id % 3)::INTEGER AS _kafka_partition, event_id AS _kafka_offset,
      event_id % 29 = 0 AS corrupt, row_number() OVER (PARTITION BY event_type, event_id % 3 ORDER BY event_id) > n // 3 AS later
    FROM raw_events JOIN (SELECT event_type, event_id % 3 AS p, count(*) AS n FROM raw_events GROUP BY 1, 2) c USING (event_type)
    WHERE c.p = event_id % 3""")
def topic_stream(t: Tables) -> DataFrame:
    """Topics read as a stream from a log of records: a third of each partition is there at
    first, the rest comes later; the second run goes on where the first stopped."""
    base = scratch_path(t.spark, "topics")
    every = records(t).select("topic", "partition", "offset", F.lit(None).cast("string").alias("key"), F.col("value").cast("string"), F.current_timestamp().alias("timestamp"))
    place = F.row_number().over(W.partitionBy("topic", "partition").orderBy("offset"))
    part = F.floor(F.count("*").over(W.partitionBy("topic", "partition")) / 3)
    dealt = stage(every.withColumn("later", place > part), "records")
    for number, later in enumerate((False, True)):
        record_log.append(dealt.filter(F.col("later") == later).drop("later"), f"{base}/log")
        read = sources.with_origin(sources.decode(record_log.stream(t.spark, f"{base}/log")))
        kept = read.select("_kafka_topic", "_kafka_partition", "_kafka_offset", F.col(CORRUPT).isNotNull().alias("corrupt"), F.lit(bool(number)).alias("later"))
        drain(kept.writeStream.foreachBatch(into_batches(f"{base}/table")).option("checkpointLocation", f"{base}/checkpoint"))
    return t.spark.read.parquet(f"{base}/table").drop("batch")


@query(
    "extraction_summary",
    """SELECT CASE WHEN grouping(event_type) = 1 THEN 'all' ELSE 'movie-events-' || event_type END AS topic,
         count(*) AS events FROM raw_events GROUP BY ROLLUP (event_type)""",
)
def extraction_summary(t: Tables) -> DataFrame:
    return sources.extraction_summary(records(t))


@query(
    "events_roundtrip",
    """SELECT event_id, user_id, movie_id, "timestamp", event_type, watch_time_seconds, rating,
         "timestamp"::DATE AS event_date FROM interactions""",
)
def events_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "events")
    sources.write_events(t.interactions.drop("watch_duration_seconds"), path)
    return t.spark.read.parquet(path)


@query(
    "load_events",
    """SELECT event_id, event_type,
         CASE WHEN event_id % 4 = 0 THEN "timestamp" + INTERVAL 1 HOUR ELSE "timestamp" END AS "timestamp"
       FROM interactions""",
)
def load_events(t: Tables) -> DataFrame:
    """Every fourth event has no timestamp and takes its read time, an hour later."""
    path = scratch_path(t.spark, "typed-events")
    rows = t.interactions.select(
        "event_id", "event_type", F.when(F.col("event_id") % 4 != 0, F.col("timestamp")).alias("timestamp"),
        (F.col("timestamp") + F.expr("INTERVAL 1 HOUR")).cast("string").alias("_extracted_at"),
    )
    rows.write.partitionBy("event_type").parquet(path)
    return sources.load_events(t.spark, path).select("event_id", "event_type", "timestamp")


@query(
    "load_interactions",
    """SELECT source, event_type, count(*) AS events, min("timestamp") AS first_at, count(item_id) AS with_item,
         sum(user_id)::BIGINT AS user_sum
       FROM (SELECT event_type, user_id, movie_id AS item_id, date_trunc('millisecond', "timestamp") AS "timestamp"
             FROM interactions), (VALUES ('csv'), ('parquet')) s(source) GROUP BY source, event_type""",
)
def load_interactions(t: Tables) -> DataFrame:
    rows = t.interactions.select("user_id", F.col("movie_id").alias("item_id"),
                                 F.date_trunc("millisecond", "timestamp").cast("timestamp_ntz").alias("timestamp"),
                                 "event_type")
    csv, parquet = scratch_path(t.spark, "rows") + ".csv", scratch_path(t.spark, "rows") + ".parquet"
    rows.write.option("header", True).csv(csv)
    rows.write.parquet(parquet)
    both = sources.load_interactions(t.spark, csv).withColumn("source", F.lit("csv")).unionByName(
        sources.load_interactions(t.spark, parquet).withColumn("source", F.lit("parquet")))
    return both.groupBy("source", "event_type").agg(
        F.count("*").alias("events"), F.min("timestamp").alias("first_at"), F.count("item_id").alias("with_item"),
        F.sum("user_id").alias("user_sum"))


@query(
    "route_events",
    """SELECT CASE WHEN user_id IS NULL OR event_id % 23 = 0 THEN 'movie-events-quarantine'
           ELSE 'movie-events-' || event_type END AS topic, user_id AS key,
         CASE WHEN user_id IS NULL THEN to_json({'event_id': event_id, 'event_type':
             CASE WHEN event_id % 23 = 0 THEN 'ping' ELSE event_type END})
           ELSE to_json({'event_id': event_id, 'event_type':
             CASE WHEN event_id % 23 = 0 THEN 'ping' ELSE event_type END, 'user_id': user_id}) END::VARCHAR AS value
       FROM raw_events""",
)
def route_events(t: Tables) -> DataFrame:
    kind = F.when(F.col("event_id") % 23 == 0, "ping").otherwise(F.col("event_type"))
    return sources.route(_raw(t).select("event_id", kind.alias("event_type"), "user_id"))


@query(
    "stamp_events",
    """SELECT "offset", event_type, CASE WHEN "offset" % 2 = 0 THEN 'given-' || "offset" ELSE sha256(position) END
         AS event_id, sha256('request:' || position) AS request_id
       FROM (SELECT event_id AS "offset", event_type,
               'movie-events-' || event_type || ':' || (event_id % 3) || ':' || event_id AS position FROM raw_events)""",
)
def stamp_events(t: Tables) -> DataFrame:
    given = F.when(F.col("offset") % 2 == 0, F.concat(F.lit("given-"), F.col("offset").cast("string")))
    rows = records(t).select("topic", "partition", "offset", F.substring_index("topic", "-", -1).alias("event_type"),
                             given.alias("event_id"))
    return validate.stamp(rows).select("offset", "event_type", "event_id", "request_id")


@query("dedup_events", "SELECT event_id, user_id, movie_id, \"timestamp\", event_type FROM interactions")
def dedup_events(t: Tables) -> DataFrame:
    """Each event arrives once, or again if its id divides by three or by seven."""
    once = t.interactions.select("event_id", "user_id", "movie_id", "timestamp", "event_type")
    again = once.unionByName(once.filter("event_id % 3 = 0")).unionByName(once.filter("event_id % 7 = 0"))
    return validate.dedup(again)


@query(
    "union_events",
    """SELECT event_id, user_id, movie_id, "timestamp", event_type, watch_time_seconds, rating,
         watch_duration_seconds FROM (
         SELECT * REPLACE (CASE WHEN event_type = 'rating' THEN rating END AS rating) FROM interactions)""",
)
def union_events(t: Tables) -> DataFrame:
    base = ["event_id", "user_id", "timestamp", "event_type"]
    extra = {"view": ["movie_id", "watch_time_seconds"], "rating": ["movie_id", "rating"], "search": [],
             "skip": ["movie_id", "watch_duration_seconds"]}
    frames = [t.interactions.filter(F.col("event_type") == kind).select(*base, *cols) for kind, cols in extra.items()]
    return sources.union_events(*frames)


@query(
    "derive_label",
    "SELECT event_id, event_type, (event_type = 'view')::INTEGER AS label FROM interactions",
)
def derive_label(t: Tables) -> DataFrame:
    return validate.with_label(t.interactions).select("event_id", "event_type", "label")


@query(
    "archive_lookup",
    """
    WITH kept AS (SELECT 'event_' || event_id AS event_id, user_id, event_type FROM raw_events
                  WHERE NOT regexp_matches('event_' || event_id, '[05]$'))
    SELECT 'id' AS found_by, event_id, user_id, event_type FROM kept WHERE event_id = 'event_42'
    UNION ALL SELECT 'user', event_id, user_id, event_type FROM kept WHERE user_id = 'user_7'
    UNION ALL SELECT 'pattern', event_id, user_id, event_type FROM kept WHERE regexp_matches(event_id, '^event_[0-9]*3$')""",
)
def archive_lookup(t: Tables) -> DataFrame:
    """Append all events, delete ids ending in 0 or 5, then look up by id, user and pattern."""
    path = scratch_path(t.spark, "archive")
    rows = _raw(t).select(F.concat(F.lit("event_"), F.col("event_id").cast("string")).alias("event_id"), "user_id", "event_type")
    archive.append(rows, path)
    archive.delete(t.spark, path, "[05]$")
    stored = archive.read(t.spark, path)
    found = {"id": archive.lookup(t.spark, path, ["event_42", "event_40"]), "user": archive.find(stored, user_id="user_7"),
             "pattern": archive.find(stored, id_pattern="^event_[0-9]*3$")}
    return sources.union_events(*[df.withColumn("found_by", F.lit(how)) for how, df in found.items()])
