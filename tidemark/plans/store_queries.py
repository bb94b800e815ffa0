"""Feature store queries over snapshots of the user and item features."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark.operators import features as feats, store
from tidemark.operators.snapshots import VersionedTable
from tidemark.plans.check_tables import add_table
from tidemark.plans.feature_queries import USER_COLUMNS, item_features_sql, rounded, user_activity_sql, user_features_sql
from tidemark.plans.registry import query
from tidemark.plans.tables import Tables
from tidemark.session import scratch_path

SNAPSHOTS = ("2024-01-08 00:00:00", "2024-01-15 00:00:00", "2024-01-22 00:00:00")
READ_AT = "2024-01-18 12:00:00"
USER_FEATURES = [c.strip() for c in USER_COLUMNS.split(",")]
MORE_FEATURES = ["unique_genres_watched", "favorite_genre", "peak_activity_hour"]
ALL_USER_FEATURES = [*USER_FEATURES, *MORE_FEATURES]
ITEM_FEATURES = ["total_views", "unique_viewers", "avg_rating", "popularity_trend", "completion_rate", "days_since_release"]


def user_snapshot(t: Tables, when: str) -> DataFrame:
    """Long user features as of ``when``, created some hours later by user."""
    wide = rounded(feats.user_features(t.interactions, when, t.items)).select("user_id", *ALL_USER_FEATURES)
    return store.to_long(wide, ["user_id"], F.lit(when), F.lit(when).cast("timestamp_ntz")).select(
        F.lit("user").alias("entity_type"), F.col("user_id").alias("entity_id"), "feature_name", "feature_value",
        "feature_type", "as_of_date",
        (F.col("created_at") + F.make_dt_interval(hours=F.pmod(F.col("user_id").cast("int"), F.lit(24)))).alias(
            "created_at"),
    )


def item_snapshot(t: Tables, when: str) -> DataFrame:
    wide = rounded(feats.item_features(t.interactions, when, t.items)).select("movie_id", *ITEM_FEATURES)
    return store.entity_rows(wide, "movie_id", "movie", F.lit(when), F.lit(when))


def user_store(t: Tables) -> DataFrame:
    return reduce(DataFrame.unionByName, [user_snapshot(t, s) for s in SNAPSHOTS])


def full_store(t: Tables) -> DataFrame:
    return reduce(DataFrame.unionByName, [user_store(t), *[item_snapshot(t, s) for s in SNAPSHOTS]])


def _long_sql(table: str, kind: str, key: str, columns: list[str], ints: set[str], when: str, created: str) -> str:
    parts = [
        f"""SELECT '{kind}' AS entity_type, {key}::VARCHAR AS entity_id, '{c}' AS feature_name,
              {c}::VARCHAR AS feature_value,
              CASE WHEN {c} IS NULL THEN 'null' ELSE '{"str" if c == "favorite_genre" else "int" if c in ints else "float"}' END AS feature_type,
              TIMESTAMP '{when}' AS as_of_date, {created} AS created_at FROM ({table})"""
        for c in columns
    ]
    return " UNION ALL ".join(parts)


_USER_INTS = {c for c in USER_FEATURES if c.startswith(("watch_count", "days_since"))}
_MORE_INTS = {"unique_genres_watched", "peak_activity_hour"}
_ITEM_INTS = {"total_views", "unique_viewers", "days_since_release"}

add_table("user_store", " UNION ALL ".join(
    _long_sql(user_features_sql(s), "user", "user_id", ALL_USER_FEATURES, _USER_INTS | _MORE_INTS, s,
              f"TIMESTAMP '{s}' + to_hours((user_id % 24)::INTEGER)")
    for s in SNAPSHOTS))
add_table("movie_store", " UNION ALL ".join(
    _long_sql(item_features_sql(s), "movie", "movie_id", ITEM_FEATURES, _ITEM_INTS, s, f"TIMESTAMP '{s}'")
    for s in SNAPSHOTS))


# ---------------------------------------------------------------- typed text


@query(
    "features_long",
    """
    SELECT movie_id::VARCHAR AS movie_id, f.n AS feature_name, f.v AS feature_value, f.t AS feature_type,
      TIMESTAMP '2024-01-20' AS as_of_date
    FROM (SELECT movie_id, unnest([
        {'n': 'title', 'v': title, 't': 'str'},
        {'n': 'genres', 'v': to_json(genres)::VARCHAR, 't': 'list'},
        {'n': 'duration_seconds', 'v': duration_seconds::VARCHAR, 't': 'int'},
        {'n': 'is_long', 'v': (duration_seconds > 5000)::VARCHAR, 't': 'bool'},
        {'n': 'short_minutes', 'v': CASE WHEN duration_seconds <= 5000 THEN (duration_seconds / 64.0::DOUBLE)::VARCHAR END,
          't': CASE WHEN duration_seconds <= 5000 THEN 'float' ELSE 'null' END}]) AS f FROM items)""",
)
def features_long(t: Tables) -> DataFrame:
    return item_text_features(t).drop("created_at")


def item_text_features(t: Tables) -> DataFrame:
    seconds = F.col("duration_seconds")
    wide = t.items.select(
        "movie_id", "title", "genres", "duration_seconds",
        (seconds > 5000).alias("is_long"),
        F.when(seconds <= 5000, seconds / 64).alias("short_minutes"),
    )
    day = F.lit("2024-01-20 00:00:00")
    return store.to_long(wide, ["movie_id"], day, day)


@query(
    "features_typed",
    """
    SELECT movie_id::VARCHAR AS movie_id, unnest([
        {'feature_name': 'title', 'value_int': NULL::BIGINT, 'value_float': NULL::DOUBLE, 'value_bool': NULL::BOOLEAN,
         'value_json': NULL::VARCHAR, 'value_text': title},
        {'feature_name': 'genres', 'value_int': NULL, 'value_float': NULL, 'value_bool': NULL,
         'value_json': to_json(genres)::VARCHAR, 'value_text': NULL},
        {'feature_name': 'duration_seconds', 'value_int': duration_seconds::BIGINT, 'value_float': NULL,
         'value_bool': NULL, 'value_json': NULL, 'value_text': NULL},
        {'feature_name': 'is_long', 'value_int': NULL, 'value_float': NULL, 'value_bool': duration_seconds > 5000,
         'value_json': NULL, 'value_text': NULL},
        {'feature_name': 'short_minutes', 'value_int': NULL,
         'value_float': CASE WHEN duration_seconds <= 5000 THEN round(duration_seconds / 64.0::DOUBLE, 6) END,
         'value_bool': NULL, 'value_json': NULL, 'value_text': NULL}], recursive := true)
    FROM items""",
)
def features_typed(t: Tables) -> DataFrame:
    out = store.typed(item_text_features(t))
    return rounded(out.select("movie_id", "feature_name", "value_int", "value_float", "value_bool",
                              F.to_json("value_json").alias("value_json"), "value_text"))


# ---------------------------------------------------------------- reads

_PIT_SQL = """
    SELECT entity_type, entity_id, feature_name, feature_value, feature_type, as_of_date FROM (
      SELECT *, row_number() OVER (PARTITION BY entity_id, feature_name ORDER BY as_of_date DESC) AS rn
      FROM {table} WHERE as_of_date <= TIMESTAMP '{when}') WHERE rn = 1"""


@query("pit_lookup", _PIT_SQL.format(table="user_store", when=READ_AT))
def pit_lookup(t: Tables) -> DataFrame:
    return store.point_in_time(user_store(t), READ_AT)


@query(
    "pit_batch",
    f"""
    SELECT * FROM ({_PIT_SQL.format(table="user_store", when=READ_AT)})
    WHERE entity_id IN (SELECT user_id::VARCHAR FROM users WHERE region = 'REGION_1' OR age_group = '18-24')
    UNION ALL
    SELECT * FROM ({_PIT_SQL.format(table="movie_store", when=READ_AT)})
    WHERE entity_id IN (SELECT movie_id::VARCHAR FROM items WHERE duration_seconds > 4800)""",
)
def pit_batch(t: Tables) -> DataFrame:
    users = t.users.filter((F.col("region") == "REGION_1") | (F.col("age_group") == "18-24"))
    movies = t.items.filter("duration_seconds > 4800")
    return store.point_in_time_batch(
        full_store(t), READ_AT,
        users.select(F.col("user_id").alias("entity_id")), movies.select(F.col("movie_id").alias("entity_id")),
    )


@query(
    "features_wide",
    "SELECT entity_id, " + ", ".join(f"max(feature_value) FILTER (feature_name = '{c}') AS {c}" for c in USER_FEATURES)
    + f" FROM ({_PIT_SQL.format(table='user_store', when=READ_AT)}) GROUP BY entity_id",
)
def features_wide(t: Tables) -> DataFrame:
    return store.to_wide(store.point_in_time(user_store(t), READ_AT), USER_FEATURES).drop("entity_type")


@query(
    "feature_filter",
    f"""SELECT user_id::VARCHAR AS user_id, total_watch_time, avg_rating_given
        FROM ({user_activity_sql(SNAPSHOTS[1])}) WHERE total_watch_time > 2000""",
)
def feature_filter(t: Tables) -> DataFrame:
    long = store.point_in_time(user_snapshot(t, SNAPSHOTS[1]), READ_AT)
    wide = store.feature_history(
        long.withColumn("created_at", F.col("as_of_date")), {"total_watch_time": "double", "avg_rating_given": "double"}
    )
    return wide.filter("total_watch_time > 2000").select(
        F.col("entity_id").alias("user_id"), "total_watch_time", "avg_rating_given"
    )


@query(
    "asof_training_set",
    f"""
    SELECT e.event_id, e.user_id, e.movie_id, (e.event_type = 'view')::INTEGER AS label, h.total_watch_time,
      h.skip_rate, h.avg_rating_given, h.as_of_date AS features_as_of
    FROM interactions e ASOF LEFT JOIN (
      SELECT user_id, as_of_date, total_watch_time, skip_rate, avg_rating_given
      FROM (""" + " UNION ALL ".join(
        f"SELECT *, TIMESTAMP '{s}' AS as_of_date FROM ({user_activity_sql(s)})" for s in SNAPSHOTS) + """)) h
    ON e.user_id = h.user_id AND e."timestamp" >= h.as_of_date""",
)
def asof_training_set(t: Tables) -> DataFrame:
    wanted = {"total_watch_time": "double", "skip_rate": "double", "avg_rating_given": "double"}
    history = store.feature_history(user_store(t), wanted).select(
        F.col("entity_id").cast("bigint").alias("user_id"), "as_of_date", *wanted
    )
    out = store.asof_training_set(t.interactions, history, list(wanted))
    return out.select("event_id", "user_id", "movie_id", (F.col("event_type") == "view").cast("int").alias("label"),
                      *wanted, F.col("as_of_date").alias("features_as_of"))


@query(
    "fresh_features",
    """
    SELECT entity_type, entity_id, feature_name, feature_value, created_at
    FROM (SELECT * FROM user_store UNION ALL SELECT * FROM movie_store)
    WHERE created_at <= TIMESTAMP '2024-01-22 12:00:00'
      AND created_at > TIMESTAMP '2024-01-22 12:00:00' - CASE entity_type WHEN 'user' THEN INTERVAL 3600 SECOND
        ELSE INTERVAL 86400 SECOND END""",
)
def fresh_features(t: Tables) -> DataFrame:
    out = store.fresh_features(full_store(t), "2024-01-22 12:00:00")
    return out.select("entity_type", "entity_id", "feature_name", "feature_value", "created_at")


# ---------------------------------------------------------------- saves


@query(
    "store_upsert",
    f"""
    SELECT entity_type, entity_id, feature_name, feature_value, feature_type, as_of_date FROM user_store s
    WHERE NOT (as_of_date = TIMESTAMP '{SNAPSHOTS[0]}' AND EXISTS (
      SELECT 1 FROM user_store z WHERE z.entity_id = s.entity_id AND z.as_of_date = s.as_of_date
        AND z.feature_name = 'skip_rate' AND z.feature_value::DOUBLE > 0))
    UNION ALL
    SELECT entity_type, entity_id, feature_name, '72000.0', 'float', as_of_date FROM user_store
    WHERE as_of_date = TIMESTAMP '{SNAPSHOTS[0]}' AND feature_name = 'skip_rate' AND feature_value::DOUBLE > 0""",
)
def store_upsert(t: Tables) -> DataFrame:
    """Save three snapshots, then save the first one again for users who skip."""
    path = scratch_path(t.spark, "feature-store")
    store.save_features(path, user_store(t))
    again = user_snapshot(t, SNAPSHOTS[0]).filter("feature_name = 'skip_rate' AND cast(feature_value AS double) > 0")
    store.save_features(path, again.withColumn("feature_value", F.lit("72000.0")))
    return store.read_features(t.spark, path).drop("created_at", "as_of_day")


@query(
    "feature_versions",
    f"""
    WITH first_saved AS (SELECT DISTINCT entity_id FROM user_store WHERE as_of_date = TIMESTAMP '{SNAPSHOTS[0]}'),
      second_saved AS (SELECT DISTINCT entity_id FROM user_store WHERE as_of_date = TIMESTAMP '{SNAPSHOTS[1]}')
    SELECT 'user' AS entity_type, entity_id, TIMESTAMP '{SNAPSHOTS[0]}' AS as_of_date, 3::INTEGER AS version
    FROM first_saved
    UNION ALL
    SELECT 'user', entity_id, TIMESTAMP '{SNAPSHOTS[1]}',
      CASE WHEN entity_id IN (SELECT entity_id FROM first_saved) THEN 2 ELSE 1 END::INTEGER FROM second_saved""",
)
def feature_versions(t: Tables) -> DataFrame:
    """Save two snapshots, then the first again; versions are read from the stored table."""
    table = VersionedTable(t.spark, scratch_path(t.spark, "versioned-store"))
    first, second = (user_snapshot(t, s) for s in SNAPSHOTS[:2])
    for saved in (first, second, first):
        table.save(saved)
    return table.versions()


@query(
    "feature_snapshots",
    f"""
    WITH first_saved AS (SELECT DISTINCT entity_id FROM user_store WHERE as_of_date = TIMESTAMP '{SNAPSHOTS[0]}'),
      changed AS (SELECT DISTINCT entity_id FROM user_store WHERE as_of_date = TIMESTAMP '{SNAPSHOTS[0]}'
        AND feature_name = 'skip_rate' AND feature_value::DOUBLE > 0),
      rows AS (SELECT entity_id, feature_name, feature_value, as_of_date FROM user_store WHERE as_of_date IN (TIMESTAMP '{SNAPSHOTS[0]}', TIMESTAMP '{SNAPSHOTS[1]}'))
    SELECT 2::BIGINT AS save, as_of_date, feature_name, count(*) AS n, count(feature_value) AS n_set, 1::INTEGER AS lowest, max(v)::INTEGER AS highest FROM (
      SELECT r.*, CASE WHEN as_of_date > TIMESTAMP '{SNAPSHOTS[0]}' AND entity_id IN (FROM first_saved) THEN 2 ELSE 1 END AS v,
      FROM rows r) GROUP BY ALL HAVING min(v) = 1
    UNION ALL
    SELECT 2, as_of_date, feature_name, count(*), count(feature_value), 2, 2 FROM rows
    GROUP BY as_of_date, feature_name HAVING bool_and(as_of_date > TIMESTAMP '{SNAPSHOTS[0]}' AND entity_id IN (FROM first_saved))
    UNION ALL
    SELECT 3, as_of_date, feature_name, count(*), count(feature_value), min(v)::INTEGER, max(v)::INTEGER FROM (
      SELECT r.*, CASE WHEN as_of_date > TIMESTAMP '{SNAPSHOTS[0]}' THEN CASE WHEN entity_id IN (FROM first_saved) THEN 2 ELSE 1 END
          WHEN entity_id NOT IN (FROM changed) THEN 1
          WHEN entity_id IN (SELECT entity_id FROM rows WHERE as_of_date > TIMESTAMP '{SNAPSHOTS[0]}') THEN 3 ELSE 2 END AS v
      FROM rows r WHERE NOT (as_of_date = TIMESTAMP '{SNAPSHOTS[0]}' AND entity_id IN (FROM changed) AND feature_name <> 'skip_rate'))
    GROUP BY as_of_date, feature_name""",
)
def feature_snapshots(t: Tables) -> DataFrame:
    """The stored table after its second and its third save, by feature, with the lowest and highest version of its rows.

    The third save replaces some users' rows of the first day by one feature."""
    table = VersionedTable(t.spark, scratch_path(t.spark, "versioned-store"))
    first, second = (user_snapshot(t, s) for s in SNAPSHOTS[:2])
    again = first.filter("feature_name = 'skip_rate' AND cast(feature_value AS double) > 0")
    saves = [table.save(rows).number for rows in (first, second, again)]

    def state(number: int) -> DataFrame:
        rows = table.read(number=number).join(table.versions(number), [*store.ENTITY_KEY, "as_of_date"])
        return rows.groupBy("as_of_date", "feature_name").agg(
            F.count("*").alias("n"), F.count("feature_value").alias("n_set"), F.min("version").alias("lowest"), F.max("version").alias("highest"),
        ).withColumn("save", F.lit(number).cast("bigint"))

    return reduce(DataFrame.unionByName, [state(n) for n in saves[1:]])


@query(
    "wide_update",
    f"""
    SELECT user_id, total_watch_time + CASE WHEN skip_rate > 0.2 THEN 500 ELSE 0 END AS total_watch_time, skip_rate
    FROM ({user_activity_sql(SNAPSHOTS[1])})""",
)
def wide_update(t: Tables) -> DataFrame:
    wide = rounded(feats.user_activity(t.interactions, SNAPSHOTS[1])).select(
        "user_id", "total_watch_time", "skip_rate")
    updates = wide.filter("skip_rate > 0.2").select(
        "user_id", (F.col("total_watch_time") + 500).alias("total_watch_time"))
    return store.wide_update(wide, updates, ["user_id"])


@query(
    "pair_store",
    """
    SELECT user_id::VARCHAR AS user_id, movie_id::VARCHAR AS movie_id, 'views' AS feature_name,
      count(*)::VARCHAR AS feature_value, 'int' AS feature_type,
      CASE WHEN max("timestamp") >= TIMESTAMP '2024-01-08' THEN TIMESTAMP '2024-01-15' ELSE TIMESTAMP '2024-01-08' END
        AS as_of_date
    FROM interactions WHERE event_type = 'view' AND "timestamp" < TIMESTAMP '2024-01-15' GROUP BY user_id, movie_id""",
)
def pair_store(t: Tables) -> DataFrame:
    """Two snapshots of per-pair view counts, the second only for pairs active since the first."""
    views = t.interactions.filter("event_type = 'view'")

    def snapshot(until: str, since: str) -> DataFrame:
        seen = views.filter(F.col("timestamp") < F.lit(until).cast("timestamp_ntz"))
        wide = seen.groupBy("user_id", "movie_id").agg(F.count("*").alias("views"), F.max("timestamp").alias("last"))
        active = wide.filter(F.col("last") >= F.lit(since).cast("timestamp_ntz")).drop("last")
        return store.to_long(active, store.PAIR_KEY, F.lit(until), F.lit(until))

    rows = store.merge_features(
        snapshot("2024-01-08 00:00:00", "2000-01-01 00:00:00"),
        snapshot("2024-01-15 00:00:00", "2024-01-08 00:00:00"),
        store.PAIR_KEY,
    )
    return store.point_in_time(rows, READ_AT, store.PAIR_KEY)


@query(
    "feature_run",
    " UNION ALL ".join(
        _long_sql(sql, kind, key, columns, ints, "2024-01-20 00:00:00", "TIMESTAMP '2024-01-20'")
        for sql, kind, key, columns, ints in (
            (user_features_sql("2024-01-20 00:00:00"), "user", "user_id", ALL_USER_FEATURES, _USER_INTS | _MORE_INTS),
            (item_features_sql("2024-01-20 00:00:00"), "movie", "movie_id",
             ITEM_FEATURES, _ITEM_INTS),
        )
    ),
)
def feature_run(t: Tables) -> DataFrame:
    """The daily run: features of every user and movie as of one instant, saved and read back."""
    when = "2024-01-20 00:00:00"
    path = scratch_path(t.spark, "feature-run")
    users = rounded(feats.user_features(t.interactions, when, t.items)).select("user_id", *ALL_USER_FEATURES)
    movies = rounded(feats.item_features(t.interactions, when, t.items)).select(
        "movie_id", *ITEM_FEATURES)
    rows = store.entity_rows(users, "user_id", "user", F.lit(when), F.lit(when)).unionByName(
        store.entity_rows(movies, "movie_id", "movie", F.lit(when), F.lit(when)))
    store.save_features(path, rows)
    return store.read_features(t.spark, path).drop("as_of_day")
