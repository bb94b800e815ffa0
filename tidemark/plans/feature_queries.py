"""Feature queries: users, items, pairs and incremental counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators import features as feats
from tidemark.plans.registry import query
from tidemark.plans.tables import AS_OF, Tables


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles so that both engines' summation orders give one value."""
    return df.select(
        *[F.round(f.name, digits).alias(f.name) if f.dataType.typeName() in ("double", "float") else F.col(f.name)
          for f in df.schema]
    )


# ---------------------------------------------------------------- SQL parts


def user_activity_sql(t: str) -> str:
    return f"""
      SELECT user_id,
        round(coalesce(sum(watch_time_seconds) FILTER (event_type = 'view'), 0)::DOUBLE, 6) AS total_watch_time,
        CASE WHEN count(*) FILTER (event_type = 'view') = 0 THEN 0.0::DOUBLE
          ELSE round(avg(watch_time_seconds) FILTER (event_type = 'view'), 6) END AS avg_watch_time_per_movie,
        count(*) FILTER (event_type = 'view' AND "timestamp" > TIMESTAMP '{t}' - INTERVAL 7 DAY)
          AS watch_count_last_7days,
        count(*) FILTER (event_type = 'view' AND "timestamp" > TIMESTAMP '{t}' - INTERVAL 30 DAY)
          AS watch_count_last_30days,
        count(*) FILTER (event_type = 'view' AND "timestamp" > TIMESTAMP '{t}' - INTERVAL 90 DAY)
          AS watch_count_last_90days,
        round(avg(rating), 6) AS avg_rating_given,
        round((count(*) FILTER (event_type = 'skip'))::DOUBLE / count(*), 6) AS skip_rate,
        floor((epoch_us(TIMESTAMP '{t}') - epoch_us(max("timestamp") FILTER (event_type = 'view')))
          / 86400000000.0::DOUBLE)::BIGINT AS days_since_last_watch
      FROM interactions WHERE "timestamp" <= TIMESTAMP '{t}' GROUP BY user_id"""


def peak_hour_sql(t: str) -> str:
    return f"""
      SELECT user_id, hr AS peak_activity_hour FROM (
        SELECT user_id, hour("timestamp")::INTEGER AS hr,
          row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, hour("timestamp")) AS rn
        FROM interactions WHERE "timestamp" <= TIMESTAMP '{t}' GROUP BY user_id, hour("timestamp")) WHERE rn = 1"""


def user_genres_sql(t: str) -> str:
    return f"""
      SELECT user_id, count(*) AS unique_genres_watched, arg_min(genre, rn) AS favorite_genre FROM (
        SELECT user_id, genre, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, genre) AS rn
        FROM (SELECT user_id, unnest(genres) AS genre FROM interactions JOIN items USING (movie_id)
              WHERE event_type = 'view' AND "timestamp" <= TIMESTAMP '{t}')
        GROUP BY user_id, genre) GROUP BY user_id"""


USER_COLUMNS = (
    "total_watch_time, avg_watch_time_per_movie, watch_count_last_7days, watch_count_last_30days, "
    "watch_count_last_90days, avg_rating_given, skip_rate, days_since_last_watch"
)


def user_features_sql(t: str) -> str:
    return f"""
      SELECT user_id, {USER_COLUMNS}, peak_activity_hour,
        coalesce(unique_genres_watched, 0) AS unique_genres_watched, favorite_genre
      FROM ({user_activity_sql(t)}) a JOIN ({peak_hour_sql(t)}) p USING (user_id)
      LEFT JOIN ({user_genres_sql(t)}) g USING (user_id)"""


def item_features_sql(t: str) -> str:
    return f"""
      SELECT movie_id, total_views, unique_viewers, avg_rating, popularity_trend,
        coalesce(completion_rate, 0.0::DOUBLE) AS completion_rate, days_since_release
      FROM (
        SELECT movie_id, count(*) FILTER (event_type = 'view') AS total_views,
          count(DISTINCT user_id) FILTER (event_type = 'view') AS unique_viewers,
          round(avg(rating) FILTER (event_type = 'view'), 6) AS avg_rating,
          round(CASE WHEN p7 = 0 THEN CASE WHEN v7 > 0 THEN 1.0 ELSE 0.0 END
            ELSE (v7 - p7)::DOUBLE / p7 END, 6)::DOUBLE AS popularity_trend
        FROM interactions JOIN (
          SELECT movie_id,
            count(*) FILTER (event_type = 'view' AND "timestamp" > TIMESTAMP '{t}' - INTERVAL 7 DAY) AS v7,
            count(*) FILTER (event_type = 'view' AND "timestamp" > TIMESTAMP '{t}' - INTERVAL 14 DAY
              AND "timestamp" <= TIMESTAMP '{t}' - INTERVAL 7 DAY) AS p7
          FROM interactions WHERE "timestamp" <= TIMESTAMP '{t}' GROUP BY movie_id) USING (movie_id)
        WHERE "timestamp" <= TIMESTAMP '{t}' GROUP BY movie_id, v7, p7) v
      LEFT JOIN (
        SELECT movie_id, round(avg(CASE WHEN watch_time_seconds IS NOT NULL THEN least(watch_time_seconds::DOUBLE / duration_seconds, 1.0::DOUBLE) END), 6)
          AS completion_rate
        FROM interactions JOIN items USING (movie_id)
        WHERE event_type = 'view' AND "timestamp" <= TIMESTAMP '{t}' GROUP BY movie_id) c USING (movie_id)
      LEFT JOIN (SELECT movie_id, floor((epoch_us(TIMESTAMP '{t}') - epoch_us(release_date))
          / 86400000000.0::DOUBLE)::BIGINT AS days_since_release FROM items) r USING (movie_id)"""


# ---------------------------------------------------------------- users

_UF = f"({user_features_sql(AS_OF)})"


@query("user_features", user_features_sql(AS_OF))
def user_features(t: Tables) -> DataFrame:
    return rounded(feats.user_features(t.interactions, AS_OF, t.items))


@query("user_watch_time", f"SELECT user_id, total_watch_time, avg_watch_time_per_movie FROM {_UF}")
def user_watch_time(t: Tables) -> DataFrame:
    out = feats.user_activity(t.interactions, AS_OF)
    return rounded(out.select("user_id", "total_watch_time", "avg_watch_time_per_movie"))


@query(
    "user_window_counts",
    f"SELECT user_id, watch_count_last_7days, watch_count_last_30days, watch_count_last_90days FROM {_UF}",
)
def user_window_counts(t: Tables) -> DataFrame:
    counts = [f"watch_count_last_{d}days" for d in feats.WATCH_WINDOWS_DAYS]
    return feats.user_activity(t.interactions, AS_OF).select("user_id", *counts)


@query("user_genres", user_genres_sql(AS_OF))
def user_genres(t: Tables) -> DataFrame:
    return feats.user_genres(t.interactions, AS_OF, t.items)


@query("user_rating_skip", f"SELECT user_id, avg_rating_given, skip_rate FROM {_UF}")
def user_rating_skip(t: Tables) -> DataFrame:
    return rounded(feats.user_activity(t.interactions, AS_OF).select("user_id", "avg_rating_given", "skip_rate"))


@query("user_peak_hour", peak_hour_sql(AS_OF))
def user_peak_hour(t: Tables) -> DataFrame:
    return feats.user_activity(t.interactions, AS_OF).select("user_id", "peak_activity_hour")


@query("user_recency", f"SELECT user_id, days_since_last_watch FROM {_UF}")
def user_recency(t: Tables) -> DataFrame:
    return feats.user_activity(t.interactions, AS_OF).select("user_id", "days_since_last_watch")


@query(
    "user_features_defaults",
    f"""
    SELECT u.user_id,
      coalesce(total_watch_time, 0.0::DOUBLE) AS total_watch_time,
      coalesce(avg_watch_time_per_movie, 0.0::DOUBLE) AS avg_watch_time_per_movie,
      coalesce(watch_count_last_7days, 0) AS watch_count_last_7days,
      coalesce(watch_count_last_30days, 0) AS watch_count_last_30days,
      coalesce(watch_count_last_90days, 0) AS watch_count_last_90days,
      coalesce(unique_genres_watched, 0) AS unique_genres_watched, favorite_genre, avg_rating_given,
      coalesce(skip_rate, 0.0::DOUBLE) AS skip_rate, peak_activity_hour, days_since_last_watch
    FROM users u LEFT JOIN {_UF} f ON u.user_id = f.user_id""",
)
def user_features_defaults(t: Tables) -> DataFrame:
    return rounded(feats.user_features(t.interactions, AS_OF, t.items, users=t.users))


# ---------------------------------------------------------------- items

_IF = f"({item_features_sql(AS_OF)})"


@query("item_features", item_features_sql(AS_OF))
def item_features(t: Tables) -> DataFrame:
    return rounded(feats.item_features(t.interactions, AS_OF, t.items))


@query("item_views", f"SELECT movie_id, total_views, unique_viewers FROM {_IF}")
def item_views(t: Tables) -> DataFrame:
    return feats.item_activity(t.interactions, AS_OF).select("movie_id", "total_views", "unique_viewers")


@query("item_rating", f"SELECT movie_id, avg_rating FROM {_IF}")
def item_rating(t: Tables) -> DataFrame:
    return rounded(feats.item_activity(t.interactions, AS_OF).select("movie_id", "avg_rating"))


@query("item_completion", f"SELECT movie_id, completion_rate FROM {_IF} WHERE total_views > 0")
def item_completion(t: Tables) -> DataFrame:
    return rounded(feats.item_completion(t.interactions, AS_OF, t.items))


@query("item_trend", f"SELECT movie_id, popularity_trend FROM {_IF}")
def item_trend(t: Tables) -> DataFrame:
    return rounded(feats.item_activity(t.interactions, AS_OF).select("movie_id", "popularity_trend"))


@query("item_release_age", f"SELECT movie_id, days_since_release FROM {_IF}")
def item_release_age(t: Tables) -> DataFrame:
    return feats.item_features(t.interactions, AS_OF, t.items).select("movie_id", "days_since_release")


_ITEM_DEFAULTS_SQL = f"""
    SELECT i.movie_id, coalesce(total_views, 0) AS total_views, coalesce(unique_viewers, 0) AS unique_viewers,
      avg_rating, coalesce(popularity_trend, 0.0::DOUBLE) AS popularity_trend,
      coalesce(completion_rate, 0.0::DOUBLE) AS completion_rate,
      floor((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(release_date)) / 86400000000.0::DOUBLE)::BIGINT
        AS days_since_release
    FROM items i LEFT JOIN {_IF} f ON i.movie_id = f.movie_id"""


@query("item_features_defaults", _ITEM_DEFAULTS_SQL)
def item_features_defaults(t: Tables) -> DataFrame:
    return rounded(feats.item_features(t.interactions, AS_OF, t.items, keep_all_items=True))


# ---------------------------------------------------------------- pairs

_PAIR_ROWS_SQL = "SELECT DISTINCT user_id, movie_id FROM interactions WHERE event_type IN ('view', 'rating')"


@query(
    "pair_features",
    f"""
    SELECT p.user_id, p.movie_id,
      CASE WHEN favorite_genre IS NULL OR genres IS NULL THEN 0.0::DOUBLE
        WHEN list_contains(genres, favorite_genre) THEN 1.0::DOUBLE
        WHEN len(list_filter(genres, lambda g: contains(lower(g), lower(favorite_genre))
          OR contains(lower(favorite_genre), lower(g)))) > 0 THEN 0.5::DOUBLE
        ELSE 0.0::DOUBLE END AS user_movie_genre_match,
      (days_since_last_watch * 24)::DOUBLE AS time_since_user_last_active,
      CASE WHEN coalesce(total_views, 0) = 0 THEN 0.0 WHEN total_views < 10 THEN 0.25
        WHEN total_views < 100 THEN 0.5 WHEN total_views < 1000 THEN 0.75
        ELSE 0.95 END::DOUBLE AS movie_popularity_percentile,
      CASE WHEN watch_count_last_30days >= 20 THEN 'high' WHEN watch_count_last_30days >= 5 THEN 'medium'
        ELSE 'low' END AS user_activity_level
    FROM ({_PAIR_ROWS_SQL}) p LEFT JOIN items m ON p.movie_id = m.movie_id
    LEFT JOIN {_UF} u ON p.user_id = u.user_id LEFT JOIN {_IF} i ON p.movie_id = i.movie_id""",
)
def pair_features(t: Tables) -> DataFrame:
    pairs = t.interactions.filter(F.col("event_type").isin("view", "rating")).select("user_id", "movie_id").distinct()
    pairs = pairs.join(t.items.select("movie_id", "genres"), "movie_id", "left")
    out = feats.pair_features(
        pairs,
        feats.user_features(t.interactions, AS_OF, t.items),
        feats.item_activity(t.interactions, AS_OF),
    )
    return out.drop("genres")


@query(
    "popularity_percentile",
    f"""SELECT movie_id, total_views, round(percent_rank() OVER (ORDER BY total_views), 6) AS percentile
        FROM ({_ITEM_DEFAULTS_SQL})""",
)
def popularity_percentile(t: Tables) -> DataFrame:
    out = feats.item_features(t.interactions, AS_OF, t.items, keep_all_items=True)
    return rounded(feats.popularity_percentile(out))


# ---------------------------------------------------------------- incremental


@query(
    "incremental_user_counts",
    """
    SELECT user_id, count(*) AS events, count(*) FILTER (event_type = 'view') AS views,
      count(*) FILTER (event_type = 'skip') AS skips,
      coalesce(sum(watch_time_seconds) FILTER (event_type = 'view'), 0)::DOUBLE AS watch_time
    FROM interactions WHERE "timestamp" >= TIMESTAMP '2024-01-13' AND "timestamp" < TIMESTAMP '2024-01-20'
    GROUP BY user_id""",
)
def incremental_user_counts(t: Tables) -> DataFrame:
    return feats.merge_daily_counts(feats.daily_user_counts(t.interactions), "2024-01-20", 7)
