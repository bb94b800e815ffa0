"""Summaries of users, items and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.columns import as_genre_list, sum_if
from tidemark.operators.features import VIEW

TOP_GENRES = 10  # fixed value


def profile_users(users: DataFrame) -> DataFrame:
    """Users by age group and by region, in one pass: (attribute, value, users)."""
    sets = [["age_group"], ["region"]]
    counted = users.groupingSets(sets, "age_group", "region").agg(F.count("*").alias("users"), F.grouping("age_group").alias("_g"))
    by_region = F.col("_g") == 1
    return counted.select(
        F.when(by_region, "region").otherwise("age_group").alias("attribute"),
        F.when(by_region, F.col("region")).otherwise(F.col("age_group")).alias("value"), "users")


def top_genres(items: DataFrame, n: int = TOP_GENRES) -> DataFrame:
    genres = items.select(F.explode(as_genre_list(items, "genres")).alias("genre"))
    return genres.groupBy("genre").agg(F.count("*").alias("items")).orderBy(F.desc("items"), "genre").limit(n)


def profile_items(items: DataFrame) -> DataFrame:
    """Least, greatest and mean release year and duration."""
    parts = []
    for column in ("release_year", "duration_minutes"):
        parts += [F.min(column).alias(f"min_{column}"), F.max(column).alias(f"max_{column}"), F.avg(column).alias(f"mean_{column}")]
    return items.agg(F.count("*").alias("items"), *parts)


def profile_events(events: DataFrame) -> DataFrame:
    """Per event type and, as type ``all``, in total: events, views, ratings and means."""
    is_view = F.col("event_type") == VIEW
    watch = F.when(is_view, F.col("watch_time_seconds"))
    counted = events.rollup("event_type").agg(
        F.count("*").alias("events"), F.count_if(is_view).alias("views"), F.count("rating").alias("ratings"),
        F.avg(watch).alias("mean_watch_time"), F.avg("rating").alias("mean_rating"),
        F.coalesce(sum_if(is_view, F.col("watch_time_seconds")), F.lit(0)).alias("watch_time"), F.grouping("event_type").alias("_g"))
    return counted.withColumn("event_type", F.when(F.col("_g") == 1, "all").otherwise(F.col("event_type"))).drop("_g")
