"""Hand-worked features, and the store's saves and point-in-time reads."""

import json
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.operators import features, store

T0 = "2024-01-20 00:00:00"
EVENTS = "user_id string, movie_id string, event_type string, timestamp timestamp_ntz, watch_time_seconds bigint, rating int"


def at(day, hour=0):
    return datetime(2024, 1, day, hour)


@pytest.fixture
def events(spark):
    return spark.createDataFrame(
        [
            ("u1", "m1", "view", at(20), 100, 4),      # exactly at the instant: counts
            ("u1", "m1", "view", at(13), 300, None),   # exactly 7 days before: outside the 7-day window
            ("u1", "m2", "view", at(14, 5), 200, 2),
            ("u1", "m2", "skip", at(10, 5), None, None),
            ("u1", "m1", "view", at(21), 999, 1),      # after the instant: ignored
            ("u2", None, "search", at(3, 9), None, None),
            ("u2", "m1", "rating", at(3, 8), None, 5),
        ],
        EVENTS,
    )


@pytest.fixture
def items(spark):
    return spark.createDataFrame(
        [("m1", ["Action", " Drama "], 200, datetime(2024, 1, 10, 12)), ("m2", ["Drama"], 0, None), ("m3", ["War"], 50, datetime(2024, 1, 25))],
        "movie_id string, genres array<string>, duration_seconds int, release_date timestamp_ntz")


def test_user_features(events, items, spark):
    users = spark.createDataFrame([("u1",), ("u2",), ("u3",)], "user_id string")
    got = {r["user_id"]: r.asDict() for r in features.user_features(events, T0, items, users).collect()}
    u1 = got["u1"]
    assert (u1["total_watch_time"], u1["avg_watch_time_per_movie"]) == (600.0, 200.0)
    assert (u1["watch_count_last_7days"], u1["watch_count_last_30days"], u1["watch_count_last_90days"]) == (2, 3, 3)
    assert (u1["unique_genres_watched"], u1["favorite_genre"]) == (2, "Drama")
    assert (u1["avg_rating_given"], u1["skip_rate"], u1["days_since_last_watch"]) == (3.0, 0.25, 0)
    assert u1["peak_activity_hour"] == 0  # two events at 0, two at 5: the earlier hour
    u2 = got["u2"]
    assert (u2["total_watch_time"], u2["avg_rating_given"], u2["favorite_genre"], u2["days_since_last_watch"]) == (0.0, 5.0, None, None)
    u3 = got["u3"]
    assert (u3["total_watch_time"], u3["watch_count_last_7days"], u3["skip_rate"], u3["unique_genres_watched"]) == (0.0, 0, 0.0, 0)
    assert u3["favorite_genre"] is None and u3["peak_activity_hour"] is None


def test_genres_as_comma_text_on_events(spark):
    df = spark.createDataFrame(
        [("u", "view", at(1), "Action, Drama"), ("u", "view", at(2), "Drama"), ("u", "view", at(3), None)],
        "user_id string, event_type string, timestamp timestamp_ntz, genres string")
    row = features.user_genres(df, T0).first()
    assert (row["unique_genres_watched"], row["favorite_genre"]) == (2, "Drama")


def test_item_features(events, items):
    got = {r["movie_id"]: r.asDict() for r in features.item_features(events, T0, items, keep_all_items=True).collect()}
    m1 = got["m1"]
    assert (m1["total_views"], m1["unique_viewers"], m1["avg_rating"]) == (2, 1, 4.0)  # the rating event does not count
    assert m1["completion_rate"] == (0.5 + 1.0) / 2
    assert m1["popularity_trend"] == 0.0  # one view in each week
    assert m1["days_since_release"] == 9
    m2 = got["m2"]
    assert (m2["total_views"], m2["completion_rate"], m2["popularity_trend"], m2["days_since_release"]) == (1, 0.0, 1.0, None)
    m3 = got["m3"]
    assert (m3["total_views"], m3["unique_viewers"], m3["popularity_trend"], m3["days_since_release"]) == (0, 0, 0.0, -5)


def test_pair_features(spark):
    users = spark.createDataFrame([("u", "Action", 2, 20), ("v", None, None, 5)], "user_id string, favorite_genre string, days_since_last_watch bigint, watch_count_last_30days bigint")
    movies = spark.createDataFrame([("a", 0), ("b", 9), ("c", 99), ("d", 999), ("e", 1000)], "movie_id string, total_views bigint")
    pairs = spark.createDataFrame(
        [("u", "a", "Action, War"), ("u", "b", "action-adventure"), ("u", "c", "War"), ("u", "d", None), ("v", "e", "Action"), ("x", "y", "Action")],
        "user_id string, movie_id string, genres string")
    got = {(r["user_id"], r["movie_id"]): r for r in features.pair_features(pairs, users, movies).collect()}
    assert [got[("u", m)]["user_movie_genre_match"] for m in "abcd"] == [1.0, 0.5, 0.0, 0.0]
    assert [got[("u", m)]["movie_popularity_percentile"] for m in "abcd"] == [0.0, 0.25, 0.5, 0.75]
    assert got[("v", "e")]["movie_popularity_percentile"] == 0.95
    assert got[("u", "a")]["time_since_user_last_active"] == 48.0 and got[("v", "e")]["time_since_user_last_active"] is None
    assert [got[k]["user_activity_level"] for k in (("u", "a"), ("v", "e"), ("x", "y"))] == ["high", "medium", "low"]
    assert got[("x", "y")]["user_movie_genre_match"] == 0.0 and got[("x", "y")]["movie_popularity_percentile"] == 0.0


def test_daily_counts_add_up(events):
    daily = features.daily_user_counts(events)
    got = {r["user_id"]: (r["events"], r["views"], r["skips"], r["watch_time"]) for r in features.merge_daily_counts(daily, "2024-01-21", 12).collect()}
    assert got == {"u1": (4, 3, 1, 600.0)}


# ---------------------------------------------------------------- store


def rows(spark, entity, when, **values):
    wide = spark.createDataFrame([(entity, *values.values())], ["user_id", *values])
    return store.entity_rows(wide, "user_id", "user", F.lit(when), F.lit(when))


def test_mixed_types_come_back_typed(spark):
    wide = spark.sql("""SELECT 'u' AS user_id, 36000.0D AS watch, 10 AS n, 'Action' AS genre, true AS premium,
        array('Action', 'Sci-Fi') AS genres, named_struct('theme', 'dark') AS prefs, CAST(NULL AS INT) AS missing""")
    long = store.entity_rows(wide, "user_id", "user", F.lit("2024-01-01"), F.lit("2024-01-01"))
    got = {r["feature_name"]: r for r in store.typed(long).withColumn("value_json", F.to_json("value_json")).collect()}
    assert got["watch"]["value_float"] == 36000.0 and got["n"]["value_int"] == 10 and got["genre"]["value_text"] == "Action"
    assert got["premium"]["value_bool"] is True
    assert json.loads(got["genres"]["value_json"]) == ["Action", "Sci-Fi"] and json.loads(got["prefs"]["value_json"]) == {"theme": "dark"}
    assert got["missing"]["feature_type"] == "null" and got["missing"]["feature_value"] is None
    assert {n: r["feature_type"] for n, r in got.items()}["prefs"] == "dict"


def test_bad_text_stays_text(spark):
    df = spark.createDataFrame([("x1", "int"), ("[1,", "list"), ("YES", "bool"), ("no", "bool"), ("1.5", "float")], "feature_value string, feature_type string")
    got = {r["feature_value"]: r for r in store.typed(df).collect()}
    assert got["x1"]["value_text"] == "x1" and got["[1,"]["value_text"] == "[1,"
    assert got["YES"]["value_bool"] is True and got["no"]["value_bool"] is False and got["1.5"]["value_float"] == 1.5


def test_overwrite_and_history(spark, tmp_path):
    path = str(tmp_path / "store")
    store.save_features(path, rows(spark, "u1", "2024-01-01 00:00:00", total_watch_time=36000.0, extra=1))
    store.save_features(path, rows(spark, "u2", "2024-01-01 00:00:00", total_watch_time=5.0))
    store.save_features(path, rows(spark, "u1", "2024-01-01 00:00:00", total_watch_time=72000.0))
    store.save_features(path, rows(spark, "u1", "2024-01-08 00:00:00", total_watch_time=1.0))
    store.save_features(path, rows(spark, "u1", "2024-01-08 00:00:00", total_watch_time=1.0).limit(0))  # no-op
    table = store.read_features(spark, path)
    assert table.count() == 3
    got = {r["entity_id"]: r["feature_value"] for r in store.point_in_time(table, "2024-01-04 00:00:00").collect()}
    assert got == {"u1": "72000.0", "u2": "5.0"}


def test_point_in_time_takes_each_feature_from_its_own_snapshot(spark):
    table = rows(spark, "u", "2024-01-01 00:00:00", a=10000.0, b=1).unionByName(rows(spark, "u", "2024-01-08 00:00:00", a=20000.0))
    read = lambda when: {r["feature_name"]: r["feature_value"] for r in store.point_in_time(table, when).collect()}
    assert read("2024-01-04 00:00:00") == {"a": "10000.0", "b": "1"}
    assert read("2024-01-11 00:00:00") == {"a": "20000.0", "b": "1"}
    assert read("2023-12-31 00:00:00") == {}


def test_batch_read(spark):
    movie = store.entity_rows(spark.createDataFrame([("m", 3)], "movie_id string, views int"), "movie_id", "movie", F.lit("2024-01-01"), F.lit("2024-01-01"))
    table = rows(spark, "u", "2024-01-01 00:00:00", a=1).unionByName(rows(spark, "other", "2024-01-01 00:00:00", a=1)).unionByName(movie)
    ids = lambda x: spark.createDataFrame([(x,)], "entity_id string")
    both = store.point_in_time_batch(table, "2024-02-01 00:00:00", ids("u"), ids("m")).collect()
    assert {(r["entity_type"], r["entity_id"]) for r in both} == {("user", "u"), ("movie", "m")}
    assert store.point_in_time_batch(table, "2024-02-01 00:00:00", None, ids("m")).count() == 1
    with pytest.raises(ValueError):
        store.point_in_time_batch(table, "2024-02-01 00:00:00")


def test_empty_id_fails(spark):
    with pytest.raises(PySparkException, match="must not be empty"):
        rows(spark, "", "2024-01-01 00:00:00", a=1).collect()


def test_versions(spark):
    versions = spark.createDataFrame([], store.VERSIONS)
    for when in ("2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-01 00:00:00"):
        versions = store.next_versions(versions, rows(spark, "u", when, a=1))
    assert {(r["as_of_date"].day, r["version"]) for r in versions.collect()} == {(1, 3), (2, 2)}


def test_wide_update(spark):
    wide = spark.createDataFrame([("a", 1, 0.5), ("b", 2, 0.5)], "user_id string, n int, r double")
    new = spark.createDataFrame([("b", 9), ("c", 3)], "user_id string, n int")
    got = {tuple(r) for r in store.wide_update(wide, new, ["user_id"]).collect()}
    assert got == {("a", 1, 0.5), ("b", 9, 0.5), ("c", 3, None)}


def test_fresh_features(spark):
    table = rows(spark, "u", "2024-01-01 10:00:00", a=1).unionByName(rows(spark, "v", "2024-01-01 11:30:00", a=1))
    movie = store.entity_rows(spark.createDataFrame([("m", 3)], "movie_id string, views int"), "movie_id", "movie", F.lit("2024-01-01"), F.lit("2024-01-01 10:00:00"))
    got = {r["entity_id"] for r in store.fresh_features(table.unionByName(movie), "2024-01-01 12:00:00").collect()}
    assert got == {"v", "m"}


def test_history_agrees_with_the_point_in_time_on_nulls(spark):
    rows = [("user", "u", "a", "1.0", "float", 1), ("user", "u", "b", "5.0", "float", 1), ("user", "u", "a", None, "null", 8)]
    df = spark.createDataFrame(rows, "entity_type string, entity_id string, feature_name string, feature_value string, feature_type string, day int")
    at = F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.col("day"), F.lit(0), F.lit(0), F.lit(0))
    saved = df.withColumn("as_of_date", at).withColumn("created_at", at).drop("day")
    history = {r.as_of_date.day: (r.a, r.b) for r in store.feature_history(saved, {"a": "double", "b": "double"}).collect()}
    assert history == {1: (1.0, 5.0), 8: (None, 5.0)}
    read = {r.feature_name: r.feature_value for r in store.point_in_time(saved, "2024-01-09 00:00:00").collect()}
    assert read == {"a": None, "b": "5.0"}
