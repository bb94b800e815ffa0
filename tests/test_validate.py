"""Boundary values of every event type, stamps, labels and templates."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from tidemark.functions.columns import endpoint_template
from tidemark.operators import validate
from tidemark.sources import events as sources
from tidemark.sources.schemas import CORRUPT, EVENT, conform

NOW = datetime(2024, 6, 1)
SCHEMA = T.StructType(
    [T.StructField(f.name, T.TimestampNTZType() if f.name == "timestamp" else f.dataType) for f in EVENT])
BASE = {
    "view": {"user_id": "user_123", "movie_id": "movie_456", "watch_time_seconds": 3600, "session_id": "session_789", "device": "desktop"},
    "rating": {"user_id": "user_123", "movie_id": "movie_456", "rating": 5.0},
    "search": {"user_id": "user_123", "query": "action movies", "results_count": 25},
    "skip": {"user_id": "user_123", "movie_id": "movie_456", "watch_duration_seconds": 600, "movie_duration_seconds": 5400},
}


def frame(spark, rows):
    full = [{"timestamp": datetime(2024, 5, 1), **r} for r in rows]
    return spark.createDataFrame([tuple(r.get(f.name) for f in SCHEMA) for r in full], SCHEMA)


CASES = [
    ("view", {}, []),
    ("view", {"watch_time_seconds": 0}, []),
    ("view", {"watch_time_seconds": 86400}, []),
    ("view", {"watch_time_seconds": 86401}, ["watch_time_seconds.range"]),
    ("view", {"watch_time_seconds": -1}, ["watch_time_seconds.range"]),
    ("view", {"watch_time_seconds": None}, ["watch_time_seconds.range"]),
    ("view", {"device": "mobile"}, []),
    ("view", {"device": "tablet"}, []),
    ("view", {"device": "tv"}, []),
    ("view", {"device": None, "session_id": None}, []),
    ("view", {"device": "watch"}, ["device.unknown"]),
    ("view", {"session_id": "s" * 256}, ["session_id.length"]),
    ("view", {"user_id": ""}, ["user_id.length"]),
    ("view", {"user_id": "u" * 255}, []),
    ("view", {"movie_id": "m" * 256}, ["movie_id.length"]),
    ("view", {"timestamp": datetime(2024, 6, 2)}, ["timestamp.future"]),
    ("view", {"timestamp": NOW}, []),
    ("view", {"timestamp": None}, ["timestamp.invalid"]),
    ("rating", {"rating": 1.0}, []),
    ("rating", {"rating": 3.5}, ["rating.range"]),
    ("rating", {"rating": 0.0}, ["rating.range"]),
    ("rating", {"rating": 6.0}, ["rating.range"]),
    ("search", {"results_count": 0}, []),
    ("search", {"query": ""}, ["query.empty"]),
    ("search", {"query": " \t "}, ["query.empty"]),
    ("search", {"query": "q" * 1001}, ["query.length"]),
    ("search", {"results_count": -1}, ["results_count.negative"]),
    ("skip", {"watch_duration_seconds": 0}, []),
    ("skip", {"watch_duration_seconds": 5400}, []),
    ("skip", {"watch_duration_seconds": 5401}, ["watch_duration_seconds.after_end"]),
    ("skip", {"watch_duration_seconds": -1}, ["watch_duration_seconds.negative"]),
    ("skip", {"movie_duration_seconds": 0}, ["movie_duration_seconds.positive", "watch_duration_seconds.after_end"]),
]


def test_boundaries_one_type_and_mixed(spark):
    rows = [{**BASE[kind], **change, "event_type": kind, "event_id": str(i)} for i, (kind, change, _) in enumerate(CASES)]
    df = frame(spark, rows)
    mixed = {int(r["event_id"]): r["errors"] for r in validate.validate_mixed(df, NOW).collect()}
    for kind in BASE:
        own = validate.validate_events(df.filter(F.col("event_type") == kind), kind, NOW)
        for r in own.collect():
            i = int(r["event_id"])
            assert r["errors"] == CASES[i][2] == mixed[i], CASES[i]


def test_future_is_after_the_run_when_no_time_is_given(spark):
    rows = [{**BASE["view"], "event_id": "past"}, {**BASE["view"], "event_id": "future", "timestamp": datetime(2999, 1, 1)}]
    got = {r["event_id"]: r["errors"] for r in validate.validate_events(frame(spark, rows), "view").collect()}
    assert got == {"past": [], "future": ["timestamp.future"]}


def test_unknown_type(spark):
    df = frame(spark, [{**BASE["view"], "event_type": "ping"}, {**BASE["view"], "event_type": None}])
    assert [r["errors"] for r in validate.validate_mixed(df, NOW).collect()] == [["event_type.unknown"]] * 2
    with pytest.raises(ValueError):
        validate.event_rules(df, "ping", NOW)


def test_good_and_bad_rows_split_everything(spark):
    df = frame(spark, [{**BASE["view"], "event_type": "view"}, {**BASE["view"], "event_type": "view", "user_id": None}])
    checked = validate.validate_mixed(df, NOW)
    assert validate.good_rows(checked).count() == 1 and validate.bad_rows(checked).count() == 1
    assert {(r["status"], r["events"]) for r in validate.outcomes(checked).collect()} == {("success", 1), ("error", 1)}


def test_timestamps(spark):
    texts = ["2024-01-01T10:00:00Z", "2024-01-01T10:00:00", "2024-01-01T12:00:00+02:00", "2024-01-01 10:00:00", "nonsense"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r["at"] for r in df.select(validate.normalise_timestamp("t").cast("timestamp_ntz").alias("at")).collect()]
    assert got == [datetime(2024, 1, 1, 10)] * 4 + [None]


def test_stamp_keeps_given_ids_and_repeats_itself(spark):
    rows = [("t", 0, 1, None), ("t", 0, 2, None), ("t", 1, 1, "given")]
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, event_id string")
    first = [r["event_id"] for r in validate.stamp(df, "view").orderBy("partition", "offset").collect()]
    again = [r["event_id"] for r in validate.stamp(df, "view").orderBy("partition", "offset").collect()]
    assert first == again and len(set(first)) == 3 and first[2] == "given"


def test_labels(spark):
    df = spark.createDataFrame([("view",), ("skip",)], "event_type string")
    assert [r["label"] for r in validate.with_label(df).collect()] == [1, 0]
    assert [r["label"] for r in validate.with_label(df.withColumn("label", F.lit(7))).collect()] == [7, 7]
    assert [r["label"] for r in validate.with_label(df.drop("event_type").withColumn("x", F.lit(0))).collect()] == [1, 1]


def test_endpoint_templates(spark):
    cases = {
        "/recommend/user_123": "/{recommend_id}",
        "/users/123/movies/9": "/{user_id}/{movie_id}",
        "/users/123e4567-e89b-12d3-a456-426614174000": "/{user_id}",
        "/health": "/health",
        "/users/{user_id}": "/users/{user_id}",
        "/123": "{_id}",
        "/class/1": "/{cla_id}",
        "/a/?k=10": "/a/?k=10",
        "/films/1/2": "/{{film_id}_id}",
    }
    df = spark.createDataFrame([(p,) for p in cases], "p string")
    assert {r["p"]: r["t"] for r in df.select("p", endpoint_template(F.col("p")).alias("t")).collect()} == cases


def test_decode_keeps_bad_json(spark):
    df = spark.createDataFrame([('{"user_id": "u", "rating": 4}', 1), ("{oops", 2), (None, 3)], "value string, n int")
    got = {r["n"]: r for r in sources.decode(df).collect()}
    assert got[1]["user_id"] == "u" and got[1]["rating"] == 4.0 and got[1][CORRUPT] is None
    assert got[2][CORRUPT] == "{oops" and got[2]["user_id"] is None


def test_load_interactions_checks_suffix_and_columns(spark, tmp_path):
    with pytest.raises(ValueError):
        sources.load_interactions(spark, "rows.json")
    path = str(tmp_path / "rows.csv")
    spark.createDataFrame([(1, 2)], "user_id int, movie_id int").write.option("header", True).csv(path)
    with pytest.raises(ValueError, match="timestamp, item_id"):
        sources.load_interactions(spark, path)


def test_route_quarantines_unknown_and_anonymous(spark):
    df = spark.createDataFrame([("view", "u"), ("ping", "u"), ("skip", None)], "event_type string, user_id string")
    assert [r["topic"] for r in sources.route(df).collect()] == ["movie-events-view", "movie-events-quarantine", "movie-events-quarantine"]
    assert sources.route(df, "x").first()["topic"] == "x-view"


def test_conform_adds_missing_columns(spark):
    got = conform(spark.createDataFrame([("u",)], "user_id string"), EVENT)
    assert got.columns == EVENT.fieldNames() and got.first()["movie_id"] is None


def test_users_and_items(spark):
    items = spark.createDataFrame(
        [(["Action"], 1900, 5, 0.0), (["Action", "Sci-Fi"], 2030, 240, 1.0), ([], 1899, 4, 1.1), (["Nope"], 2000, 241, -0.1)],
        "genres array<string>, release_year int, duration_minutes int, popularity_score double")
    assert [len(r["errors"]) for r in validate.validate_items(items).collect()] == [0, 0, 4, 3]
    users = spark.createDataFrame([("18-24", "EU"), ("12", "Mars")], "age_group string, region string")
    got = validate.validate_users(users).collect()
    assert [(len(r["errors"]), len(r["warnings"])) for r in got] == [(0, 0), (1, 1)]


def test_corrupt_records_and_first_copies(spark):
    from tidemark.operators import validate

    rows = [("a", datetime(2024, 1, 2), 2), ("a", datetime(2024, 1, 1), 5), ("b", datetime(2024, 1, 3), 1), ("b", datetime(2024, 1, 3), 0)]
    df = spark.createDataFrame(rows, "event_id string, timestamp timestamp_ntz, offset int")
    assert sorted((r.event_id, r.offset) for r in validate.dedup(df).collect()) == [("a", 5), ("b", 0)]
    scores = validate.clamp_score(spark.createDataFrame([(None,), (1.5,), (0.5,)], "score double")).collect()
    assert [(r.score, r.was_clamped) for r in scores] == [(None, False), (1.0, True), (0.5, False)]
