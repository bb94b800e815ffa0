"""Row checks. Each adds an ``errors`` array naming every rule a row breaks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.columns import instant
from tidemark.sources.schemas import CORRUPT, DEVICES, EVENT_TYPES, MAX_ID_LENGTH, MAX_QUERY_LENGTH, MAX_WATCH_SECONDS

# Known genres, age groups, regions and item ranges.
GENRES = (
    "Action", "Adventure", "Animation", "Biography", "Comedy", "Crime", "Documentary", "Drama", "Family", "Fantasy",
    "Film-Noir", "History", "Horror", "Music", "Musical", "Mystery", "Romance", "Sci-Fi", "Sport", "Thriller", "War",
    "Western",
)
AGE_GROUPS = ("18-24", "25-34", "35-44", "45-54", "55+")
REGIONS = ("US-West", "US-East", "EU", "APAC", "US-Central", "LATAM")
YEARS = (1900, 2030)
DURATION_MINUTES = (5, 240)

Rule = tuple[str, Column]  # (error code, condition under which the row is bad)


def with_errors(df: DataFrame, rules: Sequence[Rule], name: str = "errors") -> DataFrame:
    """All broken rules per row; a rule whose condition is null counts as broken."""
    flagged = [F.when(F.coalesce(bad, F.lit(True)), F.lit(code)) for code, bad in rules]
    return df.withColumn(name, F.array_compact(F.array(*flagged)))


def _id(name: str) -> Rule:
    return f"{name}.length", ~F.length(name).between(1, MAX_ID_LENGTH)


def _common(df: DataFrame, now: str | datetime | None) -> list[Rule]:
    if now is None:
        latest = F.current_timestamp().cast(df.schema["timestamp"].dataType)
    else:
        latest = instant(df, "timestamp", now)
    at = F.col("timestamp")
    return [_id("user_id"), ("timestamp.invalid", at.isNull()), ("timestamp.future", at.isNotNull() & (at > latest))]


def _optional(bad: Column, *columns: str) -> Column:
    """``bad``, but a null column is fine."""
    given = F.lit(True)
    for c in columns:
        given = given & F.col(c).isNotNull()
    return given & bad


def trimmed(column: str) -> Column:
    return F.regexp_replace(column, r"^\s+|\s+$", "")


def event_rules(df: DataFrame, kind: str, now: str | datetime | None = None) -> list[Rule]:
    """Rules of one event type; without ``now`` the time of the run (or stream batch) is used."""
    rules = _common(df, now)
    if kind == "view":
        rules += [
            _id("movie_id"),
            ("watch_time_seconds.range", ~F.col("watch_time_seconds").between(0, MAX_WATCH_SECONDS)),
            ("session_id.length", _optional(F.length("session_id") > MAX_ID_LENGTH, "session_id")),
            ("device.unknown", _optional(~F.col("device").isin(*DEVICES), "device")),
        ]
    elif kind == "rating":
        whole = F.col("rating") == F.floor("rating")
        rules += [_id("movie_id"), ("rating.range", ~(F.col("rating").between(1, 5) & whole))]
    elif kind == "search":
        rules += [
            ("query.empty", F.length(trimmed("query")) == 0),
            ("query.length", F.length("query") > MAX_QUERY_LENGTH),
            ("results_count.negative", F.col("results_count") < 0),
        ]
    elif kind == "skip":
        watched, whole = F.col("watch_duration_seconds"), F.col("movie_duration_seconds")
        rules += [
            _id("movie_id"),
            ("watch_duration_seconds.negative", watched < 0),
            ("movie_duration_seconds.positive", whole <= 0),
            ("watch_duration_seconds.after_end", watched > whole),
        ]
    else:
        raise ValueError(f"unknown event type {kind}")
    return rules


def validate_events(events: DataFrame, kind: str, now: str | datetime | None = None) -> DataFrame:
    """Check rows of one event type."""
    return with_errors(events, event_rules(events, kind, now))


def validate_mixed(events: DataFrame, now: str | datetime | None = None) -> DataFrame:
    """Check rows of all event types in one pass, each by the rules of its own type."""
    rules: list[Rule] = [("event_type.unknown", ~F.col("event_type").isin(*EVENT_TYPES))]
    if CORRUPT in events.columns:
        rules.insert(0, ("record.corrupt", F.col(CORRUPT).isNotNull()))
    for kind in EVENT_TYPES:
        for code, bad in event_rules(events, kind, now):
            applies = F.col("event_type") == kind
            rules.append((code, F.coalesce(applies, F.lit(False)) & F.coalesce(bad, F.lit(True))))
    return with_errors(events, rules)


def good_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("errors") == 0).drop("errors")


def bad_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("errors") > 0)


def outcomes(checked: DataFrame) -> DataFrame:
    """Rows per event type and outcome, success or error."""
    status = F.when(F.size("errors") == 0, "success").otherwise("error")
    return checked.groupBy("event_type", status.alias("status")).agg(F.count("*").alias("events"))


def normalise_timestamp(column: str) -> Column:
    """ISO text to an instant; text without a zone means UTC, bad text is null."""
    return F.try_to_timestamp(F.col(column))


def stamp(events: DataFrame, event_type: str | None = None) -> DataFrame:
    """Fill event_id and request_id from the source position where they are missing.

    The position (topic, partition, offset) is stable, so a replay gives the same
    ids and two equal events at two positions stay two events.
    """
    position = F.concat_ws(":", "topic", "partition", "offset")

    def given(name: str) -> Column:
        return F.col(name).cast("string") if name in events.columns else F.lit(None).cast("string")

    stamps = {
        "event_id": F.coalesce(given("event_id"), F.sha2(position, 256)),
        "request_id": F.coalesce(given("request_id"), F.sha2(F.concat(F.lit("request:"), position), 256)),
    }
    if event_type is not None:
        stamps["event_type"] = F.lit(event_type)
    return events.withColumns(stamps)


def dedup(events: DataFrame) -> DataFrame:
    """One row per event_id: the earliest by (timestamp, source position, other values),
    so that copies that differ give the same survivor in every run."""
    first = [c for c in ("timestamp", "topic", "partition", "offset") if c in events.columns]
    rest = [c for c in events.columns if c not in first and c != "event_id"]
    kept = events.groupBy("event_id").agg(F.min(F.struct(*first, *rest)).alias("_first"))
    return kept.select(*["event_id" if c == "event_id" else F.col("_first")[c].alias(c) for c in events.columns])


def validate_items(items: DataFrame) -> DataFrame:
    known = F.array(*[F.lit(g) for g in GENRES])
    return with_errors(
        items,
        [
            ("genres.empty", F.size("genres") < 1),
            ("genres.unknown", F.size(F.array_except("genres", known)) > 0),
            ("release_year.range", ~F.col("release_year").between(*YEARS)),
            ("duration_minutes.range", ~F.col("duration_minutes").between(*DURATION_MINUTES)),
            ("popularity_score.range", ~F.col("popularity_score").between(0.0, 1.0)),
        ],
    )


def validate_users(users: DataFrame) -> DataFrame:
    """An unknown age group is an error; an unknown region only a warning."""
    checked = with_errors(users, [("age_group.unknown", ~F.col("age_group").isin(*AGE_GROUPS))])
    return with_errors(checked, [("region.unknown", ~F.col("region").isin(*REGIONS))], "warnings")


def clamp_score(df: DataFrame, column: str = "score") -> DataFrame:
    """Score held to [0, 1], with a flag where that changed it; a null score stays null, unflagged."""
    score = F.col(column)
    held = F.when(score.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)))
    return df.withColumns({"was_clamped": F.coalesce((score < 0) | (score > 1), F.lit(False)), column: held})


def with_label(events: DataFrame) -> DataFrame:
    """Keep a given label; else 1 for views and 0 otherwise; 1 where there is no event type."""
    if "label" in events.columns:
        return events
    if "event_type" in events.columns:
        return events.withColumn("label", F.when(F.col("event_type") == "view", 1).otherwise(0))
    return events.withColumn("label", F.lit(1))
