"""Event schemas. Never inferred: optional columns are null, not missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

# Event types, topic name, devices and limits.
EVENT_TYPES = ("view", "rating", "search", "skip")
TOPIC_PREFIX = "movie-events"
DEVICES = ("mobile", "tablet", "desktop", "tv")
MAX_WATCH_SECONDS = 86400
MAX_ID_LENGTH = 255
MAX_QUERY_LENGTH = 1000

_COMMON = [T.StructField("user_id", T.StringType()), T.StructField("timestamp", T.StringType())]
_STAMPS = [T.StructField(n, T.StringType()) for n in ("event_type", "event_id", "request_id")]
_MOVIE = [T.StructField("movie_id", T.StringType())]

_FIELDS = {
    "view": _MOVIE + [
        T.StructField("watch_time_seconds", T.LongType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("device", T.StringType()),
    ],
    "rating": _MOVIE + [T.StructField("rating", T.DoubleType())],
    "search": [T.StructField("query", T.StringType()), T.StructField("results_count", T.LongType())],
    "skip": _MOVIE + [
        T.StructField("watch_duration_seconds", T.LongType()),
        T.StructField("movie_duration_seconds", T.LongType()),
    ],
}

EVENT_SCHEMAS = {kind: T.StructType(_COMMON + fields + _STAMPS) for kind, fields in _FIELDS.items()}

CORRUPT = "_corrupt_record"


def _union_of_fields() -> T.StructType:
    seen: dict[str, T.StructField] = {}
    for schema in EVENT_SCHEMAS.values():
        for field in schema:
            seen.setdefault(field.name, field)
    return T.StructType(list(seen.values()))


EVENT = _union_of_fields()


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to ``schema``, adding columns the frame lacks as nulls."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
