"""Versioned feature store kept as long tables of Parquet.

One row per (entity, feature, as_of): the value as text plus its type name. A
save replaces all rows of the saved (entity, as_of) keys and keeps all other
history. Tables are partitioned by as_of day, so a save rewrites, and a
point-in-time read scans, only the days it needs.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from tidemark.functions.columns import instant, micros
from tidemark.functions.ordering import asof_lookup
from tidemark.session import stage

ENTITY_KEY = ("entity_type", "entity_id")
PAIR_KEY = ("user_id", "movie_id")

_VALUE_FIELDS = [
    T.StructField("feature_name", T.StringType(), False),
    T.StructField("feature_value", T.StringType()),
    T.StructField("feature_type", T.StringType(), False),
    T.StructField("as_of_date", T.TimestampNTZType(), False),
    T.StructField("created_at", T.TimestampNTZType()),
]

# Table layouts: user and movie features share one long table told apart by entity_type.
FEATURES = T.StructType([T.StructField(c, T.StringType(), False) for c in ENTITY_KEY] + _VALUE_FIELDS)
PAIR_FEATURES = T.StructType([T.StructField(c, T.StringType(), False) for c in PAIR_KEY] + _VALUE_FIELDS)
VERSIONS = T.StructType(
    [T.StructField(c, T.StringType(), False) for c in ENTITY_KEY]
    + [T.StructField("as_of_date", T.TimestampNTZType(), False), T.StructField("version", T.IntegerType(), False)]
)

# Seconds a served feature stays fresh, and words read as true.
FRESH_SECONDS = {"user": 3600, "movie": 86400}
TRUE_WORDS = ("true", "1", "yes")

_TYPE_NAMES = {
    "byte": "int", "short": "int", "integer": "int", "long": "int",
    "float": "float", "double": "float", "decimal": "float",
    "boolean": "bool", "array": "list", "struct": "dict", "map": "dict",
}


# ---------------------------------------------------------------- typed text


def _as_text(column: Column, data_type: T.DataType) -> tuple[Column, str]:
    name = _TYPE_NAMES.get(data_type.typeName(), "str")
    return (F.to_json(column) if name in ("list", "dict") else column.cast("string")), name


def to_long(wide: DataFrame, key: Sequence[str], as_of: Column, created_at: Column) -> DataFrame:
    """One row per feature from one column per feature; null values keep type ``null``.

    Key columns must be non-empty: a bad id fails the job when it is reached.
    """
    entries = []
    for field in wide.schema:
        if field.name in key:
            continue
        text, name = _as_text(F.col(field.name), field.dataType)
        type_name = F.when(F.col(field.name).isNull(), "null").otherwise(name)
        entries.append(F.struct(F.lit(field.name).alias("n"), text.alias("v"), type_name.alias("t")))
    checked = []
    for name in key:
        text = F.col(name).cast("string")
        good = text.isNotNull() & (F.length(text) > 0)
        checked.append(F.when(good, text).otherwise(F.raise_error(F.lit(f"{name} must not be empty"))).alias(name))
    return (
        wide.select(*checked, as_of.cast("timestamp_ntz").alias("as_of_date"),
                    created_at.cast("timestamp_ntz").alias("created_at"), F.explode(F.array(*entries)).alias("_e"))
        .select(*key, F.col("_e.n").alias("feature_name"), F.col("_e.v").alias("feature_value"),
                F.col("_e.t").alias("feature_type"), "as_of_date", "created_at")
    )


def entity_rows(wide: DataFrame, id_column: str, entity_type: str, as_of: Column, created_at: Column) -> DataFrame:
    """Long rows of one entity type, as the store keeps them."""
    long = to_long(wide, [id_column], as_of, created_at).withColumnRenamed(id_column, "entity_id")
    return long.withColumn("entity_type", F.lit(entity_type)).select(*FEATURES.fieldNames())


def typed(long: DataFrame) -> DataFrame:
    """Read the text back by its type; text that does not fit stays text."""
    kind, text = F.col("feature_type"), F.col("feature_value")
    as_int = F.when(kind == "int", F.expr("try_cast(feature_value AS bigint)"))
    as_float = F.when(kind == "float", F.expr("try_cast(feature_value AS double)"))
    as_bool = F.when(kind == "bool", F.lower(text).isin(*TRUE_WORDS))
    as_json = F.when(kind.isin("list", "dict"), F.try_parse_json(text))
    fits = as_int.isNotNull() | as_float.isNotNull() | as_bool.isNotNull() | as_json.isNotNull()
    return long.withColumns(
        {
            "value_int": as_int,
            "value_float": as_float,
            "value_bool": as_bool,
            "value_json": as_json,
            "value_text": F.when(~fits & (kind != "null"), text),
        }
    )


# ---------------------------------------------------------------- saving


def merge_features(existing: DataFrame, new: DataFrame, key: Sequence[str] = ENTITY_KEY) -> DataFrame:
    """Replace every (key, as_of) present in ``new``; keep all other rows."""
    saved = new.select(*key, "as_of_date").distinct()
    return existing.join(saved, [*key, "as_of_date"], "left_anti").unionByName(new)


def _day(df: DataFrame) -> DataFrame:
    return df.withColumn("as_of_day", F.to_date("as_of_date"))


def save_features(path: str, new: DataFrame, key: Sequence[str] = ENTITY_KEY) -> None:
    """Upsert ``new`` into the table at ``path``, rewriting only the as_of days it touches.

    The merged days are staged before the overwrite, so no job reads and
    overwrites the same files.
    """
    spark = new.sparkSession
    new = stage(new, "features-new")
    if new.isEmpty():
        return
    old = _existing(spark, path)
    if old is not None:
        days = _day(new).select("as_of_day").distinct()
        touched = old.join(days, "as_of_day", "left_semi").select(*new.columns)
        new = stage(merge_features(touched, new, key), "features-merged")
    (
        _day(new)
        .hint("rebalance", "as_of_day")  # splits a large day, joins small ones
        .sortWithinPartitions("as_of_day", *key)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("as_of_day")
        .parquet(path)
    )


def _existing(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_features(spark: SparkSession, path: str, schema: T.StructType = FEATURES) -> DataFrame:
    full = T.StructType(schema.fields + [T.StructField("as_of_day", T.DateType())])
    return spark.read.schema(full).parquet(path)


def next_versions(versions: DataFrame, saved: DataFrame, key: Sequence[str] = ENTITY_KEY) -> DataFrame:
    """Versions after a save: the saved (key, as_of) get max version of the key + 1."""
    keys = saved.select(*key, "as_of_date").distinct()
    last = versions.groupBy(*key).agg(F.max("version").alias("_last"))
    order = F.row_number().over(W.partitionBy(*key).orderBy("as_of_date"))
    fresh = keys.join(last, list(key), "left").select(
        *key, "as_of_date", (F.coalesce("_last", F.lit(0)) + order).cast("int").alias("version")
    )
    return versions.join(keys, [*key, "as_of_date"], "left_anti").unionByName(fresh)


# ---------------------------------------------------------------- reading


def _upto(store: DataFrame, when: str | datetime) -> DataFrame:
    kept = store.filter(F.col("as_of_date") <= instant(store, "as_of_date", when))
    if "as_of_day" in store.columns:  # prune whole partitions too
        kept = kept.filter(F.col("as_of_day") <= F.to_date(F.lit(str(when)))).drop("as_of_day")
    return kept


def point_in_time(store: DataFrame, when: str | datetime, key: Sequence[str] = ENTITY_KEY) -> DataFrame:
    """Latest row per (key, feature) with as_of at or before ``when``.

    A max_by aggregate, so each task sends one row per feature, not its history.
    """
    row = F.struct("feature_value", "feature_type", "as_of_date")
    order = F.struct("as_of_date", "created_at")
    return (
        _upto(store, when)
        .groupBy(*key, "feature_name")
        .agg(F.max_by(row, order).alias("_r"))
        .select(*key, "feature_name", "_r.feature_value", "_r.feature_type", "_r.as_of_date")
    )


def point_in_time_batch(
    store: DataFrame,
    when: str | datetime,
    user_ids: DataFrame | None = None,
    movie_ids: DataFrame | None = None,
) -> DataFrame:
    """Point-in-time rows of listed users and movies; a side left out is skipped.

    ``user_ids`` and ``movie_ids`` hold one column ``entity_id``.
    """
    wanted = None
    for kind, ids in (("user", user_ids), ("movie", movie_ids)):
        if ids is not None:
            tagged = ids.select(F.lit(kind).alias("entity_type"), F.col("entity_id").cast("string"))
            wanted = tagged if wanted is None else wanted.unionByName(tagged)
    if wanted is None:
        raise ValueError("give user_ids, movie_ids or both")
    return point_in_time(store.join(wanted, list(ENTITY_KEY), "left_semi"), when)


def to_wide(long: DataFrame, features: Sequence[str], key: Sequence[str] = ENTITY_KEY) -> DataFrame:
    """One column per listed feature, as text."""
    return long.groupBy(*key).pivot("feature_name", list(features)).agg(F.first("feature_value"))


def feature_history(store: DataFrame, features: dict[str, str], key: Sequence[str] = ENTITY_KEY) -> DataFrame:
    """Per (key, as_of), every listed feature as last saved by then, cast to its type.

    A feature that a snapshot does not have is carried from the one before; one saved
    as null is null from then on, as in ``point_in_time``. The window holds one row per
    snapshot of an entity, not its events.
    """
    saved = F.struct(F.col("feature_value").alias("v"))  # not null itself where the value is
    wide = store.groupBy(*key, "as_of_date").pivot("feature_name", list(features)).agg(F.max_by(saved, "created_at"))
    past = W.partitionBy(*key).orderBy("as_of_date").rowsBetween(W.unboundedPreceding, 0)
    carried = wide.select(*key, "as_of_date", *[F.last(n, ignorenulls=True).over(past).alias(n) for n in features])
    return carried.select(*key, "as_of_date", *[F.expr(f"try_cast(`{n}`.v AS {t}) AS `{n}`") for n, t in features.items()])


def asof_training_set(
    events: DataFrame, history: DataFrame, features: Sequence[str], bucket_days: int = 30
) -> DataFrame:
    """Each event with its user's features as known at the event's own time.

    ``history`` has user_id, as_of_date and the features (see feature_history).
    """
    width = bucket_days * 86_400_000_000
    left = events.withColumn("_at", micros(F.col("timestamp")))
    right = history.withColumn("_as_of", micros(F.col("as_of_date")))
    payload = ["as_of_date", *features]
    return asof_lookup(left, right, ["user_id"], "_at", "_as_of", payload, width).drop("_at")


def wide_update(wide: DataFrame, updates: DataFrame, key: Sequence[str]) -> DataFrame:
    """Overwrite the columns present in ``updates`` where they are not null; add new keys."""
    changed = [c for c in updates.columns if c not in key]
    new = updates.select(*key, *[F.col(c).alias(f"_new_{c}") for c in changed])
    joined = wide.join(new, list(key), "full_outer")
    return joined.select(
        *[F.coalesce(f"_new_{c}", c).alias(c) if c in changed else F.col(c) for c in wide.columns]
    )


def fresh_features(store: DataFrame, now: str | datetime, fresh_seconds: dict[str, int] | None = None) -> DataFrame:
    """Rows young enough to serve: created within the time allowed for their entity type."""
    allowed = fresh_seconds or FRESH_SECONDS
    keep = F.lit(False)
    for kind, seconds in allowed.items():
        oldest = instant(store, "created_at", now) - F.expr(f"INTERVAL {int(seconds)} SECONDS")
        keep = keep | ((F.col("entity_type") == kind) & (F.col("created_at") > oldest))
    return store.filter(keep & (F.col("created_at") <= instant(store, "created_at", now)))
