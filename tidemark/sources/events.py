"""Reading and writing event topics, event files and interaction files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from tidemark.functions.ordering import top_n
from tidemark.sources.schemas import CORRUPT, EVENT, EVENT_TYPES, TOPIC_PREFIX

INTERACTION_FILE = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("event_type", T.StringType()),
    ]
)
REQUIRED_INTERACTION_COLUMNS = ("timestamp", "user_id", "item_id")



# ---------------------------------------------------------------- topics


def kafka_stream(spark: SparkSession, servers: str, topics: Sequence[str], cap: int | None = None) -> DataFrame:
    """Topic records from the earliest offset; run with ``trigger(availableNow=True)`` to drain.

    Needs the Kafka connector package on the session. ``cap`` bounds each batch.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
    )
    if cap is not None:
        reader = reader.option("maxOffsetsPerTrigger", cap)
    return reader.load()


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, pattern: str, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files of ``folder`` matching ``pattern`` as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def decode(records: DataFrame, value: str = "value", schema: T.StructType = EVENT) -> DataFrame:
    """JSON text or bytes to columns; a record that does not parse keeps its text in ``_corrupt_record``."""
    full = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json(F.col(value).cast("string"), full, options)
    kept = [c for c in records.columns if c != value]
    return records.select(*kept, parsed.alias("_e")).select(*kept, "_e.*")


def with_origin(records: DataFrame) -> DataFrame:
    """Origin columns: topic position for Kafka rows, file path for file rows, and the read time."""
    if {"topic", "partition", "offset"} <= set(records.columns):
        origin = {"_kafka_topic": F.col("topic"), "_kafka_partition": F.col("partition"), "_kafka_offset": F.col("offset")}
    else:
        origin = {"_source_file": F.col("_metadata.file_path")}
    return records.withColumns({**origin, "_extracted_at": F.current_timestamp()})


def cap_per_topic(records: DataFrame, cap: int, after: DataFrame | None = None) -> DataFrame:
    """The first ``cap`` records of each topic by (partition, offset).

    ``after`` (topic, partition, next_offset) is where earlier runs stopped; records
    before it are left out, so runs in sequence read every record once.
    """
    order = [F.col("partition"), F.col("offset")]
    if after is not None:
        begun = after.select("topic", "partition", "next_offset")
        joined = records.join(begun, ["topic", "partition"], "left")
        records = joined.filter(F.col("offset") >= F.coalesce("next_offset", F.lit(0))).select(*records.columns)
    return top_n(records, ["topic"], order, cap, rank="_rank").drop("_rank")


def next_offsets(taken: DataFrame, after: DataFrame | None = None) -> DataFrame:
    """(topic, partition, next_offset) from which the run after this one goes on."""
    ends = taken.select("topic", "partition", (F.col("offset") + 1).alias("next_offset"))
    if after is not None:
        ends = ends.unionByName(after.select("topic", "partition", "next_offset"))
    return ends.groupBy("topic", "partition").agg(F.max("next_offset").alias("next_offset"))


def extraction_summary(records: DataFrame) -> DataFrame:
    """Rows per topic and, as topic ``all``, in total."""
    return records.rollup("topic").agg(F.count("*").alias("events"), F.grouping("topic").alias("_all")).select(
        F.when(F.col("_all") == 1, "all").otherwise(F.col("topic")).alias("topic"), "events"
    )


def topic_of(kind: Column, prefix: str = TOPIC_PREFIX) -> Column:
    return F.concat(F.lit(f"{prefix}-"), kind)


def route(events: DataFrame, prefix: str = TOPIC_PREFIX) -> DataFrame:
    """Events as (topic, key, value) records; unknown types and null users go to ``<prefix>-quarantine``."""
    known = F.col("event_type").isin(*EVENT_TYPES) & F.col("user_id").isNotNull()
    payload = F.struct(*events.columns)
    return events.select(
        F.when(known, topic_of(F.col("event_type"), prefix)).otherwise(f"{prefix}-quarantine").alias("topic"),
        F.col("user_id").cast("string").alias("key"),
        F.to_json(payload).alias("value"),
    )


def publish(events: DataFrame, servers: str, checkpoint: str, prefix: str = TOPIC_PREFIX) -> DataStreamWriter:
    """A Kafka writer for a stream of events (needs the Kafka connector package)."""
    return (
        route(events, prefix)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.compression.type", "gzip")
        .option("kafka.acks", "all")
        .option("checkpointLocation", checkpoint)
    )


# ---------------------------------------------------------------- event files


def write_events(events: DataFrame, path: str, mode: str = "append") -> None:
    """Snappy Parquet partitioned by day and event type.

    Rebalancing splits a day's dominant type over many tasks and joins small ones.
    """
    dated = events.withColumn("event_date", F.to_date("timestamp"))
    (
        dated.hint("rebalance", "event_date", "event_type")
        .write.mode(mode)
        .option("compression", "snappy")
        .partitionBy("event_date", "event_type")
        .parquet(path)
    )


def load_events(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Event files; ``_extracted_at`` stands in where ``timestamp`` is null or absent."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    events = reader.parquet(path)
    if "_extracted_at" not in events.columns:
        return events
    taken = F.col("_extracted_at").cast("timestamp_ntz")
    given = F.col("timestamp") if "timestamp" in events.columns else F.lit(None)
    return events.withColumn("timestamp", F.coalesce(given.cast("timestamp_ntz"), taken))


def load_interactions(spark: SparkSession, path: str) -> DataFrame:
    """Interactions from ``.parquet`` or ``.csv`` with timestamp, user_id and item_id."""
    if path.endswith(".parquet"):
        df = spark.read.parquet(path)
    elif path.endswith(".csv"):
        header = spark.read.option("header", True).csv(path).columns
        types = {f.name: f for f in INTERACTION_FILE}
        schema = T.StructType([types.get(n, T.StructField(n, T.StringType())) for n in header])
        df = spark.read.option("header", True).schema(schema).csv(path)
    else:
        raise ValueError(f"unsupported file format: {path}")
    missing = [c for c in REQUIRED_INTERACTION_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def union_events(*frames: DataFrame) -> DataFrame:
    """Stack event types; a column one type lacks is null there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
