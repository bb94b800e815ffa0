"""Streaming jobs. Each takes a streaming DataFrame and writes Parquet tables.

Every batch writes its own folder ``batch=<id>`` by overwrite, so a batch run
again after a failure replaces its output instead of adding to it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark.functions.timegrid import STEP_SECONDS, as_time, bucket_counts, sliding
from tidemark.operators.features import VIEW
from tidemark.operators.monitor import REQUEST_BOUNDS, is_server_error
from tidemark.operators.validate import normalise_timestamp, stamp, validate_mixed
from tidemark.sources.events import decode

WINDOW_WIDTHS = (300, 600, 1_800)  # fixed values: seconds the alert rules look back

BatchWriter = Callable[[DataFrame, int], None]


def drain(writer: DataStreamWriter) -> None:
    """Process everything now available, then stop."""
    started = writer.trigger(availableNow=True).start()
    started.awaitTermination()


def into_batches(path: str, partition_by: Sequence[str] = ()) -> BatchWriter:
    def write(batch: DataFrame, batch_id: int) -> None:
        # static: a batch run again must not leave partitions of its first run behind
        writer = batch.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy(*partition_by).parquet(f"{path}/batch={batch_id}")

    return write


# ---------------------------------------------------------------- ingest


def ingest(records: DataFrame, path: str, checkpoint: str, now: str | None = None) -> DataStreamWriter:
    """Decode, check and stamp topic records; good and bad rows land in one table
    partitioned by ``outcome``, so each batch is computed once and written once.
    """
    decoded = decode(records)
    events = decoded.withColumn("timestamp", normalise_timestamp("timestamp").cast("timestamp_ntz"))
    checked = validate_mixed(stamp(events), now)
    outcome = F.when(F.size("errors") == 0, "good").otherwise("quarantine")
    return (
        checked.withColumn("outcome", outcome)
        .writeStream.foreachBatch(into_batches(path, ["outcome"]))
        .option("checkpointLocation", checkpoint)
    )


def ingested(spark: SparkSession, path: str, outcome: str) -> DataFrame:
    """The good or the quarantined rows written so far."""
    return spark.read.parquet(path).filter(F.col("outcome") == outcome).drop("outcome", "batch")


def dedup(events: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Each event_id once, however late or far apart its copies come.

    The ids seen are keyed state on disk, one entry an id, without a watermark, so no row
    is dropped for being late. A batch looks up and adds its own ids only; nothing that
    earlier batches wrote is read. Of copies within one batch any one is kept: copies of an
    id are taken to be the same event.
    """
    once = events.dropDuplicates(["event_id"])
    return once.writeStream.foreachBatch(into_batches(path)).option("checkpointLocation", checkpoint)


# ---------------------------------------------------------------- windows


def windowed(
    rows: DataFrame, at: str, width: str, keys: Sequence[str | Column], aggregates: Sequence[Column], path: str, checkpoint: str,
    delay: str, slide: str | None = None,
) -> DataStreamWriter:
    """Windowed aggregates in update mode: each batch writes the windows it changed.

    Windows older than the watermark leave the state, and later rows for them are
    dropped. ``latest_windows`` reads the newest version of every window.
    """
    timed = rows.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay)
    counted = timed.groupBy(F.window(at, width, slide), *keys).agg(*aggregates)
    flat = counted.withColumn("window_start", F.col("window.start").cast("timestamp_ntz")).drop("window")
    return (
        flat.writeStream.outputMode("update")
        .foreachBatch(into_batches(path))
        .option("checkpointLocation", checkpoint)
    )


def latest_windows(spark: SparkSession, path: str, keys: Sequence[str], at: str = "window_start") -> DataFrame:
    """Newest version of each (``at``, keys)."""
    versions = spark.read.parquet(path)
    values = [c for c in versions.columns if c not in (at, "batch", *keys)]
    newest = F.max_by(F.struct(*values), "batch").alias("_v")
    return versions.groupBy(at, *keys).agg(newest).select(at, *keys, "_v.*")


def request_windows(log: DataFrame, path: str, checkpoint: str, width: str = "10 minutes", slide: str = "5 minutes", delay: str = "10 minutes") -> DataStreamWriter:
    """Requests, errors, cache hits and the latency histogram per window and endpoint."""
    return windowed(
        log, "ts", width, ["endpoint"],
        [
            F.count("*").alias("requests"),
            F.count_if(is_server_error(F.col("status"))).alias("errors"),
            F.count_if(F.col("cached")).alias("hits"),
            F.count("cached").alias("operations"),
            bucket_counts(F.col("duration_s"), REQUEST_BOUNDS).alias("latency_counts"),
        ],
        path, checkpoint, delay, slide,
    )


def request_panes(
    log: DataFrame, panes: str, windows: str, checkpoint: str, widths: Sequence[int] = WINDOW_WIDTHS, delay: str = "10 minutes",
) -> DataStreamWriter:
    """Requests, errors, cache hits and the latency histogram over windows of several widths,
    each moved on by one pane (``STEP_SECONDS``), from one state of panes.

    The stream keeps a pane's counts per endpoint until the watermark passes it. A batch
    writes the panes it changed to ``panes`` and then merges, from the panes within the widest
    window of these, all windows they touch into ``windows``. A window is named by its end
    and holds the panes that start in [end - width, end).
    """
    timed = log.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    counted = timed.groupBy(F.window("ts", f"{STEP_SECONDS} seconds"), "endpoint").agg(
        F.count("*").alias("requests"),
        F.count_if(is_server_error(F.col("status"))).alias("errors"),
        F.count_if(F.col("cached")).alias("hits"),
        F.count("cached").alias("operations"),
        bucket_counts(F.col("duration_s"), REQUEST_BOUNDS).alias("latency_counts"),
    )
    flat = counted.withColumn("step", F.unix_seconds("window.end")).drop("window")
    plain, buckets = ("requests", "errors", "hits", "operations"), [f"_c{i}" for i in range(len(REQUEST_BOUNDS) + 1)]
    keep, publish, widest = into_batches(panes), into_batches(windows), max(widths)

    def merge(batch: DataFrame, batch_id: int) -> None:
        keep(batch, batch_id)
        spark = batch.sparkSession
        changed = spark.read.schema(batch.schema).parquet(f"{panes}/batch={batch_id}").agg(F.min("step").alias("lo"), F.max("step").alias("hi")).first()
        if changed["lo"] is None:
            return
        upto = spark.read.schema(f"{_ddl(batch)}, batch int").parquet(panes).filter(
            (F.col("batch") <= batch_id) & F.col("step").between(changed["lo"] - widest + STEP_SECONDS, changed["hi"] + widest))
        newest = upto.groupBy("step", "endpoint").agg(F.max_by(F.struct(*plain, "latency_counts"), "batch").alias("_v")).select("step", "endpoint", "_v.*")
        single = newest.select("step", "endpoint", *plain, *[F.get("latency_counts", F.lit(i)).alias(c) for i, c in enumerate(buckets)])

        def of(width: int) -> DataFrame:
            sums = sliding(single, ["endpoint"], {c: F.sum(c) for c in (*plain, *buckets)}, width)
            touched = sums.filter(F.col("eval_at").between(changed["lo"], changed["hi"] + width - STEP_SECONDS))
            return touched.select(
                as_time(F.col("eval_at")).alias("window_end"), F.lit(width).alias("width"), "endpoint", *plain, F.array(*buckets).alias("latency_counts"))

        publish(reduce(DataFrame.unionByName, [of(w) for w in widths]), batch_id)

    return flat.writeStream.outputMode("update").foreachBatch(merge).option("checkpointLocation", checkpoint)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def daily_counts(interactions: DataFrame, path: str, checkpoint: str, delay: str = "1 day") -> DataStreamWriter:
    """Events and views per day of every user and every item, from one pass over the stream."""
    sides = F.array(F.struct(F.lit("user").alias("kind"), F.col("user_id").alias("id")),
                    F.struct(F.lit("item").alias("kind"), F.col("movie_id").alias("id")))
    spread = interactions.select("timestamp", "event_type", F.explode(sides).alias("_s"))
    rows = spread.select("timestamp", "event_type", "_s.kind", "_s.id").filter(F.col("id").isNotNull())
    return windowed(
        rows, "timestamp", "1 day", ["kind", "id"],
        [F.count("*").alias("events"), F.count_if(F.col("event_type") == VIEW).alias("views")],
        path, checkpoint, delay,
    )


def keep_raw(rows: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """All rows as they came, late ones too, for the batch that corrects the windows."""
    return rows.writeStream.foreachBatch(into_batches(path)).option("checkpointLocation", checkpoint)
