"""Append-only event archive with look-ups and deletes.

Deletes append the removed ids to a side table that reads subtract, so neither
appends nor deletes rewrite the archive.

Files of an append are cut by ranges of event_id and sorted by it, and carry Bloom filters
on event_id and user_id. A look-up by id opens only row groups whose range and filter allow
it: those of its range in each append, and of these almost none that lack the id.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F


IDS_PER_GROUP = 1_000_000  # distinct ids a Bloom filter is made for


def append(events: DataFrame, path: str) -> None:
    _sorted_write(events, f"{path}/events")


def _sorted_write(rows: DataFrame, path: str) -> None:
    """Append in ranges of event_id, sorted, with Bloom filters on the columns looked up."""
    writer = rows.repartitionByRange("event_id").sortWithinPartitions("event_id").write.mode("append")
    for column in ("event_id", "user_id"):
        if column in rows.columns:
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
            writer = writer.option(f"parquet.bloom.filter.expected.ndv#{column}", str(IDS_PER_GROUP))
    writer.option("parquet.bloom.filter.adaptive.enabled", "true").parquet(path)


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read(spark: SparkSession, path: str) -> DataFrame:
    events = spark.read.parquet(f"{path}/events")
    deleted = _read(spark, f"{path}/deleted")
    return events if deleted is None else events.join(deleted, "event_id", "left_anti")


def lookup(spark: SparkSession, path: str, event_ids: list[str]) -> DataFrame:
    """Events of the given ids, without the deleted ones. The ids are pushed into the scan of
    both tables, so each skips the row groups that cannot hold them."""
    wanted = F.col("event_id").isin(event_ids)
    events = spark.read.parquet(f"{path}/events").filter(wanted)
    deleted = _read(spark, f"{path}/deleted")
    return events if deleted is None else events.join(deleted.filter(wanted), "event_id", "left_anti")


def find(
    archive: DataFrame, event_id: str | None = None, user_id: str | None = None, id_pattern: str | None = None
) -> DataFrame:
    """Rows matching all the given conditions."""
    if event_id is not None:
        archive = archive.filter(F.col("event_id") == event_id)
    if user_id is not None:
        archive = archive.filter(F.col("user_id") == user_id)
    if id_pattern is not None:
        archive = archive.filter(F.col("event_id").rlike(id_pattern))
    return archive


def delete(spark: SparkSession, path: str, id_pattern: str) -> None:
    """Remove the events whose id matches ``id_pattern``."""
    gone = find(read(spark, path), id_pattern=id_pattern)
    _sorted_write(gone.select("event_id").distinct(), f"{path}/deleted")
