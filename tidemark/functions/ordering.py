"""Global order, top-n, running totals and as-of lookups without one hot task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.session import stage

MOST_ENTRIES = 4_096  # right rows in one array of an as-of look-up
_POSITION_BITS = (1 << 33) - 1  # monotonically_increasing_id keeps the row position here


def _range_sorted(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Range-partitioned, sorted and staged, with a range number and a position.

    Range bounds come from a sample and may differ from run to run, so the
    numbers are written down once before anything is derived from them. Adaptive
    execution may join neighbouring small ranges, which keeps their order.
    """
    marked = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    return stage(
        marked.select(
            *df.columns,
            F.shiftright("_mid", 33).alias("_range"),
            F.col("_mid").bitwiseAND(F.lit(_POSITION_BITS)).alias("_pos"),
        ),
        "ordered",
    )


def _carried(ranges: DataFrame, total: str) -> DataFrame:
    """Sum of ``total`` over all earlier ranges; one row per range, so a tiny frame."""
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    return ranges.select("_range", F.coalesce(F.sum(total).over(before), F.lit(0)).alias("_before"))


def numbered(df: DataFrame, order: Sequence[Column], name: str = "row_number") -> DataFrame:
    """Number all rows 1..n in a global order with one range shuffle."""
    ordered = _range_sorted(df, order)
    offsets = _carried(ordered.groupBy("_range").agg(F.count("*").alias("_n")), "_n")
    return (
        ordered.join(F.broadcast(offsets), "_range")  # one row per shuffle partition
        .withColumn(name, F.col("_before") + F.col("_pos") + 1)
        .drop("_range", "_pos", "_before")
    )


def running_total(df: DataFrame, order: Sequence[Column], value: str, name: str) -> DataFrame:
    """Sum of ``value`` over all rows up to and including this one in a global order."""
    ordered = _range_sorted(df, order)
    offsets = _carried(ordered.groupBy("_range").agg(F.sum(value).alias("_n")), "_n")
    inside = W.partitionBy("_range").orderBy("_pos").rowsBetween(W.unboundedPreceding, 0)
    return (
        ordered.withColumn("_inside", F.sum(value).over(inside))
        .join(F.broadcast(offsets), "_range")  # one row per shuffle partition
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop("_range", "_pos", "_before", "_inside")
    )


def top_n(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    n: int,
    rank: str = "rank",
    salts: int = 64,
) -> DataFrame:
    """First ``n`` rows per group. Rows are ranked in salted parts first, so one
    group holding most of the data is spread over ``salts`` tasks, and only
    ``salts * n`` of its rows meet in the last step.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*_hashable(df)), F.lit(salts)))
    part = F.row_number().over(W.partitionBy(*group, "_salt").orderBy(*order))
    kept = salted.withColumn("_part", part).filter(F.col("_part") <= n).drop("_part", "_salt")
    whole = F.row_number().over(W.partitionBy(*group).orderBy(*order))
    return kept.withColumn(rank, whole).filter(F.col(rank) <= n)


def _hashable(df: DataFrame) -> list[str]:
    simple = [f.name for f in df.schema if f.dataType.typeName() not in ("map", "variant")]
    return [f"`{c}`" for c in simple]


def asof_lookup(
    left: DataFrame,
    right: DataFrame,
    key: Sequence[str],
    left_at: str,
    right_at: str,
    payload: Sequence[str],
    width: int,
    most: int = MOST_ENTRIES,
) -> DataFrame:
    """Add to each left row the ``payload`` of the last right row of its key with
    ``right_at <= left_at`` (null when there is none).

    ``left_at`` and ``right_at`` are integers and (key, right_at) is unique on the
    right. Time is cut into buckets of ``width``, and a bucket with many right rows
    into parts of ``most`` rows: right rows become one sorted array per (key, bucket,
    part), at most ``most`` long. A left row finds its part by the parts' first
    instants; one with nothing before it in its part takes the last value carried
    from earlier parts. The left side only meets the right in equi-joins on (key,
    bucket) and (key, bucket, part), so a hot key spreads over them and adaptive
    execution can split it further.
    """
    key = list(key)
    entry = F.struct(F.col(right_at).alias("at"), *[F.col(c) for c in payload])
    left = left.withColumn("_bucket", F.floor(F.col(left_at) / F.lit(width)).cast("bigint"))
    placed = right.withColumn("_bucket", F.floor(F.col(right_at) / F.lit(width)).cast("bigint"))
    if width > most:  # a bucket has no more rows than instants
        number = F.row_number().over(W.partitionBy(*key, "_bucket").orderBy(right_at))
        placed = placed.withColumn("_part", F.floor((number - 1) / most).cast("int"))
        starts = placed.groupBy(*key, "_bucket", "_part").agg(F.min(right_at).alias("_first")).filter("_part > 0")
        starts = starts.groupBy(*key, "_bucket").agg(F.collect_list("_first").alias("_starts"))
        part = F.coalesce(F.size(F.filter("_starts", lambda s: s <= F.col(left_at))), F.lit(0))
        left = left.join(starts, [*key, "_bucket"], "left").withColumn("_part", F.when(F.col("_starts").isNull(), 0).otherwise(part)).drop("_starts")
    else:
        placed, left = placed.withColumn("_part", F.lit(0)), left.withColumn("_part", F.lit(0))
    place = ["_bucket", "_part"]
    history = placed.groupBy(*key, *place).agg(F.sort_array(F.collect_list(entry)).alias("_entries"))
    needed = left.select(*key, *place, F.lit(None).cast(history.schema["_entries"].dataType).alias("_entries"))
    buckets = history.unionByName(needed.distinct()).groupBy(*key, *place).agg(
        F.first("_entries", ignorenulls=True).alias("_entries")
    )
    earlier = W.partitionBy(*key).orderBy(*place).rowsBetween(W.unboundedPreceding, -1)
    carried = buckets.withColumn(
        "_carry", F.last(F.try_element_at("_entries", F.lit(-1)), ignorenulls=True).over(earlier)
    )
    found = left.join(carried, [*key, *place], "left")
    here = F.filter("_entries", lambda e: e["at"] <= F.col(left_at))
    hit = F.when(F.size(here) > 0, F.try_element_at(here, F.lit(-1))).otherwise(F.col("_carry"))
    return (
        found.withColumn("_hit", hit)
        .select(*[c for c in left.columns if c not in place], *[F.col("_hit")[c].alias(c) for c in payload])
    )
