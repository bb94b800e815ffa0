"""Daily sketches of distinct ids and of values, merged over any run of days.

A day is folded once into a few kilobytes per key: a HyperLogLog sketch of the ids and a KLL
sketch of the values. Windows of any length merge days instead of reading rows again, and
days may be written and merged in any order. Relative error of a distinct count: about
1.6 % (one standard deviation); rank error of a quantile: about 1.3 % (99 %).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

HLL_BITS = 12
KLL_SIZE = 200


def daily_sketches(rows: DataFrame, keys: Sequence[str], at: str, ids: str | None = None, value: str | None = None) -> DataFrame:
    """(day, keys, n, ids_sketch, value_sketch): one row per day and key; a sketch not asked for is left out."""
    parts = [F.count("*").alias("n")]
    if ids is not None:
        parts.append(F.hll_sketch_agg(F.col(ids).cast("string"), F.lit(HLL_BITS)).alias("ids_sketch"))
    if value is not None:
        parts.append(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(KLL_SIZE)).alias("value_sketch"))
    return rows.groupBy(F.to_date(at).alias("day"), *keys).agg(*parts)


def merged(sketches: DataFrame, keys: Sequence[str], days: int) -> DataFrame:
    """(last_day, keys, n, sketches) over the ``days`` days up to each day that has a row of the key.

    A daily row goes to the windows of later days in which its key was seen; those are found
    by an equi-join on the key's days, so a key costs its days times the window.
    """
    seen = sketches.select(F.col("day").alias("last_day"), *keys).distinct()
    later = F.explode(F.sequence(F.lit(0), F.lit(days - 1)))
    spread = sketches.withColumn("_later", later).withColumn("last_day", F.date_add("day", F.col("_later"))).join(seen, ["last_day", *keys], "left_semi")
    parts = [F.sum("n").alias("n")]
    if "ids_sketch" in sketches.columns:
        parts.append(F.hll_union_agg("ids_sketch").alias("ids_sketch"))
    if "value_sketch" in sketches.columns:
        parts.append(F.kll_merge_agg_double("value_sketch").alias("value_sketch"))
    return spread.groupBy("last_day", *keys).agg(*parts)


def distinct_ids(frame: DataFrame, name: str = "distinct_ids") -> DataFrame:
    """With the estimated number of distinct ids in place of its sketch."""
    return frame.withColumn(name, F.hll_sketch_estimate("ids_sketch")).drop("ids_sketch")


def quantiles(frame: DataFrame, wanted: dict[str, float]) -> DataFrame:
    """With the estimated quantiles in place of the sketch."""
    return frame.withColumns({n: F.kll_sketch_get_quantile_double("value_sketch", F.lit(q)) for n, q in wanted.items()}).drop("value_sketch")
