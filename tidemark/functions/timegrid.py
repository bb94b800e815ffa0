"""Windows evaluated on a fixed time grid, histograms and quantiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.functions.columns import micros
from tidemark.functions.ordering import running_total

STEP_SECONDS = 30  # fixed value: rules are evaluated every 30 seconds


def step_of(at: Column, step: int = STEP_SECONDS) -> Column:
    """First grid second at or after ``at``."""
    return (F.ceil(micros(at) / F.lit(step * 1_000_000.0)) * step).cast("bigint")


def as_time(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds).cast("timestamp_ntz")


def sliding(steps: DataFrame, keys: Sequence[str], aggregates: dict[str, Column], window: int, step: int = STEP_SECONDS) -> DataFrame:
    """Aggregates (sum, max, min, count) of ``steps`` over (t - window, t] at each grid second t.

    A window only changes where a row enters it and where one leaves it, so each row gives
    these two points, and the value between two points is unfolded to the grid afterwards.
    Aggregates move along the points of one (keys, day); a row near midnight counts in both
    days, so no task orders more than a day of a key and nothing is carried. Windows without
    any row are absent.
    """
    day = 86_400
    if window > day:
        raise ValueError("a window longer than a day does not fit its partitions")
    day_of = lambda at: F.floor(at / day).cast("bigint")
    at = F.col("step")
    last_day = day_of(at + window - step)
    over = last_day > day_of(at)

    def point(d: Column, t: Column, row: bool) -> Column:
        return F.struct(d.alias("_day"), t.cast("bigint").alias("step"), F.lit(row).alias("_row"))

    points = F.array_compact(F.array(
        point(day_of(at), at, True), point(day_of(at + window), at + window, False),
        F.when(over, point(last_day, at, True)), F.when(over, point(last_day, last_day * day, False)),
    ))
    values = [c for c in steps.columns if c not in (*keys, "step")]
    placed = steps.withColumn("_p", F.explode(points)).select(
        *keys, "_p.*", *[F.when(F.col("_p._row"), F.col(c)).alias(c) for c in values])
    order = W.partitionBy(*keys, "_day").orderBy("step")
    frame = order.rangeBetween(-(window - 1), 0)
    moved = placed.select(
        *keys, "_day", "step", F.lead("step").over(order).alias("_next"), F.count_if("_row").over(frame).alias("_rows"),
        *[c.over(frame).alias(n) for n, c in aggregates.items()])
    end = (F.col("_day") + 1) * day
    until = F.least(F.coalesce("_next", end), end) - step
    kept = moved.filter((F.col("_rows") > 0) & (at >= F.col("_day") * day) & (until >= at))  # of equal points the last
    return kept.select(F.explode(F.sequence(at, until, F.lit(step).cast("bigint"))).alias("eval_at"), *keys, *aggregates)


def bucket_counts(value: Column, bounds: Sequence[float]) -> Column:
    """Cumulative counts per upper bound, then the total: one array per group, no window."""
    return F.array(*[F.count_if(value <= b) for b in bounds], F.count(value))


def bucket_rows(df: DataFrame, counts: str, bounds: Sequence[float]) -> DataFrame:
    """Unfold the array to (le, cumulative) rows; the last bound is infinite."""
    labels = F.array(*[F.lit(float(b)) for b in bounds], F.lit(float("inf")))
    others = [c for c in df.columns if c != counts]
    return df.select(*others, F.explode(F.arrays_zip(labels.alias("le"), F.col(counts).alias("cumulative"))).alias("_b")).select(
        *others, "_b.le", "_b.cumulative")


def bucket_quantile(counts: Column, q: float, bounds: Sequence[float]) -> Column:
    """Quantile from cumulative counts, linear inside a bucket whose lower end starts at 0.

    Above the last bound that bound is returned; no rows give null.
    """
    total = F.element_at(counts, -1)
    rank = total * F.lit(q)
    at = F.array_position(F.transform(counts, lambda c: c >= rank), True).cast("int")
    uppers = F.array(*[F.lit(float(b)) for b in bounds])
    lowers = F.array(F.lit(0.0), *[F.lit(float(b)) for b in bounds])
    before = F.coalesce(F.get(counts, at - 2), F.lit(0))
    here = F.get(counts, at - 1) - before
    lower = F.get(lowers, at - 1)
    inside = lower + (F.get(uppers, at - 1) - lower) * F.coalesce(F.try_divide(rank - before, here), F.lit(0.0))
    return F.when(total > 0, F.when(at > len(bounds), F.lit(float(bounds[-1]))).otherwise(inside))


def bucket_quantile_of(counts: Sequence[Column], q: float, bounds: Sequence[float]) -> Column:
    """``bucket_quantile`` of cumulative counts held in columns: one branch per bound, no array."""
    rank = counts[-1] * F.lit(q)
    value = F.lit(float(bounds[-1]))
    for i in reversed(range(len(bounds))):
        lower, before = (float(bounds[i - 1]), counts[i - 1]) if i else (0.0, F.lit(0))
        inside = F.lit(lower) + F.lit(float(bounds[i]) - lower) * F.coalesce(F.try_divide(rank - before, counts[i] - before), F.lit(0.0))
        value = F.when(counts[i] >= rank, inside).otherwise(value)
    return F.when(counts[-1] > 0, value)


def exact_quantiles(df: DataFrame, group: str, value: str, quantiles: Sequence[float]) -> DataFrame:
    """Exact interpolated quantiles per group: (group, quantile, value).

    Values are counted, then numbered over sorted ranges, so a group holding most
    rows is spread over many tasks; only the rows at the wanted positions remain.
    """
    levels = df.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("_n"))
    upto = running_total(levels, [F.col(group), F.col(value)], "_n", "_upto")
    sizes = upto.groupBy(group).agg(F.min(F.col("_upto") - F.col("_n")).alias("_start"), F.sum("_n").alias("_size"))
    placed = upto.join(sizes, group).withColumns(
        {"_first": F.col("_upto") - F.col("_n") - F.col("_start"), "_last": F.col("_upto") - F.col("_start") - 1})
    wanted = placed.withColumn("quantile", F.explode(F.array(*[F.lit(float(q)) for q in quantiles])))
    position = F.col("quantile") * (F.col("_size") - 1)

    def at(index: Column) -> Column:
        return F.max(F.when((F.col("_first") <= index) & (index <= F.col("_last")), F.col(value)))

    hit = wanted.withColumn("_p", position).filter(
        (F.col("_first") <= F.ceil("_p")) & (F.col("_last") >= F.floor("_p")))
    ends = hit.groupBy(group, "quantile", "_p").agg(at(F.floor("_p")).alias("_lo"), at(F.ceil("_p")).alias("_hi"))
    share = F.col("_p") - F.floor("_p")
    return ends.select(group, "quantile", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * share).alias(value))


def running_by_time(steps: DataFrame, keys: Sequence[str], at: str, period: Column, value: str, name: str) -> DataFrame:
    """Running sum of ``value`` per key in time order, in two levels.

    Totals per ``period`` are carried forward over the periods; inside one period
    rows are summed on their own. No task orders more than one period of a key.
    """
    cut = steps.withColumn("_period", period)
    totals = cut.groupBy(*keys, "_period").agg(F.sum(value).alias("_total"))
    before = W.partitionBy(*keys).orderBy("_period").rowsBetween(W.unboundedPreceding, -1)
    carried = totals.select(*keys, "_period", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_carried"))
    inside = W.partitionBy(*keys, "_period").orderBy(at).rowsBetween(W.unboundedPreceding, 0)
    summed = cut.withColumn("_inside", F.sum(value).over(inside))
    return summed.join(carried, [*keys, "_period"]).withColumn(name, F.col("_carried") + F.col("_inside")).drop(
        "_period", "_inside", "_carried")
