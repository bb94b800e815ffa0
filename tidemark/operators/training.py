"""Training sets: splits, dense indexes, positives and sampled negatives."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.functions.columns import instant
from tidemark.functions.ordering import asof_lookup, numbered

# Share of rows for training, of days for testing, negatives per positive.
TRAIN_SHARE = 0.8
TEST_DAYS_SHARE = 0.2
NEGATIVES = 4


def temporal_split(interactions: DataFrame, split_at: str | datetime) -> tuple[DataFrame, DataFrame]:
    """(rows up to the split, rows after it)."""
    at = instant(interactions, "timestamp", split_at)
    return interactions.filter(F.col("timestamp") <= at), interactions.filter(F.col("timestamp") > at)


def split_date(interactions: DataFrame) -> DataFrame:
    """One row: the last event's day, less a fifth of the whole days covered."""
    span = interactions.agg(F.max("timestamp").alias("last"), F.min("timestamp").alias("first"))
    days = F.expr("timestampdiff(DAY, first, last)") * TEST_DAYS_SHARE
    at = F.date_trunc("day", F.col("last")).cast("date")
    return span.select(F.date_sub(at, F.floor(days).cast("int")).alias("split_date"))


def train_val_split(rows: DataFrame, share: float = TRAIN_SHARE, key: str = "event_id") -> DataFrame:
    """Chronological cut: the first ``int(n * share)`` rows by (timestamp, key) are ``train``.

    Only the sort keys are ordered globally, to find the last training row; the
    rows themselves are then told apart by comparing with it, without a shuffle.
    """
    order = numbered(rows.select("timestamp", key), [F.col("timestamp"), F.col(key)], "_n")
    size = order.agg(F.floor(F.count("*") * F.lit(share))).scalar()
    last = order.filter(F.col("_n") == size).select(F.struct("timestamp", key)).scalar()
    position = F.struct("timestamp", key)
    in_train = F.coalesce(position <= last, F.lit(False))
    return rows.withColumn("part", F.when(in_train, "train").otherwise("val"))


def dims(interactions: DataFrame) -> DataFrame:
    """Number of users and of items."""
    counts = [interactions.select(F.col(c)).distinct().agg(F.count(c).alias(n))
              for c, n in (("user_id", "num_users"), ("movie_id", "num_items"))]
    return interactions.sparkSession.range(1).select(
        counts[0].scalar().alias("num_users"), counts[1].scalar().alias("num_items")
    )


def id_index(df: DataFrame, column: str) -> DataFrame:
    """(id, index): the distinct ids in order, numbered from 0."""
    ids = df.select(F.col(column).alias("id")).filter(F.col("id").isNotNull()).distinct()
    return numbered(ids, [F.col("id")], "_n").select("id", (F.col("_n") - 1).alias("index"))


def with_index(df: DataFrame, index: DataFrame, column: str, name: str) -> DataFrame:
    """Add the dense index of ``column``; an unknown id gives null."""
    return df.join(index.select(F.col("id").alias(column), F.col("index").alias(name)), column, "left")


def positives(labelled: DataFrame) -> DataFrame:
    """Distinct (user, item) pairs with label 1."""
    return labelled.filter(F.col("label") == 1).select("user_id", "item_id").distinct()


def hash_number(seed: str, *columns: str) -> Column:
    """A repeatable number in [0, 2^60) from the first fifteen hex digits of an md5."""
    text = F.concat_ws("|", F.lit(seed), *[F.col(c).cast("string") for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def _gaps(seen: DataFrame, width: int) -> DataFrame:
    """Per user, how many seen items lie at or before each gap of unseen items.

    ``seen`` is distinct (user_id, index). The j-th seen item has ``index - (j - 1)``
    unseen items before it; consecutive seen items share that number, so the last
    of them is kept. Ranks are counted in index buckets of ``width``, so no task
    orders more than ``width`` items of a user at once.
    """
    binned = seen.withColumn("_bin", F.floor(F.col("index") / width).cast("bigint"))
    sizes = binned.groupBy("user_id", "_bin").agg(F.count("*").alias("_n"))
    before = W.partitionBy("user_id").orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)
    carried = sizes.select("user_id", "_bin", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(W.partitionBy("user_id", "_bin").orderBy("index"))
    ranked = binned.withColumn("_j", inside).join(carried, ["user_id", "_bin"]).select(
        "user_id", "index", (F.col("_j") + F.col("_before")).alias("seen_upto"))
    unseen_before = (F.col("index") - F.col("seen_upto") + 1).alias("unseen_before")
    return ranked.select("user_id", unseen_before, "seen_upto").groupBy("user_id", "unseen_before").agg(
        F.max("seen_upto").alias("seen_upto"))


def negative_samples(
    positive_rows: DataFrame,
    item_index: DataFrame,
    n: int = NEGATIVES,
    seed: str = "train",
    key: str = "event_id",
    width: int = 1024,
) -> DataFrame:
    """``n`` uniformly drawn unseen items per positive row: (key, user_id, slot, item_id, label 0).

    Instead of drawing items until one is unseen, a draw picks the r-th unseen
    item of the user, r below the number of items the user has not seen. Its index
    is r plus the number of seen items before it, found by an as-of look-up in the
    user's sorted seen items. So every draw succeeds, and users who saw every item
    get none.
    """
    index = item_index.select(F.col("id").alias("item_id"), "index")
    items = item_index.agg(F.count("*")).scalar()
    seen = positive_rows.select("user_id", "item_id").distinct().join(index, "item_id").select("user_id", "index")
    unseen = seen.groupBy("user_id").agg((items - F.count("*")).alias("_unseen")).filter("_unseen > 0")
    slots = F.explode(F.sequence(F.lit(1), F.lit(n)))
    draws = (
        positive_rows.select(key, "user_id")
        .join(unseen, "user_id")
        .select(key, "user_id", "_unseen", slots.alias("slot"))
        .withColumn("_r", hash_number(seed, key, "slot") % F.col("_unseen"))
    )
    found = asof_lookup(draws, _gaps(seen, width), ["user_id"], "_r", "unseen_before", ["seen_upto"], width)
    drawn = found.withColumn("index", F.col("_r") + F.coalesce("seen_upto", F.lit(0)))
    return drawn.join(index, "index").select(key, "user_id", "slot", "item_id", F.lit(0).alias("label"))


def eval_set(positive_rows: DataFrame, item_index: DataFrame, n: int = NEGATIVES, seed: str = "eval") -> DataFrame:
    """Positive rows (slot 0, label 1) and their sampled negatives, with a seed of their own."""
    kept = positive_rows.select("event_id", "user_id", F.lit(0).alias("slot"), "item_id", F.lit(1).alias("label"))
    return kept.unionByName(negative_samples(positive_rows, item_index, n, seed))
