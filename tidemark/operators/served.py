"""A stored table of served lists, kept by user.

Lists lie in ``BUCKETS`` partitions by a hash of the user. A round of new lists, or a drop of
users, rewrites only the buckets of these users: what stays is an anti-join within the
bucket, staged before the overwrite.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.recommend import LIST_FRESH_SECONDS, fresh_lists
from tidemark.session import Scratch, file_system

BUCKETS = 64
KEY = ("user_id", "k")


class ServedLists:
    """Rows (user_id, k, generated_at, ...): the last list of each user and list length."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col("user_id").cast("string")), F.lit(self.buckets)).cast("int").alias("bucket")

    def read(self) -> DataFrame | None:
        """All lists, with their bucket; None before the first round."""
        try:
            return self.spark.read.parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def fresh(self, now: str | datetime, seconds: int = LIST_FRESH_SECONDS) -> DataFrame:
        """Lists young enough to serve."""
        return fresh_lists(self.read().drop("bucket"), now, seconds)

    def put(self, lists: DataFrame) -> None:
        """A round of lists: each replaces the stored one of its (user, k); of several the newest."""
        scratch = Scratch(self.spark, "served")
        others = [c for c in lists.columns if c not in KEY]
        newest = lists.groupBy(*KEY).agg(F.max_by(F.struct(*others), "generated_at").alias("_r")).select(*KEY, "_r.*")
        new = scratch.put(newest.select("*", self._bucket()), "new")
        self._rewrite(new, new.select(*KEY), new.select("bucket").distinct(), scratch)

    def drop(self, users: DataFrame) -> None:
        """Lists of the given users go."""
        scratch = Scratch(self.spark, "served")
        gone = scratch.put(users.select("user_id").distinct().select("user_id", self._bucket()), "gone")
        self._rewrite(None, gone.select("user_id"), gone.select("bucket").distinct(), scratch)

    def _rewrite(self, new: DataFrame | None, replaced: DataFrame, touched: DataFrame, scratch: Scratch) -> None:
        stored = self.read()
        buckets = [r["bucket"] for r in touched.collect()]  # at most ``buckets`` numbers
        rows = new
        if stored is not None:
            kept = stored.filter(F.col("bucket").isin(buckets)).join(replaced, replaced.columns, "left_anti")
            rows = kept if new is None else kept.unionByName(new, allowMissingColumns=True)
        if rows is None:
            return
        rows = scratch.put(rows, "rows")
        rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", "user_id").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.path)
        left = {r["bucket"] for r in rows.select("bucket").distinct().collect()}
        for bucket in set(buckets) - left:  # an overwrite by partition leaves those without rows as they were
            fs, folder = file_system(self.spark, f"{self.path}/bucket={bucket}")
            fs.delete(folder, True)
