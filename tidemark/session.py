"""Session set-up and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A UTC session with adaptive execution; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config(  # streaming state on disk, so it may outgrow executor memory
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")  # a batch writes its changes only
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # no call-site look-up per expression
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Naive timestamps mean UTC everywhere, so the session zone must be UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_local_scratch: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temp folder in local mode only."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    global _local_scratch
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="tidemark-")
    return _local_scratch


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


class Scratch:
    """Named staged tables of one job in the shared folder.

    Staging cuts lineage: a later read after a lost executor starts from the written
    table. Tables go when the job drops them, and what is left goes with the application.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.root = scratch_path(spark, label)
        self._fs, self._root = file_system(spark, self.root)
        self._fs.mkdirs(self._root)  # only a path that exists can be marked
        self._fs.deleteOnExit(self._root)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` under ``name`` and read it back."""
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            self._fs.delete(file_system(self.spark, self.path(name))[1], True)


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system and path object of ``path``, whatever store it is in."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; it goes with the application.

    Used where a value must not change between two reads (range-partition
    numbers) or where a long plan would be recomputed after losing an executor.
    """
    return Scratch(df.sparkSession, label).put(df, "data")
