"""Topics kept as files: partitioned records with offsets, read as a stream without a broker.

A log is a folder of Parquet files ``topic=<t>/partition=<p>/…`` with columns offset, key,
value and timestamp; offsets of a partition only grow. ``stream`` reads it as topic records
(key, value, topic, partition, offset, timestamp) in order of offsets, a bounded number of
records per topic partition and batch, each partition by a task of its own. The stream's
checkpoint keeps where it stands; what a reader group has committed is kept beside the log
as well, so that the cap counts from there after a restart.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

FORMAT = "record_log"
SCHEMA = "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"
_FOLDER = re.compile(r"topic=([^/]+)/partition=(\d+)/[^/]+\.parquet$")

Offsets = dict[str, dict[str, int]]  # next offset by topic and partition


def append(records: DataFrame, path: str) -> None:
    """Add records (topic, partition, offset, key, value, timestamp) to the log at ``path``."""
    ordered = records.hint("rebalance", "topic", "partition").sortWithinPartitions("topic", "partition", "offset")
    ordered.write.mode("append").partitionBy("topic", "partition").parquet(path)


def stream(spark: SparkSession, path: str, cap: int | None = None, group: str = "default", topics: str = ".*") -> DataFrame:
    """The log as a stream from its earliest offsets, topics fully matching ``topics`` only."""
    spark.dataSource.register(RecordLog)
    reader = spark.readStream.format(FORMAT).option("path", path).option("group", group).option("topics", topics)
    return (reader if cap is None else reader.option("cap", cap)).load()


class RecordLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> RecordLogReader:
        return RecordLogReader(dict(self.options))


class Part(InputPartition):
    """Records [first, end) of one topic partition, in these files."""

    def __init__(self, topic: str, partition: int, first: int, end: int, files: list[str]) -> None:
        self.topic, self.partition, self.first, self.end, self.files = topic, partition, first, end, files


class RecordLogReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.root, self.group = options["path"], options.get("group", "default")
        self.cap = int(options["cap"]) if options.get("cap") else None
        self.topics = re.compile(options.get("topics", ".*"))
        self.ranges: dict[str, tuple[str, str, int, int]] = {}  # file: topic, partition, first and last offset
        self.given: Offsets | None = None

    # ------------------------------------------------------------ files

    def _fs(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.root) if "://" in self.root or self.root.startswith("file:") else (fs.LocalFileSystem(), self.root)

    def _refresh(self) -> None:
        """Offset ranges of files not seen before, from their footers."""
        from pyarrow import fs, parquet

        store, root = self._fs()
        for info in store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            found = _FOLDER.search(info.path)
            if info.path in self.ranges or not found or not self.topics.fullmatch(unquote(found[1])):
                continue
            with store.open_input_file(info.path) as f:
                meta = parquet.read_metadata(f)
            at = meta.schema.names.index("offset")
            stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
            if stats:
                self.ranges[info.path] = unquote(found[1]), found[2], min(s.min for s in stats), max(s.max for s in stats)

    def _available(self) -> Offsets:
        self._refresh()
        ends: Offsets = {}
        for topic, partition, _, last in self.ranges.values():
            of = ends.setdefault(topic, {})
            of[partition] = max(of.get(partition, 0), last + 1)
        return ends

    def _progress(self) -> str:
        return f"{self._fs()[1]}/_groups/{self.group}.json"

    def _committed(self) -> Offsets:
        from pyarrow import fs

        store, at = self._fs()[0], self._progress()
        if store.get_file_info(at).type == fs.FileType.NotFound:
            return {}
        with store.open_input_stream(at) as f:
            return json.loads(f.read())

    # ------------------------------------------------------------ the stream

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """What is there, but no more than the cap beyond what was given out last."""
        before = self._committed() if self.given is None else self.given
        ends = self._available()
        if self.cap is not None:
            for topic, of in ends.items():
                for partition, end in of.items():
                    of[partition] = min(end, max(before.get(topic, {}).get(partition, 0), self._first(topic, partition)) + self.cap)
        self.given = ends
        return ends

    def _first(self, topic: str, partition: str) -> int:
        return min(first for t, p, first, _ in self.ranges.values() if (t, p) == (topic, partition))

    def partitions(self, start: dict, end: dict) -> list[Part]:
        self._refresh()
        parts = []
        for topic, of in sorted(end.items()):
            for partition, upto in sorted(of.items()):
                since = start.get(topic, {}).get(partition, 0)
                files = sorted(f for f, (t, p, first, last) in self.ranges.items() if (t, p) == (topic, partition) and first < upto and last >= since)
                if files and since < upto:
                    parts.append(Part(topic, int(partition), since, upto, files))
        return parts

    def read(self, part: Part) -> Iterator:
        """Record batches in order of offsets, each at most one row group."""
        import pyarrow as pa
        from pyarrow import compute as pc, parquet

        store, found = self._fs()[0], []
        for path in part.files:
            with store.open_input_file(path) as f:
                meta = parquet.read_metadata(f)
            at = meta.schema.names.index("offset")
            for g in range(meta.num_row_groups):
                stats = meta.row_group(g).column(at).statistics
                if stats.min < part.end and stats.max >= part.first:
                    found.append((stats.min, path, g))
        for _, path, g in sorted(found):
            with store.open_input_file(path) as f:
                table = parquet.ParquetFile(f).read_row_group(g, columns=["offset", "key", "value", "timestamp"])
            table = table.filter((pc.field("offset") >= part.first) & (pc.field("offset") < part.end)).sort_by("offset")
            n = table.num_rows
            columns = {
                "key": table["key"].cast(pa.string()), "value": table["value"].cast(pa.string()), "topic": pa.array([part.topic] * n, pa.string()),
                "partition": pa.array([part.partition] * n, pa.int32()), "offset": table["offset"].cast(pa.int64()),
                "timestamp": table["timestamp"].cast(pa.timestamp("us", tz="UTC")),
            }
            yield from pa.table(columns).to_batches()

    def commit(self, end: dict) -> None:
        store, at = self._fs()[0], self._progress()
        store.create_dir(at.rsplit("/", 1)[0])
        with store.open_output_stream(f"{at}.tmp") as f:
            f.write(json.dumps(end).encode())
        store.move(f"{at}.tmp", at)
