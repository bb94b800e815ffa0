"""Feature tables with their versions, saved together or not at all.

A save writes the days it changes and the versions of the saved keys into a new snapshot
folder, and then one manifest that names, for every as_of day, the folder that holds it,
and all folders of versions. Readers follow the newest manifest, so they see either both
tables of a save or neither; a save that breaks off leaves folders no manifest names. Older
manifests stay readable until ``vacuum`` drops them.

Layout under the table's path: ``manifests/<number>.json``, ``data/<snapshot>/as_of_day=<day>``
and ``versions/<snapshot>``. A manifest has one line per day and at most ``VERSION_PARTS``
folders of versions, which a save merges when there would be more.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.store import ENTITY_KEY, FEATURES, merge_features, next_versions
from tidemark.session import Scratch, file_system

VERSION_PARTS = 8


class SaveConflict(RuntimeError):
    """Another save was committed first; nothing of this one is visible."""


@dataclass(frozen=True)
class Manifest:
    """What a reader needs: ``days`` maps an as_of day to its folder."""

    number: int = 0
    days: dict[str, str] = field(default_factory=dict)
    versions: list[str] = field(default_factory=list)


class VersionedTable:
    """A long feature table at ``path`` and the version of every (key, as_of) in it."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType = FEATURES, key: Sequence[str] = ENTITY_KEY) -> None:
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), schema, tuple(key)
        kinds = {f.name: f for f in schema}
        self.version_schema = T.StructType([*(kinds[c] for c in self.key), kinds["as_of_date"], T.StructField("version", T.IntegerType())])

    # ------------------------------------------------------------ manifests

    def _at(self, name: str):
        return file_system(self.spark, f"{self.path}/{name}")

    def numbers(self) -> list[int]:
        """Numbers of the committed manifests, oldest first."""
        fs, folder = self._at("manifests")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith(("_", ".")))

    def manifest(self, number: int | None = None) -> Manifest:
        """The newest manifest, or the one of an earlier save; an empty one before any save."""
        if number is None:
            found = self.numbers()
            if not found:
                return Manifest()
            number = found[-1]
        text = self.spark.read.text(f"{self.path}/manifests/{number:010d}.json", wholetext=True).first()[0]
        return Manifest(number, **json.loads(text))

    def _commit(self, manifest: Manifest) -> None:
        """One rename makes the save visible; it fails if the number is taken."""
        target = f"manifests/{manifest.number:010d}.json"
        fs, written = self._at(f"manifests/_{uuid.uuid4().hex}.tmp")
        out = fs.create(written, False)
        try:
            out.write(bytearray(json.dumps({"days": manifest.days, "versions": manifest.versions}).encode()))
        finally:
            out.close()
        if fs.exists(self._at(target)[1]) or not fs.rename(written, self._at(target)[1]):
            fs.delete(written, False)
            raise SaveConflict(f"save {manifest.number} of {self.path} was committed by another writer")

    # ------------------------------------------------------------ reading

    def read(self, upto_day: str | None = None, number: int | None = None) -> DataFrame:
        """Rows of the table; ``upto_day`` leaves out the folders of later days."""
        days = self.manifest(number).days
        paths = [f"{self.path}/{folder}/as_of_day={day}" for day, folder in sorted(days.items()) if upto_day is None or day <= upto_day]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def versions(self, number: int | None = None) -> DataFrame:
        """The version of every (key, as_of): that of its last save."""
        parts = [f"{self.path}/{folder}" for folder in self.manifest(number).versions]
        if not parts:
            return self.spark.createDataFrame([], self.version_schema)
        saved = self.spark.read.schema(self.version_schema).parquet(*parts)
        return saved.groupBy(*self.key, "as_of_date").agg(F.max("version").alias("version"))

    # ------------------------------------------------------------ saving

    def save(self, rows: DataFrame) -> Manifest:
        """Replace all rows of the saved (key, as_of) and give each the key's next version."""
        base = self.manifest()
        scratch = Scratch(self.spark, "versioned-save")
        new = scratch.put(rows.select(*self.schema.fieldNames()), "new")
        found = [str(r[0]) for r in new.select(F.to_date("as_of_date").alias("d")).distinct().collect()]  # days of one save
        if not found:
            return base
        snapshot = uuid.uuid4().hex
        days = {**base.days, **{day: f"data/{snapshot}" for day in found}}
        self._write_days(base, new, found, snapshot)
        versions = self._write_versions(base, new, snapshot)
        manifest = Manifest(base.number + 1, days, versions)
        self._commit(manifest)
        return manifest

    def _write_days(self, base: Manifest, new: DataFrame, found: Sequence[str], snapshot: str) -> None:
        before = [f"{self.path}/{base.days[day]}/as_of_day={day}" for day in found if day in base.days]
        merged = merge_features(self.spark.read.schema(self.schema).parquet(*before), new, self.key) if before else new
        dated = merged.withColumn("as_of_day", F.to_date("as_of_date"))
        dated.hint("rebalance", "as_of_day").sortWithinPartitions("as_of_day", *self.key).write.partitionBy("as_of_day").parquet(
            f"{self.path}/data/{snapshot}")

    def _write_versions(self, base: Manifest, new: DataFrame, snapshot: str) -> list[str]:
        old = self.versions(base.number) if base.number else self.spark.createDataFrame([], self.version_schema)
        every = next_versions(old, new, self.key)
        merge = len(base.versions) >= VERSION_PARTS
        fresh = every if merge else every.join(new.select(*self.key, "as_of_date").distinct(), [*self.key, "as_of_date"], "left_semi")
        fresh.hint("rebalance").write.parquet(f"{self.path}/versions/{snapshot}")
        return [f"versions/{snapshot}"] if merge else [*base.versions, f"versions/{snapshot}"]

    # ------------------------------------------------------------ upkeep

    def vacuum(self, keep: int = 1) -> list[str]:
        """Drop all but the last ``keep`` manifests and every folder none of them names,
        also those of broken saves; the folders dropped. Not to be run beside a save."""
        kept = self.numbers()[-keep:]
        named = {folder for n in kept for m in (self.manifest(n),) for folder in (*m.days.values(), *m.versions)}
        dropped = []
        for kind in ("data", "versions"):
            fs, folder = self._at(kind)
            for status in fs.listStatus(folder) if fs.exists(folder) else ():
                name = f"{kind}/{status.getPath().getName()}"
                if name not in named:
                    fs.delete(status.getPath(), True)
                    dropped.append(name)
        for n in self.numbers():
            if n not in kept:
                fs, at = self._at(f"manifests/{n:010d}.json")
                fs.delete(at, False)
        return dropped
