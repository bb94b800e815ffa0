"""Versions and rows of a save become visible together or not at all."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import snapshots, store
from tidemark.operators.snapshots import SaveConflict, VersionedTable


def rows(spark, *values, day="2024-01-08 00:00:00"):
    wide = spark.createDataFrame([(e, float(v)) for e, v in values], "user_id string, score double")
    return store.entity_rows(wide, "user_id", "user", F.lit(day), F.lit(day))


def state(table, number=None):
    held = {(r.entity_id, str(r.as_of_date)[:10]): r.feature_value for r in table.read(number=number).collect()}
    return held, {(r.entity_id, str(r.as_of_date)[:10]): r.version for r in table.versions(number).collect()}


def test_saves_and_earlier_states(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/t")
    assert state(table) == ({}, {})
    table.save(rows(spark, ("a", 1), ("b", 2)))
    table.save(rows(spark, ("a", 3), day="2024-01-09 00:00:00"))
    table.save(rows(spark, ("a", 4)))
    assert table.save(rows(spark).limit(0)).number == 3
    assert state(table) == (
        {("a", "2024-01-08"): "4.0", ("b", "2024-01-08"): "2.0", ("a", "2024-01-09"): "3.0"},
        {("a", "2024-01-08"): 3, ("b", "2024-01-08"): 1, ("a", "2024-01-09"): 2})
    assert state(table, 1) == ({("a", "2024-01-08"): "1.0", ("b", "2024-01-08"): "2.0"}, {("a", "2024-01-08"): 1, ("b", "2024-01-08"): 1})
    assert table.read(upto_day="2024-01-08").count() == 2
    again = VersionedTable(spark, f"{tmp_path}/t")
    assert state(again) == state(table)


def test_a_save_broken_between_the_tables_leaves_the_old_state(spark, tmp_path, monkeypatch):
    table = VersionedTable(spark, f"{tmp_path}/t")
    table.save(rows(spark, ("a", 1)))
    before = state(table)

    def broken(*_):
        raise OSError("disk full")

    monkeypatch.setattr(VersionedTable, "_write_versions", broken)
    with pytest.raises(OSError):
        table.save(rows(spark, ("a", 2), ("b", 2)))
    assert state(table) == before and len(list((tmp_path / "t/data").iterdir())) == 2
    monkeypatch.undo()
    assert len(table.vacuum()) == 1 and state(table) == before
    table.save(rows(spark, ("a", 2)))
    assert state(table)[1] == {("a", "2024-01-08"): 2}


def test_of_two_saves_at_once_one_fails_and_leaves_nothing(spark, tmp_path, monkeypatch):
    table, other = (VersionedTable(spark, f"{tmp_path}/t") for _ in range(2))
    table.save(rows(spark, ("a", 1)))
    write = VersionedTable._write_versions

    def raced(self, base, new, snapshot):
        monkeypatch.setattr(VersionedTable, "_write_versions", write)
        other.save(rows(spark, ("a", 5)))
        return write(self, base, new, snapshot)

    monkeypatch.setattr(VersionedTable, "_write_versions", raced)
    with pytest.raises(SaveConflict):
        table.save(rows(spark, ("a", 2)))
    assert state(table) == ({("a", "2024-01-08"): "5.0"}, {("a", "2024-01-08"): 2}) and table.numbers() == [1, 2]
    assert not [p for p in (tmp_path / "t/manifests").iterdir() if p.name.endswith(".tmp")]


def test_folders_of_versions_stay_few(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "VERSION_PARTS", 2)
    table = VersionedTable(spark, f"{tmp_path}/t")
    for n in range(4):
        manifest = table.save(rows(spark, ("a", n), (f"u{n}", n)))
        assert len(manifest.versions) <= 2
    assert {e: v for (e, _), v in state(table)[1].items()} == {"a": 4, "u0": 1, "u1": 1, "u2": 1, "u3": 1}
    table.vacuum(keep=1)
    assert table.numbers() == [4] and state(table)[0][("a", "2024-01-08")] == "3.0"
