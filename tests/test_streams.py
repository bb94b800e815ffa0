"""Streams fed in several runs must agree with one batch over the same rows."""

import random
from collections import Counter
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.operators import features
from tidemark.sources import archive, events as sources, record_log
from tidemark.streaming import jobs

START = datetime(2024, 1, 1)


def deliver(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def test_dedup_over_runs(spark, tmp_path):
    folder, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = "event_id int, timestamp timestamp_ntz"
    for first in (0, 5, 10):
        deliver(spark, folder, [(i, START + timedelta(minutes=i)) for i in range(first, first + 8)], schema)
        stream = sources.file_stream(spark, folder, spark.read.parquet(folder).schema, "*.parquet")
        jobs.drain(jobs.dedup(stream, out, check))
    assert sorted(r["event_id"] for r in spark.read.parquet(out).collect()) == list(range(18))


def test_late_rows_leave_the_windows_but_stay_in_the_raw_table(spark, tmp_path):
    folder, windows, raw = (str(tmp_path / n) for n in ("in", "windows", "raw"))
    schema = "user_id int, movie_id int, event_type string, timestamp timestamp_ntz"
    deliveries = [[(1, 7, "view", START + timedelta(hours=h)) for h in range(5)],
                  [(1, 7, "view", START + timedelta(days=5)), (2, None, "search", START + timedelta(days=5))],
                  [(1, 7, "skip", START + timedelta(hours=6)), (1, 8, "view", START + timedelta(days=5, hours=1))]]
    for rows in deliveries:
        deliver(spark, folder, rows, schema)
        read = lambda: sources.file_stream(spark, folder, spark.read.parquet(folder).schema, "*.parquet")
        jobs.drain(jobs.daily_counts(read(), windows, windows + "-check"))
        jobs.drain(jobs.keep_raw(read(), raw, raw + "-check"))
    got = {(r["window_start"].day, r["kind"], r["id"]): (r["events"], r["views"]) for r in jobs.latest_windows(spark, windows, ["kind", "id"]).collect()}
    assert got == {(1, "user", 1): (5, 5), (1, "item", 7): (5, 5), (6, "user", 1): (2, 2), (6, "user", 2): (1, 0), (6, "item", 7): (1, 1), (6, "item", 8): (1, 1)}
    corrected = features.daily_user_counts(spark.read.parquet(raw))
    assert {(r["user_id"], r["day"].day): r["events"] for r in corrected.collect()} == {(1, 1): 6, (1, 6): 2, (2, 6): 1}


def test_repeated_batch_replaces_its_output(spark, tmp_path):
    out = str(tmp_path / "out")
    write = jobs.into_batches(out)
    df = spark.range(5)
    write(df, 0)
    write(df, 0)
    write(spark.range(2), 1)
    assert spark.read.parquet(out).count() == 7


def test_archive(spark, tmp_path):
    path = str(tmp_path / "archive")
    rows = [(f"test_{i}" if i < 3 else f"event_{i}", f"user_{i % 2}") for i in range(6)]
    archive.append(spark.createDataFrame(rows, "event_id string, user_id string"), path)
    assert archive.find(archive.read(spark, path), event_id="event_4").count() == 1
    assert archive.find(archive.read(spark, path), user_id="user_0").count() == 3
    archive.delete(spark, path, "^test_")
    kept = archive.read(spark, path)
    assert kept.count() == 3 and archive.find(kept, id_pattern="^test_").count() == 0
    archive.append(spark.createDataFrame([("event_9", "user_0")], "event_id string, user_id string"), path)
    assert archive.read(spark, path).count() == 4


def rows_scanned(df):
    """Rows that the scan of a plan without shuffles handed on, once it has run."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()


def test_a_look_up_skips_row_groups(spark, tmp_path):
    """Ids of no order in four appends: ranges leave one file of each, Bloom filters almost none."""
    path = str(tmp_path / "archive")
    for part in range(4):
        made = spark.range(part, 80_000, 4).select(F.md5(F.col("id").cast("string")).alias("event_id"), F.concat(F.lit("u"), F.col("id") % 50).alias("user_id"))
        archive.append(made.repartition(8), path)
    events = spark.read.parquet(f"{path}/events")
    some = [r.event_id for r in events.orderBy(F.xxhash64("event_id")).limit(10).collect()]
    read = [rows_scanned(archive.find(events, event_id=i)) for i in some]
    assert all(0 < n <= 20_000 for n in read)  # the ranges of all four appends hold every id
    absent = [rows_scanned(archive.find(events, event_id=f"{n:032x}"[::-1])) for n in range(20)]
    assert sum(n == 0 for n in absent) >= 16
    assert archive.lookup(spark, path, some).count() == 10
    archive.delete(spark, path, f"^{some[0]}$")
    assert {r.event_id for r in archive.lookup(spark, path, some).collect()} == set(some[1:])


def test_write_events_layout(spark, tmp_path):
    path = str(tmp_path / "events")
    df = spark.createDataFrame([(1, "view", START), (2, "skip", START + timedelta(days=1))], "event_id int, event_type string, timestamp timestamp_ntz")
    sources.write_events(df, path)
    back = spark.read.parquet(path)
    assert {(r["event_id"], r["event_type"], str(r["event_date"])) for r in back.collect()} == {(1, "view", "2024-01-01"), (2, "skip", "2024-01-02")}
    plan = back.filter(F.col("event_date") == "2024-01-01")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_late_ids_are_not_lost(spark, tmp_path):
    folder, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = "event_id string, timestamp timestamp_ntz"
    for rows in ([("e1", START + timedelta(days=25))], [("e2", START + timedelta(days=26)), ("e1", START)], [("e3", START), ("e2", START)]):
        deliver(spark, folder, rows, schema)
        stream = sources.file_stream(spark, folder, spark.read.parquet(folder).schema, "*.parquet")
        jobs.drain(jobs.dedup(stream, out, check))
    assert sorted(r["event_id"] for r in spark.read.parquet(out).collect()) == ["e1", "e2", "e3"]


def test_a_batch_run_again_leaves_nothing_of_its_first_run(spark, tmp_path):
    write = jobs.into_batches(str(tmp_path / "out"), ["outcome"])
    write(spark.createDataFrame([(1, "quarantine"), (2, "good")], "id int, outcome string"), 0)
    write(spark.createDataFrame([(1, "good"), (2, "good")], "id int, outcome string"), 0)
    assert {r["outcome"] for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {"good"}


def test_a_batch_touches_its_own_ids_only(spark, tmp_path):
    """Four runs, each with new ids, late ones and repeats: state grows by the new ids, written rows are not read again."""
    folder, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = "event_id int, timestamp timestamp_ntz"
    touched = []
    for first in (0, 100, 200, 300):
        ids = [*range(first, first + 100), *range(0, first, 7), first]
        deliver(spark, folder, [(i, START - timedelta(days=i)) for i in ids], schema)
        started = jobs.dedup(sources.file_stream(spark, folder, spark.read.parquet(folder).schema, "*.parquet"), out, check).trigger(availableNow=True).start()
        started.awaitTermination()
        state = [p["stateOperators"][0] for p in started.recentProgress if p["numInputRows"]]
        touched.append((sum(o["numRowsUpdated"] for o in state), state[-1]["numRowsTotal"]))
        assert sum(p["numInputRows"] for p in started.recentProgress) == len(ids)  # the source's rows and no others
    assert touched == [(100, 100), (100, 200), (100, 300), (100, 400)]
    assert sorted(r["event_id"] for r in spark.read.parquet(out).collect()) == list(range(400))


def test_windows_of_three_widths_from_one_state_of_panes(spark, tmp_path):
    rng = random.Random(2)
    base, folder = str(tmp_path), str(tmp_path / "in")
    schema = "ts timestamp_ntz, endpoint string, status int, cached boolean, duration_s double"
    made = [(START + timedelta(seconds=rng.randrange(9_000)), rng.choice("ab"), rng.choice((200, 500)), rng.choice((True, False, None)), rng.random()) for _ in range(300)]
    for n in range(3):
        deliver(spark, folder, [r for r in made if n * 3_000 <= (r[0] - START).seconds < (n + 1) * 3_000], schema)
        stream = sources.file_stream(spark, folder, spark.read.parquet(folder).schema, "*.parquet")
        jobs.drain(jobs.request_panes(stream, f"{base}/panes", f"{base}/windows", f"{base}/check"))
    want = Counter()
    for ts, endpoint, status, _, _ in made:
        end = 30 * ((ts - START).seconds // 30 + 1)
        for width in jobs.WINDOW_WIDTHS:
            for later in range(0, width, 30):
                want[width, endpoint, START + timedelta(seconds=end + later)] += 1
    got = jobs.latest_windows(spark, f"{base}/windows", ["width", "endpoint"], "window_end").collect()
    assert {(r.width, r.endpoint, r.window_end): r.requests for r in got} == want
    assert all(r.latency_counts[-1] == r.requests >= r.errors for r in got)


def test_a_log_of_records_is_read_in_order_capped_and_resumed(spark, tmp_path):
    log, out, check = (str(tmp_path / n) for n in ("log", "out", "check"))
    schema = "topic string, partition int, offset long, key string, value string, timestamp timestamp"

    def add(topic, partition, first, n):
        record_log.append(spark.createDataFrame([(topic, partition, first + i, None, f"v{first + i}", START) for i in range(n)], schema), log)

    def run(cap=None):
        """(topic, partition) and offsets of each batch, in order of reading."""
        rows = record_log.stream(spark, log, cap, topics="a.*")
        started = rows.writeStream.foreachBatch(jobs.into_batches(out)).option("checkpointLocation", check).start()
        started.processAllAvailable()
        started.stop()
        batches = [p for p in started.recentProgress if p["numInputRows"]]
        return [p["numInputRows"] for p in batches]

    add("a", 0, 0, 25), add("a", 1, 5, 3), add("a b", 0, 0, 4), add("other", 0, 0, 9)
    assert run(cap=10) == [10 + 3 + 4, 10, 5]
    add("a", 0, 25, 12), add("a", 2, 0, 1)
    again = run(cap=10)  # counted from what the group committed, which may be a batch behind
    assert sum(again) == 12 + 1 and max(again) <= 10 + 1
    assert run() == []
    add("a", 1, 8, 30)
    assert run() == [30]
    got = spark.read.parquet(out).collect()
    assert Counter((r.topic, r.partition, r.offset) for r in got) == Counter(
        [("a", 0, i) for i in range(37)] + [("a", 1, i) for i in range(5, 38)] + [("a", 2, 0)] + [("a b", 0, i) for i in range(4)])
    assert all(r.value == f"v{r.offset}" and r.key is None for r in got)


def test_dealt_rows_are_four_batches_of_bounded_files(spark, tmp_path, monkeypatch):
    """More rows make more files, not larger ones, and a batch is spread over several tasks."""
    from tidemark.plans import stream_queries
    from tidemark.plans.tables import Tables

    monkeypatch.setattr(stream_queries, "FILE_ROWS", 10)
    monkeypatch.setattr(stream_queries, "scratch_path", lambda _, label: str(tmp_path / label))
    rows = spark.range(0, 120, 1, 5).withColumn("n", F.col("id") * 2)
    stream = stream_queries._streamed(Tables(spark, str(tmp_path)), rows, "dealt", lambda df: df.select("id", (F.col("n") + 1).alias("n")))
    files = list((tmp_path / "dealt").glob("*.parquet"))
    assert len(files) == 12 and max(spark.read.parquet(str(f)).count() for f in files) <= 15
    jobs.drain(jobs.keep_raw(stream, str(tmp_path / "raw"), str(tmp_path / "check")))
    got = spark.read.parquet(str(tmp_path / "raw"))
    assert sorted((r.id, r.n) for r in got.collect()) == [(i, 2 * i + 1) for i in range(120)]
    assert got.groupBy("batch").count().count() == 4
