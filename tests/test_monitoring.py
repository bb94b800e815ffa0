"""Histograms, windows, alert holds and routing, worked by hand."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions.timegrid import bucket_quantile, sliding, step_of
from tidemark.operators import alerts, monitor, profile, search, sketches

START = datetime(2024, 1, 1)
LOG = "ts timestamp_ntz, endpoint string, method string, status int, duration_s double, cached boolean, stage string, fallback_type string, score double"


def log(spark, rows):
    """rows: (seconds from start, endpoint, status, duration, cached)"""
    full = [(START + timedelta(seconds=s), e, "GET", status, d, c, None, None, None) for s, e, status, d, c in rows]
    return spark.createDataFrame(full, LOG)


def test_bucket_quantile(spark):
    bounds = (1.0, 2.0, 4.0)
    df = spark.createDataFrame([([2, 6, 8, 10],), ([0, 0, 4, 4],), ([0, 0, 0, 3],), ([0, 0, 0, 0],), ([4, 4, 4, 4],)], "c array<bigint>")
    got = [r["q"] for r in df.select(bucket_quantile(F.col("c"), 0.5, bounds).alias("q")).collect()]
    # rank 5 is 3/4 into (1, 2]; rank 2 is half into (2, 4]; above the last bound; empty; half into (0, 1]
    assert got == [1.75, 3.0, 4.0, None, 0.5]


def test_sliding_window_ends(spark):
    df = spark.createDataFrame([(START,), (START + timedelta(seconds=1),)], "ts timestamp_ntz")
    steps = df.groupBy(step_of(F.col("ts")).alias("step")).agg(F.count("*").alias("n"))
    base = int((START - datetime(1970, 1, 1)).total_seconds())
    got = {r["eval_at"] - base: r["n"] for r in sliding(steps, [], {"n": F.sum("n")}, 60).collect()}
    # (t - 60, t]: the first row is in at 0 and 30, the second at 30 and 60
    assert got == {0: 1, 30: 2, 60: 1}


def test_error_rate_and_cache(spark):
    df = log(spark, [(1, "/a", 500, 0.1, True), (2, "/a", 200, 0.1, False), (3, "/b", 404, 0.1, None), (4, "/b", 200, 0.1, True)])
    assert {r["error_percent"] for r in monitor.error_rate(df).collect()} == {25.0}
    row = monitor.cache_hit_rate(df).first()
    assert (row["hits"], row["misses"], row["operations"]) == (2, 1, 3) and row["hit_rate"] == pytest.approx(2 / 3)
    assert monitor.cache_hit_rate(df.filter("cached IS NULL")).first()["hit_rate"] == 0.0
    lost = monitor.cache_lost(log(spark, [(1, "/health", 200, 0.1, None), (400, "/health", 200, 0.1, None), (401, "/a", 200, 0.1, True)]))
    assert {r["lost"] for r in lost.collect()} == {True, False}


def test_active_requests(spark):
    df = log(spark, [(0, "/a", 200, 100.0, None), (10, "/a", 200, 5.0, None), (70, "/a", 200, 1.0, None)])
    got = {r["minute"].minute: (r["starts"], r["ends"], r["active_at_end"], r["peak"]) for r in monitor.active_requests(df).collect()}
    assert got == {0: (2, 1, 1, 2), 1: (1, 2, 0, 2)}


def test_sla_misses(spark):
    runs = spark.createDataFrame([(1, "train", 14401.0), (2, "train", 14400.0), (3, "nothing", 1e9)], "run_id int, stage string, seconds double")
    assert [r["run_id"] for r in monitor.sla_misses(runs).collect()] == [1]


def test_series_summary_takes_last_known(spark):
    df = spark.createDataFrame([("s", 1, 2.0), ("s", 2, 4.0), ("s", 3, None)], "name string, at int, v double")
    assert tuple(monitor.series_summary(df, ["name"], "v", "at").first()) == ("s", 3.0, 4.0, 6.0, 4.0)


def metric(spark, name, values, start=0, series=""):
    return spark.createDataFrame([(name, series, start + 30 * i, v) for i, v in enumerate(values) if v is not None], "alertname string, series string, eval_at bigint, value double")


def fired(spark, *metrics):
    out = metrics[0]
    for m in metrics[1:]:
        out = out.unionByName(m)
    return alerts.firing(alerts.breaches(out, alerts.rules(spark)))


def test_alert_needs_its_whole_hold(spark):
    # five minutes are ten steps of 30 s: the alert fires at the eleventh breached step
    got = fired(spark, metric(spark, "HighErrorRate", [9.0] * 12)).collect()
    assert sorted(r["eval_at"] for r in got) == [300, 330] and {r["active_since"] for r in got} == {0}
    assert fired(spark, metric(spark, "HighErrorRate", [9.0] * 6 + [5.0] + [9.0] * 9)).count() == 0  # 5.0 is not above 5
    assert fired(spark, metric(spark, "HighErrorRate", [9.0] * 6 + [None] + [9.0] * 9)).count() == 0  # a gap is no breach
    other = metric(spark, "HighLatency", [1.0] * 6, series="/a").unionByName(metric(spark, "HighLatency", [1.0] * 6, 180, "/b"))
    assert fired(spark, other).count() == 0  # two series do not add up


def test_both_sides_of_a_range(spark):
    m = metric(spark, "ModelScoreAnomaly", [0.29, 0.3, 0.9, 0.91])
    got = {r["eval_at"]: r["breached"] for r in alerts.breaches(m, alerts.rules(spark)).collect()}
    assert got == {0: True, 30: False, 60: False, 90: True}


def test_there_are_thirteen_rules(spark):
    assert alerts.rules(spark).count() == 13 == alerts.rules(spark).select("alertname").distinct().count()


def test_routing(spark):
    schema = "eval_at bigint, alertname string, series string, severity string, component string"
    rows = [
        (0, "X", "1", "critical", "api"), (0, "X", "2", "warning", "api"), (0, "X", "3", "warning", "cache"), (0, "Y", "", "warning", "api"),
        (30, "ServiceDown", "a", "critical", "api"), (30, "ServiceDown", "b", "critical", "api"), (30, "X", "", "critical", "db"), (30, "Y", "", "warning", "api"),
    ]
    got = {(r["eval_at"], r["alertname"], r["severity"], r["component"]): r["alerts"] for r in alerts.route(spark.createDataFrame(rows, schema)).collect()}
    assert got == {(0, "X", "critical", "api"): 1, (0, "X", "warning", "cache"): 1, (0, "Y", "warning", "api"): 1, (30, "ServiceDown", "critical", "api"): 2}


def test_silence_is_low_traffic(spark):
    df = log(spark, [(0, "/a", 200, 0.1, None), (3600, "/a", 200, 0.1, None)])
    rates = {r["eval_at"]: r["rate"] for r in alerts.low_request_rate(alerts.step_totals(df)).collect()}
    assert len(rates) == 121 and list(sorted(rates.values()))[0] == 0.0


# ---------------------------------------------------------------- profiles and search


def test_profile_users(spark):
    df = spark.createDataFrame([("18-24", "EU"), ("18-24", "APAC"), (None, "EU")], "age_group string, region string")
    got = {(r["attribute"], r["value"]): r["users"] for r in profile.profile_users(df).collect()}
    assert got == {("age_group", "18-24"): 2, ("age_group", None): 1, ("region", "EU"): 2, ("region", "APAC"): 1}


def test_search_counts_like_a_text_search(spark):
    docs = [(1, "aaaa\nplain\nKafka"), (2, "no hit"), (3, "x\nAA b\ny\nz\nw\naa"), (4, "kafka kafka kafka kafka"), (5, None)]
    df = spark.createDataFrame(docs, "doc_id int, text string")
    got = [tuple(r) for r in search.keyword_search(df, "AA kafka").collect()]
    want = [(d, sum(t.lower().count(w) for w in ("aa", "kafka"))) for d, t in docs if t]
    assert got == sorted([w for w in want if w[1]], key=lambda w: (-w[1], w[0]))
    assert search.keyword_search(df, "  ").count() == 0
    snippets = {(r["doc_id"], r["snippet_number"]): r["snippet"] for r in search.search_snippets(df, "aa").collect()}
    assert snippets == {(1, 1): "aaaa\nplain\nKafka", (3, 1): "x\nAA b\ny\nz", (3, 2): "z\nw\naa"}


def test_a_counter_grows_over_its_restarts(spark):
    start = datetime(2024, 1, 1)
    for values, grown in (([10.0, 0.0, 1.0], 1.0), ([1.0, 4.0, 9.0], 8.0), ([5.0], 0.0)):
        rows = [(start + timedelta(minutes=i), "restarts", "svc", v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, "ts timestamp_ntz, metric string, instance string, value double")
        assert sum(r.rise for r in monitor.gauge_steps(df).collect()) == grown


@pytest.mark.parametrize("window", [30, 300, 1_800, 86_400])
def test_windows_by_change_points_equal_every_window(spark, window):
    """Two series over four days with rows at and around midnight, several rows a step."""
    rng = random.Random(window)
    day = 86_400
    steps = [d * day + o for d in range(1, 4) for o in (-60, -30, 0, 30, 1_770, 1_800)] + [rng.randrange(day, 4 * day) // 30 * 30 for _ in range(40)]
    rows = [(rng.choice("ab"), s, rng.randrange(9), rng.choice((None, rng.randrange(5)))) for s in steps for _ in range(rng.randint(1, 2))]
    frame = spark.createDataFrame(rows, "k string, step long, x int, y int")
    got = sliding(frame, ["k"], {"x": F.sum("x"), "top": F.max("x"), "y": F.sum("y")}, window)
    want = {}
    for k, s, x, y in rows:
        for later in range(0, window, 30):
            at = want.setdefault((k, s + later), [0, 0, None])
            at[0], at[1] = at[0] + x, max(at[1], x)
            at[2] = at[2] if y is None else (at[2] or 0) + y
    assert {(r.k, r.eval_at): [r.x, r.top, r.y] for r in got.collect()} == want
    assert got.count() == len(want)


def test_sketches_merge_to_the_whole(spark):
    rng = random.Random(5)
    start = datetime(2024, 1, 1)
    rows = [(rng.choice(("a", "b")), start + timedelta(days=rng.randrange(10)), f"u{rng.randrange(3_000)}", rng.expovariate(1)) for _ in range(20_000)]
    frame = spark.createDataFrame(rows, "k string, ts timestamp_ntz, user string, v double")
    daily = sketches.daily_sketches(frame, ["k"], "ts", ids="user", value="v")
    found = sketches.quantiles(sketches.distinct_ids(sketches.merged(daily, ["k"], 4)), {"p50": 0.5, "p95": 0.95}).collect()
    assert len(found) == 20
    for r in found:
        inside = [(u, v) for k, ts, u, v in rows if k == r.k and 0 <= (r.last_day - ts.date()).days < 4]
        values = sorted(v for _, v in inside)
        assert r.n == len(inside) and abs(r.distinct_ids - len({u for u, _ in inside})) <= 0.08 * r.distinct_ids
        for q, p in ((0.5, r.p50), (0.95, r.p95)):
            assert abs(sum(v <= p for v in values) / len(values) - q) <= 0.03
