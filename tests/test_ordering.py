"""Global order, top-n and as-of look-ups against plain Python, with hot keys."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.functions.ordering import asof_lookup, numbered, running_total, top_n
from tidemark.functions.timegrid import exact_quantiles, running_by_time


def skewed_rows(n=600, seed=3):
    """(key, at, value) with a third of the rows on key 0."""
    rng = random.Random(seed)
    return [(0 if i % 3 == 0 else rng.randrange(1, 20), rng.randrange(0, 200), i) for i in range(n)]


def test_numbered_is_dense_and_ordered(spark):
    df = spark.createDataFrame(skewed_rows(), "key int, at int, value int")
    got = [(r["at"], r["value"], r["row_number"]) for r in numbered(df, [F.col("at"), F.col("value")]).collect()]
    got.sort(key=lambda r: r[2])
    assert [r[2] for r in got] == list(range(1, 601))
    assert [r[:2] for r in got] == sorted(r[:2] for r in got)


def test_numbered_of_nothing(spark):
    assert numbered(spark.createDataFrame([], "a int"), [F.col("a")]).count() == 0


def test_running_total(spark):
    df = spark.createDataFrame(skewed_rows(), "key int, at int, value int")
    rows = sorted((r["at"], r["value"], r["total"]) for r in running_total(df, [F.col("at"), F.col("value")], "value", "total").collect())
    total = 0
    for _, value, got in rows:
        total += value
        assert got == total


def test_top_n_with_a_hot_group(spark):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "key int, at int, value int")
    got = {}
    for r in top_n(df, ["key"], [F.desc("at"), F.asc("value")], 7, salts=5).collect():
        got.setdefault(r["key"], {})[r["rank"]] = r["value"]
    for key in {r[0] for r in rows}:
        best = sorted((r for r in rows if r[0] == key), key=lambda r: (-r[1], r[2]))[:7]
        assert got[key] == {i + 1: r[2] for i, r in enumerate(best)}


def test_asof_lookup_for_every_width(spark):
    rng = random.Random(5)
    left = skewed_rows(300)
    right = sorted({(rng.choice([0, 0, 1, 2, 5, 30]), rng.randrange(0, 200)) for _ in range(80)})
    l = spark.createDataFrame(left, "key int, at bigint, value int")
    r = spark.createDataFrame([(k, t, f"{k}@{t}") for k, t in right], "key int, since bigint, tag string")
    for width in (1, 13, 1000):
        got = {x["value"]: x["tag"] for x in asof_lookup(l, r, ["key"], "at", "since", ["tag"], width).collect()}
        assert len(got) == 300
        for key, at, value in left:
            past = [t for k, t in right if k == key and t <= at]
            assert got[value] == (f"{key}@{max(past)}" if past else None)


def test_exact_quantiles(spark):
    rows = [("a", float(v)) for v in (1, 2, 2, 3, 10)] + [("b", 4.0)] + [("a", None)]
    got = {(r["g"], r["quantile"]): r["v"] for r in exact_quantiles(spark.createDataFrame(rows, "g string, v double"), "g", "v", (0.0, 0.5, 0.9, 1.0)).collect()}
    assert got[("a", 0.0)] == 1.0 and got[("a", 0.5)] == 2.0 and got[("a", 1.0)] == 10.0
    assert abs(got[("a", 0.9)] - 7.2) < 1e-12
    assert {got[("b", q)] for q in (0.0, 0.5, 0.9, 1.0)} == {4.0}


def test_running_by_time_carries_over_periods(spark):
    df = spark.createDataFrame([("x", i, 1 if i % 3 else -1) for i in range(40)], "k string, t bigint, m bigint")
    got = {r["t"]: r["n"] for r in running_by_time(df, ["k"], "t", F.floor(F.col("t") / 7), "m", "n").collect()}
    total = 0
    for i in range(40):
        total += 1 if i % 3 else -1
        assert got[i] == total


@pytest.mark.parametrize("most", [1, 3, 64])
def test_asof_arrays_have_a_bound(spark, most):
    """A hot key with most rows in one bucket, cut into parts of any size."""
    rng = random.Random(most)
    right = [("hot", at, f"h{at}") for at in sorted(rng.sample(range(1_000), 200))] + [("hot", 5_000 + i, f"z{i}") for i in range(0, 40, 3)]
    right += [("b", at, f"b{at}") for at in rng.sample(range(4_000), 9)]
    left = [(k, at) for k in ("hot", "b", "none", None) for at in rng.sample(range(-50, 7_000), 120)]
    frames = spark.createDataFrame(left, "k string, t long"), spark.createDataFrame(right, "k string, at long, v string")
    got = asof_lookup(*frames, ["k"], "t", "at", ["v"], 1_000, most)
    want = Counter((k, t, max(((at, v) for key, at, v in right if key == k and at <= t), default=(0, None))[1]) for k, t in left)
    assert Counter(tuple(r) for r in got.collect()) == want
