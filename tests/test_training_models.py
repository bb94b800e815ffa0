"""Splits, negatives, scores and metrics against plain Python."""

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions.stats import two_sided_p
from tidemark.operators import evaluate, models, selection, training


@pytest.fixture(scope="module")
def views(spark):
    """User 0 makes a third of all views; user 1 has seen every item."""
    rng = random.Random(1)
    rows = [(i, 0 if i % 3 == 0 else rng.randrange(2, 9), rng.randrange(0, 40)) for i in range(400)]
    rows += [(1000 + i, 1, i) for i in range(40)]
    return spark.createDataFrame(rows, "event_id bigint, user_id int, item_id int").cache()


def test_train_val_split_cuts_inside_a_tie(spark):
    start = datetime(2024, 1, 1)
    rows = [(i, start + timedelta(days=i // 5)) for i in range(13)]
    df = spark.createDataFrame(rows, "event_id int, timestamp timestamp_ntz")
    got = {r["event_id"]: r["part"] for r in training.train_val_split(df).collect()}
    assert [got[i] for i in range(13)] == ["train"] * 10 + ["val"] * 3
    one = training.train_val_split(df.limit(1)).collect()
    assert [r["part"] for r in one] == ["val"]


def test_split_date(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 12),), (datetime(2024, 1, 31, 13),)], "timestamp timestamp_ntz")
    assert training.split_date(df).first()["split_date"].isoformat() == "2024-01-25"  # 30 days: six of them


def test_unknown_id_has_no_index(spark, views):
    index = training.id_index(views, "item_id")
    assert sorted(r["index"] for r in index.collect()) == list(range(index.count()))
    df = spark.createDataFrame([(5,), (999,)], "item_id int")
    got = {r["item_id"]: r["i"] for r in training.with_index(df, index, "item_id", "i").collect()}
    assert got[999] is None and got[5] is not None


@pytest.mark.parametrize("width", [1, 3, 1024])
def test_negatives(views, width):
    index = training.id_index(views, "item_id")
    rows = training.negative_samples(views, index, 4, "s", width=width).collect()
    seen = {(r["user_id"], r["item_id"]) for r in views.collect()}
    drawn = [(r["event_id"], r["user_id"], r["slot"], r["item_id"]) for r in rows]
    assert not {(u, i) for _, u, _, i in drawn} & seen
    assert 1 not in {u for _, u, _, _ in drawn}
    expected = {(r["event_id"], s) for r in views.filter("user_id <> 1").collect() for s in (1, 2, 3, 4)}
    assert sorted((e, s) for e, _, s, _ in drawn) == sorted(expected)
    again = training.negative_samples(views, index, 4, "s", width=7).collect()
    assert {(r["event_id"], r["slot"], r["item_id"]) for r in again} == {(e, s, i) for e, _, s, i in drawn}
    other = training.negative_samples(views, index, 4, "t").collect()
    assert {(r["event_id"], r["slot"], r["item_id"]) for r in other} != {(e, s, i) for e, _, s, i in drawn}


def test_negatives_cover_all_unseen_items(spark):
    rows = [(i, 0, 0) for i in range(400)] + [(1000 + i, 1, i) for i in range(5)]
    df = spark.createDataFrame(rows, "event_id bigint, user_id int, item_id int")
    got = [r["item_id"] for r in training.negative_samples(df, training.id_index(df, "item_id")).filter("user_id = 0").collect()]
    assert len(got) == 1600 and set(got) == {1, 2, 3, 4}
    assert min(got.count(i) for i in set(got)) > 300


def predictions(spark, n=300, seed=2):
    rng = random.Random(seed)
    rows = [("hot" if i % 3 == 0 else f"u{i % 7}", i, round(rng.random(), 1), int(rng.random() < 0.3)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "user_id string, item_id int, score double, label int")


def test_auc(spark):
    rows, df = predictions(spark)
    pos, neg = [r[2] for r in rows if r[3]], [r[2] for r in rows if not r[3]]
    wins = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    assert evaluate.auc(df).first()["auc"] == pytest.approx(wins / len(pos) / len(neg), abs=1e-12)
    assert evaluate.auc(df.filter("label = 1")).first()["auc"] == 0.5


def test_ndcg_and_hits(spark):
    rows, df = predictions(spark)
    ndcg = {r["user_id"]: r["ndcg"] for r in evaluate.ndcg_by_user(df, 5).collect()}
    hits = {r["user_id"]: r["hit"] for r in evaluate.hit_by_user(df, 5).collect()}
    for user in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == user), key=lambda r: (-r[2], r[1]))
        gain = sum(r[3] / math.log2(i + 2) for i, r in enumerate(mine[:5]))
        best = sum(1 / math.log2(i + 2) for i in range(min(5, sum(r[3] for r in mine))))
        assert ndcg[user] == pytest.approx(gain / best if best else 0.0, abs=1e-12)
        assert hits[user] == max(r[3] for r in mine[:5])
    none = evaluate.ndcg_by_user(df.withColumn("label", F.lit(0))).collect()
    assert {r["ndcg"] for r in none} == {0.0}


def test_log_loss_is_clamped(spark):
    df = spark.createDataFrame([(1.0, 0), (0.0, 0), (0.5, 1)], "score double, label int")
    assert evaluate.log_loss(df).first()["log_loss"] == pytest.approx((100 + 0 + math.log(2)) / 3)


def test_gate_needs_every_metric(spark):
    good = spark.createDataFrame([("auc", 0.75), ("ndcg_at_10", 0.6), ("hit_rate_at_10", 0.4)], "metric string, value double")
    assert {r["deploy"] for r in evaluate.deploy_gate(good).collect()} == {True}
    rows = evaluate.deploy_gate(good.filter("metric <> 'auc'")).collect()
    assert {r["deploy"] for r in rows} == {False} and [r["value"] for r in rows if r["metric"] == "auc"] == [0.0]


def test_best_trial_stops_after_three_without_gain(spark):
    df = spark.createDataFrame(list(enumerate([0.5, 0.6, 0.6, 0.55, 0.59, 0.9])), "trial int, auc double")
    assert tuple(evaluate.best_trial(df).first()) == (1, 0.6, 5)
    assert tuple(evaluate.best_trial(df.filter("trial < 3")).first()) == (1, 0.6, 3)


def test_compare_metrics(spark):
    a = spark.createDataFrame([("x", 2.0), ("z", 0.0), ("only1", 1.0)], "metric string, value double")
    b = spark.createDataFrame([("x", 3.0), ("z", 1.0), ("only2", 1.0)], "metric string, value double")
    got = {r["metric"]: (r["difference"], r["percent_change"]) for r in evaluate.compare_metrics(a, b).collect()}
    assert got == {"x": (1.0, 50.0), "z": (1.0, None), "only1": (None, None), "only2": (None, None)}


def test_paired_t(spark):
    # published table values: t(4) = 2.776445 and t(100) = 1.983972 are the two-sided 5 % points
    assert two_sided_p(2.776445, 4) == pytest.approx(0.05, abs=1e-6)
    assert two_sided_p(1.983972, 100) == pytest.approx(0.05, abs=1e-6)
    assert two_sided_p(0.0, 9) == pytest.approx(1.0)
    assert two_sided_p(-12.7062, 1) == pytest.approx(0.05, abs=1e-5)
    df = spark.createDataFrame([(1.0, 0.0), (2.0, 0.5), (3.0, 1.0), (4.5, 2.0)], "a double, b double")
    row = evaluate.paired_t(df, "a", "b").first()
    d = np.array([1.0, 1.5, 2.0, 2.5])
    assert row["n"] == 4 and row["t"] == pytest.approx(d.mean() / (d.std(ddof=1) / 2))
    assert row["significant"] is True and row["p_value"] == pytest.approx(0.0123, abs=2e-3)
    assert evaluate.paired_t(df.limit(1), "a", "b").first()["p_value"] is None


def test_latest_version(spark):
    runs = spark.createDataFrame([("m", 1, "production", 10), ("m", 2, "staging", 20), ("n", 7, "none", 5)], "model string, version int, stage string, created_at int")
    assert {(r["model"], r["version"]) for r in evaluate.latest_version(runs).collect()} == {("m", 2), ("n", 7)}
    assert [(r["model"], r["version"]) for r in evaluate.latest_version(runs, "production").collect()] == [("m", 1)]


def test_fused_model_by_hand(spark):
    w = models.NcfWeights(
        hidden=[{"matrix": np.array([[1.0, -1.0], [0.5, 0.0], [0.0, 1.0], [1.0, 1.0]]), "bias": np.array([0.1, -10.0]),
                 "mean": np.array([1.0, 0.0]), "variance": np.array([4.0, 1.0]) - models.BATCH_NORM_EPSILON,
                 "scale": np.array([2.0, 1.0]), "shift": np.array([0.5, 0.0])}],
        out=np.array([1.0, -1.0, 0.5, 3.0]), out_bias=0.25)
    users = spark.createDataFrame([(1, [1.0, 2.0], [1.0, 2.0])], "user_id bigint, gmf array<double>, mlp array<double>")
    items = spark.createDataFrame([(5, [3.0, 1.0], [0.5, 1.5])], "movie_id bigint, gmf array<double>, mlp array<double>")
    pairs = spark.createDataFrame([(1, 5), (1, 6)], "user_id bigint, movie_id bigint")
    rows = models.ncf_score(pairs, users, items, w).collect()
    # layer: inputs (1, 2, .5, 1.5) give 1 + 1 + 0 + 1.5 + .1 = 3.6; normalised (3.6 - 1) / 2 * 2 + .5 = 3.1; the other unit is off
    assert len(rows) == 1 and rows[0]["score"] == pytest.approx(1 / (1 + math.exp(-(3.0 - 2.0 + 0.5 * 3.1 + 0.25))))


def test_als_prefers_the_own_group(spark):
    pairs = [(u, i, 1.0) for u in range(10) for i in range(10) if u % 2 == i % 2 and (u, i) != (0, 8)]
    df = spark.createDataFrame(pairs, "user int, item int, weight double")
    model = models.fit_als(df, rank=4, iterations=5)
    users, items = models.als_vectors(model)
    wanted = spark.createDataFrame([(0, 8), (0, 7)], "user_id int, movie_id int")
    got = {r["movie_id"]: r["score"] for r in models.factor_score(wanted, users, items).collect()}
    assert got[8] > got[7]


def test_the_chosen_model_is_the_best_on_held_out_pairs(spark):
    """Two groups of users with items of their own, all items equally popular."""
    rng = random.Random(3)
    seen = {(u, i): rng.random() for u in range(60) for i in range(40) if i % 2 == u % 2}
    train = [(u, i, 1.0) for (u, i), r in seen.items() if r < 0.5]
    held = [(u, i, 1) for (u, i), r in seen.items() if r >= 0.5] + [(u, rng.randrange(20) * 2 + 1 - u % 2, 0) for u in range(60) for _ in range(12)]
    held += [(99, 3, 0), (5, 77, 0)]  # unknown user, unknown item
    frames = spark.createDataFrame(train, "user int, item int, weight float"), spark.createDataFrame(held, "user int, item int, label int")
    trials = selection.grid((2, 6), (0.01, 50.0))
    assert [(t.trial, t.rank, t.reg) for t in trials] == [(1, 2, 0.01), (2, 2, 50.0), (3, 6, 0.01), (4, 6, 50.0)]
    found = selection.select_als(*frames, trials, iterations=4)
    rows = {r.trial: r.auc for r in found.trials.collect()}
    assert len(rows) == 4 and found.auc == max(rows.values()) == rows[found.winner.trial]
    scores = selection.scored(found.model, frames[1])
    assert scores.count() == len(held) and evaluate.auc(scores).first().auc == found.auc
    assert found.auc > 0.9 > selection.popularity_auc(*frames)


def test_trials_stop_when_patience_ends(spark, monkeypatch):
    values = {1: 0.6, 2: 0.7, 3: 0.7, 4: 0.65, 5: 0.69, 6: 0.9}
    monkeypatch.setattr(models, "fit_als", lambda train, rank, *_: rank)
    monkeypatch.setattr(selection, "scored", lambda model, held: model)

    class Result:
        def __init__(self, auc):
            self.auc = auc

        def first(self):
            return {"auc": self.auc}

    monkeypatch.setattr(evaluate, "auc", lambda rank: Result(values[rank]))
    pairs = spark.createDataFrame([(1, 1, 1.0)], "user int, item int, weight float")
    found = selection.select_als(pairs, pairs, selection.grid(list(values), (0.1,)), at_once=1)
    assert found.trials.count() == 6 - 1 and (found.winner.trial, found.auc) == (2, 0.7)
