"""Model selection: trials over one written split, scored on held-out pairs, with patience."""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from dataclasses import asdict, dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, functions as F

from tidemark.operators import evaluate, models
from tidemark.session import stage

TRIAL_SCHEMA = "trial int, rank int, reg double, alpha double, auc double"


@dataclass(frozen=True)
class Trial:
    trial: int
    rank: int
    reg: float
    alpha: float


def grid(ranks: Sequence[int], regs: Sequence[float], alphas: Sequence[float] = (1.0,)) -> list[Trial]:
    """Every combination, numbered from 1 in the order given."""
    return [Trial(n, *values) for n, values in enumerate(itertools.product(ranks, regs, alphas), 1)]


@dataclass(frozen=True)
class Selection:
    """``trials`` has one row per trial run; ``model`` is the winner's."""

    trials: DataFrame
    winner: Trial
    auc: float
    model: ALSModel
    held_out: DataFrame


def scored(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """``pairs`` (user, item, label) with the model's score; users and items it never saw score 0."""
    return model.setColdStartStrategy("nan").transform(pairs).withColumn("score", F.nanvl(F.col("prediction"), F.lit(0.0)).cast("double")).drop("prediction")


def popularity_auc(train: DataFrame, held_out: DataFrame) -> float:
    """AUC of scoring every pair by its item's weight in the training rows."""
    weight = train.groupBy("item").agg(F.sum("weight").cast("double").alias("score"))
    ranked = held_out.join(weight, "item", "left").select("label", F.coalesce("score", F.lit(0.0)).alias("score"))
    return evaluate.auc(ranked).first()["auc"]


def select_als(
    train: DataFrame, held_out: DataFrame, trials: Sequence[Trial], iterations: int = 10, at_once: int = 4, patience: int = evaluate.PATIENCE, seed: int = 42,
) -> Selection:
    """Fit every trial on ``train`` (user, item, weight) and keep the one of the best AUC on
    ``held_out`` (user, item, label), the first of equals.

    The split is written once and read by all trials. ``at_once`` trials share the cluster,
    so one small fit does not leave it idle; after each such wave the search stops if
    ``patience`` trials in a row brought no gain.
    """
    train, held_out = stage(train, "trial-train"), stage(held_out, "trial-held-out")
    spark, done, fitted = train.sparkSession, [], {}

    def run(trial: Trial) -> tuple[Trial, ALSModel, float]:
        model = models.fit_als(train, trial.rank, iterations, trial.reg, seed, trial.alpha)
        return trial, model, evaluate.auc(scored(model, held_out)).first()["auc"]

    with ThreadPool(at_once) as pool:
        for first in range(0, len(trials), at_once):
            for trial, model, auc in pool.map(inheritable_thread_target(spark)(run), trials[first : first + at_once]):
                done.append((*asdict(trial).values(), auc))
                fitted[trial.trial] = trial, model, auc
            table = spark.createDataFrame(done, TRIAL_SCHEMA)
            best = evaluate.best_trial(table, patience).first()
            if len(done) - 1 - [d[0] for d in done].index(best["best_trial"]) >= patience:
                break
    winner, model, auc = fitted[best["best_trial"]]
    return Selection(table, winner, auc, model, held_out)
