"""Ranking and classification metrics over (user_id, item_id, score, label) rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.functions.ordering import running_total, top_n
from tidemark.functions.stats import t_test_p

# Cut-off rank, log floor, deployment thresholds, patience, significance level.
TOP_K = 10
LOG_FLOOR = -100.0
DEPLOY_THRESHOLDS = {"auc": 0.75, "ndcg_at_10": 0.50, "hit_rate_at_10": 0.40}
PATIENCE = 3
SIGNIFICANT_BELOW = 0.05


def log_loss(predictions: DataFrame) -> DataFrame:
    """Mean binary cross-entropy over rows with a label and a score; each log is held at
    or above ``LOG_FLOOR``."""

    def log(p: Column) -> Column:
        return F.when(p <= 0, LOG_FLOOR).otherwise(F.greatest(F.log(p), F.lit(LOG_FLOOR)))

    y, p = F.col("label").cast("double"), F.col("score").cast("double")
    loss = F.when(y.isNotNull() & p.isNotNull(), -(y * log(p) + (1 - y) * log(1 - p)))  # greatest() skips nulls
    return predictions.agg(F.avg(loss).alias("log_loss"))


def auc(predictions: DataFrame) -> DataFrame:
    """Area under the ROC curve with ties averaged; 0.5 when only one class is present.

    Rank-sum form over the distinct scores; their running total is made over
    sorted ranges, so even all-distinct scores never meet in one task.
    """
    by_score = predictions.groupBy("score").agg(
        F.sum(F.col("label").cast("bigint")).alias("pos"), F.count("*").alias("n")
    )
    upto = running_total(by_score, [F.col("score")], "n", "upto")
    mean_rank = F.col("upto") - (F.col("n") - 1) / 2.0
    sums = upto.agg(
        F.sum(F.col("pos") * mean_rank).alias("ranks"),
        F.sum("pos").cast("double").alias("p"),
        (F.sum("n") - F.sum("pos")).cast("double").alias("q"),
    )
    value = F.try_divide(F.col("ranks") - F.col("p") * (F.col("p") + 1) / 2, F.col("p") * F.col("q"))
    return sums.select(F.coalesce(value, F.lit(0.5)).alias("auc"))


def _top(predictions: DataFrame, k: int) -> DataFrame:
    return top_n(predictions, ["user_id"], [F.desc("score"), F.asc("item_id")], k)


def ndcg_by_user(predictions: DataFrame, k: int = TOP_K) -> DataFrame:
    """NDCG@k per user with binary gain; 0 for a user without positives."""
    gain = F.col("label") / F.log2(F.col("rank") + 1)
    dcg = _top(predictions, k).groupBy("user_id").agg(F.sum(gain).alias("dcg"))
    best = [0.0]
    for rank in range(1, k + 1):
        best.append(best[-1] + 1.0 / math.log2(rank + 1))
    found = predictions.groupBy("user_id").agg(F.sum(F.col("label").cast("bigint")).alias("positives"))
    ideal = F.get(F.array(*[F.lit(b) for b in best]), F.least(F.col("positives"), F.lit(k)).cast("int"))
    value = F.coalesce(F.try_divide(F.col("dcg"), ideal), F.lit(0.0))
    return found.join(dcg, "user_id").select("user_id", value.alias("ndcg"))


def hit_by_user(predictions: DataFrame, k: int = TOP_K) -> DataFrame:
    """1 for a user with a positive among the top k, else 0."""
    hit = F.max(F.when(F.col("label") == 1, 1).otherwise(0))
    return _top(predictions, k).groupBy("user_id").agg(hit.alias("hit"))


def evaluation(predictions: DataFrame, k: int = TOP_K) -> DataFrame:
    """The metric table (metric, value): auc, ndcg_at_k, hit_rate_at_k, log_loss."""
    parts = [
        auc(predictions).select(F.lit("auc").alias("metric"), F.col("auc").alias("value")),
        ndcg_by_user(predictions, k).agg(F.avg("ndcg").alias("value")).select(
            F.lit(f"ndcg_at_{k}").alias("metric"), "value"),
        hit_by_user(predictions, k).agg(F.avg("hit").alias("value")).select(
            F.lit(f"hit_rate_at_{k}").alias("metric"), "value"),
        log_loss(predictions).select(F.lit("log_loss").alias("metric"), F.col("log_loss").alias("value")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("value", F.coalesce("value", F.lit(0.0)))


def best_trial(trials: DataFrame, patience: int = PATIENCE) -> DataFrame:
    """Best trial by auc, stopping after ``patience`` trials without a gain.

    ``trials`` (trial, auc) has one row per trial or epoch, so the ordered window
    over it is small by nature.
    """
    past = W.orderBy("trial").rowsBetween(W.unboundedPreceding, -1)
    gained = F.coalesce(F.col("auc") > F.max("auc").over(past), F.lit(True))
    upto = W.orderBy("trial").rowsBetween(W.unboundedPreceding, 0)
    counted = trials.withColumn("_gained", gained).withColumn("_n", F.row_number().over(W.orderBy("trial")))
    marked = counted.withColumn("_best_n", F.max(F.when(F.col("_gained"), F.col("_n"))).over(upto))
    stopped = marked.withColumn("_stop", F.max((F.col("_n") - F.col("_best_n") >= patience).cast("int")).over(past))
    run = stopped.filter(F.coalesce("_stop", F.lit(0)) == 0)
    return run.filter("_gained").agg(
        F.max_by("trial", "_n").alias("best_trial"), F.max_by("auc", "_n").alias("best_auc")
    ).withColumn("trials_run", run.agg(F.count("*")).scalar())


def deploy_gate(metrics: DataFrame, thresholds: dict[str, float] | None = None) -> DataFrame:
    """Each threshold against its metric (0 when missing), and whether all pass."""
    limits = metrics.sparkSession.createDataFrame(
        list((thresholds or DEPLOY_THRESHOLDS).items()), "metric string, threshold double"
    )
    checked = limits.join(metrics, "metric", "left").select(
        "metric", "threshold", F.coalesce("value", F.lit(0.0)).alias("value")
    ).withColumn("passed", F.col("value") >= F.col("threshold"))
    return checked.withColumn("deploy", F.every("passed").over(W.partitionBy()))


def compare_metrics(first: DataFrame, second: DataFrame) -> DataFrame:
    """Two versions' metrics side by side, with difference and percent change."""
    a = first.select("metric", F.col("value").alias("version_1"))
    b = second.select("metric", F.col("value").alias("version_2"))
    change = F.col("version_2") - F.col("version_1")
    return a.join(b, "metric", "full_outer").select(
        "metric", "version_1", "version_2", change.alias("difference"),
        F.try_divide(change * 100, F.col("version_1")).alias("percent_change"),
    )


def paired_t(pairs: DataFrame, first: str, second: str) -> DataFrame:
    """Paired t-test of two score columns: one row with n, mean, sd, t, p and significance."""
    d = F.col(first) - F.col(second)
    stats = pairs.agg(F.count(d).alias("n"), F.avg(d).alias("mean"), F.stddev_samp(d).alias("sd"))
    with_t = stats.withColumn("t", F.try_divide(F.col("mean"), F.col("sd") / F.sqrt(F.col("n").cast("double"))))
    with_p = with_t.withColumn("p_value", t_test_p("t", (F.col("n") - 1).cast("double")))
    return with_p.withColumn("significant", F.col("p_value") < SIGNIFICANT_BELOW)


def latest_version(runs: DataFrame, stage: str | None = None) -> DataFrame:
    """Newest version per model, of one stage or of any."""
    if stage is not None:
        runs = runs.filter(F.col("stage") == stage)
    newest = F.max_by(F.struct("version", "stage", "created_at"), F.struct("created_at", "version"))
    return runs.groupBy("model").agg(newest.alias("_r")).select("model", "_r.*")


def list_versions(runs: DataFrame, stage: str | None = None) -> DataFrame:
    """(model, version, stage, created_at) of every version, in the stage it was last moved
    to; those of one stage only, if given."""
    newest = F.max(F.struct("created_at", "stage")).alias("_r")
    listed = runs.groupBy("model", "version").agg(newest).select("model", "version", "_r.stage", "_r.created_at")
    return listed if stage is None else listed.filter(F.col("stage") == stage)
