"""Recommendation lists: vectors per user, two-stage ranking, popular items and fallbacks."""

from __future__ import annotations

from datetime import datetime

import numpy as np
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.functions.columns import cosine, dot, instant, ratio, sigmoid
from tidemark.functions.ordering import top_n
from tidemark.operators.features import VIEW
from tidemark.operators.models import EMBEDDING_DIM
from tidemark.operators.retrieval import top_k_exact
from tidemark.session import stage

# Candidates per user, list length, fallback scores, seconds a list stays fresh.
CANDIDATES = 100
LIST_LENGTH = 10
TRENDING_SCORE, POPULAR_SCORE = 0.7, 0.6
LIST_FRESH_SECONDS = 300


# ---------------------------------------------------------------- vectors


def user_vectors(users: DataFrame, model: DataFrame, stored: DataFrame, dim: int = EMBEDDING_DIM) -> DataFrame:
    """Vector per user: mean of the model's two vectors, else the stored one if it
    has ``dim`` entries. Users with neither are left out; they take a fallback list.
    """
    mean = F.zip_with("mlp", "gmf", lambda a, b: (a.cast("double") + b.cast("double")) / 2)
    fits = F.when(F.size("embedding") == dim, F.col("embedding").cast("array<double>"))
    joined = users.select("user_id").distinct().join(model, "user_id", "left").join(stored, "user_id", "left")
    return joined.select("user_id", F.coalesce(mean, fits).alias("vector")).filter(F.col("vector").isNotNull())


def cosine_pairs(pairs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Cosine similarity of each pair's vectors."""
    u = users.select("user_id", F.col("vector").alias("_u"))
    i = items.select("movie_id", F.col("vector").alias("_i"))
    joined = pairs.join(u, "user_id").join(i, "movie_id")
    return joined.withColumn("similarity", cosine(F.col("_u"), F.col("_i"))).drop("_u", "_i")


# ---------------------------------------------------------------- ranking


def rank_candidates(candidates: DataFrame, users: DataFrame, items: DataFrame, k: int = LIST_LENGTH) -> DataFrame:
    """Score candidates by their vectors and keep the best k per user.

    A user has at most as many candidates as the search kept.
    """
    u = users.select("user_id", F.col("vector").alias("_u"))
    i = items.select("movie_id", F.col("vector").alias("_i"))
    scored = candidates.select("user_id", "movie_id").join(u, "user_id").join(i, "movie_id").select(
        "user_id", "movie_id", sigmoid(dot(F.col("_u"), F.col("_i"))).alias("score"))
    return best_by_score(scored, k)


def best_by_score(scored: DataFrame, k: int) -> DataFrame:
    order = F.row_number().over(W.partitionBy("user_id").orderBy(F.desc("score"), "movie_id"))
    return scored.withColumn("rank", order).filter(F.col("rank") <= k)


def two_stage(
    users: DataFrame, items: DataFrame, k: int = LIST_LENGTH, candidates: int = CANDIDATES, centres: np.ndarray | None = None
) -> DataFrame:
    """Nearest ``candidates`` items per user, scored by the product the search has made, best k:
    (user_id, movie_id, score, rank)."""
    found = top_k_exact(users, items, candidates, centres=centres, with_product=True)
    return best_by_score(found.select("user_id", "movie_id", sigmoid(F.col("product")).alias("score")), k)


# ---------------------------------------------------------------- popular lists


def popular_items(interactions: DataFrame, n: int = LIST_LENGTH) -> DataFrame:
    """The n most viewed items."""
    views = interactions.filter((F.col("event_type") == VIEW) & F.col("movie_id").isNotNull())
    counts = views.groupBy("movie_id").agg(F.count("*").alias("views"))
    return counts.orderBy(F.desc("views"), "movie_id").limit(n)


def trending_items(interactions: DataFrame, when: str | datetime, n: int = LIST_LENGTH, days: int = 7) -> DataFrame:
    """The n items whose views grew most over the last ``days`` against the ``days`` before."""
    at = instant(interactions, "timestamp", when)
    week = F.make_dt_interval(days=F.lit(days))
    inside = interactions.filter(
        (F.col("event_type") == VIEW) & (F.col("timestamp") <= at) & (F.col("timestamp") > at - week - week))
    recent = F.count_if(F.col("timestamp") > at - week)
    counts = inside.groupBy("movie_id").agg(recent.alias("recent_views"), (F.count("*") - recent).alias("earlier_views"))
    growth = F.when(F.col("earlier_views") == 0, F.when(F.col("recent_views") > 0, 1.0).otherwise(0.0)).otherwise(
        ratio(F.col("recent_views") - F.col("earlier_views"), F.col("earlier_views")))
    trended = counts.select("movie_id", "recent_views", growth.alias("trend"))
    return trended.orderBy(F.desc("trend"), F.desc("recent_views"), "movie_id").limit(n)


def popular_by_region(interactions: DataFrame, users: DataFrame, n: int = LIST_LENGTH) -> DataFrame:
    """The n most viewed items of each region.

    Views are counted per (user, movie) before the user join, so a very active
    user is one row per item there.
    """
    views = interactions.filter((F.col("event_type") == VIEW) & F.col("movie_id").isNotNull())
    per_pair = views.groupBy("user_id", "movie_id").agg(F.count("*").alias("views"))
    counts = per_pair.join(users.select("user_id", "region"), "user_id").groupBy("region", "movie_id").agg(
        F.sum("views").alias("views"))
    return top_n(counts, ["region"], [F.desc("views"), F.asc("movie_id")], n)


# ---------------------------------------------------------------- fallbacks


def _as_list(items: DataFrame, order: str, source: str, score: float) -> Column:
    """A short ranked table as one array value, read once as a scalar subquery."""
    entry = F.struct(F.col(order).alias("rank"), F.col("movie_id"), F.lit(score).alias("score"), F.lit(source).alias("source"))
    return items.agg(F.sort_array(F.collect_list(entry))).scalar()


def fallback(
    users: DataFrame, recommended: DataFrame, trending: DataFrame, popular: DataFrame, k: int = LIST_LENGTH
) -> DataFrame:
    """The fallback list for every user without recommendations.

    ``trending`` and ``popular`` are ranked lists (rank, movie_id); at most k rows
    of each are used: trending if there are any, else popular, else nothing.
    """
    cold = users.select("user_id").distinct().join(recommended.select("user_id").distinct(), "user_id", "left_anti")
    first = _as_list(trending.filter(F.col("rank") <= k), "rank", "trending", TRENDING_SCORE)
    second = _as_list(popular.filter(F.col("rank") <= k), "rank", "popular", POPULAR_SCORE)
    chosen = F.when(F.size(first) > 0, first).otherwise(second)
    return cold.select("user_id", F.explode(chosen).alias("_f")).select(
        "user_id", "_f.movie_id", "_f.score", "_f.rank", "_f.source")


def ranked_list(items: DataFrame, *order: Column) -> DataFrame:
    """Number a short list by ``order``."""
    return items.withColumn("rank", F.row_number().over(W.orderBy(*order)))


def batch_recommendations(users: DataFrame, personal: DataFrame, trending: DataFrame, popular: DataFrame, k: int = LIST_LENGTH) -> DataFrame:
    """Personal lists where there are any, the fallback list for all other users.

    The personal lists are written down: they are read twice, and a search is not run again.
    """
    personal = stage(personal.select("user_id", "movie_id", "score", "rank"), "personal")
    mine = personal.select("user_id", "movie_id", "score", "rank", F.lit("personal").alias("source"))
    return mine.unionByName(fallback(users, personal, trending, popular, k))


# ---------------------------------------------------------------- served table


def fresh_lists(served: DataFrame, now: str | datetime, seconds: int = LIST_FRESH_SECONDS) -> DataFrame:
    """The newest list per (user, k), if it was generated within ``seconds`` of ``now``."""
    at = instant(served, "generated_at", now)
    recent = served.filter((F.col("generated_at") <= at) & (F.col("generated_at") > at - F.make_dt_interval(secs=F.lit(seconds))))
    others = [c for c in served.columns if c not in ("user_id", "k")]
    newest = recent.groupBy("user_id", "k").agg(F.max_by(F.struct(*others), "generated_at").alias("_r"))
    return newest.select("user_id", "k", "_r.*")


def drop_users(served: DataFrame, users: DataFrame) -> DataFrame:
    """Served lists without those of the given users."""
    return served.join(users.select("user_id"), "user_id", "left_anti")
