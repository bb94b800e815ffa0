"""Collaborative filtering on implicit positives, and scoring of user-item pairs."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, functions as F

from tidemark.functions.arrow import as_matrix
from tidemark.functions.columns import dot, sigmoid

# Width of the user and item vectors and of the hidden layers.
EMBEDDING_DIM = 64
HIDDEN_LAYERS = (128, 64, 32)
BATCH_NORM_EPSILON = 1e-5


def fit_als(pairs: DataFrame, rank: int = EMBEDDING_DIM, iterations: int = 10, reg: float = 0.01, seed: int = 42, alpha: float = 1.0) -> ALSModel:
    """Implicit ALS on (user, item, weight), with integer user and item indexes."""
    als = ALS(
        userCol="user", itemCol="item", ratingCol="weight", rank=rank, maxIter=iterations, regParam=reg,
        implicitPrefs=True, alpha=alpha, seed=seed, coldStartStrategy="drop",
    )
    return als.fit(pairs)


def als_vectors(model: ALSModel) -> tuple[DataFrame, DataFrame]:
    """(users, items) as (id, vector) tables."""
    users = model.userFactors.select(F.col("id").alias("user_id"), F.col("features").alias("vector"))
    items = model.itemFactors.select(F.col("id").alias("movie_id"), F.col("features").alias("vector"))
    return users, items


def factor_score(pairs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Sigmoid of the dot product of the pair's vectors; pairs lacking one are left out."""
    u = users.select("user_id", F.col("vector").alias("_u"))
    i = items.select("movie_id", F.col("vector").alias("_i"))
    joined = pairs.join(u, "user_id").join(i, "movie_id")
    return joined.withColumn("score", sigmoid(dot(F.col("_u"), F.col("_i")))).drop("_u", "_i")


@dataclass
class NcfWeights:
    """Layers of the fused model; sizes are set by the model, not by the data.

    ``hidden`` holds per layer (matrix in x out, bias) and, where batch norm is on,
    (scale, shift, running mean, running variance).
    """

    hidden: list[dict[str, np.ndarray]]
    out: np.ndarray
    out_bias: float = 0.0


def ncf_forward(w: NcfWeights, gmf_u: np.ndarray, gmf_i: np.ndarray, mlp_u: np.ndarray, mlp_i: np.ndarray) -> np.ndarray:
    """Scores of a batch: the element-wise path beside the layered path, then a sigmoid."""
    h = np.hstack((mlp_u, mlp_i))
    for layer in w.hidden:
        h = h @ layer["matrix"] + layer["bias"]
        if "mean" in layer:
            h = (h - layer["mean"]) / np.sqrt(layer["variance"] + BATCH_NORM_EPSILON) * layer["scale"] + layer["shift"]
        h = np.maximum(h, 0.0)
    logits = np.hstack((gmf_u * gmf_i, h)) @ w.out + w.out_bias
    return 1.0 / (1.0 + np.exp(-logits))


def ncf_score(pairs: DataFrame, users: DataFrame, items: DataFrame, weights: NcfWeights) -> DataFrame:
    """Score (user_id, movie_id) pairs with vectors from tables with ``gmf`` and ``mlp`` columns.

    The vectors come by join, so they scale with the tables; only the layer
    weights travel with the task.
    """
    u = users.select("user_id", F.col("gmf").alias("gmf_u"), F.col("mlp").alias("mlp_u"))
    i = items.select("movie_id", F.col("gmf").alias("gmf_i"), F.col("mlp").alias("mlp_i"))
    shared = pairs.sparkSession.sparkContext.broadcast(weights)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vectors = [as_matrix(b.column(c)) for c in ("gmf_u", "gmf_i", "mlp_u", "mlp_i")]
            scores = pa.array(ncf_forward(shared.value, *vectors)) if b.num_rows else pa.array([], pa.float64())
            yield pa.RecordBatch.from_arrays([b.column("user_id"), b.column("movie_id"), scores], ["user_id", "movie_id", "score"])

    joined = pairs.select("user_id", "movie_id").join(u, "user_id").join(i, "movie_id")
    return joined.mapInArrow(score, "user_id bigint, movie_id bigint, score double")
