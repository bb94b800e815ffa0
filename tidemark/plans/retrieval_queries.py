"""Vector search and recommendation lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.arrow import as_matrix
from tidemark.operators import recommend, retrieval
from tidemark.operators.served import ServedLists
from tidemark.plans.check_tables import add_table
from tidemark.plans.feature_queries import rounded
from tidemark.plans.registry import query
from tidemark.plans.tables import AS_OF, Tables
from tidemark.plans.training_queries import vector_tables, viewed_pairs
from tidemark.session import scratch_path

K = 10


def sized_vectors(t: Tables) -> tuple[DataFrame, DataFrame]:
    users, items = vector_tables(t)
    return retrieval.split_by_dimension(users, "vector", 64)[0], retrieval.split_by_dimension(items, "vector", 64)[0]


def _nearest_sql(users: str, k: int) -> str:
    return f"""
    SELECT user_id, movie_id, distance, rank FROM (
      SELECT user_id, movie_id, distance, row_number() OVER (PARTITION BY user_id ORDER BY distance, movie_id)::INTEGER AS rank
      FROM (SELECT u.user_id, e.vec_id AS movie_id, list_distance(u.vector, e.embedding::DOUBLE[]) AS distance
            FROM {users} u, embeddings e)) WHERE rank <= {k}"""


add_table("vector_users", "SELECT vec_id AS user_id, embedding::DOUBLE[] AS vector FROM embeddings")


@query("knn_l2", f"SELECT user_id, movie_id, rank, round(distance, 6) AS distance FROM ({_nearest_sql('vector_users', K)})")
def knn_l2(t: Tables) -> DataFrame:
    return rounded(retrieval.top_k_exact(*sized_vectors(t), K))


@query("knn_l2_cells", f"SELECT user_id, movie_id, rank, round(distance, 6) AS distance FROM ({_nearest_sql('vector_users', K)})")
def knn_l2_cells(t: Tables) -> DataFrame:
    """The exact search again, with blocks so small that cells and bounds decide."""
    return rounded(retrieval.top_k_exact(*sized_vectors(t), K, probes=2, block_items=32))


CENTRES = 32


@query("knn_ivf", f"""
    WITH centres AS (SELECT vec_id AS cell, embedding::DOUBLE[] AS c FROM embeddings WHERE vec_id < {CENTRES}),
    placed AS (
      SELECT vec_id AS movie_id, any_value(embedding::DOUBLE[]) AS v,
        arg_min(cell, (list_distance(embedding::DOUBLE[], c), cell)) AS cell
      FROM embeddings, centres GROUP BY vec_id),
    probed AS (
      SELECT user_id, vector, cell FROM vector_users, centres
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY list_distance(vector, c), cell) <= 10)
    SELECT user_id, movie_id, round(distance, 6) AS distance, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY distance, movie_id)::INTEGER AS rank
      FROM (SELECT user_id, movie_id, list_distance(vector, v) AS distance FROM probed JOIN placed USING (cell)))
    WHERE rank <= {K}""")
def knn_ivf(t: Tables) -> DataFrame:
    """Cells around given centres, so that the choice of cells can be checked too."""
    users, items = sized_vectors(t)
    given = items.filter(F.col("movie_id") < CENTRES).orderBy("movie_id").select("vector").toArrow()
    return rounded(retrieval.top_k_by_cells(users, items, K, retrieval.PROBES, as_matrix(given.column("vector"))))


@query("knn_ivf_fitted")
def knn_ivf_fitted(t: Tables) -> DataFrame:
    """Fitted cells and tuned probes: each user's list, with the recall over all users."""
    users, items = sized_vectors(t)
    found = retrieval.top_k_by_cells(users, items, K)
    recall = retrieval.recall_of(found, retrieval.top_k_exact(users, items, K)).select(F.round("recall", 6).alias("recall"))
    return rounded(found).crossJoin(F.broadcast(recall))  # one row


@query("knn_lsh")
def knn_lsh(t: Tables) -> DataFrame:
    return rounded(retrieval.top_k_by_hash(*sized_vectors(t), K))


@query("cosine_sim", """
    SELECT user_id, movie_id, round(list_dot_product(a, b) / (sqrt(list_dot_product(a, a)) * sqrt(list_dot_product(b, b))
      + 1e-8::DOUBLE), 6) AS similarity
    FROM (SELECT user_id, movie_id, u.embedding::DOUBLE[] AS a, i.embedding::DOUBLE[] AS b
          FROM (SELECT DISTINCT user_id, movie_id FROM interactions WHERE event_type = 'view') p
          JOIN embeddings u ON u.vec_id = user_id JOIN embeddings i ON i.vec_id = movie_id)""")
def cosine_sim(t: Tables) -> DataFrame:
    return rounded(recommend.cosine_pairs(viewed_pairs(t), *vector_tables(t)))


@query("mmr_rerank", f"""
    SELECT * FROM (WITH RECURSIVE pool AS (
      SELECT user_id, movie_id, rank, v, list_dot_product(v, u) / (sqrt(list_dot_product(v, v)) * sqrt(list_dot_product(u, u)) + 1e-8::DOUBLE) AS rel
      FROM ({_nearest_sql('vector_users', 5 * K)}) JOIN (SELECT vec_id AS movie_id, embedding::DOUBLE[] AS v FROM embeddings) USING (movie_id)
        JOIN (SELECT user_id, vector AS u FROM vector_users) USING (user_id) WHERE movie_id <> user_id),
    steps AS (
      SELECT user_id, movie_id, rank, v, rel, NULL::DOUBLE AS closest, rel AS score, 1 AS position,
        row_number() OVER (PARTITION BY user_id ORDER BY rel DESC, rank) = 1 AS picked FROM pool
      UNION ALL
      SELECT user_id, movie_id, rank, v, rel, closest, score, position,
        row_number() OVER (PARTITION BY user_id ORDER BY score DESC, rank) = 1 AS picked
      FROM (
        SELECT *, 0.5::DOUBLE * rel - 0.5::DOUBLE * closest AS score FROM (
          SELECT s.user_id, s.movie_id, s.rank, s.v, s.rel, s.position + 1 AS position,
            greatest(s.closest, list_dot_product(s.v, p.v) / (sqrt(list_dot_product(s.v, s.v)) * sqrt(list_dot_product(p.v, p.v)) + 1e-8::DOUBLE)) AS closest
          FROM steps s JOIN steps p ON p.user_id = s.user_id AND p.position = s.position AND p.picked
          WHERE NOT s.picked AND s.position < {K})))
    SELECT user_id, movie_id, position::INTEGER AS position, round(score, 6) AS mmr FROM steps WHERE picked)""")
def mmr_rerank(t: Tables) -> DataFrame:
    """Every user's pool without the item of the same vector, which all others would tie behind."""
    users, items = sized_vectors(t)
    pool = retrieval.top_k_exact(users, items, 5 * K).filter("movie_id <> user_id")
    return rounded(retrieval.mmr_rerank(pool, users, items, K))


@query("vector_misfits", """
    SELECT 'user' AS side, vec_id AS id, 63::INTEGER AS dimension FROM embeddings WHERE vec_id % 7 = 3
    UNION ALL SELECT 'user', vec_id, -1::INTEGER FROM embeddings WHERE vec_id % 7 = 5
    UNION ALL SELECT 'item', vec_id, 65::INTEGER FROM embeddings WHERE vec_id % 11 = 4""")
def vector_misfits(t: Tables) -> DataFrame:
    """Vectors a search leaves out, with the dimension they have; -1 where there is none."""
    users, items = vector_tables(t)
    vector, odd = F.col("vector"), F.col("user_id") % 7
    users = users.withColumn("vector", F.when(odd == 3, F.slice(vector, 1, 63)).when(odd != 5, vector))
    items = items.withColumn("vector", F.when(F.col("movie_id") % 11 == 4, F.array_append(vector, F.lit(0.0).cast("float"))).otherwise(vector))
    sides = ((users, "user_id", "user"), (items, "movie_id", "item"))
    parts = [retrieval.split_by_dimension(df, "vector", 64)[1].select(
        F.lit(side).alias("side"), F.col(key).alias("id"), F.coalesce(F.size("vector"), F.lit(-1)).alias("dimension")) for df, key, side in sides]
    return parts[0].unionByName(parts[1])


@query("vector_stats", """
    SELECT count(*) AS vectors, max(len(embedding))::INTEGER AS dimension,
      greatest(1, floor(sqrt(count(*))))::INTEGER AS cells, 10::INTEGER AS probes FROM embeddings""")
def vector_stats(t: Tables) -> DataFrame:
    return retrieval.vector_stats(vector_tables(t)[1])


@query("vectors_roundtrip", """
    SELECT vec_id AS movie_id, len(embedding)::INTEGER AS dimension, round(list_sum(embedding::DOUBLE[]), 6) AS total,
      true AS in_cell FROM embeddings""")
def vectors_roundtrip(t: Tables) -> DataFrame:
    """Save vectors with their 150 cells, load them again, and place each by the loaded centres."""
    path = scratch_path(t.spark, "vectors")
    items = vector_tables(t)[1]
    retrieval.save_vectors(items, retrieval.pick_centres(items, 150), path)
    loaded, centres = retrieval.load_vectors(t.spark, path)
    placed = retrieval.assign_cells(loaded.withColumnRenamed("cell", "saved_cell"), centres)
    total = F.aggregate(F.col("vector").cast("array<double>"), F.lit(0.0), lambda a, x: a + x)
    return rounded(placed.select("movie_id", F.size("vector").alias("dimension"), total.alias("total"),
                                 (F.col("cell") == F.col("saved_cell")).alias("in_cell")))


# ---------------------------------------------------------------- user vectors and lists

add_table("user_vectors", """
    SELECT c_custkey AS user_id, CASE WHEN label < 5 THEN list_transform(list_zip(embedding, list_reverse(embedding)),
      lambda z: (z[1]::DOUBLE + z[2]::DOUBLE) / 2) ELSE embedding::DOUBLE[] END AS vector
    FROM customer JOIN embeddings ON vec_id = c_custkey""")


def user_vectors(t: Tables) -> DataFrame:
    """Vectors with a low label stand for model vectors, the others for stored ones."""
    rows = t.raw("embeddings")
    model = rows.filter("label < 5").select(F.col("vec_id").alias("user_id"), F.col("embedding").alias("mlp"),
                                            F.reverse("embedding").alias("gmf"))
    stored = rows.filter("label >= 5").select(F.col("vec_id").alias("user_id"), "embedding")
    return recommend.user_vectors(t.users, model, stored)


@query("user_vector", """
    SELECT user_id, len(vector)::INTEGER AS dimension, round(vector[1], 6) AS first_value,
      round(list_sum(vector), 6) AS total FROM user_vectors""")
def user_vector(t: Tables) -> DataFrame:
    total = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x)
    return rounded(user_vectors(t).select("user_id", F.size("vector").alias("dimension"),
                                          F.element_at("vector", 1).alias("first_value"), total.alias("total")))


_TWO_STAGE_SQL = f"""
    SELECT user_id, movie_id, round(score, 6) AS score, rank FROM (
      SELECT n.user_id, n.movie_id, s.score,
        row_number() OVER (PARTITION BY n.user_id ORDER BY s.score DESC, n.movie_id)::INTEGER AS rank
      FROM ({_nearest_sql('user_vectors', 100)}) n JOIN (
        SELECT u.user_id, e.vec_id AS movie_id, 1 / (1 + exp(-list_dot_product(u.vector, e.embedding::DOUBLE[]))) AS score
        FROM user_vectors u, embeddings e) s ON s.user_id = n.user_id AND s.movie_id = n.movie_id) WHERE rank <= 10"""


@query("two_stage_recs", _TWO_STAGE_SQL)
def two_stage_recs(t: Tables) -> DataFrame:
    return rounded(recommend.two_stage(user_vectors(t), vector_tables(t)[1]))


_POPULAR_SQL = """SELECT movie_id, count(*) AS views FROM interactions WHERE event_type = 'view'
    GROUP BY movie_id ORDER BY views DESC, movie_id LIMIT 10"""
_TRENDING_SQL = f"""
    SELECT movie_id, recent_views, round(CASE WHEN earlier = 0 THEN CASE WHEN recent_views > 0 THEN 1.0 ELSE 0.0 END
      ELSE (recent_views - earlier)::DOUBLE / earlier END, 6)::DOUBLE AS trend
    FROM (SELECT movie_id, count(*) FILTER ("timestamp" > TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY) AS recent_views,
        count(*) FILTER ("timestamp" <= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY) AS earlier
      FROM interactions WHERE event_type = 'view' AND "timestamp" <= TIMESTAMP '{AS_OF}'
        AND "timestamp" > TIMESTAMP '{AS_OF}' - INTERVAL 14 DAY GROUP BY movie_id)
    ORDER BY trend DESC, recent_views DESC, movie_id LIMIT 10"""


@query("popular_items", _POPULAR_SQL)
def popular_items(t: Tables) -> DataFrame:
    return recommend.popular_items(t.interactions)


@query("trending_items", _TRENDING_SQL)
def trending_items(t: Tables) -> DataFrame:
    return rounded(recommend.trending_items(t.interactions, AS_OF))


@query("popular_by_region", """
    SELECT region, movie_id, views, rank FROM (
      SELECT region, movie_id, count(*) AS views,
        row_number() OVER (PARTITION BY region ORDER BY count(*) DESC, movie_id)::INTEGER AS rank
      FROM interactions JOIN users USING (user_id) WHERE event_type = 'view' GROUP BY region, movie_id) WHERE rank <= 10""")
def popular_by_region(t: Tables) -> DataFrame:
    return recommend.popular_by_region(t.interactions, t.users)


def _lists(t: Tables) -> tuple[DataFrame, DataFrame]:
    trending = recommend.ranked_list(recommend.trending_items(t.interactions, AS_OF), F.desc("trend"), F.desc("recent_views"),
                                     F.col("movie_id"))
    popular = recommend.ranked_list(recommend.popular_items(t.interactions), F.desc("views"), F.col("movie_id"))
    return trending.select("rank", "movie_id"), popular.select("rank", "movie_id")


_FALLBACK_SQL = f"""
    SELECT u.user_id, f.movie_id, 0.7::DOUBLE AS score, f.rank, 'trending' AS source
    FROM users u, (SELECT movie_id, row_number() OVER (ORDER BY trend DESC, recent_views DESC, movie_id)::INTEGER AS rank
                   FROM ({_TRENDING_SQL})) f
    WHERE u.user_id NOT IN (SELECT user_id FROM {{served}})"""


@query("fallback_recs", _FALLBACK_SQL.format(served="interactions"))
def fallback_recs(t: Tables) -> DataFrame:
    """Users without any event get the fallback list."""
    return recommend.fallback(t.users, t.interactions, *_lists(t))


@query("batch_recs", f"""SELECT user_id, movie_id, score, rank, 'personal' AS source FROM ({_TWO_STAGE_SQL})
    UNION ALL {_FALLBACK_SQL.format(served="user_vectors")}""")
def batch_recs(t: Tables) -> DataFrame:
    personal = recommend.two_stage(user_vectors(t), vector_tables(t)[1])
    return rounded(recommend.batch_recommendations(t.users, personal, *_lists(t)))


@query("fresh_recs", """
    SELECT user_id, k, arg_max(movie_id, generated_at) AS movie_id, max(generated_at) AS generated_at
    FROM (SELECT user_id, CASE WHEN event_id % 2 = 0 THEN 10 ELSE 20 END::INTEGER AS k, movie_id, "timestamp" AS generated_at
          FROM interactions WHERE event_type = 'view')
    WHERE generated_at <= TIMESTAMP '2024-01-20' AND generated_at > TIMESTAMP '2024-01-19'
      AND user_id NOT IN (SELECT user_id FROM interactions WHERE event_type = 'rating' AND "timestamp" >= TIMESTAMP '2024-01-29')
    GROUP BY user_id, k""")
def fresh_recs(t: Tables) -> DataFrame:
    """Views stand for served lists, written in two rounds; users who rated lately have theirs dropped."""
    lists = t.interactions.filter("event_type = 'view'").select(
        "user_id", F.when(F.col("event_id") % 2 == 0, 10).otherwise(20).alias("k"), "movie_id",
        F.col("timestamp").alias("generated_at"))
    at = lambda when: F.lit(when).cast("timestamp_ntz")
    changed = t.interactions.filter("event_type = 'rating'").filter(F.col("timestamp") >= at("2024-01-29 00:00:00"))
    table = ServedLists(t.spark, scratch_path(t.spark, "served"))
    noon, now = at("2024-01-19 12:00:00"), at("2024-01-20 00:00:00")
    table.put(lists.filter(F.col("generated_at") <= noon))
    table.put(lists.filter((F.col("generated_at") > noon) & (F.col("generated_at") <= now)))
    table.drop(changed)
    return table.fresh("2024-01-20 00:00:00", 86400)
