"""Training sets, model scores and metrics."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tidemark.operators import evaluate, models, selection, training
from tidemark.operators.validate import with_label
from tidemark.plans.check_tables import add_table
from tidemark.plans.feature_queries import rounded
from tidemark.plans.registry import query
from tidemark.plans.tables import Tables

SPLIT = "2024-01-24 00:00:00"

# ---------------------------------------------------------------- splits


@query("split_date", """
    SELECT max("timestamp")::DATE - floor((date_diff('second', min("timestamp"), max("timestamp")) // 86400) * 0.2)::INTEGER
      AS split_date FROM interactions""")
def split_date(t: Tables) -> DataFrame:
    return training.split_date(t.interactions)


@query("temporal_split", f"""
    SELECT CASE WHEN "timestamp" > TIMESTAMP '{SPLIT}' THEN 'test' ELSE 'train_val' END AS part, event_type,
      count(*) AS events, min("timestamp") AS first_at, max("timestamp") AS last_at FROM interactions GROUP BY 1, 2""")
def temporal_split(t: Tables) -> DataFrame:
    kept, test = training.temporal_split(t.interactions, SPLIT)
    both = kept.withColumn("part", F.lit("train_val")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part", "event_type").agg(
        F.count("*").alias("events"), F.min("timestamp").alias("first_at"), F.max("timestamp").alias("last_at"))


@query("train_val_split", f"""
    SELECT event_id, CASE WHEN row_number() OVER (ORDER BY "timestamp", event_id)
        <= floor(count(*) OVER () * 0.8) THEN 'train' ELSE 'val' END AS part
    FROM interactions WHERE "timestamp" <= TIMESTAMP '{SPLIT}'""")
def train_val_split(t: Tables) -> DataFrame:
    kept, _ = training.temporal_split(t.interactions, SPLIT)
    return training.train_val_split(kept).select("event_id", "part")


@query("dims", "SELECT count(DISTINCT user_id) AS num_users, count(DISTINCT movie_id) AS num_items FROM interactions")
def dims(t: Tables) -> DataFrame:
    return training.dims(t.interactions)


@query("id_index", """
    SELECT 'user' AS kind, user_id AS id, row_number() OVER (ORDER BY user_id) - 1 AS index
    FROM (SELECT DISTINCT user_id FROM interactions)
    UNION ALL SELECT 'item', movie_id, row_number() OVER (ORDER BY movie_id) - 1
    FROM (SELECT DISTINCT movie_id FROM interactions WHERE movie_id IS NOT NULL)""")
def id_index(t: Tables) -> DataFrame:
    users = training.id_index(t.interactions, "user_id").select(F.lit("user").alias("kind"), "id", "index")
    items = training.id_index(t.interactions, "movie_id").select(F.lit("item").alias("kind"), "id", "index")
    return users.unionByName(items)


# ---------------------------------------------------------------- positives and negatives


def labelled(t: Tables) -> DataFrame:
    rows = t.interactions.select("event_id", "user_id", F.col("movie_id").alias("item_id"), "event_type")
    return with_label(rows)


def positive_rows(t: Tables) -> DataFrame:
    return labelled(t).filter("label = 1").select("event_id", "user_id", "item_id")


@query("positives", "SELECT DISTINCT user_id, movie_id AS item_id FROM interactions WHERE event_type = 'view'")
def positives(t: Tables) -> DataFrame:
    return training.positives(labelled(t))


def _negatives_sql(seed: str) -> str:
    return f"""
    SELECT d.event_id, d.user_id, d.slot::INTEGER AS slot, n.item_id, 0::INTEGER AS label
    FROM (SELECT p.event_id, p.user_id, slot,
            ('0x' || substr(md5('{seed}|' || p.event_id || '|' || slot), 1, 15))::BIGINT % c.n AS r
          FROM (SELECT event_id, user_id FROM interactions WHERE event_type = 'view') p
          JOIN (SELECT user_id, count(*) AS n FROM unseen_items GROUP BY user_id) c USING (user_id),
          range(1, 5) s(slot)) d
    JOIN unseen_items n ON n.user_id = d.user_id AND n.r = d.r"""


add_table("unseen_items", """
    SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY item_id) - 1 AS r
    FROM (SELECT DISTINCT user_id FROM interactions WHERE event_type = 'view'),
      (SELECT DISTINCT movie_id AS item_id FROM interactions WHERE movie_id IS NOT NULL)
    WHERE (user_id, item_id) NOT IN (SELECT (user_id, movie_id) FROM interactions WHERE event_type = 'view')""")


@query("negative_samples", _negatives_sql("train"))
def negative_samples(t: Tables) -> DataFrame:
    return training.negative_samples(positive_rows(t), training.id_index(t.interactions, "movie_id"))


@query("eval_set", f"""
    SELECT event_id, user_id, 0::INTEGER AS slot, movie_id AS item_id, 1::INTEGER AS label
    FROM interactions WHERE event_type = 'view'
    UNION ALL {_negatives_sql("eval")}""")
def eval_set(t: Tables) -> DataFrame:
    return training.eval_set(positive_rows(t), training.id_index(t.interactions, "movie_id"))


# ---------------------------------------------------------------- scores


def vector_tables(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Every vector once as a user and once as an item."""
    rows = t.vectors
    return (rows.select(F.col("vec_id").alias("user_id"), F.col("embedding").alias("vector")),
            rows.select(F.col("vec_id").alias("movie_id"), F.col("embedding").alias("vector")))


def viewed_pairs(t: Tables) -> DataFrame:
    return t.interactions.filter("event_type = 'view'").select("user_id", "movie_id").distinct()


@query("als_scores")
def als_scores(t: Tables) -> DataFrame:
    """Implicit ALS on view counts, scored on every viewed pair."""
    counts = t.interactions.filter("event_type = 'view'").groupBy("user_id", "movie_id").agg(
        F.count("*").cast("float").alias("weight"))
    users, items = training.id_index(t.interactions, "user_id"), training.id_index(t.interactions, "movie_id")
    indexed = training.with_index(training.with_index(counts, users, "user_id", "user"), items, "movie_id", "item")
    pairs = indexed.select("user_id", "movie_id", F.col("user").cast("int"), F.col("item").cast("int"), "weight")
    model = models.fit_als(pairs, rank=16, iterations=5)
    return model.transform(pairs).select("user_id", "movie_id", F.col("prediction").alias("score"))


def fixed_weights(dim: int = models.EMBEDDING_DIM) -> models.NcfWeights:
    """Layer weights of the full model size, given by a rule so that SQL can repeat them."""
    hidden, size = [], 2 * dim
    for width in models.HIDDEN_LAYERS:
        i, j = np.arange(size)[:, None], np.arange(width)
        hidden.append({
            "matrix": np.sin(7.0 * i + 3.0 * j) * np.sqrt(2.0 / size), "bias": np.cos(1.0 * j) * 0.1, "scale": 1.0 + 0.0 * j,
            "shift": 0.05 * np.sin(1.0 * j), "mean": 0.01 * j / width, "variance": 1.0 + 0.5 * j / width})
        size = width
    return models.NcfWeights(hidden, 0.3 * np.cos(1.0 * np.arange(dim + size)), 0.1)


def _layer_sql(source: str, size: int, width: int) -> str:
    """(user_id, movie_id, g, h): the next layer's outputs from rows holding its inputs ``h``."""
    dense = f"list_dot_product(h, m) * sqrt(2.0::DOUBLE / {size}) + cos(j) * 0.1::DOUBLE"
    return f"""
      SELECT user_id, movie_id, any_value(g) AS g, list(greatest(0, ({dense} - 0.01::DOUBLE * j / {width})
        / sqrt(1.0::DOUBLE + 0.5::DOUBLE * j / {width} + 0.00001::DOUBLE) + 0.05::DOUBLE * sin(j))::DOUBLE ORDER BY j) AS h
      FROM ({source}), (SELECT j, list(sin(7 * i + 3 * j)::DOUBLE ORDER BY i) AS m
                        FROM range(0, {size}) a(i), range(0, {width}) b(j) GROUP BY j) GROUP BY 1, 2"""


def _ncf_sql() -> str:
    source = """
      SELECT user_id, movie_id, list_transform(list_zip(u.embedding, i.embedding), lambda z: z[1]::DOUBLE * z[2]::DOUBLE) AS g,
        list_concat(list_reverse(u.embedding), list_reverse(i.embedding))::DOUBLE[] AS h
      FROM (SELECT DISTINCT user_id, movie_id FROM interactions WHERE event_type = 'view') p
      JOIN embeddings u ON u.vec_id = user_id JOIN embeddings i ON i.vec_id = movie_id"""
    size = 2 * models.EMBEDDING_DIM
    for width in models.HIDDEN_LAYERS:
        source, size = _layer_sql(source, size, width), width
    total = models.EMBEDDING_DIM + size
    return f"""
      SELECT user_id, movie_id, round(1 / (1 + exp(-(list_dot_product(list_concat(g, h), w) + 0.1::DOUBLE))), 6) AS score
      FROM ({source}), (SELECT list((0.3::DOUBLE * cos(i))::DOUBLE ORDER BY i) AS w FROM range(0, {total}) r(i))"""


@query("ncf_score", _ncf_sql())
def ncf_score(t: Tables) -> DataFrame:
    vectors = t.vectors.select("vec_id", F.col("embedding").alias("gmf"), F.reverse("embedding").alias("mlp"))
    return rounded(models.ncf_score(
        viewed_pairs(t), vectors.withColumnRenamed("vec_id", "user_id"), vectors.withColumnRenamed("vec_id", "movie_id"),
        fixed_weights()))


@query("factor_score", """
    SELECT user_id, movie_id, round(1 / (1 + exp(-list_dot_product(u.embedding::DOUBLE[], i.embedding::DOUBLE[]))), 6)
      AS score
    FROM (SELECT DISTINCT user_id, movie_id FROM interactions WHERE event_type = 'view') p
    JOIN embeddings u ON u.vec_id = user_id JOIN embeddings i ON i.vec_id = movie_id""")
def factor_score(t: Tables) -> DataFrame:
    return rounded(models.factor_score(viewed_pairs(t), *vector_tables(t)))


# ---------------------------------------------------------------- metrics

_LOG_LOSS_SQL = """
    SELECT round(avg(CASE WHEN score IS NOT NULL AND label IS NOT NULL THEN -(label * CASE WHEN score <= 0 THEN -100 ELSE greatest(ln(score), -100) END
      + (1 - label) * CASE WHEN score >= 1 THEN -100 ELSE greatest(ln(1 - score), -100) END) END), 6) AS log_loss
    FROM (SELECT label, CASE WHEN item_id % 11 <> 0 THEN score END AS score FROM predictions)"""


@query("log_loss", _LOG_LOSS_SQL)
def log_loss(t: Tables) -> DataFrame:
    """Every eleventh item has no score."""
    return rounded(evaluate.log_loss(t.predictions.withColumn("score", F.when(F.col("item_id") % 11 != 0, F.col("score")))))


_AUC_SQL = """
    SELECT round(coalesce(sum(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0.0 END)::DOUBLE
      / count(*), 0.5::DOUBLE), 6)::DOUBLE AS auc
    FROM (SELECT score FROM predictions WHERE label = 1) a, (SELECT score FROM predictions WHERE label = 0) b"""


@query("auc", _AUC_SQL)
def auc(t: Tables) -> DataFrame:
    return rounded(evaluate.auc(t.predictions))


_RANKED_SQL = "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rk FROM predictions"
_NDCG_SQL = f"""
    SELECT user_id, round(CASE WHEN ideal IS NULL THEN 0 ELSE dcg / ideal END, 6)::DOUBLE AS ndcg FROM (
      SELECT user_id, sum(label / log2(rk + 1)) FILTER (rk <= 10) AS dcg,
        (SELECT sum(1 / log2(i + 1)) FROM range(1, 11) g(i) WHERE i <= positives) AS ideal
      FROM ({_RANKED_SQL}) JOIN (SELECT user_id, sum(label) AS positives FROM predictions GROUP BY user_id) USING (user_id)
      GROUP BY user_id, positives)"""
_HIT_SQL = f"SELECT user_id, max(label)::INTEGER AS hit FROM ({_RANKED_SQL}) WHERE rk <= 10 GROUP BY user_id"


@query("ndcg_at_k", _NDCG_SQL)
def ndcg_at_k(t: Tables) -> DataFrame:
    return rounded(evaluate.ndcg_by_user(t.predictions))


@query("hit_rate_at_k", _HIT_SQL)
def hit_rate_at_k(t: Tables) -> DataFrame:
    return evaluate.hit_by_user(t.predictions)


_METRICS_SQL = f"""
    SELECT 'auc' AS metric, auc AS value FROM ({_AUC_SQL})
    UNION ALL SELECT 'ndcg_at_10', avg(ndcg) FROM ({_NDCG_SQL})
    UNION ALL SELECT 'hit_rate_at_10', avg(hit) FROM ({_HIT_SQL})"""


@query("deploy_gate", f"""
    SELECT metric, threshold, round(coalesce(value, 0), 5) AS value, coalesce(value, 0) >= threshold AS passed,
      bool_and(coalesce(value, 0) >= threshold) OVER () AS deploy
    FROM (VALUES ('auc', 0.75::DOUBLE), ('ndcg_at_10', 0.5::DOUBLE), ('hit_rate_at_10', 0.4::DOUBLE)) l(metric, threshold)
    LEFT JOIN ({_METRICS_SQL}) USING (metric)""")
def deploy_gate(t: Tables) -> DataFrame:
    return rounded(evaluate.deploy_gate(evaluate.evaluation(t.predictions)), 5)


@query("trial_patience", """
    WITH trials AS (SELECT substr(source, 4)::INTEGER AS trial, round(avg(n_chars), 6) AS auc FROM documents GROUP BY source),
    marked AS (SELECT *, row_number() OVER (ORDER BY trial) AS n,
      auc > coalesce(max(auc) OVER (ORDER BY trial ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS gained FROM trials),
    counted AS (SELECT *, n - max(CASE WHEN gained THEN n END) OVER (ORDER BY trial) AS since FROM marked),
    run AS (SELECT * FROM counted WHERE n <= coalesce((SELECT min(n) FROM counted WHERE since >= 3), n))
    SELECT arg_max(trial, auc) AS best_trial, max(auc) AS best_auc, count(*) AS trials_run FROM run""")
def trial_patience(t: Tables) -> DataFrame:
    """The stopping rule alone: trials stand for document sources, their metric for the mean length."""
    trials = t.raw("documents").groupBy(F.substring("source", 4, 10).cast("int").alias("trial")).agg(
        F.round(F.avg("n_chars"), 6).alias("auc"))
    return evaluate.best_trial(trials)


def indexed_pairs(rows: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """``rows`` (user_id, item_id, ...) with dense integer indexes in place of the ids."""
    with_user = training.with_index(rows, users, "user_id", "user")
    both = training.with_index(with_user, items, "item_id", "item")
    return both.withColumns({c: F.col(c).cast("int") for c in ("user", "item")}).drop("user_id", "item_id")


def trial_split(t: Tables) -> tuple[DataFrame, DataFrame]:
    """(train: view counts up to the split, held out: later views and sampled negatives)."""
    before, after = training.temporal_split(t.interactions, SPLIT)
    views = lambda rows: with_label(rows.select("event_id", "user_id", F.col("movie_id").alias("item_id"), "event_type")).filter("label = 1")
    users, items = training.id_index(t.interactions, "user_id"), training.id_index(t.interactions, "movie_id")
    counts = views(before).groupBy("user_id", "item_id").agg(F.count("*").cast("float").alias("weight"))
    held_out = training.eval_set(views(after).select("event_id", "user_id", "item_id"), items)
    return (indexed_pairs(counts, users, items),
            indexed_pairs(held_out.select("user_id", "item_id", "label"), users, items).select("user", "item", "label"))


@query("best_trial")
def best_trial(t: Tables) -> DataFrame:
    """Six ALS settings trained on the views before the split, with their AUC on the views
    after it and sampled negatives, beside that of plain popularity."""
    train, held_out = trial_split(t)
    chosen = selection.select_als(train, held_out, selection.grid((8, 16), (0.01, 0.1, 1.0), (10.0,)), iterations=5)
    return chosen.trials.withColumns({
        "popularity_auc": F.lit(selection.popularity_auc(train, chosen.held_out)),
        "chosen": F.col("trial") == chosen.winner.trial,
    })


@query("compare_metrics", """
    SELECT coalesce(a.lang, b.lang) AS metric, a.v AS version_1, b.v AS version_2, round(b.v - a.v, 6) AS difference,
      round(CASE WHEN a.v <> 0 THEN (b.v - a.v) * 100 / a.v END, 6) AS percent_change
    FROM (SELECT lang, round(avg(quality), 6) AS v FROM documents JOIN labels USING (doc_id) WHERE lang <> 'es' GROUP BY lang) a
    FULL JOIN (SELECT lang, round(avg(toxic), 6) AS v FROM documents JOIN labels USING (doc_id) WHERE lang <> 'fr' GROUP BY lang) b
    ON a.lang = b.lang""")
def compare_metrics(t: Tables) -> DataFrame:
    """Two metric tables by language, each lacking one language."""
    rows = t.raw("documents").select("doc_id", "lang").join(t.raw("labels"), "doc_id")

    def table(column: str, without: str) -> DataFrame:
        kept = rows.filter(F.col("lang") != without)
        return kept.groupBy(F.col("lang").alias("metric")).agg(F.round(F.avg(column), 6).alias("value"))

    return rounded(evaluate.compare_metrics(table("quality", "es"), table("toxic", "fr")))


# the p-value by Simpson's rule over the density of Student's t
@query("paired_t", """
    WITH stats AS (
      SELECT count(*) AS n, avg(d) AS mean, stddev_samp(d) AS sd, avg(d) / (stddev_samp(d) / sqrt(count(*))) AS t, count(*) - 1 AS v
      FROM (SELECT score - (0.3::DOUBLE + label * 0.28::DOUBLE) AS d FROM predictions)),
    steps AS (SELECT *, i, least(abs(t), 50.0) / 20000 AS h, i * h AS x FROM stats, range(0, 20001) r(i)),
    inside AS (
      SELECT sum(CASE WHEN i IN (0, 20000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * pow(1 + x * x / v, -(v + 1) / 2.0)) * any_value(h) / 3
        * exp(lgamma((any_value(v) + 1) / 2.0) - lgamma(any_value(v) / 2.0)) / sqrt(any_value(v) * pi()) AS half FROM steps)
    SELECT n, round(mean, 6) AS mean, round(sd, 6) AS sd, round(t, 5) AS t, abs(round(1 - 2 * half, 6)) AS p_value, 1 - 2 * half < 0.05 AS significant
    FROM stats, inside""")
def paired_t(t: Tables) -> DataFrame:
    """Two scorers of the same rows, close to each other."""
    pairs = t.predictions.withColumn("other", F.lit(0.3) + F.col("label") * F.lit(0.28))
    out = evaluate.paired_t(pairs, "score", "other")
    return out.select("n", F.round("mean", 6).alias("mean"), F.round("sd", 6).alias("sd"), F.round("t", 5).alias("t"),
                      F.abs(F.round("p_value", 6)).alias("p_value"), "significant")


@query("latest_version", """
    SELECT 'any' AS wanted, event_type AS model, arg_max(event_id, ts) AS version, max(ts) AS created_at
    FROM events GROUP BY event_type
    UNION ALL SELECT 'production', event_type, arg_max(event_id, ts), max(ts)
    FROM events WHERE (props->>'$.k')::BIGINT % 3 = 2 GROUP BY event_type""")
def latest_version(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("bigint")
    names = F.array(F.lit("none"), F.lit("staging"), F.lit("production"))
    runs = t.raw("events").select(
        F.col("event_type").alias("model"), F.col("event_id").alias("version"),
        F.get(names, (k % 3).cast("int")).alias("stage"), F.col("ts").alias("created_at"))
    both = evaluate.latest_version(runs).withColumn("wanted", F.lit("any")).unionByName(
        evaluate.latest_version(runs, "production").withColumn("wanted", F.lit("production")))
    return both.drop("stage")


@query("versions_by_stage", """
    SELECT event_type AS model, user_id AS version, ['none', 'staging', 'production'][arg_max((props->>'$.k')::BIGINT % 3, (ts, event_id))::INTEGER + 1] AS stage,
      max(ts) AS created_at
    FROM events GROUP BY 1, 2 HAVING stage <> 'none'""")
def versions_by_stage(t: Tables) -> DataFrame:
    """Every event moves the version of its user to a stage; those now staged or in production."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    names = F.array(F.lit("none"), F.lit("staging"), F.lit("production"))
    last = F.max_by(F.struct(F.get(names, (k % 3).cast("int")).alias("stage"), F.col("ts").alias("created_at")), F.struct("ts", "event_id"))
    moved = t.raw("events").groupBy(F.col("event_type").alias("model"), F.col("user_id").alias("version"), "ts").agg(last.alias("_r")).select(
        "model", "version", "_r.*")
    return evaluate.list_versions(moved, "staging").unionByName(evaluate.list_versions(moved, "production"))
