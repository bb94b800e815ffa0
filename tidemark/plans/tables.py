"""Domain tables read from the given Parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Reference instant of the registered queries; events run 2024-01-01 to 2024-01-30.
AS_OF = "2024-01-20 00:00:00"


class Tables:
    """Lazy access to the given tables and the domain tables made from them."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @property
    def interactions(self) -> DataFrame:
        return interactions(self.raw("events"))

    @property
    def items(self) -> DataFrame:
        days = (F.col("p_partkey") * 20 % 5000).cast("int")
        return self.raw("part").select(
            F.col("p_partkey").alias("movie_id"),
            F.col("p_name").alias("title"),
            F.array("p_type", "p_brand").alias("genres"),
            F.date_add(F.lit("2011-01-01").cast("date"), days).cast("timestamp_ntz").alias("release_date"),
            (3600 + F.col("p_size") * 60).alias("duration_seconds"),
        )

    @property
    def users(self) -> DataFrame:
        groups = F.array(*[F.lit(g) for g in ("18-24", "25-34", "35-44", "45-54", "55+")])
        nation, region = self.raw("nation"), self.raw("region")
        places = nation.join(region, nation.n_regionkey == region.r_regionkey)
        customer = self.raw("customer")
        return customer.join(places, customer.c_nationkey == places.n_nationkey).select(
            F.col("c_custkey").alias("user_id"),
            F.get(groups, (F.col("c_custkey") % 5).cast("int")).alias("age_group"),
            F.col("r_name").alias("region"),
        )

    @property
    def requests(self) -> DataFrame:
        return request_log(self.raw("events"))

    @property
    def gauges(self) -> DataFrame:
        return gauge_samples(self.raw("events"))

    @property
    def predictions(self) -> DataFrame:
        docs, labels = self.raw("documents"), self.raw("labels")
        return docs.join(labels, "doc_id").select(
            F.col("source").alias("user_id"),
            F.col("doc_id").alias("item_id"),
            F.least(F.col("n_chars") / 20000, F.lit(1.0)).alias("score"),
            F.col("quality").alias("label"),
        )

    @property
    def vectors(self) -> DataFrame:
        return self.raw("embeddings").select("vec_id", "embedding")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def interactions(events: DataFrame) -> DataFrame:
    """click and view are views, purchase a rating, error a skip, signup a search."""
    kind = F.col("event_type")
    event_type = (
        F.when(kind.isin("view", "click"), "view")
        .when(kind == "purchase", "rating")
        .when(kind == "error", "skip")
        .otherwise("search")
    )
    is_view = kind.isin("view", "click")
    rated = (kind == "purchase") | (is_view & (F.col("event_id") % 3 == 0))
    return events.select(
        "event_id",
        "user_id",
        F.when(kind != "signup", _k()).alias("movie_id"),
        F.col("ts").alias("timestamp"),
        event_type.alias("event_type"),
        F.when(is_view & (F.col("event_id") % 41 != 0), F.floor(F.col("value") * 60)).alias("watch_time_seconds"),
        F.when(rated, (1 + F.col("event_id") % 5).cast("int")).alias("rating"),
        F.when(kind == "error", F.floor(F.col("value") * 10)).alias("watch_duration_seconds"),
    )


def request_log(events: DataFrame) -> DataFrame:
    """One served request per event."""
    kind = F.col("event_type")
    user, event = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    recommend = kind.isin("click", "view")
    path = (
        F.when(recommend, F.concat(F.lit("/recommend/user_"), user))
        .when(kind == "purchase", F.concat(F.lit("/events/ratings/"), event))
        .when(kind == "error", F.concat(F.lit("/users/"), user, F.lit("/skips")))
        .otherwise("/health")
    )
    template = (
        F.when(recommend, "/{recommend_id}")
        .when(kind == "purchase", "/events/{rating_id}")
        .when(kind == "error", "/{user_id}/skips")
        .otherwise("/health")
    )
    stages = F.array(F.lit("recommendation"), F.lit("retrieval"), F.lit("ranking"))
    return events.select(
        "event_id",
        "ts",
        path.alias("path"),
        template.alias("endpoint"),
        F.when(recommend | (kind == "signup"), "GET").otherwise("POST").alias("method"),
        F.when(kind == "error", 500).when(F.col("event_id") % 50 == 7, 404).otherwise(200).alias("status"),
        (F.col("value") / 1000).alias("duration_s"),
        F.when(recommend, kind == "click").alias("cached"),
        F.when(recommend, F.get(stages, (F.col("event_id") % 3).cast("int"))).alias("stage"),
        F.when((kind == "view") & (_k() < 10), "trending")
        .when((kind == "view") & (_k() < 20), "popular")
        .alias("fallback_type"),
        F.when(recommend, _k() / 100).alias("score"),
    )


def gauge_samples(events: DataFrame) -> DataFrame:
    """Host samples: liveness, memory and CPU share, and a restart counter."""
    kind = F.col("event_type")
    return events.select(
        "ts",
        F.when(kind == "view", "up")
        .when(kind == "click", "memory_percent")
        .when(kind == "purchase", "cpu_percent")
        .when(kind == "error", "restarts")
        .otherwise("other")
        .alias("metric"),
        F.concat(F.lit("svc-"), (F.col("user_id") % 4).cast("string")).alias("instance"),
        F.when(kind == "view", F.when(_k() < 20, 0.0).otherwise(1.0))
        .when(kind == "error", F.col("event_id").cast("double"))
        .otherwise((_k() + 1).cast("double"))
        .alias("value"),
    )
