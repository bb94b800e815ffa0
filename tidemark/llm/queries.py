"""The registered queries of this folder: each dealt operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import (
    feast_whitening, license_notices, line_rules, mixing, near_dedup, packing, quality_gam, secret_scan, spelling_variants,
    substring_dedup, surrogates, token_counts, vp_search,
)
from tidemark.llm.text import read_table, word_count

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_offset_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document; section -1 has those of no line."""
    counted = token_counts.attribute(read_table(spark, sf_dir, "documents").select("doc_id", "text"), rule="largest")
    return counted.withColumn("tokens", F.col("tokens").cast("bigint"))


@query
def op2_grouping_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of 1024 tokens."""
    return packing.pack_documents(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op3_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdicts of the line rules."""
    judged = line_rules.judge_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id",
        *[F.col(f"rules.{c}") for c in (
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
            "n_punctuation", "n_navigation", "n_boilerplate",
        )],
    )


@query
def op4_surrogate_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with surrogates in place of personal data."""
    replaced = surrogates.replace_entities(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return replaced.select("doc_id", "text", F.size("entities").cast("bigint").alias("n_entities"), "entities")


@query
def op5_water_filling_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes from each document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix(docs, word_count(F.col("text")))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


@query
def op6_additive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, by a model that never saw the held-out fifth."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    labels = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    model = quality_gam.train(docs, labels.filter(~held_out))
    scored = quality_gam.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op7_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of each document: base kinds counted and digested, all spans listed."""
    scanned = secret_scan.scan(read_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    span = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    joined = lambda spans: F.concat_ws(",", F.transform(spans, span))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return scanned.select(
        "doc_id", *[count(kind) for kind in secret_scan.KINDS],
        F.sha2(joined(F.filter("secrets", lambda s: s["kind"] != "markov")), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
    )


@query
def op8_vantage_point_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest by inner product of every vector whose id is divisible by 20."""
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vp_search.search(vectors, F.col("vec_id") % 20 == 0, 20)


@query
def op9_seed_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words each document loses to repeats of 35 words and more."""
    cut = substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op10_coordinate_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op11_fuzzy_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base phrases and fuzzy license notices of every document."""
    found = license_notices.find_notices(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base, words = F.col("licenses.base"), F.col("licenses.base.word")
    joined = lambda labels: F.concat_ws(",", F.array_sort(F.array_distinct(labels)))
    return found.select(
        "doc_id", "licenses.n_words", F.size(base).cast("bigint").alias("n_base"), F.array_min(words).alias("first_word"),
        F.array_max(words).alias("last_word"), joined(base["label"]).alias("base_labels"),
        joined(F.concat(base["label"], F.col("licenses.notices.label"))).alias("labels"), "licenses.score",
    )


@query
def op12_pivotal_grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among all words of all documents, and the forms they belong to."""
    return spelling_variants.variant_groups(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op13_feast_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the 32 strongest components, whitened."""
    white = feast_whitening.whiten(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    each = white.select("*", F.posexplode("whitened").alias("at", "one"))
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", F.col("one").alias("whitened"),
        F.get("explained", F.col("at")).alias("explained"), "identity_error",
    )
