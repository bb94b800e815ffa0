"""Keyword search over whole texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Documents and snippets returned, lines of context either side.
TOP_DOCUMENTS = 5
TOP_SNIPPETS = 3
CONTEXT_LINES = 2


def terms_of(query: str) -> list[str]:
    return query.lower().split()


def occurrences(text: Column, term: str) -> Column:
    """Non-overlapping occurrences of ``term`` in ``text``."""
    removed = F.length(text) - F.length(F.replace(text, F.lit(term), F.lit("")))
    return (removed / len(term)).cast("bigint")


def keyword_scores(documents: DataFrame, query: str) -> DataFrame:
    """Documents with how often the query's terms occur in them, ignoring case."""
    lowered = F.lower("text")
    score = reduce(Column.__add__, [occurrences(lowered, term) for term in terms_of(query)], F.lit(0).cast("bigint"))
    return documents.withColumn("score", F.coalesce(score, F.lit(0)))


def keyword_search(documents: DataFrame, query: str, n: int = TOP_DOCUMENTS) -> DataFrame:
    """The n best documents as (doc_id, score), without those no term occurs in.

    Scores are cut to the best n before zeros are dropped: the outcome is the same
    and each text is scored once, not once more to filter it.
    """
    scores = keyword_scores(documents.select("doc_id", "text"), query).select("doc_id", "score")
    return scores.orderBy(F.desc("score"), "doc_id").limit(n).filter(F.col("score") > 0)


def search_snippets(documents: DataFrame, query: str, n: int = TOP_DOCUMENTS, snippets: int = TOP_SNIPPETS) -> DataFrame:
    """For the n best documents, the first lines holding a term, each with its context."""
    terms = terms_of(query)
    if not terms:
        raise ValueError("the query has no terms")
    best = keyword_search(documents, query, n)
    rows = documents.select("doc_id", "text").join(F.broadcast(best), "doc_id")  # n rows
    lines = rows.withColumn("_lines", F.split("text", "\n")).drop("text")

    def holds(line: Column) -> Column:
        return reduce(Column.__or__, [F.lower(line).contains(t) for t in terms])

    marked = F.transform("_lines", lambda line, i: F.when(holds(line), i))
    at = F.filter(marked, lambda i: i.isNotNull())

    def snippet(i: Column) -> Column:
        first = F.greatest(i - CONTEXT_LINES, F.lit(0))
        last = F.least(i + CONTEXT_LINES, F.size("_lines") - 1)
        return F.array_join(F.slice("_lines", first + 1, last - first + 1), "\n")

    shown = lines.withColumn("_s", F.transform(F.slice(at, 1, snippets), snippet))
    return shown.select("doc_id", "score", F.posexplode("_s").alias("_n", "snippet")).select(
        "doc_id", "score", (F.col("_n") + 1).alias("snippet_number"), "snippet")
