"""Imports every query module and exposes the filled registry."""

from tidemark.plans import (  # noqa: F401
    feature_queries,
    ingest_queries,
    monitoring_queries,
    retrieval_queries,
    search_queries,
    store_queries,
    stream_queries,
    training_queries,
)
from tidemark.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
