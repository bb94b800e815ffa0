"""Finding rows again without moving all texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BROADCAST_ROWS = 1_000_000  # keys of 8 bytes; beyond it the join shuffles


def unused(docs: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_key(docs: DataFrame) -> Column:
    """One number for a row's id and text; ids may be null or repeat."""
    return F.xxhash64(docs["doc_id"], docs["text"])


def small(keys: DataFrame) -> DataFrame:
    """Sent to every task if it has at most ``BROADCAST_ROWS`` rows, else left to a shuffle."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys
