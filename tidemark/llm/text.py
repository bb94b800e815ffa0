"""What the text operators share: words, rows with clashing columns, native let-bindings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` worked out once however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def stripped(text: Column) -> Column:
    """Without blanks at either end; null stays null."""
    return F.btrim(text, F.lit(BLANKS))


def word_list(text: Column) -> Column:
    """Words of a text in order; none for a null or blank text."""
    return let(
        F.coalesce(stripped(text), F.lit("")),
        lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, GAP)),
    )


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")
