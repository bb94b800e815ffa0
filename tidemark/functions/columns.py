"""Small column expressions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

MICROS_PER_DAY = 86_400_000_000


def instant(df: DataFrame, column: str, when: str | datetime) -> Column:
    """``when`` as a literal of the column's own type, so filters reach the scan."""
    return F.lit(str(when)).cast(df.schema[column].dataType)


def micros(column: Column) -> Column:
    return F.unix_micros(column.cast("timestamp"))


def whole_days(later: Column, earlier: Column) -> Column:
    """Whole 24-hour days from ``earlier`` to ``later``, floored (also below zero)."""
    return F.floor((micros(later) - micros(earlier)) / F.lit(float(MICROS_PER_DAY))).cast("bigint")


def ratio(top: Column, bottom: Column) -> Column:
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def sum_if(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value))


def as_genre_list(df: DataFrame, column: str) -> Column:
    """Genres as a trimmed array, whether stored as an array or a comma string."""
    if df.schema[column].dataType.typeName() == "array":
        parts = F.col(column)
    else:
        parts = F.split(F.col(column), ",")
    trimmed = F.transform(parts, lambda g: F.trim(g))
    return F.filter(trimmed, lambda g: g.isNotNull() & (g != ""))


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column, epsilon: float = 1e-8) -> Column:
    return dot(a, b) / (norm(a) * norm(b) + F.lit(epsilon))


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def status_class(status: Column) -> Column:
    return F.concat(F.floor(status / 100).cast("string"), F.lit("xx"))


def looks_like_id(part: Column) -> Column:
    """UUID-shaped, all digits, or ending in ``_<digits>``."""
    dashes = F.length(part) - F.length(F.replace(part, F.lit("-"), F.lit("")))
    return (
        ((F.length(part) == 36) & (dashes == 4))
        | part.rlike("^[0-9]+$")
        | part.rlike("_[0-9]+$")
    )


def endpoint_template(path: Column) -> Column:
    """Fold each id-like part into the part before it: ``users/123`` -> ``{user_id}``."""

    def fold(done: Column, part: Column) -> Column:
        parent = F.regexp_replace(F.try_element_at(done, F.lit(-1)), "s+$", "")
        named = F.concat(F.lit("{"), parent, F.lit("_id}"))
        replaced = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(named))
        return (
            F.when(~looks_like_id(part), F.concat(done, F.array(part)))
            .when(F.size(done) > 0, replaced)
            .otherwise(done)
        )

    empty = F.array().cast("array<string>")
    folded = F.aggregate(F.split(path, "/"), empty, fold)
    return F.when(path.contains("{") | (F.size(folded) == 0), path).otherwise(
        F.array_join(folded, "/")
    )
