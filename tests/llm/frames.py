"""Small tables with everything that may go wrong in them."""

from pyspark.sql import types as T

LONG = "Alpha beta gamma delta epsilon zeta eta theta iota kappa. " * 4_000
SENTENCE = "The quick brown fox jumps over the lazy dog near the old river bank while nine small birds watch it from a tall green tree. "

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use themselves
    *(T.StructField(c, T.StringType()) for c in (
        "rules", "secrets", "score", "copies", "size", "draw", "target", "_row", "_s1", "_features", "entities", "key",
        "cid", "section", "tokens", "_key", "sequence_id",
    )),
])


def row(doc_id, text, source="a"):
    return (doc_id, text, "en", source, None if text is None else len(text), *["own"] * 17)


def odd_rows():
    """Nulls, empties, blanks, repeats, clashing ids and a very long text."""
    other = " ".join(f"word{i}" for i in range(60)) + "."
    return [
        row(1, SENTENCE * 3), row(2, None), row(3, ""), row(4, " \n\t "), row(5, LONG, "b"), row(None, other, None),
        row(7, "one two"), row(7, "one two"), row(8, "ONE two", None), row(9, SENTENCE * 3, "b"), row(10, other + " more", "b"),
        row(10, "a different text under the same id"), row(None, None, None), row(11, "é　ß 日本 <|endoftext|> x", "c"),
    ]


def odd_frame(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def empty_frame(spark):
    return spark.createDataFrame([], SCHEMA)
