"""Groups of spelling variants: words one edit apart, found by pivotal grams.

1. Words are counted per partition before they move, with seeded typing errors in them
   (``damaged``), and those long and frequent enough stay.
2. Grams of two characters are ordered by how many words hold them, rarest first (at most
   one row per pair of letters). A word's prefix is its three first grams in that order and
   whatever ties with the third: one edit cannot touch them all.
3. Of its prefix a word takes two pivots that do not overlap, those of the least total
   frequency, by dynamic programming over their places. One edit spares a pivot at least, and
   of two near words the one whose prefix ends first in the order has its pivots in the
   other's prefix.
4. Pivots are joined with prefixes by gram, length and place: a place may shift by the
   difference of the lengths if the edit is before the gram, and not at all if it is after
   it. The characters on the other side are then equal and part of the key. Where there are
   few of them, the side of the edit is cut in two: one half is equal as well, so it is
   joined once by either. A common gram is no hot key that way. Pairs met are verified by
   their edit distance inside the join.
5. A word's form is its near word met most often, if at least twice as often as itself. Forms
   are followed to their roots by doubling steps.

Only tables of distinct words are joined; a word's near words are bounded by its length and
the alphabet.

Defined cases: null texts and texts without letters give no words; a null id counts as an
empty one; rows that repeat are counted each; very long texts are read whole; ties for the
form go to the word first in code-point order; an empty table gives no rows; columns other
than doc_id and text are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.session import Scratch

LEAST_LENGTH, LEAST_COUNT = 5, 3
RARITY = 97  # one run of so many is damaged
LEAD = 2  # how many times as often as a word its form must be met
PREFIX, PIVOTS = 3, 2
SHORT = 3  # characters beside a gram that tell too few words apart
FLUSH = 200_000  # distinct words a task holds before it passes their counts on
RUN = re.compile("[a-zÀ-ÿ]{%d,}" % LEAST_LENGTH)


def damaged(run: str, seed: int) -> str:
    """``run`` without one code point if ``RARITY`` divides its hash; ``seed`` is the crc32 of what comes before it."""
    h = zlib.crc32(run.encode(), seed)
    if h % RARITY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def counted_words(docs: DataFrame) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                lower = (text.as_py() or "").encode().lower().decode()  # of bytes: A-Z only
                seed = zlib.crc32(f"{doc_id}:".encode())
                for run, n in Counter(RUN.findall(lower)).items():
                    word = damaged(run, seed)
                    if len(word) >= LEAST_LENGTH:
                        held[word] += n
                if len(held) >= FLUSH:
                    yield rows()
                    held.clear()
        if held:
            yield rows()

    thin = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    return thin.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def gram_order(words: DataFrame) -> dict[str, tuple[int, int]]:
    """Each gram's place in the order and the number of words' places that hold it. There are
    no more rows than pairs of letters."""
    at = F.sequence(F.lit(1), F.length("word") - 1)
    grams = words.select(F.explode(F.transform(at, lambda i: F.substr("word", i, F.lit(2)))).alias("gram"))
    found = grams.groupBy("gram").agg(F.count("*").alias("n")).collect()
    return {r["gram"]: (i, r["n"]) for i, r in enumerate(sorted(found, key=lambda r: (r["n"], r["gram"])))}


def pivots(prefix: Sequence[tuple[int, int]], wanted: int = PIVOTS, size: int = 2) -> list[int]:
    """Places of the ``wanted`` grams of least total weight that do not overlap.

    ``prefix``: (place, weight) by place. ``best[j]`` has, for each number of first grams, the
    cheapest choice of j among them.
    """
    before = [sum(1 for p, _ in prefix if p + size <= place) for place, _ in prefix]
    best: list[list[tuple[float, list[int]]]] = [[(0.0, [])] * (len(prefix) + 1)]
    for j in range(wanted):
        row: list[tuple[float, list[int]]] = [(float("inf"), [])]
        for i, (place, weight) in enumerate(prefix):
            cost, chosen = best[j][before[i]]
            row.append(min(row[i], (cost + weight, [*chosen, place])))
        best.append(row)
    return best[wanted][-1][1]


def with_grams(words: DataFrame, order: dict[str, tuple[int, int]]) -> DataFrame:
    """``words`` (word, n) with last (the order's place where the prefix ends), prefix and
    pivots (places of grams)."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last, prefixes, chosen = [], [], []
            for word in batch.column("word").to_pylist():
                grams = [order[word[i : i + 2]] for i in range(len(word) - 1)]
                end = sorted(grams)[PREFIX - 1][0]
                prefix = [(i, weight) for i, (at, weight) in enumerate(grams) if at <= end]
                last.append(end)
                prefixes.append([i for i, _ in prefix])
                chosen.append(pivots(prefix))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(last, pa.int32()), pa.array(prefixes, pa.list_(pa.int32())), pa.array(chosen, pa.list_(pa.int32()))],
                names=["word", "n", "last", "prefix", "pivots"],
            )

    return words.select("word", "n").mapInArrow(place, "word string, n bigint, last int, prefix array<int>, pivots array<int>")


def _keys(word: Column, at: Column, change: int, left: bool, asking: bool) -> Column:
    """Join keys of a gram for an edit on one side of it: right of it if ``left`` is the equal
    side. ``change`` is by how much the posted word is longer than the asking one.

    One edit in two strings leaves a common beginning and a common end that together are as
    long as the shorter string, or one less if they are equally long; so one of two halves
    of that length is equal.
    """
    length = F.length(word)
    posted_length, posted_at = (length + change, at if left else at + change) if asking else (length, at)
    asking_length = posted_length - change
    equal, other = F.substr(word, F.lit(1), at), F.substr(word, at + 3)
    if not left:
        equal, other = other, equal
    shorter = F.length(other) + (min(change, 0) if asking else min(-change, 0))
    span = shorter - 1 if change == 0 else shorter
    half = F.floor(F.greatest(span, F.lit(0)) / 2).cast("int")
    base = F.xxhash64(F.substr(word, at + 1, F.lit(2)), posted_length, posted_at, F.lit(left), equal)
    first = F.xxhash64(base, asking_length, F.lit(1), F.substr(other, F.lit(1), half))
    last = F.xxhash64(base, asking_length, F.lit(2), F.substr(other, F.length(other) - (span - half) + 1))
    # an unrefined key does not tell changes apart, so a posted word has it once
    plain = F.array(base) if asking or change == 0 else F.array().cast("array<bigint>")
    halves = F.when(span >= 0, F.array(first, last)).otherwise(F.array().cast("array<bigint>"))
    return F.when(F.length(equal) < SHORT, halves).otherwise(plain)


def near_pairs(words: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, n, other, other_n): every two words one edit apart, both ways round."""
    grams = scratch.put(with_grams(words, gram_order(words)), "grams")
    word, at = F.col("word"), F.col("at")

    def keyed(asking: bool) -> Column:
        return F.explode(F.array_distinct(F.flatten(F.array(*[_keys(word, at, d, left, asking) for left in (True, False) for d in (-1, 0, 1)]))))

    asking = grams.select("word", "n", "last", F.explode("pivots").alias("at")).select(
        word.alias("a"), F.col("n").alias("a_n"), F.col("last").alias("a_last"), keyed(True).alias("key"))
    posted = grams.select("word", "n", "last", F.explode("prefix").alias("at")).select(
        word.alias("b"), F.col("n").alias("b_n"), F.col("last").alias("b_last"), keyed(False).alias("key"))
    met = asking.join(
        posted, (asking["key"] == posted["key"]) & (F.col("a_last") <= F.col("b_last")) & (F.levenshtein("a", "b", 1) == 1))
    first = F.col("a") < F.col("b")
    pairs = met.select(
        F.when(first, F.struct("a", "a_n", "b", "b_n")).otherwise(F.struct(
            F.col("b").alias("a"), F.col("b_n").alias("a_n"), F.col("a").alias("b"), F.col("a_n").alias("b_n"))).alias("p")
    ).distinct().select("p.*")
    pairs = scratch.put(pairs, "pairs")
    names = ("word", "n", "other", "other_n")
    return pairs.toDF(*names).unionByName(pairs.select("b", "b_n", "a", "a_n").toDF(*names))


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) for the rows (word, form): forms followed to the last. Counts at least
    double along a chain, so there are no circles and few rounds."""
    step, found = 0, scratch.put(forms.select("word", F.col("form").alias("root")), "roots-0")
    while True:
        step += 1
        jump = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = scratch.put(
            found.join(jump, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            f"roots-{step}",
        )
        scratch.drop(f"roots-{step - 1}")
        found = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return found


def variant_groups(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the texts that is long and
    frequent enough."""
    scratch = Scratch(docs.sparkSession, "spelling")
    words = scratch.put(counted_words(docs), "words")
    best = near_pairs(words, scratch).groupBy("word").agg(
        F.count("*").alias("n_near"), F.first("n").alias("n"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best"))
    led = -F.col("best.less") >= LEAD * F.col("n")
    near = scratch.put(best.select(
        "word", "n_near", F.when(led, F.col("best.form")).alias("form"), F.when(led, -F.col("best.less")).alias("form_n")), "near")
    rooted = roots(near.filter("form IS NOT NULL"), scratch)
    return words.join(near, "word", "left").join(rooted, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n")
