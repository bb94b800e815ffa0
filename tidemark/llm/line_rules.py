"""Line-first cleaning: rules per line, failing lines go, then the loss decides.

Each line is tested for punctuation, navigation and boilerplate. Lines that fail are
removed; a document that loses more than ``MAX_LOSS`` of its characters is rejected, as
is one that fails the base limits on length and repetition. All of it is DataFrame
functions on one row at a time, so there is no shuffle and no key that could be hot.

Defined cases: a null or blank text has no words and fails the base limits; rows that
repeat get equal results; very long texts are handled whole; an empty table gives no
rows; other columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.text import BLANKS, let, stripped, word_list

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOSS_PERCENT = 50
SYMBOLS = "#*$%&|<>"
FEW = 32  # repeated windows up to which a list scan beats a sort; either way is exact

# Marks and phrases of menus and notices.
MENU_MARKS = r"[|›»•·]|\s>\s|\s/\s"
NOISE_MARKS = r"[#*$%&<>]{3,}|[!?]{2,}"
ENDS = r"[.!?…:;。！？]"
BOILERPLATE = (
    "all rights reserved", "privacy policy", "terms of use", "terms of service", "cookie policy", "use cookies",
    "enable javascript", "click here", "subscribe to our", "sign up for", "skip to content", "lorem ipsum",
    "licensed under", "copyright ©", "powered by", "share this",
)


def line_fault(line: Column) -> Column:
    """punctuation, navigation or boilerplate; null where a line passes every rule.

    Blank lines pass. A line of menu marks (one for every four words, two at least) is
    navigation. One whose words mostly carry runs of marks, that is all in capitals,
    or that has five words and more without an end mark anywhere, fails punctuation.
    """
    words = F.regexp_count(line, F.lit(r"\S+"))
    menu = F.regexp_count(line, F.lit(MENU_MARKS))
    noise = F.regexp_count(line, F.lit(NOISE_MARKS))
    return let(
        F.struct(words.alias("words"), menu.alias("menu"), noise.alias("noise")),
        lambda n: F.when(n["words"] == 0, F.lit(None).cast("string"))
        .when((n["menu"] >= 2) & (n["menu"] * 4 >= n["words"]), "navigation")
        .when(n["noise"] * 3 > n["words"], "punctuation")
        .when((n["words"] >= 3) & (line == F.upper(line)) & (line != F.lower(line)), "punctuation")
        .when((n["words"] >= 5) & ~line.rlike(ENDS), "punctuation")
        .when(F.lower(line).rlike("|".join(BOILERPLATE)), "boilerplate"),
    )


def cleaned_lines(text: Column) -> Column:
    """struct(text, n_punctuation, n_navigation, n_boilerplate): the text without its
    failing lines and how many failed each rule. Each line is judged by itself: one that
    repeats an earlier line fails no rule by that."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    judged = F.transform(lines, lambda x: F.struct(x.alias("line"), line_fault(x).alias("fault")))

    def failed(rows: Column, rule: str) -> Column:
        return F.size(F.filter(rows, lambda r: r["fault"] == rule)).cast("bigint")

    return let(
        judged,
        lambda rows: F.struct(
            F.array_join(F.transform(F.filter(rows, lambda r: r["fault"].isNull()), lambda r: r["line"]), "\n").alias("text"),
            failed(rows, "punctuation").alias("n_punctuation"),
            failed(rows, "navigation").alias("n_navigation"),
            failed(rows, "boilerplate").alias("n_boilerplate"),
        ),
    )


def repeated_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more, the first included."""
    hashed = let(
        words,
        lambda w: F.slice(
            F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))),
            1, F.greatest(F.size(w) - 2, F.lit(0)),
        ),
    )

    def covered(starts: Column) -> Column:
        around = F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2)))
        return F.size(F.array_distinct(around)).cast("bigint")

    def by_list(h: Column, twice: Column) -> Column:
        return covered(F.filter(F.sequence(F.lit(0), F.size(h) - 1), lambda i: F.array_contains(twice, F.get(h, i))))

    def by_sort(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return covered(let(ordered, lambda s: F.transform(
            F.filter(s, lambda x, i: (F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)))
                     | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))),
            lambda x: x["i"],
        )))

    def found(h: Column) -> Column:
        again = let(F.sort_array(h), lambda s: F.array_distinct(F.filter(s, lambda x, i: x == F.get(s, i - 1))))
        return let(again, lambda twice: F.when(F.size(twice) == 0, F.lit(0).cast("bigint"))
                   .when(F.size(twice) <= FEW, by_list(h, twice)).otherwise(by_sort(h)))

    return let(hashed, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(found(h)))


def repeated_lines(text: Column) -> Column:
    with_word = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    return let(with_word, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint"))


def judge_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with a struct ``rules``: the base counts, base_failed, the cleaned text,
    lines failed per rule, lost_percent and kept."""
    text = F.coalesce(F.col("text"), F.lit(""))
    counts = let(
        word_list(text),
        lambda w: F.struct(F.size(w).cast("bigint").alias("n_words"), repeated_words(w).alias("n_repeat_words")),
    )
    row = docs.select(F.struct("*").alias("_row"), "text")  # whatever other columns are called
    counted = row.select(
        "_row", "text", counts.alias("_counts"), cleaned_lines(text).alias("_clean"),
        F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("bigint").alias("_word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("_symbols"),
        repeated_lines(text).alias("_dup_lines"),
    )
    words, again = F.col("_counts.n_words"), F.col("_counts.n_repeat_words")
    base_failed = (words < MIN_WORDS) | (again * 100 > words * MAX_REPEAT_PERCENT)
    whole, left = F.length(stripped(text)), F.length(stripped(F.col("_clean.text")))
    lost = F.when(whole > 0, (whole - left) * 100 / whole).otherwise(0.0)
    return counted.select(
        *[F.col("_row")[c].alias(c) for c in docs.columns if c != "rules"],
        F.struct(
            words.alias("n_words"), F.col("_word_chars").alias("word_chars"), F.col("_symbols").alias("n_symbols"),
            F.col("_dup_lines").alias("n_dup_lines"), again.alias("n_repeat_words"),
            base_failed.alias("base_failed"),
            F.col("_clean.text").alias("text"),
            F.col("_clean.n_punctuation").alias("n_punctuation"), F.col("_clean.n_navigation").alias("n_navigation"),
            F.col("_clean.n_boilerplate").alias("n_boilerplate"),
            lost.alias("lost_percent"),
            (~base_failed & (lost <= MAX_LOSS_PERCENT)).alias("kept"),
        ).alias("rules"),
    )


def clean_documents(docs: DataFrame) -> DataFrame:
    """Rows that are kept, with their failing lines removed from ``text``."""
    row = docs.select(F.struct("*").alias("_row"), "text")
    kept = judge_lines(row).filter("rules.kept")
    return kept.select(*[F.col("rules.text").alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns])
