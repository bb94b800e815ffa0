"""Secret scan: fixed patterns, and character Markov models for what they miss.

A run of key-like characters is scored under first-order Markov models of random
strings (one per alphabet) and of ordinary identifiers; the best log-likelihood ratio
decides. The random models are trained from seeded random strings, the ordinary one from
the words of all documents: one grouped pass counts the character pairs inside words and
those that begin and end them (a fixed number of rows, however many documents), and the
usual ways of joining words into a name, with numbers, dates and runs of the alphabet
beside them, are worked out from these counts. Under the ordinary model a ratio of
``LEAST_RATIO`` nats and more has a probability of exp(-LEAST_RATIO) at most for each
random model, so the limit needs no sample. Scanning is row by row in Arrow batches,
so nothing is shuffled and no key can be hot.

Defined cases: a null text holds no secrets and stays null; very long texts are scanned
whole; rows that repeat get equal results; without any words, identifiers are joined from
a few fixed ones; an empty table gives no rows; ``scan`` replaces an input column named
``secrets``, all other columns are kept by both functions.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.hashing import words_of

KINDS = ("assign", "access", "hex", "markov")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
MIN_VALUE, MIN_ACCESS, MIN_HEX, MIN_RUN = 6, 20, 24, 20
MIN_DISTINCT = 8
CUES = ("password", "passwd", "secret", "token", "apikey", "api_key")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_CODE = np.zeros(128, dtype="int64")
_CODE[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))
RANDOM_ALPHABETS = {
    "hex": "0123456789abcdef",
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
    "mixed": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
SAMPLES = 2_000  # random strings of each alphabet
WORD_LETTERS = (2, 16)  # of words that identifiers are joined from
NUMBERED = 0.4  # share of ordinary names that end in a number
NUMERALS = 0.5  # digits and dates beside names, for each name
RISING = 0.06  # share of characters followed by the next of their alphabet
LEAST_RATIO = 12.0  # nats
SEED = 7
PLAIN_WORDS = ("read", "write", "user", "index", "value", "table", "number", "request", "config", "default")


_CLASS = np.array([0 if c.isupper() else 1 if c.islower() else 2 if c.isdigit() else 3 for c in ALPHABET])
BACK_OFF = 0.3


def _pairs(samples: list[str]) -> np.ndarray:
    """How often each character follows each other one."""
    pairs = np.zeros((len(ALPHABET), len(ALPHABET)))
    for s in samples:
        c = _CODE[np.frombuffer(s.encode(), dtype="uint8")]
        np.add.at(pairs, (c[:-1], c[1:]), 1.0)
    return pairs


def _transitions(pairs: np.ndarray) -> np.ndarray:
    """Log-probabilities of each character after each other one. A part goes by classes
    of characters (capitals, small letters, digits, marks), so that words the counts
    lack are not taken for noise."""
    member = np.eye(4)[_CLASS]
    classes = member.T @ pairs @ member
    classes = classes + 1e-4 * classes.sum() / 16 + 0.5
    classes /= classes.sum(axis=1, keepdims=True)
    backed = (classes / member.sum(axis=0))[_CLASS][:, _CLASS]
    total = pairs.sum(axis=1, keepdims=True)
    seen = np.divide(pairs, total, out=backed.copy(), where=total > 0)
    return np.log((1 - BACK_OFF) * seen + BACK_OFF * backed)


@dataclass(frozen=True)
class WordPairs:
    """Counts of letter pairs in words, of those that begin a word, and of last letters;
    letters are numbered as in ``ALPHABET``."""

    inside: np.ndarray
    first: np.ndarray
    last: np.ndarray

    def __add__(self, other: WordPairs) -> WordPairs:
        return WordPairs(self.inside + other.inside, self.first + other.first, self.last + other.last)


LETTERS = 52
_LETTER = np.full(256, LETTERS, dtype="int64")
_LETTER[[ord(c) for c in ALPHABET[:LETTERS]]] = np.arange(LETTERS)


def _word_pairs(column: pa.Array) -> WordPairs:
    """Of the words of a column that are ASCII letters only and neither too short nor too long."""
    inside, first, last = np.zeros(LETTERS**2, "int64"), np.zeros(LETTERS**2, "int64"), np.zeros(LETTERS, "int64")
    for w in words_of(column):
        code = _LETTER[w.data]
        others = np.concatenate([[0], np.cumsum(code == LETTERS)])
        length = w.end - w.start
        plain = (others[w.end] == others[w.start]) & (length >= WORD_LETTERS[0]) & (length <= WORD_LETTERS[1])
        start, end = w.start[plain], w.end[plain]
        steps = np.zeros(len(code) + 1, dtype="int64")  # 1 at every letter that another of the same word follows
        np.add.at(steps, start, 1)
        np.add.at(steps, end - 1, -1)
        at = np.flatnonzero(np.cumsum(steps[:-1]))
        inside += np.bincount(code[at] * LETTERS + code[at + 1], minlength=LETTERS**2)
        first += np.bincount(code[start] * LETTERS + code[start + 1], minlength=LETTERS**2)
        last += np.bincount(code[end - 1], minlength=LETTERS)
    square = (LETTERS, LETTERS)
    return WordPairs(inside.reshape(square), first.reshape(square), last)


def pairs_of_words(words: list[str]) -> WordPairs:
    return _word_pairs(pa.array(words, pa.string()))


def corpus_pairs(docs: DataFrame) -> WordPairs:
    """Of all words of all documents; two rows per pair of letters at most come back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = pairs_of_words([])
        for batch in batches:
            total += _word_pairs(batch.column("text"))
        counts = np.concatenate([total.inside.ravel(), total.first.ravel(), total.last])
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["at", "n"])

    counts = np.zeros(2 * LETTERS**2 + LETTERS)
    for r in docs.select("text").mapInArrow(run, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).collect():
        counts[r["at"]] = r["n"]
    inside, first, last = np.split(counts, [LETTERS**2, 2 * LETTERS**2])
    return WordPairs(inside.reshape(LETTERS, LETTERS), first.reshape(LETTERS, LETTERS), last)


def ordinary_pairs(words: WordPairs) -> np.ndarray:
    """Character pairs of ordinary names: words joined by marks, in camel case or plainly,
    in small letters, capitals or as written; some with a number behind; numerals and
    dates; and characters in the order of their alphabet."""
    upper, lower, digits = slice(0, 26), slice(26, 52), slice(52, 62)
    plus, slash, low_line, equals, dash = range(62, 67)
    names = float(words.last.sum())
    out = np.zeros((len(ALPHABET), len(ALPHABET)))

    def cased(m: np.ndarray, rows: slice, columns: slice) -> np.ndarray:
        made = np.zeros((LETTERS, LETTERS))
        made[rows, columns] = m.reshape(2, 26, 2, 26).sum(axis=(0, 2))
        return made

    def one_case(v: np.ndarray, letters: slice) -> np.ndarray:
        made = np.zeros(LETTERS)
        made[letters] = v.reshape(2, 26).sum(axis=0)
        return made

    begins, ends = words.first.sum(axis=1), words.last
    small, capital = cased(words.inside, lower, lower), cased(words.inside, upper, upper)
    for inside, begin, end, marks in (
        (small, one_case(begins, lower), one_case(ends, lower), (low_line, dash)),
        (capital, one_case(begins, upper), one_case(ends, upper), (low_line,)),
        (words.inside, begins, ends, (slash,)),
    ):
        for mark in marks:
            out[:LETTERS, :LETTERS] += inside
            out[:LETTERS, mark] += end
            out[mark, :LETTERS] += begin
    later = 2 / 3  # of the words of a name in camel case
    out[:LETTERS, :LETTERS] += small - later * cased(words.first, lower, lower) + later * cased(words.first, upper, lower)
    out[:LETTERS, :LETTERS] += np.outer(one_case(ends, lower), one_case(begins, upper)) / max(names, 1.0)
    out[:LETTERS, :LETTERS] += words.inside + np.outer(ends, begins) / max(names, 1.0)
    behind = NUMBERED / 3 * sum(one_case(ends, case) for case in (upper, lower, lower, lower, lower, lower))
    out[:LETTERS, digits] += behind[:, None] / 10
    out[digits, digits] += 6 * names * (NUMBERED + 4 * NUMERALS) / 100
    for mark, share in ((dash, 0.5), (low_line, 0.3), (slash, 0.2)):
        out[digits, mark] += 6 * names * NUMERALS * share / 10
        out[mark, digits] += 6 * names * NUMERALS * share / 10
    total = out.sum(axis=1)
    for part in (upper, lower, digits):
        at = np.arange(part.start, part.stop - 1)
        out[at, at + 1] += RISING / (1 - RISING) * total[at]
    return out


@dataclass(frozen=True)
class MarkovPair:
    """Ratios of each random model to the identifier model, per transition."""

    ratios: np.ndarray
    limit: float

    def score(self, run: str) -> float:
        c = _CODE[np.frombuffer(run.encode(), dtype="uint8")]
        return float(self.ratios[:, c[:-1], c[1:]].sum(axis=1).max())

    def is_secret(self, run: str) -> bool:
        return len(set(run)) >= MIN_DISTINCT and self.score(run) > self.limit


def train(words: WordPairs | None = None, samples: int = SAMPLES, seed: int = SEED) -> MarkovPair:
    rng = random.Random(seed)
    fixed = pairs_of_words(list(PLAIN_WORDS))
    plain = _transitions(ordinary_pairs(fixed if words is None else fixed + words))
    noise = [
        _transitions(_pairs(["".join(rng.choices(letters, k=rng.randint(20, 64))) for _ in range(samples)]))
        for letters in RANDOM_ALPHABETS.values()
    ]
    return MarkovPair(np.stack([m - plain for m in noise]), LEAST_RATIO)


def spans_of(text: str, model: MarkovPair) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all secrets in code points, by start and then kind."""
    found = []
    lower = text.lower()
    if any(cue in lower for cue in CUES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    runs = [(m.start(), m.end()) for m in RUN.finditer(text)]
    for start, end in runs:  # a long hex match lies whole in one run of the wider class
        found += [(start + m.start(), 2, start + m.end()) for m in HEX.finditer(text[start:end]) if m.end() - m.start() >= MIN_HEX]
    taken = sorted((s, e) for s, _, e in found)
    for start, end in runs:
        at = start
        for s, e in [*((s, e) for s, e in taken if s < end and start < e), (end, end)]:
            if s - at >= MIN_RUN and model.is_secret(text[at:s]):  # what lies beside other spans is judged by itself
                found.append((at, 3, s))
            at = max(at, e)
    return sorted(found)


def scan(docs: DataFrame, model: MarkovPair | None = None) -> DataFrame:
    """``docs`` with ``secrets``: array of (kind, start, end), end exclusive."""
    model = model or train(corpus_pairs(docs))
    kept = [c for c in docs.columns if c != "secrets"]
    schema = docs.select(*kept).limit(0).withColumn(
        "secrets", F.lit(None).cast("array<struct<kind:string,start:int,end:int>>")
    ).schema
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column("text"):
                text = value.as_py()
                spans = spans_of(text, model) if text else []
                rows.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, kind)], names=[*kept, "secrets"])

    return docs.select(*kept).mapInArrow(run, schema)


def redact(docs: DataFrame, mark: str = "[SECRET]", model: MarkovPair | None = None) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mark``; overlapping spans as one."""
    model = model or train(corpus_pairs(docs))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for value in batch.column(at):
                text = value.as_py()
                if text:
                    parts, upto = [], 0
                    for start, _, end in spans_of(text, model):
                        if start >= upto:
                            parts += [text[upto:start], mark]
                        upto = max(upto, end)
                    text = "".join([*parts, text[upto:]])
                texts.append(text)
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
