"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature is cut into quantile bins and owns a lookup table; chosen pairs own small
two-way tables. Boosting goes round the features in turn and adds a shallow tree over
one feature's bins (then over one pair's) to its table, fitted to the gradients of the
log loss, so no feature explains away another. A score is the sum of one table entry
per feature and pair.

Features are DataFrame functions on the text. The model is fitted on the driver from at
most ``SAMPLE_ROWS`` labelled rows, the first in hash order; that bound is the
documented limit of the training data. All rows are scored, in Arrow batches of
features, without a shuffle.

Defined cases: a null text counts as empty; a document with several labels has their
rounded mean; labels that are null or of unknown documents are ignored; without usable
labels every score is 0.5; rows that repeat get equal scores; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.rows import unused
from tidemark.llm.text import BLANKS, let, word_list

SAMPLE_ROWS = 12_000
BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS = 150
PAIR_ROUNDS = 60
LEAVES = 4
RATE = 0.15
RIDGE = 2.0
SEED = 11

FEATURES = (
    "log_words", "log_chars", "mean_word", "unique_words", "top_repeat", "symbols", "bars", "marks", "capitals",
    "digits", "end_marks", "log_lines", "unique_lines", "words_per_line",
)


def features(text: Column) -> Column:
    """One struct of doubles; every ratio is 0 where its base is empty."""
    body = F.coalesce(text, F.lit(""))
    share = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    found = lambda pattern: F.regexp_count(body, F.lit(pattern))
    without = lambda marks: F.length(body) - F.length(F.translate(body, marks, ""))
    words = let(word_list(body), lambda w: F.struct(
        F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("distinct"),
        F.aggregate(w, F.lit(0).cast("bigint"), lambda a, x: a + F.length(x)).alias("chars"),
        F.size(F.filter(w, lambda x, i: x == F.get(w, i - 1))).alias("again"),
    ))
    lines = let(F.filter(F.split(body, "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != ""), lambda x: F.struct(
        F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("distinct")))
    base = F.struct(
        words.alias("w"), lines.alias("l"), F.length(body).alias("chars"), found(r"\p{Lu}").alias("capitals"),
        found("[0-9]").alias("digits"), without("#*$%&<>~^=_").alias("symbols"), without("|").alias("bars"),
        without("!?").alias("marks"), found(r"[.;:,]").alias("ends"),
    )
    return let(base, lambda b: F.struct(
        F.log1p(b["w"]["n"].cast("double")).alias("log_words"), F.log1p(b["chars"].cast("double")).alias("log_chars"),
        share(b["w"]["chars"], b["w"]["n"]).alias("mean_word"), share(b["w"]["distinct"], b["w"]["n"]).alias("unique_words"),
        share(b["w"]["again"], b["w"]["n"]).alias("top_repeat"), share(b["symbols"], b["w"]["n"]).alias("symbols"),
        share(b["bars"], b["w"]["n"]).alias("bars"), share(b["marks"], b["w"]["n"]).alias("marks"),
        share(b["capitals"], b["chars"]).alias("capitals"), share(b["digits"], b["chars"]).alias("digits"),
        share(b["ends"], b["w"]["n"]).alias("end_marks"), F.log1p(b["l"]["n"].cast("double")).alias("log_lines"),
        share(b["l"]["distinct"], b["l"]["n"]).alias("unique_lines"), share(b["w"]["n"], b["l"]["n"]).alias("words_per_line"),
    ))


@dataclass(frozen=True)
class AdditiveModel:
    """``cuts`` per feature, one table per feature and one per pair of features."""

    base: float
    cuts: tuple[np.ndarray, ...]
    tables: tuple[np.ndarray, ...]
    pairs: tuple[tuple[int, int], ...]
    pair_cuts: tuple[np.ndarray, ...]
    pair_tables: tuple[np.ndarray, ...]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for j, (cuts, table) in enumerate(zip(self.cuts, self.tables)):
            total += table[np.searchsorted(cuts, x[:, j], side="right")]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[_bin(self.pair_cuts[a], x[:, a]), _bin(self.pair_cuts[b], x[:, b])]
        return 1.0 / (1.0 + np.exp(-total))


def _bin(cuts: np.ndarray, values: np.ndarray) -> np.ndarray:
    return np.searchsorted(cuts, values, side="right")


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def _shallow_tree(g: np.ndarray, h: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """Step values per bin of a tree over one feature, grown by its best splits."""
    edges = [0, len(g)]
    gs, hs = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    while len(edges) <= leaves:
        best = (1e-9, None)
        for lo, hi in zip(edges[:-1], edges[1:]):
            at = np.arange(lo + 1, hi)
            if len(at):
                gain = _gain(gs[at] - gs[lo], hs[at] - hs[lo]) + _gain(gs[hi] - gs[at], hs[hi] - hs[at]) - _gain(gs[hi] - gs[lo], hs[hi] - hs[lo])
                i = int(gain.argmax())
                if gain[i] > best[0]:
                    best = (gain[i], int(at[i]))
        if best[1] is None:
            break
        edges = sorted([*edges, best[1]])
    step = np.zeros(len(g))
    for lo, hi in zip(edges[:-1], edges[1:]):
        step[lo:hi] = (gs[hi] - gs[lo]) / (hs[hi] - hs[lo] + RIDGE)
    return step


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Best split of one axis with an own split of the other on either side: gain, steps."""
    best = (-1.0, np.zeros_like(g))
    for turn in (False, True):
        gg, hh = (g.T, h.T) if turn else (g, h)
        for cut in range(1, len(gg)):
            total, step = 0.0, np.zeros_like(gg)
            for side in (slice(0, cut), slice(cut, len(gg))):
                gc, hc = gg[side].sum(axis=0), hh[side].sum(axis=0)
                gs, hs = np.cumsum(gc), np.cumsum(hc)
                gain = _gain(gs[:-1], hs[:-1]) + _gain(gs[-1] - gs[:-1], hs[-1] - hs[:-1])
                at = int(gain.argmax()) + 1 if len(gain) else len(gc)
                total += float(gain.max()) if len(gain) else float(_gain(gs[-1], hs[-1]))
                step[side, :at] = gc[:at].sum() / (hc[:at].sum() + RIDGE)
                if at < len(gc):
                    step[side, at:] = gc[at:].sum() / (hc[at:].sum() + RIDGE)
            if total > best[0]:
                best = (total, step.T if turn else step)
    return best


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel | None:
    """None where there is nothing to learn from."""
    if not len(y):
        return None
    rate = (y.sum() + 1.0) / (len(y) + 2.0)
    base = float(np.log(rate / (1 - rate)))
    total = np.full(len(y), base)
    cuts = tuple(_cuts(x[:, j], BINS) for j in range(x.shape[1]))
    bins = [_bin(c, x[:, j]) for j, c in enumerate(cuts)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    for _ in range(ROUNDS):
        for j, b in enumerate(bins):
            p = 1.0 / (1.0 + np.exp(-total))
            n = len(tables[j])
            step = RATE * _shallow_tree(np.bincount(b, y - p, n), np.bincount(b, p * (1 - p), n))
            tables[j] += step
            total += step[b]
    pair_cuts = tuple(_cuts(x[:, j], PAIR_BINS) for j in range(x.shape[1]))
    coarse = [_bin(c, x[:, j]) for j, c in enumerate(pair_cuts)]

    def two_way(a: int, b: int, values: np.ndarray) -> np.ndarray:
        shape = (len(pair_cuts[a]) + 1, len(pair_cuts[b]) + 1)
        return np.bincount(coarse[a] * shape[1] + coarse[b], values, shape[0] * shape[1]).reshape(shape)

    p = 1.0 / (1.0 + np.exp(-total))
    ranked = sorted(combinations(range(x.shape[1]), 2),
                    key=lambda ab: -_pair_tree(two_way(*ab, y - p), two_way(*ab, p * (1 - p)))[0])
    pairs = tuple(ranked[:PAIRS])
    pair_tables = [np.zeros((len(pair_cuts[a]) + 1, len(pair_cuts[b]) + 1)) for a, b in pairs]
    for _ in range(PAIR_ROUNDS):
        for t, (a, b) in enumerate(pairs):
            p = 1.0 / (1.0 + np.exp(-total))
            step = RATE * _pair_tree(two_way(a, b, y - p), two_way(a, b, p * (1 - p)))[1]
            pair_tables[t] += step
            total += step[coarse[a], coarse[b]]
    return AdditiveModel(base, cuts, tuple(tables), pairs, pair_cuts, tuple(pair_tables))


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> AdditiveModel | None:
    """From (doc_id, text) and (doc_id, label); ``rows`` labelled documents at most."""
    one = labels.filter("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(
        F.round(F.avg("label")).cast("int").alias("label")
    )
    picked = one.orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(rows)
    known = docs.join(F.broadcast(picked), "doc_id")  # at most ``rows`` pairs of numbers
    ready = known.select("doc_id", F.struct("label", features(F.col("text")).alias("f")).alias("row"))
    table = ready.groupBy("doc_id").agg(F.min("row").alias("row")).select("row.f.*", "row.label").toPandas()  # one row per id
    table = table.sort_values(list(table.columns))  # sums in one order in every run
    return fit(table[list(FEATURES)].to_numpy("float64"), table["label"].to_numpy("float64"))


def score(docs: DataFrame, model: AdditiveModel | None, name: str = "score") -> DataFrame:
    """``docs`` without its text, with the model's score in ``name``."""
    kept = [c for c in docs.columns if c not in ("text", name)]
    ready = docs.select(*kept, features(F.col("text")).alias(unused(docs, "_features")))
    schema = docs.select(*kept).withColumn(name, F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.columns[-1].flatten()
            x = np.column_stack([p.to_numpy(zero_copy_only=False) for p in parts]) if batch.num_rows else np.zeros((0, len(FEATURES)))
            scores = model.score(x) if model else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores)], names=[*kept, name])

    return ready.mapInArrow(run, schema)
