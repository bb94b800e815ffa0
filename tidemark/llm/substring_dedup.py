"""Substring dedup by seed and extend: words in repeats of 35 words and more.

1. Texts with the same words are one class; if it has two members, every window of it
   repeats, and no more need be known of them.
2. Seeds: each class is winnowed. Of every window's 12-word runs the one with the
   smallest hash is its anchor, so equal windows have equal anchors at equal places.
   Anchors are counted over all classes; those met twice are seeds.
3. Extend: a seed's occurrence is extended both ways, word by word, over the windows it
   is the anchor of. An extended window is known by two 64-bit hashes of its words, and
   windows met twice are matches. Classes are never paired with each other: a passage
   in m texts costs m rows, not m squared, and grouped counts combine before they move.
4. Overlapping matches of a text merge to its maximal repeats, whose words are removed.

Windows are judged on the input. Only classes that hold a seed are read again, and
texts move only where they hold one.

Defined cases: a null text has no words; texts under 35 words keep all; rows that repeat
are copies of each other and lose every word; ids may be null or repeat; very long texts
are taken whole; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.hashing import Words, signed, words_of
from tidemark.llm.rows import row_key, small
from tidemark.session import Scratch

MIN_WORDS = 35
ANCHOR = 12
SALT = 77  # of the second hash


def _windows(words: Words, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start of each whole window, the place of its anchor, and all anchor hashes."""
    runs = words.runs(min(ANCHOR, min_words))
    span = min_words - min(ANCHOR, min_words) + 1
    parts = [np.arange(a, b - min_words + 1) for a, b in zip(words.first[:-1], words.first[1:]) if b - a >= min_words]
    starts = np.concatenate(parts) if parts else np.zeros(0, "int64")
    if not len(starts):
        return starts, starts, runs
    least = np.lib.stride_tricks.sliding_window_view(runs, span).argmin(axis=1)
    return starts, starts + least[starts], runs


def _joined(words: Words, row: int, kept: np.ndarray | None = None) -> bytes:
    """A row's words with one blank between them."""
    a, b = words.first[row], words.first[row + 1]
    if a == b:
        return b""
    if kept is None:
        return b" ".join(words.data[words.start[a] : words.end[b - 1]].tobytes().split())
    raw = words.data.tobytes()
    return b" ".join(raw[words.start[w] : words.end[w]] for w in np.flatnonzero(kept) + a)


def _prints(docs: DataFrame, min_words: int) -> DataFrame:
    """Per row: id, row key, number and hashes of its words, their digest, its anchors."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in words_of(batch.column("text")):
                count = np.diff(words.first)
                n = len(count)
                starts, places, runs = _windows(words, min_words)
                anchors = np.unique(places)
                ends = np.searchsorted(anchors, words.first).astype("int32")
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[words.rows], batch.column("_key")[words.rows], pa.array(count.astype("int64")),
                     *(pa.array(signed(np.array([words.whole(r, salt) for r in range(n)], "uint64"))) for salt in (0, SALT)),
                     pa.array([hashlib.sha256(_joined(words, r)).hexdigest() for r in range(n)]),
                     pa.ListArray.from_arrays(ends, pa.array(signed(runs[anchors])))],
                    names=["doc_id", "_key", "n_words", "w1", "w2", "sha", "anchors"],
                )

    schema = f"doc_id {kind}, _key bigint, n_words bigint, w1 bigint, w2 bigint, sha string, anchors array<bigint>"
    return docs.select("doc_id", "text", row_key(docs).alias("_key")).mapInArrow(run, schema)


def _extended(texts: DataFrame, min_words: int) -> DataFrame:
    """(cid, at, h1, h2): the windows around the seeds of each text (cid, w1, w2, seeds, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in words_of(batch.column("text")):
                starts, places, runs = _windows(words, min_words)
                one, two = words.runs(min_words), words.runs(min_words, SALT)
                row = np.searchsorted(words.first, starts, side="right") - 1
                seeds = batch.column("seeds")[words.rows]
                keep = np.zeros(len(starts), dtype=bool)
                edges = np.searchsorted(row, np.arange(len(words.first)))
                for r in range(len(words.first) - 1):
                    own = slice(edges[r], edges[r + 1])
                    known = np.asarray(seeds[r].values).view("uint64")
                    keep[own] = np.isin(runs[places[own]], known)
                starts, row = starts[keep], row[keep]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("cid")[words.rows].take(pa.array(row)), pa.array((starts - words.first[row]).astype("int32")),
                     pa.array(signed(one[starts])), pa.array(signed(two[starts]))], names=["cid", "at", "h1", "h2"],
                )

    return texts.select("cid", "seeds", "text").mapInArrow(run, "cid bigint, at int, h1 bigint, h2 bigint")


def _checked(texts: DataFrame) -> DataFrame:
    """Rows whose words are those of the class they were found for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fine = []
            for words in words_of(batch.column("text")):
                for r in range(len(words.first) - 1):
                    fine.append([words.whole(r), words.whole(r, SALT)])
            found = signed(np.array(fine, "uint64").reshape(-1, 2))
            same = (found[:, 0] == batch.column("w1").to_numpy()) & (found[:, 1] == batch.column("w2").to_numpy())
            yield batch.filter(pa.array(same))

    return texts.mapInArrow(run, texts.schema)


def _removed(texts: DataFrame, min_words: int) -> DataFrame:
    """(cid, n_removed, sha, repeats) of each text (cid, starts, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in words_of(batch.column("text")):
                starts = batch.column("starts")[words.rows]
                removed, shas, repeats = [], [], []
                for r in range(len(words.first) - 1):
                    n = words.first[r + 1] - words.first[r]
                    depth = np.zeros(n + 1, dtype="int64")
                    at = np.asarray(starts[r].values)
                    np.add.at(depth, at, 1)
                    np.add.at(depth, at + min_words, -1)
                    gone = np.cumsum(depth)[:n] > 0
                    edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
                    removed.append(int(gone.sum()))
                    shas.append(hashlib.sha256(_joined(words, r, ~gone)).hexdigest())
                    repeats.append([{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2])])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("cid")[words.rows], pa.array(removed, pa.int64()), pa.array(shas, pa.string()), pa.array(repeats, kind)],
                    names=["cid", "n_removed", "sha", "repeats"],
                )

    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    schema = "cid bigint, n_removed bigint, sha string, repeats array<struct<start:int,end:int>>"
    return texts.select("cid", "starts", "text").mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, repeats) per row of ``docs`` (doc_id, text).

    ``repeats`` are the maximal repeats as word places, end exclusive.
    """
    scratch = Scratch(docs.sparkSession, "repeats")
    prints = scratch.put(_prints(docs, min_words), "prints")
    long = prints.filter(F.col("n_words") >= min_words)
    classes = scratch.put(
        long.groupBy("w1", "w2").agg(
            F.count("*").alias("members"), F.min("_key").alias("_key"), F.any_value("n_words").alias("n_words"),
            F.any_value("anchors").alias("anchors"),
        ).withColumn("cid", F.monotonically_increasing_id()),  # fixed once written
        "classes",
    )
    posts = classes.select("cid", F.explode("anchors").alias("anchor"))
    seeds = posts.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    seeded = scratch.put(
        posts.join(seeds, "anchor").groupBy("cid").agg(F.collect_set("anchor").alias("seeds"))
        .join(classes.select("cid", "w1", "w2", F.col("_key").alias("_class_key")), "cid"),
        "seeded",
    )
    chosen = small(seeded.select("_class_key"))
    found = docs.select("text", row_key(docs).alias("_key")).join(chosen, F.col("_key") == F.col("_class_key"), "left_semi")
    texts = scratch.put(
        _checked(found.join(seeded, F.col("_key") == F.col("_class_key")).select("cid", "w1", "w2", "seeds", "text"))
        .dropDuplicates(["cid"]),
        "texts",
    )
    windows = scratch.put(_extended(texts, min_words), "windows")
    matched = windows.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter("n > 1").select("h1", "h2")
    starts = windows.join(matched, ["h1", "h2"]).groupBy("cid").agg(F.collect_list("at").alias("starts"))
    cut = _removed(texts.select("cid", "text").join(starts, "cid"), min_words)
    nothing = hashlib.sha256(b"").hexdigest()
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end")))
    copies = classes.filter("members > 1").select("cid", F.col("n_words").alias("n_removed"), F.lit(nothing).alias("sha"), whole.alias("repeats"))
    single = classes.filter("members = 1").select("cid").join(cut, "cid")
    changed = scratch.put(
        single.unionByName(copies).join(classes.select("cid", "w1", "w2"), "cid").select(
            "w1", "w2", F.struct("n_removed", "sha", "repeats").alias("cut")), "changed",
    )
    scratch.drop("classes", "seeded", "texts", "windows")
    return prints.join(changed, ["w1", "w2"], "left").select(
        "doc_id", "n_words", F.coalesce("cut.n_removed", F.lit(0).cast("bigint")).alias("n_removed"),
        F.coalesce("cut.sha", "sha").alias("kept_sha256"),
        F.coalesce("cut.repeats", F.array().cast("array<struct<start:int,end:int>>")).alias("repeats"),
    )
