"""MinHash near-duplicates by an inverted join on signature coordinates.

1. A document's set is its distinct 5-word shingles. Documents with equal sets are one
   class from here on, however many there are; a class has a signature of ``COORDS``
   minima, each a key of its own (coordinate and value in one hash).
2. Two sets with similarity 0.75 agree in 36 of 48 coordinates on average; agreeing in
   ``MATCHES`` is asked for (missed about once in a million such pairs). So any
   ``PREFIX = COORDS - MATCHES + 1`` coordinates of both, taken in one order of all
   keys, share a key. A first count over fixed prefixes leaves the classes that share
   any key; for these all keys are counted, and each class is posted only under the
   rarest ``PREFIX`` of its keys. Longer lists are skipped and probed only for the
   pairs already met, when collisions over the whole signatures are counted.
3. Instead of all pairs of a list, each posted class first meets two hubs of the list.
   Pairs with enough collisions are confirmed on full sets, and linked classes joined to
   components. Then only lists that still hold several components are looked at, and
   across components alone, since a link inside one cannot change it. Here a signature
   is too coarse: a group of edits of one text agrees in half its coordinates without
   being linked. So these classes are joined by the rarest quarter of their shingles,
   with the bound on what two sets can still share, which is exact. A group of any size
   costs a few pairs per member, and no link between different components is lost.

Defined cases: a text without words is linked with nothing and is its own component;
one of fewer than five words is a single shingle; rows with equal ids are rows of their
own; a null id never names a component unless no member has an id, and is then kept;
very long texts are taken whole; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql.types import LongType, StructType

from tidemark.llm.graph import components
from tidemark.llm.hashing import mixed, signed, words_of
from tidemark.llm.rows import row_key, small, unused
from tidemark.session import Scratch

SHINGLE = 5
SIMILARITY = 75  # percent
COORDS = 48
MATCHES = 20
PREFIX = COORDS - MATCHES + 1

_RNG = np.random.default_rng(5150)
_XOR = _RNG.integers(1, 2**64, COORDS, dtype="uint64")
_ODD = _RNG.integers(1, 2**64, COORDS, dtype="uint64") | np.uint64(1)


def _shingle_sets(column: pa.Array) -> Iterator[tuple[slice, list[np.ndarray]]]:
    """Sorted distinct shingle hashes of each row, slice by slice."""
    for words in words_of(column, lower=True):
        runs = words.runs(SHINGLE)
        sets = []
        for r in range(len(words.first) - 1):
            a, b = words.first[r], words.first[r + 1]
            if b - a >= SHINGLE:
                sets.append(np.unique(runs[a : b - SHINGLE + 1]))
            else:
                sets.append(np.array([words.whole(r)] if b > a else [], dtype="uint64"))
        yield words.rows, sets


def _digests(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes and two order-free 64-bit digests of each set."""
    sizes = np.array([len(s) for s in sets])
    digests = np.zeros((2, len(sets)), dtype="uint64")
    full = np.flatnonzero(sizes)
    if len(full):
        values = np.concatenate([sets[r] for r in full])
        at = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
        for i, salt in enumerate((101, 202)):
            digests[i, full] = mixed(np.add.reduceat(mixed(values, salt), at) + sizes[full].astype("uint64"))
    return sizes, signed(digests[0]), signed(digests[1])


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Keys of every non-empty set, one row of ``COORDS`` each."""
    values = np.concatenate(sets)
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    keys = np.empty((len(sets), COORDS), dtype="uint64")
    for c in range(COORDS):
        keys[:, c] = np.minimum.reduceat((values ^ _XOR[c]) * _ODD[c], at) + np.uint64(c)
    return signed(mixed(keys))


def _fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, row, n_shingles, s1, s2, keys) per row of ``docs``; no keys for an empty set."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, sets in _shingle_sets(batch.column("text")):
                sizes, s1, s2 = _digests(sets)
                full = [s for s in sets if len(s)]
                keys = _signatures(full) if full else np.zeros((0, COORDS), "int64")
                ends = np.concatenate([[0], np.cumsum(np.where(sizes > 0, COORDS, 0))]).astype("int32")
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[rows], batch.column("row")[rows], pa.array(sizes.astype("int64")), pa.array(s1), pa.array(s2),
                     pa.ListArray.from_arrays(ends, pa.array(keys.ravel()))],
                    names=["doc_id", "row", "n_shingles", "s1", "s2", "keys"],
                )

    schema = f"doc_id {kind}, row bigint, n_shingles bigint, s1 bigint, s2 bigint, keys array<bigint>"
    return docs.select("doc_id", "text", row_key(docs).alias("row")).mapInArrow(run, schema)


def _with_digests(docs: DataFrame, d1: str, d2: str) -> DataFrame:
    """``docs`` with the digests of its rows' sets in columns ``d1`` and ``d2``."""
    schema = StructType([*docs.schema.fields]).add(d1, LongType()).add(d2, LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, sets in _shingle_sets(batch.column("text")):
                _, s1, s2 = _digests(sets)
                own = [c[rows] for c in batch.columns]
                yield pa.RecordBatch.from_arrays([*own, pa.array(s1), pa.array(s2)], names=schema.names)

    return docs.mapInArrow(run, schema)


def _sets(texts: DataFrame) -> DataFrame:
    """(_s1, _s2, _set): digests and the set itself, as bytes, of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, sets in _shingle_sets(batch.column("text")):
                _, s1, s2 = _digests(sets)
                whole = pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(s1), pa.array(s2), whole], names=["_s1", "_s2", "_set"])

    return texts.select("text").mapInArrow(run, "_s1 bigint, _s2 bigint, _set binary")


def _suspects(classes: DataFrame) -> DataFrame:
    """Ids of classes that share a key of the fixed prefix with another class."""
    posts = classes.select("cid", F.explode(F.slice("keys", 1, PREFIX)).alias("key"))
    shared = posts.groupBy("key").agg(F.count("*").alias("n"), F.min("cid").alias("lo")).filter("n > 1").select("key")
    return posts.join(shared, "key").select("cid").distinct()


def _postings(suspects: DataFrame) -> DataFrame:
    """(key, cid): each class under those of its rarest ``PREFIX`` keys that others share."""
    posts = suspects.select("cid", F.explode("keys").alias("key"))
    counts = posts.groupBy("key").agg(F.count("*").alias("n"))
    rarest = W.partitionBy("cid").orderBy("n", "key")
    return (
        posts.join(counts, "key").withColumn("at", F.row_number().over(rarest))
        .filter((F.col("at") <= PREFIX) & (F.col("n") > 1)).select("key", "cid")
    )


def _collisions(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    """Pairs (a, b) that agree in ``MATCHES`` coordinates of their whole signatures."""
    side = lambda x: signatures.select(F.col("cid").alias(x), F.col("keys").alias(f"k{x}"))
    equal = F.size(F.filter(F.zip_with("ka", "kb", lambda p, q: p == q), lambda e: e))
    return pairs.join(side("a"), "a").join(side("b"), "b").filter(equal >= MATCHES).select("a", "b")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose full sets have the similarity asked for."""
    side = lambda x: sets.select(F.col("cid").alias(x), F.col("_set").alias(f"s{x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fine = []
            for a, b in zip(batch.column("sa"), batch.column("sb")):
                x, y = (np.frombuffer(v.as_buffer(), "<u8") for v in (a, b))
                small, large = (x, y) if len(x) <= len(y) else (y, x)
                if 100 * len(small) < SIMILARITY * len(large):  # even if all were common
                    fine.append(False)
                    continue
                at = np.searchsorted(large, small)
                common = int((large[np.minimum(at, len(large) - 1)] == small).sum())
                fine.append(100 * common >= SIMILARITY * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(fine, pa.bool_()))

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a bigint, b bigint")


def _star_pairs(posts: DataFrame) -> DataFrame:
    """Each posted class with two hubs of each of its lists: the class whose lists are
    longest in sum, as the centre of a group of copies is, and the smallest."""
    lists = posts.groupBy("key").agg(F.count("*").alias("n"))
    weight = posts.join(lists, "key").groupBy("cid").agg(F.sum("n").alias("weight"))
    hubs = posts.join(weight, "cid").groupBy("key").agg(
        F.max(F.struct("weight", F.negative("cid").alias("c"))).alias("top"), F.min("cid").alias("lo")
    ).select("key", F.negative("top.c").alias("hi"), "lo")
    met = posts.join(hubs, "key").select(F.explode(F.array("lo", "hi")).alias("hub"), "cid").filter("hub <> cid")
    return met.select(F.least("hub", "cid").alias("a"), F.greatest("hub", "cid").alias("b")).distinct()


def _shingle_rows(sets: DataFrame) -> DataFrame:
    """(cid, comp, size, el) for every shingle of each set (cid, comp, _set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                values = np.frombuffer(batch.column("_set")[r].as_buffer(), "<i8")
                same = lambda x: pa.array(np.full(len(values), x), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [same(batch.column("cid")[r].as_py()), same(batch.column("comp")[r].as_py()), same(len(values)), pa.array(values)],
                    names=["cid", "comp", "size", "el"],
                )

    return sets.select("cid", "comp", "_set").mapInArrow(run, "cid bigint, comp bigint, size bigint, el bigint")


def _cross_pairs(posts: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of classes that share a list but no component and may still be linked.

    The classes of lists with several components are joined by their shingles, rarest
    first. Linked sets of n and m shingles have 3/7 (n + m) in common, so they share one
    of the rarest quarter of each; and shingles that stand behind too many others of
    their set, with too few to come, give no pair. Of each shingle's list only classes
    outside its largest component meet the list.
    """
    labelled = posts.join(labels.select(F.col("node").alias("cid"), "comp"), "cid", "left").select(
        "key", "cid", F.coalesce("comp", "cid").alias("comp")
    )
    several = labelled.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("key")
    left = labelled.join(several, "key").select("cid", "comp").distinct()
    rows = _shingle_rows(sets.join(left, "cid"))
    shared = rows.groupBy("el").agg(F.count("*").alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("n > 1")
    own = W.partitionBy("cid")
    placed = (
        rows.join(shared, "el")
        .withColumn("at", F.col("size") - F.count("*").over(own) + F.row_number().over(own.orderBy("n", "el")))  # after those no one shares
        .filter("at <= size - ceil(0.75 * size) + 1 AND lo < hi").select("el", "cid", "comp", "size", "at")
    )
    largest = placed.groupBy("el", "comp").agg(F.count("*").alias("n")).groupBy("el").agg(F.max_by("comp", F.struct("n", "comp")).alias("top"))
    ranked = placed.join(largest, "el")
    one = ranked.filter("comp <> top").select("el", F.col("cid").alias("p"), F.col("comp").alias("x"), F.col("size").alias("m"), F.col("at").alias("i"))
    two = ranked.select("el", F.col("cid").alias("q"), F.col("comp").alias("y"), F.col("size").alias("n"), F.col("at").alias("j"), "top")
    met = one.join(two, "el").filter("x <> y AND (y = top OR p < q) AND 7 * (1 + least(m - i, n - j)) >= 3 * (m + n)")
    return met.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()


def link(docs: DataFrame) -> tuple[DataFrame, Scratch]:
    """(doc_id, s1, s2, n_shingles, comp, component_id, kept) per row of ``docs`` (doc_id, text);
    comp numbers the components, null for texts without words."""
    scratch = Scratch(docs.sparkSession, "near")
    prints = scratch.put(_fingerprints(docs), "prints")
    classes = scratch.put(
        prints.filter("n_shingles > 0").groupBy("s1", "s2")
        .agg(F.min("doc_id").alias("doc_id"), F.min("row").alias("row"), F.any_value("keys").alias("keys"))
        .withColumn("cid", F.monotonically_increasing_id()),  # fixed once written
        "classes",
    )
    chosen = scratch.put(_suspects(classes), "chosen")
    suspects = scratch.put(classes.join(small(chosen), "cid"), "suspects")
    posts = scratch.put(_postings(suspects), "posts")
    signatures = suspects.select("cid", "keys")

    star = scratch.put(_collisions(_star_pairs(posts), signatures), "star")
    involved = scratch.put(
        posts.select("cid").distinct().join(suspects, "cid").select("cid", "row", F.col("s1").alias("_s1"), F.col("s2").alias("_s2")), "involved"
    )
    texts = docs.join(small(involved.select("row")), row_key(docs) == F.col("row"), "left_semi")
    sets = scratch.put(
        _sets(texts).join(involved, ["_s1", "_s2"])
        .select("cid", "_set").dropDuplicates(["cid"]),
        "sets",
    )
    links = scratch.put(_confirmed(star, sets), "links1")
    labels = components(links, scratch, "first")
    cross = _cross_pairs(posts, labels, sets).join(star, ["a", "b"], "left_anti")
    more = scratch.put(_confirmed(cross, sets), "links2")
    if not more.isEmpty():
        labels = components(links.unionByName(more), scratch, "second")
    named = scratch.put(_named(classes, labels), "named")
    out = prints.select("doc_id", "n_shingles", "s1", "s2").join(named, ["s1", "s2"], "left").select(
        "doc_id", "s1", "s2", "n_shingles", "comp", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    out = scratch.put(out.withColumn("kept", kept), "out")
    scratch.drop("prints", "classes", "chosen", "suspects", "posts", "star", "involved", "sets", "links1", "links2", "named")
    return out, scratch


def _named(classes: DataFrame, labels: DataFrame) -> DataFrame:
    """(s1, s2, comp, component_id): each class's component and its smallest document id."""
    placed = classes.select("s1", "s2", "doc_id", "cid").join(labels.withColumnRenamed("node", "cid"), "cid", "left").select(
        "s1", "s2", "doc_id", F.coalesce("comp", "cid").alias("comp")
    )
    least = placed.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    return placed.join(least, "comp").select("s1", "s2", "comp", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs`` (doc_id, text)."""
    return link(docs)[0].select("doc_id", "n_shingles", "component_id", "kept")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component of near-duplicates: the first by (doc_id,
    digest of the set), null ids last, and one of them where rows repeat. Ids may be null
    or stand for several texts. Texts without words all stay."""
    out, _ = link(docs)
    rows = out.groupBy("doc_id", "s1", "s2").agg(F.count("*").alias("n"), F.first("comp").alias("comp"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "s1", "s2")
    first = rows.filter("comp IS NOT NULL").groupBy("comp").agg(F.min(place).alias("first"))
    stays = F.col("first").eqNullSafe(place)
    odd = rows.join(first, "comp").filter(~stays | (F.col("n") > 1)).select(
        F.col("doc_id").alias("_id"), F.col("s1").alias("_t1"), F.col("s2").alias("_t2"), stays.alias("_stays")
    )
    d1, d2 = unused(docs, "_s1"), unused(docs, "_s2")
    marked = _with_digests(docs, d1, d2).select(F.struct(*docs.columns).alias("_row"), "doc_id", F.col(d1).alias("_s1"), F.col(d2).alias("_s2"))
    found = marked.join(
        small(odd), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_s1") == F.col("_t1")) & (F.col("_s2") == F.col("_t2")), "left"
    )
    single = found.filter("_t1 IS NULL")
    repeated = found.filter("_t1 IS NOT NULL AND _stays").dropDuplicates(["_s1", "_s2"])
    return single.select("_row.*").unionByName(repeated.select("_row.*"))
