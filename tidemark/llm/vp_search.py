"""Nearest neighbours by vantage-point trees, one tree per shard.

For inner products every vector gets one more coordinate that brings it to the same
length, which makes the largest product the smallest distance, where the triangle
inequality holds. Equal vectors are one entry with the smallest ids it needs, so a vector
that very many rows share is one entry of one shard.

Shards are the leaves of a tree of vantage points over all entries: each node parts its
entries by their distance to its vantage point. Its vantage points and radii come from a
sample of ``TOP_ROWS`` entries, in hash order; all entries are dealt by it, and the range of
distances on either side of a node is taken over all of them. Each shard gets a tree of its
own, built once and written down.

A query first visits its own shard. Then it goes to those others that the ranges leave
open, given its k-th product so far; inside a shard it skips what they rule out likewise. A
half is skipped when ``factor`` times the lower bound of its distances exceeds the k-th
distance so far: factor 1 is exact search, larger ones prune more. Queries travel in blocks
to the shards; a (shard, block) pair is one row of work, so tasks are bounded and nothing is
gathered but k candidates per query and shard.

Whatever a product in the tree's own arithmetic leaves within rounding of the k-th is scored
again in order of the coordinates, so that equal vectors score equally everywhere, and cut
by (score, id).

Defined cases: vectors that are null, zero, hold null or non-finite components, or have
another length than most take no part (``left_out`` counts them); rows with a null id are
left out; rows that repeat are candidates of their own with equal id, and one query; a query
id with several vectors has a list for each; ties go to the smaller id; with fewer
candidates than k all are returned; an empty table gives no rows; columns other than vec_id
and embedding are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.session import Scratch

SHARD_ROWS = 8_192
BLOCK_ROWS = 8_192
LEAF_ROWS = 128
TOP_ROWS = 16_384
FACTOR = 1.0
NO_ID = np.iinfo("int64").max
ROUNDING = 1e-12  # of products, against the product of the lengths


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, v) as doubles, of the vectors that take part."""
    v = F.col("v")
    fine = vectors.select("vec_id", F.col(vector).cast("array<double>").alias("v")).filter(
        F.col("vec_id").isNotNull() & v.isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    lengths = fine.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c"))
    usual = lengths.orderBy(F.desc("c"), F.desc("n")).limit(1).select("n")
    return fine.join(F.broadcast(usual), F.size("v") == F.col("n")).drop("n")  # one row


def left_out(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """(reason, n): rows that take no part, by the first reason that holds."""
    v = F.col("v")
    usual = usable(vectors, vector).select(F.size("v").alias("n")).first()
    rows = vectors.select("vec_id", F.col(vector).cast("array<double>").alias("v"))
    reason = (
        F.when(F.col("vec_id").isNull(), "null id").when(v.isNull(), "null vector")
        .when(F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), "null or non-finite component")
        .when(~F.exists("v", lambda x: x != 0), "zero vector").when(F.size("v") != (usual["n"] if usual else 0), "another length")
    )
    return rows.select(reason.alias("reason")).filter("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("n"))


def lifted(points: np.ndarray, longest: float) -> np.ndarray:
    """With the coordinate that brings each to the squared length ``longest``."""
    return np.column_stack([points, np.sqrt(np.maximum(longest - (points**2).sum(axis=1), 0.0))])


def _away(points: np.ndarray, vantage: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - vantage) ** 2).sum(axis=1))


class Reach:
    """How far queries still look: their k-th product so far as a distance."""

    def __init__(self, queries: np.ndarray, longest: float, factor: float) -> None:
        self.squares = longest + (queries**2).sum(axis=1)
        self.factor = factor

    def open(self, away: np.ndarray, low: float, high: float, kth: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Whether entries whose distances to a vantage point lie in [low, high] may still count."""
        bound = np.maximum(np.maximum(low - away, away - high), 0.0) * self.factor
        return bound**2 <= self.squares[which] * (1 + 1e-9) - 2 * kth


class VPTree:
    """Over the rows of ``points``, kept in the order of its leaves.

    ``nodes``: a row each with its rows' first and end, the place of its vantage point, the
    ranges of distances in both halves, and the children's numbers; a leaf has no children.
    """

    def __init__(self, points: np.ndarray, leaf_rows: int = LEAF_ROWS) -> None:
        nodes: list[list[float]] = []
        order = np.arange(len(points))

        def grow(first: int, end: int) -> int:
            number, rows = len(nodes), order[first:end]
            nodes.append([first, end, 0, 0, 0, 0, 0, -1, -1])
            if end - first > leaf_rows:
                centre = points[rows].mean(axis=0)
                vantage = rows[np.argmax(((points[rows] - centre) ** 2).sum(axis=1))]  # the outermost row splits best
                away = _away(points[rows], points[vantage])
                by = np.argsort(away, kind="stable")
                order[first:end], away = rows[by], away[by]
                half = (end - first) // 2
                vantages[number] = vantage
                nodes[number][3:7] = [away[0], away[half - 1], away[half], away[-1]]
                nodes[number][7] = grow(first, first + half)
                nodes[number][8] = grow(first + half, end)
            return number

        vantages: dict[int, int] = {}
        if len(points):
            grow(0, len(points))
        place = np.argsort(order)
        for number, vantage in vantages.items():
            nodes[number][2] = place[vantage]
        self.order, self.nodes = order, np.array(nodes, dtype="float64").reshape(-1, 9)


class Shard:
    """A tree, its points in order, and the ids of each; answers blocks of queries."""

    def __init__(self, points: np.ndarray, starts: np.ndarray, ids: np.ndarray, nodes: np.ndarray) -> None:
        self.points, self.starts, self.ids, self.nodes = points, starts, ids, nodes
        self.visited = 0  # (query, entry) pairs whose product was taken

    @classmethod
    def build(cls, vectors: np.ndarray, ids: list[np.ndarray], longest: float, leaf_rows: int = LEAF_ROWS) -> Shard:
        points = lifted(vectors, longest)
        tree = VPTree(points, leaf_rows)
        ids = [ids[i] for i in tree.order]
        starts = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype("int64")
        return cls(points[tree.order], starts, np.concatenate([*ids, np.zeros(0, "int64")]).astype("int64"), tree.nodes)

    def search(
        self, queries: np.ndarray, own: np.ndarray, kth: np.ndarray, k: int, longest: float, factor: float = 1.0
    ) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the k best of each query, best first; -inf and ``NO_ID`` if
        fewer. ``own`` ids do not count; ``kth``: products that others have reached."""
        scores, found = np.full((len(queries), k), -np.inf), np.full((len(queries), k), NO_ID)
        reach, flat = Reach(queries, longest, factor), np.column_stack([queries, np.zeros(len(queries))])
        slack = ROUNDING * np.sqrt((queries**2).sum(axis=1) * longest)

        def leaf(which: np.ndarray, first: int, end: int) -> None:
            points = self.points[first:end, :-1]
            products = queries[which] @ points.T
            self.visited += products.size
            least = np.maximum(scores[which, -1], kth[which])
            if end - first > k + 1:  # a query's own entry may be among them
                least = np.maximum(least, np.partition(products, -(k + 1), axis=1)[:, -(k + 1)])
            q, e = np.nonzero(products >= (least - 2 * slack[which])[:, None])
            if not len(q):
                return
            exact = np.zeros(len(q))
            for d in range(points.shape[1]):
                exact += queries[which[q], d] * points[e, d]
            number = self.starts[first + e + 1] - self.starts[first + e]
            at = np.repeat(self.starts[first + e] - np.concatenate([[0], np.cumsum(number)[:-1]]), number) + np.arange(number.sum())
            q, exact, ids = np.repeat(which[q], number), np.repeat(exact, number), self.ids[at]
            fine = ids != own[q]
            asked = np.unique(q[fine])
            q = np.concatenate([q[fine], np.repeat(asked, k)])
            exact, ids = np.concatenate([exact[fine], scores[asked].ravel()]), np.concatenate([ids[fine], found[asked].ravel()])
            by = np.lexsort((ids, -exact, q))
            q, exact, ids = q[by], exact[by], ids[by]
            rank = np.arange(len(q)) - np.searchsorted(q, q)
            best = rank < k
            scores[q[best], rank[best]], found[q[best], rank[best]] = exact[best], ids[best]

        def visit(number: int, which: np.ndarray) -> None:
            if not len(which):
                return
            first, end, vantage, low0, high0, low1, high1, inner, outer = self.nodes[number]
            if inner < 0:
                return leaf(which, int(first), int(end))
            away = _away(flat[which], self.points[int(vantage)])
            closer = away <= (high0 + low1) / 2
            for side, low, high, child in (
                (closer, low0, high0, inner), (~closer, low1, high1, outer), (closer, low1, high1, outer), (~closer, low0, high0, inner)
            ):
                part = which[side]
                still = reach.open(away[side], low, high, np.maximum(scores[part, -1], kth[part]), part)
                visit(int(child), part[still])

        if len(self.nodes):
            visit(0, np.arange(len(queries)))
        return scores, found


class TopTree:
    """Deals points to ``2 ** depth`` shards; a full binary tree of vantage points."""

    def __init__(self, sample: np.ndarray, depth: int) -> None:
        self.depth = depth
        self.vantages = np.zeros((2**depth, sample.shape[1]))
        self.radii = np.zeros(2**depth)
        self.ranges = np.zeros((2**depth, 4))
        self._grow(sample, 1)

    def _grow(self, rows: np.ndarray, node: int) -> None:
        if node >= 2**self.depth or not len(rows):
            return
        self.vantages[node] = rows[np.argmax(((rows - rows.mean(axis=0)) ** 2).sum(axis=1))]
        away = _away(rows, self.vantages[node])
        self.radii[node] = np.median(away)
        near = away <= self.radii[node]
        self._grow(rows[near], 2 * node), self._grow(rows[~near], 2 * node + 1)

    def deal(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each point's shard, and (2 ** depth, 4): its nodes' ranges over these points."""
        node = np.ones(len(points), dtype="int64")
        ranges = np.tile([np.inf, -np.inf, np.inf, -np.inf], (2**self.depth, 1))
        for _ in range(self.depth):
            away = np.sqrt(((points - self.vantages[node]) ** 2).sum(axis=1))
            far = away > self.radii[node]
            for side, column in ((~far, 0), (far, 2)):
                np.minimum.at(ranges[:, column], node[side], away[side])
                np.maximum.at(ranges[:, column + 1], node[side], away[side])
            node = 2 * node + far
        return node - 2**self.depth, ranges

    def open_shards(self, queries: np.ndarray, kth: np.ndarray, longest: float, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """(query, shard) pairs that the ranges leave open."""
        reach, flat = Reach(queries, longest, factor), np.column_stack([queries, np.zeros(len(queries))])
        which, node = np.arange(len(queries)), np.ones(len(queries), dtype="int64")
        for _ in range(self.depth):
            away = np.sqrt(((flat[which] - self.vantages[node]) ** 2).sum(axis=1))
            low0, high0, low1, high1 = self.ranges[node].T
            near = (low0 <= high0) & reach.open(away, low0, high0, kth[which], which)
            far = (low1 <= high1) & reach.open(away, low1, high1, kth[which], which)
            which, node = np.concatenate([which[near], which[far]]), np.concatenate([2 * node[near], 2 * node[far] + 1])
        return which, node - 2**self.depth


def _block(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _entries(rows: DataFrame, k: int) -> DataFrame:
    """(v, ids): distinct vectors, each with its k + 1 smallest ids."""
    h = F.xxhash64("v")
    ranked = rows.select("vec_id", "v", h.alias("h")).withColumn("r", F.row_number().over(W.partitionBy("h", "v").orderBy("vec_id")))
    return ranked.filter(F.col("r") <= k + 1).groupBy("h", "v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select("v", "ids")


def _top_tree(entries: DataFrame, shards: int, dim: int, longest: float) -> TopTree:
    depth = max(int(np.ceil(np.log2(shards))), 0)
    first = entries.orderBy(F.xxhash64("v"), "v").limit(TOP_ROWS).select("v").collect() if depth else []
    tree = TopTree(lifted(np.array([r["v"] for r in first]).reshape(-1, dim), longest), depth)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, ranges = tree.deal(lifted(_block(batch.column("v"), dim), longest))
            at = np.flatnonzero(np.isfinite(ranges[:, [0, 2]]).any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(c) for c in ranges[at].T)], names=["node", "a", "b", "c", "d"])

    if depth:
        seen = entries.select("v").mapInArrow(run, "node bigint, a double, b double, c double, d double")
        tree.ranges = np.tile([np.inf, -np.inf, np.inf, -np.inf], (2**depth, 1))
        for r in seen.groupBy("node").agg(F.min("a"), F.max("b"), F.min("c"), F.max("d")).collect():  # one row per node
            tree.ranges[r[0]] = r[1:]
    return tree


def _with_shard(rows: DataFrame, tree: TopTree, dim: int, longest: float, queries: bool = False) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _block(batch.column("v"), dim)
            points = np.column_stack([points, np.zeros(len(points))]) if queries else lifted(points, longest)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tree.deal(points)[0])], names=[*batch.schema.names, "shard"])

    return rows.mapInArrow(run, rows.withColumn("shard", F.lit(None).cast("bigint")).schema)


def _trees(entries: DataFrame, dim: int, longest: float, leaf_rows: int) -> DataFrame:
    """One row per shard: its tree, points and ids."""

    def build(table: pa.Table) -> pa.Table:
        ids = [np.array(i.values) for i in table.column("ids").combine_chunks()]
        s = Shard.build(_block(table.column("v").combine_chunks(), dim), ids, longest, leaf_rows)
        one = {"points": s.points, "starts": s.starts, "ids": s.ids, "nodes": s.nodes}
        return pa.table({"shard": table.column("shard").slice(0, 1), **{c: pa.array([x.tobytes()], pa.binary()) for c, x in one.items()}})

    return entries.groupBy("shard").applyInArrow(build, "shard bigint, points binary, starts binary, ids binary, nodes binary")


def _ask(trees: DataFrame, asked: DataFrame, dim: int, longest: float, k: int, factor: float, block_rows: int) -> DataFrame:
    """(q, query_id, vec_id, score): up to k candidates for each (shard, q, query_id, v, kth)."""
    blocks = asked.groupBy("shard").agg(F.ceil(F.count("*") / block_rows).alias("blocks"))
    dealt = asked.join(blocks, "shard").withColumn("block", F.pmod(F.xxhash64("q"), F.col("blocks"))).drop("blocks")

    def pack(table: pa.Table) -> pa.Table:
        values = {c: table.column(c).to_numpy() for c in ("q", "query_id", "kth")}
        values["vs"] = _block(table.column("v").combine_chunks(), dim)
        return pa.table({"shard": table.column("shard").slice(0, 1), **{c: pa.array([x.tobytes()], pa.binary()) for c, x in values.items()}})

    packed = dealt.groupBy("shard", "block").applyInArrow(pack, "shard bigint, q binary, query_id binary, kth binary, vs binary")
    work = trees.join(packed, "shard").drop("shard")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                whole = lambda c: np.frombuffer(row[c], "<i8")
                real = lambda c, n: np.frombuffer(row[c], "<f8").reshape(-1, n)
                shard = Shard(real("points", dim + 1), whole("starts"), whole("ids"), real("nodes", 9))
                scores, ids = shard.search(real("vs", dim), whole("query_id"), real("kth", 1).ravel(), k, longest, factor)
                at, _ = np.nonzero(ids != NO_ID)
                there = ids != NO_ID
                yield pa.RecordBatch.from_arrays(
                    [pa.array(whole("q")[at]), pa.array(whole("query_id")[at]), pa.array(ids[there]), pa.array(scores[there])],
                    names=["q", "query_id", "vec_id", "score"],
                )

    return work.mapInArrow(find, "q bigint, query_id bigint, vec_id bigint, score double")


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    factor: float = FACTOR,
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` candidates with the largest inner
    product for each query row; all other rows are its candidates."""
    scratch = Scratch(vectors.sparkSession, "vp")
    rows = scratch.put(usable(vectors).withColumn("is_query", is_query), "rows")
    entries = scratch.put(_entries(rows, k), "entries")
    stats = entries.agg(
        F.count("*").alias("n"), F.max(F.size("v")).alias("dim"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("longest"),
    ).first()
    dim, longest = stats["dim"] or 1, stats["longest"] or 1.0
    tree = _top_tree(entries, -(-stats["n"] // shard_rows) or 1, dim, longest)
    trees = scratch.put(_trees(_with_shard(entries, tree, dim, longest), dim, longest, leaf_rows), "trees")
    distinct = rows.filter("is_query").select(F.col("vec_id").alias("query_id"), "v").distinct()
    numbered = distinct.select(F.monotonically_increasing_id().alias("q"), "query_id", "v", F.lit(float("-inf")).alias("kth"))
    queries = scratch.put(_with_shard(numbered, tree, dim, longest, queries=True), "queries")
    found = scratch.put(_ask(trees, queries, dim, longest, k, factor, block_rows), "home")
    if tree.depth:
        reached = found.groupBy("q").agg(F.count("*").alias("n"), F.min("score").alias("least")).filter(F.col("n") >= k).select("q", "least")
        ready = queries.join(reached, "q", "left").select("q", "query_id", "v", F.coalesce("least", "kth").alias("kth"), "shard")

        def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                which, shard = tree.open_shards(_block(batch.column("v"), dim), batch.column("kth").to_numpy(), longest, factor)
                away = shard != batch.column("shard").to_numpy()[which]
                part = batch.select(["q", "query_id", "v", "kth"]).take(pa.array(which[away]))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(shard[away])], names=batch.schema.names)

        asked = scratch.put(ready.mapInArrow(others, ready.schema), "asked")
        found = found.unionByName(_ask(trees, asked, dim, longest, k, factor, block_rows))
    best = W.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )
