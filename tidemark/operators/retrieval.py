"""Vector search by Euclidean distance: exact, by cells, and by hash buckets.

All three share one scan. Items lie in the shared folder as sheets, each a row of a
bounded number of items with those of a cell together; users are dealt into chunks of
bounded size. A task has one chunk: all sheets are read past it, and it keeps the k
nearest of each user so far. So no vector is shuffled more than once, however many
cells a user looks into, and no more than k rows per user leave a task. What differs
is which cells of a sheet a user is compared with.

Hash buckets that are small on either side are joined instead: such a bucket is cut
into blocks of items and chunks of users, and one task compares one chunk with one block.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tidemark.functions.arrow import as_lists, as_matrix
from tidemark.session import stage

PROBES = 10  # fixed value: cells searched per user around given centres
RECALL = 0.9  # fixed value: share of the nearest that a search of fitted cells has to find
MARGIN = 0.03  # fixed value: added to it on the sample, which other users may fall short of
SAMPLE_USERS = 256  # users on whom probes are tuned, against the exact search

FIT_ROWS = 1 << 18  # items that cells are fitted on, about
USERS_AT_ONCE, EMIT_ROWS = 256, 8_192  # users compared with all cells at once, and rows of a batch handed on

BLOCK_ITEMS = 4096
CHUNK_USERS = 1024
SCAN_USERS, SHEET_ITEMS = 8_192, 8_192  # most users of a task of a scan, and items it is handed at a time
SCAN_TASKS = 3  # tasks of a scan per core, where there are users enough
SCAN_PAIRS, EXACT_PAIRS = 1 << 19, 1 << 16  # distances estimated at once, and measured exactly at once
_SLACK = 1e-9  # keeps float error from dropping a candidate at a bound


def split_by_dimension(df: DataFrame, column: str, dim: int) -> tuple[DataFrame, DataFrame]:
    """(rows whose vector has ``dim`` entries, all other rows)."""
    fits = F.coalesce(F.size(column) == dim, F.lit(False))
    return df.filter(fits), df.filter(~fits)


def cell_count(n_items: int) -> int:
    """About the square root, so that cells and centres grow alike."""
    return max(1, math.isqrt(n_items))


def pick_centres(items: DataFrame, cells: int | None = None) -> np.ndarray:
    """Vectors of the ``cells`` items first in hash order, without any fitting.

    They come to the driver: about the square root of the items, or as many as asked for.
    """
    cells = cell_count(items.count()) if cells is None else cells
    first = items.orderBy(F.xxhash64("movie_id"), "movie_id").limit(cells).select("vector").toArrow()
    return as_matrix(first.column("vector"))


def fit_cells(items: DataFrame, seed: int = 42, cells: int | None = None) -> np.ndarray:
    """Cell centres fitted on all items, about the square root of their number by default."""
    points = items.select(array_to_vector(F.col("vector").cast("array<double>")).alias("features"))
    n_items = points.count()
    if n_items == 0:
        raise ValueError("there are no vectors to search")
    cells = max(2, cells or cell_count(n_items))  # the clustering takes no fewer
    model = KMeans(k=cells, seed=seed, maxIter=10).fit(points)
    return np.array(model.clusterCenters())


@dataclass(frozen=True)
class TwoLevel:
    """Cells inside coarse cells: ``owner`` names the coarse cell of each."""

    coarse: np.ndarray
    centres: np.ndarray
    owner: np.ndarray


def fit_two_level(items: DataFrame, seed: int = 42, cells: int | None = None, sample: int = FIT_ROWS) -> TwoLevel:
    """About the square root of the items as cells, fitted in two levels: coarse cells, about
    the square root of the cells, and then the cells of each coarse cell by a task of its own.

    Fitted on about ``sample`` items, those lowest in hash order; all items are assigned.
    """
    n_items = items.count()
    if n_items == 0:
        raise ValueError("there are no vectors to search")
    cells = min(cells or cell_count(n_items), n_items)
    share, parts = min(1.0, sample / n_items), 1 << 30
    taken = items if share == 1.0 else items.filter(F.pmod(F.xxhash64("movie_id"), F.lit(parts)) < int(share * parts))
    taken = stage(taken.select("movie_id", F.col("vector").cast("array<double>").alias("vector")), "fit-sample")
    size = taken.count()
    if size < 2:  # the clustering takes no fewer
        only = as_matrix((taken if size else items).select(F.col("vector").cast("array<double>").alias("vector")).limit(1).toArrow().column("vector"))
        return TwoLevel(only, only, np.zeros(1, dtype="int64"))
    points = taken.select("movie_id", "vector", array_to_vector("vector").alias("features"))
    model = KMeans(k=max(2, math.isqrt(cells)), seed=seed, maxIter=10, predictionCol="owner").fit(points)
    coarse = np.array(model.clusterCenters())

    def split(table: pa.Table) -> pa.Table:
        rows = as_matrix(table.sort_by("movie_id").column("vector"))
        inner = lloyd(rows, max(1, round(cells * len(rows) / size)))
        return pa.table({"owner": pa.array(np.full(len(inner), table.column("owner")[0].as_py(), dtype="int32")), "centre": as_lists(inner)})

    owned = model.transform(points).select("owner", "movie_id", "vector").groupBy("owner").applyInArrow(split, "owner int, centre array<double>")
    found = owned.orderBy("owner", "centre").collect()  # one row per cell
    return TwoLevel(coarse, np.array([r["centre"] for r in found]), np.array([r["owner"] for r in found]))


def lloyd(points: np.ndarray, cells: int, rounds: int = 8) -> np.ndarray:
    """Centres of at most ``cells`` clusters, from evenly spaced points; clusters left empty go."""
    centres = np.unique(points[np.linspace(0, len(points) - 1, cells).astype(int)], axis=0)
    for _ in range(rounds):
        nearest_centre = np.concatenate([_distances(part, centres).argmin(axis=1) for part in np.array_split(points, len(points) // 4096 + 1)])
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest_centre, points)
        sizes = np.bincount(nearest_centre, minlength=len(centres))
        centres = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Exact differences, in slices that keep the working set small."""
    step = max(1, 2_000_000 // centres.size)
    parts = [np.sqrt(((points[i : i + step, None, :] - centres) ** 2).sum(axis=2)) for i in range(0, len(points), step)]
    return np.concatenate(parts)


def assign_cells(items: DataFrame, centres: np.ndarray | TwoLevel) -> DataFrame:
    """Add each item's nearest ``cell`` and its distance to that cell's centre; of two levels
    the nearest of the cells in the nearest coarse cell that has any."""
    shared = items.sparkSession.sparkContext.broadcast(centres)  # one row per cell

    def nearest_of(points: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d = _distances(points, rows)
        at = d.argmin(axis=1)
        return at, d[np.arange(len(d)), at]

    def nearest_cell(vectors: pa.Array) -> pa.Array:
        points, given = as_matrix(vectors), shared.value
        if isinstance(given, TwoLevel):
            held = np.unique(given.owner)
            owner = held[nearest_of(points, given.coarse[held])[0]]
            cell, radius = np.zeros(len(points), dtype="int64"), np.zeros(len(points))
            for o in np.unique(owner):
                inside = np.flatnonzero(given.owner == o)
                at, radius[owner == o] = nearest_of(points[owner == o], given.centres[inside])
                cell[owner == o] = inside[at]
        else:
            cell, radius = nearest_of(points, given)
        return pa.StructArray.from_arrays([pa.array(cell.astype("int32")), pa.array(radius)], ["cell", "radius"])

    udf = F.arrow_udf(nearest_cell, "cell int, radius double")
    return items.withColumn("_c", udf("vector")).select(*items.columns, "_c.cell", "_c.radius")


def _with_cell_order(users: DataFrame, centres: np.ndarray) -> DataFrame:
    """Add ``_order``: all cells (cell, to_centre) of a user, nearest first."""
    shared = users.sparkSession.sparkContext.broadcast(centres)

    def order(vectors: pa.Array) -> pa.Array:
        d = _distances(as_matrix(vectors), shared.value)
        ranks = np.argsort(d, axis=1, kind="stable").astype("int32")
        lists = [as_lists(ranks), as_lists(np.take_along_axis(d, ranks, axis=1))]
        return pa.StructArray.from_arrays(lists, ["cell", "to_centre"])

    udf = F.arrow_udf(order, "cell array<int>, to_centre array<double>")
    ordered = users.withColumn("_o", udf("vector"))
    return ordered.select(*users.columns, F.arrays_zip("_o.cell", "_o.to_centre").alias("_order"))


def _probes(users: DataFrame, shared: Broadcast, choose: Callable[..., tuple[np.ndarray, np.ndarray]], cell_type: str = "int") -> DataFrame:
    """(user_id, vector, cell): a row for each cell that ``choose`` names for a user.

    Users are compared with the cells some at a time and rows handed on in bounded batches,
    so no row or array holds all cells of a user.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, USERS_AT_ONCE):
                part = batch.slice(start, USERS_AT_ONCE)
                user, cell = choose(shared.value, part)
                for first in range(0, len(user), EMIT_ROWS):
                    at = pa.array(user[first : first + EMIT_ROWS])
                    yield pa.RecordBatch.from_arrays(
                        [part.column("user_id").take(at), part.column("vector").take(at), pa.array(cell[first : first + EMIT_ROWS].astype("int32"))],
                        names=["user_id", "vector", "cell"])

    return users.mapInArrow(run, f"user_id {_type(users, 'user_id')}, vector {_type(users, 'vector')}, cell {cell_type}")


def _nearest_cells(users: DataFrame, centres: np.ndarray, probes: int) -> DataFrame:
    """(user_id, vector, cell) of each user's ``probes`` nearest cells."""
    def choose(points: np.ndarray, part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        ranks = _nearest_of(as_matrix(part.column("vector")), points, probes)
        return np.repeat(np.arange(len(ranks)), ranks.shape[1]), ranks.ravel()

    return _probes(users, users.sparkSession.sparkContext.broadcast(centres), choose)


def _nearest_in_block(k: int):
    """Top k of a block for each user of a chunk.

    Distances are first estimated by one matrix product; only items within the
    k-th estimate (plus slack) are measured exactly and ranked by (distance, id).
    """

    def kernel(users: pa.Table, items: pa.Table) -> pa.Table:
        out_users, out_items, out_d = [], [], []
        user_column, item_column = users.column("user_id"), items.column("movie_id")
        if users.num_rows and items.num_rows:
            x, u = as_matrix(items.column("vector")), as_matrix(users.column("vector"))
            ids = item_column.to_numpy()
            x_sq, u_sq = (x**2).sum(axis=1), (u**2).sum(axis=1)
            slack = _SLACK * (1.0 + x_sq.max() + u_sq.max())
            for start in range(0, len(u), 128):
                part = slice(start, start + 128)
                estimate = u_sq[part, None] + x_sq - 2.0 * (u[part] @ x.T)
                if k < len(x):
                    limit = np.partition(estimate, k - 1, axis=1)[:, k - 1] + slack
                else:
                    limit = np.full(len(estimate), np.inf)
                for row in range(len(estimate)):
                    near = np.flatnonzero(estimate[row] <= limit[row])
                    d = np.sqrt(((x[near] - u[start + row]) ** 2).sum(axis=1))
                    best = np.lexsort((ids[near], d))[:k]
                    out_users.append(np.full(len(best), start + row))
                    out_items.append(near[best])
                    out_d.append(d[best])
        at = lambda parts: pa.array(np.concatenate(parts) if parts else np.array([], dtype="int64"))
        real = lambda parts: pa.array(np.concatenate(parts) if parts else np.array([]))
        return pa.table({"user_id": user_column.take(at(out_users)), "movie_id": item_column.take(at(out_items)), "distance": real(out_d)})

    return kernel


def _parts(size: int) -> Column:
    return F.ceil(F.count("*") / F.lit(size)).cast("int")


def _each(parts: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), parts - 1))


def _part_of(id_column: str, parts: Column) -> Column:
    return F.pmod(F.xxhash64(id_column), parts.cast("bigint")).cast("int")


def search_cells(probes: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """(user_id, movie_id, distance): per user, the k nearest of every block looked into.

    ``probes`` has user_id, vector, cell; ``items`` has movie_id, vector, cell. Rows are copied
    to every block or chunk of their cell, so this is for cells with one block or one chunk.
    """
    item_cells = items.groupBy("cell").agg(_parts(BLOCK_ITEMS).alias("_blocks"))
    user_cells = probes.groupBy("cell").agg(_parts(CHUNK_USERS).alias("_chunks"))
    layout = item_cells.join(user_cells, "cell")
    chunk, block = _part_of("user_id", F.col("_chunks")), _part_of("movie_id", F.col("_blocks"))
    left = probes.join(layout, "cell").select("cell", _each(F.col("_blocks")).alias("block"), chunk.alias("chunk"), "user_id", "vector")
    right = items.join(layout, "cell").select("cell", block.alias("block"), _each(F.col("_chunks")).alias("chunk"), "movie_id", "vector")
    key = ["cell", "block", "chunk"]
    schema = f"user_id {_type(probes, 'user_id')}, movie_id {_type(items, 'movie_id')}, distance double"
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_nearest_in_block(k), schema)


# ---------------------------------------------------------------- scan


def _as_rows(df: DataFrame, id_column: str, size: int, prefix: str) -> DataFrame:
    """Up to ``size`` rows (id, vector, codes) of a partition as one: number, ids, and codes and vectors as matrices."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, []

        def row(table: pa.Table) -> pa.RecordBatch:
            nonlocal number
            number += 1
            codes, vectors = as_matrix(table.column("codes")).astype("int32"), as_matrix(table.column("vector"))
            ids = pa.array([0, table.num_rows], pa.int32()), table.column(id_column).combine_chunks()
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.ListArray.from_arrays(*ids), pa.array([codes.tobytes()]), pa.array([vectors.tobytes()])],
                names=[f"{prefix}_{c}" for c in ("number", "ids", "codes", "vectors")])

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= size:
                table = pa.Table.from_batches(held)
                while table.num_rows >= size:
                    yield row(table.slice(0, size))
                    table = table.slice(size)
                held = table.to_batches()
        if sum(b.num_rows for b in held):
            yield row(pa.Table.from_batches(held))

    schema = f"{prefix}_number bigint, {prefix}_ids array<{_type(df, id_column)}>, {prefix}_codes binary, {prefix}_vectors binary"
    return df.select(id_column, "vector", "codes").mapInArrow(run, schema)


class _Running:
    """The k nearest so far of each user of a chunk, ranked by (distance, id).

    Distances are first estimated by one matrix product; only items within the k-th
    distance so far or the k-th estimate (plus slack) are measured exactly. These wait
    until there are k per user, on average, and are then merged together.
    """

    def __init__(self, users: np.ndarray, k: int) -> None:
        self.users, self.k = users, k
        self.squares = (users**2).sum(axis=1)
        self.found = np.zeros(len(users), dtype="int64")
        self.limit = np.full(len(users), np.inf)  # the k-th distance, where there are k
        self.distance = np.full((len(users), k), np.inf)
        self.product = np.zeros((len(users), k))
        self.item: np.ndarray | None = None
        self.waiting: list[tuple[np.ndarray, ...]] = []
        self.n_waiting = 0

    def add(self, who: np.ndarray, items: np.ndarray, ids: np.ndarray, alike: Callable[[np.ndarray], np.ndarray] | None = None) -> None:
        """Compare users ``who`` with all items; or with those that ``alike(users)`` marks."""
        squares = (items**2).sum(axis=1)
        slack = _SLACK * (1.0 + squares.max() + self.squares.max())
        step = max(1, SCAN_PAIRS // len(items))
        for start in range(0, len(who), step):
            part = who[start : start + step]
            estimate = self.users[part] @ (-2.0 * items.T)
            estimate += squares
            limit = self.limit[part] ** 2 + slack - self.squares[part]
            match = None if alike is None else alike(part)
            if match is not None:
                estimate[~match] = np.inf
            near = estimate <= limit[:, None]
            many = np.flatnonzero(near.sum(axis=1) > 2 * self.k)
            if len(many):
                kth = np.partition(estimate[many], self.k - 1, axis=1)[:, self.k - 1]
                near[many] = estimate[many] <= np.minimum(limit[many], kth + slack)[:, None]
            if match is not None:
                near &= match
            row, column = np.divmod(np.flatnonzero(near.ravel()), len(items))
            for first in range(0, len(row), EXACT_PAIRS):
                user, item = part[row[first : first + EXACT_PAIRS]], column[first : first + EXACT_PAIRS]
                u, x = self.users[user], items[item]
                self.waiting.append((user, ids[item], np.sqrt(((x - u) ** 2).sum(axis=1)), (x * u).sum(axis=1)))
                self.n_waiting += len(user)
            if self.n_waiting >= self.k * len(self.users):
                self.merge()

    def merge(self) -> None:
        if not self.waiting:
            return
        user, item, distance, product = (np.concatenate(c) for c in zip(*self.waiting))
        self.waiting, self.n_waiting = [], 0
        if self.item is None:
            self.item = np.zeros(self.distance.shape, dtype=item.dtype)
        touched = np.unique(user)
        held = np.arange(self.k) < self.found[touched, None]
        user = np.concatenate([np.repeat(touched, self.found[touched]), user])
        item, distance, product = (
            np.concatenate([old[touched][held], new]) for old, new in ((self.item, item), (self.distance, distance), (self.product, product)))
        order = np.lexsort((item, distance, user))
        user = user[order]
        rank = np.arange(len(user)) - np.searchsorted(user, user)
        kept = rank < self.k
        user, rank, order = user[kept], rank[kept], order[kept]
        self.item[user, rank], self.distance[user, rank], self.product[user, rank] = item[order], distance[order], product[order]
        self.found[touched] = np.bincount(user, minlength=len(self.users))[touched]
        self.limit = np.where(self.found == self.k, self.distance[:, -1], np.inf)


_NO_ID = np.iinfo("int64").min  # stands for a null id, which sorts first


def _ids(column: pa.Array) -> np.ndarray:
    return column.cast("int64").fill_null(_NO_ID).to_numpy() if pa.types.is_integer(column.type) else column.to_numpy(zero_copy_only=False)


def _id_array(ids: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.array(ids, kind, mask=ids == _NO_ID) if pa.types.is_integer(kind) else pa.array(ids, kind)


#: From a scan's shared value and the vectors of a chunk: the cells of each user's first round (users x cells), and the
#: least distance an item of each cell can have, by which a second round takes other cells; None: there is one round.
Choice = Callable[[object, np.ndarray], tuple[np.ndarray, np.ndarray | None]]


def _scan(users: DataFrame, items: DataFrame, k: int, shared: Broadcast | None = None, choose: Choice | None = None, rounds: int = 1) -> DataFrame:
    """(user_id, movie_id, distance, product): the k nearest of each user among the items compared.

    ``users`` has user_id, vector and codes; ``items`` has movie_id, vector and codes. With
    ``choose`` the one code of an item is its cell; without it, codes are buckets (0: none), and
    users are compared with the items that have one of theirs in the same place. Each task holds a chunk of users and reads every sheet once in each round.
    """
    spark = items.sparkSession
    sheets = stage(_as_rows(items.orderBy("codes", "movie_id"), "movie_id", SHEET_ITEMS, "sheet"), "sheets")
    users = stage(users.select("user_id", "vector", "codes"), "scan-users")
    n_users = users.count()
    size = min(SCAN_USERS, max(64, -(-n_users // (SCAN_TASKS * spark.sparkContext.defaultParallelism))))
    chunks = _as_rows(users.repartition(max(1, -(-n_users // size))), "user_id", 2 * SCAN_USERS, "chunk")
    read = [sheets.withColumn("round", F.lit(r)) for r in range(rounds)]
    left = read[0] if rounds == 1 else read[0].unionByName(read[1])
    pairs = left.coalesce(1).hint("shuffle_replicate_nl").crossJoin(chunks)  # a task per chunk, past which the sheets are read

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}
        kind = None
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda name: batch.column(name)[i]  # noqa: B023, E731
                number = get("chunk_number").as_py()
                if number not in held:
                    ids = get("chunk_ids").values
                    vectors = np.frombuffer(get("chunk_vectors").as_buffer()).reshape(len(ids), -1).copy()
                    codes = np.frombuffer(get("chunk_codes").as_buffer(), dtype="int32").reshape(len(ids), -1).copy()
                    held[number] = ids, codes, _Running(vectors, k), None if choose is None else choose(shared.value, vectors)
                _, codes, running, chosen = held[number]
                listed = get("sheet_ids").values
                kind, ids = listed.type, _ids(listed)
                vectors = np.frombuffer(get("sheet_vectors").as_buffer()).reshape(len(ids), -1)
                marks = np.frombuffer(get("sheet_codes").as_buffer(), dtype="int32").reshape(len(ids), -1)
                if chosen is None:
                    _add_alike(running, codes, vectors, marks, ids)
                else:
                    _add_cells(running, *chosen, get("round").as_py(), vectors, marks[:, 0], ids)
        for ids, _, running, _ in held.values():
            running.merge()
            row, rank = np.nonzero(np.arange(k) < running.found[:, None])
            for first in range(0, len(row), EXACT_PAIRS):
                at = row[first : first + EXACT_PAIRS], rank[first : first + EXACT_PAIRS]
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(at[0])), _id_array(running.item[at], kind), pa.array(running.distance[at]), pa.array(running.product[at])],
                    names=["user_id", "movie_id", "distance", "product"])

    return pairs.mapInArrow(run, f"user_id {_type(users, 'user_id')}, movie_id {_type(items, 'movie_id')}, distance double, product double")


def _add_cells(running: _Running, first: np.ndarray, bound: np.ndarray | None, number: int, items: np.ndarray, cells: np.ndarray, ids: np.ndarray) -> None:
    """A sheet, cell by cell: in round 0 for the users that chose the cell, in round 1 for
    others to whom its bound leaves it open."""
    edges = np.flatnonzero(np.diff(cells, prepend=cells[0] - 1, append=cells[-1] + 1))  # a sheet is in order of cells
    for start, end in zip(edges, edges[1:]):
        wanted = first[:, cells[start]]
        if number:
            wanted = ~wanted & (bound[:, cells[start]] <= running.limit + _SLACK)
        who = np.flatnonzero(wanted)
        if len(who):
            running.add(who, items[start:end], ids[start:end])


def _add_alike(running: _Running, codes: np.ndarray, items: np.ndarray, marks: np.ndarray, ids: np.ndarray) -> None:
    marks = np.where(marks == 0, -1, marks)  # no bucket is like no bucket

    def alike(part: np.ndarray) -> np.ndarray:
        match = np.zeros((len(part), len(marks)), dtype=bool)
        for t in range(marks.shape[1]):
            match |= codes[part, t, None] == marks[:, t]
        return match

    touched = np.zeros(len(codes), dtype=bool)
    for t in range(marks.shape[1]):
        touched |= np.isin(codes[:, t], marks[:, t])
    who = np.flatnonzero(touched)
    if len(who):
        running.add(who, items, ids, alike)


def _nearest_of(points: np.ndarray, centres: np.ndarray, probes: int) -> np.ndarray:
    """Per point, its ``probes`` nearest centres, nearest first."""
    return np.argsort(_distances(points, centres), axis=1, kind="stable")[:, :probes]


def _by_probes(probes: int) -> Choice:
    """Of the shared centres, each user's ``probes`` nearest."""
    def choose(centres: np.ndarray, users: np.ndarray) -> tuple[np.ndarray, None]:
        first = np.zeros((len(users), len(centres)), dtype=bool)
        for start in range(0, len(users), USERS_AT_ONCE):
            part = slice(start, start + USERS_AT_ONCE)
            np.put_along_axis(first[part], _nearest_of(users[part], centres, probes), True, axis=1)
        return first, None

    return choose


def _by_bounds(probes: int) -> Choice:
    """First the packs that hold a user's ``probes`` nearest cells, then all others by their bound.

    No item of a cell is nearer to the user than the cell's bound. Shared: centres, pack
    number of each cell (-1: empty), and the least and the largest distance of its items.
    """
    def choose(given: tuple, users: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        centres, pack, low, high = given
        held = np.flatnonzero(pack >= 0)
        starts = np.flatnonzero(np.diff(pack[held], prepend=-1))  # packs are in order of cells
        first = np.zeros((len(users), len(starts)), dtype=bool)
        bound = np.zeros((len(users), len(starts)))
        for start in range(0, len(users), USERS_AT_ONCE):
            part = slice(start, start + USERS_AT_ONCE)
            away = _distances(users[part], centres[held])
            near = np.argsort(away, axis=1, kind="stable")[:, :probes]
            np.put_along_axis(first[part], pack[held][near], True, axis=1)
            bound[part] = np.minimum.reduceat(np.maximum(np.maximum(away - high[held], low[held] - away), 0.0), starts, axis=1)
        return first, bound

    return choose


def _type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def nearest(found: DataFrame, k: int) -> DataFrame:
    """The k nearest per user, ranked; each task passes on at most k rows per user."""
    order = F.row_number().over(W.partitionBy("user_id").orderBy("distance", "movie_id"))
    return found.withColumn("rank", order).filter(F.col("rank") <= k)


def _check_k(k: int) -> None:
    if k <= 0:
        raise ValueError("k must be positive")


def tuned_probes(users: DataFrame, items: DataFrame, k: int, cells: np.ndarray | TwoLevel, recall: float = RECALL + MARGIN) -> tuple[int, float]:
    """(probes, their recall on a sample of users): the fewest cells that hold the share
    ``recall`` of the k nearest.

    For each of ``SAMPLE_USERS`` users in hash order, the place in the user's order of
    cells is found for the cell of every item that the exact search returns; the probes
    are a quantile of these places, so they grow with the number of cells.
    """
    sample = users.select("user_id", "vector").orderBy(F.xxhash64("user_id"), "user_id").limit(SAMPLE_USERS)
    sample = stage(sample, "sample-users")
    centres = _all_centres(cells)
    true = top_k_exact(sample, items, k, centres=centres).select("user_id", "movie_id")
    celled = assign_cells(items.select("movie_id", "vector"), cells).select("movie_id", "cell")
    ordered = _with_cell_order(sample, centres).select("user_id", F.posexplode("_order.cell").alias("at", "cell"))
    places = true.join(celled, "movie_id").join(ordered, ["user_id", "cell"]).groupBy("at").agg(F.count("*").alias("n")).orderBy("at").collect()
    total, found = sum(r["n"] for r in places), 0  # a row per place at most, so no more than cells
    for r in places:
        found += r["n"]
        if found >= recall * total:
            return r["at"] + 1, found / total
    return len(centres), 1.0


def recall_of(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row (users, wanted, found, recall): the share of the ``exact`` (user_id, movie_id) that was ``found``."""
    hits = exact.select("user_id", "movie_id").join(
        found.select("user_id", "movie_id", F.lit(1).alias("_hit")), ["user_id", "movie_id"], "left")
    return hits.agg(
        F.count_distinct("user_id").alias("users"), F.count("*").alias("wanted"), F.count("_hit").alias("found"),
        F.try_divide(F.count("_hit"), F.count("*")).alias("recall"))


def top_k_by_cells(users: DataFrame, items: DataFrame, k: int, probes: int | None = None, centres: np.ndarray | TwoLevel | None = None) -> DataFrame:
    """Approximate top k: only the ``probes`` nearest cells of each user are searched.

    Without ``probes`` their number is tuned on a sample of the users until recall is
    ``RECALL``.
    """
    _check_k(k)
    cells = fit_two_level(items) if centres is None else centres
    probes = tuned_probes(users, items, k, cells)[0] if probes is None else probes
    celled = assign_cells(items.select("movie_id", "vector"), cells)
    shared = items.sparkSession.sparkContext.broadcast(_all_centres(cells))  # one row per cell
    found = _scan(_without_codes(users), celled.withColumn("codes", F.array("cell")), k, shared, _by_probes(probes))
    return nearest(found.drop("product"), k)


def _without_codes(users: DataFrame) -> DataFrame:
    return users.select("user_id", "vector", F.array(F.lit(0)).alias("codes"))


def _all_centres(cells: np.ndarray | TwoLevel) -> np.ndarray:
    return cells.centres if isinstance(cells, TwoLevel) else cells


def _packs(sizes: dict[int, int], cells: int, block_items: int) -> np.ndarray:
    """Cells put together until they fill a block: pack number per cell, -1 for an empty cell."""
    packs, pack, filled = np.full(cells, -1), 0, 0
    for cell in sorted(sizes):
        if filled and filled + sizes[cell] > block_items:
            pack, filled = pack + 1, 0
        packs[cell] = pack
        filled += sizes[cell]
    return packs


def top_k_exact(
    users: DataFrame, items: DataFrame, k: int, probes: int = PROBES, centres: np.ndarray | None = None,
    block_items: int = BLOCK_ITEMS, with_product: bool = False,
) -> DataFrame:
    """Exact top k, by one way at every size; ``with_product`` adds the inner product of the vectors.

    The packs holding a user's nearest cells are searched first; the k-th distance
    found so far then rules out every other pack that the triangle inequality puts
    farther away. Without given centres, items in hash order serve: bounds hold for any.
    """
    _check_k(k)
    users, items = users.select("user_id", "vector"), items.select("movie_id", "vector")
    centres = pick_centres(items) if centres is None else centres
    if not len(centres):
        schema = f"user_id {_type(users, 'user_id')}, movie_id {_type(items, 'movie_id')}, distance double{', product double' if with_product else ''}"
        return nearest(items.sparkSession.createDataFrame([], schema), k)
    celled = stage(assign_cells(items, centres), "celled-items")
    stats = celled.groupBy("cell").agg(F.count("*").alias("n"), F.max("radius").alias("far"), F.min("radius").alias("near")).collect()
    packs = _packs({r["cell"]: r["n"] for r in stats}, len(centres), block_items)  # one row per cell
    far, near = np.full(len(centres), -np.inf), np.full(len(centres), np.inf)
    for r in stats:
        far[r["cell"]], near[r["cell"]] = r["far"], r["near"]
    numbers = items.sparkSession.sparkContext.broadcast(packs.astype("int32"))
    pack_of = F.arrow_udf(lambda cell: pa.array(numbers.value[cell.to_numpy()]), "int")
    packed = celled.select("movie_id", "vector", F.array(pack_of("cell")).alias("codes"))
    shared = items.sparkSession.sparkContext.broadcast((centres, packs, near, far))  # one row per cell
    found = _scan(_without_codes(users), packed, k, shared, _by_bounds(probes), rounds=2)
    return nearest(found if with_product else found.drop("product"), k)


def top_k_by_hash(
    users: DataFrame, items: DataFrame, k: int, tables: int = 4, bucket_length: float = 1.0, seed: int = 42
) -> DataFrame:
    """Approximate top k among items sharing a random-projection bucket with the user."""
    _check_k(k)

    def as_points(df: DataFrame, id_column: str) -> DataFrame:
        vector = array_to_vector(F.col("vector").cast("array<double>"))
        return df.select(id_column, "vector", vector.alias("features"))

    points = as_points(items, "movie_id")
    lsh = BucketedRandomProjectionLSH(
        inputCol="features", outputCol="hashes", bucketLength=bucket_length, numHashTables=tables, seed=seed
    ).fit(points)

    def bucketed(df: DataFrame, id_column: str) -> DataFrame:
        buckets = F.array(*[F.get(vector_to_array(F.get("hashes", F.lit(t))), F.lit(0)).cast("bigint") for t in range(tables)])
        return stage(lsh.transform(df).select(id_column, "vector", buckets.alias("buckets")), "hashed")

    def sizes(df: DataFrame) -> DataFrame:
        return df.select(F.posexplode("buckets").alias("table", "bucket")).groupBy("table", "bucket").agg(F.count("*").alias("n"))

    hashed_users, hashed_items = bucketed(as_points(users, "user_id"), "user_id"), bucketed(points, "movie_id")
    both = sizes(hashed_items).filter(F.col("n") > BLOCK_ITEMS).join(sizes(hashed_users).filter(F.col("n") > CHUNK_USERS), ["table", "bucket"])
    large: list[list[int]] = [[] for _ in range(tables)]
    for r in both.select("table", "bucket").orderBy("table", "bucket").collect():  # at most a row per table and block of items
        large[r["table"]].append(r["bucket"])
    place = lambda t: F.array_position(F.array(*[F.lit(b) for b in large[t]]).cast("array<bigint>"), F.get("buckets", F.lit(t))).cast("int")
    codes = F.array(*[place(t) for t in range(tables)]).alias("codes")  # 0: a bucket that is small on one side

    def joined(df: DataFrame, id_column: str) -> DataFrame:
        rows = df.select(id_column, "vector", F.posexplode(F.arrays_zip("buckets", codes)).alias("table", "_b")).filter("_b.codes = 0")
        return rows.select(id_column, "vector", F.concat_ws(":", "table", "_b.buckets").alias("cell"))

    def scanned(df: DataFrame, id_column: str) -> DataFrame:
        return df.select(id_column, "vector", codes).filter(F.exists("codes", lambda c: c > 0)).distinct()

    found = search_cells(joined(hashed_users, "user_id"), joined(hashed_items, "movie_id"), k)
    if any(large):
        found = found.unionByName(_scan(scanned(hashed_users, "user_id"), scanned(hashed_items, "movie_id"), k).drop("product"))
    return nearest(found.distinct(), k)


# ---------------------------------------------------------------- diversity


def mmr_rerank(candidates: DataFrame, users: DataFrame, items: DataFrame, k: int, weight: float = 0.5) -> DataFrame:
    """Re-rank each user's candidates by ``weight * relevance - (1 - weight) * closest chosen``.

    ``candidates`` (user_id, movie_id, rank) is the bounded pool kept by a search,
    a few times k rows per user. Choosing is sequential within a user, and users
    run apart.
    """
    candidates = stage(candidates.select("user_id", "movie_id", "rank"), "mmr-pool")  # read three times
    chunks = -(-candidates.agg(F.count_distinct("user_id")).first()[0] // CHUNK_USERS) or 1
    chunk = F.pmod(F.xxhash64("user_id"), F.lit(chunks)).alias("chunk")
    pools = candidates.select("user_id", "movie_id", "rank", chunk).join(items.select("movie_id", "vector"), "movie_id")
    asked = candidates.select("user_id").distinct().join(users.select("user_id", "vector"), "user_id").select(
        F.col("user_id").alias("of"), F.col("vector").alias("own"), chunk.alias("of_chunk"))  # no name or origin shared with the pools
    schema = f"user_id {_type(candidates, 'user_id')}, movie_id {_type(candidates, 'movie_id')}, position int, mmr double"

    def rerank(pool: pa.Table, of: pa.Table) -> pa.Table:
        pool = pool.sort_by([("user_id", "ascending"), ("rank", "ascending")])
        vectors = as_matrix(pool.column("vector")) if pool.num_rows else np.zeros((0, 0))
        own = dict(zip(of.column("of").to_pylist(), as_matrix(of.column("own")) if of.num_rows else ()))
        ids = pool.column("user_id").to_pylist()
        edges = [0, *(i for i in range(1, len(ids)) if ids[i] != ids[i - 1]), len(ids)]
        at, position, scores = [], [], []
        for first, end in zip(edges, edges[1:]):
            if end > first and ids[first] in own:
                chosen, values = mmr_order(own[ids[first]], vectors[first:end], k, weight)
                at += [first + c for c in chosen]
                position += range(1, len(chosen) + 1)
                scores += values
        taken = pool.select(["user_id", "movie_id"]).take(pa.array(at, pa.int64()))
        return taken.append_column("position", pa.array(position, pa.int32())).append_column("mmr", pa.array(scores, pa.float64()))

    return pools.groupBy("chunk").cogroup(asked.groupBy("of_chunk")).applyInArrow(rerank, schema)


def mmr_order(user: np.ndarray, pool: np.ndarray, k: int, weight: float) -> tuple[list[int], list[float]]:
    """Indexes in order of choice, and the score each was chosen at."""
    lengths = np.linalg.norm(pool, axis=1)
    relevance = pool @ user / (lengths * np.linalg.norm(user) + 1e-8)
    closest = np.full(len(pool), -np.inf)
    score = relevance.copy()
    chosen: list[int] = []
    scores: list[float] = []
    while len(chosen) < min(k, len(pool)):
        pick = int(np.argmax(score))
        chosen.append(pick)
        scores.append(float(score[pick]))
        closest = np.maximum(closest, pool @ pool[pick] / (lengths * lengths[pick] + 1e-8))
        score = weight * relevance - (1.0 - weight) * closest
        score[chosen] = -np.inf
    return chosen, scores


# ---------------------------------------------------------------- storage


def save_vectors(items: DataFrame, centres: np.ndarray, path: str) -> None:
    """Vectors with their cell, partitioned by cell, and the table of cell centres."""
    celled = assign_cells(items.select("movie_id", "vector"), centres).drop("radius")
    celled.hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(f"{path}/vectors")
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(centres)]
    items.sparkSession.createDataFrame(rows, "cell int, centre array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/centres")


def load_vectors(spark: SparkSession, path: str) -> tuple[DataFrame, np.ndarray]:
    """(items with their cell, cell centres)."""
    rows = spark.read.parquet(f"{path}/centres").orderBy("cell").collect()  # one row per cell
    return spark.read.parquet(f"{path}/vectors"), np.array([r["centre"] for r in rows])


def vector_stats(items: DataFrame, probes: int = PROBES) -> DataFrame:
    """Number of vectors, their dimension, and the cells and probes a search would use."""
    stats = items.agg(F.count("*").alias("vectors"), F.max(F.size("vector")).alias("dimension"))
    cells = F.greatest(F.lit(1), F.floor(F.sqrt("vectors"))).cast("int")
    return stats.withColumn("cells", cells).withColumn("probes", F.lit(probes))


def cell_sizes(celled: DataFrame) -> DataFrame:
    return celled.groupBy("cell").agg(F.count("*").alias("items"))
