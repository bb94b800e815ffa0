"""Best-fit packing of tokenised documents by a grouping genetic algorithm.

Documents are encoded once and cut into pieces of at most ``capacity`` tokens. Full
pieces are sequences as they are. All others are dealt by hash to shards of about
``SHARD_PIECES``, small enough to be solved in one task and large enough to lose next
to nothing at the shard's edge. A shard is solved by several islands, each one task
with a population of its own: crossover ranks the bins of one parent by fill and puts the
best into the other, removes the bins that held their pieces before, and exchanges the
displaced pieces with one or two of an open bin's wherever that fills it better; what is
still displaced is placed by best fit, largest first. After each epoch the best solution of an island
moves to the next one. Islands are rows of a staged table, so a lost executor repeats
one island's epoch and nothing else. A shard stops when it reaches its lower bound.

Defined cases: a null text is empty and becomes a piece that holds the end token alone;
rows that repeat are packed each; pieces of equal length are interchangeable, and which one
goes where depends on their order in the written table; very long texts become many pieces;
an empty table gives no rows. ``pack`` replaces input columns named ``sequence_id``,
``offset`` or ``_unit``.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.tokens import default_path, encoder
from tidemark.session import Scratch

CAPACITY = 1_024
END_ID = 2
SHARD_PIECES = 4_096
ISLANDS = 2
EPOCHS = 2
POPULATION = 4
CHILDREN = 8
OPEN_SHARE, FULL_SHARE = 0.5, 0.02  # of bins that a mutation dissolves
ROUNDS = 4  # of exchanges over all open bins
SEED = 5

Bins = list[list[int]]  # each bin: its pieces' places in the shard


def cut_pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): one row per piece of every document."""
    path = path or default_path()
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        for batch in batches:
            at, piece, starts, lengths, sums = [], [], [], [], []
            for row, text in enumerate(batch.column("text")):
                ids = np.append(tool.ids(text.as_py() or ""), np.uint32(END_ID)).astype("<u4")
                first = len(ids) % capacity or capacity
                edges = [0, *range(first, len(ids) + 1, capacity)]
                raw = ids.tobytes()
                for i, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                    at.append(row), piece.append(i), starts.append(a), lengths.append(b - a)
                    sums.append(zlib.crc32(raw[4 * a : 4 * b]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()),
                 *(pa.array(x, pa.int64()) for x in (starts, lengths, sums))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


class Shop:
    """Best-fit placing into open bins by the room they have left."""

    def __init__(self, sizes: list[int], capacity: int, bins: Bins = ()) -> None:
        self.sizes, self.capacity = sizes, capacity
        self.bins: Bins = [list(b) for b in bins]
        self.by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.rooms = 0  # bit r is set if a bin has room r
        for n, b in enumerate(self.bins):
            self._open(n, capacity - sum(sizes[i] for i in b))

    def _open(self, n: int, room: int) -> None:
        if room:
            self.by_room[room].append(n)
            self.rooms |= 1 << room

    def place(self, pieces: list[int]) -> Bins:
        for i in pieces:
            size = self.sizes[i]
            fits = self.rooms >> size
            if fits:
                room = size + (fits & -fits).bit_length() - 1
                n = self.by_room[room].pop()
                if not self.by_room[room]:
                    self.rooms ^= 1 << room
                self.bins[n].append(i)
                self._open(n, room - size)
            else:
                self.bins.append([i])
                self._open(len(self.bins) - 1, self.capacity - size)
        return self.bins


def fitness(bins: Bins, sizes: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then fuller ones: room gathered in few bins can still be used."""
    return -len(bins), sum((sum(sizes[i] for i in b) / capacity) ** 2 for b in bins)


def lower_bound(sizes: list[int], capacity: int) -> int:
    return max(-(-sum(sizes) // capacity), sum(2 * s > capacity for s in sizes))


class Pool:
    """Pieces without a bin, by size; bit s of ``sizes`` is set if there is one of size s."""

    def __init__(self, pieces: list[int], sizes: list[int]) -> None:
        self.of, self.by_size, self.sizes, self.pairs = sizes, {}, 0, None
        for i in pieces:
            self.add(i)

    def add(self, i: int) -> None:
        self.by_size.setdefault(self.of[i], []).append(i)
        self.sizes |= 1 << self.of[i]

    def take(self, size: int) -> int:
        held = self.by_size[size]
        i = held.pop()
        if not held:
            self.sizes ^= 1 << size
        return i

    def largest(self, limit: int) -> int:
        """Size of the largest piece up to ``limit``; 0 if none."""
        return max((self.sizes & ((2 << limit) - 1)).bit_length() - 1, 0)

    def two(self, total: int) -> tuple[int, int] | None:
        """Sizes of two pieces of ``total`` together."""
        if self.pairs is None:
            self.pairs = 0
            for size in self.by_size:
                self.pairs |= self.sizes << size
        if self.pairs >> total & 1:
            for size, held in self.by_size.items():
                other = total - size
                if held and other > 0 and self.sizes >> other & 1 and (other != size or len(held) > 1):
                    return size, other
        return None

    def pieces(self) -> list[int]:
        return sorted((i for held in self.by_size.values() for i in held), key=lambda i: -self.of[i])


def exchange(bins: Bins, pieces: list[int], sizes: list[int], capacity: int, rounds: int = ROUNDS) -> Bins:
    """``pieces`` put into ``bins``, each open bin filled better by what it can get for one
    or two of its own; the pool shrinks by every gain. Pieces left are placed by best fit."""
    pool = Pool(pieces, sizes)
    room = [capacity - sum(sizes[i] for i in b) for b in bins]
    for _ in range(rounds):
        pool.pairs, gained = None, 0
        for n, b in enumerate(bins):
            if not room[n] or not pool.sizes:
                continue
            r = room[n]
            best, out = pool.largest(r), ()
            for x, i in enumerate(b):
                if best == r:
                    break
                for given in ((i,), *((i, j) for j in b[x + 1 :])):
                    size = sum(sizes[g] for g in given)
                    gain = pool.largest(size + r) - size
                    if gain > best:
                        best, out = gain, given
            got = (best + sum(sizes[g] for g in out),) if best > 0 else ()
            if best < r:  # two for one, if they fill the bin
                for i in b:
                    two = pool.two(sizes[i] + r)
                    if two:
                        best, out, got = r, (i,), two
                        break
            if best <= 0:
                continue
            b = [i for i in b if i not in out] + [pool.take(size) for size in got]
            for i in out:
                pool.add(i)
            bins[n], room[n] = b, r - best
            gained += best
        if not gained:
            break
    return Shop(sizes, capacity, bins).place(pool.pieces())


def crossover(host: Bins, donor: Bins, sizes: list[int], capacity: int, rng: random.Random) -> Bins:
    """The fullest bins of ``donor``, some left out by chance, put into ``host``."""
    ranked = sorted(donor, key=lambda b: (-sum(sizes[i] for i in b), rng.random()))
    share = rng.uniform(0.2, 0.6)
    injected = [b for b in ranked[: int(len(donor) * share) + 1] if rng.random() < 0.8]
    inside = {i for b in injected for i in b}
    kept, displaced = [], []
    for b in host:
        if inside.isdisjoint(b):
            kept.append(b)
        else:
            displaced += [i for i in b if i not in inside]
    return exchange([*kept, *injected], displaced, sizes, capacity)


def mutation(bins: Bins, sizes: list[int], capacity: int, rng: random.Random) -> Bins:
    """The emptiest bin, half of the other open ones and a few full ones are dissolved and
    their pieces exchanged, so that the room of many open bins gathers in fewer."""
    room = [capacity - sum(sizes[i] for i in b) for b in bins]
    emptiest = max(range(len(bins)), key=room.__getitem__)
    gone = {n for n, r in enumerate(room) if n == emptiest or rng.random() < (OPEN_SHARE if r else FULL_SHARE)}
    pieces = [i for n in gone for i in bins[n]]
    return exchange([b for n, b in enumerate(bins) if n not in gone], pieces, sizes, capacity)


def first_population(sizes: list[int], capacity: int, n: int, rng: random.Random) -> list[Bins]:
    """Best fit of the pieces largest first, and of slightly disturbed orders."""
    made = []
    for k in range(n):
        order = sorted(range(len(sizes)), key=lambda i: -sizes[i] * (1 + k * 0.05 * rng.random()))
        made.append(Shop(sizes, capacity).place(order))
    return made


def evolve(population: list[Bins], sizes: list[int], capacity: int, children: int, rng: random.Random) -> list[Bins]:
    """One epoch of an island; the population that comes back has the best first."""
    least = lower_bound(sizes, capacity)
    score = lambda b: fitness(b, sizes, capacity)
    ranked = sorted(((score(b), n, b) for n, b in enumerate(population)), reverse=True)
    for n in range(children):
        if len(ranked[0][2]) <= least or len(ranked) < 2:
            break
        a, b = (min(rng.randrange(len(ranked)), rng.randrange(len(ranked))) for _ in range(2))
        b = b if a != b else (a + 1) % len(ranked)
        child = crossover(ranked[a][2], ranked[b][2], sizes, capacity, rng)
        if rng.random() < 0.5:
            child = mutation(child, sizes, capacity, rng)
        ranked = sorted([*ranked, (score(child), len(population) + n, child)], reverse=True)[: len(population)]
    return [b for _, _, b in ranked]


def _to_array(bins: Bins, n: int) -> np.ndarray:
    """The bin of each piece."""
    at = np.zeros(n, dtype="<i4")
    for k, b in enumerate(bins):
        at[b] = k
    return at


def _to_bins(at: np.ndarray) -> Bins:
    order = np.argsort(at, kind="stable")
    return [part.tolist() for part in np.split(order, np.flatnonzero(np.diff(at[order])) + 1)] if len(at) else []


STATE = "shard bigint, island int, units array<bigint>, sizes array<int>, population array<binary>, n_bins int"


def _epoch(states: DataFrame, capacity: int, children: int, size: int, seed: int) -> DataFrame:
    """Every island goes on from its population; one without any begins it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                rng = random.Random(f"{seed}:{row['shard']}:{row['island']}")
                sizes = row["sizes"]
                population = [_to_bins(np.frombuffer(p, "<i4")) for p in row["population"] or []]
                if not population:
                    population = first_population(sizes, capacity, size, rng)
                population = evolve(population, sizes, capacity, children, rng)[:size]
                rows.append(row | {"population": [_to_array(b, len(sizes)).tobytes() for b in population], "n_bins": len(population[0])})
            yield pa.RecordBatch.from_pylist(rows, schema=_STATE_ARROW)

    return states.mapInArrow(run, STATE)


_STATE_ARROW = pa.schema([
    ("shard", pa.int64()), ("island", pa.int32()), ("units", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())),
    ("population", pa.list_(pa.binary())), ("n_bins", pa.int32()),
])


def _migrate(states: DataFrame, islands: int) -> DataFrame:
    """Each island's best solution is added to the next island of its shard."""
    elite = states.select(
        "shard", ((F.col("island") + 1) % islands).alias("island"), F.slice("population", 1, 1).alias("guest")
    )
    return states.join(elite, ["shard", "island"]).select(
        "shard", "island", "units", "sizes", F.concat("population", "guest").alias("population"), "n_bins"
    )


def pack(
    pieces: DataFrame,
    capacity: int = CAPACITY,
    shard_pieces: int = SHARD_PIECES,
    islands: int = ISLANDS,
    epochs: int = EPOCHS,
    population: int = POPULATION,
    children: int = CHILDREN,
    seed: int = SEED,
) -> DataFrame:
    """``pieces`` (with ``length``) with sequence_id and offset."""
    scratch = Scratch(pieces.sparkSession, "pack")
    columns = [c for c in pieces.columns if c not in ("sequence_id", "offset", "_unit")]
    units = scratch.put(pieces.select(*columns, F.monotonically_increasing_id().alias("_unit")), "units")  # fixed once written
    open_units = units.filter(F.col("length") < capacity)
    shards = -(-open_units.count() // shard_pieces) or 1
    dealt = open_units.select(
        "_unit", F.col("length").cast("int").alias("length"), F.pmod(F.xxhash64("_unit", F.lit(seed)), F.lit(shards)).alias("shard")
    )

    def gather(table: pa.Table) -> pa.Table:
        table = table.sort_by("_unit")
        one = {"units": pa.array([table.column("_unit").to_numpy()], pa.list_(pa.int64())),
               "sizes": pa.array([table.column("length").to_numpy()], pa.list_(pa.int32()))}
        return pa.table({"shard": table.column("shard").slice(0, 1), **one})

    filled = dealt.groupBy("shard").applyInArrow(gather, "shard bigint, units array<bigint>, sizes array<int>")
    states = filled.select(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), "units", "sizes",
        F.array().cast("array<binary>").alias("population"), F.lit(0).alias("n_bins"),
    )
    for epoch in range(epochs):
        spread = states.repartition(F.col("shard"), F.col("island"))
        states = scratch.put(_epoch(spread, capacity, children, population, seed + epoch), f"epoch{epoch}")
        if epoch + 1 < epochs:
            states = _migrate(states, islands)
    best = states.groupBy("shard").agg(
        F.min_by(F.struct("units", "sizes", F.element_at("population", 1).alias("bins")), F.struct("n_bins", "island")).alias("best")
    ).select("shard", "best.*")

    def lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, sizes = (np.array(batch.column(c)[row].values, dtype="int64") for c in ("units", "sizes"))
                at = np.frombuffer(batch.column("bins")[row].as_py(), "<i4").astype("int64")
                order = np.argsort(at, kind="stable")
                before = np.concatenate([[0], np.cumsum(sizes[order])[:-1]])
                first = np.searchsorted(at[order], at[order])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[order]), pa.array((batch.column("shard")[row].as_py() << 32) + at[order]),
                     pa.array(before - before[first])], names=["_unit", "sequence_id", "offset"],
                )

    placed = best.mapInArrow(lay_out, "_unit bigint, sequence_id bigint, offset bigint")
    full = units.filter(F.col("length") >= capacity).select(
        *columns, (-F.col("_unit") - 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    return full.unionByName(units.join(placed, "_unit").select(*columns, "sequence_id", "offset"))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, **settings: int) -> DataFrame:
    """Every document of ``docs`` in packed sequences: one row per piece."""
    return pack(cut_pieces(docs, capacity, path), capacity, **settings)
