"""Vector search and recommendation lists against brute force, with hot cells."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import recommend, retrieval
from tidemark.operators.served import ServedLists

DIM = 8


def table(spark, id_column, rows):
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in rows], f"{id_column} bigint, vector array<double>")


@pytest.fixture(scope="module")
def vectors():
    """300 items, a third of them copies of one point, and 40 users, half of them at that point."""
    rng = np.random.default_rng(4)
    items = rng.normal(size=(300, DIM))
    items[::3] = items[0]
    users = rng.normal(size=(40, DIM))
    users[::2] = items[0] + rng.normal(scale=0.01, size=(20, DIM))
    return users, items


@pytest.fixture
def frames(spark, vectors):
    users, items = vectors
    return table(spark, "user_id", enumerate(users)), table(spark, "movie_id", enumerate(items))


def brute(users, items, k):
    out = {}
    for u, vector in enumerate(users):
        d = np.sqrt(((items - vector) ** 2).sum(axis=1))
        out[u] = list(np.lexsort((np.arange(len(items)), d))[:k])
    return out


def lists(df):
    got = {}
    for r in df.collect():
        got.setdefault(r["user_id"], {})[r["rank"]] = r["movie_id"]
    return {u: [ranks[i + 1] for i in range(len(ranks))] for u, ranks in got.items()}


def small_blocks(monkeypatch):
    monkeypatch.setattr(retrieval, "BLOCK_ITEMS", 16)
    monkeypatch.setattr(retrieval, "CHUNK_USERS", 6)


def test_exact_equals_brute_force(frames, vectors, monkeypatch):
    small_blocks(monkeypatch)
    users, items = frames
    assert lists(retrieval.top_k_exact(users, items, 7, probes=2)) == brute(*vectors, 7)


def test_exact_with_fewer_items_than_k(spark, frames, vectors):
    users, items = frames
    few = items.filter("movie_id < 4")
    assert lists(retrieval.top_k_exact(users, few, 7)) == brute(vectors[0], vectors[1][:4], 7)


def test_cells_find_most_and_only_real_neighbours(frames, vectors, monkeypatch):
    small_blocks(monkeypatch)
    users, items = frames
    got, want = lists(retrieval.top_k_by_cells(users, items, 5, probes=10)), brute(*vectors, 5)
    assert sum(len(set(got[u]) & set(want[u])) for u in want) / (5 * len(want)) > 0.8
    everything = retrieval.top_k_by_cells(users, items, 5, probes=100)
    assert lists(everything) == want


def test_tuned_probes_keep_recall_as_cells_grow(spark):
    rng = np.random.default_rng(8)
    users, items = rng.normal(size=(40, 32)), rng.normal(size=(2500, 32))
    frames = table(spark, "user_id", enumerate(users)), table(spark, "movie_id", enumerate(items))
    exact = retrieval.top_k_exact(*frames, 5)
    assert lists(exact) == brute(users, items, 5)
    row = retrieval.recall_of(retrieval.top_k_by_cells(*frames, 5), exact).first()
    assert (row["users"], row["wanted"]) == (40, 200) and row["recall"] >= 0.9
    centres = retrieval.fit_cells(frames[1])
    fixed = retrieval.recall_of(retrieval.top_k_by_cells(*frames, 5, retrieval.PROBES, centres), exact).first()["recall"]
    probes, reached = retrieval.tuned_probes(*frames, 5, centres)
    assert fixed < 0.9 <= reached and retrieval.PROBES < probes < len(centres) == 50


def test_hash_buckets_find_the_own_point(frames, vectors, monkeypatch):
    small_blocks(monkeypatch)
    users, items = frames
    got, want = lists(retrieval.top_k_by_hash(users, items, 5, tables=6, bucket_length=3.0)), brute(*vectors, 5)
    assert sum(len(set(got.get(u, [])) & set(want[u])) for u in want) / (5 * len(want)) > 0.8
    assert all(len(set(v)) == len(v) for v in got.values())


def test_no_task_gets_more_than_a_block_and_a_chunk(frames, monkeypatch):
    small_blocks(monkeypatch)
    users, items = frames
    centres = retrieval.fit_cells(items)
    celled = retrieval.assign_cells(items, centres)
    assert retrieval.cell_sizes(celled).agg(F.max("items")).first()[0] >= 100  # the hot cell
    ordered = retrieval._with_cell_order(users, centres)
    probes = ordered.select("user_id", "vector", F.explode(F.slice("_order", 1, 3)["cell"]).alias("cell"))

    def spy(k):
        def kernel(left, right):
            import pyarrow as pa

            return pa.table({"user_id": [left.num_rows], "movie_id": [right.num_rows], "distance": [0.0]})

        return kernel

    monkeypatch.setattr(retrieval, "_nearest_in_block", spy)
    seen = retrieval.search_cells(probes, celled, 5).collect()
    assert max(r["movie_id"] for r in seen) <= 40 and max(r["user_id"] for r in seen) <= 20


def test_k_and_dimension_are_checked(spark, frames):
    users, items = frames
    with pytest.raises(ValueError):
        retrieval.top_k_exact(users, items, 0)
    odd = items.unionByName(table(spark, "movie_id", [(999, [1.0])]))
    good, bad = retrieval.split_by_dimension(odd, "vector", DIM)
    assert good.count() == 300 and [r["movie_id"] for r in bad.collect()] == [999]


def test_mmr_by_hand():
    user = np.array([1.0, 0.0])
    pool = np.array([[1.0, 0.0], [1.0, 0.05], [0.6, 0.8]])
    assert retrieval.mmr_order(user, pool, 2, 1.0)[0] == [0, 1]  # relevance only
    assert retrieval.mmr_order(user, pool, 2, 0.2)[0] == [0, 2]  # the near copy loses
    chosen, scores = retrieval.mmr_order(user, pool, 5, 0.5)
    assert chosen[0] == 0 and len(chosen) == 3 and scores[0] == pytest.approx(1.0)
    assert scores[1] == pytest.approx(0.5 * 0.6 - 0.5 * 0.6)


def test_mmr_table_equals_per_user_order(spark, frames, vectors):
    users, items = frames
    pool = retrieval.top_k_exact(users, items, 20)
    got = {}
    for r in retrieval.mmr_rerank(pool, users, items, 6, 0.4).collect():
        got.setdefault(r["user_id"], {})[r["position"]] = r["movie_id"]
    for u, candidates in brute(*vectors, 20).items():
        order, _ = retrieval.mmr_order(vectors[0][u], vectors[1][candidates], 6, 0.4)
        assert [got[u][i + 1] for i in range(6)] == [candidates[i] for i in order]


def test_saved_vectors_come_back(spark, frames, tmp_path):
    _, items = frames
    centres = retrieval.fit_cells(items)
    retrieval.save_vectors(items, centres, str(tmp_path / "index"))
    loaded, read = retrieval.load_vectors(spark, str(tmp_path / "index"))
    assert np.array_equal(centres, read) and loaded.count() == 300
    stats = retrieval.vector_stats(loaded).first()
    assert (stats["vectors"], stats["dimension"], stats["cells"], stats["probes"]) == (300, DIM, 17, 10)


# ---------------------------------------------------------------- lists


def test_user_vector_order_of_sources(spark):
    users = spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "user_id bigint")
    model = spark.createDataFrame([(1, [1.0, 3.0], [3.0, 5.0])], "user_id bigint, mlp array<double>, gmf array<double>")
    stored = spark.createDataFrame([(1, [9.0, 9.0]), (2, [7.0, 8.0]), (3, [1.0])], "user_id bigint, embedding array<double>")
    got = {r["user_id"]: r["vector"] for r in recommend.user_vectors(users, model, stored, dim=2).collect()}
    assert got == {1: [2.0, 4.0], 2: [7.0, 8.0]}


def test_fallback_prefers_trending(spark):
    users = spark.createDataFrame([(1,), (2,), (2,)], "user_id bigint")
    served = spark.createDataFrame([(1,)], "user_id bigint")
    trending = spark.createDataFrame([(1, 10), (2, 11), (3, 12)], "rank int, movie_id bigint")
    popular = spark.createDataFrame([(1, 20)], "rank int, movie_id bigint")
    got = [tuple(r) for r in recommend.fallback(users, served, trending, popular, 2).collect()]
    assert sorted(got) == [(2, 10, 0.7, 1, "trending"), (2, 11, 0.7, 2, "trending")]
    got = [tuple(r) for r in recommend.fallback(users, served, trending.limit(0), popular, 2).collect()]
    assert got == [(2, 20, 0.6, 1, "popular")]
    assert recommend.fallback(users, served, trending.limit(0), popular.limit(0), 2).count() == 0


def test_fresh_lists(spark):
    now = datetime(2024, 1, 1, 12)
    rows = [(1, 10, "old", datetime(2024, 1, 1, 11, 55)), (1, 10, "a", datetime(2024, 1, 1, 11, 56)), (1, 10, "b", datetime(2024, 1, 1, 11, 58)), (2, 10, "c", datetime(2024, 1, 1, 11, 59))]
    served = spark.createDataFrame(rows, "user_id int, k int, items string, generated_at timestamp_ntz")
    got = {r["user_id"]: r["items"] for r in recommend.fresh_lists(served, now).collect()}
    assert got == {1: "b", 2: "c"}
    left = recommend.drop_users(served, spark.createDataFrame([(2,)], "user_id int"))
    assert {r["user_id"] for r in left.collect()} == {1}


def test_uneven_and_null_vectors_raise():
    import pyarrow as pa

    from tidemark.functions.arrow import as_matrix

    for bad in ([[1.0] * 3, [1.0] * 5], [[1.0], None], [[1.0, None]]):
        with pytest.raises(ValueError):
            as_matrix(pa.array(bad, pa.list_(pa.float64())))


def test_saved_centres_all_come_back(spark, frames, tmp_path):
    items = frames[1]
    retrieval.save_vectors(items, retrieval.pick_centres(items, 150), str(tmp_path / "v"))
    loaded, centres = retrieval.load_vectors(spark, str(tmp_path / "v"))
    assert len(centres) == 150 and loaded.count() == items.count()


def test_served_lists_are_replaced_dropped_and_kept_by_bucket(spark, tmp_path):
    day = datetime(2024, 1, 20)
    table = ServedLists(spark, f"{tmp_path}/served", buckets=4)
    lists = lambda *rows: spark.createDataFrame([(u, k, m, day - timedelta(hours=h)) for u, k, m, h in rows], "user_id int, k int, movie_id int, generated_at timestamp_ntz")
    users = lambda *ids: spark.createDataFrame([(i,) for i in ids], "user_id int")
    held = lambda: {(r.user_id, r.k): r.movie_id for r in table.read().collect()}
    table.drop(users(1))
    assert table.read() is None
    table.put(lists(*[(u, 10, u, 30) for u in range(20)], (3, 10, 99, 29), (3, 20, 7, 30)))
    assert held() == {(u, 10): u for u in range(20)} | {(3, 10): 99, (3, 20): 7}
    files = {p: p.stat().st_mtime_ns for p in tmp_path.glob("served/bucket=*/*.parquet")}
    table.put(lists((5, 10, 50, 2)))
    assert held()[5, 10] == 50 and len(held()) == 21
    same = [p for p in tmp_path.glob("served/bucket=*/*.parquet") if files.get(p) == p.stat().st_mtime_ns]
    assert len({p.parent for p in files}) - len({p.parent for p in same}) == 1  # one bucket was rewritten
    assert [(r.user_id, r.movie_id) for r in table.fresh(day, 6 * 3600).collect()] == [(5, 50)]
    table.drop(users(*range(1, 20)))
    assert held() == {(0, 10): 0}
    table.drop(users(0, 77))
    assert table.read() is None or table.read().count() == 0
    table.put(lists((1, 10, 1, 1)))
    assert held() == {(1, 10): 1}


def test_two_levels_of_cells(spark):
    """Clusters of very unequal size: all items are assigned, each to a cell of the nearest
    coarse cell, and the tuned search keeps its recall."""
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(12, DIM)) * 4
    items = np.concatenate([centres[0] + 0.5 * rng.normal(size=(1200, DIM)), centres[rng.integers(0, 12, 800)] + 0.5 * rng.normal(size=(800, DIM))])
    frames = table(spark, "user_id", enumerate(items[::50] + 0.01)), table(spark, "movie_id", enumerate(items))
    cells = retrieval.fit_two_level(frames[1], sample=1_000)
    assert len(cells.coarse) == 6 and 20 <= len(cells.centres) <= 50 and set(cells.owner) <= set(range(6))
    for r in retrieval.assign_cells(frames[1], cells).collect():
        v = np.array(r.vector)
        inside = cells.owner == cells.owner[r.cell]
        away = np.sqrt(((cells.centres - v) ** 2).sum(axis=1))
        assert r.radius == pytest.approx(away[r.cell]) and away[r.cell] == pytest.approx(away[inside].min())
        held = np.unique(cells.owner)
        assert cells.owner[r.cell] == held[((cells.coarse[held] - v) ** 2).sum(axis=1).argmin()]
    exact = retrieval.top_k_exact(*frames, 5)
    probes, _ = retrieval.tuned_probes(*frames, 5, cells)
    found = retrieval.top_k_by_cells(*frames, 5, centres=cells)
    assert retrieval.recall_of(found, exact).first()["recall"] >= 0.9 and probes < len(cells.centres) / 2
    with pytest.raises(ValueError):
        retrieval.fit_two_level(frames[1].limit(0))
    for few in (frames[1].limit(1), table(spark, "movie_id", [(i, [1.0] * DIM) for i in range(30)])):
        cells = retrieval.fit_two_level(few)
        assert len(cells.centres) == 1 and {r.cell for r in retrieval.assign_cells(few, cells).collect()} == {0}


def test_probes_are_handed_on_in_bounded_batches(frames, monkeypatch):
    monkeypatch.setattr(retrieval, "USERS_AT_ONCE", 7)
    monkeypatch.setattr(retrieval, "EMIT_ROWS", 5)
    users, items = frames
    centres = retrieval.pick_centres(items, 20)
    got = {(r.user_id, r.cell) for r in retrieval._nearest_cells(users, centres, 6).collect()}
    want = {(r.user_id, c.cell) for r in retrieval._with_cell_order(users, centres).collect() for c in r._order[:6]}
    assert got == want


# ---------------------------------------------------------------- the scan


def moved(df):
    """Rows of ``df``, and rows that the shuffles of its last job wrote."""
    rows = df.collect()
    todo, total = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            if kind == "ShuffleExchangeExec":
                total += node.metrics().apply("shuffleRecordsWritten").value()
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return rows, total


def test_exact_search_moves_each_user_once(frames, vectors, monkeypatch):
    """However many blocks of items there are: the users and at most k rows for each are shuffled."""
    small_blocks(monkeypatch)
    monkeypatch.setattr(retrieval, "SHEET_ITEMS", 16, raising=False)
    found = retrieval.top_k_exact(*frames, 7, probes=2, block_items=16, with_product=True)
    rows, shuffled = moved(found)
    assert shuffled <= 40 * (1 + 7)
    users, items = vectors
    want = brute(users, items, 7)
    assert {(r.user_id, r["rank"]): r.movie_id for r in rows} == {(u, i + 1): m for u, ids in want.items() for i, m in enumerate(ids)}
    assert all(r["product"] == pytest.approx(items[r.movie_id] @ users[r.user_id]) for r in rows)


def test_null_and_repeated_ids_in_the_exact_search(spark):
    users = spark.createDataFrame([(None, [0.0, 0.0]), (1, [9.0, 9.0]), (1, [9.0, 9.0])], "user_id bigint, vector array<double>")
    items = spark.createDataFrame([(None, [1.0, 0.0]), (5, [1.0, 0.0]), (6, [2.0, 0.0]), (7, [9.0, 9.0])], "movie_id bigint, vector array<float>")
    got = [(r.user_id, r["rank"], r.movie_id) for r in retrieval.top_k_exact(users, items, 3).orderBy(F.asc_nulls_first("user_id"), "rank").collect()]
    assert got == [(None, 1, None), (None, 2, 5), (None, 3, 6), (1, 1, 7), (1, 2, 7), (1, 3, 6)]
    assert retrieval.top_k_exact(users.limit(0), items, 3).count() == 0


def test_running_nearest_equal_brute_force_whatever_the_order(vectors, monkeypatch):
    users, items = vectors
    monkeypatch.setattr(retrieval, "SCAN_PAIRS", 64)
    monkeypatch.setattr(retrieval, "EXACT_PAIRS", 32)
    running, order = retrieval._Running(users, 7), np.random.default_rng(3).permutation(300)
    for part in np.array_split(order, 23):
        running.add(np.arange(len(users)), items[part], part)
    running.merge()
    assert {u: list(running.item[u]) for u in range(len(users))} == brute(users, items, 7)
    assert (running.found == 7).all()


def test_cell_search_moves_each_user_once(frames, vectors):
    """However many cells a user looks into; only the items of these cells are found."""
    users, items = frames
    centres = retrieval.pick_centres(items, 20)
    rows, shuffled = moved(retrieval.top_k_by_cells(users, items, 5, 12, centres))
    assert shuffled <= 40 * (1 + 5)
    cells = {r.movie_id: r.cell for r in retrieval.assign_cells(items, centres).collect()}
    for u, vector in enumerate(vectors[0]):
        probed = np.argsort(np.sqrt(((centres - vector) ** 2).sum(axis=1)), kind="stable")[:12]
        open_to = np.array([m for m in range(300) if cells[m] in probed])
        away = np.sqrt(((vectors[1][open_to] - vector) ** 2).sum(axis=1))
        want = open_to[np.lexsort((open_to, away))[:5]]
        assert [r.movie_id for r in sorted((r for r in rows if r.user_id == u), key=lambda r: r["rank"])] == list(want)


@pytest.mark.parametrize("length", [100.0, 1.5])
def test_large_hash_buckets_are_scanned(spark, frames, vectors, monkeypatch, length):
    """Of wide buckets every user is compared with a large part of the items, of narrow ones with
    some in large and some in small buckets: as if all were joined, and no user is copied to blocks."""
    users, items = frames
    small_blocks(monkeypatch)
    repeated = users.unionByName(users.filter("user_id < 3")), items.unionByName(items.filter("movie_id < 9"))
    rows, shuffled = moved(retrieval.top_k_by_hash(*repeated, 5, tables=3, bucket_length=length))
    got = {(r.user_id, r["rank"]): (r.movie_id, r.distance) for r in rows}
    assert len(got) == len(rows)
    monkeypatch.setattr(retrieval, "BLOCK_ITEMS", 1000)
    joined = {(r.user_id, r["rank"]): (r.movie_id, r.distance) for r in retrieval.top_k_by_hash(users, items, 5, tables=3, bucket_length=length).collect()}
    assert got == joined
    if length == 100.0:
        assert shuffled < 40 * 3 * 19  # users in three tables, for each of 19 blocks
