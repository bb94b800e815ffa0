"""Packing, vector search, substring and near-duplicate removal, and the pipeline."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.comparison import compare, duck
from tests.conftest import SMALL
from tests.llm.frames import SENTENCE, empty_frame, odd_frame, odd_rows, row
from tidemark.llm import hashing, near_dedup, packing, substring_dedup, vp_search
from tidemark.llm.checks import CHECKS
from tidemark.llm.queries import QUERIES
from tidemark.llm.tokens import default_path, encoder

MID = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_sql(spark, name):
    assert compare(QUERIES[name](spark, SMALL), duck(SMALL), CHECKS[name]) == []


def lower(text):
    return (text or "").encode().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256)))


# hashing ------------------------------------------------------------------------------------

def test_hashes_tell_words_and_runs_apart():
    import pyarrow as pa

    texts = ["a b c a b c", None, "", " \t a  b\nc\x0ba b ", "ab c", "A b", "é x y", "a b c a b"]
    found = {}
    for words in hashing.words_of(pa.array(texts).slice(0)):
        runs = words.runs(3)
        for r in range(len(words.first) - 1):
            own = (texts[r] or "").encode().split()
            a, b = words.first[r], words.first[r + 1]
            assert [words.data[words.start[i] : words.end[i]].tobytes() for i in range(a, b)] == own
            for i in range(a, b):
                found.setdefault(own[i - a], set()).add(int(words.hashes[i]))
            for i in range(a, b - 2):
                found.setdefault(tuple(own[i - a : i - a + 3]), set()).add(int(runs[i]))
            found.setdefault(("whole", *own), set()).add(words.whole(r))
    assert all(len(v) == 1 for v in found.values())
    assert len({next(iter(v)) for v in found.values()}) == len(found)


# packing ------------------------------------------------------------------------------------

def test_crossover_and_mutation_keep_every_piece_once():
    rng = random.Random(8)
    sizes = [rng.randint(1, 1023) for _ in range(300)]
    population = packing.first_population(sizes, 1024, 4, rng)
    for _ in range(30):
        a, b = rng.sample(population, 2)
        child = packing.mutation(packing.crossover(a, b, sizes, 1024, rng), sizes, 1024, rng)
        assert sorted(i for g in child for i in g) == list(range(300))
        assert all(sum(sizes[i] for i in g) <= 1024 for g in child)


def cut_up(rng, n):
    """Full sequences cut in three, each piece over a quarter of it: best fit is far off here."""
    sizes = []
    for _ in range(n):
        a = rng.randint(390, 510)
        b = rng.randint(257, 1024 - a - 257) if a < 510 else 257
        sizes += [a, b, 1024 - a - b]
    rng.shuffle(sizes)
    return sizes


def test_evolution_beats_best_fit_at_the_query_settings(spark):
    rng = random.Random(12)
    sizes = cut_up(rng, 600)
    best_fit = len(packing.Shop(sizes, 1024).place(sorted(range(len(sizes)), key=lambda i: -sizes[i])))
    pieces = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "doc_id long, length long")
    packed = packing.pack(pieces).collect()
    bins = defaultdict(list)
    for r in packed:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        assert [o for o, _ in sorted(places)] == np.cumsum([0] + [n for _, n in sorted(places)])[:-1].tolist()
        assert sum(n for _, n in places) <= 1024
    assert len(packed) == len(sizes) and 600 <= len(bins) < 0.95 * best_fit


def test_evolution_is_never_worse_than_best_fit():
    rng = random.Random(6)
    for n in (1, 2, 5, 60, 300):
        sizes = [rng.choice([rng.randint(1, 1023), rng.randint(1, 60), 512, 341]) for _ in range(n)]
        best_fit = len(packing.Shop(sizes, 1024).place(sorted(range(n), key=lambda i: -sizes[i])))
        population = packing.first_population(sizes, 1024, packing.POPULATION, rng)
        best = packing.evolve(population, sizes, 1024, packing.CHILDREN, rng)[0]
        assert packing.lower_bound(sizes, 1024) <= len(best) <= best_fit
        assert sorted(i for b in best for i in b) == list(range(n))


def test_number_of_sequences_of_the_whole_table(spark):
    """Never more than best fit over all pieces at once, but for an edge of each shard."""
    rows = QUERIES["op2_grouping_pack"](spark, SMALL).collect()
    sizes = [r.length for r in rows]
    best_fit = len(packing.Shop(sizes, 1024).place(sorted(range(len(sizes)), key=lambda i: -sizes[i])))
    assert packing.lower_bound(sizes, 1024) <= len({r.sequence_id for r in rows}) <= best_fit


def test_pack_odd_rows_against_the_contract(spark):
    docs = odd_frame(spark)
    tool = encoder(default_path())
    out = packing.pack_documents(docs, shard_pieces=4).collect()
    want = Counter()
    for r in odd_rows():
        ids = np.append(tool.ids(r[1] or ""), np.uint32(2)).astype("<u4")
        head = len(ids) % 1024 or 1024
        edges = [0, *range(head, len(ids) + 1, 1024)]
        for i, (a, b) in enumerate(zip(edges, edges[1:])):
            want[r[0], i, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    rooms = defaultdict(list)
    for r in out:
        rooms[r.sequence_id].append((r.offset, r.length))
    for parts in rooms.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0, *(n for _, n in parts[:-1])]).tolist() and sum(n for _, n in parts) <= 1024
    assert packing.pack_documents(empty_frame(spark)).count() == 0


def test_pack_is_close_to_the_bound(spark):
    out = QUERIES["op2_grouping_pack"](spark, MID).collect()
    assert len({r.sequence_id for r in out}) <= 1.01 * -(-sum(r.length for r in out) // 1024) + 1


# vectors --------------------------------------------------------------------------------------

def brute_nearest(rows, k):
    out = {}
    for q, v in rows:
        if q % 20 == 0:
            found = sorted((-float(np.dot(v, w)), i) for i, w in rows if i != q)
            out[q] = [(i, -s) for s, i in found[:k]]
    return out


def test_search_with_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).astype("float32").tolist()) for i in range(400)]
    rows += [(i, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]) for i in range(400, 700)]  # one very common vector
    bad = [(700, None), (720, [0.0] * 6), (740, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (760, [float("nan")] * 6), (780, [1.0, 2.0]), (None, [1.0] * 6)]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").withColumn("ids", F.lit(1)).withColumn("v", F.lit(2))
    got = defaultdict(list)
    for r in vp_search.search(frame, F.col("vec_id") % 20 == 0, 15, shard_rows=100, block_rows=10, leaf_rows=8).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    want = brute_nearest(rows, 15)
    assert set(got) == set(want)
    for q, found in got.items():
        found.sort()
        assert [(i, pytest.approx(s)) for _, i, s in found] == want[q] and [r for r, _, _ in found] == list(range(1, 16))
    few = vp_search.search(frame.filter("vec_id < 5"), F.col("vec_id") % 20 == 0, 15)
    assert few.count() == 4
    assert vp_search.search(frame.limit(0), F.col("vec_id") % 20 == 0, 15).count() == 0


def test_equal_products_go_to_the_smaller_id(spark):
    """Vectors of zeros and ones: very many different vectors with equal products."""
    rng = np.random.default_rng(7)
    rows = [(i, rng.integers(0, 2, 12).astype(float).tolist()) for i in rng.permutation(2_000).tolist()]
    rows = [r for r in rows if any(r[1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in vp_search.search(frame, F.col("vec_id") % 20 == 0, 20, shard_rows=300, block_rows=16, leaf_rows=32).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    want = brute_nearest(rows, 20)
    assert {q: [(i, s) for _, i, s in sorted(found)] for q, found in got.items()} == want


def test_repeated_queries_and_rows_left_out(spark):
    rows = [(20, [1.0, 0.0])] * 3 + [(40, [0.0, 1.0]), (40, [1.0, 1.0])] + [(i, [float(i), 1.0]) for i in range(1, 5)]
    frame = spark.createDataFrame(rows + [(None, [1.0, 1.0]), (6, None), (7, [0.0, 0.0]), (8, [1.0])], "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in vp_search.search(frame, F.col("vec_id") % 20 == 0, 2).collect())
    assert got == [(20, 1, 4, 4.0), (20, 2, 3, 3.0), (40, 1, 1, 1.0), (40, 1, 4, 5.0), (40, 2, 2, 1.0), (40, 2, 3, 4.0)]
    assert {tuple(r) for r in vp_search.left_out(frame).collect()} == {
        ("null id", 1), ("null vector", 1), ("zero vector", 1), ("another length", 1)}


def test_relaxed_pruning_keeps_recall_and_skips_most(spark):
    """Of vectors in clusters: exact at factor 1; at 2.6 still 0.9 of the nearest with less than half of all pairs looked at."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 16))
    points = centres[rng.integers(0, 20, 4000)] + 0.3 * rng.normal(size=(4000, 16))
    longest, own = (points**2).sum(axis=1).max(), np.arange(0, 4000, 20)
    products = points[own] @ points.T
    products[np.arange(len(own)), own] = -np.inf
    brute = np.argsort(-products, axis=1)[:, :20]
    seen = {}
    for factor in (1.0, 2.6):
        shard = vp_search.Shard.build(points, [np.array([i]) for i in range(4000)], longest, 32)
        _, ids = shard.search(points[own], own, np.full(len(own), -np.inf), 20, longest, factor)
        recall = np.mean([len(set(a) & set(b)) / 20 for a, b in zip(ids, brute)])
        seen[factor] = recall, shard.visited / products.size
    assert seen[1.0][0] == 1.0 and seen[2.6][0] >= 0.9 and seen[2.6][1] < 0.5, seen
    frame = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
    found = defaultdict(set)
    for r in vp_search.search(frame, F.col("vec_id") % 20 == 0, 20, factor=1.5, shard_rows=500, leaf_rows=32).collect():
        found[r.query_id].add(r.vec_id)
    assert np.mean([len(found[q] & set(b)) / 20 for q, b in zip(own.tolist(), brute.tolist())]) >= 0.9


# substrings -----------------------------------------------------------------------------------

def brute_repeats(texts, n):
    lists = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + n]) for w in lists for i in range(len(w) - n + 1))
    out = []
    for w in lists:
        gone = {i + k for i in range(len(w) - n + 1) if seen[tuple(w[i : i + n])] > 1 for k in range(n)}
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def planted_texts(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") * rng.randint(1, 2)
    passages = [[word() for _ in range(rng.randint(20, 90))] for _ in range(6)]
    texts = []
    for _ in range(60):
        parts = [[word() for _ in range(rng.randint(0, 60))]]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, 10)
            parts += [p[a : len(p) - rng.randint(0, 10)], [word() for _ in range(rng.randint(0, 30))]]
        texts.append(" ".join(w for p in parts for w in p))
    return texts + texts[:5] + ["x " * 100, "x " * 80, "y\n" * 34, "y\n" * 35, None, "", "é ü " * 17 + "é", SENTENCE]


@pytest.mark.parametrize("seed", (1, 2))
def test_repeats_equal_brute_force(spark, seed):
    texts = planted_texts(seed)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.remove_repeats(docs).collect()}
    assert [got[i] for i in range(len(texts))] == brute_repeats(texts, 35)


def test_repeats_of_odd_rows_and_spans(spark):
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.remove_repeats(odd_frame(spark)).collect())
    rows = odd_rows()
    assert got == Counter((r[0], *b) for r, b in zip(rows, brute_repeats([r[1] for r in rows], 35)))
    assert substring_dedup.remove_repeats(empty_frame(spark)).count() == 0
    many = [(i, f"{' '.join(f'own{i}x{k}' for k in range(20))} {' '.join(f'p{k}' for k in range(40))}") for i in range(50)]
    for r in substring_dedup.remove_repeats(spark.createDataFrame(many, "doc_id long, text string")).collect():
        assert [tuple(s) for s in r.repeats] == [(20, 60)]


# near-duplicates --------------------------------------------------------------------------------

def brute_components(rows):
    sets = []
    for _, t in rows:
        w = lower(t).split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
            parent[find(a)] = find(b)
    names = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            names[find(i)].append(doc_id)
    return [(d, len(s), min(names[find(i)], default=None)) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def near_texts(seed):
    """Chains of edits, groups of near copies, shared passages, and short texts."""
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage, texts = fresh(60), []
    for _ in range(6):
        w = fresh(rng.randint(30, 150))
        for _ in range(12):  # each an edit of the last: ends of the chain differ
            texts.append(" ".join(w))
            w = list(w)
            for _ in range(rng.randint(1, 3)):
                w[rng.randrange(len(w))] = fresh(1)[0]
    base = fresh(100)
    for _ in range(40):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(100)] = fresh(1)[0]
        texts.append(" ".join(w))
    for _ in range(40):
        texts.append(" ".join(passage + fresh(rng.randint(5, 40))))
    texts += ["a b c d", "A b c D", "a b c", "", None, "  ", "a b c d e", "a b c d e a b c d e"]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", (1, 2, 3))
def test_components_equal_brute_force(spark, seed):
    rows = [(i * 3 + 1, t) for i, t in enumerate(near_texts(seed))]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for d, n, c in brute_components(rows):
        assert got[d] == (n, c if n else d, (c if n else d) == d)


def test_near_duplicates_of_odd_rows(spark):
    rows = [(r[0], r[1]) for r in odd_rows()]
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(odd_frame(spark)).collect())
    assert got == Counter((d, n, c if n else d) for d, n, c in brute_components(rows))
    assert near_dedup.near_duplicates(empty_frame(spark)).count() == 0


def test_one_row_of_each_group_stays(spark):
    docs = odd_frame(spark).unionByName(odd_frame(spark).filter("doc_id = 9"))
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids == Counter({1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 7: 1, 10: 2, None: 1, 11: 1})
    assert near_dedup.keep_one(empty_frame(spark)).count() == 0


# pipeline -----------------------------------------------------------------------------------------

@pytest.mark.parametrize("ids", [[1, 2, 3, 4, 5], [7] * 5, [None] * 5, [None, 3, 3, None, 9]])
def test_one_of_near_texts_stays_whatever_their_ids(spark, ids):
    words = [f"w{i}" for i in range(80)]
    near = [" ".join(words[:40] + [f"x{k}"] + words[40:]) for k in range(5)]
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(i, t) for i, t in zip(ids, near)] + [(7, other), (None, ""), (None, None), (7, near[0])]
    kept = near_dedup.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    of_near = [r.doc_id for r in kept if r.text in near]
    assert len(of_near) == 1 and of_near[0] == min([i for i in [*ids, 7] if i is not None])
    assert sorted(str(r.text) for r in kept if r.text not in near) == sorted(["None", "", other])


def test_stages_keep_columns_and_clean_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{MID}/labels.parquet").collect()}
    seen = [docs]
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, seen[-1], MID).write.parquet(f"{tmp_path}/{n}")
        seen.append(spark.read.parquet(f"{tmp_path}/{n}"))
    cleaned, single, safe, mixed, packed = seen[1:]
    for out in (cleaned, single, safe, mixed):
        assert out.columns == docs.columns
    long = {r.doc_id for r in docs.collect() if len((r.text or "").split()) >= 60}
    stayed = {r.doc_id for r in cleaned.collect()}
    good = [d for d in long if labels.get(d) == 1]
    assert sum(d in stayed for d in good) > 0.99 * len(good)
    assert sum(d in stayed for d in long if labels.get(d) == 0) < 0.05 * sum(v == 0 for v in labels.values())
    parts = brute_components([(r.doc_id, r.text) for r in cleaned.collect()])
    assert Counter(r.doc_id for r in single.collect()) == Counter({c for _, _, c in parts})
    assert safe.count() == single.count() and safe.filter("text RLIKE '[0-9a-f]{24}'").count() == 0
    words = sum(len(r.text.split()) for r in safe.collect())
    assert abs(sum(len(r.text.split()) for r in mixed.collect()) - 1.5 * words) < 0.02 * words
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in mixed.collect()}
    assert corpus_pipeline.run(spark, MID).count() == packed.count()


def test_stages_take_odd_rows(spark):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd_frame(spark), SMALL).count() >= 0
        assert stage(spark, empty_frame(spark), SMALL).count() == 0
    assert row(1, None)[1] is None
