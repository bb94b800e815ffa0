"""License notices, spelling variants and whitening, against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.comparison import compare, duck
from tests.conftest import SMALL
from tests.llm.frames import empty_frame, odd_frame, odd_rows
from tidemark.llm import feast_whitening, license_notices, spelling_variants
from tidemark.llm.checks import CHECKS
from tidemark.llm.queries import QUERIES
from tidemark.llm.text import read_table

# license notices ---------------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def small_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def fewest_edits(pattern, text):
    """Fewest edits between the pattern and any part of the text, row by row of the edit table."""
    chars, at = np.frombuffer(text.encode("utf-32-le"), "<u4"), np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, dtype="int64")
    for c in pattern:
        below = row + 1
        below[1:] = np.minimum(below[1:], row[:-1] + (chars != ord(c)))
        row = np.minimum.accumulate(below - at) + at
    return row.min()


def expected_notices(text):
    words = small_words(text)
    joined = f" {' '.join(words)} "
    places, base = [], set()
    for phrase, label in license_notices.BASE:
        parts = phrase.split()
        for i in range(len(words) - len(parts) + 1):
            if words[i : i + len(parts)] == parts:
                places.append(i)
                base.add(label)
    labels = set(base)
    for notice, label in license_notices.NOTICES if words else ():
        if fewest_edits(f" {notice} ", joined) <= license_notices.edits_allowed(notice):
            labels.add(label)
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)))


def digest(r):
    return r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels


def edited(rng, text, n):
    for _ in range(n):
        i = rng.randrange(len(text))
        text = rng.choice([text[:i] + text[i + 1 :], text[:i] + rng.choice("abxyz ") + text[i:], text[:i] + rng.choice("abxyz ") + text[i + 1 :]])
    return text


def test_notices_of_the_whole_table(spark):
    texts = {r.doc_id: r.text for r in read_table(spark, SMALL, "documents").collect()}
    got = QUERIES["op11_fuzzy_notices"](spark, SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        assert digest(r) == expected_notices(texts[r.doc_id])
        assert 0 <= r.score <= 1 and (r.score > 0) == (r.labels != "") and (r.score == 1 or not r.n_base)


def test_notices_with_edits_are_found_as_by_the_edit_table(spark, tmp_path):
    rng = random.Random(4)
    rows = []
    for notice, _ in license_notices.NOTICES:
        for extra in (-1, 0, 1, 2):
            n = max(license_notices.edits_allowed(notice) + extra, 0)
            rows.append((len(rows), f"Some Words before. {edited(rng, notice, n)} and after it"))
    rows.append((len(rows), "MIT License, mit-license (MIT\nLicense) Apache license; permit license " * 500))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op11_fuzzy_notices"](spark, str(tmp_path)).collect()}
    assert {i: digest(r) for i, r in got.items()} == {i: expected_notices(t) for i, t in rows}
    assert sum(r.labels != "" for r in got.values()) > len(license_notices.NOTICES)


def test_spans_of_notices(spark):
    text = "Ünder terms: Licenced under the Apache-License (Version 2.0). The end; mozila public license, version 2"
    docs = spark.createDataFrame([(1, text, "own")], "doc_id long, text string, licenses string")
    found = license_notices.find_notices(docs).first().licenses
    words = small_words(text)
    assert [(b.label, b.word) for b in found.base] == [("apache", 5)]
    spans = {n.label: (" ".join(words[n.first_word : n.last_word + 1]), n.edits) for n in found.notices}
    assert spans == {"apache": ("licenced under the apache license version 2 0", 1), "mpl": ("mozila public license version", 1)}


def test_notices_of_odd_rows(spark):
    got = license_notices.find_notices(odd_frame(spark)).collect()
    assert len(got) == len(odd_rows()) and all(r.licenses.n_words == len(small_words(r.text)) for r in got)
    assert license_notices.find_notices(odd_frame(spark), result="score").columns[-1] == "score"
    assert license_notices.find_notices(empty_frame(spark)).count() == 0


def test_many_seeds_in_a_long_text_stay_cheap(spark):
    text = "permission is here and you may not use this fil redistribution and use " * 1_000
    found = license_notices.find_notices(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().licenses
    assert (found.n_words, found.base, found.notices, found.score) == (13 * 1_000, [], [], 0.0)


# spelling variants ---------------------------------------------------------------------------

def brute_variants(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    by_cut = defaultdict(set)
    for w in n:
        for i in range(len(w)):
            by_cut[w[:i] + w[i + 1 :]].add((w, i))
    near = {w: set() for w in n}
    for rest, members in by_cut.items():
        for w, i in members:
            for other in [o for o, k in members if k == i and o != w] + ([rest] if rest in n else []):
                near[w].add(other), near[other].add(w)
    form = {}
    for w in n:
        best = min(near[w], key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    def root(w):
        return w if form[w] is None else root(form[w])
    return {(w, form[w], root(w), n[w], len(near[w]), None if form[w] is None else n[form[w]]) for w in n}


def test_variants_equal_sql_and_brute_force(spark):
    query = QUERIES["op12_pivotal_grams"](spark, SMALL)
    assert compare(query, duck(SMALL), CHECKS["op12_pivotal_grams"]) == []
    rows = [(r.doc_id, r.text) for r in read_table(spark, SMALL, "documents").collect()]
    assert {tuple(r) for r in query.collect()} == brute_variants(rows)


def test_variants_of_repetitive_words(spark):
    """Few letters: grams that repeat within a word and tie in the order."""
    rng = random.Random(8)
    rows = [(i, " ".join("".join(rng.choices("abß"[: 2 + i % 2], k=rng.randint(4, 9))) for _ in range(400))) for i in range(20)]
    got = spelling_variants.variant_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    want = brute_variants(rows)
    assert {tuple(r) for r in got.collect()} == want and sum(r[4] for r in want) > 1_000


def test_variants_of_odd_rows(spark):
    got = {tuple(r) for r in spelling_variants.variant_groups(odd_frame(spark)).collect()}
    assert got == brute_variants([r[:2] for r in odd_rows()]) and got
    assert spelling_variants.variant_groups(empty_frame(spark)).count() == 0


@pytest.mark.parametrize("prefix, want", [
    ([(0, 1), (1, 1), (2, 9)], [0, 2]), ([(0, 5), (1, 1), (2, 5), (3, 1)], [1, 3]), ([(0, 1), (4, 2), (5, 1)], [0, 5]),
])
def test_pivots_do_not_overlap_and_weigh_least(prefix, want):
    assert spelling_variants.pivots(prefix) == want


# whitening -----------------------------------------------------------------------------------

def plain_whitening(rows, wanted=32):
    x = np.floor(np.array(rows, dtype=float) * 64).astype("int64") + 1_000_000
    n, total = len(x), x.sum(axis=0)
    y = x - total / n
    v = y.T @ y / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:wanted], u[:, ::-1][:, :wanted]
    return ((n * x - total) ** 2).sum(axis=1), y @ u / np.sqrt(e), e / np.trace(v)


def test_whitening_equals_a_dense_solution(spark):
    vectors = sorted((r.vec_id, r.embedding) for r in read_table(spark, SMALL, "embeddings").collect())
    deviation, z, explained = plain_whitening([v for _, v in vectors])
    got = QUERIES["op13_feast_whitening"](spark, SMALL).collect()
    assert len(got) == 32 * len(vectors)
    at = {i: k for k, (i, _) in enumerate(vectors)}
    ours = np.zeros_like(z)
    for r in got:
        ours[at[r.vec_id], r.component - 1] = r.whitened
        assert r.deviation == deviation[at[r.vec_id]] and r.n == len(vectors)
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9) and r.identity_error < 1e-9
    ours *= np.sign((ours * z).sum(axis=0))
    assert np.abs(ours - z).max() < 1e-6


@pytest.mark.parametrize("kind", ["spread", "wide", "low rank", "equal", "clusters", "one"])
def test_no_component_is_missed(spark, kind):
    rng = np.random.default_rng(5)
    d = 1 if kind == "one" else 40
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    e = {
        "spread": rng.random(d) + 0.1, "wide": 10.0 ** -np.linspace(0, 8, d), "low rank": np.r_[rng.random(7) + 1, np.zeros(33)],
        "equal": np.ones(d), "clusters": np.r_[np.full(9, 3.0), np.full(20, 2.0), np.full(11, 1.0)], "one": np.ones(1),
    }[kind]
    v = (q * e) @ q.T
    got, u = feast_whitening.components(spark, (v + v.T) / 2, 25)
    want = np.sort(e[e > 0])[::-1][:25]
    assert got == pytest.approx(want, rel=1e-7) and np.abs(u.T @ u - np.eye(len(want))).max() < 1e-10
    assert np.abs(v @ u - u * got).max() < 1e-10


def test_inertia_counts_eigenvalues():
    rng = np.random.default_rng(6)
    for d in (1, 2, 5, 30):
        a = rng.standard_normal((d, d))
        a = a + a.T
        e = np.linalg.eigvalsh(a)
        for shift in rng.standard_normal(8) * 3:
            assert feast_whitening.above(a, shift) == (e > shift).sum()
    assert feast_whitening.above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1
    with pytest.raises(ArithmeticError):
        feast_whitening.feast(np.diag([1.0, 2.0, 3.0]), 0.5, 1.5, 2)


def test_vectors_that_take_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, None), (3, []), (4, [nan, 1.0]), (5, [1.0, -inf]), (6, [1.0, None]), (None, [0.0, 0.0]), (1, [1.0, 2.0]),
            (7, [1.0, 2.0, 3.0]), (8, [1e30, 0.0]), (9, [-3.5, 0.01]), (10, [1e9, 1e9])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("x", F.lit("own")).withColumn("whitened", F.lit("own"))
    got = feast_whitening.whiten(frame).collect()
    assert sorted((r.vec_id or 0) for r in got) == [0, 1, 1, 9, 10]
    x = np.floor(np.array([[1, 2], [1, 2], [0, 0], [-3.5, 0.01], [1e9, 1e9]]) * 64).astype("int64") + 1_000_000
    exact = {i: sum((5 * int(a) - int(s)) ** 2 for a, s in zip(v, x.sum(axis=0))) for i, v in zip((1, 1, 0, 9, 10), x)}
    assert {(r.vec_id or 0): r.deviation for r in got} == {i: s if s < 2**63 else None for i, s in exact.items()}
    alike = frame.filter("vec_id = 1")
    assert [(len(r.whitened), r.deviation, r.identity_error) for r in feast_whitening.whiten(alike).collect()] == [(0, 0, 0.0)] * 2
    assert feast_whitening.whiten(frame.limit(0)).count() == 0
