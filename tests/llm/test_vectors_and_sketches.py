"""Whitening, vector codes and odd sketches against brute force."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import code_compression, odd_sketch, whitening
from pulsegrid.llm.common import table

from ..conftest import SF

VECTORS = "vec_id long, embedding array<float>, label int"
DOCS = "doc_id long, text string"


# whitening


def covariance(kind, d, rng):
    if kind == "cluster":
        q = np.linalg.qr(rng.standard_normal((d, d)))[0]
        v = q @ np.diag([5, 4, 3, 2, 2, 2] + [1] * (d - 6)) @ q.T
    else:
        a = rng.standard_normal((200, d)) if kind == "full" else rng.standard_normal((200, 3)) @ rng.standard_normal((3, d))
        v = np.cov(a.T, bias=True)
    return (v + v.T) / 2


@pytest.mark.parametrize("kind, d", [("full", 40), ("cluster", 40), ("rank 3", 40), ("full", 5)])
@pytest.mark.parametrize("k", [1, 4, 20])
def test_contours_find_what_a_dense_solver_finds(kind, d, k):
    v = covariance(kind, d, np.random.default_rng(d))
    e = np.linalg.eigvalsh(v)[::-1]
    k = min(k, 3 if kind == "rank 3" else d)
    values, vectors = whitening.principal(v, k)
    assert len(values) == k and np.abs(values - e[:k]).max() < 1e-12 * e[0]
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-10
    assert np.linalg.norm(v @ vectors - vectors * values, axis=0).max() < 1e-12 * e[0]


def test_inertia_counts():
    rng = np.random.default_rng(3)
    for kind in ("full", "cluster", "rank 3"):
        v = covariance(kind, 30, rng)
        e = np.linalg.eigvalsh(v)
        for s in (e.mean(), e[-1] / 2, 1.5, e[-1] + 1, -1.0):
            assert whitening.above(v, s) == (e > s).sum()
    swap = np.array([[0.0, 1.0], [1.0, 0.0]])
    assert whitening.above(swap, 0.0) == 1 and whitening.above(np.zeros((3, 3)), 0.0) == 0


def brute_whitening(rows, k=4):
    x = np.floor(256 * np.array([v for _, v in rows], float))
    own = np.unique(x, axis=0)
    n, s = len(own), own.sum(0)
    v = np.cov(own.T, bias=True).reshape(len(s), len(s))
    e, w = np.linalg.eigh(v)
    e, w = e[::-1][:k], w[:, ::-1][:, :k]
    return n, [[int(t) for t in ((n * r - s) ** 2).sum(keepdims=True)][0] for r in x], (x - s / n) @ w / np.sqrt(e), e / np.trace(v)


def test_whitening_equals_brute_force(spark, results):
    _, got = results("op11_embedding_whitening")
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    n, far, white, explained = brute_whitening(rows)
    at = {i: k for k, (i, _) in enumerate(rows)}
    assert len(got) == 4 * len(rows) and {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    table_ = np.zeros_like(white)
    for r in got:
        assert r.deviation == far[at[r.vec_id]] and abs(r.explained - explained[r.component - 1]) < 1e-10
        table_[at[r.vec_id], r.component - 1] = r.whitened
    for c in range(4):
        assert min(np.abs(table_[:, c] - white[:, c]).max(), np.abs(table_[:, c] + white[:, c]).max()) < 1e-9


def test_odd_vectors(spark):
    rng = np.random.default_rng(5)
    good = [(k, [float(x) for x in rng.standard_normal(4)], 1) for k in range(30)]
    odd = [(100, None, 1), (101, [1.0, None, 0.0, 0.0], 1), (102, [float("nan"), 0.0, 0.0, 0.0], None), (103, [float("inf"), 0.0, 0.0, 0.0], 1), (104, [], 1)]
    again = [(None, good[0][1], None), (5, good[5][1], 2), (5, good[5][1], 2)]
    df = spark.createDataFrame(good + odd + again, VECTORS).withColumn("x", F.lit("clash")).withColumn("_v", F.lit(1))
    m = whitening.fit(df)
    assert m.n == 30
    out = whitening.transform(df, m).collect()
    assert len(out) == 4 * 33 and sum(r.vec_id is None for r in out) == 4 and sum(r.vec_id == 5 for r in out) == 12
    codes = code_compression.report(df).collect()
    assert sorted(r.vec_id for r in codes if r.vec_id is not None) == sorted([*range(30), 5, 5]) and len(codes) == 33
    assert len({r.code for r in codes if r.vec_id == 5}) == 1
    for none in (spark.createDataFrame([], VECTORS), spark.createDataFrame(odd, VECTORS)):
        assert whitening.fit(none) is None and whitening.transform(none, None).count() == 0
        assert code_compression.report(none).count() == 0
    same = spark.createDataFrame([(k, [1.0, 2.0], k) for k in range(3)], VECTORS)
    assert whitening.transform(same, whitening.fit(same)).count() == 0
    with pytest.raises(Exception, match="lengths"):
        whitening.fit(spark.createDataFrame([(1, [1.0, 2.0], 1), (2, [1.0], 1)], VECTORS))


def test_large_entries_stay_exact():
    x = np.array([[1 << 40, -3], [5, 7]])
    sums = [(1 << 40) + 5, 4]
    d = whitening.differences(x, 1 << 30, sums)
    assert d.dtype == object and d[0, 0] == (1 << 70) - sums[0]
    assert whitening.squares(d)[1] == (5 * (1 << 30) - sums[0]) ** 2 + (7 * (1 << 30) - 4) ** 2
    far = np.array([[1 << 27, 0]]), np.array([[-(1 << 27), 1], [1 << 27, 1]])
    assert code_compression.squared(*far).tolist() == [[(1 << 56) + 1, 1]]


# vector codes


@pytest.mark.parametrize("n, k, d", [(3000, 256, 16), (300, 7, 3), (10, 10, 2), (64, 1, 4), (200, 100, 1)])
@pytest.mark.parametrize("kind", ["spread", "clusters", "copies"])
def test_dual_trees_assign_like_all_distances(n, k, d, kind):
    rng = np.random.default_rng(n + d)
    p = np.floor(rng.standard_normal((n, d)) * 128).astype(np.int64)
    if kind == "clusters":
        p = np.floor(rng.standard_normal((6, d)) * 2000)[rng.integers(0, 6, n)].astype(np.int64) + p // 20
    if kind == "copies":
        p //= 100
    e = p[rng.integers(0, n, k)]
    p = p[code_compression.tree_order(p, code_compression.LEAF)]
    tree = code_compression.tree_of(p, code_compression.LEAF)
    found = code_compression.dual_assign(p, tree, e)
    want = ((p[:, None] - e[None]) ** 2).sum(2).argmin(1)
    assert (code_compression.entry_of_each(found) == want).all()
    count, total = code_compression.entry_sums(p, tree, found, k)
    assert (count == np.bincount(want, minlength=k)).all() and all((total[c] == p[want == c].sum(0)).all() for c in range(k))


def test_whole_nodes_take_cached_sums():
    rng = np.random.default_rng(1)
    p = np.concatenate([rng.integers(0, 50, (500, 4)), rng.integers(10_000, 10_050, (500, 4))])
    p = p[code_compression.tree_order(p, 64)]
    found = code_compression.dual_assign(p, code_compression.tree_of(p, 64), np.array([[25] * 4, [10_025] * 4]))
    assert sorted(b - a for a, b, _ in found.runs) == [500, 500] and (found.single == -1).all()


def test_codes_over_several_blocks(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(k, [float(x) for x in rng.standard_normal(8)], k % 3 or None) for k in range(700)]
    df = spark.createDataFrame(rows, VECTORS)
    whole = sorted(tuple(r) for r in code_compression.report(df, entries=20).collect())
    monkeypatch.setattr(code_compression, "BLOCK_BYTES", 8 * 8 * 50)
    assert whole == sorted(tuple(r) for r in code_compression.report(df.repartition(3), entries=20).collect())
    x = np.floor(1024 * np.array([np.float32(v) for _, v, _ in rows], float)).astype(int)
    errors = np.zeros(700, int)
    codes = [""] * 700
    for p in np.split(x, 4, 1):
        book = p[:20].copy()
        for k in range(5):
            at = ((p[:, None] - book[None]) ** 2).sum(2)
            near = at.argmin(1)
            if k < 4:
                book = np.array([p[near == c].sum(0) // (near == c).sum() if (near == c).any() else book[c] for c in range(20)])
        errors += at.min(1)
        codes = [c + f"{n:02x}" for c, n in zip(codes, near)]
    assert [(r[1], r[2]) for r in whole] == list(zip(codes, errors.tolist()))
    by = {m: sum(e for e, (k, _, y) in zip(errors.tolist(), rows) if y == m) for m in (None, 1, 2)}
    assert [r[3] for r in whole] == [by[y] for _, _, y in rows]


# odd sketches


def brute_components(texts):
    def of(t):
        import re

        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
        return {tuple(w[k : k + 2]) for k in range(max(len(w) - 1, 1))} if w else set()

    sets = [of(t) for t in texts]
    at = list(range(len(texts)))
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and at[i] != at[j]:
                a, b = sorted((at[i], at[j]))
                at = [a if x == b else x for x in at]
    return [len(s) for s in sets], at


def test_near_copies_equal_brute_force(spark):
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(3))
    texts = []
    for _ in range(25):
        base = [word() for _ in range(r.randint(1, 80))]
        for _ in range(r.randint(1, 8)):
            copy = list(base)
            for _ in range(r.randint(0, 6)):
                copy[r.randrange(len(copy))] = word()
            texts.append(" ".join(copy).upper() if r.random() < 0.3 else "\n".join(copy))
    texts += [None, "", " \n", "one", "ONE", "one one", "É", "é"]
    sizes, at = brute_components(texts)
    df = spark.createDataFrame(list(enumerate(texts)), DOCS).withColumn("sid", F.lit(1)).withColumn("group", F.lit(2))
    for chunk in (odd_sketch.CHUNK, 5):
        got = sorted(tuple(x) for x in odd_sketch.near_copies(df, chunk=chunk).collect())
        assert got == [(k, n, c, k == c) for k, (n, c) in enumerate(zip(sizes, at))]


def test_large_groups_of_near_copies_in_chunks(spark):
    """A family whose members are similar to its base, but not all to one another, another that touches it at one member, and copies."""
    r = random.Random(9)
    base = [f"w{k}" for k in range(100)]
    texts = []
    for k in range(120):
        t = list(base)
        for i in r.sample(range(0, 100, 2), 4):
            t[i] = f"x{k}_{i}"
        texts.append(" ".join(t))
    chain = list(base)
    for k in range(12):
        for i in range(6 * k, 6 * k + 5):
            chain[i] = f"y{k}_{i}"
        texts.append(" ".join(chain))
    texts += texts[:30]
    sizes, at = brute_components(texts)
    got = sorted(tuple(x) for x in odd_sketch.near_copies(spark.createDataFrame(list(enumerate(texts)), DOCS), chunk=16).collect())
    assert [(x[1], x[2]) for x in got] == list(zip(sizes, at))


def test_odd_ids_and_empty_tables(spark):
    assert odd_sketch.near_copies(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(None, "a b c"), (None, "a b c"), (7, "a b c"), (7, "a b c"), (None, "z y"), (None, None)]
    got = sorted((tuple(x) for x in odd_sketch.near_copies(spark.createDataFrame(rows, DOCS)).collect()), key=str)
    assert got == sorted([(7, 2, 7, True)] * 2 + [(None, 2, 7, False)] * 2 + [(None, 1, None, True), (None, 0, None, True)], key=str)


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(0)
    lost, far = 0, 0
    for _ in range(300):
        h = rng.integers(0, 1 << 63, 1100).astype(np.uint64)
        # 0.8 and 0.5
        a, b, c = h[:900], h[100:1000], np.concatenate([h[:600], rng.integers(0, 1 << 63, 300).astype(np.uint64)])
        s = odd_sketch.odd_sketch(odd_sketch.minhash(np.concatenate([a, b, c]), np.array([0, 900, 1800, 2700])))
        x = lambda i, j: int(np.unpackbits(s[i] ^ s[j]).sum())
        lost += x(0, 1) > odd_sketch.limit_for(odd_sketch.MISS)
        far += x(0, 2) > odd_sketch.limit_for(odd_sketch.MISS)
        rows = [(0, 0, bytes([k]), s[k].tobytes()) for k in range(3)]
        assert (odd_sketch.alike(rows) == [[x(i, j) <= odd_sketch.limit_for(odd_sketch.MISS) for j in range(3)] for i in range(3)]).all()
    assert lost == 0 and far > 200


def test_bands_keep_pairs_at_the_threshold():
    rng = np.random.default_rng(1)
    bands, lost = odd_sketch.bands_for(odd_sketch.RECALL), 0
    for _ in range(400):
        h = rng.integers(0, 1 << 63, 450).astype(np.uint64)
        names = odd_sketch.band_names(odd_sketch.minhash(np.concatenate([h[:405], h[45:]]), np.array([0, 405, 810])), bands)
        lost += not (names[0] == names[1]).any()
    assert lost == 0


def test_shingles_are_lower_cased_in_ascii_only():
    h, first = odd_sketch.shingle_sets(pa.array(["A b", "a B", "É x", "é x", None, "a"]))
    assert np.diff(first).tolist() == [1, 1, 1, 1, 0, 1] and h[0] == h[1] and h[2] != h[3]
