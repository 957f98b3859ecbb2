"""Nearest vectors: recall against brute force, copies, ties, absent values."""

import numpy as np

from souche.llm import vectors
from souche.operators import serve


def exact(rows, k):
    out = {}
    for p, v in rows:
        sims = sorted(((-round(float(np.dot(v, w)), 6), q) for q, w in rows if q != p))
        out[p] = [q for _, q in sims[:k]]
    return out


def test_recall_on_clustered_vectors(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(60, 64))
    x = (centres[rng.integers(0, 60, 1500)] + 0.35 * rng.normal(size=(1500, 64))).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(int(2 * i + 1), v) for i, v in enumerate(x)]
    df = spark.createDataFrame([(p, [float(a) for a in v]) for p, v in rows], "pos bigint, embedding array<float>")
    got = {}
    for r in vectors.neighbours(df, 5, probes=4, per_cell=30).collect():
        got.setdefault(r.pos, []).append(r.other)
    want = exact(rows, 5)
    assert sum(len(set(got[p]) & set(want[p])) for p in want) / (5 * len(want)) >= 0.9


def test_copies_ties_and_absent_vectors(spark):
    e = lambda *at: [1.0 if i in at else 0.0 for i in range(8)]
    rows = [(p, e(0)) for p in range(1, 12)] + [(20, e(1)), (21, e(1)), (30, e(2)), (40, None), (41, []), (42, [None] * 8), (43, [1.0]), (50, [0.0] * 8), (None, e(0)), (1, e(0))]
    df = spark.createDataFrame([(p, v, "clash") for p, v in rows], "pos bigint, embedding array<float>, key string")
    got = {tuple(r) for r in vectors.similar_pairs(df, 0.8, 5).collect()}
    want = {(a, b) for a in range(1, 7) for b in range(1, 12) if a < b and (b <= 6 or a <= 5)} | {(20, 21)}
    assert got == want
    assert vectors.neighbours(df.limit(0), 5).count() == 0


def test_estimates_follow_products():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 32)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    coarse = vectors.kmeans(x, 10, 8, 7)
    index = vectors.Index(x, coarse, np.full(10, 0.9), 8)
    cell, codes, stretch, left = index.encode(x)
    own = np.flatnonzero(cell == 0)
    est, true = index.estimates(x[:200], 0, codes[own], stretch[own]), x[:200] @ x[own].T
    assert np.corrcoef(est.ravel(), true.ravel())[0, 1] > 0.8
    assert (np.abs(est - true) <= vectors.SURE * left[own][None, :]).mean() > 0.999


def test_a_third_of_all_rows_are_copies(spark):
    rng = np.random.default_rng(4)
    hot = rng.normal(size=16)
    rows = [(int(p), hot if p % 3 == 0 else rng.normal(size=16)) for p in rng.permutation(900)]
    rows = [(p, (v / np.linalg.norm(v)).astype(np.float32)) for p, v in rows]
    df = spark.createDataFrame([(p, [float(a) for a in v]) for p, v in rows], "pos bigint, embedding array<float>")
    got = {tuple(r) for r in vectors.similar_pairs(df, 0.95, 5).collect()}
    copies = sorted(p for p, _ in rows if p % 3 == 0)
    assert {(a, b) for a, b in got if a % 3 == 0 and b % 3 == 0} == {(min(p, q), max(p, q)) for p in copies for q in [c for c in copies if c != p][:5]}


def test_a_third_of_all_rows_are_different_near_copies(spark):
    rng = np.random.default_rng(5)
    hot = rng.normal(size=48)
    x = np.array([hot + 0.3 * rng.normal(size=48) if p % 3 == 0 else rng.normal(size=48) for p in range(1500)])
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    df = spark.createDataFrame([(p, v.tolist()) for p, v in enumerate(x)], "pos bigint, embedding array<float>")
    sims = np.round(x.astype(float) @ x.T.astype(float), 12)
    np.fill_diagonal(sims, -np.inf)
    want = {p: np.lexsort((np.arange(1500), -sims[p]))[:5].tolist() for p in range(1500)}
    got = {}
    for r in vectors.neighbours(df, 5).orderBy("pos", "rank").collect():
        got.setdefault(r.pos, []).append(r.other)
    assert got == want
    pairs = {(min(p, q), max(p, q)) for p, qs in want.items() for q in qs if sims[p, q] >= 0.8}
    assert {tuple(r) for r in vectors.similar_pairs(df, 0.8, 5).collect()} == pairs


def test_tiles_meet_each_other(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 8)).astype(np.float32)
    df = spark.createDataFrame([(p, v.tolist()) for p, v in enumerate(x)], "id bigint, v array<float>")
    sims = np.round(x.astype(float) @ x.T.astype(float), 12)
    np.fill_diagonal(sims, -np.inf)
    got = {(r.q, r["rank"]): r.c for r in serve.knn_self(df, 7, tile=40).collect()}
    assert got == {(p, i + 1): int(q) for p in range(300) for i, q in enumerate(np.argsort(-sims[p])[:7])}


def test_cells_keep_their_sample_at_any_ratio(spark):
    """Fewer vectors on the driver never mean fewer to a cell: recall holds and no codebook collapses."""
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(40, 32))
    x = (centres[rng.integers(0, 40, 1600)] + 0.5 * rng.normal(size=(1600, 32))).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(p, v.tolist()) for p, v in enumerate(x)], "pos bigint, embedding array<float>")
    keyed = df.select(df.pos.alias("key"), df.embedding.alias("v"))
    sims = x @ x.T
    np.fill_diagonal(sims, -np.inf)
    want = np.argsort(-sims, 1)[:, :5]
    for sample, per_cell, lot in ((48, 16, 64), (400, 40, 10_000)):
        index = vectors.fit(keyed, 1600, 32, sample=sample, per_cell=per_cell, lot=lot)
        sizes = np.bincount(vectors.nearest(x, index.coarse), minlength=len(index.coarse))
        assert len(index.coarse) * per_cell <= 1600 and np.mean(sizes) >= per_cell and max(float(np.abs(b).max()) for b in index.books) > 0
        got = {}
        for r in vectors.neighbours(df, 5, probes=4, sample=sample, per_cell=per_cell, lot=lot, block=200).collect():
            got.setdefault(r.pos, set()).add(r.other)
        assert sum(len(got[p] & set(want[p])) for p in range(1600)) / 8000 >= 0.9
