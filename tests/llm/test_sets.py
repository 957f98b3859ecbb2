"""Components, distinctive terms and near duplicates against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from souche.functions.text import words_py
from souche.llm import components, distinctive, neardup, voronoi


def groups_of(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {(x, find(x)) for x in parent}


@pytest.mark.parametrize("seed,hot", [(1, 100_000), (2, 3)])
def test_hash_to_min_equals_union_find(spark, seed, hot):
    rng = random.Random(seed)
    pairs = [(f"v{rng.randrange(80):03}", f"v{rng.randrange(80):03}") for _ in range(60)]
    pairs += [(f"chain{i:03}", f"chain{i + 1:03}") for i in range(60)] + [("hub", f"leaf{i:03}") for i in range(50)]
    pairs += [(None, "x"), ("y", None), ("self", "self")] + pairs[:20]
    df = spark.createDataFrame([(a, b, "clash") for a, b in pairs], "a string, b string, v string")
    got = {(r.id, r.group) for r in components.hash_to_min(df, hot_share=0.0, hot_least=hot).collect()}
    assert got == groups_of(pairs)


def test_hash_to_min_of_nothing(spark):
    assert components.hash_to_min(spark.createDataFrame([], "a string, b string")).count() == 0


def test_name_groups_cleans_links(spark):
    names = spark.createDataFrame(
        [("02", "saint frepout", ["Trôi (XIIe s.)", "", None]), ("01", "troi", None), ("01", "troi", None), ("03", "seul", ["inconnu", "SEUL"]), ("04", "d'aix", ["Saint-Frepout2"])],
        "id string, nom string, noms_lies array<string>",
    )
    first = spark.createDataFrame([("a", "jean marie", None), ("b", "paul", ["Jean-Marie"]), ("c", "d aix", ["D'Aix", "PAUL"])], "id string, prenom string, prenoms_lies array<string>")
    got = {tuple(r) for r in components.name_groups(names, first).collect()}
    assert got == {("nom", "02", "01"), ("nom", "01", "01"), ("nom", "04", "01"), ("prenom", "a", "a"), ("prenom", "b", "a"), ("prenom", "c", "a")}


def test_two_poisson_tells_the_elite():
    share, low, high = distinctive.two_poisson(np.array([[60_000.0, 9, 3]]), np.array([0.0, 1, 4]))
    post = distinctive.posterior(np.array([0.0, 1, 4]), share, low, high)
    assert high > low and np.all(np.diff(post) > 0) and post[-1] > 0.99 and post[0] < 0.01


def test_posterior_never_drops_a_case():
    """Counts of three and more in 2 to 12 of at least a few dozen records are always elite, however often others hold the term."""
    rng = np.random.default_rng(5)
    tfs, ns, totals = [], [], []
    for _ in range(3000):
        held = Counter(rng.integers(1, int(rng.choice([4, 9, 60, 3000])), int(rng.integers(2, 13))).tolist())
        tfs.append(sorted(held))
        ns.append([held[c] for c in sorted(held)])
        totals.append(int(rng.integers(40, 100_000_000)))
    for t, total, scores in zip(tfs, totals, distinctive._fit_batch(pd.Series(tfs), pd.Series(ns), pd.Series(totals))):
        assert all(p >= 0.5 for c, p in zip(t, scores) if c >= 3), (total, t, scores)


def test_a_hot_term_is_scored_like_others(spark):
    rows = [(f"r{i}", " ".join(["de"] * (1 + i % 3) + [f"mot{i % 7}"])) for i in range(90)]
    df = spark.createDataFrame(rows, "id string, origine string")
    plain = {tuple(r) for r in distinctive.scored_terms(df, "id", "origine").collect()}
    assert {tuple(r) for r in distinctive.scored_terms(df, "id", "origine", hot_share=0.1, hot_least=10).collect()} == plain and len(plain) == 180


def test_typical_terms(spark):
    rows = [("a", "Rare rare râre mot"), ("b", "rare mot mot mot"), ("c", None), ("d", " "), ("a", "Rare rare râre mot")] + [(f"f{i}", "mot plein") for i in range(40)]
    df = spark.createDataFrame([(i, o, 1, "x") for i, o in rows], "id string, origine string, tf int, term string")
    assert {tuple(r) for r in distinctive.typical_terms(df, "id", "origine").collect()} == {("a", "rare")}
    assert distinctive.typical_terms(df.limit(0), "id", "origine").count() == 0


def test_large_counts_are_told_apart():
    """Counts over eight have bins and scores of their own, and those of a few records do not hide a smaller one."""
    tfs, ns, totals = [[20, 100], [3, 9, 2999], [3, 25]], [[900, 20], [1, 1, 1], [1, 1]], [920, 1_000_000, 600]
    (bulk, elite), *rare = distinctive._fit_batch(pd.Series(tfs), pd.Series(ns), pd.Series(totals))
    assert bulk < 0.01 and elite > 0.99 and all(p > 0.99 for scores in rare for p in scores)


def test_a_score_depends_on_its_histogram_alone():
    tfs, ns, totals = [[1, 2], [1, 40], [2, 3, 5, 9, 70]], [[30, 4], [9, 2], [8, 1, 1, 1, 1]], [500, 500, 90]
    alone = [distinctive._fit_batch(pd.Series([t]), pd.Series([n]), pd.Series([total]))[0] for t, n, total in zip(tfs, ns, totals)]
    assert distinctive._fit_batch(pd.Series(tfs), pd.Series(ns), pd.Series(totals)) == alone


def test_typical_terms_of_few_records_equal_brute_force(spark):
    rng = random.Random(4)
    rows = [("a", "deux " * 3), ("b", "deux " * 30)]
    rows += [(f"r{i:02}", " ".join(w for w in ("un", "trois", "quatre") for _ in range(rng.choice([0, 1, 3, 4, 60])))) for i in range(10)]
    counts = {i: Counter(o.split()) for i, o in rows}
    held = Counter(w for c in counts.values() for w in c)
    want = {(i, w) for i, c in counts.items() for w, n in c.items() if n >= 3 and 2 <= held[w] <= 12}
    got = {tuple(r) for r in distinctive.typical_terms(spark.createDataFrame(rows, "id string, origine string"), "id", "origine").collect()}
    assert got == want and {("a", "deux"), ("b", "deux")} < want


def similar(rows, least):
    texts = defaultdict(set)
    for genre, i, t in rows:
        if i is not None and t:
            texts[genre, t].add(i)
    keys = list(texts)
    bags = [Counter(words_py(t)) for _, t in keys]
    out = set()
    for x in range(len(keys)):
        for y in range(x):
            if keys[x][0] == keys[y][0] and (u := sum((bags[x] | bags[y]).values())) and sum((bags[x] & bags[y]).values()) / u >= least:
                out |= {(keys[x][0], min(a, b), max(a, b)) for a in texts[keys[x]] for b in texts[keys[y]] if a != b}
    return out


def corpus(seed, n=150):
    rng = random.Random(seed)
    vocab = [f"mot{i}" for i in range(60)]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            words = rng.choice(rows)[2].split() or ["mot1"]
            for _ in range(rng.randrange(4)):
                at = rng.randrange(len(words))
                words[at : at + rng.randrange(2)] = [rng.choice(vocab)]
            if rng.random() < 0.3:
                rng.shuffle(words)
        else:
            words = rng.choices(vocab[:8] if rng.random() < 0.3 else vocab, k=rng.randrange(1, 30))
        rows.append((rng.choice("np"), f"{i:04}", " ".join(words)))
    return rows + [("n", "9990", ""), ("n", "9991", None), ("n", "9992", "..."), ("n", "9993", "!!!"), (*rows[3][:2], rows[3][2]), ("n", "9994", rows[0][2].upper()), ("n", "9995", rows[0][2])]


@pytest.mark.parametrize("seed,crowd,depth,most", [(1, 800, 3, 5000), (2, 1, 3, 5000), (3, 2, 2, 6), (4, 1, 4, 3)])
def test_near_pairs_equal_brute_force(spark, monkeypatch, seed, crowd, depth, most):
    rows = corpus(seed)
    monkeypatch.setattr(neardup.similar_texts, "__defaults__", (0.8, crowd, depth, most))
    df = spark.createDataFrame([(*r, 7, "clash") for r in rows], "genre string, id string, text string, n int, words string")
    assert {tuple(r) for r in neardup.near_pairs(df, 0.7).collect()} == similar(rows, 0.7)


def test_long_text_and_empty_table(spark):
    long = " ".join(f"w{i}" for i in range(20_000))
    df = spark.createDataFrame([("n", "a", long), ("n", "b", long + " fin"), ("n", "c", "autre")], "genre string, id string, text string")
    assert {tuple(r) for r in neardup.near_pairs(df, 0.7).collect()} == {("n", "a", "b")}
    assert neardup.near_pairs(df.limit(0), 0.7).count() == 0


def test_near_groups_keep_copies_together(spark):
    base = "un deux trois quatre cinq six sept huit neuf dix"
    rows = [("n", "b", base), ("n", "a", base), ("n", "c", base + " onze"), ("n", "z", "tout autre chose ici"), ("n", "y", "tout autre chose ici")]
    got = {tuple(r) for r in neardup.near_groups(spark.createDataFrame(rows, "genre string, id string, text string"), 0.7).collect()}
    assert got == {("n", "a", "a", 1), ("n", "b", "a", 1), ("n", "c", "a", 1), ("n", "y", "y", 0), ("n", "z", "y", 0)}


def test_voronoi_windows_lose_no_pair(spark):
    rows = [(g, i, t) for g, i, t in corpus(9, 120) if g == "n"]
    df = spark.createDataFrame(rows, "genre string, id string, text string")
    toks = neardup.tokens(df.where("text <> ''").select("genre", "text")).cache()
    wide = toks.select(F.lit(1).cast("bigint").alias("region"), "sig", "n", F.lit(0).alias("miss"), F.lit(b"\0" * 32).alias("parity"))
    pairs = voronoi.join_wide(wide, toks, 0.7, most=10, pivots=4).distinct()
    exact = {tuple(r) for r in neardup.verify(pairs, toks.dropDuplicates(["sig"]), 0.7).select("a", "b").collect()}
    one = {r.sig: dict(zip(r.words, r.mults)) for r in toks.collect()}
    want = set()
    for a in one:
        for b in one:
            if a < b:
                both = sum(min(k, one[b].get(w, 0)) for w, k in one[a].items())
                if both / (sum(one[a].values()) + sum(one[b].values()) - both) >= 0.7:
                    want.add((a, b))
    assert exact == want


def test_crowded_regions_go_to_the_pivots_unjoined(spark, monkeypatch):
    """A third of all texts are near copies: their regions are seen beforehand, and the pairs stay those of brute force."""
    rng = random.Random(8)
    hot = [f"m{k}" for k in range(12)]
    rows = [("nom", f"h{i:03}", " ".join([*hot, f"x{i}"])) for i in range(60)] + [("nom", f"r{i:03}", " ".join(f"w{rng.randrange(400)}" for _ in range(12))) for i in range(120)]
    monkeypatch.setattr(neardup, "GIANT_SHARE", 0.05)
    seen = []
    plain = neardup.crowded_regions
    monkeypatch.setattr(neardup, "crowded_regions", lambda *a: seen.append(plain(*a)) or seen[-1])
    df = spark.createDataFrame(rows, "genre string, id string, text string")
    got = {tuple(r) for r in neardup.near_pairs(df, 0.7, depth=1, most=10).collect()}
    assert got == similar(rows, 0.7) and seen[0].count() > 0
