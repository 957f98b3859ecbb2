"""Close spellings met in tiles: the same pairs as plain Python, whatever the slices."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from souche.operators import graph, matching, spelling, tfidf
from souche.plans import pipelines as plans


def words(n, alphabet, sizes, seed):
    rng = random.Random(seed)
    return sorted({"".join(rng.choice(alphabet) for _ in range(rng.choice(sizes))) for _ in range(n)})


@pytest.mark.parametrize("alphabet,sizes", [("abc", [2, 4, 7, 12]), ("abcdefghij", [3, 6, 9, 64, 65, 70]), ("abcdefghijklmnopqrstuvwxyz '-éœ" + "".join(chr(0x4E00 + i) for i in range(50)), [0, 1, 2, 5, 8]), ("aàb\0", [2, 3, 5])])
def test_close_pairs_are_those_of_plain_python(alphabet, sizes):
    names = words(60, alphabet, sizes, 5)
    half = np.array([i % 2 for i in range(len(names))], np.int8)
    for least in (0.3, 0.75, 0.85):
        want = {(i, j): s for i in range(len(names)) for j in range(i + 1, len(names)) if (s := round(matching.jaro_winkler_py(names[i], names[j]), 9)) >= least}
        found = lambda *x: {(int(i), int(j)): float(s) for part in spelling.close_pairs(names, least, *x) for i, j, s in zip(*part)}
        assert found() == found(None, 7) == want
        assert found(half) == {k: s for k, s in want.items() if (k[0] + k[1]) % 2}


def test_slices_of_a_block_give_the_same_pairs(spark):
    names = ["ma" + x for x in words(80, "abcde", [3, 5, 7], 6)] + ["ba" + x for x in words(9, "abcde", [3, 5], 7)] + ["m", None, ""]
    df = spark.createDataFrame([(n,) for n in names], "nom string").repartition(5)
    want = sorted((r.a, r.b, r.sim) for r in matching.prefix_pairs(df, "nom").withColumn("sim", F.round(matching.jaro_winkler("a", "b"), 9)).where("sim >= 0.75").collect())
    for most in (7, 40, 1000):
        assert sorted(map(tuple, spelling.near(df.where("nom <> ''"), "nom", 2, 0.75, most=most).collect())) == want
    assert spelling.near(df.limit(0), "nom", 2, 0.75).count() == 0


def test_gate_before_pairing_compares_only_names_that_pass(spark):
    df = spark.createDataFrame([("martineau",), ("martinaud",), ("mart",), ("martinot",), ("martineau",)], "nom string")
    asked = lambda c: F.when(c != "martinot", F.length(c) >= 5)  # noqa: E731  unknown for one name: it passes
    named = matching.passing(df, "nom", asked)
    assert sorted(r.nom for r in named.collect()) == ["martinaud", "martineau", "martinot"]
    before = sorted((r.a, r.b) for r in matching.gate(matching.jw_scored(df, "nom"), asked).collect())
    assert sorted((r.a, r.b) for r in matching.jw_scored(named, "nom").collect()) == before != []


def test_cosines_of_carried_texts_equal_those_of_joined_pairs(spark):
    rng = random.Random(4)
    texts = [(f"ma{x}", " ".join(rng.choice(["un", "deux", "trois", "quatre", "cinq", "six", "sept"]) for _ in range(rng.choice([1, 2, 6, 12])))) for x in words(40, "abc", [3, 4, 5], 8)] + [("maabd", "seul"), ("maabdd", "autre")]
    docs = spark.createDataFrame(texts, "doc string, t string")
    terms = tfidf.word_terms(docs, "doc", "t")
    pairs = matching.jw_scored(docs, "doc", least=0.85)
    want = {(r.a, r.b): r.cosine for r in tfidf.pair_cosine(pairs, tfidf.weights(terms, docs)).collect()}
    for small in (0, 1000):
        for most in (9, 1000):
            rows = docs.select("doc").join(tfidf.vectors(terms, docs, small=small).withColumnRenamed("doc", "d"), F.col("d") == F.col("doc"), "left")
            got = {(r.a, r.b): r.cosine for r in spelling.near(rows, "doc", 2, 0.85, vectors=True, most=most, names=docs).collect()}
            assert got == pytest.approx(want) and len(want) > 50 and 0.0 in want.values()


def test_best_of_each_name_do_not_depend_on_the_slices(spark):
    names = ["ma" + x for x in words(90, "abcd", [2, 3, 5, 7], 9)] + ["ba" + x for x in words(12, "abc", [2, 3], 10)]
    df = spark.createDataFrame([(n, n[2], [len(n), 99], [1.0, 2.0]) for n in names], "nom string, l string, terms array<bigint>, weights array<double>")
    for k in (1, 4):
        want = sorted(map(tuple, matching.jw_topk(matching.jw_scored(df, "nom"), k).collect()))
        for most in (30, 1000):
            got = spelling.near(df, "nom", 2, 0.75, k, vectors=True, labels=("l",), most=most).collect()
            assert sorted((r.a, r.b, r.sim) for r in got) == want
            assert all(r.same_l == (r.a[2] == r.b[2]) and r.cosine == pytest.approx(1.0 if len(r.a) == len(r.b) else 0.8) for r in got)
    found = [(np.array([0, 0, 1]), np.array([1, 2, 2]), np.array([0.8, 0.8, 0.9])), (np.array([0]), np.array([3]), np.array([0.95]))]
    for hold in (1, 100):
        assert [x.tolist() for x in spelling._paired(*spelling._best_pairs(iter(found), 1, hold))] == [[0, 1], [3, 2], [0.95, 0.9]]


def test_spanning_edges_keep_the_components(spark):
    rng = random.Random(11)
    edges = [(f"{rng.randrange(80)}", f"{rng.randrange(80)}") for _ in range(70)] + [("x", None)] + [(f"c{i}", f"c{j}") for i in range(20) for j in range(20)]
    df = spark.createDataFrame(edges, "a string, b string").repartition(3)
    want = sorted(map(tuple, graph.components(df).collect()))
    for most in (3, 1000):
        assert sorted(map(tuple, graph.components(graph.spanning(df, most)).collect())) == want
    assert graph.spanning(df.coalesce(1)).where("a LIKE 'c%'").count() == 19


def test_stats_of_groups_come_from_thinned_edges(spark, tmp_path, monkeypatch):
    names = [f"martin{x}{y}" for x in "abcdef" for y in "abcde"]
    rows = [(n, n, "mot rare commun", "mot rare commun") for n in names] + [("seul", "seul", None, None)]
    spark.createDataFrame(rows, "nom string, id string, origine string, origine_brute string").write.parquet(f"{tmp_path}/noms_clean.parquet")
    seen, whole = [], graph.components
    monkeypatch.setattr(graph, "components", lambda edges, *x: seen.append(edges.count()) or whole(edges, *x))
    got = plans.regroup_stats(spark, str(tmp_path)).first()
    assert (got.clusters, got.singletons, got.max_size) == (2, 1, 30)
    assert seen[0] <= 2 * len(names)  # 29 of the star and those of a forest, not all 435 pairs
