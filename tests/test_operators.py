"""Groups, links, vectors, summaries, sources and streams."""

import json
import random
import struct

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from souche.operators import graph, matching, metrics, serve, skew, summarize, tfidf, trends
from souche.sources import files
from souche.streaming import jobs


def test_heavy_keys_and_votes(spark):
    rows = [(1, "a", "x")] * 50 + [(2, None, "x"), (2, "b", ""), (2, " ", "y"), (2, "a", None)] + [(None, "z", "z")] * 10 + [(i, "c", "c") for i in range(100, 140)]
    df = spark.createDataFrame([(*r, 9) for r in rows], "key int, value string, other string, n int")
    assert {tuple(r) for r in skew.heavy_keys(df, "key").collect()} == {(1, 50), (2, 4)}
    assert {tuple(r) for r in skew.vote(df.where("key < 3"), "key", "value").collect()} == {(1, "a", 50), (2, "a", 1)}
    assert skew.heavy_keys(df.limit(0), "key").count() == 0 and skew.vote(df.limit(0), "key", "value").count() == 0


def test_lots(spark):
    df = spark.createDataFrame([(1, 0, ["a", "b"]), (1, 0, ["a", "b"]), (1, 1, ["b", "c", ""]), (2, None, None), (None, 1, ["x"])], "id_groupe_total int, lot int, noms array<string>")
    assert {tuple(r) for r in skew.lot_report(df).collect()} == {(1, 3, 7, 2, 3), (2, 1, 0, 0, 0)}


@pytest.mark.parametrize("seed,hot", [(1, 100_000), (2, 4)])
def test_components(spark, seed, hot):
    rng = random.Random(seed)
    pairs = [(rng.randrange(120), rng.randrange(120)) for _ in range(90)] + [(500, 500 + i) for i in range(40)] + [(700 + i, 701 + i) for i in range(50)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    df = spark.createDataFrame(pairs, "a int, b int")
    got = graph.components(df, hot_least=hot)
    assert {tuple(r) for r in got.collect()} == {(x, find(x)) for x in parent}
    labels = {r.root: r.label for r in graph.numbered(got).collect()}
    assert [labels[k] for k in sorted(labels)] == list(range(1, len(labels) + 1))


def test_gated_merge_reads_whole_groups(spark):
    e = lambda a: [float(np.cos(a)), float(np.sin(a))]
    members = spark.createDataFrame([("a", "a", e(0)), ("b", "b", e(0.1)), ("c", "c", e(0.2)), ("d", "d", e(1.4)), ("z", "z", e(3))], "id string, group string, v array<float>")
    cand = spark.createDataFrame([("a", "b", 0.99), ("b", "c", 0.98), ("c", "d", 0.9)], "a string, b string, sim double")
    got = {r.id: r.label for r in graph.gated_merge(members, cand).collect()}
    assert got == {"a": "a", "b": "a", "c": "a", "d": "d", "z": "z"}


@pytest.mark.parametrize("a,b,want", [("martha", "marhta", 0.961111), ("dixon", "dicksonx", 0.813333), ("dwayne", "duane", 0.84), ("", "", 1.0), ("a", "", 0.0), ("abc", "xyz", 0.0)])
def test_jaro_winkler(a, b, want):
    assert matching.jaro_winkler_py(a, b) == pytest.approx(want, abs=1e-6)


@given(st.text(alphabet="abcd", max_size=8), st.text(alphabet="abcd", max_size=8))
@settings(max_examples=300, deadline=None)
def test_jaro_winkler_bounds(a, b):
    s = matching.jaro_winkler_py(a, b)
    assert 0 <= s <= 1 and s == pytest.approx(matching.jaro_winkler_py(b, a), abs=0.2) and (s == 1) == (a == b)


def test_tfidf_rows_have_unit_length(spark):
    docs = spark.createDataFrame([(1, "le nom rare vient du nom"), (2, "le nom vient"), (3, "autre chose du lieu rare"), (4, ""), (5, None)], "doc int, t string")
    w = tfidf.weights(tfidf.word_terms(docs, "doc", "t"), docs)
    norms = {r.doc: r.n for r in w.groupBy("doc").agg(F.sum(F.col("weight") * F.col("weight")).alias("n")).collect()}
    assert all(n == pytest.approx(1) for n in norms.values())
    cos = {(r.a, r.b): r.cosine for r in tfidf.pair_cosine(spark.createDataFrame([(1, 2), (2, 3), (1, 4), (1, 1)], "a int, b int"), w).collect()}
    assert cos[1, 1] == pytest.approx(1) and cos[1, 4] == 0 and cos[1, 2] > cos[2, 3]


def test_cohesion_equals_pair_mean(spark):
    docs = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate([("abcd", "x"), ("abce", "x"), ("zbcd", "x"), ("qqqq", "y")])], "doc int, t string, group string")
    w = tfidf.weights(tfidf.char_terms(docs, "doc", "t"), docs, 1, 1.0, False)
    pairs = spark.createDataFrame([(0, 1), (0, 2), (1, 2)], "a int, b int")
    mean = tfidf.pair_cosine(pairs, w).agg(F.avg("cosine")).first()[0]
    rows = {r.group: r.cohesion for r in tfidf.cohesion(w, docs.select("group", "doc")).collect()}
    assert rows == {"x": pytest.approx(mean)}


def test_exact_neighbours(spark):
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(300, 8)), 3)
    df = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], "id bigint, v array<double>")
    got = {}
    for r in serve.knn_probe(df.where("id % 20 = 0"), df, 4, chunks=3, block=7).collect():
        got.setdefault(r.q, []).append((r.rank, r.c))
    for q, found in got.items():
        order = sorted((i for i in range(300) if i != q), key=lambda i: (-round(float(x[q] @ x[i]), 9), i))[:4]
        assert [c for _, c in sorted(found)] == order
    assert set(got) == set(range(0, 300, 20))


def test_packing_never_cuts_a_sentence(spark):
    text = "Un deux trois. Quatre cinq. Six sept huit neuf dix onze. Douze."
    assert spark.createDataFrame([(text,)], "t string").select(summarize.packed_blocks(F.col("t"), 5)).first()[0] == ["Un deux trois. Quatre cinq.", "Six sept huit neuf dix onze.", "Douze."]


def test_votes_by_first_seen(spark):
    df = spark.createDataFrame([(1, "b", 1), (1, "a", 2), (1, "a", 3), (1, "b", 4), (2, "", 5), (None, "a", 6)], "g int, v string, o int")
    assert {tuple(r) for r in summarize.first_seen_vote(df, "g", "v", "o").collect()} == {(1, "b", 2)}


def test_rewriting_refuses_what_is_too_close(spark):
    df = spark.createDataFrame([(1, "le nom vient du lieu"), (2, "un autre texte"), (3, " ")], "id int, t string")
    cache = spark.createDataFrame([(1, "LE NOM vient du LIEU")], "i int, value string").join(df.where("id = 1").select(F.sha2("t", 256).alias("key")), F.lit(True)).select("key", "value")
    rows = {r.key: r for r in summarize.rewrite(df, "id", "t", cache, lambda c: F.upper(F.concat(F.lit("tout à fait neuf "), F.lit("et distinct")))).collect()}
    assert rows[1].source_used and rows[1].value == "Le nom vient du lieu." and not rows[2].source_used and 3 not in rows


def test_metrics(spark):
    df = spark.createDataFrame([(True, True), (True, False), (False, True), (False, False)], "t boolean, p boolean")
    r = metrics.pair_scores(df, "t", "p").first()
    assert (r.tp, r.fp, r.fn, r.tn, r.precision, r.recall, r.f1) == (1, 1, 1, 1, 0.5, 0.5, 0.5)
    assert metrics.pair_scores(df.limit(0), "t", "p").first().f1 == 0
    t = spark.createDataFrame([("a", "un deux trois un deux trois un deux trois"), ("b", "court")], "k string, t string")
    got = {r.k: r.share for r in metrics.repeated_trigrams(t, "k", "t").collect()}
    assert got == {"a": pytest.approx(1 / 7), "b": 0}
    lcs = spark.createDataFrame([("a b c d", "b x d")], "a string, b string").select(metrics.rouge_l("a", "b")).first()[0]
    assert lcs == 0.5


def test_trends(spark):
    rows = [("Léa", 2000, "1", 5), ("lea", 2000, "01", 5), ("léa", 2001, "2A", 9), ("léa", 2001, "75", 9), ("_rares", 2001, "75", 99), ("léa", None, "75", 9), ("léa", 2002, "75", 2)]
    m = trends.clean_measures(spark.createDataFrame([(*r, 1) for r in rows], "prenom string, annee int, dept string, count int, id_groupe_total int"))
    r = trends.trends(m).first()
    assert (r.prenom, r.total, r.pic_annee, r.top_depts) == ("lea", 23, 2001, "2A,75,01")


def test_search_orders_and_limits(spark):
    names = spark.createDataFrame([("nom", "martin", "Martin"), ("nom", "mart", "Mart"), ("prenom", "martine", "Martine"), ("prenom", "paul", "Paul")], "type string, key string, label string")
    assert [r.key for r in serve.search(names, "MART").orderBy("rank").collect()] == ["mart", "martin", "martine"]
    assert serve.search(names, "m").count() == 0
    first = serve.search(names, "martin paul").orderBy("rank").first()
    assert (first.type, first.key, first.key2) == ("compare", "paul", "martin")


def test_dbf(spark, tmp_path):
    rows = [("DUPÔNT", 12), ("MARTIN", None), ("GONE", 1)]
    fields = b"".join(struct.pack("<11sc4xBB14x", n, t, s, 0) for n, t, s in ((b"NOM", b"C", 10), (b"_1891_1900", b"N", 6)))
    body = b"".join((b"*" if n == "GONE" else b" ") + n.encode("latin-1").ljust(10) + (b"" if v is None else str(v).encode()).rjust(6) for n, v in rows)
    path = tmp_path / "x.dbf"
    path.write_bytes(struct.pack("<BBBBIHH20x", 3, 1, 1, 1, len(rows), 32 + 64 + 1, 17) + fields + b"\r" + body + b"\x1a")
    spark.dataSource.register(files.DbfSource)
    got = [tuple(r) for r in spark.read.format("dbf").option("rows", "2").load(str(path)).collect()]
    assert got == [("DUPÔNT", 12.0), ("MARTIN", None)]


def test_json_csv_and_pages(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": "1", "x": [1]}, {"id": "2"}]))
    assert files.json_array(spark, str(tmp_path / "a.json"), "id string, x array<int>").count() == 2
    assert files.json_array(spark, str(tmp_path / "none.json"), "id string", tolerant=True).count() == 0
    (tmp_path / "m.json").write_text(json.dumps({"k": "v", "l": "w"}))
    assert {tuple(r) for r in files.json_map(spark, str(tmp_path / "m.json")).collect()} == {("k", "v"), ("l", "w")}
    (tmp_path / "c.csv").write_bytes("﻿prenom,url\nLéa,/a\n".encode())
    assert files.require(files.csv_table(spark, str(tmp_path / "c.csv")), {"prenom", "url"}).first().prenom == "Léa"
    with pytest.raises(ValueError):
        files.require(spark.range(1), {"prenom"})
    html = '<h2 id="a">A</h2><p>un <b>deux</b></p><p> </p><p>trois&amp;</p><h3>x</h3><p>non</p><a class="k prenom-title" href="/z">Zoé</a><a href="" class="prenom-title">vide</a>'
    df = spark.createDataFrame([(1, html), (2, None)], "id int, html string")
    assert [tuple(r) for r in files.sections(df, "id", "html", ["a", "b"]).orderBy("id").collect()] == [(1, "un deux trois&", ""), (2, "", "")]
    assert [tuple(r) for r in files.page_links(df, "id", "html").collect()] == [(1, "/z", "Zoé")]
    assert spark.createDataFrame([("1 234 prénoms",), ("",)], "s string").select(files.page_count(F.col("s"))).collect() == [(42,), (1,)]


def test_streams_resume(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "k int, v string").write.parquet(src)
    jobs.resume(jobs.file_stream(spark, src, "k int, v string"), out, str(tmp_path / "c1"), ["k"]).awaitTermination()
    spark.createDataFrame([(2, "z"), (3, "d")], "k int, v string").write.mode("append").parquet(src)
    jobs.resume(jobs.file_stream(spark, src, "k int, v string"), out, str(tmp_path / "c1"), ["k"]).awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == [1, 2, 3]
