"""Record preparation, sheets, summaries, files and reports on small fixtures."""

import json

import pytest
from pyspark.sql import functions as F

from souche.functions import text as T
from souche.operators import graph, metrics, records, summarize, tfidf, trends
from souche.operators import pipelines as P
from souche.plans.pipelines import _hash_vector
from souche.sources import files

RAW = "n int, prenom string, sexe string, url string, signification string, histoire string, etymologie string, provenance string, id string"


def test_first_names_are_prepared(spark):
    rows = [
        (1, "Ludovica", "fille", "u1", None, "Du germanique, a donné aussi Ludwig, Ludovic, Clovis, etc. Au XIIe siècle.", "", None, "x"),
        (2, "Léa", "fille", None, "sens", "Variantes : Lia, Leah.", None, "France", "x"),
        (3, "Lea", None, None, None, "autre texte", None, None, "x"),
        (4, "Lia", "fille", None, None, "Variantes : Lia, Leah.", None, "France", "x"),
        (5, "Vide", None, None, None, None, None, None, "x"), (6, None, None, None, None, "perdu", None, None, "x"), (7, "", None, None, None, None, None, None, None),
    ]
    got = {r.prenom: r for r in records.prepare_first_names(spark.createDataFrame(rows, RAW), "n").collect()}
    assert got["ludovica"].prenoms_lies == ["ludwig", "ludovic", "clovis"] and got["ludovica"].langue == "germanique" and got["ludovica"].date.valeur == 1150
    assert got["lea"].histoire.startswith("Variantes") and got["lea"].prenoms_lies == ["lia", "leah"] and got["lia"].prenoms_lies == ["leah"]
    assert got["lea"].id_groupe == got["lia"].id_groupe != got["vide"].id_groupe
    new = got["clovis"]
    assert new.prenoms_lies == ["ludovica"] and new.id_groupe == got["ludovica"].id_groupe and new.texte_brut == got["ludovica"].texte_brut and new.histoire is None
    assert got["lea"].id_prenoms_lies == [got["lia"].id, got["leah"].id] and got["vide"].id_prenoms_lies == []
    assert set(got) == {"ludovica", "lea", "lia", "vide", "ludwig", "ludovic", "clovis", "leah"}
    assert records.prepare_first_names(spark.createDataFrame([], RAW), "n").count() == 0


def test_new_surnames_inherit(spark):
    rows = [("i1", "dupont", "Dupont", "pont pierre", ["pontier"]), ("i2", "pontard", "Pontard", "pont pierre", []), ("i3", "seul", "Seul", "", None)]
    df = spark.createDataFrame(rows, "id string, nom string, nom_original string, origine string, noms_lies array<string>")
    got = {r.nom: r for r in records.with_new_surnames(df).collect()}
    assert got["pontier"].id_groupe == got["dupont"].id_groupe == got["pontard"].id_groupe and got["pontier"].origine == "pont pierre"
    assert got["dupont"].id_noms_lies == [got["pontier"].id] and got["pontier"].id_noms_lies == ["i1"] and got["seul"].id_noms_lies == []


def greedy(sentences, k, weighted):
    vec = {}
    for r in weighted:
        vec.setdefault(r.doc, {})[r.term] = r.weight
    dot = lambda a, b: sum(w * vec.get(b, {}).get(t, 0.0) for t, w in vec.get(a, {}).items())
    left = {s: (round(sum(dot(s, o) for o in sentences), 9), at) for at, s in enumerate(sentences)}
    kept = []
    while left and len(kept) < k:
        best = max(left, key=left.get)
        kept.append(best)
        left = {s: v for s, v in left.items() if s != best and dot(s, best) < summarize.SAME}
    return [s for s in sentences if s in kept]


def test_summaries_refill_behind_near_copies(spark):
    near = [f"La forme ancienne du nom vient du latin et de la ville voisine numero {i}." for i in range(60)]
    others = ["Un acte daté du siècle dernier cite un meunier de la vallée.", "Le recensement compte trois foyers dans la commune.", "Une branche cadette habite encore le hameau du bois.", "Le blason porte une tour et deux lions."]
    rows = [(1, i, s) for i, s in enumerate(near + others)] + [(2, 0, "Court. Bref. Non."), (3, 0, "Petit."), (3, 1, "Mini."), (4, 0, "Une phrase assez longue pour rester ici. Une autre phrase bien assez longue aussi."), (5, 0, None), (None, 0, near[0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "g int, o int, t string, doc string")
    got = {r.g: r.resume for r in summarize.summaries(df, "g", "t", "o").collect()}
    docs = spark.createDataFrame([(s, s) for s in near + others + ["Une phrase assez longue pour rester ici.", "Une autre phrase bien assez longue aussi."]], "doc string, s string")
    docs = docs.where(F.col("doc").isin(near + others))
    want = greedy(near + others, 4, tfidf.weights(tfidf.word_terms(docs, "doc", "s"), docs).collect())
    assert len(want) == 4 and got[1] == " ".join(want)
    assert got[2] == "Court. Bref. Non." and got[3] == "Petit. Mini." and got[4].startswith("Une phrase") and set(got) == {1, 2, 3, 4}
    assert summarize.summaries(df.limit(0), "g", "t", "o").count() == 0


def test_rewriting_too_close_is_refused(spark):
    rows = [("a", "Le nom vient du latin."), ("b", "Une racine gauloise."), ("c", "Sans reprise."), ("d", None)]
    df = spark.createDataFrame(rows, "id string, t string")
    cache = spark.createDataFrame([(rows[0][1], "le nom vient du latin"), (rows[1][1], "Racine issue du gaulois.")], "t string, value string").select(F.sha2("t", 256).alias("key"), "value")
    got = {r.key: (r.value, r.source_used) for r in summarize.rewrite(df, "id", "t", cache).collect()}
    assert got == {"a": ("Le nom vient du latin.", True), "b": ("Racine issue du gaulois.", False), "c": ("Sans reprise.", True)}


def test_files_of_one_piece(spark, tmp_path):
    df = spark.range(50, numPartitions=7).select(F.col("id").cast("string").alias("k"), F.concat(F.lit('é"'), F.col("id").cast("string")).alias("v"))
    files.write_json_array(df, f"{tmp_path}/a.json")
    assert sorted(r["k"] for r in json.load(open(f"{tmp_path}/a.json"))) == sorted(str(i) for i in range(50))
    files.write_json_object(df, "k", f"{tmp_path}/o.json")
    assert json.load(open(f"{tmp_path}/o.json"))["7"] == {"v": 'é"7'}
    files.write_json_array(df.limit(0), f"{tmp_path}/e.json")
    assert json.load(open(f"{tmp_path}/e.json")) == []
    assert files.write_csv_files(df, "k", f"{tmp_path}/csv") == sorted("0123456789")
    data = open(f"{tmp_path}/csv/4.csv", "rb").read()
    assert data.startswith(b"\xef\xbb\xbfk,v") and data.count(b"\n") == 12
    assert files.csv_table(spark, f"{tmp_path}/csv/*.csv").count() == 50
    listed = [r.path for r in files.listing(spark, str(tmp_path), ".json").collect()]
    assert [p.rpartition("/")[2] for p in listed if ".parts" not in p] == ["a.json", "e.json", "o.json"]


def test_vectors_are_encoded_once(spark, tmp_path):
    path = f"{tmp_path}/cache"
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None), (5, " ")], "id int, t string")
    first = {r.id: r.vector for r in P.encode_cached(df, "t", _hash_vector, path).collect()}
    more = {r.id: r.vector for r in P.encode_cached(df.union(spark.createDataFrame([(6, "c")], "id int, t string")), "t", _hash_vector, path).collect()}
    assert first[1] == first[3] == more[1] and first[4] is None and first[5] is None and len(more[6]) == 8
    assert spark.read.parquet(path).count() == 3


def test_group_sizes_and_confidence(spark):
    df = spark.createDataFrame([(1,)] * 3 + [(2,)] * 2 + [(3,), (4,), (None,)], "g int")
    got = graph.size_report(df, "g").first()
    assert (got.groups, got.members, got.in_groups, got.singletons, got["median"], got.largest) == (4, 7, 5, 2, 1.5, 3)
    assert [tuple(r) for r in graph.largest(df, "g", 2).collect()] == [(1, 3), (2, 2)]
    assert graph.size_report(df.limit(0), "g").first().groups == 0
    assert graph.confidence(spark.createDataFrame([], "sim double")).first()[0] == 0.88


def test_steps_stop_at_the_first_failure(spark, tmp_path):
    ok = lambda: spark.range(3)
    run = records.run_steps([("one", ok), ("bad", lambda: spark.range(1).select("absent")), ("never", ok)], str(tmp_path))
    assert [(n, s.partition(":")[0]) for n, s, _ in run] == [("one", "ok"), ("bad", "failed")]


@pytest.mark.parametrize("raw,want", [("Tout sur le prénom Amélie", "amelie"), ("Œdipe", "oedipe"), ("Jean-Luc 2", "jean-luc"), ("", ""), (None, None)])
def test_scraped_keys(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "x string").select(T.scraped_key(F.col("x"))).first()[0] == want


def test_decades_of_unknown_names(spark):
    wide = spark.createDataFrame([("a", 3, None), ("a", 1, 1)], "prenom string, _1901_1910 int, _1911_1920 int")
    got = {r.prenom: r for r in trends.with_decades(spark.createDataFrame([("a",), ("b",)], "prenom string"), "prenom", trends.decade_total(wide, ["_1901_1910", "_1911_1920"])).collect()}
    assert got["a"].nombre_total == 3 and got["b"].nombre_total == 0 and got["b"].historique == {}


def test_cache_performance_of_empty_tables(spark):
    df = spark.createDataFrame([], "id int, t string")
    assert metrics.cache_performance(df, ["t"], spark.createDataFrame([], "key string")).first().hit_pct == 0.0
