"""Whole pipelines on small fixtures."""

from pyspark.sql import functions as F

from souche.operators import graph, matching, pipelines


def test_prepare_surnames(spark):
    rows = [("Abadie", "Le nom ABADIE désigne une abbaye. Variantes : Abadi, L'Abadie (Sud). On lit Labadie en 1204."), ("Saint-Frépout", "Sans variante"), ("X", None)]
    got = {r.nom: r for r in pipelines.prepare_surnames(spark.createDataFrame(rows, "n string, t string"), "n", "t").collect()}
    assert got["abadie"].noms_lies == ["abadi", "l'abadie", "labadie"] and "abbaye" in got["abadie"].origine.split() and "nom" not in got["abadie"].origine.split()
    assert got["saint frepout"].nom_original == "Saint Frepout" and len(got["saint frepout"].id) == 8


def test_regroup_ties_equal_texts_and_close_spellings(spark):
    rows = [("martineau", "1", "mot rare commun"), ("martinaud", "2", "mot rare commun"), ("zzyx", "3", "mot rare commun"), ("bernard", "4", "autre chose"), ("vide", "5", None), ("videt", "6", "")]
    df = spark.createDataFrame([(*r, r[2]) for r in rows], "nom string, id string, origine string, origine_brute string")
    roots = {r.id: r.root for r in pipelines.regroup_surnames(df).collect()}
    assert roots["martineau"] == roots["martinaud"] == roots["zzyx"] and roots["bernard"] == "bernard" and set(roots) == {r[0] for r in rows}


def test_fusion_filters(spark):
    long = "un deux trois quatre cinq six"
    names = spark.createDataFrame([("marielle", long, "1"), ("marielles", long + " sept", "2"), ("luc", long, "3"), ("lucie a", long, "4"), ("anne sophie", long, "5"), ("anne sophia", long + " x", "6"), ("court", "mot", "7"), ("marieller", long, "1")], "prenom string, texte string, groupe string")
    pairs = spark.createDataFrame([("marielle", "marielles"), ("luc", "lucie a"), ("anne sophia", "anne sophie"), ("court", "marielle"), ("marielle", "marieller")], "a string, b string")
    generic = spark.createDataFrame([], "text_key string, n bigint")
    radicals = matching.blocked_radicals(names, "prenom", 2)
    assert {tuple(r) for r in pipelines.fusion_pairs(pairs, names, generic, radicals).collect()} == {("marielle", "marielles")}
    same = names.groupBy(F.md5(F.trim("texte")).alias("text_key")).agg(F.count("*").alias("n"))
    assert pipelines.fusion_pairs(pairs, names, same, radicals).count() == 0


def test_encode_runs_once_per_text(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, " "), (4, None)], "id int, t string")
    rows = {r.id: r.vector for r in pipelines.encode(df, "t", lambda c: F.array(F.length(c).cast("float"))).collect()}
    assert rows == {1: [1.0], 2: [1.0], 3: None, 4: None}


def test_whole_groups_keep_the_lonely(spark):
    ids = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "id string")
    edges = spark.createDataFrame([("b", "a"), ("b", "b"), (None, "c")], "a string, b string")
    assert {tuple(r) for r in pipelines.whole_groups(ids, edges).collect()} == {("a", "a"), ("b", "a"), ("c", "c")}


def test_outliers_and_stats(spark):
    df = spark.createDataFrame([("a", 1, [1.0, 0.0]), ("b", 1, [1.0, 0.1]), ("c", 1, [0.0, 1.0]), ("d", 2, [1.0, 0.0])], "id string, g int, v array<float>")
    assert [r.id for r in graph.outliers(df, "id", "g", "v", 0.7).collect()] == ["c"]
    s = graph.cluster_stats(df, "g").first()
    assert (s.clusters, s.singletons, s.singleton_pct, s.mean_size, s.max_size) == (2, 1, 50.0, 2.0, 3)
    assert graph.cluster_stats(df.limit(0), "g").first().clusters == 0


def test_first_names_merge_along_all_near_vectors(spark):
    x, y = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [("01", "marielle", x), ("02", "marinette", x), ("03", "gaspard", y), ("04", "gaspardine", None), ("05", "melchior", [0.0, 0.95, 0.31])]
    text = "un nom de cinq mots au moins "
    names = spark.createDataFrame([(i, n, text + n, "fr", "") for i, n, _ in rows], "id string, prenom string, texte string, langue string, geo string")
    vec = spark.createDataFrame([(at, i, v) for at, (i, _, v) in enumerate(rows) if v], "pos bigint, id string, v array<float>")
    links = spark.createDataFrame([("gaspard", "gaspardine")], "a string, b string")
    got = {r.id: r.label for r in pipelines.regroup_first_names(names, vec, links).collect()}
    assert got == {"01": "marielle", "02": "marielle", "03": "gaspard", "04": "gaspard", "05": "gaspard"}
