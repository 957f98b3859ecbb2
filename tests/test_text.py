"""Scalars and labels: worked examples and properties."""

import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from souche.functions import extract as X
from souche.functions import text as T


def one(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(expr(F.col("c")).alias("r")).first().r


@given(st.text(max_size=60))
@settings(max_examples=500, deadline=None)
def test_words_by_definition(text):
    plain = "".join(c for c in unicodedata.normalize("NFD", text.lower()) if unicodedata.category(c)[0] != "M")
    want, run = [], ""
    for c in plain + " ":
        if c.isalnum():
            run += c
        elif run:
            want.append(run)
            run = ""
    assert T.words_py(text) == want


@given(st.text(alphabet="aé -'ÎœK", max_size=20))
@settings(max_examples=100, deadline=None)
def test_fold_is_idempotent(text):
    assert T.fold_py(T.fold_py(text)) == T.fold_py(text)


def test_column_and_python_folding_agree(spark):
    values = ["Élodie", "ÀÉÎÕÜ", "œuvre", "Łódź", "İstanbul", "été", "Ångström", "ß", "Ύδρα", None, ""]
    df = spark.createDataFrame([(v,) for v in values], "c string").select("c", T.fold(F.col("c")).alias("f"))
    assert all(r.f == (None if r.c is None else T.fold_py(r.c)) for r in df.collect())


@pytest.mark.parametrize("expr,value,want", [
    (T.surname_key, "  Saint-FREPÔUT  d'Aix ", "saint frepout d'aix"), (T.first_name_key, "Jean-Marie d'Été", "jean marie d ete"),
    (lambda c: T.linked_name(c), "Trôi (XIIe s.) 12", "troi"), (T.display_text, " le  nom vient", "Le nom vient."), (T.display_text, "Oui !", "Oui !"), (T.display_text, "  ", ""),
    (T.title_case, "jean-marie d'aix", "Jean-Marie D'Aix"), (T.pad_department, "1", "01"), (T.pad_department, "971", "971"), (T.pad_department, "2A", "2A"),
    (T.token_count, "  un deux\ttrois ", 3), (T.token_count, " ", 0), (T.clean_first_name_text, "<p>Le <b>nom</b></p> https://a.b/c fin", "Le nom fin"),
    (T.clean_surname_text, "Né en 1900, d'Aix-la - Ville", "ne en d'aix-la ville"), (X.sex_of_url, "/prenom-fille/x", "fille"),
    (lambda c: X.first_label(c, X.LANGUAGES), "Du vieux haut allemand, puis latin", "vieux haut allemand"), (lambda c: X.first_label(c, X.SURNAME_PLACES), "en Île de France", "île-de-france"),
    (lambda c: X.first_label(c, X.LANGUAGES), "relatinisé", ""), (lambda c: X.bag_label(c, X.BAG_LANGUAGES), "du haut au vieux allemand", "vieux haut allemand"),
    (X.roman_value, "XIX", 19), (X.roman_value, "IX", 9), (X.roman_value, "", None), (X.roman_value, "IIII", None), (X.roman_value, "xx", 20),
    (lambda c: X.date_struct(c)["valeur"], "au XIXème siècle", 1850), (lambda c: X.date_struct(c)["label"], "au XIIe siècle, en 1204", "XII siècle"), (lambda c: X.date_struct(c)["valeur"], "relevé en 1204", 1204),
    (lambda c: X.date_struct(c)["label"], "sans date", ""), (lambda c: X.labelled_names(c), "Nom rare. Variantes : Abadi (Sud), Abdi; 12, Abadi. Suite", ["Abadi", "Abdi"]),
    (lambda c: X.labelled_names(c), "Dérivés : Lupin, Lupet. Autre phrase.", ["Lupin", "Lupet"]), (lambda c: X.labelled_names(c), "Formes voisines : Tom. Dérivés : Tim.", ["Tom", "Tim"]),
    (lambda c: X.candidates(c, True), "forme de Jean-Marie ou Marie, terme *iohannes*", ["Jean-Marie", "Jean", "Marie", "iohannes"]),
    (lambda c: X.candidates(c), "également écrit Da Poian ou `âbid`", ["Da", "Poian", "âbid", "Da Poian"]),
])
def test_examples(spark, expr, value, want):
    assert one(spark, expr, value) == want


@pytest.mark.parametrize("text,want", [
    ("qui a donné aussi Ludwig, Ludovic, Clovis, etc.", ["Ludwig", "Ludovic", "Clovis"]), ("se décline aussi en Alicia", ["Alicia"]), ("comme Aelis et Alis sont", ["Aelis", "Alis"]),
    ("forme italienne : Lucia, Lucie", ["Lucia", "Lucie"]), ("entre Adalis, Alis, puis Alix", ["Adalis", "Alis", "Alix"]), ("comme toujours", []), ("", []), (None, []),
])
def test_enumerations(text, want):
    assert X.enumerated_py(text) == want


def test_close_names(spark):
    df = spark.createDataFrame([("aaron", "écrit Aron, Aaronn, Baron ou Zacharie"), ("x", None)], "n string, t string")
    assert [r.r for r in df.select(X.close_names(F.col("n"), F.col("t")).alias("r")).collect()][0] == ["Aron", "Aaronn", "Baron"]


def test_ngrams(spark):
    rows = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "w array<string>")
    assert [r[0] for r in rows.select(T.ngrams(F.col("w"), 2)).collect()] == [["a b", "b c"], [], []]
