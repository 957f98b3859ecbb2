"""Repetition, leaks, mixture and encoding repair against plain Python."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from souche.functions.text import words_py
from souche.llm import contamination, mixture, mojibake, repetition


@given(st.lists(st.sampled_from("abc"), max_size=40))
@settings(max_examples=300, deadline=None)
def test_repeated_words_by_marks(words):
    seen, marks = set(), set()
    for i in range(len(words) - 3):
        run = tuple(words[i : i + 4])
        if run in seen:
            marks |= set(range(i, i + 4))
        seen.add(run)
    assert repetition.repeated_words(words) == len(marks)


def test_jensen_shannon_bounds():
    p = np.array([1.0, 0, 0])
    assert repetition.jensen_shannon(p, p) == 0 and repetition.jensen_shannon(p, np.array([0, 1.0, 0])) == 1
    assert repetition.jensen_shannon(p, np.zeros(3)) == 1


def test_repetitive_rows(spark):
    twice = "un deux trois quatre cinq six sept huit neuf dix onze douze " * 2
    plain = " ".join(f"mot{i}" for i in range(30))
    rows = [("a", twice, None, ""), ("a", twice, None, ""), ("b", plain, "court court court court court", twice), (None, twice, "", ""), ("c", None, None, None)]
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], "id string, histoire string, etymologie string, signification string, share int, champ string")
    assert {tuple(r) for r in repetition.repetitive(df).collect()} == {("a", "histoire"), ("b", "signification")}
    got = {(r.id, r.champ): r for r in repetition.repetition(df).collect()}
    far = {(r.id, r.champ): r for r in repetition.divergence(df.withColumn("langue", F.when(F.col("id") == "a", "FR "))).collect()}
    assert far["b", "etymologie"].js_words is None and got["a", "histoire"].share == pytest.approx(0.5) and 0 <= far["b", "histoire"].js_words <= 1
    assert far["a", "histoire"].langue == "fr" and far["a", "histoire"].js_words == pytest.approx(0) and len(far) == len(got)
    assert repetition.repetitive(df.limit(0)).count() == 0


def test_a_text_said_twice_keeps_its_distances(spark):
    body = "La forme ancienne du nom vient du latin et se lit dans un acte daté de la ville"
    df = spark.createDataFrame([("a", body, "", ""), ("b", body + " " + body, "", "")], "id string, histoire string, etymologie string, signification string")
    rows = {r.id: r for r in repetition.divergence(df.withColumn("langue", F.lit(None).cast("string"))).collect()}
    share = {r.id: r.share for r in repetition.repetition(df).collect()}
    assert rows["a"].js_words == pytest.approx(rows["b"].js_words) and share == {"a": 0, "b": 0.5}


def test_leaks_equal_brute_force(spark):
    rng = random.Random(3)
    items = [(i, " ".join(f"é{rng.randrange(30)}" for _ in range(rng.randrange(5, 30)))) for i in range(12)] + [(99, None), (98, "")]
    items += [(50, items[0][1]), (3, items[3][1])]
    docs = []
    for k in range(80):
        words = [f"d{rng.randrange(50)}" for _ in range(rng.randrange(40))]
        if rng.random() < 0.7:
            w = words_py(rng.choice(items[:12])[1])
            a = rng.randrange(len(w))
            words[5:5] = [x.upper() for x in w[a : a + rng.randrange(8, 20)]]
        docs.append((k, ", ".join(words)))
    docs += [(900, None), (901, ""), (902, docs[0][1])]
    runs = lambda t: {tuple(words_py(t)[i : i + 12]) for i in range(len(words_py(t)) - 11)}
    want = {(d, i) for d, t in docs for i, x in items if runs(t) & runs(x)}
    left = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id bigint, text string, item_id string")
    right = spark.createDataFrame([(i, t, "y") for i, t in items], "item_id bigint, texte string, doc_id string")
    got = contamination.leaks(left, right).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
    texts = dict(docs)
    for r in got:
        assert len(words_py(texts[r.doc_id][r.start : r.end])) == r.run_words >= 12
    assert {tuple(r) for r in contamination.leaks(left, right, most_items=3, most_words=60).collect()} == {tuple(r) for r in got}
    assert contamination.leaks(left, right.limit(0)).count() == 0 and contamination.leaks(left.limit(0), right).count() == 0


@given(st.lists(st.tuples(st.integers(1, 30), st.integers(0, 6)), min_size=1, max_size=8), st.integers(0, 150))
@settings(max_examples=300, deadline=None)
def test_bounded_knapsack_is_best(parts, budget):
    lengths, spare = [n for n, _ in parts], [k for _, k in parts]
    reach = {0}
    for n, k in parts:
        reach = {r + n * c for r in reach for c in range(k + 1) if r + n * c <= budget}
    out = mixture.bounded_knapsack(lengths, spare, budget)
    assert all(0 < c <= spare[i] for i, c in out.items()) and sum(lengths[i] * c for i, c in out.items()) == max(reach)


@given(st.lists(st.tuples(st.integers(1, 400), st.integers(1, 50)), min_size=1, max_size=30, unique_by=lambda x: x[0]), st.floats(0, 1.2))
@settings(max_examples=200, deadline=None)
def test_fit_counts_never_takes_too_much(parts, share):
    lengths, counts = [n for n, _ in parts], [k for _, k in parts]
    total = sum(n * k for n, k in parts)
    budget = int(total * share)
    take = mixture.fit_counts(lengths, counts, budget)
    got = sum(n * t for n, t in zip(lengths, take))
    assert all(0 <= t <= k for t, k in zip(take, counts)) and got <= budget and (budget - got < max(lengths) or got == total)


def test_mixture_keeps_caps_and_targets(spark):
    rng = random.Random(1)
    docs = [(i, " ".join(rng.choices(["nom", "prénom", "lieu", "acte"], k=rng.randrange(1, 60))), rng.choice(["big"] * 6 + ["small", "none"])) for i in range(600)]
    docs += [(1000, None, "big"), (1001, "", "big"), (1002, "mot", None), (1003, docs[0][1], docs[0][2])]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id bigint, text string, source string, tokens int")
    goal = spark.createDataFrame([("big", 0.6, 1), ("small", 0.3, 2), ("absent", 0.1, 3), ("big", 0.6, 1)], "source string, part_cible double, repetitions_max int")
    rows = mixture.chosen(df, goal).collect()
    assert len({r.doc_id for r in rows}) == len(rows) and {r.source for r in rows} <= {"big", "small"}
    assert all(1 <= r.copies <= {"big": 1, "small": 2}[r.source] for r in rows)
    report = {r.source: r for r in mixture.shares(df, goal).collect()}
    assert report["big"].tokens_mix == report["big"].tokens_target and report["absent"].tokens_mix == 0 and report["none"].tokens_mix == 0
    assert {(r.doc_id, r.copies) for r in mixture.chosen(df, goal).collect()} == {(r.doc_id, r.copies) for r in rows}
    assert mixture.chosen(df.limit(0), goal).count() == 0


@pytest.mark.parametrize("chain", ["utf8 as cp1252", "utf8 as latin-1", "utf8 as cp1252, twice", "utf8 as mac", "utf8 as cp850", "utf8 as cp437", "utf8 as cp1251"])
def test_chains_undo_what_they_name(chain):
    for token in ("déjà", "«", "Nîmes,", "où", "œuvre"):
        bad = token
        for read, written in reversed(mojibake.CHAINS[chain]):
            chars = mojibake._tables(read)[1]
            bad = "".join(chars[b] for b in bad.encode(written))
        assert token in mojibake.undo(bad, chain), (token, bad)


def test_garbled_records_are_found_and_restored(spark):
    base = ["La forme légère a été relevée à Évreux près d'un château", "Où vivait déjà un sabotier, l'été, au pré de l'abbé", "Prénom formé à l'époque sur une racine très ancienne"]
    clean = [(i, base[i % 3] + f" n{i}", "s%d" % (i % 2)) for i in range(240)]
    bad = {1000: clean[0][1].encode().decode("latin-1"), 1001: clean[1][1].encode("cp1252").decode("cp437"), 1002: clean[2][1].replace("é", "�"), 1003: base[0] + ". " + base[1].encode().decode("mac_roman")}
    odd = [(2000, "Фамилия пришла из северной деревни", None), (2001, "├── branche aînée\n└── branche cadette", "s1"), (2002, "ÂGE, CHÂTEAU ET GÂTINE : 3 ¼ £ et ½ &eacute;", "s0"), (2003, None, "s0"), (2004, "", "s0")]
    rows = clean + [(k, v, "s0") for k, v in bad.items()] + odd
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id bigint, text string, source string, tokens string")
    assert {r.doc_id for r in mojibake.garbled(df).collect()} == set(bad)
    fixed = {r.doc_id: r for r in mojibake.repaired(df).collect()}
    assert fixed[1000].repaired == clean[0][1] and fixed[1001].repaired == clean[1][1] and fixed[1003].repaired == base[0] + ". " + base[1]
    assert fixed[1002].repaired == clean[2][1]
    assert mojibake.garbled(df.limit(0)).count() == 0


def test_long_clean_text_does_not_outvote_one_damaged_place(spark):
    base = ["La forme légère a été relevée à Évreux près d'un château", "Où vivait déjà un sabotier, l'été, au pré de l'abbé", "Prénom formé à l'époque sur une racine très ancienne"]
    long = ". ".join(base * 150)
    clean = [(i, base[i % 3] + f" n{i}", "s%d" % (i % 2)) for i in range(240)] + [(500, long, "s0"), (501, "Quoi?Non, dit le clerc.", "s1")]
    bad = {
        1000: long.replace("château", "ch�teau", 1),
        1001: long.replace("légère", "légère".encode().decode("cp1252"), 1),
        1002: "Le pr?nom form? par l'abb? est tr?s ancien, la forme l?g?re aussi, relev?e pr?s d'un ch?teau",
    }
    df = spark.createDataFrame(clean + [(k, v, "s0") for k, v in bad.items()], "doc_id bigint, text string, source string")
    fixed = {r.doc_id: r.repaired for r in mojibake.repaired(df).collect()}
    assert set(fixed) == set(bad)
    assert fixed[1000] == long and fixed[1001] == long
    assert "légère" in fixed[1002] and "château" in fixed[1002]
