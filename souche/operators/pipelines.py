"""Whole pipelines: preparing surnames, regrouping surnames and first names, encoding texts once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souche.config import FirstNames, Surnames
from souche.functions import extract as X
from souche.functions import text as T
from souche.operators import graph, matching, serve, skew, spelling, tfidf
from souche.session import cut
from souche.sources import files

# Trade words without weight in notices.
TRADE_WORDS = "prénom prenom personne personnes notamment ainsi également aussi très plus bien peu tout tous cette celui celle ceux celles faire être avoir porter donner venir vouloir dire voir aller saint sainte fête fete jour siècle siecle ans année annee environ vers depuis jusqu nom noms famille".split()


def lemmas(body: Column, least: int = 3, lemmatiser: Callable[[Column], Column] | None = None) -> Column:
    """Terms of a notice joined by blanks; without a lemmatiser, words stand for their lemmas (an approximation)."""
    words = T.words(T.clean_surname_text(body)) if lemmatiser is None else T.words(lemmatiser(body))
    stop = F.array(*(F.lit(w) for w in sorted({T.fold_py(w) for w in TRADE_WORDS})))
    return F.array_join(F.filter(words, lambda w: (F.length(w) >= least) & ~F.array_contains(stop, w)), " ")


def prepare_surnames(raw: DataFrame, name: str, body: str, cfg: Surnames = Surnames()) -> DataFrame:
    """(id, nom, nom_original, origine, noms_lies): normalised records with labelled and close names, themselves left out."""
    key = T.surname_key(F.col(name))
    found = F.concat(X.labelled_names(F.col(body)), X.close_names(F.col(name), F.col(body)))
    links = F.array_distinct(F.filter(F.transform(found, lambda x: T.linked_name(x)), lambda x: x != ""))
    rows = raw.select(T.stable_id(key).alias("id"), key.alias("nom"), T.display_name(key).alias("nom_original"), lemmas(F.col(body), cfg.least_lemma).alias("origine"), links.alias("l"))
    return rows.select("id", "nom", "nom_original", "origine", F.slice(F.array_except("l", F.array("nom")), 1, cfg.most_links).alias("noms_lies"))


def encode(texts: DataFrame, body: str, encoder: Callable[[Column], Column]) -> DataFrame:
    """Texts with their vectors; each distinct text is encoded once."""
    one = texts.where(f"trim({body}) <> ''").select(body).distinct()
    return texts.join(one.select(body, encoder(F.col(body)).alias("vector")), body, "left")


def encode_cached(texts: DataFrame, body: str, encoder: Callable[[Column], Column], path: str) -> DataFrame:
    """Texts with their vectors from a cache at ``path`` (key, vector): only texts it does not hold are encoded and appended.

    The cache goes by hash of the text, so rows may be added, dropped or reordered without making it stale.
    """
    spark = texts.sparkSession
    one = texts.where(f"trim({body}) <> ''").select(F.sha2(body, 256).alias("key"), F.col(body).alias("text")).dropDuplicates(["key"])
    if files.exists(spark, path):
        one = one.join(spark.read.parquet(path).select("key"), "key", "left_anti")
    one.select("key", encoder(F.col("text")).alias("vector")).write.mode("append").parquet(path)
    held = spark.read.parquet(path).dropDuplicates(["key"])
    return texts.withColumn("key", F.sha2(body, 256)).join(held, "key", "left").drop("key")


def regroup_surnames(df: DataFrame, cfg: Surnames = Surnames()) -> DataFrame:
    """(nom, root): groups from equal texts, and close spellings whose blended score passes."""
    one = skew.first_rows(df.select("nom", "id", "origine", "origine_brute"), ["nom"], ["id"])
    one = cut(one.select("nom", F.when(F.trim("origine") != "", F.md5("origine")).alias("doc"), "origine", X.bag_label(F.col("origine_brute"), X.BAG_LANGUAGES).alias("l"), X.bag_label(F.col("origine_brute"), X.BAG_PLACES).alias("g")), "surnames")
    docs = one.where("doc IS NOT NULL").groupBy("doc").agg(F.min("origine").alias("t"))
    rows = one.select("nom", "doc", "l", "g").join(tfidf.vectors(tfidf.word_terms(docs, "doc", "t"), docs), "doc", "left")
    pairs = spelling.near(rows, "nom", cfg.prefix, cfg.jw_least, cfg.top_k, vectors=True, labels=("l", "g"), names=one)
    context = matching.context_score(F.col("cosine"), F.col("same_l"), F.col("same_g"))
    kept = pairs.where(matching.blended(F.col("sim"), context, F.least(F.length("a"), F.length("b"))) >= cfg.final_least).select("a", "b")
    return whole_groups(one.select(F.col("nom").alias("id")), graph.spanning(kept).unionByName(graph.star_edges(one, "nom", "doc")))


def whole_groups(ids: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, root) for all ids, those without edges alone."""
    tied = graph.components(edges)
    return ids.distinct().join(tied, "id", "left").select("id", F.coalesce("root", "id").alias("root"))


def fusion_pairs(pairs: DataFrame, names: DataFrame, generic: DataFrame, radicals: DataFrame, cfg: FirstNames = FirstNames()) -> DataFrame:
    """Candidate pairs of first names that may merge: other groups, long enough names and texts, not both generic, no shared radical that is blocked.

    ``names``: (prenom, texte, groupe); ``generic``: (text_key); ``radicals``: (radical).
    """
    facts = names.select(
        "prenom", "groupe", T.token_count(F.coalesce("texte", F.lit(""))).alias("n"), F.md5(F.trim("texte")).alias("text_key"),
        F.when(F.col("prenom").contains(" "), F.split("prenom", " ")[0]).alias("radical"),
    )
    facts = facts.join(generic.select("text_key", F.lit(True).alias("generic")), "text_key", "left").join(radicals.select("radical", F.lit(True).alias("blocked")), "radical", "left")
    left, right = (facts.select(*(F.col(c).alias(f"{c}_{n}") for c in ("prenom", "groupe", "n", "generic", "radical", "blocked"))) for n in ("a", "b"))
    rows = pairs.join(left, F.col("a") == F.col("prenom_a")).join(right, F.col("b") == F.col("prenom_b"))
    no = F.lit(False)
    both_generic = F.coalesce("generic_a", no) & F.coalesce("generic_b", no)
    blocked = F.coalesce((F.col("radical_a") == F.col("radical_b")) & F.col("blocked_a"), no)
    long = (F.length("a") > cfg.shortest_name) & (F.length("b") > cfg.shortest_name) & (F.least("n_a", "n_b") >= cfg.least_tokens)
    return rows.where((F.col("groupe_a") != F.col("groupe_b")) & long & ~both_generic & ~blocked).select("a", "b")


def near_first_names(names: DataFrame, vectors: DataFrame, groups: DataFrame, cfg: FirstNames = FirstNames()) -> DataFrame:
    """(a, b, sim): ids of first names whose vectors are near, that may merge, and whose composite score passes.

    ``names``: (id, prenom, texte, langue, geo), one row per name; ``vectors``: (pos, id, v), all of
    them meet; ``groups``: (prenom, groupe).
    """
    names, vectors = cut(names.join(groups, "prenom"), "first_names"), cut(vectors, "name_vectors")
    near = serve.knn_self(vectors.select(F.col("pos").alias("id"), "v"), cfg.k, cfg.knn_least)
    near = near.select(F.least("q", "c").alias("q"), F.greatest("q", "c").alias("c"), "sim").distinct()
    facts = names.join(vectors.select("id", "pos"), "id")
    left, right = (facts.select(F.col("pos").alias(p), *(F.col(c).alias(f"{c}_{n}") for c in ("id", "prenom", "langue", "geo"))) for p, n in (("q", "x"), ("c", "y")))
    rows = near.join(left, "q").join(right, "c")
    same = lambda c: F.coalesce((F.col(f"{c}_x") == F.col(f"{c}_y")) & (F.col(f"{c}_x") != ""), F.lit(False))
    rows = cut(rows.where(F.round(matching.composite(F.col("sim"), same("langue"), same("geo")), 9) >= cfg.final_least), "near_names")
    generic = matching.generic_texts(names, "id", "texte", cfg.generic_text)
    radicals = matching.blocked_radicals(names, "prenom", cfg.radical_names)
    free = fusion_pairs(rows.select(F.col("prenom_x").alias("a"), F.col("prenom_y").alias("b")).distinct(), names, generic, radicals, cfg)
    return rows.join(free.select(F.col("a").alias("prenom_x"), F.col("b").alias("prenom_y")), ["prenom_x", "prenom_y"]).select(F.col("id_x").alias("a"), F.col("id_y").alias("b"), "sim")


def regroup_first_names(names: DataFrame, vectors: DataFrame, links: DataFrame, cfg: FirstNames = FirstNames()) -> DataFrame:
    """(id, label): groups from links (a, b), merged along near vectors where the centroids agree; names without a vector go with their group."""
    groups = cut(whole_groups(names.select(F.col("prenom").alias("id")), links).select(F.col("id").alias("prenom"), F.col("root").alias("groupe")), "groups")
    members = cut(names.select("id", "prenom").join(groups, "prenom").join(vectors.select("id", "v"), "id").select("id", F.col("groupe").alias("group"), "v"), "members")
    merged = graph.gated_merge(members, near_first_names(names, vectors, groups, cfg), cfg.centroid_least)
    labels = members.select("id", F.col("group").alias("groupe")).join(merged, "id").groupBy("groupe").agg(F.min("label").alias("label"))
    return names.select("id", "prenom").join(groups, "prenom").join(labels, "groupe", "left").select("id", F.coalesce("label", "groupe").alias("label"))


def member_names(groups: DataFrame, names: DataFrame) -> DataFrame:
    """(id_groupe_total, lot, membres): display names of members in order, those without a record in title case."""
    rows = groups.select("id_groupe_total", "lot", F.posexplode("noms").alias("at", "nom")).distinct()
    shown = names.groupBy("nom").agg(F.min("nom_original").alias("shown"))
    named = rows.join(shown, "nom", "left").withColumn("shown", F.coalesce("shown", T.title_case(F.col("nom"))))
    return named.groupBy("id_groupe_total", "lot").agg(F.array_join(F.transform(F.array_sort(F.collect_set(F.struct("at", "shown"))), lambda x: x["shown"]), ", ").alias("membres"))


def group_members(groups: DataFrame) -> DataFrame:
    """One layout for group files whose member list is called noms, membres or prenoms."""
    lists = [F.col(c) for c in ("noms", "membres", "prenoms") if c in groups.columns]
    return groups.select("id_groupe_total", F.explode(F.coalesce(*lists)).alias("membre"))


def diversification(final: DataFrame, source: str, other: str) -> DataFrame:
    """(id, cosine, length_ratio, fallback): how far each rewritten text is from its source."""
    rows = final.where(f"trim({source}) <> '' AND trim({other}) <> ''").select("id", F.col(source).alias("s"), F.col(other).alias("o"))
    long = rows.select(F.concat(F.lit("s|"), "id").alias("doc"), F.col("s").alias("t")).unionByName(rows.select(F.concat(F.lit("o|"), "id").alias("doc"), F.col("o").alias("t")))
    weighted = tfidf.weights(tfidf.word_terms(long, "doc", "t", bigrams=False), long, 1, 1.0, False)
    cos = tfidf.pair_cosine(rows.select(F.concat(F.lit("s|"), "id").alias("a"), F.concat(F.lit("o|"), "id").alias("b")), weighted)
    ratio = F.try_divide(T.token_count(F.col("o")).cast("double"), T.token_count(F.col("s")))
    return rows.join(cos.select(F.expr("substring(a, 3)").alias("id"), "cosine"), "id").select("id", F.round("cosine", 9).alias("cosine"), F.round(ratio, 9).alias("length_ratio"), (F.round("cosine", 9) > 0.97).alias("fallback"))
