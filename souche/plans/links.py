"""Queries over spelling relatives, TF-IDF, vectors, graphs and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from souche.operators import graph, matching, metrics, pipelines, serve, skew, spelling, summarize, tfidf
from souche.session import cut, read


def _surnames(s, d):
    return read(s, d, "noms_clean")


def _first_names(s, d):
    return read(s, d, "prenoms_clean")


def _scored(s, d):
    return matching.jw_scored(_surnames(s, d), "nom")


def unseen(s, d):
    """Pairs of close spellings that are not tied by a link already."""
    known = matching.explicit_links(_first_names(s, d), "prenom", "prenoms_lies")
    return matching.unseen(matching.jw_scored(_first_names(s, d), "prenom", least=0.85), known)


def merged_cache(s, d):
    return matching.merged_cache(matching.explicit_links(_first_names(s, d), "prenom", "prenoms_lies"), matching.jw_scored(_first_names(s, d), "prenom", least=0.9).select(F.col("b").alias("a"), F.col("a").alias("b")))


def _origins(s, d):
    """Distinct texts of surnames (key: md5)."""
    return _surnames(s, d).where("trim(origine) <> ''").groupBy(F.md5("origine").alias("doc")).agg(F.first("origine").alias("t"))


def _weights(s, d):
    docs = _origins(s, d)
    return tfidf.weights(tfidf.word_terms(docs, "doc", "t"), docs)


def tfidf_norms(s, d):
    w = _weights(s, d)
    return w.groupBy("doc").agg(F.count("*").alias("terms"), F.round(F.sum(F.col("weight") * F.col("weight")), 6).alias("norm"), F.round(F.max("weight"), 9).alias("top"))


def tfidf_cosine(s, d):
    """Pairs of close spellings with the cosine of their texts; a name's weighted text travels with it."""
    one = skew.first_rows(_surnames(s, d).where("trim(origine) <> ''").select("id", "nom", "origine"), ["nom"], ["id"]).select("nom", F.md5("origine").alias("doc"))
    docs = _origins(s, d)
    rows = one.join(tfidf.vectors(tfidf.word_terms(docs, "doc", "t"), docs), "doc", "left")
    return spelling.near(rows, "nom", 2, 0.85, vectors=True, names=one).select("a", "b", F.round("cosine", 9).alias("cosine"))


def composite(s, d):
    """Spelling blended with context for close first names."""
    one = skew.first_rows(_first_names(s, d).select("prenom", "id", "langue", "geo"), ["prenom"], ["id"])
    pairs = matching.jw_scored(_first_names(s, d), "prenom", least=0.85)
    rows = pairs.join(one.select(F.col("prenom").alias("a"), F.col("langue").alias("la"), F.col("geo").alias("ga")), "a").join(one.select(F.col("prenom").alias("b"), F.col("langue").alias("lb"), F.col("geo").alias("gb")), "b")
    same_l, same_g = F.coalesce((F.col("la") == F.col("lb")) & (F.col("la") != ""), F.lit(False)), F.coalesce((F.col("ga") == F.col("gb")) & (F.col("ga") != ""), F.lit(False))
    context = matching.context_score(F.lit(0.0), same_l, same_g)
    score = matching.blended(F.col("sim"), context, F.least(F.length("a"), F.length("b")))
    return rows.select("a", "b", F.round(matching.composite(F.col("sim"), same_l, same_g), 6).alias("composite"), F.round(score, 6).alias("blended")).where("blended >= 0.55")


def _vectors(s, d, name="prenoms_vecteurs"):
    return read(s, d, name).where("embedding IS NOT NULL").select(F.col("pos").alias("id"), F.col("embedding").alias("v"))


def knn_queries(s, d):
    """Exact nearest vectors for the rows whose id (read as a number) is divisible by 20, against all rows."""
    asked = read(s, d, "prenoms_vecteurs").where("embedding IS NOT NULL AND try_cast(conv(id, 16, 10) AS BIGINT) % 20 = 0").select(F.col("pos").alias("id"), F.col("embedding").alias("v"))
    return serve.knn_probe(asked, _vectors(s, d), 5).select("q", "c", F.round("sim", 6).alias("sim"), "rank")


def label_centroids(s, d):
    rows = read(s, d, "embeddings").select("vec_id", "label", F.col("embedding").alias("v"))
    sims = rows.join(graph.centroids(rows, "label", "v"), "label")
    return sims.select("vec_id", "label", F.round(graph.dot(F.col("v"), F.col("centroid")), 6).alias("sim"))


def _edges(s, d):
    return matching.explicit_links(_first_names(s, d), "prenom", "prenoms_lies", 1_000_000_000)


def components(s, d):
    return graph.components(_edges(s, d)).select(F.col("id").alias("prenom"), "root")


def numbered(s, d):
    return graph.numbered(components(s, d))


def cluster_stats(s, d):
    return graph.cluster_stats(read(s, d, "prenoms_grouped").select("id", "id_groupe_total").distinct(), "id_groupe_total")


def star_components(s, d):
    """Records of one exact text, tied as stars and then with their links."""
    texts = _first_names(s, d).where("trim(texte_brut) <> ''").select("prenom", F.md5("texte_brut").alias("g"))
    return graph.components(_edges(s, d).unionByName(graph.star_edges(texts, "prenom", "g"))).select(F.col("id").alias("prenom"), "root")


def _named(s, d):
    rows = _first_names(s, d).select("prenom", "id", F.col("texte_brut").alias("texte"), "langue", "geo")
    vec = read(s, d, "prenoms_vecteurs").where("embedding IS NOT NULL").select("pos", "id", F.col("embedding").alias("v"))
    return skew.first_rows(rows, ["prenom"], ["id", F.desc_nulls_last("langue"), F.desc_nulls_last("geo"), F.desc_nulls_last("texte")]), vec


def gated(s, d):
    """Links start the groups, near vectors of all names merge them where centroids agree."""
    names, vec = _named(s, d)
    groups = cut(pipelines.whole_groups(names.select(F.col("prenom").alias("id")), _edges(s, d)).select(F.col("id").alias("prenom"), F.col("root").alias("groupe")), "groups")
    members = names.select("id", "prenom").join(groups, "prenom").join(vec.select("id", "v"), "id").select("id", F.col("groupe").alias("group"), "v")
    return graph.gated_merge(members, pipelines.near_first_names(names, vec, groups))


def regrouped_first_names(s, d):
    names, vec = _named(s, d)
    return pipelines.regroup_first_names(names, vec, matching.explicit_links(_first_names(s, d), "prenom", "prenoms_lies"))


def cohesion(s, d):
    one = skew.first_rows(_surnames(s, d).where("trim(origine) <> ''").select("nom", "origine", "id"), ["nom"], ["id"]).withColumn("group", F.substring("nom", 1, 2)).withColumn("doc", F.col("nom"))
    w = tfidf.weights(tfidf.char_terms(one, "doc", "nom"), one, 1, 1.0, False)
    return tfidf.cohesion(w, one.select("group", "doc")).select("group", "n", F.round("cohesion", 9).alias("cohesion"))


def _stub(name):
    """Stands for a name scorer: any name of at least five letters passes."""
    return F.length(name) >= 5


QUERIES = {
    "prefix_block_pairs": lambda s, d: matching.prefix_pairs(_surnames(s, d), "nom"),
    "jw_pairs": _scored,
    "jw_topk": lambda s, d: matching.jw_topk(_scored(s, d), 5),
    "ner_gate": lambda s, d: matching.jw_scored(matching.passing(_surnames(s, d), "nom", _stub), "nom").select("a", "b"),
    "explicit_links": lambda s, d: matching.explicit_links(_first_names(s, d), "prenom", "prenoms_lies"),
    "outside_links": lambda s, d: matching.outside_links(_first_names(s, d).select("prenom", "prenoms_lies"), "prenom", "prenoms_lies"),
    "unseen_pairs": unseen,
    "pair_cache": merged_cache,
    "generic_texts": lambda s, d: matching.generic_texts(_first_names(s, d), "id", "texte_brut", 1),
    "blocked_radicals": lambda s, d: matching.blocked_radicals(_first_names(s, d), "prenom", 2),
    "lev_probe": lambda s, d: matching.close_to(_surnames(s, d), "nom", "daibroi"),
    "composite_score": composite,
    "tfidf": tfidf_norms,
    "tfidf_cosine": tfidf_cosine,
    "char_tfidf": cohesion,
    "knn_probe": knn_queries,
    "label_centroids": label_centroids,
    "components": components,
    "cluster_numbers": numbered,
    "cluster_stats": cluster_stats,
    "star_components": star_components,
    "gated_merge": gated,
    "regroup_first_names": regrouped_first_names,
    "majority_vote": lambda s, d: summarize.first_seen_vote(read(s, d, "events").select("user_id", "event_type", "event_id"), "user_id", "event_type", "event_id"),
    "date_vote": lambda s, d: summarize.date_vote(read(s, d, "prenoms_grouped").select("id", "id_groupe_total", "date").distinct(), "id_groupe_total", "id"),
    "extractive_summary": lambda s, d: summarize.summaries(read(s, d, "prenoms_grouped").select("id", "texte_brut", "id_groupe_total").distinct(), "id_groupe_total", "texte_brut", "id"),
    "pack_blocks": lambda s, d: read(s, d, "documents").where("text IS NOT NULL").select("doc_id", F.posexplode(summarize.packed_blocks(F.col("text"))).alias("at", "block")),
}

_J = "SELECT a.nom AS a, b.nom AS b, round(jaro_winkler_similarity(a.nom, b.nom), 9) AS sim FROM (SELECT DISTINCT nom FROM noms_clean WHERE length(nom) >= 2) a JOIN (SELECT DISTINCT nom FROM noms_clean) b ON a.nom[1:2] = b.nom[1:2] AND a.nom < b.nom"
_JW = f"(SELECT * FROM ({_J}) WHERE sim >= 0.75)"
_JP = "(SELECT * FROM (" + _J.replace("noms_clean", "prenoms_clean").replace(".nom", ".prenom").replace("DISTINCT nom", "DISTINCT prenom").replace("length(nom)", "length(prenom)") + ") WHERE sim >= {0})"
_STOP = ", ".join(repr(w) for w in matching.X.LINK_STOPWORDS)
_FK = "trim(regexp_replace(regexp_replace(strip_accents(lower({0})), '[-''’]', ' ', 'g'), '\\s+', ' ', 'g'))"
_CITE = f"""(SELECT DISTINCT source, target FROM (SELECT prenom AS source, {_FK.format('raw')} AS target FROM (SELECT prenom, unnest(prenoms_lies) AS raw FROM prenoms_clean)
    WHERE length(trim(raw)) >= 2 AND regexp_matches(raw, '^[\\p{{L}}\\s-]+$') AND strip_accents(lower(raw)) NOT IN ({_STOP})) WHERE source <> target)"""


def _links(most: int) -> str:
    return f"""(SELECT DISTINCT least(source, target) AS a, greatest(source, target) AS b FROM {_CITE} c WHERE target IN (SELECT target FROM {_CITE} GROUP BY target HAVING count(*) <= {most})
        AND target IN (SELECT prenom FROM prenoms_clean))"""


_DOT = "list_dot_product({0}::DOUBLE[], {1}::DOUBLE[])"
_CC = """WITH RECURSIVE u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
    r AS (SELECT a AS id, a AS o FROM u UNION SELECT r.id, u.b FROM r JOIN u ON u.a = r.o)"""
_TERMS = """t AS (SELECT md5(origine) AS doc, regexp_extract_all(lower(origine), '[\\p{L}\\p{N}\\p{M}_]{2,}') AS w FROM (SELECT DISTINCT origine FROM noms_clean WHERE trim(origine) <> '')),
    x AS (SELECT doc, unnest(w) AS term FROM t UNION ALL SELECT doc, w[i] || ' ' || w[i+1] FROM (SELECT doc, w, unnest(range(1, len(w))) AS i FROM t WHERE len(w) > 1)),
    c AS (SELECT doc, term, count(*) AS tf FROM x GROUP BY ALL), n AS (SELECT count(*) AS n FROM t),
    f AS (SELECT term, count(*) AS df FROM c GROUP BY term HAVING count(*) >= 2 AND count(*) <= 0.95 * (SELECT n FROM n)),
    q AS (SELECT doc, term, (1 + ln(tf)) * (ln((1 + (SELECT n FROM n)) / (1 + df)::DOUBLE) + 1) AS w FROM c JOIN f USING (term)),
    s AS (SELECT doc, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc)) AS weight FROM q)"""

SQL = {
    "prefix_block_pairs": f"SELECT a, b FROM ({_J}) WHERE (2 + least(length(a), length(b)) / greatest(length(a), length(b))::DOUBLE) / 3 + 0.4 * (1 - (2 + least(length(a), length(b)) / greatest(length(a), length(b))::DOUBLE) / 3) >= 0.75",
    "jw_pairs": f"SELECT * FROM {_JW}",
    "jw_topk": f"""WITH w AS (SELECT a, b, sim FROM {_JW} UNION ALL SELECT b, a, sim FROM {_JW}), k AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY sim DESC, b) AS r FROM w)
        SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b, sim FROM k WHERE r <= 5""",
    "ner_gate": f"SELECT a, b FROM {_JW} WHERE length(a) >= 5 AND length(b) >= 5",
    "explicit_links": f"SELECT * FROM {_links(8)}",
    "outside_links": f"SELECT count(*) FILTER (k IN (SELECT prenom FROM prenoms_clean)) AS inside, count(*) FILTER (k NOT IN (SELECT prenom FROM prenoms_clean)) AS outside FROM (SELECT {_FK.format('raw')} AS k FROM (SELECT unnest(prenoms_lies) AS raw FROM prenoms_clean) WHERE trim(raw) <> '')",
    "unseen_pairs": f"SELECT j.* FROM {_JP.format(0.85)} j WHERE NOT EXISTS (SELECT 1 FROM {_links(8)} l WHERE l.a = j.a AND l.b = j.b)",
    "pair_cache": f"SELECT a, b FROM {_links(8)} UNION SELECT a, b FROM {_JP.format(0.9)}",
    "generic_texts": "SELECT md5(trim(texte_brut)) AS text_key, count(DISTINCT id) AS n FROM prenoms_clean WHERE trim(texte_brut) <> '' GROUP BY 1 HAVING count(DISTINCT id) > 1",
    "blocked_radicals": "SELECT string_split(prenom, ' ')[1] AS radical, count(DISTINCT prenom) AS n FROM prenoms_clean WHERE contains(prenom, ' ') AND length(string_split(prenom, ' ')[1]) >= 4 GROUP BY 1 HAVING count(DISTINCT prenom) >= 2",
    "lev_probe": "SELECT DISTINCT nom FROM noms_clean WHERE levenshtein(nom, 'daibroi') <= 2 AND nom <> 'daibroi' ORDER BY nom LIMIT 6",
    "composite_score": f"""WITH o AS (SELECT prenom, langue, geo FROM prenoms_clean QUALIFY row_number() OVER (PARTITION BY prenom ORDER BY id) = 1),
        r AS (SELECT j.a, j.b, sim, coalesce(x.langue = y.langue AND x.langue <> '', false) AS l, coalesce(x.geo = y.geo AND x.geo <> '', false) AS g, least(length(j.a), length(j.b), 15) / 15.0::DOUBLE AS t
          FROM {_JP.format(0.85)} j JOIN o x ON x.prenom = j.a JOIN o y ON y.prenom = j.b),
        z AS (SELECT a, b, round(sim + CASE WHEN l THEN 0.04 ELSE 0 END + CASE WHEN g THEN 0.02 ELSE 0 END, 6)::DOUBLE AS composite, round(t * sim + (1 - t) * (CASE WHEN l THEN 0.3 ELSE 0 END + CASE WHEN g THEN 0.2 ELSE 0 END), 6)::DOUBLE AS blended FROM r)
        SELECT * FROM z WHERE blended >= 0.55""",
    "tfidf": f"WITH {_TERMS} SELECT doc, count(*) AS terms, round(sum(weight * weight), 6) AS norm, round(max(weight), 9) AS top FROM s GROUP BY doc",
    "tfidf_cosine": f"""WITH {_TERMS}, o AS (SELECT nom, md5(origine) AS doc FROM noms_clean WHERE trim(origine) <> '' QUALIFY row_number() OVER (PARTITION BY nom ORDER BY id) = 1)
        SELECT j.a, j.b, round(coalesce((SELECT sum(p.weight * q2.weight) FROM s p JOIN s q2 ON p.term = q2.term WHERE p.doc = x.doc AND q2.doc = y.doc), 0), 9) AS cosine
        FROM (SELECT * FROM {_JW} WHERE sim >= 0.85) j JOIN o x ON x.nom = j.a JOIN o y ON y.nom = j.b""",
    "knn_probe": f"""WITH v AS (SELECT pos, id, embedding AS e FROM prenoms_vecteurs WHERE embedding IS NOT NULL), s AS (SELECT a.pos AS q, b.pos AS c, round({_DOT.format('a.e', 'b.e')}, 9) AS sim FROM v a JOIN v b ON a.pos <> b.pos WHERE ('0x' || a.id)::BIGINT % 20 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY sim DESC, c)::INT AS rank FROM s) SELECT q, c, round(sim, 6) AS sim, rank FROM r WHERE rank <= 5""",
    "label_centroids": """WITH d AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings), m AS (SELECT label, i, avg(x) AS m FROM d GROUP BY ALL),
        c AS (SELECT label, i, m / sqrt(sum(m * m) OVER (PARTITION BY label)) AS m FROM m) SELECT vec_id, label, round(sum(x * m), 6) AS sim FROM d JOIN c USING (label, i) GROUP BY ALL""",
    "components": _CC.replace("RECURSIVE u", f"RECURSIVE e AS {_links(1_000_000_000)}, u") + " SELECT id AS prenom, min(o) AS root FROM r GROUP BY id",
    "cluster_numbers": _CC.replace("RECURSIVE u", f"RECURSIVE e AS {_links(1_000_000_000)}, u") + " SELECT prenom AS id2, root, prenom, dense_rank() OVER (ORDER BY root) AS label FROM (SELECT id AS prenom, min(o) AS root FROM r GROUP BY id)",
    "star_components": _CC.replace("RECURSIVE u", f"""RECURSIVE p AS (SELECT DISTINCT prenom, texte_brut FROM prenoms_clean WHERE trim(texte_brut) <> ''), e AS (SELECT * FROM {_links(1_000_000_000)}
        UNION SELECT m.a, p.prenom FROM p JOIN (SELECT texte_brut, min(prenom) AS a FROM p GROUP BY 1) m USING (texte_brut) WHERE m.a <> p.prenom), u""") + " SELECT id AS prenom, min(o) AS root FROM r GROUP BY id",
    "cluster_stats": """SELECT count(*) AS clusters, count(*) FILTER (n = 1) AS singletons, round(count(*) FILTER (n = 1) * 100.0 / count(*), 6) AS singleton_pct, round(avg(n), 6) AS mean_size, max(n) AS max_size
        FROM (SELECT count(*) AS n FROM (SELECT DISTINCT id, id_groupe_total FROM prenoms_grouped WHERE id_groupe_total IS NOT NULL) GROUP BY id_groupe_total)""",
    "majority_vote": "SELECT user_id, event_type, votes FROM (SELECT user_id, event_type, count(*) AS votes, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, min(event_id)) AS r FROM events WHERE user_id IS NOT NULL GROUP BY user_id, event_type) WHERE r = 1",
    "date_vote": """WITH o AS (SELECT DISTINCT id, id_groupe_total, date.label AS label, date.valeur AS valeur FROM prenoms_grouped WHERE id_groupe_total IS NOT NULL AND date.label <> '')
        SELECT id_groupe_total, label, valeur, votes FROM (SELECT id_groupe_total, label, arg_min(valeur, (id, coalesce(valeur, 9999))) AS valeur, count(*) AS votes, row_number() OVER (PARTITION BY id_groupe_total ORDER BY count(*) DESC, min(id), label) AS r FROM o GROUP BY id_groupe_total, label) WHERE r = 1""",
    "char_tfidf": """WITH o AS (SELECT nom FROM noms_clean WHERE trim(origine) <> '' GROUP BY nom), g AS (SELECT nom, substr(nom, i, k) AS term FROM (SELECT nom, k, unnest(range(1, length(nom) - k + 2)) AS i FROM o, (VALUES (2), (3)) v(k))),
        c AS (SELECT nom, term, count(*) AS tf FROM g WHERE length(term) >= 2 GROUP BY ALL), n AS (SELECT count(*) AS n FROM o), f AS (SELECT term, count(*) AS df FROM c GROUP BY term),
        q AS (SELECT nom, term, tf * (ln((1 + (SELECT n FROM n)) / (1 + df)::DOUBLE) + 1) AS w FROM c JOIN f USING (term)), s AS (SELECT nom, term, w / sqrt(sum(w * w) OVER (PARTITION BY nom)) AS w FROM q),
        p AS (SELECT a.nom[1:2] AS grp, sum(a.w * b.w) AS s FROM s a JOIN s b ON a.term = b.term AND a.nom <> b.nom AND a.nom[1:2] = b.nom[1:2] GROUP BY 1), z AS (SELECT nom[1:2] AS grp, count(*) AS n FROM o GROUP BY 1 HAVING count(*) > 1)
        SELECT grp AS "group", n, round(coalesce(s, 0) / (n * (n - 1)), 9) AS cohesion FROM z LEFT JOIN p USING (grp)""",
}
SQL["cluster_numbers"] = SQL["cluster_numbers"].replace("prenom AS id2, ", "")
