"""Queries over whole pipelines."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from souche.operators import graph, matching, metrics, pipelines, skew
from souche.session import read


@F.pandas_udf(ArrayType(FloatType()))
def _hash_vector(t: pd.Series) -> pd.Series:
    """Stands for an encoder: eight numbers from the text's hash."""
    return t.map(lambda x: [b / 255 for b in hashlib.md5(x.encode()).digest()[:8]])


def fusion(s, d):
    names = read(s, d, "prenoms_grouped")
    one = skew.first_rows(names.select("prenom", "id", F.col("texte_brut").alias("texte"), F.col("id_groupe_total").cast("string").alias("groupe")), ["prenom"], ["id"])
    pairs = matching.jw_scored(one, "prenom", least=0.85).select("a", "b")
    return pipelines.fusion_pairs(pairs, one, matching.generic_texts(names, "id", "texte_brut", 1), matching.blocked_radicals(names, "prenom", 2))


def encoded(s, d):
    rows = read(s, d, "prenoms_clean").select("id", "texte_brut").distinct()
    return pipelines.encode(rows, "texte_brut", _hash_vector).select("id", F.size("vector").alias("dims"))


def regroup_stats(s, d):
    return graph.cluster_stats(pipelines.regroup_surnames(read(s, d, "noms_clean")), "root")


def prepared(s, d):
    one = skew.first_rows(read(s, d, "noms_clean").where("origine_brute <> ''").select("id", "nom_original", "origine_brute"), ["id"], ["nom_original"])
    return pipelines.prepare_surnames(one, "nom_original", "origine_brute").select("id", "nom", "nom_original", "origine", F.array_join("noms_lies", ",").alias("noms_lies"))


def _final(s, d):
    return skew.first_rows(read(s, d, "prenoms_final").select("id", "histoire", "histoire_v"), ["id"], ["histoire"])


def diversification_summary(s, d):
    return metrics.describe(pipelines.diversification(_final(s, d), "histoire", "histoire_v"), "cosine")


QUERIES = {
    "prepare_surnames": prepared,
    "regroup_surnames": lambda s, d: pipelines.regroup_surnames(read(s, d, "noms_clean")),
    "regroup_stats": regroup_stats,
    "fusion_pairs": fusion,
    "encode_once": encoded,
    "member_names": lambda s, d: pipelines.member_names(skew.first_rows(read(s, d, "groupes_finals").select("id_groupe_total", "lot", "noms"), ["id_groupe_total", "lot"], ["id_groupe_total"]), read(s, d, "noms_clean")),
    "group_layout": lambda s, d: pipelines.group_members(read(s, d, "groupes_finals")).distinct(),
    "diversification": lambda s, d: pipelines.diversification(_final(s, d), "histoire", "histoire_v"),
    "diversification_summary": diversification_summary,
}

SQL = {
    "encode_once": "SELECT DISTINCT id, texte_brut, CASE WHEN trim(texte_brut) <> '' THEN 8 END AS dims FROM prenoms_clean",
    "member_names": """WITH g AS (SELECT id_groupe_total, lot, any_value(noms) AS noms FROM groupes_finals GROUP BY ALL), m AS (SELECT id_groupe_total, lot, unnest(noms) AS nom, unnest(range(len(noms))) AS seq FROM g),
        s AS (SELECT nom, min(nom_original) AS shown FROM noms_clean GROUP BY nom)
        SELECT id_groupe_total, lot, string_agg(coalesce(shown, array_to_string(list_transform(regexp_extract_all(lower(m.nom), '\\p{L}+|[^\\p{L}]+'), lambda w: upper(w[1]) || w[2:]), '')), ', ' ORDER BY seq) AS membres
        FROM m LEFT JOIN s ON s.nom = m.nom GROUP BY ALL""",
    "group_layout": "SELECT DISTINCT id_groupe_total, unnest(noms) AS membre FROM groupes_finals",
    "diversification": """WITH r AS (SELECT id, any_value(histoire) AS s, any_value(histoire_v) AS o FROM prenoms_final GROUP BY id), q AS (SELECT * FROM r WHERE trim(s) <> '' AND trim(o) <> ''),
        l AS (SELECT 's|' || id AS doc, s AS t FROM q UNION ALL SELECT 'o|' || id, o FROM q), c AS (SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(regexp_extract_all(lower(t), '[\\p{L}\\p{N}\\p{M}_]{2,}')) AS term FROM l) GROUP BY ALL),
        n AS (SELECT count(*) AS n FROM l), f AS (SELECT term, count(*) AS df FROM c GROUP BY term), w AS (SELECT doc, term, tf * (ln((1 + (SELECT n FROM n)) / (1 + df)::DOUBLE) + 1) AS w FROM c JOIN f USING (term)),
        u AS (SELECT doc, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc)) AS w FROM w), d AS (SELECT a.doc[3:] AS id, sum(a.w * b.w) AS c FROM u a JOIN u b ON a.term = b.term AND a.doc[1] = 's' AND b.doc[1] = 'o' AND a.doc[3:] = b.doc[3:] GROUP BY 1)
        SELECT q.id, round(coalesce(c, 0), 9) AS cosine, round(len(string_split(trim(regexp_replace(o, '\\s+', ' ', 'g')), ' '))::DOUBLE / len(string_split(trim(regexp_replace(s, '\\s+', ' ', 'g')), ' ')), 9) AS length_ratio, round(coalesce(c, 0), 9) > 0.97 AS fallback FROM q LEFT JOIN d ON d.id = q.id""",
}
SQL["encode_once"] = "SELECT id, dims FROM (" + SQL["encode_once"] + ")"
SQL["diversification_summary"] = "SELECT count(cosine) AS n, round(avg(cosine), 6) AS mean, round(stddev_samp(cosine), 6) AS std, min(cosine) AS min, " + ", ".join(f"round(quantile_cont(cosine, {q / 100}), 6) AS p{q}" for q in (10, 25, 50, 75, 90)) + f", max(cosine) AS max FROM ({SQL['diversification']})"
_SQUEEZED = "trim(regexp_replace(coalesce(t, ''), '[\\s\\x{a0}\\x{85}\\p{Z}]+', ' ', 'g'))"
SQL["fusion_pairs"] = f"""WITH o AS (SELECT prenom, texte_brut AS t, id_groupe_total::VARCHAR AS g FROM prenoms_grouped QUALIFY row_number() OVER (PARTITION BY prenom ORDER BY id) = 1),
        ge AS (SELECT trim(texte_brut) AS t FROM prenoms_grouped WHERE trim(texte_brut) <> '' GROUP BY 1 HAVING count(DISTINCT id) > 1),
        ra AS (SELECT string_split(prenom, ' ')[1] AS r FROM (SELECT DISTINCT prenom FROM prenoms_grouped) WHERE contains(prenom, ' ') AND length(string_split(prenom, ' ')[1]) >= 4 GROUP BY 1 HAVING count(*) >= 2),
        f AS (SELECT prenom, g, CASE WHEN {_SQUEEZED} = '' THEN 0 ELSE len(string_split({_SQUEEZED}, ' ')) END AS n, coalesce(trim(t) IN (SELECT t FROM ge), false) AS gen, CASE WHEN contains(prenom, ' ') THEN string_split(prenom, ' ')[1] END AS r FROM o)
        SELECT a.prenom AS a, b.prenom AS b FROM f a JOIN f b ON a.prenom[1:2] = b.prenom[1:2] AND a.prenom < b.prenom AND length(a.prenom) > 4 AND length(b.prenom) > 4 AND a.g <> b.g AND least(a.n, b.n) >= 5
        WHERE round(jaro_winkler_similarity(a.prenom, b.prenom), 9) >= 0.85 AND NOT (a.gen AND b.gen) AND NOT coalesce(a.r = b.r AND a.r IN (SELECT r FROM ra), false)"""
