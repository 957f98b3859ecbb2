"""Queries of the training-data problems over their whole tables, and their SQL where SQL can say them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souche.llm import components, contamination, distinctive, mixture, mojibake, neardup, repetition, vectors
from souche.session import read

SIMILAR_WORDS = 0.7
# regions of one word, and pivots for those that hold over this share of the texts: the same pairs by the pivots' path
PIVOTS_EARLY = {"depth": 1, "most": 0.005}


def _texts(s: SparkSession, d: str) -> DataFrame:
    surnames = read(s, d, "noms_clean").select(F.lit("nom").alias("genre"), "id", F.col("origine_brute").alias("text"))
    return surnames.unionByName(read(s, d, "prenoms_clean").select(F.lit("prenom").alias("genre"), "id", F.col("texte_brut").alias("text")))


def queries() -> dict:
    return {
        "p1_found": lambda s, d: repetition.repetitive(read(s, d, "prenoms_final")),
        "p1_shares": lambda s, d: repetition.repetition(read(s, d, "prenoms_final")).withColumn("share", F.round("share", 9)),
        "p1_distances": lambda s, d: repetition.divergence(read(s, d, "prenoms_final")),
        "p2_found": lambda s, d: components.name_groups(read(s, d, "noms_clean"), read(s, d, "prenoms_clean")),
        "p3_found": lambda s, d: distinctive.typical_terms(read(s, d, "noms_clean"), "id", "origine"),
        "p3_scores": lambda s, d: distinctive.scored_terms(read(s, d, "noms_clean"), "id", "origine"),
        "p4_found": lambda s, d: neardup.near_pairs(_texts(s, d), SIMILAR_WORDS),
        "p4_pivots": lambda s, d: neardup.near_pairs(_texts(s, d), SIMILAR_WORDS, **PIVOTS_EARLY),
        "p4_groups": lambda s, d: neardup.near_groups(_texts(s, d), SIMILAR_WORDS),
        "p6_found": lambda s, d: vectors.similar_pairs(read(s, d, "prenoms_vecteurs"), 0.8, 5),
        "p6_neighbours": lambda s, d: vectors.neighbours(read(s, d, "prenoms_vecteurs"), 5).withColumn("similarity", F.round("similarity", 6)),
        "p7_found": lambda s, d: contamination.leaks(read(s, d, "documents"), read(s, d, "items_eval")).select("doc_id", "item_id"),
        "p7_items": lambda s, d: contamination.leaked_items(read(s, d, "documents"), read(s, d, "items_eval")),
        "p8_mix": lambda s, d: mixture.chosen(read(s, d, "documents"), read(s, d, "sources_cibles")),
        "p8_shares": lambda s, d: mixture.shares(read(s, d, "documents"), read(s, d, "sources_cibles")),
        "p9_found": lambda s, d: mojibake.garbled(read(s, d, "documents")).select("doc_id"),
        "p9_repaired": lambda s, d: mojibake.repaired(read(s, d, "documents")),
    }


_WORDS = r"list_filter(regexp_split_to_array(strip_accents(lower({0})), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"


def _p2_side(genre: str, table: str, name: str, links: str, blanks: str) -> str:
    return rf"""
        SELECT DISTINCT '{genre}' AS genre, a.id AS a, b.id AS b
        FROM (SELECT id, trim(regexp_replace(regexp_replace(strip_accents(lower(regexp_replace(regexp_replace(l, '\([^)]*\)', ' ', 'g'), '[0-9]+', '', 'g'))), '{blanks}', ' ', 'g'), '\s+', ' ', 'g')) AS k
              FROM (SELECT id, unnest({links}) AS l FROM {table})) a
        JOIN {table} b ON b.{name} = a.k AND b.id <> a.id"""


def _p4_side(genre: str, table: str, column: str) -> str:
    return f"""
        SELECT DISTINCT '{genre}' AS genre, id, {column} AS body, {_WORDS.format(column)} AS w FROM {table} WHERE {column} <> ''"""


_P1 = f"""WITH t AS (
              SELECT DISTINCT id, champ, {_WORDS.format("body")} AS w FROM (
                SELECT id, 'histoire' AS champ, histoire AS body FROM prenoms_final
                UNION ALL SELECT id, 'etymologie', etymologie FROM prenoms_final
                UNION ALL SELECT id, 'signification', signification FROM prenoms_final) WHERE trim(body) <> ''),
            g AS (SELECT id, champ, w, unnest(range(1, greatest(len(w) - 2, 1))) AS i FROM t),
            h AS (SELECT id, champ, w, len(w) AS n, i, row_number() OVER (PARTITION BY id, champ, w, w[i], w[i+1], w[i+2], w[i+3] ORDER BY i) AS r FROM g),
            p AS (SELECT DISTINCT id, champ, w, n, i + k AS at FROM h, (SELECT unnest(range(4)) AS k) WHERE r > 1)"""


def oracle_sql() -> dict[str, str]:
    out = {
        "p1_found": f"""
            WITH t AS (
              SELECT DISTINCT id, champ, {_WORDS.format("body")} AS w FROM (
                SELECT id, 'histoire' AS champ, histoire AS body FROM prenoms_final
                UNION ALL SELECT id, 'etymologie', etymologie FROM prenoms_final
                UNION ALL SELECT id, 'signification', signification FROM prenoms_final) WHERE body <> ''),
            g AS (SELECT id, champ, w, unnest(range(1, greatest(len(w) - 2, 1))) AS i FROM t WHERE len(w) >= 12),
            h AS (SELECT id, champ, len(w) AS n, i, row_number() OVER (PARTITION BY id, champ, w[i], w[i+1], w[i+2], w[i+3] ORDER BY i) AS r FROM g),
            p AS (SELECT DISTINCT id, champ, n, i + k AS at FROM h, (SELECT unnest(range(4)) AS k) WHERE r > 1)
            SELECT id, champ FROM p GROUP BY id, champ, n HAVING count(*) >= 0.4 * n""",
        "p1_shares": f"""
            {_P1}, c AS (SELECT id, champ, w, count(*) AS k FROM p GROUP BY id, champ, w)
            SELECT DISTINCT t.id, t.champ, len(t.w)::INT AS n_words, coalesce(k, 0)::INT AS repeated, round(CASE WHEN len(t.w) > 0 THEN coalesce(k, 0) / len(t.w) ELSE 0 END, 9) AS share
            FROM t LEFT JOIN c ON c.id = t.id AND c.champ = t.champ AND c.w = t.w""",
        "p2_found": f"""
            WITH RECURSIVE e AS ({_p2_side("nom", "noms_clean", "nom", "noms_lies", "-")}
              UNION {_p2_side("prenom", "prenoms_clean", "prenom", "prenoms_lies", "[-''’]")}),
            u AS (SELECT genre, a, b FROM e UNION SELECT genre, b, a FROM e),
            r AS (SELECT genre, a AS id, a AS other FROM u UNION SELECT r.genre, r.id, u.b FROM r JOIN u ON u.genre = r.genre AND u.a = r.other)
            SELECT genre, id, min(other) AS id_min FROM r GROUP BY genre, id""",
        "p3_found": r"""
            WITH t AS (SELECT id, unnest(regexp_split_to_array(strip_accents(lower(origine)), '\s+')) AS terme FROM (SELECT DISTINCT id, origine FROM noms_clean)),
            c AS (SELECT id, terme, count(*) AS tf FROM t WHERE terme <> '' GROUP BY id, terme),
            d AS (SELECT terme, count(*) AS df FROM c GROUP BY terme HAVING count(*) BETWEEN 2 AND 12)
            SELECT id, terme FROM c JOIN d USING (terme) WHERE tf >= 3""",
        "p4_found": f"""
            WITH t AS ({_p4_side("nom", "noms_clean", "origine_brute")} UNION ALL {_p4_side("prenom", "prenoms_clean", "texte_brut")}),
            one AS (SELECT genre, id, body, len(w) AS n, unnest(w) AS x FROM t WHERE len(w) > 0),
            k AS (SELECT genre, id, body, n, x, count(*) AS c FROM one GROUP BY ALL)
            SELECT DISTINCT a.genre, a.id AS id_a, b.id AS id_b
            FROM k a JOIN k b ON a.genre = b.genre AND a.x = b.x AND a.id < b.id
            WHERE a.body <> b.body
            GROUP BY a.genre, a.id, b.id, a.body, b.body, a.n, b.n
            HAVING sum(least(a.c, b.c)) >= 0.7 * (a.n + b.n - sum(least(a.c, b.c)))""",
        "p6_found": """
            WITH v AS (SELECT DISTINCT pos, embedding::DOUBLE[] AS e FROM prenoms_vecteurs WHERE embedding IS NOT NULL),
            s AS (SELECT a.pos AS p, b.pos AS q, round(list_dot_product(a.e, b.e), 12) AS sim FROM v a JOIN v b ON a.pos <> b.pos),
            r AS (SELECT p, q, sim, row_number() OVER (PARTITION BY p ORDER BY sim DESC, q) AS k FROM s)
            SELECT DISTINCT least(p, q) AS pos_a, greatest(p, q) AS pos_b FROM r WHERE k <= 5 AND sim >= 0.8""",
        "p6_neighbours": """
            WITH v AS (SELECT DISTINCT pos, embedding::DOUBLE[] AS e FROM prenoms_vecteurs WHERE embedding IS NOT NULL),
            s AS (SELECT a.pos AS p, b.pos AS q, round(list_dot_product(a.e, b.e), 12) AS sim FROM v a JOIN v b ON a.pos <> b.pos),
            r AS (SELECT p, q, sim, row_number() OVER (PARTITION BY p ORDER BY sim DESC, q) AS k FROM s)
            SELECT p AS pos, q AS other, round(sim, 6) AS similarity, k::INT AS rank FROM r WHERE k <= 5""",
        "p7_found": f"""
            WITH i AS (SELECT item_id, {_WORDS.format("texte")} AS w FROM items_eval),
            g AS (SELECT DISTINCT item_id, w[k:k+11] AS run FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 1))) AS k FROM i) WHERE len(w) >= 12),
            d AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
            h AS (SELECT DISTINCT doc_id, w[k:k+11] AS run FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 10, 1))) AS k FROM d WHERE len(w) >= 12))
            SELECT DISTINCT doc_id, item_id FROM h JOIN g USING (run)""",
    }
    out["p4_pivots"] = out["p4_found"]
    out["p4_groups"] = f"""
            WITH RECURSIVE t AS ({_p4_side("nom", "noms_clean", "origine_brute")} UNION ALL {_p4_side("prenom", "prenoms_clean", "texte_brut")}),
            v AS (SELECT genre, s, row_number() OVER () AS v FROM (SELECT DISTINCT genre, list_sort(w) AS s FROM t WHERE len(w) > 0)),
            k AS (SELECT genre, v, n, x, count(*) AS c FROM (SELECT genre, v, len(s) AS n, unnest(s) AS x FROM v) GROUP BY ALL),
            e AS (SELECT a.v AS a, b.v AS b FROM k a JOIN k b ON a.genre = b.genre AND a.x = b.x AND a.v < b.v GROUP BY a.v, b.v, a.n, b.n
                  HAVING sum(least(a.c, b.c)) >= 0.7 * (a.n + b.n - sum(least(a.c, b.c)))),
            u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
            r AS (SELECT v AS v, v AS o FROM v UNION SELECT r.v, u.b FROM r JOIN u ON u.a = r.o),
            g AS (SELECT v, min(o) AS g FROM r GROUP BY v), l AS (SELECT a AS v, count(*) AS links FROM u GROUP BY a),
            m AS (SELECT t.genre, t.id, g.g, coalesce(l.links, 0) AS links FROM (SELECT DISTINCT genre, id, body, list_sort(w) AS s FROM t) t JOIN v ON v.genre = t.genre AND v.s = t.s JOIN g ON g.v = v.v LEFT JOIN l ON l.v = v.v),
            z AS (SELECT genre, g, min(id) AS id_min FROM m GROUP BY genre, g HAVING count(*) > 1)
            SELECT m.genre, m.id, min(id_min) AS id_min, max(links) AS links FROM m JOIN z ON z.genre = m.genre AND z.g = m.g GROUP BY m.genre, m.id"""
    out["p7_items"] = f"""
            WITH i AS (SELECT item_id, {_WORDS.format("texte")} AS w FROM items_eval), d AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
            g AS (SELECT DISTINCT item_id, k, w[k:k+11] AS run FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 1))) AS k FROM i) WHERE len(w) >= 12),
            h AS (SELECT DISTINCT doc_id, k AS j, w[k:k+11] AS run FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 10, 1))) AS k FROM d WHERE len(w) >= 12)),
            m AS (SELECT DISTINCT doc_id, item_id, j, j - k AS away FROM h JOIN g USING (run)),
            s AS (SELECT *, j - row_number() OVER (PARTITION BY doc_id, item_id, away ORDER BY j) AS stretch FROM m),
            n AS (SELECT doc_id, item_id, count(*) + 11 AS run FROM s GROUP BY doc_id, item_id, away, stretch)
            SELECT item_id, count(DISTINCT doc_id) AS documents, max(run)::INT AS longest_run FROM n GROUP BY item_id"""
    return out
