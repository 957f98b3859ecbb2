"""Queries of the lookup side: search, sheets, statistics; sources, sinks and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from souche.operators import serve, skew, trends
from souche.session import own_dir, read
from souche.sources import files
from souche.streaming import jobs


def _names(s, d):
    return serve.keys(read(s, d, "noms_clean"), read(s, d, "prenoms_clean"))


def _first_pair(s, d):
    """A query of two words that are a first name and a surname: the smallest of each without blanks."""
    row = read(s, d, "prenoms_clean").where("NOT contains(prenom, ' ')").agg(F.min("prenom")).first(), read(s, d, "noms_clean").where("NOT contains(nom, ' ')").agg(F.min("nom")).first()
    return f"{row[0][0]} {row[1][0]}"


def _measures(s, d):
    return trends.clean_measures(read(s, d, "prenoms_stats"))


def star(s, d):
    totals = _measures(s, d).groupBy(F.col("prenom").alias("name")).agg(F.sum("count").alias("total"))
    one = skew.first_rows(read(s, d, "prenoms_final").select("id", F.col("prenom").alias("name"), F.col("prenoms_groupe").alias("related")), ["id"], ["name"])
    return serve.star(one, totals)


def trending(s, d):
    t = trends.trends(_measures(s, d)).where("pic_annee >= 2018")
    return serve.top_then_known(t, read(s, d, "prenoms_clean"), "total").select("prenom", "total", "pic_annee")


def top_names(s, d):
    return serve.top_then_known(trends.trends(_measures(s, d)), read(s, d, "prenoms_clean"), "total").select("prenom", "total")


def candidate(s, d):
    rows = read(s, d, "prenoms_vecteurs").where("embedding IS NOT NULL").select("pos", "id", F.col("embedding").alias("v"))
    probe = rows.orderBy("pos").limit(1).first()
    meta = skew.first_rows(read(s, d, "prenoms_clean").select("id", "langue", "geo"), ["id"], ["id"])
    return serve.score_candidate(rows.select("id", "v").join(meta, "id"), probe.v if probe else [0.0])


def json_roundtrip(s, d):
    path = f"{own_dir(s)}/json-{uuid.uuid4().hex}"
    df = read(s, d, "groupes_finals").select("id_groupe_total", "lot", "noms", "langue", "geo", "texte_resume")
    files.write_json(df, path)
    return files.json_array(s, path, "id_groupe_total int, lot int, noms array<string>, langue string, geo string, texte_resume string", lines=True).select("id_groupe_total", "lot", F.size("noms").alias("n"), "langue", "geo")


def json_map(s, d):
    path = f"{own_dir(s)}/map-{uuid.uuid4().hex}"
    df = trends.national_series(_measures(s, d)).groupBy("prenom").agg(F.sum("births").alias("total"), F.count("*").alias("years"))
    files.write_json_map(df, "prenom", path)
    rows = files.json_map(s, path, "struct<total:bigint,years:bigint>", lines=True)
    return rows.select(F.col("key").alias("prenom"), "value.total", "value.years")


def csv_letters(s, d):
    path = f"{own_dir(s)}/csv-{uuid.uuid4().hex}"
    files.write_csv_by_letter(read(s, d, "prenoms_clean").select("prenom", "url", "sexe").distinct(), "prenom", path)
    df = files.require(files.csv_table(s, path), {"prenom", "url", "sexe"})
    return df.groupBy("lettre").agg(F.count("*").alias("n"), F.count("url").alias("urls"))


def cache_upsert(s, d):
    path = f"{own_dir(s)}/cache-{uuid.uuid4().hex}"
    rows = read(s, d, "documents").where("text IS NOT NULL").select(F.sha2("text", 256).alias("key"), F.lower("text").alias("value"))
    files.append_cache(rows.where("key < '8'"), path, ["key"])
    files.append_cache(rows, path, ["key"])
    return files.read_cache(s, path, "key string, value string").groupBy("key").agg(F.count("*").alias("n"))


def _pages(s, d):
    body = F.concat(F.lit('<html><h2 id="sens">Sens</h2><p>'), F.coalesce("signification", F.lit("")), F.lit('</p><h2 id="histoire">Histoire</h2><p>'), F.coalesce("histoire", F.lit("")), F.lit('</p><p> </p><h3>Fin</h3><p>x</p><a href="'), F.coalesce("url", F.lit("")), F.lit('" class="prenom-title">'), F.col("prenom"), F.lit("</a></html>"))
    return skew.first_rows(read(s, d, "prenoms_clean"), ["id"], ["prenom"]).where("NOT coalesce(histoire, '') RLIKE '[<&]' AND NOT coalesce(signification, '') RLIKE '[<&]'").select("id", body.alias("html"))


def stream_windows(s, d):
    """The events table as a stream, counted by day and kind."""
    base = f"{own_dir(s)}/stream-{uuid.uuid4().hex}"
    df = read(s, d, "events")
    stream = s.readStream.schema(df.schema).option("pathGlobFilter", "events.parquet*").parquet(d).withColumn("ts", F.col("ts").cast("timestamp"))

    def keep(batch, _):
        batch.write.mode("overwrite").parquet(f"{base}/out")

    jobs.windowed(stream).writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return s.read.parquet(f"{base}/out")


def stream_resume(s, d):
    """Documents appended once per text key; a second run over the same files adds nothing."""
    base = f"{own_dir(s)}/resume-{uuid.uuid4().hex}"
    df = read(s, d, "events")
    for run in ("a", "b"):
        stream = s.readStream.schema(df.schema).option("pathGlobFilter", "events.parquet*").parquet(d).select("event_id", "user_id")
        jobs.resume(stream, f"{base}/out", f"{base}/{run}", ["user_id"]).awaitTermination()
    return s.read.parquet(f"{base}/out").groupBy("user_id").agg(F.count("*").alias("n"))


QUERIES = {
    "search_contains": lambda s, d: serve.search(_names(s, d), "bro"),
    "autocomplete": lambda s, d: serve.search(_names(s, d), "da", inside=False),
    "combined_search": lambda s, d: serve.search(_names(s, d), _first_pair(s, d)),
    "record_sheet": lambda s, d: serve.record(read(s, d, "noms_clean").select("id", "nom", "nom_original", "origine_brute").distinct(), "nom", read(s, d, "noms_clean").agg(F.min("nom")).first()[0] or ""),
    "graph_star": star,
    "direct_flag": lambda s, d: serve.related_flags(read(s, d, "prenoms_final"), "id", "prenom", "prenoms_groupe", "prenoms_lies"),
    "stats_overview": lambda s, d: serve.label_counts(read(s, d, "groupes_finals"), read(s, d, "prenoms_final"), "langue"),
    "timeline": lambda s, d: serve.timeline(trends.enrich(_measures(s, d), read(s, d, "prenoms_clean").select("prenom", F.lit(0).alias("id_groupe_total")).distinct()).groupBy("annee").agg(F.sum("count").alias("births"))),
    "top_names": top_names,
    "trending": trending,
    "explore_stats": lambda s, d: serve.explore(read(s, d, "prenoms_grouped"), "id_groupe_total", "id"),
    "candidate_score": candidate,
    "json_roundtrip": json_roundtrip,
    "json_map": json_map,
    "csv_letters": csv_letters,
    "cache_upsert": cache_upsert,
    "section_extract": lambda s, d: files.sections(_pages(s, d), "id", "html", ["sens", "histoire", "caractere"]),
    "links_extract": lambda s, d: files.page_links(_pages(s, d), "id", "html"),
    "stream_windows": stream_windows,
    "stream_resume": stream_resume,
}

_KEYS = "(SELECT 'nom' AS type, nom AS key, min(nom_original) AS label FROM noms_clean GROUP BY nom UNION ALL SELECT 'prenom', prenom, min(prenom_original) FROM prenoms_clean GROUP BY prenom)"
_M = """(SELECT DISTINCT trim(regexp_replace(regexp_replace(strip_accents(lower(prenom)), '[-''’]', ' ', 'g'), '\\s+', ' ', 'g')) AS prenom, annee,
    CASE WHEN length(dept) < 2 THEN lpad(dept, 2, '0') ELSE dept END AS dept, count AS c, id_groupe_total
    FROM prenoms_stats WHERE annee IS NOT NULL AND count >= 3 AND prenom IS NOT NULL AND prenom[1] <> '_')"""
_T = f"(SELECT prenom, sum(b)::BIGINT AS total, arg_max(annee, (b, -annee)) AS pic_annee FROM (SELECT prenom, annee, sum(c) AS b FROM {_M} GROUP BY ALL) GROUP BY prenom)"


def _search(match: str, first: str, kind: str, limit: int) -> str:
    part = lambda t: f"(SELECT * FROM {_KEYS} WHERE type = '{t}' AND {match} ORDER BY key LIMIT {limit})"
    return f"SELECT type, key, label, NULL::VARCHAR AS key2, NULL::VARCHAR AS label2, row_number() OVER (ORDER BY {first}, {kind}, key, type)::INT AS rank FROM (SELECT * FROM {part('nom')} UNION ALL SELECT * FROM {part('prenom')})"


_PAGE = "SELECT * FROM (SELECT id, any_value(prenom) AS prenom, any_value(url) AS url, any_value(signification) AS s, any_value(histoire) AS h FROM prenoms_clean GROUP BY id) WHERE NOT regexp_matches(coalesce(h, ''), '[<&]') AND NOT regexp_matches(coalesce(s, ''), '[<&]')"

SQL = {
    "search_contains": _search("contains(key, 'bro')", "key <> 'bro'", "0", 20),
    "autocomplete": _search("starts_with(key, 'da')", "0", "type", 10),
    "combined_search": """SELECT 'compare' AS type, p AS key, (SELECT min(prenom_original) FROM prenoms_clean WHERE prenom = p) AS label, n AS key2, (SELECT min(nom_original) FROM noms_clean WHERE nom = n) AS label2, 1 AS rank
        FROM (SELECT (SELECT min(prenom) FROM prenoms_clean WHERE NOT contains(prenom, ' ')) AS p, (SELECT min(nom) FROM noms_clean WHERE NOT contains(nom, ' ')) AS n)""",
    "record_sheet": "SELECT DISTINCT id, nom, nom_original, origine_brute FROM noms_clean WHERE nom = (SELECT min(nom) FROM noms_clean) ORDER BY id DESC LIMIT 1",
    "graph_star": f"""WITH o AS (SELECT id, any_value(prenom) AS name, any_value(prenoms_groupe) AS g FROM prenoms_final GROUP BY id), n AS (SELECT id, name, list_filter(coalesce(g, []), lambda x: x <> name AND trim(x) <> '')[1:12] AS r FROM o),
        x AS (SELECT id, name, unnest(list_concat([name], r)) AS node, unnest(range(len(r) + 1))::INT AS "at" FROM n), t AS (SELECT prenom, sum(c) AS total FROM {_M} GROUP BY prenom)
        SELECT id, "at", node, greatest(10, floor(sqrt(coalesce(total, 0)))::INT) + 5 AS size, CASE WHEN "at" > 0 THEN name END AS edge_from FROM x LEFT JOIN t ON t.prenom = x.node""",
    "direct_flag": """SELECT DISTINCT id, member, list_contains(list_transform(coalesce(prenoms_lies, []), lambda x: lower(trim(x))), member) AS direct FROM (SELECT id, prenom, prenoms_lies, unnest(prenoms_groupe) AS member FROM prenoms_final) WHERE member <> prenom""",
    "stats_overview": "SELECT langue AS label, count(*) AS n FROM (SELECT langue FROM groupes_finals UNION ALL SELECT langue FROM prenoms_final) WHERE trim(langue) <> '' GROUP BY 1 ORDER BY n DESC, label LIMIT 10",
    "timeline": f"SELECT annee, sum(c)::BIGINT AS births FROM {_M} WHERE prenom IN (SELECT prenom FROM prenoms_clean) AND annee >= 1890 GROUP BY annee",
    "top_names": f"SELECT prenom, total FROM (SELECT * FROM {_T} ORDER BY total DESC, prenom LIMIT 10) WHERE prenom IN (SELECT prenom FROM prenoms_clean)",
    "trending": f"SELECT prenom, total, pic_annee FROM (SELECT * FROM {_T} WHERE pic_annee >= 2018 ORDER BY total DESC, prenom LIMIT 10) WHERE prenom IN (SELECT prenom FROM prenoms_clean)",
    "explore_stats": "SELECT size, count(*) AS groups FROM (SELECT count(DISTINCT id) AS size FROM prenoms_grouped WHERE id_groupe_total IS NOT NULL GROUP BY id_groupe_total) GROUP BY size ORDER BY size LIMIT 15",
    "candidate_score": """WITH v AS (SELECT pos, id, embedding::DOUBLE[] AS e FROM prenoms_vecteurs WHERE embedding IS NOT NULL), q AS (SELECT e AS q FROM v ORDER BY pos LIMIT 1),
        s AS (SELECT id, round(list_dot_product(e, q), 6) AS sim FROM v, q WHERE id IN (SELECT id FROM prenoms_clean) ORDER BY sim DESC, id LIMIT 5)
        SELECT id, sim, sim AS score, round_even(coalesce(2 * least(sim, 1) * sim / nullif(least(sim, 1) + sim, 0), 0), 4) AS f1, CASE WHEN sim >= 0.92 THEN 'FUSION' ELSE 'REJET' END AS decision FROM s""",
    "json_roundtrip": "SELECT id_groupe_total, lot, len(noms)::INT AS n, langue, geo FROM groupes_finals",
    "json_map": f"SELECT prenom, sum(b)::BIGINT AS total, count(*) AS years FROM (SELECT prenom, annee, sum(c) AS b FROM {_M} GROUP BY ALL) GROUP BY prenom",
    "csv_letters": "SELECT upper(prenom[1]) AS lettre, count(*) AS n, count(nullif(url, '')) AS urls FROM (SELECT DISTINCT prenom, url, sexe FROM prenoms_clean) GROUP BY 1",
    "cache_upsert": "SELECT DISTINCT sha256(text) AS key, 1::BIGINT AS n FROM documents WHERE text IS NOT NULL",
    "section_extract": f"SELECT id, trim(regexp_replace(coalesce(s, ''), '\\s+', ' ', 'g')) AS sens, trim(regexp_replace(coalesce(h, ''), '\\s+', ' ', 'g')) AS histoire, '' AS caractere FROM ({_PAGE})",
    "links_extract": f"SELECT id, url, prenom AS title FROM ({_PAGE}) WHERE url <> ''",
    "stream_windows": "SELECT date_trunc('day', ts)::TIMESTAMP AS start, event_type AS kind, count(*) AS n, sum(value) AS total FROM events GROUP BY ALL",
    "stream_resume": "SELECT DISTINCT user_id, 1::BIGINT AS n FROM events",
}
