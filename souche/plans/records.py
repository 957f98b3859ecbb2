"""Queries over prepared records, sheets, group statistics, reports and file layouts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from souche.functions import extract as X
from souche.functions import text as T
from souche.operators import graph, metrics, records, serve, skew, tfidf, trends
from souche.operators import pipelines as P
from souche.plans import births
from souche.plans import texts as texts_plan
from souche.session import own_dir, read
from souche.sources import files
from souche.streaming import jobs

FIELDS = ["histoire", "etymologie", "signification", "provenance"]


def _raw(s, d):
    """First names as they came: the records with texts of their own or none, one row an id."""
    return skew.first_rows(read(s, d, "prenoms_clean").select("id", F.col("prenom_original").alias("prenom"), "sexe", "url", *FIELDS), ["id"], ["prenom", *FIELDS])


def prepared_groups(s, d):
    rows = _raw(s, d).withColumn("prenom", T.first_name_key(F.col("prenom"))).select("id", "prenom", T.embedding_text(F.col("histoire"), F.col("provenance"), F.col("etymologie")).alias("t"))
    rows = rows.withColumn("r", F.row_number().over(records.Window.partitionBy("prenom").orderBy("id"))).where("r = 1 AND prenom <> ''")
    return records.text_groups(rows, "prenom", "t", "id").select("prenom", "id_groupe")


def discovered(s, d):
    """New names with what they inherit, from the links as given."""
    rows = skew.first_rows(read(s, d, "prenoms_clean").select("id", "prenom", "langue", "geo", "prenoms_lies"), ["id"], ["id"])
    keys = F.array_distinct(F.filter(F.transform(F.coalesce("prenoms_lies", F.array().cast("array<string>")), lambda x: T.linked_name(x, True)), lambda x: x != ""))
    new = records.discovered(rows.withColumn("liens", keys), "prenom", "liens", ["langue", "geo"], "id")
    return new.select("prenom", F.array_join("liens", ",").alias("par"), "langue", "geo")


def _grouped(s, d):
    return read(s, d, "prenoms_grouped").select("id", "id_groupe_total").distinct()


def group_outliers(s, d):
    """Members of small groups that are far from their group's centre, from the vectors of their texts."""
    label = read(s, d, "prenoms_grouped").groupBy("id").agg(F.max("id_groupe_total").alias("g"))
    rows = read(s, d, "prenoms_vecteurs").where("embedding IS NOT NULL").select("pos", "id", F.col("embedding").alias("v")).join(label.where("g IS NOT NULL"), "id")
    return graph.outliers(rows, "pos", "g", "v")


def char_groups(s, d):
    """Cohesion of names by their first two letters, each group weighed as a corpus of its own."""
    one = read(s, d, "noms_clean").where("trim(origine) <> ''").select("nom").distinct()
    members = one.select(F.substring("nom", 1, 2).alias("group"), F.col("nom").alias("doc"))
    weighted = tfidf.group_weights(tfidf.char_terms(one, "nom", "nom"), members)
    return tfidf.cohesion(weighted.select("doc", "term", "weight"), members).select("group", "n", F.round("cohesion", 9).alias("cohesion"))


def all_texts(s, d):
    """Weights over the texts of all records, copies included."""
    rows = read(s, d, "noms_clean").where("trim(origine) <> ''").select("id", "origine").distinct()
    weighted = tfidf.weights(tfidf.word_terms(rows, "id", "origine", bigrams=False), rows)
    return weighted.groupBy("doc").agg(F.count("*").alias("terms"), F.round(F.max("weight"), 9).alias("top"))


def cache_performance(s, d):
    final = read(s, d, "prenoms_final")
    cache = final.where("trim(histoire_v) <> '' AND trim(histoire) <> ''").select(F.sha2("histoire", 256).alias("key"))
    return metrics.cache_performance(final.select("id", *FIELDS).distinct(), FIELDS, cache)


def _decades(s, d):
    return births.decades(s, d).select("prenom", "nombre_total", "historique")


def decade_values(s, d):
    labels = ["1901_1910", "1951_1960", "2031_2040"]
    return _decades(s, d).select("prenom", F.array_join(F.transform(trends.decade_values(F.col("historique"), labels), lambda x: x.cast("string")), ",").alias("valeurs"))


def with_decades(s, d):
    rows = trends.with_decades(read(s, d, "prenoms_clean").select("prenom").distinct(), "prenom", _decades(s, d))
    return rows.select("prenom", "nombre_total", F.size("historique").alias("decades"))


def _smallest(s, d, table, name):
    return read(s, d, table).agg(F.min(name)).first()[0] or ""


def first_name_sheet(s, d):
    names = read(s, d, "prenoms_final").select("id", "prenom", "langue", "geo", "date", "prenoms_groupe").distinct()
    return records.first_name_sheet(names, trends.trends(births._measures(s, d)), _smallest(s, d, "prenoms_final", "prenom"))


def surname_sheet(s, d):
    names = read(s, d, "noms_clean").select("id", "nom", "nom_original", "origine_brute").distinct()
    return records.surname_sheet(names, read(s, d, "groupes_finals").distinct(), _smallest(s, d, "groupes_finals", F.array_min("noms")))


def compared(s, d):
    pair = read(s, d, "prenoms_clean").agg(F.min("prenom"), F.max("prenom")).first()
    return records.compared(trends.national_series(births._measures(s, d)), pair[0] or "", pair[1] or "")


def candidate_summary(s, d):
    """The first vector as a candidate with the language and place of its own record: best record, mean F1, fusions."""
    rows = read(s, d, "prenoms_vecteurs").where("embedding IS NOT NULL").select("pos", "id", F.col("embedding").alias("v"))
    meta = skew.first_rows(read(s, d, "prenoms_clean").select("id", "langue", "geo"), ["id"], ["id"])
    probe = rows.join(meta, "id").orderBy("pos").limit(1).first()
    scored = serve.score_candidate(rows.select("id", "v").join(meta, "id"), probe.v if probe else [0.0], (probe.langue if probe else "") or "", (probe.geo if probe else "") or "")
    return scored.agg(F.min_by("id", F.struct((-F.col("score")).alias("s"), "id")).alias("best"), F.round(F.avg("f1"), 4).alias("mean_f1"), F.coalesce(F.sum((F.col("decision") == "FUSION").cast("int")), F.lit(0)).alias("fusions"))


def map_points(s, d):
    groups = read(s, d, "groupes_finals").select("id_groupe_total", "geo", F.explode("noms").alias("nom")).where("trim(nom) <> ''")
    return serve.group_points(groups, "id_groupe_total", "geo", "nom")


def json_files(s, d):
    """Groups written as one JSON array and read back."""
    path = f"{own_dir(s)}/array-{uuid.uuid4().hex}.json"
    files.write_json_array(read(s, d, "groupes_finals").select("id_groupe_total", "lot", "noms", "langue"), path)
    return files.json_array(s, path, "id_groupe_total int, lot int, noms array<string>, langue string").select("id_groupe_total", "lot", F.size("noms").alias("n"), "langue")


def json_object(s, d):
    """Totals written as one JSON object and read back."""
    path = f"{own_dir(s)}/object-{uuid.uuid4().hex}.json"
    totals = trends.national_series(births._measures(s, d)).groupBy("prenom").agg(F.sum("births").alias("total"))
    files.write_json_object(totals, "prenom", path)
    return files.json_map(s, path, "struct<total:bigint>").select(F.col("key").alias("prenom"), F.col("value.total").alias("total"))


def csv_files(s, d):
    """One CSV file a letter with a byte-order mark, listed and read back."""
    folder = f"{own_dir(s)}/letters-{uuid.uuid4().hex}"
    files.write_csv_files(read(s, d, "prenoms_clean").select("prenom", "sexe").distinct(), "prenom", folder)
    rows = files.require(files.csv_table(s, f"{folder}/*.csv"), {"prenom", "sexe"}).groupBy(F.upper(F.substring("prenom", 1, 1)).alias("lettre")).agg(F.count("*").alias("n"))
    names = files.listing(s, folder, ".csv").select(F.regexp_extract("path", r"([^/]+)\.csv$", 1).alias("lettre"))
    return names.join(rows, "lettre", "left")


def vector_cache(s, d):
    """Texts encoded through a cache, twice: the second run encodes nothing."""
    from souche.plans.pipelines import _hash_vector

    path = f"{own_dir(s)}/vectors-{uuid.uuid4().hex}"
    rows = read(s, d, "prenoms_clean").select("id", "texte_brut").distinct()
    for _ in range(2):
        done = P.encode_cached(rows, "texte_brut", _hash_vector, path)
    return done.groupBy(F.col("vector").isNotNull().alias("encoded")).agg(F.count("*").alias("n"), F.count_distinct("texte_brut").alias("texts"))


def steps(s, d):
    """Preparation, grouping and numbering of surnames as steps."""
    path = f"{own_dir(s)}/steps-{uuid.uuid4().hex}"
    names = read(s, d, "noms_clean").select("id", "nom", "origine").distinct()
    run = records.run_steps([
        ("prepare", lambda: records.text_groups(names, "nom", "origine", "id")),
        ("sizes", lambda: graph.size_report(s.read.parquet(f"{path}/prepare"), "id_groupe")),
        ("broken", lambda: s.read.parquet(f"{path}/absent")),
        ("never", lambda: names),
    ], path)
    return s.createDataFrame([(name, state.partition(":")[0]) for name, state, _ in run], "step string, state string")


def stream_scored(s, d):
    """Vectors as a stream against the centres of their labels."""
    base = f"{own_dir(s)}/scored-{uuid.uuid4().hex}"
    df = read(s, d, "embeddings")
    centres = graph.centroids(df.select("label", "embedding"), "label", "embedding")
    stream = s.readStream.schema(df.schema).option("pathGlobFilter", "embeddings.parquet*").parquet(d)
    jobs.drain(jobs.scored(stream, centres, "label", "embedding", "centroid", 0.5).select("vec_id", "sim", "decision"), f"{base}/out", f"{base}/checkpoint")
    return s.read.parquet(f"{base}/out")


def _sentences(s, d):
    return read(s, d, "documents").where("text IS NOT NULL").select("doc_id", F.posexplode(T.sentences(F.col("text"))).alias("at", "phrase"))


QUERIES = {
    "scraped_key": lambda s, d: read(s, d, "prenoms_clean").select("prenom_original", T.scraped_key(F.concat(F.lit(T.TITLE_PREFIX), "prenom_original")).alias("key")).distinct(),
    "joined_text": lambda s, d: _raw(s, d).select("id", T.joined_text(*(F.col(c) for c in FIELDS)).alias("texte")),
    "candidate_labels": lambda s, d: read(s, d, "documents").where("text IS NOT NULL").select("doc_id", *(c.alias(n) for c, n in zip(serve.candidate_labels(F.col("text")), ("langue", "geo")))),
    "advice": lambda s, d: read(s, d, "customer").select("c_custkey", serve.advice(F.col("c_acctbal"), 0, 5000).alias("advice")),
    "prepare_first_names": lambda s, d: records.prepare_first_names(_raw(s, d), "id").select("id", "prenom", "texte_brut", "langue", "religion", "geo", F.col("date.label").alias("date"), F.array_join("prenoms_lies", ",").alias("lies"), "id_groupe", F.array_join("id_prenoms_lies", ",").alias("ids")),
    "prepare_groups": prepared_groups,
    "discovered_first_names": discovered,
    "new_surnames": lambda s, d: records.with_new_surnames(P.prepare_surnames(skew.first_rows(read(s, d, "noms_clean").select("nom", "nom_original", "origine_brute"), ["nom"], ["nom_original"]), "nom_original", "origine_brute")).select("id", "nom", "id_groupe", F.array_join("noms_lies", ",").alias("lies"), F.array_join("id_noms_lies", ",").alias("ids")),
    "group_sizes": lambda s, d: graph.size_report(_grouped(s, d), "id_groupe_total"),
    "largest_groups": lambda s, d: graph.largest(_grouped(s, d), "id_groupe_total"),
    "outliers": group_outliers,
    "confidence": lambda s, d: graph.confidence(group_outliers(s, d)),
    "char_tfidf_groups": char_groups,
    "tfidf_all_texts": all_texts,
    "cache_performance": cache_performance,
    "field_lengths": lambda s, d: metrics.field_lengths(read(s, d, "prenoms_final").select("id", *FIELDS).distinct(), FIELDS),
    "source_and_final": lambda s, d: metrics.source_and_final(_raw(s, d), skew.first_rows(read(s, d, "prenoms_final").select("id", *FIELDS), ["id"], FIELDS), FIELDS),
    "decade_values": decade_values,
    "with_decades": with_decades,
    "first_name_sheet": first_name_sheet,
    "surname_sheet": surname_sheet,
    "compared_names": compared,
    "candidate_summary": candidate_summary,
    "map_points": map_points,
    "json_array_file": json_files,
    "json_object_file": json_object,
    "csv_files": csv_files,
    "vector_cache": vector_cache,
    "steps": steps,
    "stream_scored": stream_scored,
    "record_spread": lambda s, d: read(s, d, "nation").select(F.struct("*").alias("r")).select(F.col("r").withField("kind", F.lit("nation")).alias("r")).select("r.*"),
    "label_report": lambda s, d: serve.label_report(read(s, d, "groupes_finals"), "id_groupe_total", ["langue", "geo"]),
}

_SQ = "trim(regexp_replace(regexp_replace(regexp_replace({0}, '<[^>]+>', ' ', 'g'), 'https?://\\S+', ' ', 'g'), '\\s+', ' ', 'g'))"
_PART = "nullif(" + _SQ + ", '')"
_RAW = f"(SELECT * FROM (SELECT id, prenom_original, {', '.join(FIELDS)}, row_number() OVER (PARTITION BY id ORDER BY prenom_original, {', '.join(c + ' NULLS FIRST' for c in FIELDS)}) AS r FROM prenoms_clean) WHERE r = 1)"
_FINAL = f"(SELECT * FROM (SELECT id, {', '.join(FIELDS)}, row_number() OVER (PARTITION BY id ORDER BY {', '.join(c + ' NULLS FIRST' for c in FIELDS)}) AS r FROM prenoms_final) WHERE r = 1)"
_KEY = "trim(regexp_replace(regexp_replace(strip_accents(lower({0})), '[-''’]', ' ', 'g'), '\\s+', ' ', 'g'))"
_LINK = _KEY.format("regexp_replace(regexp_replace({0}, '\\([^)]*\\)', ' ', 'g'), '[0-9]+', '', 'g')")
_EMB = f"concat_ws(' | ', {_PART.format('histoire')}, {_PART.format('histoire')}, {_PART.format('provenance')}, {_PART.format('etymologie')})"
_PLACES = "(VALUES " + ", ".join(f"('{k}', {a}::DOUBLE, {b}::DOUBLE)" for k, (a, b) in serve.PLACES.items()) + ") AS places(g, lat, lng)"
_SIZES = "(SELECT count(*) AS n FROM (SELECT DISTINCT id, id_groupe_total FROM prenoms_grouped WHERE id_groupe_total IS NOT NULL) GROUP BY id_groupe_total)"
_MARK = "least(greatest(round(({0} - 500) / 1500.0 * 100, 1), 2.0), 97.0)::DOUBLE"
_LONG = " UNION ALL ".join(f"SELECT '{f}' AS field, {f} AS text FROM (SELECT DISTINCT id, {', '.join(FIELDS)} FROM prenoms_final) WHERE trim({f}) <> ''" for f in FIELDS)
_OUT = """WITH g AS (SELECT id, max(id_groupe_total) AS g FROM prenoms_grouped GROUP BY id), v AS (SELECT pos, g, embedding AS e FROM prenoms_vecteurs JOIN g USING (id) WHERE embedding IS NOT NULL AND g IS NOT NULL),
        k AS (SELECT g FROM v GROUP BY g HAVING count(*) BETWEEN 2 AND 30), d AS (SELECT pos, g, unnest(e)::DOUBLE AS x, unnest(range(len(e))) AS i FROM v JOIN k USING (g)), m AS (SELECT g, i, avg(x) AS m FROM d GROUP BY ALL),
        c AS (SELECT g, i, m / coalesce(nullif(sqrt(sum(m * m) OVER (PARTITION BY g)), 0), 1) AS m FROM m), o AS (SELECT g, pos, round(sum(x * m), 4) AS sim FROM d JOIN c USING (g, i) GROUP BY ALL HAVING round(sum(x * m), 4) < 0.82)"""


def _share(column: str) -> str:
    return f"""SELECT '{column}' AS label, count(*) FILTER (EXISTS (SELECT 1 FROM groupes_finals x WHERE x.id_groupe_total = g.id_groupe_total AND trim(x.{column}) <> '')) AS labelled, count(*) AS groups
        FROM (SELECT DISTINCT id_groupe_total FROM groupes_finals WHERE id_groupe_total IS NOT NULL) g"""


SQL = {
    "scraped_key": "SELECT DISTINCT prenom_original, regexp_replace(replace(replace(replace(strip_accents(lower(prenom_original)), 'œ', 'oe'), 'æ', 'ae'), 'ß', 'ss'), '[^a-z\\-]', '', 'g') AS key FROM prenoms_clean",
    "joined_text": f"SELECT id, concat_ws(' ', {', '.join(_PART.format(c) for c in FIELDS)}) AS texte FROM {_RAW}",
    "candidate_labels": f"SELECT doc_id, {texts_plan._first(serve.CANDIDATE_LANGUAGES, 't')} AS langue, {texts_plan._first(serve.CANDIDATE_PLACES, 't')} AS geo FROM (SELECT doc_id, trim(regexp_replace(strip_accents(lower(text)), '\\s+', ' ', 'g')) AS t FROM documents WHERE text IS NOT NULL)",
    "advice": "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'permissive' WHEN c_acctbal > 5000 THEN 'strict' ELSE 'balanced' END AS advice FROM customer WHERE true",
    "prepare_groups": f"""WITH k AS (SELECT id, {_KEY.format('prenom_original')} AS prenom, {_EMB} AS t FROM {_RAW}), o AS (SELECT * FROM k WHERE prenom <> '' QUALIFY row_number() OVER (PARTITION BY prenom ORDER BY id) = 1),
        f AS (SELECT t, arg_min(prenom, id) AS first FROM o WHERE t <> '' GROUP BY t) SELECT prenom, substr(md5(CASE WHEN o.t <> '' THEN 'grp_' || first ELSE 'solo_' || prenom END), 1, 8) AS id_groupe FROM o LEFT JOIN f ON f.t = o.t""",
    "discovered_first_names": f"""WITH o AS (SELECT id, prenom, langue, geo, prenoms_lies AS l FROM prenoms_clean QUALIFY row_number() OVER (PARTITION BY id ORDER BY id) = 1),
        e AS (SELECT id, prenom AS par, langue, geo, unnest(l) AS x, unnest(range(len(l))) AS seq FROM o), k AS (SELECT id, par, langue, geo, seq, {_LINK.format('x')} AS prenom FROM e)
        SELECT prenom, par, langue, geo FROM k WHERE prenom <> '' AND prenom NOT IN (SELECT prenom FROM prenoms_clean) QUALIFY row_number() OVER (PARTITION BY prenom ORDER BY id, seq) = 1""",
    "group_sizes": f"SELECT count(*) AS groups, sum(n)::BIGINT AS members, coalesce(sum(n) FILTER (n > 1), 0)::BIGINT AS in_groups, count(*) FILTER (n = 1) AS singletons, round(avg(n), 6) AS mean, median(n)::DOUBLE AS median, max(n) AS largest FROM {_SIZES}",
    "largest_groups": f"SELECT row_number() OVER (ORDER BY n DESC)::INT AS rank, n AS size FROM {_SIZES} QUALIFY rank <= 5",
    "outliers": _OUT + " SELECT g, pos, sim FROM o",
    "confidence": _OUT + " SELECT round(coalesce(avg(sim), 0.88), 6)::DOUBLE AS confidence FROM o",
    "char_tfidf_groups": """WITH o AS (SELECT nom FROM noms_clean WHERE trim(origine) <> '' GROUP BY nom), g AS (SELECT nom, substr(nom, i, k) AS term FROM (SELECT nom, k, unnest(range(1, length(nom) - k + 2)) AS i FROM o, (VALUES (2), (3)) v(k))),
        c AS (SELECT nom, nom[1:2] AS grp, term, count(*) AS tf FROM g WHERE length(term) >= 2 GROUP BY ALL), z AS (SELECT nom[1:2] AS grp, count(*) AS n FROM o GROUP BY 1), f AS (SELECT grp, term, count(*) AS df FROM c GROUP BY ALL),
        q AS (SELECT nom, grp, term, tf * (ln((1 + n) / (1 + df)::DOUBLE) + 1) AS w FROM c JOIN f USING (grp, term) JOIN z USING (grp)), s AS (SELECT nom, grp, term, w / sqrt(sum(w * w) OVER (PARTITION BY nom)) AS w FROM q),
        p AS (SELECT a.grp, sum(a.w * b.w) AS s FROM s a JOIN s b ON a.term = b.term AND a.nom <> b.nom AND a.grp = b.grp GROUP BY 1)
        SELECT grp AS "group", n, round(coalesce(s, 0) / (n * (n - 1)), 9) AS cohesion FROM z LEFT JOIN p USING (grp) WHERE n > 1""",
    "tfidf_all_texts": """WITH t AS (SELECT DISTINCT id, origine FROM noms_clean WHERE trim(origine) <> ''), c AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(regexp_extract_all(lower(origine), '[\\p{L}\\p{N}\\p{M}_]{2,}')) AS term FROM t) GROUP BY ALL),
        n AS (SELECT count(*) AS n FROM t), f AS (SELECT term, count(*) AS df FROM c GROUP BY term HAVING count(*) BETWEEN 2 AND 0.95 * (SELECT n FROM n)), w AS (SELECT id, term, (1 + ln(tf)) * (ln((1 + (SELECT n FROM n)) / (1 + df)::DOUBLE) + 1) AS w FROM c JOIN f USING (term)),
        u AS (SELECT id, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM w) SELECT id AS doc, count(*) AS terms, round(max(w), 9) AS top FROM u GROUP BY id""",
    "cache_performance": f"""WITH l AS ({_LONG}), c AS (SELECT DISTINCT histoire AS text FROM prenoms_final WHERE trim(histoire_v) <> '' AND trim(histoire) <> ''), k AS (SELECT text, count(*) AS n FROM l GROUP BY text), h AS (SELECT k.n, c.text IS NOT NULL AS hit FROM k LEFT JOIN c USING (text))
        SELECT count(*) AS unique_texts, (SELECT count(*) FROM c) AS cached, count(*) FILTER (hit) AS hits, round(count(*) FILTER (hit) * 100.0 / count(*), 1)::DOUBLE AS hit_pct, sum(n)::BIGINT AS calls, coalesce(sum(n) FILTER (hit), 0)::BIGINT AS avoided,
          round(coalesce(sum(n) FILTER (hit), 0) * 1.5 / 3600, 2)::DOUBLE AS hours_saved FROM h""",
    "field_lengths": f"SELECT field, count(*) AS n, round(avg(length(text)), 6) AS mean, max(length(text))::INT AS max, round(avg((length(text) > 1800)::INT) * 100, 6) AS pct_long FROM ({_LONG}) GROUP BY field",
    "source_and_final": " UNION ALL ".join(
        f"SELECT '{f}' AS field, a AS n_source, round(a * 100.0 / n, 1)::DOUBLE AS source_pct, b AS n_final, round(b * 100.0 / n, 1)::DOUBLE AS final_pct FROM (SELECT (SELECT count(*) FROM {_RAW} WHERE trim({f}) <> '') AS a, (SELECT count(*) FROM {_FINAL} WHERE trim({f}) <> '') AS b, (SELECT count(*) FROM {_RAW}) AS n)"
        for f in FIELDS
    ),
    "decade_values": f"SELECT prenom, coalesce(sum(n) FILTER (y = 1900), 0)::BIGINT || ',' || coalesce(sum(n) FILTER (y = 1950), 0)::BIGINT || ',0' AS valeurs FROM {births._DECADES} GROUP BY prenom",
    "with_decades": f"SELECT p.prenom, coalesce(sum(n), 0)::BIGINT AS nombre_total, CASE WHEN count(n) > 0 THEN 13 ELSE 0 END AS decades FROM (SELECT DISTINCT prenom FROM prenoms_clean) p LEFT JOIN {births._DECADES} d ON d.prenom = p.prenom GROUP BY p.prenom",
    "first_name_sheet": f"""WITH q AS (SELECT min(prenom) AS q FROM prenoms_final), o AS (SELECT DISTINCT id, prenom, langue, geo, date.label AS date, date.valeur AS valeur, prenoms_groupe AS grp FROM prenoms_final, q WHERE prenom = q ORDER BY id DESC LIMIT 1)
        SELECT o.prenom, o.id, o.langue, o.geo, o.date, {_MARK.format('valeur')} AS marker, array_to_string(list_filter(coalesce(grp, []), lambda x: x <> o.prenom AND trim(x) <> '')[1:12], ',') AS related, lat, lng, total, pic_annee, first_year, last_year, top_depts
        FROM o LEFT JOIN {_PLACES} ON places.g = lower(trim(o.geo)) LEFT JOIN ({births.SQL['name_trends']}) t ON t.prenom = o.prenom""",
    "surname_sheet": f"""WITH q AS (SELECT min(list_min(noms)) AS q FROM groupes_finals), o AS (SELECT DISTINCT id, nom, nom_original FROM noms_clean, q WHERE nom = q ORDER BY id DESC LIMIT 1),
        m AS (SELECT id_groupe_total, langue, geo, array_to_string(list_filter(noms, lambda x: x <> q AND trim(x) <> '')[1:12], ',') AS related FROM groupes_finals, q WHERE list_contains(noms, q) ORDER BY id_groupe_total, lot LIMIT 1)
        SELECT o.nom, o.id, nom_original, x.label AS date, {_MARK.format('x.valeur')} AS marker, id_groupe_total, langue, geo, related, lat, lng FROM o LEFT JOIN m ON true LEFT JOIN ({texts_plan.SQL['extract_date']}) x ON x.id = o.id LEFT JOIN {_PLACES} ON places.g = lower(trim(m.geo))""",
    "compared_names": f"""WITH q AS (SELECT min(prenom) AS a, max(prenom) AS b FROM prenoms_clean) SELECT annee, coalesce(sum(c) FILTER (prenom = a), 0)::BIGINT AS births_a, coalesce(sum(c) FILTER (prenom = b), 0)::BIGINT AS births_b
        FROM {births._M}, q WHERE prenom IN (a, b) GROUP BY annee""",
    "candidate_summary": """WITH m AS (SELECT id, langue, geo FROM prenoms_clean QUALIFY row_number() OVER (PARTITION BY id ORDER BY id) = 1), v AS (SELECT pos, id, langue, geo, embedding::DOUBLE[] AS e FROM prenoms_vecteurs JOIN m USING (id) WHERE embedding IS NOT NULL),
        q AS (SELECT e AS q, langue AS l, geo AS p FROM v ORDER BY pos LIMIT 1), s AS (SELECT id, langue, geo, l, p, round(list_dot_product(e, q), 6) AS sim FROM v, q ORDER BY sim DESC, id LIMIT 5),
        c AS (SELECT id, sim, round(sim + CASE WHEN langue = l AND l <> '' THEN 0.04 ELSE 0 END + CASE WHEN geo = p AND p <> '' THEN 0.02 ELSE 0 END, 6)::DOUBLE AS score FROM s),
        f AS (SELECT id, score, round_even(coalesce(2 * least(score, 1) * sim / nullif(least(score, 1) + sim, 0), 0), 4) AS f1 FROM c)
        SELECT (SELECT id FROM f ORDER BY score DESC, id LIMIT 1) AS best, round(avg(f1), 4) AS mean_f1, count(*) FILTER (score >= 0.92) AS fusions FROM f""",
    "map_points": f"""WITH p AS (SELECT DISTINCT id_groupe_total AS "group", nom AS key, lower(trim(geo)) AS g FROM (SELECT id_groupe_total, geo, unnest(noms) AS nom FROM groupes_finals WHERE id_groupe_total IS NOT NULL) WHERE trim(nom) <> ''),
        x AS (SELECT p.*, lat, lng FROM p LEFT JOIN {_PLACES} ON places.g = p.g), m AS (SELECT "group", arg_min(lat, (key, lat, lng)) AS la, arg_min(lng, (key, lat, lng)) AS ln FROM x WHERE lat IS NOT NULL GROUP BY ALL)
        SELECT x."group", key, coalesce(lat, la) AS lat, coalesce(lng, ln) AS lng, lat IS NOT NULL AS known FROM x LEFT JOIN m ON m."group" = x."group" """,
    "json_array_file": "SELECT id_groupe_total, lot, len(noms)::INT AS n, langue FROM groupes_finals",
    "json_object_file": f"SELECT prenom, sum(c)::BIGINT AS total FROM {births._M} GROUP BY prenom",
    "csv_files": "SELECT upper(prenom[1]) AS lettre, count(*) AS n FROM (SELECT DISTINCT prenom, sexe FROM prenoms_clean) GROUP BY 1",
    "vector_cache": "SELECT coalesce(trim(texte_brut) <> '', false) AS encoded, count(*) AS n, count(DISTINCT texte_brut) AS texts FROM (SELECT DISTINCT id, texte_brut FROM prenoms_clean) GROUP BY 1",
    "steps": "SELECT * FROM (VALUES ('prepare', 'ok'), ('sizes', 'ok'), ('broken', 'failed')) AS t(step, state)",
    "stream_scored": """WITH d AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings), m AS (SELECT label, i, avg(x) AS m FROM d GROUP BY ALL),
        c AS (SELECT label, i, m / sqrt(sum(m * m) OVER (PARTITION BY label)) AS m FROM m), s AS (SELECT vec_id, round(sum(x * m), 6) AS sim FROM d JOIN c USING (label, i) GROUP BY ALL) SELECT vec_id, sim, CASE WHEN sim >= 0.5 THEN 'FUSION' ELSE 'REJET' END AS decision FROM s""",
    "record_spread": "SELECT *, 'nation' AS kind FROM nation",
    "label_report": " UNION ALL ".join(f"SELECT label, labelled, groups, round(labelled * 100.0 / groups, 6)::DOUBLE AS pct FROM ({_share(c)})" for c in ("langue", "geo")),
}
