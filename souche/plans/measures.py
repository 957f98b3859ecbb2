"""Queries over counts, distributions and quality measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from souche.functions import text as T
from souche.operators import metrics, summarize
from souche.session import read

# Words without weight in word counts.
STOPWORDS = "de du des le la les un une et en au aux il elle ils elles se sa son ses qui que qu ce cet cette ces par pour sur dans avec est sont a à été être plus très ou si ne pas mais car dont on nous vous leur leurs tout aussi comme même bien puis donc celui ceux nom noms forme formes var porte portent s d l j n y c".split()
WORD_BINS = [("0", 0), ("1-10", 10), ("11-30", 30), ("31-60", 60), ("61-100", 100)]
SIZE_BINS = [("1", 1), ("2", 2), ("3-5", 5), ("6-10", 10), ("11-20", 20)]


def _tokens(s, d):
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-zA-ZÀ-ÿ]{3,}"), 0)
    stop = F.array(*(F.lit(w) for w in STOPWORDS))
    return read(s, d, "documents").where("text IS NOT NULL").select("doc_id", F.filter(words, lambda w: ~F.array_contains(stop, w)).alias("w"))


def bigrams(s, d):
    return _tokens(s, d).select(F.explode(T.ngrams(F.col("w"), 2)).alias("bigram")).groupBy("bigram").agg(F.count("*").alias("n"))


def _records(s, d):
    return read(s, d, "prenoms_final").select("id", "prenom", "langue", "sexe", "geo", "id_groupe_total", "etymologie", "etymologie_v", "histoire", "histoire_v", "provenance", "provenance_v", "signification", "signification_v").distinct()


FIELDS = ["etymologie", "provenance", "histoire", "signification"]


def text_quality(s, d):
    df = _records(s, d).unpivot(["id"], [f"{f}_v" for f in FIELDS], "field", "t").where("trim(t) <> ''")
    df = df.withColumn("key", F.concat_ws("|", "id", "field"))
    repeated = metrics.repeated_trigrams(df, "key", "t")
    rows = df.join(repeated, "key")
    return rows.groupBy("field").agg(F.count("*").alias("n"), F.round(F.avg(metrics.flesch_fr(F.col("t"))), 6).alias("flesch"), F.round(F.avg(metrics.well_formed(F.col("t")).cast("int")), 6).alias("well_formed"), F.round(F.avg("share"), 6).alias("repeated"))


def rouge(s, d, n=1):
    df = _records(s, d).where("trim(histoire) <> '' AND trim(histoire_v) <> ''")
    return metrics.rouge_recall(df, "id", "histoire", "histoire_v", n).select("id", F.round("recall", 9).alias("recall"))


def unpivoted(s, d):
    return _records(s, d).unpivot(["id"], FIELDS, "field", "t").where("trim(t) <> ''").groupBy("field").agg(F.count("*").alias("n"), F.count_distinct("t").alias("distinct_n"))


def truth_pairs(s, d):
    """Consecutive members of a label, true if they have one language, predicted if one place."""
    df = _records(s, d).where("langue <> '' AND geo <> '' AND id_groupe_total IS NOT NULL")
    two = df.groupBy("id_groupe_total", "sexe").agg(F.min(F.struct("id", "langue", "geo")).alias("a"), F.max(F.struct("id", "langue", "geo")).alias("b")).where("a.id <> b.id")
    return metrics.pair_scores(two.select((F.col("a.langue") == F.col("b.langue")).alias("t"), (F.col("a.geo") == F.col("b.geo")).alias("p")), "t", "p")


def cache_report(s, d):
    """How many calls a cache of the rewritten texts saves."""
    df = _records(s, d).where("trim(histoire) <> ''")
    keys = df.select(F.sha2("histoire", 256).alias("k"))
    per = keys.groupBy("k").agg(F.count("*").alias("n"))
    return per.agg(F.sum("n").alias("texts"), F.count("*").alias("unique_texts"), F.round((F.sum("n") - F.count("*")) * 1.5 / 3600, 6).alias("hours_saved"))


QUERIES = {
    "bow": lambda s, d: _tokens(s, d).select(F.explode("w").alias("word")).groupBy("word").agg(F.count("*").alias("n")),
    "bigrams": bigrams,
    "word_cloud": lambda s, d: _tokens(s, d).select(F.explode("w").alias("word")).groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(200),
    "ttr": lambda s, d: _tokens(s, d).select("doc_id", F.round(metrics.type_token(F.col("w")), 9).alias("ttr")),
    "describe_len": lambda s, d: metrics.describe(read(s, d, "documents"), "n_chars"),
    "bins": lambda s, d: metrics.binned(read(s, d, "documents").select(T.token_count(F.col("text")).alias("n")), "n", WORD_BINS, "100+"),
    "size_bins": lambda s, d: metrics.binned(read(s, d, "prenoms_grouped").where("id_groupe_total IS NOT NULL").groupBy("id_groupe_total").agg(F.count("*").alias("n")), "n", SIZE_BINS, "21+"),
    "hist10": lambda s, d: metrics.histogram10(read(s, d, "lineitem").select((F.col("l_discount") * 10).alias("x")), "x"),
    "pivot": lambda s, d: _records(s, d).where("trim(langue) <> ''").groupBy("langue").pivot("sexe", ["fille", "garcon"]).agg(F.count(F.lit(1))).na.fill(0),
    "unpivot": unpivoted,
    "coverage": lambda s, d: metrics.coverage(_records(s, d), ["langue", "geo", "sexe", *FIELDS]),
    "extremes": lambda s, d: metrics.extremes(read(s, d, "noms_clean").where("nom IS NOT NULL"), "nom", "id"),
    "shares": lambda s, d: _records(s, d).where("trim(langue) <> ''").groupBy("langue").agg(F.round(F.count("*") * 100.0 / _records(s, d).agg(F.count("*")).scalar(), 1).alias("pct")),
    "length_by_initial": lambda s, d: read(s, d, "noms_clean").groupBy(F.upper(F.substring("nom", 1, 1)).alias("initial")).agg(F.count_distinct("nom").alias("n"), F.round(F.avg(F.length("nom")), 6).alias("mean")),
    "recap": lambda s, d: _records(s, d).agg(F.count("*").alias("records"), F.count_distinct("id_groupe_total").alias("groups"), F.count_distinct("langue").alias("languages"), F.sum(T.filled(F.col("histoire")).cast("int")).alias("with_history")),
    "hubs": lambda s, d: read(s, d, "prenoms_clean").select("prenom", F.coalesce(F.size("prenoms_lies"), F.lit(0)).alias("links")).distinct().orderBy(F.desc("links"), "prenom").limit(20),
    "text_quality": text_quality,
    "flesch": lambda s, d: read(s, d, "documents").where("text IS NOT NULL").select("doc_id", F.round(metrics.flesch_fr(F.col("text")), 6).alias("flesch"), metrics.well_formed(F.col("text")).alias("well_formed")),
    "trigram_rep": lambda s, d: metrics.repeated_trigrams(read(s, d, "documents"), "doc_id", "text").select("doc_id", F.round("share", 9).alias("share")),
    "rouge_recall": lambda s, d: rouge(s, d, 1),
    "rouge2_recall": lambda s, d: rouge(s, d, 2),
    "rouge_l": lambda s, d: _records(s, d).where("trim(histoire) <> '' AND trim(histoire_v) <> ''").select("id", F.round(metrics.rouge_l("histoire", "histoire_v"), 9).alias("recall")),
    "prf1": truth_pairs,
    "consistency": lambda s, d: metrics.consistency(_records(s, d), "id_groupe_total", "langue"),
    "pair_sample": lambda s, d: metrics.sample_pairs(_records(s, d), "id", "id_groupe_total", 200),
    "report_samples": lambda s, d: metrics.report_samples(_records(s, d).unpivot(["id"], FIELDS, "field", "t").where("trim(t) <> ''").select("id", "field", F.length("t").alias("score")), "id", "field", "score"),
    "cache_report": cache_report,
    "hash_cache_lookup": lambda s, d: summarize.rewrite(_records(s, d), "id", "histoire", _records(s, d).where("trim(histoire_v) <> ''").groupBy(F.sha2("histoire", 256).alias("key")).agg(F.min("histoire_v").alias("value")).where("key IS NOT NULL")).select("key", "value", "source_used"),
}

_LIST = ", ".join(f"'{w}'" for w in STOPWORDS)
_TOK = f"(SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[a-zA-ZÀ-ÿ]{{3,}}'), lambda w: w NOT IN ({_LIST})) AS w FROM documents WHERE text IS NOT NULL)"
_REC = "(SELECT DISTINCT id, prenom, langue, sexe, geo, id_groupe_total, etymologie, etymologie_v, histoire, histoire_v, provenance, provenance_v, signification, signification_v FROM prenoms_final)"
_LONG = "(" + " UNION ALL ".join(f"SELECT id, '{f}' AS field, {f} AS t FROM {_REC} WHERE trim({f}) <> ''" for f in FIELDS) + ")"
_COUNT = "CASE WHEN trim(regexp_replace(text, '\\s+', ' ', 'g')) = '' THEN 0 ELSE len(string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ')) END"


def _bins(expr: str, bins, rest: str) -> str:
    return "CASE " + " ".join(f"WHEN {expr} <= {top} THEN '{name}'" for name, top in bins) + f" ELSE '{rest}' END"


def _all(bins, rest: str) -> str:
    return "(VALUES " + ", ".join(f"('{n}')" for n, _ in [*bins, (rest, 0)]) + ") b(bin)"


_FLESCH = """CASE WHEN wc >= 3 THEN 207 - 1.015 * (wc / greatest(1, len(list_filter(regexp_split_to_array({0}, '[.!?]+'), lambda s: trim(s) <> '')))::DOUBLE)
    - 73.6 * (len(regexp_extract_all(lower({0}), '[aeiouyàâäéèêëîïôöùûü]')) / wc::DOUBLE) END"""
_WC = "len(regexp_extract_all({0}, '[\\p{{L}}\\p{{N}}\\p{{M}}_]+'))"


def _rouge(n: int) -> str:
    words = "list_filter(regexp_split_to_array(strip_accents(lower({0})), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')"
    gram = " || ' ' || ".join(f"w[i+{k}]" for k in range(n))
    side = lambda c: f"(SELECT id, {gram} AS g, count(*) AS c FROM (SELECT id, w, unnest(range(1, greatest(len(w) - {n - 2}, 1))) AS i FROM (SELECT id, {words.format(c)} AS w FROM r) WHERE len(w) >= {n}) GROUP BY ALL)"
    return f"WITH r AS (SELECT * FROM {_REC} WHERE trim(histoire) <> '' AND trim(histoire_v) <> '') SELECT a.id, round(sum(least(a.c, coalesce(b.c, 0))) / sum(a.c)::DOUBLE, 9) AS recall FROM {side('histoire')} a LEFT JOIN {side('histoire_v')} b ON a.id = b.id AND a.g = b.g GROUP BY a.id"


SQL = {
    "bow": f"SELECT unnest(w) AS word, count(*) AS n FROM {_TOK} GROUP BY 1",
    "bigrams": f"SELECT w[i] || ' ' || w[i+1] AS bigram, count(*) AS n FROM (SELECT w, unnest(range(1, len(w))) AS i FROM {_TOK} WHERE len(w) > 1) GROUP BY 1",
    "word_cloud": f"SELECT * FROM (SELECT unnest(w) AS word, count(*) AS n FROM {_TOK} GROUP BY 1) ORDER BY n DESC, word LIMIT 200",
    "ttr": f"SELECT doc_id, round(len(list_distinct(w))::DOUBLE / nullif(len(w), 0), 9) AS ttr FROM {_TOK}",
    "describe_len": "SELECT count(n_chars) AS n, round(avg(n_chars), 6) AS mean, round(stddev_samp(n_chars), 6) AS std, min(n_chars) AS min, " + ", ".join(f"round(quantile_cont(n_chars, {q / 100}), 6) AS p{q}" for q in (10, 25, 50, 75, 90)) + ", max(n_chars) AS max FROM documents",
    "bins": f"SELECT b.bin, coalesce(n, 0) AS n FROM {_all(WORD_BINS, '100+')} LEFT JOIN (SELECT {_bins(_COUNT, WORD_BINS, '100+')} AS bin, count(*) AS n FROM documents GROUP BY 1) x USING (bin)",
    "size_bins": f"SELECT b.bin, coalesce(n, 0) AS n FROM {_all(SIZE_BINS, '21+')} LEFT JOIN (SELECT {_bins('c', SIZE_BINS, '21+')} AS bin, count(*) AS n FROM (SELECT count(*) AS c FROM prenoms_grouped WHERE id_groupe_total IS NOT NULL GROUP BY id_groupe_total) GROUP BY 1) x USING (bin)",
    "hist10": "SELECT least(floor(x * 10), 9)::INT AS bin, count(*) AS n FROM (SELECT l_discount * 10 AS x FROM lineitem) WHERE x BETWEEN 0 AND 1 GROUP BY 1",
    "pivot": f"SELECT langue, count(*) FILTER (sexe = 'fille') AS fille, count(*) FILTER (sexe = 'garcon') AS garcon FROM {_REC} WHERE trim(langue) <> '' GROUP BY langue",
    "unpivot": f"SELECT field, count(*) AS n, count(DISTINCT t) AS distinct_n FROM {_LONG} GROUP BY field",
    "coverage": " UNION ALL ".join(f"SELECT '{c}' AS field, count(*) FILTER (trim({c}) <> '') AS filled, round(count(*) FILTER (trim({c}) <> '') * 100.0 / count(*), 6) AS pct FROM {_REC}" for c in ["langue", "geo", "sexe", *FIELDS]),
    "extremes": "SELECT arg_min(nom, (length(nom), id)) AS shortest, (SELECT nom FROM noms_clean WHERE nom IS NOT NULL ORDER BY length(nom) DESC, id LIMIT 1) AS longest FROM noms_clean",
    "shares": f"SELECT langue, round(count(*) * 100.0 / (SELECT count(*) FROM {_REC}), 1) AS pct FROM {_REC} WHERE trim(langue) <> '' GROUP BY langue",
    "length_by_initial": "SELECT upper(nom[1]) AS initial, count(DISTINCT nom) AS n, round(avg(length(nom)), 6) AS mean FROM noms_clean GROUP BY 1",
    "recap": f"SELECT count(*) AS records, count(DISTINCT id_groupe_total) AS groups, count(DISTINCT langue) AS languages, count(*) FILTER (trim(histoire) <> '') AS with_history FROM {_REC}",
    "hubs": "SELECT DISTINCT prenom, coalesce(len(prenoms_lies), 0)::INT AS links FROM prenoms_clean ORDER BY links DESC, prenom LIMIT 20",
    "flesch": f"SELECT doc_id, round({_FLESCH.format('text')}, 6) AS flesch, regexp_matches(trim(text), '(?s)^\\p{{Lu}}.*[.!?]$') AS well_formed FROM (SELECT doc_id, text, {_WC.format('text')} AS wc FROM documents WHERE text IS NOT NULL)",
    "trigram_rep": """WITH t AS (SELECT doc_id, string_split(trim(regexp_replace(lower(text), '[\\s\\x{a0}\\x{85}\\p{Z}]+', ' ', 'g')), ' ') AS w FROM documents WHERE text IS NOT NULL),
        g AS (SELECT doc_id, w[i] || ' ' || w[i+1] || ' ' || w[i+2] AS g, count(*) AS c FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM t WHERE len(w) > 2) GROUP BY ALL)
        SELECT t.doc_id, round(coalesce((SELECT count(*) FILTER (c >= 3) / sum(c)::DOUBLE FROM g WHERE g.doc_id = t.doc_id), 0), 9) AS share FROM t""",
    "rouge_recall": _rouge(1),
    "rouge2_recall": _rouge(2),
    "prf1": f"""WITH p AS (SELECT arg_min(langue, id) AS la, arg_max(langue, id) AS lb, arg_min(geo, id) AS ga, arg_max(geo, id) AS gb FROM {_REC} WHERE langue <> '' AND geo <> '' AND id_groupe_total IS NOT NULL GROUP BY id_groupe_total, sexe HAVING min(id) <> max(id)),
        c AS (SELECT count(*) FILTER (la = lb AND ga = gb) AS tp, count(*) FILTER (la <> lb AND ga = gb) AS fp, count(*) FILTER (la = lb AND ga <> gb) AS fn, count(*) FILTER (la <> lb AND ga <> gb) AS tn FROM p),
        m AS (SELECT *, coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0) AS precision, coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0) AS recall FROM c)
        SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM m""",
    "consistency": f"""WITH v AS (SELECT id_groupe_total AS g, langue, count(*) AS v FROM {_REC} WHERE trim(langue) <> '' GROUP BY ALL), t AS (SELECT g, max(v) AS top, sum(v) AS a FROM v GROUP BY g),
        z AS (SELECT id_groupe_total AS g FROM {_REC} WHERE id_groupe_total IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
        SELECT count(*) AS groups, count(*) FILTER (coalesce(top >= 0.75 * a, true)) AS consistent, round(avg(CASE WHEN coalesce(top >= 0.75 * a, true) THEN 1 ELSE 0 END), 6) AS share FROM z LEFT JOIN t USING (g)""",
    "cache_report": f"SELECT count(*) AS texts, count(DISTINCT histoire) AS unique_texts, round((count(*) - count(DISTINCT histoire)) * 1.5 / 3600, 6) AS hours_saved FROM {_REC} WHERE trim(histoire) <> ''",
}
_LONG_V = " UNION ALL ".join(f"SELECT id, '{f}_v' AS field, {f}_v AS t FROM {_REC} WHERE trim({f}_v) <> ''" for f in FIELDS)
SQL["text_quality"] = f"""WITH q AS ({_LONG_V}), u AS (SELECT id || '|' || field AS k, string_split(trim(regexp_replace(lower(t), '[\\s\\x{{a0}}\\x{{85}}\\p{{Z}}]+', ' ', 'g')), ' ') AS w FROM q),
        g AS (SELECT k, w[i] || ' ' || w[i+1] || ' ' || w[i+2] AS g, count(*) AS c FROM (SELECT k, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM u WHERE len(w) > 2) GROUP BY ALL),
        r AS (SELECT k, count(*) FILTER (c >= 3) / sum(c)::DOUBLE AS share FROM g GROUP BY k), x AS (SELECT field, t AS text, share, {_WC.format('t')} AS wc FROM q LEFT JOIN r ON r.k = id || '|' || field)
        SELECT field, count(*) AS n, round(avg({_FLESCH.format('text')}), 6) AS flesch, round(avg(regexp_matches(trim(text), '(?s)^\\p{{Lu}}.*[.!?]$')::INT), 6) AS well_formed, round(avg(coalesce(share, 0)), 6) AS repeated FROM x GROUP BY field"""
_SHOWN = "trim(regexp_replace(s, '[\\s\\x{a0}\\x{85}\\p{Z}]+', ' ', 'g'))"
SQL["hash_cache_lookup"] = f"""WITH p AS (SELECT id, histoire AS s, (SELECT min(histoire_v) FROM {_REC} x WHERE x.histoire = r.histoire AND trim(histoire_v) <> '') AS v FROM {_REC} r WHERE trim(histoire) <> ''),
        d AS (SELECT s AS t FROM p WHERE trim(v) <> '' UNION SELECT v FROM p WHERE trim(v) <> ''), c AS (SELECT t, term, count(*) AS tf FROM (SELECT t, unnest(regexp_extract_all(lower(t), '[\\p{{L}}\\p{{N}}\\p{{M}}_]{{2,}}')) AS term FROM d) GROUP BY ALL),
        n AS (SELECT count(*) AS n FROM d), f AS (SELECT term, count(*) AS df FROM c GROUP BY term), w AS (SELECT t, term, tf * (ln((1 + (SELECT n FROM n)) / (1 + df)::DOUBLE) + 1) AS w FROM c JOIN f USING (term)),
        u AS (SELECT t, term, w / sqrt(sum(w * w) OVER (PARTITION BY t)) AS w FROM w), k AS (SELECT DISTINCT s, v FROM p WHERE trim(v) <> ''),
        z AS (SELECT k.s, k.v, round(coalesce(sum(a.w * b.w), 0), 9) AS cosine FROM k LEFT JOIN u a ON a.t = k.s LEFT JOIN u b ON b.t = k.v AND b.term = a.term GROUP BY k.s, k.v),
        y AS (SELECT id, p.s, p.v, coalesce(trim(p.v) = '' OR cosine > 0.97, p.v IS NULL) AS refused FROM p LEFT JOIN z ON z.s = p.s AND z.v = p.v)
        SELECT id AS key, CASE WHEN refused THEN upper({_SHOWN}[1]) || {_SHOWN}[2:] || CASE WHEN regexp_matches({_SHOWN}, '[.!?]$') THEN '' ELSE '.' END ELSE v END AS value, refused AS source_used FROM y"""
