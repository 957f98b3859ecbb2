"""Queries over text scalars, labels and lists drawn from text."""

from __future__ import annotations

from pyspark.sql import functions as F

from souche.functions import extract as X
from souche.functions import text as T
from souche.session import read


def _notes(s, d):
    return read(s, d, "documents").where("text IS NOT NULL")


def _surnames(s, d):
    return read(s, d, "noms_clean").select("id", "nom", "nom_original", "origine_brute").distinct().where("origine_brute IS NOT NULL")


def _first_names(s, d):
    return read(s, d, "prenoms_clean").select("id", "prenom", "prenom_original", "etymologie", "histoire", "texte_brut", "url").distinct()


def normalize_key(s, d):
    a = read(s, d, "noms_clean").select(F.lit("nom").alias("genre"), F.col("nom_original").alias("raw")).select("genre", "raw", T.surname_key(F.col("raw")).alias("key"))
    b = read(s, d, "prenoms_clean").select(F.lit("prenom").alias("genre"), F.col("prenom_original").alias("raw")).select("genre", "raw", T.first_name_key(F.col("raw")).alias("key"))
    return a.unionByName(b).distinct()


def text_lengths(s, d):
    t = F.col("text")
    return _notes(s, d).select("doc_id", T.token_count(t).alias("tokens"), F.length(t).alias("chars"), T.filled(t).alias("filled"), T.thousands(F.col("n_chars")).alias("shown"), F.substring("text", 1, 160).alias("head"))


def labels(s, d):
    body = F.col("origine_brute")
    return _surnames(s, d).select("id", X.first_label(body, X.SURNAME_LANGUAGES).alias("langue"), X.first_label(body, X.SURNAME_PLACES).alias("geo"), X.bag_label(body, X.BAG_LANGUAGES).alias("langue_sac"), X.bag_label(body, X.BAG_PLACES).alias("geo_sac"))


def first_name_labels(s, d):
    body = F.col("texte_brut")
    return _first_names(s, d).where("texte_brut <> ''").select("id", X.first_label(body, X.LANGUAGES).alias("langue"), X.first_label(body, X.RELIGIONS).alias("religion"), X.first_label(body, X.PLACES).alias("geo"))


def _lists(df, key, col):
    return df.select(key, F.posexplode(col).alias("at", "item"))


QUERIES = {
    "normalize_key": normalize_key,
    "stable_id": lambda s, d: normalize_key(s, d).select("genre", "key", T.stable_id(F.col("key")).alias("stable")).distinct(),
    "display_name": lambda s, d: read(s, d, "noms_clean").select("nom", T.display_name(F.col("nom")).alias("shown"), T.title_case(F.col("nom")).alias("title")).distinct(),
    "statistics_key": lambda s, d: read(s, d, "prenoms_stats").select("prenom", T.statistics_key(F.col("prenom")).alias("key")).distinct(),
    "clean_text": lambda s, d: _notes(s, d).select("doc_id", T.clean_first_name_text(F.col("text")).alias("clean")),
    "clean_surname_text": lambda s, d: _surnames(s, d).select("id", T.clean_surname_text(F.col("origine_brute")).alias("clean")),
    "display_clean": lambda s, d: _surnames(s, d).select("id", T.display_text(F.col("origine_brute")).alias("shown")),
    "embedding_text": lambda s, d: _first_names(s, d).join(read(s, d, "prenoms_clean").select("id", "provenance").distinct(), "id").select("id", T.embedding_text(F.col("histoire"), F.col("provenance"), F.col("etymologie")).alias("texte")),
    "text_lengths": text_lengths,
    "sex_of_url": lambda s, d: _first_names(s, d).select("id", X.sex_of_url(F.col("url")).alias("sexe")).distinct(),
    "affixes": lambda s, d: read(s, d, "noms_clean").select("nom", F.substring("nom", 1, 2).alias("p2"), F.substring("nom", 1, 3).alias("p3"), F.right("nom", F.lit(2)).alias("s2"), F.right("nom", F.lit(3)).alias("s3"), F.upper(F.substring("nom", 1, 1)).alias("initial"), F.length("nom").alias("n"), F.col("nom").rlike(r"[-\s]").alias("compound")).distinct(),
    "distance_limit": lambda s, d: read(s, d, "noms_clean").select("nom", T.distance_limit(F.length("nom")).alias("edits")).distinct(),
    "sentences": lambda s, d: _lists(_notes(s, d), "doc_id", T.sentences(F.col("text"))),
    "first_match_label": labels,
    "first_name_labels": first_name_labels,
    "multi_label": lambda s, d: _surnames(s, d).select("id", F.explode(X.multi_labels(F.col("origine_brute"), X.MULTI_LANGUAGES)).alias("langue")).groupBy("langue").agg(F.count("*").alias("n")),
    "place_counts": lambda s, d: _surnames(s, d).select("id", F.explode(X.multi_labels(F.col("origine_brute"), {w: [w] for w in X.PLACE_WORDS})).alias("lieu")).groupBy("lieu").agg(F.count("*").alias("n")),
    "extract_date": lambda s, d: _surnames(s, d).select("id", X.date_struct(F.col("origine_brute")).alias("x")).select("id", "x.label", "x.valeur"),
    "extract_year": lambda s, d: _notes(s, d).select("doc_id", X.year_of(F.col("text")).alias("year")),
    "candidates": lambda s, d: _lists(_surnames(s, d), "id", X.candidates(F.col("origine_brute"))),
    "candidates_first_names": lambda s, d: _lists(_first_names(s, d).where("etymologie <> ''"), "id", X.candidates(F.col("etymologie"), True)),
    "label_list": lambda s, d: _lists(_surnames(s, d), "id", X.labelled_names(F.col("origine_brute"))),
    "label_list_first_names": lambda s, d: _lists(_first_names(s, d).where("etymologie <> ''"), "id", X.labelled_names(F.col("etymologie"), True)),
    "enum_list": lambda s, d: _lists(_first_names(s, d).where("histoire <> ''"), "id", X.enumerated(F.col("histoire"))),
    "lev_links": lambda s, d: _lists(_surnames(s, d), "id", X.close_names(F.col("nom"), F.col("origine_brute"))),
    "valid_links": lambda s, d: read(s, d, "prenoms_clean").select("id", F.explode("prenoms_lies").alias("lie")).where("lie IS NOT NULL").select("id", "lie", X.valid_link(F.col("lie")).alias("valid")).distinct(),
}


def _first(labels_, body: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({body}, '(^|[^\\p{{L}}\\p{{N}}_])({w.replace(chr(39), chr(39) * 2)})($|[^\\p{{L}}\\p{{N}}_])') THEN '{label}'" for label, w in labels_) + " ELSE '' END"


def _bag(labels_, words: str) -> str:
    return "CASE " + " ".join(f"WHEN list_has_all({words}, {T.words_py(label)}) THEN '{label}'" for label in labels_) + " ELSE '' END"


def _key(col: str, blanks: str) -> str:
    return f"trim(regexp_replace(regexp_replace(strip_accents(lower({col})), '{blanks}', ' ', 'g'), '\\s+', ' ', 'g'))"


_FOLDED = "trim(regexp_replace(strip_accents(lower({0})), '\\s+', ' ', 'g'))"
_KEYS = f"""(SELECT DISTINCT 'nom' AS genre, nom_original AS raw, {_key("nom_original", "-")} AS key FROM noms_clean
    UNION SELECT DISTINCT 'prenom', prenom_original, {_key("prenom_original", "[-''’]")} FROM prenoms_clean)"""
_SN = "(SELECT DISTINCT id, nom, nom_original, origine_brute FROM noms_clean WHERE origine_brute IS NOT NULL)"
_FN = "(SELECT DISTINCT id, prenom, prenom_original, etymologie, histoire, texte_brut, url FROM prenoms_clean)"
_CLEANED = "trim(regexp_replace(regexp_replace(regexp_replace({0}, '<[^>]+>', ' ', 'g'), 'https?://\\S+', ' ', 'g'), '\\s+', ' ', 'g'))"
_SQ = "trim(regexp_replace({0}, '\\s+', ' ', 'g'))"
_WORDS = "list_filter(regexp_split_to_array(strip_accents(lower({0})), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')"


def _multi(groups: dict) -> str:
    return " UNION ALL ".join(f"SELECT '{k}' AS k, count(*) AS n FROM {_SN} WHERE " + " OR ".join(f"contains(lower(origine_brute), '{w}')" for w in words) + " HAVING count(*) > 0" for k, words in groups.items())


_ROMAN = "(SELECT upper(r) AS r, v FROM (VALUES " + ", ".join(f"('{r}', {v})" for v, r in enumerate([t + u for t in ("", "x", "xx", "xxx") for u in ("", "i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix")]) if r) + ") x(r, v))"

_W = "\\p{L}\\p{Nd}\\p{M}\\p{Pc}"  # what counts as a letter of a word
_BARE = f"regexp_replace(regexp_replace(regexp_replace(strip_accents(origine_brute), 'https?://\\S+|www\\.\\S+', ' ', 'g'), '(^|[^{_W}])\\p{{Nd}}+[{_W}]*', '\\1 ', 'g'), '[^{_W}\\s\\x{{a0}}\\x{{85}}\\p{{Z}}''-]', ' ', 'g')"


def _joined(x: str) -> str:
    """Hyphens between letters marked to stay."""
    return f"regexp_replace({x}, '([{_W}])-([{_W}])', '\\1' || chr(1) || '\\2', 'g')"


SQL = {
    "clean_surname_text": f"SELECT id, trim(regexp_replace(lower(replace(replace({_joined(_joined(_BARE))}, '-', ' '), chr(1), '-')), '[\\s\\x{{a0}}\\x{{85}}\\p{{Z}}]+', ' ', 'g')) AS clean FROM {_SN}",
    "text_lengths": """SELECT doc_id, CASE WHEN t = '' THEN 0 ELSE len(string_split(t, ' '))::INT END AS tokens, length(text)::INT AS chars, trim(text) <> '' AS filled, replace(format('{:,}', n_chars), ',', ' ') AS shown, text[1:160] AS head
        FROM (SELECT *, trim(regexp_replace(text, '[\\s\\x{a0}\\x{85}\\p{Z}]+', ' ', 'g')) AS t FROM documents WHERE text IS NOT NULL)""",
    "normalize_key": f"SELECT * FROM {_KEYS}",
    "stable_id": f"SELECT DISTINCT genre, key, substr(md5(key), 1, 8) AS stable FROM {_KEYS}",
    "display_name": """SELECT DISTINCT nom, array_to_string(list_transform(string_split(nom, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS shown,
        array_to_string(list_transform(regexp_extract_all(lower(nom), '\\p{L}+|[^\\p{L}]+'), lambda w: upper(w[1]) || w[2:]), '') AS title FROM noms_clean""",
    "statistics_key": "SELECT DISTINCT prenom, trim(regexp_replace(regexp_replace(strip_accents(lower(prenom)), '[^a-z\\s\\-]', ' ', 'g'), '\\s+', ' ', 'g')) AS key FROM prenoms_stats",
    "clean_text": "SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), 'https?://\\S+', ' ', 'g'), '[\\s\\x{a0}\\x{85}\\p{Z}]+', ' ', 'g')) AS clean FROM documents WHERE text IS NOT NULL",
    "display_clean": f"""SELECT id, CASE WHEN t = '' THEN '' WHEN regexp_matches(t, '[.!?]$') THEN upper(t[1]) || t[2:] ELSE upper(t[1]) || t[2:] || '.' END AS shown FROM (SELECT id, {_SQ.format("origine_brute")} AS t FROM {_SN})""",
    "sentences": r"""WITH p AS (SELECT doc_id, list_filter(string_split(regexp_replace(trim(text), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: length(x) >= 25) AS l FROM documents WHERE text IS NOT NULL)
        SELECT doc_id, unnest(l) AS item, unnest(range(len(l)))::INT AS at FROM p""",
    "embedding_text": f"""SELECT id, concat_ws(' | ', nullif({_CLEANED.format("histoire")}, ''), nullif({_CLEANED.format("histoire")}, ''), nullif({_CLEANED.format("provenance")}, ''), nullif({_CLEANED.format("etymologie")}, '')) AS texte
        FROM (SELECT DISTINCT id, prenom, prenom_original, etymologie, histoire, texte_brut, url, provenance FROM prenoms_clean)""",
    "sex_of_url": f"SELECT DISTINCT id, CASE WHEN contains(url, 'fille') THEN 'fille' WHEN contains(url, 'garcon') THEN 'garcon' ELSE 'inconnu' END AS sexe FROM {_FN}",
    "affixes": "SELECT DISTINCT nom, nom[1:2] AS p2, nom[1:3] AS p3, right(nom, 2) AS s2, right(nom, 3) AS s3, upper(nom[1]) AS initial, length(nom)::INT AS n, regexp_matches(nom, '[-\\s]') AS compound FROM noms_clean",
    "distance_limit": "SELECT DISTINCT nom, CASE WHEN length(nom) <= 4 THEN 1 WHEN length(nom) <= 7 THEN 2 ELSE 3 END AS edits FROM noms_clean",
    "first_match_label": f"""SELECT id, {_first(X.SURNAME_LANGUAGES, "b")} AS langue, {_first(X.SURNAME_PLACES, "b")} AS geo, {_bag(X.BAG_LANGUAGES, "w")} AS langue_sac, {_bag(X.BAG_PLACES, "w")} AS geo_sac
        FROM (SELECT id, {_FOLDED.format("origine_brute")} AS b, {_WORDS.format("origine_brute")} AS w FROM {_SN})""",
    "first_name_labels": f"""SELECT id, {_first(X.LANGUAGES, "b")} AS langue, {_first(X.RELIGIONS, "b")} AS religion, {_first(X.PLACES, "b")} AS geo FROM (SELECT id, {_FOLDED.format("texte_brut")} AS b FROM {_FN} WHERE texte_brut <> '')""",
    "multi_label": f"SELECT k AS langue, n FROM ({_multi(X.MULTI_LANGUAGES)})",
    "place_counts": f"SELECT k AS lieu, n FROM ({_multi({w: [w] for w in X.PLACE_WORDS})})",
    "extract_date": f"""WITH b AS (SELECT id, strip_accents(lower(origine_brute)) AS t FROM {_SN}),
        c AS (SELECT id, upper(regexp_extract(t, '(^|[^\\p{{L}}\\p{{N}}_])([xvi]+)(ieme|eme|er|e)?\\s*siecle($|[^\\p{{L}}\\p{{N}}_])', 2)) AS r, regexp_extract(t, '(^|[^\\p{{L}}\\p{{N}}_])(1[0-9]{{3}}|20[0-2][0-9])($|[^\\p{{L}}\\p{{N}}_])', 2) AS y FROM b)
        SELECT id, CASE WHEN v IS NOT NULL THEN c.r || ' siècle' ELSE y END AS label, CASE WHEN v IS NOT NULL THEN (v - 1) * 100 + 50 ELSE try_cast(nullif(y, '') AS INT) END AS valeur FROM c LEFT JOIN {_ROMAN} n ON n.r = c.r""",
    "extract_year": "SELECT doc_id, try_cast(nullif(regexp_extract(text, '(\\d{4})', 1), '') AS INT) AS year FROM documents WHERE text IS NOT NULL",
    "valid_links": f"""SELECT DISTINCT id, lie, length(trim(lie)) >= 2 AND regexp_matches(lie, '^[\\p{{L}}\\s-]+$') AND strip_accents(lower(lie)) NOT IN ({", ".join(repr(w) for w in X.LINK_STOPWORDS)}) AS valid
        FROM (SELECT id, unnest(prenoms_lies) AS lie FROM prenoms_clean) WHERE lie IS NOT NULL""",
}
