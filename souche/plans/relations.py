"""Queries over links, lookups, arrays and sets."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from souche.functions import text as T
from souche.operators import serve, skew
from souche.session import read
from souche.sources import files


def _names(s, d):
    return read(s, d, "noms_clean")


def _cited(s, d):
    """(id, at, raw): cited names of each record in order, copies of a record folded."""
    one = skew.first_rows(_names(s, d).where("size(noms_lies) > 0").select("id", "noms_lies"), ["id"], ["id"])
    return one.select("id", F.posexplode("noms_lies").alias("at", "raw"))


def resolve_links(s, d):
    """Linked names to ids, in order, unknown ones dropped."""
    known = _names(s, d).select(F.col("nom").alias("key"), F.col("id").alias("other")).distinct()
    rows = _cited(s, d).select("id", "at", T.linked_name(F.col("raw")).alias("key")).where("key <> ''").join(known, "key")
    return rows.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "other"))), lambda x: x["other"]), ",").alias("ids"))


def ordered_lookup(s, d):
    """Orders with the names of their parts in line order."""
    parts = read(s, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    rows = read(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").join(parts, "l_partkey", "left")
    return rows.groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", F.coalesce("p_name", F.lit("?")).alias("p")))), lambda x: x["p"]), " ").alias("names"))


def discover_new(s, d):
    """Cited names without a record: the first record that cites each, by id and place."""
    rows = _cited(s, d).select("id", "at", T.linked_name(F.col("raw")).alias("name")).where("length(name) >= 2")
    new = rows.join(_names(s, d).select(F.col("nom").alias("name")).distinct(), "name", "left_anti")
    return new.groupBy("name").agg(F.min(F.struct("id", "at")).alias("x")).select("name", F.col("x.id").alias("found_by"), T.stable_id(F.col("name")).alias("new_id"))


def propagate_links(s, d):
    """Members of one exact text get each other's links: (id, links), at most 15, own links first."""
    one = skew.first_rows(_names(s, d).where("origine <> ''").select("id", "nom", "origine", "noms_lies"), ["id"], ["nom"]).withColumn("g", F.md5("origine"))
    names = F.array_distinct(F.concat(F.array("nom"), F.filter(F.transform(F.coalesce("noms_lies", F.array().cast("array<string>")), lambda x: T.linked_name(x)), lambda x: x != "")))
    pool = one.select("g", F.explode(names).alias("x")).distinct()
    ranked = pool.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("x"))).where("r <= 32")
    pooled = ranked.groupBy("g").agg(F.array_sort(F.collect_list("x")).alias("pool"))
    own = F.array_distinct(F.filter(F.transform(F.coalesce("noms_lies", F.array().cast("array<string>")), lambda x: T.linked_name(x)), lambda x: (x != "") & (x != F.col("nom"))))
    rows = one.select("id", "nom", "g", own.alias("own")).join(pooled, "g")
    rest = F.array_except(F.array_except("pool", "own"), F.array("nom"))
    return rows.select("id", F.array_join(F.slice(F.concat("own", rest), 1, 15), ",").alias("links"))


def text_groups(s, d):
    """Records of one exact text share the id of its smallest name; those without text stand alone."""
    one = skew.first_rows(_names(s, d).select("id", "nom", "origine"), ["id"], ["nom"])
    has = F.trim(F.coalesce("origine", F.lit(""))) != ""
    least = one.where(has).groupBy(F.md5("origine").alias("g")).agg(F.min("nom").alias("first"))
    tied = one.where(has).withColumn("g", F.md5("origine")).join(least, "g").select("id", F.substring(F.md5(F.concat(F.lit("groupe_"), "first")), 1, 8).alias("groupe"))
    return tied.unionByName(one.where(~has).select("id", F.substring(F.md5(F.concat(F.lit("solo_"), "nom")), 1, 8).alias("groupe")))


def group_texts(s, d):
    """All distinct texts of a group, joined in order of their first record."""
    rows = read(s, d, "prenoms_grouped").where("id_groupe_total IS NOT NULL AND trim(provenance) <> ''").groupBy("id_groupe_total", "provenance").agg(F.min("id").alias("first"))
    rank = F.row_number().over(Window.partitionBy("id_groupe_total").orderBy("first", "provenance"))
    return rows.withColumn("r", rank).groupBy("id_groupe_total").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "provenance"))), lambda x: x["provenance"]), " --- ").alias("texte"))


def group_members(s, d):
    """All distinct members of a group, numbered in order."""
    rows = read(s, d, "groupes_finals").select("id_groupe_total", F.explode("noms").alias("nom")).where("trim(nom) <> '' AND id_groupe_total IS NOT NULL").distinct()
    rank = F.row_number().over(Window.partitionBy("id_groupe_total").orderBy("nom"))
    return rows.withColumn("seq", rank)


def left_enrich(s, d):
    last = read(s, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("last_order"))
    nation = read(s, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return read(s, d, "customer").select("c_custkey", "c_nationkey").join(last, "c_custkey", "left").join(nation, "c_nationkey", "left")


def member_labels(s, d):
    """Group labels back on their members."""
    labels = skew.vote(read(s, d, "prenoms_grouped"), "id_groupe_total", "langue").select(F.col("key").alias("id_groupe_total"), F.col("value").alias("langue_groupe"))
    return read(s, d, "prenoms_grouped").select("id", "id_groupe_total").distinct().join(labels, "id_groupe_total", "left")


def array_sets(s, d):
    arr = F.coalesce("noms_lies", F.array().cast("array<string>"))
    clean = F.filter(F.transform(arr, lambda x: T.linked_name(x)), lambda x: x != "")
    one = _names(s, d).select("id", "nom", clean.alias("c"), F.coalesce("id_noms_lies", F.array().cast("array<string>")).alias("ids")).distinct()
    return one.select(
        "id", F.size(F.array_distinct("c")).alias("links"), F.size(F.array_except("c", F.array("nom"))).alias("others"), F.array_contains("c", F.col("nom")).alias("selfref"),
        F.size(F.array_distinct("ids")).alias("resolved"), F.array_join(F.array_sort(F.array_distinct("c")), ",").alias("sorted"),
    ).distinct()


def resume_anti(s, d):
    """First names of the statistics that have no record."""
    done = read(s, d, "prenoms_clean").select("prenom").distinct()
    return read(s, d, "prenoms_stats").select(T.first_name_key(F.col("prenom")).alias("prenom")).where("prenom <> ''").distinct().join(done, "prenom", "left_anti")


def scalar_math(s, d):
    df = read(s, d, "orders")
    return df.select(
        "o_orderkey", files.page_count(F.col("o_orderkey"), 30).cast("bigint").alias("pages"), (F.greatest(F.lit(10), F.sqrt(F.abs("o_orderkey")).cast("int")) + 5).alias("size"),
        (F.col("o_totalprice") / 10.0).alias("mean"), serve.marker(F.year("o_orderdate")).alias("marker"),
    )


def nested_get(s, d):
    k = F.get_json_object("props", "$.k").try_cast("int")
    rows = read(s, d, "events").select("event_id", k.alias("k"), F.coalesce(k, F.lit(-1)).alias("or_default"), F.to_json(F.struct(k.alias("k"))).alias("again"))
    return rows.select("*", (F.get_json_object("again", "$.k").try_cast("int") == F.col("k")).alias("same"))


QUERIES = {
    "resolve_links": resolve_links, "array_join_lookup": ordered_lookup, "discover_new": discover_new, "propagate_links": propagate_links,
    "text_groups": text_groups, "group_texts": group_texts, "group_members": group_members, "left_enrich": left_enrich,
    "member_labels": member_labels, "array_set_ops": array_sets, "resume_anti": resume_anti, "scalar_math": scalar_math, "nested_get": nested_get,
    "dedup_first": lambda s, d: skew.first_rows(read(s, d, "events").select("user_id", "event_type", "event_id", "ts"), ["user_id", "event_type"], ["event_id"]),
    "last_duplicate": lambda s, d: skew.first_rows(read(s, d, "prenoms_stats").where("annee IS NOT NULL AND dept IS NOT NULL").select("prenom", "annee", "dept", "count", "charge_le"), ["prenom", "annee", "dept"], [F.desc("charge_le"), "count"]).select("prenom", "annee", "dept", "count"),
    "unions": lambda s, d: read(s, d, "noms_clean").select(F.lower("nom").alias("name")).union(read(s, d, "prenoms_clean").select(F.lower("prenom"))).distinct(),
    "intersection": lambda s, d: read(s, d, "prenoms_clean").select("id").intersect(read(s, d, "prenoms_final").select("id")),
    "difference": lambda s, d: read(s, d, "prenoms_clean").select("prenom").exceptAll(read(s, d, "prenoms_final").select("prenom")).distinct(),
}

_CLEAN = "trim(regexp_replace(replace(strip_accents(lower(regexp_replace(regexp_replace({0}, '\\([^)]*\\)', ' ', 'g'), '[0-9]+', '', 'g'))), '-', ' '), '\\s+', ' ', 'g'))"
_ONE = "(SELECT id, nom, any_value(noms_lies) AS l FROM noms_clean GROUP BY id, nom)"
_CITED = f"(SELECT id, unnest(range(len(l))) AS seq, unnest(l) AS raw FROM {_ONE})"
_LINKS = f"list_filter(list_transform(coalesce(noms_lies, []), lambda x: {_CLEAN.format('x')}), lambda x: x <> '')"

SQL = {
    "propagate_links": f"""WITH o AS (SELECT id, nom, any_value(origine) AS g, any_value(noms_lies) AS noms_lies FROM noms_clean WHERE origine <> '' GROUP BY id, nom), c AS (SELECT id, nom, g, {_LINKS} AS k FROM o),
        d AS (SELECT id, nom, g, k, list_filter(k, lambda x, i: list_position(k, x) = i AND x <> nom) AS own FROM c), p AS (SELECT g, list_sort(list(DISTINCT x)) AS pool FROM (SELECT g, unnest([nom] || k) AS x FROM d) GROUP BY g)
        SELECT id, array_to_string((own || list_filter(pool, lambda x: x <> nom AND NOT list_contains(own, x)))[1:15], ',') AS links FROM d JOIN p USING (g)""",
    "resolve_links": f"SELECT c.id, string_agg(k.id, ',' ORDER BY seq, k.id) AS ids FROM (SELECT id, seq, {_CLEAN.format('raw')} AS k FROM {_CITED}) c JOIN (SELECT DISTINCT nom, id FROM noms_clean) k ON k.nom = c.k WHERE c.k <> '' GROUP BY c.id",
    "array_join_lookup": "SELECT l_orderkey, string_agg(coalesce(p_name, '?'), ' ' ORDER BY l_linenumber, coalesce(p_name, '?')) AS names FROM lineitem LEFT JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey",
    "discover_new": f"""SELECT name, found_by, substr(md5(name), 1, 8) AS new_id FROM (SELECT name, id AS found_by, row_number() OVER (PARTITION BY name ORDER BY id, seq) AS r
        FROM (SELECT id, seq, {_CLEAN.format('raw')} AS name FROM {_CITED}) WHERE length(name) >= 2 AND name NOT IN (SELECT nom FROM noms_clean)) WHERE r = 1""",
    "text_groups": """WITH o AS (SELECT DISTINCT id, nom, origine FROM noms_clean), f AS (SELECT origine, min(nom) AS first FROM o WHERE trim(origine) <> '' GROUP BY origine)
        SELECT o.id, substr(md5(CASE WHEN first IS NULL THEN 'solo_' || nom ELSE 'groupe_' || first END), 1, 8) AS groupe FROM o LEFT JOIN f ON f.origine = o.origine""",
    "group_texts": """SELECT id_groupe_total, string_agg(provenance, ' --- ' ORDER BY r) AS texte FROM (SELECT id_groupe_total, provenance, row_number() OVER (PARTITION BY id_groupe_total ORDER BY f, provenance) AS r
        FROM (SELECT id_groupe_total, provenance, min(id) AS f FROM prenoms_grouped WHERE id_groupe_total IS NOT NULL AND trim(provenance) <> '' GROUP BY 1, 2)) GROUP BY id_groupe_total""",
    "group_members": "SELECT id_groupe_total, nom, row_number() OVER (PARTITION BY id_groupe_total ORDER BY nom)::INT AS seq FROM (SELECT DISTINCT id_groupe_total, unnest(noms) AS nom FROM groupes_finals WHERE id_groupe_total IS NOT NULL) WHERE trim(nom) <> ''",
    "left_enrich": "SELECT c_custkey, c_nationkey, (SELECT arg_max(o_orderkey, (o_orderdate, o_orderkey)) FROM orders WHERE o_custkey = c_custkey) AS last_order, n_name FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey",
    "member_labels": """WITH v AS (SELECT id_groupe_total AS g, langue, row_number() OVER (PARTITION BY id_groupe_total ORDER BY count(*) DESC, langue) AS r FROM prenoms_grouped WHERE trim(langue) <> '' AND id_groupe_total IS NOT NULL GROUP BY id_groupe_total, langue)
        SELECT DISTINCT id, id_groupe_total, v.langue AS langue_groupe FROM prenoms_grouped p LEFT JOIN v ON v.g = p.id_groupe_total AND r = 1""",
    "array_set_ops": f"""SELECT DISTINCT id, len(list_distinct(c))::INT AS links, len(list_filter(list_distinct(c), lambda x: x <> nom))::INT AS others, list_contains(c, nom) AS selfref,
        len(list_distinct(ids))::INT AS resolved, array_to_string(list_sort(list_distinct(c)), ',') AS sorted FROM (SELECT id, nom, {_LINKS} AS c, coalesce(id_noms_lies, []) AS ids FROM noms_clean)""",
    "resume_anti": "SELECT DISTINCT prenom FROM (SELECT trim(regexp_replace(regexp_replace(strip_accents(lower(prenom)), '[-''’]', ' ', 'g'), '\\s+', ' ', 'g')) AS prenom FROM prenoms_stats) WHERE prenom <> '' AND prenom NOT IN (SELECT prenom FROM prenoms_clean)",
    "scalar_math": "SELECT o_orderkey, greatest(1, ceil(o_orderkey / 30.0))::BIGINT AS pages, greatest(10, floor(sqrt(abs(o_orderkey)))::INT) + 5 AS size, o_totalprice / 10.0::DOUBLE AS mean, least(greatest(round((year(o_orderdate) - 500) / 1500.0 * 100, 1), 2.0), 97.0)::DOUBLE AS marker FROM orders",
    "nested_get": "SELECT event_id, k, coalesce(k, -1) AS or_default, '{\"k\":' || k || '}' AS again, true AS same FROM (SELECT event_id, try_cast(json_extract_string(props, '$.k') AS INT) AS k FROM events)",
    "dedup_first": "SELECT user_id, event_type, event_id, ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1",
    "last_duplicate": "SELECT prenom, annee, dept, count FROM prenoms_stats WHERE annee IS NOT NULL AND dept IS NOT NULL QUALIFY row_number() OVER (PARTITION BY prenom, annee, dept ORDER BY charge_le DESC, count) = 1",
    "unions": "SELECT lower(nom) AS name FROM noms_clean UNION SELECT lower(prenom) FROM prenoms_clean",
    "intersection": "SELECT id FROM prenoms_clean INTERSECT SELECT id FROM prenoms_final",
    "difference": "SELECT DISTINCT prenom FROM (SELECT prenom FROM prenoms_clean EXCEPT ALL SELECT prenom FROM prenoms_final)",
}
