"""Queries over birth statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from souche.operators import trends
from souche.session import read


def _measures(s, d):
    return trends.clean_measures(read(s, d, "prenoms_stats"))


def _names(s, d):
    """One row per first name: the label of its last row in label order (copies carry the same)."""
    return read(s, d, "prenoms_grouped").groupBy("prenom").agg(F.max("id_groupe_total").alias("id_groupe_total"))


def department_rows(s, d):
    rows = read(s, d, "prenoms_stats").withColumn("level", F.when(F.col("dept").isNotNull(), "DEP").otherwise("NAT"))
    return trends.department_rows(rows, "level").groupBy("level").agg(F.count("*").alias("n"))


def decades(s, d):
    rows = _measures(s, d).where("annee >= 1900 AND annee < 2030").withColumn("dec", F.concat(F.lit("_"), (F.floor(F.col("annee") / 10) * 10 + 1).cast("string"), F.lit("_"), (F.floor(F.col("annee") / 10) * 10 + 10).cast("string")))
    columns = [f"_{y + 1}_{y + 10}" for y in range(1900, 2030, 10)]
    wide = rows.groupBy("prenom").pivot("dec", columns).agg(F.sum("count"))
    return trends.decade_total(wide, columns)


def map_series(s, d):
    return trends.nested_trends(_measures(s, d)).select("prenom", F.size("national").alias("years"), F.element_at("national", 1)["annee"].alias("first_year"), F.coalesce(F.size("par_dept"), F.lit(0)).alias("depts"), F.array_join(F.array_sort(F.map_keys("par_dept")), ",").alias("dept_list"))


QUERIES = {
    "name_trends": lambda s, d: trends.trends(_measures(s, d)),
    "trend_by_key": lambda s, d: trends.national_series(_measures(s, d)),
    "trend_by_key_dept": lambda s, d: trends.department_series(_measures(s, d)),
    "top_departments": lambda s, d: trends.top_departments(_measures(s, d)),
    "nested_trends": map_series,
    "inner_enrich": lambda s, d: trends.enrich(_measures(s, d), _names(s, d)).groupBy("groupe").agg(F.sum("count").alias("births"), F.count("*").alias("n")),
    "inner_enrich_cov": lambda s, d: trends.coverage(_measures(s, d), _names(s, d)),
    "choropleth": lambda s, d: trends.choropleth(_measures(s, d), 1950, 2000),
    "department_level_filter": department_rows,
    "decade_totals": lambda s, d: decades(s, d).select("prenom", "nombre_total"),
    "compare_series": lambda s, d: trends.decade_points(decades(s, d), "prenom"),
}

_M = """(SELECT DISTINCT trim(regexp_replace(regexp_replace(strip_accents(lower(prenom)), '[-''’]', ' ', 'g'), '\\s+', ' ', 'g')) AS prenom, annee,
    CASE WHEN length(dept) < 2 THEN lpad(dept, 2, '0') ELSE dept END AS dept, count AS c, id_groupe_total
    FROM prenoms_stats WHERE annee IS NOT NULL AND count >= 3 AND prenom IS NOT NULL AND prenom[1] <> '_')"""
_TOP = f"""(SELECT prenom, dept, births, row_number() OVER (PARTITION BY prenom ORDER BY births DESC, dept) AS rank
    FROM (SELECT prenom, dept, sum(c)::BIGINT AS births FROM {_M} WHERE dept IS NOT NULL GROUP BY ALL) QUALIFY rank <= 5)"""
_NAMES = "(SELECT prenom, max(id_groupe_total) AS groupe FROM prenoms_grouped GROUP BY prenom)"
_DECADES = f"(SELECT prenom, (annee // 10) * 10 AS y, sum(c)::BIGINT AS n FROM {_M} WHERE annee >= 1900 AND annee < 2030 GROUP BY ALL)"

SQL = {
    "name_trends": f"""
        WITH s AS (SELECT prenom, annee, sum(c)::BIGINT AS births FROM {_M} GROUP BY ALL),
        w AS (SELECT prenom, sum(births)::BIGINT AS total, min(annee) AS first_year, max(annee) AS last_year FROM s GROUP BY prenom),
        p AS (SELECT prenom, annee AS pic_annee FROM s QUALIFY row_number() OVER (PARTITION BY prenom ORDER BY births DESC, annee) = 1),
        t AS (SELECT prenom, string_agg(dept, ',' ORDER BY rank) AS top_depts FROM {_TOP} GROUP BY prenom)
        SELECT w.prenom, total, pic_annee, first_year, last_year, top_depts FROM w JOIN p USING (prenom) LEFT JOIN t USING (prenom)""",
    "trend_by_key": f"SELECT prenom, annee, sum(c)::BIGINT AS births FROM {_M} GROUP BY ALL",
    "trend_by_key_dept": f"SELECT prenom, dept, annee, sum(c)::BIGINT AS births FROM {_M} WHERE dept IS NOT NULL GROUP BY ALL",
    "top_departments": f"SELECT * FROM {_TOP}",
    "nested_trends": f"""
        WITH n AS (SELECT prenom, count(DISTINCT annee) AS years, min(annee) AS first_year FROM {_M} GROUP BY prenom),
        t AS (SELECT prenom, count(*) AS depts, string_agg(dept, ',' ORDER BY dept) AS dept_list FROM {_TOP} GROUP BY prenom)
        SELECT prenom, years::INT AS years, first_year, coalesce(depts, 0)::INT AS depts, dept_list FROM n LEFT JOIN t USING (prenom)""",
    "inner_enrich": f"SELECT groupe, sum(c)::BIGINT AS births, count(*) AS n FROM {_M} JOIN {_NAMES} USING (prenom) GROUP BY groupe",
    "inner_enrich_cov": f"""
        SELECT count(*) AS rows, count(CASE WHEN k.prenom IS NOT NULL THEN 1 END) AS matched, count(DISTINCT m.prenom) AS names, count(DISTINCT k.prenom) AS names_matched
        FROM {_M} m LEFT JOIN {_NAMES} k ON m.prenom = k.prenom""",
    "choropleth": f"""
        WITH t AS (SELECT dept, sum(c)::BIGINT AS births FROM {_M} WHERE annee BETWEEN 1950 AND 2000 AND dept IS NOT NULL GROUP BY dept),
        r AS (SELECT dept, births, births / greatest(max(births) OVER (), 1)::DOUBLE AS x FROM t)
        SELECT dept, births, round(x, 6) AS share_of_max, CASE WHEN x > 0.8 THEN 5 WHEN x > 0.5 THEN 4 WHEN x > 0.2 THEN 3 WHEN x > 0.05 THEN 2 ELSE 1 END AS colour FROM r""",
    "department_level_filter": "SELECT 'DEP' AS level, count(*) AS n FROM prenoms_stats WHERE dept IS NOT NULL",
    "decade_totals": f"SELECT prenom, sum(n)::BIGINT AS nombre_total FROM {_DECADES} GROUP BY prenom",
    "compare_series": f"""
        SELECT p.prenom, (y.y + 10)::INT AS x, coalesce(d.n, 0) / 10.0 AS y FROM (SELECT DISTINCT prenom FROM {_DECADES}) p
        CROSS JOIN (SELECT unnest(range(1900, 2030, 10)) AS y) y LEFT JOIN {_DECADES} d ON d.prenom = p.prenom AND d.y = y.y""",
}
