"""Queries over skewed group labels (problem 5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from souche.operators import skew
from souche.session import read


def p5_found(s, d):
    parts = [
        skew.heavy_keys(read(s, d, t), "id_groupe_total").select(F.lit(t).alias("nom_table"), F.col("key").alias("id_groupe_total"))
        for t in ("prenoms_grouped", "groupes_finals")
    ]
    return parts[0].unionByName(parts[1])


def p5_members(s, d):
    return skew.group_report(read(s, d, "prenoms_grouped"), "id_groupe_total", ["langue", "religion", "geo", "sexe"]).withColumnRenamed("key", "id_groupe_total")


def p5_lots(s, d):
    return skew.lot_report(read(s, d, "groupes_finals")).withColumnRenamed("key", "id_groupe_total")


QUERIES = {"p5_found": p5_found, "p5_members": p5_members, "p5_lots": p5_lots}


def _vote(column: str) -> str:
    return f"""(SELECT id_groupe_total, {column}, {column}_n FROM (
        SELECT id_groupe_total, {column}, count(*) AS {column}_n, row_number() OVER (PARTITION BY id_groupe_total ORDER BY count(*) DESC, {column}) AS r
        FROM prenoms_grouped WHERE id_groupe_total IS NOT NULL AND trim({column}) <> '' GROUP BY id_groupe_total, {column}) WHERE r = 1)"""


SQL = {
    "p5_found": " UNION ALL ".join(
        f"SELECT '{t}' AS nom_table, id_groupe_total FROM {t} WHERE id_groupe_total IS NOT NULL GROUP BY id_groupe_total HAVING count(*) >= 4 AND count(*) >= 0.02 * (SELECT count(*) FROM {t})"
        for t in ("prenoms_grouped", "groupes_finals")
    ),
    "p5_members": "SELECT * FROM (SELECT id_groupe_total, count(*) AS n FROM prenoms_grouped WHERE id_groupe_total IS NOT NULL GROUP BY 1)"
    + "".join(f" LEFT JOIN {_vote(c)} USING (id_groupe_total)" for c in ("langue", "religion", "geo", "sexe")),
    "p5_lots": """
        SELECT id_groupe_total, count(*) AS n_rows, coalesce(sum(len(noms)), 0)::BIGINT AS n_named, count(DISTINCT lot) AS n_lots,
          (SELECT count(DISTINCT m) FROM (SELECT g2.id_groupe_total AS k, unnest(g2.noms) AS m FROM groupes_finals g2) WHERE k = g.id_groupe_total AND trim(m) <> '') AS n_members
        FROM groupes_finals g WHERE id_groupe_total IS NOT NULL GROUP BY id_groupe_total""",
}
