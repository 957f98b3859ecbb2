"""Birth statistics per first name: cleaning, enrichment, yearly series, peaks, best departments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souche.functions import text as T

MIN_COUNT = 3
TOP_DEPARTMENTS = 5
DEPARTMENT_LEVELS = ("DEP", "DEPARTEMENT", "D")


def department_rows(df: DataFrame, level: str) -> DataFrame:
    """Rows of department level, or all rows if there is none of that level."""
    is_dep = F.upper(F.col(level)).isin(*DEPARTMENT_LEVELS)
    none = df.agg(F.coalesce(F.max(is_dep.cast("int")), F.lit(0))).scalar()
    return df.where(F.coalesce(is_dep, F.lit(False)) | (none == 0))


def clean_measures(df: DataFrame) -> DataFrame:
    """(prenom, annee, dept, count, id_groupe_total): usable measures, names and departments normalised.

    A measure loaded again with the same count is the same measure, whenever it came; another count is another measure.
    """
    rows = df.where(f"annee IS NOT NULL AND count >= {MIN_COUNT} AND prenom IS NOT NULL AND NOT startswith(prenom, '_')")
    rows = rows.select(T.first_name_key(F.col("prenom")).alias("prenom"), "annee", T.pad_department(F.col("dept")).alias("dept"), "count", "id_groupe_total")
    # a repeated or late load repeats a measure: equal rows fold map-side
    return rows.distinct()


def national_series(measures: DataFrame) -> DataFrame:
    return measures.groupBy("prenom", "annee").agg(F.sum("count").alias("births"))


def department_series(measures: DataFrame) -> DataFrame:
    return measures.where("dept IS NOT NULL").groupBy("prenom", "dept", "annee").agg(F.sum("count").alias("births"))


def peak(year: Column, births: Column) -> Column:
    """Earliest year of the most births."""
    return F.max_by(year, F.struct(births, -year))


def top_departments(measures: DataFrame, k: int = TOP_DEPARTMENTS) -> DataFrame:
    """(prenom, dept, births, rank): the k departments of most births, ties to the smaller code."""
    totals = measures.where("dept IS NOT NULL").groupBy("prenom", "dept").agg(F.sum("count").alias("births"))
    rank = F.row_number().over(Window.partitionBy("prenom").orderBy(F.desc("births"), "dept"))
    return totals.withColumn("rank", rank).where(F.col("rank") <= k)


def trends(measures: DataFrame, k: int = TOP_DEPARTMENTS) -> DataFrame:
    """One row per first name: total, peak year, first and last year, best departments in order."""
    series = national_series(measures)
    whole = series.groupBy("prenom").agg(
        F.sum("births").alias("total"), peak(F.col("annee"), F.col("births")).alias("pic_annee"), F.min("annee").alias("first_year"), F.max("annee").alias("last_year"),
    )
    best = top_departments(measures, k).groupBy("prenom").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "dept"))), lambda x: x["dept"]), ",").alias("top_depts"))
    return whole.join(best, "prenom", "left")


def nested_trends(measures: DataFrame, k: int = TOP_DEPARTMENTS) -> DataFrame:
    """National series as an array of structs, and a map of the best departments' series."""
    national = national_series(measures).groupBy("prenom").agg(F.array_sort(F.collect_list(F.struct("annee", F.col("births").alias("count")))).alias("national"))
    best = top_departments(measures, k).select("prenom", "dept")
    per = department_series(measures).join(best, ["prenom", "dept"]).groupBy("prenom", "dept").agg(F.array_sort(F.collect_list(F.struct("annee", F.col("births").alias("count")))).alias("series"))
    maps = per.groupBy("prenom").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("dept", "series")))).alias("par_dept"))
    return national.join(maps, "prenom", "left")


def enrich(measures: DataFrame, names: DataFrame) -> DataFrame:
    """Measures with the group of their first name; names without a record are dropped."""
    return measures.join(names.select("prenom", F.col("id_groupe_total").alias("groupe")), "prenom")


def coverage(measures: DataFrame, names: DataFrame) -> DataFrame:
    """(rows, matched, names, names_matched): how much of the statistics finds its record."""
    known = names.select("prenom", F.lit(True).alias("known"))
    per = measures.groupBy("prenom").agg(F.count("*").alias("n")).join(known, "prenom", "left")
    return per.agg(
        F.sum("n").alias("rows"), F.sum(F.when(F.col("known"), F.col("n")).otherwise(0)).alias("matched"),
        F.count("*").alias("names"), F.count("known").alias("names_matched"),
    )


def choropleth(measures: DataFrame, first: int, last: int) -> DataFrame:
    """(dept, births, share_of_max, colour): births per department in a span of years, in five classes."""
    totals = measures.where(F.col("annee").between(first, last) & F.col("dept").isNotNull()).groupBy("dept").agg(F.sum("count").alias("births"))
    most = totals.agg(F.greatest(F.max("births"), F.lit(1))).scalar()
    ratio = F.col("births") / most
    colour = F.when(ratio > 0.8, 5).when(ratio > 0.5, 4).when(ratio > 0.2, 3).when(ratio > 0.05, 2).otherwise(1)
    return totals.select("dept", "births", F.round(ratio, 6).alias("share_of_max"), colour.alias("colour"))


def decade_total(df: DataFrame, columns: list[str]) -> DataFrame:
    """Wide decade columns to a total and a map, nulls as 0."""
    filled = [F.coalesce(F.col(c), F.lit(0)) for c in columns]
    return df.withColumn("nombre_total", sum(filled[1:], filled[0])).withColumn("historique", F.map_from_arrays(F.array(*(F.lit(c.lstrip("_")) for c in columns)), F.array(*filled)))


def decade_values(history: Column, labels: list[str]) -> Column:
    """Values of the labelled decades in order, 0 where there is none."""
    return F.transform(F.array(*(F.lit(x) for x in labels)), lambda x: F.coalesce(F.try_element_at(history, x), F.lit(0)))


def with_decades(names: DataFrame, key: str, decades: DataFrame) -> DataFrame:
    """All names with their decades (key, nombre_total, historique), names without statistics with 0 and an empty map.

    Repeated keys of the statistics count once, the one of most births.
    """
    one = decades.groupBy(key).agg(F.max_by(F.struct("nombre_total", "historique"), "nombre_total").alias("x")).select(key, "x.*")
    kind = dict(decades.dtypes)["historique"]
    out = names.join(one, key, "left")
    return out.withColumn("nombre_total", F.coalesce("nombre_total", F.lit(0))).withColumn("historique", F.coalesce("historique", F.create_map().cast(kind)))


def decade_points(df: DataFrame, key: str) -> DataFrame:
    """(key, x, y): decades of a map by their last year, yearly mean."""
    rows = df.select(key, F.explode("historique").alias("decade", "n"))
    return rows.select(key, F.try_element_at(F.split("decade", "_"), F.lit(2)).try_cast("int").alias("x"), (F.col("n") / 10.0).alias("y")).where("x IS NOT NULL")
