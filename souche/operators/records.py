"""First-name records from raw texts, and whole sheets: record, place, date, trend and related names in one answer."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souche.config import Preparation
from souche.functions import extract as X
from souche.functions import text as T
from souche.operators import serve
from souche.session import cut

_NO_NAMES = "array<string>"


def text_groups(rows: DataFrame, key: str, body: str, order: str, tied: str = "grp_", alone: str = "solo_") -> DataFrame:
    """``rows`` with id_groupe: records of one exact text share the group of the first of them in ``order``.

    Records without text stand alone. Texts travel as hashes; the first of a text is a partial aggregate, and
    only texts of several records are joined back, each its own row, so a text held by a third of all is split by AQE like any skewed join.
    """
    group = lambda prefix, name: F.substring(F.md5(F.concat(F.lit(prefix), name)), 1, 8)
    own = rows.withColumn("__t", F.when(F.col(body) != "", F.md5(body)))
    first = own.where("__t IS NOT NULL").groupBy("__t").agg(F.min_by(key, order).alias("__first"), F.count("*").alias("__n")).where("__n > 1").drop("__n")
    name = F.when(F.col("__t").isNull(), group(alone, F.col(key))).otherwise(group(tied, F.coalesce("__first", key)))
    return own.join(first, "__t", "left").withColumn("id_groupe", name).drop("__t", "__first")


def first_name_links(name: Column, body: Column, most: int) -> Column:
    """Names tied to a first name by its text: labelled lists, then enumerations, then close spellings; itself left out, normalised."""
    found = F.concat(X.labelled_names(body, True), X.enumerated(body), X.close_names(name, body, True))
    keys = F.array_distinct(F.filter(F.transform(found, lambda x: T.linked_name(x, True)), lambda x: x != ""))
    return F.slice(F.array_except(keys, F.array(T.first_name_key(name))), 1, most)


def discovered(rows: DataFrame, key: str, links: str, inherited: list[str], order: str) -> DataFrame:
    """(key, links, <inherited>): cited names without a record, from the first record in ``order`` that cites each.

    A new name takes over the ``inherited`` columns of its discoverer and links back to it.
    """
    cited = rows.select(F.col(order).alias("__o"), F.col(key).alias("__by"), *inherited, F.posexplode(links).alias("__at", "__name")).where("__name <> ''")
    new = cited.join(rows.select(F.col(key).alias("__name")).distinct(), "__name", "left_anti")
    best = new.groupBy("__name").agg(F.min(F.struct("__o", "__at")).alias("__x"))
    found = new.join(best, "__name").where((F.col("__o") == F.col("__x.__o")) & (F.col("__at") == F.col("__x.__at")))
    return found.select(F.col("__name").alias(key), F.array("__by").alias(links), *inherited).dropDuplicates([key])


def resolved(rows: DataFrame, key: str, links: str, out: str) -> DataFrame:
    """``rows`` with the ids of the linked names in order, unknown ones left out."""
    known = rows.select(F.col(key).alias("__name"), F.col("id").alias("__other")).distinct()
    ids = rows.select(F.col("id"), F.posexplode(links).alias("__at", "__name")).join(known, "__name")
    packed = ids.groupBy("id").agg(F.transform(F.array_sort(F.collect_set(F.struct("__at", "__other"))), lambda x: x["__other"]).alias(out))
    return rows.join(packed, "id", "left").withColumn(out, F.coalesce(out, F.array().cast(_NO_NAMES)))


def prepare_first_names(raw: DataFrame, order: str, cfg: Preparation = Preparation()) -> DataFrame:
    """Clean first-name records of raw ones (prenom, sexe, url, signification, histoire, etymologie, provenance, ``order``), one row a name.

    Labels and date are drawn from all fields, links from all but the meaning; records of one text share a group; cited names
    without a record are added with what they inherit; links are resolved to ids. Nulls and blanks are absent; of copies of a name the first in ``order`` counts.
    """
    key = T.first_name_key(F.col("prenom"))
    one = raw.withColumn("__k", key).withColumn("__order", F.col(order)).where("__k <> ''")
    one = one.withColumn("__r", F.row_number().over(Window.partitionBy("__k").orderBy("__order"))).where("__r = 1")
    whole = T.joined_text(*(F.col(c) for c in ("signification", "histoire", "etymologie", "provenance")))
    cited = T.joined_text(*(F.col(c) for c in ("histoire", "etymologie", "provenance")))
    fields = one.select("__order", F.col("__k").alias("prenom"), "sexe", "url", "signification", "histoire", "etymologie", "provenance", T.embedding_text(F.col("histoire"), F.col("provenance"), F.col("etymologie")).alias("texte_brut"), whole.alias("__all"), cited.alias("__cited"))
    fields = cut(fields, "raw_names")  # read by many expressions, computed once
    rows = fields.select(
        "__order", T.stable_id(F.col("prenom")).alias("id"), "prenom", T.display_name(F.col("prenom")).alias("prenom_original"), "sexe", "url", "signification", "histoire", "etymologie", "provenance", "texte_brut",
        X.first_label(F.col("__all"), X.LANGUAGES).alias("langue"), X.first_label(F.col("__all"), X.RELIGIONS).alias("religion"), X.first_label(F.col("__all"), X.PLACES).alias("geo"), X.date_struct(F.col("__all")).alias("date"),
        first_name_links(F.col("prenom"), F.col("__cited"), cfg.most_links).alias("prenoms_lies"),
    )
    rows = cut(text_groups(rows, "prenom", "texte_brut", "__order"), "first_names")
    new = discovered(rows, "prenom", "prenoms_lies", ["texte_brut", "langue", "religion", "geo", "date", "id_groupe"], "__order")
    new = new.select("*", T.stable_id(F.col("prenom")).alias("id"), T.display_name(F.col("prenom")).alias("prenom_original"), F.lit("").alias("sexe"), F.lit("").alias("url"))
    both = cut(rows.drop("__order").unionByName(new, allowMissingColumns=True), "first_names")
    return resolved(both, "prenom", "prenoms_lies", "id_prenoms_lies")


def with_new_surnames(rows: DataFrame, order: str = "nom") -> DataFrame:
    """Prepared surnames (id, nom, nom_original, origine, noms_lies) with groups, the names they cite added, and links as ids."""
    grouped = cut(text_groups(rows, "nom", "origine", order, "groupe_"), "surnames")
    new = discovered(grouped, "nom", "noms_lies", ["origine", "id_groupe"], order)
    new = new.select("*", T.stable_id(F.col("nom")).alias("id"), T.display_name(F.col("nom")).alias("nom_original"))
    return resolved(cut(grouped.unionByName(new, allowMissingColumns=True), "surnames"), "nom", "noms_lies", "id_noms_lies")


def located(rows: DataFrame, geo: str) -> DataFrame:
    """``rows`` with lat and lng of their place label, null where it has none."""
    coords = rows.sparkSession.createDataFrame([(k, *v) for k, v in serve.PLACES.items()], "__g string, lat double, lng double")
    return rows.join(F.broadcast(coords), F.lower(F.trim(geo)) == F.col("__g"), "left").drop("__g")


def first_name_sheet(names: DataFrame, trends: DataFrame, q: str, cap: int = 12) -> DataFrame:
    """One row for a first name: its record, place on the map, date on the line, trend and related names; none if it is unknown."""
    one = serve.record(names, "prenom", q)
    related = F.slice(F.filter(F.coalesce("prenoms_groupe", F.array().cast(_NO_NAMES)), lambda x: (x != F.col("prenom")) & (F.trim(x) != "")), 1, cap)
    rows = located(one.select("id", "prenom", "langue", "geo", F.col("date.label").alias("date"), serve.marker(F.col("date.valeur")).alias("marker"), F.array_join(related, ",").alias("related")), "geo")
    return rows.join(trends.where(F.col("prenom") == q.strip().lower()), "prenom", "left")


def surname_sheet(names: DataFrame, groups: DataFrame, q: str, cap: int = 12) -> DataFrame:
    """One row for a surname: its record, date, and of its first group the labels, place and members; none if it is unknown."""
    date = X.date_struct(F.col("origine_brute"))
    one = serve.record(names, "nom", q).select("id", "nom", "nom_original", date["label"].alias("date"), serve.marker(date["valeur"]).alias("marker"))
    mine = groups.where(F.array_contains("noms", q.strip().lower())).orderBy("id_groupe_total", "lot").limit(1)
    related = F.slice(F.filter("noms", lambda x: (x != q.strip().lower()) & (F.trim(x) != "")), 1, cap)
    mine = mine.select(F.lit(q.strip().lower()).alias("nom"), "id_groupe_total", "langue", "geo", F.array_join(related, ",").alias("related"))
    return located(one.join(mine, "nom", "left"), "geo")


def compared(series: DataFrame, a: str, b: str) -> DataFrame:
    """(annee, births_a, births_b): two names year by year, 0 where one has none."""
    rows = series.where(F.col("prenom").isin(a, b))
    births = lambda n: F.coalesce(F.sum(F.when(F.col("prenom") == n, F.col("births"))), F.lit(0))
    return rows.groupBy("annee").agg(births(a).alias("births_a"), births(b).alias("births_b"))


def run_steps(steps: list[tuple[str, Callable[[], DataFrame]]], path: str) -> list[tuple[str, str, float]]:
    """Run steps in order, each written below ``path``; the first that fails ends the run. (step, state, seconds) of those begun."""
    done = []
    for name, step in steps:
        began = time.time()
        try:
            step().write.mode("overwrite").parquet(f"{path}/{name}")
            state = "ok"
        except Exception as error:  # a failed step is a result, not a crash
            state = f"failed: {type(error).__name__}"
        done.append((name, state, round(time.time() - began, 3)))
        if state != "ok":
            break
    return done
