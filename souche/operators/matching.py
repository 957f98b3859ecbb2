"""Spelling relatives and explicit links: blocked pairs, bounded edits, Jaro-Winkler, top-k, hubs."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from souche.functions import extract as X
from souche.functions import text as T
from souche.operators import spelling

JW_LEAST = 0.75
JW_TOP = 40
MOST_CITED = 8
GENERIC_TEXT = 20
RADICAL_NAMES = 5


def jaro_winkler_py(a: str, b: str) -> float:
    """Jaro similarity, raised by up to four common first letters when it is over 0.7."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    free = [True] * len(b)
    left = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if free[j] and b[j] == c:
                free[j] = False
                left.append(c)
                break
    if not left:
        return 0.0
    right = [c for c, f in zip(b, free) if not f]
    m, swaps = len(left), sum(x != y for x, y in zip(left, right)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    if jaro <= 0.7:
        return jaro
    prefix = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        prefix += 1
    return jaro + 0.1 * prefix * (1 - jaro)


def jaro_winkler_rows(a: list[str], b: list[str]) -> np.ndarray:
    """``jaro_winkler_py`` of many pairs at once: letters as codes in a matrix, one step per letter of the longest name."""
    la, lb = (np.array([len(x) for x in side]) for side in (a, b))
    wide = max(int(la.max(initial=0)), int(lb.max(initial=0)), 1)
    x, y = (np.array(side, dtype=f"U{wide}").view(np.uint32).reshape(len(side), wide) for side in (a, b))
    at = np.arange(wide)
    reach = np.maximum(np.maximum(la, lb) // 2 - 1, 0)[:, None]
    free = at[None, :] < lb[:, None]
    left = np.zeros(x.shape, bool)
    for i in range(int(la.max(initial=0))):
        near = free & (y == x[:, i : i + 1]) & (np.abs(at[None, :] - i) <= reach) & (i < la)[:, None]
        hit = near.any(1)
        left[:, i] = hit
        free[hit, near.argmax(1)[hit]] = False
    right = (at[None, :] < lb[:, None]) & ~free
    m = left.sum(1)
    # matched letters of both sides, in order, in front
    first, second = (np.take_along_axis(side, np.argsort(~held, axis=1, kind="stable"), 1) for side, held in ((x, left), (y, right)))
    swaps = ((first != second) & (at[None, :] < m[:, None])).sum(1) // 2
    some = np.maximum(m, 1)
    jaro = np.where(m > 0, (m / np.maximum(la, 1) + m / np.maximum(lb, 1) + (m - swaps) / some) / 3, 0.0)
    same = (x[:, :4] == y[:, :4]) & (at[None, :4] < np.minimum(la, lb)[:, None])
    prefix = np.cumprod(same, axis=1).sum(1)
    out = np.where(jaro > 0.7, jaro + 0.1 * prefix * (1 - jaro), jaro)
    return np.where([p == q for p, q in zip(a, b)], 1.0, out)


@F.pandas_udf(DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    out = np.full(len(a), np.nan)
    known = np.flatnonzero(a.notna().to_numpy() & b.notna().to_numpy())
    x, y = a.to_numpy()[known].tolist(), b.to_numpy()[known].tolist()
    # letters that numpy would take for padding, and names too long for a matrix, go one by one
    odd = np.array([len(p) > 256 or len(q) > 256 or p.endswith("\0") or q.endswith("\0") for p, q in zip(x, y)], bool)
    out[known[odd]] = [jaro_winkler_py(x[i], y[i]) for i in np.flatnonzero(odd)]
    plain = np.flatnonzero(~odd)
    for part in (plain[i : i + 8192] for i in range(0, len(plain), 8192)):
        out[known[part]] = jaro_winkler_rows([x[i] for i in part], [y[i] for i in part])
    return pd.Series(out)


def prefix_pairs(names: DataFrame, name: str, prefix: int = 2, least: float = JW_LEAST) -> DataFrame:
    """(a, b), a < b: distinct names that share their first letters and could be ``least`` similar.

    The bound drops pairs in the JVM before any Python: the matches of a pair are at most its
    common letters, and the similarity at most what that many matches in order give.
    """
    one = names.select(F.col(name).alias("a")).where(F.length("a") >= prefix).distinct().withColumn("block", F.substring("a", 1, prefix))
    other = one.select(F.col("a").alias("b"), "block")
    pairs = one.join(other, "block").where("a < b")
    short, long = F.least(F.length("a"), F.length("b")), F.greatest(F.length("a"), F.length("b"))
    jaro = (1 + short / long + 1) / 3
    return pairs.where(jaro + 0.4 * (1 - jaro) >= least).select("a", "b")


def jw_scored(names: DataFrame, name: str, prefix: int = 2, least: float = JW_LEAST) -> DataFrame:
    """(a, b, sim) of all ``prefix_pairs`` that are ``least`` similar; compared in tiles, so only these become rows."""
    return spelling.near(names.select(name).distinct(), name, prefix, least)


def jw_topk(scored: DataFrame, k: int = JW_TOP) -> DataFrame:
    """(a, b, sim): pairs among the k best of either of their names."""
    ways = scored.select("a", "b", "sim").unionByName(scored.select(F.col("b").alias("a"), F.col("a").alias("b"), "sim"))
    best = ways.withColumn("r", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("sim"), "b"))).where(F.col("r") <= k)
    return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "sim").distinct()


def unseen(pairs: DataFrame, cache: DataFrame) -> DataFrame:
    """Pairs not in the cache of known ones."""
    return pairs.join(cache.select("a", "b"), ["a", "b"], "left_anti")


def merged_cache(cache: DataFrame, pairs: DataFrame) -> DataFrame:
    ends = [df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")) for df in (cache, pairs)]
    return ends[0].unionByName(ends[1]).distinct()


def explicit_links(names: DataFrame, name: str, links: str, most_cited: int = MOST_CITED) -> DataFrame:
    """(a, b): names tied by a valid link to a known name that is not a hub."""
    cited = names.select(F.col(name).alias("source"), F.explode(links).alias("raw")).where(X.valid_link(F.col("raw")))
    cited = cited.select("source", T.first_name_key(F.col("raw")).alias("target")).where("source <> target").distinct()
    counts = cited.groupBy("target").agg(F.count("*").alias("n")).where(F.col("n") <= most_cited).select("target")
    known = names.select(F.col(name).alias("target")).distinct()
    kept = cited.join(counts, "target").join(known, "target", "left_semi")
    return kept.select(F.least("source", "target").alias("a"), F.greatest("source", "target").alias("b")).distinct()


def outside_links(names: DataFrame, name: str, links: str) -> DataFrame:
    """(inside, outside): links to known and to unknown names."""
    cited = names.select(F.explode(links).alias("raw")).where("trim(raw) <> ''").select(T.first_name_key(F.col("raw")).alias("target"))
    known = names.select(F.col(name).alias("target"), F.lit(1).alias("k")).distinct()
    per = cited.groupBy("target").agg(F.count("*").alias("n")).join(known, "target", "left")
    return per.agg(F.coalesce(F.sum(F.when(F.col("k") == 1, F.col("n"))), F.lit(0)).alias("inside"), F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("n"))), F.lit(0)).alias("outside"))


def generic_texts(df: DataFrame, key: str, body: str, more_than: int = GENERIC_TEXT) -> DataFrame:
    """(text_key, n): texts shared by more than so many records; only hashes travel."""
    return df.where(f"trim({body}) <> ''").select(F.md5(F.trim(body)).alias("text_key"), key).distinct().groupBy("text_key").agg(F.count("*").alias("n")).where(F.col("n") > more_than)


def blocked_radicals(names: DataFrame, name: str, least: int = RADICAL_NAMES) -> DataFrame:
    """(radical, n): first words (four letters at least) of compound names shared by several names."""
    first = F.split(F.col(name), " ")[0]
    compound = names.where(F.col(name).contains(" ")).select(first.alias("radical"), name).where("length(radical) >= 4").distinct()
    return compound.groupBy("radical").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def close_to(names: DataFrame, name: str, probe: str, k: int = 6) -> DataFrame:
    """First k names, in order, within the edits allowed for one given name."""
    key = T.fold_py(probe)
    limit = 1 if len(key) <= 4 else 2 if len(key) <= 7 else 3
    near = F.levenshtein(F.col(name), F.lit(key), limit)
    return names.select(name).distinct().where((near >= 0) & (F.col(name) != key)).orderBy(name).limit(k)


def composite(sim: Column, same_language: Column, same_place: Column) -> Column:
    return sim + F.when(same_language, 0.04).otherwise(0.0) + F.when(same_place, 0.02).otherwise(0.0)


def context_score(tfidf: Column, same_language: Column, same_place: Column) -> Column:
    return 0.5 * tfidf + F.when(same_language, 0.3).otherwise(0.0) + F.when(same_place, 0.2).otherwise(0.0)


def blended(spelling: Column, context: Column, shorter: Column) -> Column:
    """Spelling counts for more the longer the shorter name is."""
    t = F.least(shorter, F.lit(15)) / 15
    return t * spelling + (1 - t) * context


def passing(names: DataFrame, name: str, valid) -> DataFrame:
    """Distinct names that pass ``valid``: gated before they are paired, as a pair passes if both of its names do. An unknown answer passes."""
    return names.select(name).distinct().where(F.coalesce(valid(F.col(name)), F.lit(True)))


def gate(pairs: DataFrame, valid, a: str = "a", b: str = "b") -> DataFrame:
    """Pairs both of whose names pass ``valid`` (a Column predicate, or a scorer's UDF over a name)."""
    names = pairs.select(F.explode(F.array(a, b)).alias("name")).distinct()
    good = names.where(F.coalesce(valid(F.col("name")), F.lit(True))).select("name")
    return pairs.join(good.withColumnRenamed("name", a), a, "left_semi").join(good.withColumnRenamed("name", b), b, "left_semi")
