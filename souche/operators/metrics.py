"""Measures of groups and of generated text."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from souche.functions import text as T
from souche.session import cut, drop_cut


def pair_scores(pairs: DataFrame, truth: str, predicted: str) -> DataFrame:
    """(tp, fp, fn, tn, precision, recall, f1); empty denominators give 0."""
    t, p = F.col(truth), F.col(predicted)
    sums = pairs.agg(*(F.coalesce(F.sum(c.cast("int")), F.lit(0)).alias(n) for n, c in (("tp", t & p), ("fp", ~t & p), ("fn", t & ~p), ("tn", ~t & ~p))))
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))
    precision, recall = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return sums.select("*", precision.alias("precision"), recall.alias("recall"), F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0)).alias("f1"))


def consistency(df: DataFrame, group: str, label: str, least: float = 0.75) -> DataFrame:
    """(groups, consistent, share): groups of several members of which one label has at least ``least`` of the labelled ones."""
    sizes = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count("*").alias("n")).where("n > 1")
    votes = df.where(f"trim({label}) <> ''").groupBy(group, label).agg(F.count("*").alias("v")).groupBy(group).agg(F.max("v").alias("top"), F.sum("v").alias("all"))
    rows = sizes.join(votes, group, "left").withColumn("ok", F.coalesce(F.col("top") >= least * F.col("all"), F.lit(True)))
    return rows.agg(F.count("*").alias("groups"), F.coalesce(F.sum(F.col("ok").cast("int")), F.lit(0)).alias("consistent"), F.round(F.coalesce(F.avg(F.col("ok").cast("int")), F.lit(1.0)), 6).alias("share"))


def flesch_fr(col: Column) -> Column:
    """207 - 1.015 words a sentence - 73.6 vowels a word; NULL under three words."""
    words = F.regexp_count(col, F.lit(r"[\p{L}\p{N}\p{M}_]+"))
    sentences = F.greatest(F.lit(1), F.size(F.filter(F.split(col, r"[.!?]+"), lambda s: F.trim(s) != "")))
    vowels = F.regexp_count(F.lower(col), F.lit("[aeiouyàâäéèêëîïôöùûü]"))
    return F.when(words >= 3, 207 - 1.015 * (words / sentences) - 73.6 * (vowels / words))


def well_formed(col: Column) -> Column:
    return F.trim(col).rlike(r"(?s)^\p{Lu}.*[.!?]$")


def repeated_trigrams(df: DataFrame, key: str, body: str, least: int = 3) -> DataFrame:
    """(key, share): distinct trigrams of lower-cased words seen ``least`` times, over all trigrams; 0 under three words."""
    w = F.split(T.squeeze(F.lower(F.col(body))), " ")
    rows = df.where(F.col(body).isNotNull()).select(F.col(key).alias("k"), w.alias("w"))
    counts = rows.select("k", F.explode_outer(T.ngrams(F.col("w"), 3)).alias("g")).groupBy("k", "g").agg(F.count("g").alias("c"))
    per = counts.groupBy("k").agg(F.sum((F.col("c") >= least).cast("int")).alias("hit"), F.sum("c").alias("all"))
    return per.select(F.col("k").alias(key), F.coalesce(F.try_divide(F.col("hit").cast("double"), F.col("all")), F.lit(0.0)).alias("share"))


def type_token(words: Column) -> Column:
    return F.try_divide(F.size(F.array_distinct(words)).cast("double"), F.size(words))


def rouge_recall(pairs: DataFrame, key: str, source: str, other: str, n: int = 1) -> DataFrame:
    """(key, recall): clipped n-gram overlap over the source's n-grams."""
    def grams(col: str) -> DataFrame:
        return pairs.select(key, F.explode(T.ngrams(T.words(F.col(col)), n)).alias("gram")).groupBy(key, "gram").agg(F.count("*").alias("c"))

    a, b = grams(source), grams(other).withColumnRenamed("c", "d")
    both = a.join(b, [key, "gram"], "left").groupBy(key).agg(F.sum("c").alias("all"), F.sum(F.least("c", F.coalesce("d", F.lit(0)))).alias("hit"))
    return both.select(key, (F.col("hit") / F.col("all")).alias("recall"))


def common_subsequence(x: list[str], y: list[str]) -> int:
    """Length of the longest common subsequence; rows of the table are the bits of one integer."""
    places: dict[str, int] = {}
    for i, w in enumerate(x):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(x)) - 1
    row = full
    for w in y:
        hit = row & places.get(w, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(x) - row.bit_count()


@F.pandas_udf(DoubleType())
def rouge_l(a: pd.Series, b: pd.Series) -> pd.Series:
    """Longest common subsequence of words over the source's words."""
    words = ((T.words_py(x), T.words_py(y)) for x, y in zip(a, b))
    return pd.Series([common_subsequence(x, y) / len(x) if x else float("nan") for x, y in words], dtype=float)


PERCENTILES = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9}


def describe(df: DataFrame, value: str) -> DataFrame:
    """(n, mean, std, min, p10, p25, p50, p75, p90, max): exact linear percentiles.

    Values are sorted in ranges; the few ranks wanted are looked up in the ranges that hold them, so no task sees all values.
    """
    r = lambda c: F.round(c, 6)
    v = F.col(value).cast("double")
    whole = df.agg(F.count(v).alias("n"), r(F.avg(v)).alias("mean"), r(F.stddev_samp(v)).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"))
    rows = cut(df.where(v.isNotNull()).select(v.alias("v")).repartitionByRange("v").withColumn("part", F.spark_partition_id()), "values")
    sizes = {x.part: x.n for x in rows.groupBy("part").agg(F.count("*").alias("n")).collect()}  # one row a partition
    n, before, starts = sum(sizes.values()), 0, {}
    for part in sorted(sizes):
        starts[part], before = before, before + sizes[part]
    ranks = sorted({rank for p in PERCENTILES.values() for rank in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))}) if n else []
    home = {rank: max(p for p, start in starts.items() if start <= rank and sizes[p]) for rank in ranks}
    found = {}
    for part in sorted(set(home.values())):
        at = F.row_number().over(Window.partitionBy("part").orderBy("v")) - 1 + F.lit(starts[part])
        here = [rank for rank in ranks if home[rank] == part]
        found |= {x["rank"]: x.v for x in rows.where(F.col("part") == part).select("v", at.alias("rank")).where(F.col("rank").isin(here)).collect()}
    drop_cut(rows)

    def percentile(p: float) -> float | None:
        if not n:
            return None
        low, high = math.floor(p * (n - 1)), math.ceil(p * (n - 1))
        return found[low] + (found[high] - found[low]) * (p * (n - 1) - low)

    points = (r(F.lit(percentile(p)).cast("double")).alias(name) for name, p in PERCENTILES.items())
    return whole.select("n", "mean", "std", "min", *points, "max")


def histogram10(df: DataFrame, value: str) -> DataFrame:
    """(bin, n): ten equal bins on [0, 1], the last one closed; other values dropped."""
    v = F.col(value)
    return df.where(v.between(0, 1)).groupBy(F.least(F.floor(v * 10), F.lit(9)).cast("int").alias("bin")).agg(F.count("*").alias("n"))


def binned(df: DataFrame, value: str, bins: list[tuple[str, int]], rest: str) -> DataFrame:
    """(bin, n): right-closed bins by their upper bounds, all labels present."""
    v = F.col(value)
    label = F.coalesce(*(F.when(v <= top, name) for name, top in bins), F.lit(rest))
    counts = df.groupBy(label.alias("bin")).agg(F.count("*").alias("n"))
    every = df.sparkSession.createDataFrame([(n,) for n, _ in bins] + [(rest,)], "bin string")
    return every.join(counts, "bin", "left").na.fill(0, ["n"])


def coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """(field, filled, pct): how many rows have something in each column."""
    row = df.agg(F.count("*").alias("__all"), *(F.coalesce(F.sum(T.filled(F.col(c)).cast("int")), F.lit(0)).alias(c) for c in columns))
    long = row.unpivot(["__all"], columns, "field", "filled")
    return long.select("field", "filled", F.round(F.coalesce(F.try_divide(F.col("filled") * 100.0, F.col("__all")), F.lit(0.0)), 6).alias("pct"))


def extremes(df: DataFrame, name: str, order: str) -> DataFrame:
    """(shortest, longest): first in ``order`` on ties."""
    n = F.length(name)
    return df.agg(F.min_by(name, F.struct(n, F.col(order))).alias("shortest"), F.min_by(name, F.struct(-n, F.col(order))).alias("longest"))


def sample_pairs(df: DataFrame, key: str, group: str, n: int, seed: int = 7) -> DataFrame:
    """(a, b, same): n / 2 pairs within groups (one a group at most) and n / 2 across, by seeded hash."""
    rows = df.where(F.col(group).isNotNull()).select(F.col(key).alias("k"), F.col(group).alias("g")).distinct().withColumn("h", F.xxhash64("k", F.lit(seed)))
    two = rows.groupBy("g").agg(F.min(F.struct("h", "k")).alias("a"), F.max(F.struct("h", "k")).alias("b")).where("a.k <> b.k")
    same = two.orderBy(F.xxhash64("g", F.lit(seed))).limit(n // 2).select(F.col("a.k").alias("a"), F.col("b.k").alias("b"), F.lit(True).alias("same"))
    # bounded by 20 n rows, as many tries as the pairs wanted are worth
    some = rows.orderBy("h", "k").limit(20 * n).withColumn("i", F.row_number().over(Window.orderBy("h", "k")))
    left, right = some.where("i % 2 = 1"), some.where("i % 2 = 0").withColumn("i", F.col("i") - 1)
    across = left.alias("x").join(right.alias("y"), "i").where("x.g <> y.g").orderBy("i").limit(n - n // 2).select(F.col("x.k").alias("a"), F.col("y.k").alias("b"), F.lit(False).alias("same"))
    return same.unionByName(across)


def report_samples(df: DataFrame, key: str, field: str, score: str, cap: int = 5, seed: int = 7) -> DataFrame:
    """(field, key, score, kind): three lowest, three highest and one seeded row per field, capped."""
    low = F.row_number().over(Window.partitionBy(field).orderBy(score, key))
    high = F.row_number().over(Window.partitionBy(field).orderBy(F.desc(score), key))
    rnd = F.row_number().over(Window.partitionBy(field).orderBy(F.xxhash64(F.col(key), F.lit(seed)), key))
    picked = df.withColumn("low", low).withColumn("high", high).withColumn("rnd", rnd).where("low <= 3 OR high <= 3 OR rnd = 1")
    kind = F.when(F.col("low") <= 3, "lowest").when(F.col("high") <= 3, "highest").otherwise("random")
    rank = F.row_number().over(Window.partitionBy(field).orderBy(F.when(kind == "lowest", 0).when(kind == "highest", 1).otherwise(2), "low"))
    return picked.withColumn("kind", kind).withColumn("r", rank).where(F.col("r") <= cap).select(field, key, score, "kind")


def long_texts(df: DataFrame, fields: list[str]) -> DataFrame:
    """(field, text, key): non-blank texts of the fields, key the hash a cache would hold them by."""
    pairs = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields)))
    return df.select(pairs.alias("x")).select("x.field", "x.text").where("trim(text) <> ''").withColumn("key", F.sha2("text", 256))


def cache_performance(df: DataFrame, fields: list[str], cache: DataFrame, seconds: float = 1.5) -> DataFrame:
    """(unique_texts, cached, hits, hit_pct, calls, avoided, hours_saved): what a cache (key) spares of one call a text."""
    keys = long_texts(df, fields).groupBy("key").agg(F.count("*").alias("n"))
    known = cache.select("key").distinct()
    entries = known.agg(F.count("*")).scalar()
    rows = keys.join(known.withColumn("hit", F.lit(True)), "key", "left")
    return rows.agg(
        F.count("*").alias("unique_texts"), F.lit(entries).alias("cached"), F.count("hit").alias("hits"), F.round(F.coalesce(F.try_divide(F.count("hit") * 100.0, F.count("*")), F.lit(0.0)), 1).alias("hit_pct"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("calls"), F.coalesce(F.sum(F.when(F.col("hit"), F.col("n"))), F.lit(0)).alias("avoided"),
        F.round(F.coalesce(F.sum(F.when(F.col("hit"), F.col("n"))), F.lit(0)) * seconds / 3600, 2).alias("hours_saved"),
    )


def field_lengths(df: DataFrame, fields: list[str], long: int = 1800) -> DataFrame:
    """(field, n, mean, max, pct_long): characters of the non-blank texts of each field, and how many are over ``long``."""
    size = F.length("text")
    return long_texts(df, fields).groupBy("field").agg(F.count("*").alias("n"), F.round(F.avg(size), 6).alias("mean"), F.max(size).alias("max"), F.round(F.avg((size > long).cast("int")) * 100, 6).alias("pct_long"))


def source_and_final(source: DataFrame, final: DataFrame, fields: list[str]) -> DataFrame:
    """(field, n_source, source_pct, n_final, final_pct): filled fields before and after, both over the source's rows."""
    total = source.agg(F.count("*")).scalar()
    a, b = (coverage(df, fields).select("field", F.col("filled").alias(name)) for df, name in ((source, "n_source"), (final, "n_final")))
    pct = lambda c: F.round(F.coalesce(F.try_divide(F.col(c) * 100.0, total), F.lit(0.0)), 1)
    return a.join(b, "field").select("field", "n_source", pct("n_source").alias("source_pct"), "n_final", pct("n_final").alias("final_pct"))
