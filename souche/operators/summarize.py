"""Summaries and rewriting: votes, central sentences, packing, cached rewriting with a gate."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souche.functions import text as T
from souche.operators import tfidf
from souche.session import cut, drop_cut

SENTENCES = 4
SAME = 0.90
SALTS = 16
BLOCK_TOKENS = 480
TOO_CLOSE = 0.97


def first_seen_vote(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """(key, value, votes): most frequent non-blank value, ties to the one seen first in ``order``."""
    counts = df.where(f"{key} IS NOT NULL AND trim({value}) <> ''").groupBy(key, value).agg(F.count("*").alias("votes"), F.min(order).alias("first"))
    best = counts.groupBy(key).agg(F.min_by(F.struct(value, "votes"), F.struct((-F.col("votes")).alias("m"), "first", value)).alias("b"))
    return best.select(key, f"b.{value}", "b.votes")


def date_vote(df: DataFrame, key: str, order: str) -> DataFrame:
    """(key, label, valeur, votes): most frequent date label, with the value first seen beside it."""
    rows = df.where(f"{key} IS NOT NULL AND date.label <> ''").select(key, order, F.col("date.label").alias("label"), F.col("date.valeur").alias("valeur"))
    counts = rows.groupBy(key, "label").agg(F.count("*").alias("votes"), F.min(order).alias("first"), F.min_by("valeur", F.struct(order, F.coalesce("valeur", F.lit(9999)))).alias("valeur"))
    best = counts.groupBy(key).agg(F.min_by(F.struct("label", "valeur", "votes"), F.struct((-F.col("votes")).alias("m"), "first", "label")).alias("b"))
    return best.select(key, "b.label", "b.valeur", "b.votes")


def summaries(texts: DataFrame, group: str, body: str, order: str, k: int = SENTENCES) -> DataFrame:
    """(group, resume): the k sentences nearest the group's centre, no two nearly alike, in their order.

    A group of one text keeps its first k sentences. Of several texts, equal sentences count once; k times the best
    sentence left (ties to the later one) is kept and all nearly like it are dropped, so the list is refilled until k stand or
    none is left. Each round compares one kept sentence a group with the others by their terms, in long form and
    salted: no task holds a group, however large. Groups without a sentence of 25 characters give
    the first 500 characters of their text, or the first 400 of their first three.
    """
    one = texts.where(f"{group} IS NOT NULL AND trim({body}) <> ''").select(F.col(group).alias("g"), F.col(order).alias("o"), F.col(body).alias("t"))
    one = cut(one.groupBy("g", "t").agg(F.min("o").alias("o")), "texts")
    sizes = one.groupBy("g").agg(F.count("*").alias("texts"))
    alone = one.join(sizes.where("texts = 1").select("g"), "g", "left_semi").select("g", F.slice(T.sentences(F.col("t")), 1, k).alias("kept"), "t")
    single = alone.select("g", F.when(F.size("kept") > 0, F.array_join("kept", " ")).otherwise(F.substring("t", 1, 500)).alias("resume"))
    several = one.join(sizes.where("texts > 1").select("g"), "g", "left_semi")
    rows = several.select("g", "o", F.posexplode(T.sentences(F.col("t"))).alias("at", "s"))
    rows = cut(rows.groupBy("g", "s").agg(F.min(F.struct("o", "at")).alias("place")).withColumn("doc", F.md5(F.concat(F.col("g").cast("string"), F.lit("|"), "s"))), "sentences")
    weighted = tfidf.weights(tfidf.word_terms(rows, "doc", "s"), rows)
    salt = F.pmod(F.xxhash64("doc"), F.lit(SALTS)).cast("int")
    named = cut(weighted.join(rows.select("doc", "g"), "doc").withColumn("salt", salt), "terms")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    centre = named.groupBy("g", "term").agg(F.sum("weight").alias("c")).select("g", "term", "c", salts)
    scores = named.join(centre, ["g", "term", "salt"]).groupBy("doc").agg(F.round(F.sum(F.col("weight") * F.col("c")), 9).alias("score"))
    left = cut(rows.select("g", "doc", "place").join(scores, "doc", "left").na.fill(0.0, ["score"]), "left")
    kept = None
    for at in range(k):
        best = cut(left.groupBy("g").agg(F.max(F.struct("score", "place", "doc")).alias("b")).select("g", F.col("b.doc").alias("doc")), "kept")
        kept = best if kept is None else kept.unionByName(best)
        if at + 1 < k:
            own = named.drop("salt").join(best, ["g", "doc"]).select("g", "term", F.col("weight").alias("w"), salts)
            alike = named.join(own, ["g", "term", "salt"]).groupBy("doc").agg(F.sum(F.col("weight") * F.col("w")).alias("sim")).where(F.col("sim") >= SAME).select("doc")
            new = cut(left.join(alike.unionByName(best.select("doc")).distinct(), "doc", "left_anti"), "left")
            drop_cut(left)
            left = new
    shown = rows.join(kept.select("doc"), "doc", "left_semi").groupBy("g").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "s"))), lambda x: x["s"]), " ").alias("resume"))
    without = several.join(rows.select("g").distinct(), "g", "left_anti")
    third = F.row_number().over(Window.partitionBy("g").orderBy("o", "t"))
    short = without.withColumn("r", third).where("r <= 3").groupBy("g").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", F.substring("t", 1, 400).alias("t")))), lambda x: x["t"]), " ").alias("resume"))
    return single.unionByName(shown).unionByName(short).select(F.col("g").alias(group), T.display_text(F.col("resume")).alias("resume"))


def packed_blocks(body: Column, most: int = BLOCK_TOKENS) -> Column:
    """Sentences packed in order into blocks of at most ``most`` words; a sentence is never cut."""
    parts = F.filter(F.split(F.trim(body), r"(?<=[.!?])\s+"), lambda s: F.trim(s) != "")
    empty = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"), F.lit(0).alias("n"))

    def add(acc, s):
        size = T.token_count(s)
        fits = acc["n"] + size <= most
        return F.when((acc["n"] == 0) | fits, F.struct(acc["done"].alias("done"), F.trim(F.concat(acc["open"], F.lit(" "), s)).alias("open"), (acc["n"] + size).alias("n"))).otherwise(
            F.struct(F.concat(acc["done"], F.array(acc["open"])).alias("done"), s.alias("open"), size.alias("n"))
        )

    return F.aggregate(parts, empty, add, lambda acc: F.when(acc["n"] > 0, F.concat(acc["done"], F.array(acc["open"]))).otherwise(acc["done"]))


def cache_misses(texts: DataFrame, body: str, cache: DataFrame) -> DataFrame:
    """(key, text): distinct texts whose hash is not in the cache (key, value)."""
    wanted = texts.where(f"trim({body}) <> ''").select(F.sha2(body, 256).alias("key"), F.col(body).alias("text")).groupBy("key").agg(F.first("text").alias("text"))
    return wanted.join(cache.select("key"), "key", "left_anti")


def rewrite(texts: DataFrame, key: str, body: str, cache: DataFrame, model: Callable[[Column], Column] | None = None, too_close: float = TOO_CLOSE) -> DataFrame:
    """(key, source, value, source_used): cached or fresh rewriting, or the cleaned source where there is none.

    ``model`` maps a text column to a text column (a pandas UDF around any model); without one
    the cleaned source stands. A rewriting too close to the source (cosine of TF-IDF) is refused.
    """
    rows = texts.where(f"trim({body}) <> ''").select(F.col(key).alias("key"), F.col(body).alias("source"), F.sha2(body, 256).alias("h"))
    known = cache.select(F.col("key").alias("h"), F.col("value").alias("value"))
    if model is not None:
        fresh = cache_misses(texts, body, cache).select(F.col("key").alias("h"), model(F.col("text")).alias("value"))
        known = known.unionByName(fresh)
    joined = cut(rows.join(known, "h", "left").withColumn("clean", T.display_text(F.col("source"))), "rewritten")
    # both sides in one space, by TF-IDF over all of them; a distinct (source, value) is measured once
    pairs = joined.where("trim(value) <> ''").select("source", "value").distinct()
    sides = pairs.select(F.md5("source").alias("doc"), F.col("source").alias("t")).unionByName(pairs.select(F.md5("value").alias("doc"), F.col("value").alias("t"))).dropDuplicates(["doc"])
    weighted = tfidf.weights(tfidf.word_terms(sides, "doc", "t", bigrams=False), sides, 1, 1.0, False)
    near = tfidf.pair_cosine(pairs.select(F.md5("source").alias("a"), F.md5("value").alias("b")), weighted)
    joined = joined.withColumn("a", F.md5("source")).withColumn("b", F.md5("value")).join(near, ["a", "b"], "left")
    refused = F.col("value").isNull() | (F.trim("value") == "") | (F.round(F.coalesce("cosine", F.lit(0.0)), 9) > too_close)
    return joined.select("key", "source", F.when(refused, F.col("clean")).otherwise(F.col("value")).alias("value"), refused.alias("source_used"))
