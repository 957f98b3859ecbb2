"""TF-IDF in long form: one row per document and term, unit length per document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souche.functions.text import fold, ngrams
from souche.session import cut_marked


def word_terms(df: DataFrame, key: str, body: str, bigrams: bool = True) -> DataFrame:
    """(doc, term, tf) of words of two letters or more, and their neighbours in pairs."""
    words = F.regexp_extract_all(F.lower(F.col(body)), F.lit(r"(?U)\b\w\w+\b"), 0)
    rows = df.select(F.col(key).alias("doc"), words.alias("w")).where(F.size("w") > 0)
    terms = F.concat("w", ngrams(F.col("w"), 2)) if bigrams else F.col("w")
    return rows.select("doc", F.explode(terms).alias("term")).groupBy("doc", "term").agg(F.count("*").alias("tf"))


def char_terms(df: DataFrame, key: str, body: str, sizes: tuple[int, ...] = (2, 3)) -> DataFrame:
    """(doc, term, tf) of runs of characters of the folded text."""
    rows = df.select(F.col(key).alias("doc"), fold(F.col(body)).alias("t"))
    parts = []
    for n in sizes:
        starts = rows.where(F.length("t") >= n).select("doc", "t", F.explode(F.sequence(F.lit(1), F.length("t") - n + 1)).alias("i"))
        parts.append(starts.select("doc", F.col("t").substr(F.col("i"), F.lit(n)).alias("term")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("doc", "term").agg(F.count("*").alias("tf"))


def weights(terms: DataFrame, documents: DataFrame, least_df: int = 2, most_df: float = 0.95, sublinear: bool = True) -> DataFrame:
    """(doc, term, weight): tf (or 1 + ln tf) times ln((1 + n) / (1 + df)) + 1, scaled to unit length.

    ``documents`` has one row per document, also those without terms: they count in n.
    """
    total = documents.agg(F.count("*")).scalar()
    df = terms.groupBy("term").agg(F.count("*").alias("df")).where((F.col("df") >= least_df) & (F.col("df") <= most_df * total))
    idf = df.select("term", (F.log((1 + total) / (1 + F.col("df"))) + 1).alias("idf"))
    tf = 1 + F.log(F.col("tf")) if sublinear else F.col("tf")
    raw = terms.join(idf, "term").select("doc", "term", (tf * F.col("idf")).alias("w"))
    norm = raw.groupBy("doc").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return raw.join(norm, "doc").select("doc", "term", (F.col("w") / F.col("norm")).alias("weight"))


def vectors(terms: DataFrame, documents: DataFrame, least_df: int = 2, most_df: float = 0.95, sublinear: bool = True, small: int = 1_000_000) -> DataFrame:
    """(doc, terms, weights): ``weights`` before scaling, a row per document, terms as numbers.

    A vocabulary of at most ``small`` terms is broadcast: where ``terms`` lie by document, none of its rows is shuffled then.
    """
    total = documents.agg(F.count("*")).scalar()
    df = terms.groupBy("term").agg(F.count("*").alias("df")).where((F.col("df") >= least_df) & (F.col("df") <= most_df * total))
    idf, seen = cut_marked(df.select("term", F.monotonically_increasing_id().alias("number"), (F.log((1 + total) / (1 + F.col("df"))) + 1).alias("idf")), "idf", F.count("*"))
    tf = 1 + F.log(F.col("tf")) if sublinear else F.col("tf")
    raw = terms.join(F.broadcast(idf) if seen[0] <= small else idf, "term").select("doc", F.struct("number", (tf * F.col("idf")).alias("w")).alias("x"))
    return raw.groupBy("doc").agg(F.collect_list("x").alias("x")).select("doc", F.col("x.number").alias("terms"), F.col("x.w").alias("weights"))


def group_weights(terms: DataFrame, members: DataFrame) -> DataFrame:
    """(group, doc, term, weight): as ``weights`` (plain tf, every term), each group being a corpus of its own.

    ``members``: (group, doc); document counts of a (group, term) combine before the shuffle.
    """
    sizes = members.groupBy("group").agg(F.count("*").alias("n"))
    rows = terms.join(members, "doc")
    df = rows.groupBy("group", "term").agg(F.count("*").alias("df")).join(sizes, "group")
    idf = df.select("group", "term", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))
    raw = rows.join(idf, ["group", "term"]).select("group", "doc", "term", (F.col("tf") * F.col("idf")).alias("w"))
    norm = raw.groupBy("doc").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return raw.join(norm, "doc").select("group", "doc", "term", (F.col("w") / F.col("norm")).alias("weight"))


def pair_cosine(pairs: DataFrame, weighted: DataFrame) -> DataFrame:
    """(a, b, cosine) for the pairs given; 0 where no term is common."""
    left = weighted.select(F.col("doc").alias("a"), "term", F.col("weight").alias("wa"))
    right = weighted.select(F.col("doc").alias("b"), "term", F.col("weight").alias("wb"))
    dots = pairs.select("a", "b").distinct().join(left, "a").join(right, ["b", "term"]).groupBy("a", "b").agg(F.sum(F.col("wa") * F.col("wb")).alias("cosine"))
    return pairs.select("a", "b").distinct().join(dots, ["a", "b"], "left").na.fill(0.0, ["cosine"])


def cohesion(weighted: DataFrame, members: DataFrame) -> DataFrame:
    """(group, n, cohesion): mean over members of their mean similarity to the others.

    For unit vectors that is (|sum|^2 - n) / (n (n - 1)), so no pair is ever made.
    """
    sums = members.select("group", "doc").join(weighted, "doc").groupBy("group", "term").agg(F.sum("weight").alias("s"), F.sum(F.col("weight") * F.col("weight")).alias("own"))
    squares = sums.groupBy("group").agg(F.sum(F.col("s") * F.col("s")).alias("sq"), F.sum("own").alias("own"))
    sizes = members.groupBy("group").agg(F.count("*").alias("n")).where("n > 1")
    return sizes.join(squares, "group", "left").select("group", "n", ((F.coalesce("sq", F.lit(0.0)) - F.coalesce("own", F.lit(0.0))) / (F.col("n") * (F.col("n") - 1))).alias("cohesion"))
