"""Per-key results over skewed keys (problem 5).

Method: map-side combining. Every aggregate here is algebraic, so each task folds its rows
into a bounded hash table that spills mergeable states, and only one compact state per key
and task is shuffled: a key holding a third of all rows costs the reducer no more states
than any other. Votes are two of those steps, (key, value) then key; nothing gathers the
rows of a key. Repeated rows count (they are rows of the table).

Defined edge cases: a null key is not a group; null and blank votes do not count; ties of
a vote go to the smallest value; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def key_sizes(df: DataFrame, key: str) -> DataFrame:
    """Rows per non-null key: (key, n)."""
    return df.select(F.col(key).alias("key")).where("key IS NOT NULL").groupBy("key").agg(F.count("*").alias("n"))


def heavy_keys(df: DataFrame, key: str, share: float = 0.02, least: int = 4) -> DataFrame:
    """Keys held by at least ``share`` of all rows (null keys included) and ``least`` rows: (key, n)."""
    sizes = df.select(F.col(key).alias("key")).groupBy("key").agg(F.count("*").alias("n"))
    total = sizes.agg(F.sum("n").alias("total")).scalar()
    return sizes.where("key IS NOT NULL").where((F.col("n") >= least) & (F.col("n") >= share * total))


def vote(df: DataFrame, key: str, value: str) -> DataFrame:
    """Most frequent non-blank value per key, ties to the smallest: (key, value, votes)."""
    counts = (
        df.select(F.col(key).alias("key"), F.col(value).alias("value"))
        .where("key IS NOT NULL AND trim(value) <> ''")
        .groupBy("key", "value").agg(F.count("*").alias("votes"))
    )
    best = F.min(F.struct((-F.col("votes")).alias("minus"), F.col("value"))).alias("best")
    return counts.groupBy("key").agg(best).select("key", F.col("best.value").alias("value"), (-F.col("best.minus")).alias("votes"))


def group_report(df: DataFrame, key: str, votes: list[str]) -> DataFrame:
    """Size and winning values per key: (key, n, <vote>, <vote>_n ...)."""
    out = key_sizes(df, key)
    for name in votes:
        won = vote(df, key, name).select("key", F.col("value").alias(name), F.col("votes").alias(f"{name}_n"))
        out = out.join(won, "key", "left")
    return out


def lot_report(df: DataFrame) -> DataFrame:
    """Groups written in lots: rows, distinct lots, members named and distinct members per label.

    Distinct counts go through (key, value) states first, so no task holds a label's values.
    """
    base = df.select(F.col("id_groupe_total").alias("key"), F.col("lot").alias("lot"), F.col("noms").alias("noms")).where("key IS NOT NULL")
    rows = base.groupBy("key").agg(F.count("*").alias("n_rows"), F.sum(F.when(F.size("noms") > 0, F.size("noms")).otherwise(0)).alias("n_named"))
    lots = base.where("lot IS NOT NULL").groupBy("key", "lot").agg(F.lit(1).alias("x")).groupBy("key").agg(F.count("*").alias("n_lots"))
    members = (
        base.select("key", F.explode("noms").alias("nom")).where("trim(nom) <> ''")
        .groupBy("key", "nom").agg(F.lit(1).alias("x")).groupBy("key").agg(F.count("*").alias("n_members"))
    )
    return rows.join(lots, "key", "left").join(members, "key", "left").na.fill(0, ["n_lots", "n_members"])


def first_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first by ``order``; ``WindowGroupLimit`` prunes before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")
