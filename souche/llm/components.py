"""Consolidating pairwise matches into groups (problem 2).

Method: hash-to-min. Every vertex v keeps a cluster set C(v), at first itself and its
neighbours. Each round, v sends C(v) to its smallest member m and {m} to all others; the new
C(v) is the union of what v receives. When nothing changes, the smallest vertex of a group
holds the group and every other vertex holds just that smallest vertex.

The sets are kept as rows (v, u), never as arrays, so the set of a giant group is spread over
all tasks. The minimum of a set is an algebraic aggregate (combined map-side). Bringing it
back to the rows of v would meet the hot vertices: those holding more than ``hot_share`` of
all rows. There are at most 1/hot_share of them, so they, and only they, are broadcast, and
their rows stay where they are; all others go through an ordinary shuffled join. Every round
is written to the shared checkpoint folder, and the previous one deleted.

Defined edge cases: null ends and self pairs are dropped, repeated pairs count once, an empty
table gives an empty result, extra columns are ignored. A vertex named only in a self pair is
in no group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souche.functions import text
from souche.session import cut_marked, drop_cut


def hash_to_min(pairs: DataFrame, a: str = "a", b: str = "b", hot_share: float = 0.005, hot_least: int = 100_000, rounds: int = 60) -> DataFrame:
    """(id, group) for every vertex of ``pairs``; group is the smallest id tied to it."""
    ends = pairs.select(F.col(a).alias("v"), F.col(b).alias("u")).where("v IS NOT NULL AND u IS NOT NULL AND v <> u")
    # C(v) = {v} and the neighbours; explode keeps both directions in one pass over the pairs
    rows = ends.select(F.explode(F.expr("array(struct(v AS v, u AS u), struct(u AS v, v AS u), struct(v AS v, v AS u), struct(u AS v, u AS u))")).alias("r")).select("r.v", "r.u").distinct()
    state, mark = _settle(rows)
    for _ in range(rounds):
        new, new_mark = _settle(_round(state, mark[0], hot_share, hot_least))
        drop_cut(state)
        state = new
        if new_mark == mark:
            break
        mark = new_mark
    else:
        raise RuntimeError("hash-to-min has not settled")
    return state.groupBy(F.col("v").alias("id")).agg(F.min("u").alias("group"))


def _settle(rows: DataFrame) -> tuple[DataFrame, tuple]:
    return cut_marked(rows, "hash-to-min", F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")))


def _round(state: DataFrame, n: int, hot_share: float, hot_least: int) -> DataFrame:
    least = state.groupBy("v").agg(F.min("u").alias("m"), F.count("*").alias("n"))
    limit = max(hot_least, int(n * hot_share))
    if n > limit:
        # at most n / limit <= 1 / hot_share rows
        hot = [r.v for r in least.where(F.col("n") > limit).select("v").collect()]
    else:
        hot = []
    least = least.select("v", "m")
    if hot:
        is_hot = F.col("v").isin(hot)
        cold = state.where(~is_hot).join(least.where(~is_hot), "v")
        joined = cold.unionByName(state.where(is_hot).join(F.broadcast(least.where(is_hot)), "v"))
    else:
        joined = state.join(least, "v")
    sent = F.explode(F.array(F.struct(F.col("m").alias("v"), "u"), F.struct(F.col("u").alias("v"), F.col("m").alias("u"))))
    return joined.select(sent.alias("r")).select("r.v", "r.u").distinct()


def name_ties(names: DataFrame, name: str, links: str, first_name: bool) -> DataFrame:
    """(a, b): ids of records of which one cites the other's name, cleaned; both directions fold into one."""
    people = names.select(F.col("id").alias("b"), F.col(name).alias("key")).where("b IS NOT NULL AND key <> ''").distinct()
    cited = (
        names.select(F.col("id").alias("a"), F.explode(F.array_distinct(links)).alias("cited")).where("a IS NOT NULL")
        .select("a", text.linked_name(F.col("cited"), first_name).alias("key")).where("key <> ''").distinct()
    )
    return cited.join(people, "key").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def name_groups(surnames: DataFrame, first_names: DataFrame) -> DataFrame:
    """(genre, id, id_min) for every record tied to another; both tables settle in the same rounds."""
    parts = []
    for genre, table, name, links in (("nom", surnames, "nom", "noms_lies"), ("prenom", first_names, "prenom", "prenoms_lies")):
        ties = name_ties(table, name, links, genre == "prenom")
        parts.append(ties.select(*(F.concat(F.lit(f"{genre}|"), c).alias(c) for c in ("a", "b"))))
    groups = hash_to_min(parts[0].unionByName(parts[1]))
    return groups.select(
        F.substring_index("id", "|", 1).alias("genre"),
        F.expr("substring(id, instr(id, '|') + 1)").alias("id"),
        F.expr("substring(group, instr(group, '|') + 1)").alias("id_min"),
    )
