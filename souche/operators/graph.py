"""Groups from links: components, numbering, the centroid-gated merge and outliers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from souche.session import cut, cut_marked, drop_cut


def components(edges: DataFrame, a: str = "a", b: str = "b", hot_least: int = 100_000, rounds: int = 100) -> DataFrame:
    """(id, root): the smallest id each vertex is tied to, by large-star and small-star steps.

    Each round links a vertex's larger neighbours to its smallest one, then all its smaller
    neighbours and itself; the edges of a component shrink to a star. Minima are algebraic
    aggregates; vertices holding more than their share of the edges (at most 200) get theirs by
    broadcast, so a hub's edges are never gathered. Each round is cut to the shared folder.
    """
    marks = F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))
    state, mark = cut_marked(edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).where("lo < hi").distinct(), "components", *marks)
    for _ in range(rounds):
        new, after = cut_marked(_star(_star(state, True, mark[0], hot_least), False, mark[0], hot_least), "components", *marks)
        drop_cut(state)
        state, before, mark = new, mark, after
        if mark == before:
            break
    else:
        raise RuntimeError("components have not settled")
    return state.select(F.col("hi").alias("id"), F.col("lo").alias("root")).unionByName(state.select(F.col("lo").alias("id"), F.col("lo").alias("root")).distinct())


def _star(edges: DataFrame, large: bool, n: int, hot_least: int) -> DataFrame:
    if large:
        ways = edges.select(F.explode(F.array(F.struct(F.col("lo").alias("v"), F.col("hi").alias("u")), F.struct(F.col("hi").alias("v"), F.col("lo").alias("u")))).alias("r")).select("r.v", "r.u")
    else:
        ways = edges.select(F.col("hi").alias("v"), F.col("lo").alias("u"))
    least = ways.groupBy("v").agg(F.min("u").alias("m"), F.count("*").alias("n"))
    limit = max(hot_least, n // 100)
    hot = [r.v for r in least.where(F.col("n") > limit).select("v").collect()] if n > limit else []  # at most 2 n / limit
    least = least.select("v", F.least("m", "v").alias("m"))
    if hot:
        joined = ways.where(~F.col("v").isin(hot)).join(least, "v").unionByName(ways.where(F.col("v").isin(hot)).join(F.broadcast(least.where(F.col("v").isin(hot))), "v"))
    else:
        joined = ways.join(least, "v")
    if large:  # larger neighbours go to the smallest of the neighbourhood
        out = joined.where("u > v").select(F.col("u").alias("hi"), F.col("m").alias("lo"))
    else:  # smaller neighbours and the vertex itself
        out = joined.select(F.col("u").alias("hi"), F.col("m").alias("lo")).unionByName(joined.select(F.col("v").alias("hi"), F.col("m").alias("lo")))
    return out.where("lo < hi").distinct()


def spanning(edges: DataFrame, most: int = 1_000_000) -> DataFrame:
    """(a, b): edges that join what no edge before them in their partition had joined; the components stay the same.

    At most a row per vertex and partition is left, without a shuffle. Beyond ``most`` vertices a task begins anew, which keeps edges, never drops one.
    """

    def joining(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict[str, str] = {}

        def top(x: str) -> str:
            p = above.setdefault(x, x)
            while p != x:
                above[x] = x = above[p]
                p = above[x]
            return x

        for batch in batches:
            keep = []
            for at, (x, y) in enumerate(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())):
                if x is not None and y is not None and (u := top(x)) != (v := top(y)):
                    above[v] = u
                    keep.append(at)
            yield batch.take(pa.array(keep, pa.int64()))
            if len(above) > most:
                above.clear()

    rows = edges.select("a", "b")
    return rows.mapInArrow(joining, rows.schema)


def star_edges(df: DataFrame, key: str, group: str) -> DataFrame:
    """Edges from a group's smallest member to the others."""
    rows = df.where(F.col(group).isNotNull()).select(F.col(key).alias("b"), F.col(group).alias("g")).distinct()
    least = rows.groupBy("g").agg(F.min("b").alias("a"))
    return rows.join(least, "g").where("a <> b").select("a", "b")


def numbered(groups: DataFrame, root: str = "root") -> DataFrame:
    """Dense numbers 1..n in the order of the roots.

    Roots are ranked within ranges, and ranges offset by the roots before them, so no task sees all.
    """
    roots = groups.select(F.col(root).alias("root")).distinct().repartitionByRange("root").withColumn("part", F.spark_partition_id())
    roots = cut(roots, "roots")
    sizes = roots.groupBy("part").agg(F.count("*").alias("n"))
    # one row per partition
    offsets = sizes.withColumn("offset", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("part", "offset")
    rank = F.row_number().over(Window.partitionBy("part").orderBy("root"))
    labels = roots.withColumn("r", rank).join(F.broadcast(offsets), "part").select("root", (F.col("r") + F.col("offset")).alias("label"))
    return groups.withColumnRenamed(root, "root").join(labels, "root")


def cluster_stats(groups: DataFrame, group: str) -> DataFrame:
    """(clusters, singletons, singleton_pct, mean_size, max_size)."""
    sizes = groups.where(F.col(group).isNotNull()).groupBy(group).agg(F.count("*").alias("n"))
    return sizes.agg(
        F.count("*").alias("clusters"), F.sum((F.col("n") == 1).cast("int")).alias("singletons"),
        F.round(F.try_divide(F.sum((F.col("n") == 1).cast("int")) * 100.0, F.count("*")), 6).alias("singleton_pct"),
        F.round(F.avg("n"), 6).alias("mean_size"), F.max("n").alias("max_size"),
    )


def largest(groups: DataFrame, group: str, k: int = 5) -> DataFrame:
    """(rank, size): the k largest group sizes."""
    sizes = groups.where(F.col(group).isNotNull()).groupBy(group).agg(F.count("*").alias("size")).orderBy(F.desc("size")).limit(k)
    return sizes.select(F.row_number().over(Window.orderBy(F.desc("size"))).alias("rank"), "size")  # k rows


def size_report(groups: DataFrame, group: str) -> DataFrame:
    """(groups, members, in_groups, singletons, mean, median, largest); in_groups counts members who are not alone.

    The median comes from how many groups have each size: one row a distinct size, about the root of twice the rows.
    """
    sizes = groups.where(F.col(group).isNotNull()).groupBy(group).agg(F.count("*").alias("n"))
    hist = sizes.groupBy("n").agg(F.count("*").alias("g"))
    upto = F.sum("g").over(Window.orderBy("n"))
    every = F.sum("g").over(Window.partitionBy(F.lit(0)))
    at = hist.withColumn("upto", upto).withColumn("all", every).withColumn("before", F.col("upto") - F.col("g"))
    lower, upper = F.floor((F.col("all") + 1) / 2), F.floor(F.col("all") / 2) + 1
    inside = lambda x: (F.col("before") < x) & (x <= F.col("upto"))
    return at.agg(
        F.coalesce(F.sum("g"), F.lit(0)).alias("groups"), F.coalesce(F.sum(F.col("g") * F.col("n")), F.lit(0)).alias("members"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("g") * F.col("n"))), F.lit(0)).alias("in_groups"), F.coalesce(F.sum(F.when(F.col("n") == 1, F.col("g"))), F.lit(0)).alias("singletons"),
        F.round(F.try_divide(F.sum(F.col("g") * F.col("n")).cast("double"), F.sum("g")), 6).alias("mean"),
        ((F.max(F.when(inside(lower), F.col("n"))) + F.max(F.when(inside(upper), F.col("n")))) / 2).alias("median"), F.max("n").alias("largest"),
    )


def confidence(sims: DataFrame, sim: str = "sim", otherwise: float = 0.88) -> DataFrame:
    """(confidence): mean similarity of the outliers to their groups' centres, ``otherwise`` if there is none."""
    return sims.agg(F.round(F.coalesce(F.avg(sim), F.lit(otherwise)), 6).alias("confidence"))


def centroids(members: DataFrame, group: str, vector: str) -> DataFrame:
    """(group, centroid): normalised mean vector, from per-dimension sums combined map-side."""
    dims = members.where(F.col(vector).isNotNull()).select(group, F.posexplode(vector).alias("i", "x")).groupBy(group, "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    packed = dims.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda e: e["x"]).alias("mean"))
    norm = F.sqrt(F.aggregate("mean", F.lit(0.0), lambda s, x: s + x * x))
    return packed.select(group, F.when(norm > 0, F.transform("mean", lambda x: x / norm)).otherwise(F.col("mean")).alias("centroid"))


def dot(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def outliers(members: DataFrame, key: str, group: str, vector: str, least: float = 0.82, most: int = 30) -> DataFrame:
    """(group, key, sim): members of groups of at most ``most`` that are far from their group's centroid."""
    sizes = members.groupBy(group).agg(F.count("*").alias("n")).where(F.col("n").between(2, most)).select(group)
    rows = members.join(sizes, group)
    sims = rows.join(centroids(rows, group, vector), group).select(group, key, F.round(dot(F.col(vector), F.col("centroid")), 4).alias("sim"))
    return sims.where(F.col("sim") < least)


def gated_merge(members: DataFrame, candidates: DataFrame, least: float = 0.88) -> DataFrame:
    """(id, label): starting groups merged greedily along candidate pairs, best first, while each
    end is close to the other group's centroid.

    ``members``: (id, group, v); ``candidates``: (a, b, sim). A merge reads only its two groups,
    so each component of groups tied by candidates is its own task: exact and parallel. The
    largest task is the largest such component; the candidate threshold bounds it.
    """
    tied = candidates.join(members.select(F.col("id").alias("a"), F.col("group").alias("ga")), "a").join(members.select(F.col("id").alias("b"), F.col("group").alias("gb")), "b").where("ga <> gb")
    tied = cut(tied, "tied")
    parts = components(tied, "ga", "gb").select(F.col("id").alias("group"), F.col("root").alias("part"))
    inside = members.join(parts, "group")
    steps = tied.join(parts.withColumnRenamed("group", "ga"), "ga")
    rows = inside.select("part", "id", "group", "v", F.lit(None).cast("string").alias("a"), F.lit(None).cast("string").alias("b"), F.lit(None).cast("double").alias("sim"))
    rows = rows.unionByName(steps.select("part", F.lit(None).cast("string").alias("id"), F.lit(None).cast(dict(members.dtypes)["group"]).alias("group"), F.lit(None).cast("array<float>").alias("v"), "a", "b", "sim"))

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        people = part[part["id"].notna()].sort_values("id")
        vectors = {i: np.asarray(v, dtype=float) for i, v in zip(people["id"], people["v"])}
        home = dict(zip(people["id"], people["group"]))
        sums, ids = {}, {}
        for i, g in home.items():
            sums[g] = sums.get(g, 0) + vectors[i]
            ids.setdefault(g, []).append(i)
        for a, b in part[part["id"].isna()].sort_values(["sim", "a", "b"], ascending=[False, True, True])[["a", "b"]].itertuples(index=False):
            ga, gb = home[a], home[b]
            if ga == gb:
                continue
            ca, cb = (s / (np.linalg.norm(s) or 1.0) for s in (sums[ga], sums[gb]))
            if vectors[a] @ cb >= least and vectors[b] @ ca >= least:
                keep, drop = min(ga, gb), max(ga, gb)
                sums[keep] = sums[keep] + sums.pop(drop)
                for i in ids[drop]:
                    home[i] = keep
                ids[keep] += ids.pop(drop)
        return pd.DataFrame({"id": list(home), "label": list(home.values())})

    kind = dict(members.dtypes)["group"]
    merged = rows.groupBy("part").applyInPandas(merge, f"id string, label {kind}")
    return members.select("id", "group").join(merged, "id", "left").select("id", F.coalesce("label", "group").alias("label"))
