"""Jaccard metric-space join: pivots, Voronoi regions and triangle-inequality windows.

d(x, y) = 1 - |x n y| / |x u y| over word multisets is a metric. Each row of a region goes to
its nearest of ``pivots`` pivots (ties to the smaller signature) and, as a guest, to every
pivot p with d(x, p) <= d(x, nearest) + 2 r: a partner y within r of x whose home is p has
d(x, p) <= d(x, y) + d(y, p) <= r + d(y, home of x) <= 2 r + d(x, home of x), so each pair
meets in the home of either of its texts, and the join stays exact. Regions that stay over the limit
are split again with other pivots, and what no pivot can split is joined in salted blocks.

Pivots are picked by smallest hash, as aggregates of bounded size per region; distances are
computed where the rows are, against the pivots of their region.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souche.session import cut

PIVOTS = 12
ROUNDS = 2


def pick_pivots(rows: DataFrame, pivots: int, seed: int) -> DataFrame:
    """(region, sig): per region the rows of smallest hash, from partial aggregates of bounded size."""
    parts = rows.select("region", "sig", F.xxhash64("sig", F.lit(seed)).alias("h"))
    # the smallest hash of each of ``pivots`` slots: an algebraic aggregate, never a sort of the region
    slot = F.pmod("h", F.lit(pivots)).alias("slot")
    return parts.groupBy("region", slot).agg(F.min(F.struct("h", "sig")).alias("p")).select("region", F.col("p.sig").alias("sig"))


def distances(rows: DataFrame, toks: DataFrame, pivots: int, seed: int) -> DataFrame:
    """(region, sig, n, miss, parity, to): rows with their distance to each pivot of their region."""
    chosen = pick_pivots(rows, pivots, seed).join(toks.select("sig", "words", "mults"), "sig")
    packed = chosen.groupBy("region").agg(F.collect_list(F.struct("sig", "words", "mults")).alias("pivots"))
    near = rows.join(toks.select("sig", "words", "mults"), "sig").join(packed, "region")
    kind = pa.struct([("pivot", pa.binary()), ("d", pa.float64())])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                lists = batch.column("words")
                row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
                words, mults = lists.flatten().to_numpy(), batch.column("mults").flatten().to_numpy()
                size = np.bincount(row, mults, batch.num_rows)
                region, given = batch.column("region").to_numpy(), batch.column("pivots")
                parts, at_row = [], []
                for r in np.unique(region):
                    inside = np.flatnonzero(region == r)
                    own = np.isin(row, inside)
                    w, m, who = words[own], mults[own], row[own]
                    for p in given[int(inside[0])]:
                        pw, pm = p["words"].values.to_numpy(), p["mults"].values.to_numpy()
                        place = np.minimum(np.searchsorted(pw, w), len(pw) - 1)
                        hit = pw[place] == w
                        both = np.bincount(who[hit], np.minimum(m[hit], pm[place[hit]]), batch.num_rows)[inside]
                        far = 1 - both / (size[inside] + pm.sum() - both)
                        parts.append(pa.StructArray.from_arrays([pa.array([p["sig"].as_py()] * len(inside), pa.binary()), pa.array(far)], fields=list(kind)))
                        at_row.append(inside)
                at_row = np.concatenate(at_row)
                order = np.argsort(at_row, kind="stable")
                ends = np.concatenate([[0], np.cumsum(np.bincount(at_row, minlength=batch.num_rows))]).astype(np.int32)
                to = pa.ListArray.from_arrays(pa.array(ends), pa.concat_arrays(parts).take(pa.array(order)))
                keep = ["region", "sig", "n", "miss", "parity"]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), to], names=[*keep, "to"])

    return near.mapInArrow(measure, "region bigint, sig binary, n int, miss int, parity binary, to array<struct<pivot binary, d double>>")


def split(rows: DataFrame, toks: DataFrame, least: float, pivots: int = PIVOTS, seed: int = 0) -> DataFrame:
    """(region, sig, n, miss, parity, home): rows in the sub-region of their nearest pivot, and as guests in others' windows."""
    radius = 1 - least
    far = distances(rows, toks, pivots, seed).withColumn("near", F.array_min(F.transform("to", lambda p: F.struct(p["d"].alias("d"), p["pivot"].alias("pivot")))))
    window = F.filter("to", lambda p: p["d"] <= F.col("near.d") + 2 * radius + 1e-9)
    placed = far.select("region", "sig", "n", "miss", "parity", "near", F.explode(window).alias("p"))
    return placed.select(F.xxhash64("region", F.col("p.pivot")).alias("region"), "sig", "n", "miss", "parity", (F.col("p.pivot") == F.col("near.pivot")).alias("home"))


def join_wide(rows: DataFrame, toks: DataFrame, least: float, most: int, pivots: int = PIVOTS, rounds: int = ROUNDS, block: int | None = None) -> DataFrame:
    """(a, b): candidate pairs of regions over ``most`` rows; what stays large is joined in blocks of ``block`` (else ``most``)."""
    one = toks.groupBy("sig").agg(F.first("words").alias("words"), F.first("mults").alias("mults"))
    rows = rows.groupBy("region", "sig").agg(F.first("n").alias("n"), F.min("miss").alias("miss"), F.first("parity").alias("parity"))
    rows = rows.withColumn("home", F.lit(True))
    done = None
    for seed in range(rounds):
        rows = cut(rows, "wide")
        sizes = rows.groupBy("region").agg(F.count("*").alias("rows"))
        large = rows.join(sizes.where(F.col("rows") > most).select("region"), "region", "left_semi")
        small = rows.join(sizes.where(F.col("rows") <= most).select("region"), "region", "left_semi")
        done = small if done is None else done.unionByName(small)
        # a guest may sit at any pivot of the split region, so homes are told apart only at the last split
        parts = cut(split(large.drop("home"), one, least, pivots, seed), "voronoi")
        before, after = large.count(), parts.count()
        if not before or after > 0.5 * pivots * before:  # the windows cover the region: pivots can't split it
            rows = large
            break
        rows = parts
    done = rows if done is None else done.unionByName(rows)
    return salted_pairs(cut(done, "blocks"), least, block or most)


def salted_pairs(rows: DataFrame, least: float, most: int) -> DataFrame:
    """Candidate pairs within each region; a large one is a triangle of blocks, so no task gets all of it."""
    sizes = rows.groupBy("region").agg(F.count("*").alias("rows"))
    salts = sizes.select("region", F.ceil(F.col("rows") / most).cast("int").alias("salts"))
    placed = rows.join(salts, "region")
    # the parity as four longs, once a row: a pair then costs four XORs
    words = [F.conv(F.hex(F.substring("parity", 8 * i + 1, 8)), 16, -10).cast("bigint").alias(f"p{i}") for i in range(4)]
    placed = placed.select("region", "sig", "n", "miss", "home", "salts", *words)
    names = ("sig", "n", "miss", "home", "p0", "p1", "p2", "p3")
    left = placed.select("region", F.pmod(F.xxhash64("sig"), "salts").cast("int").alias("salt"), *(F.col(c).alias(f"{c}_a") for c in names))
    right = placed.select("region", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), *(F.col(c).alias(f"{c}_b") for c in names))
    room = F.lit((1 - least) / (1 + least)) * (F.col("n_a") + F.col("n_b")) + 1e-9
    bits = [F.bit_count(F.col(f"p{i}_a").bitwiseXOR(F.col(f"p{i}_b"))) for i in range(4)]
    differ = sum(bits[1:], bits[0])
    return (
        left.join(right, ["region", "salt"]).where((F.col("sig_a") < F.col("sig_b")) & (F.col("home_a") | F.col("home_b")))
        .where((F.col("miss_a") + F.col("miss_b") <= room) & (F.least("n_a", "n_b") >= least * F.greatest("n_a", "n_b") - 1e-9))
        .where(differ <= room).select(F.col("sig_a").alias("a"), F.col("sig_b").alias("b")).distinct()
    )
