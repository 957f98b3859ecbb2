"""All close spellings of names that share their first letters, without a row per compared pair.

Names of a block (same first letters) meet in tiles: a block of at most ``most`` names is one tile, a larger
one is dealt by hash into slices and each two slices are a tile, so no task grows with a block. Inside a
tile every pair is compared, exactly: an upper bound from common letters leaves most pairs out, the others are
scored by the steps of ``jaro_winkler_py`` on words of 64 bits. Only pairs that pass leave the tile. What
belongs to a name (a weighted text, labels) travels with it, so pairs need no join afterwards.

Defined edge cases: null names and names shorter than the prefix take no part; names over 64 letters, or with a
zero byte, are scored one by one; no names give no pairs. Ties of the k best go to the smaller name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MOST = 8192
LOT = 50_000


def _best(m, la, lb, prefix):
    """The highest similarity of ``m`` matches, all in order."""
    jaro = (m / la + m / lb + 1) / 3
    return np.where(jaro > 0.7, jaro + 0.1 * prefix * (1 - jaro), jaro)


def close_pairs(names: list[str], least: float, half: np.ndarray | None = None, cells: int = 65_536) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, sim), i < j, of distinct names in ascending order; with ``half`` only pairs across the halves."""
    half = np.zeros(len(names), np.int8) if half is None else half + 1
    long = np.array([len(x) for x in names], np.int64)
    odd = np.array([not 0 < len(x) <= 64 or "\0" in x for x in names], bool)
    yield from _one_by_one(names, np.flatnonzero(odd), odd, half, least)
    rows = np.flatnonzero(~odd)
    if len(rows) < 2:
        return
    wide = max(int(long[rows].max()), 4)
    letters = np.zeros((len(names), wide), np.int64)
    kinds, at = np.unique(np.array([names[i] for i in rows], dtype=f"U{wide}").view(np.uint32), return_inverse=True)
    letters[rows] = at.reshape(len(rows), wide)
    bags, extra = _bags(letters, long)
    groups = {key: rows[(half[rows] == key[0]) & (long[rows] == key[1])] for key in sorted({(int(h), int(n)) for h, n in zip(half[rows], long[rows])})}
    lot = max(1, 4_000_000 // len(kinds))
    for (hb, lb), every in groups.items():
        for right in (every[i : i + lot] for i in range(0, len(every), lot)):
            n = len(right)
            bits = np.zeros((len(kinds), n), np.uint64)
            for j in range(lb):
                bits[letters[right, j], np.arange(n)] |= np.uint64(1 << j)
            for (ha, la), left in groups.items():
                if ha == hb != 0:
                    continue
                enough = np.flatnonzero(_best(np.arange(1, min(la, lb) + 1), la, lb, 4) >= least - 1e-9)
                if not len(enough):
                    continue
                reach = max(max(la, lb) // 2 - 1, 0)
                near = [np.uint64(sum(1 << j for j in range(max(0, i - reach), min(lb, i + reach + 1)))) for i in range(la)]
                step = max(1, cells // n)
                for part in (left[i : i + step] for i in range(0, len(left), step)):
                    start = int(np.searchsorted(right, part[0], "right"))
                    if start == n:
                        break
                    common = np.bitwise_count(bags[part][:, None] & bags[right[start:]][None, :]) + np.minimum(extra[part][:, None], extra[right[start:]][None, :])
                    x, y = np.nonzero((common > enough[0]) & (part[:, None] < right[None, start:]))
                    if len(x):
                        yield from _scored(bits.ravel(), n, letters, part[x], right, y + start, la, lb, near, least)


def _one_by_one(names, hard, odd, half, least):
    from souche.operators.matching import jaro_winkler_py

    for i in hard:
        others = [j for j in range(len(names)) if j != i and (j > i or not odd[j]) and (half[i] == 0 or half[i] != half[j])]
        pairs = np.array([(min(i, j), max(i, j)) for j in others], np.int64).reshape(-1, 2)
        sim = np.array([round(jaro_winkler_py(names[a], names[b]), 9) for a, b in pairs], float)
        pick = sim >= least
        if pick.any():
            yield pairs[pick, 0], pairs[pick, 1], sim[pick]


def _bags(letters: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A bit for the first and the second time each of 32 classes of letters occurs, and the number of further ones."""
    count = np.zeros((len(letters), 32), np.uint8)
    bags, extra, row = np.zeros(len(letters), np.uint64), np.zeros(len(letters), np.uint8), np.arange(len(letters))
    for j in range(letters.shape[1]):
        there, kind = j < long, letters[:, j] % 32
        seen = count[row, kind]
        bags |= np.where(there & (seen < 2), np.uint64(1) << (kind + 32 * np.minimum(seen, 1)).astype(np.uint64), np.uint64(0))
        extra += there & (seen >= 2)
        count[row, kind] += there
    return bags, extra


def _scored(bits, n, letters, a, right, y, la, lb, near, least):
    """Greedy matches of each pair, letter by letter of ``a``; then letters out of order."""
    one, zero = np.uint64(1), np.uint64(0)
    at = [letters[a, i] * n + y for i in range(la)]
    used, hit = np.zeros(len(a), np.uint64), np.zeros(len(a), np.uint64)
    for i in range(la):
        free = bits.take(at[i]) & ~used & near[i]
        low = free & (zero - free)
        used |= low
        hit |= (low != 0).astype(np.uint64) << np.uint64(i)
    m = np.bitwise_count(used).astype(np.int64)
    b, prefix, same = right[y], np.zeros(len(a), np.int64), np.ones(len(a), bool)
    for k in range(min(4, la, lb)):
        same &= letters[a, k] == letters[b, k]
        prefix += same
    keep = np.flatnonzero((m > 0) & (_best(m, la, lb, prefix) >= least - 1e-9))
    a, b, m, prefix, used, hit = a[keep], b[keep], m[keep], prefix[keep], used[keep], hit[keep]
    swaps = np.zeros(len(a), np.int64)
    for i in range(la):
        on = (hit >> np.uint64(i)) & one
        low = used & (zero - used)
        swaps += (on != 0) & ((bits.take(at[i][keep]) & low) == 0)
        used ^= low * on
    jaro = (m / la + m / lb + (m - swaps // 2) / np.maximum(m, 1)) / 3
    sim = np.round(np.where(jaro > 0.7, jaro + 0.1 * prefix * (1 - jaro), jaro), 9)
    pick = sim >= least
    if pick.any():
        yield a[pick], b[pick], sim[pick]


def best_of(i: np.ndarray, j: np.ndarray, sim: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(name, other, sim): the k best of each name, in both directions; ties to the smaller other."""
    a, b, s = np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([sim, sim])
    order = np.lexsort((b, -s, a))
    a, b, s = a[order], b[order], s[order]
    first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else np.zeros(0, np.int64)
    rank = np.arange(len(a)) - np.repeat(first, np.diff(np.r_[first, len(a)]))
    return a[rank < k], b[rank < k], s[rank < k]


def _paired(a, b, s):
    """Pairs i < j, each once."""
    i, j = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((j, i))
    i, j, s = i[order], j[order], s[order]
    fresh = np.r_[True, (i[1:] != i[:-1]) | (j[1:] != j[:-1])] if len(i) else np.zeros(0, bool)
    return i[fresh], j[fresh], s[fresh]


def _best_pairs(found, k: int, hold: int = 2_000_000):
    """Ways of the k best, with what is held in between pruned to them."""
    held, n = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))], 0
    for x in found:
        held.append(x)
        n += len(x[0])
        if n > hold:
            held = [_paired(*best_of(*(np.concatenate(c) for c in zip(*held)), k))]
            n = 0
    return best_of(*(np.concatenate(c) for c in zip(*held)), k)


class Cosines:
    """Inner products of sparse rows scaled to unit length: one row spread out, all its partners gathered at once."""

    def __init__(self, terms: pa.Array, weights: pa.Array):
        size = np.nan_to_num(terms.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
        self.begin, self.size = np.r_[0, np.cumsum(size)][:-1], size
        kinds, self.at = np.unique(terms.flatten().to_numpy(zero_copy_only=False), return_inverse=True)
        weight, row = weights.flatten().to_numpy(zero_copy_only=False).astype(float), np.repeat(np.arange(len(size)), size)
        self.weight, self.dense = weight / np.sqrt(np.bincount(row, weight * weight, len(size)))[row], np.zeros(len(kinds))

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i))
        order = np.argsort(i, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(i[order])) + 1) if len(order) else []:
            x, to = i[part[0]], j[part]
            own = slice(self.begin[x], self.begin[x] + self.size[x])
            self.dense[self.at[own]] = self.weight[own]
            size = self.size[to]
            pair = np.repeat(np.arange(len(to)), size)
            at = np.arange(len(pair)) + np.repeat(self.begin[to] - (np.cumsum(size) - size), size)
            out[part] = np.bincount(pair, self.dense[self.at[at]] * self.weight[at], len(to))
            self.dense[self.at[own]] = 0
        return out


def _worker(least: float, k: int | None, ways: bool, vectors: bool, labels: list[str], limits: bool):
    def work(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).combine_chunks()
        names = table["__name"].to_pylist()
        order = sorted(range(len(names)), key=names.__getitem__)
        table, names = table.take(pa.array(order)).combine_chunks(), [names[x] for x in order]
        half = None if key[1].as_py() == key[2].as_py() else (table["__s"].to_numpy() == key[2].as_py()).astype(np.int8)
        whole = lambda c: table[c].combine_chunks() if isinstance(table[c], pa.ChunkedArray) else table[c]
        texts = whole("__name")
        cosines = Cosines(whole("terms"), whole("weights")) if vectors else None
        codes = [np.unique(["" if x is None else x for x in table[c].to_pylist()], return_inverse=True) for c in labels]
        found = close_pairs(names, least, half)

        def batch(i, j, sim) -> pa.RecordBatch:
            cols = {"a": texts.take(pa.array(i)), "b": texts.take(pa.array(j)), "sim": pa.array(sim)}
            if vectors:
                cols["cosine"] = pa.array(cosines(i, j))
            for c, (values, code) in zip(labels, codes):
                cols[f"same_{c}"] = pa.array((code[i] == code[j]) & (values[code[i]] != ""))
            return pa.RecordBatch.from_pydict(cols)

        if k is not None:
            a, b, s = _best_pairs(found, k)
            found = [(a, b, s) if ways else _paired(a, b, s)]
        elif limits:
            worst = np.nan_to_num(table["__worst"].to_numpy().astype(float), nan=-1.0)
            last = ["" if x is None else x for x in table["__last"].to_pylist()]
            within = lambda i, j, s: (s > worst[i]) | (s == worst[i]) & np.array([names[y] <= last[x] for x, y in zip(i, j)], bool)
            found = ((i[p], j[p], s[p]) for i, j, s in found for p in [within(i, j, s) | within(j, i, s)])
        held, n = [], 0
        for x in found:
            for at in range(0, len(x[0]), LOT):
                held.append([c[at : at + LOT] for c in x])
                n += len(held[-1][0])
                if n >= LOT:
                    yield batch(*(np.concatenate(c) for c in zip(*held)))
                    held, n = [], 0
        if n:
            yield batch(*(np.concatenate(c) for c in zip(*held)))

    return work


def near(rows: DataFrame, name: str, prefix: int, least: float, k: int | None = None, vectors: bool = False, labels: tuple[str, ...] = (), most: int | None = None, names: DataFrame | None = None) -> DataFrame:
    """(a, b, sim), a < b: names that share ``prefix`` letters and are at least ``least`` similar (nine decimals); with ``k`` those among the k best of either name.

    ``rows``: one row per name. With ``vectors`` they hold (terms, weights), and a pair gets its ``cosine``; for each of
    ``labels`` a pair gets ``same_<label>``: equal and not empty. ``names``: the same names, where they are cheaper
    to count alone.
    """
    most = most or (2 * MOST if vectors or k is not None else MOST)  # fewer slices where they carry more or go twice
    block = F.substring("__name", 1, prefix).alias("__block")
    sizes = (rows if names is None else names).select(F.col(name).alias("__name")).where(F.length("__name") >= prefix).groupBy(block).agg(F.ceil(F.count("*") / most).cast("int").alias("__slices"))
    carried = [*(["terms", "weights"] if vectors else []), *labels]
    rows = rows.select(F.col(name).alias("__name"), *carried).where(F.length("__name") >= prefix).withColumn("__block", block)
    seen = sizes.agg(F.sum(F.col("__slices") * (F.col("__slices") + 1) / 2), F.max("__slices")).first()
    tiles, split = int(seen[0] or 0), (seen[1] or 0) > 1
    if split:  # blocks over ``most`` names: at most rows / most
        rows = rows.join(F.broadcast(sizes.where("__slices > 1")), "__block", "left").na.fill(1, ["__slices"])
    else:
        rows = rows.withColumn("__slices", F.lit(1))
    shape = "a string, b string, sim double" + ", cosine double" * vectors + "".join(f", same_{c} boolean" for c in labels)
    parts = min(4096, max(2 * tiles, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))

    def met(df: DataFrame, k, ways=False, limits=False, bare=False) -> DataFrame:
        s = F.when(F.col("__slices") > 1, F.pmod(F.xxhash64("__name"), F.col("__slices"))).otherwise(F.lit(0)).cast("int")
        dealt = df.withColumn("__s", s).withColumn("__t", F.explode(F.sequence(F.lit(0), F.col("__slices") - 1)))
        dealt = dealt.select("__block", F.least("__s", "__t").alias("__i"), F.greatest("__s", "__t").alias("__j"), "__name", "__s", *([] if bare else carried), *(["__worst", "__last"] if limits else []))
        work = _worker(least, k, ways, vectors and not bare, [] if bare else list(labels), limits)
        # a number of partitions of our own: tiles are few bytes and much work, so they must not be put together by size
        return dealt.repartition(parts, "__block", "__i", "__j").groupBy("__block", "__i", "__j").applyInArrow(work, "a string, b string, sim double" if bare else shape)

    if k is None or not split:
        return met(rows, k)
    large = rows.where("__slices > 1")
    best = met(large.select("__block", "__slices", "__name"), k, ways=True, bare=True)
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("sim"), "b"))
    last = best.withColumn("r", rank).where(F.col("r") == k).select(F.col("a").alias("__name"), F.col("sim").alias("__worst"), F.col("b").alias("__last"))
    return met(rows.where("__slices = 1"), k).unionByName(met(large.join(last, "__name", "left"), None, limits=True))
