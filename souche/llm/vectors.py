"""Most similar vectors for every vector (problem 6). Similarity is the inner product.

Method: an inverted file of coarse centroids with product-quantised residuals, asymmetric
distance tables and exact reranking. Nothing is capped: what is left out is left out by a bound.

* Fit in two levels. ``sample`` vectors of smallest hash (a parameter) give the driver the fourth root of n
  upper centroids; each upper cell then fits its own centroids in a task, one for every ``PER_CELL``
  of its sampled vectors, in lots of at most ``LOT`` vectors. So there are ``PER_CELL``
  vectors to a centroid at any n, and about root n cells (``MOST_CELLS`` at most: it bounds the
  broadcast, 100 MB at 768 values; beyond it cells grow). The residual codebooks (256 words a sub-space) come
  from the driver's sample. Every vector is indexed and asked.
* Equal vectors are folded first: one row stands for all, with the smallest ``k + 1`` positions
  (bounded), enough for any top k when ties go to the smaller position.
* Cells lie on shelves of at most ``block`` vectors, neighbours together; a larger cell takes
  several shelves, so a cell holding a third of all rows is spread over tasks. A query goes
  once to each shelf that has one of its cells, in lots of ``ASK``, with its vector.
* On a shelf, one table per query and sub-space gives estimates of all inner products in a cell. A
  member stays if its estimate, plus the quantisation error it may have, reaches both ``least`` and
  the query's k-th best so far (less that error). All that stay are measured exactly, there.
* First a query asks its ``probes`` nearest cells. Then it asks every other cell whose members
  could reach its k-th best: centroid product plus ``SURE`` deviations of the cell's
  residuals. So a crowd of close but different vectors, which no clustering can tell apart, is
  searched whole; far cells are not.

Errors and deviations are those of directions spread over the residuals' effective dimension, four of
them (``SURE``): estimates, not proofs, hence recall is measured against brute force (README).

Defined edge cases: null and empty vectors, those of another length than most, and vectors with nulls take no part; all-zero
vectors do (their similarity is 0); a position given twice counts once; k above the table gives
what there is; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from souche.session import cut, drop_cut

SAMPLE = 10_240
PER_CELL = 100
LOT = 12_800
MOST_CELLS = 1 << 15
SUBSPACES = 48
WORDS = 256
PROBES = 12
SURE = 4.0
BLOCK = 4096
ASK = 4096
SLOTS = 32


def kmeans(x: np.ndarray, k: int, steps: int, seed: int) -> np.ndarray:
    """Plain Lloyd steps from seeded rows; an emptied centroid restarts at a seeded row."""
    rng = np.random.default_rng(seed)
    k = min(k, len(x))
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(steps):
        near = nearest(x, c)
        count = np.bincount(near, minlength=k)
        order = np.argsort(near, kind="stable")
        held = np.flatnonzero(count)
        starts = np.concatenate([[0], np.cumsum(count)[:-1]])[held]
        c[held] = np.add.reduceat(x[order], starts, axis=0) / count[held, None]
        empty = np.flatnonzero(count == 0)
        if len(empty):
            c[empty] = x[rng.choice(len(x), len(empty))]
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    half = (c * c).sum(1) / 2
    return np.concatenate([np.argmax(x[i : i + 4096] @ c.T - half, axis=1) for i in range(0, len(x), 4096)]) if len(x) else np.zeros(0, int)


class Index:
    """Coarse centroids with the deviation of their members, and residual codebooks (one byte per sub-space)."""

    def __init__(self, sample: np.ndarray, coarse: np.ndarray, spread: np.ndarray, subspaces: int = SUBSPACES, seed: int = 7):
        dim = sample.shape[1]
        self.dim, self.parts = dim, min(subspaces, dim)
        self.bounds = np.linspace(0, dim, self.parts + 1).astype(int)
        self.coarse = coarse
        self.half = (coarse * coarse).sum(1) / 2
        rest = sample - coarse[nearest(sample, coarse)]
        # directions are spread over this many dimensions
        gram = rest.T @ rest
        self.spread_over = float(max(1.0, np.trace(gram) ** 2 / max(float((gram * gram).sum()), 1e-30)))
        self.deviation = (np.sqrt(spread) / math.sqrt(self.spread_over)).astype(np.float32)
        self.books = [kmeans(rest[:, a:b], WORDS, 6, seed + 1 + i) for i, (a, b) in enumerate(zip(self.bounds, self.bounds[1:]))]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Cell, codes, the stretch that makes estimates unbiased (codewords are means, so too short), and the deviation left."""
        cell = nearest(x, self.coarse)
        rest = x - self.coarse[cell]
        codes = np.stack([nearest(rest[:, a:b], book) for a, b, book in zip(self.bounds, self.bounds[1:], self.books)], axis=1)
        coded = np.concatenate([book[codes[:, i]] for i, book in enumerate(self.books)], axis=1)
        along = (rest * coded).sum(1)
        stretch = np.clip(np.where(along > 1e-9, (rest * rest).sum(1) / np.maximum(along, 1e-9), 1.0), 0, 8).astype(np.float32)
        left = np.linalg.norm(rest - stretch[:, None] * coded, axis=1) / math.sqrt(self.spread_over)
        return cell, codes.astype(np.uint8), stretch, left.astype(np.float32)

    def probes(self, x: np.ndarray, n: int) -> np.ndarray:
        """The n cells nearest to each vector."""
        n = min(n, len(self.coarse))
        return np.argpartition(self.half - x @ self.coarse.T, n - 1, axis=1)[:, :n]

    def further(self, x: np.ndarray, n: int, reach: np.ndarray) -> list[np.ndarray]:
        """Cells beyond the n nearest whose members could have an inner product of ``reach``."""
        dots = x @ self.coarse.T
        bound = dots + SURE * np.linalg.norm(x, axis=1)[:, None] * self.deviation[None, :]
        n = min(n, len(self.coarse))
        near = np.argpartition(self.half - dots, n - 1, axis=1)[:, :n]
        open_ = bound >= reach[:, None] - 1e-6
        np.put_along_axis(open_, near, False, 1)
        return [np.flatnonzero(row).astype(np.int32) for row in open_]

    def estimates(self, queries: np.ndarray, cell: int, codes: np.ndarray, stretch: np.ndarray) -> np.ndarray:
        """Asymmetric: exact query against coded vectors, through one table per query and sub-space."""
        out = np.zeros((len(codes), len(queries)), np.float32)
        for i, (a, b, book) in enumerate(zip(self.bounds, self.bounds[1:], self.books)):
            out += (book @ queries[:, a:b].T)[codes[:, i]]
        out *= stretch[:, None]
        out += (queries @ self.coarse[cell])[None, :]
        return out.T


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float32, copy=False).reshape(-1, dim) if len(column) else np.zeros((0, dim), np.float32)


def _pack(x: np.ndarray) -> pa.Array:
    """Vectors as bytes: half floats where those hold every value, else floats."""
    with np.errstate(over="ignore"):
        half = x.astype(np.float16)
    fits = (half.astype(np.float32) == x).all(axis=1)
    return pa.array([h.tobytes() if f else v.tobytes() for f, h, v in zip(fits, half, x)], pa.binary())


def _unpack(column: pa.Array, dim: int) -> np.ndarray:
    values = column.to_pylist()
    if values and all(len(v) == 2 * dim for v in values):
        return np.frombuffer(b"".join(values), np.float16).reshape(-1, dim).astype(np.float32)
    return np.stack([np.frombuffer(v, np.float16 if len(v) == 2 * dim else np.float32).astype(np.float32) for v in values]) if values else np.zeros((0, dim), np.float32)


def folded(df: DataFrame, pos: str, vector: str, k: int) -> tuple[DataFrame, int]:
    """(key, v, members) and the length: distinct vectors, key the smallest position, members the k + 1 smallest (k at least 1)."""
    base = df.select(F.col(pos).cast("bigint").alias("pos"), F.col(vector).cast("array<float>").alias("v")).where("pos IS NOT NULL AND size(v) > 0 AND NOT exists(v, x -> x IS NULL OR isnan(x))")
    length = base.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").first()
    base = base.where(F.size("v") == (length.n if length else 0))
    # equal vectors have equal hashes; two hashes of 64 bits stand for the vector in the shuffle of positions
    keyed = base.select("pos", F.xxhash64("v").alias("h"), F.xxhash64(F.reverse("v")).alias("h2")).distinct()
    # the k + 1 smallest of each slot, then of all: no task meets all copies of a vector
    slot = Window.partitionBy("h", "h2", F.pmod(F.xxhash64("pos"), F.lit(SLOTS))).orderBy("pos")
    first = keyed.withColumn("r", F.row_number().over(slot)).where(F.col("r") <= k + 1)
    whole = Window.partitionBy("h", "h2").orderBy("pos")
    members = first.withColumn("r", F.row_number().over(whole)).where(F.col("r") <= k + 1).groupBy("h", "h2").agg(F.array_sort(F.collect_list("pos")).alias("members"))
    classes = members.select(F.element_at("members", 1).alias("key"), "members")
    return base.join(classes, F.col("pos") == F.col("key")).select("key", "v", "members").dropDuplicates(["key"]), (length.n if length else 0)


def _sampled(vectors: DataFrame, n: int, wanted: int) -> DataFrame:
    """About ``wanted`` vectors and a few more, those of smallest hash."""
    share = min(1.0, 1.1 * wanted / max(n, 1) + 50 / max(n, 1))
    return vectors.where(F.pmod(F.xxhash64("key"), F.lit(1_000_000)) < math.ceil(share * 1_000_000)).select("key", "v")


def fit(vectors: DataFrame, n: int, dim: int, sample: int = SAMPLE, per_cell: int = PER_CELL, lot: int = LOT, subspaces: int = SUBSPACES, most_cells: int = MOST_CELLS) -> Index:
    """The index: upper centroids and codebooks from at most ``sample`` vectors, cells from ``per_cell`` vectors each."""
    rows = _sampled(vectors, n, sample).orderBy(F.xxhash64("key"), "key").limit(sample).select("v").toArrow().column("v").combine_chunks()
    own = _matrix(rows, dim)
    cells = max(1, min(most_cells, round(math.sqrt(n))))
    upper = kmeans(own, max(1, round(math.sqrt(cells))), 8, 7)
    shared = vectors.sparkSession.sparkContext.broadcast(upper)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("v"), dim)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(nearest(x, shared.value).astype(np.int32)), _pack(x)], names=["key", "top", "b"])

    placed = cut(_sampled(vectors, n, per_cell * cells).mapInArrow(place, "key bigint, top int, b binary"), "sampled")
    # at most as many rows as upper cells; a crowded one fits in several lots, none larger than about ``lot``
    sizes = {r.top: r.n for r in placed.groupBy("top").agg(F.count("*").alias("n")).collect()}
    lots = F.create_map(*(F.lit(x) for top, size in sizes.items() for x in (top, -(-size // lot))))
    parted = placed.withColumn("lot", F.pmod(F.xxhash64("key"), lots[F.col("top")]).cast("int"))

    def cells_of(table: pa.Table) -> pa.Table:
        table = table.sort_by("key")
        x = _unpack(table["b"].combine_chunks(), dim)
        c = kmeans(x, max(1, len(x) // per_cell), 8, 7)
        near = nearest(x, c)
        far = np.bincount(near, ((x - c[near]) ** 2).sum(1), minlength=len(c)) / np.maximum(np.bincount(near, minlength=len(c)), 1)
        n_ = len(c)
        return pa.table([table["top"][:1].combine_chunks().take(pa.array([0] * n_)), table["lot"][:1].combine_chunks().take(pa.array([0] * n_)), pa.array(far), pa.array([v.tobytes() for v in c.astype(np.float32)], pa.binary())], names=["top", "lot", "far", "c"])

    found = parted.groupBy("top", "lot").applyInArrow(cells_of, "top int, lot int, far double, c binary").toArrow().sort_by([("top", "ascending"), ("lot", "ascending"), ("c", "ascending")])
    drop_cut(placed)
    coarse = np.frombuffer(b"".join(found["c"].to_pylist()), np.float32).reshape(-1, dim)
    return Index(own, coarse, found["far"].to_numpy(), subspaces)


class Shelves:
    """Where cells lie: cell -> its first shelf and how many it takes."""

    def __init__(self, sizes: np.ndarray, block: int):
        self.first, self.taken = np.zeros(len(sizes), np.int32), np.ones(len(sizes), np.int32)
        shelf, held = 0, 0
        for cell, size in enumerate(sizes.tolist()):
            if held and held + size > block:
                shelf, held = shelf + 1, 0
            self.first[cell] = shelf
            held += size
            if held > block:
                self.taken[cell] = -(-held // block)
                shelf, held = shelf + int(self.taken[cell]), 0
        self.count = shelf + 1

    def of(self, cells: np.ndarray) -> dict[int, list[int]]:
        """Shelves of the cells asked, with the cells on each."""
        out: dict[int, list[int]] = {}
        for cell, first, taken in zip(cells.tolist(), self.first[cells].tolist(), self.taken[cells].tolist()):
            for shelf in range(first, first + taken):
                out.setdefault(shelf, []).append(cell)
        return out


def _pieces(batches: Iterator[pa.RecordBatch], rows: int = 2000) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def stocked(vectors: DataFrame, shared, shelves, dim: int) -> DataFrame:
    """(shelf, rows): the coded vectors of each shelf with their exact values, one row a shelf."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, where = shared.value, shelves.value
        for batch in _pieces(batches):
            x = _matrix(batch.column("v"), dim)
            cell, codes, stretch, left = index.encode(x)
            keys = batch.column("key").to_numpy()
            part = (keys * 0x9E3779B1 >> 16) % where.taken[cell]
            data = pa.array([s.tobytes() + e.tobytes() + c.tobytes() for s, e, c in zip(stretch, left, codes)], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array((where.first[cell] + part).astype(np.int32)), pa.array(cell.astype(np.int32)), batch.column("key"), data, _pack(x)], names=["shelf", "cell", "key", "code", "b"])

    rows = vectors.select("key", "v").mapInArrow(code, "shelf int, cell int, key bigint, code binary, b binary")
    return rows.groupBy("shelf").agg(F.collect_list(F.struct("cell", "key", "code", "b")).alias("rows"))


def searched(stock: DataFrame, asks: DataFrame, counts: dict[int, int], shared, dim: int, k: int, least: float | None) -> DataFrame:
    """(q, c, sim): per shelf and query of ``asks`` (shelf, key, b, cells) its k best, exactly measured."""
    spark = stock.sparkSession
    if not counts:
        return spark.createDataFrame([], "q bigint, c bigint, sim double")
    lots = {shelf: max(1, -(-n // ASK)) for shelf, n in counts.items()}
    # one row a shelf: the root of the number of vectors, or the vectors over a block
    table = spark.createDataFrame(list(lots.items()), "shelf int, lots int")
    parts = max(1, sum(lots.values()))
    queries = asks.join(F.broadcast(table), "shelf").withColumn("lot", F.pmod(F.xxhash64("key"), "lots").cast("int")).groupBy("shelf", "lot").agg(F.collect_list(F.struct("key", "b", "cells")).alias("queries"))
    held = stock.join(F.broadcast(table), "shelf").withColumn("lot", F.explode(F.sequence(F.lit(0), F.col("lots") - 1))).select("shelf", "lot", "rows")
    # few rows to a partition, as Python gets many rows of one at once
    pairs = queries.repartition(parts, "shelf", "lot").join(held.repartition(parts, "shelf", "lot").hint("merge"), ["shelf", "lot"]).select("queries", "rows")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                yield from _scan(index, batch.column("queries")[i].values, batch.column("rows")[i].values, dim, k, least)

    return pairs.mapInArrow(scan, "q bigint, c bigint, sim double")


def _scan(index: Index, asked: pa.StructArray, held: pa.StructArray, dim: int, k: int, least: float | None) -> Iterator[pa.RecordBatch]:
    """Queries of one lot against one shelf."""
    cell = held.field("cell").to_numpy()
    order = np.argsort(cell, kind="stable")
    held, cell = held.take(pa.array(order)), cell[order]
    key = held.field("key").to_numpy()
    x = _unpack(held.field("b"), dim)
    data = np.frombuffer(b"".join(held.field("code").to_pylist()), np.uint8).reshape(len(key), -1)
    stretch, left, codes = data[:, :4].copy().view(np.float32)[:, 0], data[:, 4:8].copy().view(np.float32)[:, 0], data[:, 8:]
    lists = asked.field("cells")
    for at in range(0, len(asked), 1024):
        part = asked.slice(at, 1024)
        qk, q = part.field("key").to_numpy(), _unpack(part.field("b"), dim)
        length = np.linalg.norm(q, axis=1)
        wanted = lists.slice(at, 1024)
        who, what = np.repeat(np.arange(len(qk)), np.diff(wanted.offsets.to_numpy())), wanted.flatten().to_numpy()
        by = np.argsort(what, kind="stable")
        who, what = who[by], what[by]
        best = np.full((len(qk), k), -np.inf)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for c in np.unique(what):
            rows = who[np.searchsorted(what, c) : np.searchsorted(what, c, "right")]
            a, b = np.searchsorted(cell, c), np.searchsorted(cell, c, "right")
            if a == b:
                continue
            est = index.estimates(q[rows], int(c), codes[a:b], stretch[a:b])
            slack = SURE * length[rows][:, None] * left[None, a:b]
            own = qk[rows][:, None] == key[None, a:b]
            reach = best[rows, k - 1]
            if least is not None:
                reach = np.maximum(reach, least)
            if b - a > k + 1:
                low = np.where(own, -np.inf, est - slack)
                reach = np.maximum(reach, np.partition(low, b - a - k, axis=1)[:, b - a - k])
            r, s = np.nonzero((est + slack >= reach[:, None] - 1e-6) & ~own)
            if not len(r):
                continue
            value = _products(q[rows], x[a:b], r, s)
            if least is not None:
                r, s, value = r[value >= least], s[value >= least], value[value >= least]
                if not len(r):
                    continue
            found.append((rows[r], a + s, value))
            # the k best so far of the queries that found any
            some, short = np.unique(r, return_inverse=True)
            new = np.full((len(some), b - a), -np.inf)
            new[short, s] = value
            both = np.concatenate([best[rows[some]], new], axis=1)
            best[rows[some]] = -np.sort(np.partition(-both, k - 1, axis=1)[:, :k], axis=1)
        if found:
            r, s, value = (np.concatenate(f) for f in zip(*found))
            keep = value >= best[r, k - 1]
            r, s, value = r[keep], s[keep], value[keep]
            order = np.lexsort((key[s], -value, r))
            r, s, value = r[order], s[order], value[order]
            few = np.arange(len(r)) - np.searchsorted(r, r) < k
            yield pa.RecordBatch.from_arrays([pa.array(qk[r[few]]), pa.array(key[s[few]]), pa.array(value[few])], names=["q", "c", "sim"])


def _products(q: np.ndarray, x: np.ndarray, r: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Inner products in doubles of the rows r of q with the rows s of x: as one product where many are wanted."""
    if len(r) * 30 > len(q) * len(x):
        return np.round(q.astype(float) @ x.astype(float).T, 12)[r, s]
    out = [np.einsum("ij,ij->i", q[r[i : i + 4096]].astype(float), x[s[i : i + 4096]].astype(float)) for i in range(0, len(r), 4096)]
    return np.round(np.concatenate(out), 12)


def ranked(ways: DataFrame, k: int) -> DataFrame:
    return ways.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("sim"), "c"))).where(F.col("r") <= k)


def found_ways(vectors: DataFrame, n: int, dim: int, k: int, least: float | None, probes: int, block: int, **fitting) -> DataFrame:
    """(q, c, sim): for every distinct vector its nearest others, by the index."""
    spark = vectors.sparkSession
    index = fit(vectors, n, dim, **fitting)
    shared = spark.sparkContext.broadcast(index)

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            x = _matrix(batch.column("v"), dim)
            yield pa.RecordBatch.from_arrays([pa.array(nearest(x, shared.value.coarse).astype(np.int32)), pa.array(list(shared.value.probes(x, probes).astype(np.int32)), pa.list_(pa.int32()))], names=["cell", "near"])

    surveyed = cut(vectors.select("v").mapInArrow(survey, "cell int, near array<int>"), "survey")
    sizes = np.zeros(len(index.coarse), np.int64)
    for r in surveyed.groupBy("cell").agg(F.count("*").alias("n")).collect():  # one row a cell
        sizes[r.cell] = r.n
    shelves = spark.sparkContext.broadcast(Shelves(sizes, block))
    stock = cut(stocked(vectors, shared, shelves, dim), "stock")

    def shelved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked_of = np.zeros(shelves.value.count, np.int64)
        for batch in batches:
            for cells in batch.column("near").to_pylist():
                for shelf in shelves.value.of(np.array(cells, np.int64)):
                    asked_of[shelf] += 1
        at = np.flatnonzero(asked_of)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(asked_of[at])], names=["shelf", "n"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            x = _matrix(batch.column("v"), dim)
            yield _asked(batch.column("key"), x, list(shared.value.probes(x, probes)), shelves.value)

    def more(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            x = _matrix(batch.column("v"), dim)
            reach = batch.column("kth").to_numpy(zero_copy_only=False).astype(float)
            reach = np.where(np.isnan(reach), -np.inf if least is None else least, reach)
            yield _asked(batch.column("key"), x, shared.value.further(x, probes, reach), shelves.value)

    def could(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            x = _matrix(batch.column("v"), dim)
            far = shared.value.further(x, probes, np.full(len(x), least))
            yield batch.filter(pa.array([len(f) > 0 for f in far], pa.bool_()))

    def per_shelf(rows: DataFrame) -> dict[int, int]:
        return {r.shelf: r.n for r in rows.groupBy("shelf").agg(F.sum("n").alias("n")).collect()}

    asked = "shelf int, key bigint, b binary, cells array<int>"
    plain = vectors.select("key", "v")
    first = cut(searched(stock, plain.mapInArrow(ask, asked), per_shelf(surveyed.select("near").mapInArrow(shelved, "shelf int, n bigint")), shared, dim, k, least), "ways")
    drop_cut(surveyed)
    # the k-th best so far, from either side of what was found
    both = first.unionByName(first.select(F.col("c").alias("q"), F.col("q").alias("c"), "sim")).distinct()
    kth = ranked(both, k).where(F.col("r") == k).select(F.col("q").alias("key"), F.col("sim").alias("kth"))
    left = plain if least is None else plain.mapInArrow(could, "key bigint, v array<float>")
    rest = cut(left.join(kth, "key", "left").mapInArrow(more, asked), "asks")
    second = cut(searched(stock, rest, per_shelf(rest.select("shelf", F.lit(1).alias("n"))), shared, dim, k, least), "ways")
    drop_cut(rest)
    drop_cut(stock)
    every = first.unionByName(second)
    return every.unionByName(every.select(F.col("c").alias("q"), F.col("q").alias("c"), "sim")).distinct()


def _asked(keys: pa.Array, x: np.ndarray, cells: list[np.ndarray], shelves: Shelves) -> pa.RecordBatch:
    rows, shelf, lists = [], [], []
    for i, wanted in enumerate(cells):
        for s, c in shelves.of(wanted).items():
            rows.append(i)
            shelf.append(s)
            lists.append(c)
    rows = pa.array(rows, pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(shelf, pa.int32()), keys.take(rows), _pack(x).take(rows), pa.array(lists, pa.list_(pa.int32()))], names=["shelf", "key", "b", "cells"])


def neighbours(df: DataFrame, k: int = 5, pos: str = "pos", vector: str = "embedding", least: float | None = None, probes: int = PROBES, block: int = BLOCK, **fitting) -> DataFrame:
    """(pos, other, similarity, rank): the k most similar others of every vector, ties to the smaller position.

    With ``least``, only those at least that similar are wanted.
    """
    spark = df.sparkSession
    schema = "pos bigint, other bigint, similarity double, rank int"
    rows, dim = folded(df, pos, vector, k)
    vectors = cut(rows, "vectors")
    n = vectors.count()
    if not n:
        return spark.createDataFrame([], schema)
    # k others are enough: each stands for at least one position, and is met from both sides
    ways = found_ways(vectors, n, dim, k, least, probes, block, **fitting).select("q", "c", F.col("sim").alias("similarity"))
    own = vectors.select(F.col("key").alias("q"), F.col("key").alias("c"), F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")).alias("similarity")).join(vectors.where("size(members) > 1").select(F.col("key").alias("q")), "q", "left_semi")
    ways = ways.unionByName(own)
    if least is not None:
        ways = ways.where(F.col("similarity") >= least)
    # per distinct vector: its best others, spread over their members; k + 1 as a member may meet itself
    spread = ways.join(vectors.select(F.col("key").alias("c"), "members"), "c").select("q", F.explode("members").alias("other"), "similarity")
    best = Window.partitionBy("q").orderBy(F.desc("similarity"), "other")
    lists = spread.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).select("q", "other", "similarity")
    # back to every row: rows of equal vectors share a list of at most k + 1 entries, salted as they may be many
    lists = cut(lists, "lists")
    single = vectors.where("size(members) = 1").select(F.col("key").alias("q"))
    alone = lists.join(single, "q", "left_semi").select("q", F.col("q").alias("pos"), "other", "similarity")
    shared = lists.join(vectors.where("size(members) > 1").select(F.col("key").alias("q")), "q", "left_semi").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SLOTS - 1))))
    copies = positions(df, pos, vector, vectors).withColumn("salt", F.pmod(F.xxhash64("pos"), F.lit(SLOTS)).cast("int"))
    every = alone.unionByName(shared.join(copies, ["q", "salt"]).select("q", "pos", "other", "similarity"))
    per = Window.partitionBy("pos").orderBy(F.desc("similarity"), "other")
    out = every.where("pos <> other").withColumn("rank", F.row_number().over(per)).where(F.col("rank") <= k)
    return out.select("pos", "other", "similarity", "rank")


def positions(df: DataFrame, pos: str, vector: str, vectors: DataFrame) -> DataFrame:
    """(q, pos): the positions of vectors that occur more than once, with the key of their vector."""
    several = vectors.where("size(members) > 1").select(F.col("key").alias("q"), F.xxhash64("v").alias("h"), F.xxhash64(F.reverse("v")).alias("h2"))
    base = df.select(F.col(pos).cast("bigint").alias("pos"), F.col(vector).cast("array<float>").alias("v")).where("pos IS NOT NULL AND size(v) > 0")
    hashed = base.select("pos", F.xxhash64("v").alias("h"), F.xxhash64(F.reverse("v")).alias("h2")).distinct()
    return hashed.join(several, ["h", "h2"]).select("q", "pos")


def similar_pairs(df: DataFrame, least: float = 0.8, k: int = 5, **kw) -> DataFrame:
    """(pos_a, pos_b), pos_a < pos_b: pairs of which one is among the k most similar of the other."""
    rows = neighbours(df, k, least=least, **kw)
    return rows.select(F.least("pos", "other").alias("pos_a"), F.greatest("pos", "other").alias("pos_b")).distinct()
