"""Near-duplicate records with small edits (problem 4): an exact similarity join.

Similarity is that of word multisets, |A n B| / |A u B|; its complement is a metric. The method
named for this problem, pivots with Voronoi regions and triangle-inequality windows, is in
``souche.llm.voronoi``: exact, but with windows twice as wide as the radius (0.6 of a distance
that cannot exceed 1) it copies nearly every text into nearly every region, so it joins what
this module leaves: regions too large for one task. README has the figures.

The regions here are made by words instead of pivots, and split recursively and exactly:

1. Texts are deduplicated as strings (copies never reach the join), cut into words in Arrow
   batches, and hashed to 64 bits. A fixed-size sketch (2^18 counters, whatever the data's
   size) holds how many texts have each word; it alone is broadcast. Words of a text are
   ordered by that count, rarest first, a total order shared by all texts.
2. A text with n words may miss at most e = n - ceil(t n) of them, so two similar texts meet
   at their first common word, at most e words deep. That word is a region. Where the sketch
   expects more than ``crowd`` texts in it, it splits by the next common word, which the
   remaining misses keep as close, and so on to ``depth`` words.
3. A region is joined from one sorted shuffle, in a vectorised sweep: lengths, misses so far and
   a 256-bit parity of the words (its difference is never more than the words' difference)
   leave few pairs. A region over ``region_rows`` rows goes on to the pivots, whose regions
   join in salted blocks; regions that hold a great share of all texts go there without the shuffle.
   ``depth`` does not grow with n: each level multiplies a text's regions by its misses, where pivots cost no more.
4. Pairs are checked exactly on the words, then spread over the ids that hold the texts.

Defined edge cases: null and empty texts and texts without words have no partner; repeated
rows of an id count once; texts equal as strings are no pair, texts of equal words are; an id
is never paired with itself; an empty table gives no rows; extra columns are ignored. Hashes of words are 64 bits:
two different words of one text pair would have to collide to change a similarity.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souche.functions.text import fold_py, raw_words_py
from souche.session import cut

SKETCH_BITS = 18
STEP = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1
CROWD = 800
DEPTH = 3
REGION_ROWS = 5000
GIANT_SAMPLE, GIANT_SHARE = 4096, 0.01

TOKENS = "genre string, text_key string, sig binary, n int, words array<bigint>, mults array<int>"
REGIONS = "region bigint, sig binary, n int, miss int, parity binary"
PAIRS = "region bigint, a binary, b binary, n int, miss int, parity binary"


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """Batches in smaller pieces, so that what a piece grows to stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def multisets(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of lists of ``sizes`` laid end to end: the distinct members of each in order, how often each occurs, and where each list begins."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    return hashes[at], np.diff(np.append(at, len(hashes))).astype(np.int32), np.searchsorted(row[at], np.arange(len(sizes) + 1))


def tokens(texts: DataFrame) -> DataFrame:
    """(genre, text_key, sig, n, words, mults) of (genre, text), one row per distinct text with words."""

    def cut_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, int] = {}
        for batch in _parts(batches):
            lists = [raw_words_py(body) for body in batch.column(2).to_pylist()]
            if len(memo) > 100_000:
                memo.clear()
            flat = []
            for words in lists:
                for word in words:
                    h = memo.get(word)
                    if h is None:
                        h = memo[word] = xxhash.xxh3_64_intdigest(fold_py(word)) - (1 << 63)
                    flat.append(h)
            w, m, ends = multisets(np.array(flat, np.int64), np.array([len(x) for x in lists], np.int64))
            out: list[list] = [[], [], [], [], [], []]
            for i, (genre, key) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                own, times = w[ends[i] : ends[i + 1]], m[ends[i] : ends[i + 1]]
                if len(own):
                    for column, value in zip(out, (genre, key, xxhash.xxh3_128_digest(genre.encode() + own.tobytes() + times.tobytes()), len(lists[i]), own, times)):
                        column.append(value)
            kinds = (pa.string(), pa.string(), pa.binary(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=["genre", "text_key", "sig", "n", "words", "mults"])

    one = texts.groupBy("genre", "text").agg(F.lit(1).alias("x"))  # copies combine before the shuffle
    return one.select("genre", F.md5("text").alias("text_key"), "text").mapInArrow(cut_words, TOKENS)


def word_sketch(toks: DataFrame) -> tuple[np.ndarray, int]:
    """Texts per word bucket, and texts; 2^18 counters at most come to the driver."""
    size = 1 << SKETCH_BITS
    bucket = F.expr(f"word & {size - 1}").cast("int")
    rows = toks.select(F.explode("words").alias("word")).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n")).toPandas()
    sketch = np.zeros(size, np.float64)
    sketch[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return sketch, toks.count()


def region_rows(words: np.ndarray, mults: np.ndarray, n: int, sketch: np.ndarray, texts: int, least: float, crowd: float, depth: int, genre: str = "") -> list[tuple[int, int]]:
    """(region, misses) of one text; any partner of its genre shares a region with it."""
    df = sketch[words & (len(sketch) - 1)]
    spare = n - math.ceil(least * n - 1e-9)
    order = np.lexsort((words, df))
    w, m, f = words[order].tolist(), mults[order].tolist(), df[order].tolist()
    start, out = [0], []
    for k in m:
        start.append(start[-1] + k)
    count = len(w)
    stack = [(-1, xxhash.xxh3_64_intdigest(genre), float(texts), 0, 0)]
    while stack:
        at, region, size, common, level = stack.pop()
        for j in range(at + 1, count):
            miss = start[j] - common
            if miss > spare:
                break
            key = ((region ^ (w[j] & MASK)) * STEP + level + 1) & MASK
            key ^= key >> 29
            now = size * f[j] / texts
            if now <= crowd or level + 1 >= depth:
                out.append((key - (1 << 63), max(miss, 0)))
            else:
                stack.append((j, key, now, common + m[j], level + 1))
        if level and common >= n - spare:  # nothing else need be common
            key = ((region ^ STEP) * STEP) & MASK
            out.append((key - (1 << 63), n - common))
    return out


def parities(words: np.ndarray, mults: np.ndarray, row: np.ndarray, rows: int) -> list[bytes]:
    """Per row 256 parities of its multiset's members, so that differing bits never outnumber differing members."""
    each = np.repeat(words.view(np.uint64), mults)
    nth = np.arange(len(each), dtype=np.uint64) - np.repeat(np.cumsum(mults) - mults, mults).astype(np.uint64)
    bits = ((each + nth * np.uint64(STEP)) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(56)
    counts = np.bincount(np.repeat(row, mults) * 256 + bits.astype(np.int64), minlength=rows * 256)
    return [x.tobytes() for x in np.packbits((counts & 1).astype(np.uint8).reshape(rows, 256), axis=1)]


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    return column.offsets.to_numpy(), column.values.to_numpy()


def regions(toks: DataFrame, shared, texts: int, least: float, crowd: float, depth: int) -> DataFrame:
    """REGIONS rows: each text in all its regions; ``shared`` is the broadcast word sketch."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in _parts(batches):
            sigs, ns, genres = (batch.column(c).to_pylist() for c in ("sig", "n", "genre"))
            (ends, words), (_, mults) = _lists(batch.column("words")), _lists(batch.column("mults"))
            first = int(ends[0])
            words, mults, ends = words[first : ends[-1]], mults[first : ends[-1]], ends - first
            bits = parities(words, mults, np.repeat(np.arange(len(ns)), np.diff(ends)), len(ns))
            key, miss, rows = [], [], []
            for i, n in enumerate(ns):
                w, m = words[ends[i] : ends[i + 1]], mults[ends[i] : ends[i + 1]]
                found = region_rows(w, m, n, counts, texts, least, crowd, depth, genres[i])
                rows += [i] * len(found)
                for k, x in found:
                    key.append(k)
                    miss.append(x)
            rows = pa.array(rows, pa.int32())
            cols = [pa.array(key, pa.int64()), pa.array(sigs, pa.binary()).take(rows), pa.array(ns, pa.int32()).take(rows), pa.array(miss, pa.int32()), pa.array(bits, pa.binary()).take(rows)]
            table = pa.RecordBatch.from_arrays(cols, names=["region", "sig", "n", "miss", "parity"])
            for at in range(0, table.num_rows, 20_000):
                yield table.slice(at, 20_000)

    return toks.select("genre", "sig", "n", "words", "mults").mapInArrow(place, REGIONS)


def crowded_regions(toks: DataFrame, shared, texts: int, least: float, crowd: float, depth: int, most: int) -> DataFrame:
    """Regions that hold a great share of all texts, as seen from those of ``GIANT_SAMPLE`` of them.

    This only decides where work is placed: their rows go to the pivots without passing through one task. A region over
    ``most`` that is not seen here is found, and passed on, where it is joined. At most 1 / GIANT_SHARE such regions for each
    region of a text: a small table.
    """
    few = toks.where(F.pmod(F.xxhash64("sig"), F.lit(1_000_000)) < math.ceil(1_000_000 * min(1.0, GIANT_SAMPLE / max(texts, 1))))
    seen = regions(few, shared, texts, least, crowd, depth).groupBy("region").agg(F.count_distinct("sig").alias("n"))
    share = max(GIANT_SHARE, 4 * most / max(texts, 1))
    return cut(seen.where(F.col("n") > share * min(texts, GIANT_SAMPLE)).select("region"), "giants")


def _sweep(region, n, miss, bits, least) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of rows in one region that may be similar; rows are sorted by region and length."""
    left, right = [], []
    at = np.arange(len(region))
    for d in range(1, len(region)):
        at = at[at + d < len(region)]
        # lengths rise within a region: once the partner is too long, so are all after it
        at = at[(region[at] == region[at + d]) & (n[at] >= least * n[at + d] - 1e-9)]
        if not len(at):
            break
        a, b = at, at + d
        room = (1 - least) / (1 + least) * (n[a] + n[b]) + 1e-9
        ok = miss[a] + miss[b] <= room
        a, b, room = a[ok], b[ok], room[ok]
        ok = np.bitwise_count(bits[a] ^ bits[b]).sum(1) <= room
        left.append(a[ok])
        right.append(b[ok])
    return (np.concatenate(left), np.concatenate(right)) if left else (at[:0], at[:0])


def join_regions(rows: DataFrame, least: float, most: int) -> DataFrame:
    """Candidate pairs (a, b) of each region; the rows of regions over ``most`` come back with b null."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, wide = None, None  # rows of the last region so far; the region now passed on

        def emit(table: pa.Table) -> Iterator[pa.RecordBatch]:
            if not table.num_rows:
                return
            region = table["region"].to_numpy()
            sig = table["sig"].combine_chunks()
            n, miss = table["n"].to_numpy(), table["miss"].to_numpy()
            bits = np.frombuffer(b"".join(table["parity"].to_pylist()), np.uint64).reshape(len(region), 4)
            a, b = _sweep(region, n, miss, bits, least)
            if not len(a):
                return
            pairs = {(x, y) if x < y else (y, x) for x, y in zip(sig.take(pa.array(a)).to_pylist(), sig.take(pa.array(b)).to_pylist()) if x != y}
            if not pairs:
                return
            x, y = zip(*pairs)
            nulls = pa.nulls(len(x), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.nulls(len(x), pa.int64()), pa.array(x, pa.binary()), pa.array(y, pa.binary()), nulls, nulls, pa.nulls(len(x), pa.binary())], names=["region", "a", "b", "n", "miss", "parity"])

        def onward(table: pa.Table) -> Iterator[pa.RecordBatch]:
            t = pa.table([table["region"], table["sig"], pa.nulls(table.num_rows, pa.binary()), table["n"], table["miss"], table["parity"]], names=["region", "a", "b", "n", "miss", "parity"])
            yield from t.combine_chunks().to_batches()

        for batch in batches:
            table = pa.Table.from_batches([batch])
            if kept is not None:
                table = pa.concat_tables([kept, table])
            region = table["region"].to_numpy()
            if not len(region):
                continue
            if wide is not None:
                done = int(np.searchsorted(region, wide, "right"))
                yield from onward(table.slice(0, done))
                if done < len(region):
                    wide = None
                table, region, kept = table.slice(done), region[done:], None
                if not len(region):
                    continue
            first = int(np.searchsorted(region, region[-1], "left"))
            yield from _within(table.slice(0, first), most, emit, onward)
            kept = table.slice(first)
            if kept.num_rows > most:
                yield from onward(kept)
                wide, kept = int(region[-1]), None
        if kept is not None:
            yield from emit(kept)

    return rows.repartition("region").sortWithinPartitions("region", "n").mapInArrow(join, PAIRS)


def _within(table: pa.Table, most: int, emit, onward) -> Iterator[pa.RecordBatch]:
    region = table["region"].to_numpy()
    if not len(region):
        return
    keys, counts = np.unique(region, return_counts=True)
    large = np.isin(region, keys[counts > most])
    if large.any():
        yield from onward(table.filter(pa.array(large)))
        table = table.filter(pa.array(~large))
    yield from emit(table)


def verify(pairs: DataFrame, toks: DataFrame, least: float) -> DataFrame:
    """(a, b, similarity): pairs of word multisets at least ``least`` similar, exactly."""
    one = toks.select("sig", "words", "mults")
    left = one.select(F.col("sig").alias("a"), F.col("words").alias("wa"), F.col("mults").alias("ma"))
    right = one.select(F.col("sig").alias("b"), F.col("words").alias("wb"), F.col("mults").alias("mb"))
    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "wa", "ma", "wb", "mb")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (ea, wa), (_, ma), (eb, wb), (_, mb) = (_lists(batch.column(c)) for c in ("wa", "ma", "wb", "mb"))
            value = np.zeros(batch.num_rows)
            for i in range(batch.num_rows):
                a, b = slice(ea[i], ea[i + 1]), slice(eb[i], eb[i + 1])
                _, x, y = np.intersect1d(wa[a], wb[b], assume_unique=True, return_indices=True)
                both = int(np.minimum(ma[a][x], mb[b][y]).sum())
                value[i] = both / (int(ma[a].sum()) + int(mb[b].sum()) - both)
            keep = pa.array(value >= least)
            out = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(value)], names=["a", "b", "similarity"])
            yield out.filter(keep)

    return rows.mapInArrow(measure, "a binary, b binary, similarity double")


def similar_texts(texts: DataFrame, least: float = 0.8, crowd: float = CROWD, depth: int = DEPTH, most: float = REGION_ROWS) -> tuple[DataFrame, DataFrame]:
    """Of (genre, text): the tokens table, and (a, b, similarity) over signatures of word multisets.

    ``most`` under 1 is a share of the texts.
    """
    from souche.llm.voronoi import join_wide

    toks = cut(tokens(texts.where("text <> ''")), "tokens")
    sketch, count = word_sketch(toks)
    shared = toks.sparkSession.sparkContext.broadcast(sketch)
    most = int(most) if most >= 1 else max(10, int(most * count))
    rows = regions(toks, shared, count, least, crowd, depth)
    giants = crowded_regions(toks, shared, count, least, crowd, depth, most)
    giant = not giants.isEmpty()
    found = cut(join_regions(rows.join(F.broadcast(giants), "region", "left_anti") if giant else rows, least, most), "candidates")
    pairs = found.where("b IS NOT NULL").select("a", "b")
    wide = found.where("b IS NULL").select("region", F.col("a").alias("sig"), "n", "miss", "parity")
    if giant:
        wide = wide.unionByName(rows.join(F.broadcast(giants), "region", "left_semi").select("region", "sig", "n", "miss", "parity"))
    if not wide.isEmpty():
        pairs = pairs.unionByName(join_wide(wide, toks, least, most, block=REGION_ROWS))
    # texts of one signature have one row here: any of them stands for the same words
    one = toks.groupBy("sig").agg(F.first("words").alias("words"), F.first("mults").alias("mults")) if _has_twins(toks) else toks
    return toks, verify(pairs.distinct(), one, least)


def _has_twins(toks: DataFrame) -> bool:
    return not toks.groupBy("sig").agg(F.count("*").alias("n")).where("n > 1").isEmpty()


def near_pairs(records: DataFrame, least: float = 0.8, **regions_of) -> DataFrame:
    """(genre, id_a, id_b), id_a < id_b, of (genre, id, text): ids whose differing texts are similar.

    ``regions_of``: crowd, depth and most, as in ``similar_texts``; they move work between regions and pivots, not the result.
    """
    held = records.where("id IS NOT NULL AND text <> ''")
    toks, similar = similar_texts(held.select("genre", "text"), least, **regions_of)
    keys = toks.select("genre", "text_key", "sig")
    ids = held.select("genre", "id", F.md5("text").alias("text_key")).distinct()
    # signatures tied to another, and those of several texts: only their ids are ever paired
    cross = similar.select("a", "b")
    twins = keys.groupBy("sig").agg(F.count("*").alias("n")).where("n > 1").select("sig")
    twin_keys = keys.join(twins, "sig")
    same = twin_keys.alias("x").join(twin_keys.alias("y"), "sig").where("x.text_key < y.text_key").select(F.col("x.genre").alias("genre"), F.col("x.text_key").alias("ka"), F.col("y.text_key").alias("kb"))
    other = (
        cross.join(keys.select(F.col("sig").alias("a"), "genre", F.col("text_key").alias("ka")), "a")
        .join(keys.select(F.col("sig").alias("b"), F.col("text_key").alias("kb")), "b").select("genre", "ka", "kb")
    )
    both = (
        same.unionByName(other)
        .join(ids.select("genre", F.col("text_key").alias("ka"), F.col("id").alias("ia")), ["genre", "ka"])
        .join(ids.select("genre", F.col("text_key").alias("kb"), F.col("id").alias("ib")), ["genre", "kb"])
    )
    return both.where("ia <> ib").select("genre", F.least("ia", "ib").alias("id_a"), F.greatest("ia", "ib").alias("id_b")).distinct()


def near_groups(records: DataFrame, least: float = 0.8) -> DataFrame:
    """(genre, id, id_min, links): each record with its group and the number of other texts it is close to.

    Copies of a text stay one vertex (they share its links and its group).
    """
    from souche.llm.components import hash_to_min

    held = records.where("id IS NOT NULL AND text <> ''")
    toks, similar = similar_texts(held.select("genre", "text"), least)
    similar = cut(similar.select(F.hex("a").alias("a"), F.hex("b").alias("b")), "similar")
    groups = hash_to_min(similar)
    links = similar.select(F.explode(F.array("a", "b")).alias("sig")).groupBy("sig").agg(F.count("*").alias("links"))
    keys = toks.select("genre", "text_key", F.hex("sig").alias("sig"))
    ids = held.select("genre", "id", F.md5("text").alias("text_key")).distinct()
    placed = (
        ids.join(keys, ["genre", "text_key"]).join(groups.withColumnRenamed("id", "sig"), "sig", "left").join(links, "sig", "left")
        .select("genre", "id", F.coalesce("group", "sig").alias("group"), F.coalesce("links", F.lit(0)).alias("links"))
    )
    least_id = placed.groupBy("genre", "group").agg(F.min("id").alias("id_min"), F.count("*").alias("members")).where("members > 1")
    return placed.join(least_id, ["genre", "group"]).groupBy("genre", "id").agg(F.min("id_min").alias("id_min"), F.max("links").alias("links"))
