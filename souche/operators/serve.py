"""Lookups: search, autocomplete, record sheets, comparison, statistics, candidate scoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souche.functions import extract as X
from souche.functions import text as T
from souche.operators import graph, matching
from souche.session import cut

LEAST_QUERY = 2
SHOWN, SUGGESTED, TOP = 20, 10, 10

# Label -> latitude, longitude of map points.
PLACES = {
    "bretagne": (48.20, -2.93), "normandie": (49.18, 0.37), "alsace": (48.47, 7.56), "lorraine": (48.87, 6.18), "provence": (43.93, 5.72),
    "languedoc": (43.61, 3.88), "gascogne": (43.80, 0.57), "bourgogne": (47.05, 4.85), "auvergne": (45.45, 3.17), "savoie": (45.57, 6.35),
    "dauphiné": (45.19, 5.72), "poitou": (46.58, 0.34), "anjou": (47.47, -0.55), "touraine": (47.39, 0.69), "champagne": (49.04, 4.02),
    "picardie": (49.89, 2.30), "flandre": (50.85, 2.71), "pays basque": (43.29, -1.65), "catalogne": (41.83, 2.13), "jura": (46.67, 5.55),
    "franche-comté": (47.28, 6.02), "île-de-france": (48.85, 2.35), "france": (46.60, 1.88), "allemagne": (51.17, 10.45),
    "angleterre": (52.36, -1.17), "italie": (42.83, 12.83), "espagne": (40.42, -3.70), "portugal": (39.40, -8.22), "belgique": (50.85, 4.35),
    "suisse": (46.82, 8.23), "pays-bas": (52.13, 5.29), "scandinavie": (62.00, 15.00), "irlande": (53.41, -8.24), "pologne": (52.07, 19.48),
    "maghreb": (30.00, 3.00), "maroc": (31.79, -7.09), "algérie": (28.03, 1.66), "tunisie": (33.89, 9.54), "nord-pas-de-calais": (50.48, 2.79),
}
# End of the fixed values.


def keys(surnames: DataFrame, first_names: DataFrame) -> DataFrame:
    """(type, key, label): one row per name of either kind, the smallest label of copies."""
    a = surnames.groupBy(F.col("nom").alias("key")).agg(F.min("nom_original").alias("label")).select(F.lit("nom").alias("type"), "key", "label")
    b = first_names.groupBy(F.col("prenom").alias("key")).agg(F.min("prenom_original").alias("label")).select(F.lit("prenom").alias("type"), "key", "label")
    return a.unionByName(b)


def _compare(names: DataFrame, q: str) -> DataFrame | None:
    """A row for a query of two words that are a first name and a surname, in either order."""
    parts = q.split()
    if len(parts) != 2:
        return None
    a, b = parts
    ways = names.where(F.col("key").isin(a, b))
    found = ways.agg(*(F.max(F.when((F.col("type") == t) & (F.col("key") == k), F.col("label"))).alias(n) for n, t, k in (("pa", "prenom", a), ("nb", "nom", b), ("pb", "prenom", b), ("na", "nom", a))))
    straight, turned = F.col("pa").isNotNull() & F.col("nb").isNotNull(), F.col("pb").isNotNull() & F.col("na").isNotNull()
    pick = lambda x, y: F.when(straight, x).otherwise(y)
    return found.where(straight | turned).select(
        F.lit("compare").alias("type"), pick(F.lit(a), F.lit(b)).alias("key"), pick(F.col("pa"), F.col("pb")).alias("label"),
        pick(F.lit(b), F.lit(a)).alias("key2"), pick(F.col("nb"), F.col("na")).alias("label2"),
    )


def search(names: DataFrame, q: str, kind: str = "all", inside: bool = True, limit: int | None = None) -> DataFrame:
    """(type, key, label, key2, label2, rank): compare row, exact matches, then by key; at most ``limit`` of each type."""
    q = q.strip().lower()
    limit = limit or (SHOWN if inside else SUGGESTED)
    out = None
    if len(q) >= LEAST_QUERY:
        parts = []
        for t in ("nom", "prenom"):
            if kind in ("all", t):
                match = F.col("key").contains(q) if inside else F.col("key").startswith(q)
                parts.append(names.where((F.col("type") == t) & match).orderBy("key").limit(limit))
        for p in parts:
            out = p if out is None else out.unionByName(p)
        if out is not None:
            out = out.select("type", "key", "label", F.lit(None).cast("string").alias("key2"), F.lit(None).cast("string").alias("label2"))
        both = _compare(names, q) if kind == "all" else None
        if both is not None:
            out = both if out is None else out.unionByName(both)
    if out is None:
        out = names.where("false").select("type", "key", "label", F.lit(None).cast("string").alias("key2"), F.lit(None).cast("string").alias("label2"))
    first = F.when(F.col("type") == "compare", 0).when((F.col("key") == q) & F.lit(inside), 1).otherwise(2)
    kind_order = F.lit(0) if inside else F.when(F.col("type") == "nom", 1).otherwise(2)
    # at most 2 * limit + 1 rows
    return out.withColumn("rank", F.row_number().over(Window.orderBy(first, kind_order, "key", "type")))


def record(df: DataFrame, key: str, value: str) -> DataFrame:
    """The record of a key; of copies the one of largest id."""
    return df.where(F.col(key) == value.strip().lower()).orderBy(F.desc("id")).limit(1)


def group_points(names: DataFrame, group: str, geo: str, key: str) -> DataFrame:
    """(group, key, lat, lng, known): members at the place of their label ``geo``, else at the group's first known place."""
    coords = names.sparkSession.createDataFrame([(k, *v) for k, v in PLACES.items()], "g string, lat double, lng double")
    rows = names.where(F.col(group).isNotNull()).select(F.col(group).alias("group"), F.col(key).alias("key"), F.lower(F.trim(geo)).alias("g")).distinct()
    placed = rows.join(F.broadcast(coords), "g", "left")
    main = placed.where("lat IS NOT NULL").groupBy("group").agg(F.min_by(F.struct("lat", "lng"), "key").alias("main"))
    return placed.join(main, "group", "left").select("group", "key", F.coalesce("lat", "main.lat").alias("lat"), F.coalesce("lng", "main.lng").alias("lng"), F.col("lat").isNotNull().alias("known"))


def star(members: DataFrame, totals: DataFrame, cap: int = 12) -> DataFrame:
    """(id, at, node, size, edge_from): each record's related names as a star around itself.

    ``members`` has (id, name, related ARRAY); at 0 is the record itself.
    """
    nodes = members.select("id", "name", F.posexplode(F.concat(F.array("name"), F.slice(F.filter(F.coalesce("related", F.array().cast("array<string>")), lambda x: (x != F.col("name")) & (F.trim(x) != "")), 1, cap))).alias("at", "node"))
    sized = nodes.join(totals.select(F.col("name").alias("node"), "total"), "node", "left")
    size = F.greatest(F.lit(10), F.sqrt(F.coalesce("total", F.lit(0))).cast("int")) + 5
    return sized.select("id", "at", "node", size.alias("size"), F.when(F.col("at") > 0, F.col("name")).alias("edge_from"))


def related_flags(df: DataFrame, key: str, name: str, group: str, links: str) -> DataFrame:
    """(key, member, direct): members of a record's group, itself left out, and whether it links to them."""
    lower = F.transform(F.coalesce(F.col(links), F.array().cast("array<string>")), lambda x: F.lower(F.trim(x)))
    return df.select(key, F.col(name).alias("__n"), lower.alias("l"), F.explode(group).alias("member")).where("member <> __n").select(key, "member", F.array_contains("l", F.col("member")).alias("direct")).distinct()


def label_counts(surnames: DataFrame, first_names: DataFrame, label: str, top: int = TOP) -> DataFrame:
    """(label, n): the most frequent labels over both kinds of names, ties to the smaller label."""
    both = surnames.select(label).unionByName(first_names.select(label)).where(f"trim({label}) <> ''")
    return both.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label").limit(top)


def timeline(series: DataFrame, first: int = 1890) -> DataFrame:
    return series.where(F.col("annee") >= first).groupBy("annee").agg(F.sum("births").alias("births"))


def top_then_known(trends: DataFrame, names: DataFrame, order: str, top: int = TOP) -> DataFrame:
    """The best ``top`` first, then only those with a record (so fewer may be left)."""
    best = trends.orderBy(F.desc(order), "prenom").limit(top)
    return best.join(names.select("prenom").distinct(), "prenom", "left_semi")


def marker(value: Column) -> Column:
    """Place of a year on a line from 500 to 2000, in percent, kept within 2 and 97."""
    return F.least(F.greatest(F.round((value - 500) / 1500 * 100, 1), F.lit(2.0)), F.lit(97.0))


def score_candidate(corpus: DataFrame, vector: list[float], language: str = "", place: str = "", k: int = 5, least: float = 0.92) -> DataFrame:
    """The k records most similar to a new one, with the composite score and the decision."""
    q = F.array(*(F.lit(float(x)) for x in vector))
    sim = F.round(graph.dot(F.col("v"), q), 6)
    rows = corpus.where("v IS NOT NULL").select("id", "langue", "geo", sim.alias("sim")).orderBy(F.desc("sim"), "id").limit(k)
    score = matching.composite(F.col("sim"), F.coalesce((F.col("langue") == language) & (F.col("langue") != ""), F.lit(False)), F.coalesce((F.col("geo") == place) & (F.col("geo") != ""), F.lit(False)))
    precision, recall = F.least(score, F.lit(1.0)), F.col("sim")
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
    return rows.select("id", "sim", F.round(score, 6).alias("score"), F.bround(f1, 4).alias("f1"), F.when(score >= least, "FUSION").otherwise("REJET").alias("decision"))


def explore(df: DataFrame, group: str, label: str) -> DataFrame:
    """(size, groups): how many groups have each size (first 15 sizes)."""
    sizes = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count_distinct(label).alias("size"))
    return sizes.groupBy("size").agg(F.count("*").alias("groups")).orderBy("size").limit(15)


def label_report(df: DataFrame, group: str, labels: list[str]) -> DataFrame:
    """(label, labelled, groups, pct): how many groups carry each label on any of their rows."""
    has = df.where(F.col(group).isNotNull()).groupBy(group).agg(*(F.max(T.filled(F.col(c)).cast("int")).alias(c) for c in labels))
    long = has.agg(F.count("*").alias("groups"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in labels)).unpivot(["groups"], labels, "label", "labelled")
    return long.select("label", "labelled", "groups", F.round(F.coalesce(F.try_divide(F.col("labelled") * 100.0, F.col("groups")), F.lit(0.0)), 6).alias("pct"))


def advice(value: Column, low: float, high: float) -> Column:
    return F.when(value < low, "permissive").when(value > high, "strict").otherwise("balanced")


def knn_probe(queries: DataFrame, corpus: DataFrame, k: int = 5, chunks: int | None = None, block: int = 512) -> DataFrame:
    """(q, c, sim, rank): exact k nearest rows of ``corpus`` (id, v) for a stated set of ``queries`` (id, v).

    Both sides lie in blocks by hash, as many as their rows need (``block`` queries; 2 048 rows of the corpus, or ``chunks`` blocks), and every block of queries meets every block of
    the corpus as one matrix product; only the k best of each go on. Meant for a set of queries, not all rows.
    """
    import numpy as np
    import pyarrow as pa

    def blocks(df: DataFrame, size: int, at: str, rows: str, count: int | None = None) -> tuple[DataFrame, int]:
        held = df.where("v IS NOT NULL").select("id", F.col("v").cast("array<double>").alias("v"))
        count = count or max(1, -(-held.count() // size))
        return held.groupBy(F.pmod(F.xxhash64("id"), F.lit(count)).cast("int").alias(at)).agg(F.collect_list(F.struct("id", "v")).alias(rows)), count

    c, chunks = blocks(corpus, 2048, "chunk", "cs", chunks)
    q, asks = blocks(queries, block, "ask", "qs")
    parts = max(1, chunks * asks // 2)
    asked = q.select("ask", "qs", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk")).repartition(parts, "chunk", "ask")
    held = c.select("chunk", "cs", F.explode(F.sequence(F.lit(0), F.lit(asks - 1))).alias("ask")).repartition(parts, "chunk", "ask")
    pairs = asked.join(held.hint("merge"), ["chunk", "ask"]).select("qs", "cs")

    def multiply(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                a, b = batch.column("qs")[i].values, batch.column("cs")[i].values
                qi, ci = a.field("id").to_numpy(zero_copy_only=False), b.field("id").to_numpy(zero_copy_only=False)
                x = a.field("v").flatten().to_numpy().reshape(len(qi), -1)
                y = b.field("v").flatten().to_numpy().reshape(len(ci), -1)
                s = np.round(x @ y.T, 9)
                s[qi[:, None] == ci[None, :]] = -np.inf
                order = np.lexsort((np.broadcast_to(ci, s.shape), -s), axis=1)[:, :k]
                value = np.take_along_axis(s, order, 1)
                r, t = np.nonzero(np.isfinite(value))
                yield pa.RecordBatch.from_arrays([pa.array(qi[r]), pa.array(ci[order[r, t]]), pa.array(value[r, t])], names=["q", "c", "sim"])

    kind = dict(corpus.dtypes)["id"]
    best = Window.partitionBy("q").orderBy(F.desc("sim"), "c")
    return pairs.mapInArrow(multiply, f"q {kind}, c {kind}, sim double").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def knn_self(rows: DataFrame, k: int = 50, least: float | None = None, tile: int = 2048) -> DataFrame:
    """(q, c, sim, rank): the exact k nearest other rows of every row of ``rows`` (id, v), ties to the smaller id.

    ``rows`` is read more than once (a table, not a long plan), its ids are unique and its vectors
    of one length. Rows lie in tiles of about ``tile`` by hash; every two tiles meet once, as one product in
    doubles that serves both, and only the k best of each row go on, so no task holds more than two
    tiles. Nothing is left out, so the products grow with the square of the rows.
    """
    import numpy as np
    import pyarrow as pa

    def pack(batches):
        """Vectors as bytes: half floats where those hold every value, else floats."""
        for batch in batches:
            lists = batch.column("v")
            dim = len(lists[0]) if len(lists) else 1
            x = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, max(dim, 1))
            with np.errstate(over="ignore"):
                half = x.astype(np.float16)
            fits = (half.astype(np.float32) == x).all(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([h.tobytes() if f else v.tobytes() for f, h, v in zip(fits, half, x)], pa.binary()), pa.array(np.full(len(x), dim, np.int32))], names=["id", "b", "dim"])

    n = rows.count()
    tiles = max(1, -(-n // tile))
    kind = dict(rows.dtypes)["id"]
    small = rows.select("id", F.col("v").cast("array<float>").alias("v")).mapInArrow(pack, f"id {kind}, b binary, dim int")
    packed = cut(small.groupBy(F.pmod(F.xxhash64("id"), F.lit(tiles)).cast("int").alias("t")).agg(F.max("dim").alias("dim"), F.collect_list(F.struct("id", "b")).alias("rows")), "tiles")
    last = F.lit(tiles - 1)
    left = packed.select(F.col("t").alias("i"), "dim", F.col("rows").alias("qs")).withColumn("j", F.explode(F.sequence(F.col("i"), last)))
    right = packed.select(F.col("t").alias("j"), F.col("rows").alias("cs")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("j"))))
    # few pairs to a partition, as Python gets many rows of one at once
    parts = max(1, tiles * (tiles + 1) // 4)
    pairs = left.repartition(parts, "i", "j").join(right.repartition(parts, "i", "j").hint("merge"), ["i", "j"])

    def matrix(side, dim):
        return np.stack([np.frombuffer(v, np.float16 if len(v) == 2 * dim else np.float32).astype(float) for v in side.field("b").to_pylist()])

    def best(s, qi, ci):
        """The k best of each row of s, all that tie with the last among them judged by id."""
        if least is not None:
            held = np.flatnonzero((s >= least).any(axis=1))
            s, qi = s[held], qi[held]
        if s.shape[1] > k and len(s):
            keep = s >= np.partition(s, s.shape[1] - k, axis=1)[:, -k][:, None]
        else:
            keep = np.ones(s.shape, bool)
        keep &= np.isfinite(s) if least is None else s >= least
        r, t = np.nonzero(keep)
        value = s[r, t]
        order = np.lexsort((ci[t], -value, r))
        r, t, value = r[order], t[order], value[order]
        few = np.arange(len(r)) - np.searchsorted(r, r) < k
        return pa.RecordBatch.from_arrays([pa.array(qi[r[few]]), pa.array(ci[t[few]]), pa.array(value[few])], names=["q", "c", "sim"])

    def multiply(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                a, b = batch.column("qs")[at].values, batch.column("cs")[at].values
                qi, ci = a.field("id").to_numpy(zero_copy_only=False), b.field("id").to_numpy(zero_copy_only=False)
                dim = batch.column("dim")[at].as_py()
                s = np.round(matrix(a, dim) @ matrix(b, dim).T, 12)
                if batch.column("i")[at] == batch.column("j")[at]:
                    np.fill_diagonal(s, -np.inf)
                    s = np.maximum(s, s.T)
                else:
                    yield best(s.T, ci, qi)
                yield best(s, qi, ci)

    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("sim"), "c"))
    return pairs.mapInArrow(multiply, f"q {kind}, c {kind}, sim double").withColumn("rank", rank).where(F.col("rank") <= k)


# What a candidate's own text says of its language and place.
CANDIDATE_LANGUAGES = [("arabe", "origine arabe"), ("grec", "origine grecque"), ("latin", "origine latine"), ("hébreu", "origine hebraique")]
CANDIDATE_PLACES = [("france", "france"), ("allemagne", "allemagne")]


def candidate_labels(text: Column) -> tuple[Column, Column]:
    return X.first_label(text, CANDIDATE_LANGUAGES), X.first_label(text, CANDIDATE_PLACES)
