"""Mixing sources to target weights (problem 8).

Method: subset-sum budget fitting. Texts are counted by exact token length and source; each
source's budget is its target share of the corpus's tokens. Whole passes over a source are
taken as long as they fit and its cap allows; what is left of the budget is filled by a
proportional draw from the length counts, corrected by a bounded-knapsack dynamic programme
over the remaining tokens. Texts are then chosen by seeded hash within each (source, length).

Tokens are counted once, in Arrow batches, by a public byte-level BPE whose file is a parameter
(read on the driver, broadcast). The programme sees lengths and counts only, never texts: at
most about the root of twice a source's tokens rows per source, one task per source. Choosing
is spread: hash buckets within a (source, length) are taken or left whole, and only the bucket
at the boundary is ranked, so texts all of one length need no single task.

Defined edge cases: null and empty texts and null sources have no tokens and are never chosen;
the same text of a source under several ids counts once (its smallest id is used), as the cap
is per text; a source without target contributes nothing, one without texts reports a share of
0; targets are normalised by their sum; a source too small for its share at its cap is used whole at the cap and
reported short; repeated target rows of a source count once (the largest); empty tables give no rows;
extra columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from souche.session import cut

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: fixed value: the split pattern that belongs to the vocabulary
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SEED = 17
BUCKETS = 1024


@cache
def _encoder(data: bytes) -> tiktoken.Encoding:
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(documents: DataFrame, vocabulary: str = VOCABULARY, key: str = "doc_id", body: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, text_key, tokens) for every document with a text and a source."""
    with open(vocabulary, "rb") as file:
        shared = documents.sparkSession.sparkContext.broadcast(file.read())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in batches:
            sizes = [len(encoder.encode_ordinary(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "source", "text_key")), pa.array(sizes, pa.int64())], names=["doc_id", "source", "text_key", "tokens"])

    rows = documents.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), F.md5(body).alias("text_key"), F.col(body).alias("text"))
    rows = rows.where("doc_id IS NOT NULL AND source IS NOT NULL AND text <> ''")
    return rows.mapInArrow(count, f"doc_id {dict(documents.dtypes)[key]}, source string, text_key string, tokens bigint")


def fit_counts(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """How many texts of each length to take for a total as near to ``budget`` as can be (never more texts than there are)."""
    total = sum(n * k for n, k in zip(lengths, counts))
    if budget >= total:
        return list(counts)
    take = [k * budget // total for k in counts]
    left = budget - sum(n * t for n, t in zip(lengths, take))
    spare = [k - t for k, t in zip(counts, take)]
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    longest = lengths[order[0]]
    for i in order:  # greedy down to a remainder that the programme can hold
        if left <= 4 * longest:
            break
        more = min(spare[i], (left - 2 * longest) // lengths[i])
        if more > 0:
            take[i], spare[i], left = take[i] + more, spare[i] - more, left - more * lengths[i]
    for i in order:  # and a little back, so that it has more than one way to fill it
        if left >= 2 * longest:
            break
        back = min(take[i], max(0, (2 * longest - left) // lengths[i]))
        take[i], spare[i], left = take[i] - back, spare[i] + back, left + back * lengths[i]
    for i, more in bounded_knapsack([lengths[i] for i in range(len(lengths))], spare, left).items():
        take[i] += more
    return take


def bounded_knapsack(lengths: list[int], spare: list[int], budget: int) -> dict[int, int]:
    """{index: copies} with the largest total not over ``budget``.

    Per total only the step that first reached it is kept (so memory is the budget's, whatever the number of steps).
    """
    if budget <= 0:
        return {}
    first = np.full(budget + 1, -1, np.int32)  # -1: not reached
    first[0] = 0
    steps = [(0, 0)]
    for i, (n, k) in enumerate(zip(lengths, spare)):
        k, size = min(k, budget // n), 1
        while k > 0 and first[budget] < 0:
            size = min(size, k)
            steps.append((i, size))
            new = np.flatnonzero((first[: budget + 1 - n * size] >= 0) & (first[n * size :] < 0)) + n * size
            first[new] = len(steps) - 1
            k -= size
            size *= 2
        if first[budget] >= 0:
            break
    at, out = int(np.flatnonzero(first >= 0)[-1]), {}
    while at:
        i, size = steps[first[at]]
        out[i] = out.get(i, 0) + size
        at -= lengths[i] * size
    return out


def plan(counted: DataFrame, targets: DataFrame, total: int) -> DataFrame:
    """(source, tokens, base, extra): each text of a source and length is used ``base`` times, ``extra`` of them once more."""
    goal = targets.where("source IS NOT NULL AND part_cible > 0").groupBy("source").agg(F.max("part_cible").alias("part"), F.max(F.coalesce("repetitions_max", F.lit(1))).alias("cap"))
    whole = goal.agg(F.sum("part")).scalar()
    goal = goal.withColumn("budget", F.floor(F.lit(total) * F.col("part") / whole + 1e-6))
    hist = counted.groupBy("source", "tokens").agg(F.count("*").alias("n")).join(goal, "source")

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("tokens")
        lengths, counts = rows["tokens"].tolist(), rows["n"].tolist()
        budget, cap, size = int(rows["budget"].iloc[0]), int(rows["cap"].iloc[0]), sum(a * b for a, b in zip(lengths, counts))
        base = min(cap, budget // size)
        extra = fit_counts(lengths, counts, budget - base * size) if base < cap else [0] * len(counts)
        return pd.DataFrame({"source": rows["source"], "tokens": lengths, "base": base, "extra": extra})

    return hist.groupBy("source").applyInPandas(fit, "source string, tokens bigint, base int, extra bigint")


def mixture(documents: DataFrame, targets: DataFrame, vocabulary: str = VOCABULARY, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, tokens, copies) of the chosen documents, and the counted corpus."""
    corpus = cut(token_counts(documents, vocabulary), "tokens")
    total = corpus.agg(F.sum("tokens")).first()[0] or 0
    single = corpus.groupBy("source", "text_key").agg(F.min("doc_id").alias("doc_id"), F.min("tokens").alias("tokens")).where("tokens > 0").select("doc_id", "source", "tokens")
    single = cut(single, "texts")
    uses = cut(plan(single, targets, total), "plan")
    rows = single.join(uses, ["source", "tokens"]).withColumn("h", F.xxhash64("doc_id", F.lit(seed))).withColumn("bucket", F.pmod("h", F.lit(BUCKETS)).cast("int"))
    # texts per bucket before this one: at most BUCKETS rows per (source, length)
    sizes = rows.where("extra > 0").groupBy("source", "tokens", "bucket").agg(F.count("*").alias("n"), F.first("extra").alias("extra_of"))
    before = F.sum("n").over(Window.partitionBy("source", "tokens").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    room = sizes.withColumn("before", F.coalesce(before, F.lit(0))).select("source", "tokens", "bucket", "n", (F.col("extra_of") - F.col("before")).alias("room"))
    placed = rows.join(room, ["source", "tokens", "bucket"], "left")
    edge = placed.where("room > 0 AND room < n")
    rank = F.row_number().over(Window.partitionBy("source", "tokens", "bucket").orderBy("h", "doc_id"))
    ranked = edge.withColumn("more", F.when(rank <= F.col("room"), 1).otherwise(0))
    clear = placed.where("room IS NULL OR room <= 0 OR room >= n").withColumn("more", F.when(F.col("room") >= F.col("n"), 1).otherwise(0))
    both = clear.unionByName(ranked).withColumn("copies", (F.col("base") + F.col("more")).cast("int")).where("copies > 0")
    return both.select("doc_id", "source", "tokens", "copies"), corpus


def chosen(documents: DataFrame, targets: DataFrame, **kw) -> DataFrame:
    return mixture(documents, targets, **kw)[0]


def shares(documents: DataFrame, targets: DataFrame, **kw) -> DataFrame:
    """(source, part_cible, repetitions_max, tokens_corpus, tokens_target, tokens_mix, share_of_target_total, share_of_mix, short)."""
    picked, corpus = mixture(documents, targets, **kw)
    goal = targets.where("source IS NOT NULL").groupBy("source").agg(F.max("part_cible").alias("part_cible"), F.max("repetitions_max").alias("repetitions_max"))
    have = corpus.groupBy("source").agg(F.sum("tokens").alias("tokens_corpus"))
    took = picked.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("tokens_mix"), F.max("copies").alias("most_copies"))
    rows = goal.join(have, "source", "full").join(took, "source", "left").na.fill(0, ["tokens_corpus", "tokens_mix", "most_copies", "part_cible"])
    # one row per source
    everything = Window.partitionBy(F.lit(0))
    total = F.sum("tokens_corpus").over(everything)
    part = F.try_divide(F.col("part_cible"), F.sum("part_cible").over(everything))
    return rows.select(
        "source", "part_cible", "repetitions_max", "most_copies", "tokens_corpus", F.floor(total * part + 1e-6).alias("tokens_target"), "tokens_mix",
        F.try_divide(F.col("tokens_mix"), total).alias("share_of_corpus_size"), F.try_divide(F.col("tokens_mix"), F.sum("tokens_mix").over(everything)).alias("share_of_mix"),
    )
