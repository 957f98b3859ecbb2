"""Garbled text from wrong character encoding (problem 9).

Method: expectation-maximisation with latent encoding chains. A chain is a way text can have
been misread (bytes of UTF-8 read as cp1252, twice, as cp850, latin-1 bytes read as cp437 ...).
Each record has one latent chain, "none" most often; each source has its own weights of the
chains, pooled towards those of all records, so that weak evidence of many records of one
source adds up. A chain explains a token by undoing itself: the token's probability is then
that of the restored token under a character model of clean text.

* E: the posterior of each record's chain, from its tokens with characters beyond ASCII, or with a
  question mark inside a word. A chain may have touched all tokens or only some: the share touched is
  mixed over ``SHARES`` and one token of the record, so clean text, however long, does
  not outvote a damaged place in it.
* M: the weights per source, and the character model, from all records, each counted by its
  posterior of being clean.

The records pass as Arrow batches, once per round; only these tokens are kept, cut
to the shared folder. Within a batch each distinct token is judged once, and records are summed as
matrices. A round gives back only sums (slots of the model, weights of a source); the last one the records.
The character model is a fixed-size table (2^18 hashed pairs), so what is
broadcast does not grow with the data; source weights are joined, not broadcast by hand.
The corpus has one text field; ``source`` may name several fields apart by being a column of both.

A record is repaired by its most probable chain, token by token, where restoring makes the token
more probable; characters lost on the way (U+FFFD, or the tail of a pair turned to "?") are
restored if one letter clearly fits, else left.

Defined edge cases: null and empty texts are no case; a null source is a source of its own;
repeated ids give one row each unless equal; entities, foreign alphabets and signs that no
chain turns into likelier text are left alone; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souche.session import cut, drop_cut

#: name -> stages, each (encoding it was read with, encoding it was written in), to undo in order
CHAINS: dict[str, tuple[tuple[str, str], ...]] = {
    "utf8 as cp1252": (("cp1252", "utf-8"),),
    "utf8 as latin-1": (("latin-1", "utf-8"),),
    "utf8 as cp1252, twice": (("cp1252", "utf-8"), ("cp1252", "utf-8")),
    "utf8 as latin-1, twice": (("latin-1", "utf-8"), ("latin-1", "utf-8")),
    "utf8 as mac": (("mac_roman", "utf-8"),),
    "utf8 as cp850": (("cp850", "utf-8"),),
    "utf8 as cp437": (("cp437", "utf-8"),),
    "utf8 as cp1251": (("cp1251", "utf-8"),),
    "utf8 as cp1250": (("cp1250", "utf-8"),),
    "utf8 as latin-9": (("iso8859-15", "utf-8"),),
    "utf8 as koi8": (("koi8-r", "utf-8"),),
    "latin as cp437": (("cp437", "cp1252"),),
    "latin as cp850": (("cp850", "cp1252"),),
    "latin as mac": (("mac_roman", "cp1252"),),
    "latin as cp1251": (("cp1251", "cp1252"),),
    "latin as cp1250": (("cp1250", "cp1252"),),
    "latin as koi8": (("koi8-r", "cp1252"),),
    "mac as latin": (("cp1252", "mac_roman"),),
    "cp850 as latin": (("cp1252", "cp850"),),
}
LOST = "characters lost"
NAMES = ("none", *CHAINS, LOST)
SHARES = (0.04, 0.4, 0.95)
LOST_ODDS = math.log(1e7)
ASKED_ODDS = math.log(50)  # of a question mark inside a word: one is not enough, several are
LETTERS = "éèàêâîôûçùëïüöäñóíáúìòœÀÉÈÊÔÎÇŒ«»"
ROUNDS = 3
PAIRS = 1 << 18
CLEAN = 0.95  # weight of "none" before any record was seen

_TOKEN = re.compile(r"[^ \t\n\r]*(?:[^\x00-\x7f]|[A-Za-z]\?[a-z])[^ \t\n\r]*")
_ASKED = re.compile(r"(?<=[A-Za-z])\?(?=[a-z])")
_LEAD = re.compile("[Â-ß](?:\\?|$)")


@cache
def _tables(encoding: str) -> tuple[dict[str, int], list[str]]:
    """Character to byte and back; bytes the encoding leaves open stand for themselves."""
    chars = []
    for b in range(256):
        try:
            chars.append(bytes([b]).decode(encoding))
        except UnicodeDecodeError:
            chars.append(chr(b))
    back = {c: b for b, c in reversed(list(enumerate(chars)))}
    return back, chars


def _bytes(token: str, encoding: str) -> bytes | None:
    back = _tables(encoding)[0]
    try:
        return bytes([back[c] for c in token])
    except KeyError:
        return None


def undo(token: str, chain: str) -> list[str]:
    """What the token may have been before the chain: nothing if the chain cannot have made it.

    More than one where characters were lost: all with one letter put in their place.
    """
    stages = CHAINS[chain]
    for i, (read, written) in enumerate(stages):
        raw = _bytes(token, read)
        if raw is None:
            return []
        if written != "utf-8":
            chars = _tables(written)[1]
            new = "".join(chars[b] for b in raw)
        else:
            try:
                new = raw.decode("utf-8")
            except UnicodeDecodeError:
                if i + 1 < len(stages):
                    return []
                return _with_letters(raw)
        if new == token:
            return []
        token = new
    return [token]


def _with_letters(raw: bytes) -> list[str]:
    """Decodings of UTF-8 whose second bytes were lost, one letter for all of them."""
    plain = raw.decode("latin-1")
    if not _LEAD.search(plain):
        return []
    out = []
    for letter in LETTERS:
        code = letter.encode("utf-8").decode("latin-1")
        filled = _LEAD.sub(lambda m, code=code: code if m.group()[0] == code[0] else m.group(), plain)
        try:
            out.append(filled.encode("latin-1").decode("utf-8"))
        except UnicodeDecodeError:
            continue
    return out


def pair_slots(token: str) -> list[int]:
    codes = [32, *map(ord, token), 32]
    return [(a * 0x9E3779B1 + b * 0x85EBCA6B >> 7) & (PAIRS - 1) for a, b in zip(codes, codes[1:])]


def char_slots(token: str) -> list[int]:
    return [PAIRS + (ord(c) * 0x9E3779B1 >> 5 & 0xFFFF) for c in (" ", *token)]


class Model:
    """Character pairs of clean tokens; ``counts`` holds 2^18 pairs, then 2^16 characters."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        self.total = float(counts[PAIRS:].sum()) + 1.0
        self.token = lru_cache(200_000)(self._token)
        self.odds = lru_cache(100_000)(self._odds)

    def _token(self, token: str) -> float:
        chars = char_slots(token)
        follow = [*chars[1:], chars[0]]
        out = 0.0
        for pair, a, b in zip(pair_slots(token), chars, follow):
            back = (self.counts[b] + 0.02) / (self.total + 1000)
            out += math.log((self.counts[pair] + 2 * back) / (self.counts[a] + 2))
        return out

    def restore(self, token: str, chain: str) -> tuple[float, str]:
        """Log-odds of the best restored token against the token as it stands."""
        ways = undo(token, chain)
        if not ways:
            return -math.inf, token
        loss = math.log(len(ways))
        best = max(ways, key=lambda w: (self.token(w), w))
        return self.token(best) - loss - self.token(token), best

    def _odds(self, token: str) -> np.ndarray:
        """What each chain, and lost characters, make of the token: its odds against no damage."""
        lost = LOST_ODDS if "�" in token else ASKED_ODDS if token.isascii() else -math.inf
        odds = np.array([*(self.restore(token, c)[0] for c in CHAINS), lost])
        return np.exp(np.clip(odds, -60, 60))

    def records(self, ids: np.ndarray, lengths: np.ndarray, odds: np.ndarray, prior: np.ndarray) -> np.ndarray:
        """Posterior of none, each chain and lost characters for records of ``lengths`` tokens, given as rows of ``odds``."""
        out = np.empty((len(lengths), len(NAMES)))
        ends = np.cumsum(lengths)
        at = 0
        while at < len(lengths):  # slices of bounded size, but for a record larger than that
            start = ends[at] - lengths[at]
            to = max(at + 1, int(np.searchsorted(ends, start + 20_000, "right")))
            out[at:to] = self._records(ids[start : ends[to - 1]], lengths[at:to], odds, prior[at:to])
            at = to
        return out

    def _records(self, ids, lengths, odds, prior):
        # each distinct token of a record once, with its count
        who = np.repeat(np.arange(len(lengths)), lengths)
        pairs, count = np.unique(who * len(odds) + ids, return_counts=True)
        who, touched = pairs // len(odds), odds[pairs % len(odds)]
        starts = np.searchsorted(who, np.arange(len(lengths)))
        n = lengths.astype(float)
        touched[:, -1] *= np.maximum(1, n / 25)[who]  # a lost character is one in a text of any length
        least = np.minimum(SHARES[0], 1 / n)[who, None]
        each = np.stack([np.add.reduceat(count[:, None] * np.log((1 - s) + s * touched), starts, axis=0) for s in (least, *SHARES[1:])])
        top = each.max(0)
        log = np.zeros((len(lengths), len(NAMES)))
        log[:, 1:] = top + np.log(np.exp(each - top).mean(0))
        log += np.log(np.maximum(prior, 1e-12))
        post = np.exp(log - log.max(1, keepdims=True))
        return post / post.sum(1, keepdims=True)


def strictly_restorable(token: str) -> bool:
    """Whether a chain of UTF-8 undoes the token whole: too unlikely for clean text to start the model with."""
    return "�" in token or any(CHAINS[c][0][1] == "utf-8" and len(undo(token, c)) == 1 for c in CHAINS)


def tokens(documents: DataFrame, key: str, body: str, source: str) -> DataFrame:
    """(doc_id, source, tokens): the texts' tokens that may be damaged, for texts that have any."""

    def cut_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[w for w in t.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if not w.isascii() or ("?" in w and _ASKED.search(w))] for t in batch.column("text").to_pylist()]
            keep = pa.array([bool(f) for f in found], pa.bool_())
            out = pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"), pa.array(found, pa.list_(pa.string()))], names=["doc_id", "source", "tokens"])
            yield out.filter(keep)

    rows = documents.select(F.col(key).alias("doc_id"), F.coalesce(F.col(source), F.lit("")).alias("source"), F.col(body).alias("text"))
    return rows.where(r"doc_id IS NOT NULL AND text RLIKE '[^\\x00-\\x7f]|[A-Za-z][?][a-z]'").mapInArrow(cut_tokens, f"doc_id {dict(documents.dtypes)[key]}, source string, tokens array<string>")


def _spend(weights: dict[str, float], sums: np.ndarray) -> None:
    """Count the characters of weighted tokens, each distinct token once."""
    at, much = [], []
    for token, weight in weights.items():
        slots = (*pair_slots(token), *char_slots(token))
        at += slots
        much += [weight] * len(slots)
    np.add.at(sums, np.array(at, dtype=np.int64), much)
    weights.clear()


def _model(rows: DataFrame) -> np.ndarray:
    """The character model's fixed number of counters, summed over all tasks."""
    sums = rows.where("slot IS NOT NULL").groupBy("slot").agg(F.sum("weight").alias("weight")).toPandas()
    counts = np.zeros(PAIRS + 0x10000)
    counts[sums["slot"].to_numpy()] = sums["weight"].to_numpy()
    return counts


def _step(toks: DataFrame, counts: np.ndarray | None, prior: DataFrame | None, last: bool = False) -> DataFrame:
    """One E step. Its sums: (slot, weight) rows for the next model and (source, posterior) rows added up; or, at
    the ``last``, the records: (doc_id, source, posterior)."""
    shared = toks.sparkSession.sparkContext.broadcast(counts)
    k = len(NAMES)
    flat = np.array([CLEAN, *[(1 - CLEAN) / (k - 1)] * (k - 1)])
    lists = pa.list_(pa.float64())
    rows = toks.withColumn("prior", F.array(*(F.lit(float(x)) for x in flat)))
    if prior is not None:
        rows = toks.join(prior, "source", "left").withColumn("prior", F.coalesce("prior", F.array(*(F.lit(float(x)) for x in flat))))

    def posts(batches: Iterator[pa.RecordBatch], model: Model | None):
        """Per piece of a batch: the batch, its distinct tokens, their weight as clean ones, the posteriors."""
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                lengths = np.diff(batch.column("tokens").offsets.to_numpy())
                coded = batch.column("tokens").flatten().dictionary_encode()
                ids, own = coded.indices.to_numpy(), coded.dictionary.to_pylist()
                if model is None:
                    weight = np.bincount(ids, minlength=len(own)) * np.array([not strictly_restorable(t) for t in own], float)
                    yield batch, own, weight, None
                    continue
                post = model.records(ids, lengths, np.stack([model.odds(t) for t in own]), batch.column("prior").flatten().to_numpy().reshape(-1, k))
                yield batch, own, np.bincount(ids, np.repeat(post[:, 0], lengths), len(own)), post

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, _, post in posts(batches, Model(shared.value)):
            values = pa.ListArray.from_arrays(pa.array(np.arange(len(post) + 1, dtype=np.int32) * k), pa.array(post.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"), values], names=["doc_id", "source", "posterior"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(PAIRS + 0x10000)
        weights: dict[str, float] = {}
        per: dict[str, np.ndarray] = {}

        def sources() -> pa.RecordBatch:
            values = list(per.values())
            out = [pa.array(list(per), pa.string()), pa.array(values, lists), pa.nulls(len(per), pa.int32()), pa.nulls(len(per), pa.float64())]
            per.clear()
            return pa.RecordBatch.from_arrays(out, names=["source", "posterior", "slot", "weight"])

        for batch, own, weight, post in posts(batches, None if shared.value is None else Model(shared.value)):
            for t, w in zip(own, weight.tolist()):
                weights[t] = weights.get(t, 0.0) + w
            if len(weights) > 100_000:
                _spend(weights, sums)
            if post is not None:
                named = batch.column("source").dictionary_encode()
                own_sums = np.zeros((len(named.dictionary), k))
                np.add.at(own_sums, named.indices.to_numpy(), post)
                for name, row in zip(named.dictionary.to_pylist(), own_sums):
                    per[name] = per[name] + row if name in per else row
                if len(per) > 10_000:
                    yield sources()
        _spend(weights, sums)
        yield sources()
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(at), pa.string()), pa.nulls(len(at), lists), pa.array(at.astype(np.int32)), pa.array(sums[at])], names=["source", "posterior", "slot", "weight"])

    if last:
        return rows.mapInArrow(told, f"doc_id {dict(toks.dtypes)['doc_id']}, source string, posterior array<double>")
    return rows.mapInArrow(summed, "source string, posterior array<double>, slot int, weight double")


def source_weights(posteriors: DataFrame, sizes: DataFrame, pooled: float = 50.0) -> DataFrame:
    """(source, prior): chain weights per source, pooled with those of all sources as ``pooled`` records would be."""
    k = len(NAMES)
    parts = [F.sum(F.col("posterior")[i]).alias(f"c{i}") for i in range(1, k)]
    sums = posteriors.groupBy("source").agg(*parts)
    rows = sizes.join(sums, "source", "left").na.fill(0.0)
    whole = rows.agg(F.sum("n").alias("n"), *(F.sum(f"c{i}").alias(f"c{i}") for i in range(1, k))).first()
    every = [((whole[f"c{i}"] or 0.0) + 0.01) / ((whole["n"] or 0) + 1.0) for i in range(1, k)]
    chains = [(F.col(f"c{i}") + pooled * every[i - 1]) / (F.col("n") + pooled) for i in range(1, k)]
    none = F.greatest(F.lit(1e-6), 1 - sum(chains[1:], chains[0]))
    return rows.select("source", F.array(none, *chains).alias("prior"))


def posteriors(documents: DataFrame, rounds: int = ROUNDS, key: str = "doc_id", body: str = "text", source: str = "source") -> tuple[DataFrame, np.ndarray]:
    """(doc_id, source, posterior) of every record with characters beyond ASCII, and the last clean model."""
    toks = cut(tokens(documents, key, body, source), "tokens")
    sizes = documents.select(F.coalesce(F.col(source), F.lit("")).alias("source"), F.col(key).alias("k"), F.col(body).alias("b")).where("k IS NOT NULL AND b <> ''").groupBy("source").agg(F.count("*").alias("n"))
    counts, prior = _model(_step(toks, None, None)), None
    for _ in range(rounds - 1):
        done = cut(_step(toks, counts, prior), "sums")
        counts, prior = _model(done), cut(source_weights(done.where("posterior IS NOT NULL"), sizes), "weights")
        drop_cut(done)
    return cut(_step(toks, counts, prior, last=True), "posteriors"), counts


def garbled(documents: DataFrame, least: float = 0.5, **kw) -> DataFrame:
    """(doc_id, chain, posterior): records whose text, or a part of it, is garbled."""
    rows, _ = posteriors(documents, **kw)
    found = rows.where(F.col("posterior")[0] < 1 - least)
    rest = F.slice("posterior", 2, len(NAMES) - 1)
    best = F.array_position(rest, F.array_max(rest))
    return found.select("doc_id", F.element_at(F.array(*(F.lit(n) for n in NAMES[1:])), best.cast("int")).alias("chain"), (1 - F.col("posterior")[0]).alias("posterior")).distinct()


def repaired(documents: DataFrame, key: str = "doc_id", body: str = "text", source: str = "source", **kw) -> DataFrame:
    """(doc_id, chain, posterior, text, repaired, open): garbled records with the text as it was; open counts places left."""
    rows, counts = posteriors(documents, key=key, body=body, source=source, **kw)
    found = rows.where(F.col("posterior")[0] < 0.5).select("doc_id", "posterior").distinct()
    texts = documents.select(F.col(key).alias("doc_id"), F.col(body).alias("text")).join(found, "doc_id")
    shared = documents.sparkSession.sparkContext.broadcast(counts)

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(shared.value)
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for text, post in zip(batch.column("text").to_pylist(), batch.column("posterior").to_pylist()):
                chain = NAMES[1 + int(np.argmax(post[1:]))]
                fixed = repair_text(text, chain, model)
                for column, value in zip(out, (chain, 1 - post[0], fixed, fixed.count("�"))):
                    column.append(value)
            kinds = (pa.string(), pa.float64(), pa.string(), pa.int32())
            arrays = [pa.array(c, k) for c, k in zip(out, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays[:2], batch.column("text"), *arrays[2:]], names=["doc_id", "chain", "posterior", "text", "repaired", "open"])

    return texts.mapInArrow(repair, f"doc_id {dict(documents.dtypes)[key]}, chain string, posterior double, text string, repaired string, open int")


def repair_text(text: str, chain: str, model: Model) -> str:
    def fix(match: re.Match) -> str:
        token = match.group()
        if chain != LOST:
            odds, best = model.restore(token, chain)
            if odds > 0:
                token = best
        elif token.isascii():
            return fill_lost(_ASKED.sub("�", token), model).replace("�", "?")
        return fill_lost(token, model) if "�" in token else token

    return _TOKEN.sub(fix, text)


def fill_lost(token: str, model: Model, sure: float = 0.8) -> str:
    """Each lost character becomes a letter if that letter clearly fits, from left to right."""
    at = token.find("�")
    while at >= 0:
        ways = [token[:at] + letter + token[at + 1 :] for letter in LETTERS]
        score = np.array([model.token(w) for w in ways])
        weight = np.exp(score - score.max())
        best = int(np.argmax(weight))
        if weight[best] / weight.sum() >= sure:
            token = ways[best]
        at = token.find("�", at + 1)
    return token
