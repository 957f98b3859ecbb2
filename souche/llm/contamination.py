"""Evaluation texts leaking into training text (problem 7).

Method: one Aho-Corasick automaton over the normalised evaluation items: every run of
``least`` consecutive words of every item is a pattern, all in one automaton, and each text is
normalised and scanned once. A match maps back to the characters of the original text.

The items are the small side (held-out sets are small and fixed), the corpus only streams past: no
shuffle of texts. Items are counted before anything is built: beyond ``most_items`` items or ``most_words``
words they are divided into lots by hash, each with an automaton of that size and a pass over
the corpus of its own, so nothing broadcast grows. A Python worker builds an automaton once and keeps it for its tasks.

Defined edge cases: null and empty texts leak nothing; an item of fewer than ``least`` words
cannot be found; repeated items and repeated passages give one row per document and item (the
first place, the longest run of words); patterns shared by items name all of them; an empty
side gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import unicodedata
import uuid
from collections.abc import Iterator
from functools import partial

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souche.functions.text import fold_py, words_py

LEAST_WORDS = 12
MOST_ITEMS = 100_000
MOST_WORDS = 5_000_000

#: the automaton a worker built last, by its lot
_BUILT: dict = {}


def patterns(items: list[tuple[int, str]], least: int = LEAST_WORDS) -> dict[str, list[tuple[int, int]]]:
    """Runs of ``least`` words, blank-delimited, with the (item, first word) they stand for."""
    out: dict[str, list[tuple[int, int]]] = {}
    for item, body in items:
        words = words_py(body)
        for i in range(len(words) - least + 1):
            out.setdefault(" " + " ".join(words[i : i + least]) + " ", []).append((item, i))
    return out


def automaton(found: dict[str, list[tuple[int, int]]]) -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for pattern, places in found.items():
        out.add_word(pattern, (len(pattern), places))
    out.make_automaton()
    return out


def normal(body: str) -> str:
    return " " + " ".join(words_py(body)) + " "


def original_words(body: str) -> list[tuple[int, int]]:
    """(start, end) in ``body`` of each of its words after normalisation."""
    spans: list[list[int]] = []
    inside = False
    for at, char in enumerate(body):
        for c in fold_py(char):
            if c.isalnum():
                if inside:
                    spans[-1][1] = at + 1
                else:
                    spans.append([at, at + 1])
                inside = True
            elif unicodedata.category(c)[0] != "M":
                inside = False
    return [(a, b) for a, b in spans]


def leaks(documents: DataFrame, items: DataFrame, doc: str = "doc_id", body: str = "text", item: str = "item_id", item_body: str = "texte", least: int = LEAST_WORDS, most_items: int = MOST_ITEMS, most_words: int = MOST_WORDS) -> DataFrame:
    """(doc_id, item_id, run_words, start, end): documents holding ``least`` or more consecutive words of an item.

    run_words is the longest run of the item's consecutive words in the document; start and end are its characters.
    """
    held = items.select(F.col(item).alias("i"), F.col(item_body).alias("t")).where("i IS NOT NULL AND t IS NOT NULL").distinct()
    size = held.agg(F.count("*"), F.sum(F.size(F.split("t", " ")))).first()
    lots = max(1, -(-size[0] // most_items), -(-(size[1] or 0) // most_words))
    kind = dict(items.dtypes)[item]

    def scan(name: str, shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _BUILT:
            _BUILT.clear()
            _BUILT[name] = automaton(patterns(shared.value, least))
        machine = _BUILT[name]
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text or not len(machine):
                    continue
                plain = normal(text)
                hits = [(end + 1 - length, item_id, first) for end, (length, places) in machine.iter(plain) for item_id, first in places]
                if not hits:
                    continue
                word_at = {}
                at = 0
                for k, w in enumerate(plain.split()):
                    word_at[at] = k
                    at += len(w) + 1
                runs: dict = {}  # (item, offset between document and item) -> stretches of consecutive first words
                for place, item_id, first in hits:
                    k = word_at[place]
                    stretches = runs.setdefault((item_id, k - first), [])
                    if stretches and stretches[-1][1] == k - 1:
                        stretches[-1][1] = k
                    elif not stretches or stretches[-1][1] != k:
                        stretches.append([k, k])
                best: dict = {}
                for (item_id, _), stretches in runs.items():
                    for a, b in stretches:
                        rank = (-(b - a + least), a)
                        if item_id not in best or rank < best[item_id]:
                            best[item_id] = rank
                spans = original_words(text)
                for item_id, (size_, first) in best.items():
                    last = first - size_ - 1
                    for column, value in zip(out, (key, item_id, -size_, spans[first][0], spans[last][1])):
                        column.append(value)
            names = ["doc_id", "item_id", "run_words", "start", "end"]
            kinds = [batch.schema.field(0).type, pa.array([r[0] for r in shared.value[:1]]).type if shared.value else pa.int64(), pa.int32(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)

    source = documents.select(F.col(doc).alias("doc_id"), F.col(body).alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    found = None
    for lot in range(lots):
        rows = [(r.i, r.t) for r in held.where(F.pmod(F.xxhash64("i", "t"), F.lit(lots)) == lot).collect()]
        part = source.mapInArrow(partial(scan, uuid.uuid4().hex, documents.sparkSession.sparkContext.broadcast(rows)), f"doc_id {dict(documents.dtypes)[doc]}, item_id {kind}, run_words int, start int, end int")
        found = part if found is None else found.unionByName(part)
    best = F.max(F.struct("run_words", (-F.col("start")).alias("minus"), (-F.col("end")).alias("minus_end"))).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", F.col("best.run_words").alias("run_words"), (-F.col("best.minus")).alias("start"), (-F.col("best.minus_end")).alias("end"))


def leaked_items(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(item_id, documents, longest_run): how far each item has leaked."""
    return leaks(documents, items).groupBy("item_id").agg(F.count("*").alias("documents"), F.max("run_words").alias("longest_run"))
