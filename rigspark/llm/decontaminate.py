"""Benchmark decontamination by pigeonhole edit matching over words.

Test units are whole items, allowed one error in ``words_per_error`` words, and every
window of ``window`` words of an item, allowed one error, so that parts of long items
are found too. A unit with budget e is split into e + 1 pieces: whatever e errors do, one
piece stays whole. Exact piece hits in a text are looked up by hash, and the
neighbourhood of each hit is verified with Myers' bit-parallel edit distance.

Words are runs outside ASCII white space, with A-Z lower-cased. Items of more than
``longest`` words are searched in stretches of that many, which overlap by a window less one word: an
occurrence of a whole item within its budget always holds a window with one error at most, so no pair
goes unseen. Stretches go to the executors in blocks of about ``block_words`` words, which bounds the
index that is broadcast, whatever the number and length of items; each further block takes another pass.

Cases: null, empty and blank texts or items match nothing; items shorter than
``least_words`` words are allowed no error, and a caller may leave their pairs out by
``n_words``; a long item's pair has the length of the stretch or window that was found; texts of any length are searched whole; repeated rows
give the pairs of their doc_id once; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .words import hash_runs, hash_words, split_words, text_blocks

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def best_match(unit: list[int], text: list[int], budget: int) -> tuple[int, int] | None:
    """(distance, end in ``text``) of the best approximate occurrence of ``unit`` within ``budget``, by Myers' bit vectors."""
    m = len(unit)
    equal: dict[int, int] = defaultdict(int)
    for i, w in enumerate(unit):
        equal[w] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best = full, 0, m, None
    for j, w in enumerate(text):
        eq = equal.get(w, 0)
        x = eq | minus
        d0 = (((x & plus) + plus) ^ plus) | x
        up = minus | ~(d0 | plus)
        down = plus & d0
        score += bool(up & top) - bool(down & top)
        up <<= 1  # an occurrence may begin anywhere
        down <<= 1
        plus = (down | ~(d0 | up)) & full
        minus = up & d0 & full
        if score <= budget and (best is None or score < best[0]):
            best = (score, j + 1)
    return best


def item_units(words: int, window: int, words_per_error: int) -> list[tuple[int, int, int]]:
    """(first word, words, budget) of the units of an item."""
    whole = (0, words, max(1, words // words_per_error))
    if words <= window:
        return [whole]
    return [whole, *((a, window, 1) for a in range(words - window + 1))]


def pieces(words: int, budget: int) -> list[tuple[int, int]]:
    """(first word, words) of budget + 1 pieces of near equal length."""
    cuts = [words * i // (budget + 1) for i in range(budget + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _index(items: list[tuple[int, str]], window: int, words_per_error: int, least_words: int) -> dict[int, tuple]:
    """By piece length: sorted piece hashes, and for each its (unit number, place in the unit); and the units."""
    units: list[tuple[int, list[int], int]] = []
    by_length: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
    for item_id, text in items:
        data = np.frombuffer((text or "").encode(), np.uint8)
        if not len(data):
            continue
        starts, ends, _ = split_words(data, np.array([0, len(data)]))
        words = hash_words(data, starts, ends, lower=True)
        if not len(words):
            continue
        for a, n, budget in item_units(len(words), window, words_per_error) if len(words) >= least_words else [(0, len(words), 0)]:
            own = words[a : a + n]
            units.append((item_id, [int(x) for x in own], budget))
            for at, length in pieces(n, budget):
                by_length[length][int(hash_runs(own[at : at + length], length)[0])].append((len(units) - 1, at))
    found = {n: (np.array(sorted(x), np.uint64), dict(x)) for n, x in by_length.items()}
    return {"units": units, "pieces": found}


def stretches(items: DataFrame, window: int, longest: int) -> DataFrame:
    """(item_id, k, text, n_words): each item as a whole, or in overlapping stretches of ``longest`` words, words joined by one space."""
    words = F.filter(F.split(F.coalesce(F.col("text"), F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = items.filter("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), words.alias("w"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)), F.lit(longest - window + 1))
    starts = F.when(F.size("w") <= longest, F.array(F.lit(0))).otherwise(starts)
    cut = rows.select("item_id", "w", F.posexplode(starts).alias("k", "at")).select("item_id", "k", F.slice("w", F.col("at") + 1, longest).alias("w"))
    return cut.select("item_id", "k", F.array_join("w", " ").alias("text"), F.size("w").alias("n_words"))


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    window: int = 13,
    words_per_error: int = 8,
    least_words: int = 8,
    longest: int = 2_048,
    block_words: int = 200_000,
) -> DataFrame:
    """(doc_id, item_id, distance, n_words): each pair once, with its least distance and the length of the unit found."""
    spark = docs.sparkSession
    parts = stretches(items, window, longest)
    n_blocks = max(1, -(-(parts.agg(F.sum("n_words")).first()[0] or 0) // block_words))
    out = None
    for block in range(n_blocks):
        # a block of the test items, not of the corpus: about ``block_words`` words by the hash split
        own = [tuple(r) for r in parts.filter(F.pmod(F.xxhash64("item_id", "k"), F.lit(n_blocks)) == block).select("item_id", "text").collect()]
        found = _search(docs, spark.sparkContext.broadcast(_index(own, window, words_per_error, least_words)))
        out = found if out is None else out.union(found)
    return out.groupBy("doc_id", "item_id").agg(F.min(F.struct("distance", F.negative("n_words").alias("n"))).alias("best")).select(
        "doc_id", "item_id", "best.distance", F.negative("best.n").alias("n_words")
    )


def _search(docs: DataFrame, index) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, by_length = index.value["units"], index.value["pieces"]
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            took: dict[tuple, tuple[int, int]] = {}
            for first, last, data, offsets in text_blocks(batch.column("text")):
                starts, ends, place = split_words(data, offsets)
                words = hash_words(data, starts, ends, lower=True)
                tried: set[tuple[int, int, int]] = set()
                for length, (sorted_hashes, where) in by_length.items():
                    runs = hash_runs(words, length)
                    at = np.searchsorted(sorted_hashes, runs)
                    at[at == len(sorted_hashes)] = 0
                    hits = np.flatnonzero(sorted_hashes[at] == runs) if len(runs) else at
                    for hit in hits:
                        doc = int(np.searchsorted(place, hit, "right")) - 1
                        if hit + length > place[doc + 1]:
                            continue
                        for number, inside in where[int(runs[hit])]:
                            item, unit, budget = units[number]
                            if not budget and (ids[first + doc], item) in took:  # an exact unit is its item's only one
                                continue
                            a = max(int(place[doc]), int(hit) - inside - budget)
                            b = min(int(place[doc + 1]), int(hit) - inside + len(unit) + budget)
                            if (number, a, b) in tried:
                                continue
                            tried.add((number, a, b))
                            match = best_match(unit, [int(x) for x in words[a:b]], budget)
                            if match is not None:
                                key, value = (ids[first + doc], item), (match[0], -len(unit))
                                took[key] = min(took.get(key, value), value)
            keys, values = list(took), list(took.values())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.int64()),
                    pa.array([k[1] for k in keys], pa.int64()),
                    pa.array([v[0] for v in values], pa.int32()),
                    pa.array([-v[1] for v in values], pa.int32()),
                ],
                names=["doc_id", "item_id", "distance", "n_words"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        rows, "doc_id long, item_id long, distance int, n_words int"
    )


def op9_pigeonhole(spark, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
