"""Language identification by rank-order profiles of character n-grams.

A profile is the list of the most frequent n-grams (one to three letters, words padded
by a space) of a language, by falling frequency. A text's own list is compared with
each profile: every n-gram costs the difference of its two ranks, or ``ranks`` if the
profile lacks it. The language with the least out-of-place distance wins.

Profiles are learned from at most about ``sample`` labelled texts a language, chosen by a
hash of doc_id, and are as many as there are labels. Prediction reads whole texts.

Cases: a text that is null or has no letter is ``und`` with score 0; equal distances go to
the language first in order; without any label every text is ``und``; repeated rows are
predicted like others; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import table, whole_text

#: n-grams of a profile and of a text.
RANKS = 400
#: Labelled texts a language to learn from, in expectation.
SAMPLE = 4_000
UNKNOWN = "und"

_folded: np.ndarray | None = None


def _letters() -> np.ndarray:
    """For each code point: 0 for what is no letter, else a 16-bit code of its lower-case form."""
    global _folded
    if _folded is None:
        made = np.zeros(0x110000, np.uint64)
        for c in range(0x110000):
            if (s := chr(c)).isalpha():
                low = s.lower()
                made[c] = (ord(low) if len(low) == 1 else c) % 65535 + 1
        _folded = made
    return _folded


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of a text's n-grams; none if it has no letter."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.zeros(len(points) + 2, np.uint64)
    codes[1:-1] = _letters()[points]
    inside = codes != 0
    if not inside.any():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    one = codes[inside]
    two = ((codes[:-1] << np.uint64(16)) | codes[1:])[inside[:-1] | inside[1:]] | np.uint64(1 << 60)
    three = ((codes[:-2] << np.uint64(32)) | (codes[1:-1] << np.uint64(16)) | codes[2:])[inside[1:-1]] | np.uint64(2 << 60)
    return np.unique(np.concatenate((one, two, three)), return_counts=True)


def ranked(codes: np.ndarray, counts: np.ndarray, ranks: int) -> np.ndarray:
    """The most frequent n-grams, most frequent first, equal counts by code."""
    if len(counts) > ranks:
        least = np.partition(counts, len(counts) - ranks)[len(counts) - ranks]
        keep = counts >= least
        codes, counts = codes[keep], counts[keep]
    return codes[np.lexsort((codes, -counts))][:ranks]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sums: dict[str, tuple[list, list]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            codes, counts = ngrams(text)
            a, b = sums.setdefault(lang, ([], []))
            a.append(codes)
            b.append(counts)
        for lang, (a, b) in sums.items():
            codes, inverse = np.unique(np.concatenate(a), return_inverse=True)
            n = np.bincount(inverse, np.concatenate(b), minlength=len(codes)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(codes), pa.string()), pa.array(codes.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"]
            )


def profiles(labelled: DataFrame, sample: int = SAMPLE, ranks: int = RANKS) -> list[tuple[str, list[int]]]:
    """(lang, n-grams by rank): ``ranks`` numbers a language, all that the driver sees of the corpus."""
    labelled = labelled.filter("lang is not null").select("doc_id", "lang", whole_text().alias("text"))
    share = labelled.groupBy("lang").agg((F.lit(float(sample)) / F.count(F.lit(1))).alias("share"))
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < F.col("share") * 1_000_003
    chosen = labelled.join(F.broadcast(share), "lang").filter(drawn).select("lang", "text")  # one row a language
    counts = chosen.mapInArrow(_counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")  # the n-grams of a bounded sample
    top = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= ranks)
    found: dict[str, list[int]] = {}
    for r in top.orderBy("lang", "rank").collect():
        found.setdefault(r["lang"], []).append(r["gram"])
    return sorted(found.items())


def identify(docs: DataFrame, learned: list[tuple[str, list[int]]], ranks: int = RANKS) -> DataFrame:
    """``doc_id`` and ``text`` are read; every row gets ``lang_pred`` and ``score`` beside all of its columns."""
    names = [lang for lang, _ in learned]
    tables = []
    for _, grams in learned:
        codes = np.array(grams, np.int64).view(np.uint64)
        order = np.argsort(codes)
        tables.append((codes[order], order))

    def predict(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            own = ranked(*ngrams(text), ranks) if text else ()
            if not len(own) or not names:
                out.append((UNKNOWN, 0.0))
                continue
            places, costs = np.arange(len(own)), []
            for codes, rank in tables:
                at = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
                costs.append(int(np.where(codes[at] == own, np.minimum(np.abs(rank[at] - places), ranks), ranks).sum()))
            best = int(np.argmin(costs))
            out.append((names[best], 1.0 - costs[best] / (ranks * len(own))))
        return pd.DataFrame(out, columns=["lang_pred", "score"])

    predicted = F.pandas_udf(predict, "lang_pred string, score double")(F.col("text"))
    return (
        docs.withColumn("__language", predicted)
        .withColumn("lang_pred", F.col("__language.lang_pred"))
        .withColumn("score", F.col("__language.score"))
        .drop("__language")
    )


def held_out() -> Column:
    """Documents never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame) -> list[tuple[str, list[int]]]:
    return profiles(docs.filter(~held_out() & F.col("doc_id").isNotNull()))


def op4_rank_order(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs.select("doc_id", "text"), learn(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
