"""Repeated passages as paths of a De Bruijn graph over words.

An edge is a window of ``window`` consecutive words, its ends the nodes that it shares
with the windows before and after it. Edges that several documents hold are found in two
rounds, so that only a small part of all windows is ever shuffled:

1. Every window has a minimizer, the least hash among its short word runs; equal windows
   have equal minimizers. Minimizers that two different texts hold are kept.
2. Windows with a kept minimizer become edges, known by two independent hashes of 64 and
   32 bits, and meet by hash. An edge that starts in a smaller doc_id is a repeat in every other document
   that holds it, at its source coordinates (doc_id, first word).

Repeats at neighbouring coordinates compact into one path; paths of a document are joined
back to its text, and the words that they cover go. Texts that are equal as a whole form
one class, of which only the least doc_id takes part: its copies lose every window.

Both rounds decide inside each batch what they can before the shuffle, so a passage
that a third of all documents hold sends at most two rows a batch, not one a document.

Cases: null, empty and short texts lose nothing; a row without doc_id is never a source
and loses nothing; rows that share a doc_id are no repeats of one another; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table, whole_text
from .words import hash_runs, hash_words, mix, split_words, text_blocks

WINDOW = 13
#: Words of a minimizer: fewer would be shared by chance, more would be too many.
RUN = 5
LEAST_ID = -(2**63)


def _window_minima(hashes: np.ndarray, window: int, run: int) -> np.ndarray:
    """For each window of words, the least hash among the word runs inside it."""
    low, width, span = hash_runs(hashes, run), 1, window - run + 1
    while width * 2 <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < span:
        low = np.minimum(low[: len(low) - (span - width)], low[span - width :])
    return low


def _first_of(*sorted_columns: np.ndarray) -> np.ndarray:
    """True where a row of sorted columns differs from the row before."""
    out = np.zeros(len(sorted_columns[0]), bool)
    out[:1] = True
    for c in sorted_columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def _minimizers(docs: DataFrame, window: int, run: int) -> DataFrame:
    """(minimizer, text_hash, decided): what each text holds; decided where two other texts of the batch have it."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of_text = batch.column("text_hash").to_numpy()
            found, texts = [], []
            for first, last, data, offsets in text_blocks(batch.column("text")):
                starts, ends, place = split_words(data, offsets)
                if len(starts) < window:
                    continue
                low = _window_minima(hash_words(data, starts, ends, lower=False), window, run)
                count = np.maximum(np.diff(place) - window + 1, 0)
                at = np.repeat(place[:-1] - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
                found.append(low[at])
                texts.append(np.repeat(of_text[first:last], count))
            if not found:
                continue
            m, t = np.concatenate(found).view(np.int64), np.concatenate(texts)
            new = _first_of(m, t)
            m, t = m[new], t[new]
            order = np.lexsort((t, m))
            m, t = m[order], t[order]
            new = _first_of(m, t)
            m, t = m[new], t[new]
            heads = np.flatnonzero(_first_of(m))
            rank = np.arange(len(m)) - np.repeat(heads, np.diff(np.append(heads, len(m))))
            decided = rank >= 2  # the first two tell the others of their hash
            yield pa.RecordBatch.from_arrays([pa.array(m), pa.array(t), pa.array(decided)], names=["minimizer", "text_hash", "decided"])

    return docs.select("text_hash", "text").mapInArrow(rows, "minimizer long, text_hash long, decided boolean")


def _shared_minimizers(docs: DataFrame, window: int, run: int) -> DataFrame:
    """(text_hash, minimizer) of every minimizer that two texts hold."""

    def out(m: np.ndarray, t: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(t), pa.array(m)], names=["text_hash", "minimizer"])

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, t, tied = np.zeros(0, np.int64), np.zeros(0, np.int64), False  # the last row waits for the next batch
        for batch in batches:
            decided = batch.column("decided").to_numpy(zero_copy_only=False)
            bm, bt = batch.column("minimizer").to_numpy(), batch.column("text_hash").to_numpy()
            yield out(bm[decided], bt[decided])
            m, t = np.concatenate((m, bm[~decided])), np.concatenate((t, bt[~decided]))
            if not len(m):
                continue
            new = _first_of(m, t)
            m, t = m[new], t[new]
            same = m[1:] == m[:-1]
            repeated = np.append(same, False) | np.insert(same, 0, tied)
            yield out(m[:-1][repeated[:-1]], t[:-1][repeated[:-1]])
            m, t, tied = m[-1:], t[-1:], bool(repeated[-1])
        if tied:
            yield out(m, t)

    meet = F.when(F.col("decided"), F.col("text_hash")).otherwise(F.col("minimizer"))
    dealt = _minimizers(docs, window, run).repartition(meet).sortWithinPartitions("minimizer", "text_hash")
    return dealt.mapInArrow(shared, "text_hash long, minimizer long")


_COVER = "doc_id long, tag int, first int, last int"


def _merged(doc: np.ndarray, tag: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Windows at neighbouring coordinates of a document compacted into paths (doc, tag, first word, last word + 1)."""
    order = np.lexsort((first, tag, doc))
    doc, tag, first = doc[order], tag[order], first[order]
    head = _first_of(doc, tag)
    head[1:] |= first[1:] > first[:-1] + window
    heads = np.flatnonzero(head)
    tails = np.append(heads[1:], len(doc)) - 1
    return doc[heads], tag[heads], first[heads], first[tails] + window if len(heads) else first[heads]


def _edges(texts: DataFrame, window: int, run: int) -> DataFrame:
    """Windows with a shared minimizer. Rows with ``decided`` are paths that a smaller doc_id of the batch repeats."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tags = batch.column("doc_id").to_numpy(), batch.column("tag").to_numpy()
            wanted = batch.column("minimizers")
            parts = []
            for first, last, data, offsets in text_blocks(batch.column("text")):
                starts, ends, place = split_words(data, offsets)
                words = hash_words(data, starts, ends, lower=False)
                if len(words) < window:
                    continue
                low = _window_minima(words, window, run).view(np.int64)
                edge = hash_runs(words, window).view(np.int64)
                check = hash_runs(mix(words ^ np.uint64(0xA5A5A5A5F0F0F0F0)), window).astype(np.uint32).view(np.int32)
                for i in range(last - first):
                    a, b = place[i], place[i + 1] - window + 1
                    if b > a:
                        at = np.flatnonzero(np.isin(low[a:b], wanted[first + i].values.to_numpy()))
                        n = len(at)
                        parts.append((edge[a + at], check[a + at], np.full(n, ids[first + i]), np.full(n, tags[first + i]), at.astype(np.int32)))
            if not parts:
                continue
            edge, check, doc, tag, at = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.lexsort((doc, check, edge))
            edge, check, doc, tag, at = edge[order], check[order], doc[order], tag[order], at[order]
            heads = np.flatnonzero(_first_of(edge, check))
            least = np.repeat(doc[heads], np.diff(np.append(heads, len(doc))))
            later = doc > least
            paths = _merged(doc[later], tag[later], at[later], window)
            n = len(paths[0])
            own = ~later
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate((edge[own], mix((paths[0] + paths[2]).view(np.uint64)).view(np.int64)))),
                    pa.array(np.concatenate((check[own], np.zeros(n, np.int32)))),
                    pa.array(np.concatenate((doc[own], paths[0]))),
                    pa.array(np.concatenate((tag[own], paths[1])).astype(np.int32)),
                    pa.array(np.concatenate((at[own], paths[2])).astype(np.int32)),
                    pa.array(np.concatenate((np.zeros(own.sum()), paths[3])).astype(np.int32)),
                ],
                names=["edge", "check", "doc_id", "tag", "first", "last"],
            )

    return texts.select("doc_id", "tag", "text", "minimizers").mapInArrow(rows, "edge long, check int, " + _COVER)


def _repeats(edges: DataFrame, window: int) -> DataFrame:
    """Paths (doc_id, tag, first, last) of edges that start in a smaller doc_id too."""

    def out(*columns: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["doc_id", "tag", "first", "last"])

    def later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple | None = None  # edge, check and least doc_id of the batch's last edge
        for batch in batches:
            edge, check, doc, tag, first, last = (batch.column(i).to_numpy() for i in range(6))
            path = last > 0
            yield out(doc[path], tag[path], first[path], last[path])
            edge, check, doc, tag, first = (c[~path] for c in (edge, check, doc, tag, first))
            if not len(edge):
                continue
            heads = np.flatnonzero(_first_of(edge, check))
            source = doc[heads]
            if known is not None and (edge[0], check[0]) == known[:2]:
                source[0] = known[2]
            least = np.repeat(source, np.diff(np.append(heads, len(doc))))
            known = (edge[-1], check[-1], least[-1])
            again = doc > least
            yield out(*(x.astype(t) for x, t in zip(_merged(doc[again], tag[again], first[again], window), ("i8", "i4", "i4", "i4"), strict=True)))

    return edges.repartition("edge").sortWithinPartitions("edge", "check", "doc_id").mapInArrow(later, _COVER)


def _without(words: list[bytes], paths: list[tuple[int, int]]) -> list[bytes]:
    if paths and paths[0][1] < 0:
        return []
    kept, at = [], 0
    for first, last in sorted(paths):
        if first > at:
            kept += words[at:first]
        at = max(at, last)
    return kept + words[at:]


def _tag(text_hash: Column) -> Column:
    """Tells texts under one doc_id apart."""
    return F.coalesce(F.pmod(text_hash, F.lit(30_011)).cast("int"), F.lit(0))


def drop_repeats(docs: DataFrame, window: int = WINDOW, run: int = RUN) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text (words joined by one space) for every row of ``docs``."""
    text = whole_text()
    # without nulls in its keys the table is shuffled once for both joins
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID)).alias("doc_id"), text.alias("text")).select(
        "doc_id", F.xxhash64("text").alias("text_hash"), _tag(F.xxhash64("text")).alias("tag"), "text"
    )
    named = rows.filter(F.col("doc_id") != LEAST_ID)
    classes = named.groupBy("text_hash", F.xxhash64(F.lit(17), "text").alias("second")).agg(F.min("doc_id").alias("least"))
    minimizers = (
        _shared_minimizers(named, window, run)
        .groupBy("text_hash")
        .agg(F.collect_list("minimizer").alias("minimizers"))  # as long as one text
        .join(classes, "text_hash")
        .select(F.col("least").alias("doc_id"), _tag(F.col("text_hash")).alias("tag"), "minimizers")
    )
    texts = rows.select("doc_id", "tag", "text")
    paths = _repeats(_edges(texts.join(minimizers, ["doc_id", "tag"]), window, run), window)
    copies = (
        named.select("doc_id", "tag", "text_hash", F.xxhash64(F.lit(17), "text").alias("second"))
        .join(classes, ["text_hash", "second"])
        .filter("doc_id > least")
        .select("doc_id", "tag", F.lit(0).alias("first"), F.lit(-1).alias("last"))
    )
    covered = paths.union(copies).groupBy("doc_id", "tag").agg(F.array_sort(F.collect_list(F.struct("last", "first"))).alias("paths"))
    splitter = re.compile(rb"[^\x20\x09-\x0D]+")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, kept = [], [], []
            spans = batch.column("paths").to_pylist()
            for value, found in zip(batch.column("text"), spans, strict=True):
                words = splitter.findall(value.as_buffer().to_pybytes()) if value.is_valid else []
                left = words
                if found and len(words) >= window:
                    left = _without(words, [(p["first"], p["last"]) for p in found])
                n.append(len(words))
                gone.append(len(words) - len(left))
                kept.append(b" ".join(left).decode())
            yield pa.RecordBatch.from_arrays(
                [pc.if_else(pc.equal(batch.column("doc_id"), LEAST_ID), None, batch.column("doc_id")), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_text"],
            )

    return texts.join(covered, ["doc_id", "tag"], "left").select("doc_id", "text", "paths").mapInArrow(
        apply, "doc_id long, n_words long, n_removed long, kept_text string"
    )


def op10_debruijn(spark, sf_dir: str) -> DataFrame:
    return drop_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


OP10_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
wins AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)),
first AS (SELECT g, min(doc_id) AS least FROM wins GROUP BY g),
gone AS (
  SELECT DISTINCT doc_id, i + k AS i
  FROM (SELECT wins.doc_id, wins.i FROM wins JOIN first ON wins.g = first.g WHERE first.least < wins.doc_id), range(13) r(k)),
words AS (SELECT doc_id, ws[i] AS word, i FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w))
SELECT d.doc_id, count(x.i) AS n_words, count(g.i) AS n_removed,
       sha256(coalesce(string_agg(x.word, ' ' ORDER BY x.i) FILTER (g.i IS NULL), '')) AS kept_sha256
FROM documents d LEFT JOIN words x ON x.doc_id = d.doc_id LEFT JOIN gone g ON g.doc_id = x.doc_id AND g.i = x.i
GROUP BY d.doc_id
"""
