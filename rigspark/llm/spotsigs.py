"""SpotSigs fingerprints: chains of content words behind common words.

Every common word (an anchor) of a text opens a signature: the anchor and the next
``chain`` words that are no anchors. A fingerprint is the set of a text's signatures, 32
bits each, and the likeness of two fingerprints their Jaccard coefficient. A text without
any anchor takes each of its words as one.

``similar_sets`` joins fingerprints: equal sets form a class, sets are partitioned by
length such that only neighbouring partitions can be similar enough, only a prefix of
the rarest signatures is posted, and candidates are compared by a Jaccard that stops
where the threshold is out of reach.

Cases: a null text counts as empty, and an empty set is like another empty set alone;
repeated rows and equal ids follow each other in the order of their text's hash; rows
without doc_id come last; a single row is its own successor; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import table, whole_text
from .words import hash_runs, hash_words, mix, split_words, text_blocks

#: The commonest function words of four languages.
ANCHORS = (
    "the of and to in a is that it on for was as be with by at from are this "
    "der die und das den von zu mit ist des im für auf ein eine "
    "de la le les et en un une du que est pour dans qui sur "
    "el los las y del por con se no una al lo"
).split()
CHAIN = 2
LEAST_ID = -(2**63)

_anchor_hashes: dict[tuple[str, ...], np.ndarray] = {}


def _hashes_of(words: tuple[str, ...]) -> np.ndarray:
    if words not in _anchor_hashes:
        data = np.frombuffer(" ".join(words).encode(), np.uint8)
        starts, ends, _ = split_words(data, np.array([0, len(data)]), signs=True)
        _anchor_hashes[words] = np.unique(hash_words(data, starts, ends, lower=True))
    return _anchor_hashes[words]


def signature_sets(texts: pa.Array, anchors: tuple[str, ...] = tuple(ANCHORS), chain: int = CHAIN) -> Iterator[np.ndarray]:
    """The sorted distinct 32-bit signatures of each text."""
    common = _hashes_of(anchors)
    for first, last, data, offsets in text_blocks(texts):
        starts, ends, place = split_words(data, offsets, signs=True)
        words = hash_words(data, starts, ends, lower=True)
        anchor = np.isin(words, common)
        for i in range(last - first):
            own, is_anchor = words[place[i] : place[i + 1]], anchor[place[i] : place[i + 1]]
            content = own[~is_anchor]
            at = np.flatnonzero(is_anchor)
            if not len(at) or not len(content):  # every word is an anchor, and what follows its chain
                content, at = own, np.arange(len(own))
                after = at + 1
            else:
                after = at - np.arange(len(at))  # content words before the anchor
            out = own[at]
            padded = np.concatenate((content, np.zeros(chain, np.uint64)))
            for k in range(chain):
                out = mix(out * np.uint64(0x9E3779B97F4A7C15) + padded[np.minimum(after + k, len(padded) - 1)])
            yield np.unique((out >> np.uint64(32)).astype("<u4"))


def pruned_jaccard(a: np.ndarray, b: np.ndarray, threshold: float = 0.0) -> float:
    """Jaccard coefficient of two sorted sets; 0 where their lengths put ``threshold`` out of reach."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if min(len(a), len(b)) < threshold * max(len(a), len(b)):
        return 0.0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[at] == a).sum())
    return both / (len(a) + len(b) - both)


def fingerprint(signatures: np.ndarray) -> str:
    return base64.b64encode(signatures.tobytes()).decode()


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and ``signatures`` (array of long, sorted) of every text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.astype(np.int64) for s in signature_sets(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["doc_id", "signatures"])

    return docs.select("doc_id", "text").mapInArrow(rows, "doc_id long, signatures array<long>")


def similar_sets(prints: DataFrame, threshold: float = 0.75) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b, likeness) of class representatives at or above ``threshold``, and (doc_id, representative) of all rows."""
    rows = prints.filter(F.size("signatures") > 0).select("doc_id", "signatures", F.md5(F.array_join("signatures", ",").cast("binary")).alias("same"))
    least = rows.groupBy("same").agg(F.min("doc_id").alias("representative"))
    members = rows.join(least, "same").select("doc_id", "representative")
    sets = rows.join(least.select("same", F.col("representative").alias("doc_id")), ["same", "doc_id"]).dropDuplicates(["same"]).select("doc_id", "signatures")
    size = F.size("signatures")
    # sets of partition p are similar enough to sets of p and p + 1 only
    part = F.floor(F.log(size.cast("double")) / -math.log(threshold) + 1e-9).cast("int")
    single = sets.select("doc_id", size.alias("n"), part.alias("part"), F.explode("signatures").alias("s"))
    often = single.groupBy("s").agg(F.count(F.lit(1)).alias("often"))
    rarest = Window.partitionBy("doc_id").orderBy("often", "s")
    posted = (
        single.join(often, "s")
        .withColumn("k", F.row_number().over(rarest))
        .filter(F.col("k") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1)
        .select("doc_id", "n", "part", "s")
    )
    low = posted.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.explode(F.array("part", F.col("part") + 1)).alias("part"), "s", F.col("part").alias("pa"))
    high = posted.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), "part", "s")
    ordered = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    near = F.col("na") >= F.col("nb") * threshold
    pairs = low.join(high, ["s", "part"]).filter(ordered & near).select("a", "b").distinct()
    both = F.size(F.array_intersect("x", "y"))
    compared = (
        pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("signatures").alias("x")), "a")
        .join(sets.select(F.col("doc_id").alias("b"), F.col("signatures").alias("y")), "b")
        .withColumn("likeness", both / (F.size("x") + F.size("y") - both))
    )
    return compared.filter(F.col("likeness") >= threshold).select("a", "b", "likeness"), members


def _edited(text: str, after: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def _with_successor(docs: DataFrame, bucket_bytes: int, most_buckets: int) -> tuple[DataFrame, int]:
    """Rows in buckets of neighbouring doc_id, each bucket closed by a copy of the row that follows it; and the number of buckets.

    Cuts are quantiles of doc_id. The driver sees them alone: ``most_buckets`` numbers at most.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID)).alias("place"), whole_text().alias("text")
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = min(most_buckets, size // bucket_bytes + 1)
    cuts = rows.agg(F.percentile_approx("place", [i / buckets for i in range(1, buckets)] or [0.5], max(10 * buckets, 10_000))).first()[0] or []
    splits = [-math.inf, *(sorted({float(c) for c in cuts}) or [0.0]), math.inf]
    dealt = Bucketizer(splits=splits, inputCol="where", outputCol="bucket").transform(rows.withColumn("where", F.col("place").cast("double"))).drop("where")
    tops = dealt.groupBy("bucket").agg(F.max("place").alias("place"))
    last = tops.agg(F.max("place").alias("top"))
    downwards = Window.orderBy(F.desc("bucket"))  # one row a bucket
    follow = tops.crossJoin(F.broadcast(last)).select(F.col("bucket").alias("closes"), F.coalesce(F.lead("place").over(downwards), F.col("top")).alias("place"))
    copies = dealt.drop("bucket").join(F.broadcast(follow), "place")  # numbers, one row a bucket
    # of rows that share the doc_id, the one that comes first
    first = copies.groupBy("closes", "place", "doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return dealt.select("bucket", F.lit(False).alias("closing"), "place", "doc_id", "text").union(
        first.select(F.col("closes").alias("bucket"), F.lit(True), "place", "doc_id", "text")
    ), buckets


def compare_edits(docs: DataFrame, bucket_bytes: int = 4 << 20, most_buckets: int = 1_000_000) -> DataFrame:
    """Each text's fingerprint beside that of its edited text (the second half replaced by
    the head of the next text in falling doc_id) and that of the next text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # the last row, which waits for its successor
        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                part = batch.slice(first, 1000)
                texts = part.column("text")
                new = list(zip(part.column("bucket").to_pylist(), part.column("closing").to_pylist(), part.column("doc_id").to_pylist(), texts.to_pylist(), signature_sets(texts), strict=True))
                run = held + new
                pairs = [(x, y) for x, y in zip(run, run[1:], strict=False) if not x[1] and x[0] == y[0]]
                held = run[-1:]
                changed = [_edited(x[3], y[3]) for x, y in pairs]
                out = []
                for (x, y), text, own in zip(pairs, changed, signature_sets(pa.array(changed, pa.large_string())), strict=True):
                    out.append((x[2], len(x[3]), hashlib.sha256(text.encode()).hexdigest(), fingerprint(x[4]), fingerprint(own), pruned_jaccard(x[4], own), pruned_jaccard(x[4], y[4]), len(x[4])))
                if out:
                    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_signatures"]
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_signatures int"
    order = [F.desc("bucket"), "closing", F.desc("place"), F.xxhash64("text")]
    placed, buckets = _with_successor(docs, bucket_bytes, most_buckets)
    dealt = placed.repartition(int(buckets), "bucket").sortWithinPartitions(*order)  # about one bucket a task
    return dealt.select("bucket", "closing", "doc_id", "text").mapInArrow(rows, schema)


def op2_spotsigs(spark, sf_dir: str) -> DataFrame:
    return compare_edits(table(spark, sf_dir, "documents"))
