"""Document quality by a factorisation machine.

A text's features are its words, hashed into ``BUCKETS`` places and weighted by the logarithm of
their counts, statistics of its structure, and numeric metadata of its row. Every feature has
a weight and a vector of ``RANK`` numbers; two features interact by the product of their
vectors. The sum over all pairs is half of the squared sum of the weighted vectors less
the sum of their squares, so a score takes time linear in the features of a text.

The machine learns from at most ``SAMPLE`` labelled documents of either class, drawn by a hash of
doc_id; classes count as often as they do among all labels. Features of the sample (at
most ``BUCKETS`` a document) are all that the driver sees. Scoring reads whole texts, a megabyte
at a time, one longer text alone.

Cases: a null text is empty, and an empty text is scored by its statistics; labels other than 0 and
1, labels of unknown documents and rows without doc_id teach nothing; of rows that share a doc_id
the one of least features is learned from, with each of its labels; with labels of one class alone
the score is that class's smoothed share, without any it is 0.5; metadata that is null or missing is marked
as such; very long texts have logarithmic weights like others; repeated rows have equal scores; an
empty table gives no rows; extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table, whole_text
from .words import hash_words, split_words, text_blocks

BUCKETS = 1 << 14
RANK = 8
#: Documents of a class to learn from, at most.
SAMPLE = 3_000
EPOCHS = 12
BATCH = 64
RATE = 0.05
DECAY = 1e-5
#: Numeric columns of ``documents`` that are read beside the text.
METADATA = ("n_chars",)

STATISTICS = (
    "log_bytes", "log_words", "word_length", "long_words", "distinct_words", "top_word", "letters", "upper", "digits", "signs", "wide",
    "spaces", "words_ending_in_signs", "words_without_letters", "words_all_upper", "lines", "line_length", "sign_runs",
)

_KIND = np.zeros(256, np.uint8)  # 0 white space, 1 lower case, 2 upper case, 3 digit, 4 sign, 5 beyond ASCII
_KIND[:] = 4
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 1, 2, 3, 5


def _sums(flags: np.ndarray, edges: np.ndarray, ends: np.ndarray | None = None) -> np.ndarray:
    """Sums of ``flags`` between consecutive edges, or from each edge to its end."""
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[edges[1:]] - total[edges[:-1]] if ends is None else total[ends] - total[edges]


def block_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, bucket, weight) of the words of a block, by document and bucket, and a row of statistics a document."""
    n = len(offsets) - 1
    kind = _KIND[data]
    starts, ends, first = split_words(data, offsets)
    hashes = hash_words(data, starts, ends, lower=True)
    length, words = np.diff(offsets), np.diff(first)
    doc_of_word = np.repeat(np.arange(n), words)

    keys, counts = np.unique(doc_of_word * BUCKETS + (hashes % np.uint64(BUCKETS)).astype(np.int64), return_counts=True)
    doc, bucket = keys // BUCKETS, keys % BUCKETS
    weight = 1 + np.log(counts)
    norm = np.sqrt(np.bincount(doc, weight**2, minlength=n))
    top = np.zeros(n)
    np.maximum.at(top, doc, counts)

    size, number = np.maximum(length, 1), np.maximum(words, 1)
    share = {k: _sums(kind == k, offsets) / size for k in range(6)}
    letters = _sums((kind == 1) | (kind == 2) | (kind == 5), starts, ends)
    upper, lower = _sums(kind == 2, starts, ends), _sums((kind == 1) | (kind == 5), starts, ends)
    of_words = lambda x: np.bincount(doc_of_word, x, minlength=n) / number
    run = np.zeros(len(data), bool)
    run[1:] = (kind[1:] == 4) & (data[1:] == data[:-1])
    inner = offsets[1:-1]
    run[inner[inner < len(data)]] = False
    lines = _sums(data == 10, offsets) + 1
    stats = np.stack(
        [
            np.log1p(length), np.log1p(words), of_words(ends - starts), of_words(ends - starts > 15), np.bincount(doc, minlength=n) / number,
            top / number, share[1] + share[2] + share[5], share[2], share[3], share[4], share[5], share[0],
            of_words(kind[ends - 1] == 4), of_words(letters == 0), of_words((upper > 1) & (lower == 0)), np.log1p(lines / number), np.log1p(length / lines),
            _sums(run, offsets) / size,
        ],
        axis=1,
    )
    return doc, bucket, weight / norm[doc], stats


def _metadata(columns: list[np.ndarray], n: int) -> np.ndarray:
    """For each column its signed logarithm, and whether it is missing."""
    out = np.zeros((n, 2 * len(columns)))
    for i, values in enumerate(columns):
        known = np.isfinite(values)
        out[known, 2 * i] = np.sign(values[known]) * np.log1p(np.abs(values[known]))
        out[~known, 2 * i + 1] = 1
    return out


@dataclass
class Machine:
    """Weights and vectors: words first, then statistics and metadata, which are centred and scaled."""

    bias: float
    weights: np.ndarray
    vectors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray

    def dense(self, stats: np.ndarray) -> np.ndarray:
        return np.clip((stats - self.centre) / self.scale, -4, 4) / np.sqrt(len(self.centre))

    def raw(self, doc: np.ndarray, bucket: np.ndarray, weight: np.ndarray, dense: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the logistic function, and the summed vectors of each document."""
        n = len(dense)
        v, rest = self.vectors[:BUCKETS], self.vectors[BUCKETS:]
        mine = v[bucket] * weight[:, None]
        sums, squares = dense @ rest, (dense**2) @ rest**2
        for f in range(self.vectors.shape[1]):
            sums[:, f] += np.bincount(doc, mine[:, f], minlength=n)
            squares[:, f] += np.bincount(doc, mine[:, f] ** 2, minlength=n)
        linear = np.bincount(doc, self.weights[bucket] * weight, minlength=n) + dense @ self.weights[BUCKETS:]
        return self.bias + linear + 0.5 * (sums**2 - squares).sum(axis=1), sums

    def score(self, doc: np.ndarray, bucket: np.ndarray, weight: np.ndarray, stats: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(doc, bucket, weight, self.dense(stats))[0], -40, 40)))


def constant(share: float, columns: int) -> Machine:
    """Every document has the same score."""
    return Machine(float(np.log(share / (1 - share))), np.zeros(BUCKETS + columns), np.zeros((BUCKETS + columns, RANK)), np.zeros(columns), np.ones(columns))


def fit(documents: list[tuple[np.ndarray, np.ndarray]], stats: np.ndarray, target: np.ndarray, cost: np.ndarray, epochs: int = EPOCHS) -> Machine:
    """A machine fitted to (buckets, weights) and statistics of documents by adaptive gradient steps on the logistic loss."""
    rng = np.random.default_rng(0)
    features = BUCKETS + stats.shape[1]
    centre, scale = stats.mean(axis=0), stats.std(axis=0)
    out = Machine(0.0, np.zeros(features), rng.normal(0, 0.05, (features, RANK)), centre, np.where(scale > 1e-9, scale, 1.0))
    dense = out.dense(stats)
    bias_seen, weights_seen, vectors_seen = 1e-8, np.full(features, 1e-8), np.full((features, RANK), 1e-8)
    for _ in range(epochs):
        order = rng.permutation(len(documents))
        for first in range(0, len(order), BATCH):
            chosen = order[first : first + BATCH]
            doc = np.repeat(np.arange(len(chosen)), [len(documents[i][0]) for i in chosen])
            bucket = np.concatenate([documents[i][0] for i in chosen])
            weight = np.concatenate([documents[i][1] for i in chosen])
            own = dense[chosen]
            raw, sums = out.raw(doc, bucket, weight, own)
            slope = cost[chosen] * (1 / (1 + np.exp(-np.clip(raw, -40, 40))) - target[chosen]) / len(chosen)

            touched, at = np.unique(bucket, return_inverse=True)
            to = np.concatenate((touched, np.arange(BUCKETS, features)))
            pull = slope[doc] * weight
            weights_by = np.concatenate((np.bincount(at, pull, minlength=len(touched)), slope @ own)) + DECAY * out.weights[to]
            vectors_by = DECAY * out.vectors[to]
            squared = np.concatenate((np.bincount(at, pull * weight, minlength=len(touched)), slope @ own**2))
            for f in range(RANK):
                vectors_by[: len(touched), f] += np.bincount(at, pull * sums[doc, f], minlength=len(touched))
            vectors_by[len(touched) :] += (own * slope[:, None]).T @ sums
            vectors_by -= squared[:, None] * out.vectors[to]

            bias_seen += slope.sum() ** 2
            out.bias -= RATE * slope.sum() / np.sqrt(bias_seen)
            weights_seen[to] += weights_by**2
            out.weights[to] -= RATE * weights_by / np.sqrt(weights_seen[to])
            vectors_seen[to] += vectors_by**2
            out.vectors[to] -= RATE * vectors_by / np.sqrt(vectors_seen[to])
    return out


def _features(docs: DataFrame, metadata: list[str], keep: list[str]) -> DataFrame:
    """``keep`` columns, buckets and weights of the words, and the dense features."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = _metadata([batch.column(f"__m{i}").to_numpy(zero_copy_only=False) for i in range(len(metadata))], batch.num_rows)
            for first, last, data, offsets in text_blocks(batch.column("text")):
                doc, bucket, weight, stats = block_features(data, offsets)
                edges = pa.array(np.searchsorted(doc, np.arange(last - first + 1)), pa.int32())
                stats = np.concatenate((stats, numbers[first:last]), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(first, last - first) for c in keep]
                    + [pa.ListArray.from_arrays(edges, pa.array(bucket, pa.int32())), pa.ListArray.from_arrays(edges, pa.array(weight)), pa.array(list(stats), pa.list_(pa.float64()))],
                    names=[*keep, "buckets", "weights", "stats"],
                )

    types = dict(docs.dtypes)
    shape = ", ".join(f"{c} {types[c]}" for c in keep)
    numbers = [F.col(c).cast("double").alias(f"__m{i}") for i, c in enumerate(metadata)]
    return docs.select(*keep, whole_text().alias("text"), *numbers).mapInArrow(rows, f"{shape}, buckets array<int>, weights array<double>, stats array<double>")


def _known(docs: DataFrame, metadata: tuple[str, ...]) -> list[str]:
    return [c for c in metadata if c in docs.columns]


def learn(docs: DataFrame, labels: DataFrame, metadata: tuple[str, ...] = METADATA, sample: int = SAMPLE) -> Machine:
    """A machine of ``labels`` (doc_id, quality) and the documents that they name."""
    metadata = _known(docs, metadata)
    columns = len(STATISTICS) + 2 * len(metadata)
    taught = labels.filter("doc_id is not null and quality in (0, 1)").select("doc_id", F.col("quality").cast("int").alias("quality"))
    number = {r["quality"]: r["n"] for r in taught.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    drawn = [taught.filter(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for q in (0, 1)]
    ids = drawn[0].union(drawn[1])
    chosen = docs.join(F.broadcast(ids.select("doc_id").distinct()), "doc_id", "left_semi")  # at most two samples of ids
    made = _features(chosen, metadata, ["doc_id"])
    one = made.groupBy("doc_id").agg(F.min(F.struct("buckets", "weights", "stats")).alias("own"))
    rows = sorted(one.join(ids, "doc_id").select("doc_id", "quality", "own").collect(), key=lambda r: (r["doc_id"], r["quality"]))
    target = np.array([r["quality"] for r in rows], float)
    if len(set(target.tolist())) < 2:
        return constant((target.sum() + 1) / (len(target) + 2), columns)
    share = {q: number[q] / (target == q).sum() for q in (0, 1)}
    cost = np.where(target == 1, share[1], share[0])
    documents = [(np.array(r["own"]["buckets"], np.int64), np.array(r["own"]["weights"])) for r in rows]
    return fit(documents, np.array([r["own"]["stats"] for r in rows]), target, cost / cost.mean())


def score(docs: DataFrame, machine: Machine, metadata: tuple[str, ...] = METADATA) -> DataFrame:
    """Every row with ``score`` (0 to 1, higher: quality 1 likelier) and ``predicted`` beside all of its columns."""
    metadata = _known(docs, metadata)
    model = docs.sparkSession.sparkContext.broadcast(machine)  # a little over a megabyte, whatever the corpus

    def scores(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for part in parts:
            texts, *columns = part if isinstance(part, tuple) else (part,)
            numbers = _metadata([c.to_numpy(float) for c in columns], len(texts))
            out = np.zeros(len(texts))
            for first, last, data, offsets in text_blocks(pa.array(texts, pa.large_string())):
                doc, bucket, weight, stats = block_features(data, offsets)
                out[first:last] = model.value.score(doc, bucket, weight, np.concatenate((stats, numbers[first:last]), axis=1))
            yield pd.Series(out)

    scored = F.pandas_udf(scores, "double")(whole_text(), *[F.col(c).cast("double") for c in metadata])
    return docs.withColumn("score", scored).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def held_out() -> Column:
    """Documents never learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")) % 3 == 1, F.lit(False))


def op12_factorisation_machine(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    machine = learn(docs, table(spark, sf_dir, "labels").filter(~held_out()))
    return score(docs, machine).select("doc_id", held_out().alias("held_out"), "score", "predicted")
