"""Product codes of vectors, their nearest codebook entries found through memoised grid cells.

Components become integers, so that every distance, sum and mean is exact and a run gives
the same codes on any number of machines. A part of a vector lies in a cell of a coarse
grid. An entry whose least distance to the cell's box exceeds another entry's greatest one
is dominated across the whole box: it is nearest to no point of it. The cell is hashed, the
entries that are left are kept under its hash, and only those are evaluated for every
part that falls into the cell.

Training passes send sums of at most ``entries`` rows a part and task; the driver sees the
codebooks alone.

Cases: a vector that is null, empty or holds a null or non-finite component is dropped, and so
are vectors of another length than the most frequent one (the longer of two). A length that
the parts do not divide is filled with zeros at its end. Integers beyond the size at which
a squared distance would leave 64 bits are set to that size (2**27 for 64 components).
Distances that tie go to the lower entry; equal vec_ids are ordered by their vectors, a
null vec_id after all others. With fewer vectors than entries the codebooks are as short.
Labels that are null are one label; repeated rows are coded like others; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage, table
from .words import mix

PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Components are multiplied by this before they are rounded down.
SCALE = 1024
#: Edge of a grid cell, in integer units.
CELL = 32
#: Cells that a worker remembers for a part; beyond, it starts anew.
REMEMBERED = 50_000
#: Parts that are assigned at once.
BLOCK_ROWS = 4_096


def _ranges(first: np.ndarray, number: np.ndarray) -> np.ndarray:
    """The numbers ``first[i]``, ``first[i] + 1``, ... of every range behind one another."""
    return np.repeat(first - np.cumsum(number) + number, number) + np.arange(number.sum())


class CellMemo:
    """Nearest entries of one part's codebook, with the entries worth a look remembered by cell."""

    def __init__(self, book: np.ndarray, cell: int = CELL):
        self.book, self.cell = book.astype(np.int64), cell
        self.evaluated = self.asked = self.made = 0
        self._begin()

    def _begin(self) -> None:
        self.hashes = np.zeros(0, np.uint64)  # ascending; cells and spans go with them
        self.cells = np.zeros((0, self.book.shape[1]), np.int64)
        self.spans = np.zeros((0, 2), np.int64)
        self.candidates = np.arange(len(self.book))  # begins with the list of all entries

    def undominated(self, cells: np.ndarray) -> np.ndarray:
        """For each cell, which entries are nearest to some point of its box or may be."""
        near = np.zeros((len(cells), len(self.book)), np.int64)
        far = np.zeros_like(near)
        for d in range(cells.shape[1]):
            edges, back = np.unique(cells[:, d], return_inverse=True)
            low = (edges * self.cell)[:, None]
            high = low + self.cell - 1
            at = self.book[:, d][None]
            near += (np.maximum(np.maximum(low - at, at - high), 0) ** 2)[back]
            far += (np.maximum(np.abs(at - low), np.abs(high - at)) ** 2)[back]
        return near <= far.min(axis=1, keepdims=True)

    def _lists(self, cells: np.ndarray) -> np.ndarray:
        """(first, number) of the remembered entries of each row's cell."""
        hashes, at, back = np.unique(_hashed(cells), return_index=True, return_inverse=True)
        own = cells[at]
        place = np.searchsorted(self.hashes, hashes)
        known = np.zeros(len(hashes), bool)
        known[place < len(self.hashes)] = self.hashes[place[place < len(self.hashes)]] == hashes[place < len(self.hashes)]
        new = np.flatnonzero(~known)
        if len(new):
            kept = self.undominated(own[new])
            number = kept.sum(axis=1)
            first = len(self.candidates) + np.cumsum(number) - number
            self.candidates = np.concatenate((self.candidates, np.nonzero(kept)[1]))
            self.hashes = np.insert(self.hashes, place[new], hashes[new])
            self.cells = np.insert(self.cells, place[new], own[new], axis=0)
            self.spans = np.insert(self.spans, place[new], np.stack([first, number], axis=1), axis=0)
            self.made += len(new)
        place = np.searchsorted(self.hashes, hashes)[back]
        # a cell under the hash of another one, which is next to impossible, looks at all entries
        same = (self.cells[place] == cells).all(axis=1)
        return np.where(same[:, None], self.spans[place], [[0, len(self.book)]])

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of each part."""
        if len(self.hashes) > REMEMBERED:
            self._begin()
        spans = self._lists(parts // self.cell)
        entry = self.candidates[_ranges(spans[:, 0], spans[:, 1])]
        row = np.repeat(np.arange(len(parts)), spans[:, 1])
        distance = np.zeros(len(row), np.int64)
        for d in range(parts.shape[1]):
            distance += (parts[row, d] - self.book[entry, d]) ** 2
        least = np.minimum.reduceat(distance, np.cumsum(spans[:, 1]) - spans[:, 1])
        hits = np.flatnonzero(distance == least[row])  # lists are ascending: the first hit of a row is the lowest entry
        self.asked += len(parts)
        self.evaluated += len(row)
        return entry[hits[np.searchsorted(row[hits], np.arange(len(parts)))]], least


def _hashed(cells: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of cell coordinates."""
    out = np.full(len(cells), cells.shape[1], np.uint64)
    for d in range(cells.shape[1]):
        out = mix(out + cells[:, d].astype(np.uint64))
    return out


_memos: dict[bytes, list[CellMemo]] = {}


def _memo(books: np.ndarray, cell: int) -> list[CellMemo]:
    """The worker's memo of these codebooks; that of earlier ones goes."""
    key = hashlib.sha256(books.tobytes() + cell.to_bytes(8, "little")).digest()
    if key not in _memos:
        _memos.clear()
        _memos[key] = [CellMemo(book, cell) for book in books]
    return _memos[key]


def _blocks(batch: pa.RecordBatch, books: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, parts of the rows by position) of a batch, a block at a time; short vectors end in zeros."""
    column = batch.column("integers")
    parts, _, width = books.shape
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)
    for first in range(0, len(flat), BLOCK_ROWS):
        block = flat[first : first + BLOCK_ROWS]
        filled = np.zeros((len(block), parts * width), np.int64)
        filled[:, : block.shape[1]] = block
        yield first, filled.reshape(len(block), parts, width)


def finite(vector: Column) -> Column:
    """Whether a vector is there, has components, and all of them are finite numbers."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & good, F.lit(False))


def integer_vectors(vectors: DataFrame, column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id, label and ``integers`` of the vectors that are kept, all of one length."""
    kept = vectors.filter(finite(F.col(column))).select("vec_id", "label", F.col(column).cast("array<double>").alias("__v"))
    lengths = kept.groupBy(F.size("__v").alias("n")).count()
    usual = lengths.orderBy(F.desc("count"), F.desc("n")).first()  # one row a length
    length = usual["n"] if usual else 1
    most = math.isqrt(2**61 // max(length, 1))
    whole = lambda x: F.least(F.greatest(F.floor(x * scale), F.lit(-most)), F.lit(most)).cast("int")
    return kept.filter(F.size("__v") == length).select("vec_id", "label", F.transform("__v", whole).alias("integers"))


def first_books(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray:
    """parts x entries x width: the parts of the ``entries`` smallest vec_ids, all that the driver takes."""
    rows = kept.select("vec_id", "integers").orderBy(F.asc_nulls_last("vec_id"), "integers").limit(entries).collect()
    if not rows:
        return np.zeros((parts, 0, 1), np.int64)
    width = -(-len(rows[0]["integers"]) // parts)
    filled = np.zeros((len(rows), parts * width), np.int64)
    filled[:, : len(rows[0]["integers"])] = [r["integers"] for r in rows]
    return filled.reshape(len(rows), parts, width).transpose(1, 0, 2).copy()


def _moved(kept: DataFrame, books: np.ndarray, cell: int) -> np.ndarray:
    """One Lloyd round: every used entry becomes the mean of its parts, rounded down."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memos, total = _memo(books, cell), np.zeros_like(books)
        number = np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            for _, block in _blocks(batch, books):
                for p, memo in enumerate(memos):
                    entry, _ = memo.nearest(block[:, p])
                    number[p] += np.bincount(entry, minlength=books.shape[1])
                    np.add.at(total[p], entry, block[:, p])
        part, entry = np.nonzero(number)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(number[part, entry]), pa.array(list(total[part, entry]), pa.list_(pa.int64()))],
            names=["part", "entry", "number", "total"],
        )

    added = F.array(*[F.sum(F.col("total")[i]) for i in range(books.shape[2])])
    found = (
        kept.select("integers")
        .mapInArrow(sums, "part int, entry int, number long, total array<long>")
        .groupBy("part", "entry")
        .agg(F.sum("number").alias("number"), added.alias("total"))
        .collect()  # at most parts x entries rows
    )
    out = books.copy()
    for r in found:
        out[r["part"], r["entry"]] = [x // r["number"] for x in r["total"]]
    return out


def train(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, cell: int = CELL) -> np.ndarray:
    """Codebooks (parts x entries x width) of ``integer_vectors``."""
    books = first_books(kept, parts, entries)
    for _ in range(rounds if books.size else 0):
        books = _moved(kept, books, cell)
    return books


def encode(kept: DataFrame, books: np.ndarray, cell: int = CELL) -> DataFrame:
    """vec_id, label, code and error of every vector. A code has two hex digits a part, more if the entries need them."""
    digits = max(2, len(f"{max(books.shape[1] - 1, 0):x}"))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memos = _memo(books, cell)
        for batch in batches:
            codes: list[str] = []
            errors: list[np.ndarray] = [np.zeros(0, np.int64)]
            for _, block in _blocks(batch, books):
                found = [memo.nearest(block[:, p]) for p, memo in enumerate(memos)]
                codes += ["".join(f"{x:0{digits}x}" for x in own) for own in zip(*[e.tolist() for e, _ in found], strict=True)]
                errors.append(sum(d for _, d in found))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(np.concatenate(errors))],
                names=["vec_id", "label", "code", "error"],
            )

    types = dict(kept.dtypes)
    return kept.mapInArrow(coded, f"vec_id {types['vec_id']}, label {types['label']}, code string, error long")


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_error(coded: DataFrame) -> DataFrame:
    """``label_error``: the error summed over equal labels. Sums are made before the shuffle, one row a label and task."""
    sums = coded.groupBy(F.col("label").alias("__label")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("__label"))).drop("__label")


def op11_cell_memo(spark, sf_dir: str) -> DataFrame:
    kept = stage(integer_vectors(table(spark, sf_dir, "embeddings")), "integers")  # read by every round
    books = train(kept)
    coded = stage(encode(kept, books), "codes")  # summed and joined
    return with_label_error(coded).select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _op11_sql(rounds: int = ROUNDS) -> str:
    sql = f"""
WITH ints AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
), long AS (
  SELECT vec_id, i // (n // {PARTS}) AS part, i % (n // {PARTS}) AS pos, x
  FROM (SELECT vec_id, len(v) AS n, unnest(v) AS x, unnest(range(len(v))) AS i FROM ints)
), seeds AS (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM ints QUALIFY entry < {ENTRIES}
), book0 AS MATERIALIZED (
  SELECT part, entry, pos, x AS c FROM long JOIN seeds USING (vec_id)
)"""
    for r in range(rounds + 1):
        sql += f""", near{r} AS MATERIALIZED (
  SELECT vec_id, part, min(d * {ENTRIES} + entry) AS best
  FROM (SELECT vec_id, part, entry, CAST(sum((x - c) * (x - c)) AS BIGINT) AS d FROM long JOIN book{r} USING (part, pos) GROUP BY ALL)
  GROUP BY vec_id, part
)"""
        if r < rounds:
            sql += f""", sums{r} AS (
  SELECT part, best % {ENTRIES} AS entry, pos, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
  FROM near{r} JOIN long USING (vec_id, part) GROUP BY ALL
), book{r + 1} AS MATERIALIZED (
  SELECT part, entry, pos, CASE WHEN n IS NULL THEN c ELSE (s - ((s % n) + n) % n) // n END AS c
  FROM book{r} LEFT JOIN sums{r} USING (part, entry, pos)
)"""
    return sql + f""", codes AS (
  SELECT vec_id, string_agg(printf('%02x', best % {ENTRIES}), '' ORDER BY part) AS code, CAST(sum(best // {ENTRIES}) AS BIGINT) AS error
  FROM near{rounds} GROUP BY vec_id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM book{rounds}) AS codebooks_sha256
FROM codes JOIN ints USING (vec_id)
"""


OP11_SQL = _op11_sql()
