"""Palettes of vectors, trained for all groups at once: centroids are a table keyed by group and never come to the driver."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructType
from pyspark.sql.window import Window

from .scratch import cut

#: Rows of a group that one task takes, and distances that it holds at a time.
_PART, _DISTANCES = 65_536, 1 << 22


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column) - column.null_count, -1)


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The nearest row of ``c`` for each of ``x``, the first at ties, by blocks of a matrix product."""
    half, step = (c * c).sum(axis=1) / 2, max(_DISTANCES // len(c), 1)
    return np.concatenate([np.argmin(half - x[i : i + step] @ c.T, axis=1) for i in range(0, len(x), step)]).astype(np.int32)


def _beside(df: DataFrame, key: str, centroids: DataFrame, own: list[str]):
    """Rows dealt by a hash of ``key`` into parts of a bounded size, and with each part the centroids of its group."""
    parts = df.groupBy(*own).agg(F.ceil(F.count(F.lit(1)) / _PART).alias("__parts"))
    dealt = df.join(parts, own).withColumn("__part", F.pmod(F.xxhash64(key), F.col("__parts"))).drop("__parts")
    fresh = centroids.select(*(F.col(c).alias(c) for c in centroids.columns))  # columns of its own: it may come from ``df``
    copies = fresh.join(parts, own).withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__parts") - 1))).drop("__parts")
    return dealt.groupBy(*own, "__part").cogroup(copies.groupBy(*own, "__part"))


def assign_palette(df: DataFrame, column: str, key: str, centroids: DataFrame, into: str, keys: Sequence[str] = ("clip_id",)) -> DataFrame:
    """``into``: the nearest entry of the own group's palette, the first at ties; null without a vector or a palette.

    A group goes in parts of some 65,536 rows, and each part receives the palette (65,536 entries of 45 numbers are
    23 MB), so no task holds a group and no node holds all palettes. ``centroids``: keys, entry, v. Rows whose group is null are dropped.
    """

    def label(rows: pa.Table, palette: pa.Table) -> pa.Table:
        given = rows[column].is_valid().to_numpy()
        labels = np.zeros(len(given), np.int32)
        known = len(palette) > 0
        if known and given.any():
            palette = palette.sort_by("entry")
            labels[given] = palette["entry"].to_numpy()[_nearest(_matrix(rows[column]), _matrix(palette["v"]))]
        return rows.drop_columns("__part").append_column(into, pa.array(labels, mask=~given if known else np.ones(len(given), bool)))

    schema = StructType(list(df.schema.fields)).add(into, IntegerType())
    return _beside(df, key, centroids, list(keys)).applyInArrow(label, schema)


def train_palettes(
    df: DataFrame, column: str, key: str, k: int, rounds: int = 8, sample: int = 262_144, keys: Sequence[str] = ("clip_id",), draw: Callable[[int], Column] | None = None
) -> DataFrame:
    """(keys, entry, v): Lloyd's rounds for all groups at once, on at most about ``sample`` vectors a group.

    The sample and every drawing follow ``draw`` (a number to a column; hashes of ``key`` by default), ties by ``key``.
    Entries start as the first k of the sample. A round sums vectors by entry inside each part and then across parts;
    entries without vectors move onto others of the sample, as far as there are any. Rows without vector do not count;
    a group of fewer than k vectors has as many entries as vectors.
    """
    own = list(keys)
    draw = draw or (lambda n: F.xxhash64(F.lit(n), F.col(key)))
    rows = df.filter(F.col(column).isNotNull()).select(*own, key, F.col(column).cast("array<double>").alias("v"))
    sizes = rows.groupBy(*own).agg(F.count(F.lit(1)).alias("__n"))
    share = F.col("__n") * F.pmod(F.xxhash64(key), F.lit(1_000_003)) < F.lit(sample * 1_000_003)
    drawn = cut(rows.join(sizes, own).filter(share).drop("__n"))
    width = drawn.agg(F.max(F.size("v"))).first()[0] or 0

    def others(n: int) -> DataFrame:  # the first k of a bounded sample
        order = Window.partitionBy(*own).orderBy(draw(n), key)
        return drawn.withColumn("entry", F.row_number().over(order) - 1).filter(F.col("entry") < k).select(*own, "entry", "v")

    def sums(rows: pa.Table, palette: pa.Table) -> pa.Table:
        if not len(rows) or not len(palette):
            return pa.table({**{c: rows[c].slice(0, 0) for c in own}, "entry": pa.array([], pa.int32()), "n": pa.array([], pa.int64()), "s": pa.array([], pa.list_(pa.float64()))})
        palette = palette.sort_by("entry")
        x = _matrix(rows["v"])
        labels = _nearest(x, _matrix(palette["v"]))
        order = np.argsort(labels, kind="stable")
        used, first, count = np.unique(labels[order], return_index=True, return_counts=True)
        total = np.add.reduceat(x[order], first, axis=0)
        group = {c: pa.chunked_array([pa.repeat(rows[c][0], len(used))]) for c in own}
        s = pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1, dtype=np.int32) * x.shape[1]), pa.array(total.ravel()))
        return pa.table({**group, "entry": palette["entry"].to_numpy()[used].astype(np.int32), "n": count.astype(np.int64), "s": s})

    schema = StructType([drawn.schema[c] for c in own]).add("entry", IntegerType()).add("n", LongType()).add("s", ArrayType(DoubleType()))
    palette = cut(others(5))
    for n in range(rounds):
        partial = _beside(drawn, key, palette, own).applyInArrow(sums, schema)
        total = partial.groupBy(*own, "entry").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.col("s")[i]) for i in range(width))).alias("s"))
        means = total.select(*own, "entry", F.transform("s", lambda x: x / F.col("n")).alias("mean"))
        moved = cut(palette.join(means, [*own, "entry"], "left"))
        went, empty = moved.agg(F.count(F.when(F.col("mean").isNull() | (F.col("mean") != F.col("v")), 1)), F.count(F.when(F.col("mean").isNull(), 1))).first()
        if empty:
            turn = F.row_number().over(Window.partitionBy(*own).orderBy("entry")) - 1  # a palette's empty entries
            vacant = moved.filter("mean is null").select(*own, "entry", turn.alias("turn"))
            fresh = vacant.join(others(6 + n).withColumnsRenamed({"entry": "turn", "v": "fresh"}), [*own, "turn"]).drop("turn")
            moved = moved.join(fresh, [*own, "entry"], "left").withColumn("mean", F.coalesce("mean", "fresh"))
        palette = cut(moved.select(*own, "entry", F.coalesce("mean", "v").alias("v")))
        if not went:
            break
    return palette
