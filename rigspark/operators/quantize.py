"""Quantised splats: ranges, codebooks, byte planes, and the way back."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import encoding as E
from .blocks import SortedBlocks, halvings, leading
from .palettes import assign_palette, train_palettes
from .scratch import MOST_NUMBERS, cut

GROUPS = {"means": ("x", "y", "z"), "motion": ("vx", "vy", "vz"), "accel": ("ax", "ay", "az")}
CODEBOOKS = {"scale": ("scale_0", "scale_1", "scale_2"), "dc": ("f_dc_0", "f_dc_1", "f_dc_2"), "t_center": ("t_center",), "t_sigma": ("t_sigma",)}


def axis_ranges(splats: DataFrame) -> DataFrame:
    """clip_id, grp, axis, mn, mx of the log-transformed axes, in one pass."""
    present = {g: axes for g, axes in GROUPS.items() if set(axes) <= set(splats.columns)}
    aggs = [f(E.log_transform(F.col(c))).alias(f"{n}_{c}") for axes in present.values() for c in axes for n, f in (("mn", F.min), ("mx", F.max))]
    rows = [
        F.struct(F.lit(g).alias("grp"), F.lit(i).alias("axis"), F.col(f"mn_{c}").alias("mn"), F.col(f"mx_{c}").alias("mx"))
        for g, axes in present.items()
        for i, c in enumerate(axes)
    ]
    return splats.groupBy("clip_id").agg(*aggs).select("clip_id", F.explode(F.array(*rows)).alias("r")).select("clip_id", "r.*")


def _wide(ranges: DataFrame) -> DataFrame:
    """Ranges as one row a clip: mn_means_0, ..."""
    keys = [(g, i) for g in GROUPS for i in range(3)]
    pick = lambda n, g, i: F.max(F.when((F.col("grp") == g) & (F.col("axis") == i), F.col(n))).alias(f"{n}_{g}_{i}")
    return ranges.groupBy("clip_id").agg(*(pick(n, g, i) for g, i in keys for n in ("mn", "mx")))


def distinct_values(df: DataFrame, columns: tuple[str, ...], log_domain: bool = False) -> DataFrame:
    """(clip_id, value, n): what a one-dimensional codebook is trained on, summed before the shuffle."""
    value = F.explode(F.array(*(F.col(c).cast("double") for c in columns))).alias("value")
    out = df.select("clip_id", value)
    if log_domain:
        out = out.withColumn("value", F.log(F.greatest("value", F.lit(1e-9))))
    return out.groupBy("clip_id", "value").agg(F.count(F.lit(1)).alias("n"))


def assign_codebook(df: DataFrame, value: str, codebook: DataFrame, into: str, keys: tuple[str, ...] = ("clip_id",)) -> DataFrame:
    """``into``: the index of the nearest entry, the lower one at a mid-point, found by halving. ``codebook`` (keys, idx, value) is sorted, with at most 65,536 entries."""
    nearest = Window.partitionBy(*keys).orderBy("idx")
    edges = (
        codebook.withColumn("__edge", (F.col("value") + F.lag("value").over(nearest)) / 2.0)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list("__edge")).alias("__edges"))  # a codebook of 256
        .withColumn("__steps", halvings(F.size("__edges"), 65_535))
    )
    index = F.when(F.col("__edges").isNotNull(), leading(F.col("__edges"), lambda e: e < F.col(value), 65_535, F.col("__steps")))
    return df.join(F.broadcast(edges), list(keys), "left").withColumn(into, index.cast("short")).drop("__edges", "__steps")


def kmeans_1d(values: DataFrame, k: int = 256, rounds: int = 16, keys: tuple[str, ...] = ("clip_id",)) -> DataFrame:
    """(keys, idx, value): Lloyd's rounds from quantiles over (keys, value, n), for all keys at once.

    Values are sorted once, in blocks with running counts and sums. The first entries are interpolated between the
    values of two ranks. A round looks up count and sum below each of its k edges, so it works on k rows a group and
    the blocks they fall into, not on the values; empty entries stay; entries are sorted again. Sums are differences of running
    sums, so a mean is off by at most about 2^-52 of the largest value times the values a group has for each of the
    entry's own. Only the number of entries that still move comes to the driver. Rows without key or value do not
    count; a group without values has no codebook.
    """
    own = list(keys)
    store = SortedBlocks(values, own)
    at_once = store.totals.count() * k * 2 <= MOST_NUMBERS
    place = F.col("idx") * (F.col("total") - 1) / F.lit(max(k - 1, 1))
    wanted = store.totals.select(*own, "total", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("idx")).select(*own, "idx", place.alias("place"))
    ranks = wanted.select(*own, "idx", F.explode(F.array_distinct(F.array(F.floor("place"), F.ceil("place")))).alias("at"))
    ends = store.at_rank(ranks, at_once).groupBy(*own, "idx").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    start = F.col("low") + (F.col("place") - F.floor("place")) * (F.col("high") - F.col("low")) + F.col("idx") * F.lit(1e-12)
    book = cut(wanted.join(ends, [*own, "idx"]).select(*own, "idx", start.alias("value")))
    upwards, order = Window.partitionBy(*own).orderBy("idx"), Window.partitionBy(*own).orderBy("value", "idx")  # a codebook
    for _ in range(rounds):
        edge = F.coalesce((F.col("value") + F.lead("value").over(upwards)) / 2.0, F.lit(float("inf")))
        below = store.upto(book.select(*own, "idx", edge.alias("at")), at_once)
        within = {c: F.coalesce(c, F.lit(0)) - F.coalesce(F.lag(c).over(upwards), F.lit(0)) for c in ("n", "s")}
        sums = book.join(below, [*own, "idx"], "left").select(*own, "idx", "value", *(e.alias(c) for c, e in within.items()))
        mean = F.when(F.col("n") > 0, F.col("s") / F.col("n")).otherwise(F.col("value"))
        after = cut(sums.select(*own, "idx", mean.alias("value"), (mean != F.col("value")).alias("went")))
        still = after.filter("went").limit(1).count()
        book = after.withColumn("idx", (F.row_number().over(order) - 1).cast("int")).select(*own, "idx", "value")
        if not still:
            break
    return cut(book)


def adjacent_gap(codebook: DataFrame) -> DataFrame:
    """Half the largest gap of neighbouring entries, by clip and attribute: the codebook's own tolerance."""
    order = Window.partitionBy("clip_id", "attr").orderBy("value")
    gap = codebook.withColumn("gap", F.lead("value").over(order) - F.col("value"))
    return gap.groupBy("clip_id", "attr").agg((F.max("gap") / 2.0).alias("tolerance"))


def assign_centroids(df: DataFrame, column: str, centroids: np.ndarray, into: str) -> DataFrame:
    """``into``: the nearest centroid, the first at ties, by blocks of a matrix product."""
    shared = df.sparkSession.sparkContext.broadcast(np.asarray(centroids, np.float64))  # k rows

    def nearest(vectors: pd.Series) -> pd.Series:
        x, c = np.stack(vectors.to_numpy()).astype(np.float64), shared.value
        half = (c * c).sum(axis=1) / 2
        return pd.Series(np.concatenate([np.argmin(half - x[i : i + 2048] @ c.T, axis=1) for i in range(0, len(x), 2048)]).astype(np.int32))

    nearest.__annotations__ = {"vectors": pd.Series, "return": pd.Series}
    return df.withColumn(into, F.pandas_udf(nearest, "int")(F.col(column)))


def build_palette(centroids: DataFrame, k: int = 256) -> tuple[DataFrame, DataFrame]:
    """Palettes of vectors (clip_id, entry, v) as bytes: each one's codebook over all its values, and each entry's texels (entry n in row n / 64, column n % 64 times its length)."""
    values = centroids.select("clip_id", "entry", F.size("v").alias("width"), F.posexplode("v").alias("coefficient", "c"))
    book = kmeans_1d(values.groupBy("clip_id", F.col("c").alias("value")).agg(F.count(F.lit(1)).alias("n")), k)
    placed = assign_codebook(values, "c", book, "idx").select(
        "clip_id", "entry", (F.col("entry") / 64).cast("int").alias("row"), ((F.col("entry") % 64) * F.col("width") + F.col("coefficient")).alias("column"), "idx"
    )
    return book, placed


def with_palette(splats: DataFrame, entries: int = 65_536, k: int = 256, **training) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Splats with ``sh_label``, their entry in a palette of ``f_rest`` trained for each clip, all clips at once; the codebooks; and the palettes.

    Splats without ``f_rest`` have the null label. ``training``: other arguments of ``train_palettes``.
    """
    centroids = train_palettes(splats, "f_rest", "splat_id", entries, **training)
    return (assign_palette(splats, "f_rest", "splat_id", centroids, "sh_label"), *build_palette(centroids, k))


def decode_palette(labelled: DataFrame, book: DataFrame, palette: DataFrame) -> DataFrame:
    """``f_rest`` of rows by their ``sh_label``: texels through the codebook (clip_id, idx, value), in the order of their columns."""
    vector = F.array_sort(F.collect_list(F.struct("column", "value")))["value"].alias("f_rest")  # the values of one entry
    entries = palette.join(book, ["clip_id", "idx"]).groupBy("clip_id", F.col("entry").alias("sh_label")).agg(vector)
    return labelled.join(entries, ["clip_id", "sh_label"], "left")


def quantise(ordered: DataFrame, ranges: DataFrame, codebooks: DataFrame | None = None) -> DataFrame:
    """Byte planes of ordered splats: split positions and motion, packed quaternions, alpha, and codebook indices."""
    out = ordered.join(F.broadcast(_wide(ranges)), "clip_id")  # one row a clip
    columns = {}
    for g, axes in GROUPS.items():
        for i, c in enumerate(axes):
            if c in ordered.columns:
                q = E.split16(E.log_transform(F.col(c)), F.col(f"mn_{g}_{i}"), F.col(f"mx_{g}_{i}"))
                columns |= {f"{g}_lo_{i}": E.low_byte(q), f"{g}_hi_{i}": E.high_byte(q)}
    packed = E.smallest_three([F.col(f"rot_{i}") for i in range(4)])
    columns |= {f"quat_{n}": packed[n] for n in ("b0", "b1", "b2", "mode")} | {"alpha8": E.alpha8(F.col("opacity"))}
    out = out.withColumns(columns)
    names = list(columns)
    for attr, cols in CODEBOOKS.items() if codebooks is not None else ():
        book = codebooks.filter(F.col("attr") == attr).select("clip_id", "idx", "value")
        for c in cols:
            if attr == "t_sigma":  # mid-points lie in logarithms, where its codebook was trained
                logs = out.withColumn("__log", F.log(F.greatest(F.col(c).cast("double"), F.lit(1e-9))))
                out = assign_codebook(logs, "__log", book.withColumn("value", F.log("value")), f"{c}_i").drop("__log")
            else:
                out = assign_codebook(out, c, book, f"{c}_i")
            names.append(f"{c}_i")
    names += ["sh_label"] if "sh_label" in ordered.columns else []
    keys = [c for c in ("clip_id", "grp", "file_idx", "splat_id") if c in ordered.columns]
    return out.select(*keys, *names)


def dequantise(q: DataFrame, ranges: DataFrame, codebooks: DataFrame | None = None, palette: DataFrame | None = None) -> DataFrame:
    """Splat columns of byte planes; ``f_rest`` too where there is a palette."""
    out = q.join(F.broadcast(_wide(ranges)), "clip_id")  # one row a clip
    columns = {}
    for g, axes in GROUPS.items():
        for i, c in enumerate(axes):
            if f"{g}_lo_{i}" in q.columns:
                t = E.join16(F.col(f"{g}_lo_{i}").cast("int"), F.col(f"{g}_hi_{i}").cast("int"), F.col(f"mn_{g}_{i}"), F.col(f"mx_{g}_{i}"))
                columns[c] = E.log_inverse(t)
    bytes_ = [F.col(f"quat_b{i}").cast("double") for i in range(3)]
    columns |= {f"rot_{i}": v for i, v in enumerate(E.from_smallest_three(bytes_, F.col("quat_mode").cast("int")))}
    columns["opacity"] = E.opacity_of(F.col("alpha8").cast("double"))
    out = out.withColumns(columns)
    names = list(columns)
    for attr, cols in CODEBOOKS.items() if codebooks is not None else ():
        own = codebooks.filter(F.col("attr") == attr).groupBy("clip_id").agg(F.map_from_entries(F.collect_list(F.struct("idx", "value"))).alias("__book"))
        out = out.join(F.broadcast(own), "clip_id", "left")  # 256 entries a clip
        out = out.withColumns({c: F.element_at("__book", F.col(f"{c}_i").cast("int")) for c in cols}).drop("__book")
        names += cols
    if codebooks is not None and palette is not None:
        out = decode_palette(out, codebooks.filter(F.col("attr") == "sh").select("clip_id", "idx", "value"), palette)
        names.append("f_rest")
    keys = [c for c in ("clip_id", "grp", "file_idx", "splat_id") if c in q.columns]
    return out.select(*keys, *names)


def pack(splats: DataFrame, time_min: float, time_max: float, duration: float, k: int = 256, entries: int = 65_536) -> dict[str, DataFrame]:
    """Planes, ranges, codebooks, segments and counts of splats; with ``f_rest``, also its palette of at most ``entries``."""
    from . import temporal

    shared = {}
    if "f_rest" in splats.columns:
        splats, sh_books, shared["palette"] = with_palette(splats, entries, k)
    ordered = temporal.order_splats(splats, time_min, time_max, duration)
    ranges = cut(axis_ranges(splats))  # a few rows a clip
    values = None
    for attr, cols in CODEBOOKS.items():
        own = distinct_values(splats, cols, attr == "t_sigma").withColumn("attr", F.lit(attr))
        values = own if values is None else values.union(own)
    books = kmeans_1d(values, k, keys=("clip_id", "attr"))
    books = books.select("clip_id", "attr", "idx", F.when(F.col("attr") == "t_sigma", F.exp("value")).otherwise(F.col("value")).alias("value"))
    if shared:
        books = books.union(sh_books.select("clip_id", F.lit("sh").alias("attr"), "idx", "value"))
    return shared | {
        "planes": quantise(ordered, ranges, books),
        "ranges": ranges,
        "codebooks": books,
        "segments": temporal.segment_table(splats, time_min, time_max, duration),
        "clips": temporal.persistent_end(splats, duration),
    }
