"""Time segments of a splat set: buckets, the segment table, file order and what is drawn at a time."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.encoding import cell1024, morton30
from .rank import levelled_rank
from .scratch import small

MOST_SEGMENTS = 65_536


def segment_count(time_min: float, time_max: float, duration: float) -> int:
    n = max(1, math.ceil((time_max - time_min) / duration))
    if n > MOST_SEGMENTS:
        raise ValueError(f"{n} segments; at most {MOST_SEGMENTS} can be stored")
    return n


def bucket_of(time_min: float, time_max: float, duration: float) -> Column:
    n = segment_count(time_min, time_max, duration)
    cell = ((F.col("t_center") - F.lit(float(time_min))) / F.lit(float(duration))).cast("int")
    return F.least(F.greatest(cell, F.lit(0)), F.lit(n - 1))


def is_persistent(duration: float, k_sigma: float, span: float) -> Column:
    return F.lit(2.0) * F.lit(k_sigma) * F.col("t_sigma") > F.lit(span) * F.lit(duration)


def with_group(splats: DataFrame, time_min: float, time_max: float, duration: float, k_sigma: float = 3.8, span: float = 3.0) -> DataFrame:
    """``grp``: -1 for persistent rows, else the bucket of t_center."""
    grp = F.when(is_persistent(duration, k_sigma, span), F.lit(-1)).otherwise(bucket_of(time_min, time_max, duration))
    return splats.withColumn("grp", grp)


def segment_table(splats: DataFrame, time_min: float, time_max: float, duration: float, k_sigma: float = 3.8, span: float = 3.0) -> DataFrame:
    """clip_id, seg_idx, t0, t1, first, last for every segment, empty ones at their nominal bounds.

    Ranges follow the persistent rows. The running sum is over segments, never over splats.
    """
    n = segment_count(time_min, time_max, duration)
    rows = with_group(splats, time_min, time_max, duration, k_sigma, span)
    groups = rows.groupBy("clip_id", "grp").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.col("t_center") - F.lit(k_sigma) * F.col("t_sigma")).alias("low"),
        F.max(F.col("t_center") + F.lit(k_sigma) * F.col("t_sigma")).alias("high"),
    )
    every = groups.select("clip_id").distinct().select("clip_id", F.explode(F.sequence(F.lit(-1), F.lit(n - 1))).alias("grp"))
    before = Window.partitionBy("clip_id").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    filled = every.join(groups, ["clip_id", "grp"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    start = F.lit(float(time_min)) + F.col("grp") * F.lit(float(duration))
    return (
        filled.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .filter("grp >= 0")
        .select(
            "clip_id",
            F.col("grp").alias("seg_idx"),
            F.coalesce("low", start).alias("t0"),
            F.coalesce("high", start + F.lit(float(duration))).alias("t1"),
            F.col("first").cast("long").alias("first"),
            (F.col("first") + F.col("n")).cast("long").alias("last"),
        )
    )


def persistent_end(splats: DataFrame, duration: float, k_sigma: float = 3.8, span: float = 3.0) -> DataFrame:
    return splats.groupBy("clip_id").agg(
        F.sum(is_persistent(duration, k_sigma, span).cast("long")).alias("persistent_end"), F.count(F.lit(1)).alias("splat_count")
    )


def order_splats(splats: DataFrame, time_min: float, time_max: float, duration: float, k_sigma: float = 3.8, span: float = 3.0) -> DataFrame:
    """``morton`` and ``file_idx``: persistent rows first, then buckets, along the Morton curve of the group's own box.

    Ranks are taken inside a part of a group's curve and moved by the rows of the parts and groups before.
    """
    rows = with_group(splats, time_min, time_max, duration, k_sigma, span)
    box = rows.groupBy("clip_id", "grp").agg(
        F.count(F.lit(1)).alias("__n"),
        *(f(a).alias(f"__{n}_{a}") for a in "xyz" for n, f in (("low", F.min), ("high", F.max))),
    )
    before = Window.partitionBy("clip_id").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    box = box.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    cells = [cell1024(F.col(a), F.col(f"__low_{a}"), F.col(f"__high_{a}")) for a in "xyz"]
    made = rows.join(small(box, 10), ["clip_id", "grp"]).withColumn("morton", morton30(*cells))
    made = made.withColumnRenamed("__start", "__before").drop("__n", *(f"__{n}_{a}" for a in "xyz" for n in ("low", "high")))
    # the upper 12 bits of a code are its bucket: a persistent group of any size is sorted in parts
    made = levelled_rank(made, ["clip_id", "grp"], F.shiftright("morton", 18), ["morton", "splat_id"], "file_idx")
    return made.withColumn("file_idx", F.col("__before") + F.col("file_idx") - 1).drop("__before")


def draw_ranges(segments: DataFrame, times: DataFrame, persistent: DataFrame) -> DataFrame:
    """For each (clip_id, t): the span of the segments whose cover holds t, and the persistent prefix.

    Covers overlap and are not sorted by their start, so every segment of the clip is tried against the
    few times asked for.
    """
    hit = segments.join(small(times.select("clip_id", "t"), 2), "clip_id").filter((F.col("t0") <= F.col("t")) & (F.col("t") <= F.col("t1")) & (F.col("last") > F.col("first")))
    spans = hit.groupBy("clip_id", "t").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return (
        times.join(spans, ["clip_id", "t"], "left")
        .join(persistent.select("clip_id", "persistent_end"), "clip_id", "left")
        .select("clip_id", "t", F.coalesce("first", F.lit(0)).alias("first"), F.coalesce("last", F.lit(0)).alias("last"), F.coalesce("persistent_end", F.lit(0)).alias("persistent_end"))
    )


def splats_at(ordered: DataFrame, ranges: DataFrame, segments: DataFrame) -> DataFrame:
    """Rows of an ordered set that are drawn at each time of ``ranges``.

    A range is turned into the groups that it covers (it begins and ends at segment bounds), and
    rows meet it by (clip_id, grp): a table partitioned by them is read in those parts alone.
    """
    own = segments.select("clip_id", F.col("seg_idx").alias("grp"), F.col("first").alias("s0"), F.col("last").alias("s1")).filter("s1 > s0")
    covered = ranges.join(own, "clip_id").filter("s0 >= first and s1 <= last").select("clip_id", "grp", "t")
    persistent = ranges.filter("persistent_end > 0").select("clip_id", F.lit(-1).alias("grp"), "t")
    return ordered.join(small(covered.unionByName(persistent), 3), ["clip_id", "grp"])


def drawn_fraction(ranges: DataFrame, persistent: DataFrame) -> DataFrame:
    """Mean and largest share of rows drawn over the times of ``ranges``, by clip."""
    share = (F.col("persistent_end") + F.col("last") - F.col("first")) / F.col("splat_count")
    return (
        ranges.join(persistent.select("clip_id", "splat_count"), "clip_id")
        .groupBy("clip_id")
        .agg(F.avg(share).alias("mean_share"), F.max(share).alias("max_share"))
    )


def support_violations(segments: DataFrame, stored: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """Stored segments whose cover differs from the union of their members' intervals."""
    s = stored.select("clip_id", "seg_idx", F.col("t0").alias("s0"), F.col("t1").alias("s1"))
    off = (F.abs(F.col("t0") - F.col("s0")) > tolerance) | (F.abs(F.col("t1") - F.col("s1")) > tolerance)
    return segments.join(s, ["clip_id", "seg_idx"], "full").filter(F.coalesce(off, F.lit(True))).select("clip_id", "seg_idx")
