"""Checks of each step's tables. Every check returns its violations; no row means that it passed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import determinant3
from .temporal import MOST_SEGMENTS


def _reasons(*pairs) -> F.Column:
    return F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in pairs)))


def _violations(df: DataFrame, keys: list[str], *pairs) -> DataFrame:
    return df.withColumn("violation", F.explode(_reasons(*pairs))).select(*keys, "violation")


def members(expected: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Expected rows that are missing, and found ones that nobody expects."""
    side = lambda df, due: df.select(*keys, F.lit(due).alias("__due"), F.lit(not due).alias("__seen"))
    # dealt before they are grouped: a scan's task may hold any number of short rows, whose groups it would have to keep
    both = side(expected, True).unionByName(side(found, False)).repartition(*keys)
    known = both.groupBy(*keys).agg(F.bool_or("__due").alias("__due"), F.bool_or("__seen").alias("__seen"))
    same = F.col("__due") & F.col("__seen")
    for k in keys:  # nothing equals a null
        same = same & F.col(k).isNotNull()
    reasons = F.array_compact(F.array(F.when(F.col("__due") & ~same, F.lit("missing")), F.when(F.col("__seen") & ~same, F.lit("unexpected"))))
    return known.select(*keys, F.explode(reasons).alias("violation"))


def finite(c: str) -> F.Column:
    return F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))


def validate_sync(offsets: DataFrame, cameras: DataFrame) -> DataFrame:
    keys = ["capture_id", "camera"]
    own = _violations(
        offsets, keys,
        ("error", F.col("error").isNotNull()),
        ("no offset", F.col("error").isNull() & (F.col("offset_seconds").isNull() | F.col("frame_offset").isNull())),
        ("not finite", F.col("offset_seconds").isNotNull() & ~finite("offset_seconds")),
        ("no fps", F.col("error").isNull() & (F.col("fps").isNull() | ~(F.col("fps") > 0))),
    )
    return own.unionByName(members(cameras, offsets, keys))


def validate_frames(frames: DataFrame, cameras: DataFrame, least: int = 1000) -> DataFrame:
    keys = ["capture_id", "camera"]
    small = _violations(frames, keys, ("small", (F.col("width") < least) | (F.col("height") < least)))
    twice = frames.groupBy(*keys).count().filter("count > 1").select(*keys, F.lit("twice").alias("violation"))
    return small.unionByName(twice).unionByName(members(cameras, frames, keys))


def validate_poses(cameras: DataFrame, expected: DataFrame) -> DataFrame:
    """Pose matrices (c2w): rigid, finite, unique, and not all in one place."""
    keys = ["capture_id", "camera_label"]
    m = lambda i, j: F.get("c2w", F.lit(4 * i + j))
    whole = F.coalesce((F.size("c2w") == 16) & F.forall("c2w", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))
    bottom = sum((F.abs(m(3, j) - (1.0 if j == 3 else 0.0)) for j in range(4)), F.lit(0.0)) > 1e-6
    dot = lambda a, b: sum((m(i, a) * m(i, b) for i in range(3)), F.lit(0.0))
    skew = F.greatest(*(F.abs(dot(a, b) - (1.0 if a == b else 0.0)) for a in range(3) for b in range(a, 3)))
    own = _violations(
        cameras, keys,
        ("not a finite 4x4", ~whole),
        ("bottom row", whole & bottom),
        ("reflected or collapsed", whole & (determinant3([m(i, j) for i in range(3) for j in range(3)]) < 0.5)),
        ("not orthonormal", whole & (skew > 0.05)),
    )
    twice = cameras.groupBy(*keys).count().filter("count > 1").select(*keys, F.lit("twice").alias("violation"))
    spread = cameras.groupBy("capture_id").agg(*((F.max(m(i, 3)) - F.min(m(i, 3))).alias(f"s{i}") for i in range(3)))
    flat = spread.filter(F.greatest("s0", "s1", "s2") <= 0.01).select("capture_id", F.lit(None).cast("string").alias("camera_label"), F.lit("all in one place").alias("violation"))
    return own.unionByName(twice).unionByName(flat).unionByName(members(expected, cameras, keys))


def validate_masks(coverage: DataFrame, expected: DataFrame, low: float = 0.005, high: float = 0.9) -> DataFrame:
    keys = ["capture_id", "camera_label"]
    own = _violations(coverage, keys, ("coverage", ~((F.col("coverage") > low) & (F.col("coverage") < high))))
    twice = coverage.groupBy(*keys).count().filter("count > 1").select(*keys, F.lit("twice").alias("violation"))
    return own.unionByName(twice).unionByName(members(expected, coverage, keys))


def validate_dataset(views: DataFrame, points: DataFrame) -> DataFrame:
    """capture_id and violation: captures without a train or test view, without points, with views that lack a value or a
    fourth channel (``channels``), or with points without time."""
    needed = ("camera_label", "frame_idx", "time", "fl_x", "fl_y", "cx", "cy", "w", "h", "c2w", "file_path")
    lacks = [(f"null {c}", F.col(c).isNull()) for c in needed]
    if "channels" in views.columns:
        lacks.append(("not 4 channels", ~F.coalesce(F.col("channels") == 4, F.lit(False))))
    own = _violations(views, ["capture_id"], *lacks).distinct()
    share = lambda s: F.coalesce(F.max((F.col("split") == s).cast("int")), F.lit(0)) == 0
    empty = views.groupBy("capture_id").agg(share("train").alias("train"), share("test").alias("test"))
    empty = _violations(empty, ["capture_id"], ("no train view", F.col("train")), ("no test view", F.col("test")))
    timed = points.groupBy("capture_id").agg(F.count(F.lit(1)).alias("n"), F.count("time").alias("timed"))
    few = views.select("capture_id").distinct().join(timed, "capture_id", "left")
    few = _violations(few, ["capture_id"], ("no point", F.coalesce("n", F.lit(0)) == 0), ("point without time", F.col("timed") < F.col("n")))
    return own.unionByName(empty).unionByName(few)


def validate_result(clips: DataFrame, name: str) -> DataFrame:
    return _violations(clips, ["clip_id"], ("format", ~F.coalesce(F.col("format") == name, F.lit(False))), ("empty", F.coalesce("splat_count", F.lit(0)) < 1))


def validate_static_rig(first: DataFrame, last: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """Cameras whose pose or intrinsics move between two frames, or that are distorted."""
    keys = ["capture_id", "camera_label"]
    parts = ("fl_x", "fl_y", "cx", "cy")
    other = last.select(*keys, F.col("c2w").alias("b_c2w"), *(F.col(c).alias(f"b_{c}") for c in parts))
    far = F.exists(F.zip_with("c2w", "b_c2w", lambda a, b: F.abs(a - b) > tolerance), lambda x: F.coalesce(x, F.lit(True)))
    inner = sum((F.abs(F.col(c) - F.col(f"b_{c}")) for c in parts), F.lit(0.0)) > tolerance
    both = first.join(other, keys)
    bent = F.exists("dist", lambda d: F.abs(d) > tolerance)
    return _violations(both, keys, ("pose moves", far), ("intrinsics move", inner), ("distorted", bent)).unionByName(members(first, last, keys))


def validate_splats(splats: DataFrame) -> DataFrame:
    pairs = [("t_sigma", ~(finite("t_sigma") & (F.col("t_sigma") > 0)))]
    if "f_rest" in splats.columns:
        pairs.append(("f_rest", F.col("f_rest").isNotNull() & (F.size("f_rest") != 45)))
    present = [c for c in ("ax", "ay", "az") if c in splats.columns]
    if present:
        have = sum((F.col(c).isNotNull().cast("int") for c in present), F.lit(0))
        pairs.append(("accel", (have > 0) & (have < 3)))
    return _violations(splats, ["clip_id", "splat_id"], *pairs)


def validate_clips(clips: DataFrame, degrees: DataFrame) -> DataFrame:
    needed = ("time_min", "time_max", "fps", "motion_degree")
    joined = clips.join(degrees.select("clip_id", "found_degree"), "clip_id", "left")
    return _violations(joined, ["clip_id"], *((f"no {c}", F.col(c).isNull()) for c in needed), ("degree", F.col("motion_degree") != F.col("found_degree")))


def validate_segment_count(segments: DataFrame) -> DataFrame:
    return segments.groupBy("clip_id").count().filter(F.col("count") > MOST_SEGMENTS)
