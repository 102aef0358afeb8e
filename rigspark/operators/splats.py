"""Filters, orders and budgets of splats.

Every operator works for many clips at once: ``clip_id`` groups, ``splat_id`` identifies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import colour, position_at, sigmoid
from .quantiles import at_share, select_ranks
from .rank import levelled_rank
from .scratch import cut, small

SIZES = ("scale_0", "scale_1", "scale_2")

#: Bounds of the 15 real harmonics of degree 1 to 3, by which clamping is defined.
SH_BOUNDS = [0.489, 0.489, 0.489, 0.546, 0.546, 0.630, 0.546, 0.546, 0.590, 0.590, 0.457, 0.746, 0.457, 0.590, 0.590]


def _largest() -> Column:
    return F.greatest(*(F.exp(c) for c in SIZES))


def _smallest() -> Column:
    return F.least(*(F.exp(c) for c in SIZES))


def _mean(channels: list[Column]) -> Column:
    return (channels[0] + channels[1] + channels[2]) / 3.0


def peak_alpha(time_min: float, time_max: float) -> Column:
    """The largest alpha inside the clip: at t_center, or at the clip's nearer end."""
    nearest = F.greatest(F.least(F.col("t_center"), F.lit(float(time_max))), F.lit(float(time_min)))
    r = (nearest - F.col("t_center")) / F.greatest(F.abs("t_sigma"), F.lit(1e-9))
    return sigmoid(F.col("opacity")) * F.exp(F.lit(-0.5) * r * r)


def keep_peak_alpha(time_min: float, time_max: float, threshold: float = 1 / 1024) -> Column:
    return peak_alpha(time_min, time_max) >= threshold


def keep_good_colour() -> Column:
    return colour(0).between(0, 1) & colour(1).between(0, 1) & colour(2).between(0, 1)


def keep_sound_geometry(size: float = 0.2, aspect: float = 10.0) -> Column:
    return ~((_largest() > size) & (_largest() / F.greatest(_smallest(), F.lit(1e-12)) > aspect))


def keep_no_floater() -> Column:
    """Drops black floaters: far below black, or dark and either thin or faint."""
    mean = _mean([colour(c) for c in range(3)])
    thin = _largest() / F.greatest(_smallest(), F.lit(1e-12)) > 6
    return ~((mean < -0.25) | ((mean < 0.05) & ((sigmoid(F.col("opacity")) < 0.30) | thin)))


def with_dark_limit(splats: DataFrame, percentile: float = 0.75) -> DataFrame:
    """``size_limit``: the percentile of the largest size over all rows of a clip (one row a clip is joined back)."""
    limit = select_ranks(splats, ["clip_id"], [at_share("size_limit", _largest(), percentile)])
    return splats.join(small(limit, 2), "clip_id")


def keep_no_occluder(dark: float = 0.05, alpha: float = 0.7) -> Column:
    clipped = [F.least(F.greatest(colour(c), F.lit(0.0)), F.lit(1.0)) for c in range(3)]
    return ~((_mean(clipped) < dark) & (sigmoid(F.col("opacity")) > alpha) & (_largest() > F.col("size_limit")))


def filter_splats(splats: DataFrame, time_min: float, time_max: float, corrupted: bool = True, dark: bool = False, black: bool = False, keep: DataFrame | None = None, cluster: bool = False) -> DataFrame:
    """The filters of a profile. All are judged on the unfiltered rows and hold together.

    ``corrupted``: garbage geometry and impossible colours, as quantised sources have them and clean ones do not.
    ``dark`` and ``black``: occluders and floaters. ``keep``: (clip_id, splat_id) of rows that an outside list keeps.
    ``cluster``: only the main cluster of all rows given.
    """
    wanted = keep_peak_alpha(time_min, time_max)
    if corrupted:
        wanted = wanted & keep_sound_geometry() & keep_good_colour()
    if black:
        wanted = wanted & keep_no_floater()
    out = with_dark_limit(splats).filter(wanted & keep_no_occluder()).drop("size_limit") if dark else splats.filter(wanted)
    if keep is not None:
        out = out.join(keep.select("clip_id", "splat_id"), ["clip_id", "splat_id"], "left_semi")
    if cluster:
        from .components import main_cluster

        out = out.join(main_cluster(splats).select("clip_id", "splat_id"), ["clip_id", "splat_id"], "left_semi")
    return out


def apply_keep_list(splats: DataFrame, keep: DataFrame) -> DataFrame:
    """Rows whose (clip_id, splat_id) the list keeps; a list of another length fails."""
    sizes = splats.groupBy("clip_id").agg(F.count(F.lit(1)).alias("n")).join(
        keep.groupBy("clip_id").agg(F.count(F.lit(1)).alias("listed")), "clip_id", "left"
    )
    checked = sizes.select("clip_id", F.when(F.col("n") == F.col("listed"), True).otherwise(F.raise_error(F.lit("keep list of another length"))).alias("ok"))
    kept = splats.join(keep.filter("keep").select("clip_id", "splat_id"), ["clip_id", "splat_id"], "left_semi")
    return kept.join(F.broadcast(checked.filter("ok").select("clip_id")), "clip_id", "left_semi")  # one row a clip


def filter_radius(splats: DataFrame, points: DataFrame, radius: float) -> DataFrame:
    """Rows within ``radius`` of the per-axis median of their clip's point cloud."""
    anchor = select_ranks(points, ["clip_id"], [at_share(f"anchor_{a}", a, 0.5) for a in "xyz"])
    square = sum(((F.col(a) - F.col(f"anchor_{a}")) * (F.col(a) - F.col(f"anchor_{a}")) for a in "xyz"), F.lit(0.0))
    return splats.join(small(anchor, 4), "clip_id").filter(F.sqrt(square) <= radius).drop(*(f"anchor_{a}" for a in "xyz"))


def filter_visible(splats: DataFrame, threshold: float = 1 / 255) -> DataFrame:
    return splats.filter(sigmoid(F.col("opacity")) >= threshold)


def reanchor(splats: DataFrame, t: Column | float) -> DataFrame:
    """Position, velocity and acceleration moved to another centre time."""
    d = (t if isinstance(t, Column) else F.lit(float(t))) - F.col("t_center")
    moved = {a: position_at(a, t, accel=True) for a in "xyz"}
    speed = {f"v{a}": F.col(f"v{a}") + F.lit(2.0) * F.coalesce(F.col(f"a{a}"), F.lit(0.0)) * d for a in "xyz"}
    new_time = t if isinstance(t, Column) else F.lit(float(t))
    return splats.withColumns(moved | speed | {"t_center": new_time})


def clamp_sh(splats: DataFrame, y_max: list[float] = SH_BOUNDS, limit: float = 1.5) -> DataFrame:
    """Scales ``f_rest`` (channel-major, 15 a channel) by one factor, so that the largest base and the largest bound of the channels keep within the limit together; 0 or less disables."""
    if limit <= 0:
        return splats
    bounds = F.array(*(F.lit(float(y)) for y in y_max))
    per_channel = [
        F.aggregate(
            F.zip_with(F.slice("f_rest", 15 * c + 1, 15), bounds, lambda v, y: F.abs(v) * y), F.lit(0.0), lambda a, b: a + b
        )
        for c in range(3)
    ]
    room = F.greatest(F.lit(limit) - F.greatest(*(F.abs(colour(c)) for c in range(3))), F.lit(0.0))
    scale = F.least(F.lit(1.0), room / F.greatest(F.greatest(*per_channel), F.lit(1e-9)))
    clamped = F.transform("f_rest", lambda v: (v * F.col("__scale")).cast("float"))
    return splats.withColumn("__scale", scale).withColumn("f_rest", clamped).drop("__scale")


def strip_sh(splats: DataFrame) -> DataFrame:
    return splats.drop("f_rest")


def truncate_sh(splats: DataFrame, bands: int) -> DataFrame:
    """The leading coefficients of each channel: 3, 8 or 15 for one to three bands."""
    n = (bands + 1) ** 2 - 1
    return splats.withColumn("f_rest", F.concat(*(F.slice("f_rest", 15 * c + 1, n) for c in range(3))))


def top_fraction(splats: DataFrame, fraction: float, time_min: float, time_max: float) -> DataFrame:
    """Rows whose peak alpha reaches that of the k-th largest of their clip; ties stay.

    The threshold is selected in two levels, so no task ranks a clip's rows.
    """
    rows = splats.withColumn("__peak", peak_alpha(time_min, time_max))
    k = lambda n: F.greatest(F.lit(1.0), F.least(F.rint(n * fraction), n.cast("double")))
    least = select_ranks(rows, ["clip_id"], [("__cut", F.col("__peak"), min(max(1.0 - fraction, 0.0), 1.0), lambda n: n - k(n))])
    return rows.join(small(least, 2), "clip_id").filter(F.col("__peak") >= F.col("__cut")).drop("__peak", "__cut")


def importance() -> Column:
    mean = (F.col("scale_0") + F.col("scale_1") + F.col("scale_2")) / 3.0
    return sigmoid(F.col("opacity")) * F.exp(mean) * F.exp(mean)


def top_budget(splats: DataFrame, total: int, frames: int) -> DataFrame:
    """The ``total // frames`` most important rows of each (clip, frame); 0 keeps all."""
    if not total:
        return splats
    # steps of an eighth of an octave of importance deal a frame into parts
    step = F.floor(-8.0 * F.log2(F.greatest("__importance", F.lit(1e-30)))).cast("int")
    ranked = levelled_rank(splats.withColumn("__importance", importance()), ["clip_id", "frame"], step, [F.desc("__importance"), "splat_id"], "__rank")
    return ranked.filter(F.col("__rank") <= total // frames).drop("__importance", "__rank")


def flipbook_to_splats(frames: DataFrame, fps: float, stride: int = 1, factor: float = 0.5) -> DataFrame:
    """Static frames as one moving set: centred at the frame's time, no velocity."""
    step = stride / fps
    return frames.withColumns(
        {"t_center": F.col("frame") * step, "t_sigma": F.lit(factor * step), **{f"v{a}": F.lit(0.0) for a in "xyz"}}
    )


def frame_counts(splats: DataFrame) -> DataFrame:
    """Least, median and most rows of a frame, by clip."""
    n = splats.groupBy("clip_id", "frame").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("clip_id").agg(F.min("n").alias("least"), F.percentile("n", 0.5).alias("median"), F.max("n").alias("most"))


def kept_share(before: DataFrame, after: DataFrame) -> DataFrame:
    """Share of a clip's rows that are left."""
    n = lambda df, name: df.groupBy("clip_id").agg(F.count(F.lit(1)).alias(name))
    both = n(before, "given").join(n(after, "kept"), "clip_id", "left")
    return both.select("clip_id", (F.coalesce("kept", F.lit(0)) / F.col("given")).alias("share"))


def sample_every(df: DataFrame, n: int, keys: list[str], order: list[str]) -> DataFrame:
    """Every n-th row of each group, from the first. ``order`` decides, so it should have no ties.

    Rows are dealt into ranges of (keys, order) and written once; they are ranked inside their range and moved by the
    rows of the ranges before, so a large group is never in one task. A null key is a group of its own.
    """
    dealt = cut(df.repartitionByRange(*keys, *order).withColumns({"__range": F.spark_partition_id(), "__group": F.to_json(F.struct(*keys))}))
    ranked = levelled_rank(dealt, ["__group"], F.col("__range"), order, "__k")
    return ranked.filter((F.col("__k") - 1) % n == 0).drop("__k", "__range", "__group")


def temporal_profile(splats: DataFrame, times: list[float], clips_at_most: int | None = None) -> DataFrame:
    """Share of visible rows at each time, and percentiles of speed, duration and (where there is any) acceleration, by clip."""
    from ..functions.geometry import alpha_at

    shares = [F.avg((alpha_at(t) > 1 / 255).cast("double")).alias(f"live_{i}") for i, t in enumerate(times)]
    size = lambda n: F.sqrt(F.col(f"{n}x") * F.col(f"{n}x") + F.col(f"{n}y") * F.col(f"{n}y") + F.col(f"{n}z") * F.col(f"{n}z"))
    speed, bend = size("v"), size("a") if {"ax", "ay", "az"} <= set(splats.columns) else None
    measures = {"speed": speed, "sigma": F.col("t_sigma")} | ({"accel": bend} if bend is not None else {})
    ranks = [at_share(f"{name}_p{round(100 * q)}", value, q) for name, value in measures.items() for q in (0.5, 0.95, 0.99)]
    return splats.groupBy("clip_id").agg(*shares).join(select_ranks(splats, ["clip_id"], ranks, clips_at_most), "clip_id")
