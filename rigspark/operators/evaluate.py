"""Scores, baselines and histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARGINS = {"median_reprojection_error_px": ("upper", 1.0), "mask_coverage": ("around", 0.005), "eval4d_psnr_db": ("lower", 2.0)}


def psnr(mse: Column, peak: float = 1.0) -> Column:
    return F.when(mse <= 0, F.lit(float("inf"))).otherwise(F.lit(-10.0) * F.log10(mse / (peak * peak)))


def image_mse(a: DataFrame, b: DataFrame, keys: list[str], mask: DataFrame | None = None) -> DataFrame:
    """Mean squared difference of two pixel tables (keys, x, y, r, g, b), on a mask's foreground if there is one.

    Squares are summed whole and divided once: those of integers sum without any error, in whatever order.
    """
    at = [*keys, "x", "y"]
    other = b.select(*at, *(F.col(c).alias(f"o_{c}") for c in "rgb"))
    joined = a.join(other, at)
    if mask is not None:
        joined = joined.join(mask.filter("fg").select(*at), at, "left_semi")
    square = sum(((F.col(c) - F.col(f"o_{c}")) * (F.col(c) - F.col(f"o_{c}")) for c in "rgb"), F.lit(0.0))
    return joined.groupBy(*keys).agg((F.sum(square) / (3.0 * F.count(square))).alias("mse"))


def score_views(rendered: DataFrame, truth: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rendered views with their truth, and those without any."""
    return rendered.join(truth, keys), rendered.join(truth.select(*keys), keys, "left_anti")


def view_means(views: DataFrame) -> DataFrame:
    return views.agg(*(F.avg(c).alias(c) for c in ("psnr_db", "ssim", "lpips")))


def gate_baseline(metrics: DataFrame, golden: DataFrame) -> DataFrame:
    """metric, camera and status: pass, fail, or skip where there is no baseline. ``metrics`` and ``golden``: metric, camera, value."""
    base = golden.select(F.col("metric").alias("g_metric"), F.col("camera").alias("g_camera"), F.col("value").alias("base"))
    same = F.col("metric").eqNullSafe(F.col("g_metric")) & F.col("camera").eqNullSafe(F.col("g_camera"))
    joined = metrics.join(base, same, "left").drop("g_metric", "g_camera")
    ok = F.lit(None).cast("boolean")
    for name, (kind, margin) in MARGINS.items():
        rule = {"upper": F.col("value") <= F.col("base") + margin, "lower": F.col("value") >= F.col("base") - margin, "around": F.abs(F.col("value") - F.col("base")) <= margin}[kind]
        ok = F.when(F.col("metric") == name, rule).otherwise(ok)
    status = F.when(F.col("base").isNull() | ok.isNull(), "skip").when(ok, "pass").otherwise("fail")
    return joined.withColumn("status", status)


def measure_run(report: DataFrame, coverage: DataFrame, views: DataFrame) -> DataFrame:
    """One row of a run's rounded figures."""
    error = report.filter("camera_label is null").agg(F.round(F.max("median"), 2).alias("median_reprojection_error_px"))
    cover = coverage.agg(F.round(F.avg("coverage"), 4).alias("mask_coverage_avg"))
    score = view_means(views).select(F.round("psnr_db", 2).alias("eval4d_psnr_db"), F.round("ssim", 4).alias("eval4d_ssim"), F.round("lpips", 4).alias("eval4d_lpips"))
    return error.crossJoin(F.broadcast(cover)).crossJoin(F.broadcast(score))  # one row each


def latest(history: DataFrame) -> DataFrame:
    return history.groupBy("metric").agg(F.max_by("value", F.struct("ts", "value")).alias("value"))


def size_summary(before: DataFrame, after: DataFrame, counts: DataFrame) -> DataFrame:
    """In/out ratio and bytes a splat; ``before`` and ``after``: clip_id, bytes."""
    total = lambda df, n: df.groupBy("clip_id").agg(F.sum("bytes").alias(n))
    joined = total(before, "bytes_in").join(total(after, "bytes_out"), "clip_id").join(counts.select("clip_id", "splat_count"), "clip_id")
    return joined.withColumn("ratio", F.col("bytes_in") / F.col("bytes_out")).withColumn("bytes_per_splat", F.col("bytes_out") / F.col("splat_count"))
