"""Compositions that a user calls: each is one lazy plan over tables, with its check beside it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import normalised_quaternion
from ..operators import cameras, compare, components, dataset, evaluate, poses, quantize, splats, sync, temporal, validate
from ..operators.scratch import cut
from ..operators.scratch import kept as written


def sync_job(clips: DataFrame, media: DataFrame, reference: DataFrame, rate: int = 16_000) -> tuple[DataFrame, DataFrame]:
    """Offsets of every camera, and the violations among them. ``media``: capture_id, camera, fps; ``clips`` share one ``rate``."""
    pairs = cut(sync.full_rate_pairs(clips, rate))  # correlated once, read by every step below
    offsets = sync.offset_table(pairs, sync.offset_lsq(pairs, reference), reference, media)
    return offsets, validate.validate_sync(offsets, media.select("capture_id", "camera"))


def refine_job(rig: DataFrame, keypoints: DataFrame, threshold: float = 0.5, outlier_px: float = 200.0, min_views: int = 3, rounds: int = 20) -> dict[str, DataFrame]:
    """Refined poses and points in the frame of the given ones, and the error before and after."""
    seen = keypoints.filter(F.col("score") >= threshold)
    points = poses.triangulate(seen, rig, threshold, min_views)
    kept = cameras.drop_outliers(seen, points, rig, outlier_px, min_views)
    refined, moved = poses.refine_poses(kept, rig, points, rounds)
    # bundle adjustment is free to scale and move the world: camera centres are laid back on the given ones
    centres = poses.camera_centres(refined, "src").join(poses.camera_centres(poses.given_poses(rig), "dst"), ["capture_id", "camera_label"])
    fit = poses.similarity_fit(centres)
    aligned, points_after = poses.remove_gauge_of_poses(refined, fit), poses.remove_gauge(moved, fit)
    report = lambda p, r: cameras.residual_report(kept, p, r)
    return {"poses": aligned, "points": points_after, "before": report(points, rig), "after": report(points_after, poses.with_poses(rig, aligned))}


def clean_masks_job(runs: DataFrame, keypoints: DataFrame, images: DataFrame, least: float = 0.8, retried: DataFrame | None = None) -> dict[str, DataFrame]:
    """Masks of the parts that keypoints hit, and a report: parts, coverage before and after, retried, emptied and low flags.

    ``retried``: the cameras (capture_id, camera_label) whose mask was made a second time.
    """
    keys = ["capture_id", "camera_label"]
    px = keypoints.join(images.select(*keys, "w", "h"), keys)
    px = px.withColumn("px", cameras.rounded_pixel(F.col("u"), F.col("w"))).withColumn("py", cameras.rounded_pixel(F.col("v"), F.col("h")))
    labelled = components.mask_components(runs, keys)
    clean = components.component_hits(labelled, px, keys)[0].select(*keys, "y", "x0", "x1")
    cover = {c: F.round(c, 4) for c in ("coverage_before", "coverage_after")}  # as keypoint_coverage has it, without moving the runs again
    report = components.component_report(labelled, px, keys).join(images.select(*keys), keys, "left_semi").withColumns(cover)
    again = report.select(*keys).limit(0) if retried is None else retried.select(*keys).distinct()
    report = report.join(again.withColumn("retried", F.lit(True)), keys, "left").withColumn("retried", F.coalesce("retried", F.lit(False)))
    flags = {"emptied": F.col("components_kept") == 0, "low_coverage": F.col("coverage_after") < least}
    return {"masks": clean, "report": report.withColumns(flags)}


def dataset_job(first: DataFrame, last: DataFrame, frames: DataFrame, runs: DataFrame, n: int, min_views: int, fps: float, test: list[str], holdout: list[str], pixels: DataFrame | None = None, seeds: int = 500_000) -> dict[str, DataFrame]:
    """Views, hull points with time and colour, and the violations of the rigs and of the sets, for all captures at once.

    ``n`` points in all are carved from the masks (``runs``, by frame) in the box that the middle frame shows, at least 200 a frame.
    """
    boxes = cut(dataset.find_bbox(first, runs, min_views, seeds))  # one row a capture, read twice
    usable = boxes.filter("error is null")
    each = runs.select("capture_id", "frame_idx").distinct().groupBy("capture_id").count().agg(F.max("count")).first()[0] or 1
    points = dataset.carve_in_place(usable, first, runs, max(n // each, 200), min_views).withColumn("time", F.col("frame_idx") / fps)
    if pixels is not None:
        points = dataset.hull_colour(points, first, pixels)
    views = cameras.holdout_split(dataset.drop_held_frames(frames).join(first, ["capture_id", "camera_label"]), test, holdout)
    views = views.withColumn("time", F.col("frame_idx") / fps)
    return {"views": views, "points": points, "boxes": boxes, "rig_violations": validate.validate_static_rig(first, last), "violations": validate.validate_dataset(views, points)}


def bake_job(raw: DataFrame, time_min: float, time_max: float, keep: float | None = None, corrupted: bool = True, dark: bool = False, black: bool = False, masks: dict | None = None, clamp: float = 1.5, cluster: bool = True) -> dict[str, DataFrame]:
    """Splats of a raw 4D model, and their profile: covariances sliced, colours folded and clamped, the top share kept,
    those outside the masks over their lifetime dropped, then the filters of the source and the main cluster of all rows.

    ``raw``: clip_id, splat_id, x, y, z, t_center, opacity and the columns of the slice and the fold; with ``masks``
    (the other arguments of ``lifetime_votes``) also capture_id.
    """
    folded = poses.fold_temporal_sh(raw)
    dc = [F.col("dc")[c].alias(f"f_dc_{c}") for c in range(3)]
    channel = lambda c: lambda v: v[c].cast("float")  # noqa: E731  (of one argument: a second one would be the index)
    rest = F.flatten(F.array(*(F.transform("rest", channel(c)) for c in range(3)))).alias("f_rest")
    own = [c for c in ("capture_id",) if c in raw.columns]
    # what the filters judge goes through the slice, behind which they stay: pushed below the fold, they would work it out again for each colour
    scalars = [*own, "x", "y", "z", "t_center", "opacity", *(f"f_dc_{c}" for c in range(3))]
    flat = folded.select("clip_id", "splat_id", *(c for c in scalars if not c.startswith("f_dc_")), *dc, "log_scale", "log_scale_t", "rot_l", "rot_r")
    sliced = poses.slice_4d_covariance(flat, carry=tuple(scalars))
    keys = ["clip_id", "splat_id"]
    joined = sliced.join(folded.select(*keys, rest), keys)
    made = splats.clamp_sh(joined.select(*keys, *scalars, "f_rest", *(c for c in sliced.columns if c not in {*keys, *scalars})), limit=clamp)
    if keep is not None:
        made = splats.top_fraction(made, keep, time_min, time_max)
    seen = cameras.drop_by_lifetime(made, **masks).select("clip_id", "splat_id") if masks else None
    baked = splats.filter_splats(made, time_min, time_max, corrupted, dark, black, seen, cluster)
    times = [time_min + (time_max - time_min) * k / 4 for k in range(5)]
    clips = raw.select("clip_id").distinct().count()  # of the given rows, so that nothing is baked for being counted
    return {"splats": baked, "profile": splats.temporal_profile(baked, times, clips), "kept": splats.kept_share(raw, baked)}


def flipbook_job(frames: DataFrame, fps: float, budget: int, n_frames: int, stride: int = 1, k: int = 256) -> dict[str, DataFrame]:
    """Packed tables of static frames: normalised, visible, within the budget, and timed."""
    rows = frames.select(*(c for c in frames.columns if not c.startswith("rot_")), *normalised_quaternion())
    kept = splats.top_budget(splats.filter_visible(rows), budget, n_frames)
    timed = written(splats.flipbook_to_splats(kept, fps, stride))  # every table of the pack reads it: frames are ranked once
    return quantize.pack(timed, 0.0, n_frames * stride / fps, stride / fps, k)


def compare_job(a: DataFrame, b: DataFrame, ranges: DataFrame, time_min: float, time_max: float, duration: float, sides: list[tuple[DataFrame | None, DataFrame | None]]) -> dict[str, DataFrame]:
    """Every judgement on two splat sets: counts, groups, members, fields with their errors, weights, rotations and harmonics.

    ``sides``: (ranges, codebooks) of each side that was quantised, from which the tolerances come.
    """
    sides = [(None if r is None else cut(r), books) for r, books in sides]  # a few rows a clip
    ranges = cut(ranges)
    side = lambda df: compare.integer_keys(temporal.with_group(df, time_min, time_max, duration), ranges)
    rest = ["f_rest"] if "f_rest" in a.columns and "f_rest" in b.columns else []
    scored = ["x", "y", "z", "vx", "vy", "vz", *(f"scale_{i}" for i in range(3)), *(f"f_dc_{i}" for i in range(3)), "t_center", "t_sigma", "opacity"]
    fields = ["splat_id", *scored, *(f"rot_{i}" for i in range(4)), *rest, *(f"k_{c}" for c in compare.KEYS)]
    pairs = compare.pair_splats(side(a), side(b), fields)
    table = lambda df: temporal.segment_table(df, time_min, time_max, duration)
    fixed = compare.repair_pairs(pairs)  # written once; every table below reads the pairs
    out = {
        "counts": compare.count_differences(a, b),
        "presence": compare.field_presence(a, b, ["ax", "ay", "az"], ["f_rest"]),
        "groups": compare.group_differences(table(a), table(b)),
        "members": compare.membership(fixed),
        "displaced": compare.displaced(fixed),
        "errors": compare.error_table(fixed, scored),
        "fields": compare.judge_each(compare.tolerances(fixed, scored, sides), scored),
        "weights": compare.temporal_weight_error(fixed, time_min, time_max),
        "rotations": compare.rotation_error(fixed),
    }
    return out | ({"harmonics": compare.sh_layout_ratio(fixed)} if rest else {})


def mask_filter_job(rows: DataFrame, rig: DataFrame, runs: DataFrame, limit: float = 0.5, radius: float | None = None) -> DataFrame:
    """Splats that few masks see outside, and within ``radius`` of their clip's middle."""
    drop = cameras.vote_fraction(cameras.mask_votes(rows, rig, runs), limit)
    kept = rows.join(drop, ["capture_id", "clip_id", "splat_id"], "left_anti")
    return kept if radius is None else splats.filter_radius(kept, rows, radius)


def evaluate_job(rendered: DataFrame, truth: DataFrame, keys: list[str], report: DataFrame, coverage: DataFrame, views: DataFrame, golden: DataFrame) -> dict[str, DataFrame]:
    """Scores of rendered views, the run's figures, and their gate against a baseline."""
    scored, missing = evaluate.score_views(rendered.select(*keys).distinct(), truth.select(*keys).distinct(), keys)
    mse = evaluate.image_mse(rendered, truth, keys).withColumn("psnr_db", evaluate.psnr(F.col("mse"), 255.0)).join(scored, keys)
    run = evaluate.measure_run(report, coverage, views)
    parts = ("median_reprojection_error_px", "eval4d_psnr_db")
    rows = F.array(*(F.struct(F.lit(m).alias("metric"), F.lit(None).cast("string").alias("camera"), F.col(m).alias("value")) for m in parts))
    masks = coverage.select(F.lit("mask_coverage").alias("metric"), F.col("camera_label").alias("camera"), F.col("coverage").alias("value"))
    metrics = run.select(F.explode(rows).alias("r")).select("r.*").unionByName(masks)
    return {"views": mse, "missing": missing, "run": run, "gate": evaluate.gate_baseline(metrics, golden)}


def validate_job(stage: str, **given: DataFrame) -> DataFrame:
    """The violations of one stage's tables: sync, frames, poses, masks, dataset or result. ``given`` are its check's arguments."""
    checks = {
        "sync": validate.validate_sync, "frames": validate.validate_frames, "poses": validate.validate_poses,
        "masks": validate.validate_masks, "dataset": validate.validate_dataset, "result": validate.validate_result,
    }
    if stage not in checks:
        raise ValueError(f"no check of {stage}")
    return checks[stage](**given)
