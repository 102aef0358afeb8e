"""Votes of timed masks: rows and masks stream by frame, and no packed mask is ever dealt."""

import numpy as np
from pyspark.sql import functions as F

from rigspark.operators import cameras as C


def _tables(spark):
    rng = np.random.default_rng(4)
    pose = lambda a: [float(v) for v in (np.cos(a), 0, np.sin(a), 8 * np.sin(a), 0, -1, 0, 0.5, np.sin(a), 0, -np.cos(a), -8 * np.cos(a), 0, 0, 0, 1)]
    rig = spark.createDataFrame([(c, f"cam_{k}", 60.0, 60.0, 70.0, 20.0, 140, 40, pose(k + c)) for c in (1, 2, 3) for k in range(5)], "capture_id long, camera_label string, fl_x double, fl_y double, cx double, cy double, w int, h int, c2w array<double>")
    runs = [(c, f"cam_{k}", f, y, int(rng.integers(0, 60)), int(rng.integers(60, 200))) for c in (1, 2, 4) for k in range(6) for f in range(3) for y in range(-2, 42) if (k, f) != (2, 1)]
    runs += [(2, "cam_0", 0, 5, None, 9), (None, "cam_0", 0, 5, 1, 9), (1, "cam_1", 0, 7, 130, 139)]
    runs = spark.createDataFrame(runs, "capture_id long, camera_label string, frame_idx int, y int, x0 int, x1 int")
    rows = [(c, 7, s, f, *map(float, rng.normal(size=3) * 2)) for c in (1, 2, 3, 4) for s in range(60) for f in range(4)]
    rows += [(1, 7, 900, 0, float("nan"), 0.0, 0.0), (1, 7, 901, 0, None, 0.0, 0.0), (None, 7, 902, 0, 0.0, 0.0, 0.0), (2, 7, 1, 0, 0.0, 0.0, 0.0)]
    return rig, runs, spark.createDataFrame(rows, "capture_id long, clip_id long, splat_id long, frame_idx int, x double, y double, z double")


def test_streamed_votes_equal_joined_ones(spark):
    """In batches that end amid masks and rows of a frame, with cameras and frames that lack masks, captures that lack rigs, and empty places."""
    rig, runs, at = _tables(spark)
    keys = ["capture_id", "clip_id", "splat_id"]
    # a place that is no number is in no image, as in mask_votes; the join would take it for the first pixel
    want = C._votes(C._seen(at.filter(C._finite("x", "y", "z")), C._masked_rig(rig, runs, "frame_idx"), keys, ["capture_id", "frame_idx"], 0.05), keys)
    want = sorted(map(tuple, want.select(*keys, "tested", "outside").collect()))
    assert len(want) > 100 and any(0 < r[4] < r[3] for r in want)
    for batch in (3, 50, 10_000):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        try:
            got = C._votes_by_frame(at, rig, runs, keys, 0.05).groupBy(*keys).agg(F.sum("tested"), F.sum("outside"))
            assert sorted(map(tuple, got.collect())) == want
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_no_packed_mask_is_dealt(spark):
    rig, runs, at = _tables(spark)
    given = at.withColumns({"vx": F.lit(0.0), "vy": F.lit(0.0), "vz": F.lit(0.0), "t_center": F.lit(0.0), "t_sigma": F.lit(1.0), "opacity": F.lit(2.0)})
    votes = C.lifetime_votes(given, rig, runs, [0.0, 0.5, 1.0])
    assert "words" not in votes._jdf.queryExecution().executedPlan().toString()
    assert votes.filter("tested > 0").count() == votes.count() > 100
