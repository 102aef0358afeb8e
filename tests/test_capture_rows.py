"""Captures and cameras solved many at a time, against the plain form of the same rule."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rigspark.operators import poses, sync


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_peaks_of_pairs_equal_those_of_the_profile(spark):
    rng = np.random.default_rng(8)
    rows = []
    for capture in range(4):
        sound = rng.normal(size=900) * (rng.random(900) < 0.1)
        rows += [(capture, f"cam_{c}", 1000, [0.0] * (17 * c) + sound.tolist()) for c in range(3)]
    rows += [(0, "still", 1000, [0.0] * 900), (2, "short", 1000, [0.5] * 100), (3, "other", 1000, rng.normal(size=700).tolist())]
    clips = spark.createDataFrame(rows, "capture_id long, camera string, sample_rate int, samples array<double>")
    got = sync.full_rate_pairs(clips, 1000)
    assert "Window" not in _plan(got) and "Join" not in _plan(got)
    want = {(r.capture_id, r.cam_a, r.cam_b): r for r in sync.best_lag(sync.full_rate_profile(sync.envelopes(clips)), 1000.0).collect()}
    seen = 0
    for r in got.collect():
        w = want.get((r.capture_id, r.cam_a, r.cam_b))
        if w is None:
            assert (r.offset_seconds, r.match_quality, r.peak_ratio, r.confident) == (0.0, 0.0, 1.0, False)
        else:
            seen += 1
            assert r.confident == w.confident and (r.offset_seconds, r.match_quality, r.peak_ratio) == pytest.approx((w.offset_seconds, w.match_quality, w.peak_ratio), rel=1e-9, abs=1e-12)
    assert seen == len(want) > 12 and got.count() == 3 + 6 + 6 + 6


def test_offsets_without_rounds_of_joins(spark, monkeypatch):
    """A chain, a ring with an error of its own, a part that nothing ties to the reference, and a capture without any pair."""
    monkeypatch.setattr(sync, "cut", None)
    chain = [(1, f"c{k:02}", f"c{k + 1:02}", 0.25 * k, True) for k in range(30)]
    ring = [(2, "a", "b", 1.0, True), (2, "b", "c", 1.0, True), (2, "a", "c", 2.3, True), (2, "x", "y", 5.0, True), (2, "a", "x", 9.0, False)]
    pairs = spark.createDataFrame(chain + ring, "capture_id long, cam_a string, cam_b string, offset_seconds double, confident boolean")
    reference = spark.createDataFrame([(1, "c03"), (2, "a"), (3, "alone")], "capture_id long, camera string")
    got = {(r.capture_id, r.camera): (r.offset_seconds, r.max_residual_seconds) for r in sync.offset_lsq(pairs, reference).collect()}
    start = np.concatenate(([0.0], np.cumsum([0.25 * k for k in range(30)])))
    want = {(1, f"c{k:02}"): (start[k] - start[3], 0.0) for k in range(31)} | {(3, "alone"): (0.0, 0.0)}
    want |= {(2, "a"): (0.0, 0.1), (2, "b"): (1.1, 0.1), (2, "c"): (2.2, 0.1)}
    assert set(got) == set(want)
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


def test_poses_of_many_cameras_are_averaged_together(spark, monkeypatch):
    monkeypatch.setattr(poses, "POSE_PAIRS", 40)  # several blocks of cameras
    rng = np.random.default_rng(2)
    rows, want = [], {}
    for k in range(30):
        n, axis = 1 + k % 6, rng.normal(size=3)
        turn, centre = poses._turn(axis / np.linalg.norm(axis) * 0.7), rng.normal(size=3) * 5
        for i in range(n):
            far = n >= 4 and i == n - 1
            m = np.eye(4)
            m[:3, :3] = turn
            m[:3, 3] = -turn @ (centre + (90 if far else 0))
            rows.append((k // 7, f"cam_{k % 7}", f"i{i}", m.ravel().tolist()))
        want[k // 7, f"cam_{k % 7}"] = (n, n - (n >= 4), centre)
    mean = poses.robust_pose_average(spark.createDataFrame(rows, "capture_id long, camera_label string, image string, w2c array<double>"))
    assert "FlatMapGroupsInPandas" not in _plan(mean)
    at = poses.camera_centres(mean, "c").join(mean, ["capture_id", "camera_label"]).select("capture_id", "camera_label", "num_views", "num_inliers", F.array("c_x", "c_y", "c_z").alias("c"), "center_spread_max").collect()
    assert len(at) == len(want)
    for r in at:
        n, inside, centre = want[r.capture_id, r.camera_label]
        assert (r.num_views, r.num_inliers) == (n, inside) and r.c == pytest.approx(centre.tolist(), abs=1e-9) and r.center_spread_max < 1e-9
