"""Steps that grew faster than their input: what they must not do again, and results against plain Python."""

from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from rigspark.operators import cameras, evaluate, scratch
from rigspark.plans import fixtures as X
from rigspark.plans import jobs

from .test_analytic import cloud, ring, rig_frame


def planned(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_mean_square_of_whole_numbers_is_exact(spark):
    """Thirds summed in an order of chance differ in the last place; whole squares do not."""
    rng = np.random.default_rng(5)
    rows = [(v, k, 0, *map(int, rng.integers(0, 256, 6))) for v in range(60) for k in range(2 + v % 11)]
    table = spark.createDataFrame(rows, "view int, x int, y int, r int, g int, b int, r2 int, g2 int, b2 int").repartition(7)
    other = table.select("view", "x", "y", *(F.col(f"{c}2").alias(c) for c in "rgb"))
    got = {r.view: r.mse for r in evaluate.image_mse(table.select("view", "x", "y", *"rgb"), other, ["view"]).collect()}
    for v in range(60):
        squares = [sum((r[3 + c] - r[6 + c]) ** 2 for c in range(3)) for r in rows if r[0] == v]
        assert got[v] == float(Fraction(sum(squares), 3 * len(squares)))


def test_flipbook_ranks_its_frames_once(spark, sf_dir):
    frames = X.splats(spark, sf_dir).drop("t_center", "t_sigma", "vx", "vy", "vz")
    made = jobs.flipbook_job(frames, 30.0, 350, 7, k=8)
    for name in ("planes", "segments", "clips"):
        assert "l_extendedprice" not in planned(made[name]) and made[name].count() > 0


def test_keypoints_meet_runs_as_they_are(spark):
    """Overlapping runs count once; edges, a camera without mask, one without keypoints, null ends and null positions."""
    images = spark.createDataFrame([(1, c, 20, 10) for c in ("a", "b", "c")], "capture_id long, camera_label string, w int, h int")
    runs = spark.createDataFrame([(1, "a", 2, 3, 6), (1, "a", 2, 5, 9), (1, "a", 9, 0, 19), (1, "a", 4, None, 7), (1, "c", 0, 0, 3), (2, "b", 2, 0, 19)], "capture_id long, camera_label string, y int, x0 int, x1 int")
    points = [(3.0, 2.0), (5.5, 2.0), (9.4, 2.4), (9.6, 2.0), (99.0, 50.0), (5.0, 4.0), (None, 2.0), (-3.0, 9.0)]
    keypoints = spark.createDataFrame([(1, c, u, v) for c in ("a", "b") for u, v in points], "capture_id long, camera_label string, u double, v double")
    out = cameras.keypoint_coverage(keypoints, runs, images)
    assert "collect_list" not in planned(out)
    got = {r.camera_label: r.coverage for r in out.collect()}
    assert got.keys() == {"a", "b", "c"} and got["a"] in (5 / 8, 6 / 8) and got["b"] == got["c"] == 0


def test_tasks_grow_with_cameras(spark, monkeypatch):
    """Beyond the bound of a broadcast, points and rig are dealt over a number of tasks that grows with the cameras."""
    rig = rig_frame(spark, ring(12))
    points = spark.createDataFrame([(0, k, *map(float, p)) for k, p in enumerate(cloud(9))], "capture_id long, kp_idx int, x double, y double, z double")
    rows = lambda df: {(r.kp_idx, r.camera_label): (r.u, r.v) for r in df.collect()}
    few = rows(cameras.project_points(points, rig))
    monkeypatch.setattr(scratch, "MOST_NUMBERS", 0)
    monkeypatch.setattr(cameras, "CAMERAS", 1)
    many = cameras.project_points(points, rig)
    assert planned(many).count("RepartitionByExpression [capture_id") == 2 and ", 12" in planned(many)
    assert rows(many) == few and len(few) == 108


def test_baking_is_not_run_for_being_counted(spark, monkeypatch):
    """The profile takes its number of clips from the given rows; and colours are judged behind the slice, not again below the fold."""
    from rigspark.operators import quantiles, splats

    bounds = []
    real = quantiles.select_ranks
    monkeypatch.setattr(splats, "select_ranks", lambda df, keys, wanted, groups_at_most=None: bounds.append(groups_at_most) or real(df, keys, wanted, groups_at_most))
    n = F.col("id")
    triple = lambda v: F.array(v, F.lit(0.0), F.lit(0.0))
    raw = spark.range(40).select(
        (n % 2).alias("clip_id"), n.alias("splat_id"), *((n / 10.0).alias(a) for a in "xyz"), F.lit(1.0).alias("t_center"), F.lit(2.0).alias("opacity"), F.array(F.lit(0.1), F.lit(0.2), F.lit(0.3)).alias("dc"),
        F.transform(F.sequence(F.lit(0), F.lit(46)), lambda k: triple(F.when(k == 15, n / 100.0).when(k == 31, 0.5).otherwise(0.0))).alias("rest"), F.array(*(F.lit(x) for x in (-2.0, -1.0, -3.0))).alias("log_scale"),
        F.lit(0.0).alias("log_scale_t"), *(F.array(F.lit(1.0), *(F.lit(0.0) for _ in range(3))).alias(c) for c in ("rot_l", "rot_r")),
    )
    made = jobs.bake_job(raw, 0.0, 2.0, corrupted=False, black=True, cluster=False)
    assert bounds == [2] and made["profile"].count() == 2
    got = {r.splat_id: r for r in made["splats"].collect()}
    assert len(got) == 40 and all(np.isclose(r.f_dc_0, 0.1 + k / 100 + 0.5) and len(r.f_rest) == 45 and np.isclose(r.t_sigma, 1.0) for k, r in got.items())
    assert made["splats"].columns[:5] == ["clip_id", "splat_id", "x", "y", "z"]
