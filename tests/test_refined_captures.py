"""Bundle adjustment of many captures at once: those of few points in groups of their own, those of many by shared rounds."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from rigspark.operators import cameras, poses
from rigspark.plans.queries import QUERIES

from .test_analytic import cloud, observed, rig_frame, ring

FEW, MANY = (0, 3), 7


def captures(spark):
    """Two captures of 25 points and one of 60, and a camera that sees nothing; nothing of one fits another."""
    seen, rigs = [], []
    for c, n, shake in ((0, 25, 0.01), (3, 25, 0.02), (MANY, 60, 0.01)):
        blind = ("blind", ring(5)[2][1])
        seen.append(observed(spark, ring(5), cloud(n, seed=c)).withColumn("capture_id", F.lit(c).cast("long")))
        rigs.append(rig_frame(spark, [*ring(5, shake, seed=c), blind]).withColumn("capture_id", F.lit(c).cast("long")))
    return seen[0].union(seen[1]).union(seen[2]), rigs[0].union(rigs[1]).union(rigs[2])


@pytest.mark.parametrize("most", [10, 40, 100])
def test_captures_large_and_small(spark, monkeypatch, most):
    monkeypatch.setattr(poses, "POINTS", most)
    obs, rig = captures(spark)
    start = poses.triangulate(obs, rig)
    refined, points = poses.refine_poses(obs, rig, start, rounds=8)
    report = lambda p, r: {r.capture_id: r.median for r in cameras.residual_report(obs, p, r).filter("camera_label is null").collect()}
    before, after = report(start, rig), report(points, poses.with_poses(rig, refined))
    assert set(after) == {*FEW, MANY} and all(before[c] > 2 and after[c] < 0.05 * before[c] for c in after)
    assert {(r.capture_id, r.camera_label) for r in refined.collect()} == {(r.capture_id, r.camera_label) for r in rig.collect()}
    assert {(r.capture_id, r.tem, r.kp_idx) for r in points.collect()} == {(r.capture_id, r.tem, r.kp_idx) for r in start.collect()}
    given = {(r.capture_id, r.camera_label): r.w2c for r in poses.given_poses(rig).collect()}
    assert all(np.allclose(r.w2c, given[r.capture_id, r.camera_label]) for r in refined.filter("camera_label = 'blind'").collect())


def test_one_capture_does_not_hold_back_another(spark, monkeypatch):
    """Each small capture is damped for itself, so it ends where it ends alone; and no round of Spark's is run for it."""
    monkeypatch.setattr(poses, "_refined_together", None)
    obs, rig = captures(spark)
    start = poses.triangulate(obs, rig)
    rows = lambda df: {(r.capture_id, r.camera_label): r.w2c for r in df.collect()}
    whole = rows(poses.refine_poses(obs, rig, start, rounds=4)[0])
    for c in (*FEW, MANY):
        own = [df.filter(F.col("capture_id") == c) for df in (obs, rig, start)]
        alone = rows(poses.refine_poses(*own, rounds=4)[0])
        assert all(np.allclose(w, whole[k], atol=1e-6) for k, w in alone.items())


def test_captures_that_settle_slowly(spark, sf_dir, tmp_path):
    """Two captures whose steps must be damped anew in most rounds, and one with a camera that pixels hardly show to be off."""
    captures = (209, 418, 573)
    made = {
        "supplier": f"SELECT CAST(unnest({list(captures)}) AS BIGINT) AS s_suppkey",
        "nation": f"SELECT * FROM '{sf_dir}/nation.parquet'",
        "part": f"SELECT CAST(20 * capture + k AS BIGINT) AS p_partkey FROM (SELECT unnest({list(captures)}) AS capture), range(20) AS numbers(k)",
    }
    for name, sql in made.items():
        duckdb.sql(f"COPY ({sql}) TO '{tmp_path}/{name}.parquet' (FORMAT parquet)")
    rows = QUERIES["refine_poses"](spark, str(tmp_path)).collect()
    assert {(r.capture_id, r.camera_label) for r in rows} == {(c, f"cam_{k}") for c in captures for k in range(25)}
    assert all((r.n, r.was_off, r.fits) == (10, True, True) for r in rows)
