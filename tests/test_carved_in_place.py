"""Hulls of many captures: candidates are tried where the masks lie, in one pass."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rigspark.operators import cameras, dataset
from rigspark.plans import jobs

from .test_analytic import rig_frame, ring
from .test_hulls import BOX


def _given(spark):
    """A wide, a narrow and an idle mask, a mask of two cameras alone, and a capture without a box."""
    wide = {(0, 0): (0, 1919), (0, 1): (935, 985), (0, 2): (0, 0), (0, 3): (500, 1400), (7, 0): (0, 1919)}
    rows = [(c, f"c{i}", f, y, *x) for (c, f), x in wide.items() for i in range(2 if f == 3 else 6) for y in range(0, 1080)]
    runs = spark.createDataFrame(rows, "capture_id long, camera_label string, frame_idx int, y int, x0 int, x1 int").cache()
    rig = rig_frame(spark, ring())
    return spark.createDataFrame([(0, -0.5, 0.5, -0.5, 0.5, -0.5, 0.5)], BOX), rig.unionByName(rig.withColumn("capture_id", F.lit(7).cast("long"))), runs


@pytest.mark.parametrize("views, tried", [(5, 1 << 16), (5, 50), (2, 70), (1, 64), (0, 1 << 16)])
def test_same_rows_as_in_rounds(spark, monkeypatch, views, tried):
    box, rig, runs = _given(spark)
    monkeypatch.setattr(dataset, "TRIED", tried)
    want = dataset.carve_hull(box, rig, runs, 20, views)
    got = dataset.carve_in_place(box, rig, runs, 20, views)
    assert dict(got.dtypes) == dict(want.dtypes)
    rows = lambda df: sorted(map(tuple, df.select("capture_id", "frame_idx", "point_id", *"xyz", "votes").collect()))
    assert rows(got) == rows(want) != []


def test_the_job_makes_no_rounds(spark, monkeypatch):
    box, rig, runs = _given(spark)
    for name in ("carve_hull", "candidates", "packed_rig"):
        monkeypatch.setattr(dataset, name, None)
    rig = rig.withColumn("dist", F.array(F.lit(0.0)))
    frames = spark.createDataFrame([(0, "c1", 0, "a", "x"), (0, "c2", 1, "b", "y")], "capture_id long, camera_label string, frame_idx int, hash string, file_path string")
    out = jobs.dataset_job(rig, rig, frames, runs.filter("frame_idx = 0"), 100, 4, 25.0, ["c1"], ["c1"], seeds=4000)
    assert {(r.capture_id, r["count"]) for r in out["points"].groupBy("capture_id").count().collect()} == {(0, 200), (7, 200)}


@pytest.mark.parametrize("least", [0, 1, 4, 6, 7])
def test_points_without_hope_are_left_early(monkeypatch, least):
    """Votes of all that reach ``least`` are whole, whatever the order of cameras, and others stay below."""
    rng = np.random.default_rng(3)
    cams = []
    for _ in range(6):
        turn = np.linalg.qr(rng.normal(size=(3, 3)))[0]
        words = np.packbits(rng.random((40, 128)) < 0.5, axis=1, bitorder="little").view("<i8")
        cams.append({"fl_x": 60.0, "fl_y": 50.0, "cx": 45.0, "cy": 20.0, "w": 100, "h": 40, **{f"r{i}{j}": turn[i, j] for i in range(3) for j in range(3)}, "tx": 0.1, "ty": -0.2, "tz": 0.5, "words": words.ravel().tolist()})
    x, y, z = rng.normal(size=(3, 9001))
    whole = cameras.mask_counts(x, y, z, pa.array(cams), 0.05)
    tested, votes = cameras.mask_counts(x, y, z, pa.array(cams), 0.05, least)
    good = whole[1] >= least
    assert (votes[good] == whole[1][good]).all() and (tested[good] == whole[0][good]).all() and (votes[~good] < least).all()
    assert whole[1].max() >= 4
