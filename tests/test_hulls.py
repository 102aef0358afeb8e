"""Hulls carved by need."""

import pytest
from pyspark.sql import functions as F

from rigspark.operators import cameras, dataset
from rigspark.plans.queries import QUERIES

from .test_analytic import rig_frame, ring

BOX = "capture_id long, " + ", ".join(f"{n}_{a} double" for a in "xyz" for n in ("min", "max"))


def test_only_frames_that_are_short_go_on(spark, monkeypatch):
    """Frames with a wide, a narrow and an idle mask, and a capture without a box: the rows are the first of all candidates, from fewer of them."""
    wide = {(0, 0): (0, 1919), (0, 1): (935, 985), (0, 2): (0, 0), (7, 0): (0, 1919)}
    rows = [(c, f"c{i}", f, y, *x) for (c, f), x in wide.items() for i in range(6) for y in range(0, 1080)]
    runs = spark.createDataFrame(rows, "capture_id long, camera_label string, frame_idx int, y int, x0 int, x1 int").cache()
    rig = rig_frame(spark, ring())
    rig = rig.unionByName(rig.withColumn("capture_id", F.lit(7).cast("long")))
    box = spark.createDataFrame([(0, -0.5, 0.5, -0.5, 0.5, -0.5, 0.5)], BOX)
    n, views, asked, plain = 20, 5, [], dataset.candidates

    def watched(boxes, frames, first, upto):
        asked.append((first, upto, sorted(r.frame_idx for r in frames.select("frame_idx").collect())))
        return plain(boxes, frames, first, upto)

    monkeypatch.setattr(dataset, "candidates", watched)
    got = {(r.capture_id, r.frame_idx, r.point_id, r.x, r.y, r.z, r.votes) for r in dataset.carve_hull(box, rig, runs, n, views).collect()}
    every = plain(box, runs.select("capture_id", "frame_idx").distinct(), 0, 32 * n)
    held = {}
    for r in cameras.hull_votes(every, rig, runs, views, by=("frame_idx",)).orderBy("point_id").collect():
        held.setdefault((r.capture_id, r.frame_idx), []).append((r.capture_id, r.frame_idx, r.point_id, r.x, r.y, r.z, r.votes))
    assert got == {p for points in held.values() for p in points[:n]}
    assert len(held[0, 0]) > n and (0, 2) not in held and (7, 0) not in held
    assert asked[0] == (0, 80, [0, 1, 2]) and asked[1] == (80, 160, [1, 2]) and 0 not in {f for *_, frames in asked[1:] for f in frames}
    assert len(asked) == 8  # the idle frame tries all


def test_candidates_fill_their_box_evenly(spark):
    box = spark.createDataFrame([(3, 0.0, 1.0, -2.0, 2.0, 5.0, 6.0)], BOX)
    frames = spark.createDataFrame([(3, f) for f in (0, 1)], "capture_id long, frame_idx int")
    cell = [F.floor((F.col(a) - low) / size * 4) for a, low, size in (("x", 0, 1), ("y", -2, 4), ("z", 5, 1))]
    counts = dataset.candidates(box, frames, 0, 6400).groupBy("frame_idx", *cell).count().collect()
    assert len(counts) == 2 * 64 and all(abs(r["count"] - 100) < 25 for r in counts)
    assert dataset.candidates(box, frames, 0, 50).select("x", "y", "z").distinct().count() == 100


def test_no_masks_no_points(spark):
    runs = spark.createDataFrame([], "capture_id long, camera_label string, frame_idx int, y int, x0 int, x1 int")
    box = spark.createDataFrame([(0, -0.5, 0.5, -0.5, 0.5, -0.5, 0.5)], BOX)
    assert dataset.carve_hull(box, rig_frame(spark, ring()), runs, 20, 5).count() == 0


def test_each_part_of_the_job_has_rows(spark, sf_dir):
    rows = QUERIES["dataset_job"](spark, sf_dir).collect()
    assert {r.part for r in rows} >= {"box", "points", "views", "rig", "set"}
    assert {r.n for r in rows if r.part == "points"} and {r.label.split()[1] for r in rows if r.part == "views"} == {"train", "test"}


def test_boxes_are_found_beside_the_masks(spark, monkeypatch):
    """The box of all candidates that the plain votes hold, from tasks that make and judge them; nothing of them is joined or grouped."""
    monkeypatch.setattr(dataset, "TRIED", 300)
    rows = [(c, f"c{i}", f, y, 700 + 20 * i, 1300 + 90 * f) for c in (0, 7) for i in range(6) for f in (1, 2, 5) for y in range(200, 900)]
    runs = spark.createDataFrame(rows, "capture_id long, camera_label string, frame_idx int, y int, x0 int, x1 int").cache()
    rig = rig_frame(spark, ring())
    rig = rig.unionByName(rig.withColumn("capture_id", F.lit(7).cast("long")))
    middle = runs.select("capture_id", "frame_idx").distinct().filter("frame_idx = 2")
    tried = dataset.candidates(dataset.search_box(rig), middle, 0, 2000)
    plain = dataset.hull_bbox(cameras.hull_votes(tried, rig, runs.filter("frame_idx = 2"), 4, by=("frame_idx",)))
    got = dataset.find_bbox(rig, runs, 4, 2000)
    assert sorted(map(tuple, got.select(*plain.columns).collect())) == sorted(map(tuple, plain.collect())) and plain.count() == 2
    assert "Generate explode(sequence" not in got._jdf.queryExecution().optimizedPlan().toString()
