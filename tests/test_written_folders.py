"""Folders of many captures, written by one task each."""

import glob

from pyspark.sql import functions as F

from rigspark.sources import tables


def test_a_capture_is_one_file(spark, tmp_path):
    points = spark.range(0, 600, 1, 6).select((F.col("id") % 20).alias("capture_id"), F.col("id").alias("point_id"), *(F.lit(0.5).alias(c) for c in "xyz"))
    fixed = {c: F.lit(0.0) for c in ("fl_x", "fl_y", "cx", "cy", "qw", "qx", "qy", "qz", "tx", "ty", "tz")}
    cameras = spark.range(0, 60, 1, 6).select((F.col("id") % 20).alias("capture_id"), F.concat(F.lit("cam_"), F.col("id")).alias("camera_label"), F.lit(9).alias("w"), F.lit(9).alias("h")).withColumns(fixed)
    tables.write_sfm_text(cameras, points, str(tmp_path))
    for part in ("cameras", "images", "points3D"):
        assert len(glob.glob(f"{tmp_path}/{part}/*/*.txt")) == 20
    assert spark.read.text(f"{tmp_path}/points3D").count() == 600


def test_captures_are_written_by_all_tasks(spark, tmp_path):
    """A small table in one piece, or one whose shuffle is brought together again, would leave all files to one task."""
    points = spark.range(0, 600, 1, 1).select((F.col("id") % 40).alias("capture_id"), F.lit(0).alias("frame_idx"), *(F.lit(0.5).alias(c) for c in ("x", "y", "z", "time")), *(F.lit(1).alias(c) for c in "rgb"))
    tables.write_hull_points(points, str(tmp_path / "hull"))
    cameras = spark.range(0, 120, 1, 1).select((F.col("id") % 40).alias("capture_id"), F.col("id").cast("string").alias("camera_label"), F.lit("a.jpg").alias("file_path"), F.array_repeat(F.lit(1.0), 16).alias("c2w"))
    tables.write_transforms(cameras, str(tmp_path / "rigs"))
    for part in ("hull", "rigs"):
        files = glob.glob(f"{tmp_path}/{part}/capture_id=*/part-*")
        assert len(files) == 40
        assert len({f.split("/part-")[1].split("-")[0] for f in files}) > 4
    assert spark.read.parquet(str(tmp_path / "hull")).count() == 600
    assert tables.read_cameras(spark, str(tmp_path / "rigs")).count() == 120
