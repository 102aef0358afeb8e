"""Small files under names of their own: written and found by tasks, read as Spark's own reader reads them."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from rigspark.sources import tables, texts


def _files(spark, captures=12):
    keypoints = json.dumps({"instance_info": [{"keypoints": [[1.0, 2.0], [3.0], [4.0, 5.0]], "keypoint_scores": [0.5]}, {"keypoints": [[9.0, 9.0]]}]})
    rows = spark.range(captures).select(F.col("id").alias("capture_id"), F.explode(F.array(F.lit("cam_a"), F.lit("cam b"))).alias("camera"))
    return rows.select("capture_id", "camera", F.explode(F.array(F.lit("t1"), F.lit("t2"))).alias("tem"), F.lit(keypoints).alias("value"))


def test_keypoints_need_no_listing_in_the_driver(spark, tmp_path, monkeypatch):
    """Files lie where the reader's own layout has them, one each, and Spark's file sources are not asked for them."""
    tables.write_keypoints(_files(spark), str(tmp_path))
    found = sorted(os.path.relpath(os.path.join(at, f), tmp_path) for at, _, names in os.walk(tmp_path) for f in names)
    assert found == sorted(f"{c}/{cam}/{tem}.json" for c in range(12) for cam in ("cam_a", "cam b") for tem in ("t1", "t2"))
    got = tables.read_keypoints(spark, str(tmp_path))
    assert "FileScan" not in got._jdf.queryExecution().executedPlan().toString()
    want = sorted((tem, cam, *k) for tem in ("t1", "t2") for cam in ("cam_a", "cam b") for k in ((0, 1.0, 2.0, 0.5), (2, 4.0, 5.0, 1.0)) for _ in range(12))
    assert sorted(map(tuple, got.collect())) == want
    # written again, a file is replaced
    tables.write_keypoints(_files(spark, 1).withColumn("value", F.lit("[]")), str(tmp_path))
    assert tables.read_keypoints(spark, str(tmp_path)).count() == len(want) - 8


@pytest.mark.parametrize("slash", ["camera", "tem"])
def test_a_slash_has_no_file(spark, tmp_path, slash):
    with pytest.raises(Exception, match="a slash in"):
        tables.write_keypoints(_files(spark).withColumn(slash, F.lit("a/b")), str(tmp_path))


def test_read_as_by_sparks_reader(spark, tmp_path):
    """Broken text, wrong types, lists, other encodings and empty files: the same rows by folder (tasks) and by pattern (Spark's reader)."""
    one = {"instance_info": [{"keypoints": [[1.0, 2.0]], "keypoint_scores": [0.25]}]}
    given = {
        "good": json.dumps(one).encode(), "broken": b"{no json", "empty": b"", "blank": b" \n", "list": json.dumps([one, one]).encode(), "no_scores": b'{"instance_info": [{"keypoints": [[1, 2], [3, 4]]}]}',
        "wrong": b'{"instance_info": [{"keypoints": [[1, 2]], "keypoint_scores": "none"}]}', "number": b'{"instance_info": 5}', "none": b"{}", "null": b"null", "wide": json.dumps(one).encode("utf-16"), "mark": json.dumps(one).encode("utf-8-sig"),
        "text": b'"words"', "lines": json.dumps(one, indent=2).encode(), "nothing": b'{"instance_info": []}',
    }
    for name, data in given.items():
        os.makedirs(tmp_path / name)
        (tmp_path / name / "t.json").write_bytes(data)
        (tmp_path / name / "_hidden.json").write_bytes(json.dumps(one).encode())
    rows = lambda path: sorted(map(tuple, tables.read_keypoints(spark, path).collect()))
    got = rows(str(tmp_path))
    assert got == rows(f"{tmp_path}/*/t.json") and {r[1] for r in got} == {"good", "list", "no_scores", "wide", "mark", "lines"}
    assert rows([f"{tmp_path}/good", f"file://{tmp_path}/list/t.json"]) == [r for r in got if r[1] in ("good", "list")]
    assert not texts.opens(f"{tmp_path}/*/t.json") and not texts.opens("viewfs://store/in")


def test_lines_of_captures_are_found_by_tasks(spark, tmp_path):
    """A capture's lines lie in one file in their order, a second set takes the place of the first, and none is listed by the driver."""
    for captures in (30, 20):
        rig = spark.range(captures * 3).select((F.col("id") % captures).alias("capture_id"), F.concat(F.lit("cam_"), (F.col("id") / captures).cast("int").cast("string")).alias("camera_label"), F.lit(9).alias("w"), F.lit(8).alias("h"))
        rig = rig.withColumns({c: F.lit(0.5) for c in ("fl_x", "fl_y", "cx", "cy", "qw", "qx", "qy", "qz", "tx", "ty", "tz")})
        points = spark.range(captures * 50).select((F.col("id") % captures).alias("capture_id"), F.col("id").alias("point_id"), *(F.lit(1.5).alias(c) for c in "xyz"))
        tables.write_sfm_text(rig, points, str(tmp_path))
    for part, n in (("cameras", 3), ("images", 3), ("points3D", 50)):
        assert len(glob.glob(f"{tmp_path}/{part}/*/*")) == 20
        back = tables.read_sfm_lines(spark, f"{tmp_path}/{part}")
        assert "FileScan" not in back._jdf.queryExecution().executedPlan().toString()
        assert {r["count"] for r in back.groupBy("capture_id").count().collect()} == {n} and back.select("capture_id").distinct().count() == 20
        assert sorted(map(tuple, back.collect())) == sorted((str(r.capture_id), r.value) for r in spark.read.text(f"{tmp_path}/{part}").collect())
    assert open(f"{tmp_path}/cameras/capture_id=7/cameras.txt").read() == "".join(f"{k} PINHOLE 9 8 0.5 0.5 0.5 0.5\n" for k in (1, 2, 3))
