"""Queries of files: written in the layout that a reader expects, read again, and compared with the rows they came from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import tables
from . import fixtures as X
from .further import _folder, _table
from .queries import query

#: Eight neighbouring captures as one, so that files are fewer; the keypoints of a part are numbered throughout.
_OBS = f"SELECT CAST(floor(capture_id / 8e0) AS BIGINT) AS capture_id, tem, kp_idx, camera_label, u, v, score FROM ({X.OBSERVATIONS}) AS o"
_KEPT = "SELECT *, row_number() OVER (PARTITION BY capture_id, tem, camera_label ORDER BY kp_idx) - 1 AS place FROM obs"


def _instances(obs: DataFrame) -> DataFrame:
    """The keypoints of each (capture, tem, camera) as one list; each seventh place has no second coordinate."""
    entry = F.struct("kp_idx", "u", "v", "score")
    lists = obs.groupBy("capture_id", "tem", "camera_label").agg(F.array_sort(F.collect_list(entry)).alias("k"))
    point = F.transform("k", lambda k, i: F.when(i % 7 == 2, F.array(k["u"])).otherwise(F.array(k["u"], k["v"])))
    return lists.select("capture_id", "tem", "camera_label", point.alias("keypoints"), F.transform("k", lambda k: k["score"]).alias("keypoint_scores"))


@query(  # the first instance of each file; a file without instances, and one that is no JSON, give nothing
    "keypoint_files",
    "SELECT capture_id, tem, camera_label, CAST(place AS INT) AS kp_idx, round(u, 6) + 0e0 AS u, round(v, 6) + 0e0 AS v, CASE WHEN camera_label LIKE '%4' THEN 1e0 ELSE score END AS score FROM kept WHERE place % 7 <> 2 AND camera_label NOT IN ('cam_7', 'cam_8')",
    obs=_OBS, kept=_KEPT,
)
def _(spark, d):
    path, label = _folder(spark), F.col("camera_label")
    rows = _instances(X.derive(spark, d, _OBS))
    second = F.struct(F.array(F.array(F.lit(-1.0), F.lit(-1.0))).alias("keypoints"), F.array(F.lit(0.5)).alias("keypoint_scores"))
    scores = F.when(~label.endswith("4"), F.col("keypoint_scores"))
    both = F.array(F.struct("keypoints", scores.alias("keypoint_scores")), second)
    text = F.to_json(F.struct(F.when(label == "cam_7", F.slice(both, 1, 0)).otherwise(both).alias("instance_info")))
    files = rows.select("capture_id", label.alias("camera"), "tem", F.when(label == "cam_8", "{no json").otherwise(text).alias("value"))
    tables.write_keypoints(files, path)
    back = tables.read_keypoints(spark, path, r"([^/]+/[^/]+)/([^/]+)\.json$")
    of = F.split("camera_label", "/")
    return back.select(of[0].cast("long").alias("capture_id"), "tem", of[1].alias("camera_label"), "kp_idx", (F.round("u", 6) + 0.0).alias("u"), (F.round("v", 6) + 0.0).alias("v"), "score")


@query(  # combined files: a later frame of a camera and time replaces an earlier one; nameless frames and frames without an instance are skipped
    "prediction_files",
    "SELECT capture_id, tem, camera_label, CAST(place AS INT) AS kp_idx, round(u, 6) + 0e0 AS u, round(v, 6) + 0e0 AS v, score FROM kept WHERE place % 7 <> 2 AND camera_label NOT IN ('cam_7', 'cam_8') UNION ALL "
    "SELECT capture_id, tem, camera_label, CAST(place AS INT), round(u, 6) + 0e0, NULL, score FROM kept WHERE place % 7 = 2 AND camera_label NOT IN ('cam_7', 'cam_8')",
    obs=_OBS, kept=_KEPT,
)
def _(spark, d):
    path, label = _folder(spark), F.col("camera_label")
    rows = _instances(X.derive(spark, d, _OBS))
    given = F.struct("keypoints", "keypoint_scores")
    stale = F.struct(F.slice("keypoints", 1, 1).alias("keypoints"), F.slice("keypoint_scores", 1, 1).alias("keypoint_scores"))
    name = F.when(label != "cam_7", F.concat(label, F.lit(".jpg")))
    frame = lambda i: F.struct(name.alias("image_name"), F.col("tem").alias("frame_id"), i.alias("instances"))
    last = F.when(label == "cam_8", F.slice(F.array(given), 1, 0)).otherwise(F.array(given, stale))
    frames = rows.select("capture_id", label, "tem", F.array(frame(F.slice(F.array(stale), 1, F.when(label == "cam_8", 0).otherwise(1))), frame(last)).alias("f"))
    files = tables.by_capture(frames).groupBy("capture_id", "tem").agg(F.flatten(F.array_sort(F.collect_list(F.struct("camera_label", "f")))["f"]).alias("frames"))
    files.select("capture_id", "tem", F.to_json(F.struct("frames")).alias("value")).write.partitionBy("capture_id", "tem").text(path)
    rig = X.cameras(spark, d).select(F.lit(0).alias("capture_id"), "camera_label").distinct()
    back = tables.read_predictions(spark, f"{path}/*/*/*.txt", rig)
    capture = F.regexp_extract("path", "capture_id=([^/]+)/", 1).cast("long")
    return back.select(capture.alias("capture_id"), "tem", "camera_label", "kp_idx", (F.round("u", 6) + 0.0).alias("u"), (F.round("v", 6) + 0.0).alias("v"), "score")


@query("baseline_replaced", "SELECT o_orderpriority AS metric, max(o_totalprice) AS value FROM orders GROUP BY o_orderpriority")
def _(spark, d):
    path = _folder(spark)
    rows = _table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("metric"))
    tables.replace_baseline(rows.agg(F.min("o_totalprice").alias("value"), F.lit("old").alias("note")), path)
    tables.replace_baseline(rows.agg(F.max("o_totalprice").alias("value")), path)  # nothing of the first one is left
    return spark.read.json(path).select("metric", "value")


@query(
    "report_written",
    "SELECT l_linenumber AS view, count(*) AS n, round(avg(l_discount), 6) AS mean, CASE WHEN avg(l_discount) > 5e-2 THEN 'high' END AS note FROM lineitem GROUP BY l_linenumber",
)
def _(spark, d):
    path, mean = _folder(spark), F.avg("l_discount")
    report = _table(spark, d, "lineitem").groupBy(F.col("l_linenumber").alias("view")).agg(F.count(F.lit(1)).alias("n"), F.round(mean, 6).alias("mean"), F.when(mean > 0.05, "high").alias("note"))
    tables.write_report(report, path)
    return spark.read.schema("view int, n long, mean double, note string").json(path)


@query(
    "splats4d_read",
    "SELECT clip_id, splat_id, CAST(x AS FLOAT) AS x, CAST(scale_1 AS FLOAT) AS scale_1, CAST(rot_0 AS FLOAT) AS rot_l_0, CAST(rot_1 AS FLOAT) AS rot_r_0, CAST(ln(t_sigma) AS FLOAT) AS log_scale_t, CAST(f_dc_2 AS FLOAT) AS dc_2, CAST(f_dc_0 AS FLOAT) AS rest_00 FROM splats",
    splats=X.SPLATS,
)
def _(spark, d):
    path = _folder(spark)
    f = lambda c: (F.col(c) if isinstance(c, str) else c).cast("float")
    quat = lambda k: F.array(*(f(f"rot_{(i + k) % 4}") for i in range(4)))
    dc = F.array(*(f(f"f_dc_{c}") for c in range(3)))
    raw = X.splats(spark, d).select(
        "frame", "splat_id", "clip_id", *(f(c).alias(c) for c in ("opacity", "t_center", "z", "y", "x")),
        F.array(*(f(f"scale_{i}") for i in range(3))).alias("log_scale"), quat(0).alias("rot_l"), quat(1).alias("rot_r"), f(F.log("t_sigma")).alias("log_scale_t"), dc.alias("dc"), F.array(dc).alias("rest"),
    )
    raw.write.parquet(path)  # columns in another order, and one too many
    back = tables.read_splats4d(spark, path)
    at = lambda c, i, n: F.col(c)[i].alias(n)
    return back.select("clip_id", "splat_id", "x", at("log_scale", 1, "scale_1"), at("rot_l", 0, "rot_l_0"), at("rot_r", 0, "rot_r_0"), "log_scale_t", at("dc", 2, "dc_2"), F.col("rest")[0][0].alias("rest_00"))
