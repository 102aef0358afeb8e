"""JSON and Parquet tables of captures: rigs, keypoints, offsets, masks, planes and reports."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import camera_label, file_stem
from . import texts

_VIEW = "fl_x double, fl_y double, cx double, cy double, w int, h int, camera_model string, k1 double, k2 double, p1 double, p2 double"
RIG_SCHEMA = f"{_VIEW}, frames array<struct<file_path:string,camera_label:string,time:double,transform_matrix:array<array<double>>," + ",".join(
    p.strip().replace(" ", ":", 1) for p in _VIEW.split(",")
) + ">>"


def read_cameras(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """One row for each frame of each rig: shared intrinsics where a frame has none, label from the file name where it has none."""
    raw = spark.read.schema(RIG_SCHEMA).option("multiLine", True).json(paths).withColumn("path", F.col("_metadata.file_path"))
    top = [c.strip().split(" ")[0] for c in _VIEW.split(",")]
    rows = raw.select("path", *(F.col(c).alias(f"t_{c}") for c in top), F.posexplode("frames").alias("pos", "f"))
    dist = F.array(*(F.coalesce(F.coalesce(f"f.{c}", f"t_{c}"), F.lit(0.0)) for c in ("k1", "k2", "p1", "p2")))
    return rows.select(
        "path",
        "pos",
        F.coalesce("f.camera_label", camera_label(F.col("f.file_path"))).alias("camera_label"),
        "f.file_path",
        "f.time",
        *(F.coalesce(f"f.{c}", f"t_{c}").alias(c) for c in ("fl_x", "fl_y", "cx", "cy", "w", "h", "camera_model")),
        dist.alias("dist"),
        F.flatten("f.transform_matrix").alias("c2w"),
    )


def write_transforms(cameras: DataFrame, path: str) -> None:
    """Camera rows as one nested JSON file a capture, frames by label. A rig's cameras are tens."""
    row = lambda i: F.array(*(F.col("c2w")[4 * i + j] for j in range(4)))
    extra = [c for c in cameras.columns if c not in ("capture_id", "camera_label", "file_path", "c2w", "dist")]  # lens model, time and whatever else a frame carries
    lens = [F.get("dist", F.lit(i)).alias(k) for i, k in enumerate(("k1", "k2", "p1", "p2"))] if "dist" in cameras.columns else []
    frame = F.struct("camera_label", "file_path", *extra, *lens, F.array(*(row(i) for i in range(4))).alias("transform_matrix"))
    by_capture(cameras).groupBy("capture_id").agg(F.array_sort(F.collect_list(frame)).alias("frames")).write.mode("overwrite").partitionBy("capture_id").json(path)


def read_keypoints(spark: SparkSession, paths: list[str] | str, name_pattern: str = r"([^/]+)/([^/]+)\.json$") -> DataFrame:
    """Keypoints of ``<camera>/<tem>.json`` files: first instance, missing scores 1.0, broken files and entries skipped."""
    schema = "instance_info array<struct<keypoints:array<array<double>>,keypoint_scores:array<double>>>, broken string"
    raw = _objects(spark, [paths] if isinstance(paths, str) else paths, schema, "broken")
    first = F.get("instance_info", F.lit(0))
    named = [F.regexp_extract("path", name_pattern, group).alias(c) for group, c in ((2, "tem"), (1, "camera_label"))]  # once a file, not once a keypoint
    rows = raw.filter("broken is null and size(instance_info) > 0").select(*named, first.alias("i"))
    flat = rows.select("tem", "camera_label", F.posexplode("i.keypoints").alias("kp_idx", "k"), F.col("i.keypoint_scores").alias("s"))
    return flat.filter(F.size("k") >= 2).select(
        "tem", "camera_label", "kp_idx", F.col("k")[0].alias("u"), F.col("k")[1].alias("v"), F.coalesce(F.get("s", F.col("kp_idx")), F.lit(1.0)).alias("score")
    )


def _objects(spark: SparkSession, paths: list[str], schema: str, broken: str) -> DataFrame:
    """path and columns of ``schema`` of files of one JSON object, or one list of objects, each; text that is neither goes to ``broken``.

    Only patterns, and stores that Arrow does not know, are left to Spark's own reader, which lists every file in the driver.
    """
    if not all(map(texts.opens, paths)):
        raw = spark.read.schema(schema).option("multiLine", True).option("columnNameOfCorruptRecord", broken).json(paths)
        return raw.withColumn("path", F.col("_metadata.file_path"))
    value = F.col("value")
    listed = F.when(F.ltrim(value).startswith("["), F.from_json(value, "array<string>")).otherwise(F.array(value))
    # parsed inside the explode, behind which its fields are taken: as a column of its own, it would be parsed again for each of them
    parsed = F.transform(F.coalesce(listed, F.array(value)), lambda v: F.from_json(v, schema, {"columnNameOfCorruptRecord": broken}))
    return texts.read_texts(spark, paths).select("path", F.explode(parsed).alias("o")).select("path", "o.*")


def write_keypoints(files: DataFrame, path: str) -> None:
    """``value`` of each row as the file ``<capture>/<camera>/<tem>.json``, as ``read_keypoints`` finds it. Rows of a capture are written by one task."""
    for c in ("camera", "tem"):
        files = files.withColumn(c, F.when(F.col(c).contains("/"), F.raise_error(F.concat(F.lit(f"a slash in {c} "), c))).otherwise(F.col(c)))
    name = F.format_string("%s/%s/%s.json", F.col("capture_id").cast("string"), "camera", "tem")
    texts.write_texts(by_capture(files.select("capture_id", "value", name.alias("name"))), path)


def read_predictions(spark: SparkSession, paths: list[str] | str, cameras: DataFrame) -> DataFrame:
    """Keypoints of combined prediction files (``frames[]`` with image_name, frame_id and instances): first instance of each frame.

    Images are matched to camera labels; frames without a name, a match or an instance, and instances without
    keypoints or scores, are skipped. A later frame of the same camera and time takes the place of an earlier one.
    """
    from ..operators.cameras import match_camera

    instance = "struct<keypoints:array<array<double>>,keypoint_scores:array<double>>"
    raw = spark.read.schema(f"frames array<struct<image_name:string,frame_id:string,instances:array<{instance}>>>").option("multiLine", True).json(paths)
    frames = raw.select(F.col("_metadata.file_path").alias("path"), F.posexplode("frames").alias("pos", "f")).filter("f.image_name is not null")
    rows = frames.select("path", "pos", F.col("f.image_name").alias("image"), F.coalesce("f.frame_id", F.lit("000000")).alias("tem"), F.get("f.instances", F.lit(0)).alias("i"))
    named = rows.filter("i.keypoints is not null and i.keypoint_scores is not null").join(match_camera(rows, cameras).select("image", "camera_label"), "image")
    last = named.groupBy("path", "tem", "camera_label").agg(F.max_by("i", "pos").alias("i"))
    flat = last.select("path", "tem", "camera_label", F.posexplode(F.arrays_zip(F.col("i.keypoints").alias("k"), F.col("i.keypoint_scores").alias("s"))).alias("kp_idx", "p"))
    return flat.filter("p.k is not null and p.s is not null").select("path", "tem", "camera_label", "kp_idx", F.get("p.k", F.lit(0)).alias("u"), F.get("p.k", F.lit(1)).alias("v"), F.col("p.s").alias("score"))


OFFSET = "struct<fps:double,frame_offset:int,offset_seconds:double,match_quality:double,peak_ratio:double,low_confidence:boolean,solver:string,error:string>"


def read_offsets(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """The map of camera file to offset, with error stubs, as rows."""
    raw = spark.read.schema(f"offsets map<string,{OFFSET}>").option("multiLine", True).json(paths).withColumn("path", F.col("_metadata.file_path"))
    return raw.select("path", F.explode("offsets").alias("camera", "o")).select("path", "camera", "o.*")


def write_offsets(offsets: DataFrame, path: str) -> None:
    entry = F.struct("camera", F.struct("fps", "frame_offset", "offset_seconds", "match_quality", "peak_ratio", "low_confidence", "solver", "error"))
    offsets.groupBy("capture_id").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("offsets")).write.mode("overwrite").json(path)


def read_masks(spark: SparkSession, path: str, threshold: int = 127, alpha_threshold: int = 100) -> DataFrame:
    """Foreground runs (path, camera_label, y, x0, x1) of grey, colour (first channel) or alpha (above 100) images."""

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                image = np.frombuffer(r.data, np.uint8).reshape(r.height, r.width, r.nChannels)
                # the decoder keeps blue first, so the first channel of a colour image is its third
                fg = image[:, :, 3] > alpha_threshold if r.nChannels == 4 else image[:, :, min(2, r.nChannels - 1)] > threshold
                edges = np.diff(np.pad(fg.astype(np.int8), ((0, 0), (1, 1))), axis=1)
                y, x0 = np.nonzero(edges == 1)
                x1 = np.nonzero(edges == -1)[1] - 1
                out.append(pd.DataFrame({"path": r.origin, "y": y, "x0": x0, "x1": x1}))
            yield pd.concat(out) if out else pd.DataFrame({"path": [], "y": [], "x0": [], "x1": []})

    images = spark.read.format("image").option("dropInvalid", True).load(path).select("image.*")
    return images.mapInPandas(runs, "path string, y int, x0 int, x1 int").withColumn("camera_label", file_stem(F.col("path")))


REQUIRED = ("x", "y", "z", *(f"rot_{i}" for i in range(4)), *(f"scale_{i}" for i in range(3)), "opacity", *(f"f_dc_{i}" for i in range(3)), "vx", "vy", "vz", "t_center", "t_sigma")


#: Rows of a group that lie in one file at most.
STRETCH = 262_144


def _by_group(ordered: DataFrame, path: str) -> None:
    """Rows by clip and group, so that a time query reads its groups alone; a large group is cut along its order.

    Stretches are dealt by number, not by ranges: those would be sampled, and all that made the rows would run twice.
    """
    stretch = F.floor(F.col("file_idx") / STRETCH)
    dealt = ordered.repartition("clip_id", "grp", stretch).sortWithinPartitions("clip_id", "grp", "file_idx")
    dealt.write.mode("overwrite").partitionBy("clip_id", "grp").parquet(path)


def write_splats(ordered: DataFrame, path: str) -> None:
    """Ordered splats in canonical columns. A set that lacks a required one, or has only a part of the acceleration, fails."""
    missing = [c for c in REQUIRED if c not in ordered.columns]
    accel = [c for c in ("ax", "ay", "az") if c in ordered.columns]
    if missing or len(accel) in (1, 2):
        raise ValueError(f"splats lack {', '.join(missing or ['a part of the acceleration'])}")
    rest = ["f_rest"] if "f_rest" in ordered.columns else []
    _by_group(ordered.select("clip_id", "grp", "file_idx", "splat_id", *(F.col(c).cast("float").alias(c) for c in (*REQUIRED, *accel)), *rest), path)


CLIP_SCALARS = ("time_min", "time_max", "fps", "motion_degree", "cov2d_kx", "cov2d_ky", "splat_count", "generator")


def write_clips(clips: DataFrame, path: str) -> None:
    """The scalars of each clip as one JSON object a line; those that a clip does not have are left out."""
    clips.select("clip_id", *(c for c in CLIP_SCALARS if c in clips.columns)).write.mode("overwrite").json(path)


def write_hull_points(points: DataFrame, path: str) -> None:
    """Hull points with colour and time, by capture: one file each."""
    floats = [F.col(c).cast("float").alias(c) for c in ("x", "y", "z", "time")]
    shades = [F.col(c).cast("short").alias(c) for c in ("r", "g", "b")]
    by_capture(points).select("capture_id", F.col("frame_idx").cast("int").alias("frame_idx"), *floats, *shades).write.mode("overwrite").partitionBy("capture_id").parquet(path)


SPLATS4D = "clip_id long, splat_id long, x float, y float, z float, log_scale array<float>, rot_l array<float>, rot_r array<float>, log_scale_t float, t_center float, opacity float, dc array<float>, rest array<array<float>>"


def read_splats4d(spark: SparkSession, path: str) -> DataFrame:
    """Raw 4D model rows of a Parquet table, in their fixed schema."""
    return spark.read.schema(SPLATS4D).parquet(path)


def write_quantized(packed: dict[str, DataFrame], path: str) -> None:
    """Planes by clip and group; ranges, codebooks, segments, clips and palettes of harmonics beside them."""
    _by_group(packed["planes"], f"{path}/planes")
    for name in ("ranges", "codebooks", "segments", "clips", "palette"):
        if packed.get(name) is not None:
            packed[name].write.mode("overwrite").parquet(f"{path}/{name}")


def read_quantized(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    out = {name: spark.read.parquet(f"{path}/{name}") for name in ("planes", "ranges", "codebooks", "segments", "clips")}
    if not out["codebooks"].filter("attr = 'sh'").isEmpty():
        out["palette"] = spark.read.parquet(f"{path}/palette")
    return out


def by_capture(df: DataFrame) -> DataFrame:
    """Rows dealt by capture over a stated number of tasks: each folder is written by one of them, and small tables are not left to a few."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "capture_id")


def write_sfm_text(cameras: DataFrame, points: DataFrame, path: str) -> None:
    """Camera, image and point lines as text, a file a capture; numbers run over the labels of a capture."""
    w = Window.partitionBy("capture_id").orderBy("camera_label")  # a rig's cameras
    rows = by_capture(cameras).withColumn("n", F.row_number().over(w))
    line = lambda *c: F.concat_ws(" ", *(x if isinstance(x, F.Column) else F.col(x).cast("string") for x in c)).alias("value")

    def write(lines: DataFrame, part: str) -> None:
        capture = F.coalesce(F.col("capture_id").cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))  # as Spark's readers take it
        name = F.concat(F.lit("capture_id="), capture, F.lit(f"/{part}.txt")).alias("name")
        texts.write_texts(lines.select(name, "value"), f"{path}/{part}", "\n", replace=True)

    write(rows.select("capture_id", line("n", F.lit("PINHOLE"), "w", "h", "fl_x", "fl_y", "cx", "cy")), "cameras")
    write(rows.select("capture_id", line("n", "qw", "qx", "qy", "qz", "tx", "ty", "tz", "n", "camera_label")), "images")
    grey = F.lit("128 128 128 1.0")
    write(by_capture(points).select("capture_id", line("point_id", "x", "y", "z", grey)).sortWithinPartitions("capture_id"), "points3D")


def read_sfm_lines(spark: SparkSession, path: str) -> DataFrame:
    """capture_id and each line (``value``) of one part of ``write_sfm_text``; files are listed by tasks, and one is held at once."""
    rows = texts.read_texts(spark, [path]).select(F.regexp_extract("path", r"capture_id=([^/]*)/[^/]*$", 1).alias("capture_id"), F.explode(F.split("value", "\n")).alias("value"))
    return rows.filter("value <> ''")


def append_history(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("append").json(path)


def replace_baseline(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("overwrite").json(path)


def write_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
