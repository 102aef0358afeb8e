"""Training sets: held frames, hulls, colours and masks of pixels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.geometry import truncated_pixel
from .cameras import LOOKED_UP, _masked_rig, mask_counts, packed_rig, project_points, votes_in_place
from .scratch import cut, small


def drop_held_frames(frames: DataFrame) -> DataFrame:
    """Frames whose hash differs from the frame before, by capture and camera; survivors keep their number."""
    w = Window.partitionBy("capture_id", "camera_label").orderBy("frame_idx")
    before = F.lag("hash").over(w)
    return frames.withColumn("__before", before).filter(F.col("__before").isNull() | (F.col("__before") != F.col("hash"))).drop("__before")


def search_box(cameras: DataFrame, otherwise: float = 4.0) -> DataFrame:
    """Box around the mean camera centre of a capture: as far to each side as its centres spread along their widest axis, or ``otherwise`` where all stand in one place."""
    centre = {a: F.col("c2w")[4 * i + 3] for i, a in enumerate("xyz")}
    box = cameras.groupBy("capture_id").agg(*(f(centre[a]).alias(f"{n}_{a}") for a in "xyz" for n, f in (("mid", F.avg), ("lo", F.min), ("hi", F.max))))
    widest = F.greatest(*(F.col(f"hi_{a}") - F.col(f"lo_{a}") for a in "xyz"))
    span = F.when(widest > 0, widest).otherwise(F.lit(float(otherwise)))
    return box.select("capture_id", *((F.col(f"mid_{a}") + s * span).alias(f"{n}_{a}") for a in "xyz" for n, s in (("min", -1.0), ("max", 1.0))))


def hull_bbox(points: DataFrame, least: int = 100) -> DataFrame:
    """Box of the kept candidates padded by 15 % and 0.05; too few are an ``error``."""
    box = points.groupBy("capture_id").agg(F.count(F.lit(1)).alias("n"), *(f(a).alias(f"{n}_{a}") for a in "xyz" for n, f in (("lo", F.min), ("hi", F.max))))
    return _padded(box, least)


def _padded(box: DataFrame, least: int = 100) -> DataFrame:
    """``hull_bbox`` of capture_id, n and lo_x .. hi_z."""
    pad = {a: (F.col(f"hi_{a}") - F.col(f"lo_{a}")) * 0.15 + 0.05 for a in "xyz"}
    sides = [(F.col(f"{src}_{a}") + s * pad[a]).alias(f"{n}_{a}") for a in "xyz" for n, src, s in (("min", "lo", -1.0), ("max", "hi", 1.0))]
    return box.select("capture_id", "n", *sides, F.when(F.col("n") < least, "too few points").alias("error"))


#: Numbers below one are whole multiples of 1 / UNIT, so that their products with table values stay exact.
UNIT = 1 << 31
#: Steps of an evenly spread sequence in three dimensions: powers of the inverse of the root of g^4 = g + 1.
STEPS = tuple(round(UNIT / 1.2207440846057596**k) for k in (1, 2, 3))


def spread(axis: int, *columns: str) -> Column:
    """The coordinate (in [0, 1)) of a point of an evenly spread sequence; its first column is the point's number, each other one moves the whole sequence.

    It depends on nothing but its arguments, so that a lost task repeats it, and fills a box with smaller gaps than independent draws.
    """
    moved = [F.pmod(F.pmod(F.col(c).cast("long"), F.lit(UNIT)) * F.lit(STEPS[(axis + i) % 3]), F.lit(UNIT)) for i, c in enumerate(columns)]
    return F.pmod(sum(moved[1:], moved[0]), F.lit(UNIT)) / float(UNIT)


def candidates(boxes: DataFrame, frames: DataFrame, first: int, upto: int) -> DataFrame:
    """The columns of ``frames`` and point_id, x, y, z: points ``first`` to ``upto`` - 1 of a sequence in the box of each capture, for each of its frames."""
    rows = frames.join(boxes.select("capture_id", *(f"{n}_{a}" for a in "xyz" for n in ("min", "max"))), "capture_id")
    rows = rows.withColumn("point_id", F.explode(F.sequence(F.lit(first), F.lit(upto - 1))))
    at = {a: F.col(f"min_{a}") + spread(i, "point_id", "frame_idx", "capture_id") * (F.col(f"max_{a}") - F.col(f"min_{a}")) for i, a in enumerate("xyz")}
    return rows.select(*frames.columns, "point_id", *(e.alias(a) for a, e in at.items()))


#: Candidates that a task tries, whose votes it holds.
CANDIDATES = 1 << 20
#: Candidates of a frame that are tried at once.
TRIED = 1 << 16


def _tasks(frames: DataFrame, each: int) -> int:
    """Tasks of some ``CANDIDATES`` if each frame tries ``each``."""
    return max(-(-frames.count() * each // CANDIDATES), frames.sparkSession.sparkContext.defaultParallelism)


def carve_hull(boxes: DataFrame, cameras: DataFrame, runs: DataFrame, n: int, min_views: int, batches: int = 8) -> DataFrame:
    """The first ``n`` candidates of each frame that ``min_views`` masks hold, of at most ``batches`` times 4n.

    ``boxes`` has one row a capture (min_x .. max_z), ``runs`` also frame_idx; a frame's candidates meet its own
    masks only, which are packed once. A batch of 4n candidates is tried for all frames of all captures at once, the
    next one only for frames that are still short; how many they are is all that comes to the driver. Frames whose
    masks hold nothing end without points. Candidates are made beside the masks of their frame and judged there, so
    that only those that are kept are ever written.
    """
    keys = ["capture_id", "frame_idx"]
    boxes = small(boxes.select("capture_id", *(f"{n}_{a}" for a in "xyz" for n in ("min", "max"))), 7)
    own = runs.join(boxes, "capture_id", "left_semi")
    rig = packed_rig(cameras, own, "frame_idx", tasks=_tasks(own.select(*keys).distinct(), 4 * n))
    short = rig.select(*keys).withColumn("have", F.lit(0).cast("long"))
    in_order = Window.partitionBy(*keys).orderBy("point_id")  # a batch of one frame
    points = None
    for batch in range(batches):
        tried = candidates(boxes, rig.join(short.hint("shuffle_hash"), keys), batch * 4 * n, (batch + 1) * 4 * n)
        kept = votes_in_place(tried, [*keys, "have", "point_id"], min_views)
        taken = cut(kept.withColumn("k", F.col("have") + F.row_number().over(in_order)).filter(F.col("k") <= n).select(*keys, "point_id", "x", "y", "z", "votes"))
        points = taken if points is None else points.unionByName(taken)
        more = taken.groupBy(*keys).agg(F.count(F.lit(1)).alias("more"))
        short = short.join(more, keys, "left").select(*keys, (F.col("have") + F.coalesce("more", F.lit(0))).alias("have"))
        short = cut(short.filter(F.col("have") < n))
        if not short.count():
            break
    return points


def carve_in_place(boxes: DataFrame, cameras: DataFrame, runs: DataFrame, n: int, min_views: int, batches: int = 8) -> DataFrame:
    """The rows of ``carve_hull``, whose candidates are tried where the packed masks lie until the frame has its points or all are tried.

    Masks are not written and no round goes through the driver, so captures may be many; a frame is carved by one task.
    """
    keys = ["capture_id", "frame_idx"]
    boxes = small(boxes.select("capture_id", *(f"{n}_{a}" for a in "xyz" for n in ("min", "max"))), 7)
    own = runs.join(boxes, "capture_id", "left_semi")
    rig = _masked_rig(cameras, own, "frame_idx", tasks=_tasks(own.select(*keys).distinct(), 4 * n))
    return cut(_carved(rig.join(boxes, "capture_id"), n, min_views, batches * 4 * n))


def _carved(rows: DataFrame, n: int, min_views: int, most: int, min_depth: float = 0.05) -> DataFrame:
    """capture_id, frame_idx, point_id, x, y, z and votes of the first ``n`` of ``most`` candidates of a frame (with box and ``cams``) that ``min_views`` masks hold."""

    def carve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r, (capture, frame) in enumerate(zip(batch.column("capture_id").to_pylist(), batch.column("frame_idx").to_pylist(), strict=True)):
                least, upto = _box(batch, r)
                if None in (*least, *upto):
                    continue
                cams, have = batch.column("cams")[r].values, 0
                for first in range(0, most, step):
                    number = np.arange(first, min(first + step, most), dtype=np.int64)
                    at = _places(number, frame, capture, least, upto)
                    tested, votes = mask_counts(*at, cams, min_depth, min_views)
                    good = np.flatnonzero((tested > 0) & (votes >= min_views))[: n - have]
                    if len(good):
                        heads = [pa.array([v] * len(good), batch.schema.field(c).type) for c, v in (("capture_id", capture), ("frame_idx", frame))]
                        columns = [*heads, pa.array(number[good].astype(np.int32)), *(pa.array(a[good]) for a in at), pa.array(votes[good].astype(np.int64))]
                        yield pa.RecordBatch.from_arrays(columns, names=["capture_id", "frame_idx", "point_id", *"xyz", "votes"])
                    have += len(good)
                    if have >= n:
                        break

    types, step = dict(rows.dtypes), min(max(4 * n, LOOKED_UP), TRIED)
    given = rows.select("capture_id", "frame_idx", "cams", *(F.col(f"{side}_{a}").cast("double") for a in "xyz" for side in ("min", "max")))
    return given.mapInArrow(carve, f"capture_id {types['capture_id']}, frame_idx {types['frame_idx']}, point_id int, x double, y double, z double, votes long")


def _box(batch: pa.RecordBatch, r: int) -> tuple[list, list]:
    """Least and greatest x, y and z of the box in row ``r``."""
    return tuple([batch.column(f"{side}_{a}")[r].as_py() for a in "xyz"] for side in ("min", "max"))


def _places(number: np.ndarray, frame: int, capture: int, least: list[float], most: list[float]) -> list[np.ndarray]:
    """x, y and z of the candidates of these numbers, in the arithmetic of ``candidates``."""
    at = []
    for i in range(3):
        moved = (number % UNIT * STEPS[i] % UNIT + frame % UNIT * STEPS[(i + 1) % 3] % UNIT + capture % UNIT * STEPS[(i + 2) % 3] % UNIT) % UNIT
        at.append(least[i] + moved / float(UNIT) * (most[i] - least[i]))
    return at


def find_bbox(cameras: DataFrame, runs: DataFrame, min_views: int, n: int = 500_000) -> DataFrame:
    """The padded box of the hull of each capture's middle frame, found among ``n`` candidates in the search box around its cameras, which are made beside the frame's masks."""
    frames = runs.select("capture_id", "frame_idx").distinct().groupBy("capture_id").agg(F.sort_array(F.collect_set("frame_idx")).alias("all"))
    middle = cut(frames.select("capture_id", F.get("all", F.floor(F.size("all") / 2).cast("int")).alias("frame_idx")))
    own = runs.join(middle, ["capture_id", "frame_idx"], "left_semi")
    rig = _masked_rig(cameras, own, "frame_idx", tasks=_tasks(middle, n))
    return _padded(_found(rig.join(small(search_box(cameras), 7), "capture_id"), min_views, n))


def _found(rows: DataFrame, min_views: int, n: int, min_depth: float = 0.05) -> DataFrame:
    """capture_id, n and lo_x .. hi_z of those of the first ``n`` candidates of a frame (with box and ``cams``) that ``min_views`` masks hold.

    A frame's candidates are made, judged and summed up ``TRIED`` at a time, in the arithmetic of ``candidates`` and ``hull_votes``.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r, (capture, frame) in enumerate(zip(batch.column("capture_id").to_pylist(), batch.column("frame_idx").to_pylist(), strict=True)):
                least, most = _box(batch, r)
                if None in least or None in most:
                    continue
                cams, held = batch.column("cams")[r].values, []
                for first in range(0, n, TRIED):
                    number = np.arange(first, min(first + TRIED, n), dtype=np.int64)
                    at = _places(number, frame, capture, least, most)
                    tested, votes = mask_counts(*at, cams, min_depth, min_views)
                    good = (tested > 0) & (votes >= min_views)
                    if good.any():
                        held.append((good.sum(), *(f(a[good]) for a in at for f in (np.min, np.max))))
                if held:
                    every = np.array(held)
                    sides = (f(every[:, 1 + 2 * i + j]) for i in range(3) for j, f in enumerate((np.min, np.max)))
                    out.append((capture, int(every[:, 0].sum()), *map(float, sides)))
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row, strict=True)) for row in out], schema)

    schema = pa.schema([("capture_id", pa.int64()), ("n", pa.int64()), *((f"{side}_{a}", pa.float64()) for a in "xyz" for side in ("lo", "hi"))])
    given = rows.select(F.col("capture_id").cast("long"), F.col("frame_idx").cast("long"), "cams", *(F.col(f"{side}_{a}").cast("double") for a in "xyz" for side in ("min", "max")))
    return given.mapInArrow(search, "capture_id long, n long, " + ", ".join(f"{side}_{a} double" for a in "xyz" for side in ("lo", "hi")))


def colour_cameras(cameras: DataFrame, most: int = 4) -> DataFrame:
    """Up to ``most`` cameras of each capture, spread over its labels in name order."""
    w = Window.partitionBy("capture_id")  # a rig's cameras
    placed = cameras.withColumn("__k", F.row_number().over(w.orderBy("camera_label")) - 1).withColumn("__n", F.count(F.lit(1)).over(w))
    step = F.greatest(F.floor(F.col("__n") / most), F.lit(1))
    return placed.filter((F.col("__k") % step == 0) & (F.col("__k") < most * step)).drop("__k", "__n")


def hull_colour(points: DataFrame, cameras: DataFrame, pixels: DataFrame, by: tuple[str, ...] = ("frame_idx",), min_depth: float = 0.05) -> DataFrame:
    """r, g, b of each point: the mean over the spread cameras that see it on their mask; 127 where none does.

    ``pixels``: capture_id, camera_label, ``by``, x, y, fg, r, g, b.
    """
    keys = ["capture_id", *by, "point_id"]
    seen = project_points(points.select(*keys, "x", "y", "z"), colour_cameras(cameras), min_depth).filter("u >= 0 and v >= 0")
    at = seen.select(*keys, "camera_label", truncated_pixel(F.col("u")).alias("px"), truncated_pixel(F.col("v")).alias("py"))
    shown = pixels.filter("fg").select("capture_id", *by, "camera_label", F.col("x").alias("px"), F.col("y").alias("py"), "r", "g", "b")
    mean = at.join(shown, ["capture_id", *by, "camera_label", "px", "py"]).groupBy(*keys).agg(*(F.avg(c).alias(c) for c in "rgb"))
    return points.join(mean, keys, "left").withColumns({c: F.coalesce(F.col(c), F.lit(127.0)).cast("int") for c in "rgb"})


def mask_to_alpha(pixels: DataFrame) -> DataFrame:
    """Colour black off the mask, alpha 255 on it."""
    on = lambda c: F.when(F.col("fg"), F.col(c)).otherwise(0).alias(c)
    return pixels.select(*(c for c in pixels.columns if c not in ("r", "g", "b")), on("r"), on("g"), on("b"), F.when(F.col("fg"), 255).otherwise(0).alias("a"))


def composite_black(pixels: DataFrame) -> DataFrame:
    return pixels.withColumns({c: F.floor(F.col(c) * F.col("a") / 255).cast("int") for c in ("r", "g", "b")})


def mask_union(mask: DataFrame, patch: DataFrame, keys: list[str]) -> DataFrame:
    """Foreground of either, on the pixels of both."""
    columns = [*keys, "x", "y", "fg"]
    return mask.select(*columns).unionByName(patch.select(*columns)).groupBy(*keys, "x", "y").agg(F.max("fg").alias("fg"))


def crop_box(keypoints: DataFrame, margin: float) -> DataFrame:
    """Box of the keypoints of a capture's camera, wider by ``margin`` of its own width and height to each side, clipped into the image, whole pixels. Needs w and h."""
    box = keypoints.groupBy("capture_id", "camera_label").agg(
        F.min("u").alias("u0"), F.max("u").alias("u1"), F.min("v").alias("v0"), F.max("v").alias("v1"), F.max("w").cast("double").alias("w"), F.max("h").cast("double").alias("h")
    )
    mu, mv = (F.col("u1") - F.col("u0")) * margin, (F.col("v1") - F.col("v0")) * margin
    low = lambda c, m: F.greatest(F.col(c) - m, F.lit(0.0)).cast("int")
    high = lambda c, m, size: F.least(F.col(c) + m, F.col(size)).cast("int")
    return box.select("capture_id", "camera_label", low("u0", mu).alias("x0"), low("v0", mv).alias("y0"), high("u1", mu, "w").alias("x1"), high("v1", mv, "h").alias("y1"))


def merge_instants(parts: dict[str, DataFrame]) -> DataFrame:
    """Keypoints of several instants as one table, the instant's name as ``tem``."""
    out = None
    for name, df in parts.items():
        own = df.withColumn("tem", F.lit(name))
        out = own if out is None else out.unionByName(own)
    return out


def filter_points(points: DataFrame, max_error: float = 2.0, min_track: int = 3) -> DataFrame:
    return points.filter((F.col("error") <= max_error) & (F.col("track_length") >= min_track))
