"""Cameras, keypoints and mask votes."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.geometry import alpha_at, determinant3, project, rounded_pixel, sigmoid, truncated_pixel, with_world_to_camera
from ..functions.text import camera_label, file_stem, trailing_id
from . import scratch
from .quantiles import shares_of_many
from .scratch import cut, kept, small

RIG = ("fl_x", "fl_y", "cx", "cy", "w", "h", *(f"r{i}{j}" for i in range(3) for j in range(3)), "tx", "ty", "tz")


RIG_GIVEN = ("fl_x", "fl_y", "cx", "cy", "w", "h", "c2w")


def _rig(cameras: DataFrame, *keys: str) -> DataFrame:
    """The columns that projection needs, one short row a camera."""
    return with_world_to_camera(cameras).select(*keys, *RIG)


def _parts(whole: DataFrame, name: str, parts: DataFrame, part: str) -> DataFrame:
    """(image, camera_label) where ``name`` holds ``part``: an equi-join on the pieces of ``name`` that are as long as any ``part``."""
    lengths = parts.agg(F.collect_set(F.length(part)).alias("lengths"))  # one row, with no more lengths than the longest name
    sized = whole.crossJoin(F.broadcast(lengths)).withColumn("size", F.explode("lengths")).filter(F.col("size") <= F.length(name))
    at = F.explode(F.sequence(F.lit(1), F.length(name) - F.col("size") + 1))
    pieces = sized.select(*whole.columns, "size", at.alias("at")).select(*whole.columns, F.substring(F.col(name), F.col("at"), F.col("size")).alias("piece")).distinct()
    return pieces.join(parts, pieces["piece"] == parts[part]).select("image", "camera_label")


def match_camera(images: DataFrame, cameras: DataFrame) -> DataFrame:
    """image, camera_label and the rule that matched: the exact stem, else a unique trailing number,
    else the longest label that holds or is held by the stem, the first in name order at ties.

    All three are equi-joins; what the first two leave is cut into pieces of the lengths that labels have, and labels into pieces of its lengths.
    """
    images = images.select("image").distinct().withColumn("stem", file_stem(F.col("image")))
    cams = cameras.select("camera_label").distinct()
    exact = images.join(cams, images["stem"] == cams["camera_label"]).select("image", "camera_label", F.lit("exact").alias("rule"))
    rest = images.join(exact.select("image"), "image", "left_anti")
    numbered = cams.withColumn("number", trailing_id(F.col("camera_label"))).filter("number is not null")
    single = numbered.groupBy("number").agg(F.min("camera_label").alias("camera_label"), F.count(F.lit(1)).alias("n")).filter("n = 1")
    by_number = (
        rest.withColumn("number", trailing_id(F.col("stem"))).join(single, "number").select("image", "camera_label", F.lit("number").alias("rule"))
    )
    rest = rest.join(by_number.select("image"), "image", "left_anti")
    held = _parts(rest, "stem", cams, "camera_label").unionByName(_parts(cams, "camera_label", rest, "stem"))
    most = held.groupBy("image").agg(F.max(F.length("camera_label")).alias("most"))
    partial = (
        held.join(most, "image")
        .filter(F.length("camera_label") == F.col("most"))
        .groupBy("image")
        .agg(F.min("camera_label").alias("camera_label"))
        .select("image", "camera_label", F.lit("part").alias("rule"))
    )
    return exact.unionByName(by_number).unionByName(partial)


#: Cameras that a task meets where rigs are too many to be broadcast.
CAMERAS = 20_000


def _with_rig(rows: DataFrame, cameras: DataFrame) -> DataFrame:
    """Rows by capture with each camera of their capture. Rigs beyond the bound of a broadcast are dealt by capture over a number
    of tasks that grows with the cameras: short rows that compress well would else be put together into a few large tasks."""
    rig = cut(_rig(cameras, "capture_id", "camera_label"))
    n = rig.count()
    if n * (len(RIG) + 2) <= scratch.MOST_NUMBERS:
        return rows.join(F.broadcast(rig), "capture_id")
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // CAMERAS))
    return rows.repartition(tasks, "capture_id").join(rig.repartition(tasks, "capture_id"), "capture_id")


def project_points(points: DataFrame, cameras: DataFrame, min_depth: float = 1e-6) -> DataFrame:
    """Each point seen from each camera of its capture: u, v, depth; behind the camera u and v are null."""
    u, v, depth = project(F.col("x"), F.col("y"), F.col("z"), min_depth)
    return _with_rig(points, cameras).select(*points.columns, "camera_label", u.alias("u"), v.alias("v"), depth.alias("depth"))


#: Pixels of masks that a task holds unpacked at once; one larger mask is packed alone.
PACKED_PIXELS = 1 << 19


def first_of_group(runs: pa.Table, keys: list[str]) -> np.ndarray:
    """The first row of each group in rows sorted by ``keys``."""
    new = np.zeros(runs.num_rows, bool)
    new[:1] = True
    for k in keys:
        column = runs.column(k).combine_chunks()
        new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def _packed(runs: pa.Table, first: np.ndarray, keys: list[str]) -> pa.RecordBatch:
    """keys and ``words`` of masks whose runs begin at the rows ``first``."""
    y, x0, x1, height, width = (runs.column(c).to_numpy().astype(np.int64) for c in ("y", "x0", "x1", "h", "w"))
    x0, x1 = np.maximum(x0, 0), np.minimum(x1, width - 1)
    line = -(-width // 64)
    number = (height * line)[first]
    of = np.repeat(np.arange(len(first)), np.diff(first, append=len(y)))
    start = 64 * ((np.cumsum(number) - number)[of] + y * line)
    good = (y >= 0) & (y < height) & (x0 <= x1)
    edge = np.zeros(64 * number.sum() + 1, np.int32)
    np.add.at(edge, (start + x0)[good], 1)
    np.add.at(edge, (start + x1 + 1)[good], -1)
    bits = np.packbits(np.cumsum(edge[:-1], dtype=np.int32) > 0, bitorder="little").view("<i8")
    words = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(number))), pa.int32()), pa.array(bits))
    heads = runs.select(keys).take(pa.array(first))
    return pa.RecordBatch.from_arrays([*(heads.column(k).combine_chunks() for k in keys), words], names=[*keys, "words"])


#: Runs that are unfolded at once.
UNFOLDED_RUNS = 1 << 20


def gathered_runs(runs: DataFrame, keys: list[str]) -> DataFrame:
    """keys, ``n`` and ``runs``: the runs of a mask that lie in one batch as one row, as differences of y, x0 and x1 in one, two or four bytes each, deflated.

    Wherever masks lie together in their table, a mask moves as one short row instead of one row a run.
    """

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            mask = np.zeros(batch.num_rows, np.int64)
            for k in keys:  # masks by number: sorting rows by keys that are names takes longer than all else
                own = pc.dictionary_encode(batch.column(k), null_encoding="encode")
                mask = np.unique(mask * len(own.dictionary) + own.indices.to_numpy(), return_inverse=True)[1]
            order = np.argsort(mask, kind="stable")
            first = np.flatnonzero(np.diff(mask[order], prepend=-1))
            ends = np.column_stack([batch.column(c).to_numpy() for c in ("y", "x0", "x1")])[order].astype(np.int64)
            number = np.diff(first, append=batch.num_rows)
            step = np.diff(ends, axis=0, prepend=0)
            step[first] = ends[first]
            most = np.abs(step).max()
            data = step.astype("<i1" if most < 1 << 7 else "<i2" if most < 1 << 15 else "<i4")
            parts = pa.array([zlib.compress(data[a : a + n].tobytes(), 1) for a, n in zip(first, number, strict=True)], pa.binary())
            heads = [batch.column(k).take(pa.array(order[first])) for k in keys]
            yield pa.RecordBatch.from_arrays([*heads, pa.array(number.astype(np.int32)), parts], names=[*keys, "n", "runs"])

    types = dict(runs.dtypes)
    whole = F.col("y").isNotNull() & F.col("x0").isNotNull() & F.col("x1").isNotNull()  # a run without an end has no pixel
    ends = {c: F.when(whole, F.col(c)).otherwise(-1) for c in ("y", "x0", "x1")}
    known = runs.dropna(subset=["capture_id", "camera_label"]).select(*keys, *(c.cast("int").alias(n) for n, c in ends.items()))
    return known.mapInArrow(gather, ", ".join(f"`{c}` {types[c]}" for c in keys) + ", n int, runs binary")


def _unfolded(table: pa.Table, heads: list[str]) -> Iterator[pa.Table]:
    """One row a run again, of at most ``UNFOLDED_RUNS`` or one gathered row at once."""
    upto, at = np.cumsum(table.column("n").to_numpy().astype(np.int64)), 0
    while at < table.num_rows:
        stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + UNFOLDED_RUNS, "right")))
        part = table.slice(at, stop - at)
        number = part.column("n").to_numpy().astype(np.int64)
        given = [zlib.decompress(b) for b in part.column("runs").to_pylist()]
        size = np.array([len(b) for b in given]) // (3 * number)  # bytes a number
        first, of = np.cumsum(number) - number, np.repeat(np.arange(len(number)), number)
        step = np.empty((len(of), 3), np.int64)
        for width in np.unique(size):
            own = size == width
            step[own[of]] = np.frombuffer(b"".join(b for b, o in zip(given, own, strict=True) if o), f"<i{width}").reshape(-1, 3)
        total = np.cumsum(step, axis=0)
        ends = (total - (total[first] - step[first])[of]).astype(np.int32)
        rows = part.select(heads).take(pa.array(of))
        for name, values in zip(("y", "x0", "x1"), ends.T, strict=True):
            rows = rows.append_column(name, pa.array(np.ascontiguousarray(values)))
        yield rows
        at = stop


def _blocks(gathered: Iterator[pa.Table], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """keys and ``words`` of masks, from their gathered runs in the order of ``keys`` (with w and h), some ``PACKED_PIXELS`` at once."""

    def blocks(runs: pa.Table, first: np.ndarray) -> Iterator[pa.RecordBatch]:
        size = (runs.column("h").to_numpy().astype(np.int64) * runs.column("w").to_numpy())[first]
        at = 0
        while at < len(first):
            stop = at + max(1, int(np.searchsorted(np.cumsum(size[at:]), PACKED_PIXELS, "right")))
            end = first[stop] if stop < len(first) else runs.num_rows
            yield _packed(runs.slice(first[at], end - first[at]), first[at:stop] - first[at], keys)
            at = stop

    rest = None
    for table in gathered:
        for runs in _unfolded(table, [*keys, "w", "h"]):
            runs = runs if rest is None else pa.concat_tables([rest, runs])
            first = first_of_group(runs, keys)
            yield from blocks(runs.slice(0, first[-1]), first[:-1])
            rest = runs.slice(first[-1])
    if rest is not None:
        yield from blocks(rest, np.zeros(1, np.int64))


def bit_masks(cameras: DataFrame, runs: DataFrame, *extra: str) -> DataFrame:
    """capture_id, camera_label (and ``extra``, such as frame_idx) and ``words`` of each mask, of cameras that have one.

    64 pixels a word, lowest bit first, lines filled up to whole words. Runs are dealt and sorted by mask
    and packed as they stream by; a task holds one mask's runs and ``PACKED_PIXELS`` pixels.
    """
    keys = ["capture_id", "camera_label", *extra]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _blocks((pa.Table.from_batches([batch]) for batch in batches if batch.num_rows), keys)

    # runs move once, gathered: dealt by camera, merged with its size there (never broadcast, which would leave them undealt), and sorted by mask
    camera = ["capture_id", "camera_label"]
    sizes = cameras.select(*camera, "w", "h").hint("merge")
    types = dict(runs.dtypes)
    dealt = gathered_runs(runs, keys).repartition(*camera).join(sizes, camera).select(*keys, "n", "runs", "w", "h").sortWithinPartitions(*keys)
    return dealt.mapInArrow(pack, ", ".join(f"{c} {types[c]}" for c in keys) + ", words array<bigint>")


def _masked_rig(cameras: DataFrame, runs: DataFrame, *extra: str, tasks: int | None = None) -> DataFrame:
    """``cams``: the cameras of a capture (and frame, with ``extra``) that have a mask, with its bits.

    One row a capture, so a splat meets one row. Its cameras are unfolded, and bits looked up, inside the
    stage that joins: a row of the join only points at them, and no pixel of a splat is ever shuffled.
    """
    keys = ["capture_id", "camera_label"]
    masked = _rig(cameras.select(*keys, *RIG_GIVEN), *keys).join(bit_masks(cameras, runs, *extra), keys)
    masked = masked if tasks is None else masked.repartition(tasks, "capture_id", *extra)
    return masked.groupBy("capture_id", *extra).agg(F.collect_list(F.struct(*RIG, "words")).alias("cams"))  # a rig's cameras


def _seen(rows: DataFrame, rig: DataFrame, keys: list[str], on: list[str], min_depth: float) -> DataFrame:
    """keys and ``fg`` of each row in each masked camera of its capture: null where the row is not in its image.

    No filter stands behind the projection: it would be pushed below and every pixel worked out several times over.
    """
    return _looked_up(rows.join(rig, on), keys, min_depth)


def _looked_up(rows: DataFrame, keys: list[str], min_depth: float) -> DataFrame:
    """``_seen`` of rows that carry ``cams``, the cameras of their own capture."""
    u, v, _ = project(F.col("x"), F.col("y"), F.col("z"), min_depth)
    own = list(dict.fromkeys([*keys, "x", "y", "z"]))
    return (
        rows.select(*own, F.explode("cams").alias("cam"))
        .select(*own, *(F.col(f"cam.{c}").alias(c) for c in (*RIG, "words")))
        .select(*keys, u.alias("u"), v.alias("v"), "w", "h", "words")
        .select(*keys, truncated_pixel(F.col("u")).alias("px"), truncated_pixel(F.col("v")).alias("py"), "u", "v", "w", "h", "words")
        .select(*keys, F.when(F.expr("u >= 0 and v >= 0 and px < w and py < h"), _bit()).alias("fg"))
    )


def _bit() -> Column:
    """Whether the mask ``words`` of width ``w`` holds the pixel (px, py)."""
    return F.expr("(shiftrightunsigned(get(words, cast(py * ((w + 63) div 64) + px div 64 as int)), cast(px % 64 as int)) & 1) = 1")


def _votes(seen: DataFrame, keys: list[str]) -> DataFrame:
    return seen.groupBy(*keys).agg(F.count("fg").alias("tested"), F.sum((~F.col("fg")).cast("long")).alias("outside")).filter("tested > 0")


def mask_votes(splats: DataFrame, cameras: DataFrame, runs: DataFrame, min_alpha: float = 0.1, min_depth: float = 0.01) -> DataFrame:
    """capture_id, clip_id, splat_id, tested, outside: how many masks of its capture see a splat, and how many of them see it outside.

    Cameras without a mask do not vote. Votes are summed by splat right behind the lookup.
    """
    keys = ["capture_id", "clip_id", "splat_id"]
    alive = splats.filter((sigmoid(F.col("opacity")) > min_alpha) & _finite("x", "y", "z")).select(*keys, "x", "y", "z")
    return _votes(_seen(alive, _masked_rig(cameras, runs), keys, ["capture_id"], min_depth), keys)


def _finite(*columns: str) -> Column:
    good = F.lit(True)
    for c in columns:
        good = good & F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return good


def vote_fraction(votes: DataFrame, limit: float = 0.5, strict: bool = False) -> DataFrame:
    """Rows to drop: the share of masks that see them outside reaches the limit, or with ``strict`` goes beyond it. Unseen rows are kept."""
    share = F.col("outside") / F.col("tested")
    return votes.withColumn("fraction", share).filter(share > limit if strict else share >= limit)


def lifetime_votes(splats: DataFrame, views: DataFrame, runs: DataFrame, times: list[float], min_alpha: float = 0.02, min_depth: float = 0.05) -> DataFrame:
    """Votes over the times at which a splat is live. ``views`` holds cameras, ``runs`` masks by (capture_id, camera_label, frame_idx).

    Times outside the support that ``min_alpha`` leaves are cut by an interval bound before rows are multiplied.
    """
    peak = sigmoid(F.col("opacity"))
    reach = F.abs("t_sigma") * F.sqrt(F.greatest(F.lit(0.0), -2.0 * F.log(F.lit(min_alpha) / peak)))
    near = F.filter(
        F.array(*(F.struct(F.lit(i).alias("frame_idx"), F.lit(float(t)).alias("t")) for i, t in enumerate(times))),
        lambda s: F.abs(s["t"] - F.col("t_center")) <= F.col("reach") + 1e-9,
    )
    keys = ["capture_id", "clip_id", "splat_id"]
    live = (
        splats.filter(peak > min_alpha)
        .withColumn("reach", reach)
        .select(*keys, "x", "y", "z", "vx", "vy", "vz", "t_center", "t_sigma", "opacity", F.explode(near).alias("s"))
        .withColumn("t", F.col("s.t"))
        .filter(alpha_at(F.col("t"), 1e-9) > min_alpha)
    )
    moved = {a: F.col(a) + F.col(f"v{a}") * (F.col("t") - F.col("t_center")) for a in "xyz"}
    at = live.select(*keys, F.col("s.frame_idx").alias("frame_idx"), *(e.alias(a) for a, e in moved.items()))
    seen = _votes_by_frame(at, views, runs, keys, min_depth)
    return seen.groupBy(*keys).agg(F.sum("tested").alias("tested"), F.sum("outside").alias("outside"))


#: Projections that are worked out at once.
PROJECTIONS = 1 << 18


def _votes_by_frame(at: DataFrame, cameras: DataFrame, runs: DataFrame, keys: list[str], min_depth: float) -> DataFrame:
    """keys, ``tested`` and ``outside`` of each row of ``at`` (keys, capture_id, frame_idx, x, y, z) that a mask of its capture's frame sees.

    Masks are many where each frame has its own, so they meet the rows as gathered runs, some tens of bytes each, and are
    packed where they are looked up: rows and masks are dealt by frame and stream by, masks first. A task holds the masks of one frame.
    """
    on, camera = ["capture_id", "frame_idx"], ["capture_id", "camera_label"]
    rig = _rig(cameras, *camera).select(*camera, F.struct(*RIG).alias("cam")).hint("merge")
    own = list(dict.fromkeys([*keys, *on, "x", "y", "z"]))
    masks = gathered_runs(runs, [*camera, "frame_idx"]).repartition(*camera).join(rig, camera).select(*on, "camera_label", "cam", "n", "runs")
    stream = at.select(*own).dropna(subset=on).unionByName(masks.dropna(subset=on), allowMissingColumns=True)
    types = dict(at.dtypes)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the masks of the frame that the batch before ended in
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            frame = np.zeros(table.num_rows, np.int64)
            frame[first_of_group(table, on)] = 1
            frame = np.cumsum(frame)
            is_mask = table.column("runs").is_valid().to_numpy()
            masks, rows, of_mask, of_row = table.filter(pa.array(is_mask)), table.filter(pa.array(~is_mask)), frame[is_mask], frame[~is_mask]
            held = masks.filter(pa.array(of_mask == frame[-1]))
            used = np.isin(of_mask, of_row)
            if used.any():
                yield from counted(masks.filter(pa.array(used)), of_mask[used], rows, of_row)

    def counted(masks: pa.Table, of_mask: np.ndarray, rows: pa.Table, of_row: np.ndarray) -> Iterator[pa.RecordBatch]:
        first = first_of_group(masks, [*on, "camera_label"])
        cams, of_mask = masks.column("cam").combine_chunks(), of_mask[first]
        number = {c: cams.field(c).to_numpy(zero_copy_only=False) for c in RIG}
        numbered = pa.table({"mask": np.repeat(np.arange(len(first)), np.diff(first, append=len(cams))), "n": masks.column("n"), "runs": masks.column("runs"), "w": cams.field("w"), "h": cams.field("h")})
        packed = pa.Table.from_batches(_blocks(iter([numbered]), ["mask"])).column("words").combine_chunks()
        words, start = packed.flatten().to_numpy(), np.concatenate(([0], np.cumsum(packed.value_lengths().to_numpy())))
        cam = {c: v[first].astype(float) for c, v in number.items()}
        low = np.searchsorted(of_mask, of_row, "left")
        many = np.searchsorted(of_mask, of_row, "right") - low
        xyz = [rows.column(a).to_numpy() for a in "xyz"]
        upto, at = np.cumsum(many), 0
        while at < len(many):
            stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PROJECTIONS, "right")))
            here = many[at:stop]
            of = np.repeat(np.arange(stop - at), here)
            k = np.repeat(low[at:stop] - np.cumsum(here) + here, here) + np.arange(len(of))
            x, y, z = (a[at:stop][of] for a in xyz)
            row = lambda i, t: cam[f"r{i}0"][k] * x + cam[f"r{i}1"][k] * y + cam[f"r{i}2"][k] * z + cam[t][k]  # noqa: B023, E731
            with np.errstate(all="ignore"):  # rows beside or behind a camera
                depth = row(2, "tz")
                u, v = cam["fl_x"][k] * row(0, "tx") / depth + cam["cx"][k], cam["fl_y"][k] * row(1, "ty") / depth + cam["cy"][k]
                inside = np.flatnonzero((depth > min_depth) & (u >= 0) & (v >= 0) & (u < cam["w"][k]) & (v < cam["h"][k]))
            px, py, k, of = u[inside].astype(np.int64), v[inside].astype(np.int64), k[inside], of[inside]
            fg = (words[start[k] + py * -(-cam["w"][k].astype(np.int64) // 64) + px // 64] >> (px % 64)) & 1
            tested, held = np.bincount(of, minlength=stop - at), np.bincount(of[fg == 1], minlength=stop - at)
            good = np.flatnonzero(tested)
            part = rows.slice(at, stop - at).select(keys).take(pa.array(good)).combine_chunks()
            heads = [part.column(c).combine_chunks() for c in keys]
            yield pa.RecordBatch.from_arrays([*heads, pa.array(tested[good]), pa.array((tested - held)[good])], names=[*keys, "tested", "outside"])
            at = stop

    dealt = stream.repartition(*on).sortWithinPartitions(*on, F.col("runs").isNull(), "camera_label")
    return dealt.mapInArrow(vote, ", ".join(f"`{c}` {types[c]}" for c in keys) + ", tested long, outside long")


def drop_by_lifetime(splats: DataFrame, views: DataFrame, runs: DataFrame, times: list[float], limit: float = 0.5) -> DataFrame:
    """Splats without those that more than ``limit`` of their votes see outside."""
    gone = vote_fraction(lifetime_votes(splats, views, runs, times), limit, strict=True)
    return splats.join(gone, ["capture_id", "clip_id", "splat_id"], "left_anti")


def hull_votes(points: DataFrame, cameras: DataFrame, runs: DataFrame, min_views: int, min_depth: float = 0.05, by: tuple[str, ...] = ()) -> DataFrame:
    """Candidate points (capture_id, point_id and ``by``, such as frame_idx) that at least ``min_views`` masks of their capture see inside, with their votes."""
    return votes_in_rig(points, _masked_rig(cameras, runs, *by), min_views, min_depth, by)


def votes_in_rig(points: DataFrame, rig: DataFrame, min_views: int, min_depth: float = 0.05, by: tuple[str, ...] = ()) -> DataFrame:
    """``hull_votes`` on a rig whose masks are packed already (``packed_rig``)."""
    keys = ["capture_id", *by, "point_id"]
    seen = _seen(points.select(*keys, "x", "y", "z"), rig, keys, ["capture_id", *by], min_depth)
    votes = seen.groupBy(*keys).agg(F.sum(F.col("fg").cast("long")).alias("votes"))
    return points.join(votes.filter(F.col("votes") >= min_views), keys)


def votes_in_place(points: DataFrame, keys: list[str], min_views: int, min_depth: float = 0.05) -> DataFrame:
    """keys, x, y, z and votes of the points that ``min_views`` masks hold. Points carry ``cams``; where they lie dealt by some of ``keys``, nothing moves."""
    seen = _looked_up(points.select(*keys, "x", "y", "z", "cams"), [*keys, "x", "y", "z"], min_depth)
    once = (F.first(a).alias(a) for a in "xyz")  # the same in all rows of a point
    return seen.groupBy(*keys).agg(*once, F.sum(F.col("fg").cast("long")).alias("votes")).filter(F.col("votes") >= min_views)


def packed_rig(cameras: DataFrame, runs: DataFrame, *by: str, tasks: int | None = None) -> DataFrame:
    """One row a capture (and ``by``) with its cameras and their packed masks, written once for loops that vote again and again; dealt by its keys over ``tasks``."""
    return cut(_masked_rig(cameras, runs, *by, tasks=tasks))


#: Candidates that are looked up in a camera at once.
LOOKED_UP = 4096


def mask_counts(x: np.ndarray, y: np.ndarray, z: np.ndarray, cams: pa.StructArray, min_depth: float, least: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """How many images of ``cams`` (RIG and words) hold each point, and how many of their masks.

    Points that can no longer come to ``least`` masks are not looked up in the cameras that are left, so their counts stay below it.
    """
    number = {c: cams.field(c).to_numpy(zero_copy_only=False).astype(float) for c in RIG}
    words, ends = cams.field("words").flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(cams.field("words").value_lengths().to_numpy(zero_copy_only=False))))
    tested, votes = np.zeros(len(x), np.int32), np.zeros(len(x), np.int32)
    cameras = [{name: float(values[k]) for name, values in number.items()} for k in range(len(cams))]
    for at in range(0, len(x), LOOKED_UP):
        own = slice(at, at + LOOKED_UP)
        px, py, pz = x[own], y[own], z[own]
        shown, held = np.zeros(len(px), np.int32), np.zeros(len(px), np.int32)
        for k, c in enumerate(cameras):
            row = lambda i, t: c[f"r{i}0"] * px + c[f"r{i}1"] * py + c[f"r{i}2"] * pz + c[t]  # noqa: B023, E731
            depth = row(2, "tz")
            with np.errstate(all="ignore"):  # points beside or behind the camera
                u, v = c["fl_x"] * row(0, "tx") / depth + c["cx"], c["fl_y"] * row(1, "ty") / depth + c["cy"]
            inside = np.flatnonzero((depth > min_depth) & (u >= 0) & (v >= 0) & (u < c["w"]) & (v < c["h"]))
            if len(inside):
                line, column = v[inside].astype(np.int64), u[inside].astype(np.int64)
                bits = words[ends[k] + line * -(-int(c["w"]) // 64) + (column >> 6)] >> (column & 63)
                shown[inside] += 1
                held[inside] += (bits & 1).astype(np.int32)
            left = len(cams) - k - 1
            if least > left and k % 4 == 3:
                keep = np.flatnonzero(held >= least - left)
                if 4 * len(keep) < 3 * len(px):
                    tested[own], votes[own] = shown, held
                    own = np.arange(at, min(at + LOOKED_UP, len(x)))[keep] if isinstance(own, slice) else own[keep]
                    px, py, pz, shown, held = px[keep], py[keep], pz[keep], shown[keep], held[keep]
                    if not len(keep):
                        break
        tested[own], votes[own] = shown, held
    return tested, votes


def mask_coverage(runs: DataFrame, images: DataFrame) -> DataFrame:
    """Share of foreground pixels by capture and camera; ``images`` has their w and h, also where a mask is empty."""
    keys = ["capture_id", "camera_label"]
    area = runs.groupBy(*keys).agg(F.sum(F.col("x1") - F.col("x0") + 1).alias("area"))
    return images.join(area, keys, "left").select(*keys, (F.coalesce("area", F.lit(0)) / (F.col("w") * F.col("h"))).alias("coverage"))


def keypoint_coverage(keypoints: DataFrame, runs: DataFrame, images: DataFrame) -> DataFrame:
    """Share of a camera's keypoints on the foreground, by capture and camera; none gives 0.

    Runs and keypoints are dealt by image line and meet there as they are; no line or mask is gathered.
    """
    keys = ["capture_id", "camera_label"]
    px = keypoints.select(*keys, "u", "v").join(images.select(*keys, "w", "h"), keys)
    px = px.select(*keys, rounded_pixel(F.col("u"), F.col("w")).alias("px"), rounded_pixel(F.col("v"), F.col("h")).alias("py"))
    m = runs.select(*(F.col(k).alias(f"m_{k}") for k in keys), "y", "x0", "x1")
    on_line = [*(F.col(k) == F.col(f"m_{k}") for k in keys), F.col("py") == F.col("y"), F.col("px") >= F.col("x0"), F.col("px") <= F.col("x1")]
    inside = px.join(m, on_line, "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("inside"))
    share = px.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).join(inside, keys, "left").select(*keys, (F.coalesce("inside", F.lit(0)) / F.col("n")).alias("share"))
    return images.select(*keys).join(share, keys, "left").select(*keys, F.coalesce("share", F.lit(0.0)).alias("coverage"))


def residuals(observations: DataFrame, points: DataFrame, cameras: DataFrame) -> DataFrame:
    """Observations with ``error`` in pixels; points behind their camera have null."""
    u, v, _ = project(F.col("x"), F.col("y"), F.col("z"), 1e-6)
    rig = small(_rig(cameras, "capture_id", "camera_label"), len(RIG) + 2)
    du, dv = F.col("u") - u, F.col("v") - v
    joined = observations.join(points.select("capture_id", "tem", "kp_idx", "x", "y", "z"), ["capture_id", "tem", "kp_idx"]).join(rig, ["capture_id", "camera_label"])
    return joined.select(*observations.columns, F.sqrt(du * du + dv * dv).alias("error"))


def residual_report(observations: DataFrame, points: DataFrame, cameras: DataFrame) -> DataFrame:
    """Median, mean, p90 and count of the error by camera, and over all (camera_label null)."""
    errors = kept(residuals(observations, points, cameras).filter("error is not null").select("capture_id", "camera_label", "error"))  # read twice
    both = errors.select("capture_id", F.explode(F.array("camera_label", F.lit(None).cast("string"))).alias("camera_label"), "error")
    return shares_of_many(both, ["capture_id", "camera_label"], "error", {"median": 0.5, "p90": 0.9})


def drop_outliers(observations: DataFrame, points: DataFrame, cameras: DataFrame, outlier_px: float = 200.0, min_views: int = 3) -> DataFrame:
    """Observations in front of their camera within ``outlier_px``, of points that keep ``min_views`` of them."""
    kept = residuals(observations, points, cameras).filter(F.col("error") <= outlier_px)
    views = Window.partitionBy("capture_id", "tem", "kp_idx")
    return kept.withColumn("__n", F.count(F.lit(1)).over(views)).filter(F.col("__n") >= min_views).drop("__n", "error")


def split_valid_cameras(cameras: DataFrame) -> DataFrame:
    """``reason``: null for a usable camera, else what it lacks."""
    needed = ("fl_x", "fl_y", "cx", "cy", "w", "h", "c2w")
    missing = F.array_compact(F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for c in needed)))
    m = [F.col("c2w")[4 * i + j] for i in range(3) for j in range(3)]
    singular = F.abs(determinant3(m)) < 1e-12
    return cameras.withColumn("reason", F.when(F.size(missing) > 0, F.concat(F.lit("missing "), F.array_join(missing, ","))).when(singular, "singular pose"))


def filter_keypoints(keypoints: DataFrame, threshold: float = 0.5) -> DataFrame:
    return keypoints.filter(F.col("score") >= threshold)


def camera_pairs(cameras: DataFrame) -> DataFrame:
    """cam_a, cam_b for all pairs of a capture in name order."""
    a = cameras.select("capture_id", F.col("camera_label").alias("cam_a")).distinct()
    b = a.withColumnRenamed("cam_a", "cam_b")
    return a.join(b, "capture_id").filter("cam_a < cam_b")


def dense_labels(cameras: DataFrame) -> DataFrame:
    """``dense``: 00, 01, ... in label order inside a capture, without gaps."""
    w = Window.partitionBy("capture_id").orderBy("camera_label")  # a rig's cameras
    n = (F.row_number().over(w) - 1).cast("string")
    return cameras.withColumn("dense", F.when(F.length(n) < 2, F.lpad(n, 2, "0")).otherwise(n))


def relabel(images: DataFrame, labels: DataFrame, expected: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Images with the label of their camera number; those of unknown number; and expected labels without image."""
    numbered = images.withColumn("camera_id", trailing_id(camera_label(F.col("image"))))
    named = numbered.join(labels, "camera_id")
    unknown = numbered.join(labels, "camera_id", "left_anti")
    return named, unknown, expected.join(named.select("camera_label"), "camera_label", "left_anti")


def holdout_split(views: DataFrame, test: list[str], holdout: list[str]) -> DataFrame:
    """``split``: train, test or null; without any test view, the first train camera is the test."""
    label = F.col("camera_label")
    marked = views.withColumn("split", F.when(label.isin(test), "test").when(~label.isin(holdout) | F.lit(not holdout), "train"))
    rest = marked.groupBy("capture_id").agg(
        F.max((F.col("split") == "test").cast("int")).alias("__tested"), F.min(F.when(F.col("split") == "train", label)).alias("__first")
    )
    as_test: Column = (F.coalesce("__tested", F.lit(0)) == 0) & (label == F.col("__first"))
    both = marked.join(F.broadcast(rest), "capture_id").filter(as_test).withColumn("split", F.lit("test"))  # one row a capture
    return marked.filter("split is not null").unionByName(both.drop("__tested", "__first"))


def with_intrinsics(cameras: DataFrame, calibrations: DataFrame, fallback: dict[str, float]) -> DataFrame:
    """Calibrated intrinsics of the same capture and camera where there are any, else the fallback's."""
    own = calibrations.select("capture_id", "camera_label", *(F.col(c).alias(f"__{c}") for c in fallback))
    joined = cameras.join(own, ["capture_id", "camera_label"], "left")
    return joined.withColumns({c: F.coalesce(f"__{c}", F.lit(float(v))) for c, v in fallback.items()}).drop(*(f"__{c}" for c in fallback))


def reconcile_calibration(calibrations: DataFrame, media: DataFrame) -> DataFrame:
    """``status`` and intrinsics brought to the media's size. ``k`` is row-major 3x3."""
    k = lambda i: F.col("k")[i]
    finite = F.forall("k", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < 1e300))
    rx, ry = F.col("width") / F.col("image_w"), F.col("height") / F.col("image_h")
    unsized = F.col("image_w").isNull() | F.col("image_h").isNull()
    off = (F.abs(k(2) - F.col("width") / 2) > 0.1 * F.col("width")) | (F.abs(k(5) - F.col("height") / 2) > 0.1 * F.col("height"))
    status = (
        F.when(~finite | (k(0) <= 0) | (k(4) <= 0), "invalid")
        .when(unsized, F.when(off, "warn").otherwise("unsized"))
        .when((rx == 1) & (ry == 1), "ok")
        .when(F.abs(rx - ry) > 0.01, "aspect")
        .otherwise("scaled")
    )
    sx, sy = F.when(status == "scaled", rx).otherwise(1.0), F.when(status == "scaled", ry).otherwise(1.0)
    scaled = F.transform("k", lambda v, i: v * F.when(i < 3, sx).when(i < 6, sy).otherwise(1.0))
    return calibrations.join(media, calibrations["camera_id"] == media["camera"]).withColumn("status", status).withColumn("k", scaled)


def time_rescale(views: DataFrame, durations: DataFrame) -> DataFrame:
    """Times stretched to their clip's duration, unless they fit it within 0.8 and 1.25. ``durations``: capture_id, duration."""
    longest = views.groupBy("capture_id").agg(F.max("time").alias("__longest")).join(durations, "capture_id")
    ratio = F.col("duration") / F.col("__longest")
    factor = F.when((F.col("__longest") > 0) & ~((ratio > 0.8) & (ratio < 1.25)), ratio).otherwise(1.0)
    scaled = views.join(F.broadcast(longest), "capture_id")  # one row a capture
    return scaled.withColumn("time", F.col("time") * factor).drop("__longest", "duration")
