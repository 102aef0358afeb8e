"""Triangulation, alignment and refinement of camera poses."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import with_world_to_camera
from .scratch import cut, kept, small


def triangulate(observations: DataFrame, cameras: DataFrame, threshold: float = 0.5, min_views: int = 3) -> DataFrame:
    """capture_id, tem, kp_idx, x, y, z, n_views by the weighted direct linear method.

    The ten entries of each point's normal matrix are summed by Spark; what is left is one 4x4 eigenproblem a point.
    """
    rig = with_world_to_camera(cameras)
    rows = [[F.col(f"r{i}0"), F.col(f"r{i}1"), F.col(f"r{i}2"), F.col(t)] for i, t in enumerate(("tx", "ty", "tz"))]
    p = [
        *(F.col("fl_x") * rows[0][j] + F.col("cx") * rows[2][j] for j in range(4)),
        *(F.col("fl_y") * rows[1][j] + F.col("cy") * rows[2][j] for j in range(4)),
        *(rows[2][j] for j in range(4)),
    ]
    lines = small(rig.select("capture_id", "camera_label", F.array(*p).alias("p")), 14)
    seen = observations.filter(F.col("score") >= threshold).join(lines, ["capture_id", "camera_label"])
    first = [F.col("u") * F.col("p")[8 + j] - F.col("p")[j] for j in range(4)]
    second = [F.col("v") * F.col("p")[8 + j] - F.col("p")[4 + j] for j in range(4)]
    sums = [F.sum(F.col("score") * (first[i] * first[j] + second[i] * second[j])).alias(f"m{i}{j}") for i in range(4) for j in range(i, 4)]
    normal = seen.groupBy("capture_id", "tem", "kp_idx").agg(*sums, F.count(F.lit(1)).cast("int").alias("n_views")).filter(F.col("n_views") >= min_views)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            m = np.empty((len(pdf), 4, 4))
            for i in range(4):
                for j in range(i, 4):
                    m[:, i, j] = m[:, j, i] = pdf[f"m{i}{j}"]
            h = np.linalg.eigh(m)[1][:, :, 0] if len(pdf) else np.empty((0, 4))
            xyz = h[:, :3] / (h[:, 3:] + 1e-12)
            yield pdf[["capture_id", "tem", "kp_idx"]].assign(x=xyz[:, 0], y=xyz[:, 1], z=xyz[:, 2], n_views=pdf["n_views"])

    return normal.mapInPandas(solve, "capture_id long, tem string, kp_idx int, x double, y double, z double, n_views int")


def similarity_fit(pairs: DataFrame) -> DataFrame:
    """scale, rotation (9, row-major) and translation (3) that take src_* to dst_*, by capture.

    Means and the centred cross-covariance are sums in Spark; the 3x3 decomposition is one row a capture.
    """
    mean = pairs.groupBy("capture_id").agg(*(F.avg(f"{s}_{a}").alias(f"m_{s}_{a}") for s in ("src", "dst") for a in "xyz"), F.count(F.lit(1)).alias("n"))
    c = pairs.join(F.broadcast(mean), "capture_id")  # one row a capture
    d = lambda s, a: F.col(f"{s}_{a}") - F.col(f"m_{s}_{a}")
    cov = c.groupBy("capture_id").agg(
        *(F.sum(d("dst", a) * d("src", b)).alias(f"c{i}{j}") for i, a in enumerate("xyz") for j, b in enumerate("xyz")),
        F.sum(sum((d("src", a) * d("src", a) for a in "xyz"), F.lit(0.0))).alias("spread"),
    ).join(mean, "capture_id")

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.to_dict("records"):
                u, s, vt = np.linalg.svd(np.array([[r[f"c{i}{j}"] for j in range(3)] for i in range(3)]))
                turn = np.diag([1.0, 1.0, np.sign(np.linalg.det(u @ vt)) or 1.0])
                rot = u @ turn @ vt
                scale = float((s * np.diag(turn)).sum() / max(r["spread"], 1e-12))
                src, dst = (np.array([r[f"m_{n}_{a}"] for a in "xyz"]) for n in ("src", "dst"))
                out.append((r["capture_id"], scale, rot.ravel().tolist(), (dst - scale * rot @ src).tolist()))
            yield pd.DataFrame(out, columns=["capture_id", "scale", "rotation", "translation"])

    return cov.mapInPandas(solve, "capture_id long, scale double, rotation array<double>, translation array<double>")


def _similarity(a: str) -> Column:
    """One axis of x, y, z moved by scale, rotation and translation."""
    i = "xyz".index(a)
    return F.col("scale") * sum((F.col("rotation")[3 * i + j] * F.col(b) for j, b in enumerate("xyz")), F.lit(0.0)) + F.col("translation")[i]


def remove_gauge(points: DataFrame, fit: DataFrame) -> DataFrame:
    """Points (x, y, z) moved by the similarity of their capture."""
    joined = points.join(F.broadcast(fit), "capture_id")  # one row a capture
    return joined.select(*(_similarity(c).alias(c) if c in "xyz" else c for c in points.columns))


def camera_centres(poses: DataFrame, prefix: str) -> DataFrame:
    """capture_id, camera_label and the centre of each pose (w2c) as ``prefix``_x .. _z."""
    m = lambda i, j: F.col("w2c")[4 * i + j]
    centre = [-sum((m(k, i) * m(k, 3) for k in range(3)), F.lit(0.0)) for i in range(3)]
    return poses.select("capture_id", "camera_label", *(c.alias(f"{prefix}_{a}") for c, a in zip(centre, "xyz", strict=True)))


def remove_gauge_of_poses(poses: DataFrame, fit: DataFrame) -> DataFrame:
    """Poses (w2c) in the world that the similarity of their capture moves into; image positions of moved points stay."""
    joined = poses.join(F.broadcast(fit), "capture_id")  # one row a capture
    m, r = (lambda i, j: F.col("w2c")[4 * i + j]), (lambda i, j: F.col("rotation")[3 * i + j])
    turned = [[sum((m(i, k) * r(j, k) for k in range(3)), F.lit(0.0)) for j in range(3)] for i in range(3)]
    rows = [[*turned[i], F.col("scale") * m(i, 3) - sum((turned[i][j] * F.col("translation")[j] for j in range(3)), F.lit(0.0))] for i in range(3)]
    last = [F.lit(float(x)) for x in (0, 0, 0, 1)]
    return joined.withColumn("w2c", F.array(*(c for row in rows for c in row), *last)).select(*poses.columns)


def given_poses(cameras: DataFrame) -> DataFrame:
    """capture_id, camera_label, w2c of cameras given by c2w."""
    rig = with_world_to_camera(cameras)
    rows = [F.col(c) for i, t in enumerate(("tx", "ty", "tz")) for c in (f"r{i}0", f"r{i}1", f"r{i}2", t)]
    return rig.select("capture_id", "camera_label", F.array(*rows, *(F.lit(float(x)) for x in (0, 0, 0, 1))).alias("w2c"))


def with_poses(cameras: DataFrame, poses: DataFrame) -> DataFrame:
    """Cameras with the c2w of refined poses (w2c)."""
    m = lambda i, j: F.col("w2c")[4 * i + j]
    turned = (1.0, -1.0, -1.0)
    centre = [-sum((m(k, i) * m(k, 3) for k in range(3)), F.lit(0.0)) for i in range(3)]
    rows = [c for i in range(3) for c in (*(F.lit(turned[j]) * m(j, i) for j in range(3)), centre[i])]
    joined = cameras.drop("c2w").join(poses.select("capture_id", "camera_label", "w2c"), ["capture_id", "camera_label"])
    return joined.withColumn("c2w", F.array(*rows, *(F.lit(float(x)) for x in (0, 0, 0, 1)))).drop("w2c")


def robust_pose_average(poses: DataFrame, max_degrees: float = 10.0) -> DataFrame:
    """Mean centre and rotation of each camera over its repeated poses (w2c, 16 row-major), outliers left out.

    Positions: within five median distances of the median centre. Rotations: of those, within ``max_degrees`` of the
    one with most support among them. Spreads are means and maxima over what is left. A camera's repeated poses
    (instants of one capture) are one row; cameras with as many poses are averaged together, ``POSE_PAIRS`` pairs of poses at once.
    """

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = batch.column("seen")
            number = seen.value_lengths().to_numpy()
            first, w2c = np.cumsum(number) - number, seen.flatten().field("w2c").flatten().to_numpy(zero_copy_only=False).reshape(-1, 4, 4)
            mean, good, spreads = np.zeros((len(number), 4, 4)), np.zeros(len(number), np.int32), np.zeros((len(number), 4))
            for n in np.unique(number):
                same = np.flatnonzero(number == n)
                step = max(1, POSE_PAIRS // int(n) ** 2)
                for at in range(0, len(same), step):
                    rows = same[at : at + step]
                    mean[rows], good[rows], spreads[rows] = _average(w2c[first[rows][:, None] + np.arange(n)], max_degrees)
            listed = pa.ListArray.from_arrays(pa.array(np.arange(len(number) + 1, dtype=np.int32) * 16), pa.array(mean.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("capture_id"), batch.column("camera_label"), listed, pa.array(number.astype(np.int32)), pa.array(good), *(pa.array(c) for c in spreads.T.copy())], names=names)

    names = ["capture_id", "camera_label", "w2c", "num_views", "num_inliers", "center_spread", "center_spread_max", "rot_spread_deg", "rot_spread_deg_max"]
    seen = F.array_sort(F.collect_list(F.struct("image", "w2c"))).alias("seen")
    return poses.groupBy(F.col("capture_id").cast("long").alias("capture_id"), "camera_label").agg(seen).mapInArrow(
        average,
        "capture_id long, camera_label string, w2c array<double>, num_views int, num_inliers int, center_spread double, center_spread_max double, rot_spread_deg double, rot_spread_deg_max double",
    )


#: Pairs of poses that are compared at once.
POSE_PAIRS = 1 << 20


def _average(m: np.ndarray, max_degrees: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean pose, inliers and four spreads of each of g cameras with n poses."""
    rot, centre = m[..., :3, :3], -np.einsum("gnji,gnj->gni", m[..., :3, :3], m[..., :3, 3])
    far = np.linalg.norm(centre - np.median(centre, axis=1, keepdims=True), axis=2)
    near = far <= np.maximum(5 * np.median(far, axis=1, keepdims=True), 1e-6)
    degrees = lambda trace: np.degrees(np.arccos(np.clip((trace - 1) / 2, -1, 1)))
    flat = rot.reshape(*rot.shape[:2], 9)
    close = (degrees(flat @ flat.transpose(0, 2, 1)) <= max_degrees) & near[:, None, :] & near[:, :, None]
    best = close[np.arange(len(m)), close.sum(axis=2).argmax(axis=1)]
    good = np.where(close.any(axis=(1, 2))[:, None], best, near)
    u, _, vt = np.linalg.svd(np.einsum("gn,gnij->gij", good, rot))
    turn = np.zeros((len(m), 3, 3))
    sign = np.sign(np.linalg.det(u @ vt))
    turn[:, 0, 0], turn[:, 1, 1], turn[:, 2, 2] = 1.0, 1.0, np.where(sign == 0, 1.0, sign)
    mean, count = u @ turn @ vt, good.sum(axis=1)
    where = np.einsum("gn,gni->gi", good, centre) / count[:, None]
    spread, turned = np.linalg.norm(centre - where[:, None], axis=2) * good, degrees(np.einsum("gnij,gij->gn", rot, mean)) * good
    w2c = np.zeros((len(m), 4, 4))
    w2c[:, :3, :3], w2c[:, :3, 3], w2c[:, 3, 3] = mean, -np.einsum("gij,gj->gi", mean, where), 1.0
    return w2c, count, np.column_stack((spread.sum(axis=1) / count, spread.max(axis=1), turned.sum(axis=1) / count, turned.max(axis=1)))


def _turns(w: np.ndarray) -> np.ndarray:
    """Rotations of n small axis-angle vectors."""
    a = np.linalg.norm(w, axis=1)[:, None, None]
    k = np.zeros((len(w), 3, 3))
    k[:, 0, 1], k[:, 0, 2], k[:, 1, 2] = -w[:, 2], w[:, 1], -w[:, 0]
    k -= k.transpose(0, 2, 1)
    safe = np.maximum(a, 1e-12)
    return np.where(a < 1e-12, np.eye(3) + k, np.eye(3) + np.sin(a) / safe * k + (1 - np.cos(a)) / (safe * safe) * k @ k)


def _turn(w: np.ndarray) -> np.ndarray:
    """Rotation of one axis-angle vector."""
    return _turns(w[None])[0]


#: Points that are eliminated together, in expectation, and pairs of their observations multiplied at once.
POINTS, PAIRS = 500, 100_000
#: Dampings that a round of one capture tries at most.
DAMPINGS = 6


def _bent(rot: np.ndarray, t: np.ndarray, xyz: np.ndarray, lens: np.ndarray, seen: np.ndarray, weight: np.ndarray, huber_px: float) -> tuple[np.ndarray, ...]:
    """Positions of n points before their cameras, their residuals (n, 2) after the Huber transform and its slopes, both weighted.

    ``rot`` and ``t`` are those of each observation's camera, ``lens`` its fl_x, fl_y, cx, cy.
    """
    cam = np.einsum("nij,nj->ni", rot, xyz) + t
    z = np.where(np.abs(cam[:, 2]) < 1e-9, 1e-9, cam[:, 2])
    res = lens[:, :2] * cam[:, :2] / z[:, None] + lens[:, 2:] - seen
    size = np.abs(res)
    bent = np.sqrt(huber_px * np.maximum(2 * size - huber_px, huber_px))  # beyond the threshold
    slope = np.where(size <= huber_px, 1.0, huber_px / bent) * weight[:, None]
    return cam, np.where(size <= huber_px, res, np.sign(res) * bent) * weight[:, None], slope


def _jacobians(rot: np.ndarray, t: np.ndarray, lens: np.ndarray, cam: np.ndarray, slope: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Derivatives of n residuals by their pose (n, 2, 6) and by their point (n, 2, 3)."""
    z = np.where(np.abs(cam[:, 2]) < 1e-9, 1e-9, cam[:, 2])
    jc = np.zeros((len(cam), 2, 3))
    jc[:, 0, 0], jc[:, 0, 2], jc[:, 1, 1], jc[:, 1, 2] = lens[:, 0] / z, -lens[:, 0] * cam[:, 0] / z**2, lens[:, 1] / z, -lens[:, 1] * cam[:, 1] / z**2
    turned = cam - t
    skew = np.zeros((len(cam), 3, 3))
    skew[:, 0, 1], skew[:, 0, 2], skew[:, 1, 2] = -turned[:, 2], turned[:, 1], -turned[:, 0]
    skew -= skew.transpose(0, 2, 1)
    return np.concatenate((-jc @ skew, jc), axis=2) * slope[:, :, None], (jc @ rot) * slope[:, :, None]


def _damped(v: np.ndarray, lam: float) -> np.ndarray:
    """Square blocks with their diagonals raised."""
    at = np.arange(v.shape[-1])
    v = v.copy()
    v[..., at, at] += lam * np.maximum(v[..., at, at], 1e-9)
    return v


def _solved(m: np.ndarray, s: np.ndarray) -> np.ndarray:
    try:
        return np.linalg.solve(m, s)
    except np.linalg.LinAlgError:
        return np.linalg.lstsq(m, s, rcond=None)[0]


def _refined(rot: np.ndarray, t: np.ndarray, xyz: np.ndarray, cam_of: np.ndarray, of: np.ndarray, lens: np.ndarray, seen: np.ndarray, weight: np.ndarray, rounds: int, huber_px: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Poses (rot, t) and points of one capture; observation i is of point ``of[i]``, ascending, in camera ``cam_of[i]``.

    A round makes its blocks once and solves them with less damping as long as the cost falls by it, or with more until it falls at all.
    """
    judge = lambda rot, t, xyz: _bent(rot[cam_of], t[cam_of], xyz[of], lens, seen, weight, huber_px)
    first, c, p = np.flatnonzero(np.diff(of, prepend=-1)), len(rot), len(xyz)
    found, lam = judge(rot, t, xyz), 1e-3
    last = (found[1] ** 2).sum()
    for _ in range(rounds):
        cam, res, slope = found
        a, b = _jacobians(rot[cam_of], t[cam_of], lens, cam, slope)
        whole, side, both = np.zeros((c, 6, c, 6)), np.zeros((c, 6)), np.zeros((p, 3, c, 6))
        np.add.at(whole, (cam_of, slice(None), cam_of), a.transpose(0, 2, 1) @ a)
        np.add.at(side, cam_of, np.einsum("nki,nk->ni", a, res))
        np.add.at(both, (of, slice(None), cam_of), b.transpose(0, 2, 1) @ a)
        v, g = np.add.reduceat(b.transpose(0, 2, 1) @ b, first), np.add.reduceat(np.einsum("nki,nk->ni", b, res), first)
        whole, both = whole.reshape(6 * c, 6 * c), both.reshape(p, 3, 6 * c)
        flat, best, cost = both.reshape(3 * p, -1), None, last * (1 + 1e-12)
        for _ in range(DAMPINGS):
            vi = np.linalg.inv(_damped(v, lam))
            held = (vi @ both).reshape(3 * p, -1)
            step = _solved(_damped(whole - flat.T @ held, lam), held.T @ g.ravel() - side.ravel())
            moved = xyz - np.einsum("nij,nj->ni", vi, g + both @ step)
            step = step.reshape(c, 6)
            tried = _turns(step[:, :3]) @ rot, t + step[:, 3:], moved
            judged = judge(*tried)
            cost_so = (judged[1] ** 2).sum()
            if cost_so <= cost:
                best, cost, damp = (*tried, judged), cost_so, lam
                if lam <= 1e-9:
                    break
                lam = max(lam / 10, 1e-9)
            elif best is None:
                lam *= 10
            else:
                break
        if best is None:
            continue  # with the damping that was raised
        done = abs(last - cost) <= 1e-10 * max(last, 1e-12)
        (rot, t, xyz, found), last, lam = best, cost, damp
        if done:
            break
    return rot, t, xyz


def _refined_captures(weighted: DataFrame, rig: DataFrame, pts: DataFrame, rounds: int, huber_px: float) -> DataFrame:
    """One row a capture with its refined ``cams`` and ``pts``, for captures of at most ``POINTS`` points: each is adjusted in a group of its own."""

    def adjust(seen: pa.Table, rig: pa.Table) -> pa.Table:
        numbers = lambda table, *names: np.column_stack([table.column(n).to_numpy() for n in names]).astype(float)
        listed = lambda name, *shape: np.array(rig.column(name).to_pylist(), float).reshape(-1, *shape)
        cams, points = rig.select(["camera_label"]), seen.select(keys[1:]).slice(0, 0)
        rot, t, xyz = listed("rot", 3, 3), listed("t", 3), np.empty((0, 3))
        cam_of = pc.index_in(seen.column("camera_label"), rig.column("camera_label").combine_chunks()).to_numpy()
        if len(cam_of):
            point = np.zeros(len(cam_of), np.int64)
            for k in keys[1:]:
                own = seen.column(k).combine_chunks().dictionary_encode()
                point = np.unique(point * len(own.dictionary) + own.indices.to_numpy(), return_inverse=True)[1]
            order = np.argsort(point, kind="stable")
            seen, cam_of, of = seen.take(pa.array(order)), cam_of[order], point[order]
            heads = pa.array(np.flatnonzero(np.diff(of, prepend=-1)))
            one, used = seen.take(heads), np.unique(cam_of)
            points, xyz = one.select(keys[1:]), numbers(one, *"xyz")
            lens = numbers(rig, "fl_x", "fl_y", "cx", "cy")[cam_of]
            rot[used], t[used], xyz = _refined(rot[used], t[used], xyz, np.searchsorted(used, cam_of), of, lens, numbers(seen, "u", "v"), numbers(seen, "wt")[:, 0], rounds, huber_px)
        vectors = lambda x: pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), int(np.prod(x.shape[1:]))).cast(pa.list_(pa.float64()))
        row = lambda names, arrays: pa.ListArray.from_arrays([0, len(arrays[0])], pa.StructArray.from_arrays(arrays, names))
        placed = row([*keys[1:], *"xyz"], [*(points.column(k).combine_chunks() for k in keys[1:]), *(pa.array(xyz[:, i].copy()) for i in range(3))])
        posed = row(["camera_label", "rot", "t"], [cams.column(0).combine_chunks(), vectors(rot), vectors(t)])
        return pa.Table.from_arrays([rig.column("capture_id").slice(0, 1).combine_chunks(), posed, placed], ["capture_id", "cams", "pts"])

    keys = ["capture_id", "tem", "kp_idx"]
    seen = weighted.join(rig, ["capture_id", "camera_label"], "left_semi").join(pts, keys).select(*keys, "camera_label", "u", "v", "wt", "x", "y", "z")
    schema = "capture_id long, cams array<struct<camera_label: string, rot: array<double>, t: array<double>>>, pts array<struct<tem: string, kp_idx: int, x: double, y: double, z: double>>"
    tasks = int(weighted.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # stated: few bytes are much work here
    return seen.repartition(tasks, "capture_id").groupBy("capture_id").cogroup(rig.repartition(tasks, "capture_id").groupBy("capture_id")).applyInArrow(adjust, schema)


def refine_poses(observations: DataFrame, cameras: DataFrame, points: DataFrame, rounds: int = 20, huber_px: float = 20.0, face_weight: float = 1.0, face: tuple[tuple[int, int], ...] = ((0, 4), (69, 307))) -> tuple[DataFrame, DataFrame]:
    """Poses (capture_id, camera_label, w2c) and points after Huber bundle adjustment with fixed intrinsics.

    Each component of a residual goes through the Huber transform before its weight, and the cost is the sum of
    squares of what comes out. A step that raises it is taken back and tried again with more damping.

    Each round is Levenberg-Marquardt on the Schur complement: observations give 6x6, 6x3 and 3x3 blocks, points are
    eliminated, and the 6C x 6C sums of a capture, whose cameras are tens, are solved. Captures of at most ``POINTS``
    points are adjusted each in its own group, with damping of their own, and move once. Those of more points share
    their rounds: points are eliminated ``POINTS`` at a time with all their observations at once, Spark reduces the
    sums, and poses and points are rewritten by joins; nothing is collected but one cost a round.
    """
    rig = with_world_to_camera(cameras).select(
        "capture_id", "camera_label", "fl_x", "fl_y", "cx", "cy", F.array(*(F.col(f"r{i}{j}") for i in range(3) for j in range(3))).alias("rot"), F.array("tx", "ty", "tz").alias("t")
    )
    is_face = F.lit(False)
    for a, b in face:
        is_face = is_face | F.col("kp_idx").between(a, b)
    weighted = observations.withColumn("wt", F.sqrt(F.when(is_face, F.lit(face_weight)).otherwise(1.0) * F.col("score")))
    keys = ["capture_id", "tem", "kp_idx"]
    pts = cut(points.select(*keys, "x", "y", "z"))
    parts = cut(pts.groupBy("capture_id").agg(F.ceil(F.count(F.lit(1)) / POINTS).alias("__parts")).filter("__parts > 1"))
    has_large = not parts.isEmpty()
    without = lambda df: df.join(parts, "capture_id", "left_anti") if has_large else df
    done = cut(_refined_captures(without(weighted), without(rig), without(pts), rounds, huber_px))
    refined, moved = done.select("capture_id", F.inline("cams")), done.select("capture_id", F.inline("pts"))
    if has_large:
        split = weighted.join(parts, "capture_id").withColumn("part", F.pmod(F.xxhash64("tem", "kp_idx"), F.col("__parts"))).drop("__parts")
        among = lambda df: df.join(parts, "capture_id", "left_semi")
        rig, pts = _refined_together(kept(split), among(rig), among(pts), rounds, huber_px)
        refined, moved = refined.unionByName(rig.select(*refined.columns)), moved.unionByName(pts.select(*moved.columns))
    w2c = F.flatten(F.array(*(F.concat(F.slice("rot", 3 * i + 1, 3), F.array(F.col("t")[i])) for i in range(3)), F.array(*(F.lit(float(x)) for x in (0, 0, 0, 1)))))
    return refined.select("capture_id", "camera_label", w2c.alias("w2c")), moved


def _refined_together(weighted: DataFrame, rig: DataFrame, pts: DataFrame, rounds: int, huber_px: float) -> tuple[DataFrame, DataFrame]:
    """Refined rig and points of captures of many points, whose observations carry their ``part``."""
    keys = ["capture_id", "tem", "kp_idx"]
    damp, last, before, again = 1e-3, None, None, False
    reduced_schema = "capture_id long, cam_a string, cam_b string, block array<double>, side array<double>, cost double"

    def blocks(pdf: pd.DataFrame, lam: float):
        r, t = np.stack(pdf["rot"].to_numpy()).reshape(-1, 3, 3), np.stack(pdf["t"].to_numpy())
        lens = pdf[["fl_x", "fl_y", "cx", "cy"]].to_numpy()
        cam, res, slope = _bent(r, t, pdf[["x", "y", "z"]].to_numpy(), lens, pdf[["u", "v"]].to_numpy(), pdf["wt"].to_numpy(), huber_px)
        a, b = _jacobians(r, t, lens, cam, slope)
        of = pdf.groupby(keys[1:]).ngroup().to_numpy()
        v, g = np.zeros((of.max() + 1, 3, 3)), np.zeros((of.max() + 1, 3))
        np.add.at(v, of, np.einsum("nki,nkj->nij", b, b))
        np.add.at(g, of, np.einsum("nki,nk->ni", b, res))
        return a, res, np.einsum("nki,nkj->nij", a, b), of, np.linalg.inv(_damped(v, lam)), g

    for k in range(rounds + 1):  # the last one only judges the step before
        lam = damp  # each round is run before it changes
        joined = weighted.join(pts, keys).join(rig, ["capture_id", "camera_label"])

        def eliminate(pdf: pd.DataFrame) -> pd.DataFrame:
            a, res, w, of, vi, g = blocks(pdf, lam)
            names, cam = np.unique(pdf["camera_label"].to_numpy(str), return_inverse=True)
            order = np.argsort(of, kind="stable")
            number = np.bincount(of)
            first = np.cumsum(number) - number
            solved = w @ vi[of]
            whole, side = np.zeros((len(names) ** 2, 6, 6)), np.zeros((len(names), 6))
            np.add.at(whole, cam * len(names) + cam, np.einsum("nki,nkj->nij", a, a))
            np.add.at(side, cam, np.einsum("nki,nk->ni", a, res) - np.einsum("nij,nj->ni", solved, g[of]))
            row = np.repeat(np.arange(len(of)), number[of])
            col = order[np.repeat(first[of] - np.cumsum(number[of]) + number[of], number[of]) + np.arange(len(row))]
            for start in range(0, len(row), PAIRS):
                i, j = row[start : start + PAIRS], col[start : start + PAIRS]
                np.subtract.at(whole, cam[i] * len(names) + cam[j], solved[i] @ w[j].transpose(0, 2, 1))
            met = np.unique(cam[row] * len(names) + cam[col])
            i, j = met // len(names), met % len(names)
            return pd.DataFrame(
                {"capture_id": pdf["capture_id"].iloc[0], "cam_a": names[i], "cam_b": names[j], "block": whole[met].reshape(-1, 36).tolist(),
                 "side": np.where((i == j)[:, None], side[i], 0.0).tolist(), "cost": np.where(np.arange(len(met)) == 0, (res**2).sum(), 0.0)}
            )

        sums = joined.groupBy("capture_id", "part").applyInPandas(eliminate, reduced_schema)
        summed = cut(
            sums.groupBy("capture_id", "cam_a", "cam_b").agg(
                F.array(*(F.sum(F.col("block")[i]) for i in range(36))).alias("block"), F.array(*(F.sum(F.col("side")[i]) for i in range(6))).alias("side"), F.sum("cost").alias("cost")
            )
        )
        cost = summed.agg(F.sum("cost")).first()[0] or 0.0
        if last is not None and cost > last * (1 + 1e-12):
            (rig, pts), damp, again = before, damp * 10, True
            continue
        if k == rounds or (last is not None and not again and abs(last - cost) <= 1e-10 * max(last, 1e-12)):
            break
        last, again = cost, False

        def solve(pdf: pd.DataFrame) -> pd.DataFrame:
            names = sorted(set(pdf["cam_a"]))
            at = {c: i for i, c in enumerate(names)}
            m, s = np.zeros((6 * len(names), 6 * len(names))), np.zeros(6 * len(names))
            for r in pdf.itertuples():
                i, j = 6 * at[r.cam_a], 6 * at[r.cam_b]
                m[i : i + 6, j : j + 6] += np.array(r.block).reshape(6, 6)
                if i == j:
                    s[i : i + 6] += np.array(r.side)
            step = _solved(_damped(m, lam), -s).reshape(-1, 6)
            return pd.DataFrame({"capture_id": pdf["capture_id"].iloc[0], "camera_label": names, "step": [x.tolist() for x in step]})

        steps = cut(summed.groupBy("capture_id").applyInPandas(solve, "capture_id long, camera_label string, step array<double>"))

        def move_points(pdf: pd.DataFrame) -> pd.DataFrame:
            _, _, w, of, vi, g = blocks(pdf, lam)
            back = g.copy()
            np.add.at(back, of, np.einsum("nij,ni->nj", w, np.stack(pdf["step"].to_numpy())))
            one = pdf.assign(__of=of).drop_duplicates("__of").sort_values("__of")
            placed = one[["x", "y", "z"]].to_numpy() - np.einsum("nij,nj->ni", vi, back)
            return one[keys].assign(x=placed[:, 0], y=placed[:, 1], z=placed[:, 2])

        moved = joined.join(steps, ["capture_id", "camera_label"]).groupBy("capture_id", "part").applyInPandas(move_points, "capture_id long, tem string, kp_idx int, x double, y double, z double")

        def move_cameras(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                rot = []
                t = []
                for r in pdf.itertuples():
                    s = np.array(r.step) if r.step is not None else np.zeros(6)
                    rot.append((_turn(s[:3]) @ np.array(r.rot).reshape(3, 3)).ravel().tolist())
                    t.append((np.array(r.t) + s[3:]).tolist())
                yield pdf.drop(columns=["step"]).assign(rot=rot, t=t)

        schema = "capture_id long, camera_label string, fl_x double, fl_y double, cx double, cy double, rot array<double>, t array<double>"
        before = (rig, pts)
        pts = cut(moved)
        rig = cut(rig.join(steps, ["capture_id", "camera_label"], "left").mapInPandas(move_cameras, schema))
        damp = max(damp / 3, 1e-9)
    return rig, pts


def quat_from_matrix(m: np.ndarray) -> np.ndarray:
    """Unit quaternions, w first and not negative, of n 3x3 rotations: the eigenvector of the largest eigenvalue."""
    k = np.empty((len(m), 4, 4))
    xx, yy, zz = m[:, 0, 0], m[:, 1, 1], m[:, 2, 2]
    k[:, 0, 0], k[:, 1, 1], k[:, 2, 2], k[:, 3, 3] = xx + yy + zz, xx - yy - zz, yy - xx - zz, zz - xx - yy
    for (i, j), (a, b, s) in {(0, 1): ((2, 1), (1, 2), -1), (0, 2): ((0, 2), (2, 0), -1), (0, 3): ((1, 0), (0, 1), -1), (1, 2): ((0, 1), (1, 0), 1), (1, 3): ((0, 2), (2, 0), 1), (2, 3): ((1, 2), (2, 1), 1)}.items():
        k[:, i, j] = k[:, j, i] = m[:, a[0], a[1]] + s * m[:, b[0], b[1]]
    q = np.linalg.eigh(k)[1][:, :, 3]
    return q * np.where(q[:, :1] < 0, -1.0, 1.0)


def quaternions(df: DataFrame, column: str) -> DataFrame:
    """rot_0..rot_3 of the 3x3 rotations (9 values, row-major) in ``column``."""

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            q = quat_from_matrix(np.stack(pdf[column].to_numpy()).reshape(-1, 3, 3)) if len(pdf) else np.empty((0, 4))
            yield pdf.drop(columns=[column]).assign(**{f"rot_{i}": q[:, i] for i in range(4)})

    kept = [f for f in df.schema.fields if f.name != column]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), *(f"rot_{i} double" for i in range(4))])
    return df.mapInPandas(made, schema)


def _product_matrix(q: np.ndarray, side: int) -> np.ndarray:
    """4x4 matrices of quaternion products (w first): by q from the left (side 1), by its conjugate from the right (side -1)."""
    w, v = q[:, 0], q[:, 1:]
    out = np.zeros((len(q), 4, 4))
    out[:, range(4), range(4)] = w[:, None]
    out[:, 1:, 0] = side * v
    out[:, 0, 1:] = -side * v
    for i, j, k in ((0, 1, 2), (1, 2, 0), (2, 0, 1)):
        out[:, 1 + j, 1 + k] -= v[:, i]
        out[:, 1 + k, 1 + j] += v[:, i]
    return out


def view_stretch(cameras: DataFrame, kx: float, ky: float) -> np.ndarray:
    """3x3 stretch by kx and ky along the mean camera's axes; one summed rotation comes to the driver."""
    sums = cameras.agg(*(F.avg(F.col("c2w")[4 * i + j]) for i in range(3) for j in range(3))).first()
    u, _, vt = np.linalg.svd(np.array([float(x) for x in sums]).reshape(3, 3))
    return (u @ vt) @ np.diag([kx, ky, 1.0]) @ (u @ vt).T


def slice_4d_covariance(splats4d: DataFrame, boost: float = 1.0, stretch: np.ndarray | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """velocity, t_sigma, rotation and log scales of raw 4D splats, by conditioning on time; columns of ``carry`` come along.

    ``log_scale`` (3), ``log_scale_t``, ``rot_l`` and ``rot_r`` (4, w first) give the covariance of the rotor
    (its axes in reverse order, time last); its time row gives velocity and duration, the Schur complement the shape.
    """

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = {c: batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) for c in ("rot_l", "rot_r", "log_scale")}
            unit = {c: raw[c] / np.maximum(np.linalg.norm(raw[c], axis=1, keepdims=True), 1e-12) for c in ("rot_l", "rot_r")}
            rotor = _product_matrix(unit["rot_l"], 1) @ _product_matrix(unit["rot_r"], -1)
            axes = rotor[:, ::-1, ::-1] * np.exp(np.column_stack((raw["log_scale"], batch.column("log_scale_t").to_numpy(zero_copy_only=False))))[:, None, :]
            cov = axes @ axes.transpose(0, 2, 1)
            tt = np.maximum(cov[:, 3, 3], 1e-12)
            velocity = cov[:, :3, 3] / tt[:, None]
            shape = cov[:, :3, :3] - velocity[:, :, None] * cov[:, None, :3, 3]
            if stretch is not None:
                shape = stretch @ shape @ stretch.T
            values, vectors = np.linalg.eigh(shape)
            vectors[:, :, 2] *= np.where(np.linalg.det(vectors) < 0, -1.0, 1.0)[:, None]
            made = (velocity, np.sqrt(tt)[:, None], quat_from_matrix(vectors), 0.5 * np.log(np.maximum(values, 1e-18)) + np.log(max(boost, 1e-6)))
            columns = [pa.array(np.ascontiguousarray(c)) for c in np.concatenate(made, axis=1).T]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept_columns), *columns], names=[*kept_columns, *names])

    names = ["vx", "vy", "vz", "t_sigma", *(f"rot_{i}" for i in range(4)), *(f"scale_{i}" for i in range(3))]
    kept_columns, types = ["clip_id", "splat_id", *carry], dict(splats4d.dtypes)
    schema = ", ".join(["clip_id long", "splat_id long", *(f"`{c}` {types[c]}" for c in carry), *(f"{n} double" for n in names)])
    typed = lambda c, t: F.col(c).cast(t).alias(c)
    given = splats4d.select(*(typed(c, "long") for c in ("clip_id", "splat_id")), *carry, *(typed(c, "array<double>") for c in ("log_scale", "rot_l", "rot_r")), typed("log_scale_t", "double"))
    return given.mapInArrow(sliced, schema)


def fold_temporal_sh(splats4d: DataFrame) -> DataFrame:
    """dc and rest with the two temporal bands (each of 16) added on: dc + rest[15] + rest[31], rest[k] + rest[k+16] + rest[k+32]."""
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    dc = add(add(F.col("dc"), F.col("rest")[15]), F.col("rest")[31])
    rest = F.transform(F.sequence(F.lit(0), F.lit(14)), lambda k: add(add(F.get("rest", k), F.get("rest", k + 16)), F.get("rest", k + 32)))
    return splats4d.withColumn("dc", dc).withColumn("rest", rest)
