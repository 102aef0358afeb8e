"""Geometry of cameras and splats as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SH_C0 = 0.28209479177387814


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def colour(channel: int) -> Column:
    """Colour of one channel from its raw harmonic coefficient."""
    return F.lit(0.5) + F.lit(SH_C0) * F.col(f"f_dc_{channel}")


def dt(t: Column | float) -> Column:
    return (t if isinstance(t, Column) else F.lit(float(t))) - F.col("t_center")


def position_at(axis: str, t: Column | float, accel: bool = False) -> Column:
    d = dt(t)
    moved = F.col(axis) + F.col(f"v{axis}") * d
    return moved + F.coalesce(F.col(f"a{axis}"), F.lit(0.0)) * d * d if accel else moved


def temporal_weight(t: Column | float, floor: float = 1e-6) -> Column:
    r = dt(t) / F.greatest(F.abs("t_sigma"), F.lit(floor))
    return F.exp(F.lit(-0.5) * r * r)


def alpha_at(t: Column | float, floor: float = 1e-6) -> Column:
    return sigmoid(F.col("opacity")) * temporal_weight(t, floor)


def with_world_to_camera(cameras: DataFrame) -> DataFrame:
    """Adds r00..r22 and tx,ty,tz of the rigid inverse of ``c2w`` (row-major, 16 values, y and z axes turned)."""
    m = lambda i, j: F.col("c2w")[4 * i + j]
    turned = {0: 1.0, 1: -1.0, 2: -1.0}
    r = {(i, j): F.lit(turned[i]) * m(j, i) for i in range(3) for j in range(3)}
    out = cameras.select("*", *(r[i, j].alias(f"r{i}{j}") for i in range(3) for j in range(3)))
    for i, name in enumerate(("tx", "ty", "tz")):
        out = out.withColumn(name, -(F.col(f"r{i}0") * m(0, 3) + F.col(f"r{i}1") * m(1, 3) + F.col(f"r{i}2") * m(2, 3)))
    return out


def project(x: Column, y: Column, z: Column, min_depth: float) -> tuple[Column, Column, Column]:
    """u, v and depth; u and v are null nearer than ``min_depth``."""
    row = lambda i, t: F.col(f"r{i}0") * x + F.col(f"r{i}1") * y + F.col(f"r{i}2") * z + F.col(t)
    depth = row(2, "tz")
    front = depth > F.lit(min_depth)
    u = F.when(front, F.col("fl_x") * row(0, "tx") / depth + F.col("cx"))
    v = F.when(front, F.col("fl_y") * row(1, "ty") / depth + F.col("cy"))
    return u, v, depth


def truncated_pixel(x: Column) -> Column:
    """Pixel of a projection: towards zero."""
    return F.when(x >= 0, F.floor(x)).otherwise(F.ceil(x)).cast("int")


def rounded_pixel(x: Column, size: Column | int) -> Column:
    """Pixel of a keypoint: nearest, ties to even, clipped into the image."""
    last = (size if isinstance(size, Column) else F.lit(size)) - 1
    return F.least(F.greatest(F.rint(x), F.lit(0.0)), last.cast("double")).cast("int")


def rotation_angle_deg(trace: Column) -> Column:
    return F.degrees(F.acos(F.greatest(F.least((trace - 1.0) / 2.0, F.lit(1.0)), F.lit(-1.0))))


def quaternion_angle_deg(dot: Column) -> Column:
    return F.degrees(F.lit(2.0) * F.acos(F.least(F.abs(dot), F.lit(1.0))))


def huber(residual: Column, d: float) -> Column:
    size = F.abs(residual)
    return F.when(size <= d, residual).otherwise(F.signum(residual) * F.sqrt(F.lit(d) * (F.lit(2.0) * size - F.lit(d))))


def normalised_quaternion() -> list[Column]:
    """rot_0..rot_3 divided by their norm."""
    norm = F.sqrt(sum((F.col(f"rot_{i}") * F.col(f"rot_{i}") for i in range(4)), F.lit(0.0)))
    return [(F.col(f"rot_{i}") / F.greatest(norm, F.lit(1e-12))).alias(f"rot_{i}") for i in range(4)]


def determinant3(m: list[Column]) -> Column:
    return (
        m[0] * (m[4] * m[8] - m[5] * m[7]) - m[1] * (m[3] * m[8] - m[5] * m[6]) + m[2] * (m[3] * m[7] - m[4] * m[6])
    )


def scaled_intrinsics(k: float, rounded: bool) -> list[Column]:
    """fl, cx, cy divided by ``k``; width and height floor-divided, or rounded for scoring."""
    size = (lambda c: F.rint(F.col(c) / k).cast("int")) if rounded else (lambda c: F.floor(F.col(c) / k).cast("int"))
    return [*((F.col(c) / k).alias(c) for c in ("fl_x", "fl_y", "cx", "cy")), size("w").alias("w"), size("h").alias("h")]


def distorted(x: Column, y: Column, model: str, k: list[Column]) -> tuple[Column, Column]:
    """Normalised coordinates as a lens of the model shows them: ``pinhole``, ``polynomial`` (k1, k2, p1, p2) or ``fisheye`` (k1..k4)."""
    r2 = x * x + y * y
    if model == "pinhole":
        return x, y
    if model == "polynomial":
        radial = 1.0 + k[0] * r2 + k[1] * r2 * r2
        return x * radial + 2.0 * k[2] * x * y + k[3] * (r2 + 2.0 * x * x), y * radial + k[2] * (r2 + 2.0 * y * y) + 2.0 * k[3] * x * y
    if model == "fisheye":
        r = F.sqrt(r2)
        a = F.atan(r)
        a2 = a * a
        turned = a * (1.0 + a2 * (k[0] + a2 * (k[1] + a2 * (k[2] + a2 * k[3]))))
        scale = F.when(r > 1e-12, turned / F.greatest(r, F.lit(1e-12))).otherwise(1.0)
        return x * scale, y * scale
    raise ValueError(f"unknown lens model {model}")


def undistort_map(px: Column, py: Column, target: dict[str, Column], native: dict[str, Column], model: str, k: list[Column]) -> tuple[Column, Column]:
    """The native pixel that each pixel of an undistorted image shows; both cameras by fl_x, fl_y, cx, cy."""
    u, v = distorted((px - target["cx"]) / target["fl_x"], (py - target["cy"]) / target["fl_y"], model, k)
    return native["fl_x"] * u + native["cx"], native["fl_y"] * v + native["cy"]
