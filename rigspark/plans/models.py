"""Queries of raw 4D models: the whole slice by time, and colours of a small network, each against matrix arithmetic in SQL."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import poses
from ..operators.appearance import TwoLayers, bake_appearance
from . import fixtures as X
from .queries import query

_PAIRS = [(i, j) for i in range(3) for j in range(i, 3)]
#: Stretch along the mean camera's axes, and growth of all axes.
_KX, _KY, _BOOST = 1.5, 0.75, 2.0


def _sum(terms) -> str:
    return "(" + " + ".join(terms) + ")"


def _slice_sql() -> dict[str, str]:
    """Named steps from quaternions to the stretched covariance."""
    unit = {s: f"sqrt({_sum(f'rot_{i} * rot_{i}' for i in range(4))})" for s in "lr"}
    lw, lx, ly, lz = (f"l{i}" for i in range(4))
    rw, rx, ry, rz = (f"r{i}" for i in range(4))
    left = [[lw, f"-{lx}", f"-{ly}", f"-{lz}"], [lx, lw, f"-{lz}", ly], [ly, lz, lw, f"-{lx}"], [lz, f"-{ly}", lx, lw]]
    right = [[rw, rx, ry, rz], [f"-{rx}", rw, f"-{rz}", ry], [f"-{ry}", rz, rw, f"-{rx}"], [f"-{rz}", f"-{ry}", rx, rw]]
    rotor = ", ".join(f"{_sum(f'({left[i][k]}) * ({right[k][j]})' for k in range(4))} AS m{3 - i}{3 - j}" for i in range(4) for j in range(4))
    scale = ["exp(scale_0)", "exp(scale_1)", "exp(scale_2)", "t_sigma"]
    cov = ", ".join(f"{_sum(f'm{i}{k} * m{j}{k} * {scale[k]} * {scale[k]}' for k in range(4))} AS c{i}{j}" for i in range(4) for j in range(4))
    schur = ", ".join(f"c{i}{j} - c{i}3 * c{j}3 / greatest(c33, 1e-12) AS s{i}{j}" for i in range(3) for j in range(3))
    stretch = [[f"({_KX} * p * p + q * q)", "0e0", f"({_KX} - 1) * p * q"], ["0e0", f"{_KY}", "0e0"], [f"({_KX} - 1) * p * q", "0e0", f"({_KX} * q * q + p * p)"]]
    shaped = ", ".join(f"{_BOOST**2} * {_sum(f'{stretch[i][a]} * s{a}{b} * {stretch[j][b]}' for a in range(3) for b in range(3))} AS e{i}{j}" for i, j in _PAIRS)
    return {
        "unit": "SELECT *, " + ", ".join(f"rot_{i} / {unit['l']} AS l{i}, rot_{(i + 1) % 4} / {unit['r']} AS r{i}" for i in range(4)) + " FROM splats",
        "rotors": f"SELECT *, {rotor} FROM unit",
        "covariances": f"SELECT clip_id, splat_id, {cov} FROM rotors",
        "schur": f"SELECT *, {schur} FROM covariances",
        "mean_camera": "SELECT a / sqrt(a * a + b * b) AS p, b / sqrt(a * a + b * b) AS q FROM (SELECT avg(c) AS a, avg(s) AS b FROM rig)",
        "shaped": f"SELECT clip_id, splat_id, c03, c13, c23, c33, {shaped} FROM schur CROSS JOIN mean_camera",
    }


@query(  # quaternion and scales are judged by the covariance that they make again
    "slice_4d_whole",
    "SELECT clip_id, splat_id, " + ", ".join(f"round(c{i}3 / greatest(c33, 1e-12), 5) + 0e0 AS v{a}" for i, a in enumerate("xyz")) + ", round(sqrt(greatest(c33, 1e-12)), 7) + 0e0 AS t_sigma, "
    + ", ".join(f"round(e{i}{j} / (e00 + e11 + e22), 5) + 0e0 AS e{i}{j}" for i, j in _PAIRS) + ", round(ln(e00 + e11 + e22), 6) + 0e0 AS log_trace FROM shaped",
    splats=X.SPLATS, rig=X.RIG, **_slice_sql(),
)
def _(spark, d):
    quat = lambda k: F.array(*(F.col(f"rot_{(i + k) % 4}") for i in range(4)))
    raw = X.splats(spark, d).select("clip_id", "splat_id", F.array("scale_0", "scale_1", "scale_2").alias("log_scale"), F.log("t_sigma").alias("log_scale_t"), quat(0).alias("rot_l"), quat(1).alias("rot_r"))
    made = poses.slice_4d_covariance(raw, _BOOST, poses.view_stretch(X.cameras(spark, d), _KX, _KY))
    w, x, y, z = (F.col(f"rot_{i}") for i in range(4))
    axes = [[1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y)], [2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x)], [2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)]]
    again = {f"e{i}{j}": sum((axes[i][k] * axes[j][k] * F.exp(2 * F.col(f"scale_{k}")) for k in range(3)), F.lit(0.0)) for i, j in _PAIRS}
    whole = made.withColumns(again).withColumn("trace", F.col("e00") + F.col("e11") + F.col("e22"))
    return whole.select(
        "clip_id", "splat_id", *((F.round(f"v{a}", 5) + 0.0).alias(f"v{a}") for a in "xyz"), (F.round("t_sigma", 7) + 0.0).alias("t_sigma"),
        *((F.round(F.col(e) / F.col("trace"), 5) + 0.0).alias(e) for e in again), (F.round(F.log("trace"), 6) + 0.0).alias("log_trace"),
    )


_BANDS, _HIDDEN, _INPUTS = 2, 3, 4 * 2 * 2 + 3


def _weights(rows: int, columns: int, turn: int) -> np.ndarray:
    return np.array([[((7 * i + 3 * j + turn * i * j) % 11 - 5) / 8 for j in range(columns)] for i in range(rows)])


#: A network without biases in padded weights, and one with biases.
_NETWORKS = {
    True: TwoLayers(_weights(_HIDDEN, 32, 2), _weights(16, _HIDDEN, 5)),
    False: TwoLayers(_weights(_HIDDEN, _INPUTS, 4), _weights(3, _HIDDEN, 1), _weights(1, _HIDDEN, 0)[0], _weights(1, 3, 0)[0]),
}


def _network_sql(interleaved: bool) -> str:
    net, leak = _NETWORKS[interleaved], 0.01 if interleaved else 0.1
    place = ("px", "py", "pz", "t_center")
    wave = lambda f, c, b: f"{f}(pi() * {c} * {2**b}e0)"
    inputs = [wave(f, c, b) for c in place for b in range(_BANDS) for f in ("sin", "cos")] if interleaved else [wave(f, c, b) for b in range(_BANDS) for f in ("sin", "cos") for c in place]
    inputs += ["a0", "a1", "a2"]
    bias = (lambda v, i: "0e0" if v is None else f"{v[i]}")
    hidden = ", ".join(_sum([*(f"({net.first[h, i]}) * {e}" for i, e in enumerate(inputs)), bias(net.first_bias, h)]) + f" AS u{h}" for h in range(_HIDDEN))
    out = ", ".join("round(" + _sum([*(f"({net.second[c, h]}) * CASE WHEN u{h} > 0 THEN u{h} ELSE {leak} * u{h} END" for h in range(_HIDDEN)), bias(net.second_bias, c)]) + f", 6) + 0e0 AS f_dc_{c}" for c in range(3))
    return f"SELECT {str(interleaved).lower()} AS interleaved, clip_id, splat_id, {out} FROM (SELECT clip_id, splat_id, {hidden} FROM placed)"


_SIZE = "greatest(sqrt(x * x + y * y + z * z), 1e-12)"
_APP = ("opacity / 4e0", "f_dc_0 / 8e0", "vx")
_PLACED = "SELECT clip_id, splat_id, t_center, " + ", ".join(f"CASE WHEN {_SIZE} <= 1 THEN {a} ELSE (2 - 1 / {_SIZE}) * {a} / {_SIZE} END / 4e0 + 5e-1 AS p{a}" for a in "xyz") + ", " + ", ".join(f"{e} AS a{i}" for i, e in enumerate(_APP)) + " FROM splats"


@query("bake_appearance", f"{_network_sql(True)} UNION ALL {_network_sql(False)}", splats=X.SPLATS, placed=_PLACED)
def _(spark, d):
    s = X.splats(spark, d).withColumn("app", F.array(*(F.expr(e) for e in _APP), F.lit(9.0)))  # the fourth feature is not asked for

    def baked(interleaved: bool) -> DataFrame:
        made = bake_appearance(s, _NETWORKS[interleaved], _BANDS, interleaved)
        return made.select(F.lit(interleaved).alias("interleaved"), "clip_id", "splat_id", *((F.round(f"f_dc_{c}", 6) + 0.0).alias(f"f_dc_{c}") for c in range(3)))

    return baked(True).unionByName(baked(False))
