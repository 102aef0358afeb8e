"""Votes and observations of the whole rig against brute force over all cameras."""

from collections import Counter

import numpy as np
import pytest

from rigspark.plans import fixtures as X
from rigspark.plans.queries import QUERIES

SIN, COS = [0.8, 0.6, 0.8, -0.8], [0.6, 0.8, -0.6, 0.6]


@pytest.fixture(scope="module")
def cameras(spark, sf_dir):
    return sorted(r.n_nationkey for r in spark.read.parquet(f"{sf_dir}/nation.parquet").collect())


def seen(n, capture, x, y, z):
    """u, v and depth of points in camera ``n`` of their capture, which stands 60 units off and looks at the origin."""
    k = (n + capture) % 4
    c, s = np.array(COS)[k], np.array(SIN)[k]
    tx, tz = -(c * (60 * s) + s * (-(60 * c))), -(-s * (60 * s) + c * (-(60 * c)))
    depth = -s * x + c * z + tz
    return 80 * (c * x + s * z + tx) / depth + 48, 80 * y / depth + 32, depth


def counted(cameras, capture, x, y, z, near, wide=0):
    """How many masks of its capture see each point, and how many of them see it inside."""
    tested, inside = np.zeros(len(x), int), np.zeros(len(x), int)
    for n in cameras:
        u, v, depth = seen(n, capture, x, y, z)
        with np.errstate(invalid="ignore"):
            px, py = np.trunc(u).astype(int), np.trunc(v).astype(int)
        ok = (depth > near) & (u >= 0) & (v >= 0) & (px < 96) & (py < 64)
        tested += ok
        inside += ok & (py >= 6) & (py < 58) & (px >= 28 - (n * 3 + py + capture) % 17 + wide) & (px <= 63 + (n + py + capture) % 13)
    return tested, inside


def as_counts(rows, *names):
    return Counter({tuple(r[c] for c in names): r["n"] for r in rows})


def test_votes_of_all_cameras(spark, sf_dir, cameras):
    s = X.splats(spark, sf_dir).toPandas()
    assert s.capture_id.nunique() > 2
    alpha = 1 / (1 + np.exp(-s.opacity))
    live = s[alpha > 0.1]
    tested, inside = counted(cameras, live.capture_id.values, live.x.values, live.y.values, live.z.values, 0.01)
    got = {r.splat_id: (r.capture_id, r.tested, r.outside) for r in QUERIES["splat_mask_votes_rig"](spark, sf_dir).collect()}
    assert got == {i: (c, t, t - k) for i, c, t, k in zip(live.splat_id, live.capture_id, tested, inside, strict=True) if t} and max(t for _, t, _ in got.values()) == len(cameras) == 25
    drop = (tested > 0) & (2 * (tested - inside) >= tested)
    dropped = {r.clip_id: (r.n, r.sum_id) for r in QUERIES["mask_filter"](spark, sf_dir).collect()}
    assert dropped == {c: (len(g), g.splat_id.sum()) for c, g in live[drop].groupby("clip_id")}

    total = np.zeros((2, len(s)), int)
    for k in range(10):
        t = 0.5 + k - s.t_center
        on = (alpha > 0.02) & (alpha * np.exp(-0.5 * (t / np.maximum(abs(s.t_sigma), 1e-9)) ** 2) > 0.02)
        moved = [(s[a] + s[f"v{a}"] * t).values for a in "xyz"]
        total += np.array(counted(cameras, s.capture_id.values, *moved, 0.05, wide=k)) * on.values
    want = Counter((c, t, t - i) for c, t, i in zip(s.clip_id, *total, strict=True) if t)
    assert as_counts(QUERIES["lifetime_votes"](spark, sf_dir).collect(), "clip_id", "tested", "outside") == want


def test_hull_of_all_cameras(spark, sf_dir, cameras):
    p = X.derive(spark, sf_dir, X.POINTS).toPandas()
    _, inside = counted(cameras, p.capture_id.values, p.x.values, p.y.values, p.z.values, 0.05)
    got = as_counts(QUERIES["hull_votes"](spark, sf_dir).collect(), "tem", "votes")
    assert got == Counter((tem, v) for tem, v in zip(p.tem, inside, strict=True) if v >= 5) and max(v for _, v in got) > 8


def test_points_are_observed_by_all_that_see_them(spark, sf_dir, cameras):
    p = X.derive(spark, sf_dir, X.POINTS).toPandas()
    views = {n: seen(n, p.capture_id.values, p.x.values, p.y.values, p.z.values) for n in cameras}
    inside = {n: (d > 1e-6) & (u >= 0) & (u < 96) & (v >= 0) & (v < 64) for n, (u, v, d) in views.items()}
    obs = X.derive(spark, sf_dir, X.OBSERVATIONS).toPandas()
    assert set(zip(obs.kp_idx, obs.camera_label, strict=True)) == {(k, f"cam_{n}") for n in cameras for k in p.kp_idx[inside[n]]}
    report = Counter()
    for r in QUERIES["residual_report"](spark, sf_dir).collect():
        report[r.camera_label] += r.n
    assert report == Counter({None: len(obs)} | {f"cam_{n}": inside[n].sum() for n in cameras})

    sure = p.kp_idx.values % 10 / 10 + 0.05 >= 0.5
    want = {k: n for k, n, y in zip(p.kp_idx, sum(inside.values()), sure, strict=True) if y and n >= 3}
    rows = QUERIES["triangulate"](spark, sf_dir).collect()
    assert {r.kp_idx: r.n_views for r in rows} == want and min(want.values()) > 9
