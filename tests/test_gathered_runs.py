"""Runs of masks gathered before they are moved, and packed to the same bits."""

import random

from rigspark.operators import cameras


def test_masks_scattered_over_batches(spark, monkeypatch):
    rng = random.Random(7)
    sizes = {(c, f"cam_{k}"): (rng.randint(5, 150), rng.randint(4, 20)) for c in range(3) for k in range(4)}
    rows, want = [], {}
    for (c, l), (w, h) in sizes.items():
        for frame in range(3):
            on = want.setdefault((c, l, frame), set())
            for _ in range(rng.randint(1, 12)):
                y, x0 = rng.randint(-1, h), rng.randint(-3, w)
                x1 = x0 + rng.randint(-1, 9)
                rows.append((c, l, frame, y, x0, x1))
                on |= {(y, x) for x in range(max(x0, 0), min(x1, w - 1) + 1) if 0 <= y < h}
    rows += [(0, "cam_0", 0, 1, None, 3), (7, "no_camera", 0, 1, 1, 1)]
    rng.shuffle(rows)
    runs = spark.createDataFrame(rows, "capture_id long, camera_label string, frame_idx int, y int, x0 int, x1 int").repartition(5)
    given = spark.createDataFrame([(c, l, w, h) for (c, l), (w, h) in sizes.items()], "capture_id long, camera_label string, w int, h int")
    monkeypatch.setattr(cameras, "UNFOLDED_RUNS", 6)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 11)
    try:
        got = cameras.bit_masks(given, runs, "frame_idx").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == len(want)
    for r in got:
        w, h = sizes[r.capture_id, r.camera_label]
        line = -(-w // 64)
        assert len(r.words) == h * line
        assert {(y, x) for y in range(h) for x in range(w) if r.words[y * line + x // 64] >> (x % 64) & 1} == want[r.capture_id, r.camera_label, r.frame_idx]


def test_a_mask_moves_as_one_row(spark):
    runs = spark.range(0, 5000, 1, 1).selectExpr("id div 500 as capture_id", "'cam' as camera_label", "cast(id % 500 as int) as y", "3 as x0", "40 as x1")
    moved = cameras.gathered_runs(runs, ["capture_id", "camera_label"]).selectExpr("count(*) as rows", "sum(n) as n", "sum(length(runs)) as bytes").first()
    assert (moved.rows, moved.n) == (10, 5000) and moved.bytes < 5000
