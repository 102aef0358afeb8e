"""Parts of masks and the keypoints on them, found image by image, against plain Python."""

import random

from rigspark.operators import components
from rigspark.plans import jobs


def _parts(runs):
    """The least (y, x0) reachable from each run of one image."""
    label = {r: r[:2] for r in runs}
    changed = True
    while changed:
        changed = False
        for a in runs:
            for b in runs:
                if abs(a[0] - b[0]) == 1 and a[1] <= b[2] and b[1] <= a[2] and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


def _images():
    rng = random.Random(11)
    images = {}
    for i in range(40):
        runs = set()
        for y in range(rng.randint(1, 9)):
            x = rng.randint(-2, 4)
            while x < 25 and rng.random() < 0.8:
                stop = x + rng.randint(0, 6)
                runs.add((y, x, stop))
                x = stop + rng.randint(1, 5)
        images[i // 8, f"cam_{i % 8}"] = sorted(runs)
    images[9, "cam_0"] = [(y, 5 * (y % 2), 5 + 5 * (y % 2)) for y in range(60)] + [(y, 40 if y % 2 else 30, 40) for y in range(60)]  # long snakes
    return images


def test_parts_and_hits(spark, monkeypatch):
    images = _images()
    rows = [(*k, *r, f"{r}") for k, runs in images.items() for r in runs]
    random.Random(3).shuffle(rows)
    runs = spark.createDataFrame(rows, "capture_id long, camera_label string, y int, x0 int, x1 int, extra string")
    keys = ["capture_id", "camera_label"]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)  # images go on over many batches
    monkeypatch.setattr(components, "cut", None)  # no rounds that write tables
    try:
        labelled = components.mask_components(runs, keys)
        want = {k: _parts(r) for k, r in images.items()}
        got = labelled.collect()
        assert len(got) == len(rows) and all(r.extra == str((r.y, r.x0, r.x1)) for r in got)
        assert all(r.label == (p[0] << 32) + p[1] for r in got for p in [want[r.capture_id, r.camera_label][r.y, r.x0, r.x1]])
        rng = random.Random(5)
        marks = [(*k, rng.randint(-1, 20), rng.randint(0, 8)) for k in list(images) + [(77, "cam_0")] for _ in range(rng.randint(0, 5))] + [(0, "cam_1", None, 3)]
        points = spark.createDataFrame(marks, "capture_id long, camera_label string, px int, py int")
        kept, counts = components.component_hits(labelled, points, keys, 2)
        hits, on = {}, {}
        for c, l, px, py in marks:
            for r, part in want.get((c, l), {}).items():
                if px is not None and r[0] == py and r[1] <= px <= r[2]:
                    hits[c, l, part] = hits.get((c, l, part), 0) + 1
                    on.setdefault((c, l), []).append(part)
        good = {k for k, n in hits.items() if n >= 2}
        assert good and len(good) < len(hits)
        assert sorted((r.capture_id, r.camera_label, r.y, r.x0) for r in kept.collect()) == sorted((*k, *r[:2]) for k, of in want.items() for r, part in of.items() if (*k, part) in good)
        total = {(r.capture_id, r.camera_label): (r.components_total, r.components_kept) for r in counts.collect()}
        assert total == {k: (len(set(of.values())), sum(g[:2] == k for g in good)) for k, of in want.items() if of}
        share = {(r.capture_id, r.camera_label): (r.coverage_before, r.coverage_after) for r in components.component_report(labelled, points, keys, 2).collect()}
        number = {k: max(sum(m[:2] == k for m in marks), 1) for k in share}
        assert share == {k: (len(on.get(k, [])) / number[k], sum((*k, part) in good for part in on.get(k, [])) / number[k]) for k in share}
        assert components.mask_components(runs.limit(0), keys).count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_clean_masks_report_plans_no_second_layout_of_runs(spark):
    runs = spark.createDataFrame([(1, "a", 0, 0, 3), (1, "a", 2, 0, 3), (1, "b", 0, 0, 3), (2, "a", 0, 0, 3)], "capture_id long, camera_label string, y int, x0 int, x1 int")
    points = spark.createDataFrame([(1, "a", 1.0, 0.0), (1, "a", 9.0, 0.0)], "capture_id long, camera_label string, u double, v double")
    images = spark.createDataFrame([(1, "a", 20, 10), (1, "b", 20, 10)], "capture_id long, camera_label string, w int, h int")
    report = jobs.clean_masks_job(runs, points, images)["report"]
    assert "collect_list" not in report._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, report.drop("retried").collect())) == [(1, "a", 2, 1, 0.5, 0.5, False, True), (1, "b", 1, 0, 0.0, 0.0, True, True)]
