"""Operators that rank, match or broadcast in ways that do not depend on one task, against plain Python."""

import random

from pyspark.sql import functions as F

from rigspark.operators import cameras, scratch, splats


def test_every_nth_row_of_a_hot_group(spark):
    """One group of 200,000 rows, a small one and rows without a group."""
    df = spark.range(200_000).select(F.lit(1).alias("clip_id"), "id").unionByName(spark.createDataFrame([(2, 5), (2, 9), (None, 7), (None, 8)], "clip_id int, id long"))
    got = splats.sample_every(df.withColumn("extra", F.lit("x")), 1000, ["clip_id"], ["id"])
    assert got.columns == ["clip_id", "id", "extra"]
    assert {(r.clip_id, r.id) for r in got.collect()} == {(1, i) for i in range(0, 200_000, 1000)} | {(2, 5), (None, 7)}
    assert splats.sample_every(df.limit(0), 3, ["clip_id"], ["id"]).count() == 0


def test_names_inside_names(spark):
    """Labels inside stems and stems inside labels, repeated pieces, ties of length, and names without a match."""
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abc") for _ in range(n))
    labels = sorted({word(rng.randint(1, 6)) for _ in range(40)} - {"a", "b", "c"} | {"zz", "lone"})
    stems = sorted({word(rng.randint(1, 9)) for _ in range(80)} | {"zzzz", "one", "q"})
    got = cameras.match_camera(spark.createDataFrame([(f"shots/{s}.png",) for s in stems], "image string"), spark.createDataFrame([(c,) for c in labels], "camera_label string"))
    want = {}
    for s in stems:
        held = [c for c in labels if c in s or s in c]
        if s in labels:
            want[s] = (s, "exact")
        elif held:
            want[s] = (min(held, key=lambda c: (-len(c), c)), "part")
    assert {r.image.removeprefix("shots/").removesuffix(".png"): (r.camera_label, r.rule) for r in got.collect()} == want
    assert {rule for _, rule in want.values()} == {"exact", "part"} and "q" not in want


def test_rigs_beyond_the_bound_are_not_broadcast(spark, monkeypatch):
    rig = spark.range(50).withColumn("v", F.col("id") * 2)
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(scratch.small(rig, 2))
    monkeypatch.setattr(scratch, "MOST_NUMBERS", 99)
    assert not hinted(scratch.small(rig, 2))
    assert spark.range(50).join(scratch.small(rig, 2), "id").agg(F.sum("v")).first()[0] == 2450
