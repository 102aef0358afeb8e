"""Palettes of harmonics in packed splats, and the refilling of empty clusters."""

import numpy as np
from pyspark.sql import functions as F

from rigspark.operators import palettes, quantize
from rigspark.sources import tables

from .test_analytic import random_splats


def test_harmonics_are_packed_and_come_back(spark, tmp_path):
    rng = np.random.default_rng(2)
    vectors = F.array(*(F.array(*(F.lit(float(np.float32(v))) for v in rng.normal(size=45))) for _ in range(10)))
    s = random_splats(spark).withColumn("f_rest", F.when(F.col("splat_id") % 40 != 3, vectors[(F.col("splat_id") % 10).cast("int")])).cache()
    tables.write_quantized(quantize.pack(s, 0.0, 2.0, 0.25, k=256, entries=64), f"{tmp_path}/q")
    again = tables.read_quantized(spark, f"{tmp_path}/q")
    back = {r.splat_id: r.f_rest for r in quantize.dequantise(again["planes"], again["ranges"], again["codebooks"], again["palette"]).collect()}
    given = {r.splat_id: r.f_rest for r in s.collect()}
    assert len(back) == 400 and all((back[i] is None) == (given[i] is None) == (i % 40 == 3) for i in given)
    assert max(np.abs(np.subtract(back[i], given[i])).max() for i in given if given[i]) < 0.02


def test_empty_clusters_are_refilled(spark):
    """Two groups of different sizes at once; half the rows of each are one vector."""
    rng = np.random.default_rng(1)
    rows = [(i % 3 == 0, i, [0.0, 0.0] if i % 2 else [float(x) for x in rng.normal(size=2) * 9]) for i in range(150)]
    df = spark.createDataFrame(rows, "clip_id boolean, id long, v array<double>")
    centroids = palettes.train_palettes(df, "v", "id", 12, 8)
    for clip in (True, False):
        assert len({tuple(r.v) for r in centroids.filter(F.col("clip_id") == clip).collect()}) == 12
    used = palettes.assign_palette(df, "v", "id", centroids, "label").groupBy("clip_id").agg(F.countDistinct("label").alias("n")).collect()
    assert [r.n for r in used] == [12, 12]


def test_groups_without_enough_vectors(spark):
    """Fewer vectors than entries, no vector at all, rows without a vector, and an empty table."""
    rows = [(1, 1, [1.0, 2.0]), (1, 2, [5.0, 2.0]), (1, 3, None), (2, 4, None)]
    df = spark.createDataFrame(rows, "clip_id long, id long, v array<float>")
    centroids = palettes.train_palettes(df, "v", "id", 8, 3)
    assert sorted((r.clip_id, r.entry) for r in centroids.collect()) == [(1, 0), (1, 1)]
    labels = {r.id: r.label for r in palettes.assign_palette(df, "v", "id", centroids, "label").collect()}
    assert labels[3] is None and labels[4] is None and {labels[1], labels[2]} == {0, 1}
    nothing = df.limit(0)
    assert palettes.train_palettes(nothing, "v", "id", 8, 3).count() == 0
    assert palettes.assign_palette(nothing, "v", "id", centroids, "label").count() == 0
