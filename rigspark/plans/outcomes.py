"""Queries of jobs whose outcomes differ: masks emptied and low, gates passed, failed and skipped, and codebooks through packing and back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import quantize
from ..sources import tables
from . import fixtures as X
from . import jobs
from . import queries as Q
from .further import _folder, _table, lloyd
from .queries import STEP, T0, T1, query


@query(  # keypoints beside the mask, half and a tenth of them beside it, or all inside
    "mask_flags",
    """SELECT capture_id, camera_label, CAST(3 + n % 2 AS BIGINT) AS components_total, CAST(CASE WHEN n % 5 = 0 THEN 0 ELSE 1 END AS BIGINT) AS components_kept, share AS coverage_before, share AS coverage_after,
    n % 4 = 0 AS retried, n % 5 = 0 AS emptied, n % 5 < 2 AS low_coverage FROM (SELECT *, CASE n % 5 WHEN 0 THEN 0e0 WHEN 1 THEN 5e-1 WHEN 2 THEN 9e-1 ELSE 1e0 END AS share FROM
    (SELECT DISTINCT capture_id, camera_label, CAST(substr(camera_label, 5) AS INT) AS n FROM runs))""",
    runs=X.RUNS,
)
def _(spark, d):
    n, y = text.trailing_id(F.col("camera_label")), F.col("y")
    rows = F.when(n % 5 == 0, y == 30).when(n % 5 == 1, y.isin(6, 10)).when(n % 5 == 2, (y == 6) | y.between(10, 18)).otherwise(y == 10)
    hits = X.derive(spark, d, X.RUNS).filter(rows).select("capture_id", "camera_label", (F.col("x0") + 3.2).alias("u"), (F.when(y == 6, 2).otherwise(y) - 0.4).alias("v"))
    images = Q._images(spark, d)
    return jobs.clean_masks_job(Q._parted(spark, d), hits, images, retried=images.filter(n % 4 == 0))["report"]


_COVER = "SELECT concat('cam_', CAST(o_custkey % 12 AS STRING)) AS camera_label, avg((o_orderkey % 10) / 1e1) AS coverage FROM orders GROUP BY o_custkey % 12"
#: Baselines: of the first nine cameras, half of them far off, and of one figure of the run each way.
_GOLD = "SELECT 'mask_coverage' AS metric, concat('cam_', CAST(i AS STRING)) AS camera, CASE WHEN i % 2 = 0 THEN c.coverage + 4e-3 ELSE c.coverage - 6e-3 END AS base FROM range(9) r(i) JOIN cover c ON c.camera_label = concat('cam_', CAST(i AS STRING))"


@query(
    "evaluate_gate",
    """SELECT 'gate' AS part, m.metric, m.camera, round(m.value, 6) AS value, CASE WHEN m.metric = 'eval4d_psnr_db' THEN 'fail' WHEN m.metric <> 'mask_coverage' THEN 'pass' WHEN base IS NULL THEN 'skip' WHEN abs(m.value - base) <= 5e-3 THEN 'pass' ELSE 'fail' END AS status
    FROM figures m LEFT JOIN gold g ON g.metric = m.metric AND g.camera = m.camera
    UNION ALL SELECT 'run', metric, NULL, value, NULL FROM (SELECT metric, value FROM figures WHERE camera IS NULL UNION ALL SELECT 'mask_coverage_avg', round(avg(coverage), 4) FROM cover UNION ALL SELECT 'eval4d_ssim', round(avg(ssim), 4) FROM views UNION ALL SELECT 'eval4d_lpips', round(avg(lpips), 4) FROM views)""",
    views=X.VIEWS, cover=_COVER, gold=_GOLD,
    figures="SELECT 'median_reprojection_error_px' AS metric, NULL AS camera, round(max(o_orderkey % 100) / 8e0, 2) AS value FROM orders UNION ALL SELECT 'eval4d_psnr_db', NULL, round(avg(psnr_db), 2) FROM views UNION ALL SELECT 'mask_coverage', camera_label, coverage FROM cover",
)
def _(spark, d):
    orders, views = _table(spark, d, "orders"), X.derive(spark, d, X.VIEWS)
    cover = X.derive(spark, d, _COVER)
    # of all cameras and of one: the run's figure is that of all
    top = orders.agg((F.max(F.col("o_orderkey") % 100) / 8.0).alias("median"))
    report = top.select(F.lit(None).cast("string").alias("camera_label"), "median").unionByName(top.select(F.lit("cam_1").alias("camera_label"), (F.col("median") * 2).alias("median")))
    i = text.trailing_id(F.col("camera_label"))
    of_cameras = cover.filter(i < 9).select(F.lit("mask_coverage").alias("metric"), F.col("camera_label").alias("camera"), (F.col("coverage") + F.when(i % 2 == 0, 4e-3).otherwise(-6e-3)).alias("value"))
    none = F.lit(None).cast("string").alias("camera")
    of_run = views.agg((F.avg("psnr_db") + 2.5).alias("value")).select(F.lit("eval4d_psnr_db").alias("metric"), none, "value")
    of_error = top.select(F.lit("median_reprojection_error_px").alias("metric"), none, (F.col("median") - 0.5).alias("value"))
    pixels = views.select(F.col("doc_id").alias("view"), F.lit(0).alias("x"), F.lit(0).alias("y"), *(F.lit(1).alias(c) for c in "rgb"))
    out = jobs.evaluate_job(pixels, pixels, ["view"], report, cover, views, of_cameras.unionByName(of_run).unionByName(of_error))
    gate = out["gate"].select(F.lit("gate").alias("part"), "metric", "camera", F.round("value", 6).alias("value"), "status")
    names = ["median_reprojection_error_px", "mask_coverage_avg", "eval4d_psnr_db", "eval4d_ssim", "eval4d_lpips"]
    run = out["run"].select(F.explode(F.array(*(F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names))).alias("r")).select("r.*")
    return gate.unionByName(run.select(F.lit("run").alias("part"), "metric", none, "value", F.lit(None).cast("string").alias("status")))


#: Times in 256ths and sizes in halves, whose sums are exact; a codebook's key is its clip and attribute.
_STEPPED = "SELECT clip_id, splat_id, floor(t_center * 2.5e2 + 5e-1) / 2.56e2 AS t_center, floor(scale_0 * 2 + 5e-1) / 2 AS scale_0, scale_1, floor(scale_2 * 2 + 5e-1) / 2 AS scale_2"
_LONG = f"SELECT clip_id * 2 AS key, splat_id, 't_center' AS name, t_center AS value FROM s UNION ALL SELECT clip_id * 2 + 1, splat_id, unnest(['scale_0', 'scale_1', 'scale_2']), unnest([scale_0, scale_1, scale_2]) FROM s"
_CODED = (
    f"SELECT key // 2 AS clip_id, splat_id, " + ", ".join(f"max(CASE WHEN name = '{c}' THEN idx END) AS {c}_i, max(CASE WHEN name = '{c}' THEN round(value, 6) + 0e0 END) AS {c}" for c in ("t_center", "scale_0", "scale_1", "scale_2"))
    + f" FROM (SELECT l.key, l.splat_id, l.name, CAST(e.idx AS INT) AS idx, e.value FROM (WITH s AS ({_STEPPED} FROM ({X.SPLATS})) {_LONG}) l"
    " ASOF JOIN (SELECT *, coalesce((value + lag(value) OVER (PARTITION BY clip_id ORDER BY idx)) / 2e0, -1e300) AS low FROM book) e ON e.clip_id = l.key AND l.value > e.low) GROUP BY key // 2, splat_id"
)


@query(  # trained, packed, written, read and decoded: the indices of every splat and what they stand for
    "pack_codebooks",
    lloyd(16, 16, f"WITH s AS ({_STEPPED} FROM ({X.SPLATS})) SELECT key AS clip_id, value, count(*) AS n FROM ({_LONG}) GROUP BY key, value", _CODED),
)
def _(spark, d):
    half = lambda c: (F.floor(F.col(c) * 2 + 0.5) / 2).alias(c)
    s = X.splats(spark, d).withColumns({"t_center": F.floor(F.col("t_center") * 250 + 0.5) / 256, "scale_0": half("scale_0"), "scale_2": half("scale_2")})
    path = _folder(spark)
    tables.write_quantized(quantize.pack(s, T0, T1, STEP, k=16), path)
    q = tables.read_quantized(spark, path)
    coded = ("t_center", "scale_0", "scale_1", "scale_2")
    back = quantize.dequantise(q["planes"], q["ranges"], q["codebooks"]).select("clip_id", "splat_id", *((F.round(c, 6) + 0.0).alias(c) for c in coded))
    indices = q["planes"].select("clip_id", "splat_id", *(F.col(f"{c}_i").cast("int").alias(f"{c}_i") for c in coded))
    return indices.join(back, ["clip_id", "splat_id"]).withColumn("clip_id", F.col("clip_id").cast("long"))
