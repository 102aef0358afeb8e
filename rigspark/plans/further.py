"""More registered queries: functions of one row, checks, sources and jobs, each beside the SQL of the same result."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import encoding as E
from ..functions import geometry as G
from ..functions import text
from ..operators import cameras as C
from ..operators import compare, dataset, evaluate, poses, quantize, sync, temporal, validate
from ..operators import splats as S
from ..operators.scratch import shared_dir
from ..sources import ply, tables
from . import fixtures as X
from . import jobs
from . import queries as Q
from .queries import STEP, T0, T1, query


def _table(spark, d, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _folder(spark) -> str:
    """A new folder in the shared one, for what a query writes and reads again."""
    return f"{shared_dir(spark)}/written-{uuid.uuid4().hex}"


# functions of a row

@query(
    "normalised_quaternion",
    "SELECT clip_id, splat_id, " + ", ".join(f"round({q}, 6) + 0e0 AS rot_{i}" for i, q in enumerate(Q._Q)) + " FROM splats",
    splats=X.SPLATS,
)
def _(spark, d):
    unit = X.splats(spark, d).select("clip_id", "splat_id", *G.normalised_quaternion())
    return unit.select("clip_id", "splat_id", *((F.round(f"rot_{i}", 6) + 0.0).alias(f"rot_{i}") for i in range(4)))


@query(  # the quaternion of a quaternion's own matrix, w positive
    "quat_from_matrix",
    "SELECT clip_id, splat_id, " + ", ".join(f"round({q}, 6) + 0e0 AS rot_{i}" for i, q in enumerate(Q._Q)) + " FROM splats",
    splats=X.SPLATS,
)
def _(spark, d):
    w, x, y, z = (F.col(f"rot_{i}") for i in range(4))
    cells = [1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y), 2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x), 2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)]
    unit = X.splats(spark, d).select("clip_id", "splat_id", *G.normalised_quaternion())
    made = poses.quaternions(unit.select("clip_id", "splat_id", F.array(*cells).alias("m")), "m")
    return made.select("clip_id", "splat_id", *((F.round(f"rot_{i}", 6) + 0.0).alias(f"rot_{i}") for i in range(4)))


@query(
    "alpha8",
    f"SELECT clip_id, splat_id, CAST(b AS INT) AS alpha8, round(ln(least(greatest(b / 255e0, 1e-5), 1e0 - 1e-5) / (1e0 - least(greatest(b / 255e0, 1e-5), 1e0 - 1e-5))), 6) + 0e0 AS opacity FROM (SELECT *, round_even(255e0 * {Q._ALPHA}, 0) AS b FROM splats)",
    splats=X.SPLATS,
)
def _(spark, d):
    byte = E.alpha8(F.col("opacity"))
    return X.splats(spark, d).select("clip_id", "splat_id", byte.cast("int").alias("alpha8"), (F.round(E.opacity_of(byte.cast("double")), 6) + 0.0).alias("opacity"))


@query(
    "scale_intrinsics",
    "SELECT capture_id, camera_label, 2.5e1 + n_nationkey AS k_fl, round((8e1 + n_nationkey) / 3e0, 9) AS fl_x, round(4.8e1 / 3e0, 9) AS cx, CAST(floor((96 + n_nationkey) / 3e0) AS INT) AS w, CAST(round_even((96 + n_nationkey) / 3e0, 0) AS INT) AS w_rounded FROM rig",
    rig=X.RIG,
)
def _(spark, d):
    n = F.col("n_nationkey")
    rig = X.cameras(spark, d).withColumns({"fl_x": F.col("fl_x") + n, "w": F.col("w") + n})
    cut = lambda rounded: [c for c in G.scaled_intrinsics(3.0, rounded)]
    floor, near = cut(False), cut(True)
    return rig.select("capture_id", "camera_label", (n + 25.0).alias("k_fl"), F.round(floor[0], 9).alias("fl_x"), F.round(floor[2], 9).alias("cx"), floor[4].alias("w"), near[4].alias("w_rounded"))


@query(
    "huber",
    "SELECT l_returnflag AS flag, l_linenumber AS line, round(sum(CASE WHEN abs(r) <= 5e0 THEN r ELSE sign(r) * sqrt(5e0 * (2e0 * abs(r) - 5e0)) END), 3) AS total FROM (SELECT *, l_quantity - 2.55e1 AS r FROM lineitem) GROUP BY l_returnflag, l_linenumber",
)
def _(spark, d):
    return _table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("flag"), F.col("l_linenumber").alias("line")).agg(F.round(F.sum(G.huber(F.col("l_quantity") - 25.5, 5.0)), 3).alias("total"))


@query(
    "rotation_angle",
    "SELECT clip_id, splat_id, round(degrees(acos(greatest(least(((x / 1e1 - 1e0) - 1e0) / 2e0, 1e0), -1e0))), 5) AS angle FROM splats",
    splats=X.SPLATS,
)
def _(spark, d):
    return X.splats(spark, d).select("clip_id", "splat_id", F.round(G.rotation_angle_deg(F.col("x") / 10.0 - 1.0), 5).alias("angle"))


_LENS = ("1e-1", "1e-2", "1e-3", "2e-3")


@query(
    "undistort_map",
    """SELECT capture_id, kp_idx, round(9e1 * (a * radial + 2e0 * 1e-3 * a * b + 2e-3 * (r2 + 2e0 * a * a)) + 5e1, 6) + 0e0 AS x, round(9e1 * (b * radial + 1e-3 * (r2 + 2e0 * b * b) + 2e0 * 2e-3 * a * b) + 3e1, 6) + 0e0 AS y,
      round(9e1 * (a * CASE WHEN r2 > 0 THEN t * (1e0 + t * t * (1e-1 + t * t * (1e-2 + t * t * (1e-3 + t * t * 2e-3)))) / sqrt(r2) ELSE 1e0 END) + 5e1, 6) + 0e0 AS fish_x
    FROM (SELECT *, 1e0 + 1e-1 * r2 + 1e-2 * r2 * r2 AS radial, atan(sqrt(r2)) AS t FROM (SELECT *, a * a + b * b AS r2 FROM (SELECT capture_id, kp_idx, (x * 1e1 + 4.8e1 - 4.8e1) / 8e1 AS a, (y * 1e1 + 3.2e1 - 3.2e1) / 8e1 AS b FROM points)))""",
    points=X.POINTS,
)
def _(spark, d):
    k = [F.lit(float(v)) for v in _LENS]
    target = {"fl_x": F.lit(80.0), "fl_y": F.lit(80.0), "cx": F.lit(48.0), "cy": F.lit(32.0)}
    native = {"fl_x": F.lit(90.0), "fl_y": F.lit(90.0), "cx": F.lit(50.0), "cy": F.lit(30.0)}
    px, py = F.col("x") * 10.0 + 48.0, F.col("y") * 10.0 + 32.0
    x, y = G.undistort_map(px, py, target, native, "polynomial", k)
    fish, _ = G.undistort_map(px, py, target, native, "fisheye", k)
    return X.derive(spark, d, X.POINTS).select("capture_id", "kp_idx", *((F.round(c, 6) + 0.0).alias(n) for n, c in (("x", x), ("y", y), ("fish_x", fish))))


@query(
    "parse_seconds",
    "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN o_orderkey / 1e3 WHEN 1 THEN o_orderkey / 2e0 WHEN 2 THEN CAST(o_orderkey AS DOUBLE) END AS seconds FROM orders",
)
def _(spark, d):
    k = F.col("o_orderkey")
    written = F.when(k % 4 == 0, F.concat(k.cast("string"), F.lit("ms"))).when(k % 4 == 1, F.concat((k / 2.0).cast("string"), F.lit(" s "))).when(k % 4 == 2, k.cast("string")).otherwise("soon")
    return _table(spark, d, "orders").select("o_orderkey", text.seconds(F.trim(F.regexp_replace(written, " s ", "s"))).alias("seconds"))


@query(
    "parse_metric",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey / 4e0 END AS value FROM orders",
)
def _(spark, d):
    k = F.col("o_orderkey")
    line = lambda v: F.concat(F.lit("median error 9.5 -> "), (v).cast("string"), F.lit(" px\n"))
    log = F.when(k % 5 > 0, F.concat(F.lit("start\n"), line(k / 8.0), F.lit("other 1 -> 2\n"), line(k / 4.0), F.lit("end"))).otherwise("median error none")
    return _table(spark, d, "orders").select("o_orderkey", text.last_change(log, "median error").alias("value"))


@query("sh_palette_size", "SELECT o_orderkey, CAST(least(pow(2e0, ceil(log2(greatest(1024e0, o_orderkey * 37e0 / 16e0)))), 65536e0) AS INT) AS entries FROM orders")
def _(spark, d):
    return _table(spark, d, "orders").select("o_orderkey", E.palette_size(F.col("o_orderkey") * 37.0).alias("entries"))


_PIXEL_ROWS = "SELECT CAST(l_orderkey AS BIGINT) AS view, CAST(l_linenumber AS INT) AS x, CAST(l_partkey % 8 AS INT) AS y, max(CAST(l_quantity AS INT) * 5) AS r, max(CAST(l_partkey % 256 AS INT)) AS g, max(CAST(l_suppkey % 256 AS INT)) AS b, max(CAST(floor(l_extendedprice) AS INT) % 256) AS a FROM lineitem GROUP BY l_orderkey, l_linenumber, l_partkey % 8"


@query(
    "mask_colours",
    "SELECT view, x, y, CASE WHEN fg THEN CAST(floor(r * a / 255e0) AS INT) ELSE 0 END AS r, CASE WHEN fg THEN CAST(floor(g * a / 255e0) AS INT) ELSE 0 END AS g, CASE WHEN fg THEN CAST(floor(b * a / 255e0) AS INT) ELSE 0 END AS b FROM (SELECT *, (x + y) % 3 > 0 AS fg FROM px)",
    px=_PIXEL_ROWS,
)
def _(spark, d):
    px = X.derive(spark, d, _PIXEL_ROWS).withColumn("fg", (F.col("x") + F.col("y")) % 3 > 0)
    cut = dataset.mask_to_alpha(px.drop("a")).withColumnRenamed("a", "on")
    both = cut.join(px.select("view", "x", "y", "a"), ["view", "x", "y"]).withColumn("a", F.when(F.col("on") == 255, F.col("a")).otherwise(0))
    return dataset.composite_black(both).select("view", "x", "y", "r", "g", "b")


_SQUARES = "((r - r2) * (r - r2) + (g - g2) * (g - g2) + (b - b2) * (b - b2))"
_SQUARE = f"{_SQUARES} / 3e0"
_OTHER = "SELECT *, CASE WHEN view % 3 = 0 THEN r ELSE least(r + 4, 255) END AS r2, CASE WHEN view % 3 = 0 THEN g ELSE 255 - g END AS g2, b AS b2 FROM px"


@query(
    "image_psnr",
    f"SELECT view, round(m, 6) AS mse, CASE WHEN m <= 0 THEN CAST('inf' AS DOUBLE) ELSE round(-1e1 * log10(m / (255e0 * 255e0)), 6) END AS psnr_db FROM (SELECT view, sum({_SQUARES}) / (3e0 * count(*)) AS m FROM other WHERE (x + y) % 3 > 0 GROUP BY view)",
    px=_PIXEL_ROWS, other=_OTHER,
)
def _(spark, d):
    px = X.derive(spark, d, _PIXEL_ROWS)
    same = F.col("view") % 3 == 0
    other = px.withColumns({"r": F.when(same, F.col("r")).otherwise(F.least(F.col("r") + 4, F.lit(255))), "g": F.when(same, F.col("g")).otherwise(255 - F.col("g"))})
    mask = px.select("view", "x", "y", ((F.col("x") + F.col("y")) % 3 > 0).alias("fg"))
    mse = evaluate.image_mse(px, other, ["view"], mask)
    return mse.select("view", F.round("mse", 6).alias("mse"), F.round(evaluate.psnr(F.col("mse"), 255.0), 6).alias("psnr_db"))


@query("score_views", "SELECT view, CASE WHEN view % 4 = 1 THEN 'missing' ELSE 'scored' END AS state FROM (SELECT DISTINCT view FROM px)", px=_PIXEL_ROWS)
def _(spark, d):
    rendered = X.derive(spark, d, _PIXEL_ROWS).select("view").distinct()
    scored, missing = evaluate.score_views(rendered, rendered.filter("view % 4 <> 1"), ["view"])
    return scored.withColumn("state", F.lit("scored")).unionByName(missing.withColumn("state", F.lit("missing")))


@query(
    "mask_union",
    "SELECT view, x, y, bool_or(fg) AS fg FROM (SELECT view, x, y, a > 127 AS fg FROM px UNION ALL SELECT view, x + 1, y, b > 60 FROM px WHERE x BETWEEN 2 AND 4) GROUP BY view, x, y",
    px=_PIXEL_ROWS,
)
def _(spark, d):
    px = X.derive(spark, d, _PIXEL_ROWS)
    patch = px.filter("x between 2 and 4").select("view", (F.col("x") + 1).alias("x"), "y", (F.col("b") > 60).alias("fg"))
    return dataset.mask_union(px.withColumn("fg", F.col("a") > 127), patch, ["view"])


# splats and codebooks

_EMB = "CAST(embedding AS DOUBLE[])"


@query(
    "fold_temporal_sh",
    f"SELECT vec_id, round({_EMB}[1] + {_EMB}[16] + {_EMB}[32], 6) + 0e0 AS dc, round(list_sum(list_transform(range(1, 16), lambda k: k * ({_EMB}[k] + {_EMB}[k + 16] + {_EMB}[k + 32]))), 4) + 0e0 AS rest FROM embeddings",
)
def _(spark, d):
    v = F.col("embedding").cast("array<double>")
    rows = _table(spark, d, "embeddings").select("vec_id", F.array(v[0], v[0], v[0]).alias("dc"), F.transform(F.slice(v, 1, 47), lambda x: F.array(x, x * 2, x * 3)).alias("rest"))
    folded = poses.fold_temporal_sh(rows)
    weighted = F.aggregate(F.transform("rest", lambda x, i: (i + 1) * x[0]), F.lit(0.0), lambda a, b: a + b)
    return folded.select("vec_id", (F.round(F.col("dc")[0], 6) + 0.0).alias("dc"), (F.round(weighted, 4) + 0.0).alias("rest"))


_CHANNEL = [f"list_sum(list_transform(range(1, 16), lambda k: abs({_EMB}[k + {15 * c}]) * yb[k]))" for c in range(3)]
_BASES = [f"abs(5e-1 + {G.SH_C0!r}e0 * {_EMB}[{46 + c}])" for c in range(3)]


@query(
    "clamp_sh",
    f"""SELECT vec_id, round(least(1e0, greatest(1.5e0 - greatest({', '.join(_BASES)}), 0e0) / greatest(greatest({', '.join(_CHANNEL)}), 1e-9)), 3) AS scale
    FROM (SELECT *, CAST({S.SH_BOUNDS} AS DOUBLE[]) AS yb FROM embeddings)""",
)
def _(spark, d):
    v = F.col("embedding").cast("array<double>")
    rows = _table(spark, d, "embeddings").select("vec_id", F.slice(v, 1, 45).alias("f_rest"), F.slice(v, 1, 45).alias("given"), *(v[45 + c].alias(f"f_dc_{c}") for c in range(3)))
    out = S.clamp_sh(rows)
    largest = lambda c: F.aggregate(c, F.lit(0.0), lambda a, b: a + F.abs(b).cast("double"))
    return out.select("vec_id", F.round(largest("f_rest") / largest("given"), 3).alias("scale"))


@query("truncate_sh", f"SELECT vec_id, 24 AS n, round(list_sum({_EMB}[1:8]) + list_sum({_EMB}[16:23]) + list_sum({_EMB}[31:38]), 5) + 0e0 AS total FROM embeddings")
def _(spark, d):
    rows = _table(spark, d, "embeddings").select("vec_id", F.slice("embedding", 1, 45).cast("array<double>").alias("f_rest"))
    out = S.truncate_sh(rows, 2)
    return out.select("vec_id", F.size("f_rest").alias("n"), (F.round(F.aggregate("f_rest", F.lit(0.0), lambda a, b: a + b), 5) + 0.0).alias("total"))


@query(
    "assign_codebook",
    "SELECT clip_id, splat_id, CAST(least(greatest(ceil((x - (clip_id * 1e-1 - 2.4e1)) / 7.5e-1 - 5e-1), 0), 63) AS INT) AS idx FROM splats",
    splats=X.SPLATS,
)
def _(spark, d):
    s = X.splats(spark, d)
    book = s.select("clip_id").distinct().select("clip_id", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("idx")).withColumn("value", F.col("clip_id") * 0.1 - 24.0 + F.col("idx") * 0.75)
    return quantize.assign_codebook(s, "x", book, "idx").select("clip_id", "splat_id", F.col("idx").cast("int").alias("idx"))


@query("kmeans_quantiles", " UNION ALL ".join(f"SELECT clip_id, {i} AS idx, round(quantile_cont(v, {i / 15!r}), 6) + 0e0 AS value FROM (SELECT clip_id, unnest([scale_0, scale_1, scale_2]) AS v FROM splats) GROUP BY clip_id" for i in range(16)), splats=X.SPLATS)
def _(spark, d):
    values = quantize.distinct_values(X.splats(spark, d), ("scale_0", "scale_1", "scale_2"))
    return quantize.kmeans_1d(values, 16, 0).withColumn("value", F.round("value", 6) + 0.0)


_PRICES = "SELECT l_orderkey % 4 AS clip_id, CAST(round(l_extendedprice * 100) AS BIGINT) / 6.4e1 AS value, count(*) AS n FROM lineitem GROUP BY ALL"  # their sums are exact


def lloyd(k: int, rounds: int, values: str, result: str) -> str:
    """Lloyd's rounds in SQL, each over all ``values`` (clip_id, value, n), and a ``result`` from their last codebook."""
    ctes = [
        f"v AS MATERIALIZED ({values})",
        "ranked AS MATERIALIZED (SELECT clip_id, value, sum(n) OVER w - n AS above, sum(n) OVER w AS upto, sum(n) OVER (PARTITION BY clip_id) AS total FROM v WINDOW w AS (PARTITION BY clip_id ORDER BY value))",
        f"place AS (SELECT DISTINCT clip_id, i AS idx, i * (total - 1) / {k - 1}e0 AS pos FROM ranked, range({k}) AS r(i))",
        "b0 AS MATERIALIZED (SELECT clip_id, idx, min(value) + (max(pos) - floor(max(pos))) * (max(value) - min(value)) + idx * 1e-12 AS value FROM place JOIN ranked USING (clip_id) WHERE (above <= floor(pos) AND floor(pos) < upto) OR (above <= ceil(pos) AND ceil(pos) < upto) GROUP BY clip_id, idx)",
    ]
    for r in range(rounds):
        ctes += [
            f"e{r} AS MATERIALIZED (SELECT *, coalesce((value + lag(value) OVER (PARTITION BY clip_id ORDER BY idx)) / 2e0, -1e300) AS low FROM b{r})",
            f"m{r} AS MATERIALIZED (SELECT v.clip_id, e.idx, sum(v.value * n) / sum(n) AS mean FROM v ASOF JOIN e{r} e ON v.clip_id = e.clip_id AND v.value > e.low GROUP BY ALL)",
            f"b{r + 1} AS MATERIALIZED (SELECT clip_id, row_number() OVER (PARTITION BY clip_id ORDER BY coalesce(mean, value), idx) - 1 AS idx, coalesce(mean, value) AS value FROM e{r} LEFT JOIN m{r} USING (clip_id, idx))",
        ]
    return f"WITH {', '.join(ctes)}, book AS (SELECT * FROM b{rounds}) {result}"


@query("kmeans_rounds", lloyd(256, 16, _PRICES, "SELECT clip_id, CAST(idx AS INT) AS idx, round(value, 6) + 0e0 AS value FROM book"))
def _(spark, d):
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    values = _table(spark, d, "lineitem").groupBy((F.col("l_orderkey") % 4).alias("clip_id"), (cents / 64.0).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return quantize.kmeans_1d(values).select("clip_id", "idx", (F.round("value", 6) + 0.0).alias("value"))


@query(
    "assign_centroids",
    f"SELECT v.vec_id, CAST(arg_min(c.vec_id, list_distance({_EMB.replace('embedding', 'v.embedding')}, {_EMB.replace('embedding', 'c.embedding')})) AS INT) AS label FROM embeddings v CROSS JOIN (SELECT * FROM embeddings WHERE vec_id < 16) c GROUP BY v.vec_id",
)
def _(spark, d):
    import numpy as np

    v = _table(spark, d, "embeddings")
    first = np.array([r.embedding for r in v.filter("vec_id < 16").orderBy("vec_id").collect()], np.float64)  # a codebook of 16
    return quantize.assign_centroids(v, "embedding", first, "label").select("vec_id", "label")


@query(  # the determinant of a 4D covariance is that of its shape times its duration's square
    "slice_4d_volume",
    "SELECT clip_id, splat_id, round(scale_0 + scale_1 + scale_2 + ln(t_sigma), 3) + 0e0 AS volume FROM splats",
    splats=X.SPLATS,
)
def _(spark, d):
    s = X.splats(spark, d)
    quat = lambda k: F.array(*(F.col(f"rot_{(i + k) % 4}") for i in range(4)))
    raw = s.select("clip_id", "splat_id", F.array("scale_0", "scale_1", "scale_2").alias("log_scale"), F.log("t_sigma").alias("log_scale_t"), quat(0).alias("rot_l"), quat(1).alias("rot_r"))
    volume = F.col("scale_0") + F.col("scale_1") + F.col("scale_2") + F.log("t_sigma")
    return poses.slice_4d_covariance(raw).select("clip_id", "splat_id", (F.round(volume, 3) + 0.0).alias("volume"))


@query(
    "ambiguous_keys",
    "SELECT clip_id, grp, count(*) AS n FROM (SELECT clip_id, grp, row_number() OVER (PARTITION BY clip_id, grp, k_x >> 12, k_y >> 12, k_z >> 12 ORDER BY splat_id) AS k FROM keyed) WHERE k > 1 GROUP BY clip_id, grp",
    splats=X.SPLATS, keyed=Q._KEY_TABLE,
)
def _(spark, d):
    s = X.splats(spark, d)
    keyed = compare.integer_keys(temporal.with_group(s, T0, T1, STEP), quantize.axis_ranges(s))
    # coarse keys without motion, so that there are ties
    still = keyed.withColumns({f"k_{a}": F.shiftright(f"k_{a}", 12) for a in "xyz"} | {f"k_v{a}": F.lit(0) for a in "xyz"})
    return compare.ambiguous(still).groupBy("clip_id", "grp").agg(F.count(F.lit(1)).alias("n"))


@query("count_differences", "SELECT clip_id, count(*) AS n_a, count(*) FILTER (splat_id % 9 <> 0 OR clip_id = 2) AS n_b FROM splats WHERE clip_id <> 2 GROUP BY clip_id", splats=X.SPLATS)
def _(spark, d):
    s = X.splats(spark, d)
    return compare.count_differences(s, s.filter("splat_id % 9 <> 0 or clip_id = 2"))


@query("field_presence", "SELECT 'ax' AS field, true AS in_a, false AS in_b, 'fail' AS verdict WHERE (SELECT count(*) FROM splats) > 0 UNION ALL SELECT 'f_rest', false, true, 'note' WHERE (SELECT count(*) FROM splats) > 0", splats=X.SPLATS)
def _(spark, d):
    s = X.splats(spark, d).withColumn("ay", F.lit(None).cast("double"))
    return compare.field_presence(s.withColumn("ax", F.col("x")), s.withColumn("f_rest", F.array("y")), ["ax", "ay"], ["f_rest"])


@query("kept_share", "SELECT clip_id, round(count(*) FILTER (splat_id % 9 < 4) / count(*), 6) AS share FROM splats GROUP BY clip_id", splats=X.SPLATS)
def _(spark, d):
    s = X.splats(spark, d)
    return S.kept_share(s, s.filter("splat_id % 9 < 4")).withColumn("share", F.round("share", 6))


# cameras, keypoints and sync

_CALIBRATED = """SELECT s_name AS camera_id, CASE WHEN s_suppkey % 7 = 0 THEN -1e0 ELSE 8e2 END AS f, CASE WHEN s_suppkey % 5 = 0 THEN 1.2e3 ELSE 9.6e2 END AS cx, 5.4e2 AS cy,
    CASE s_suppkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 1920 WHEN 2 THEN 960 ELSE 1920 END AS image_w, CASE s_suppkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 1080 WHEN 2 THEN 540 ELSE 720 END AS image_h FROM supplier"""


@query(
    "reconcile_calibration",
    """SELECT camera_id, status, round(f * rx, 6) AS f, round(cx * rx, 6) AS cx, round(cy * ry, 6) AS cy FROM (SELECT *, CASE WHEN status = 'scaled' THEN 1920e0 / image_w ELSE 1e0 END AS rx, CASE WHEN status = 'scaled' THEN 1080e0 / image_h ELSE 1e0 END AS ry FROM
    (SELECT *, CASE WHEN f <= 0 THEN 'invalid' WHEN image_w IS NULL THEN CASE WHEN abs(cx - 960) > 192 THEN 'warn' ELSE 'unsized' END WHEN image_w = 1920 AND image_h = 1080 THEN 'ok'
      WHEN abs(1920e0 / image_w - 1080e0 / image_h) > 1e-2 THEN 'aspect' ELSE 'scaled' END AS status FROM calibrated))""",
    calibrated=_CALIBRATED,
)
def _(spark, d):
    c = X.derive(spark, d, _CALIBRATED)
    zero, one = F.lit(0.0), F.lit(1.0)
    calib = c.select("camera_id", F.array(F.col("f"), zero, F.col("cx"), zero, F.col("f"), F.col("cy"), zero, zero, one).alias("k"), "image_w", "image_h")
    media = c.select(F.col("camera_id").alias("camera"), F.lit(1920).alias("width"), F.lit(1080).alias("height"))
    k = lambda i: F.round(F.col("k")[i], 6)
    return C.reconcile_calibration(calib, media).select("camera_id", "status", k(0).alias("f"), k(2).alias("cx"), k(5).alias("cy"))


@query(
    "with_intrinsics",
    "SELECT capture_id, camera_label, CASE WHEN (n_nationkey + capture_id) % 3 = 0 THEN 1e2 + capture_id ELSE 5e1 END AS fl_x FROM rig",
    rig=X.RIG,
)
def _(spark, d):
    rig = X.cameras(spark, d)
    own = rig.filter((F.col("n_nationkey") + F.col("capture_id")) % 3 == 0).select("capture_id", "camera_label", (F.col("capture_id") + 100.0).alias("fl_x"))
    return C.with_intrinsics(rig, own, {"fl_x": 50.0}).select("capture_id", "camera_label", "fl_x")


@query(
    "split_valid_cameras",
    "SELECT capture_id, camera_label, CASE WHEN n_nationkey % 5 = 0 THEN 'missing fl_x,w' WHEN n_nationkey % 5 = 1 THEN 'missing c2w' WHEN n_nationkey % 5 = 2 THEN 'singular pose' END AS reason FROM rig",
    rig=X.RIG,
)
def _(spark, d):
    n = F.col("n_nationkey") % 5
    rig = X.cameras(spark, d)
    flat = F.transform("c2w", lambda v, i: F.when(i.isin(0, 1, 2), F.lit(0.0)).otherwise(v))
    bad = rig.withColumns({"fl_x": F.when(n != 0, F.col("fl_x")), "w": F.when(n != 0, F.col("w")), "c2w": F.when(n == 2, flat).when(n != 1, F.col("c2w"))})
    return C.split_valid_cameras(bad).select("capture_id", "camera_label", "reason")


@query(
    "time_rescale",
    """SELECT doc_id, round(t * CASE WHEN longest > 0 AND NOT (duration / longest > 8e-1 AND duration / longest < 1.25e0) THEN duration / longest ELSE 1e0 END, 6) AS time FROM
    (SELECT *, max(t) OVER (PARTITION BY capture) AS longest, 2e0 + 3e0 * capture AS duration FROM (SELECT doc_id, doc_id % 5 AS capture, (doc_id % 97) / 8e0 AS t FROM labels))""",
)
def _(spark, d):
    views = _table(spark, d, "labels").select((F.col("doc_id") % 5).alias("capture_id"), "doc_id", ((F.col("doc_id") % 97) / 8.0).alias("time"))
    durations = views.select("capture_id").distinct().withColumn("duration", 2.0 + 3.0 * F.col("capture_id"))
    return C.time_rescale(views, durations).select("doc_id", F.round("time", 6).alias("time"))


_FIT = "[0e0, -1e0, 0e0, 1e0, 0e0, 0e0, 0e0, 0e0, 1e0]"


@query(
    "similarity_of_points",
    f"SELECT capture_id, round(2e0 + capture_id, 6) AS scale, {_FIT} AS rotation, [1e0, -3e0, CAST(capture_id AS DOUBLE)] AS translation FROM points GROUP BY capture_id HAVING count(*) > 3",
    points=X.POINTS,
)
def _(spark, d):
    p, k = X.derive(spark, d, X.POINTS), F.col("capture_id")
    long = F.col("kp_idx").cast("long")  # the square of a part's number is beyond an int
    p = p.withColumn("y", (long * long % 29 - 14) / 10.0).withColumn("z", (F.col("kp_idx") % 3) / 1.0)  # never all in a plane
    moved = p.select("capture_id", *(F.col(a).alias(f"src_{a}") for a in "xyz"), (1.0 - (2.0 + k) * F.col("y")).alias("dst_x"), ((2.0 + k) * F.col("x") - 3.0).alias("dst_y"), ((2.0 + k) * F.col("z") + k).alias("dst_z"))
    near = lambda c: F.transform(c, lambda v: F.round(v, 6) + 0.0).alias(c)
    return poses.similarity_fit(moved).select("capture_id", F.round("scale", 6).alias("scale"), near("rotation"), near("translation"))


@query(
    "pose_average",
    "SELECT capture_id, camera_label, 7 AS num_views, 5 AS num_inliers, round(60e0 * s, 4) + 0e0 AS x, round(-(60e0 * c), 4) + 0e0 AS z FROM rig",
    rig=X.RIG,
)
def _(spark, d):
    given = poses.given_poses(X.cameras(spark, d)).withColumn("image", F.explode(F.array(*(F.lit(f"i{k}") for k in range(7)))))
    moved = F.transform("w2c", lambda v, i: v + F.when((F.col("image") == "i6") & (i == 3), 40.0).otherwise(0.0))  # one far off, one turned around
    turned = F.transform("w2c", lambda v, i: F.when((F.col("image") == "i5") & i.isin(0, 1, 2, 3, 8, 9, 10, 11), -v).otherwise(v))
    p = given.withColumn("w2c", moved).withColumn("w2c", turned)
    mean = poses.robust_pose_average(p)
    centre = poses.camera_centres(mean, "c").select("capture_id", "camera_label", (F.round("c_x", 4) + 0.0).alias("x"), (F.round("c_z", 4) + 0.0).alias("z"))
    return mean.select("capture_id", "camera_label", "num_views", "num_inliers").join(centre, ["capture_id", "camera_label"])


@query("prefix_energy", "SELECT capture_id, camera, i, value, sum(value * value) OVER (PARTITION BY capture_id, camera ORDER BY i) AS energy FROM env", env=X.ENVELOPES)
def _(spark, d):
    return sync.prefix_energy(X.derive(spark, d, X.ENVELOPES))


@query(
    "offset_table",
    """SELECT capture_id, camera, 2.997e1 AS fps, CAST(round_even(o * 2.997e1, 0) AS INT) AS frame_offset, round(o, 4) + 0e0 AS offset_seconds, round(CASE WHEN k = 1 THEN 1e0 ELSE coalesce(q, dq) END, 3) AS match_quality,
      round(least(CASE WHEN k = 1 THEN 999e0 ELSE coalesce(r, dr) END, 999e0), 2) AS peak_ratio, k > 1 AND q IS NULL AS low_confidence, CASE WHEN k = 1 OR breaks = 0 THEN 'lsq' WHEN d IS NOT NULL THEN 'direct' END AS solver, CASE WHEN o IS NULL THEN 'no offset' END AS error FROM
    (SELECT t.capture_id, t.camera, t.k, t.breaks, ends.q, ends.r, direct.d, direct.dq, direct.dr, CASE WHEN t.k = 1 THEN 0e0 WHEN t.breaks = 0 THEN t.start ELSE direct.d END AS o FROM (SELECT *, CAST(substr(camera, 5) AS INT) - 1000 AS k FROM tied) t
     LEFT JOIN (SELECT capture_id, camera, min(match_quality) AS q, min(peak_ratio) AS r FROM (SELECT capture_id, unnest([cam_a, cam_b]) AS camera, match_quality, peak_ratio FROM pairs WHERE confident) GROUP BY capture_id, camera) ends ON ends.capture_id = t.capture_id AND ends.camera = t.camera
     LEFT JOIN (SELECT capture_id, cam_b AS camera, offset_seconds AS d, match_quality AS dq, peak_ratio AS dr FROM pairs WHERE cam_a = 'cam_1001') direct ON direct.capture_id = t.capture_id AND direct.camera = t.camera)""",
    chain=X.CHAIN, pairs=X.PAIRS, tied=Q._TIED,
)
def _(spark, d):
    pairs, reference = Q._pairs(spark, d)
    media = pairs.select("capture_id", F.explode(F.array("cam_a", "cam_b")).alias("camera")).distinct().withColumn("fps", F.lit(29.97))
    out = sync.offset_table(pairs, sync.offset_lsq(pairs, reference), reference, media)
    return out.drop("max_residual_seconds").withColumn("offset_seconds", F.col("offset_seconds") + 0.0)


@query("filter_points", "SELECT p_partkey, p_retailprice FROM part WHERE (p_partkey % 50) / 1e1 <= 2e0 AND p_size >= 3")
def _(spark, d):
    p = _table(spark, d, "part").withColumns({"error": (F.col("p_partkey") % 50) / 10.0, "track_length": F.col("p_size")})
    return dataset.filter_points(p).select("p_partkey", "p_retailprice")


@query("filter_keypoints", "SELECT capture_id, tem, kp_idx, camera_label FROM obs WHERE score >= 7e-1", obs=X.OBSERVATIONS)
def _(spark, d):
    return C.filter_keypoints(X.derive(spark, d, X.OBSERVATIONS), 0.7).select("capture_id", "tem", "kp_idx", "camera_label")


@query("merge_instants", "SELECT CASE WHEN kp_idx % 2 = 0 THEN 'even' ELSE 'odd' END AS tem, count(*) AS n, CAST(sum(kp_idx) AS BIGINT) AS sum_kp FROM points GROUP BY kp_idx % 2", points=X.POINTS)
def _(spark, d):
    p = X.derive(spark, d, X.POINTS)
    merged = dataset.merge_instants({"even": p.filter("kp_idx % 2 = 0"), "odd": p.filter("kp_idx % 2 = 1")})
    return merged.groupBy("tem").agg(F.count(F.lit(1)).alias("n"), F.sum("kp_idx").alias("sum_kp"))


# checks

@query("members", "SELECT CAST(o_orderkey AS BIGINT) AS k, CASE WHEN o_orderkey % 5 = 0 THEN 'missing' ELSE 'unexpected' END AS violation FROM orders WHERE (o_orderkey % 5 = 0) <> (o_orderkey % 7 = 0)")
def _(spark, d):
    o = _table(spark, d, "orders").select(F.col("o_orderkey").alias("k"))
    return validate.members(o.filter("k % 7 <> 0"), o.filter("k % 5 <> 0"), ["k"])


@query(
    "validate_frames",
    "SELECT s_nationkey % 3 AS capture_id, s_name AS camera, CASE WHEN s_suppkey % 6 = 1 THEN 'small' WHEN s_suppkey % 6 = 2 THEN 'twice' ELSE 'missing' END AS violation FROM supplier WHERE s_suppkey % 6 BETWEEN 1 AND 3",
)
def _(spark, d):
    k = F.col("s_suppkey") % 6
    s = _table(spark, d, "supplier").select((F.col("s_nationkey") % 3).alias("capture_id"), F.col("s_name").alias("camera"), k.alias("k"), F.when(k == 1, 999).otherwise(1920).alias("width"), F.lit(1080).alias("height"))
    frames = s.filter("k <> 3").unionByName(s.filter("k = 2"))
    return validate.validate_frames(frames, s).select("capture_id", "camera", "violation")


@query(
    "validate_job_result",
    "SELECT clip_id, violation FROM (SELECT clip_id, unnest([CASE WHEN clip_id % 4 = 1 THEN 'format' END, CASE WHEN n - 1 < 3 THEN 'empty' END]) AS violation FROM (SELECT o_custkey AS clip_id, count(*) AS n FROM orders GROUP BY o_custkey)) WHERE violation IS NOT NULL",
)
def _(spark, d):
    n = _table(spark, d, "orders").groupBy(F.col("o_custkey").alias("clip_id")).agg(F.count(F.lit(1)).alias("n"))
    clips = n.select("clip_id", F.when(F.col("clip_id") % 4 != 1, "packed").alias("format"), F.when(F.col("n") - 1 >= 3, F.col("n") - 1).alias("splat_count"))
    return jobs.validate_job("result", clips=clips, name="packed")


@query(
    "validate_static_rig",
    "SELECT capture_id, camera_label, violation FROM (SELECT capture_id, camera_label, unnest([CASE WHEN n_nationkey % 5 = 0 THEN 'pose moves' END, CASE WHEN n_nationkey % 6 = 1 THEN 'intrinsics move' END, CASE WHEN n_nationkey % 7 = 2 THEN 'distorted' END]) AS violation FROM rig WHERE n_nationkey % 11 <> 3) WHERE violation IS NOT NULL UNION ALL SELECT capture_id, camera_label, 'missing' FROM rig WHERE n_nationkey % 11 = 3",
    rig=X.RIG,
)
def _(spark, d):
    n = F.col("n_nationkey")
    first = X.cameras(spark, d).withColumn("dist", F.array(F.lit(0.0), F.when(n % 7 == 2, 1e-3).otherwise(1e-12)))
    moved = F.transform("c2w", lambda v, i: v + F.when((i == 3) & (n % 5 == 0), 1e-6).otherwise(0.0))
    last = first.filter(n % 11 != 3).withColumns({"c2w": moved, "cx": F.col("cx") + F.when(n % 6 == 1, 0.5).otherwise(0.0)})
    return validate.validate_static_rig(first, last)


@query(
    "validate_clips",
    "SELECT clip_id, violation FROM (SELECT o_custkey AS clip_id, unnest([CASE WHEN o_custkey % 4 = 0 THEN 'no fps' END, CASE WHEN o_custkey % 6 = 0 THEN 'no time_max' END, CASE WHEN o_custkey % 5 = 0 THEN 'degree' END]) AS violation FROM (SELECT DISTINCT o_custkey FROM orders)) WHERE violation IS NOT NULL",
)
def _(spark, d):
    k = F.col("clip_id")
    clips = _table(spark, d, "orders").select(F.col("o_custkey").alias("clip_id")).distinct()
    given = clips.withColumns({"time_min": F.lit(0.0), "time_max": F.when(k % 6 != 0, 9.0), "fps": F.when(k % 4 != 0, 30.0), "motion_degree": F.lit(1)})
    return validate.validate_clips(given, clips.withColumn("found_degree", F.when(k % 5 == 0, 2).otherwise(1)))


@query("validate_segment_count", "SELECT clip_id, count(*) AS count FROM (SELECT o_custkey AS clip_id, unnest(range(0, CASE WHEN o_custkey % 250 = 1 THEN 65537 ELSE 3 END)) AS k FROM (SELECT DISTINCT o_custkey FROM orders)) GROUP BY clip_id HAVING count(*) > 65536")
def _(spark, d):
    clips = _table(spark, d, "orders").select(F.col("o_custkey").alias("clip_id")).distinct()
    n = F.when(F.col("clip_id") % 250 == 1, 65_536).otherwise(2)
    return validate.validate_segment_count(clips.select("clip_id", F.explode(F.sequence(F.lit(0), n)).alias("seg_idx")))


@query("support_violations", "SELECT clip_id, seg_idx FROM exact WHERE seg_idx % 10 = 4 OR (seg_idx % 10 = 7 AND clip_id = 1)", splats=X.SPLATS, exact=Q._EXACT)
def _(spark, d):
    table = Q._segments(spark, d)
    k = F.col("seg_idx") % 10
    stored = table.withColumns({"t0": F.col("t0") + F.when(k == 4, 0.01).otherwise(1e-9), "t1": F.col("t1") - F.when((k == 7) & (F.col("clip_id") == 1), 0.01).otherwise(0.0)})
    return temporal.support_violations(table, stored, 1e-6)


@query(
    "validate_dataset",
    """SELECT DISTINCT capture_id, violation FROM (SELECT capture_id, unnest([CASE WHEN n_nationkey = 3 AND capture_id % 4 = 1 THEN 'null time' END, CASE WHEN n_nationkey = 5 AND capture_id % 3 = 0 THEN 'not 4 channels' END, CASE WHEN capture_id % 5 = 2 THEN 'no test view' END,
      CASE WHEN capture_id % 6 = 0 THEN 'no point' WHEN capture_id % 6 = 1 THEN 'point without time' END]) AS violation FROM rig) WHERE violation IS NOT NULL""",
    rig=X.RIG,
)
def _(spark, d):
    n, c = F.col("n_nationkey"), F.col("capture_id")
    rig = X.cameras(spark, d)
    views = rig.withColumns({
        "frame_idx": F.lit(0), "file_path": F.lit("f"), "time": F.when((n != 3) | (c % 4 != 1), 0.5), "channels": F.when((n == 5) & (c % 3 == 0), 3).otherwise(4),
        "split": F.when((n == 1) & (c % 5 != 2), "test").otherwise("train"),
    })
    points = rig.filter(c % 6 != 0).select("capture_id", F.when((c % 6 != 1) | (n != 2), 1.0).alias("time"))
    return validate.validate_dataset(views, points)


# sources and sinks: written to the shared folder and read again

@query(
    "offsets_written",
    "SELECT camera, CASE WHEN error IS NULL THEN fps END AS fps, CASE WHEN error IS NULL THEN frame_offset END AS frame_offset, round(offset_seconds, 6) AS offset_seconds, error FROM offs",
    offs=X.OFFSETS,
)
def _(spark, d):
    path, good = _folder(spark), F.col("error").isNull()
    given = X.derive(spark, d, X.OFFSETS).withColumns({"fps": F.when(good, F.col("fps")), "frame_offset": F.when(good, F.col("frame_offset")), "match_quality": F.lit(0.5), "peak_ratio": F.lit(2.0), "low_confidence": F.lit(False), "solver": F.lit("lsq")})
    tables.write_offsets(given.withColumn("capture_id", F.lit(0)), path)
    return tables.read_offsets(spark, path).select("camera", "fps", "frame_offset", F.round("offset_seconds", 6).alias("offset_seconds"), "error")


@query(
    "transforms_written",
    "SELECT camera_label, count(*) AS n, round(sum(60e0 * s), 4) + 0e0 AS x, round(sum(-(60e0 * c)), 4) + 0e0 AS z, round(sum(n_nationkey / 8e0), 4) AS k1, CAST(sum(n_nationkey) AS BIGINT) AS extra FROM rig GROUP BY camera_label",
    rig=X.RIG,
)
def _(spark, d):
    path = _folder(spark)
    n = F.col("n_nationkey")
    rig = X.cameras(spark, d).withColumns({"file_path": F.concat(F.lit("shots/"), "camera_label", F.lit(".jpg")), "dist": F.array(n / 8.0, F.lit(0.0), F.lit(0.0), F.lit(0.0)), "time": n.cast("double")})
    tables.write_transforms(rig.drop("n_nationkey"), path)
    at = lambda i: F.round(F.sum(F.col("c2w")[i]), 4) + 0.0
    back = tables.read_cameras(spark, path)
    return back.groupBy("camera_label").agg(F.count(F.lit(1)).alias("n"), at(3).alias("x"), at(11).alias("z"), F.round(F.sum(F.col("dist")[0]), 4).alias("k1"), F.sum("time").cast("long").alias("extra"))


@query("clips_written", "SELECT clip_id, count(*) AS splat_count, 0e0 AS time_min, max(t_center) AS time_max FROM splats GROUP BY clip_id", splats=X.SPLATS)
def _(spark, d):
    path = _folder(spark)
    clips = X.splats(spark, d).groupBy("clip_id").agg(F.count(F.lit(1)).alias("splat_count"), F.lit(0.0).alias("time_min"), F.max("t_center").alias("time_max"))
    tables.write_clips(clips.withColumn("note", F.lit("not a scalar")), path)
    return spark.read.json(path).select("clip_id", "splat_count", "time_min", "time_max")


@query("splats_written", "SELECT clip_id, CAST(grp AS INT) AS grp, count(*) AS n, CAST(sum(splat_id) AS BIGINT) AS sum_id, max(file_idx) AS last FROM filed GROUP BY clip_id, grp", **Q._ORDER_TABLES)
def _(spark, d):
    path = _folder(spark)
    tables.write_splats(Q._order(spark, d), path)
    return spark.read.parquet(path).groupBy(F.col("clip_id").cast("long").alias("clip_id"), "grp").agg(F.count(F.lit(1)).alias("n"), F.sum("splat_id").alias("sum_id"), F.max("file_idx").alias("last"))


@query("hull_points_written", "SELECT capture_id, count(*) AS n, CAST(sum(kp_idx % 256) AS BIGINT) AS sum_r, round(avg(kp_idx % 7 / 4e0), 6) AS mean_time FROM points GROUP BY capture_id", points=X.POINTS)
def _(spark, d):
    path = _folder(spark)
    k = F.col("kp_idx")
    p = X.derive(spark, d, X.POINTS).withColumns({"frame_idx": k % 7, "time": (k % 7) / 4.0, "r": k % 256, "g": F.lit(1), "b": F.lit(2)})
    tables.write_hull_points(p, path)
    return spark.read.parquet(path).groupBy(F.col("capture_id").cast("long").alias("capture_id")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("r").cast("long")).alias("sum_r"), F.round(F.avg("time"), 6).alias("mean_time"))


@query(
    "sfm_text_written",
    "SELECT capture_id, concat_ws(' ', CAST(row_number() OVER (PARTITION BY capture_id ORDER BY camera_label) AS STRING), 'PINHOLE', '96', '64', '80.0', '80.0', '48.0', '32.0') AS value FROM rig",
    rig=X.RIG,
)
def _(spark, d):
    path, zero = _folder(spark), F.lit(0.0)
    rig = X.cameras(spark, d).withColumns({c: zero for c in ("qw", "qx", "qy", "qz", "tx", "ty", "tz")})
    points = X.derive(spark, d, X.POINTS).withColumnRenamed("kp_idx", "point_id")
    tables.write_sfm_text(rig, points, path)
    return tables.read_sfm_lines(spark, f"{path}/cameras").select(F.col("capture_id").cast("long").alias("capture_id"), "value")


@query("history_written", "SELECT metric, max(value) AS latest, count(*) * 2 AS runs FROM (SELECT o_orderpriority AS metric, o_totalprice AS value FROM orders) GROUP BY metric")
def _(spark, d):
    path = _folder(spark)
    rows = _table(spark, d, "orders").select(F.col("o_orderpriority").alias("metric"), F.col("o_totalprice").alias("value"))
    tables.append_history(rows.withColumn("ts", F.lit(1)), path)
    tables.append_history(rows.withColumn("ts", F.lit(2)), path)  # a later run of the same figures
    both = spark.read.json(path)
    return evaluate.latest(both.select("metric", "ts", "value")).withColumnRenamed("value", "latest").join(both.groupBy("metric").agg(F.count(F.lit(1)).alias("runs")), "metric")


@query("size_summary", "SELECT clip_id, round(before / after, 6) AS ratio, round(after / n, 6) AS bytes_per_splat FROM (SELECT clip_id, CAST(sum(frame * 100) AS DOUBLE) AS before, CAST(sum(frame * 7 + 1) AS DOUBLE) AS after, count(*) AS n FROM splats GROUP BY clip_id)", splats=X.SPLATS)
def _(spark, d):
    s = X.splats(spark, d)
    counts = s.groupBy("clip_id").agg(F.count(F.lit(1)).alias("splat_count"))
    sized = lambda k, more: s.select("clip_id", (F.col("frame") * k + more).alias("bytes"))
    out = evaluate.size_summary(sized(100, 0), sized(7, 1), counts)
    return out.select("clip_id", F.round("ratio", 6).alias("ratio"), F.round("bytes_per_splat", 6).alias("bytes_per_splat"))


@query("measure_run", "SELECT round(max(m), 2) AS median_reprojection_error_px, round(avg(p), 2) AS eval4d_psnr_db, round(avg(s), 4) AS eval4d_ssim FROM (SELECT psnr_db AS p, ssim AS s, (SELECT max(o_orderkey % 100) / 8e0 FROM orders) AS m FROM views)", views=X.VIEWS)
def _(spark, d):
    top = _table(spark, d, "orders").agg(F.max(F.col("o_orderkey") % 100).alias("k")).select(F.lit(None).cast("string").alias("camera_label"), (F.col("k") / 8.0).alias("median"))
    coverage = _table(spark, d, "orders").select((F.col("o_orderkey") % 10).alias("coverage"))
    return evaluate.measure_run(top, coverage, X.derive(spark, d, X.VIEWS)).select("median_reprojection_error_px", "eval4d_psnr_db", "eval4d_ssim")


# jobs

_MODE = f"CAST(252 + {Q._BIG_AT} AS INT) AS quat_mode"
_SPLIT = f"CAST({Q._CODE} AS INT)"


@query(
    "pack_job",
    f"""SELECT f.clip_id, f.splat_id, f.file_idx, q & 255 AS means_lo_0, q >> 8 AS means_hi_0, CAST(round_even(255e0 * {Q._ALPHA}, 0) AS INT) AS alpha8, {_MODE} FROM filed f JOIN
    (SELECT *, {_SPLIT} AS q FROM (SELECT *, {Q._T} AS t, min({Q._T}) OVER (PARTITION BY clip_id) AS mn, max({Q._T}) OVER (PARTITION BY clip_id) AS mx FROM splats)) s ON s.clip_id = f.clip_id AND s.splat_id = f.splat_id""",
    **Q._ORDER_TABLES,
)
def _(spark, d):
    planes = quantize.pack(X.splats(spark, d), T0, T1, STEP, k=16)["planes"]
    return planes.select("clip_id", "splat_id", "file_idx", *(F.col(c).cast("int").alias(c) for c in ("means_lo_0", "means_hi_0", "alpha8", "quat_mode")))


@query(
    "mask_filter_job",
    "SELECT clip_id, count(*) AS n, CAST(sum(splat_id) AS BIGINT) AS sum_id FROM splats WHERE splat_id NOT IN (SELECT splat_id FROM votes WHERE outside / tested >= 5e-1) GROUP BY clip_id",
    **Q._VOTE_TABLES,
)
def _(spark, d):
    return Q._digest(jobs.mask_filter_job(X.splats(spark, d), X.cameras(spark, d), X.derive(spark, d, X.RUNS)))


@query(
    "clean_masks_job",
    "SELECT capture_id, camera_label, CAST(3 + n % 2 AS BIGINT) AS components_total, CAST(1 AS BIGINT) AS components_kept, 1e0 AS coverage_before, 1e0 AS coverage_after, n % 4 = 0 AS retried, false AS emptied, false AS low_coverage FROM (SELECT DISTINCT capture_id, camera_label, CAST(substr(camera_label, 5) AS INT) AS n FROM runs)",
    runs=X.RUNS,
)
def _(spark, d):
    parts = Q._parted(spark, d)
    hits = parts.filter("y = 10").select("capture_id", "camera_label", (F.col("x0") + 3.2).alias("u"), (F.col("y") - 0.4).alias("v"))
    images = Q._images(spark, d)
    again = images.filter(text.trailing_id(F.col("camera_label")) % 4 == 0)
    return jobs.clean_masks_job(parts, hits, images, retried=again)["report"]


@query(
    "evaluate_job",
    f"SELECT view, round(-1e1 * log10(m / (255e0 * 255e0)), 6) AS psnr_db FROM (SELECT view, avg({_SQUARE}) AS m FROM other WHERE view % 3 > 0 AND view % 4 <> 1 GROUP BY view) WHERE m > 0",
    px=_PIXEL_ROWS, other=_OTHER,
)
def _(spark, d):
    px = X.derive(spark, d, _PIXEL_ROWS).filter("view % 3 > 0")
    truth = px.filter("view % 4 <> 1").withColumns({"r": F.least(F.col("r") + 4, F.lit(255)), "g": 255 - F.col("g")})
    report = X.derive(spark, d, X.VIEWS).agg(F.lit(None).cast("string").alias("camera_label"), F.lit(2.0).alias("median"))
    coverage = X.derive(spark, d, X.VIEWS).select(F.lit("cam").alias("camera_label"), F.lit(0.5).alias("coverage"))
    golden = report.select(F.lit("eval4d_psnr_db").alias("metric"), F.lit(None).cast("string").alias("camera"), F.lit(30.0).alias("value"))
    views = jobs.evaluate_job(px, truth, ["view"], report, coverage, X.derive(spark, d, X.VIEWS), golden)["views"]
    return views.filter("mse > 0").select("view", F.round("psnr_db", 6).alias("psnr_db"))


@query(
    "flipbook_job",
    f"SELECT clip_id, count(*) AS n, CAST(sum(splat_id) AS BIGINT) AS sum_id FROM (SELECT *, row_number() OVER (PARTITION BY clip_id, frame ORDER BY {Q._IMPORTANCE} DESC, splat_id) AS k FROM splats WHERE {Q._ALPHA} >= 1e0 / 255e0) WHERE k <= 50 GROUP BY clip_id",
    splats=X.SPLATS,
)
def _(spark, d):
    frames = X.splats(spark, d).drop("t_center", "t_sigma", "vx", "vy", "vz")
    return Q._digest(jobs.flipbook_job(frames, 30.0, 350, 7, k=8)["planes"])


@query("reorder_like", "SELECT clip_id, splat_id, file_idx FROM filed", **Q._ORDER_TABLES)
def _(spark, d):
    s = X.splats(spark, d)
    archive = s.select("clip_id").distinct().withColumns({"segment_duration": F.lit(STEP), "k_sigma": F.lit(None).cast("double"), "persistent_span_mult": F.lit(3.0)})
    return compare.reorder_like(s, archive, T0, T1)[0].select("clip_id", "splat_id", "file_idx")


@query(  # neighbours of a group exchanged in a few places come back to their own rows
    "repair_pairs",
    "SELECT clip_id, splat_id AS a_splat_id, splat_id AS b_splat_id, (r % 2000 = 1 AND last > r) OR r % 2000 = 2 AS repaired FROM (SELECT *, row_number() OVER (PARTITION BY clip_id ORDER BY splat_id) AS r, count(*) OVER (PARTITION BY clip_id) AS last FROM splats)",
    splats=X.SPLATS,
)
def _(spark, d):
    from pyspark.sql.window import Window

    w = Window.partitionBy("clip_id").orderBy("splat_id")
    s = X.splats(spark, d).withColumn("rank", F.row_number().over(w))
    k = F.col("rank") % 2000
    partner = F.when((k == 1) & F.lead("splat_id").over(w).isNotNull(), F.lead("rank").over(w)).when(k == 2, F.lag("rank").over(w)).otherwise(F.col("rank"))
    a = s.select("clip_id", "rank", partner.alias("other"), F.col("splat_id").alias("a_splat_id"), *(F.col(c).alias(f"a_{c}") for c in "xyz"))
    b = s.select("clip_id", F.col("rank").alias("other"), F.col("splat_id").alias("b_splat_id"), *(F.col(c).alias(f"b_{c}") for c in "xyz"))
    pairs = a.join(b, ["clip_id", "other"]).withColumn("grp", F.lit(0))
    moved = (F.col("a_splat_id") != F.col("b_splat_id")).cast("int")
    keys = {f"{n}_k_{c}": F.lit(0) if n == "a" else moved for n in "ab" for c in compare.KEYS}
    return compare.repair_pairs(pairs.withColumns(keys), 0.01).select("clip_id", "a_splat_id", "b_splat_id", "repaired")


_LAGS = """SELECT capture_id, cam_a, cam_b, lag, count(*) AS overlap, sum(a * b) AS ab, sum(a * a) AS aa, sum(b * b) AS bb FROM (SELECT x.capture_id, x.camera AS cam_a, y.camera AS cam_b, y.i - x.i AS lag, x.v AS a, y.v AS b FROM wave x
    JOIN wave y ON x.capture_id = y.capture_id AND x.camera < y.camera) GROUP BY capture_id, cam_a, cam_b, lag"""


@query(
    "full_rate_profile",
    "SELECT capture_id, cam_a, cam_b, CAST(lag AS INT) AS lag, overlap, round(ab / sqrt(aa * bb), 6) + 0e0 AS ncc FROM sums WHERE overlap >= 32",
    wave="SELECT CAST(floor(vec_id / 3e0) AS BIGINT) AS capture_id, CAST(vec_id AS VARCHAR) AS camera, unnest(range(0, 64)) AS i, unnest(CAST(embedding AS DOUBLE[])) AS v FROM embeddings", sums=_LAGS,
)
def _(spark, d):
    waves = _table(spark, d, "embeddings").select(F.floor(F.col("vec_id") / 3).alias("capture_id"), F.col("vec_id").cast("string").alias("camera"), F.col("embedding").cast("array<double>").alias("envelope"))
    return sync.full_rate_profile(waves).withColumn("ncc", F.round("ncc", 6) + 0.0)


_APART = "SELECT clip_id, splat_id, opacity, CASE WHEN x > 5e0 THEN x + 2.5e1 ELSE x END AS x, y, z FROM splats"
_CELLED = """SELECT s.*, CAST(floor((x - lx) / cell) AS BIGINT) AS cx, CAST(floor((y - ly) / cell) AS BIGINT) AS cy, CAST(floor((z - lz) / cell) AS BIGINT) AS cz FROM apart s JOIN
    (SELECT clip_id, min(x) AS lx, min(y) AS ly, min(z) AS lz, 6e-2 * sqrt((max(x) - min(x)) * (max(x) - min(x)) + (max(y) - min(y)) * (max(y) - min(y)) + (max(z) - min(z)) * (max(z) - min(z))) AS cell FROM apart GROUP BY clip_id) b ON s.clip_id = b.clip_id"""
_VOXELS = f"SELECT clip_id, (cx << 42) + (cy << 21) + cz AS id, any_value(cx) AS cx, any_value(cy) AS cy, any_value(cz) AS cz, sum({Q._ALPHA}) AS mass FROM celled GROUP BY clip_id, (cx << 42) + (cy << 21) + cz"
_NEAR = "SELECT a.clip_id, a.id AS a, b.id AS b FROM voxels a JOIN voxels b ON a.clip_id = b.clip_id AND abs(a.cx - b.cx) <= 1 AND abs(a.cy - b.cy) <= 1 AND abs(a.cz - b.cz) <= 1 AND a.id <> b.id"
_PARTS = "SELECT clip_id, id, min(r) AS part FROM (WITH RECURSIVE reach AS (SELECT clip_id, id, id AS r FROM voxels UNION SELECT n.clip_id, n.b, reach.r FROM reach JOIN near n ON n.clip_id = reach.clip_id AND n.a = reach.id AND n.b > reach.r) SELECT * FROM reach) GROUP BY clip_id, id"
_HEAVIEST = "SELECT clip_id, arg_max(part, (mass, -part)) AS part FROM (SELECT v.clip_id, part, sum(mass) AS mass FROM voxels v JOIN parts p ON p.clip_id = v.clip_id AND p.id = v.id GROUP BY v.clip_id, part) GROUP BY clip_id"


@query(
    "main_cluster_rows",
    "SELECT c.clip_id, c.splat_id FROM celled c JOIN parts p ON p.clip_id = c.clip_id AND p.id = (c.cx << 42) + (c.cy << 21) + c.cz JOIN heaviest h ON h.clip_id = c.clip_id AND h.part = p.part",
    splats=X.SPLATS, apart=_APART, celled=_CELLED, voxels=_VOXELS, near=_NEAR, parts=_PARTS, heaviest=_HEAVIEST,
)
def _(spark, d):
    from ..operators import components

    s = X.splats(spark, d).withColumn("x", F.when(F.col("x") > 5.0, F.col("x") + 25.0).otherwise(F.col("x")))
    return components.main_cluster(s, 0.06).select("clip_id", "splat_id")


@query(
    "hull_colour",
    f"""SELECT capture_id, kp_idx, CAST(coalesce(avg(r), 127e0) AS INT) AS r, CAST(floor(coalesce(avg(g), 127e0)) AS INT) AS g FROM (SELECT p.capture_id, p.kp_idx, CASE WHEN px.y IS NOT NULL THEN 200 END AS r, CASE WHEN px.y IS NOT NULL THEN 3 * px.n + 1 END AS g FROM points p LEFT JOIN
      (SELECT capture_id, kp_idx, n, py AS y FROM (SELECT capture_id, kp_idx, n_nationkey AS n, camera_label, CAST(trunc({Q._U}) AS INT) AS px, CAST(trunc({Q._V}) AS INT) AS py FROM points JOIN
        (SELECT capture_id AS rig_capture, n_nationkey, camera_label, c, s, tx, tz FROM (SELECT *, row_number() OVER (PARTITION BY capture_id ORDER BY camera_label) - 1 AS k FROM rig) WHERE k % 6 = 0 AND k < 24) AS r ON rig_capture = capture_id WHERE {Q._D} > 5e-2) WHERE (py + n) % 2 = 0) px
      ON px.capture_id = p.capture_id AND px.kp_idx = p.kp_idx) GROUP BY capture_id, kp_idx""",
    points=X.POINTS, rig=X.RIG,
)
def _(spark, d):
    points = X.derive(spark, d, X.POINTS).withColumns({"point_id": F.col("kp_idx"), "frame_idx": F.lit(0)})
    rig = X.cameras(spark, d)
    at = C.project_points(points.select("capture_id", "x", "y", "z"), rig, 0.05).join(rig.select("capture_id", "camera_label", F.col("n_nationkey").alias("n")), ["capture_id", "camera_label"])
    px = at.select("capture_id", "camera_label", "n", C.truncated_pixel(F.col("u")).alias("x"), C.truncated_pixel(F.col("v")).alias("y")).distinct()
    px = px.withColumns({"frame_idx": F.lit(0), "fg": (F.col("y") + F.col("n")) % 2 == 0, "r": F.lit(200), "g": 3 * F.col("n") + 1, "b": F.lit(0)})
    return dataset.hull_colour(points, rig, px).select("capture_id", "kp_idx", "r", "g")


@query(
    "bake_job",
    f"""SELECT clip_id, splat_id, round(f_dc + 3e-9, 5) + 0e0 AS f_dc_0, round(t_sigma, 6) AS t_sigma, round(list_sort([scale_0, scale_1, scale_2])[1], 5) + 0e0 AS scale_0, round(list_sort([scale_0, scale_1, scale_2])[3], 5) + 0e0 AS scale_2 FROM
      (SELECT *, f_dc_0 + x / 1e2 + y / 1e2 AS f_dc FROM splats) WHERE {Q._PEAK} >= 1e0 / 1024e0 AND NOT ((5e-1 + {G.SH_C0!r}e0 * f_dc + 2 * (5e-1 + {G.SH_C0!r}e0 * f_dc_1)) / 3e0 < -2.5e-1 OR ((5e-1 + {G.SH_C0!r}e0 * f_dc + 2 * (5e-1 + {G.SH_C0!r}e0 * f_dc_1)) / 3e0 < 5e-2 AND ({Q._ALPHA} < 3e-1 OR {Q._BIG} / {Q._SMALL} > 6e0)))""",
    splats=X.SPLATS,
)
def _(spark, d):
    s = X.splats(spark, d)
    band = F.transform(F.sequence(F.lit(0), F.lit(46)), lambda k: F.transform(F.array(F.lit(1.0), F.lit(0.0), F.lit(0.0)), lambda c: c * F.when(k == 15, F.col("x") / 100.0).when(k == 31, F.col("y") / 100.0).otherwise(0.0)))
    still = F.array(F.lit(1.0), F.lit(0.0), F.lit(0.0), F.lit(0.0))  # no rotation: axes keep their lengths
    raw = s.select(
        "clip_id", "splat_id", "x", "y", "z", "t_center", "opacity", F.array("f_dc_0", "f_dc_1", "f_dc_1").alias("dc"), band.alias("rest"),
        F.array("scale_0", "scale_1", "scale_2").alias("log_scale"), F.log("t_sigma").alias("log_scale_t"), still.alias("rot_l"), still.alias("rot_r"),
    )
    made = jobs.bake_job(raw, T0, T1, corrupted=False, black=True, cluster=False)["splats"]
    return made.select("clip_id", "splat_id", (F.round(F.col("f_dc_0") + 3e-9, 5) + 0.0).alias("f_dc_0"), F.round("t_sigma", 6).alias("t_sigma"), *((F.round(c, 5) + 0.0).alias(c) for c in ("scale_0", "scale_2")))


@query(
    "decode_job",
    f"""SELECT s.clip_id, s.splat_id, round(sign(u) * (exp(abs(u)) - 1e0), 6) + 0e0 AS x, round(ln(least(greatest(b / 255e0, 1e-5), 1e0 - 1e-5) / (1e0 - least(greatest(b / 255e0, 1e-5), 1e0 - 1e-5))), 6) + 0e0 AS opacity FROM
      (SELECT *, mn + {Q._CODE} / 65535e0 * CASE WHEN mx > mn THEN mx - mn ELSE 1e0 END AS u, round_even(255e0 * {Q._ALPHA}, 0) AS b FROM (SELECT *, {Q._T} AS t, min({Q._T}) OVER (PARTITION BY clip_id) AS mn, max({Q._T}) OVER (PARTITION BY clip_id) AS mx FROM splats)) s""",
    splats=X.SPLATS,
)
def _(spark, d):
    path = _folder(spark)
    tables.write_quantized(quantize.pack(X.splats(spark, d), T0, T1, STEP, k=16), path)
    q = tables.read_quantized(spark, path)
    back = quantize.dequantise(q["planes"], q["ranges"], q["codebooks"])
    return back.select(F.col("clip_id").cast("long").alias("clip_id"), "splat_id", *((F.round(c, 6) + 0.0).alias(c) for c in ("x", "opacity")))


_COMPARED = {"opacity": Q._ERROR_OF["opacity"], "scale_1": "CASE WHEN splat_id % 47 = 0 THEN 3e-1 ELSE 0e0 END"}
_SCORED = ("x", "y", "z", "vx", "vy", "vz", "scale_0", "scale_1", "scale_2", "f_dc_0", "f_dc_1", "f_dc_2", "t_center", "t_sigma", "opacity")


@query(  # every table of the job but weights and rotations, in one
    "compare_job",
    " UNION ALL ".join(f"SELECT 'errors' AS part, clip_id, '{c}' AS name, round(avg({_COMPARED.get(c, '0e0')}), 6) AS value, round(max({_COMPARED.get(c, '0e0')}), 6) AS most FROM splats GROUP BY clip_id" for c in _SCORED)
    + """ UNION ALL SELECT 'displaced', clip_id, '', 0e0, 0e0 FROM splats GROUP BY clip_id
    UNION ALL SELECT 'fields', clip_id, 'opacity', NULL, NULL FROM splats GROUP BY clip_id UNION ALL SELECT 'fields', clip_id, 'x', 0e0, NULL FROM splats GROUP BY clip_id
    UNION ALL SELECT 'presence', NULL, 'f_rest', 0e0, NULL WHERE (SELECT count(*) FROM splats) > 0
    UNION ALL SELECT 'counts', 9, '', (SELECT count(*) FROM splats WHERE clip_id = 3), 0e0""",
    splats=X.SPLATS,
)
def _(spark, d):
    a = X.splats(spark, d)
    b = a.withColumns({"opacity": F.col("opacity") + F.when(F.col("splat_id") % 5 == 0, 0.5).otherwise(0.0), "scale_1": F.col("scale_1") + F.when(F.col("splat_id") % 47 == 0, 0.3).otherwise(0.0)})
    b = b.withColumn("f_rest", F.array("y"))
    only_a = a.filter("clip_id = 3").withColumn("clip_id", F.lit(9).cast("long"))  # a clip that side b lacks
    ranges = quantize.axis_ranges(a.unionByName(only_a))
    out = jobs.compare_job(a.unionByName(only_a), b, ranges, T0, T1, STEP, [(ranges, None)])
    none = F.lit(None).cast("double")
    row = lambda df, part, name, value, most: df.select(F.lit(part).alias("part"), F.col("clip_id").cast("long").alias("clip_id"), name.alias("name"), value.cast("double").alias("value"), most.cast("double").alias("most"))
    said = row(out["errors"], "errors", F.col("field"), F.round("mean_error", 6), F.round("max_error", 6))
    said = said.union(row(out["displaced"], "displaced", F.lit(""), F.col("displaced"), F.lit(0.0)))
    said = said.union(row(out["fields"].filter("field in ('opacity', 'x')"), "fields", F.col("field"), F.round("over_share", 6), none))
    said = said.union(row(out["presence"].filter("field = 'f_rest'").withColumn("clip_id", F.lit(None)), "presence", F.col("field"), F.lit(0.0), none))
    return said.union(row(out["counts"], "counts", F.lit(""), F.col("n_a"), F.coalesce("n_b", F.lit(0))))


_STORED = ("clip_id", "x", "opacity", "t_center")


@query("ply_written", "SELECT CAST(clip_id AS BIGINT) AS clip_id, CAST(CAST(x AS FLOAT) AS DOUBLE) AS x, CAST(CAST(opacity AS FLOAT) AS DOUBLE) AS opacity, count(*) AS n FROM splats GROUP BY ALL", splats=X.SPLATS)
def _(spark, d):
    path = _folder(spark)
    ply.write_splat_ply(X.splats(spark, d).select(*_STORED), path, rows=1000)
    back = ply.read_splat_ply(spark, [path], ["opacity", "clip_id", "x"], rows=300)
    return back.groupBy(F.col("clip_id").cast("long").alias("clip_id"), F.col("x").cast("double").alias("x"), F.col("opacity").cast("double").alias("opacity")).agg(F.count(F.lit(1)).alias("n"))


@query("ply_clips", "SELECT CAST(count(*) AS BIGINT) AS splat_count, 0e0 AS time_min, 11e0 AS time_max, 2.5e1 AS fps, 1 AS motion_degree FROM splats", splats=X.SPLATS)
def _(spark, d):
    path = _folder(spark)
    ply.write_splat_ply(X.splats(spark, d).select(*_STORED), path, {"time_min": 0.0, "time_max": 11.0, "fps": 25.0, "motion_degree": 1}, rows=500)
    scalars = ["time_min", "time_max", "fps", "motion_degree"]
    return ply.read_clips(spark, path).groupBy(*scalars).agg(F.sum("splat_count").alias("splat_count"))


@query("static_splats", "SELECT CAST(l_linenumber AS INT) AS frame, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS total FROM lineitem GROUP BY l_linenumber")
def _(spark, d):
    path, rows = _folder(spark), _table(spark, d, "lineitem")
    for k in range(1, 8):  # a line's number is its frame
        ply.write_splat_ply(rows.filter(F.col("l_linenumber") == k).select("l_quantity"), f"{path}/{k}")
    each = ply.read_static_splats(spark, [f"{path}/{k}" for k in range(1, 8)], r"/([0-9]+)/part-[^/]*$")
    return each.groupBy("frame").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("double")).alias("total"))
