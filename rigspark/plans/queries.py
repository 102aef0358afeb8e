"""The registered queries of the operators, each beside the DuckDB SQL of the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import encoding as E
from ..functions.geometry import SH_C0, alpha_at, position_at
from ..functions.text import camera_label, trailing_id
from ..operators import cameras as C
from ..operators import compare, components, dataset, evaluate, poses, quantize, sync, temporal, validate
from ..operators import splats as S
from . import fixtures as X

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
T0, T1, STEP = X.TIME_MIN, X.TIME_MAX, X.DURATION


def query(name: str, oracle: str | None = None, **tables: str) -> Callable[[Query], Query]:
    """Register a query, with SQL over named domain tables."""

    def add(f: Query) -> Query:
        QUERIES[name] = f
        if oracle is not None:
            ctes = ", ".join(f"{n} AS ({sql})" for n, sql in tables.items())
            ORACLES[name] = X.in_duckdb(f"WITH {ctes} {oracle}" if ctes else oracle)
        return f

    return add


def _digest(df: DataFrame) -> DataFrame:
    return df.groupBy("clip_id").agg(F.count(F.lit(1)).alias("n"), F.sum("splat_id").alias("sum_id"))


_DIGEST = "SELECT clip_id, count(*) AS n, CAST(sum(splat_id) AS BIGINT) AS sum_id FROM"
_ALPHA = "(1e0 / (1e0 + exp(-opacity)))"
_RGB = [f"(5e-1 + {SH_C0!r}e0 * f_dc_{i})" for i in range(3)]
_BIG = "greatest(exp(scale_0), exp(scale_1), exp(scale_2))"
_SMALL = "greatest(least(exp(scale_0), exp(scale_1), exp(scale_2)), 1e-12)"
_NEAR = "(greatest(least(t_center, 11e0), 0e0) - t_center) / greatest(abs(t_sigma), 1e-9)"
_PEAK = f"({_ALPHA} * exp(-5e-1 * ({_NEAR}) * ({_NEAR})))"
_MEAN = f"(({_RGB[0]} + {_RGB[1]} + {_RGB[2]}) / 3e0)"
_CLIPPED = "((" + " + ".join(f"least(greatest({c}, 0e0), 1e0)" for c in _RGB) + ") / 3e0)"
_GOOD_COLOUR = " AND ".join(f"{c} BETWEEN 0e0 AND 1e0" for c in _RGB)
_SOUND = f"NOT ({_BIG} > 2e-1 AND {_BIG} / {_SMALL} > 1e1)"
_NO_FLOATER = f"NOT ({_MEAN} < -2.5e-1 OR ({_MEAN} < 5e-2 AND ({_ALPHA} < 3e-1 OR {_BIG} / {_SMALL} > 6e0)))"
_LIMITED = f"(SELECT s.*, quantile_cont({_BIG}, 0.75) OVER (PARTITION BY clip_id) AS size_limit FROM splats s)"
_NO_OCCLUDER = f"NOT ({_CLIPPED} < 5e-2 AND {_ALPHA} > 7e-1 AND {_BIG} > size_limit)"


@query("peak_alpha_prune", f"{_DIGEST} splats WHERE {_PEAK} >= 1e0 / 1024e0 GROUP BY clip_id", splats=X.SPLATS)
def _(spark, d):
    return _digest(X.splats(spark, d).filter(S.keep_peak_alpha(T0, T1)))


@query("bad_colour", f"{_DIGEST} splats WHERE {_GOOD_COLOUR} GROUP BY clip_id", splats=X.SPLATS)
def _(spark, d):
    return _digest(X.splats(spark, d).filter(S.keep_good_colour()))


@query("garbage_geometry", f"{_DIGEST} splats WHERE {_SOUND} GROUP BY clip_id", splats=X.SPLATS)
def _(spark, d):
    return _digest(X.splats(spark, d).filter(S.keep_sound_geometry()))


@query("dark_occluders", f"{_DIGEST} {_LIMITED} WHERE {_NO_OCCLUDER} GROUP BY clip_id", splats=X.SPLATS)
def _(spark, d):
    return _digest(S.with_dark_limit(X.splats(spark, d)).filter(S.keep_no_occluder()))


@query("black_floaters", f"{_DIGEST} splats WHERE {_NO_FLOATER} GROUP BY clip_id", splats=X.SPLATS)
def _(spark, d):
    return _digest(X.splats(spark, d).filter(S.keep_no_floater()))


@query(
    "filter_profile",
    f"{_DIGEST} {_LIMITED} WHERE {_PEAK} >= 1e0 / 1024e0 AND {_SOUND} AND {_GOOD_COLOUR} AND {_NO_OCCLUDER} AND {_NO_FLOATER} GROUP BY clip_id",
    splats=X.SPLATS,
)
def _(spark, d):
    return _digest(S.filter_splats(X.splats(spark, d), T0, T1, dark=True, black=True))


@query(
    "filter_profile_clean",
    f"{_DIGEST} splats WHERE {_PEAK} >= 1e0 / 1024e0 AND {_NO_FLOATER} AND splat_id % 3 <> 1 GROUP BY clip_id",
    splats=X.SPLATS,
)
def _(spark, d):
    s = X.splats(spark, d)
    listed = s.filter(F.col("splat_id") % 3 != 1).select("clip_id", "splat_id")
    return _digest(S.filter_splats(s, T0, T1, corrupted=False, black=True, keep=listed))


@query(
    "radius_filter",
    f"""{_DIGEST} splats JOIN (SELECT clip_id AS k, median(x) AS mx, median(y) AS my, median(z) AS mz FROM splats GROUP BY clip_id) a ON clip_id = k
    WHERE sqrt((x - mx) * (x - mx) + (y - my) * (y - my) + (z - mz) * (z - mz)) <= 12.3e0 GROUP BY clip_id""",
    splats=X.SPLATS,
)
def _(spark, d):
    s = X.splats(spark, d)
    return _digest(S.filter_radius(s, s.select("clip_id", "x", "y", "z"), 12.3))


@query(
    "keep_list",
    f"{_DIGEST} splats WHERE splat_id % 3 <> 1 GROUP BY clip_id",
    splats=X.SPLATS,
)
def _(spark, d):
    s = X.splats(spark, d)
    return _digest(S.apply_keep_list(s, s.select("clip_id", "splat_id", (F.col("splat_id") % 3 != 1).alias("keep"))))


@query(
    "top_fraction",
    f"""{_DIGEST} (SELECT clip_id, splat_id, rank() OVER (PARTITION BY clip_id ORDER BY {_PEAK} DESC) AS r,
      count(*) OVER (PARTITION BY clip_id) AS total FROM splats) WHERE r <= greatest(1, least(round_even(total * 0.1e0, 0), total)) GROUP BY clip_id""",
    splats=X.SPLATS,
)
def _(spark, d):
    return _digest(S.top_fraction(X.splats(spark, d), 0.1, T0, T1))


_IMPORTANCE = f"({_ALPHA} * exp((scale_0 + scale_1 + scale_2) / 3e0) * exp((scale_0 + scale_1 + scale_2) / 3e0))"


@query(
    "top_budget",
    f"""SELECT clip_id, frame, splat_id FROM (SELECT *, row_number() OVER (PARTITION BY clip_id, frame ORDER BY {_IMPORTANCE} DESC, splat_id) AS k FROM splats)
    WHERE k <= 100""",
    splats=X.SPLATS,
)
def _(spark, d):
    return S.top_budget(X.splats(spark, d), 700, 7).select("clip_id", "frame", "splat_id")


_W = "((5e0 - t_center) / greatest(abs(t_sigma), 1e-6))"


@query(
    "position_alpha_at",
    f"""SELECT clip_id, count(*) AS n, CAST(sum(splat_id) AS BIGINT) AS sum_id, CAST(sum(trunc((x + vx * (5e0 - t_center)) * 1e1)) AS BIGINT) AS cells
    FROM splats WHERE {_ALPHA} * exp(-5e-1 * {_W} * {_W}) > 2e-2 GROUP BY clip_id""",
    splats=X.SPLATS,
)
def _(spark, d):
    s = X.splats(spark, d).filter(alpha_at(5.0) > 0.02)
    return s.groupBy("clip_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("splat_id").alias("sum_id"), F.sum((position_at("x", 5.0) * 10.0).cast("long")).alias("cells")
    )


@query(
    "reanchor",
    """SELECT clip_id, splat_id, round(x + vx * dt + ax * dt * dt, 6) + 0e0 AS x, round(vx + 2e0 * ax * dt, 6) + 0e0 AS vx, ax, 2e0 AS t_center FROM
    (SELECT *, 2e0 - t_center AS dt, CASE WHEN splat_id % 4 = 0 THEN 0e0 ELSE (splat_id % 9 - 4) / 8e0 END AS ax FROM splats)""",
    splats=X.SPLATS,
)
def _(spark, d):
    accel = F.when(F.col("splat_id") % 4 != 0, (F.col("splat_id") % 9 - 4) / 8.0)
    s = S.reanchor(X.splats(spark, d).withColumns({"ax": accel, "ay": F.lit(0.0), "az": F.lit(0.0)}), 2.0)
    return s.select("clip_id", "splat_id", *((F.round(c, 6) + 0.0).alias(c) for c in ("x", "vx")), F.coalesce("ax", F.lit(0.0)).alias("ax"), "t_center")


@query(
    "frame_counts",
    """SELECT clip_id, min(n) AS least, quantile_cont(n, 0.5) AS median, max(n) AS most
    FROM (SELECT clip_id, frame, count(*) AS n FROM splats GROUP BY clip_id, frame) GROUP BY clip_id""",
    splats=X.SPLATS,
)
def _(spark, d):
    return S.frame_counts(X.splats(spark, d))


@query(
    "sample_every",
    f"{_DIGEST} (SELECT *, row_number() OVER (PARTITION BY clip_id ORDER BY splat_id) AS k FROM splats) WHERE (k - 1) % 7 = 0 GROUP BY clip_id",
    splats=X.SPLATS,
)
def _(spark, d):
    return _digest(S.sample_every(X.splats(spark, d), 7, ["clip_id"], ["splat_id"]))


_PROFILE_TIMES = [0.0, 2.75, 5.5, 8.25, 11.0]
_LIVE_AT = ", ".join(f"round(avg(CASE WHEN {_ALPHA} * exp(-5e-1 * (({t!r}e0 - t_center) / greatest(abs(t_sigma), 1e-6)) * (({t!r}e0 - t_center) / greatest(abs(t_sigma), 1e-6))) > 1e0 / 255e0 THEN 1e0 ELSE 0e0 END), 6) AS live_{i}" for i, t in enumerate(_PROFILE_TIMES))
_SHARES = ", ".join(f"round(quantile_cont({e}, {p}), 6) AS {n}_p{round(100 * p)}" for n, e in (("speed", "sqrt(vx * vx + vy * vy + vz * vz)"), ("sigma", "t_sigma"), ("accel", "sqrt(x * x / 1e4 + y * y + z * z)")) for p in (0.5, 0.95, 0.99))


@query("temporal_profile", f"SELECT clip_id, {_LIVE_AT}, {_SHARES} FROM splats GROUP BY clip_id", splats=X.SPLATS)
def _(spark, d):
    s = X.splats(spark, d).withColumns({"ax": F.col("x") / 100.0, "ay": F.col("y"), "az": F.col("z")})
    p = S.temporal_profile(s, _PROFILE_TIMES)
    return p.select("clip_id", *(F.round(c, 6).alias(c) for c in p.columns if c != "clip_id"))


_GRP = "CASE WHEN 2e0 * 3.8e0 * t_sigma > 3e0 * 1e-1 THEN -1 ELSE CAST(least(greatest(trunc((t_center - 0e0) / 1e-1), 0), 109) AS INT) END"
_SEGMENTS = f"""SELECT clip_id, CAST(seg_idx AS INT) AS seg_idx, first, first + n AS last, round(coalesce(low, nominal), 6) AS t0, round(coalesce(high, nominal + 1e-1), 6) AS t1 FROM (
  SELECT k.clip_id, k.g AS seg_idx, coalesce(n, 0) AS n, low, high, 0e0 + k.g * 1e-1 AS nominal,
    CAST(coalesce(sum(coalesce(n, 0)) OVER (PARTITION BY k.clip_id ORDER BY k.g ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first
  FROM (SELECT clip_id, unnest(range(-1, 110)) AS g FROM (SELECT DISTINCT clip_id FROM splats)) k
  LEFT JOIN (SELECT clip_id, {_GRP} AS g, count(*) AS n, min(t_center - 3.8e0 * t_sigma) AS low, max(t_center + 3.8e0 * t_sigma) AS high FROM splats GROUP BY clip_id, g) c
  ON k.clip_id = c.clip_id AND k.g = c.g) WHERE seg_idx >= 0"""


def _segments(spark, d) -> DataFrame:
    return temporal.segment_table(X.splats(spark, d), T0, T1, STEP)


@query("segment_table", _SEGMENTS, splats=X.SPLATS)
def segment_query(spark, d):
    return _segments(spark, d).withColumns({c: F.round(c, 6) for c in ("t0", "t1")})


_TIMES = [0.05 + 0.55 * k for k in range(20)]
_TIMES_SQL = "SELECT unnest([" + ", ".join(f"{t!r}e0" for t in _TIMES) + "]) AS t"
_PERSISTENT = "SELECT clip_id, count(*) FILTER (2e0 * 3.8e0 * t_sigma > 3e0 * 1e-1) AS persistent_end, count(*) AS splat_count FROM splats GROUP BY clip_id"
_RANGES_SQL = """SELECT p.clip_id, times.t, coalesce(min(first), 0) AS first, coalesce(max(last), 0) AS last, p.persistent_end, p.splat_count
  FROM persistent p CROSS JOIN times LEFT JOIN exact ON exact.clip_id = p.clip_id AND t0 <= times.t AND times.t <= t1 AND last > first
  GROUP BY p.clip_id, times.t, p.persistent_end, p.splat_count"""
_EXACT = _SEGMENTS.replace("round(coalesce(low, nominal), 6)", "coalesce(low, nominal)").replace("round(coalesce(high, nominal + 1e-1), 6)", "coalesce(high, nominal + 1e-1)")
_DRAWN = {"splats": X.SPLATS, "exact": _EXACT, "persistent": _PERSISTENT, "times": _TIMES_SQL, "ranges": _RANGES_SQL}


def _ranges(spark, d) -> tuple[DataFrame, DataFrame]:
    s = X.splats(spark, d)
    persistent = temporal.persistent_end(s, STEP)
    every = F.explode(F.array(*(F.lit(t) for t in _TIMES)))
    times = persistent.select("clip_id", every.alias("t"))
    return temporal.draw_ranges(_segments(spark, d), times, persistent), persistent


@query("draw_ranges", "SELECT clip_id, round(t, 6) AS t, first, last, persistent_end FROM ranges", **_DRAWN)
def _(spark, d):
    return _ranges(spark, d)[0].withColumn("t", F.round("t", 6))


@query(
    "drawn_fraction",
    "SELECT clip_id, round(avg((persistent_end + last - first) / splat_count), 6) AS mean_share, round(max((persistent_end + last - first) / splat_count), 6) AS max_share FROM ranges GROUP BY clip_id",
    **_DRAWN,
)
def _(spark, d):
    ranges, persistent = _ranges(spark, d)
    return temporal.drawn_fraction(ranges, persistent).select("clip_id", *(F.round(c, 6).alias(c) for c in ("mean_share", "max_share")))


_CELLS = [f"CAST(least(greatest(floor(({a} - lo_{a}) / CASE WHEN hi_{a} > lo_{a} THEN hi_{a} - lo_{a} ELSE 1e0 END * 1023e0), 0), 1023) AS BIGINT)" for a in "xyz"]


def _spread(v: str) -> str:
    for shift, mask in ((16, 0x30000FF), (8, 0x300F00F), (4, 0x30C30C3), (2, 0x9249249)):
        v = f"(({v} | ({v} << {shift})) & {mask})"
    return v


_BOXED = f"SELECT clip_id, splat_id, grp, {', '.join(f'{c} AS c{a}' for c, a in zip(_CELLS, 'xyz', strict=True))} FROM (SELECT *, {', '.join(f'{f}({a}) OVER (PARTITION BY clip_id, grp) AS {n}_{a}' for a in 'xyz' for n, f in (('lo', 'min'), ('hi', 'max')))} FROM (SELECT *, {_GRP} AS grp FROM splats))"
_BITS = [f"SELECT *, {_spread('cx')} AS bx, {_spread('cy')} AS by_, {_spread('cz')} AS bz FROM boxed"]
_ORDERED = f"SELECT clip_id, splat_id, grp, bx | (by_ << 1) | (bz << 2) AS morton FROM ({_BITS[0]})"
_FILE = "SELECT *, row_number() OVER (PARTITION BY clip_id ORDER BY grp, morton, splat_id) - 1 AS file_idx FROM ordered"
_ORDER_TABLES = {"splats": X.SPLATS, "boxed": _BOXED, "ordered": _ORDERED, "filed": _FILE}


def _order(spark, d) -> DataFrame:
    return temporal.order_splats(X.splats(spark, d), T0, T1, STEP)


@query("morton_order", "SELECT clip_id, grp, count(*) AS n, CAST(sum(morton) AS BIGINT) AS sum_morton, max(morton) AS max_morton FROM ordered GROUP BY clip_id, grp", **_ORDER_TABLES)
def _(spark, d):
    return _order(spark, d).groupBy("clip_id", "grp").agg(F.count(F.lit(1)).alias("n"), F.sum("morton").alias("sum_morton"), F.max("morton").alias("max_morton"))


@query("file_order", "SELECT clip_id, splat_id, file_idx FROM filed", **_ORDER_TABLES)
def _(spark, d):
    return _order(spark, d).select("clip_id", "splat_id", "file_idx")


@query(
    "splats_at",
    """SELECT r.clip_id, round(r.t, 6) AS t, count(*) AS n, CAST(sum(f.splat_id) AS BIGINT) AS sum_id FROM ranges r JOIN filed f ON f.clip_id = r.clip_id
    AND (f.file_idx < r.persistent_end OR (f.file_idx >= r.first AND f.file_idx < r.last)) GROUP BY r.clip_id, r.t""",
    **_DRAWN, **{k: v for k, v in _ORDER_TABLES.items() if k != "splats"},
)
def _(spark, d):
    at = temporal.splats_at(_order(spark, d), _ranges(spark, d)[0], _segments(spark, d))
    return at.groupBy("clip_id", F.round("t", 6).alias("t")).agg(F.count(F.lit(1)).alias("n"), F.sum("splat_id").alias("sum_id"))


_AXES = [("means", i, c) for i, c in enumerate("xyz")] + [("motion", i, f"v{c}") for i, c in enumerate("xyz")]
_LOG = lambda c: f"(sign({c}) * ln(1e0 + abs({c})))"


@query(
    "axis_ranges",
    " UNION ALL ".join(f"SELECT clip_id, '{g}' AS grp, {i} AS axis, round(min({_LOG(c)}), 6) AS mn, round(max({_LOG(c)}), 6) AS mx FROM splats GROUP BY clip_id" for g, i, c in _AXES),
    splats=X.SPLATS,
)
def _(spark, d):
    return quantize.axis_ranges(X.splats(spark, d)).withColumns({c: F.round(c, 6) for c in ("mn", "mx")})


_LINEAR = "CAST(least(greatest(round_even((x - mn) / CASE WHEN mx > mn THEN mx - mn ELSE 1e0 END * 65535e0, 0), 0), 65535) AS INT)"


@query(
    "split16",
    f"SELECT clip_id, splat_id, {_LINEAR} & 255 AS lo, {_LINEAR} >> 8 AS hi FROM (SELECT *, min(x) OVER (PARTITION BY clip_id) AS mn, max(x) OVER (PARTITION BY clip_id) AS mx FROM splats)",
    splats=X.SPLATS,
)
def _(spark, d):
    s = X.splats(spark, d)
    r = s.groupBy("clip_id").agg(F.min("x").alias("mn"), F.max("x").alias("mx"))
    q = E.split16(F.col("x"), F.col("mn"), F.col("mx"))
    return s.join(F.broadcast(r), "clip_id").select("clip_id", "splat_id", E.low_byte(q).cast("int").alias("lo"), E.high_byte(q).cast("int").alias("hi"))


_T = "(sign(x) * ln(1e0 + abs(x)))"
_CODE = "least(greatest(round_even((t - mn) / CASE WHEN mx > mn THEN mx - mn ELSE 1e0 END * 65535e0, 0), 0), 65535)"


@query(
    "split16_roundtrip",
    f"""SELECT clip_id, splat_id, round(sign(u) * (exp(abs(u)) - 1e0), 6) + 0e0 AS x, abs(x - sign(u) * (exp(abs(u)) - 1e0)) > (mx - mn) / 65535e0 * (1e0 + abs(x)) + 1e-6 * abs(x) + 1e-9 AS beyond
    FROM (SELECT *, mn + {_CODE} / 65535e0 * CASE WHEN mx > mn THEN mx - mn ELSE 1e0 END AS u FROM (SELECT *, {_T} AS t, min({_T}) OVER (PARTITION BY clip_id) AS mn, max({_T}) OVER (PARTITION BY clip_id) AS mx FROM splats))""",
    splats=X.SPLATS,
)
def _(spark, d):
    s = X.splats(spark, d)
    ranges = quantize.axis_ranges(s)
    packed = quantize.dequantise(quantize.quantise(_order(spark, d), ranges), ranges)
    both = s.select("clip_id", "splat_id", "x").join(packed.select("clip_id", "splat_id", F.col("x").alias("got")), ["clip_id", "splat_id"])
    wide = ranges.filter("grp = 'means' and axis = 0").select("clip_id", "mn", "mx")
    over = F.abs(F.col("x") - F.col("got")) > compare.split16_tolerance(F.col("x"), F.col("mn"), F.col("mx"))
    return both.join(F.broadcast(wide), "clip_id").select("clip_id", "splat_id", (F.round("got", 6) + 0.0).alias("x"), over.alias("beyond"))


_Q = [f"(rot_{i} / greatest(sqrt(rot_0 * rot_0 + rot_1 * rot_1 + rot_2 * rot_2 + rot_3 * rot_3), 1e-12))" for i in range(4)]


_BIG_AT = f"(list_position([{', '.join(f'abs({_Q[i]})' for i in (1, 2, 3, 0))}], greatest({', '.join(f'abs({q})' for q in _Q)})) % 4)"
_BYTE = lambda c: f"CAST(least(greatest(round_even(({c} * sg * sqrt(2e0) / 2e0 + 5e-1) * 255e0, 0), 0), 255) AS INT)"


@query(
    "quat_smallest_three",
    f"""SELECT clip_id, splat_id, {_BYTE('kept[1]')} AS b0, {_BYTE('kept[2]')} AS b1, {_BYTE('kept[3]')} AS b2, CAST(252 + big AS INT) AS mode FROM
    (SELECT *, CASE WHEN q[big + 1] < 0 THEN -1e0 ELSE 1e0 END AS sg, list_filter(q, lambda v, i: i <> big + 1) AS kept FROM (SELECT clip_id, splat_id, [{', '.join(_Q)}] AS q, {_BIG_AT} AS big FROM splats))""",
    splats=X.SPLATS,
)
def _(spark, d):
    packed = E.smallest_three([F.col(f"rot_{i}") for i in range(4)])
    return X.splats(spark, d).select("clip_id", "splat_id", *(packed[c].cast("int").alias(c) for c in ("b0", "b1", "b2", "mode")))


@query(
    "codebook_gap",
    """SELECT clip_id, attr, round(max(gap) / 2e0, 9) AS tolerance FROM (SELECT clip_id, attr, lead(value) OVER (PARTITION BY clip_id, attr ORDER BY value) - value AS gap FROM
    (SELECT DISTINCT clip_id, 't_sigma' AS attr, t_sigma AS value FROM splats UNION ALL SELECT DISTINCT clip_id, 'scale', scale_1 FROM splats)) GROUP BY clip_id, attr""",
    splats=X.SPLATS,
)
def _(spark, d):
    s = X.splats(spark, d)
    books = s.select("clip_id", F.lit("t_sigma").alias("attr"), F.col("t_sigma").alias("value")).distinct()
    books = books.union(s.select("clip_id", F.lit("scale"), "scale_1").distinct())
    return quantize.adjacent_gap(books).withColumn("tolerance", F.round("tolerance", 9))


#: Side b has known defects: opacity in every fifth row, positions in every seventh, speeds scaled, durations longer in every fourth and rotations turned in every sixth.
_DEFECTS = {
    "opacity": "opacity + CASE WHEN splat_id % 5 = 0 THEN 5e-1 ELSE 0e0 END",
    "x": "x + CASE WHEN splat_id % 7 = 0 THEN 1e0 / (1 + splat_id % 3) ELSE 0e0 END",
    "t_sigma": "t_sigma * CASE WHEN splat_id % 4 = 0 THEN 1.5e0 ELSE 1.001e0 END",
    "rot_0": "CASE WHEN splat_id % 6 = 0 THEN rot_0 * 9e-1 + 1e-2 ELSE -rot_0 END",
    **{f"rot_{i}": f"CASE WHEN splat_id % 6 = 0 THEN rot_{i} ELSE -rot_{i} END" for i in (1, 2, 3)},
}


def _two_sides(spark, d) -> tuple[DataFrame, DataFrame]:
    """Splats, and a copy with the known defects."""
    a = X.splats(spark, d)
    return a, a.select(*(F.expr(_DEFECTS[c].replace("e0", "D").replace("5e-1", "0.5D").replace("9e-1", "0.9D").replace("1e-2", "0.01D")).alias(c) if c in _DEFECTS else c for c in a.columns))


def _joined(a: DataFrame, b: DataFrame, fields: list[str]) -> DataFrame:
    side = lambda df, n: df.select("clip_id", "splat_id", *(F.col(c).alias(f"{n}_{c}") for c in fields))
    return side(a, "a").join(side(b, "b"), ["clip_id", "splat_id"])


_ERROR_OF = {
    "opacity": f"abs({_ALPHA} - 1e0 / (1e0 + exp(-({_DEFECTS['opacity']}))))",
    "x": f"abs(x - ({_DEFECTS['x']}))",
    "t_sigma": f"abs(t_sigma - {_DEFECTS['t_sigma']})",
    "y": "abs(y - y)",
}


@query(
    "error_table",
    " UNION ALL ".join(f"SELECT clip_id, '{c}' AS field, round(avg({e}), 6) AS mean_error, round(quantile_cont({e}, 0.99), 6) AS p99_error, round(max({e}), 6) AS max_error FROM splats GROUP BY clip_id" for c, e in _ERROR_OF.items()),
    splats=X.SPLATS,
)
def _(spark, d):
    out = compare.error_table(_joined(*_two_sides(spark, d), list(_ERROR_OF)), list(_ERROR_OF))
    return out.withColumns({c: F.round(c, 6) for c in ("mean_error", "p99_error", "max_error")})


_LOG_X = "(max(sign(x) * ln(1e0 + abs(x))) - min(sign(x) * ln(1e0 + abs(x)))) / 65535e0"


@query(
    "judge_fields",
    f"""SELECT clip_id, 'opacity' AS field, NULL AS over_share, 'advisory' AS verdict FROM splats GROUP BY clip_id
    UNION ALL SELECT clip_id, 't_center', 0e0, 'pass' FROM splats GROUP BY clip_id
    UNION ALL SELECT clip_id, 'x', round(avg(over), 6), CASE WHEN max(over) > 0 THEN 'fail' ELSE 'pass' END FROM (SELECT clip_id, CASE WHEN e > 1.001e0 * 2e0 * (step * (1e0 + abs(x)) + 1e-6 * abs(x) + 1e-9) + 1e-9 THEN 1e0 ELSE 0e0 END AS over
      FROM (SELECT clip_id, x, abs(x - ({_DEFECTS['x']})) AS e FROM splats) JOIN (SELECT clip_id, {_LOG_X} AS step FROM splats GROUP BY clip_id) r USING (clip_id)) GROUP BY clip_id
    UNION ALL SELECT clip_id, 'scale_1', round(avg(over), 6), CASE WHEN avg(over) > 1e-2 THEN 'fail' ELSE 'pass' END FROM (SELECT clip_id, CASE WHEN splat_id % 47 = 0 AND clip_id < 2 AND 3e-1 > 1.001e0 * gap + 1e-9 THEN 1e0 ELSE 0e0 END AS over FROM splats
      JOIN (SELECT clip_id, max(g) / 2e0 AS gap FROM (SELECT clip_id, lead(scale_1) OVER (PARTITION BY clip_id ORDER BY scale_1) - scale_1 AS g FROM (SELECT DISTINCT clip_id, scale_1 FROM splats)) GROUP BY clip_id) b USING (clip_id)) GROUP BY clip_id""",
    splats=X.SPLATS,
)
def _(spark, d):
    a, b = _two_sides(spark, d)
    b = b.withColumn("scale_1", F.col("scale_1") + F.when((F.col("splat_id") % 47 == 0) & (F.col("clip_id") < 2), 0.3).otherwise(0.0))
    fields = ["opacity", "t_center", "x", "scale_1"]
    books = a.select("clip_id", F.lit("scale").alias("attr"), F.col("scale_1").alias("value")).distinct()
    books = books.unionByName(a.select("clip_id", F.lit("t_center").alias("attr"), F.col("t_center").alias("value")).distinct())
    ranges = quantize.axis_ranges(a)
    bounded = compare.tolerances(_joined(a, b, fields), fields, [(ranges, books), (ranges, None)])
    return compare.judge_each(bounded, fields).withColumn("over_share", F.round("over_share", 6))


_KEYED = ", ".join(f"CAST(least(greatest(round_even((t_{c} - min(t_{c}) OVER (PARTITION BY clip_id)) / CASE WHEN max(t_{c}) OVER (PARTITION BY clip_id) > min(t_{c}) OVER (PARTITION BY clip_id) THEN max(t_{c}) OVER (PARTITION BY clip_id) - min(t_{c}) OVER (PARTITION BY clip_id) ELSE 1e0 END * 65535e0, 0), 0), 65535) AS INT) AS k_{c}" for c in compare.KEYS)
_LOGS = ", ".join(f"(sign({c}) * ln(1e0 + abs({c}))) AS t_{c}" for c in compare.KEYS)
_KEY_TABLE = f"SELECT clip_id, splat_id, grp, {_KEYED} FROM (SELECT clip_id, splat_id, {_GRP} AS grp, {_LOGS} FROM splats)"
_KEY_ORDER = ", ".join(f"k_{c}" for c in compare.KEYS)
#: Side b holds one splat in 997 at another place and one a step off, and the ids of neighbours exchanged.
_RANKED = f"SELECT *, row_number() OVER (PARTITION BY clip_id, grp ORDER BY {_KEY_ORDER}, splat_id) AS rank FROM"
_PAIR_TABLES = {"splats": X.SPLATS, "keyed": _KEY_TABLE, "moved": "SELECT clip_id, splat_id + 1 - 2 * (splat_id % 2) AS splat_id, grp, CAST(CASE WHEN splat_id % 997 = 0 THEN (k_x + 40) % 65536 WHEN splat_id % 997 = 500 THEN k_x + 1 ELSE k_x END AS INT) AS k_x, " + ", ".join(f"k_{c}" for c in compare.KEYS[1:]) + " FROM keyed"}


def _keyed_sides(spark, d) -> tuple[DataFrame, DataFrame]:
    s = X.splats(spark, d)
    a = compare.integer_keys(temporal.with_group(s, T0, T1, STEP), quantize.axis_ranges(s))
    k, i = F.col("k_x"), F.col("splat_id")
    b = a.withColumn("k_x", F.when(i % 997 == 0, (k + 40) % 65536).when(i % 997 == 500, k + 1).otherwise(k).cast("int"))
    return a, b.withColumn("splat_id", i + 1 - 2 * (i % 2))


@query(
    "pair_splats",
    f"SELECT a.clip_id, a.grp, a.rank, a.splat_id AS a_splat_id, b.splat_id AS b_splat_id FROM ({_RANKED} keyed) a JOIN ({_RANKED} moved) b ON a.clip_id = b.clip_id AND a.grp = b.grp AND a.rank = b.rank",
    **_PAIR_TABLES,
)
def _(spark, d):
    return compare.pair_splats(*_keyed_sides(spark, d), ["splat_id"])


_APART = f"greatest({', '.join(f'abs(a.k_{c} - b.k_{c})' for c in compare.KEYS)})"


@query(
    "membership",
    f"SELECT a.clip_id, a.grp, count(*) AS offenders FROM ({_RANKED} keyed) a JOIN ({_RANKED} moved) b ON a.clip_id = b.clip_id AND a.grp = b.grp AND a.rank = b.rank WHERE {_APART} > 1 GROUP BY a.clip_id, a.grp",
    **_PAIR_TABLES,
)
def _(spark, d):
    return compare.membership(compare.pair_splats(*_keyed_sides(spark, d), [f"k_{c}" for c in compare.KEYS]))


@query(
    "displaced",
    f"SELECT a.clip_id, CAST(sum(CASE WHEN a.splat_id <> b.splat_id THEN 1 ELSE 0 END) AS BIGINT) AS displaced FROM ({_RANKED} keyed) a JOIN ({_RANKED} moved) b ON a.clip_id = b.clip_id AND a.grp = b.grp AND a.rank = b.rank GROUP BY a.clip_id",
    **_PAIR_TABLES,
)
def _(spark, d):
    return compare.displaced(compare.pair_splats(*_keyed_sides(spark, d), ["splat_id"]))


@query("same_rows", f"SELECT 'a' AS side, clip_id, splat_id, round(opacity, 6) AS opacity FROM splats WHERE splat_id % 5 = 0 UNION ALL SELECT 'b', clip_id, splat_id, round({_DEFECTS['opacity']}, 6) FROM splats WHERE splat_id % 5 = 0", splats=X.SPLATS)
def _(spark, d):
    a, b = (x.select("clip_id", "splat_id", "opacity") for x in _two_sides(spark, d))
    return compare.same_rows(a, b).withColumn("opacity", F.round("opacity", 6))


# cameras, keypoints and masks

_IMAGES = "SELECT DISTINCT concat('shots/', CASE c_custkey % 3 WHEN 0 THEN 'cam_' WHEN 1 THEN 'take' ELSE 'xcam_' END, CAST(c_custkey % 40 AS STRING), CASE WHEN c_custkey % 3 = 2 THEN '_b' ELSE '' END, '.jpg') AS image FROM customer"


@query(
    "match_camera",
    """SELECT image, coalesce(exact, number, part) AS camera_label, CASE WHEN exact IS NOT NULL THEN 'exact' WHEN number IS NOT NULL THEN 'number' ELSE 'part' END AS rule FROM (
      SELECT image, (SELECT camera_label FROM rig WHERE camera_label = stem) AS exact,
        (SELECT min(camera_label) FROM rig WHERE regexp_extract(camera_label, '(\\d+)$', 1) = regexp_extract(stem, '(\\d+)$', 1) AND regexp_extract(stem, '(\\d+)$', 1) <> '') AS number,
        (SELECT arg_min(camera_label, lpad(CAST(1000 - length(camera_label) AS STRING), 4, '0') || camera_label) FROM rig WHERE contains(stem, camera_label) OR contains(camera_label, stem)) AS part
      FROM (SELECT image, regexp_replace(regexp_replace(image, '^.*/', ''), '[.][^.]*$', '') AS stem FROM images)) WHERE coalesce(exact, number, part) IS NOT NULL""",
    images=_IMAGES, rig=f"SELECT DISTINCT camera_label FROM ({X.RIG}) AS r",
)
def _(spark, d):
    return C.match_camera(X.derive(spark, d, _IMAGES), X.cameras(spark, d))


_U, _V, _D = X.projected()
_RIGGED = "(SELECT capture_id AS rig_capture, camera_label, c, s, tx, tz FROM rig) AS r"
_PIXELS = f"SELECT capture_id, clip_id, splat_id, camera_label, CAST(trunc(u) AS INT) AS px, CAST(trunc(v) AS INT) AS py FROM (SELECT capture_id, clip_id, splat_id, camera_label, {_U} AS u, {_V} AS v, {_D} AS dz FROM splats JOIN {_RIGGED} ON rig_capture = capture_id WHERE {_ALPHA} > 1e-1) WHERE dz > 1e-2 AND u >= 0 AND v >= 0 AND trunc(u) < 96 AND trunc(v) < 64"
_VOTES = "SELECT p.capture_id, p.clip_id, p.splat_id, count(*) AS tested, count(*) FILTER (r.y IS NULL) AS outside FROM pixels p LEFT JOIN runs r ON r.capture_id = p.capture_id AND r.camera_label = p.camera_label AND r.y = p.py AND p.px BETWEEN r.x0 AND r.x1 GROUP BY p.capture_id, p.clip_id, p.splat_id"
_VOTE_TABLES = {"splats": X.SPLATS, "rig": X.RIG, "runs": X.RUNS, "pixels": _PIXELS, "votes": _VOTES}


@query("project_points", f"SELECT capture_id, tem, camera_label, count(*) AS n, CAST(sum(CAST(trunc({_U}) AS INT)) AS BIGINT) AS sum_px FROM points JOIN {_RIGGED} ON rig_capture = capture_id WHERE {_D} > 1e-6 GROUP BY capture_id, tem, camera_label", points=X.POINTS, rig=X.RIG)
def _(spark, d):
    p = C.project_points(X.derive(spark, d, X.POINTS), X.cameras(spark, d)).filter("u is not null")
    return p.groupBy("capture_id", "tem", "camera_label").agg(F.count(F.lit(1)).alias("n"), F.sum(C.truncated_pixel(F.col("u"))).alias("sum_px"))


def _votes(spark, d) -> DataFrame:
    return C.mask_votes(X.splats(spark, d), X.cameras(spark, d), X.derive(spark, d, X.RUNS))


_COUNT_VOTES = "SELECT clip_id, tested, outside, count(*) AS n FROM votes GROUP BY clip_id, tested, outside"


def _count_votes(votes: DataFrame) -> DataFrame:
    return votes.groupBy("clip_id", "tested", "outside").agg(F.count(F.lit(1)).alias("n"))


@query("splat_mask_votes", _COUNT_VOTES, **_VOTE_TABLES)
def _(spark, d):
    return _count_votes(_votes(spark, d))


#: The queries named ``..._rig`` give each row, where those without give counts of equal ones.
@query("splat_mask_votes_rig", "SELECT * FROM votes", **_VOTE_TABLES)
def _(spark, d):
    return _votes(spark, d)


@query("mask_filter", f"{_DIGEST} votes WHERE outside / tested >= 5e-1 GROUP BY clip_id", **_VOTE_TABLES)
def _(spark, d):
    return _digest(C.vote_fraction(_votes(spark, d)))


@query("mask_filter_rig", "SELECT capture_id, clip_id, splat_id, round(outside / tested, 6) AS fraction FROM votes WHERE outside / tested >= 5e-1", **_VOTE_TABLES)
def _(spark, d):
    return C.vote_fraction(_votes(spark, d)).select("capture_id", "clip_id", "splat_id", F.round("fraction", 6).alias("fraction"))


_LIFE = [0.5 + k for k in range(10)]
_LIVE = "(SELECT s.*, k AS frame_idx, 5e-1 + k AS t FROM splats s CROSS JOIN (SELECT unnest(range(0, 10)) AS k))"
_LW = "((t - t_center) / greatest(abs(t_sigma), 1e-9))"
_MOVED = f"SELECT capture_id, clip_id, splat_id, frame_idx, x + vx * (t - t_center) AS x, y + vy * (t - t_center) AS y, z + vz * (t - t_center) AS z FROM {_LIVE} WHERE {_ALPHA} > 2e-2 AND {_ALPHA} * exp(-5e-1 * {_LW} * {_LW}) > 2e-2"
_LIFE_PIXELS = f"SELECT capture_id, clip_id, splat_id, frame_idx, camera_label, CAST(trunc(u) AS INT) AS px, CAST(trunc(v) AS INT) AS py FROM (SELECT capture_id, clip_id, splat_id, frame_idx, camera_label, {_U} AS u, {_V} AS v, {_D} AS dz FROM moved JOIN {_RIGGED} ON rig_capture = capture_id) WHERE dz > 5e-2 AND u >= 0 AND v >= 0 AND trunc(u) < 96 AND trunc(v) < 64"
_LIFE_VOTES = """SELECT p.capture_id, p.clip_id, p.splat_id, count(*) AS tested, count(*) FILTER (r.y IS NULL) AS outside FROM pixels p
    LEFT JOIN runs r ON r.capture_id = p.capture_id AND r.camera_label = p.camera_label AND r.y = p.py AND p.px BETWEEN r.x0 + p.frame_idx AND r.x1 GROUP BY p.capture_id, p.clip_id, p.splat_id"""
_LIFE_TABLES = {"splats": X.SPLATS, "rig": X.RIG, "runs": X.RUNS, "moved": _MOVED, "pixels": _LIFE_PIXELS, "votes": _LIFE_VOTES}


def _timed_runs(spark, d) -> DataFrame:
    return X.derive(spark, d, X.RUNS).withColumn("frame_idx", F.explode(F.sequence(F.lit(0), F.lit(9)))).withColumn("x0", F.col("x0") + F.col("frame_idx"))


def _life_votes(spark, d) -> DataFrame:
    return C.lifetime_votes(X.splats(spark, d), X.cameras(spark, d), _timed_runs(spark, d), _LIFE)


@query("lifetime_votes", _COUNT_VOTES, **_LIFE_TABLES)
def _(spark, d):
    return _count_votes(_life_votes(spark, d))


@query("lifetime_votes_rig", "SELECT * FROM votes", **_LIFE_TABLES)
def _(spark, d):
    return _life_votes(spark, d)


@query("lifetime_drop", "SELECT clip_id, count(*) AS n, CAST(sum(splat_id) AS BIGINT) AS sum_id FROM splats WHERE splat_id NOT IN (SELECT splat_id FROM votes WHERE 2 * outside > tested) GROUP BY clip_id", **_LIFE_TABLES)
def _(spark, d):
    return _digest(C.drop_by_lifetime(X.splats(spark, d), X.cameras(spark, d), _timed_runs(spark, d), _LIFE))


_HULL = f"""SELECT p.capture_id, p.tem, p.kp_idx, count(r.y) AS votes FROM (SELECT capture_id, tem, kp_idx, camera_label, CAST(trunc({_U}) AS INT) AS px, CAST(trunc({_V}) AS INT) AS py FROM points JOIN {_RIGGED} ON rig_capture = capture_id
    WHERE {_D} > 5e-2 AND {_U} >= 0 AND {_V} >= 0 AND trunc({_U}) < 96 AND trunc({_V}) < 64) p LEFT JOIN runs r ON r.capture_id = p.capture_id AND r.camera_label = p.camera_label AND r.y = p.py AND p.px BETWEEN r.x0 AND r.x1 GROUP BY p.capture_id, p.tem, p.kp_idx"""
_HULL_TABLES = {"points": X.POINTS, "rig": X.RIG, "runs": X.RUNS, "hull": _HULL}


def _hull_votes(spark, d) -> DataFrame:
    points = X.derive(spark, d, X.POINTS).withColumn("point_id", F.col("kp_idx"))
    return C.hull_votes(points, X.cameras(spark, d), X.derive(spark, d, X.RUNS), 5)


@query("hull_votes", "SELECT tem, votes, count(*) AS n FROM hull WHERE votes >= 5 GROUP BY tem, votes", **_HULL_TABLES)
def _(spark, d):
    return _hull_votes(spark, d).groupBy("tem", "votes").agg(F.count(F.lit(1)).alias("n"))


@query("hull_votes_rig", "SELECT capture_id, kp_idx, votes FROM hull WHERE votes >= 5", **_HULL_TABLES)
def _(spark, d):
    return _hull_votes(spark, d).select("capture_id", "kp_idx", "votes")


def _images(spark, d) -> DataFrame:
    return X.cameras(spark, d).select("capture_id", "camera_label", "w", "h")


@query("mask_coverage", "SELECT capture_id, camera_label, round(sum(x1 - x0 + 1) / (96e0 * 64e0), 6) AS coverage FROM runs GROUP BY capture_id, camera_label", runs=X.RUNS)
def _(spark, d):
    return C.mask_coverage(X.derive(spark, d, X.RUNS), _images(spark, d)).withColumn("coverage", F.round("coverage", 6))


_COVERED = """SELECT g.capture_id, g.camera_label, round(coalesce(avg(CASE WHEN o.camera_label IS NULL THEN NULL WHEN r.y IS NULL THEN 0e0 ELSE 1e0 END), 0e0), 6) AS coverage FROM rig g LEFT JOIN
    (SELECT capture_id, camera_label, CAST(least(greatest(round_even(u, 0), 0), 95) AS INT) AS px, CAST(least(greatest(round_even(v, 0), 0), 63) AS INT) AS py FROM obs) o ON o.capture_id = g.capture_id AND o.camera_label = g.camera_label
    LEFT JOIN runs r ON r.capture_id = o.capture_id AND r.camera_label = o.camera_label AND r.y = o.py AND o.px BETWEEN r.x0 AND r.x1 GROUP BY g.capture_id, g.camera_label"""


@query("keypoint_coverage", _COVERED, obs=X.OBSERVATIONS, runs=X.RUNS, rig=X.RIG)
def _(spark, d):
    return C.keypoint_coverage(X.derive(spark, d, X.OBSERVATIONS), X.derive(spark, d, X.RUNS), _images(spark, d)).withColumn("coverage", F.round("coverage", 6))


_ERRORS = f"SELECT *, sqrt((u - pu) * (u - pu) + (v - pv) * (v - pv)) AS error FROM (SELECT o.*, {_U} AS pu, {_V} AS pv, {_D} AS dz FROM obs o JOIN (SELECT tem AS pt, kp_idx AS pk, x, y, z FROM points) ON pt = o.tem AND pk = o.kp_idx JOIN {_RIGGED.replace('camera_label', 'camera_label AS cl')} ON cl = o.camera_label AND rig_capture = o.capture_id) WHERE dz > 1e-6"
_ERROR_TABLES = {"points": X.POINTS, "rig": X.RIG, "obs": X.OBSERVATIONS, "errors": _ERRORS}


def _observed(spark, d):
    return X.derive(spark, d, X.OBSERVATIONS), X.derive(spark, d, X.POINTS), X.cameras(spark, d)


@query(
    "residual_report",
    "SELECT capture_id, camera_label, round(quantile_cont(error, 0.5), 5) AS median, round(avg(error), 5) AS mean, round(quantile_cont(error, 0.9), 5) AS p90, count(*) AS n FROM errors GROUP BY GROUPING SETS ((capture_id, camera_label), (capture_id))",
    **_ERROR_TABLES,
)
def _(spark, d):
    return C.residual_report(*_observed(spark, d)).withColumns({c: F.round(c, 5) for c in ("median", "mean", "p90")})


@query(
    "drop_outliers",
    "SELECT capture_id, camera_label, count(*) AS n, CAST(sum(kp_idx) AS BIGINT) AS sum_kp FROM (SELECT *, count(*) OVER (PARTITION BY capture_id, tem, kp_idx) AS views FROM errors WHERE error <= 200) WHERE views >= 25 GROUP BY capture_id, camera_label",
    **_ERROR_TABLES,
)
def _(spark, d):
    kept = C.drop_outliers(*_observed(spark, d), min_views=25)
    return kept.groupBy("capture_id", "camera_label").agg(F.count(F.lit(1)).alias("n"), F.sum("kp_idx").alias("sum_kp"))


for _name in ("keypoint_coverage", "residual_report", "drop_outliers"):  # the whole rig has been their input since the second round
    QUERIES[f"{_name}_rig"], ORACLES[f"{_name}_rig"] = QUERIES[_name], ORACLES[_name]


@query("camera_pairs", "SELECT a.capture_id, a.camera_label AS cam_a, b.camera_label AS cam_b FROM rig a JOIN rig b ON a.capture_id = b.capture_id AND a.camera_label < b.camera_label", rig=X.RIG)
def _(spark, d):
    return C.camera_pairs(X.cameras(spark, d))


@query("dense_labels", "SELECT capture_id, camera_label, lpad(CAST(row_number() OVER (PARTITION BY capture_id ORDER BY camera_label) - 1 AS STRING), 2, '0') AS dense FROM rig", rig=X.RIG)
def _(spark, d):
    return C.dense_labels(X.cameras(spark, d)).select("capture_id", "camera_label", "dense")


@query(
    "holdout_split",
    "SELECT capture_id, camera_label, CASE WHEN camera_label = 'cam_3' THEN 'test' ELSE 'train' END AS split FROM rig WHERE camera_label <> 'cam_5'",
    rig=X.RIG,
)
def _(spark, d):
    return C.holdout_split(X.cameras(spark, d), ["cam_3"], ["cam_3", "cam_5"]).select("capture_id", "camera_label", "split")


@query(
    "relabel_unknown",
    "SELECT image FROM images WHERE CAST(nullif(regexp_extract(regexp_replace(image, '[.][^.]*$', ''), '(\\d+)$', 1), '') AS BIGINT) IS NULL OR TRY_CAST(regexp_extract(regexp_replace(image, '[.][^.]*$', ''), '(\\d+)$', 1) AS BIGINT) NOT IN (SELECT n_nationkey FROM nation)",
    images=_IMAGES,
)
def _(spark, d):
    labels = X.cameras(spark, d).select(trailing_id(camera_label(F.col("camera_label"))).alias("camera_id"), "camera_label").distinct()
    return C.relabel(X.derive(spark, d, _IMAGES), labels, labels)[1].select("image")


# sync

_NCC = """SELECT capture_id, cam_a, cam_b, lag, count(*) AS overlap, sum(a * b) AS ab, sum(a * a) AS aa, sum(b * b) AS bb, min(least(na, nb)) AS shorter FROM (
  SELECT x.capture_id, x.camera AS cam_a, y.camera AS cam_b, y.i - x.i AS lag, x.value AS a, y.value AS b, x.n AS na, y.n AS nb FROM (SELECT *, count(*) OVER (PARTITION BY capture_id, camera) AS n FROM env) x
  JOIN (SELECT *, count(*) OVER (PARTITION BY capture_id, camera) AS n FROM env) y ON x.capture_id = y.capture_id AND x.camera < y.camera AND y.i - x.i BETWEEN -24 AND 24) GROUP BY capture_id, cam_a, cam_b, lag"""
_PROFILE = "SELECT capture_id, cam_a, cam_b, lag, overlap, ab / sqrt(aa * bb) AS ncc FROM sums WHERE overlap >= greatest(2, floor(5e-1 * shorter)) AND sqrt(aa * bb) > 1e-12"
_PEAKS = """SELECT *, (ncc - before) + (ncc - after) AS fall FROM (SELECT capture_id, cam_a, cam_b, lag, ncc, row_number() OVER (PARTITION BY capture_id, cam_a, cam_b ORDER BY ncc DESC, lag) AS k,
    CASE WHEN lag(lag) OVER w = lag - 1 THEN lag(ncc) OVER w END AS before, CASE WHEN lead(lag) OVER w = lag + 1 THEN lead(ncc) OVER w END AS after
    FROM profile WINDOW w AS (PARTITION BY capture_id, cam_a, cam_b ORDER BY lag)) WHERE k = 1"""
_BEST = """SELECT p.capture_id, p.cam_a, p.cam_b, p.lag, -(p.lag + CASE WHEN fall > 0 THEN least(greatest((after - before) / (2e0 * fall), -1e0), 1e0) ELSE 0e0 END) AS offset_seconds, p.ncc AS match_quality,
    CASE WHEN p.ncc <= 0 THEN 1e0 WHEN second IS NULL OR second <= 0 THEN CAST('inf' AS DOUBLE) ELSE greatest(p.ncc / second, 1e0) END AS peak_ratio FROM peaks p
    LEFT JOIN LATERAL (SELECT max(o.ncc) AS second FROM profile o WHERE o.capture_id = p.capture_id AND o.cam_a = p.cam_a AND o.cam_b = p.cam_b AND abs(o.lag - p.lag) > 2) q ON true"""
_LAG_TABLES = {"env": X.ENVELOPES, "sums": _NCC, "profile": _PROFILE, "peaks": _PEAKS, "best": _BEST}


@query("ncc_profile", "SELECT capture_id, cam_a, cam_b, lag, overlap, round(ncc, 6) AS ncc FROM profile", env=X.ENVELOPES, sums=_NCC, profile=_PROFILE)
def _(spark, d):
    p = sync.ncc_profile(X.derive(spark, d, X.ENVELOPES), 24)
    return p.select("capture_id", "cam_a", "cam_b", "lag", "overlap", F.round("ncc", 6).alias("ncc"))


@query(
    "best_lag",
    "SELECT capture_id, cam_a, cam_b, lag, round(offset_seconds, 5) + 0e0 AS offset_seconds, round(match_quality, 6) AS match_quality, round(peak_ratio, 5) AS peak_ratio, match_quality >= 4e-1 AND peak_ratio >= 1.02e0 AS confident FROM best",
    **_LAG_TABLES,
)
def _(spark, d):
    best = sync.best_lag(sync.ncc_profile(X.derive(spark, d, X.ENVELOPES), 24), 1.0, apart_seconds=2.0, ratio=1.02)
    return best.withColumns({"offset_seconds": F.round("offset_seconds", 5) + 0.0, "match_quality": F.round("match_quality", 6), "peak_ratio": F.round("peak_ratio", 5)})


def _pairs(spark, d) -> tuple[DataFrame, DataFrame]:
    pairs = X.derive(spark, d, X.PAIRS.replace("chain", f"({X.CHAIN}) AS chain"))
    return pairs, pairs.groupBy("capture_id").agg(F.min("cam_a").alias("camera"))


_TIED = """SELECT o_custkey AS capture_id, 'cam_' || CAST(1000 + k AS STRING) AS camera, coalesce(sum(own) OVER (PARTITION BY o_custkey ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0) AS start,
    coalesce(sum(CASE WHEN linked THEN 0 ELSE 1 END) OVER (PARTITION BY o_custkey ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS breaks FROM chain WHERE k > 1 OR next_key IS NOT NULL"""


@query("offset_lsq", "SELECT capture_id, camera, round(start, 6) AS offset_seconds, 0e0 AS max_residual_seconds FROM tied WHERE breaks = 0", chain=X.CHAIN, tied=_TIED)
def _(spark, d):
    solved = sync.offset_lsq(*_pairs(spark, d))
    return solved.withColumns({c: F.round(c, 6) + 0.0 for c in ("offset_seconds", "max_residual_seconds")})


@query(
    "extraction_plan",
    """SELECT capture_id, camera, CAST(k AS INT) AS frame, CASE WHEN reason IS NULL THEN round(4e-1 - frame_offset / fps + k / fps, 6) END AS seek_seconds, reason FROM (SELECT *, unnest(CASE WHEN reason IS NULL THEN [0, 1, 2] ELSE [0] END) AS k FROM
    (SELECT *, CASE WHEN error IS NOT NULL THEN error WHEN fps IS NULL OR fps <= 0 THEN 'no frame rate' WHEN 4e-1 - frame_offset / fps < 0 THEN 'before the clip' END AS reason FROM offs))""",
    offs=X.OFFSETS,
)
def _(spark, d):
    safe = X.derive(spark, d, X.OFFSETS).withColumn("fps", F.when(F.col("fps") > 0, F.col("fps")))
    return sync.extraction_plan(safe, 0.4, 3).withColumn("seek_seconds", F.round("seek_seconds", 6))


@query(
    "validate_sync",
    """SELECT capture_id, camera, violation FROM (SELECT capture_id, camera, unnest([CASE WHEN error IS NOT NULL THEN 'error' END, CASE WHEN error IS NULL AND (offset_seconds IS NULL OR frame_offset IS NULL) THEN 'no offset' END,
    CASE WHEN error IS NULL AND (fps IS NULL OR NOT fps > 0) THEN 'no fps' END]) AS violation FROM offs) WHERE violation IS NOT NULL""",
    offs=X.OFFSETS,
)
def _(spark, d):
    offsets = X.derive(spark, d, X.OFFSETS)
    return validate.validate_sync(offsets, offsets.select("capture_id", "camera"))


# dataset, checks and scores


@query(
    "dedupe_frames",
    "SELECT capture_id, camera_label, count(*) AS n, CAST(sum(frame_idx) AS BIGINT) AS sum_frame FROM (SELECT *, lag(hash) OVER (PARTITION BY capture_id, camera_label ORDER BY frame_idx) AS before FROM frames) WHERE before IS NULL OR before <> hash GROUP BY capture_id, camera_label",
    frames=X.FRAMES,
)
def _(spark, d):
    return dataset.drop_held_frames(X.derive(spark, d, X.FRAMES)).groupBy("capture_id", "camera_label").agg(F.count(F.lit(1)).alias("n"), F.sum("frame_idx").alias("sum_frame"))


@query(
    "hull_bbox",
    "SELECT capture_id, count(*) AS n, " + ", ".join(f"round(min({a}) - ((max({a}) - min({a})) * 15e-2 + 5e-2), 6) AS min_{a}, round(max({a}) + ((max({a}) - min({a})) * 15e-2 + 5e-2), 6) AS max_{a}" for a in "xyz") + ", CASE WHEN count(*) < 100 THEN 'too few points' END AS error FROM points GROUP BY capture_id",
    points=X.POINTS,
)
def _(spark, d):
    return dataset.hull_bbox(X.derive(spark, d, X.POINTS)).withColumns({f"{n}_{a}": F.round(f"{n}_{a}", 6) for a in "xyz" for n in ("min", "max")})


_BAD_POSE = "CASE WHEN n_nationkey % 6 = 2 THEN 'not a finite 4x4' WHEN n_nationkey % 6 = 3 THEN 'bottom row' WHEN n_nationkey % 6 = 4 THEN 'reflected or collapsed' WHEN n_nationkey % 6 = 5 THEN 'not orthonormal' END"


@query(
    "validate_poses",
    f"""SELECT capture_id, camera_label, 'missing' AS violation FROM rig WHERE n_nationkey % 6 = 1 UNION ALL SELECT capture_id, camera_label, {_BAD_POSE} FROM rig WHERE n_nationkey % 6 > 1
    UNION ALL SELECT capture_id, camera_label, 'twice' FROM rig WHERE n_nationkey % 12 = 0 UNION ALL SELECT capture_id, NULL, 'all in one place' FROM (SELECT DISTINCT capture_id FROM rig) WHERE capture_id % 5 = 4""",
    rig=X.RIG,
)
def _(spark, d):
    cams = X.cameras(spark, d)
    kind, at = F.col("n_nationkey") % 6, lambda i: F.col("c2w")[i]
    pose = lambda cells: F.array(*(cells.get(i, at(i)) for i in range(16)))
    bad = (
        F.when(kind == 2, pose({7: F.lit(float("nan"))}))
        .when(kind == 3, pose({12: F.lit(0.5)}))
        .when(kind == 4, pose({i: -at(i) for i in (2, 6, 10)}))
        .when(kind == 5, pose({i: 1.2 * at(i) for i in (0, 4, 8)}))
        .otherwise(F.col("c2w"))
    )
    found = cams.filter("n_nationkey % 6 <> 1").withColumn("c2w", bad)
    found = found.unionByName(found.filter("n_nationkey % 12 = 0"))
    still = F.col("capture_id") % 5 == 4  # all cameras of the capture in the place of one
    found = found.withColumn("c2w", F.when(still, F.transform("c2w", lambda v, i: F.when(i.isin(3, 11), F.lit(0.0)).otherwise(v))).otherwise(F.col("c2w")))
    found = found.withColumn("c2w", F.when(still & F.isnan(F.get("c2w", F.lit(7))), F.transform("c2w", lambda v, i: F.when(i == 7, F.lit(0.0)).when(i == 15, F.lit(float("nan"))).otherwise(v))).otherwise(F.col("c2w")))
    return validate.validate_poses(found, cams)


@query(
    "validate_masks",
    """SELECT capture_id, camera_label, violation FROM (SELECT capture_id, camera_label, sum(x1 - x0 + 1) / (96e0 * 64e0) AS c FROM runs GROUP BY capture_id, camera_label)
    JOIN (SELECT unnest(['coverage', 'missing']) AS violation) v ON (violation = 'coverage' AND NOT (c > 5e-3 AND c < 37.5e-2) AND camera_label <> 'cam_7') OR (violation = 'missing' AND camera_label = 'cam_7')""",
    runs=X.RUNS,
)
def _(spark, d):
    images = _images(spark, d)
    cover = C.mask_coverage(X.derive(spark, d, X.RUNS), images).filter("camera_label <> 'cam_7'")
    return validate.validate_masks(cover, images, high=0.375)


@query(
    "validate_splats",
    "SELECT clip_id, splat_id, violation FROM (SELECT clip_id, splat_id, unnest([CASE WHEN splat_id % 50 = 7 THEN 't_sigma' END, CASE WHEN splat_id % 40 = 3 THEN 'f_rest' END, CASE WHEN splat_id % 30 = 5 THEN 'accel' END]) AS violation FROM splats) WHERE violation IS NOT NULL",
    splats=X.SPLATS,
)
def _(spark, d):
    k = F.col("splat_id")
    s = X.splats(spark, d).withColumn("t_sigma", F.when(k % 100 == 7, -F.col("t_sigma")).when(k % 100 == 57, float("nan")).otherwise(F.col("t_sigma")))
    rest = F.when(k % 40 == 3, F.array_repeat(F.lit(0.5), 44)).when(k % 3 == 0, F.array_repeat(F.lit(0.5), 45))
    accel = {"ax": F.when(k % 30 != 5, 1.0), "ay": F.lit(1.0), "az": F.lit(1.0)}
    return validate.validate_splats(s.withColumns({"f_rest": rest, **accel}))


@query("view_means", "SELECT round(avg(psnr_db), 5) AS psnr_db, round(avg(ssim), 5) AS ssim, round(avg(lpips), 5) AS lpips FROM views", views=X.VIEWS)
def _(spark, d):
    return evaluate.view_means(X.derive(spark, d, X.VIEWS)).select(*(F.round(c, 5).alias(c) for c in ("psnr_db", "ssim", "lpips")))


_METRICS = """SELECT 'mask_coverage' AS metric, concat(CAST(capture_id AS STRING), '/', camera_label) AS camera, sum(x1 - x0 + 1) / (96e0 * 64e0) AS value FROM runs GROUP BY capture_id, camera_label
    UNION ALL SELECT 'median_reprojection_error_px', concat('run_', CAST(doc_id AS STRING)), (doc_id % 37) / 8e0 FROM views UNION ALL SELECT 'eval4d_psnr_db', concat('run_', CAST(doc_id AS STRING)), psnr_db FROM views"""


@query(
    "gate_baseline",
    """SELECT metric, camera, CASE WHEN n % 3 = 2 THEN 'skip' WHEN metric = 'mask_coverage' THEN CASE WHEN n % 3 = 1 THEN 'fail' ELSE 'pass' END
      WHEN metric = 'eval4d_psnr_db' THEN CASE WHEN value >= 3e1 - 2e0 THEN 'pass' ELSE 'fail' END ELSE CASE WHEN value <= 2e0 + 1e0 THEN 'pass' ELSE 'fail' END END AS status
    FROM (SELECT *, CAST(regexp_extract(camera, '(\\d+)$', 1) AS BIGINT) AS n FROM metrics)""",
    runs=X.RUNS, views=X.VIEWS, metrics=_METRICS,
)
def _(spark, d):
    own = C.mask_coverage(X.derive(spark, d, X.RUNS), _images(spark, d)).select(F.lit("mask_coverage").alias("metric"), F.concat(F.col("capture_id").cast("string"), F.lit("/"), "camera_label").alias("camera"), F.col("coverage").alias("value"))
    views, run = X.derive(spark, d, X.VIEWS), F.concat(F.lit("run_"), F.col("doc_id").cast("string")).alias("camera")
    own = own.union(views.select(F.lit("median_reprojection_error_px"), run, (F.col("doc_id") % 37) / 8.0)).union(views.select(F.lit("eval4d_psnr_db"), run, "psnr_db"))
    n = trailing_id(F.col("camera"))
    base = F.when(F.col("metric") == "mask_coverage", F.col("value") + F.when(n % 3 == 1, 0.02).otherwise(0.001)).when(F.col("metric") == "eval4d_psnr_db", 30.0).otherwise(2.0)
    return evaluate.gate_baseline(own, own.filter(n % 3 != 2).withColumn("value", base)).select("metric", "camera", "status")


@query("flipbook_splats", "SELECT frame, count(*) AS n, round(frame / 3e1, 6) AS t_center, round(5e-1 / 3e1, 6) AS t_sigma FROM splats WHERE 1e0 / (1e0 + exp(-opacity)) >= 1e0 / 255e0 GROUP BY frame", splats=X.SPLATS)
def _(spark, d):
    made = S.flipbook_to_splats(S.filter_visible(X.splats(spark, d)), 30.0)
    return made.groupBy("frame", F.round("t_center", 6).alias("t_center"), F.round("t_sigma", 6).alias("t_sigma")).agg(F.count(F.lit(1)).alias("n"))


_CROPPED = """SELECT capture_id, camera_label, CAST(trunc(greatest(u0 - (u1 - u0) * 25e-2, 0e0)) AS INT) AS x0, CAST(trunc(greatest(v0 - (v1 - v0) * 25e-2, 0e0)) AS INT) AS y0,
    CAST(trunc(least(u1 + (u1 - u0) * 25e-2, 96e0)) AS INT) AS x1, CAST(trunc(least(v1 + (v1 - v0) * 25e-2, 64e0)) AS INT) AS y1
    FROM (SELECT capture_id, camera_label, min(u) AS u0, max(u) AS u1, min(v) AS v0, max(v) AS v1 FROM obs WHERE score >= 5e-1 GROUP BY capture_id, camera_label)"""


@query("crop_box", _CROPPED, obs=X.OBSERVATIONS)
def _(spark, d):
    sure = X.derive(spark, d, X.OBSERVATIONS).filter("score >= 0.5D")
    return dataset.crop_box(sure.withColumns({"w": F.lit(96), "h": F.lit(64)}), 0.25)


QUERIES["crop_box_rig"], ORACLES["crop_box_rig"] = QUERIES["crop_box"], ORACLES["crop_box"]


@query(
    "search_box",
    "SELECT capture_id, " + ", ".join(f"round(m{a} - r, 6) AS min_{a}, round(m{a} + r, 6) AS max_{a}" for a in "xyz") + """ FROM (SELECT *, CASE WHEN greatest(wx, wz) > 0 THEN greatest(wx, wz) ELSE 4e0 END AS r FROM
    (SELECT capture_id, avg(6e1 * s) AS mx, max(6e1 * s) - min(6e1 * s) AS wx, 0e0 AS my, avg(-(6e1 * c)) AS mz, max(-(6e1 * c)) - min(-(6e1 * c)) AS wz FROM rig GROUP BY capture_id))""",
    rig=X.RIG,
)
def _(spark, d):
    return dataset.search_box(X.cameras(spark, d)).select("capture_id", *(F.round(f"{n}_{a}", 6).alias(f"{n}_{a}") for a in "xyz" for n in ("min", "max")))


#: Masks in parts: lines 30 and 45 are missing, and the lines between them are cut in two for odd cameras.
_PARTED = """SELECT capture_id, camera_label, y, x0, CASE WHEN y BETWEEN 31 AND 44 AND CAST(substr(camera_label, 5) AS INT) % 2 = 1 THEN x0 + 9 ELSE x1 END AS x1 FROM runs WHERE y <> 30 AND y <> 45
    UNION ALL SELECT capture_id, camera_label, y, x0 + 11, x1 FROM runs WHERE y BETWEEN 31 AND 44 AND CAST(substr(camera_label, 5) AS INT) % 2 = 1"""


def _parted(spark, d) -> DataFrame:
    runs = X.derive(spark, d, X.RUNS).filter("y <> 30 and y <> 45")
    odd = (F.col("y").between(31, 44)) & (trailing_id(F.col("camera_label")) % 2 == 1)
    left = runs.withColumn("x1", F.when(odd, F.col("x0") + 9).otherwise(F.col("x1")))
    return left.unionByName(runs.filter(odd).withColumn("x0", F.col("x0") + 11))


_IMAGE = ["capture_id", "camera_label"]


@query("mask_components", "SELECT capture_id, camera_label, CAST(3 + CAST(substr(camera_label, 5) AS INT) % 2 AS INT) AS parts, count(*) AS runs, CAST(sum(x1 - x0 + 1) AS BIGINT) AS pixels FROM parted GROUP BY capture_id, camera_label", runs=X.RUNS, parted=_PARTED)
def _(spark, d):
    labelled = components.mask_components(_parted(spark, d), _IMAGE)
    return labelled.groupBy(*_IMAGE).agg(F.countDistinct("label").cast("int").alias("parts"), F.count(F.lit(1)).alias("runs"), F.sum(F.col("x1") - F.col("x0") + 1).alias("pixels"))


@query(
    "component_hits",
    "SELECT capture_id, camera_label, count(*) AS runs, CAST(sum(x1 - x0 + 1) AS BIGINT) AS pixels FROM parted WHERE y < 30 OR (y > 45 AND CAST(substr(camera_label, 5) AS INT) % 2 = 1) GROUP BY capture_id, camera_label",
    runs=X.RUNS, parted=_PARTED,
)
def _(spark, d):
    parts = _parted(spark, d)
    hits = parts.filter((F.col("y") == 10) | ((F.col("y") == 50) & (trailing_id(F.col("camera_label")) % 2 == 1))).select(*_IMAGE, (F.col("x0") + 2).alias("px"), F.col("y").alias("py"))
    kept = components.component_hits(components.mask_components(parts, _IMAGE), hits, _IMAGE)[0]
    return kept.groupBy(*_IMAGE).agg(F.count(F.lit(1)).alias("runs"), F.sum(F.col("x1") - F.col("x0") + 1).alias("pixels"))


@query(
    "mask_components_two",
    "SELECT capture_id, camera_label, CAST(3 + CAST(substr(camera_label, 5) AS INT) % 2 AS BIGINT) AS components_total, CAST(1 + CAST(substr(camera_label, 5) AS INT) % 2 AS BIGINT) AS components_kept FROM runs GROUP BY capture_id, camera_label",
    runs=X.RUNS,
)
def _(spark, d):
    parts = _parted(spark, d)
    hits = parts.filter((F.col("y") == 10) | ((F.col("y") == 40) & (trailing_id(F.col("camera_label")) % 2 == 1) & (F.col("x1") == F.col("x0") + 9))).select(*_IMAGE, F.col("x0").alias("px"), F.col("y").alias("py"))
    return components.component_hits(components.mask_components(parts, _IMAGE), hits, _IMAGE)[1]


_FAR = "greatest(abs(t_center), abs(11e0 - t_center))"
_WEIGHT_OFF = f"abs(exp(-5e-1 * ({_FAR} / greatest(t_sigma, 1e-9)) * ({_FAR} / greatest(t_sigma, 1e-9))) - exp(-5e-1 * ({_FAR} / greatest(sb, 1e-9)) * ({_FAR} / greatest(sb, 1e-9)))) > 2e0 / 255e0 * 1.001e0 + 1e-9"
_LONG = "SELECT *, ({0}) AS sb FROM (SELECT clip_id, splat_id, t_center, CASE WHEN splat_id % 3 = 0 THEN 6e0 ELSE t_sigma END AS t_sigma FROM splats)".format(_DEFECTS["t_sigma"])


@query(
    "temporal_weight_error",
    f"SELECT clip_id, round(avg(CASE WHEN {_WEIGHT_OFF} THEN 1e0 ELSE 0e0 END), 6) AS over_share, CASE WHEN avg(CASE WHEN {_WEIGHT_OFF} THEN 1e0 ELSE 0e0 END) <= 1e-2 THEN 'pass' ELSE 'fail' END AS verdict FROM long GROUP BY clip_id",
    splats=X.SPLATS, long=_LONG,
)
def _(spark, d):
    a = X.splats(spark, d).withColumn("t_sigma", F.when(F.col("splat_id") % 3 == 0, 6.0).otherwise(F.col("t_sigma")))
    b = a.withColumn("t_sigma", F.col("t_sigma") * F.when(F.col("splat_id") % 4 == 0, 1.5).otherwise(1.001))
    return compare.temporal_weight_error(_joined(a, b, ["t_center", "t_sigma"]), T0, T1).withColumn("over_share", F.round("over_share", 6))


_TURNED = {f"rot_{i}": _DEFECTS[f"rot_{i}"] for i in range(4)}
_DOT = " + ".join(f"rot_{i} * ({e})" for i, e in enumerate(_TURNED.values()))
_NORMS = "sqrt(" + " + ".join(f"rot_{i} * rot_{i}" for i in range(4)) + ") * sqrt(" + " + ".join(f"({e}) * ({e})" for e in _TURNED.values()) + ")"


@query(
    "rotation_error",
    f"SELECT clip_id, round(m, 3) AS max_degrees, CASE WHEN m <= 2.002e0 THEN 'pass' ELSE 'fail' END AS verdict FROM (SELECT clip_id, max(degrees(2e0 * acos(least(abs(({_DOT}) / greatest({_NORMS}, 1e-12)), 1e0)))) AS m FROM splats GROUP BY clip_id)",
    splats=X.SPLATS,
)
def _(spark, d):
    names = [f"rot_{i}" for i in range(4)]
    return compare.rotation_error(_joined(*_two_sides(spark, d), names)).withColumn("max_degrees", F.round("max_degrees", 3))


@query(
    "sh_layout_ratio",
    """SELECT clip_id, round(r, 6) AS ratio, CASE WHEN r <= 25e-2 THEN 'pass' ELSE 'fail' END AS verdict FROM (SELECT clip_id, avg(abs(a - b)) / stddev_pop(a) AS r FROM (SELECT vec_id % 3 AS clip_id, unnest(CAST(embedding AS DOUBLE[])) AS a,
    unnest(CASE WHEN vec_id % 3 = 1 THEN CAST(embedding AS DOUBLE[]) ELSE list_reverse(CAST(embedding AS DOUBLE[])) END) AS b FROM embeddings) GROUP BY clip_id)""",
)
def _(spark, d):
    v = spark.read.parquet(f"{d}/embeddings.parquet").select((F.col("vec_id") % 3).alias("clip_id"), F.col("embedding").cast("array<double>").alias("a_f_rest"))
    v = v.withColumn("b_f_rest", F.when(F.col("clip_id") == 1, F.col("a_f_rest")).otherwise(F.reverse("a_f_rest")))
    return compare.sh_layout_ratio(v).withColumn("ratio", F.round("ratio", 6))


@query(
    "group_differences",
    "SELECT clip_id, CAST(min(seg_idx) AS INT) AS first_difference FROM segments WHERE seg_idx >= clip_id * 9 + 4 AND (last - first) % 2 = 0 GROUP BY clip_id",
    splats=X.SPLATS, segments=_SEGMENTS,
)
def _(spark, d):
    table = _segments(spark, d)
    changed = (F.col("seg_idx") >= F.col("clip_id") * 9 + 4) & ((F.col("last") - F.col("first")) % 2 == 0)
    return compare.group_differences(table, table.withColumn("last", F.col("last") + changed.cast("long")))


@query("stem_collisions", "SELECT capture_id, stem, count(*) AS n FROM (SELECT capture_id, 'take_' || CAST(floor(s_acctbal / 5e2) AS BIGINT) AS stem FROM (SELECT CAST(s_nationkey % 3 AS BIGINT) AS capture_id, s_acctbal FROM supplier)) GROUP BY capture_id, stem HAVING count(*) > 1")
def _(spark, d):
    s = spark.read.parquet(f"{d}/supplier.parquet")
    folder = F.when(F.col("s_suppkey") % 2 == 0, "a/").otherwise("b/c/")
    name = F.concat(folder, F.lit("take_"), F.floor(F.col("s_acctbal") / 500.0).cast("string"), F.when(F.col("s_suppkey") % 3 == 0, ".mov").otherwise(".mp4"))
    return sync.stem_collisions(s.select((F.col("s_nationkey") % 3).cast("long").alias("capture_id"), name.alias("camera")))


@query(
    "sample_instants",
    """SELECT DISTINCT capture_id, camera, instant, CAST(least(greatest(instant + shift, 0), nb_frames - 1) AS INT) AS frame FROM (SELECT *, CAST(round_even(low + k * (shortest - 1 - 2 * low) / 4e0, 0) AS INT) AS instant FROM
    (SELECT *, max(abs(shift)) OVER (PARTITION BY capture_id) AS low, min(nb_frames) OVER (PARTITION BY capture_id) AS shortest FROM (SELECT capture_id, camera, CAST(200 + length(camera) AS INT) AS nb_frames, coalesce(frame_offset, 0) AS shift FROM offs)) CROSS JOIN (SELECT CAST(range AS INT) AS k FROM range(0, 5)))""",
    offs=X.OFFSETS,
)
def _(spark, d):
    offsets = X.derive(spark, d, X.OFFSETS)
    media = offsets.select("capture_id", "camera", (F.length("camera") + 200).alias("nb_frames"))
    return sync.sample_instants(media, offsets.select("capture_id", "camera", F.col("frame_offset").alias("shift")), 5)


@query(
    "reachable_cameras",
    "SELECT 'cam_' || CAST(n_nationkey AS STRING) AS camera FROM nation WHERE n_nationkey % 3 = 0",
)
def _(spark, d):
    label = lambda c: F.concat(F.lit("cam_"), c.cast("string"))
    n = spark.read.parquet(f"{d}/nation.parquet").select("n_nationkey")
    pairs = n.select(F.lit(0).alias("capture_id"), label(F.col("n_nationkey")).alias("cam_a"), label(F.col("n_nationkey") + 3).alias("cam_b"), F.lit(True).alias("confident")).filter("n_nationkey < 22")
    return sync.reachable(pairs, n.filter("n_nationkey = 0").select(F.lit(0).alias("capture_id"), label(F.col("n_nationkey")).alias("camera"))).select("camera")


@query(
    "latest_metric",
    "SELECT o_orderpriority AS metric, arg_max(o_totalprice, (o_orderdate, o_totalprice)) AS value FROM orders GROUP BY o_orderpriority",
)
def _(spark, d):
    history = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderpriority").alias("metric"), F.col("o_orderdate").alias("ts"), F.col("o_totalprice").alias("value"))
    return evaluate.latest(history)


# results that SQL cannot give: rows only here, analytic tests beside


@query(
    "triangulate",
    "SELECT o.capture_id, o.tem, o.kp_idx, CAST(count(*) AS INT) AS n_views, round(any_value(x), 4) + 0e0 AS x, round(any_value(y), 4) + 0e0 AS y, round(any_value(z), 4) + 0e0 AS z FROM obs o JOIN points p ON p.capture_id = o.capture_id AND p.tem = o.tem AND p.kp_idx = o.kp_idx WHERE score >= 5e-1 GROUP BY o.capture_id, o.tem, o.kp_idx HAVING count(*) >= 3",
    obs=X.EXACT, points=X.POINTS,
)
def _(spark, d):
    found = poses.triangulate(X.derive(spark, d, X.EXACT), X.cameras(spark, d), 0.5, 3)
    return found.select("capture_id", "tem", "kp_idx", "n_views", *((F.round(c, 4) + 0.0).alias(c) for c in "xyz"))


@query("similarity_fit")
def _(spark, d):
    p = X.derive(spark, d, X.POINTS)
    moved = p.select("capture_id", *(F.col(a).alias(f"src_{a}") for a in "xyz"), (-2.0 * F.col("y") + 1.0).alias("dst_x"), (2.0 * F.col("x") - 3.0).alias("dst_y"), (2.0 * F.col("z")).alias("dst_z"))
    return poses.similarity_fit(moved)


@query("main_cluster")
def _(spark, d):
    return components.main_cluster(X.splats(spark, d)).groupBy("clip_id").agg(F.count(F.lit(1)).alias("n"))


@query("kmeans_1d")
def _(spark, d):
    return quantize.kmeans_1d(quantize.distinct_values(X.splats(spark, d), ("scale_0", "scale_1", "scale_2")))


@query("slice_4d_covariance")
def _(spark, d):
    s = X.splats(spark, d)
    quat = lambda k: F.array(*(F.col(f"rot_{(i + k) % 4}") for i in range(4)))
    return poses.slice_4d_covariance(s.select("clip_id", "splat_id", F.array("scale_0", "scale_1", "scale_2").alias("log_scale"), F.log("t_sigma").alias("log_scale_t"), quat(0).alias("rot_l"), quat(1).alias("rot_r")))
