"""Queries of hulls and of the data set job. Their SQL tries all candidates of all batches, whichever are needed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import dataset
from . import fixtures as X
from . import jobs
from .queries import _D, _RIGGED, _U, _V, query

#: Masks that move to the right and narrow from frame to frame, so that frames need more or fewer batches.
TIMED_RUNS = f"SELECT capture_id, camera_label, frame_idx, y, x0 + 6 * frame_idx AS x0, x1 FROM ({X.RUNS}) AS q CROSS JOIN @RANGE(0,4,frame_idx)@"


def _at(axis: int) -> str:
    moved = [f"(({c} % {dataset.UNIT}) * {dataset.STEPS[(axis + i) % 3]}) % {dataset.UNIT}" for i, c in enumerate(("point_id", "frame_idx", "capture_id"))]
    return f"((({' + '.join(moved)}) % {dataset.UNIT}) / {dataset.UNIT}e0)"


def tried(boxes: str, frames: str, n: int) -> str:
    """SQL of the first ``n`` candidates of each frame."""
    at = ", ".join(f"min_{a} + {_at(i)} * (max_{a} - min_{a}) AS {a}" for i, a in enumerate("xyz"))
    return f"SELECT capture_id, frame_idx, point_id, {at} FROM {frames} JOIN {boxes} USING (capture_id) CROSS JOIN (SELECT range AS point_id FROM range(0, {n})) AS numbers"


def held(points: str, views: int) -> str:
    """SQL of the candidates that so many masks of their frame hold."""
    return f"""SELECT seen.capture_id, seen.frame_idx, point_id, any_value(seen.x) AS x, any_value(seen.y) AS y, any_value(seen.z) AS z, count(*) AS votes FROM (
    SELECT *, CAST(trunc(u) AS INT) AS px, CAST(trunc(v) AS INT) AS py FROM (SELECT p.*, camera_label, {_U} AS u, {_V} AS v, {_D} AS depth FROM {points} AS p JOIN {_RIGGED} ON rig_capture = capture_id)
    WHERE depth > 5e-2 AND u >= 0 AND v >= 0 AND trunc(u) < 96 AND trunc(v) < 64) AS seen
    JOIN runs AS m ON m.capture_id = seen.capture_id AND m.frame_idx = seen.frame_idx AND m.camera_label = seen.camera_label AND m.y = py AND px BETWEEN m.x0 AND m.x1
    GROUP BY seen.capture_id, seen.frame_idx, point_id HAVING count(*) >= {views}"""


def first_of(points: str, n: int) -> str:
    return f"SELECT * FROM {points} QUALIFY row_number() OVER (PARTITION BY capture_id, frame_idx ORDER BY point_id) <= {n}"


_BOX = "SELECT CAST(s_suppkey AS BIGINT) AS capture_id, " + ", ".join(f"-(1.2e1 + s_suppkey % {k}) AS min_{a}, 1e1 + s_suppkey % {k + 1} AS max_{a}" for k, a in enumerate("xyz", 3)) + " FROM supplier"
_FRAMES = "SELECT DISTINCT capture_id, frame_idx FROM runs"


@query(
    "carve_hull",
    "SELECT capture_id, frame_idx, point_id, " + ", ".join(f"round({a}, 6) + 0e0 AS {a}" for a in "xyz") + f", votes FROM ({first_of('inside', 24)})",
    runs=TIMED_RUNS, rig=X.RIG, boxes=_BOX, frames=_FRAMES, tried=tried("boxes", "frames", 8 * 4 * 24), inside=held("tried", 20),
)
def _(spark, d):
    hull = dataset.carve_hull(X.derive(spark, d, _BOX), X.cameras(spark, d), X.derive(spark, d, TIMED_RUNS), 24, 20)
    return hull.select("capture_id", "frame_idx", "point_id", *((F.round(a, 6) + 0.0).alias(a) for a in "xyz"), "votes")


#: Candidates for the box, points a frame, and masks that must hold a point.
_SEEDS, _EACH, _VIEWS = 16_000, 200, 12
_SHOT = X.FRAMES.replace("SELECT", "SELECT CASE WHEN o_orderkey % 1201 <> 0 THEN concat('f', CAST(o_orderkey AS STRING)) END AS file_path,", 1)
_CENTRES = "SELECT capture_id, avg(6e1 * s) AS mx, max(6e1 * s) - min(6e1 * s) AS wx, 0e0 AS my, avg(-(6e1 * c)) AS mz, max(-(6e1 * c)) - min(-(6e1 * c)) AS wz FROM rig GROUP BY capture_id"
_SEARCH = "SELECT capture_id, " + ", ".join(f"m{a} - r AS min_{a}, m{a} + r AS max_{a}" for a in "xyz") + f" FROM (SELECT *, CASE WHEN greatest(wx, wz) > 0 THEN greatest(wx, wz) ELSE 4e0 END AS r FROM ({_CENTRES}))"
_HULL_BOX = "SELECT capture_id, count(*) AS n, " + ", ".join(f"min({a}) - ((max({a}) - min({a})) * 15e-2 + 5e-2) AS min_{a}, max({a}) + ((max({a}) - min({a})) * 15e-2 + 5e-2) AS max_{a}" for a in "xyz") + " FROM seeds GROUP BY capture_id"
_JOB_SQL = """SELECT 'box' AS part, capture_id, CASE WHEN n < 100 THEN 'too few points' END AS label, n, round(min_x, 6) AS total FROM found
    UNION ALL SELECT 'points', capture_id, CAST(frame_idx AS STRING), count(*), CAST(sum(point_id) AS DOUBLE) FROM carved GROUP BY ALL
    UNION ALL SELECT 'views', capture_id, concat(camera_label, ' ', split), count(*), CAST(sum(frame_idx) AS DOUBLE) FROM views GROUP BY ALL
    UNION ALL SELECT 'rig', CAST(s_suppkey AS BIGINT), 'pose moves', 1, NULL FROM supplier WHERE s_suppkey % 3 = 1
    UNION ALL SELECT 'set', capture_id, 'null file_path', 1, NULL FROM views WHERE file_path IS NULL GROUP BY capture_id
    UNION ALL SELECT 'set', capture_id, 'no point', 1, NULL FROM views WHERE capture_id NOT IN (SELECT capture_id FROM carved) GROUP BY capture_id"""


@query(
    "dataset_job", _JOB_SQL,
    runs=TIMED_RUNS, rig=X.RIG, search=_SEARCH, middle="SELECT DISTINCT capture_id, 2 AS frame_idx FROM runs", sown=tried("search", "middle", _SEEDS), seeds=held("sown", _VIEWS), found=_HULL_BOX,
    boxes="SELECT * FROM found WHERE n >= 100", frames=_FRAMES, tried=tried("boxes", "frames", 8 * 4 * _EACH), inside=held("tried", _VIEWS), carved=first_of("inside", _EACH), shot=_SHOT,
    views="""SELECT f.*, CASE WHEN camera_label = 'cam_3' THEN 'test' ELSE 'train' END AS split FROM (SELECT *, lag(hash) OVER (PARTITION BY capture_id, camera_label ORDER BY frame_idx) AS before FROM shot) AS f
        JOIN rig USING (capture_id, camera_label) WHERE (before IS NULL OR before <> hash) AND camera_label <> 'cam_1'""",
)
def _(spark, d):
    first = X.cameras(spark, d).withColumn("dist", F.array(F.lit(0.0)))
    moves = (F.col("capture_id") % 3 == 1) & (F.col("camera_label") == "cam_7")
    last = first.withColumn("c2w", F.when(moves, F.transform("c2w", lambda v, i: F.when(i == 3, v + 1e-3).otherwise(v))).otherwise(F.col("c2w")))
    frames, runs = X.derive(spark, d, _SHOT), X.derive(spark, d, TIMED_RUNS)
    out = jobs.dataset_job(first, last, frames, runs, 4 * _EACH, _VIEWS, 25.0, ["cam_3"], ["cam_1", "cam_3"], seeds=_SEEDS)

    def part(name: str, df: DataFrame, label, n=F.count(F.lit(1)), total=F.lit(None)) -> DataFrame:
        rows = df.groupBy("capture_id", label.cast("string").alias("label")).agg(n.cast("long").alias("n"), total.cast("double").alias("total"))
        return rows.select(F.lit(name).alias("part"), "capture_id", "label", "n", "total")

    return (
        part("box", out["boxes"], F.col("error"), F.max("n"), F.round(F.max("min_x"), 6))
        .unionByName(part("points", out["points"].filter("time = frame_idx / 25"), F.col("frame_idx"), total=F.sum("point_id")))
        .unionByName(part("views", out["views"].filter("time = frame_idx / 25"), F.concat_ws(" ", "camera_label", "split"), total=F.sum("frame_idx")))
        .unionByName(part("rig", out["rig_violations"], F.col("violation")))
        .unionByName(part("set", out["violations"], F.col("violation")))
    )
