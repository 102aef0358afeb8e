"""Queries of whole jobs on tables in which the truth is planted; their SQL states that truth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cameras as C
from ..operators import poses
from ..operators.scratch import cut, kept
from . import fixtures as X
from . import jobs
from .queries import query

#: Samples a second, samples of an event's sound, and frames a second of the sound fixture.
RATE, BURST, FPS = 1000, 40, 25

_SOUNDING = "SELECT DISTINCT user_id FROM events WHERE user_id IS NOT NULL"
_DELAY = {"cam_0": "0", "cam_1": "user_id % 50", "cam_2": "2 * (user_id % 31) + 5", "cam_3": "120 - user_id % 40"}


def sounds(spark, d: str) -> tuple[DataFrame, DataFrame]:
    """Clips of a capture a user, and their frame rates. All cameras hear the user's events as bursts of noise, each camera later by its delay."""
    events = spark.read.parquet(f"{d}/events.parquet").filter("user_id is not null")
    noise = F.transform(F.sequence(F.lit(0), F.lit(BURST - 1)), lambda j: F.col("value") * (F.pmod(F.xxhash64("event_id", j), F.lit(2001)) - 1000) / 1000.0)
    heard = events.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("ts", "event_id", noise.alias("burst")))).alias("e"))  # one user's events
    delays = F.array(*(F.struct(F.lit(c).alias("camera"), F.expr(e).cast("int").alias("late")) for c, e in _DELAY.items()))
    rows = heard.select(F.col("user_id").alias("capture_id"), F.flatten("e.burst").alias("sound"), F.explode(delays).alias("c"))
    clips = rows.select("capture_id", "c.camera", F.lit(RATE).alias("sample_rate"), F.concat(F.array_repeat(F.lit(0.0), F.col("c.late")), "sound").alias("samples"))
    return clips, clips.select("capture_id", "camera", F.lit(float(FPS)).alias("fps"))


@query(  # a camera that hears everything later began earlier by as much
    "sync_job",
    " UNION ALL ".join(f"SELECT user_id AS capture_id, '{c}' AS camera, CAST(-({e}) AS INT) AS late_samples, CAST(round_even(-({e}) / 4e1, 0) AS INT) AS frame_offset, 'lsq' AS solver, false AS low_confidence, true AS fits FROM users" for c, e in _DELAY.items()),
    users=_SOUNDING,
)
def _(spark, d):
    clips, media = sounds(spark, d)
    reference = media.filter("camera = 'cam_0'").select("capture_id", "camera")
    offsets, _ = jobs.sync_job(clips, media, reference, RATE)
    samples = F.rint(F.col("offset_seconds") * RATE).cast("int")
    # half a frame is a matter of rounding: the frame is judged by its sample
    return offsets.select("capture_id", "camera", samples.alias("late_samples"), F.rint(samples / F.lit(RATE / FPS)).cast("int").alias("frame_offset"), "solver", "low_confidence", (F.col("max_residual_seconds") < 0.002).alias("fits"))


def shaken(cameras: DataFrame) -> DataFrame:
    """The rig with every pose a little off: turned about its own axes and moved, each camera by amounts of its own."""
    k = lambda m, o: (F.pmod(F.col("n_nationkey") * m + F.col("capture_id") * o, F.lit(11)) - 5) / 5.0
    a, b = 0.004 * k(3, 1), 0.003 * k(7, 2)
    c = lambda i, j: F.col("c2w")[4 * i + j]
    turned = [[F.cos(a) * c(i, 0) + F.sin(a) * c(i, 2), c(i, 1), F.cos(a) * c(i, 2) - F.sin(a) * c(i, 0)] for i in range(3)]
    tilted = [[r[0], F.cos(b) * r[1] + F.sin(b) * r[2], F.cos(b) * r[2] - F.sin(b) * r[1]] for r in turned]
    moved = [c(i, 3) + 0.15 * k(5 + i, 3 + i) for i in range(3)]
    pose = F.array(*(x for i in range(3) for x in (*tilted[i], moved[i])), *(F.lit(x) for x in (0.0, 0.0, 0.0, 1.0)))
    return cameras.withColumn("c2w", pose)


@query(  # what is planted is seen without any error: refined, the rig sees it so again
    "refine_poses",
    "SELECT capture_id, camera_label, count(*) AS n, true AS was_off, true AS fits FROM obs WHERE score >= 5e-1 GROUP BY capture_id, camera_label",
    obs=X.EXACT,
)
def _(spark, d):
    seen = kept(X.derive(spark, d, X.EXACT).filter("score >= 0.5"))  # read by every step below
    given = kept(shaken(X.cameras(spark, d)))
    start = cut(poses.triangulate(seen, given, 0.5, 3))
    refined, points = poses.refine_poses(seen, given, start, rounds=6)
    report = lambda p, rig: C.residual_report(seen, p, rig).filter("camera_label is not null")
    # off is what stands elsewhere and is seen worse than after: a pose may be off along its rays, where pixels hardly show it
    keys, off = ["capture_id", "camera_label"], F.exists(F.zip_with("c2w", "planted", lambda a, b: F.abs(a - b)), lambda x: x > 1e-6)
    was = given.join(X.cameras(spark, d).select(*keys, F.col("c2w").alias("planted")), keys).select(*keys, off.alias("off"))
    before = report(start, given).select(*keys, F.col("p90").alias("before"))
    after = report(points, poses.with_poses(given, refined)).join(before, keys).join(was, keys)
    return after.select(*keys, "n", (F.col("off") & (F.col("before") > F.col("p90"))).alias("was_off"), (F.col("p90") < 0.01).alias("fits"))
