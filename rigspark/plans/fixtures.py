"""Domain tables as exact arithmetic over the given tables, in SQL that Spark and DuckDB share.

``@DAYS@`` and ``@RANGE(a,b,name)@`` stand for what the two write differently.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TIME_MIN, TIME_MAX, DURATION = 0.0, 11.0, 0.1

SPLATS = """
SELECT CAST(l_orderkey % 4 AS BIGINT) AS clip_id,
       l_orderkey * 1000 + row_number() OVER (PARTITION BY l_orderkey
         ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS splat_id,
       CAST(l_suppkey AS BIGINT) AS capture_id, CAST(l_linenumber AS INT) AS frame,
       l_quantity - 2.55e1 AS x, (l_extendedprice - 4e4) / 1e4 AS y, 1e2 * l_discount - 5e0 AS z,
       @DAYS@ / 2.5e2 AS t_center,
       CASE WHEN l_linenumber = 7 THEN 5e-1 ELSE 5e-3 * l_linenumber END AS t_sigma,
       (l_quantity - 2e1) / 1e1 AS opacity,
       5e1 * l_tax - 6e0 AS scale_0, 5e-1 * l_linenumber - 6e0 AS scale_1, 4e1 * l_discount - 5e0 AS scale_2,
       (l_extendedprice - 5e4) / 2.5e4 AS f_dc_0, (l_quantity - 2.5e1) / 1.2e1 AS f_dc_1, (1e2 * l_discount - 5e0) / 2e0 AS f_dc_2,
       (l_partkey % 11 - 5) / 4e0 AS vx, (l_suppkey % 7 - 3) / 4e0 AS vy, (l_linenumber - 4) / 8e0 AS vz,
       (l_partkey % 13 + 1) / 7e0 AS rot_0, (l_suppkey % 11 - 5) / 7.3e0 AS rot_1,
       (l_orderkey % 9 - 4) / 7.9e0 AS rot_2, (l_linenumber - 4) / 8.3e0 AS rot_3
FROM lineitem"""

#: A rig of all nations for each supplier's capture: labels repeat between captures, poses and masks differ.
RIG = """
SELECT n_nationkey, capture_id, concat('cam_', CAST(n_nationkey AS STRING)) AS camera_label,
       c, s, -((c * (6e1 * s) + 0e0 * 0e0) + s * (-(6e1 * c))) AS tx, -((-s * (6e1 * s) + 0e0 * 0e0) + c * (-(6e1 * c))) AS tz
FROM (SELECT n_nationkey, CAST(s_suppkey AS BIGINT) AS capture_id, CASE (n_nationkey + s_suppkey) % 4 WHEN 0 THEN 6e-1 WHEN 1 THEN 8e-1 WHEN 2 THEN -6e-1 ELSE 6e-1 END AS c,
             CASE (n_nationkey + s_suppkey) % 4 WHEN 0 THEN 8e-1 WHEN 1 THEN 6e-1 WHEN 2 THEN 8e-1 ELSE -8e-1 END AS s FROM nation CROSS JOIN supplier) AS turns"""

RUNS = """
SELECT CAST(s_suppkey AS BIGINT) AS capture_id, concat('cam_', CAST(n_nationkey AS STRING)) AS camera_label, y,
       CAST(48 - 20 - (n_nationkey * 3 + y + s_suppkey) % 17 AS INT) AS x0, CAST(48 + 15 + (n_nationkey + y + s_suppkey) % 13 AS INT) AS x1
FROM nation CROSS JOIN supplier CROSS JOIN @RANGE(6,58,y)@"""

POINTS = """
SELECT CAST(floor(p_partkey / 2e1) AS BIGINT) AS capture_id, CAST(p_partkey % 3 AS STRING) AS tem, CAST(p_partkey AS INT) AS kp_idx,
       (p_partkey % 41 - 20) / 1e1 AS x, (p_partkey % 29 - 14) / 1e1 AS y, (p_partkey % 37 - 18) / 1e1 AS z
FROM part"""


def projected(x: str = "x", y: str = "y", z: str = "z") -> tuple[str, str, str]:
    """u, v and depth of a point of the rig in SQL, in the order of the operators' own arithmetic."""
    depth = f"((-s * {x} + 0e0 * {y}) + c * {z} + tz)"
    return f"(8e1 * ((c * {x} + 0e0 * {y}) + s * {z} + tx) / {depth} + 4.8e1)", f"(8e1 * ({y} + 0e0) / {depth} + 3.2e1)", depth


_U, _V, _D = projected()
#: Every point in every camera that sees it: before the camera, and inside its image.
OBSERVATIONS = f"""
SELECT p.capture_id, tem, kp_idx, camera_label, {_U} + ((kp_idx * 7 + n_nationkey * 3) % 5 - 2)
         + CASE WHEN (kp_idx + n_nationkey) % 50 = 0 THEN 3e2 ELSE 0e0 END AS u,
       {_V} + ((kp_idx * 3 + n_nationkey) % 5 - 2) / 2e0 AS v, (kp_idx % 10) / 1e1 + 5e-2 AS score
FROM ({POINTS}) AS p JOIN (SELECT capture_id AS rig_capture, n_nationkey, camera_label, c, s, tx, tz FROM ({RIG}) AS r) AS rig
  ON capture_id = rig_capture AND {_D} > 1e-6 AND {_U} >= 0 AND {_U} < 96 AND {_V} >= 0 AND {_V} < 64"""

#: The same without noise or outliers.
EXACT = f"""
SELECT p.capture_id, tem, kp_idx, camera_label, {_U} AS u, {_V} AS v, (kp_idx % 10) / 1e1 + 5e-2 AS score
FROM ({POINTS}) AS p JOIN (SELECT capture_id AS rig_capture, n_nationkey, camera_label, c, s, tx, tz FROM ({RIG}) AS r) AS rig
  ON capture_id = rig_capture AND {_D} > 1e-6 AND {_U} >= 0 AND {_U} < 96 AND {_V} >= 0 AND {_V} < 64"""

ENVELOPES = """
SELECT CAST(user_id % 3 AS BIGINT) AS capture_id, event_type AS camera, CAST(@HOUR@ AS INT) AS i, CAST(count(*) AS DOUBLE) AS value
FROM events GROUP BY user_id % 3, event_type, @HOUR@"""

FRAMES = """
SELECT CAST(o_custkey % 7 AS BIGINT) AS capture_id, concat('cam_', CAST(o_custkey % 5 AS STRING)) AS camera_label, o_orderkey AS frame_idx,
       concat(o_orderstatus, CAST(floor(o_totalprice / 1e5) AS STRING)) AS hash
FROM orders"""

OFFSETS = """
SELECT CAST(s_nationkey % 3 AS BIGINT) AS capture_id, s_name AS camera,
       CASE WHEN s_suppkey % 9 = 0 THEN 0e0 WHEN s_suppkey % 11 = 0 THEN NULL ELSE 3e1 END AS fps,
       CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE CAST(s_suppkey % 50 - 25 AS INT) END AS frame_offset,
       CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE (s_suppkey % 50 - 25) / 3e1 END AS offset_seconds,
       CASE WHEN s_suppkey % 13 = 0 THEN 'no audio' ELSE NULL END AS error
FROM supplier"""

#: Pairs of neighbours, and of every second one, in the chain of a customer's orders: exact sixteenths of a second, broken where an order's key is a multiple of 11.
PAIRS = """
SELECT capture_id, concat('cam_', CAST(1000 + k AS STRING)) AS cam_a, concat('cam_', CAST(1000 + k + step AS STRING)) AS cam_b, offset_seconds, match_quality, peak_ratio, confident FROM (
  SELECT CAST(o_custkey AS BIGINT) AS capture_id, k, 1 AS step, own AS offset_seconds, (k % 50 + 4e1) / 1e2 AS match_quality, 1e0 + k AS peak_ratio, linked AS confident FROM chain WHERE next_key IS NOT NULL
  UNION ALL SELECT CAST(o_custkey AS BIGINT), k, 2, own + next_own, 9e-1, 2e0, linked AND next_linked FROM chain WHERE next_own IS NOT NULL AND after_key IS NOT NULL) AS both_steps"""

CHAIN = """
SELECT o_custkey, k, own, linked, lead(k) OVER w AS next_key, lead(own) OVER w AS next_own, lead(linked) OVER w AS next_linked, lead(k, 2) OVER w AS after_key FROM (
  SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k, (o_orderkey % 97 - 48) / 1.6e1 AS own, o_orderkey % 11 <> 0 AS linked FROM orders) AS numbered
WINDOW w AS (PARTITION BY o_custkey ORDER BY k)"""

VIEWS = """
SELECT doc_id, (doc_id % 97) / 4e0 + 2e1 AS psnr_db, (doc_id % 13) / 1e2 + 8.5e-1 AS ssim, quality / 1e1 + toxic / 4e0 AS lpips FROM labels"""


def in_duckdb(sql: str) -> str:
    sql = re.sub(r"@RANGE\((\d+),(\d+),(\w+)\)@", r"(SELECT CAST(range AS INT) AS \3 FROM range(\1, \2)) AS r", sql)
    return sql.replace("@DAYS@", "date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE))").replace("@HOUR@", "floor(epoch(ts) / 3600)")


def in_spark(sql: str) -> str:
    sql = re.sub(r"@RANGE\((\d+),(\d+),(\w+)\)@", r"(SELECT CAST(id AS INT) AS \3 FROM range(\1, \2)) AS r", sql)
    return sql.replace("@DAYS@", "datediff(CAST(l_shipdate AS DATE), DATE '1995-01-01')").replace("@HOUR@", "floor(unix_timestamp(CAST(ts AS TIMESTAMP)) / 3600)")


TABLES = ("lineitem", "nation", "part", "events", "orders", "supplier", "labels", "customer", "embeddings")


def derive(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A domain table over the Parquet tables of ``sf_dir``."""
    text, frames = in_spark(sql), {}
    for name in TABLES:
        if re.search(rf"\b{name}\b", text):
            frames[name] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
            if name == "supplier":  # few rows in one piece, from which rigs and masks are unfolded: each would come from one task
                frames[name] = frames[name].repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "s_suppkey")
            text = re.sub(rf"(FROM|JOIN) {name}\b", rf"\1 {{{name}}}", text)
    return spark.sql(text, **frames)


def splats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, SPLATS)


def cameras(spark: SparkSession, sf_dir: str, sql: str = RIG) -> DataFrame:
    c, s, zero = F.col("c"), F.col("s"), F.lit(0.0)
    pose = F.array(c, zero, s, F.lit(60.0) * s, zero, F.lit(-1.0), zero, zero, s, zero, -c, -(F.lit(60.0) * c), zero, zero, zero, F.lit(1.0))
    fixed = {"fl_x": F.lit(80.0), "fl_y": F.lit(80.0), "cx": F.lit(48.0), "cy": F.lit(32.0), "w": F.lit(96), "h": F.lit(64), "c2w": pose}
    return derive(spark, sf_dir, sql).withColumns(fixed).drop("tx", "tz", "c", "s")
