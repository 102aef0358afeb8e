"""Point tables written and read by Spark."""

import os

import pytest
from pyspark.sql import functions as F

from rigspark.sources import ply


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.fixture
def splats(spark):
    return spark.range(1000).select((F.col("id") / 8.0).alias("x"), (-F.col("id")).cast("int").alias("y"), F.lit(0.5).alias("opacity"))


def test_written_rows_come_back(spark, splats, tmp_path):
    folder = f"{tmp_path}/a b"
    ply.write_splat_ply(splats.repartition(3), folder, {"fps": 30.0, "time_min": 0, "time_max": 2.5, "motion_degree": 1}, rows=150)
    assert len(os.listdir(folder)) >= 7 and max(ply.ply_headers(spark, folder).select("n").toPandas().n) == 150
    want = [(i / 8.0, float(-i)) for i in range(1000)]
    for given in ([folder], [f"file://{folder.replace(' ', '%20')}"], [f"{folder}/{f}" for f in os.listdir(folder)]):
        got = ply.read_splat_ply(spark, given, ["y", "x"], rows=40)
        assert got.columns == ["path", "splat_id", "y", "x"] and rows_of(got, "x", "y") == sorted(want)
    assert ply.read_clips(spark, folder).agg(F.sum("splat_count"), F.max("fps")).first()[:] == (1000, 30.0)


def test_append_and_overwrite(spark, splats, tmp_path):
    folder = str(tmp_path / "t")
    for mode, n in (("append", 1000), ("append", 2000), ("overwrite", 1000)):
        ply.write_splat_ply(splats, folder, mode=mode)
        assert ply.read_splat_ply(spark, [folder]).count() == n


def test_a_failed_write_leaves_what_was_there(spark, splats, tmp_path):
    folder = str(tmp_path / "t")
    ply.write_splat_ply(splats, folder)
    bad = splats.withColumn("x", F.when(F.col("x") < 100, F.col("x")))
    with pytest.raises(Exception, match="null in x"):
        ply.write_splat_ply(bad, folder, mode="overwrite", rows=10)
    assert ply.read_splat_ply(spark, [folder]).count() == 1000


def test_files_of_lost_attempts_go(tmp_path):
    writer = ply._Writer(str(tmp_path), ["x"], {}, 10, overwrite=False)
    for name in (f"part-{writer.job}-000000-000000-1.ply", f"part-{writer.job}-000000-000000-2.ply", "earlier.ply"):
        (tmp_path / name).write_bytes(b"")
    writer.commit([ply._Written([f"part-{writer.job}-000000-000000-2.ply"])])
    assert sorted(os.listdir(tmp_path)) == ["earlier.ply", f"part-{writer.job}-000000-000000-2.ply"]


def test_an_empty_table_keeps_its_columns(spark, splats, tmp_path):
    folder = str(tmp_path / "t")
    ply.write_splat_ply(splats.limit(0), folder)
    back = ply.read_splat_ply(spark, [folder])
    assert back.columns == ["path", "splat_id", "x", "y", "opacity"] and back.count() == 0


def test_many_ranges_are_read_by_few_tasks(spark, tmp_path):
    """Files and ranges grow with the table, tasks do not; every record comes back once, in its own place."""
    folder = str(tmp_path / "t")
    ply.write_splat_ply(spark.range(3000).select(F.col("id").alias("x")).repartition(4), folder, rows=20)
    back = ply.read_splat_ply(spark, [folder], rows=3)
    assert back.rdd.getNumPartitions() <= ply.TASKS < 1000
    assert rows_of(back, "x") == [(float(i),) for i in range(3000)]
    files = back.groupBy("path").agg(F.min("splat_id").alias("low"), F.max("splat_id").alias("high"), F.count("*").alias("n")).collect()
    assert len(files) >= 150 and all((r.low, r.high) == (0, r.n - 1) for r in files)
