"""Row functions that run for every splat stay compiled, and large tables are made once."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rigspark.functions.encoding import smallest_three
from rigspark.operators import compare
from rigspark.operators.quantize import assign_codebook
from rigspark.sources import tables


def test_quaternions_are_packed_without_array_functions(spark):
    q = np.random.default_rng(5).integers(-3, 4, (500, 4)).astype(float)  # many ties and zeros
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(q)], "id int, a double, b double, c double, d double")
    packed = df.select("id", smallest_three([F.col(c) for c in "abcd"]).alias("p")).select("id", "p.*")
    assert "lambda" not in packed._jdf.queryExecution().optimizedPlan().toString()
    got = np.array([tuple(r) for r in packed.orderBy("id").collect()])[:, 1:]
    unit = q / np.maximum(np.sqrt((q * q).sum(axis=1, keepdims=True)), 1e-12)
    for u, g in zip(unit, got, strict=True):
        big = max((1, 2, 3, 0), key=lambda i: abs(u[i]))
        sign = -1.0 if u[big] < 0 else 1.0
        rest = [np.clip(np.rint((c * sign * np.sqrt(2.0) / 2.0 + 0.5) * 255.0), 0, 255) for i, c in enumerate(u) if i != big]
        assert g.tolist() == [*rest, big + 252]


@pytest.mark.parametrize("k", [1, 2, 16, 100, 256])
def test_nearest_entries_of_codebooks_of_any_size(spark, k):
    book = spark.range(k).select(F.lit(0).alias("clip_id"), F.col("id").cast("int").alias("idx"), (F.col("id") * 2.0).alias("value"))
    rows = spark.range(-5, 2 * k + 5).select(F.lit(0).alias("clip_id"), "id", F.col("id").cast("double").alias("v"))
    for r in assign_codebook(rows, "v", book, "i").collect():
        assert r.i == min(max(r.id // 2, 0), k - 1)


def test_what_is_written_by_group_is_made_once(spark, tmp_path):
    """Dealing rows by ranges would sample them first, and make each of them twice."""
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    rows = spark.range(0, 3000, 1, 4).select((F.col("id") % 2).alias("clip_id"), F.lit(-1).alias("grp"), F.col("id").alias("file_idx")).mapInArrow(counted, "clip_id long, grp int, file_idx long")
    tables._by_group(rows, str(tmp_path / "out"))
    assert made.value == 3000
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3000


def test_pairs_are_made_once_and_not_dealt_by_group(spark):
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    keys = {f"{n}_k_{c}": F.when(F.col("rank") < 3, F.lit(int(n == "b"))).otherwise(0) for n in "ab" for c in compare.KEYS}
    rows = spark.range(1, 2001).select(F.lit(1).alias("clip_id"), F.lit(0).alias("grp"), F.col("id").alias("rank"))
    other = F.when(F.col("rank") < 3, 3 - F.col("rank")).otherwise(F.col("rank"))
    rows = rows.select("*", F.col("rank").alias("a_splat_id"), other.alias("b_splat_id"), *(F.col("rank").cast("double").alias(f"a_{c}") for c in "xyz"), *(other.cast("double").alias(f"b_{c}") for c in "xyz")).withColumns(keys)
    mended = compare.repair_pairs(rows.mapInArrow(counted, rows.schema), 0.01)
    assert mended.filter("repaired").count() == 2 and mended.filter("a_splat_id = b_splat_id").count() == 2000
    assert made.value == 2000
