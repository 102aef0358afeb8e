"""Sorted blocks of values, look-ups in them, and codebooks trained on them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rigspark.operators import blocks, quantize
from rigspark.operators.blocks import SortedBlocks, leading


def plain_lloyd(values, k, rounds):
    """All values in each round."""
    book = np.quantile(values, np.linspace(0, 1, k)) + 1e-12 * np.arange(k)
    for _ in range(rounds):
        at = np.searchsorted((book[1:] + book[:-1]) / 2, values)
        n, s = np.bincount(at, minlength=k), np.bincount(at, values, minlength=k)
        book = np.sort(np.where(n > 0, s / np.maximum(n, 1), book))
    return book


def counted(df):
    return df.groupBy("clip_id", "value").agg(F.count(F.lit(1)).alias("n"))


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 1000])
def test_halving_counts_like_a_scan(spark, n):
    rng = np.random.default_rng(n)
    edges = sorted(float(e) for e in rng.integers(0, 50, n))
    asked = [*range(-1, 52), 7.5, float("inf"), None]
    df = spark.createDataFrame([(edges, None if a is None else float(a)) for a in asked], "e array<double>, a double")
    got = df.select("a", leading(F.col("e"), lambda e: e < F.col("a"), 65_535).alias("k")).collect()
    assert all(r.k == (0 if r.a is None else int(np.searchsorted(edges, r.a))) for r in got)


def test_rounds_on_running_sums(spark, monkeypatch):
    """A group in many blocks with a heavy tail, one with three quarters of one value, one of a single value, and rows that do not count."""
    monkeypatch.setattr(blocks, "BLOCK", 64)
    n = 40_000
    tail = spark.range(n).select(F.lit(1).alias("clip_id"), F.exp(F.pmod(F.col("id") * 7919, F.lit(n)) / 4_000.0).alias("value"))
    tied = spark.range(10_000).select(F.lit(2), F.when(F.col("id") % 4 != 0, 7.0).otherwise(F.col("id") / 1024.0))  # exact sums: mid-points may be values
    one = spark.range(5).select(F.lit(3), F.lit(-2.5))
    empty = spark.range(5).select(F.lit(4), F.lit(None).cast("double"))
    book = quantize.kmeans_1d(counted(tail.union(tied).union(one).union(empty)), 32, 5)
    got = {c: [r.value for r in book.filter(F.col("clip_id") == c).orderBy("idx").collect()] for c in (1, 2, 3, 4)}
    given = {1: np.exp(np.arange(n) / 4_000.0), 2: np.where(np.arange(10_000) % 4 != 0, 7.0, np.arange(10_000) / 1024.0), 3: np.full(5, -2.5)}
    assert got[4] == []
    for c, values in given.items():
        assert np.allclose(got[c], plain_lloyd(values, 32, 5), rtol=1e-9, atol=1e-9)


def test_ranks_and_sums_are_those_of_a_sorted_list(spark, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK", 16)
    rng = np.random.default_rng(5)
    values = np.sort(rng.integers(0, 400, 3000) / 8.0)
    df = spark.createDataFrame([(9, float(v)) for v in values], "clip_id int, value double")
    store = SortedBlocks(counted(df), ["clip_id"])
    assert store.directory.count() > 10
    probes = spark.createDataFrame([(9, i, float(a)) for i, a in enumerate([-1, 0, 3.125, 3.2, 49.9, 1e9])], "clip_id int, idx int, at double")
    for at_once in (False, True):
        found = {r.idx: (r.n, r.s) for r in store.upto(probes, at_once).collect()}
        assert found == {r.idx: ((values <= r.at).sum(), values[values <= r.at].sum()) for r in probes.collect() if (values <= r.at).any()}
    ranks = spark.createDataFrame([(9, i, i) for i in range(0, 3000, 37)], "clip_id int, idx int, at long")
    assert all(r.value == values[r.idx] for r in store.at_rank(ranks).collect())


def test_empty_values(spark):
    assert quantize.kmeans_1d(spark.createDataFrame([], "clip_id long, value double, n long"), 8, 3).count() == 0


def test_a_round_reads_no_sorted_values_again(spark):
    """The plan of a look-up sorts the directory and the probes only."""
    store = SortedBlocks(spark.range(5000).select(F.lit(1).alias("clip_id"), F.col("id").cast("double").alias("value"), F.lit(1).alias("n")), ["clip_id"])
    probes = spark.createDataFrame([(1, 0, 7.0)], "clip_id int, idx int, at double")
    plan = store.upto(probes, True)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Generate" not in plan and "SortMergeJoin" not in plan
