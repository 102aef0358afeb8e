"""Rows that are missing or unexpected, in one pass over both tables."""

from rigspark.operators import validate


def test_one_pass_and_nulls_equal_nothing(spark):
    due = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, None), (None, "c")], "k long, name string")
    seen = spark.createDataFrame([(2, "b"), (4, "d"), (4, "d"), (3, None), (2, "a")], "k long, name string")
    got = validate.members(due, seen, ["k", "name"])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Aggregate") == 1
    want = [(1, "a", "missing"), (2, "a", "unexpected"), (3, None, "missing"), (3, None, "unexpected"), (4, "d", "unexpected"), (None, "c", "missing")]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
