"""Queries on keys beyond those of the given small tables."""

import pandas as pd

from rigspark.plans.queries import QUERIES


def test_similarity_of_points_with_large_part_keys(spark, tmp_path):
    keys = list(range(1_200_000, 1_200_060))
    pd.DataFrame({"p_partkey": keys}).to_parquet(f"{tmp_path}/part.parquet")
    rows = QUERIES["similarity_of_points"](spark, str(tmp_path)).collect()
    assert sorted(r.capture_id for r in rows) == [60_000, 60_001, 60_002]
    assert all(abs(r.scale - (2 + r.capture_id)) < 1e-4 and [round(x) for x in r.rotation] == [0, -1, 0, 1, 0, 0, 0, 0, 1] for r in rows)
