"""Every registered query of the library against its SQL, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from rigspark.plans.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def shown(v):
    return repr(float(v)) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equal_to_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(tuple(map(shown, r)) for r in df.select(*columns).collect())
    result = duck.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted(tuple(shown(r[i]) for i in at) for r in result.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


@pytest.mark.parametrize("name, column", [("membership", None), ("ambiguous_keys", None), ("judge_fields", "verdict"), ("displaced", None), ("compare_job", "part")])
def test_defects_really_occur(spark, sf_dir, name, column):
    """Queries on planted defects have rows, and where they judge, rows of every verdict."""
    rows = QUERIES[name](spark, sf_dir).collect()
    assert rows
    if column == "verdict":
        assert {r.verdict for r in rows if r.field == "scale_1"} == {"pass", "fail"} and {r.verdict for r in rows} == {"pass", "fail", "advisory"}
    elif column:
        assert {r[column] for r in rows} == {"errors", "displaced", "fields", "presence", "counts"}
    elif name == "displaced":
        assert sum(r.displaced for r in rows) > 0
