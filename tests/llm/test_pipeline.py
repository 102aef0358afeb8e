from collections import defaultdict

import corpus_pipeline
from rigspark.llm.common import stage

from .test_neardup_secrets import brute_components
from .test_sharding_lines import LOWER, WHITE


def lines_left(docs):
    held = defaultdict(set)
    key = lambda x: x.strip(WHITE).translate(LOWER)
    for d, t in docs.items():
        for x in t.split("\n"):
            held[key(x)].add(d)
    keep = lambda d, x: len(key(x)) < 20 or len(held[key(x)]) < 3 or max(held[key(x)]) == d
    return {d: "\n".join(x for x in t.split("\n") if keep(d, x)) for d, t in docs.items()}


def test_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = {r.doc_id: r.text or "" for r in docs.collect()}
    columns = docs.columns
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
        assert docs.columns == columns
        got = {r.doc_id: r.text for r in docs.collect()}
        if name == "language_id":
            want = {d: t for d, t in want.items() if any(c.isalpha() for c in t)}
        elif name == "line_dedup":
            want = lines_left(want)
        elif name == "near_dedup":
            kept = brute_components(list(want.items()))
            want = {d: t for d, t in want.items() if kept[d][2]}
        else:
            leaks = {d for d, t in want.items() if any(i in " ".join(t.lower().split()) for i in items)}
            assert leaks and not leaks & got.keys() and len(want.keys() - leaks - got.keys()) <= 2
            want = got
        assert got == want, name
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r.doc_id for r in packed} == set(want)


def test_run_on_empty_table(spark, tmp_path, sf_dir):
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_odd_rows_and_clashing_columns(spark, sf_dir):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, lang_pred int, kept_text string, n_lines int, kept boolean"
    long_text = "word " * 200_000
    line = "a line of more than twenty characters"
    rows = [
        (1, "ein kurzer Satz", "de", "s", 15), (2, None, "de", "s", None), (None, f"one text more\n{line}", None, None, 1), (3, "", "en", "s", 0),
        (4, long_text, "en", "s", 1_000_000), (5, f"the first of these\n{line}", "en", "s", 1), (6, f"the other one here\n{line}", "en", "s", 1), (6, f"and again the other\n{line}", "en", "s", 1),
    ]
    docs = spark.createDataFrame([(*r, "own", 7, "mine", 9, True) for r in rows], schema)
    for table in (docs, docs.filter("false")):
        for name, step in corpus_pipeline.STAGES[:-1]:
            table = stage(step(spark, table, sf_dir), name)
            assert table.columns == docs.columns
            assert all((r.score, r.lang_pred, r.kept_text, r.n_lines, r.kept) == ("own", 7, "mine", 9, True) for r in table.collect())
        packed = corpus_pipeline.packing(spark, table, sf_dir).collect()
        left = table.collect()
        assert len(packed) >= len(left) and {r.doc_id for r in packed} == {r.doc_id for r in left}
        if left:
            assert sorted(r.doc_id or 0 for r in left) == [0, 1, 4, 5, 6, 6]
            assert sum(line in r.text for r in left) == 2  # the keeper is the largest doc_id, which two rows share
            assert max(len(r.text) for r in left) == len(long_text)
