import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rigspark.llm.quality import BUCKETS, RANK, STATISTICS, Machine, block_features, learn, op12_factorisation_machine, score
from rigspark.llm.words import text_blocks


def features(texts):
    [(_, _, data, offsets)] = list(text_blocks(pa.array(texts)))
    return block_features(data, offsets)


def test_linear_time_equals_all_pairs():
    rng = np.random.default_rng(0)
    doc, bucket, weight, stats = features(["Some words, some MORE words!!", "", "x", "a b\nc d 12 é"])
    n = BUCKETS + stats.shape[1]
    machine = Machine(0.3, rng.normal(size=n), rng.normal(size=(n, RANK)), stats.mean(axis=0), np.ones(stats.shape[1]))
    dense = machine.dense(stats)
    got, _ = machine.raw(doc, bucket, weight, dense)
    for i in range(4):
        x = np.zeros(n)
        x[bucket[doc == i]] = weight[doc == i]
        x[BUCKETS:] = dense[i]
        used = np.flatnonzero(x)
        pairs = sum(machine.vectors[a] @ machine.vectors[b] * x[a] * x[b] for k, a in enumerate(used) for b in used[k + 1 :])
        assert np.isclose(got[i], 0.3 + machine.weights @ x + pairs)


def test_statistics():
    doc, bucket, weight, stats = features(["AB cd. 1!!\nAB", ""])
    own = dict(zip(STATISTICS, stats[0], strict=True))
    assert np.isclose(np.expm1(own["log_words"]), 4) and own["upper"] == 4 / 13 and own["digits"] == 1 / 13 and own["signs"] == 3 / 13
    assert own["words_ending_in_signs"] == 0.5 and own["words_without_letters"] == 0.25 and own["words_all_upper"] == 0.5
    assert own["distinct_words"] == 0.75 and own["top_word"] == 0.5 and own["sign_runs"] == 1 / 13 and own["word_length"] == 2.5
    assert (doc == 0).all() and len(bucket) == 3 and np.isclose((weight**2).sum(), 1) and stats[1][0] == 0 and np.isfinite(stats).all()


def test_held_out_accuracy(spark):
    data = "/root/testdata/sf0.1"
    scored = op12_factorisation_machine(spark, data)
    rows = scored.join(spark.read.parquet(f"{data}/labels.parquet"), "doc_id", "left").select("held_out", "score", "predicted", "quality").collect()
    assert len(rows) == 10_000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    tested = [r for r in rows if r.held_out and r.quality is not None]
    for q in (0, 1):
        right = [r.predicted == q for r in tested if r.quality == q]
        assert len(right) > 50 and sum(right) / len(right) > 0.95


def test_classifier_cases(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdef", k=4))
    good = [(i, " ".join(word() for _ in range(30))) for i in range(60)]
    junk = [(100 + i, " ".join(word() + "$$$" for _ in range(30))) for i in range(60)]
    odd = [(300, None), (301, ""), (None, "a b"), (302, "word " * 200_000), (302, "other"), (303, "   \n"), (5, good[5][1])]
    docs = spark.createDataFrame(good + junk + odd, "doc_id long, text string").withColumn("score", F.lit("own")).withColumn("quality", F.lit("x"))
    labels = [(i, 1) for i, _ in good[:40]] + [(i, 0) for i, _ in junk[:40]] + [(302, 1), (302, 0), (999, 1), (None, 1), (7, None), (8, 5)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    machine = learn(docs.drop("score", "quality"), labels)
    rows = score(docs, machine).collect()
    assert len(rows) == 127 and all(0 <= r.score <= 1 for r in rows) and set(rows[0].asDict()) == {"doc_id", "text", "score", "quality", "predicted"}
    right = [r.predicted == (r.doc_id < 100) for r in rows if r.doc_id is not None and 40 <= r.doc_id % 100 < 60 and r.doc_id < 200]
    assert len(right) == 40 and sum(right) >= 38
    assert len({r.score for r in rows if r.doc_id == 5}) == 1
    assert len({r.score for r in rows if not r.text}) == 1  # null and empty alike

    one = score(docs, learn(docs, labels.filter("quality = 1 and doc_id < 100"))).select("score").distinct().collect()
    none = score(docs, learn(docs, labels.filter("false"))).select("score").distinct().collect()
    assert np.isclose(one[0].score, 41 / 42) and len(one) == 1 and [r.score for r in none] == [0.5]
    assert score(docs.filter("false"), machine).count() == 0
    with_null = docs.withColumn("n_chars", F.when(F.col("doc_id") % 2 == 0, F.col("doc_id")))
    assert score(with_null, learn(with_null, labels)).filter("score between 0 and 1").count() == 127
