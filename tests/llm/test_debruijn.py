import hashlib
import random
import re

from pyspark.sql import functions as F

from rigspark.llm.debruijn import drop_repeats, op10_debruijn


def brute(docs, window=13):
    words = [(d, re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for d, t in docs]
    least = {}
    for d, w in words:
        for i in range(len(w) - window + 1):
            g = tuple(w[i : i + window])
            least[g] = min(least.get(g, d), d)
    out = {}
    for d, w in words:
        gone = {i + k for i in range(len(w) - window + 1) if least[tuple(w[i : i + window])] < d for k in range(window)}
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out[d] = (len(w), len(gone), hashlib.sha256(kept).hexdigest())
    return out


def test_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in op10_debruijn(spark, sf_dir).collect()}
    assert got == brute(docs)
    assert sum(x[1] for x in got.values()) > 0


def test_edges(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcé", k=3))
    passage = [word() for _ in range(60)]
    docs = [(0, None), (1, ""), (2, "x y z"), (3, "\n\t "), (4, " ".join(word() for _ in range(30_000)))]
    for k in range(10, 60):
        a, b = sorted(rng.sample(range(61), 2))
        docs.append((k, " ".join([word() for _ in range(rng.randrange(20))] + passage[a:b] + ["\n"] + [word() for _ in range(20)])))
    docs += [(70, docs[7][1]), (71, docs[7][1]), (72, " ".join(["w"] * 40)), (73, " ".join(["w"] * 13)), (74, " ".join(["w"] * 12))]
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("tag", F.lit("clash")).withColumn("paths", F.lit(1))
    for parts in (1, 7):
        rows = drop_repeats(df.repartition(parts)).collect()
        assert {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in rows} == brute(docs)
    long = " ".join(passage)
    odd = spark.createDataFrame([(None, long), (None, long), (5, long), (5, long), (5, long + " more"), (9, long)], "doc_id long, text string")
    assert sorted((r.doc_id or -1, r.n_removed) for r in drop_repeats(odd).collect()) == [(-1, 0), (-1, 0), (5, 0), (5, 0), (5, 0), (9, 60)]
    assert drop_repeats(df.filter("false")).count() == 0
