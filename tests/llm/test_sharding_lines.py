import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from rigspark.llm.line_dedup import dedup_lines, op6_line_runs
from rigspark.llm.sharding import difference, op1_karmarkar_karp, shard_documents

WHITE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_difference_is_tight():
    sizes = [(i * 7919) % 1000 + 1 for i in range(2000)]
    bins = [0] * 24
    for s, b in zip(sizes, difference(sizes, 24), strict=True):
        bins[b] += s
    assert max(bins) - min(bins) <= 0.001 * sum(bins) / 24
    assert difference([], 3) == [] and len(difference([5], 3)) == 1


def plain_differencing(sizes, shards):
    """Sums of the bins when the two partitions of largest spread are combined, largest bin with smallest, until one is left."""
    parts = [[s] + [0] * (shards - 1) for s in sizes]
    while len(parts) > 1:
        parts.sort(key=lambda p: p[0] - p[-1])
        a, b = parts.pop(), parts.pop()
        parts.append(sorted((x + y for x, y in zip(a, reversed(b), strict=True)), reverse=True))
    return parts[0]


def test_difference_against_plain_differencing():
    rng = random.Random(2)
    for shards, n in ((2, 9), (3, 40), (24, 60), (24, 200)):
        sizes = [rng.randrange(1, 10**9) for _ in range(n)]
        bins = [0] * shards
        for s, b in zip(sizes, difference(sizes, shards), strict=True):
            bins[b] += s
        assert sorted(bins, reverse=True) == plain_differencing(sizes, shards)


def test_shards(spark, sf_dir):
    rows = op1_karmarkar_karp(spark, sf_dir).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    of_text, slots, sums = {}, defaultdict(list), defaultdict(int)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(data) + 8, zlib.crc32(data))
        assert of_text.setdefault(data, r.shard) == r.shard
        slots[r.shard].append(r.slot)
        sums[r.shard] += r.size
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    largest = defaultdict(int)
    for r in rows:
        largest[texts[r.doc_id]] += r.size
    mean = sum(sums.values()) / 24
    assert max(sums.values()) <= max(1.01 * mean, max(largest.values()))


def test_shard_edge_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, 5), (1, None, 5), (None, "", 6), (2, "é" * 70_000, 7), (3, "a", 8)], "doc_id long, text string, size long"
    )
    out = shard_documents(docs, shards=3).collect()
    assert len(out) == 5 and sorted(r["size"] for r in out) == [8, 8, 8, 9, 140_008]
    assert shard_documents(docs.filter("false")).count() == 0


def brute_lines(docs, min_chars=20, min_docs=3):
    key = lambda x: x.strip(WHITE).translate(LOWER)
    held = defaultdict(set)
    for d, text in docs:
        for x in (text or "").split("\n"):
            if len(key(x)) >= min_chars:
                held[key(x)].add(d)
    out = {}
    for d, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(held.get(key(x), ())) >= min_docs and max(held[key(x)]) != d)]
        out[d] = (len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def test_lines_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in op6_line_runs(spark, sf_dir).collect()}
    assert got == brute_lines(docs)
    assert sum(x[1] for x in got.values()) > 0


def test_line_edges(spark):
    common = "  A COMMON LINE OF WORDS ÄÖ\t"
    docs = [(i, f"head {i}\n{common}\n{common.lower() if i % 2 else common}\n") for i in range(9)]
    docs += [(20, None), (21, ""), (22, "x" * 200_000), (23, "short\nshort"), (24, "short"), (25, "short")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_lines", F.lit("clash"))
    for batches in (1, 5):
        out = dedup_lines(df, batches=batches)
        got = {r.doc_id: (r.n_lines, r.n_dropped, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in out.collect()}
        assert got == brute_lines(docs)
    assert got[8][1] == 0 and got[7][1] == 1
    assert dedup_lines(df.filter("false")).count() == 0
    twice = spark.createDataFrame([(1, common * 2), (1, common * 2), (None, common * 2)], "doc_id long, text string")
    assert [r.n_dropped for r in dedup_lines(twice).orderBy("doc_id").collect()] == [1, 0, 0]
