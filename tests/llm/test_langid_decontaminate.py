import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from rigspark.llm.decontaminate import best_match, contaminated, op9_pigeonhole, pieces
from rigspark.llm.langid import identify, learn, ngrams, op4_rank_order, profiles, ranked


def brute_distance(unit, text):
    row = [0] * (len(text) + 1)
    for i, u in enumerate(unit):
        new = [i + 1]
        for j, w in enumerate(text):
            new.append(min(new[-1] + 1, row[j + 1] + 1, row[j] + (u != w)))
        row = new
    return min(row)


def test_myers_equals_dynamic_programming():
    rng = random.Random(0)
    for _ in range(400):
        unit = [rng.randrange(4) for _ in range(rng.randrange(1, 90))]
        text = [rng.randrange(4) for _ in range(rng.randrange(0, 60))]
        want = brute_distance(unit, text)
        got = best_match(unit, text, len(unit))
        assert (got[0] if got else len(unit)) == want
    assert pieces(13, 1) == [(0, 6), (6, 7)] and sum(n for _, n in pieces(59, 7)) == 59


def test_leaks(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    norm = lambda t: " ".join((t or "").lower().split())
    items = {r.item_id: norm(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    whole = {(r.doc_id, i) for r in docs.collect() for i, t in items.items() if t in norm(r.text)}
    got = {(r.doc_id, r.item_id): r.distance for r in op9_pigeonhole(spark, sf_dir).collect()}
    assert whole and whole <= got.keys() and all(got[k] == 0 for k in whole)
    assert len(got.keys() - whole) <= 0.2 * len(whole)


def test_edited_and_partial_leaks(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    item = [word() for _ in range(48)]
    noise = lambda n: [word() for _ in range(n)]
    edited = [("X" + w if i % 9 == 4 else w) for i, w in enumerate(item)]
    docs = [(1, noise(50) + item + noise(9)), (2, noise(3) + [w.upper() for w in item]), (3, noise(30) + edited), (4, item[10:24]),
            (5, noise(900)), (6, noise(20) + item[:6] + noise(20)), (7, item[5:12] + ["new"] + item[12:20]), (7, noise(5))]
    rows = [(d, "\n ".join(w)) for d, w in docs] + [(8, None), (9, ""), (None, " ".join(item))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    items = spark.createDataFrame([(0, " ".join(item)), (1, None), (2, ""), (3, "too short"), (None, "a b c d e f g h i"), (4, " ".join(noise(30)))], "item_id long, text string")
    for block in (40, 10_000):
        got = {(r.doc_id, r.item_id) for r in contaminated(df, items, block_words=block).collect()}
        assert got == {(d, 0) for d in (1, 2, 3, 4, 7, None)}
    assert contaminated(df.filter("false"), items).count() == 0 and contaminated(df, items.filter("false")).count() == 0


def test_short_items(spark):
    items = [(1, "Forty two"), (2, "yes"), (3, "what is the capital of France?"), (4, " "), (5, "a b c d e f g h")]
    texts = {1: "the answer is FORTY\n two , yes or no", 2: "forty-two", 3: "forty and two", 4: "yesterday eyes", 5: "yes", 6: "so what is the capital of France? yes yes", 7: "what is the capital in France?",
             8: "forty", 9: "two", 10: "x " * 999 + "forty two " * 999, 11: "a b c d X f g h", 12: None, 13: ""}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1)
    df = df.union(df.filter("doc_id = 5")).union(df.filter("doc_id = 5").withColumn("doc_id", F.lit(None).cast("long")))
    words = lambda t: f" {' '.join((t or '').lower().split())} "
    want = {(d, i, 0, len(q.split())) for d, t in texts.items() for i, q in items[:3] if words(q) in words(t)}
    assert len(want) == 6
    for block in (40, 10_000):
        got = [tuple(r) for r in contaminated(df, spark.createDataFrame(items, "item_id long, text string"), block_words=block).select("doc_id", "item_id", "distance", "n_words").collect()]
        assert sorted(got, key=str) == sorted(want | {(None, 2, 0, 1), (11, 5, 1, 8)}, key=str)


def test_ngrams():
    codes, counts = ngrams("Ab ab")
    assert sorted(counts) == sorted([2, 2] + [2, 2, 2] + [2, 2])
    assert len(ngrams("12 .")[0]) == 0 and len(ranked(*ngrams("abc" * 50), 4)) == 4


def test_held_out_accuracy(spark):
    rows = op4_rank_order(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text"), "doc_id").collect()
    tested = [r for r in rows if r.held_out and r.lang_pred != "und" and len(r.text) >= 40]
    right = sum(r.lang == r.lang_pred for r in tested) / len(tested)
    assert len(rows) == 1000 and right > 0.95, right
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges(spark):
    docs = [(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, None, "en"), (4, "12 !!", "de"), (5, "", None),
            (6, "the " * 100_000, None), (None, "und der hund", "de"), (1, "the cat and the dog", "en")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    learned = profiles(df)
    got = [(r.doc_id, r.lang_pred) for r in identify(df, learned).collect()]
    assert sorted(got, key=str) == sorted([(1, "en"), (1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (6, "en"), (None, "de")], key=str)
    assert {r.lang_pred for r in identify(df, profiles(df.filter("lang is null"))).collect()} == {"und"}
    assert identify(df.filter("false"), learned).count() == 0 and learn(df.filter("false")) == []


def test_pairs_against_plain_edit_search(spark):
    rng = np.random.default_rng(4)
    word = lambda: f"w{rng.integers(0, 40)}"
    items = {i: [word() for _ in range(n)] for i, n in enumerate((3, 7, 8, 13, 14, 20, 33, 41))}
    docs = {}
    for d in range(60):
        text = [word() for _ in range(int(rng.integers(0, 40)))]
        item = items[d % 8]
        a = int(rng.integers(0, max(1, len(item) - 13)))
        part = list(item[a : a + 20] if d % 3 else item)
        for _ in range(d % 5):
            at = int(rng.integers(0, len(part)))
            part[at : at + int(rng.integers(0, 2))] = [word()] * int(rng.integers(0, 2))
            part = part or [word()]
        docs[d] = text + part + [word() for _ in range(int(rng.integers(0, 20)))]
    want = set()
    for d, text in docs.items():
        for i, item in items.items():
            if len(item) < 8:
                if any(text[k : k + len(item)] == item for k in range(len(text))):
                    want.add((d, i))
                continue
            units = [(item, max(1, len(item) // 8))] + [(item[k : k + 13], 1) for k in range(len(item) - 12) if len(item) > 13]
            if any(brute_distance(u, text) <= e for u, e in units):
                want.add((d, i))
    df = spark.createDataFrame([(d, " ".join(t)) for d, t in docs.items()], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in items.items()], "item_id long, text string")
    got = lambda **k: {(r.doc_id, r.item_id) for r in contaminated(df, bench, **k).collect()}
    assert got() == want and 10 < len(want) < 400
    assert got(longest=16) == want and got(longest=20, block_words=30) == want  # in stretches, and in many blocks


def plain_ranks(texts, ranks):
    """Most frequent n-grams of letters, words padded by a space; equal counts by length and code points."""
    found = Counter()
    for text in texts:
        s = " " + "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text) + " "
        for i in range(len(s)):
            if s[i] != " ":
                found[s[i]] += 1
                found[s[i - 1 : i + 2]] += 1
            if i + 1 < len(s) and s[i : i + 2] != "  ":
                found[s[i : i + 2]] += 1
    code = lambda g: (len(g), [0 if c == " " else ord(c) + 1 for c in g])
    return sorted(found, key=lambda g: (-found[g], code(g)))[:ranks]


def test_out_of_place_distance_against_plain_python(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.collect()
    by_lang = {}
    for r in rows:
        if r.lang is not None:
            by_lang.setdefault(r.lang, []).append(r.text or "")
    known = {lang: {g: k for k, g in enumerate(plain_ranks(texts, 100))} for lang, texts in by_lang.items()}
    learned = profiles(docs, sample=10**9, ranks=100)
    assert [lang for lang, _ in learned] == sorted(known)
    got = {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in identify(docs, learned, 100).select("doc_id", "lang_pred", "score").collect()}
    for r in rows:
        own = plain_ranks([r.text or ""], 100)
        if not own:
            assert got[r.doc_id] == ("und", 0.0)
            continue
        cost = {lang: sum(min(abs(p[g] - k), 100) if g in p else 100 for k, g in enumerate(own)) for lang, p in known.items()}
        best = min(sorted(cost), key=cost.get)
        assert got[r.doc_id] == (best, round(1 - cost[best] / (100 * len(own)), 9))
