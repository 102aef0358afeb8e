import base64
import hashlib
import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rigspark.llm import webtext
from rigspark.llm.spotsigs import compare_edits, fingerprints, op2_spotsigs, pruned_jaccard, signature_sets, similar_sets
from rigspark.llm.webtext import Model, blocks, extract, features, fit, labelled_pages, likelihood, main_text, rewritten, viterbi


def test_signatures():
    a, b, c, d, e = signature_sets(pa.array(["the red fox of the old wood", "The RED, fox; of the (old) wood!", "", None, "zzz"]))
    assert (a == b).all() and len(a) == 3 and len(c) == len(d) == 0 and len(e) == 1
    assert pruned_jaccard(a, a) == 1 and pruned_jaccard(c, d) == 1 and pruned_jaccard(a, c) == 0
    assert pruned_jaccard(a[:1], a, 0.5) == 0 and pruned_jaccard(a[:1], a) == pytest.approx(1 / 3)


def test_query_against_python(spark, sf_dir):
    docs = sorted(((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()), reverse=True)
    for got in (op2_spotsigs(spark, sf_dir).collect(), compare_edits(spark.read.parquet(f"{sf_dir}/documents.parquet"), bucket_bytes=20_000).collect()):
        rows = {r.doc_id: r for r in got}
        assert len(got) == len(docs)
        sets = dict(zip([d for d, _ in docs], signature_sets(pa.array([t for _, t in docs])), strict=True))
        for i, (d, text) in enumerate(docs):
            n, after = docs[(i + 1) % len(docs)]
            half = len(text) // 2
            edited = text[: len(text) - half] + after[:half]
            assert rows[d].n_chars == len(text) and rows[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            x, y, z = set(sets[d]), set(next(iter(signature_sets(pa.array([edited]))))), set(sets[n])
            like = lambda p, q: len(p & q) / len(p | q) if p | q else 1.0
            assert rows[d].near_edited == pytest.approx(like(x, y)) and rows[d].near_next == pytest.approx(like(x, z))
            assert np.frombuffer(base64.b64decode(rows[d].fingerprint), "<u4").tolist() == sorted(x)
    far = [r for r in got if r.n_signatures > 20]
    assert np.mean([r.near_edited for r in far]) > 0.2 > 0.05 > np.median([r.near_next for r in far])


def test_edit_edges(spark):
    docs = [(5, "é" * 100_001), (5, "b a"), (5, "b a"), (3, None), (None, "x"), (9, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("bucket", F.lit("clash")).withColumn("place", F.lit(0))
    assert sorted((r.doc_id or 0, r.n_chars) for r in compare_edits(df).collect()) == [(0, 1), (3, 0), (5, 3), (5, 3), (5, 100_001), (9, 0)]
    one = compare_edits(df.filter("doc_id = 9")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert compare_edits(df.filter("false")).count() == 0


def test_similar_sets_brute_force(spark):
    rng = random.Random(4)
    base = [f"the w{i} x{i}" for i in range(60)]
    texts = [" ".join(rng.sample(base, rng.randrange(35, 60))) for _ in range(40)] + [" ".join(base)] * 3 + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [set(s) for s in signature_sets(pa.array(texts))]
    pairs, members = similar_sets(fingerprints(df), 0.6)
    rep = {r.doc_id: r.representative for r in members.collect()}
    assert rep[41] == rep[42] == 40 and 43 not in rep
    want = {(min(i, j), max(i, j)) for i in set(rep.values()) for j in set(rep.values()) if i < j and len(sets[i] & sets[j]) >= 0.6 * len(sets[i] | sets[j])}
    assert want and {(min(r.a, r.b), max(r.a, r.b)) for r in pairs.collect()} == want


def test_likelihood_gradient():
    rng = np.random.default_rng(0)
    page, labels = [np.array([0, 1 + i % 3]) for i in range(5)], [0, 1, 1, 0, 1]
    model = Model(rng.normal(size=(webtext.BUCKETS, 2)), rng.normal(size=(2, 2)))
    _, states, moves = likelihood(model, page, labels)
    for i, j in ((0, 1), (1, 0)):
        up = Model(model.weights, model.moves.copy())
        up.moves[i, j] += 1e-5
        assert (likelihood(up, page, labels)[0] - likelihood(model, page, labels)[0]) / 1e-5 == pytest.approx(-moves[i, j], abs=1e-3)
    up = Model(model.weights.copy(), model.moves)
    up.weights[0, 1] += 1e-5
    assert (likelihood(up, page, labels)[0] - likelihood(model, page, labels)[0]) / 1e-5 == pytest.approx(-states[:, 1].sum(), abs=1e-3)
    paths = [[int(x) for x in f"{k:05b}"] for k in range(32)]
    assert viterbi(model, page) == max(paths, key=lambda y: likelihood(model, page, y)[0])


@pytest.fixture(scope="module")
def model(spark):
    return fit(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"), 120)


def test_pages(spark, sf_dir, model):
    rows = extract(spark.read.parquet(f"{sf_dir}/pages.parquet"), model).collect()
    html = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert len(rows) == len(html)
    for r in rows:
        page = blocks(html[r.page_id])
        assert r.text == "\n".join(b.text for b in page if "article" in b.tags)


def test_held_out_layouts(spark, model):
    rng, right, total = np.random.default_rng(5), 0, 0
    for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        page = blocks(r.html)
        article, short = [b.text for b in page if "article" in b.tags], [b.text for b in page if "nav" in b.tags]
        made = blocks(rewritten(article, short, rng))
        labels = viterbi(model, features(made))
        right += sum(y == b.main for y, b in zip(labels, made, strict=True))
        total += len(made)
    assert right > 0.98 * total


def test_page_edges(spark, model):
    assert [b.text for b in blocks("<p>a &amp; b\n c<br>d<p>x<b>y</b>z<script>no</script>")] == ["a & b c d", "xyz"]
    pages = [(1, None), (2, ""), (3, "<html><body><article><p>One &lt;two&gt; three.</p></article>"), (3, "plain words only"), (None, "<<>>&&#0;</p></div>"), (4, "<article><p>" + "long text. " * 50_000)]
    df = spark.createDataFrame(pages, "page_id long, html string").withColumn("url", F.lit("u")).withColumn("text", F.lit("clash"))
    rows = extract(df, model).collect()
    assert len(rows) == 6 and {r.page_id: r.text for r in rows}[1] == "" and any(r.text == "One <two> three." for r in rows)
    assert max(len(r.text) for r in rows) == 549_999
    assert extract(df.filter("false"), model).count() == 0 and main_text(fit(df.filter("false")), "<p>a") in ("", "a")
    assert labelled_pages(["<p>no article</p>"]) == []


def test_no_text_is_lost():
    texts = lambda h: [b.text for b in blocks(h)]
    assert texts("<html><head><title>T</title><p>Hello world.</p>") == ["T", "Hello world."]
    assert texts("<head><meta charset=x><title>T</title>bare <b>text</b><p>more") == ["T", "bare text", "more"]
    assert texts("<html><head><title>T</title></head><article><p>a<body class=x><p>b</article>") == ["T", "a", "b"]
    assert texts("<p>x<script>var a='<p>';</script>y<style>p{}</style>z</p>") == ["xyz"]
    assert texts("<p>mass <math><mi>m</mi><mo>=</mo><mn>1</mn></math> kg</p>") == ["mass m=1 kg"]
    assert texts("<p>a<svg><text>b</text></svg></p><object><p>c</object><noscript>d</noscript><template><p>e</template><x-y>f</x-y>") == ["ab", "c", "d", "e", "f"]
    assert texts("<p>a</body></html>late") == ["a", "late"]
    assert all("article" in b.tags for b in blocks("<article><ul><li>a<li>b</ul><p>c<p>d</b></i><div>e</div>f"))


def test_open_tags_cost_linear_time():
    for page in (
        "<div>x " * 100_000,
        "<a href=y>x " * 100_000,
        "<b>x " * 50_000 + "</i>y " * 50_000,
        "".join(f"<div class='c{chr(97 + i % 26)} k{chr(97 + i // 26 % 26)}x'>x" for i in range(50_000)),
        "<div>" * 50_000 + "<p>x</p><li>y" * 20_000,
        "".join(f"<t{i}>x" for i in range(50_000)),
    ):
        began = time.process_time()
        page_blocks = blocks(page)
        assert "".join(b.text for b in page_blocks).replace(" ", "").count("x") == page.count(">x")
        assert time.process_time() - began < 20


def unmarked(spark, n, seed=3):
    """Pages of other layouts that hold no article or main, as (html, text of their article)."""
    rng, out, given = np.random.default_rng(seed), [], [blocks(r.html) for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()]
    while len(out) < n:
        page = given[len(out) % len(given)]
        made = rewritten([b.text for b in page if "article" in b.tags], [b.text for b in page if "nav" in b.tags], rng)
        if "<article" not in made and "<main" not in made:
            out.append((made.replace(" data-main", ""), [b.main for b in blocks(made)]))
    return out


def test_no_marked_page(spark):
    pages = unmarked(spark, 40)
    df = spark.createDataFrame([(i, "u", h) for i, (h, _) in enumerate(pages)], "page_id long, url string, html string")
    model = fit(df)
    labels = [(y, m) for h, main in pages for y, m in zip(viterbi(model, features(blocks(h))), main, strict=True)]
    assert sum(y == m for y, m in labels) > 0.85 * len(labels)
    assert all(r.text for r in extract(df, model).collect())
    # tags without text of their own, or with asides alone, mark nothing
    empty = spark.createDataFrame([(1, "<main></main><p>x"), (2, "<article><nav>menu</nav></article><p>y"), (3, "<!-- <article> --><p>z")], "page_id long, html string")
    assert (fit(empty).weights == webtext.prior().weights).all()


def test_rare_marked_pages(spark):
    marked = [r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").limit(5).collect()]
    others = [h for h, _ in unmarked(spark, 60)] + ["<p>about <article></article> and <main></main>"] * 400
    df = spark.createDataFrame(list(enumerate(others + marked)), "page_id long, html string")
    learned = []
    for sample in (2, 4, 300):
        learned.append(fit(df, sample))
        assert np.abs(learned[-1].weights).sum() > 0 and not (learned[-1].weights == webtext.prior().weights).all()
    keyed = df.filter(F.col("page_id") >= len(others)).orderBy(F.pmod(F.xxhash64("page_id"), F.lit(1 << 40))).collect()
    for model, n in zip(learned, (2, 4, 5), strict=True):
        assert (model.weights == webtext.train(labelled_pages([r.html for r in keyed[:n]])).weights).all()
