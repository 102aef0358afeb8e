import hashlib
import math
import random

import numpy as np
from pyspark.sql import functions as F

from rigspark.llm.vector_codes import CellMemo, digest, encode, integer_vectors, op11_cell_memo, train, with_label_error


def plain(rows, parts=4, entries=256, rounds=4):
    """{(id, vector): (code, error)} and codebooks, all distances evaluated with Python's integers."""
    kept = sorted(((i, tuple(math.floor(1024 * x) for x in v)) for i, v in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v in kept]
    books = [[own[p] for own in cut[:entries]] for p in range(parts)]

    def nearest(book, x):
        return min((sum((a - b) ** 2 for a, b in zip(c, x, strict=True)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for own in cut:
                members.setdefault(nearest(books[p], own[p])[1], []).append(own[p])
            books[p] = [tuple(sum(c) // len(members[e]) for c in zip(*members[e], strict=True)) if e in members else old for e, old in enumerate(books[p])]
    coded = {}
    for (i, v), own in zip(kept, cut, strict=True):
        found = [nearest(books[p], own[p]) for p in range(parts)]
        coded[i, v] = "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)
    return coded, books


def test_memo_equals_all_distances():
    rng = np.random.default_rng(0)
    book = rng.integers(-200, 200, (40, 5))
    book[7] = book[3]  # a tie goes to the lower entry
    points = np.concatenate((rng.integers(-300, 300, (2000, 5)), book, np.repeat(book[:2], 200, axis=0)))
    want = ((points[:, None] - book[None]) ** 2).sum(axis=2)
    for cell in (1, 16, 64, 4096):
        memo = CellMemo(book, cell)
        for _ in range(2):
            entry, distance = memo.nearest(points)
            assert (entry == want.argmin(axis=1)).all() and (distance == want.min(axis=1)).all()
        assert memo.made == len(np.unique(points // cell, axis=0))  # the second pass finds every cell
        kept = memo.undominated(np.unique(points // cell, axis=0))
        assert kept.any(axis=1).all() and (cell > 64 or kept.mean() < 0.7)


def test_codes_equal_plain_training(spark):
    rng = random.Random(1)
    rows = [(i * 3, [rng.gauss(i % 7 / 7, 0.2) for _ in range(8)]) for i in range(120)]
    rows += [(1000 + i, rows[5][1]) for i in range(60)]  # a hot vector
    bad = [(2000, None), (2001, []), (2002, [None] * 8), (2003, [float("nan")] * 8), (2004, [1.0] * 7 + [float("inf")]), (2005, [0.5] * 6)]
    label = lambda i: None if i % 4 == 1 else i % 4
    df = spark.createDataFrame([(i, v, label(i), "x") for i, v in rows + bad], "vec_id long, embedding array<float>, label int, code string").repartition(5)
    kept = integer_vectors(df)
    books = train(kept, entries=16)
    exact = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    want, want_books = plain(exact, entries=16)
    assert books.tolist() == [[list(c) for c in book] for book in want_books]
    assert digest(books) == hashlib.sha256(",".join(str(x) for b in want_books for c in b for x in c).encode()).hexdigest()
    got = with_label_error(encode(kept, books)).collect()
    assert sorted((r.vec_id, r.code, r.error) for r in got) == sorted((i, *own) for (i, _), own in want.items())
    errors = {}
    for r in got:
        errors[r.label] = errors.get(r.label, 0) + r.error
    assert None in errors and all(r.label_error == errors[r.label] for r in got)


def test_vector_cases(spark):
    schema = "vec_id long, embedding array<float>, label int"
    empty = integer_vectors(spark.createDataFrame([], schema))
    assert encode(empty, train(empty)).count() == 0
    # repeated rows and ids, a null id, a length that four does not divide, components of any size
    rows = [(1, [1.0, 2.0, 3.0, 4.0, 5.0], 1), (1, [1.0, 2.0, 3.0, 4.0, 5.0], 1), (None, [9e37, -9e37, 0.0, -0.0, 1.0], None), (1, [0.0] * 5, 2)]
    kept = integer_vectors(spark.createDataFrame(rows, schema))
    books = train(kept)
    got = encode(kept, books).collect()
    assert books.shape == (4, 4, 2) and len(got) == 4 and all(r.error == 0 for r in got)
    assert books[:, 0].ravel().tolist() == [0] * 8 and books[3, 1].tolist() == [0, 0]  # equal ids in the order of their vectors


def test_query(spark, sf_dir):
    rows = op11_cell_memo(spark, sf_dir).collect()
    want, books = plain([(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").filter(F.col("embedding").isNotNull()).collect()])
    assert sorted((r.vec_id, r.code, r.error) for r in rows) == sorted((i, *own) for (i, _), own in want.items())
    assert {r.codebooks_sha256 for r in rows} == {digest(np.array(books))}
