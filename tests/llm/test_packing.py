import math
import os
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from rigspark.llm.packing import ChunkEncoder, op7_large_item_matching, pack, pack_documents, piece_lengths, plan, token_pieces

os.environ["TOKENIZERS_PARALLELISM"] = "false"
PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_chunks_give_the_tokenizers_ids():
    plain, mine = Tokenizer.from_file(PATH), ChunkEncoder(open(PATH, encoding="utf-8").read())
    rng = random.Random(3)
    texts = ["", " ", "  a  b ", "a\n b\n\n c\t d", "it's 'quoted' don't.", "x<|endoftext|>y z", "　 \x85x \x1c y", "end. \n", "é\xa0 ß  12 a1b2."]
    texts += ["".join(rng.choices(["a", "word", " ", " ", "\n", ".", ",", "'s", "é", "12", "\t", "_", "|", "$$", "日本"], k=60)) for _ in range(800)]
    want = [np.array(e.ids, "<u4").tobytes() for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert mine.encode(texts) == want and mine.encode(texts[::-1]) == want[::-1]


def test_plan_places_everything_once():
    rng = random.Random(1)
    for capacity in (10, 64, 1024):
        for _ in range(20):
            counts = {x: rng.randrange(1, 60) for x in rng.sample(range(1, capacity + 1), rng.randrange(1, min(capacity, 200)))}
            used, seen = defaultdict(list), defaultdict(list)
            for length, a, b, sequence, offset in plan(counts, capacity):
                seen[length] += range(a, b)
                for k in range(b - a):
                    used[sequence + k].append((offset, length))
            assert {x: sorted(r) == list(range(counts[x])) for x, r in seen.items()} == dict.fromkeys(counts, True)
            for places in used.values():
                at = 0
                for offset, length in sorted(places):
                    assert offset == at
                    at += length
                assert at <= capacity
            total = sum(x * n for x, n in counts.items())
            assert len(used) >= total / capacity
    assert plan({}, 8) == []


def plain_bins(lengths, capacity):
    """Sequences when each large piece takes the largest that fits beside it, and smaller ones the tightest gap, piece by piece."""
    large = sorted((x for x in lengths if 3 * x > capacity), reverse=True)
    gaps = []
    while large:
        a = large.pop(0)
        k = next((k for k, b in enumerate(large) if a + b <= capacity), None)
        gaps.append(capacity - a - (large.pop(k) if k is not None else 0))
    for x in sorted((x for x in lengths if 3 * x <= capacity), reverse=True):
        fits = [g for g in gaps if g >= x]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - x)
        else:
            gaps.append(capacity - x)
    return len(gaps)


def test_plan_against_a_plain_packer():
    rng = random.Random(9)
    for capacity in (12, 50, 1024):
        for _ in range(15):
            lengths = [rng.randrange(1, capacity + 1) if rng.random() < 0.5 else rng.randrange(1, capacity // 4 + 1) for _ in range(rng.randrange(1, 250))]
            counts = {x: lengths.count(x) for x in set(lengths)}
            used = {sequence + k for _, a, b, sequence, _ in plan(counts, capacity) for k in range(b - a)}
            assert len(used) == plain_bins(lengths, capacity)


def test_remembered_chunks_are_forgotten(monkeypatch):
    from rigspark.llm import packing

    monkeypatch.setattr(packing, "REMEMBERED", 50)
    plain, mine = Tokenizer.from_file(PATH), ChunkEncoder(open(PATH, encoding="utf-8").read())
    rng = random.Random(5)
    for _ in range(12):
        texts = [" ".join(f"w{rng.randrange(200)}" + "x" * rng.randrange(20) for _ in range(40)) for _ in range(5)]
        assert mine.encode(texts) == [np.array(e.ids, "<u4").tobytes() for e in plain.encode_batch(texts, add_special_tokens=False)]
        assert len(mine.hashes) <= 50 + 2 * 200 and len(mine.hashes) == len(mine.spans) == len(mine.seen)


def test_query(spark, sf_dir):
    tk = Tokenizer.from_file(PATH)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op7_large_item_matching(spark, sf_dir).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert by_doc.keys() == texts.keys()
    total = 0
    for d, text in texts.items():
        ids = np.array([*tk.encode(text, add_special_tokens=False).ids, 2], "<u4")
        total += len(ids)
        got = sorted(by_doc[d], key=lambda r: r.piece)
        assert [r.length for r in got] == piece_lengths(len(ids), 1024) and [r.piece for r in got] == list(range(len(got)))
        assert all(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in got)
    for places in by_sequence.values():
        assert [o for o, _ in sorted(places)] == [sum(n for _, n in sorted(places)[:i]) for i in range(len(places))]
        assert sum(n for _, n in places) <= 1024
    assert len(by_sequence) <= math.ceil(total / 1024) * 1.03 + 1


def test_edges(spark):
    docs = [(1, None), (1, None), (None, ""), (2, "word " * 5000), (3, "a")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'clash' as length", "1 as rank")
    out = pack_documents(df).collect()
    assert sorted(r.length for r in out) == sorted([1, 1, 1, 2, *piece_lengths(sum(r.length for r in out if r.doc_id == 2), 1024)])
    assert pack_documents(df.filter("false")).count() == 0
    kept = token_pieces(df, PATH, capacity=100)
    assert all(len(r.ids) == r.length for r in kept.collect())
    assert pack(kept, 100).agg({"sequence_id": "max"}).first()[0] is not None
