"""Alignment of two tokenizers' ids over the same bytes, and how often ids meet in a corpus.

The tokens of both end at byte offsets. Each side's ends go into a dictionary from end to index; the keys
that both hold, in order, cut the two id lists into groups that cover the same bytes, and the
links of a group are its pairs of tokens whose byte ranges overlap.

Neither tokenizer joins a visible character to the space behind it, so a text is cut in front of such
spaces, and a stretch between two cuts is tokenised and aligned once for all its occurrences in a
worker (``Aligner``). Where that does not hold, for a text with white space beyond ASCII's or a
vocabulary with such a piece, the text is one stretch.

Counting an id pair over the corpus needs one row a pair and block of documents. That row meets the pair's
count and goes back to its block, where the sums of the documents are made from the block's lists, which
travel once, packed into one row. So no row a link or a document's pair is ever shuffled, a pair
in all documents is a row a block, and a block is bounded in bytes (one longer text is a block alone).

Cases: texts that are null, empty, or that either tokenizer does not give back byte for byte, have no tokens, zeros
and an empty digest; special tokens' strings inside texts are plain text; counts of an id that tie are all
best; rows without doc_id and repeated rows are documents of their own; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stage, table
from .words import text_blocks

#: Bytes of text, and documents, of a block.
BLOCK_BYTES = 4 << 20
ROW_BITS = 16
BLOCK_DOCUMENTS = 1 << ROW_BITS
#: A pair is the id of A, shifted by this, and the id of B.
PAIR_BITS = 24
#: Stretches that are tokenised at once.
TOKENISED = 4_096
#: Characters of stretches, and stretches, that a worker remembers between blocks; beyond, it starts anew.
REMEMBERED_CHARACTERS = 20_000_000
REMEMBERED = 600_000

#: A space behind a visible character begins a stretch, unless it is the text's last character.
_CUT = re.compile(r"(?<=\S)(?= (?!\Z))")
#: White space beyond ASCII's.
_WIDE = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: itself where Latin-1 prints it, else the next of U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


def group_edges(ends_a: list[int], ends_b: list[int]) -> tuple[list[int], list[int]]:
    """The last token of A and of B in each group: those that end at an offset where both sides end."""
    index_a = dict(zip(ends_a, range(len(ends_a)), strict=True))
    index_b = dict(zip(ends_b, range(len(ends_b)), strict=True))
    common = sorted(index_a.keys() & index_b.keys())
    return list(map(index_a.__getitem__, common)), list(map(index_b.__getitem__, common))


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ends of either side, and the tokens of A and B that overlap in front of each: between two ends lies exactly one pair."""
    ends = np.union1d(ends_a, ends_b)
    return ends, np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)


def _laid(ids: list[list[int]], size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ids of all stretches behind one another, the end of each, and the end of each stretch."""
    number = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter(chain.from_iterable(ids), np.int64, int(number.sum()))
    ends = np.cumsum(size[flat])
    return flat, ends, np.concatenate(([0], ends))[np.cumsum(number)]


class Aligner:
    """Both tokenizers, and what they make of every stretch seen."""

    def __init__(self, tokenizer_json: str, piece_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(tokenizer_json)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=piece_model)
        alphabet = byte_alphabet()
        self.bytes_a: dict[int, bytes] = {}
        for token, i in self.a.get_vocab().items():
            known = all(c in alphabet for c in token)
            self.bytes_a[i] = bytes(alphabet[c] for c in token) if known else token.encode()
        self.size_a = np.zeros(max(self.bytes_a) + 1, np.int64)
        for i, x in self.bytes_a.items():
            self.size_a[i] = len(x)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(m[1], 16)]) if self.b.is_byte(i) and (m := _BYTE_PIECE.fullmatch(p)) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.size_b = np.array(list(map(len, self.bytes_b)), np.int64)
        self.cuttable = not any(re.search("[^▁]▁", p) for p in pieces)
        self._begin()

    def _begin(self) -> None:
        self.known: dict[str, int] = {}
        self.characters = 0
        self.groups: list[str] = []
        self.numbers = np.zeros((0, 4), np.int64)  # A tokens, B tokens, groups, links
        self.lost = np.zeros(0, bool)  # not given back byte for byte
        self.pairs = np.zeros(0, np.int64)  # of every link, those of a stretch behind one another
        self.first = np.zeros(0, np.int64)

    def _remember(self, stretches: list[str], ids_a: list[list[int]], ids_b: list[list[int]]) -> None:
        """Groups and links of some stretches. Their tokens are laid behind one another, so that all share one dictionary a side."""
        sizes = list(map(len, map(str.encode, stretches)))
        lost = np.zeros(len(stretches), bool)
        laid_a, laid_b = _laid(ids_a, self.size_a), _laid(ids_b, self.size_b)
        edges = np.cumsum(sizes)
        if not (np.array_equal(laid_a[2], edges) and np.array_equal(laid_b[2], edges) and self._same(stretches, ids_a, ids_b)):
            lost = np.array([not self._same([s], [x], [y]) for s, x, y in zip(stretches, ids_a, ids_b, strict=True)], bool)
            ids_a, ids_b = ([[] if gone else x for x, gone in zip(ids, lost, strict=True)] for ids in (ids_a, ids_b))
            laid_a, laid_b = _laid(ids_a, self.size_a), _laid(ids_b, self.size_b)
            edges = laid_a[2]
        (flat_a, array_a, _), (flat_b, array_b, _) = laid_a, laid_b
        last_a, last_b = group_edges(array_a.tolist(), array_b.tolist())

        said_a, said_b = list(map(str, flat_a.tolist())), list(map(str, flat_b.tolist()))
        said, i, k = [], 0, 0
        for j, m in zip(last_a, last_b, strict=True):
            said.append(f"{said_a[i] if i == j else ','.join(said_a[i : j + 1])}|{said_b[k] if k == m else ','.join(said_b[k : m + 1])}")
            i, k = j + 1, m + 1
        groups_to = np.searchsorted(array_a[np.array(last_a, np.int64)], edges, "right")
        at_ends, at_a, at_b = links(array_a, array_b)
        links_to = np.searchsorted(at_ends, edges, "right")
        pairs = flat_a[at_a] << PAIR_BITS | flat_b[at_b]

        start = 0
        for s, stop in zip(stretches, groups_to.tolist(), strict=True):
            self.known[s] = len(self.groups)
            self.groups.append(";".join(said[start:stop]))
            start = stop
        self.characters += sum(map(len, stretches))
        counts = [list(map(len, ids_a)), list(map(len, ids_b)), np.diff(groups_to, prepend=0), np.diff(links_to, prepend=0)]
        self.numbers = np.concatenate((self.numbers, np.stack(counts, axis=1)))
        self.lost = np.concatenate((self.lost, lost))
        self.first = np.concatenate((self.first, len(self.pairs) + links_to - np.diff(links_to, prepend=0)))
        self.pairs = np.concatenate((self.pairs, pairs))

    def _same(self, stretches: list[str], ids_a: list[list[int]], ids_b: list[list[int]]) -> bool:
        """Whether both sides give the stretches back."""
        want = "".join(stretches).encode()
        back_a = b"".join(map(self.bytes_a.__getitem__, chain.from_iterable(ids_a)))
        return back_a == want and b"".join(map(self.bytes_b.__getitem__, chain.from_iterable(ids_b))) == want

    def stretches(self, text: str) -> list[str]:
        """The text behind a space, cut in front of every space that follows a visible character."""
        spaced = " " + text
        return _CUT.split(spaced) if self.cuttable and not _WIDE.search(text) else [spaced]

    def block(self, texts: list[str]) -> tuple[list[list[int]], list[str], np.ndarray]:
        """The stretches of each text (none if it has no tokens), its groups, and its four numbers."""
        if self.characters > REMEMBERED_CHARACTERS or len(self.groups) > REMEMBERED:
            self._begin()
        cut = [self.stretches(t) if t else [] for t in texts]
        new = list(dict.fromkeys(s for own in cut for s in own if s not in self.known))
        for first in range(0, len(new), TOKENISED):
            some = new[first : first + TOKENISED]
            in_a = [e.ids for e in self.a.encode_batch_fast(some, add_special_tokens=False)]
            # this tokenizer adds the first space itself
            self._remember(some, in_a, self.b.encode([s[1:] for s in some], num_threads=1))
        places = [list(map(self.known.__getitem__, own)) for own in cut]
        for i in self._lost_texts(places):
            places[i] = []
        joined = [";".join(map(self.groups.__getitem__, own)) for own in places]
        flat, of = self._flat(places)
        sums = np.stack([np.bincount(of, self.numbers[flat, i], minlength=len(texts)) for i in range(4)], axis=1).astype(np.int64)
        return places, joined, sums

    @staticmethod
    def _flat(places: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """All stretches behind one another, and the text of each."""
        lengths = np.fromiter(map(len, places), np.int64, len(places))
        return np.fromiter(chain.from_iterable(places), np.int64, int(lengths.sum())), np.repeat(np.arange(len(places)), lengths)

    def _lost_texts(self, places: list[list[int]]) -> list[int]:
        flat, of = self._flat(places)
        return np.unique(of[self.lost[flat]]).tolist()

    def postings(self, places: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs of a block with the edges of their lists, and the lists: document in the block, times."""
        flat, of = self._flat(places)
        number = self.numbers[flat, 3]
        at = np.repeat(self.first[flat] - np.cumsum(number) + number, number) + np.arange(number.sum())
        keys = np.sort(self.pairs[at] << ROW_BITS | np.repeat(of, number))
        starts = np.flatnonzero(np.concatenate((np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1])))
        times = np.diff(starts, append=len(keys))
        keys = keys[starts]
        codes = keys >> ROW_BITS
        edges = np.flatnonzero(np.concatenate((np.ones(min(len(codes), 1), bool), codes[1:] != codes[:-1])))
        return codes[edges], np.append(edges, len(codes)), keys & (BLOCK_DOCUMENTS - 1), times


def _split(first: int, last: int) -> Iterator[tuple[int, int]]:
    """A range of rows as ranges of at most ``BLOCK_DOCUMENTS``."""
    for start in range(first, last, BLOCK_DOCUMENTS):
        yield start, min(start + BLOCK_DOCUMENTS, last)


_aligners: dict[tuple[str, str], Aligner] = {}


def _aligner(key: tuple[str, str], tokenizer_json: str, piece_model: bytes) -> Aligner:
    if key not in _aligners:
        _aligners.clear()
        _aligners[key] = Aligner(tokenizer_json, piece_model)
    return _aligners[key]


_ALIGNED = "block long, row int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pair long, occurrences long, numbers binary, rows binary, times binary"


def aligned_blocks(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """One row a document (``row`` is its place in the block), one a block and id pair, and one a block with its packed lists.

    The lists are laid behind one another by ascending pair: ``numbers`` has the documents of each pair, ``rows`` which they
    are, ``times`` how often they hold it.
    """
    with open(byte_path, encoding="utf-8") as f, open(piece_path, "rb") as g:
        vocabularies = docs.sparkSession.sparkContext.broadcast((f.read(), g.read()))  # two vocabularies, a few MB
    key = (byte_path, piece_path)
    schema = pa.schema(
        [("block", pa.int64()), ("row", pa.int32()), ("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")],
         ("groups_sha256", pa.string()), ("pair", pa.int64()), ("occurrences", pa.int64()), *[(c, pa.binary()) for c in ("numbers", "rows", "times")]]
    )

    def emit(known: dict[str, pa.Array], n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([known.get(f.name, pa.nulls(n, f.type)).cast(f.type) for f in schema], schema=schema)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(key, *vocabularies.value)
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for first, last in (x for a, b, _, _ in text_blocks(batch.column("text"), BLOCK_BYTES) for x in _split(a, b)):
                texts = batch.column("text").slice(first, last - first).to_pylist()
                ids = batch.column("doc_id").slice(first, last - first)
                places, joined, sums = aligner.block(texts)
                n = len(texts)
                yield emit(
                    {
                        "block": pa.array(np.full(n, block)), "row": pa.array(np.arange(n, dtype=np.int32)), "doc_id": ids,
                        **{c: pa.array(sums[:, i].copy()) for i, c in enumerate(("n_a", "n_b", "n_groups", "n_links"))},
                        "groups_sha256": pa.array([hashlib.sha256(g.encode()).hexdigest() if own else "" for g, own in zip(joined, places, strict=True)], pa.string()),
                    },
                    n,
                )
                codes, edges, document, times = aligner.postings(places)
                total = np.concatenate(([0], np.cumsum(times)))
                for start in range(0, len(codes), 20_000):
                    stop = min(start + 20_000, len(codes))
                    often = total[edges[start + 1 : stop + 1]] - total[edges[start:stop]]
                    yield emit({"block": pa.array(np.full(stop - start, block)), "pair": pa.array(codes[start:stop]), "occurrences": pa.array(often)}, stop - start)
                lists = {"numbers": np.diff(edges).astype("<u4"), "rows": document.astype("<u2"), "times": times.astype("<u4")}
                yield emit({"block": pa.array([block])} | {c: pa.array([x.tobytes()], pa.binary()) for c, x in lists.items()}, 1)
                block += 1

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(rows, _ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, count, and whether the count is the highest of its B id. An id of B has no more partners than A has ids."""
    counts = aligned.filter("pair is not null").groupBy("pair").agg(F.sum("occurrences").alias("count"))
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit((1 << PAIR_BITS) - 1)))
    return counts.withColumn("best", F.col("count") == F.max("count").over(of_b))


def _block_sums(block: pd.DataFrame) -> pd.DataFrame:
    """The documents of one block with the sums over their links."""
    docs = block[block["row"].notna()].sort_values("row")
    pairs = block[block["pair"].notna()].sort_values("pair")
    lists = block[block["rows"].notna()]
    number, rows, times = (np.frombuffer(b"".join(lists[c]), t) for c, t in (("numbers", "<u4"), ("rows", "<u2"), ("times", "<u4")))
    best, counted = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
    np.add.at(best, rows, times * np.repeat(pairs["best"].to_numpy(np.int64), number))
    np.add.at(counted, rows, times * np.repeat(pairs["count"].to_numpy(np.int64), number))
    return docs.assign(n_best=best, count_sum=counted)[["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]]


def align_corpus(docs: DataFrame, byte_path: str | None = None, piece_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """A row a document, and (pair, count, best) of every id pair that is linked."""
    if byte_path is None or piece_path is None:
        import public_tokenizers

        byte_path = byte_path or public_tokenizers.path("byte_bpe_50k.json")
        piece_path = piece_path or public_tokenizers.path("piece_bpe_32k.model")
    aligned = stage(aligned_blocks(docs, byte_path, piece_path), "aligned")  # read three times
    counts = stage(pair_counts(aligned), "pairs")
    met = aligned.filter("pair is not null").select("block", "pair").join(counts, "pair").withColumn("best", F.col("best").cast("long"))
    rest = aligned.filter("pair is null").drop("pair", "occurrences")
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return rest.unionByName(met, allowMissingColumns=True).groupBy("block").applyInPandas(_block_sums, schema), counts


def op13_end_dictionaries(spark, sf_dir: str) -> DataFrame:
    return align_corpus(table(spark, sf_dir, "documents"))[0]
