"""Best-fit packing of tokenised documents into sequences of fixed capacity.

Only the length of a piece matters to a packing, and there are no more lengths than
tokens in a sequence. So the plan is made from the histogram of lengths, exactly and for
all pieces at once: pieces above a third of the capacity are matched at most two to
a bin, each with the largest that fits beside it, and the smaller ones, largest first,
go to the tightest remaining gap. The plan is a short list of intervals of ranks within
a length; every piece finds its sequence by its own rank. Its size depends on the
capacity, never on the corpus.

Cases: a null text is empty, and an empty text is the end token alone; a very long text is
cut into full pieces, the first of which may be shorter; repeated rows and null ids are
packed like others; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gapless_rank, stage, table, whole_text
from .words import mix, text_blocks

CAPACITY = 1024
END = 2

#: Chunks that a worker remembers the ids of, about 60 bytes each; beyond, the half not seen for longest goes.
REMEMBERED = 2_000_000
#: Longest chunk that is remembered; it must fit two 64-bit words with its length.
LONGEST = 15
#: Bytes of text cut into chunks at once.
BLOCK_BYTES = 1 << 22

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_SIGN = np.zeros(256, bool)
_SIGN[[x for x in range(0x21, 0x7F) if not _ALNUM[x] and x != ord("'")]] = True
#: White space beyond ASCII's, and the bytes that it begins with.
_WIDE = re.compile(rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
_MAYBE_WIDE = np.zeros(256, bool)
_MAYBE_WIDE[[*range(0x1C, 0x20), 0xC2, 0xE1, 0xE2, 0xE3]] = True
#: Bytes kept of the first and of the second eight of a chunk, by its length.
_FIRST = np.array([(1 << 8 * min(n, 8)) - 1 for n in range(LONGEST + 1)], np.uint64)
_SECOND = np.array([(1 << 8 * max(n - 8, 0)) - 1 for n in range(LONGEST + 1)], np.uint64)


class ChunkEncoder:
    """Ids of texts by a byte-level tokenizer, remembered by chunk.

    The splitting rule of the vocabulary never joins a visible character to the white space
    behind it, nor an ASCII letter or digit to an ASCII sign behind it (but for the
    apostrophe), and looks ahead only inside white space. So a text may be cut at both
    places, and the chunks encoded alone. Short chunks are known by their very bytes and
    looked up by the batch; longer ones are encoded where they stand. Texts that hold
    a special token or white space beyond ASCII's are one chunk.
    """

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        special = [re.escape(str(t.content).encode()) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile(b"|".join(special)) if special else None
        self.block = 0
        self.hashes = np.zeros(0, np.uint64)  # of the known chunks, ascending; the next three go with them
        self.bytes = np.zeros((0, 2), np.uint64)
        self.spans = np.zeros((0, 2), np.int64)  # first id and their number
        self.seen = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _encode(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all chunks behind one another, and the number of each."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast([c.decode() for c in chunks], add_special_tokens=False)]
        return np.fromiter((x for own in ids for x in own), np.uint32), np.fromiter(map(len, ids), np.int64, len(ids))

    def _whole(self, data: np.ndarray, offsets: np.ndarray) -> set[int]:
        """Texts that must not be cut."""
        maybe = np.unique(np.searchsorted(offsets, np.flatnonzero(_MAYBE_WIDE[data]), "right") - 1)
        whole = {int(i) for i in maybe if _WIDE.search(data[offsets[i] : offsets[i + 1]].tobytes())}
        if self.special is not None:
            whole |= {int(np.searchsorted(offsets, m.start(), "right")) - 1 for m in self.special.finditer(data.tobytes())}
        return whole

    def _starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The first byte of each chunk."""
        space = _SPACE[data]
        first = np.zeros(len(data), bool)
        first[1:] = (space[1:] & ~space[:-1]) | (_ALNUM[data[:-1]] & _SIGN[data[1:]])
        for i in self._whole(data, offsets):
            first[offsets[i] : offsets[i + 1]] = False
        own = offsets[:-1]
        first[own[own < len(data)]] = True
        return np.flatnonzero(first)

    def _forget(self) -> None:
        if len(self.hashes) <= REMEMBERED:
            return
        kept = np.sort(np.argsort(self.seen, kind="stable")[len(self.seen) // 2 :])
        self.hashes, self.bytes, self.seen, spans = self.hashes[kept], self.bytes[kept], self.seen[kept], self.spans[kept]
        self.ids = self.ids[_ranges(spans[:, 0], spans[:, 1])]
        self.spans = np.stack([np.cumsum(spans[:, 1]) - spans[:, 1], spans[:, 1]], axis=1)

    def _known(self, hashes: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each chunk among the known ones, and whether it is that very chunk."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(len(self.hashes) - 1, 0))
        if not len(self.hashes):
            return at, np.zeros(len(hashes), bool)
        return at, (self.bytes[at, 0] == first) & (self.bytes[at, 1] == second)

    def _spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids that are needed, and (first, number) of them for each chunk."""
        length = ends - starts
        padded = np.concatenate((data, np.zeros(16, np.uint8)))
        eight = np.ndarray((len(data) + 8,), "<u8", padded, strides=(1,))  # the eight bytes at every byte
        n = np.minimum(length, LONGEST)
        first = eight[starts] & _FIRST[n]
        code = np.where(length <= LONGEST, length, 255).astype(np.uint64)  # tells a longer chunk from its beginning
        second = eight[np.minimum(starts + 8, len(data))] & _SECOND[n] | (code << np.uint64(56))
        hashes, at, back = np.unique(mix(first + mix(second)), return_index=True, return_inverse=True)
        first_of, second_of = first[at], second[at]
        # chunks under the hash of another one, which is next to impossible, are taken as long
        short = (length <= LONGEST) & (first == first_of[back]) & (second == second_of[back])
        wanted = np.zeros(len(hashes), bool)
        wanted[back[short]] = True

        place, known = self._known(hashes, first_of, second_of)
        taken = np.zeros(len(hashes), bool)  # the hash of another known chunk
        if len(self.hashes):
            taken = (self.hashes[place] == hashes) & ~known
        new = np.flatnonzero(wanted & ~known & ~taken)
        ids, number = self._encode([data[starts[i] : ends[i]].tobytes() for i in at[new]])
        to = np.searchsorted(self.hashes, hashes[new])
        self.hashes = np.insert(self.hashes, to, hashes[new])
        self.bytes = np.insert(self.bytes, to, np.stack([first_of[new], second_of[new]], axis=1), axis=0)
        self.spans = np.insert(self.spans, to, np.stack([len(self.ids) + np.cumsum(number) - number, number], axis=1), axis=0)
        self.seen = np.insert(self.seen, to, self.block)
        self.ids = np.concatenate((self.ids, ids))

        place, known = self._known(hashes, first_of, second_of)
        self.seen[place[known & wanted]] = self.block
        spans = np.zeros((len(starts), 2), np.int64)
        short &= known[back]
        spans[short] = self.spans[place[back[short]]]
        rest = np.flatnonzero(~short)
        again: dict[bytes, int] = {}
        of_rest = [again.setdefault(data[starts[i] : ends[i]].tobytes(), len(again)) for i in rest]
        more, number = self._encode(list(again))
        if len(rest):
            spans[rest] = np.stack([len(self.ids) + np.cumsum(number) - number, number], axis=1)[of_rest]
        return np.concatenate((self.ids, more)), spans

    def encode_column(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text."""
        for first, last, data, offsets in text_blocks(column, BLOCK_BYTES):
            self.block += 1
            starts = self._starts(data, offsets)
            ids, spans = self._spans(data, starts, np.append(starts[1:], len(data)))
            found = ids[_ranges(spans[:, 0], spans[:, 1])]
            before = np.concatenate(([0], np.cumsum(spans[:, 1])))[np.searchsorted(starts, offsets)]
            for i in range(last - first):
                yield found[before[i] : before[i + 1]]
            self._forget()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        return [ids.astype("<u4").tobytes() for ids in self.encode_column(pa.array(texts, pa.large_string()))]


def _ranges(first: np.ndarray, number: np.ndarray) -> np.ndarray:
    """The numbers ``first[i]``, ``first[i] + 1``, ... of every range behind one another."""
    return np.repeat(first - np.cumsum(number) + number, number) + np.arange(number.sum())


_encoders: dict[int, ChunkEncoder] = {}


def _encoder(tokenizer_json: str) -> ChunkEncoder:
    key = zlib.crc32(tokenizer_json.encode())
    if key not in _encoders:
        _encoders[key] = ChunkEncoder(tokenizer_json)
    return _encoders[key]


def piece_lengths(length: int, capacity: int) -> list[int]:
    """One piece, or full pieces after a first one that may be shorter."""
    if length <= capacity:
        return [length]
    full, rest = divmod(length, capacity)
    return [rest] * (rest > 0) + [capacity] * full


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end: int = END, keep_ids: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every piece of every text, each document closed by ``end``."""
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary, a few MB

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer.value)
        for batch in batches:
            texts = encoder.encode_column(batch.column("text"))
            for first in range(0, batch.num_rows, 256):
                took: list[tuple] = []
                for doc, own_ids in zip(batch.column("doc_id").slice(first, 256).to_pylist(), texts):  # noqa: B905
                    ids = np.append(own_ids, np.uint32(end)).astype("<u4").tobytes()
                    start = 0
                    for k, n in enumerate(piece_lengths(len(ids) // 4, capacity)):
                        own = ids[4 * start : 4 * (start + n)]
                        took.append((doc, k, start, n, zlib.crc32(own), np.frombuffer(own, "<i4") if keep_ids else None))
                        start += n
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + keep_ids]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t, _ in zip(zip(*took, strict=True), types, names, strict=False)], names=names
                )

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(rows, schema)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank + 1, first sequence, offset) for all pieces of a histogram."""
    left = dict(counts)
    done = dict.fromkeys(counts, 0)
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by room: (first sequence, sequences)
    out: list[tuple[int, int, int, int, int]] = []
    bins = 0

    def put(length: int, number: int, sequence: int, offset: int) -> None:
        out.append((length, done[length], done[length] + number, sequence, offset))
        done[length] += number
        left[length] -= number

    large = sorted((x for x in left if 3 * x > capacity), reverse=True)
    for a in large:
        for b in large:
            if left[a] and b <= min(a, capacity - a):
                number = left[a] // 2 if a == b else min(left[a], left[b])
                if number:
                    put(a, number, bins, 0)
                    put(b, number, bins, a)
                    gaps[capacity - a - b].append((bins, number))
                    bins += number
        if number := left[a]:
            put(a, number, bins, 0)
            gaps[capacity - a].append((bins, number))
            bins += number
    for x in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        room = x
        while left[x]:
            while room <= capacity and not gaps[room]:
                room += 1
            if room > capacity:
                number = -(-left[x] // (capacity // x))
                gaps[capacity].append((bins, number))
                bins += number
                room = capacity
            first, width = gaps[room].pop()
            number = min(width, left[x])
            put(x, number, first, capacity - room)
            if width > number:
                gaps[room].append((first + number, width - number))
            gaps[room - x].append((first, number))
            if room - x >= x:
                room = x
    return out


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with doc_id, piece and length) with sequence_id and offset."""
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    intervals = pieces.sparkSession.createDataFrame(
        plan(counts, capacity), "length long, __from long, __to long, __sequence long, offset long"
    )
    ranked = gapless_rank(pieces, ["length"], ["doc_id", "piece", "start"])
    return (
        ranked.join(F.broadcast(intervals), "length")  # bounded by the capacity
        .filter("rank >= __from and rank < __to")
        .withColumn("sequence_id", F.col("__sequence") + F.col("rank") - F.col("__from"))
        .drop("rank", "__from", "__to", "__sequence")
    )


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Every piece with its sequence; the pieces are written once, as they are both counted and placed."""
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("byte_bpe_50k.json")
    return pack(stage(token_pieces(docs, tokenizer_path, capacity, end, keep_ids=False), "pieces"), capacity)


def op7_large_item_matching(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
