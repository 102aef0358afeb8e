"""Near-duplicate documents by an inverted join over MinHash coordinates.

Every set of shingles has a signature of ``coordinates`` coordinates, each of ``folded``
minima taken together, so that a passage which many unlike documents share rarely fills a
coordinate. Documents with equal sets form a class first, and only the class's least doc_id
goes on. A pair that agrees in ``matches`` coordinates must collide in one of the first
``coordinates - matches + 1``, so only this prefix is posted under (coordinate, value).

Beside them, two bits of each of ``minima`` minima estimate the similarity of a pair
of step 1 or 2, so that hopeless pairs are never confirmed on texts.

1. Each posting list ties its members to its least member, which is linear in the
   list. Pairs that agree in ``equal`` minima or more are confirmed on the full shingle
   sets: first each document's best pair, then the others whose ends are still apart.
2. Lists whose members all lie in one component by then are skipped. The rest are tied
   once more, each to a member drawn by hash.
3. In the lists that are open even so, pairs across components meet. The members of a list's
   largest component do not meet one another, and both sides of a longer list are cut into
   blocks, each two of which are a group of their own, so no list keeps one task busy. The
   join makes a row of a pair only if two bits of ``fine`` minima agree often enough, if it collides in
   ``matches`` coordinates or more (all are counted), and in the first of these alone. What passes is confirmed.

So no link between components goes unseen, a group of near copies never meets all its pairs,
and documents around a common passage, which a list may hold by the thousand, cost some bit
counts a pair, spread over tasks, and no row. At similarity 0.75 two of 32 coordinates of three
minima agree but for a chance of 6e-7, two bits of 368 of 512 minima (416 expected, deviation 8.8)
but for one of 3e-8, and those of 1576 of 2048 (1664 expected, deviation 17.7) but for one of 4e-7.

Cases: null, empty and blank texts have no shingles and are linked with nothing; a text
of fewer words than a shingle is one shingle; rows that share a doc_id are one document;
a row without doc_id stays alone and is kept; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stage, table
from .components import components
from .words import hash_runs, hash_words, mix, split_words, text_blocks

WORDS = 5
SIMILARITY = 75  # hundredths
COORDINATES = 32
FOLDED = 3
MATCHES = 2
MINIMA = 512
EQUAL = 368
FINE = 2048
FINE_EQUAL = 1576
#: Members of a list that meet in one task; longer lists are cut.
BLOCK = 5_000

_random = np.random.default_rng(20_240_229)
_TIMES = _random.integers(0, 2**31, 4096, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_PLUS = _random.integers(0, 2**32, 4096, dtype=np.uint32)


def shingle_sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for first, last, data, offsets in text_blocks(column):
        starts, ends, place = split_words(data, offsets)
        hashes = hash_words(data, starts, ends, lower=True)
        runs = hash_runs(hashes, words)
        for i in range(last - first):
            a, b = place[i], place[i + 1]
            if b - a >= words:
                yield np.unique(runs[a : b - words + 1])
            elif b > a:
                yield hash_runs(hashes[a:b], int(b - a))
            else:
                yield runs[:0]


def minima(shingles: np.ndarray, number: int) -> np.ndarray:
    """The least value of each of ``number`` hash functions over the set."""
    out, high = np.full(number, 2**32 - 1, np.uint32), (shingles >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(high), 1024):
        part = high[i : i + 1024, None] * _TIMES[:number]
        part += _PLUS[:number]
        np.minimum(out, part.min(axis=0), out=out)
    return out


def two_bits(sig: np.ndarray) -> np.ndarray:
    """Two bits of each minimum, 32 minima to a long."""
    codes = mix(sig.astype(np.uint64)).astype(np.uint8) & 3
    return np.packbits((codes[:, None] >> np.array([1, 0], np.uint8)) & 1).view(np.int64)


def folded_coordinates(sig: np.ndarray, folded: int) -> np.ndarray:
    """One 32-bit value of each ``folded`` minima."""
    out = np.zeros(len(sig) // folded, np.uint64)
    for i in range(folded):
        out = mix(out * np.uint64(31) + sig[i::folded])
    return (out >> np.uint64(32)).astype(np.uint32)


def signatures(docs: DataFrame, words: int, coordinates: int, folded: int, number: int) -> DataFrame:
    """doc_id, n_shingles, (h1, h2) of the whole set, the coordinates of the signature and two bits of each minimum."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, h1, h2, head, brief = [], [], [], [], []
            for s in shingle_sets(batch.column("text"), words):
                n.append(len(s))
                if len(s):
                    sig = minima(s, number)
                    h1.append(int((s.sum() + np.uint64(len(s))).view(np.int64)))
                    h2.append(int(mix(s ^ np.uint64(0xD6E8FEB86659FD93)).sum().view(np.int64)))
                    head.append(folded_coordinates(sig[: coordinates * folded], folded).view(np.int32))
                    brief.append(two_bits(sig))
                else:
                    h1.append(None), h2.append(None), head.append(None), brief.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array(h1, pa.int64()),
                    pa.array(h2, pa.int64()),
                    pa.array(head, pa.list_(pa.int32())),
                    pa.array(brief, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "h1", "h2", "head", "brief"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        rows, "doc_id long, n_shingles long, h1 long, h2 long, head array<int>, brief array<long>"
    )


def _agreement(x: Column, y: Column, number: int) -> Column:
    """In how many minima the two bits agree."""
    wrong = F.lit(0)
    for i in range(number // 32):
        d = F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i)))
        wrong = wrong + F.bit_count(d.bitwiseOR(F.shiftrightunsigned(d, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    return F.lit(number) - wrong


def _agreeing(pairs: DataFrame, briefs: DataFrame, number: int, least: int) -> DataFrame:
    """Pairs (a, b, equal) that agree in ``least`` minima or more."""
    left = briefs.select(F.col("doc_id").alias("a"), F.col("brief").alias("x"))
    right = briefs.select(F.col("doc_id").alias("b"), F.col("brief").alias("y"))
    equal = _agreement(F.col("x"), F.col("y"), number)
    return pairs.join(left, "a").join(right, "b").select("a", "b", equal.alias("equal")).filter(F.col("equal") >= least)


def _fine_agreement(x: Column, y: Column, number: int) -> Column:
    """The same over long arrays, which would make too long an expression."""

    def wrong(a: Column, b: Column) -> Column:
        d = a.bitwiseXOR(b)
        return F.bit_count(d.bitwiseOR(F.shiftrightunsigned(d, 1)).bitwiseAND(F.lit(0x5555555555555555)))

    return F.lit(number) - F.aggregate(F.zip_with(x, y, wrong), F.lit(0), lambda a, b: a + b)


def _fine_bits(texts: DataFrame, words: int, number: int) -> DataFrame:
    """(doc_id, fine): two bits of each of ``number`` minima, of which the first are those of the coarse sketch."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [two_bits(minima(s, number)) for s in shingle_sets(batch.column("text"), words)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(bits, pa.list_(pa.int64()))], names=["doc_id", "fine"])

    return texts.select("doc_id", "text").mapInArrow(rows, "doc_id long, fine array<long>")


def met_in_lists(posts: DataFrame, kept: Callable[[], Column], carried: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """Pairs (a, b) across components that share a post and fulfil ``kept``, a condition of the join over x_*, y_* and post.

    ``posts``: post, doc_id, component; ``carried``: doc_id and whatever the condition looks at. A list's largest component
    meets only the rest of the list, and both sides of a list longer than ``block`` are cut into blocks.
    """
    sizes = posts.groupBy("post", "component").agg(F.count(F.lit(1)).alias("n"))
    lists = sizes.groupBy("post").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.sum("n").alias("all"), F.max("n").alias("most"))
    lists = lists.filter("all > most").select("post", "main", F.ceil(F.col("all") / block).alias("rights"), F.ceil((F.col("all") - F.col("most")) / block).alias("lefts"))
    members = posts.join(lists, "post")
    more = []
    if carried is not None:
        members, more = members.join(carried, "doc_id"), [c for c in carried.columns if c != "doc_id"]
    part = lambda n: F.pmod(F.xxhash64("doc_id"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    side = lambda s: [F.col(c).alias(f"{s}_{c}") for c in ("doc_id", "component", *more)]
    left = members.filter("component <> main").select("post", *side("x"), part("lefts").alias("i"), every("rights").alias("j"))
    right = members.select("post", *side("y"), (F.col("component") == F.col("main")).alias("of_main"), part("rights").alias("j"), every("lefts").alias("i"))
    across = (F.col("x_component") != F.col("y_component")) & (F.col("of_main") | (F.col("x_doc_id") > F.col("y_doc_id")))
    met = left.join(right, ["post", "i", "j"]).filter(across & kept())
    return met.select(F.greatest("x_doc_id", "y_doc_id").alias("a"), F.least("x_doc_id", "y_doc_id").alias("b"))


def _open_lists(shared: DataFrame, joined: DataFrame) -> DataFrame:
    """(post, doc_id, component) of the lists whose members lie in several components."""
    labelled = shared.join(joined.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "post", "doc_id", F.coalesce("component", "doc_id").alias("component")
    )
    mixed = labelled.groupBy("post").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
    return labelled.join(mixed.select("post"), "post")


def _confirmed(pairs: DataFrame, texts: DataFrame, words: int, similarity: int) -> DataFrame:
    """Pairs (a, b) whose full shingle sets are similar enough."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i, (s, t) in enumerate(
                zip(shingle_sets(batch.column("x"), words), shingle_sets(batch.column("y"), words), strict=True)
            ):
                both = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(both > 0 and 100 * both >= similarity * (len(s) + len(t) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("x"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("y"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").mapInArrow(confirm, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    words: int = WORDS,
    similarity: int = SIMILARITY,
    coordinates: int = COORDINATES,
    folded: int = FOLDED,
    matches: int = MATCHES,
    number: int = MINIMA,
    equal: int = EQUAL,
    fine: int = FINE,
    fine_equal: int = FINE_EQUAL,
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``."""
    prefix = coordinates - matches + 1
    rows = stage(signatures(docs, words, coordinates, folded, number), "signatures")
    filled = rows.filter("n_shingles > 0 and doc_id is not null")
    classes = filled.groupBy("h1", "h2", "n_shingles").agg(F.min("doc_id").alias("rep"))
    reps = stage(
        filled.join(classes.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi").select("doc_id", "head", "brief"),
        "representatives",
    )
    briefs = reps.select("doc_id", "brief")

    # 1. every list ties its members to its least member
    posted = reps.select("doc_id", F.posexplode(F.slice("head", 1, prefix)).alias("i", "v")).select(
        "doc_id", (F.shiftleft(F.col("i").cast("long"), 32) + F.col("v")).alias("post")
    )
    lists = posted.groupBy("post").agg(F.min("doc_id").alias("b"), F.max("doc_id").alias("most")).filter("b < most")
    shared = stage(posted.join(lists.select("post", "b"), "post"), "shared-lists")
    collided = shared.filter("doc_id <> b").select(F.col("doc_id").alias("a"), "b").distinct()
    stars = stage(_agreeing(collided, briefs, number, equal), "stars")

    # texts of whatever may have to be confirmed: members of shared lists
    members = shared.select("doc_id").distinct()
    texts = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(members, "doc_id", "left_semi"), "texts")

    best = Window.partitionBy("a").orderBy(F.desc("equal"), "b")
    ranked = stars.withColumn("rank", F.row_number().over(best))
    links = stage(_confirmed(ranked.filter("rank = 1"), texts, words, similarity), "links")
    joined = stage(components(links), "components")
    more = stage(_confirmed(_apart(ranked.filter("rank > 1"), joined), texts, words, similarity), "links")
    links = links.union(more)
    joined = stage(components(links), "components")

    # 2. lists that still hold several components: another centre
    opened = stage(_open_lists(shared, joined), "open-lists")
    drawn = opened.groupBy("post").agg(F.min(F.struct(F.xxhash64("doc_id", "post").alias("k"), "doc_id", "component")).alias("c"))
    ends = opened.join(drawn, "post").filter(F.col("component") != F.col("c.component"))
    tied = ends.select(F.greatest("doc_id", "c.doc_id").alias("a"), F.least("doc_id", "c.doc_id").alias("b")).distinct()
    turned = stage(_agreeing(tied.join(stars.select("a", "b"), ["a", "b"], "left_anti"), briefs, number, equal), "stars")
    links = links.union(stage(_confirmed(turned, texts, words, similarity), "links"))
    joined = stage(components(links), "components")
    opened = stage(_open_lists(shared, joined), "open-lists")

    # 3. pairs across components of the lists that are open even so
    opened = opened.select("post", "doc_id", "component")
    finer = stage(_fine_bits(texts.join(opened.select("doc_id").distinct(), "doc_id", "left_semi"), words, fine), "fine")

    def kept() -> Column:
        x, y = F.col("x_fine"), F.col("y_fine")
        same = F.zip_with("x_head", "y_head", lambda a, b: a == b)
        place = F.shiftright("post", 32) + F.shiftrightunsigned("post", 31).bitwiseAND(1)
        collisions = F.size(F.filter(same, lambda c: c))
        return (_agreement(x, y, number) >= equal) & (_fine_agreement(x, y, fine) >= fine_equal) & (collisions >= matches) & (F.array_position(same, True) - 1 == place)

    across = stage(met_in_lists(opened, kept, reps.select("doc_id", "head").join(finer, "doc_id")), "across")
    rest = across.join(stars.union(turned).select("a", "b"), ["a", "b"], "left_anti")
    last = stage(_confirmed(rest, texts, words, similarity), "links")
    joined = components(links.union(last))

    named = classes.join(joined.withColumnRenamed("node", "rep"), "rep", "left").select(
        "h1", "h2", "n_shingles", F.coalesce("component", "rep").alias("component")
    )
    return (
        rows.select("doc_id", "n_shingles", "h1", "h2")
        .join(named, ["h1", "h2", "n_shingles"], "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def _apart(pairs: DataFrame, joined: DataFrame) -> DataFrame:
    """Pairs whose ends lie in different components so far."""
    ca = joined.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    cb = joined.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    apart = F.coalesce("ca", "a") != F.coalesce("cb", "b")
    return pairs.select("a", "b").join(ca, "a", "left").join(cb, "b", "left").filter(apart).select("a", "b")


def op5_coordinate_join(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []
      WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
      ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) c ON c.x = d.doc_id
"""
