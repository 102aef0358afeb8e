"""Line deduplication over levelled sorted runs of line hashes (DataFrame functions only).

Documents come in batches of descending doc_id. A batch is reduced to one row per line
key, sorted by hash, and merge-joined with the runs written so far: a key that no run
has (the anti-join) enters with the largest doc_id that holds it, its keeper; a key that
is there already adds its count alone. The result is the batch's own run on level 0.
Whenever a level has ``fanout`` runs, they are compacted into one run of the next level.
At the end the runs give each key's document count and keeper.

Cases: a null or empty text is one empty line; short keys never count; a line repeated
inside one document counts once for it; repeated rows count as documents of their own;
a null doc_id is smaller than any other; an empty table gives no rows. Hot lines are
summed before every shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, ascii_lower, hash128, stage, table, whole_text

LEAST_ID = -(2**63)


def line_key(line: Column) -> Column:
    """The line stripped of ASCII white space, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


def _batched(docs: DataFrame, batches: int, min_chars: int) -> DataFrame:
    """(batch, h1, h2, place) for each distinct long key of each document; batch 0 has the largest ids."""
    cuts = docs.agg(
        F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 10_000).alias("cuts")
    ).first()["cuts"]
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID))
    later = sum(((place <= c).cast("int") for c in sorted(set(cuts or []))), F.lit(0))
    keys = F.transform(F.split(whole_text(), "\n", -1), line_key)
    long_keys = F.filter(keys, lambda k: F.char_length(k) >= min_chars)
    hashes = F.array_distinct(F.transform(long_keys, hash128))
    return docs.select(later.alias("batch"), place.alias("place"), F.explode(hashes).alias("h")).select(
        "batch", "h.h1", "h.h2", "place"
    )


def _sorted_run(df: DataFrame, name: str) -> DataFrame:
    return stage(df.sortWithinPartitions("h1", "h2"), name)


def _union(runs: list[DataFrame]) -> DataFrame:
    out = runs[0]
    for r in runs[1:]:
        out = out.unionByName(r)
    return out


def repeated_lines(keys: DataFrame, batches: int, min_docs: int, fanout: int = 2) -> DataFrame:
    """(h1, h2, n, keeper) of every key that at least ``min_docs`` documents hold."""
    levels: list[list[DataFrame]] = [[]]
    for b in range(batches):
        own = (
            keys.filter(F.col("batch") == b)
            .groupBy("h1", "h2")
            .agg(F.count(F.lit(1)).alias("n"), F.max("place").alias("keeper"))
        )
        runs = [r for level in levels for r in level]
        if runs:
            known = _union(runs).filter(F.col("keeper").isNotNull()).select("h1", "h2", F.lit(True).alias("known"))
            own = own.join(known, ["h1", "h2"], "left").select(
                "h1", "h2", "n", F.when(F.col("known").isNull(), F.col("keeper")).alias("keeper")
            )
        levels[0].append(_sorted_run(own, f"lines-l0-{b}"))
        i = 0
        while len(levels[i]) >= fanout and b < batches - 1:
            if i + 1 == len(levels):
                levels.append([])
            levels[i + 1].append(_sorted_run(_merged(levels[i]), f"lines-l{i + 1}-{b}"))
            levels[i] = []
            i += 1
    return _merged([r for level in levels for r in level]).filter(F.col("n") >= min_docs)


def _merged(runs: list[DataFrame]) -> DataFrame:
    return _union(runs).groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.max("keeper").alias("keeper"))


def _holders(keys: DataFrame, flagged: DataFrame, most_hot: int = 10_000) -> DataFrame:
    """(place, h1, h2) of each document that loses a key.

    A key that more than one in ``most_hot`` of all rows has is hot; there are fewer than ``most_hot`` of them, so
    they are broadcast and their rows never meet in one task. The others are joined by hash.
    """
    total = keys.agg(F.count(F.lit(1)).alias("total"))
    marked = stage(flagged.crossJoin(F.broadcast(total)).select("h1", "h2", "keeper", (F.col("n") * most_hot > F.col("total")).alias("hot")), "repeated-lines")
    hot = marked.filter("hot").select("h1", "h2", F.col("keeper").alias("hot_keeper"))
    rows = keys.select("h1", "h2", "place").join(F.broadcast(hot), ["h1", "h2"], "left")
    of_hot = rows.filter("place < hot_keeper").select("place", "h1", "h2")
    rest = rows.filter("hot_keeper is null").select("place", "h1", "h2")
    of_rest = rest.join(marked.filter("not hot").select("h1", "h2", "keeper"), ["h1", "h2"]).filter("place < keeper").select("place", "h1", "h2")
    return of_hot.unionByName(of_rest)


def dedup_lines(
    docs: DataFrame, min_chars: int = 20, min_docs: int = 3, batches: int = 4, fanout: int = 2
) -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines`` and ``n_dropped``.

    A line goes when its key has ``min_chars`` code points or more and ``min_docs``
    documents or more hold it, except in the largest doc_id that holds it.
    """
    keys = stage(_batched(docs, batches, min_chars), "line-keys", ["batch"])
    flagged = repeated_lines(keys, batches, min_docs, fanout)
    drops = _holders(keys, flagged).groupBy("place").agg(F.collect_set(F.struct("h1", "h2")).alias("__drop"))
    lines = F.split(whole_text(), "\n", -1)
    pairs = F.transform(lines, lambda x: F.struct(x.alias("line"), line_key(x).alias("key")))
    stays = F.filter(
        pairs,
        lambda p: (F.char_length(p["key"]) < min_chars) | ~F.array_contains(F.col("__drop"), hash128(p["key"])),
    )
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID))
    kept = F.when(F.col("__drop").isNull(), lines).otherwise(F.transform(stays, lambda p: p["line"]))
    return (
        docs.withColumn("__place", place)
        .join(drops.withColumnRenamed("place", "__place"), "__place", "left")
        .withColumn("__kept", kept)
        .withColumn("kept_text", F.array_join("__kept", "\n"))
        .withColumn("n_lines", F.size(lines).cast("long"))
        .withColumn("n_dropped", F.col("n_lines") - F.size("__kept"))
        .drop("__place", "__drop", "__kept")
    )


def op6_line_runs(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH lines AS (
  SELECT doc_id, i, parts[i] AS line,
         translate(trim(parts[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
repeated AS (
  SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT l.doc_id, l.i, l.line, r.k IS NOT NULL AND l.doc_id <> r.keeper AS gone
  FROM lines l LEFT JOIN repeated r ON l.k = r.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
