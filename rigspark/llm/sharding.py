"""Byte-balanced sharding by Karmarkar-Karp differencing.

Equal texts form one indivisible group. A group that holds more than
``1 / (shards * grain)`` of all bytes is an item of its own; the others are dealt by
hash into ``shards * grain`` units, each of which is one item. So there are never more
than ``2 * shards * grain`` items, whatever the size of the corpus, and the
differencing runs over this bounded list in one task while documents stay put.

Cases: a null text counts as empty; a null doc_id is ranked like any other value;
repeated rows each get a slot of their own; an empty table gives no rows; a group
larger than an even share fills its shard alone. Extra columns are ignored.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gapless_rank, stage, table, whole_text

#: Bytes that a row costs besides its text.
ROW_BYTES = 8


def difference(sizes: list[int], shards: int) -> list[int]:
    """Shard of each item. The two partial partitions of largest spread are combined, the
    fullest bin of one with the emptiest of the other, until a single partition is left."""
    if not sizes:
        return []
    sums: list[list[int]] = [[s] + [0] * (shards - 1) for s in sizes]
    merged: list[tuple[int, int, list[int]]] = []
    heap = [(-s[0] + s[-1], i) for i, s in enumerate(sums)]
    heapq.heapify(heap)
    last = shards - 1
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        joined = [x + y for x, y in zip(sums[a], reversed(sums[b]), strict=True)]
        order = sorted(range(shards), key=lambda i: -joined[i])
        least = joined[order[last]]
        sums.append([joined[i] - least for i in order])
        merged.append((a, b, order))
        heapq.heappush(heap, (-sums[-1][0], len(sums) - 1))
    shard = [0] * len(sizes)
    places = {len(sums) - 1: list(range(shards))}
    for node in range(len(sums) - 1, -1, -1):
        place = places.pop(node)
        if node < len(sizes):
            shard[node] = place[0]
            continue
        a, b, order = merged[node - len(sizes)]
        left, right = [0] * shards, [0] * shards
        for k, i in enumerate(order):
            left[i] = right[last - i] = place[k]
        places[a], places[b] = left, right
    return shard


def shard_documents(docs: DataFrame, shards: int = 24, grain: int = 200) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row; sizes of shards near equal.

    Slots are ranked in two levels, so that no task holds a whole shard.
    """
    text = whole_text()
    narrow = docs.select(
        "doc_id",
        (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
        F.xxhash64(text).alias("same"),
    )
    rows = stage(narrow, "sizes")  # the texts are read once
    units = shards * grain
    total = rows.agg(F.sum("size").alias("total"))
    groups = rows.groupBy("same").agg(F.sum("size").alias("bytes")).crossJoin(F.broadcast(total))
    heavy = F.col("bytes") * units > F.col("total")
    large = groups.filter(heavy).select("same", F.lit(True).alias("large"))
    unit = F.when(F.col("large"), F.col("same")).otherwise(F.pmod("same", F.lit(units)))
    items = (
        groups.withColumn("large", heavy)
        .withColumn("unit", unit)
        .groupBy("large", "unit")
        .agg(F.sum("bytes").alias("bytes"))
    )

    def differenced(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bytes", "large", "unit"], ascending=False)
        return pdf.assign(shard=difference([int(x) for x in pdf["bytes"]], shards))[["large", "unit", "shard"]]

    # at most 2 * shards * grain rows: a proven bound for the one task and the broadcasts
    placed = items.groupBy().applyInPandas(differenced, "large boolean, unit long, shard int")
    dealt = (
        rows.join(F.broadcast(large), "same", "left")
        .withColumn("large", F.coalesce("large", F.lit(False)))
        .withColumn("unit", unit)
        .join(F.broadcast(placed), ["large", "unit"])
        .select("doc_id", "size", "text_crc32", "shard")
    )
    ranked = gapless_rank(stage(dealt, "shards"), ["shard"], ["doc_id", "text_crc32", "size"])
    return ranked.select("doc_id", "size", "text_crc32", "shard", F.col("rank").alias("slot"))


def op1_karmarkar_karp(spark, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
