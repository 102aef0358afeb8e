"""Ranks of large groups in two levels, so that no task sorts a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def levelled_rank(df: DataFrame, keys: list[str], bucket: Column, order: list[Column | str], into: str) -> DataFrame:
    """``into``: the rank (from 1) in each group of ``keys`` by ``order``.

    ``bucket`` never falls along ``order``. Rows are ranked inside their bucket and moved by the
    rows of the buckets before, of which only the counts meet in one task.
    """
    dealt = df.withColumn("__bucket", bucket)
    before = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(*keys, "__bucket")
        .agg(F.count(F.lit(1)).alias("__rows"))
        .select(*keys, "__bucket", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    )
    inside = Window.partitionBy(*keys, "__bucket").orderBy(*order)
    ranked = dealt.withColumn(into, F.row_number().over(inside)).join(starts, [*keys, "__bucket"])
    return ranked.withColumn(into, (F.col("__start") + F.col(into)).cast("long")).drop("__bucket", "__start")
