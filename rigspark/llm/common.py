"""Helpers shared by the operators: shared scratch tables and the word rule."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: ASCII white space, the only characters that separate words.
SPACE = " \t\n\x0b\x0c\r"


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Only a local session, which has one machine, may do without the setting."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not named and not (context.master or "").startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    named = named or tempfile.mkdtemp(prefix="spark-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named.rstrip("/")


def stage(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table, which cuts its lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z alone. A text of one-byte characters takes the fast way to the same result."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower())
    )


def hash128(value: Column) -> Column:
    """A 128-bit identity of a value as a struct of two longs under different seeds."""
    return F.struct(F.xxhash64(value).alias("h1"), F.xxhash64(F.lit(17), value).alias("h2"))


def gapless_rank(df: DataFrame, keys: list[str], order: list[str], rows: int = 20_000) -> DataFrame:
    """``df`` with ``rank``, gapless from 0 in each group of ``keys``.

    Ranks come in two levels: rows are dealt into buckets of about ``rows`` by a hash of
    ``order``, ranked inside, and moved by the rows of the buckets before. So no task
    holds a whole group, and only the counts of buckets meet in one.
    """
    total = df.agg(F.count(F.lit(1)).alias("__n"))
    dealt = (
        df.crossJoin(F.broadcast(total))  # one row
        .withColumn("__bucket", F.pmod(F.xxhash64(*order), F.ceil(F.col("__n") / rows)))
        .drop("__n")
    )
    inside = Window.partitionBy(*keys, "__bucket").orderBy(*order)
    before = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(*keys, "__bucket")
        .agg(F.count(F.lit(1)).alias("__rows"))
        .select(*keys, "__bucket", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    )
    return (
        dealt.withColumn("__rank", F.row_number().over(inside))
        .join(starts, [*keys, "__bucket"])
        .withColumn("rank", (F.col("__start") + F.col("__rank") - 1).cast("long"))
        .drop("__bucket", "__rank", "__start")
    )
