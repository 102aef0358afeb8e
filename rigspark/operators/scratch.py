"""Checkpoints for loops: lineage is cut in the folder that the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Numbers that a broadcast table may hold.
MOST_NUMBERS = 1 << 22


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


def cut(df: DataFrame) -> DataFrame:
    """``df`` checkpointed in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def kept(df: DataFrame) -> DataFrame:
    """``df`` written once as a compressed table in the shared folder: for wide rows that are read many times, each time in a few columns."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, width: int) -> DataFrame:
    """``df`` checkpointed, and broadcast only where its counted rows of ``width`` numbers stay below the bound."""
    kept = cut(df)
    return F.broadcast(kept) if kept.count() * width <= MOST_NUMBERS else kept
