"""From raw documents to packed training sequences, in five stages.

Each stage takes what its predecessor kept and returns the columns of ``documents``; the
last returns the packed pieces. No SQL expresses the first and the last stage, so the
whole is tested against brute force instead.

Columns that a stage makes for itself never take the place of the table's own; extra columns
come through every stage but the last. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rigspark.llm.decontaminate import contaminated
from rigspark.llm.langid import UNKNOWN, identify, learn
from rigspark.llm.line_dedup import dedup_lines
from rigspark.llm.neardup import near_duplicates
from rigspark.llm.packing import pack_documents


def _own(docs: DataFrame, made: list[str]) -> tuple[DataFrame, list[Column]]:
    """``docs`` with the columns that a stage makes under other names, and how to take its columns back."""
    aside = {c: f"__own_{c}" for c in docs.columns if c in made}
    return docs.withColumnsRenamed(aside), [F.col(aside.get(c, c)).alias(c) for c in docs.columns]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go: those whose text is null or has no letter.

    A table without any label has no languages, and all of it goes. Rows with a null or repeated doc_id are judged like others.
    """
    apart, back = _own(docs, ["lang_pred", "score"])
    return identify(apart, learn(apart)).filter(F.col("lang_pred") != UNKNOWN).select(*back)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; the documents stay, with ``text`` and ``n_chars`` of what is left (a null text becomes empty).

    A null doc_id is smaller than any other, so it never keeps a repeated line that a numbered document holds.
    """
    apart, back = _own(docs, ["kept_text", "n_lines", "n_dropped"])
    left = dedup_lines(apart).withColumn("text", F.col("kept_text"))
    return left.withColumn("n_chars", F.char_length("text").cast("long")).select(*back)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the document of least doc_id stays.

    Rows that share a doc_id are one document and stay or go together; rows without doc_id and texts without words stay.
    """
    gone = near_duplicates(docs).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go. Rows without doc_id cannot be named by a pair, and stay."""
    leaks = contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id").distinct()
    return docs.join(leaks, "doc_id", "left_anti").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as token pieces placed in sequences; an empty text is its end token alone."""
    return pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    from rigspark.llm.common import stage

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
