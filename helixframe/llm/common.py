"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from helixframe.session import scratch_path, scratch_root

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; reading goes through Spark, so any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def save(df: DataFrame, purpose: str) -> DataFrame:
    """Write rows to the shared folder and continue from the files."""
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_root(spark: SparkSession) -> str:
    """The folder that the driver and all executors share."""
    return scratch_root(spark)


def n_words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(f"({WORD})"))), F.lit(0)).cast("long")


def bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def with_defaults(docs: DataFrame) -> DataFrame:
    """The columns of ``documents``; other columns of the input are left out."""
    return docs.select("doc_id", "text", "lang", "source", "n_chars")
