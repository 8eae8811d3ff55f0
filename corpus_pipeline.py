"""Corpus pipeline: toxicity, line dedup, near-dedup, mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; ``run`` writes its result as Parquet below the
shared folder and reads it back as the next stage's ``docs``. Columns beyond those of ``documents`` are left out, also
where their names clash with what a stage adds.

A null or empty text is scored, has no lines to lose, is a near-copy of no other text, has size 0 and so is never taken by the mix.
Null ids and sources are kept as they are. Rows that repeat an id or a text are separate documents until near-dedup, which
keeps one row of a class. An empty table gives an empty result in each stage. Texts are processed whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from helixframe.llm import boilerplate, bpe, mixing, neardup, queries, toxicity
from helixframe.llm.common import save, table, with_defaults


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity scorer does not reject."""
    docs = with_defaults(docs)
    scorer = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return with_defaults(toxicity.score(docs, scorer).where("predicted = 0"))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without cross-site boilerplate lines; those that were nothing else are gone."""
    cleaned = boilerplate.clean(with_defaults(docs))
    emptied = (F.col("n_removed") > 0) & (F.coalesce(boilerplate.normal(F.col("text")), F.lit("")) == "")
    return with_defaults(cleaned.where(~emptied).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return neardup.one_of_each(with_defaults(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, shuffled within the shards; the one cut at its source's target keeps its first words."""
    mixed = mixing.shuffled(mixing.mix(with_defaults(docs)))
    return with_defaults(mixed.withColumn("n_chars", F.when(F.col("words") < F.col("size"), F.length("text")).otherwise(F.col("n_chars")).cast("long")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, with the digests of the round trip."""
    path, pattern = queries.vocabulary()
    encoded = bpe.encode(with_defaults(docs), path, pattern, hashes=True)
    return encoded.select(
        "doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), "ids_sha256", "decoded_sha256")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic), ("line_dedup", drop_boilerplate), ("near_dedup", drop_near_copies),
    ("mixing", mix_sources), ("bpe", encode),
]

#: The scorer, the signatures and the draw have no SQL form; tests of the operators hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), name)
    return docs
