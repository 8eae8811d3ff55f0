"""Cross-site boilerplate lines: distinct sites per line by HyperLogLog, exact near the threshold.

A line is compared in lower case with its white space reduced to single spaces; lines without a word are never touched.
Per line a HyperLogLog sketch of the sites (``source``) is merged by aggregation. Lines whose estimate is far below the
threshold are done, lines far above are boilerplate, and for those within ``band`` of it the distinct sites are counted
exactly. A boilerplate line is removed from every document but the one of smallest id that holds it, so its text stays
in the corpus once.

Null texts stay null and empty ones empty; a null source is a site of its own. Rows that repeat both id and text are one
document in two rows and are treated alike. A null id orders after all others. An empty table gives an empty result.
Other columns are kept by ``clean``; ``n_lines`` and ``n_removed`` replace columns of that name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from helixframe.llm.common import SPACE, save

MIN_SITES = 10
LG_CONFIG = 12
# Six standard errors of a sketch with 4,096 registers.
BAND = 0.10


def normal(line: Column) -> Column:
    """The form in which lines are compared."""
    return F.btrim(F.regexp_replace(F.lower(line), SPACE, " "), F.lit(" "))


def _line_keys(text: Column) -> Column:
    """128 bits for each line of a text; null for a line without a word. Each line is normalised once."""
    key = lambda x: F.when(x != "", F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b")))
    return F.transform(F.transform(F.split(text, "\n"), normal), key)


def _keyed(docs: DataFrame) -> DataFrame:
    id_order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"))
    return docs.withColumn("_doc", F.struct(id_order.alias("order"), F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b")))


def boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, band: float = BAND) -> DataFrame:
    """(line, first): lines on at least ``min_sites`` sites and the document that keeps each."""
    lines = _keyed(docs.select("doc_id", "source", "text")).select(
        "_doc", F.coalesce(F.concat(F.lit("="), "source"), F.lit("none")).alias("site"),
        F.explode(F.array_distinct(_line_keys(F.col("text")))).alias("line"),
    ).where(F.col("line").isNotNull())
    spread = lines.groupBy("line").agg(
        F.hll_sketch_agg("site", F.lit(LG_CONFIG)).alias("sketch"), F.min("_doc").alias("first"),
    ).select("line", "first", F.hll_sketch_estimate("sketch").alias("estimate"))
    spread = save(spread.where(F.col("estimate") >= min_sites * (1 - band)), "spread")
    high = spread.where(F.col("estimate") > min_sites * (1 + band))
    near = spread.where(F.col("estimate") <= min_sites * (1 + band))
    if near.isEmpty():
        return high.select("line", "first")
    exact = (
        lines.join(near.select("line"), "line", "left_semi").groupBy("line").agg(F.count_distinct("site").alias("sites"))
        .where(F.col("sites") >= min_sites)
    )
    return high.select("line", "first").unionByName(near.join(exact, "line", "left_semi").select("line", "first"))


def clean(docs: DataFrame, min_sites: int = MIN_SITES, band: float = BAND) -> DataFrame:
    """The documents without boilerplate lines, with ``n_lines`` and ``n_removed``."""
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed", "_doc")]
    found = boilerplate(docs, min_sites, band)
    held = _keyed(docs.select("doc_id", "text")).select(
        "_doc", F.explode(F.array_distinct(_line_keys(F.col("text")))).alias("line"),
    ).where(F.col("line").isNotNull())
    drop = (
        held.join(found, "line").where(F.col("_doc") != F.col("first"))
        .groupBy("_doc").agg(F.collect_set("line").alias("_drop"))  # at most the lines of one document
    )
    parts = F.split("text", "\n")
    joined = _keyed(docs.select(*kept)).join(drop, "_doc", "left")
    gone = F.transform(_line_keys(F.col("text")), lambda k: F.coalesce(F.array_contains("_drop", k), F.lit(False)))
    marked = F.filter(F.arrays_zip(parts.alias("line"), gone.alias("gone")), lambda x: ~x["gone"])
    stay = F.transform(marked, lambda x: x["line"])
    return joined.select(
        *[F.when(F.col("_drop").isNull(), F.col("text")).otherwise(F.array_join(stay, "\n")).alias(c) if c == "text" else F.col(c) for c in kept],
        F.when(F.col("text").isNull(), 0).otherwise(F.size(parts)).cast("long").alias("n_lines"),
        F.when(F.col("_drop").isNull(), 0).otherwise(F.size(F.filter(gone, lambda x: x))).cast("long").alias("n_removed"),
    )
