"""Text lines with their place in the file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# A line's place: file, start of the split it was read in, row within the split.
# Sorting by it is file order, without numbering a file in one task.
BLOCK = ["file", "block"]
POSITION = BLOCK + ["row"]


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of text files (plain or gzip) with partition columns and ``pos``."""
    raw = spark.read.text(path)
    extra = [c for c in raw.columns if c != "value"]
    place = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return raw.select("value", *extra, place.alias("pos"))
