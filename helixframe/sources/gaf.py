"""Gene-association files (GAF 1.0 and 2.x)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from helixframe.sources.text import read_lines
from helixframe.terms import GAF_COLUMNS

LISTS = ["Qualifier", "DB:Reference", "With", "Synonym"]


def column_name(name: str) -> str:
    """Column name used in DataFrames (no colon)."""
    return name.replace(":", "_")


def parse_gaf(lines: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Records with list columns split on pipes; for lines that are none see :func:`malformed_lines`."""
    cells = F.split(F.regexp_replace("value", "\r$", ""), "\t")
    rows = lines.where(~F.startswith("value", F.lit("!"))).withColumn("_c", cells).where(F.size("_c") >= len(GAF_COLUMNS))

    def cell(i: int, name: str) -> Column:
        text = F.get("_c", F.lit(i))
        return (F.split(text, "\\|") if name in LISTS else text).alias(column_name(name))

    return rows.select(*(group or []), "pos", *[cell(i, n) for i, n in enumerate(GAF_COLUMNS)])


def malformed_lines(lines: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Lines with too few columns: group columns, pos, item (the line) and reason."""
    text = F.trim(F.translate("value", "\r\t", "  "))
    short = F.size(F.split("value", "\t")) < len(GAF_COLUMNS)
    rows = lines.where(~F.startswith("value", F.lit("!")) & (text != "") & short)
    return rows.select(*(group or []), "pos", F.col("value").alias("item"), F.lit("too few columns").alias("reason"))


def read_gaf(spark: SparkSession, path: str, group: list[str] | None = None) -> DataFrame:
    return parse_gaf(read_lines(spark, path), group)
