"""Sequence files: one record per row, or a record as pieces of fixed width."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

TYPE_KEYS = ["SO", "sequence_type"]
PIECE = 12_000  # a multiple of the line length, so pieces can be written as lines one by one


def read_fasta(spark: SparkSession, path: str, group: list[str] | None = None) -> DataFrame:
    """id, description, residues and pos of every record; a record is one row, never split, and ``pos`` is file order."""
    raw = spark.read.option("lineSep", "\n>").text(path)
    place = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    raw = raw.select("value", *(group or []), place.alias("pos"))
    text = F.regexp_replace(F.ltrim("value"), "^>", "")
    rows = raw.select(*(group or []), "pos", text.alias("text")).where(F.trim("text") != "")
    header = F.regexp_replace(F.substring_index("text", "\n", 1), "\r$", "")
    body = F.when(F.contains("text", F.lit("\n")), F.expr("substring(text, locate('\\n', text) + 1)")).otherwise("")
    return rows.select(
        *(group or []), F.split(header, "\\s+")[0].alias("id"), header.alias("description"),
        F.translate(body, "\n\r\t ", "").alias("residues"), "pos",
    )


def header_type(description: Column) -> Column:
    """Type from a ``key=value`` part of the header, null if there is none."""
    parts = F.filter(F.split(description, "\\|"), lambda p: F.contains(p, F.lit("=")))
    named = F.filter(parts, lambda p: F.trim(F.substring_index(p, "=", 1)).isin(TYPE_KEYS))
    return F.trim(F.regexp_replace(F.get(named, F.lit(0)), "^[^=]*=", ""))


def with_header(lines: DataFrame, header: Column) -> DataFrame:
    """Add ``_file``, ``_block`` and ``_record``, the last ``header`` that is not null up to each line of its file.

    Within its split it comes from a window, across splits from the last header of the splits before. Headers start
    with a place, so that the greatest of a split is its last.
    """
    block = [F.col("pos.file").alias("_file"), F.col("pos.block").alias("_block")]
    rows = lines.select("*", *block, header.alias("_head"))
    here = Window.partitionBy("_file", "_block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_own", F.last("_head", ignorenulls=True).over(here))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy("_file", "_block").agg(F.max("_head").alias("_last")).withColumn(
        "_carried", F.last("_last", ignorenulls=True).over(before)
    ).drop("_last")
    owned = rows.join(carried, ["_file", "_block"], "left")
    return owned.withColumn("_record", F.coalesce("_own", "_carried")).drop("_own", "_carried")


def _is_header() -> Column:
    return F.startswith("value", F.lit(">"))


def headers(lines: DataFrame, group: list[str] | None = None) -> DataFrame:
    """id, description and pos of the records of lines (``text.read_lines``)."""
    text = F.regexp_replace(F.substring("value", 2, 1 << 30), "\r$", "")
    rows = lines.where(_is_header()).select(*(group or []), text.alias("description"), "pos")
    return rows.select(*(group or []), F.split("description", "\\s+")[0].alias("id"), "description", "pos")


def sequence_pieces(lines: DataFrame, width: int = PIECE) -> DataFrame:
    """Sequences of lines in pieces of fixed width: pos (of the record's header), chunk_no, bases.

    A line's place in its sequence is the sum of the lengths before it: within its split by a window, plus the lengths
    that the splits before hold of the same record. So no row or task holds a sequence; a row is a line or a piece.
    Lines before the first header are left out; a record without bases has no pieces. Lines that repeat are kept.
    """
    body = with_header(lines, F.when(_is_header(), F.col("pos"))).where(F.col("_head").isNull() & F.col("_record").isNotNull())
    rows = body.select(
        "pos", "_block", F.col("_record").alias("_of"), F.translate("value", "\r\t ", "").alias("bases")
    ).withColumn("_n", F.length("bases").cast("long")).where("_n > 0")
    sizes = rows.groupBy("_of", "_block").agg(F.sum("_n").alias("_n"))
    before = Window.partitionBy("_of").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_of", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_of", "_block").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_within", F.coalesce(F.sum("_n").over(within), F.lit(0))).join(sizes, ["_of", "_block"])
    start = F.col("_within") + F.col("_before")
    room = (F.lit(width) - start % width).cast("int")  # bases that the piece at the line's start still takes
    rest = F.substring("bases", room + 1, F.length("bases"))
    parts = F.concat(
        F.array(F.substring("bases", F.lit(1), room)), F.regexp_extract_all(rest, F.lit(f"(?s).{{1,{width}}}"), F.lit(0)))
    cut = placed.select("_of", start.alias("_start"), F.posexplode(parts).alias("_i", "part"))
    chunk = (F.expr(f"_start div {width}") + F.col("_i")).cast("int")
    found = cut.groupBy("_of", chunk.alias("chunk_no")).agg(F.collect_list(F.struct("_start", "_i", "part")).alias("p"))
    bases = F.array_join(F.transform(F.array_sort("p"), lambda x: x["part"]), "")
    return found.select(F.col("_of").alias("pos"), "chunk_no", bases.alias("bases"))


def with_lengths(records: DataFrame, pieces: DataFrame) -> DataFrame:
    """Add ``seqlen`` to records, and null ``residues``: the bases stay in the pieces."""
    lengths = pieces.groupBy("pos").agg(F.sum(F.length("bases")).cast("long").alias("seqlen"))
    return records.join(lengths, "pos", "left").withColumns(
        {"seqlen": F.coalesce("seqlen", F.lit(0)).cast("long"), "residues": F.lit(None).cast("string")})
