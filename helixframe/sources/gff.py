"""Nine-column feature files (GFF3): records, sequence names, embedded sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from helixframe.functions.expr import ordered_number, percent_decode
from helixframe.sources.fasta import with_header
from helixframe.sources.text import read_lines

SEQUENCE_MARKER = "##FASTA"
HAS_ID = r"(^|;)\s*ID=[^;,]"


def _attribute_expr() -> str:
    """``key=v1,v2;...`` as an array of (key, values); values are decoded after splitting."""
    # Most text has nothing to decode, and looking for a % is cheaper than decoding.
    decode = lambda x: (
        f"CASE WHEN contains({x}, '%') THEN coalesce(try_url_decode(replace({x}, '+', '%2B')), {x}) ELSE {x} END"
    )
    values = f"transform(split(substring(i, locate('=', i) + 1), ','), v -> {decode('v')})"
    return (
        "transform(filter(split(attrs, ';'), i -> trim(i) != ''), i -> named_struct("
        f"'key', {decode('trim(substring_index(i, chr(61), 1))')}, "
        f"'values', CASE WHEN contains(i, '=') THEN {values} ELSE cast(array() AS array<string>) END))"
    )


def _is_marker() -> Column:
    """The marker is a whole line; the text may also occur inside a record."""
    return F.startswith("value", F.lit(SEQUENCE_MARKER)) & (F.rtrim(F.translate("value", "\r\t", "  ")) == SEQUENCE_MARKER)


def annotation_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split lines at the sequence marker of each file: (before, after)."""
    marked = lines.where(_is_marker())
    marker = marked.groupBy(F.col("pos.file").alias("_file")).agg(F.min("pos").alias("_marker"))
    # One row per file goes to every task; the lines stay in their splits.
    joined = lines.join(F.broadcast(marker), lines["pos.file"] == marker["_file"], "left")
    before = joined.where(F.col("_marker").isNull() | (F.col("pos") < F.col("_marker")))
    after = joined.where(F.col("pos") > F.col("_marker"))
    return before.drop("_file", "_marker"), after.drop("_file", "_marker")


def parse_records(lines: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Feature records of annotation lines.

    Columns: the group columns, seqid, source, type, start, end, score, strand,
    phase, attributes (array of key and values), id, pos. A record without an
    ID attribute is named by its type and number within the group.
    """
    group = group or []
    cells = F.split("value", "\t")
    rows = lines.where(~F.startswith("value", F.lit("#"))).withColumn("c", cells).where(F.size("c") == 9)
    names = ["seqid", "source", "type", "start", "end", "score", "strand", "phase", "attrs"]
    flat = rows.select(*group, "pos", *[F.get("c", F.lit(i)).alias(n) for i, n in enumerate(names)])
    typed = flat.withColumn("type", percent_decode(F.col("type"))).withColumn("_has_id", F.rlike("attrs", F.lit(HAS_ID)))

    def full(df: DataFrame, ident: Column) -> DataFrame:
        return df.withColumn("attributes", F.expr(_attribute_expr())).select(
            *group, percent_decode(F.col("seqid")).alias("seqid"), percent_decode(F.col("source")).alias("source"), "type",
            F.col("start").try_cast("long").alias("start"), F.col("end").try_cast("long").alias("end"), "score", "strand",
            "phase", "attributes", "pos", ident.alias("id"),
        )

    # The raw text tells whether a record has an ID, so numbering the others
    # does not parse attributes again.
    nameless = ordered_number(
        typed.where(~F.col("_has_id")), group + ["type"], [F.col("pos.file"), F.col("pos.block")], [F.col("pos.row")], "_n",
    )
    return full(typed.where("_has_id"), first_value("ID")).unionByName(
        full(nameless, F.concat_ws("_", "type", F.col("_n").cast("string")))
    )


def malformed_lines(lines: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Annotation lines that are no record: group columns, pos, item (the line) and reason."""
    text = F.trim(F.translate("value", "\r\t", "  "))
    rows = lines.where(~F.startswith("value", F.lit("#")) & (text != "") & (F.size(F.split("value", "\t")) != 9))
    return rows.select(*(group or []), "pos", F.col("value").alias("item"), F.lit("not nine columns").alias("reason"))


def read_gff(spark: SparkSession, path: str, group: list[str] | None = None) -> DataFrame:
    """Feature records of the files below ``path``."""
    return parse_records(annotation_lines(read_lines(spark, path))[0], group)


def attribute_values(key: str, exact: bool = True) -> Column:
    """All values of an attribute (case-insensitive unless exact), in order."""
    same = (lambda a: a["key"] == key) if exact else (lambda a: F.lower(a["key"]) == key.lower())
    return F.flatten(F.transform(F.filter("attributes", same), lambda a: a["values"]))


def first_value(key: str) -> Column:
    return F.get(attribute_values(key), F.lit(0))


def sequence_names(lines: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Names declared by ``##sequence-region`` lines."""
    rows = lines.where(F.startswith("value", F.lit("##sequence-region")))
    return rows.select(*(group or []), F.get(F.split(F.trim("value"), "\\s+"), F.lit(1)).alias("name"))


def has_sequences(lines: DataFrame) -> bool:
    return not lines.where(_is_marker()).isEmpty()


def sequences_of_lines(lines: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Sequence records of lines after the marker: group columns, id, description, residues, pos.

    A record becomes one row; ``fasta.sequence_pieces`` keeps long ones in pieces.
    """
    group = group or []
    header = F.when(F.startswith("value", F.lit(">")), F.struct("pos", F.substring("value", 2, 1 << 30).alias("text")))
    body = with_header(lines, header).where(F.col("_record").isNotNull())
    piece = F.when(F.col("_head").isNull(), F.struct("pos", F.translate("value", "\r ", "").alias("bases")))
    joined = body.groupBy(*group, "_record").agg(F.array_sort(F.collect_list(piece)).alias("_pieces"))
    return joined.select(
        *group, F.substring_index("_record.text", " ", 1).alias("id"), F.col("_record.text").alias("description"),
        F.array_join(F.transform("_pieces", lambda p: p["bases"]), "").alias("residues"),
        F.col("_record.pos").alias("pos"),
    )


def embedded_sequences(lines: DataFrame, separate_file: bool = False, group: list[str] | None = None) -> DataFrame:
    """Sequences after the marker; refuses them next to a separate sequence file."""
    if separate_file and has_sequences(lines):
        raise ValueError("the feature file already holds sequences; do not give a separate sequence file")
    return sequences_of_lines(annotation_lines(lines)[1], group)
