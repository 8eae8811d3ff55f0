"""Column expressions: strand, phase, cross references, quoting, ranking."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from helixframe.terms import COMPLEMENTS, NUCLEOTIDES


def strand_number(text: Column) -> Column:
    return F.when(text == "+", 1).when(text == "-", -1).cast("short")


def strand_text(number: Column) -> Column:
    return F.when(number > 0, "+").when(number < 0, "-").otherwise(".")


def phase_number(text: Column) -> Column:
    number = text.try_cast("int")
    return F.when(number.isin(0, 1, 2), number)


def phase_text(number: Column) -> Column:
    return F.coalesce(number.cast("string"), F.lit("."))


def nonblank(text: Column) -> Column:
    """Trimmed text, null when nothing is left."""
    trimmed = F.trim(text)
    return F.when(trimmed != "", trimmed)


def xref_parts(text: Column) -> Column:
    """``db:accession[:version]`` as a struct; null when it has not 2 or 3 parts."""
    parts = F.split(text, ":")
    part = lambda i: F.get(parts, F.lit(i))
    version = F.coalesce(part(2), F.lit(""))
    return F.when(
        F.size(parts).isin(2, 3),
        F.struct(part(0).alias("db"), part(1).alias("accession"), version.alias("version")),
    )


def xref_text(db: Column, accession: Column, version: Column | None = None) -> Column:
    base = F.concat(db, F.lit(":"), accession)
    if version is None:
        return base
    return F.when(version != "", F.concat(base, F.lit(":"), version)).otherwise(base)


def scalar_text(text: Column) -> Column:
    """Text after reading it as a number or truth value where it is one (``5`` reads as ``5.0``)."""
    number = text.try_cast("double")
    lowered = F.lower(text)
    return F.when(number.isNotNull(), number.cast("string")).when(
        lowered.isin("true", "false"), lowered
    ).otherwise(text)


def percent_decode(text: Column) -> Column:
    """Percent-decoding that leaves ``+`` alone; undecodable text stays as it is."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def percent_encode(text: Column, reserved: str) -> Column:
    """Percent-encode ``%`` and the given reserved characters only."""
    out = F.replace(text, F.lit("%"), F.lit("%25"))
    for char in reserved:
        out = F.replace(out, F.lit(char), F.lit(f"%{ord(char):02X}"))
    return out


def url_quote(text: Column) -> Column:
    """URL quoting of everything but letters, digits and ``_.-~/``."""
    changes = [("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")]
    return reduce(lambda col, c: F.replace(col, F.lit(c[0]), F.lit(c[1])), changes, F.url_encode(text))


def reverse_complement(residues: Column) -> Column:
    return F.reverse(F.translate(residues, NUCLEOTIDES, COMPLEMENTS))


def today() -> Column:
    return F.date_format(F.current_date(), "yyyyMMdd")


def spread_null(key: Column, own_id: Column) -> Column:
    """Join key that sends rows without a partner to many tasks instead of one."""
    return F.coalesce(key, -own_id - F.lit(1))


def sort_nulls_last(df: DataFrame, *columns: str) -> DataFrame:
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in columns])


def new_id(*columns: str | Column) -> Column:
    """Surrogate key of a new row, derived from its natural key."""
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.xxhash64(*[F.coalesce(c.cast("string"), F.lit("\x00")) for c in cols])


def ordered_number(df: DataFrame, keys: list[str], bucket: list[Column], order: list[Column], name: str) -> DataFrame:
    """1-based position of each row among the rows with the same keys.

    The order is (bucket, order). Rows are numbered within one (key, bucket)
    and shifted by the sizes of the buckets before it, so a key that holds a
    large share of the rows is spread over its buckets instead of being sorted
    in one task. Buckets must be order-preserving.
    """
    names = [f"_bucket{i}" for i in range(len(bucket))]
    for label, col in zip(names, bucket):
        df = df.withColumn(label, col)
    sizes = df.groupBy(*keys, *names).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*keys).orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0))).drop("_size")
    within = Window.partitionBy(*keys, *names).orderBy(*order)
    numbered = df.withColumn("_within", F.row_number().over(within))
    on = reduce(lambda a, b: a & b, [numbered[c].eqNullSafe(sizes[c]) for c in keys + names])
    joined = numbered.join(sizes, on, "left")
    keep = [numbered[c] for c in numbered.columns if c not in names and c != "_within"]
    return joined.select(*keep, (F.col("_within") + F.col("_before")).cast("long").alias(name))
