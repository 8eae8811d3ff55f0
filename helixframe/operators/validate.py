"""Constraint checks as data-quality jobs. Each returns the violations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from helixframe.schema import AUDIT_TYPES, TABLES
from helixframe.tables import Tables


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def unique_violations(df: DataFrame, table: str) -> DataFrame:
    """Keys held by more than one row: table_name, constraint, key, n_rows. Keys with a null are free.

    Each key is counted by its own columns as they are; only repeated keys become text.
    """
    parts = []
    for key in ((TABLES[table].key,),) + TABLES[table].unique:
        whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
        counts = df.where(whole).groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")
        shown = F.concat_ws(",", *[F.col(c).cast("string") for c in key]).alias("key")
        parts.append(counts.select(F.lit(table).alias("table_name"), F.lit(",".join(key)).alias("constraint"), shown, "n_rows"))
    return _union(parts)


def reference_violations(t: Tables, df: DataFrame, table: str) -> DataFrame:
    """References without a parent row: table_name, column_name, value, n_rows."""
    return _dangling(t, {table: df}) if TABLES[table].references else _no_references(df)


def _dangling(t: Tables, frames: dict[str, DataFrame]) -> DataFrame:
    """The same for all references of several tables.

    The keys of a parent and all references to it are counted per value in one aggregation, so a value that most rows share is
    one row per task in the shuffle, the keys of a parent are exchanged once, and nothing is joined.
    """
    references: dict[str, list[tuple[str, str]]] = {}
    for name in frames:
        for column in TABLES[name].references:
            references.setdefault(column.parent, []).append((name, column.name))
    parts = []
    for parent, refs in sorted(references.items()):
        rows = [t[parent].select(F.col(TABLES[parent].key).alias("value"), F.lit(0).alias("ref"))]
        rows += [frames[n].select(F.col(c).alias("value"), F.lit(i).alias("ref")) for i, (n, c) in enumerate(refs, 1)]
        counts = _union(rows).where("value IS NOT NULL").groupBy("value").agg(
            *[F.count(F.when(F.col("ref") == i, 1)).alias(f"n{i}") for i in range(len(rows))])
        found = [F.struct(F.lit(n).alias("table_name"), F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n_rows"))
                 for i, (n, c) in enumerate(refs, 1)]
        lost = counts.where("n0 = 0").select("value", F.explode(F.array(*found)).alias("r")).where("r.n_rows > 0")
        parts.append(lost.select("r.table_name", "r.column_name", "value", "r.n_rows"))
    return _union(parts)


def _no_references(df: DataFrame) -> DataFrame:
    return df.select(F.lit("").alias("table_name"), F.lit("").alias("column_name"), F.lit(0).cast("long").alias("value"),
                     F.lit(0).cast("long").alias("n_rows")).limit(0)


def all_violations(t: Tables, names: list[str] | None = None) -> dict[str, DataFrame]:
    """The unique, reference and required violations of all tables (or the named ones)."""
    names = names or list(TABLES)
    return {
        "unique": _union([unique_violations(t[n], n) for n in names]),
        "references": _dangling(t, {n: t[n] for n in names if TABLES[n].references}),
        "required": _union([required_violations(t[n], n) for n in names]),
    }


def required_violations(df: DataFrame, table: str) -> DataFrame:
    """Required columns holding nulls, in one pass: table_name, column_name, n_rows."""
    names = [c.name for c in TABLES[table].columns if c.required]
    counts = df.agg(*[F.count(F.when(F.col(n).isNull(), 1)).alias(n) for n in names])
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(n).alias("n_rows")) for n in names]))
    return counts.select(pairs.alias("p")).select(F.lit(table).alias("table_name"), "p.*").where(F.col("n_rows") > 0)


def check_violations(df: DataFrame, table: str) -> DataFrame:
    """Rows that break the table's check; a null result passes."""
    condition = TABLES[table].check
    return df.where(~F.expr(condition)) if condition else df.limit(0)


def domain_violations(df: DataFrame, column: str = "type", allowed: tuple[str, ...] = AUDIT_TYPES) -> DataFrame:
    """Values outside the allowed ones with their counts."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_rows")).where(~F.col("value").isin(*allowed))
