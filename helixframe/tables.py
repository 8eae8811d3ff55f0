"""Access to a set of annotation tables."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from helixframe.schema import TABLES
from helixframe.session import scratch_path

MANIFEST = "_manifest"
# Names of used terms are broadcast up to this many terms and bytes.
MOST_TERMS, MOST_BYTES = 100_000, 16 << 20


class Tables:
    """Named tables, each resolved to a DataFrame on first use."""

    def __init__(self, spark: SparkSession, resolve: Callable[[str], DataFrame], names: list[str] | None = None):
        self.spark = spark
        self._resolve = resolve
        self._names = names
        self._cache: dict[str, DataFrame] = {}
        self._ids: dict[tuple, list[int] | None] = {}
        self._names_of: dict[tuple, tuple[DataFrame, bool]] = {}

    @classmethod
    def of(cls, spark: SparkSession, frames: Mapping[str, DataFrame]) -> Tables:
        """Tables given as DataFrames."""
        return cls(spark, lambda name: frames[name], list(frames))

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Tables:
        """Tables of the snapshot last published below ``path``."""
        manifest = spark.read.json(f"{path}/{MANIFEST}").orderBy(F.desc("version")).first()
        where = json.loads(manifest["paths"])
        return cls(spark, lambda name: spark.read.schema(TABLES[name].struct).parquet(where[name]), list(where))

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            if self._names is not None and name not in self._names and name in TABLES:
                self._cache[name] = self.spark.createDataFrame([], TABLES[name].struct)
            else:
                self._cache[name] = self._resolve(name)
        return self._cache[name]

    def with_tables(self, frames: Mapping[str, DataFrame]) -> Tables:
        """The same set with some tables replaced."""
        names = None if self._names is None else sorted(set(self._names) | set(frames))
        return Tables(self.spark, lambda name: frames[name] if name in frames else self[name], names)

    def scan(self, name: str, /, **equals) -> DataFrame:
        """Rows of a table whose columns equal the given values (None matches null)."""
        df = self[name]
        for column, value in equals.items():
            df = df.where(F.col(column).isNull() if value is None else F.col(column) == F.lit(value))
        return df

    # -- vocabulary ids ---------------------------------------------------

    def ids(self, table: str, condition_key: tuple, rows: DataFrame) -> list[int]:
        """Ids of ``rows``: those of names the caller lists, at most one per name and vocabulary."""
        key = (table, *condition_key)
        if key not in self._ids:
            self._ids[key] = sorted(r[0] for r in rows.select(f"{table}_id").collect())
        return self._ids[key]

    def _restrict(self, df: DataFrame, column: str, table: str, condition_key: tuple, rows: DataFrame) -> DataFrame:
        ids = self.ids(table, condition_key, rows)
        return df.where(F.col(column).isin(ids)) if ids else df.where(F.lit(False))

    def of_terms(self, df: DataFrame, column: str, names: list[str], cv: str | None = None) -> DataFrame:
        """Keep rows whose ``column`` is a term with one of the names.

        The ids become a literal predicate that reaches the Parquet scan.
        Without ``cv`` the term may come from any vocabulary.
        """
        terms = self["cvterm"].where(F.col("name").isin(names))
        if cv is not None:
            terms = self.of_names(terms, "cv_id", "cv", [cv])
        return self._restrict(df, column, "cvterm", ("terms", tuple(names), cv), terms)

    def of_names(self, df: DataFrame, column: str, table: str, names: list[str]) -> DataFrame:
        """Keep rows whose ``column`` references a db, cv or organism by name."""
        label = "abbreviation" if table == "organism" else "uniquename" if table == "pub" else "name"
        rows = self[table].where(F.col(label).isin(names))
        return self._restrict(df, column, table, ("names", tuple(names)), rows)

    def term_names(self, table: str, name: str, column: str = "type_id") -> DataFrame:
        """(``column``, ``name``): the names of the terms that a table has in a column.

        Types are few, whatever the size of the vocabulary, and skewed. The
        used ones are found once, from that column alone, and broadcast if
        their number and bytes are within bounds; beyond, Spark chooses.
        """
        key = (table, column)
        if key not in self._names_of:
            used = self[table].select(F.col(column).alias("_id")).distinct()
            terms = self["cvterm"].select(F.col("cvterm_id").alias("_id"), F.col("name").alias("_name")).join(used, "_id", "left_semi")
            path = scratch_path(self.spark, "term_names")
            terms.write.parquet(path)
            held = self.spark.read.schema(terms.schema).parquet(path)
            n, size = held.agg(F.count(F.lit(1)), F.sum(F.octet_length("_name") + 8)).first()
            self._names_of[key] = held, n <= MOST_TERMS and (size or 0) <= MOST_BYTES
        held, small = self._names_of[key]
        out = held.select(F.col("_id").alias(column), F.col("_name").alias(name))
        return F.broadcast(out) if small else out

    def term_id(self, name: str, cv: str | None = None) -> int:
        """Id of a required term; the lowest one if several vocabularies have it."""
        terms = self["cvterm"].where(F.col("name") == name)
        if cv is not None:
            terms = self.of_names(terms, "cv_id", "cv", [cv])
        key = ("cvterm", "term_id", name, cv)
        if key not in self._ids:
            self._ids[key] = [terms.agg(F.min("cvterm_id")).first()[0]]
        found = self._ids[key][0]
        if found is None:
            raise LookupError(f"term '{name}'" + (f" of vocabulary '{cv}'" if cv else "") + " is not in the tables")
        return found

    def name_id(self, table: str, name: str) -> int:
        """Id of a required db, cv, organism or pub by name."""
        label = {"organism": "abbreviation", "pub": "uniquename"}.get(table, "name")
        key = (table, "name_id", name)
        if key not in self._ids:
            row = self[table].where(F.col(label) == name).agg(F.min(f"{table}_id")).first()
            self._ids[key] = [row[0]]
        found = self._ids[key][0]
        if found is None:
            raise LookupError(f"{table} '{name}' is not in the tables")
        return found


def published(spark: SparkSession, path: str):
    """The newest manifest row, or None where nothing is published."""
    try:
        return spark.read.schema("version int, paths string").json(f"{path}/{MANIFEST}").orderBy(F.desc("version")).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def write_snapshot(
    tables: Mapping[str, DataFrame], path: str, previous: Tables | None = None, version: int = 1,
    partition_by: Mapping[str, list[str]] | None = None,
) -> None:
    """Write tables as Parquet folders, then publish them with one manifest row.

    Readers follow the manifest, so a job that dies half way changes nothing.
    Tables not given keep the folder of the last version before. A version that
    is already published is refused, and so is one that is not the newest.
    """
    spark = next(iter(tables.values())).sparkSession
    paths: dict[str, str] = {}
    last = published(spark, path)
    if last is not None:
        if last["version"] >= version:
            raise ValueError(f"version {last['version']} is published; {version} is too late")
        paths.update(json.loads(last["paths"]))
    for name, df in tables.items():
        target = f"{path}/v{version}/{name}"
        struct = TABLES[name].struct
        writer = df.select([F.col(c.name).cast(c.dataType).alias(c.name) for c in struct.fields]).write
        columns = (partition_by or {}).get(name)
        if columns:
            writer = writer.partitionBy(*columns)
        writer.mode("overwrite").parquet(target)
        paths[name] = target
    now = published(spark, path)
    if (now and now["version"]) != (last and last["version"]):
        raise ValueError(f"another job published version {now['version']} meanwhile")
    row = spark.createDataFrame([(version, json.dumps(paths))], "version int, paths string")
    row.coalesce(1).write.mode("append").json(f"{path}/{MANIFEST}")


def snapshot_counts(tables: Tables, names: list[str]) -> DataFrame:
    """Row count per table."""
    parts = [tables[n].agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
             for n in names]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def copy_snapshot(tables: Tables, names: list[str]) -> Tables:
    """Write the named tables to the shared folder and read them back."""
    path = scratch_path(tables.spark, "snapshot")
    write_snapshot({n: tables[n] for n in names}, path)
    return Tables.read(tables.spark, path)
