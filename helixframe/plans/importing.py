"""What all file imports share: results, cross references, publications, commit."""

from __future__ import annotations

from collections.abc import Callable, Iterator, MutableMapping
from dataclasses import dataclass, field
from functools import cache

from pyspark.sql import Column, DataFrame, functions as F

from helixframe import terms
from helixframe.operators import merge
from helixframe.schema import TABLES
from helixframe.session import cut_lineage
from helixframe.tables import Tables, write_snapshot


class Merges(MutableMapping):
    """Merged tables by name; those given by :meth:`later` are worked out when they are first read."""

    def __init__(self):
        self._held: dict[str, DataFrame | Callable[[], DataFrame]] = {}

    def later(self, name: str, make: Callable[[], DataFrame]) -> None:
        self._held[name] = make

    def __getitem__(self, name: str) -> DataFrame:
        if not isinstance(self._held[name], DataFrame):
            self._held[name] = self._held[name]()
        return self._held[name]

    def __setitem__(self, name: str, merged: DataFrame) -> None:
        self._held[name] = merged

    def __delitem__(self, name: str) -> None:
        del self._held[name]

    def __contains__(self, name: object) -> bool:
        return name in self._held

    def __iter__(self) -> Iterator[str]:
        return iter(self._held)

    def __len__(self) -> int:
        return len(self._held)


@dataclass
class ImportResult:
    """Merged tables (with ``_action``), rejected items and other reports.

    ``features`` names the features after the merge (organism_id, uniquename, feature_id), where the import had to work them out.
    """

    merges: MutableMapping[str, DataFrame] = field(default_factory=Merges)
    rejects: DataFrame | None = None
    reports: dict[str, DataFrame] = field(default_factory=dict)
    features: DataFrame | None = None

    def reject(self, rows: DataFrame) -> None:
        self.rejects = rows if self.rejects is None else self.rejects.unionByName(rows)

    def reject_lines(self, lines: DataFrame | None) -> None:
        """Reject lines that are no records; they have no id."""
        if lines is not None:
            self.reject(lines.select("organism_id", F.lit(None).cast("string").alias("id"), "item", "reason"))

    def tables(self) -> dict[str, DataFrame]:
        return {name: merge.applied(df) for name, df in self.merges.items()}

    def counts(self) -> DataFrame:
        return merge.change_counts(self.merges)


def rejected(rows: DataFrame, item: Column | str, reason: str) -> DataFrame:
    return rows.select("organism_id", "id", F.col(item).alias("item") if isinstance(item, str) else item.alias("item"),
                       F.lit(reason).alias("reason"))


def commit(result: ImportResult, path: str, version: int) -> None:
    """Write the changed tables and publish them together, once every primary key is found to be unique."""
    tables = result.tables()
    for name, df in tables.items():
        key = TABLES[name].key
        # New ids are hashes; ids that meet are found before anything is published.
        if not df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
            raise ValueError(f"{name}: two rows share one {key}")
    write_snapshot(tables, path, version=version)


def merge_xrefs(t: Tables, refs: DataFrame, result: ImportResult) -> DataFrame:
    """Add missing dbs and dbxrefs; returns (db, accession, dbxref_id) for every reference.

    ``refs`` has db, accession, version. An existing (db, accession) matches
    whatever its version.
    """
    dbs = t["db"] if "db" not in result.merges else merge.applied(result.merges["db"])
    xrefs = t["dbxref"] if "dbxref" not in result.merges else merge.applied(result.merges["dbxref"])
    names = refs.select(F.col("db").alias("name")).distinct()
    # Keys are resolved once and written; every output joins the small result.
    found = cut_lineage(merge.resolve(dbs, names, "db"))
    db_ids = found.select("db_id", F.col("name").alias("db"))
    once = refs.groupBy("db", "accession").agg(F.min("version").alias("version"))
    resolved = cut_lineage(merge.resolve(xrefs, once.join(db_ids, "db"), "dbxref"))
    result.merges["db"] = _after(result, "db", merge.merge_resolved(dbs, found, "db"))
    result.merges["dbxref"] = _after(result, "dbxref", merge.merge_resolved(xrefs, resolved, "dbxref"))
    return resolved.select("db", "accession", "dbxref_id")


def _after(result: ImportResult, name: str, merged: DataFrame) -> DataFrame:
    """Keep the insert marks of an earlier merge of the same table."""
    if name not in result.merges:
        return merged
    key = f"{name}_id"
    earlier = result.merges[name].where(F.col("_action") == "insert").select(key, F.lit("insert").alias("_before"))
    return merged.join(earlier, key, "left").withColumn("_action", F.coalesce("_before", "_action")).drop("_before")


def later_xrefs(t: Tables, refs: DataFrame, result: ImportResult) -> Callable[[], DataFrame]:
    """:func:`merge_xrefs` once something reads its tables or calls the result."""
    aside = ImportResult()
    found = cache(lambda: merge_xrefs(t, refs, aside))
    for name in ("db", "dbxref"):
        if name in result.merges:
            aside.merges[name] = result.merges[name]
        result.merges.later(name, lambda name=name: (found(), aside.merges[name])[1])
    return found


def merge_pubs(t: Tables, names: DataFrame, result: ImportResult) -> DataFrame:
    """Add missing publications; returns (publication, pub_id)."""
    type_id = t["pub"].where(F.col("uniquename") == terms.NULL_PUB).agg(F.min("type_id")).first()[0]
    batch = names.select(F.col("publication").alias("uniquename")).distinct().withColumn("type_id", F.lit(type_id))
    batch = batch.withColumn("is_obsolete", F.lit(False))
    resolved = cut_lineage(merge.resolve(t["pub"], batch, "pub"))
    result.merges["pub"] = merge.merge_resolved(t["pub"], resolved, "pub")
    return resolved.select(F.col("uniquename").alias("publication"), "pub_id")


def in_file(merged: DataFrame, features: DataFrame) -> DataFrame:
    """Add ``_in_file``: the row's feature is in the file."""
    flag = features.select("feature_id", F.lit(True).alias("_in_file"))
    return merged.join(flag, "feature_id", "left").withColumn("_in_file", F.coalesce("_in_file", F.lit(False)))


def of_xref_terms(t: Tables, df: DataFrame, db: str) -> DataFrame:
    """Add ``_of_db``: the row's term belongs to the database."""
    xrefs = t.of_names(t["dbxref"], "db_id", "db", [db]).select("dbxref_id")
    ids = t["cvterm"].join(xrefs, "dbxref_id", "left_semi").select("cvterm_id", F.lit(True).alias("_of_db"))
    return df.join(ids, "cvterm_id", "left").withColumn("_of_db", F.coalesce("_of_db", F.lit(False)))


def existing_terms(t: Tables, refs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Terms that references point to.

    ``refs`` has distinct db and accession; returns (db, accession, cvterm_id)
    and the references without a term with a reason.
    """
    db = t["db"].groupBy(F.col("name").alias("db")).agg(F.min("db_id").alias("db_id"))
    with_db = refs.select("db", "accession").distinct().join(db, "db", "left")
    xrefs = t["dbxref"].groupBy("db_id", "accession").agg(F.min("dbxref_id").alias("dbxref_id"))
    with_xref = with_db.join(xrefs, ["db_id", "accession"], "left")
    by_xref = t["cvterm"].groupBy("dbxref_id").agg(F.min("cvterm_id").alias("cvterm_id"))
    full = with_xref.join(by_xref, "dbxref_id", "left")
    reason = (
        F.when(F.col("db_id").isNull(), "unknown database")
        .when(F.col("dbxref_id").isNull(), "unknown accession").otherwise("no term")
    )
    found = full.where(F.col("cvterm_id").isNotNull()).select("db", "accession", "cvterm_id")
    missing = full.where(F.col("cvterm_id").isNull()).select("db", "accession", reason.alias("reason"))
    return found, missing
