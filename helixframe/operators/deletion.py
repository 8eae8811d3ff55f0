"""Deleting and obsoleting rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from helixframe.schema import TABLES
from helixframe.session import cut_lineage
from helixframe.tables import Tables


def delete_missing(existing: DataFrame, present: DataFrame, key: list[str], scope: DataFrame, scope_key: str) -> DataFrame:
    """Rows of ``existing`` in scope (semi join on scope_key) that ``present`` lacks."""
    inside = existing.join(scope.select(scope_key).distinct(), scope_key, "left_semi")
    return inside.join(present.select(*key), key, "left_anti")


def mark_obsolete(
    features: DataFrame, loaded: DataFrame | None, organisms: DataFrame, present: Column | None = None
) -> DataFrame:
    """Mark features of the organisms that are not loaded as obsolete; adds ``_action``, or changes it where it is.

    ``loaded`` has organism_id and uniquename of everything in the file,
    including the names of its sequences, or of what ``present`` does not tell.
    """
    scope = organisms.select("organism_id").distinct().withColumn("_scope", F.lit(True))
    missing, joined = F.lit(True) if present is None else ~present, features
    if loaded is not None:
        names = loaded.select("organism_id", "uniquename").distinct().withColumn("_loaded", F.lit(True))
        missing, joined = missing & F.col("_loaded").isNull(), features.join(names, ["organism_id", "uniquename"], "left")
    gone = F.coalesce(F.col("_scope") & missing & ~F.col("is_obsolete"), F.lit(False))
    joined = joined.join(scope, "organism_id", "left")
    values = [F.when(gone, True).otherwise(F.col(c)).alias(c) if c == "is_obsolete" else F.col(c) for c in features.columns]
    before = F.col("_action") if "_action" in features.columns else F.lit("keep")
    values = [v for v, c in zip(values, features.columns, strict=True) if c != "_action"]
    return joined.select(*values, F.when(gone, "update").otherwise(before).alias("_action"))


class FeaturesExist(ValueError):
    """A fresh load was asked for an organism that already has features."""


def guard_fresh_load(t: Tables, organism: str, force: bool = False) -> bool:
    """True if existing features must be purged first; fails unless forced."""
    existing = t.of_names(t["feature"], "organism_id", "organism", [organism])
    if existing.isEmpty():
        return False
    if not force:
        raise FeaturesExist(f"organism '{organism}' already has features")
    return True


def feature_counts(t: Tables) -> DataFrame:
    """Existing features per organism: what a fresh load would run into."""
    counts = t["feature"].groupBy("organism_id").agg(F.count(F.lit(1)).alias("n_features"))
    return t["organism"].select("organism_id", "abbreviation").join(counts, "organism_id")


def _in_order() -> list[str]:
    """Table names, every table after the tables it references."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for column in TABLES[name].references:
            if column.parent != name:
                visit(column.parent)
        order.append(name)

    for name in TABLES:
        visit(name)
    return order


def doomed_rows(t: Tables, table: str, rows: DataFrame) -> dict[str, DataFrame]:
    """Primary keys that go when ``rows`` of ``table`` are deleted, per table reached.

    The keys of each table are worked out once and written: its children, and theirs, read them, and Spark knows how many they are.
    """
    gone = {table: cut_lineage(rows.select(TABLES[table].key).distinct())}
    for name in _in_order():
        spec = TABLES[name]
        parts = []
        for column in spec.references:
            if column.parent in gone and column.on_delete == "cascade":
                parent = gone[column.parent].select(F.col(TABLES[column.parent].key).alias(column.name))
                parts.append(t[name].select(spec.key, column.name).join(parent, column.name, "left_semi").select(spec.key))
        if parts:
            union = reduce(lambda a, b: a.union(b), parts + ([gone[name]] if name in gone else []))
            gone[name] = cut_lineage(union.distinct())
    return gone


def cascade_delete(t: Tables, table: str, rows: DataFrame) -> dict[str, DataFrame]:
    """All changed tables after deleting ``rows``: children go too, or lose the reference."""
    gone = doomed_rows(t, table, rows)
    out = {}
    for name in _in_order():
        spec = TABLES[name]
        loose = [c for c in spec.references if c.parent in gone and c.on_delete == "set null"]
        if name not in gone and not loose:
            continue
        df = t[name]
        if name in gone:
            df = df.join(gone[name], spec.key, "left_anti")
        for column in loose:
            parent = gone[column.parent].select(
                F.col(TABLES[column.parent].key).alias(column.name), F.lit(True).alias("_gone")
            )
            df = df.join(parent, column.name, "left")
            df = df.withColumn(column.name, F.when(F.col("_gone").isNull(), F.col(column.name))).drop("_gone")
        out[name] = df.select(*spec.column_names)
    return out


def cascade_actions(t: Tables, table: str, rows: DataFrame) -> dict[str, DataFrame]:
    """Changed rows of all tables after deleting ``rows``, with ``_action``: deleted, or updated to lose a reference."""
    gone = doomed_rows(t, table, rows)
    out = {}
    for name in _in_order():
        spec = TABLES[name]
        loose = [c.name for c in spec.references if c.parent in gone and c.on_delete == "set null"]
        if name not in gone and not loose:
            continue
        df = t[name].select(*spec.column_names)
        doomed = gone.get(name)
        parts = []
        if doomed is not None:
            parts.append(df.join(doomed, spec.key, "left_semi").select(*spec.column_names, F.lit("delete").alias("_action")))
            df = df.join(doomed, spec.key, "left_anti")
        if loose:
            changed = F.lit(False)
            for column in loose:
                parent = next(c.parent for c in spec.references if c.name == column)
                lost = gone[parent].select(F.col(TABLES[parent].key).alias(column), F.lit(True).alias("_lost"))
                df = df.join(lost, column, "left").withColumn(f"_lost_{column}", F.coalesce("_lost", F.lit(False))).drop("_lost")
                changed = changed | F.col(f"_lost_{column}")
            values = [F.when(~F.col(f"_lost_{c}"), F.col(c)).alias(c) if c in loose else F.col(c) for c in spec.column_names]
            parts.append(df.where(changed).select(*values, F.lit("update").alias("_action")))
        out[name] = reduce(DataFrame.unionByName, parts)
    return out


def purge_actions(t: Tables, organism: str) -> dict[str, DataFrame]:
    """Changed rows after deleting every feature of an organism."""
    return cascade_actions(t, "feature", t.of_names(t["feature"], "organism_id", "organism", [organism]))


def delete_organism(t: Tables, abbreviation: str) -> dict[str, DataFrame]:
    """All changed tables after deleting one organism."""
    return cascade_delete(t, "organism", t["organism"].where(F.col("abbreviation") == abbreviation))


def purge_features(t: Tables, organism: str) -> dict[str, DataFrame]:
    """All changed tables after deleting every feature of an organism."""
    return cascade_delete(t, "feature", t.of_names(t["feature"], "organism_id", "organism", [organism]))
