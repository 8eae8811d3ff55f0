"""Upserts: merge a batch of incoming rows into a table by a match key.

Every merge returns the table's columns plus ``_action`` (insert, update, keep
or delete) and ``_touched`` (the row is in the batch). Existing rows are left
joined to the batch, so a small batch is broadcast and the table is not
shuffled; a large batch becomes a sort-merge join that AQE splits on skew.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from helixframe.functions.expr import new_id, ordered_number
from helixframe.schema import TABLES, TYPES


@dataclass(frozen=True)
class Rule:
    """How rows of one table are matched and which columns a match updates."""

    table: str
    key: tuple[str, ...]
    update: tuple[str, ...] = ()
    defaults: dict[str, object] = field(default_factory=dict)


RULES: dict[str, Rule] = {
    r.table: r
    for r in [
        Rule("organismprop", ("organism_id", "type_id"), ("value",)),
        Rule("organism_dbxref", ("organism_id", "dbxref_id")),
        Rule("db", ("name",)),
        Rule("dbxref", ("db_id", "accession"), defaults={"version": ""}),
        Rule("cv", ("name",)),
        Rule("feature", ("organism_id", "uniquename"),
             ("name", "type_id", "residues", "seqlen", "md5checksum", "is_analysis", "is_obsolete")),
        Rule("featureloc", ("feature_id",), ("fmin", "fmax", "strand", "phase")),
        Rule("feature_dbxref", ("feature_id", "dbxref_id"), ("is_current",), {"is_current": True}),
        Rule("feature_cvterm", ("feature_id", "cvterm_id"), ("is_not",)),
        Rule("feature_relationship", ("subject_id", "type_id", "object_id"), ("value",)),
        Rule("synonym", ("name", "type_id"), ("synonym_sgml",)),
        Rule("feature_synonym", ("feature_id", "synonym_id"), ("is_internal", "is_current"), {"is_current": True}),
        Rule("pub", ("uniquename",),
             ("title", "volume", "volumetitle", "series_name", "issue", "pyear", "pages", "miniref", "publisher",
              "pubplace", "is_obsolete")),
        Rule("feature_pub", ("feature_id", "pub_id")),
        Rule("feature_cvtermprop", ("feature_cvterm_id", "type_id"), ("value",)),
        Rule("feature_cvterm_dbxref", ("feature_cvterm_id", "dbxref_id")),
        Rule("feature_cvterm_pub", ("feature_cvterm_id", "pub_id")),
    ]
}

_BLANK = {"bool": False, "int": 0, "string": ""}


def last_rows(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    """The whole last row of every key; of rows in the same place, the greatest."""
    others = [c for c in rows.columns if c not in key and c != order]
    picked = F.max(F.struct(F.col(order), *others)).alias("_row")
    return rows.groupBy(*key).agg(picked).select(*key, *[F.col("_row")[c].alias(c) for c in others])


def collapse(rows: DataFrame, key: list[str], order: Column | None = None) -> DataFrame:
    """One row per key: the last value that is not null of every other column."""
    others = [c for c in rows.columns if c not in key]
    if not others:
        return rows.distinct()
    if order is None:
        raise ValueError("rows that share a key need an order")
    ordered = rows.withColumn("_order", order)
    others = [c for c in others if c != "_order"]
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_order"))).alias(c) for c in others]
    return ordered.groupBy(*key).agg(*last)


def _default(rule: Rule, name: str) -> Column:
    column = next(c for c in TABLES[rule.table].columns if c.name == name)
    if name in rule.defaults:
        return F.lit(rule.defaults[name]).cast(TYPES[column.kind])
    if column.required and column.kind == "timestamp":
        return F.current_timestamp()
    if column.required and column.kind in _BLANK:
        return F.lit(_BLANK[column.kind]).cast(TYPES[column.kind])
    return F.lit(None).cast(TYPES[column.kind])


def _insert_value(rule: Rule, name: str, given: list[str]) -> Column:
    column = next(c for c in TABLES[rule.table].columns if c.name == name)
    if name not in given:
        return _default(rule, name)
    return F.coalesce(F.col(name).cast(TYPES[column.kind]), _default(rule, name))


def insert_rows(resolved: DataFrame, rule: Rule) -> DataFrame:
    """Full table rows for resolved batch rows that have no match."""
    spec = TABLES[rule.table]
    fresh = resolved.where(F.col("_target").isNull())
    return fresh.select(
        spec.key, *[_insert_value(rule, c, resolved.columns).alias(c) for c in spec.column_names[1:]],
        F.lit("insert").alias("_action"), F.lit(True).alias("_touched"),
    )


def targets(existing: DataFrame, batch: DataFrame, key: list[str], pk: str) -> DataFrame:
    """The batch with ``_target``: the lowest primary key with the same match key, or null."""
    names = {k: f"_k_{k}" for k in key}
    have = existing.select(*[F.col(k).alias(names[k]) for k in key], pk)
    same = reduce(lambda a, b: a & b, [batch[k].eqNullSafe(have[names[k]]) for k in key])
    hits = batch.select(*key).join(have, same).groupBy(*key).agg(F.min(pk).alias("_target"))
    hits = hits.select(*[F.col(k).alias(names[k]) for k in key], "_target")
    back = reduce(lambda a, b: a & b, [batch[k].eqNullSafe(hits[names[k]]) for k in key])
    return batch.join(hits, back, "left").drop(*names.values())


def update_rows(existing: DataFrame, resolved: DataFrame, update: list[str], pk: str) -> DataFrame:
    """Existing rows with the non-null values of the batch row that targets them."""
    news = resolved.where(F.col("_target").isNotNull()).select(
        F.col("_target").alias(pk), *[F.col(c).alias(f"_new_{c}") for c in update], F.lit(True).alias("_hit")
    )
    joined = existing.join(news, pk, "left")
    differs = reduce(
        lambda a, b: a | b,
        [F.col(f"_new_{c}").isNotNull() & ~F.col(f"_new_{c}").eqNullSafe(F.col(c)) for c in update],
        F.lit(False),
    )
    values = [
        F.coalesce(F.col(f"_new_{c}").cast(existing.schema[c].dataType), F.col(c)).alias(c) if c in update else F.col(c)
        for c in existing.columns
    ]
    return joined.select(
        *values,
        F.when(differs, "update").otherwise("keep").alias("_action"),
        F.coalesce("_hit", F.lit(False)).alias("_touched"),
    )


def with_ids(resolved: DataFrame, rule: Rule | str) -> DataFrame:
    """Add the primary key every batch row has after the merge."""
    rule = RULES[rule] if isinstance(rule, str) else rule
    spec = TABLES[rule.table]
    natural = rule.key if rule.table in ("cvterm", "featureprop") else spec.unique[0]
    fresh = new_id(*[_insert_value(rule, c, resolved.columns) for c in natural])
    return resolved.withColumn(spec.key, F.coalesce("_target", fresh))


def resolve(existing: DataFrame, batch: DataFrame, rule: Rule | str) -> DataFrame:
    """The batch (one row per match key) with its primary keys: matched or new."""
    rule = RULES[rule] if isinstance(rule, str) else rule
    return with_ids(targets(existing, batch, list(rule.key), TABLES[rule.table].key), rule)


def merge_resolved(existing: DataFrame, resolved: DataFrame, rule: Rule | str) -> DataFrame:
    """The table with the resolved batch inserted or updated."""
    rule = RULES[rule] if isinstance(rule, str) else rule
    update = [c for c in rule.update if c in resolved.columns]
    kept = update_rows(existing, resolved, update, TABLES[rule.table].key)
    return kept.unionByName(insert_rows(resolved, rule).select(*kept.columns))


def _as_is(df: DataFrame) -> DataFrame:
    return df


def merge(
    existing: DataFrame, batch: DataFrame, rule: Rule | str, hold: Callable[[DataFrame], DataFrame] = _as_is
) -> DataFrame:
    """Insert or update the batch (one row per match key) into the table.

    ``hold`` may write the resolved batch, which is read twice.
    """
    return merge_resolved(existing, hold(resolve(existing, batch, rule)), rule)


TERM_RULE = Rule("cvterm", ("dbxref_id",))


def resolve_terms(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Vocabulary terms (one row per cross reference): match by it, else by vocabulary and name.

    New terms that share vocabulary and name become one, under the lowest cross reference.
    """
    first = targets(existing, batch, ["dbxref_id"], "cvterm_id").withColumnRenamed("_target", "_by_xref")
    second = targets(existing, first, ["cv_id", "name"], "cvterm_id")
    found = second.withColumn("_target", F.coalesce("_by_xref", "_target")).drop("_by_xref")
    lead = found.where(F.col("_target").isNull()).groupBy("cv_id", "name").agg(F.min("dbxref_id").alias("_lead"))
    keyed = found.join(lead, ["cv_id", "name"], "left")
    return keyed.withColumn("cvterm_id", F.coalesce("_target", new_id("_lead")))


def merge_terms(existing: DataFrame, resolved: DataFrame) -> DataFrame:
    """The vocabulary with resolved terms added; existing terms are never changed."""
    hits = resolved.where(F.col("_target").isNotNull()).select("_target").distinct()
    kept = update_rows(existing, hits, [], "cvterm_id")
    fresh = resolved.where(F.col("_target").isNull() & (F.col("dbxref_id") == F.col("_lead"))).drop("_lead")
    return kept.unionByName(insert_rows(fresh, TERM_RULE).select(*kept.columns))


def merge_ranked_properties(
    existing: DataFrame, batch: DataFrame, bucket: list[str], order: list[str],
    hold: Callable[[DataFrame], DataFrame] = _as_is,
) -> DataFrame:
    """featureprop: a (feature, type, value) not there yet gets the next free rank.

    ``batch`` has feature_id, type_id, value and the position columns; the
    first position of a value decides its place. ``hold`` may write the
    values with their rows, which are read several times.
    """
    key = ["feature_id", "type_id", "value"]
    rule = Rule("featureprop", tuple(key))
    position = F.min(F.struct(*bucket, *order)).alias("_pos")
    distinct = batch.groupBy(*key).agg(position)
    found = hold(targets(existing, distinct, key, "featureprop_id"))
    kept = update_rows(existing, found, [], "featureprop_id")
    numbered = ordered_number(
        found.where(F.col("_target").isNull()), ["feature_id", "type_id"], [F.col(f"_pos.{b}") for b in bucket],
        [F.col(f"_pos.{o}") for o in order] + [F.col("value")], "_n",
    )
    top = existing.groupBy("feature_id", "type_id").agg(F.max("rank").alias("_top"))
    ranked = numbered.join(top, ["feature_id", "type_id"], "left").withColumn(
        "rank", (F.coalesce(F.col("_top") + 1, F.lit(0)) + F.col("_n") - 1).cast("int")
    )
    return kept.unionByName(insert_rows(with_ids(ranked, rule), rule).select(*kept.columns))


def find_or_insert(existing: DataFrame, batch: DataFrame, table: str) -> DataFrame:
    """Rows matching on all given columns stay; the others are inserted."""
    return merge(existing, batch.distinct(), Rule(table, tuple(batch.columns)))


def delete_unmatched(merged: DataFrame, scope: Column) -> DataFrame:
    """Mark rows in scope that the batch does not have as deleted."""
    gone = scope & ~F.col("_touched")
    return merged.withColumn("_action", F.when(gone, "delete").otherwise(F.col("_action")))


def applied(merged: DataFrame) -> DataFrame:
    """The table after the merge."""
    return merged.where(F.col("_action") != "delete").drop("_action", "_touched")


def change_counts(merges: dict[str, DataFrame]) -> DataFrame:
    """Number of inserted, updated and deleted rows per table."""
    parts = [
        m.where(F.col("_action") != "keep").groupBy(F.col("_action").alias("action"))
        .agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "action", "n_rows")
        for name, m in merges.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)
