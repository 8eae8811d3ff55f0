"""Import of an ontology: its terms become the vocabulary, missing ones turn obsolete."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from helixframe import terms
from helixframe.functions.expr import ordered_number, xref_parts
from helixframe.operators import merge
from helixframe.operators.lookups import require_terms
from helixframe.plans.importing import ImportResult
from helixframe.session import cut_lineage
from helixframe.sources.ontology import of_authority
from helixframe.tables import Tables

SCOPES = ["exact", "narrow", "broad", "related"]
REQUIRED = (
    [("comment", None, None), ("is_a", None, 1), ("part_of", None, 1)]
    + [(scope, terms.ONTOLOGY_SYNONYM_CV, None) for scope in SCOPES]
)
XREF_RULE = merge.Rule("dbxref", ("db_id", "accession", "version"), ("version",))
TERM_RULE = merge.Rule("cvterm", ("dbxref_id",), ("cv_id", "name", "is_obsolete"))


def sync_xrefs(existing: DataFrame, refs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(merged dbxref table, refs with dbxref_id).

    A reference keeps a row of its db and accession: the one with its version,
    else the lowest, whose version is then changed. ``refs`` has distinct
    db_id, accession, version.
    """
    have = existing.select("db_id", "accession", F.col("version").alias("_version"), "dbxref_id")
    exact = F.when(F.col("version") == F.col("_version"), F.col("dbxref_id"))
    hits = refs.join(have, ["db_id", "accession"], "left").groupBy("db_id", "accession", "version").agg(
        F.coalesce(F.min(exact), F.min("dbxref_id")).alias("_target")
    )
    resolved = cut_lineage(merge.with_ids(hits, XREF_RULE))
    once = resolved.where(F.col("_target").isNotNull()).groupBy("_target").agg(F.max("version").alias("version"))
    kept = merge.update_rows(existing, once, ["version"], "dbxref_id")
    added = merge.insert_rows(resolved, XREF_RULE)
    return kept.unionByName(added.select(*kept.columns)), resolved.drop("_target")


def _obsolete_name(name: Column) -> Column:
    return F.when(F.contains(F.lower(name), F.lit("obsolete")), name).otherwise(F.concat(F.lit("obsolete "), name))


def number_obsolete(rows: DataFrame, fixed: DataFrame) -> DataFrame:
    """Set ``is_obsolete`` so that (cv_id, name, is_obsolete) is unique.

    ``rows`` has cv_id, name, accession, dbxref_id and ``held`` (the number the
    row already has under this name, or null). Numbers follow the highest one
    that ``fixed`` rows hold; held numbers come first, then accessions.
    """
    last = F.coalesce("held", F.lit(2**31 - 1))
    numbered = ordered_number(
        rows, ["cv_id", "name"], [last, F.substring("accession", 1, 5)], [F.col("accession"), F.col("dbxref_id")], "_n"
    )
    top = fixed.where(F.col("is_obsolete") > 0).groupBy("cv_id", "name").agg(F.max("is_obsolete").alias("_top"))
    return numbered.join(top, ["cv_id", "name"], "left").withColumn(
        "is_obsolete", (F.coalesce("_top", F.lit(0)) + F.col("_n")).cast("int")
    ).drop("_n", "_top", "held")


def _vocabulary(t: Tables, records: DataFrame, typedefs: DataFrame, namespace: str, authority: str, result: ImportResult):
    """Merge db, cv and dbxref; returns (records with cv_id and dbxref_id, typedef rows)."""
    dbs = merge.resolve(t["db"], t.spark.range(1).select(F.lit(authority).alias("name")), "db")
    result.merges["db"] = merge.merge_resolved(t["db"], dbs, "db")
    db_id = dbs.first()["db_id"]
    spaces = records.select(F.coalesce("namespace", F.lit(namespace)).alias("name")).distinct()
    if not spaces.where(F.col("name") == "").isEmpty() or not namespace:
        raise ValueError("namespace missing in the ontology file")
    spaces = spaces.unionByName(t.spark.range(1).select(F.lit(namespace).alias("name"))).distinct()
    cvs = merge.resolve(t["cv"], spaces, "cv").select("name", "cv_id", "_target")
    result.merges["cv"] = merge.merge_resolved(t["cv"], cvs, "cv")

    known = t["cvterm"].where(F.col("is_relationshiptype") == 1).select("name")
    fresh = typedefs.distinct().join(known, "name", "left_anti").select(
        F.lit(db_id).alias("db_id"), F.col("name").alias("accession"), F.lit("").alias("version")
    )
    parts = records.withColumn("x", xref_parts(F.col("id"))).withColumn("accession", F.col("x.accession")).withColumn(
        "version", F.col("x.version")
    ).drop("x")
    refs = parts.select(F.lit(db_id).alias("db_id"), "accession", "version").unionByName(fresh).distinct()
    merged, resolved = sync_xrefs(t["dbxref"], refs)
    result.merges["dbxref"] = merged
    named = parts.join(resolved.select("accession", "version", "dbxref_id"), ["accession", "version"]).join(
        cvs.select(F.col("name").alias("_space"), "cv_id"), F.coalesce("namespace", F.lit(namespace)) == F.col("_space")
    ).drop("_space")
    cv_id = cvs.where(F.col("name") == namespace).first()["cv_id"]
    types = fresh.join(resolved, ["db_id", "accession", "version"]).select(
        "dbxref_id", F.lit(cv_id).alias("cv_id"), F.col("accession").alias("name"), F.lit(1).alias("is_relationshiptype")
    )
    return named, types, db_id


def _terms(t: Tables, named: DataFrame, types: DataFrame, db_id: int, result: ImportResult) -> DataFrame:
    """Merge terms; returns (id, cvterm_id) of the file's terms."""
    existing = t["cvterm"]
    active = named.where(~F.col("is_obsolete"))
    first = active.groupBy("cv_id", "name").agg(F.min("id").alias("_first"), F.min("dbxref_id").alias("_holder"))
    doubled = active.join(first, ["cv_id", "name"]).where(F.col("id") != F.col("_first"))
    result.reject(doubled.select("id", F.col("name").alias("item"), F.lit("name used twice in the file").alias("reason")))
    active = active.join(first, ["cv_id", "name"]).where(F.col("id") == F.col("_first")).drop("_first", "_holder")

    in_file = named.select("dbxref_id").distinct()
    own = merge.applied(result.merges["dbxref"]).where(F.col("db_id") == db_id).select("dbxref_id", "accession")
    # Terms that go: not in the file, or holding the name of a term in the file.
    missing = existing.where(F.col("is_relationshiptype") == 0).join(
        own.join(in_file, "dbxref_id", "left_anti").select("dbxref_id"), "dbxref_id", "left_semi"
    ).select("cvterm_id")
    takers = active.select("cv_id", "name")
    in_the_way = existing.where(F.col("is_obsolete") == 0).join(takers, ["cv_id", "name"], "left_semi").join(
        in_file, "dbxref_id", "left_anti"
    ).select("cvterm_id")
    gone = cut_lineage(missing.union(in_the_way).distinct())
    accessions = merge.applied(result.merges["dbxref"]).select("dbxref_id", "accession")
    dropped = existing.join(gone, "cvterm_id", "left_semi").join(accessions, "dbxref_id").select(
        "dbxref_id", "cv_id", _obsolete_name(F.col("name")).alias("name"), "definition", "accession",
        F.when((F.col("is_obsolete") > 0) & (_obsolete_name(F.col("name")) == F.col("name")), F.col("is_obsolete")).alias("held"),
    )
    stored = existing.select("dbxref_id", F.col("cv_id").alias("_cv"), F.col("name").alias("_name"), F.col("is_obsolete").alias("_obs"))
    flagged = named.where("is_obsolete").join(stored, "dbxref_id", "left").select(
        "dbxref_id", "cv_id", _obsolete_name(F.col("name")).alias("name"), "definition", "accession",
        F.when((F.col("_obs") > 0) & (F.col("_cv") == F.col("cv_id")) & (F.col("_name") == _obsolete_name(F.col("name"))),
               F.col("_obs")).alias("held"),
    )
    # Each step is written before the next reads it several times, so that no plan holds them all.
    leavers = cut_lineage(dropped.unionByName(flagged))
    leaving = leavers.select("dbxref_id").union(in_file).distinct()
    fixed = existing.join(leaving, "dbxref_id", "left_anti").select("cv_id", "name", "is_obsolete")
    retired = number_obsolete(leavers, fixed)
    batch = active.select("dbxref_id", "cv_id", "name", "definition", F.lit(0).alias("is_obsolete")).unionByName(
        retired.select("dbxref_id", "cv_id", "name", "definition", "is_obsolete")
    ).withColumn("is_relationshiptype", F.lit(0)).unionByName(
        types.select("dbxref_id", "cv_id", "name", F.lit(None).cast("string").alias("definition"),
                     F.lit(0).alias("is_obsolete"), "is_relationshiptype")
    )
    resolved = cut_lineage(merge.resolve(existing, cut_lineage(batch), TERM_RULE))
    merged = merge.merge_resolved(existing, resolved, TERM_RULE)
    # A definition in the file replaces the stored one even when it is empty.
    given = cut_lineage(resolved.join(in_file, "dbxref_id", "left_semi").select(
        "cvterm_id", F.struct("definition").alias("_given")
    ))
    joined = merged.join(given, "cvterm_id", "left").join(gone.withColumn("_gone", F.lit(True)), "cvterm_id", "left")
    replaced = F.when(F.col("_given").isNotNull(), F.col("_given.definition")).otherwise(F.col("definition"))
    changed = ~replaced.eqNullSafe(F.col("definition")) & (F.col("_action") == "keep")
    action = F.when(F.col("_gone") & (F.col("_action") == "update"), "obsolete").when(changed, "update").otherwise(F.col("_action"))
    result.merges["cvterm"] = joined.select(
        *[replaced.alias(c) if c == "definition" else F.col(c) for c in existing.columns], action.alias("_action"), "_touched"
    )
    return named.select("id", "dbxref_id").join(resolved.select("dbxref_id", "cvterm_id"), "dbxref_id").select("id", "cvterm_id")


def _scoped(merged: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows of the file's terms that the file no longer has are deleted."""
    flag = ids.select(F.col("cvterm_id").alias(column), F.lit(True).alias("_scope"))
    joined = merged.join(flag, column, "left")
    return merge.delete_unmatched(joined, F.coalesce("_scope", F.lit(False))).drop("_scope")


def _comments(t: Tables, found: DataFrame, result: ImportResult) -> None:
    type_id = t.term_id("comment")
    rule = merge.Rule("cvtermprop", ("cvterm_id", "type_id"), ("value",))
    given = found.where(F.col("comment") != "").select("cvterm_id", F.col("comment").alias("value")).withColumn("type_id", F.lit(type_id))
    own = t["cvtermprop"].where(F.col("type_id") == type_id).select("cvterm_id", F.col("value").alias("_value"), "cvtermprop_id")
    same = F.when(F.col("value") == F.col("_value"), F.col("cvtermprop_id"))
    best = given.join(own, "cvterm_id", "left").groupBy("cvterm_id", "type_id", "value").agg(
        F.coalesce(F.min(same), F.min("cvtermprop_id")).alias("_target")
    )

    def merged() -> DataFrame:
        rows = merge.merge_resolved(t["cvtermprop"], cut_lineage(merge.with_ids(best, rule)), rule)
        scope = found.select("cvterm_id", F.lit(True).alias("_scope"))
        scoped = F.coalesce("_scope", F.lit(False)) & (F.col("type_id") == type_id)
        return merge.delete_unmatched(rows.join(scope, "cvterm_id", "left"), scoped).drop("_scope")

    result.merges.later("cvtermprop", merged)


def _synonyms(t: Tables, found: DataFrame, result: ImportResult) -> None:
    types = t.of_names(t["cvterm"], "cv_id", "cv", [terms.ONTOLOGY_SYNONYM_CV]).groupBy(
        F.col("name").alias("scope")
    ).agg(F.max("cvterm_id").alias("type_id"))
    rows = found.select("id", "cvterm_id", F.posexplode("synonyms").alias("place", "s")).select("id", "cvterm_id", "place", "s.*")
    typed = rows.join(types, "scope", "left")
    result.reject(typed.where(F.col("type_id").isNull()).select(
        "id", F.col("text").alias("item"), F.lit("unknown synonym scope").alias("reason")))
    batch = typed.where(F.col("type_id").isNotNull()).groupBy("cvterm_id", F.col("text").alias("synonym")).agg(
        F.max_by("type_id", "place").alias("type_id")
    )
    rule = merge.Rule("cvtermsynonym", ("cvterm_id", "synonym"), ("type_id",))
    result.merges.later(
        "cvtermsynonym", lambda: _scoped(merge.merge(t["cvtermsynonym"], batch, rule, cut_lineage), found, "cvterm_id"))


def _cross_references(t: Tables, found: DataFrame, result: ImportResult) -> None:
    rows = found.select("id", "cvterm_id", F.explode(F.concat("alt_ids", "xrefs")).alias("text"))
    split = rows.withColumn("x", xref_parts(F.col("text")))
    result.reject(split.where(F.col("x").isNull()).select(
        "id", F.col("text").alias("item"), F.lit("malformed cross reference").alias("reason")))
    refs = split.where(F.col("x").isNotNull()).select("cvterm_id", "x.*")
    dbs = merge.applied(result.merges["db"])
    names = refs.select(F.col("db").alias("name")).distinct()
    db_found = cut_lineage(merge.resolve(dbs, names, "db"))
    before = result.merges["db"].where(F.col("_action") == "insert").select("db_id", F.lit("insert").alias("_b"))
    result.merges["db"] = merge.merge_resolved(dbs, db_found, "db").join(before, "db_id", "left").withColumn(
        "_action", F.coalesce("_b", "_action")).drop("_b")
    keyed = refs.join(db_found.select("db_id", F.col("name").alias("db")), "db")
    earlier = result.merges["dbxref"]
    merged, resolved = sync_xrefs(merge.applied(earlier), keyed.select("db_id", "accession", "version").distinct())
    acted = cut_lineage(earlier.where(F.col("_action") != "keep").select("dbxref_id", F.col("_action").alias("_b")))
    result.merges["dbxref"] = merged.join(acted, "dbxref_id", "left").withColumn(
        "_action", F.when(F.col("_b").isNotNull(), F.col("_b")).otherwise(F.col("_action"))).drop("_b")
    links = keyed.join(resolved, ["db_id", "accession", "version"]).select("cvterm_id", "dbxref_id").distinct()
    batch = links.withColumn("is_for_definition", F.lit(0))
    rule = merge.Rule("cvterm_dbxref", ("cvterm_id", "dbxref_id"))
    result.merges.later(
        "cvterm_dbxref", lambda: _scoped(merge.merge(t["cvterm_dbxref"], batch, rule, cut_lineage), found, "cvterm_id"))


def _relationships(t: Tables, found: DataFrame, authority: str, result: ImportResult) -> None:
    types = cut_lineage(merge.applied(result.merges["cvterm"]).where(F.col("is_relationshiptype") == 1).groupBy(
        F.col("name").alias("type")
    ).agg(F.max("cvterm_id").alias("type_id")))
    rows = found.select("id", F.col("cvterm_id").alias("subject_id"), F.explode("relations").alias("r")).select(
        "id", "subject_id", "r.type", "r.object")
    typed = rows.join(types, "type", "left")
    result.reject(typed.where(F.col("type_id").isNull() & (F.col("type") != "can_be")).select(
        "id", F.col("type").alias("item"), F.lit("unknown relationship type").alias("reason")))
    local = typed.where(F.col("type_id").isNotNull() & (F.substring_index("object", ":", 1) == authority))
    objects = found.select(F.col("id").alias("object"), F.col("cvterm_id").alias("object_id"))
    joined = local.join(objects, "object", "left")
    result.reject(joined.where(F.col("object_id").isNull()).select(
        "id", F.col("object").alias("item"), F.lit("related term not in the file").alias("reason")))
    batch = joined.where(F.col("object_id").isNotNull()).select("subject_id", "type_id", "object_id").distinct()
    rule = merge.Rule("cvterm_relationship", ("subject_id", "type_id", "object_id"))
    result.merges.later(
        "cvterm_relationship", lambda: _scoped(merge.merge(t["cvterm_relationship"], batch, rule, cut_lineage), found, "subject_id"))


def import_ontology(t: Tables, records: DataFrame, typedefs: DataFrame, namespace: str, authority: str) -> ImportResult:
    """Merge the file's terms of one authority into the vocabulary tables.

    Actions of terms are insert, update, obsolete or keep. Relationship types
    declared in the file can be used by its terms at once.
    """
    require_terms(t, REQUIRED)
    result = ImportResult()
    own = of_authority(records, authority)
    result.reject(own.where(xref_parts(F.col("id")).isNull()).select(
        "id", F.col("id").alias("item"), F.lit("malformed term id").alias("reason")))
    own = cut_lineage(own.where(xref_parts(F.col("id")).isNotNull()))
    if own.isEmpty():
        # Every stored term of the authority would count as gone.
        raise ValueError(f"the file has no term of '{authority}'")
    named, types, db_id = _vocabulary(t, own, typedefs, namespace, authority, result)
    named = cut_lineage(named)
    ids = cut_lineage(_terms(t, named, types, db_id, result))
    found = cut_lineage(named.drop("dbxref_id", "cv_id").join(ids, "id"))
    _comments(t, found, result)
    _synonyms(t, found, result)
    _cross_references(t, found, result)
    _relationships(t, found, authority, result)
    return result


def statistics(result: ImportResult) -> DataFrame:
    """Rows inserted, updated, marked obsolete and deleted per table."""
    return result.counts()
