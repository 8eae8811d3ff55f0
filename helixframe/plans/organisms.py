"""Inserting organisms with their properties, and the seed vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from helixframe import terms
from helixframe.operators import merge
from helixframe.plans.importing import ImportResult, merge_xrefs
from helixframe.session import cut_lineage
from helixframe.tables import Tables


def merge_organisms(t: Tables, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Merge organisms: (merged table, batch with organism_id and outcome).

    An organism is updated when both its name (genus, species, strain) and its
    abbreviation are known, inserted when neither is, and a conflict otherwise:
    the stored row stays, but properties still go to it.
    """
    rule = merge.Rule("organism", ("abbreviation",), ("common_name", "comment", "type_id"))
    name = ["genus", "species", "infraspecific_name"]
    by_name = merge.targets(t["organism"], batch, name, "organism_id").withColumnRenamed("_target", "_by_name")
    both = merge.targets(t["organism"], by_name, ["abbreviation"], "organism_id").withColumnRenamed("_target", "_by_abbr")
    known_name, known_abbr = F.col("_by_name").isNotNull(), F.col("_by_abbr").isNotNull()
    outcome = F.when(known_name & known_abbr, "update").when(known_name | known_abbr, "conflict").otherwise("insert")
    marked = both.withColumn("outcome", outcome).withColumn("_target", F.coalesce("_by_name", "_by_abbr"))
    resolved = merge.with_ids(marked, rule)
    merged = merge.merge_resolved(t["organism"], resolved.where(F.col("outcome") != "conflict"), rule)
    return merged, resolved.drop("_by_name", "_by_abbr", "_target")


def insert_organisms(t: Tables, batch: DataFrame) -> ImportResult:
    """Insert or update a batch of organisms.

    Columns: genus, species, abbreviation, infraspecific_name, common_name,
    comment, genome_version, taxon_id, wikidata_id; the last six may be null.
    Of rows with one abbreviation the last by ``pos`` counts as a whole; without
    that column, or in the same place, the greatest row.
    """
    result = ImportResult()
    placed = batch if "pos" in batch.columns else batch.withColumn("pos", F.lit(0))
    batch = cut_lineage(merge.last_rows(placed, ["abbreviation"], "pos"))
    named = batch.withColumn("common_name", F.coalesce(F.when(F.col("common_name") != "", F.col("common_name")), F.col("abbreviation")))
    core = named.select("genus", "species", "abbreviation", "infraspecific_name", "common_name", "comment")
    result.merges["organism"], found = merge_organisms(t, core)
    found = cut_lineage(found)
    ids = named.join(found.select("abbreviation", "organism_id", "outcome"), "abbreviation")
    conflicts = ids.where(F.col("outcome") == "conflict")
    result.reject(conflicts.select(
        "organism_id", F.col("abbreviation").alias("id"), F.concat_ws(" ", "genus", "species", "infraspecific_name").alias("item"),
        F.lit("name and abbreviation belong to different organisms").alias("reason"),
    ))
    pairs = F.explode(F.array(
        F.struct(F.lit(t.term_id("version")).alias("type_id"), F.col("genome_version").alias("value")),
        F.struct(F.lit(t.term_id("taxonId")).alias("type_id"), F.col("taxon_id").alias("value")),
    ))
    props = ids.select("organism_id", pairs.alias("p")).select("organism_id", "p.*").where(F.col("value") != "")
    result.merges["organismprop"] = merge.merge(
        t["organismprop"], merge.last_rows(props.withColumn("pos", F.lit(0)), ["organism_id", "type_id"], "pos"), "organismprop"
    )
    refs = ids.where(F.col("wikidata_id") != "").select(
        "organism_id", F.lit(terms.WIKIDATA_DB).alias("db"), F.col("wikidata_id").alias("accession"), F.lit("").alias("version")
    )
    xrefs = merge_xrefs(t, refs.select("db", "accession", "version"), result)
    links = refs.join(xrefs, ["db", "accession"]).select("organism_id", "dbxref_id").distinct()
    result.merges["organism_dbxref"] = merge.merge(t["organism_dbxref"], links, "organism_dbxref")
    return result


def seed(t: Tables, sequence_terms: bool = False) -> ImportResult:
    """Add the vocabulary the jobs rely on; running it again changes nothing."""
    result = ImportResult()
    groups = terms.SEED_TERMS + terms.SEED_EXTRA_TERMS + (terms.SEED_SEQUENCE_TERMS if sequence_terms else [])
    rows = [(db, cv, term, flag) for db, cv, names, flag in groups for term in names or [None]]
    wanted = t.spark.createDataFrame(
        rows + [(db, None, None, None) for db in terms.SEED_EXTRA_DBS],
        "db string, cv string, term string, is_relationshiptype int",
    )
    wanted = cut_lineage(wanted)
    dbs = merge.resolve(t["db"], wanted.select(F.col("db").alias("name")).distinct(), "db")
    cvs = merge.resolve(t["cv"], wanted.where("cv is not null").select(F.col("cv").alias("name")).distinct(), "cv")
    result.merges["db"] = merge.merge_resolved(t["db"], dbs, "db")
    result.merges["cv"] = merge.merge_resolved(t["cv"], cvs, "cv")
    dbs, cvs = cut_lineage(dbs), cut_lineage(cvs)
    keyed = wanted.where("term is not null").join(dbs.select("db_id", F.col("name").alias("db")), "db").join(
        cvs.select("cv_id", F.col("name").alias("cv")), "cv"
    )
    refs = keyed.select("db_id", F.col("term").alias("accession")).distinct().withColumn("version", F.lit(""))
    xrefs = cut_lineage(merge.resolve(t["dbxref"], refs, "dbxref"))
    result.merges["dbxref"] = merge.merge_resolved(t["dbxref"], xrefs, "dbxref")
    batch = keyed.join(xrefs.select("db_id", F.col("accession").alias("term"), "dbxref_id"), ["db_id", "term"])
    batch = batch.groupBy("dbxref_id").agg(*[
        F.min_by(c, F.col("cv")).alias(a) for c, a in [("cv_id", "cv_id"), ("term", "name"), ("is_relationshiptype",) * 2]
    ])
    named = cut_lineage(merge.resolve_terms(t["cvterm"], batch))
    result.merges["cvterm"] = merge.merge_terms(t["cvterm"], named)
    null_id = named.where(F.col("name") == "null").agg(F.min("cvterm_id")).first()[0]
    pub = t.spark.range(1).select(
        F.lit(terms.NULL_PUB).alias("uniquename"), F.lit(null_id).alias("type_id"), F.lit(False).alias("is_obsolete")
    )
    result.merges["pub"] = merge.merge(t["pub"], pub, "pub")
    return result
