"""Lookups: for every feature, annotation or term at once, not one id at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from helixframe import terms
from helixframe.session import cut_lineage
from helixframe.tables import Tables


def relationships_by_type(t: Tables, types: list[str]) -> DataFrame:
    return t.of_terms(t["feature_relationship"], "type_id", types)


def properties_by_type(t: Tables, types: list[str]) -> DataFrame:
    return t.of_terms(t["featureprop"], "type_id", types)


def synonyms_by_type(t: Tables, types: list[str]) -> DataFrame:
    """feature_synonym rows whose synonym has one of the types."""
    wanted = t.of_terms(t["synonym"], "type_id", types).select("synonym_id")
    return t["feature_synonym"].join(wanted, "synonym_id", "left_semi")


def terms_of_db(t: Tables, db: str) -> DataFrame:
    """cvterm_id, name, cv_id, accession of the terms of one ontology database."""
    xrefs = t.of_names(t["dbxref"], "db_id", "db", [db]).select("dbxref_id", "accession")
    return t["cvterm"].select("cvterm_id", "name", "cv_id", "dbxref_id").join(xrefs, "dbxref_id").withColumn("db", F.lit(db))


def annotations_by_ontology(t: Tables, db: str) -> DataFrame:
    """feature_cvterm rows whose term belongs to the database."""
    return t["feature_cvterm"].join(terms_of_db(t, db).select("cvterm_id"), "cvterm_id", "left_semi")


def annotations_by_ontology_and_organism(t: Tables, db: str, organism: str | None = None) -> DataFrame:
    """The same with organism_id, for one organism or for all."""
    features = t["feature"].select("feature_id", "organism_id")
    if organism:
        features = t.of_names(features, "organism_id", "organism", [organism])
    return annotations_by_ontology(t, db).join(features, "feature_id")


def parents(t: Tables, types: list[str] | None = None) -> DataFrame:
    """(subject_id, type_id, parent columns) along the given relationship types."""
    edges = relationships_by_type(t, types or terms.PARENT_TYPES).select("subject_id", "object_id", "type_id").distinct()
    parent = t["feature"].select(
        F.col("feature_id").alias("object_id"), F.col("uniquename").alias("parent"),
        F.col("is_obsolete").alias("parent_obsolete"),
    )
    return edges.join(parent, "object_id")


def children(t: Tables, relationship: str) -> DataFrame:
    """(object_id, child columns) along one relationship type."""
    edges = relationships_by_type(t, [relationship]).select("subject_id", "object_id").distinct()
    child = t["feature"].select(
        F.col("feature_id").alias("subject_id"), F.col("uniquename").alias("child"),
        F.col("is_obsolete").alias("child_obsolete"),
    )
    return edges.join(child, "subject_id")


def features_on_sequence(t: Tables) -> DataFrame:
    """(srcfeature_id, fmin, feature) for every located feature, once per sequence with its first start."""
    located = t["featureloc"].where(F.col("srcfeature_id").isNotNull()).groupBy("srcfeature_id", "feature_id").agg(
        F.min("fmin").alias("fmin"))
    return located.join(t["feature"].select("feature_id", "uniquename", "is_obsolete"), "feature_id")


def flagged_features(t: Tables, name: str) -> DataFrame:
    """feature_id of the features that have a property of the type.

    They are written, so that Spark knows how few they are: it would judge them by the size of the whole property
    table, and exchange the features with their residues.
    """
    return cut_lineage(t.of_terms(t["featureprop"], "type_id", [name]).select("feature_id"))


def features_with_property(t: Tables, name: str) -> DataFrame:
    """Features that have a property of the type, each once."""
    return t["feature"].join(flagged_features(t, name), "feature_id", "left_semi")


def features_by_type(t: Tables, types: list[str], cv: str | None = None) -> DataFrame:
    return t.of_terms(t["feature"], "type_id", types, cv)


def protein_features(t: Tables) -> DataFrame:
    """Features that derive from a transcript that is part of a gene, each once."""
    genes = features_by_type(t, ["gene"], terms.SEQUENCE_CV).select(F.col("feature_id").alias("gene_id"))
    edges = t["feature_relationship"].select("subject_id", "object_id", "type_id")
    part = t.of_terms(edges, "type_id", ["part_of"], terms.RELATIONSHIP_CV)
    part = part.join(genes, part["object_id"] == genes["gene_id"], "left_semi").select(
        F.col("subject_id").alias("transcript_id")
    )
    derives = t.of_terms(edges, "type_id", ["derives_from"], terms.SEQUENCE_CV)
    proteins = derives.join(part, derives["object_id"] == part["transcript_id"], "left_semi").select(
        F.col("subject_id").alias("feature_id")
    )
    return t["feature"].join(proteins, "feature_id", "left_semi")


def feature_properties(t: Tables) -> DataFrame:
    props = t["featureprop"].select("feature_id", "type_id", "value", "rank", "featureprop_id")
    return props.join(t.term_names("featureprop", "property"), "type_id").drop("type_id")


def feature_publications(t: Tables) -> DataFrame:
    pubs = t["pub"].select("pub_id", F.col("uniquename").alias("publication"))
    return t["feature_pub"].select("feature_id", "pub_id").join(pubs, "pub_id")


def _xrefs(t: Tables) -> DataFrame:
    db = t["db"].select("db_id", F.col("name").alias("db"))
    return t["dbxref"].select("dbxref_id", "db_id", "accession").join(db, "db_id").drop("db_id")


def feature_cross_references(t: Tables) -> DataFrame:
    return t["feature_dbxref"].select("feature_id", "dbxref_id").join(_xrefs(t), "dbxref_id")


def feature_synonyms(t: Tables) -> DataFrame:
    synonyms = t["synonym"].select("synonym_id", "type_id", F.col("name").alias("synonym"))
    links = t["feature_synonym"].select("feature_synonym_id", "feature_id", "synonym_id")
    return links.join(synonyms, "synonym_id").join(t.term_names("synonym", "synonym_type"), "type_id").drop("type_id", "synonym_id")


def feature_ontology_terms(t: Tables, db: str) -> DataFrame:
    links = t["feature_cvterm"].select("feature_cvterm_id", "feature_id", "cvterm_id")
    return links.join(terms_of_db(t, db).select("cvterm_id", "db", "accession"), "cvterm_id").drop("cvterm_id")


def annotation_properties(t: Tables) -> DataFrame:
    props = t["feature_cvtermprop"].select("feature_cvterm_id", "type_id", "value", "rank", "feature_cvtermprop_id")
    return props.join(t.term_names("feature_cvtermprop", "property"), "type_id").drop("type_id")


def annotation_primary_publications(t: Tables) -> DataFrame:
    pubs = t["pub"].select("pub_id", F.col("uniquename").alias("publication"))
    return t["feature_cvterm"].select("feature_cvterm_id", "pub_id").join(pubs, "pub_id")


def annotation_secondary_publications(t: Tables) -> DataFrame:
    pubs = t["pub"].select("pub_id", F.col("uniquename").alias("publication"))
    return t["feature_cvterm_pub"].select("feature_cvterm_pub_id", "feature_cvterm_id", "pub_id").join(pubs, "pub_id")


def annotation_cross_references(t: Tables) -> DataFrame:
    links = t["feature_cvterm_dbxref"].select("feature_cvterm_dbxref_id", "feature_cvterm_id", "dbxref_id")
    return links.join(_xrefs(t), "dbxref_id")


def annotation_ontology_terms(t: Tables, db: str) -> DataFrame:
    links = t["feature_cvterm"].select("feature_cvterm_id", "cvterm_id")
    return links.join(terms_of_db(t, db).select("cvterm_id", "db", "accession"), "cvterm_id").drop("cvterm_id")


def term_vocabularies(t: Tables) -> DataFrame:
    cv = t["cv"].select("cv_id", F.col("name").alias("vocabulary"))
    return t["cvterm"].select("cvterm_id", "cv_id").join(cv, "cv_id").drop("cv_id")


def missing_terms(t: Tables, required: DataFrame) -> DataFrame:
    """Required (name, cv, relationship flag) rows that have no term; null cv or flag accept any."""
    cv = t["cv"].select("cv_id", F.col("name").alias("_cv"))
    have = t["cvterm"].join(cv, "cv_id").select(F.col("name").alias("_name"), "_cv", F.col("is_relationshiptype").alias("_rel"))
    same = (
        (required["name"] == have["_name"])
        & (required["cv"].isNull() | (required["cv"] == have["_cv"]))
        & (required["relationship"].isNull() | (required["relationship"] == have["_rel"]))
    )
    return required.join(have, same, "left_anti")


def require_terms(t: Tables, required: list[tuple[str, str | None, int | None]]) -> None:
    """Fail with the whole list of missing names before a job starts."""
    wanted = t.spark.createDataFrame(required, "name string, cv string, relationship int")
    missing = missing_terms(t, wanted).collect()
    if missing:
        raise LookupError("missing terms: " + ", ".join(sorted(f"{r['cv'] or '*'}/{r['name']}" for r in missing)))
