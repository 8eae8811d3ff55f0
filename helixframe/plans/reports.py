"""Prepared reports over the annotation tables.

Each report is one declarative plan. Type and vocabulary names become short id
lists that reach the Parquet scans; joins on feature ids stay equi-joins that
Catalyst and AQE may broadcast once a side is measured to be small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from helixframe import terms
from helixframe.functions.expr import sort_nulls_last, today
from helixframe.session import cut_lineage
from helixframe.tables import Tables


def _organism_property(t: Tables, name: str, alias: str) -> DataFrame:
    return t.of_terms(t["organismprop"], "type_id", [name]).select("organism_id", F.col("value").alias(alias))


def _public(t: Tables) -> DataFrame:
    """One row per public flag: an organism flagged twice doubles its rows."""
    return t.of_terms(t["organismprop"], "type_id", [terms.PUBLIC_FLAG]).select("organism_id")


def organisms(t: Tables, public: bool = False) -> DataFrame:
    """Organisms with genome version, taxon and Wikidata ids."""
    xrefs = t.of_names(t["dbxref"], "db_id", "db", [terms.WIKIDATA_DB])
    wikidata = t["organism_dbxref"].join(xrefs, "dbxref_id").select("organism_id", F.col("accession").alias("wikidata_id"))
    out = (
        t["organism"].where(F.col("abbreviation") != "dummy")
        .join(wikidata, "organism_id", "left")
        .join(_organism_property(t, "version", "version"), "organism_id", "left")
        .join(_organism_property(t, "taxonId", "taxon_id"), "organism_id", "left")
    )
    if public:
        out = out.join(_public(t), "organism_id")
    out = out.select(
        "abbreviation", "genus", "species", F.col("infraspecific_name").alias("strain"), "common_name", "version",
        "taxon_id", "wikidata_id",
    )
    return sort_nulls_last(out, "genus", "species", "strain")


def vocabulary_terms(t: Tables, vocabulary: str | None = None, database: str | None = None) -> DataFrame:
    """Terms with their vocabulary and cross reference."""
    cv = t["cv"].select("cv_id", F.col("name").alias("vocabulary"))
    db = t["db"].select("db_id", F.col("name").alias("xref_database"))
    if vocabulary:
        cv = cv.where(F.col("vocabulary") == vocabulary)
    if database:
        db = db.where(F.col("xref_database") == database)
    xref = t["dbxref"].select(
        "dbxref_id", "db_id", F.col("accession").alias("xref_accession"), F.col("version").alias("xref_version")
    )
    out = t["cvterm"].join(cv, "cv_id").join(xref, "dbxref_id").join(db, "db_id").orderBy("cvterm_id")
    return out.select(
        "name", "definition", "is_obsolete", "is_relationshiptype", "vocabulary", "xref_database", "xref_accession",
        "xref_version",
    )


def _edges(t: Tables, name: str, subject: str, object: str) -> DataFrame:
    edges = t["feature_relationship"].select("subject_id", "object_id", "type_id")
    return t.of_terms(edges, "type_id", [name]).select(F.col("subject_id").alias(subject), F.col("object_id").alias(object))


def gene_models(t: Tables) -> DataFrame:
    """Every product -> transcript -> gene path: product_id, transcript_id, gene_id."""
    derives = _edges(t, "derives_from", "product_id", "transcript_id")
    return derives.join(_edges(t, "part_of", "transcript_id", "gene_id"), "transcript_id")


def _named_models(t: Tables, transcripts: DataFrame, genes: DataFrame) -> DataFrame:
    """The same paths with the columns of their transcripts and genes, for reports on most products.

    Genes come first, as they are restricted most. Paths, products and
    transcripts then meet in one exchange, and what is said of a product
    is only exchanged to meet it.
    """
    paths = _edges(t, "part_of", "transcript_id", "gene_id").join(genes, "gene_id")
    return paths.join(_edges(t, "derives_from", "product_id", "transcript_id"), "transcript_id").join(transcripts, "transcript_id")


def _genes(t: Tables, organism: str | None, public: bool) -> DataFrame:
    """Genes with the name of their organism, restricted as asked."""
    org = t["organism"].select("organism_id", F.col("abbreviation").alias("organism_name"))
    if organism:
        org = org.where(F.col("organism_name") == organism)
    if public:
        # Written, so that Spark knows how few they are and exchanges no features to find them.
        org = cut_lineage(org.join(_public(t), "organism_id"))
    genes = t["feature"].select(
        F.col("feature_id").alias("gene_id"), "organism_id", "type_id", F.col("uniquename").alias("gene"),
        F.col("name").alias("gene_name"), F.col("is_obsolete").alias("gene_obsolete"),
    )
    if organism:
        genes = t.of_names(genes, "organism_id", "organism", [organism])
    return genes.join(org, "organism_id")


def _transcripts(t: Tables) -> DataFrame:
    return t["feature"].select(
        F.col("feature_id").alias("transcript_id"), F.col("uniquename").alias("transcript"),
        F.col("is_obsolete").alias("transcript_obsolete"),
    )


def gene_products(t: Tables, organism: str | None = None, public: bool = False) -> DataFrame:
    """Products of transcripts that are not obsolete."""
    products = t.of_names(t["cvterm"], "cv_id", "cv", [terms.PRODUCT_CV]).select(
        "cvterm_id", F.col("name").alias("product")
    )
    annotations = t["feature_cvterm"].select(
        F.col("feature_id").alias("product_id"), "cvterm_id", F.col("rank").alias("rankalternative")
    )
    out = (
        annotations.join(products, "cvterm_id")
        .join(_named_models(t, _transcripts(t).where(~F.col("transcript_obsolete")), _genes(t, organism, public)), "product_id")
        .select(
            "organism_name", F.col("transcript").alias("transcript_id"), F.col("gene").alias("gene_id"), "gene_name",
            "product", "rankalternative",
        )
    )
    return sort_nulls_last(out, "organism_name", "transcript_id", "rankalternative", "product")


def annotation_updates(
    t: Tables, start_date: str, end_date: str | None = None, organism: str | None = None, public: bool = False
) -> DataFrame:
    """Annotation changes between two dates (``YYYYMMDD``, inclusive; end defaults to today)."""
    changes = t.of_names(t["cvterm"], "cv_id", "cv", [terms.CHANGE_CV]).select("cvterm_id")
    annotations = (
        t["feature_cvterm"].join(changes, "cvterm_id", "left_semi")
        .select("feature_cvterm_id", F.col("feature_id").alias("product_id"))
    )
    props = t["feature_cvtermprop"].select("feature_cvterm_id", "type_id", "value")
    texts = t.of_terms(props, "type_id", ["qualifier"]).where(F.col("value") != "").select(
        "feature_cvterm_id", F.col("value").alias("annotation")
    )
    last = F.lit(end_date) if end_date else today()
    dates = t.of_terms(props, "type_id", ["date"]).where(
        (F.col("value") >= start_date) & (F.col("value") <= last)
    ).select("feature_cvterm_id", F.col("value").alias("date"))
    out = (
        dates.join(texts, "feature_cvterm_id")
        .join(annotations, "feature_cvterm_id")
        .join(gene_models(t), "product_id")
        .join(_transcripts(t), "transcript_id")
        .join(_genes(t, organism, public), "gene_id")
        .select(
            "organism_name", F.col("transcript").alias("transcript_id"), F.col("gene").alias("gene_id"), "date",
            "annotation",
        )
    )
    return sort_nulls_last(out, "organism_name", "transcript_id", "date", "annotation")


def curator_comments(t: Tables, organism: str | None = None, public: bool = False) -> DataFrame:
    """Comments on products of genes that are not obsolete."""
    comments = t.of_terms(t["featureprop"], "type_id", ["comment", "curation"]).select(
        F.col("feature_id").alias("product_id"), F.col("value").alias("curator_comment")
    )
    genes = t.of_terms(_genes(t, organism, public), "type_id", ["gene", "pseudogene"])
    out = (
        comments.join(_named_models(t, _transcripts(t), genes.where(~F.col("gene_obsolete"))), "product_id")
        .select(F.col("gene").alias("gene_id"), F.col("transcript").alias("transcript_id"), "curator_comment")
    )
    return sort_nulls_last(out, "gene_id", "transcript_id", "curator_comment")


def ad_hoc(t: Tables, text: str, names: list[str], **parameters) -> DataFrame:
    """Run a user's SQL with named parameters over the named tables."""
    for name in names:
        t[name].createOrReplaceTempView(name)
    return t.spark.sql(text, args=parameters)
