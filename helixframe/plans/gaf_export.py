"""Export of ontology annotations as gene-association records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from helixframe import terms
from helixframe.functions.expr import sort_nulls_last, today, xref_text
from helixframe.operators import hierarchy, lookups
from helixframe.session import cut_lineage
from helixframe.sinks.delimited import write_text
from helixframe.sources.gaf import column_name
from helixframe.tables import Tables

HEADER = "!gaf-version: 1.0"


def _map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def evidence_code(text: Column) -> Column:
    """Code of a spelled-out or abbreviated evidence, the default if unknown."""
    by_text = _map({v.lower(): k for k, v in terms.EVIDENCE.items()})
    by_code = F.when(F.upper(text).isin(list(terms.EVIDENCE)), F.upper(text))
    return F.coalesce(F.try_element_at(by_text, F.lower(text)), by_code, F.lit(terms.DEFAULT_EVIDENCE))


def _sorted_list(df: DataFrame, key: str, value: Column, order: list, name: str) -> DataFrame:
    rows = F.array_sort(F.collect_list(F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order)], value.alias("v"))))
    return df.groupBy(key).agg(rows.alias("_rows")).select(key, F.transform("_rows", lambda r: r["v"]).alias(name))


def _annotations(t: Tables, organism: str | None, include_obsolete: bool, publications: DataFrame) -> DataFrame:
    """Annotations with the ontology and primary publications, of features of known kinds."""
    ontology = lookups.terms_of_db(t, terms.GO_DB).select(
        "cvterm_id", "cv_id", "accession", xref_text(F.col("db"), F.col("accession")).alias("GO_ID")
    )
    cv = t["cv"].select("cv_id", F.col("name").alias("namespace"))
    features = t["feature"].select("feature_id", "organism_id", "type_id", "uniquename", "is_obsolete")
    if organism:
        features = t.of_names(features, "organism_id", "organism", [organism])
    if not include_obsolete:
        features = features.where(~F.col("is_obsolete"))
    features = hierarchy.with_kind(t, features.drop("is_obsolete")).where(F.col("kind").isNotNull()).drop("type_id")
    links = t["feature_cvterm"].select("feature_cvterm_id", "feature_id", "cvterm_id", "pub_id", "is_not")
    links = links.join(ontology, "cvterm_id").join(cv, "cv_id").drop("cv_id", "cvterm_id")
    links = links.join(publications, "pub_id", "left")
    return links.drop("pub_id").join(features, "feature_id")


def _targets(t: Tables, annotated: DataFrame, level: str, synonyms: DataFrame) -> DataFrame:
    """feature_id, target id and type, gene name, gene_id and ``synonyms`` (by gene_id) for every annotated feature."""
    leveled = hierarchy.at_level(t, annotated.select("feature_id", "kind").distinct(), level).select("feature_id", "target_id")
    type_names = t.term_names("feature", "DB_Object_Type")
    names = t["feature"].select("feature_id", "type_id", "uniquename", "name")
    target = hierarchy.with_kind(
        t, leveled.select(F.col("target_id").alias("feature_id")).distinct().join(names.drop("name"), "feature_id")
    ).join(type_names, "type_id")
    genes = hierarchy.gene_of(t, target.select("feature_id", "kind", "DB_Object_Type", F.col("uniquename").alias("DB_Object_ID")))
    symbol = F.coalesce(F.when(F.col("name") != "", F.col("name")), F.col("uniquename"))
    named = names.select(F.col("feature_id").alias("gene_id"), symbol.alias("DB_Object_Symbol"))
    whole = genes.join(named, "gene_id", "left").join(synonyms, "gene_id", "left").select(
        F.col("feature_id").alias("target_id"), "gene_id", "DB_Object_ID", "DB_Object_Type", "DB_Object_Symbol", "synonyms"
    )
    return leveled.join(whole, "target_id")


def gaf_records(
    t: Tables, database: str, organism: str | None = None, level: str = "default", include_obsolete: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(records, rejected annotations with a reason). List columns are arrays."""
    props = lookups.annotation_properties(t).where(F.col("property").isin("date", "evidence", "assigned_by"))
    last = F.struct("rank", "feature_cvtermprop_id")
    pick = lambda name: F.max_by("value", F.when(F.col("property") == name, last)).alias(name)
    props = props.groupBy("feature_cvterm_id").agg(pick("date"), pick("evidence"), pick("assigned_by"))

    xrefs = _sorted_list(
        lookups.annotation_cross_references(t), "feature_cvterm_id", xref_text(F.col("db"), F.col("accession")),
        ["feature_cvterm_dbxref_id"], "xrefs",
    )
    primary = t["pub"].select("pub_id", F.col("uniquename").alias("primary_pub"))
    secondary = _sorted_list(
        lookups.annotation_secondary_publications(t), "feature_cvterm_id", F.col("publication"),
        ["feature_cvterm_pub_id"], "more_pubs",
    )
    synonyms = _sorted_list(
        lookups.feature_synonyms(t), "feature_id", F.col("synonym"), ["feature_synonym_id"], "synonyms"
    ).withColumnRenamed("feature_id", "gene_id")
    product_terms = lookups.terms_of_db(t, terms.PRODUCT_DB).select("cvterm_id", F.col("name").alias("product"))
    products = t["feature_cvterm"].select("feature_id", "cvterm_id", "feature_cvterm_id").join(product_terms, "cvterm_id")
    products = products.groupBy("feature_id").agg(F.min_by("product", "feature_cvterm_id").alias("product"))
    taxon = t["organismprop"].where(F.col("type_id") == t.term_id("taxonId")).groupBy("organism_id").agg(
        F.min_by("value", "organismprop_id").alias("taxon")
    )
    organisms = t["organism"].select("organism_id", "abbreviation").join(taxon, "organism_id", "left")
    # Whole records are exchanged once, to the keys of their annotations: publications are joined to the bare links,
    # synonyms to the genes, and all that belongs to a feature while the links lie by feature.
    # Annotations and targets are written, so that neither is worked out twice and no plan holds all of it.
    annotated = cut_lineage(_annotations(t, organism, include_obsolete, primary))
    targets = cut_lineage(_targets(t, annotated, level, synonyms))
    full = (
        annotated.join(targets, "feature_id").join(products, "feature_id", "left")
        .join(organisms, "organism_id").join(props, "feature_cvterm_id", "left").join(xrefs, "feature_cvterm_id", "left")
        .join(secondary, "feature_cvterm_id", "left")
    )

    nothing = F.expr("cast(array() AS array<string>)")
    refs = F.coalesce("xrefs", nothing)
    is_ref = lambda x: F.substring_index(x, ":", 1).isin(terms.REFERENCE_DBS)
    pubs = F.filter(F.concat(F.array("primary_pub"), F.coalesce("more_pubs", nothing)), lambda p: p != terms.NULL_PUB)
    references = F.concat(pubs, F.filter(refs, is_ref))
    columns = {
        "DB": F.lit(database), "DB_Object_ID": F.col("DB_Object_ID"), "DB_Object_Symbol": F.col("DB_Object_Symbol"),
        "Qualifier": F.when(F.col("is_not"), "NOT").otherwise(""), "GO_ID": F.col("GO_ID"),
        "DB:Reference": F.when(F.size(references) > 0, references).otherwise(F.array(F.lit(terms.DEFAULT_REFERENCE))),
        "Evidence": F.when(F.col("evidence").isNull(), terms.DEFAULT_EVIDENCE).otherwise(evidence_code(F.col("evidence"))),
        "With": F.filter(refs, lambda x: ~is_ref(x)), "Aspect": F.try_element_at(_map(terms.ASPECTS), F.col("namespace")),
        "DB_Object_Name": F.coalesce("product", F.lit("")), "Synonym": F.coalesce("synonyms", nothing),
        "DB_Object_Type": F.col("DB_Object_Type"),
        "Taxon_ID": F.concat(F.lit("taxon:"), F.coalesce("taxon", "abbreviation")),
        "Date": F.coalesce("date", today()), "Assigned_By": F.coalesce("assigned_by", F.lit(database)),
    }
    reason = F.when(F.col("Aspect").isNull(), "unknown namespace").when(F.col("DB_Object_Symbol").isNull(), "missing gene name")
    rows = full.select(
        F.col("abbreviation").alias("organism"), "uniquename", "accession", "feature_cvterm_id",
        *[columns[c].alias(column_name(c)) for c in terms.GAF_COLUMNS],
    ).withColumn("reason", reason)
    good = rows.where(F.col("reason").isNull()).drop("reason")
    return good, rows.where(F.col("reason").isNotNull()).select("organism", "uniquename", "GO_ID", "reason")


def gaf_lines(records: DataFrame) -> DataFrame:
    """Records as tab-separated lines in file order, lists joined by pipes."""
    kinds = dict(records.dtypes)
    cell = lambda c: F.array_join(c, "|") if kinds[c].startswith("array") else F.col(c)
    line = F.concat_ws("\t", *[F.coalesce(cell(column_name(c)), F.lit("")) for c in terms.GAF_COLUMNS])
    return sort_nulls_last(records, "uniquename", "accession", "feature_cvterm_id").select(line.alias("value"))


def write_gaf(
    t: Tables, path: str, organism: str, database: str, level: str = "default", include_obsolete: bool = False,
    compress: bool = False,
) -> DataFrame:
    """Write the annotations of an organism; returns what was left out."""
    records, rejects = gaf_records(t, database, organism, level, include_obsolete)
    head = t.spark.range(1, numPartitions=1).select(F.lit(HEADER).alias("value"))
    write_text(head.union(gaf_lines(records)), path, compress)
    return rejects
