"""Import of feature records into the annotation tables.

All records of all files are handled at once: for each table the records give
one batch, foreign keys are resolved by joins, and the batch is merged.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, functions as F

from helixframe import terms
from helixframe.functions.expr import phase_number, scalar_text, strand_number, strand_text, xref_parts
from helixframe.operators import deletion, merge
from helixframe.operators.lookups import require_terms
from helixframe.plans.importing import (
    ImportResult, existing_terms, in_file, later_xrefs, merge_pubs, of_xref_terms, rejected,
)
from helixframe.session import cut_lineage
from helixframe.sources.gff import attribute_values, first_value
from helixframe.tables import Tables

REQUIRED = (
    [("part_of", terms.RELATIONSHIP_CV, None), ("derives_from", terms.SEQUENCE_CV, None)]
    + [(name, terms.SYNONYM_CV, None) for name in terms.SYNONYM_TYPES]
    + [(name, terms.PROPERTY_CV, None) for name in terms.PROPERTY_TYPES]
    + [(name, terms.SEQUENCE_CV, None) for name in ["gene", "intron", "exon", "CDS", "mRNA", "chromosome"]]
)

MERGED_ATTRIBUTES = ["id", "name", "size", "translation", "protein_source_id"]


def of_organism(t: Tables, records: DataFrame, organism: str) -> DataFrame:
    """Records of one file for one organism."""
    return records.withColumn("organism_id", F.lit(t.name_id("organism", organism)))


def with_organism(t: Tables, records: DataFrame, column: str = "organism") -> DataFrame:
    """Records of many files; ``column`` holds each file's organism abbreviation."""
    names = t["organism"].select("organism_id", F.col("abbreviation").alias(column))
    return records.join(names, column)


def _typed(t: Tables, records: DataFrame, result: ImportResult) -> DataFrame:
    """Records whose type is a sequence term; the others are rejected. All are read once and written."""
    known = t.of_names(t["cvterm"], "cv_id", "cv", [terms.SEQUENCE_CV]).where(F.col("is_relationshiptype") == 0)
    known = known.groupBy(F.col("name").alias("type")).agg(F.max("cvterm_id").alias("type_id"))
    every = cut_lineage(records.join(known.withColumn("_known", F.lit(True)), "type", "left"))
    result.reject(rejected(every.where(F.col("_known").isNull()), "type", "unknown feature type"))
    return every.where("_known").drop("_known")


def _unique(records: DataFrame, result: ImportResult) -> tuple[DataFrame, bool]:
    """The first record of every id, and whether any id is repeated; later ones are rejected.

    Ids are counted on narrow rows; whole records are only joined when some
    id is in fact repeated.
    """
    seen = records.groupBy("organism_id", "id").agg(F.min("pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    repeated = seen.where(F.col("_n") > 1).drop("_n")
    if repeated.isEmpty():
        return records, False
    marked = records.join(repeated, ["organism_id", "id"], "left")
    later = F.col("_first").isNotNull() & (F.col("pos") > F.col("_first"))
    result.reject(rejected(marked.where(later), "id", "repeated id"))
    return marked.where(~later).drop("_first"), True


def _one_per_key(batch: DataFrame, key: list[str], repeated: bool) -> DataFrame:
    """Last values per key by position; skipped when no key is repeated."""
    return (merge.collapse(batch, key, F.col("pos")) if repeated else batch).drop("pos")


def implied_proteins(t: Tables, records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Protein records named by ``protein_source_id``: (records, rejected rows).

    The protein lies where its transcript lies: the record itself, or its
    first part_of parent by name.
    """
    asked = records.withColumn("protein", first_value("protein_source_id")).where(F.col("protein").isNotNull())
    own = F.lower("type").isin(terms.TRANSCRIPT_TYPES)
    parent = F.array_min(_last_values("part_of", {"parent": "part_of"}))
    asked = asked.withColumn("transcript", F.when(own, F.col("id")).otherwise(parent))
    here = records.select(
        "organism_id", F.col("id").alias("transcript"), F.col("start").alias("_start"), F.col("end").alias("_end"),
        F.when(F.col("strand").isin("+", "-"), F.col("strand")).otherwise(".").alias("_strand"), F.lit(True).alias("_here"),
    )
    # Few records name a protein: they are written with their places, and stored places are only read for those left.
    placed = cut_lineage(cut_lineage(asked).join(here, ["organism_id", "transcript"], "left"))
    left = placed.where(F.col("_here").isNull())
    if not left.isEmpty():
        wanted = left.select("organism_id", "transcript").distinct()
        stored = t["feature"].select("feature_id", "organism_id", F.col("uniquename").alias("transcript")).join(
            wanted, ["organism_id", "transcript"], "left_semi"
        ).join(t["featureloc"].select("feature_id", "fmin", "fmax", "strand"), "feature_id").select(
            "organism_id", "transcript", (F.col("fmin") + 1).alias("_start"), F.col("fmax").alias("_end"),
            strand_text(F.col("strand")).alias("_strand"))
        placed = placed.where(F.col("_here").isNotNull()).drop("_here").unionByName(
            left.drop("_start", "_end", "_strand", "_here").join(stored, ["organism_id", "transcript"], "left"))
    made = placed.where(F.col("_start").isNotNull()).select(
        *[
            {
                "type": F.lit("polypeptide"), "start": F.col("_start"), "end": F.col("_end"), "strand": F.col("_strand"),
                "score": F.lit("."), "phase": F.lit("."), "id": F.col("protein"),
                "attributes": F.array(F.struct(F.lit("Derives_from").alias("key"), F.array("transcript").alias("values"))),
            }.get(c, F.col(c)).alias(c)
            for c in records.columns
        ]
    )
    lost = rejected(placed.where(F.col("_start").isNull()), "protein", "no transcript location for protein")
    return made, lost


def _mapped(key: Column, names: list[str], renamed: dict[str, str]) -> Column:
    lowered = F.lower(key)
    out = F.when(lowered.isin(names), lowered)
    for old, new in renamed.items():
        out = F.when(lowered == old, new).otherwise(out)
    return out


def _last_values(name: str, renamed: dict[str, str]) -> Column:
    """Values of the last attribute that stands for ``name``."""
    same = F.filter("attributes", lambda a: F.coalesce(_mapped(a["key"], [name], renamed) == name, F.lit(False)))
    return F.try_element_at(F.transform(same, lambda a: a["values"]), F.lit(-1))


def _placed(name: str):
    return lambda v, i: F.struct(i.alias("place"), F.lit(name).alias("name"), v.alias("value"))


def _by_type(records: DataFrame, names: list[str], renamed: dict[str, str] | None = None, extra=None) -> DataFrame:
    """One row per (record, name, value): organism_id, id, feature_id, pos, place, name, value."""
    lists = []
    for name in names:
        values = _last_values(name, renamed or {})
        if extra and name in extra:
            values = F.coalesce(values, extra[name])
        values = F.coalesce(values, F.expr("cast(array() AS array<string>)"))
        lists.append(F.transform(values, _placed(name)))
    return records.select("organism_id", "id", "feature_id", "pos", F.explode(F.concat(*lists)).alias("v")).select(
        "organism_id", "id", "feature_id", "pos", "v.*"
    )


def _without_merged(records: DataFrame, values: dict[str, Column] | None = None) -> DataFrame:
    """Records without the attributes that only the features and proteins needed, so that they are not exchanged.

    ``values`` are columns taken from all attributes before.
    """
    left = F.filter("attributes", lambda a: F.coalesce(~F.lower(a["key"]).isin(MERGED_ATTRIBUTES), F.lit(True)))
    return records.withColumns({**(values or {}), "attributes": left})


def _values(records: DataFrame, key: str, exact: bool = True) -> DataFrame:
    """One row per value of a multi-valued attribute."""
    return records.select("organism_id", "id", "feature_id", "pos", F.explode(attribute_values(key, exact)).alias("value"))


def _feature_values() -> dict[str, Column]:
    """What a feature takes from the attributes of its record."""
    residues = F.upper(first_value("translation"))
    size = F.coalesce(F.length(residues).cast("long"), first_value("size").try_cast("long"))
    return {"_name": first_value("Name"), "_residues": residues, "_seqlen": size}


def _feature_batch(rows: DataFrame, *more: str) -> DataFrame:
    return rows.select(
        "organism_id", F.col("id").alias("uniquename"), F.col("_name").alias("name"), "type_id",
        F.col("_residues").alias("residues"), F.col("_seqlen").alias("seqlen"), F.lit(False).alias("is_analysis"),
        F.lit(False).alias("is_obsolete"), *more,
    )


def _located(
    t: Tables, records: DataFrame, result: ImportResult, full_genome: bool, names: DataFrame | None
) -> DataFrame | None:
    """The records with feature_id, their features merged: records and table meet once, by name, and are written.

    None where a name is repeated or missing in the table or the records.
    """
    stored = t["feature"].groupBy(F.col("organism_id").alias("_organism"), F.col("uniquename").alias("_uniquename")).agg(
        F.min("feature_id").alias("_target"), F.count(F.lit(1)).alias("_n"))
    same = (F.col("organism_id") == F.col("_organism")) & (F.col("id") == F.col("_uniquename"))
    met = _without_merged(records, _feature_values()).join(stored, same, "left").drop("_organism", "_uniquename")
    typed = merge.with_ids(met.withColumn("uniquename", F.col("id")), "feature").drop("uniquename")
    rows = cut_lineage(typed)
    if not rows.where("_n > 1 OR id IS NULL OR organism_id IS NULL OR (_n = 1 AND _target IS NULL)").isEmpty():
        return None
    merged = merge.merge_resolved(t["feature"], _feature_batch(rows, "_target", "feature_id"), "feature")
    if full_genome:
        # Rows of the file are touched, so only the few names of sequences and organisms are looked up.
        scope = cut_lineage(rows.select("organism_id").distinct())
        loaded = None if names is None else cut_lineage(names.select("organism_id", F.col("name").alias("uniquename")).distinct())
        merged = deletion.mark_obsolete(merged, loaded, scope, F.col("_touched"))
    result.merges["feature"] = merged
    fresh = rows.where(F.col("_target").isNull()).select("organism_id", F.col("id").alias("uniquename"), "feature_id")
    result.features = cut_lineage(t["feature"].select("organism_id", "uniquename", "feature_id").unionByName(fresh))
    return rows.drop("_name", "_residues", "_seqlen", "_target", "_n")


def _features(
    t: Tables, records: DataFrame, result: ImportResult, full_genome: bool, names: DataFrame | None, repeated: bool
) -> DataFrame:
    """Merge features; returns (organism_id, uniquename, feature_id) of the table after it."""
    batch = _feature_batch(records.withColumns(_feature_values()), "pos")
    batch = _one_per_key(batch, ["organism_id", "uniquename"], repeated)
    merged = merge.merge(t["feature"], batch, "feature")
    if full_genome:
        loaded = records.select("organism_id", F.col("id").alias("uniquename"))
        if names is not None:
            loaded = loaded.unionByName(names.select("organism_id", F.col("name").alias("uniquename")))
        merged = deletion.mark_obsolete(merged, loaded, records)
    result.merges["feature"] = merged
    result.features = cut_lineage(merge.applied(merged).select("organism_id", "uniquename", "feature_id"))
    return result.features


def _locations(t: Tables, records: DataFrame, ids: DataFrame, result: ImportResult, repeated: bool) -> None:
    names = records.select("organism_id", "seqid").distinct()
    sources = names.join(ids.withColumnRenamed("uniquename", "seqid"), ["organism_id", "seqid"]).select(
        "organism_id", "seqid", F.col("feature_id").alias("srcfeature_id")
    )
    placed = records.where(F.col("seqid") != F.col("id")).join(sources, ["organism_id", "seqid"], "left")
    result.reject(rejected(placed.where(F.col("srcfeature_id").isNull()), "seqid", "unknown sequence"))
    batch = placed.where(F.col("srcfeature_id").isNotNull()).select(
        "feature_id", "srcfeature_id", (F.col("start") - 1).alias("fmin"), F.col("end").alias("fmax"),
        strand_number(F.col("strand")).alias("strand"), phase_number(F.col("phase")).alias("phase"), "pos",
    )
    batch = _one_per_key(batch, ["feature_id"], repeated)
    result.merges.later("featureloc", lambda: merge.merge(t["featureloc"], batch, "featureloc", cut_lineage))


def _synonym_parts(value: Column) -> Column:
    """``text;key=value;...`` as a struct: the first plain part (else ``term``) and ``current``."""
    parts = F.filter(F.split(value, ";"), lambda p: p != "")
    plain = F.get(F.filter(parts, lambda p: ~F.contains(p, F.lit("="))), F.lit(0))
    named = lambda key: F.try_element_at(
        F.transform(
            F.filter(parts, lambda p: F.substring_index(p, "=", 1) == key) , lambda p: F.regexp_replace(p, "^[^=]*=", "")
        ), F.lit(-1),
    )
    current = F.lower(named("current"))
    return F.struct(
        F.coalesce(plain, scalar_text(named("term")), F.lit("")).alias("text"),
        F.when(current == "true", True).when(current == "false", False).alias("current"),
    )


def _synonyms(t: Tables, records: DataFrame, features: DataFrame, result: ImportResult, prune: bool) -> None:
    types = {name: t.term_id(name, terms.SYNONYM_CV) for name in terms.SYNONYM_TYPES}
    rows = _by_type(records, terms.SYNONYM_TYPES).withColumn("s", _synonym_parts(F.col("value")))
    type_id = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])[F.col("name")]
    rows = rows.select("feature_id", "pos", "place", type_id.alias("type_id"), F.col("s.text").alias("name"), "s.current")
    batch = rows.select("name", "type_id", F.col("name").alias("synonym_sgml")).distinct()
    resolved = cache(lambda: cut_lineage(merge.resolve(t["synonym"], batch, "synonym")))
    result.merges.later("synonym", lambda: merge.merge_resolved(t["synonym"], resolved(), "synonym"))

    def linked() -> DataFrame:
        links = rows.join(resolved().select("name", "type_id", "synonym_id"), ["name", "type_id"]).select(
            "feature_id", "synonym_id", F.col("current").alias("is_current"), "pos", "place"
        )
        last = merge.collapse(
            links.withColumn("at", F.struct("pos", "place")).select("feature_id", "synonym_id", "is_current", "at"),
            ["feature_id", "synonym_id"], F.col("at"),
        ).drop("at").withColumn("pub_id", F.lit(t.name_id("pub", terms.NULL_PUB)))
        merged = merge.merge(t["feature_synonym"], last, "feature_synonym", cut_lineage)
        if prune:
            handled = t["synonym"].where(F.col("type_id").isin(list(types.values()))).select(
                "synonym_id", F.lit(True).alias("_handled")
            )
            scoped = in_file(merged, features).join(handled, "synonym_id", "left")
            scope = F.col("_in_file") & F.coalesce("_handled", F.lit(False))
            merged = merge.delete_unmatched(scoped, scope).drop("_in_file", "_handled")
        return merged

    result.merges.later("feature_synonym", linked)


def _properties(t: Tables, records: DataFrame, features: DataFrame, result: ImportResult, prune: bool) -> None:
    types = {name: t.term_id(name, terms.PROPERTY_CV) for name in terms.PROPERTY_TYPES}
    type_id = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])[F.col("name")]
    column = lambda c: F.when((F.col(c) != "") & (F.col(c) != "."), F.array(c))
    rows = _by_type(
        records.select("organism_id", "id", "feature_id", "pos", "attributes", "score", "source"),
        terms.PROPERTY_TYPES, {"note": "comment"}, {"score": column("score"), "source": column("source")},
    )
    batch = rows.select(
        "feature_id", type_id.alias("type_id"), "value", F.col("pos.file").alias("file"),
        F.col("pos.block").alias("block"), F.col("pos.row").alias("row"), "place",
    )

    def ranked() -> DataFrame:
        merged = merge.merge_ranked_properties(t["featureprop"], batch, ["file", "block"], ["row", "place"], cut_lineage)
        if prune:
            scope = F.col("_in_file") & F.col("type_id").isin(list(types.values()))
            merged = merge.delete_unmatched(in_file(merged, features), scope).drop("_in_file")
        return merged

    result.merges.later("featureprop", ranked)


def _cross_references(t: Tables, records: DataFrame, features: DataFrame, result: ImportResult, prune: bool) -> None:
    rows = _values(records, "dbxref", exact=False).withColumn("x", xref_parts(F.col("value")))
    result.reject(rejected(rows.where(F.col("x").isNull()), "value", "malformed cross reference"))
    refs = rows.where(F.col("x").isNotNull()).select("feature_id", "x.*")
    ids = later_xrefs(t, refs.select("db", "accession", "version"), result)

    def linked() -> DataFrame:
        batch = refs.join(ids(), ["db", "accession"]).select("feature_id", "dbxref_id").distinct()
        merged = merge.merge(t["feature_dbxref"], batch.withColumn("is_current", F.lit(True)), "feature_dbxref", cut_lineage)
        if prune:
            merged = merge.delete_unmatched(in_file(merged, features), F.col("_in_file")).drop("_in_file")
        return merged

    result.merges.later("feature_dbxref", linked)


def _ontology_terms(t: Tables, records: DataFrame, features: DataFrame, result: ImportResult, prune: bool) -> None:
    rows = _values(records, "Ontology_term").withColumn("x", xref_parts(F.col("value")))
    result.reject(rejected(rows.where(F.col("x").isNull()), "value", "malformed ontology term"))
    refs = rows.where(F.col("x").isNotNull()).select("organism_id", "id", "feature_id", "value", "x.db", "x.accession")
    found, missing = existing_terms(t, refs)
    lost = refs.join(missing, ["db", "accession"])
    result.reject(lost.select("organism_id", "id", F.col("value").alias("item"), "reason"))
    batch = refs.join(found, ["db", "accession"]).select("feature_id", "cvterm_id").distinct()
    batch = batch.withColumn("pub_id", F.lit(t.name_id("pub", terms.NULL_PUB)))

    def linked() -> DataFrame:
        merged = merge.merge(t["feature_cvterm"], batch, "feature_cvterm", cut_lineage)
        if prune:
            scoped = of_xref_terms(t, in_file(merged, features), terms.GO_DB)
            merged = merge.delete_unmatched(scoped, F.col("_in_file") & F.col("_of_db")).drop("_in_file", "_of_db")
        return merged

    result.merges.later("feature_cvterm", linked)


def _publications(t: Tables, records: DataFrame, features: DataFrame, result: ImportResult, prune: bool) -> None:
    rows = _values(records, "literature").select("feature_id", F.col("value").alias("publication"))
    aside = ImportResult()
    ids = cache(lambda: merge_pubs(t, rows, aside))
    result.merges.later("pub", lambda: (ids(), aside.merges["pub"])[1])

    def linked() -> DataFrame:
        batch = rows.join(ids(), "publication").select("feature_id", "pub_id").distinct()
        merged = merge.merge(t["feature_pub"], batch, "feature_pub", cut_lineage)
        if prune:
            merged = merge.delete_unmatched(in_file(merged, features), F.col("_in_file")).drop("_in_file")
        return merged

    result.merges.later("feature_pub", linked)


def _relationships(
    t: Tables, records: DataFrame, features: DataFrame, ids: DataFrame, result: ImportResult, prune: bool
) -> None:
    types = {name: t.term_id(name, terms.PARENT_CV[name]) for name in terms.PARENT_TYPES}
    rows = _by_type(records, terms.PARENT_TYPES, {"parent": "part_of"})
    parents = ids.select("organism_id", F.col("uniquename").alias("value"), F.col("feature_id").alias("object_id"))
    joined = rows.join(parents, ["organism_id", "value"], "left")
    result.reject(rejected(joined.where(F.col("object_id").isNull()), "value", "unknown parent feature"))
    type_id = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])[F.col("name")]
    batch = joined.where(F.col("object_id").isNotNull()).select(
        F.col("feature_id").alias("subject_id"), type_id.alias("type_id"), "object_id"
    ).distinct()

    def linked() -> DataFrame:
        merged = merge.merge(t["feature_relationship"], batch, "feature_relationship", cut_lineage)
        if prune:
            keyed = merged.withColumn("feature_id", F.col("subject_id"))
            scope = F.col("_in_file") & F.col("type_id").isin(list(types.values()))
            merged = merge.delete_unmatched(in_file(keyed, features), scope).drop("_in_file", "feature_id")
        return merged

    result.merges.later("feature_relationship", linked)


def unknown_attributes(records: DataFrame) -> DataFrame:
    """Attribute keys the import does not handle, per record."""
    keys = F.explode(F.array_distinct(F.transform("attributes", lambda a: a["key"])))
    rows = records.select("organism_id", "id", keys.alias("attribute"))
    return rows.where(~F.lower("attribute").isin(terms.KNOWN_ATTRIBUTES))


def import_gff(
    t: Tables, records: DataFrame, full_genome: bool = False, full_attributes: bool = False,
    sequence_names: DataFrame | None = None, malformed: DataFrame | None = None,
) -> ImportResult:
    """Merge feature records (with organism_id) into the tables.

    ``full_genome`` marks features of the organisms that are not in the files
    as obsolete, except the declared ``sequence_names``. ``full_attributes``
    deletes attributes that features in the files no longer have. ``malformed``
    lines (organism_id, item, reason) go to the rejects.
    """
    require_terms(t, REQUIRED)
    result = ImportResult()
    result.reject_lines(malformed)
    typed, again = _unique(_typed(t, records, result), result)
    proteins, lost = implied_proteins(t, typed)
    result.reject(lost)
    proteins = cut_lineage(proteins)
    everything, repeated = typed, False
    if not proteins.isEmpty():
        everything = typed.unionByName(
            proteins.withColumn("type_id", F.lit(t.term_id("polypeptide", terms.SEQUENCE_CV)))
        )
        # Several records may name one protein, and the file may hold it too.
        made = proteins.select("organism_id", "id")
        twice = made.groupBy("organism_id", "id").count().where("count > 1").drop("count")
        repeated = not twice.union(made.join(typed, ["organism_id", "id"], "left_semi")).isEmpty()
    rows = None if again or repeated else _located(t, everything, result, full_genome, sequence_names)
    if rows is None:
        ids = _features(t, everything, result, full_genome, sequence_names, repeated)
        named = ids.withColumnRenamed("uniquename", "id")
        everything = cut_lineage(_without_merged(everything).join(named, ["organism_id", "id"]))
    else:
        ids, everything = result.features, rows
    features = everything.select("feature_id").distinct()
    _locations(t, everything, ids, result, repeated)
    _synonyms(t, everything, features, result, full_attributes)
    _properties(t, everything, features, result, full_attributes)
    _cross_references(t, everything, features, result, full_attributes)
    _ontology_terms(t, everything, features, result, full_attributes)
    _publications(t, everything, features, result, full_attributes)
    _relationships(t, everything, features, ids, result, full_attributes)
    result.reports["unknown_attributes"] = unknown_attributes(everything)
    return result
