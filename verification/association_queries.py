"""Imports of sequences (I2), associations (I3) and organisms (I5), and the seed."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.operators import merge
from helixframe.plans import fasta_import, gaf_import, organisms
from helixframe.session import scratch_path
from helixframe.sources import fasta as fasta_source, gaf as gaf_source
from helixframe.terms import GAF_COLUMNS
from verification.registry import query
from verification.report_queries import H

_CACHE: dict[tuple, object] = {}


def _once(c, kind, make):
    key = (c.spark.sparkContext.applicationId, c.sf_dir, kind)
    if key not in _CACHE:
        _CACHE[key] = make()
    return _CACHE[key]


# -- I2: sequences -----------------------------------------------------------
# Chromosomes with new residues, a header type for some, and new contigs.

I2 = {"in_seq": """SELECT organism_id, uniquename AS id, CASE organism_id % 4 WHEN 0 THEN 'contig' WHEN 1 THEN 'unheard' END AS type,
 'ACGT' || residues AS residues FROM feature WHERE type_id = 4 AND organism_id % 5 <> 2
UNION ALL SELECT organism_id, 'ctg' || substr(uniquename, 2), CASE feature_id % 3 WHEN 0 THEN 'region' END,
 repeat('GATTACAN', 20) FROM feature WHERE type_id = 1 AND feature_id % 7 = 0"""}


def sequence_import(c):
    def make():
        rows = c.view("SELECT i.*, abbreviation AS organism FROM in_seq i JOIN organism o ON i.organism_id = o.organism_id", I2)
        header = F.concat_ws(" | ", "id", F.lit("length=1"), F.when(F.col("type").isNotNull(), F.concat(F.lit("sequence_type="), "type")))
        wrapped = F.regexp_replace("residues", "(.{70})(?=.)", "$1\n")
        path = scratch_path(c.spark, "fasta-in")
        rows.select("organism", F.concat(F.lit(">"), header, F.lit("\n"), wrapped).alias("value")).repartition(
            4, "organism").write.partitionBy("organism").text(path)
        records = fasta_source.read_fasta(c.spark, path, ["organism"])
        names = c.tables["organism"].select("organism_id", F.col("abbreviation").alias("organism"))
        return fasta_import.import_fasta(c.tables, records.join(names, "organism"), "supercontig")

    return _once(c, "fasta", make)


@query(
    "I2_sequences",
    """SELECT coalesce(e.organism_id, i.organism_id) AS organism_id, coalesce(e.uniquename, i.id) AS uniquename,
 CASE WHEN i.id IS NULL THEN c.name WHEN i.type IN ('contig', 'region') THEN i.type ELSE 'supercontig' END AS type,
 cast(length(coalesce(i.residues, e.residues)) AS bigint) AS seqlen, coalesce(i.residues, e.residues) AS residues,
 CASE WHEN e.feature_id IS NULL THEN 'insert' WHEN i.id IS NULL THEN 'keep' ELSE 'update' END AS action
FROM (feature e JOIN cvterm c ON e.type_id = c.cvterm_id) FULL OUTER JOIN in_seq i
 ON e.organism_id = i.organism_id AND e.uniquename = i.id""",
    I2,
)
def _(c):
    types = c.tables["cvterm"].select(F.col("cvterm_id").alias("type_id"), F.col("name").alias("type"))
    return sequence_import(c).merges["feature"].join(types, "type_id").select(
        "organism_id", "uniquename", "type", "seqlen", "residues", F.col("_action").alias("action")
    )


@query(
    "I2_top_level_flags",
    """SELECT uniquename FROM feature f JOIN featureprop p ON p.feature_id = f.feature_id WHERE p.type_id = 15
UNION SELECT id FROM in_seq""",
    I2,
)
def _(c):
    result = sequence_import(c)
    names = merge.applied(result.merges["feature"]).select("feature_id", "uniquename")
    flags = merge.applied(result.merges["featureprop"]).where("type_id = 15")
    return flags.join(names, "feature_id").select("uniquename")


@query("I2_rejects", "SELECT organism_id, id, type AS item, 'unknown sequence type' AS reason FROM in_seq WHERE type = 'unheard'", I2)
def _(c):
    return sequence_import(c).rejects


# -- I3: associations --------------------------------------------------------
# One line per transcript and protein annotation, in file order (ord).

UID = "'G' || cast(o AS string) || '.' || cast(l AS string)"
I3 = {
    **H,
    "in_gaf": f"""SELECT n, 10 * gene_id + l AS ord, CASE WHEN o % 31 = 5 THEN 'lost' || cast(o AS string)
  WHEN l % 2 = 0 THEN {UID} ELSE {UID} || ':pep' END AS id,
 CASE WHEN o % 4 = 0 THEN '' WHEN o % 4 = 1 THEN 'G' || cast(o AS string) ELSE 'sym' || cast(o AS string) || cast(l AS string) END AS symbol,
 CASE WHEN l % 3 = 0 THEN 'NOT|contributes_to' WHEN l % 3 = 1 THEN 'NOTABLE' ELSE '' END AS qualifier,
 CASE WHEN o % 29 = 3 THEN 'GO:absent' WHEN o % 37 = 3 THEN 'QQ:1' ELSE 'GO:' || lpad(cast(suppkey AS string), 7, '0') END AS go,
 'PMID:' || lpad(cast(partkey AS string), 7, '0') AS pm1,
 CASE WHEN l % 2 = 1 THEN 'GO_REF:000000' || cast(l AS string) END AS ref, CASE WHEN o % 5 = 1 THEN 'thesis' || cast(o AS string) END AS pm2,
 CASE l % 3 WHEN 0 THEN 'IDA' WHEN 1 THEN 'ISO' ELSE 'none' END AS ev, CASE WHEN o % 3 = 0 THEN 'UniProtKB:P' || cast(o AS string) END AS withs,
 CASE WHEN o % 17 = 4 THEN 'bad' END AS withbad,
 CASE WHEN l % 4 = 1 THEN 'product ' || cast(o % 40 AS string) WHEN l % 4 = 2 THEN 'second product' ELSE '' END AS product,
 CASE WHEN o % 6 = 1 THEN 'gsyn' || cast(o AS string) END AS gsyn, CASE WHEN o % 4 = 1 THEN 'syn' || cast(o AS string) END AS gsyn2,
 ymd AS annotated, CASE WHEN o % 2 = 0 THEN 'Us' ELSE 'Them' END AS assigned FROM fx_model""",
    # Every record with the feature it names, its protein and its gene.
    "in_loc": """SELECT i.*, f.feature_id, coalesce(fa.protein_id, f.feature_id) AS target_id, ga.gene_id FROM in_gaf i
JOIN feature f ON f.organism_id = i.n AND f.uniquename = i.id JOIN family fa ON fa.feature_id = f.feature_id
JOIN family ga ON ga.feature_id = coalesce(fa.protein_id, f.feature_id)""",
    "in_ont": """SELECT i.*, c.cvterm_id FROM in_loc i JOIN dbxref d ON 'GO:' || d.accession = i.go AND d.db_id = 7
JOIN cvterm c ON c.dbxref_id = d.dbxref_id""",
    "in_prod": """SELECT target_id, arg_min(product, ord) AS product, arg_min(pm1, ord) AS pm1, min(ord) AS ord
FROM in_loc GROUP BY target_id""",
}



def association_import(c):
    def make():
        rows = c.view("SELECT i.*, abbreviation AS organism FROM in_gaf i JOIN organism ON n = organism_id", I3)
        cells = {
            "DB": F.lit("Db"), "DB_Object_ID": F.col("id"), "DB_Object_Symbol": F.col("symbol"), "Qualifier": F.col("qualifier"),
            "GO_ID": F.col("go"), "DB:Reference": F.concat_ws("|", "ref", "pm1", "pm2"), "Evidence": F.col("ev"),
            "With": F.concat_ws("|", "withs", "withbad"), "Aspect": F.lit("P"), "DB_Object_Name": F.col("product"),
            "Synonym": F.concat_ws("|", "gsyn", "gsyn2"), "DB_Object_Type": F.lit("gene"), "Taxon_ID": F.lit("taxon:1"),
            "Date": F.col("annotated"), "Assigned_By": F.col("assigned"),
        }
        line = F.concat_ws("\t", *[cells[name] for name in GAF_COLUMNS])
        head = c.tables["organism"].select(F.col("abbreviation").alias("organism"), F.lit(-1).cast("long").alias("ord"), F.lit("!gaf-version: 1.0").alias("value"))
        lines = rows.select("organism", F.col("ord").cast("long").alias("ord"), line.alias("value")).unionByName(head)
        path = scratch_path(c.spark, "gaf-in")
        # Files are cut by place, so that no task holds an organism.
        lines.repartitionByRange("organism", "ord").sortWithinPartitions("organism", "ord").select(
            "organism", "value").write.partitionBy("organism").option("compression", "gzip").text(path)
        records = gaf_source.read_gaf(c.spark, path, ["organism"])
        names = c.tables["organism"].select("organism_id", F.col("abbreviation").alias("organism"))
        return gaf_import.import_gaf(c.tables, records.join(names, "organism"), "protein")

    return _once(c, "gaf", make)


@query(
    "I3a_rejects",
    """SELECT n AS organism_id, id, id AS item, 'unknown feature' AS reason FROM in_gaf WHERE id LIKE 'lost%'
UNION ALL SELECT n, id, go, 'unknown accession' FROM in_loc WHERE go = 'GO:absent'
UNION ALL SELECT n, id, go, 'unknown database' FROM in_loc WHERE go = 'QQ:1'
UNION ALL SELECT n, id, withbad, 'malformed cross reference' FROM in_ont WHERE withbad IS NOT NULL""",
    I3,
)
def _(c):
    return association_import(c).rejects


@query(
    "I3b_gene_names",
    """SELECT f.uniquename, coalesce(s.symbol, f.name) AS name,
 CASE WHEN s.symbol IS NOT NULL AND s.symbol IS DISTINCT FROM f.name THEN 'update' ELSE 'keep' END AS action FROM feature f
LEFT JOIN (SELECT i.gene_id, arg_max(i.symbol, i.ord) AS symbol FROM in_loc i JOIN feature g ON g.feature_id = i.gene_id
 WHERE i.symbol <> '' AND i.symbol <> g.uniquename GROUP BY i.gene_id) s ON s.gene_id = f.feature_id""",
    I3,
)
def _(c):
    return association_import(c).merges["feature"].select("uniquename", "name", F.col("_action").alias("action"))


@query(
    "I3_gene_synonyms",
    """SELECT fs.feature_id, s.name AS synonym FROM feature_synonym fs JOIN synonym s ON fs.synonym_id = s.synonym_id
UNION SELECT gene_id, gsyn FROM in_loc WHERE gsyn IS NOT NULL UNION SELECT gene_id, gsyn2 FROM in_loc WHERE gsyn2 IS NOT NULL""",
    I3,
)
def _(c):
    result = association_import(c)
    names = merge.applied(result.merges["synonym"]).select("synonym_id", F.col("name").alias("synonym"))
    return merge.applied(result.merges["feature_synonym"]).join(names, "synonym_id").select("feature_id", "synonym")




@query(
    "I3c_products",
    f"""SELECT fc.feature_id, c.name AS product, 'keep' AS action, p.uniquename AS publication FROM feature_cvterm fc
JOIN cvterm c ON fc.cvterm_id = c.cvterm_id JOIN pub p ON fc.pub_id = p.pub_id WHERE c.cv_id = 4
UNION ALL SELECT target_id, product, 'insert', pm1 FROM in_prod WHERE product <> ''""",
    I3,
)
def _(c):
    result = association_import(c)
    terms = merge.applied(result.merges["cvterm"]).where("cv_id = 4").select("cvterm_id", F.col("name").alias("product"))
    pubs = merge.applied(result.merges["pub"]).select("pub_id", F.col("uniquename").alias("publication"))
    rows = result.merges["feature_cvterm"].join(terms, "cvterm_id").join(pubs, "pub_id")
    return rows.select("feature_id", "product", F.when(F.col("_action") == "insert", "insert").otherwise("keep").alias("action"), "publication")


@query(
    "I3c_new_product_terms",
    """SELECT DISTINCT product AS name, 'PRODUCT' AS db, product AS accession FROM in_prod WHERE product <> ''""",
    I3,
)
def _(c):
    result = association_import(c)
    db = merge.applied(result.merges["db"]).select("db_id", F.col("name").alias("db"))
    xref = merge.applied(result.merges["dbxref"]).select("dbxref_id", "db_id", "accession").join(db, "db_id")
    new = result.merges["cvterm"].where("_action = 'insert'")
    return new.join(xref, "dbxref_id").select("name", "db", "accession")


ONTOLOGY = """SELECT e.feature_id, e.cvterm_id, CASE WHEN e.is_not IS DISTINCT FROM coalesce(i.is_not, e.is_not) THEN i.is_not ELSE e.is_not END AS is_not,
 CASE WHEN i.is_not IS NOT NULL AND i.is_not <> e.is_not THEN 'update' ELSE 'keep' END AS action
FROM (SELECT fc.* FROM feature_cvterm fc JOIN cvterm c ON fc.cvterm_id = c.cvterm_id WHERE c.cv_id IN (8, 9, 10)) e
LEFT JOIN (SELECT target_id, cvterm_id, arg_max(qualifier LIKE 'NOT|%', ord) AS is_not FROM in_ont GROUP BY 1, 2) i
 ON i.target_id = e.feature_id AND i.cvterm_id = e.cvterm_id
UNION ALL SELECT target_id, cvterm_id, arg_max(qualifier LIKE 'NOT|%', ord), 'insert' FROM in_ont i WHERE NOT EXISTS (
 SELECT 1 FROM feature_cvterm e WHERE e.feature_id = i.target_id AND e.cvterm_id = i.cvterm_id) GROUP BY 1, 2"""


@query("I3d_ontology_terms", ONTOLOGY, I3)
def _(c):
    ontology = c.tables["cvterm"].where("cv_id in (8, 9, 10)").select("cvterm_id")
    rows = association_import(c).merges["feature_cvterm"].join(ontology, "cvterm_id", "left_semi")
    return rows.select("feature_id", "cvterm_id", "is_not", F.col("_action").alias("action"))


I3["in_fc"] = """SELECT i.*, fc.feature_cvterm_id FROM in_ont i LEFT JOIN feature_cvterm fc
 ON fc.feature_id = i.target_id AND fc.cvterm_id = i.cvterm_id"""


@query(
    "I3e_annotation_properties",
    """SELECT target_id, cvterm_id, arg_max(annotated, ord) AS annotated, arg_max(CASE ev WHEN 'IDA' THEN 'Inferred from Direct Assay'
 WHEN 'ISO' THEN 'Inferred from Sequence Orthology' ELSE '' END, ord) AS evidence, arg_max(assigned, ord) AS assigned
FROM in_ont GROUP BY target_id, cvterm_id""",
    I3,
)
def _(c):
    result = association_import(c)
    props = result.merges["feature_cvtermprop"].where("_touched")
    pick = lambda i, name: F.max(F.when(F.col("type_id") == i, F.col("value"))).alias(name)
    wide = props.groupBy("feature_cvterm_id").agg(pick(14, "annotated"), pick(16, "evidence"), pick(18, "assigned"))
    ids = merge.applied(result.merges["feature_cvterm"]).select("feature_cvterm_id", F.col("feature_id").alias("target_id"), "cvterm_id")
    return wide.join(ids, "feature_cvterm_id").select("target_id", "cvterm_id", "annotated", "evidence", "assigned")


@query(
    "I3f_cross_references",
    """SELECT target_id, cvterm_id, withs AS xref FROM in_ont WHERE withs IS NOT NULL
UNION SELECT target_id, cvterm_id, ref FROM in_ont WHERE ref IS NOT NULL
UNION SELECT fc.feature_id, fc.cvterm_id, db.name || ':' || d.accession FROM feature_cvterm_dbxref x
JOIN feature_cvterm fc ON x.feature_cvterm_id = fc.feature_cvterm_id JOIN dbxref d ON x.dbxref_id = d.dbxref_id
JOIN db ON d.db_id = db.db_id""",
    I3,
)
def _(c):
    result = association_import(c)
    db = merge.applied(result.merges["db"]).select("db_id", F.col("name").alias("db"))
    xref = merge.applied(result.merges["dbxref"]).select("dbxref_id", "db_id", "accession").join(db, "db_id")
    ids = merge.applied(result.merges["feature_cvterm"]).select("feature_cvterm_id", F.col("feature_id").alias("target_id"), "cvterm_id")
    rows = merge.applied(result.merges["feature_cvterm_dbxref"]).join(xref, "dbxref_id").join(ids, "feature_cvterm_id")
    return rows.select("target_id", "cvterm_id", F.concat_ws(":", "db", "accession").alias("xref"))


@query(
    "I3f_secondary_publications",
    """SELECT target_id, cvterm_id, pm2 AS publication FROM in_ont WHERE pm2 IS NOT NULL
UNION SELECT fc.feature_id, fc.cvterm_id, p.uniquename FROM feature_cvterm_pub x
JOIN feature_cvterm fc ON x.feature_cvterm_id = fc.feature_cvterm_id JOIN pub p ON x.pub_id = p.pub_id""",
    I3,
)
def _(c):
    result = association_import(c)
    pubs = merge.applied(result.merges["pub"]).select("pub_id", F.col("uniquename").alias("publication"))
    ids = merge.applied(result.merges["feature_cvterm"]).select("feature_cvterm_id", F.col("feature_id").alias("target_id"), "cvterm_id")
    rows = merge.applied(result.merges["feature_cvterm_pub"]).join(pubs, "pub_id").join(ids, "feature_cvterm_id")
    return rows.select("target_id", "cvterm_id", "publication")


# -- I5, M1: organisms --------------------------------------------------------
# One organism per supplier: some known, some new, some with half-known names.

I5 = {"in_org": """SELECT CASE WHEN s % 5 = 0 THEN o.genus ELSE 'Novum' END AS genus,
 CASE WHEN s % 5 = 0 THEN o.species ELSE 'species' || cast(s AS string) END AS species,
 CASE WHEN s % 5 = 0 THEN o.infraspecific_name WHEN s % 5 = 2 THEN 'st' END AS infraspecific_name,
 CASE WHEN s % 5 = 0 AND s % 3 <> 1 THEN o.abbreviation WHEN s % 5 = 1 AND s < 25 THEN o.abbreviation ELSE 'ORG' || cast(s AS string) END
  AS abbreviation,
 CASE WHEN s % 2 = 0 THEN 'common ' || cast(s AS string) END AS common_name, cast(NULL AS string) AS comment,
 CASE WHEN s % 3 = 0 THEN 'w' || cast(s AS string) END AS genome_version,
 CASE WHEN s % 4 < 2 THEN cast(9000 + s AS string) END AS taxon_id, CASE WHEN s % 7 < 4 THEN 'Q' || cast(s AS string) END AS wikidata_id
FROM (SELECT s_suppkey AS s FROM {supplier}) q JOIN organism o ON o.organism_id = q.s % 25 WHERE s < 25 OR s % 5 <> 0""",
      "in_match": """SELECT i.*, a.organism_id AS by_name, b.organism_id AS by_abbr FROM in_org i
LEFT JOIN organism a ON a.genus = i.genus AND a.species = i.species
 AND a.infraspecific_name IS NOT DISTINCT FROM i.infraspecific_name
LEFT JOIN organism b ON b.abbreviation = i.abbreviation"""}


def organism_import(c):
    return _once(c, "organism", lambda: organisms.insert_organisms(c.tables, c.view("SELECT * FROM in_org", I5)))


@query(
    "M1_organisms",
    """SELECT e.abbreviation, coalesce(m.common_name, e.common_name) AS common_name, e.species,
 CASE WHEN m.common_name IS NOT NULL AND m.common_name <> e.common_name THEN 'update' ELSE 'keep' END AS action FROM organism e
LEFT JOIN (SELECT by_name, coalesce(common_name, abbreviation) AS common_name FROM in_match
 WHERE by_name IS NOT NULL AND by_abbr IS NOT NULL) m ON m.by_name = e.organism_id
UNION ALL SELECT abbreviation, coalesce(common_name, abbreviation), species, 'insert' FROM in_match
WHERE by_name IS NULL AND by_abbr IS NULL""",
    I5,
)
def _(c):
    return organism_import(c).merges["organism"].select("abbreviation", "common_name", "species", F.col("_action").alias("action"))


@query(
    "I5_conflicts",
    """SELECT coalesce(by_name, by_abbr) AS organism_id, abbreviation AS id FROM in_match
WHERE (by_name IS NULL) <> (by_abbr IS NULL)""",
    I5,
)
def _(c):
    return organism_import(c).rejects.select("organism_id", "id")


@query(
    "I5_organism_properties",
    """SELECT o.abbreviation, c.name AS property, p.value FROM (SELECT organism_id, type_id, value FROM organismprop p
 WHERE NOT EXISTS (SELECT 1 FROM in_match m WHERE coalesce(by_name, by_abbr) = p.organism_id
  AND ((p.type_id = 19 AND genome_version IS NOT NULL) OR (p.type_id = 23 AND taxon_id IS NOT NULL)))) p
JOIN organism o ON o.organism_id = p.organism_id JOIN cvterm c ON p.type_id = c.cvterm_id
UNION ALL SELECT coalesce(o.abbreviation, m.abbreviation), 'version', max(m.genome_version) FROM in_match m LEFT JOIN organism o
 ON o.organism_id = coalesce(by_name, by_abbr) WHERE genome_version IS NOT NULL GROUP BY 1
UNION ALL SELECT coalesce(o.abbreviation, m.abbreviation), 'taxonId', max(m.taxon_id) FROM in_match m LEFT JOIN organism o
 ON o.organism_id = coalesce(by_name, by_abbr) WHERE taxon_id IS NOT NULL GROUP BY 1""",
    I5,
)
def _(c):
    result = organism_import(c)
    names = merge.applied(result.merges["organism"]).select("organism_id", "abbreviation")
    types = c.tables["cvterm"].select(F.col("cvterm_id").alias("type_id"), F.col("name").alias("property"))
    rows = merge.applied(result.merges["organismprop"]).join(names, "organism_id").join(types, "type_id")
    return rows.select("abbreviation", "property", "value")


@query(
    "I5_organism_xrefs",
    """SELECT o.abbreviation, d.accession FROM organism_dbxref x JOIN organism o ON x.organism_id = o.organism_id
JOIN dbxref d ON x.dbxref_id = d.dbxref_id UNION SELECT coalesce(o.abbreviation, m.abbreviation), m.wikidata_id FROM in_match m
LEFT JOIN organism o ON o.organism_id = coalesce(by_name, by_abbr) WHERE wikidata_id IS NOT NULL""",
    I5,
)
def _(c):
    result = organism_import(c)
    names = merge.applied(result.merges["organism"]).select("organism_id", "abbreviation")
    xref = merge.applied(result.merges["dbxref"]).select("dbxref_id", "accession")
    rows = merge.applied(result.merges["organism_dbxref"]).join(names, "organism_id").join(xref, "dbxref_id")
    return rows.select("abbreviation", "accession")


SEEDED = [
    ("synonym_type", "internal", ["exact", "narrow", "broad", "related"]),
    ("cvterm_property_type", "internal", ["comment", "is_anonymous", "is_transitive", "is_anti_symmetric", "is_reflexive",
                                          "is_symmetric", "is_cyclic", "intersection_of", "disjoint_from"]),
    ("genedb_synonym_type", "genedb_misc", ["systematic_id", "temporary_systematic_id"]),
    ("genedb_misc", "genedb_misc", ["colour"]),
]


@query(
    "S13_seed",
    "SELECT c.name, cv.name AS vocabulary FROM cvterm c JOIN cv ON c.cv_id = cv.cv_id UNION SELECT name, vocabulary FROM (VALUES "
    + ", ".join(f"('{t}', '{cv}')" for cv, _, names in SEEDED for t in names) + ") v(name, vocabulary)",
)
def _(c):
    result = organisms.seed(c.tables)
    cv = merge.applied(result.merges["cv"]).select("cv_id", F.col("name").alias("vocabulary"))
    return merge.applied(result.merges["cvterm"]).join(cv, "cv_id").select("name", "vocabulary")
