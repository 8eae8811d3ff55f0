"""Reports (Q), report files (K1, K2), lookups (L) and hierarchy (H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe import terms
from helixframe.operators import hierarchy, lookups
from helixframe.plans import reports
from helixframe.sinks import delimited
from verification.registry import query

# -- Q: reports ------------------------------------------------------------

Q = {}
Q["wikidata"] = """SELECT od.organism_id, d.accession FROM organism_dbxref od JOIN dbxref d ON od.dbxref_id = d.dbxref_id
JOIN db ON db.db_id = d.db_id WHERE db.name = 'Wikidata'"""
Q["model"] = """SELECT r1.subject_id AS product_id, t.uniquename AS transcript_id, t.is_obsolete AS t_obsolete,
 g.uniquename AS gene_id, g.name AS gene_name, g.is_obsolete AS g_obsolete, g.organism_id,
 o.abbreviation AS organism_name, gt.name AS gene_type
FROM feature_relationship r1 JOIN cvterm c1 ON r1.type_id = c1.cvterm_id AND c1.name = 'derives_from'
JOIN feature t ON r1.object_id = t.feature_id
JOIN feature_relationship r2 ON r2.subject_id = t.feature_id
JOIN cvterm c2 ON r2.type_id = c2.cvterm_id AND c2.name = 'part_of'
JOIN feature g ON r2.object_id = g.feature_id JOIN cvterm gt ON g.type_id = gt.cvterm_id
JOIN organism o ON g.organism_id = o.organism_id"""
Q["public_org"] = "SELECT organism_id FROM organismprop JOIN cvterm ON type_id = cvterm_id WHERE name = 'genedb_public'"
Q["organism_report"] = """SELECT o.abbreviation, o.genus, o.species, o.infraspecific_name AS strain, o.common_name,
 v.value AS version, x.value AS taxon_id, w.accession AS wikidata_id, o.organism_id FROM organism o
LEFT JOIN wikidata w ON w.organism_id = o.organism_id
LEFT JOIN (SELECT organism_id, value FROM organismprop JOIN cvterm ON type_id = cvterm_id WHERE name = 'version') v
 ON v.organism_id = o.organism_id
LEFT JOIN (SELECT organism_id, value FROM organismprop JOIN cvterm ON type_id = cvterm_id WHERE name = 'taxonId') x
 ON x.organism_id = o.organism_id WHERE o.abbreviation <> 'dummy'"""
Q["product_report"] = """SELECT m.organism_name, m.transcript_id, m.gene_id, m.gene_name, c.name AS product,
 fc.rank AS rankalternative, m.organism_id FROM feature_cvterm fc JOIN cvterm c ON fc.cvterm_id = c.cvterm_id
JOIN cv ON c.cv_id = cv.cv_id JOIN model m ON m.product_id = fc.feature_id
WHERE cv.name = 'genedb_products' AND NOT m.t_obsolete"""
Q["update_report"] = """SELECT m.organism_name, m.transcript_id, m.gene_id, p2.value AS "date", p1.value AS annotation,
 m.organism_id FROM feature_cvterm fc JOIN cvterm c ON fc.cvterm_id = c.cvterm_id JOIN cv ON c.cv_id = cv.cv_id
JOIN feature_cvtermprop p1 ON p1.feature_cvterm_id = fc.feature_cvterm_id
JOIN cvterm t1 ON p1.type_id = t1.cvterm_id AND t1.name = 'qualifier'
JOIN feature_cvtermprop p2 ON p2.feature_cvterm_id = fc.feature_cvterm_id
JOIN cvterm t2 ON p2.type_id = t2.cvterm_id AND t2.name = 'date'
JOIN model m ON m.product_id = fc.feature_id WHERE cv.name = 'annotation_change' AND p1.value <> ''"""
Q["comment_report"] = """SELECT m.gene_id, m.transcript_id, p.value AS curator_comment, m.organism_id, m.organism_name
FROM featureprop p JOIN cvterm c ON p.type_id = c.cvterm_id JOIN model m ON m.product_id = p.feature_id
WHERE c.name IN ('comment', 'curation') AND m.gene_type IN ('gene', 'pseudogene') AND NOT m.g_obsolete"""

ORG = "abbreviation, genus, species, strain, common_name, version, taxon_id, wikidata_id"
PROD = "organism_name, transcript_id, gene_id, gene_name, product, rankalternative"
UPD = 'organism_name, transcript_id, gene_id, "date", annotation'
COM = "gene_id, transcript_id, curator_comment"
BETWEEN = "\"date\" >= '19960101' AND \"date\" <= '19971231'"


def public(name: str, columns: str) -> str:
    return f"SELECT {columns} FROM {name} JOIN public_org p ON p.organism_id = {name}.organism_id"


@query("Q1_organisms", f"SELECT {ORG} FROM organism_report", Q)
def _(c):
    return reports.organisms(c.tables)


@query("Q2_public_organisms", public("organism_report", ORG), Q)
def _(c):
    return reports.organisms(c.tables, public=True)


TERMS = """SELECT c.name, c.definition, c.is_obsolete, c.is_relationshiptype, cv.name AS vocabulary,
db.name AS xref_database, d.accession AS xref_accession, d.version AS xref_version
FROM cvterm c JOIN cv ON c.cv_id = cv.cv_id JOIN dbxref d ON c.dbxref_id = d.dbxref_id JOIN db ON d.db_id = db.db_id"""


@query("Q3_cvterms", TERMS)
def _(c):
    return reports.vocabulary_terms(c.tables)


@query("Q4_gene_products", f"SELECT {PROD} FROM product_report", Q)
def _(c):
    return reports.gene_products(c.tables)


@query("Q5_public_gene_products", public("product_report", PROD), Q)
def _(c):
    return reports.gene_products(c.tables, public=True)


@query("Q6_annotation_updates", f"SELECT {UPD} FROM update_report WHERE {BETWEEN}", Q)
def _(c):
    return reports.annotation_updates(c.tables, "19960101", "19971231")


@query("Q7_public_annotation_updates", public("update_report", UPD) + f" WHERE {BETWEEN}", Q)
def _(c):
    return reports.annotation_updates(c.tables, "19960101", "19971231", public=True)


@query("Q8_curator_comments", f"SELECT {COM} FROM comment_report", Q)
def _(c):
    return reports.curator_comments(c.tables)


@query("Q9_public_curator_comments", public("comment_report", COM), Q)
def _(c):
    return reports.curator_comments(c.tables, public=True)


@query("Q10_terms_of_vocabulary_and_db", TERMS + " WHERE cv.name = 'genedb_products' AND db.name = 'PRODUCT'")
def _(c):
    return reports.vocabulary_terms(c.tables, vocabulary="genedb_products", database="PRODUCT")


@query("Q10_products_of_organism", f"SELECT {PROD} FROM product_report WHERE organism_name = 'NATION_3'", Q)
def _(c):
    return reports.gene_products(c.tables, organism="NATION_3")


@query("Q10_comments_of_organism", f"SELECT {COM} FROM comment_report WHERE organism_name = 'NATION_4'", Q)
def _(c):
    return reports.curator_comments(c.tables, organism="NATION_4")


@query("Q11_updates_until_today", f"SELECT {UPD} FROM update_report WHERE \"date\" >= '20000101'", Q)
def _(c):
    return reports.annotation_updates(c.tables, "20000101")


@query(
    "Q12_ad_hoc_sql",
    """SELECT o.abbreviation, c.name AS type, count(*) AS n_features FROM feature f JOIN organism o
ON f.organism_id = o.organism_id JOIN cvterm c ON f.type_id = c.cvterm_id WHERE c.name <> 'gene'
GROUP BY o.abbreviation, c.name""",
)
def _(c):
    text = """SELECT o.abbreviation, c.name AS type, count(*) AS n_features FROM feature f
        JOIN organism o USING (organism_id) JOIN cvterm c ON f.type_id = c.cvterm_id
        WHERE c.name <> :without GROUP BY o.abbreviation, c.name"""
    return reports.ad_hoc(c.tables, text, ["feature", "organism", "cvterm"], without="gene")


# -- K1, K2: report files --------------------------------------------------


@query(
    "K1_delimited_rows",
    """SELECT uniquename || ';' || coalesce(name, '') || ';' || CASE WHEN is_obsolete THEN 't' ELSE 'f' END
 || ';' || coalesce(cast(seqlen AS string), '') AS value FROM feature""",
)
def _(c):
    return delimited.delimited_lines(c.tables["feature"].select("uniquename", "name", "is_obsolete", "seqlen"), ";")


@query(
    "K2_json_rows",
    """SELECT '{{"gene_id":"' || gene_id || '","gene_name":' || coalesce('"' || gene_name || '"', 'null')
 || ',"rankalternative":' || cast(rankalternative AS string) || '}}' AS value FROM product_report""",
    Q,
)
def _(c):
    rows = reports.gene_products(c.tables).select("rankalternative", "gene_name", "gene_id")
    return delimited.json_lines(rows)


# -- L: lookups ------------------------------------------------------------


@query(
    "L1_relationships_by_type",
    "SELECT r.subject_id, r.object_id, c.name AS type FROM feature_relationship r JOIN cvterm c ON r.type_id = c.cvterm_id"
    " WHERE c.name = 'derives_from'",
)
def _(c):
    return lookups.relationships_by_type(c.tables, ["derives_from"]).select(
        "subject_id", "object_id", F.lit("derives_from").alias("type")
    )


@query(
    "L2_properties_by_type",
    "SELECT p.feature_id, p.value, p.rank FROM featureprop p JOIN cvterm c ON p.type_id = c.cvterm_id"
    " WHERE c.name IN ('comment', 'description', 'score', 'source')",
)
def _(c):
    return lookups.properties_by_type(c.tables, terms.PROPERTY_TYPES).select("feature_id", "value", "rank")


@query(
    "L3_synonyms_by_type",
    "SELECT fs.feature_id, fs.synonym_id, fs.is_current FROM feature_synonym fs JOIN synonym s"
    " ON fs.synonym_id = s.synonym_id JOIN cvterm c ON s.type_id = c.cvterm_id WHERE c.name IN ('synonym', 'alias')",
)
def _(c):
    return lookups.synonyms_by_type(c.tables, ["synonym", "alias"]).select("feature_id", "synonym_id", "is_current")


GO = """SELECT fc.feature_cvterm_id, fc.feature_id, f.organism_id, fc.is_not FROM feature_cvterm fc
JOIN feature f ON fc.feature_id = f.feature_id JOIN cvterm c ON fc.cvterm_id = c.cvterm_id
JOIN dbxref d ON c.dbxref_id = d.dbxref_id JOIN db ON d.db_id = db.db_id WHERE db.name = 'GO'"""


@query("L4_annotations_by_ontology", f"SELECT feature_cvterm_id, feature_id, is_not FROM ({GO}) g")
def _(c):
    return lookups.annotations_by_ontology(c.tables, "GO").select("feature_cvterm_id", "feature_id", "is_not")


@query("L5_annotations_by_ontology_and_organism", GO + " AND f.organism_id = 3")
def _(c):
    return lookups.annotations_by_ontology_and_organism(c.tables, "GO", "NATION_3").select(
        "feature_cvterm_id", "feature_id", "organism_id", "is_not"
    )


@query(
    "L6_parent_features",
    "SELECT r.subject_id, f.uniquename AS parent, f.is_obsolete AS parent_obsolete FROM feature_relationship r JOIN feature f"
    " ON r.object_id = f.feature_id JOIN cvterm c ON r.type_id = c.cvterm_id WHERE c.name IN ('part_of', 'derives_from')",
)
def _(c):
    return lookups.parents(c.tables).select("subject_id", "parent", "parent_obsolete").orderBy("subject_id", "parent")


@query(
    "L7_child_features",
    "SELECT r.object_id, f.uniquename AS child FROM feature_relationship r JOIN feature f"
    " ON r.subject_id = f.feature_id JOIN cvterm c ON r.type_id = c.cvterm_id WHERE c.name = 'part_of'",
)
def _(c):
    return lookups.children(c.tables, "part_of").select("object_id", "child").orderBy("object_id", "child")


@query(
    "L8_features_on_sequence",
    "SELECT l.srcfeature_id, l.fmin, f.uniquename FROM featureloc l JOIN feature f ON l.feature_id = f.feature_id",
)
def _(c):
    return lookups.features_on_sequence(c.tables).select("srcfeature_id", "fmin", "uniquename").orderBy(
        "srcfeature_id", "fmin", "uniquename"
    )


@query(
    "L9_features_with_property",
    "SELECT DISTINCT f.uniquename, f.seqlen FROM feature f JOIN featureprop p ON p.feature_id = f.feature_id"
    " JOIN cvterm c ON p.type_id = c.cvterm_id WHERE c.name = 'comment'",
)
def _(c):
    return lookups.features_with_property(c.tables, "comment").select("uniquename", "seqlen")


@query(
    "L10_features_by_type",
    "SELECT f.organism_id, f.uniquename FROM feature f JOIN cvterm c ON f.type_id = c.cvterm_id"
    " WHERE c.name IN ('gene', 'pseudogene')",
)
def _(c):
    return lookups.features_by_type(c.tables, ["gene", "pseudogene"]).select("organism_id", "uniquename")


PROTEINS = """SELECT DISTINCT p.feature_id, p.uniquename FROM feature p
JOIN feature_relationship r1 ON r1.subject_id = p.feature_id JOIN feature_relationship r2 ON r2.subject_id = r1.object_id
JOIN feature g ON r2.object_id = g.feature_id WHERE r1.type_id = 7 AND r2.type_id = 8 AND g.type_id = 1"""


@query("L11_protein_features", PROTEINS)
def _(c):
    return lookups.protein_features(c.tables).select("feature_id", "uniquename")


@query(
    "L12_feature_properties",
    "SELECT p.feature_id, c.name AS property, p.value FROM featureprop p JOIN cvterm c ON p.type_id = c.cvterm_id",
)
def _(c):
    return lookups.feature_properties(c.tables).select("feature_id", "property", "value")


@query(
    "L13_feature_publications",
    "SELECT fp.feature_id, p.uniquename AS publication FROM feature_pub fp JOIN pub p ON fp.pub_id = p.pub_id",
)
def _(c):
    return lookups.feature_publications(c.tables).select("feature_id", "publication")


XREF = "JOIN dbxref d ON x.dbxref_id = d.dbxref_id JOIN db ON d.db_id = db.db_id"


@query("L14_feature_cross_references", f"SELECT x.feature_id, db.name AS db, d.accession FROM feature_dbxref x {XREF}")
def _(c):
    return lookups.feature_cross_references(c.tables).select("feature_id", "db", "accession")


@query(
    "L15_feature_synonyms",
    "SELECT fs.feature_id, c.name AS synonym_type, s.name AS synonym FROM feature_synonym fs JOIN synonym s"
    " ON fs.synonym_id = s.synonym_id JOIN cvterm c ON s.type_id = c.cvterm_id",
)
def _(c):
    return lookups.feature_synonyms(c.tables).select("feature_id", "synonym_type", "synonym")


@query(
    "L16_feature_ontology_terms",
    "SELECT fc.feature_id, db.name AS db, d.accession FROM feature_cvterm fc JOIN cvterm x ON fc.cvterm_id = x.cvterm_id"
    f" {XREF} WHERE db.name = 'GO'",
)
def _(c):
    return lookups.feature_ontology_terms(c.tables, "GO").select("feature_id", "db", "accession")


@query(
    "L17_annotation_properties",
    "SELECT p.feature_cvterm_id, c.name AS property, p.value FROM feature_cvtermprop p JOIN cvterm c"
    " ON p.type_id = c.cvterm_id",
)
def _(c):
    return lookups.annotation_properties(c.tables).select("feature_cvterm_id", "property", "value")


@query(
    "L18_annotation_primary_publications",
    "SELECT fc.feature_cvterm_id, p.uniquename AS publication FROM feature_cvterm fc JOIN pub p ON fc.pub_id = p.pub_id",
)
def _(c):
    return lookups.annotation_primary_publications(c.tables).select("feature_cvterm_id", "publication")


@query(
    "L19_annotation_secondary_publications",
    "SELECT fc.feature_cvterm_id, p.uniquename AS publication FROM feature_cvterm_pub fc JOIN pub p"
    " ON fc.pub_id = p.pub_id",
)
def _(c):
    return lookups.annotation_secondary_publications(c.tables).select("feature_cvterm_id", "publication")


@query(
    "L20_annotation_cross_references",
    f"SELECT x.feature_cvterm_id, db.name AS db, d.accession FROM feature_cvterm_dbxref x {XREF}",
)
def _(c):
    return lookups.annotation_cross_references(c.tables).select("feature_cvterm_id", "db", "accession")


@query(
    "L21_annotation_ontology_terms",
    "SELECT fc.feature_cvterm_id, db.name AS db, d.accession FROM feature_cvterm fc JOIN cvterm x"
    f" ON fc.cvterm_id = x.cvterm_id {XREF} WHERE db.name = 'GO'",
)
def _(c):
    return lookups.annotation_ontology_terms(c.tables, "GO").select("feature_cvterm_id", "db", "accession")


@query("L22_term_vocabularies", "SELECT c.cvterm_id, cv.name AS vocabulary FROM cvterm c JOIN cv ON c.cv_id = cv.cv_id")
def _(c):
    return lookups.term_vocabularies(c.tables)


REQUIRED = (
    "SELECT p_name || ' ' || p_brand || ' #' || cast(p_partkey + p_partkey % 2 AS string) AS name, "
    "'genedb_products' AS cv, 0 AS relationship FROM {part}"
)


@query(
    "L23_missing_terms",
    f"""SELECT r.name, r.cv FROM ({REQUIRED}) r WHERE NOT EXISTS (SELECT 1 FROM cvterm c JOIN cv ON c.cv_id = cv.cv_id
WHERE c.name = r.name AND cv.name = r.cv AND c.is_relationshiptype = r.relationship)""",
)
def _(c):
    return lookups.missing_terms(c.tables, c.view(REQUIRED)).select("name", "cv")


# -- H: hierarchy ----------------------------------------------------------

H = {
    "f_kind": """SELECT f.feature_id, f.uniquename, CASE WHEN lower(c.name) IN ('gene', 'pseudogene') THEN 'gene'
 WHEN lower(c.name) IN ('mrna','rrna','trna','snrna','ncrna','scrna','snorna','pseudogenic_transcript') THEN 'transcript'
 WHEN lower(c.name) = 'polypeptide' THEN 'protein' END AS kind FROM feature f JOIN cvterm c ON f.type_id = c.cvterm_id""",
    "up_part": """SELECT subject_id AS k, object_id AS v FROM (SELECT r.subject_id, r.object_id, row_number() OVER (
 PARTITION BY r.subject_id ORDER BY f.uniquename) AS n FROM feature_relationship r JOIN feature f
 ON r.object_id = f.feature_id WHERE r.type_id = 8) q WHERE n = 1""",
    "up_derives": """SELECT subject_id AS k, object_id AS v FROM (SELECT r.subject_id, r.object_id, row_number() OVER (
 PARTITION BY r.subject_id ORDER BY f.uniquename) AS n FROM feature_relationship r JOIN feature f
 ON r.object_id = f.feature_id WHERE r.type_id = 7) q WHERE n = 1""",
    "down_part": """SELECT object_id AS k, subject_id AS v FROM (SELECT r.subject_id, r.object_id, row_number() OVER (
 PARTITION BY r.object_id ORDER BY f.uniquename) AS n FROM feature_relationship r JOIN feature f
 ON r.subject_id = f.feature_id WHERE r.type_id = 8) q WHERE n = 1""",
    "down_derives": """SELECT object_id AS k, subject_id AS v FROM (SELECT r.subject_id, r.object_id, row_number() OVER (
 PARTITION BY r.object_id ORDER BY f.uniquename) AS n FROM feature_relationship r JOIN feature f
 ON r.subject_id = f.feature_id WHERE r.type_id = 7) q WHERE n = 1""",
    "family": """SELECT f.feature_id, f.kind,
 CASE f.kind WHEN 'gene' THEN f.feature_id WHEN 'transcript' THEN tp.v WHEN 'protein' THEN pp.v END AS gene_id,
 CASE f.kind WHEN 'gene' THEN gt.v WHEN 'transcript' THEN f.feature_id WHEN 'protein' THEN pd.v END AS transcript_id,
 CASE f.kind WHEN 'gene' THEN gd.v WHEN 'transcript' THEN td.v WHEN 'protein' THEN f.feature_id END AS protein_id
FROM f_kind f LEFT JOIN up_part tp ON tp.k = f.feature_id LEFT JOIN up_derives pd ON pd.k = f.feature_id
LEFT JOIN up_part pp ON pp.k = pd.v LEFT JOIN down_part gt ON gt.k = f.feature_id
LEFT JOIN down_derives gd ON gd.k = gt.v LEFT JOIN down_derives td ON td.k = f.feature_id""",
}


def _kinds(c):
    return hierarchy.with_kind(c.tables, c.tables["feature"].select("feature_id", "type_id")).drop("type_id")


@query("H1_gene_of_feature", "SELECT feature_id, kind, gene_id FROM family", H)
def _(c):
    return hierarchy.gene_of(c.tables, _kinds(c))


@query("H2_transcript_of_feature", "SELECT feature_id, kind, transcript_id FROM family", H)
def _(c):
    return hierarchy.transcript_of(c.tables, _kinds(c))


@query("H3_protein_of_feature", "SELECT feature_id, kind, protein_id FROM family", H)
def _(c):
    return hierarchy.protein_of(c.tables, _kinds(c))


@query("H4_annotation_level", "SELECT feature_id, coalesce(protein_id, feature_id) AS target_id FROM family", H)
def _(c):
    return hierarchy.at_level(c.tables, _kinds(c), "protein").select("feature_id", "target_id")


@query(
    "H5_root_features",
    "SELECT uniquename FROM feature WHERE feature_id NOT IN (SELECT subject_id FROM feature_relationship)",
)
def _(c):
    return hierarchy.roots(c.tables).select("uniquename")


TREE = """RECURSIVE, walk AS (
SELECT f.uniquename AS sequence, f.feature_id, f.uniquename AS name, cast(NULL AS string) AS parent,
 '0' AS walk_path, 0 AS depth FROM feature f JOIN featureprop p ON p.feature_id = f.feature_id WHERE p.type_id = 15
UNION ALL
SELECT s.uniquename, f.feature_id, f.uniquename, cast(NULL AS string),
 '1|' || lpad(cast(l.fmin AS string), 12, '0') || '|' || f.uniquename, 0
FROM feature f JOIN featureloc l ON l.feature_id = f.feature_id JOIN feature s ON l.srcfeature_id = s.feature_id
JOIN featureprop p ON p.feature_id = s.feature_id AND p.type_id = 15
WHERE NOT f.is_obsolete AND f.feature_id NOT IN (SELECT subject_id FROM feature_relationship)
UNION ALL
SELECT w.sequence, f.feature_id, f.uniquename, w.name,
 w.walk_path || ' > ' || CASE r.type_id WHEN 8 THEN '0' ELSE '1' END || '|' || f.uniquename, w.depth + 1
FROM walk w JOIN feature_relationship r ON r.object_id = w.feature_id JOIN feature f ON r.subject_id = f.feature_id
WHERE NOT f.is_obsolete)
SELECT sequence, name, parent, walk_path, cast(depth AS bigint) AS depth FROM walk"""


@query("H6_feature_tree", TREE)
def _(c):
    walk = hierarchy.tree(c.tables)
    place = lambda s: F.concat_ws("|", s["place"].cast("string"), s["name"])
    first = F.when(F.col("path")[0]["place"] == 0, F.lit("0")).otherwise(
        F.concat_ws("|", F.lit("1"), F.lpad(F.col("path")[0]["start"].cast("string"), 12, "0"), F.col("path")[0]["name"])
    )
    rest = F.transform(F.expr("slice(path, 2, size(path))"), place)
    return walk.orderBy("sequence", "path").select(
        "sequence", F.element_at("path", -1)["name"].alias("name"), "parent",
        F.concat_ws(" > ", F.concat(F.array(first), rest)).alias("walk_path"), F.col("depth").cast("long").alias("depth"),
    )
