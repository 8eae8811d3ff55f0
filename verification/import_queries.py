"""File sources (S1-S6, S11, S13) and imports."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.operators import merge
from helixframe.plans import gff_import
from helixframe.sources import gff
from verification import gff_files
from verification.registry import query

GFF = gff_files.VIEWS

# -- S1-S3: reading feature files -------------------------------------------


@query(
    "S1_gff_records",
    """SELECT o.abbreviation AS organism, r.uid AS id, r.seqid, r.source, r.type, r.start_, r.end_, r.score, r.strand,
 r.phase, r.name, r.parent, r.xref2, r.alias2, r.cmt FROM in_named r JOIN organism o ON r.n = o.organism_id""",
    GFF,
)
def _(c):
    before, _ = gff.annotation_lines(gff_files.gff_lines(c))
    rec = gff.parse_records(before, ["organism"])
    last = lambda key: F.try_element_at(gff.attribute_values(key), F.lit(-1))
    second = lambda key, mark: F.get(F.filter(gff.attribute_values(key), lambda v: F.startswith(v, F.lit(mark))), F.lit(0))
    return rec.select(
        "organism", "id", "seqid", "source", "type", F.col("start").alias("start_"), F.col("end").alias("end_"), "score",
        "strand", "phase", gff.first_value("Name").alias("name"), last("Parent").alias("parent"),
        second("Dbxref", "NEWDB").alias("xref2"), second("Alias", "extra").alias("alias2"),
        F.try_element_at(gff.attribute_values("comment"), F.lit(1)).alias("cmt"),
    )


@query(
    "S2_sequence_names",
    "SELECT abbreviation AS organism, 'chr' || cast(organism_id AS string) AS name FROM organism",
)
def _(c):
    return gff.sequence_names(gff_files.gff_lines(c), ["organism"])


@query(
    "S3_embedded_sequences",
    """SELECT o.abbreviation AS organism, f.uniquename AS id, f.residues FROM feature f JOIN organism o
ON f.organism_id = o.organism_id WHERE f.type_id = 4 AND o.organism_id % 2 = 0""",
)
def _(c):
    return gff.embedded_sequences(gff_files.gff_lines(c), group=["organism"]).select("organism", "id", "residues")


# -- I1: feature import ------------------------------------------------------

_RESULTS = {}


def gff_result(c):
    key = (c.spark.sparkContext.applicationId, c.sf_dir)
    if key not in _RESULTS:
        lines = gff_files.gff_lines(c)
        before, _ = gff.annotation_lines(lines)
        records = gff_import.with_organism(c.tables, gff.parse_records(before, ["organism"]))
        names = gff_import.with_organism(c.tables, gff.sequence_names(lines, ["organism"]))
        _RESULTS[key] = gff_import.import_gff(
            c.tables, records, full_genome=True, full_attributes=True, sequence_names=names
        )
    return _RESULTS[key]


IN_FEATURE = """SELECT n, uid, max(name) AS name, max(type) AS type, max(upper(translation)) AS residues,
 max(coalesce(cast(length(translation) AS bigint), cast(size_ AS bigint))) AS seqlen FROM in_typed GROUP BY n, uid
UNION ALL SELECT n, uid, NULL, 'polypeptide', NULL, NULL FROM in_protein"""


@query(
    "I1_features",
    f"""SELECT coalesce(e.organism_id, i.n) AS organism_id, coalesce(e.uniquename, i.uid) AS uniquename,
 coalesce(i.name, e.name) AS name, coalesce(i.type, c.name) AS type, coalesce(i.residues, e.residues) AS residues,
 coalesce(i.seqlen, e.seqlen) AS seqlen,
 CASE WHEN i.uid IS NOT NULL THEN false WHEN e.uniquename LIKE 'chr%' THEN e.is_obsolete ELSE true END AS is_obsolete,
 CASE WHEN e.feature_id IS NULL THEN 'insert'
  WHEN i.uid IS NULL THEN CASE WHEN e.is_obsolete OR e.uniquename LIKE 'chr%' THEN 'keep' ELSE 'update' END
  WHEN e.is_obsolete OR i.type <> c.name OR (i.name IS NOT NULL AND i.name IS DISTINCT FROM e.name)
   OR (i.residues IS NOT NULL AND i.residues IS DISTINCT FROM e.residues)
   OR (i.seqlen IS NOT NULL AND i.seqlen IS DISTINCT FROM e.seqlen) THEN 'update' ELSE 'keep' END AS action
FROM (feature e JOIN cvterm c ON e.type_id = c.cvterm_id) FULL OUTER JOIN ({IN_FEATURE}) i
 ON e.organism_id = i.n AND e.uniquename = i.uid""",
    GFF,
)
def _(c):
    types = c.tables["cvterm"].select(F.col("cvterm_id").alias("type_id"), F.col("name").alias("type"))
    return gff_result(c).merges["feature"].join(types, "type_id").select(
        "organism_id", "uniquename", "name", "type", "residues", "seqlen", "is_obsolete", F.col("_action").alias("action")
    )


@query(
    "I1_rejects",
    """SELECT n AS organism_id, uid AS id, type AS item, 'unknown feature type' AS reason FROM in_named
 WHERE type = 'mystery' UNION ALL
SELECT n, uid, seqid, 'unknown sequence' FROM in_typed WHERE seqid = 'chrX' UNION ALL
SELECT n, uid, parent, 'unknown parent feature' FROM in_typed WHERE parent LIKE 'missing%' UNION ALL
SELECT n, uid, xref, 'malformed cross reference' FROM in_typed WHERE xref = 'broken' UNION ALL
SELECT n, uid, ont, 'unknown database' FROM in_typed WHERE ont = 'XX:1' UNION ALL
SELECT n, uid, ont, 'unknown accession' FROM in_typed WHERE ont LIKE 'GO:%'
 AND replace(ont, 'GO:', '') NOT IN (SELECT accession FROM dbxref WHERE db_id = 7)""",
    GFF,
)
def _(c):
    return gff_result(c).rejects


@query(
    "I1j_unknown_attributes",
    "SELECT n AS organism_id, uid AS id, 'colour' AS attribute FROM in_typed WHERE colour IS NOT NULL",
    GFF,
)
def _(c):
    return gff_result(c).reports["unknown_attributes"]


IN_LOC = """SELECT n, uid, seqid, start_, end_, strand, phase FROM in_typed WHERE seqid <> 'chrX'
UNION ALL SELECT n, uid, seqid, start_, end_, strand, '.' FROM in_protein WHERE seqid <> 'chrX'"""


@query(
    "I1b_locations",
    f"""SELECT coalesce(f.organism_id, i.n) AS organism_id, coalesce(f.uniquename, i.uid) AS uniquename,
 coalesce(i.start_ - 1, l.fmin) AS fmin, coalesce(i.end_, l.fmax) AS fmax,
 coalesce(CASE i.strand WHEN '+' THEN 1 WHEN '-' THEN -1 END, l.strand) AS strand,
 cast(CASE WHEN i.phase = '0' THEN 0 END AS int) AS phase,
 CASE WHEN l.featureloc_id IS NULL THEN 'insert' WHEN i.start_ - 1 <> l.fmin THEN 'update' ELSE 'keep' END AS action
FROM (featureloc l JOIN feature f ON l.feature_id = f.feature_id) FULL OUTER JOIN ({IN_LOC}) i
 ON f.organism_id = i.n AND f.uniquename = i.uid""",
    GFF,
)
def _(c):
    return _named(c, gff_result(c).merges["featureloc"]).select(
        "organism_id", "uniquename", "fmin", "fmax", F.col("strand").cast("int").alias("strand"), "phase",
        F.col("_action").alias("action"),
    )


@query(
    "H7_implied_proteins",
    """SELECT p.n AS organism_id, p.uid AS uniquename, p.derives AS transcript, l.start_ - 1 AS fmin FROM in_protein p
LEFT JOIN in_protein l ON l.n = p.n AND l.uid = p.uid AND l.seqid <> 'chrX'""",
    GFF,
)
def _(c):
    result = gff_result(c)
    names = result.features
    made = result.merges["feature"].where("_action = 'insert' and uniquename like 'PG%'").select(
        F.col("feature_id").alias("subject_id"), "organism_id", "uniquename"
    )
    loc = result.merges["featureloc"].select(F.col("feature_id").alias("subject_id"), "fmin")
    edges = result.merges["feature_relationship"].select("subject_id", F.col("object_id").alias("feature_id"))
    tx = names.select("feature_id", F.col("uniquename").alias("transcript"))
    return made.join(edges, "subject_id").join(tx, "feature_id").join(loc, "subject_id", "left").select(
        "organism_id", "uniquename", "transcript", "fmin"
    )


def _named(c, merged):
    return merged.join(gff_result(c).features, "feature_id")


# Attribute tables after the import: rows the file has (matched or new), rows of
# features or kinds the file does not speak about, and deleted rows.
IN_UIDS = "(SELECT n, uid FROM in_typed UNION SELECT n, uid FROM in_protein)"


def _diff(table: str, existing: str, incoming: str, key: list[str], scope: str) -> str:
    """Expected (organism_id, uniquename, key..., action) of a keyed attribute table."""
    same = " AND ".join(f"e.{k} IS NOT DISTINCT FROM i.{k}" for k in key)
    cols = lambda p: ", ".join(f"{p}.{k}" for k in key)
    return f"""SELECT e.organism_id, e.uniquename, {cols('e')},
 CASE WHEN i.uid IS NOT NULL THEN 'keep' WHEN u.uid IS NOT NULL AND ({scope}) THEN 'delete' ELSE 'keep' END AS action
FROM ({existing}) e LEFT JOIN (SELECT DISTINCT * FROM ({incoming})) i ON e.organism_id = i.n AND e.uniquename = i.uid
 AND {same} LEFT JOIN {IN_UIDS} u ON u.n = e.organism_id AND u.uid = e.uniquename
UNION ALL SELECT i.n, i.uid, {cols('i')}, 'insert' FROM (SELECT DISTINCT * FROM ({incoming})) i
WHERE NOT EXISTS (SELECT 1 FROM ({existing}) e WHERE e.organism_id = i.n AND e.uniquename = i.uid AND {same})"""


SYN = _diff(
    "feature_synonym",
    """SELECT f.organism_id, f.uniquename, c.name AS synonym_type, s.name AS synonym FROM feature_synonym fs
JOIN feature f ON fs.feature_id = f.feature_id JOIN synonym s ON fs.synonym_id = s.synonym_id
JOIN cvterm c ON s.type_id = c.cvterm_id""",
    """SELECT n, uid, 'alias' AS synonym_type, alias AS synonym FROM in_typed WHERE alias IS NOT NULL UNION ALL
SELECT n, uid, 'alias', alias2 FROM in_typed WHERE alias2 IS NOT NULL UNION ALL
SELECT n, uid, 'synonym', syn FROM in_typed WHERE syn IS NOT NULL UNION ALL
SELECT n, uid, 'previous_systematic_id', prev FROM in_typed WHERE prev IS NOT NULL""",
    ["synonym_type", "synonym"], "true",
)
# A matching synonym is updated when the file says current or not: o % 8 = 1 (true) and 5 (false), stored false.
SYN = f"""SELECT organism_id, uniquename, synonym_type, synonym,
 CASE WHEN synonym_type = 'synonym' AND action = 'keep' AND cast(substr(uniquename, 2) AS bigint) % 8 = 1
  AND EXISTS (SELECT 1 FROM in_typed t WHERE t.n = organism_id AND t.uid = uniquename) THEN 'update' ELSE action END
 AS action FROM ({SYN}) q"""


@query("I1c_synonyms", SYN, GFF)
def _(c):
    result = gff_result(c)
    synonyms = merge.applied(result.merges["synonym"]).select("synonym_id", "type_id", F.col("name").alias("synonym"))
    types = c.tables["cvterm"].select(F.col("cvterm_id").alias("type_id"), F.col("name").alias("synonym_type"))
    rows = result.merges["feature_synonym"].join(synonyms, "synonym_id").join(types, "type_id")
    return _named(c, rows).select("organism_id", "uniquename", "synonym_type", "synonym", F.col("_action").alias("action"))


@query("D5_deleted_synonyms", f"SELECT organism_id, uniquename, synonym FROM ({SYN}) q WHERE action = 'delete'", GFF)
def _(c):
    result = gff_result(c)
    gone = result.merges["feature_synonym"].where("_action = 'delete'")
    synonyms = c.tables["synonym"].select("synonym_id", F.col("name").alias("synonym"))
    return _named(c, gone.join(synonyms, "synonym_id")).select("organism_id", "uniquename", "synonym")


EX_PROP = """SELECT f.organism_id, f.uniquename, c.name AS property, p.value FROM featureprop p JOIN feature f
ON p.feature_id = f.feature_id JOIN cvterm c ON p.type_id = c.cvterm_id"""
PROP = _diff(
    "featureprop", EX_PROP,
    """SELECT n, uid, 'comment' AS property, coalesce(note, cmt) AS value FROM in_typed
 WHERE note IS NOT NULL OR cmt IS NOT NULL UNION ALL
SELECT n, uid, 'score', score FROM in_typed WHERE score <> '.' UNION ALL
SELECT n, uid, 'source', source FROM in_typed WHERE source <> '.'""",
    ["property", "value"], "e.property IN ('comment', 'description', 'score', 'source')",
)


@query("I1d_properties", PROP, GFF)
def _(c):
    types = c.tables["cvterm"].select(F.col("cvterm_id").alias("type_id"), F.col("name").alias("property"))
    rows = _named(c, gff_result(c).merges["featureprop"].join(types, "type_id"))
    return rows.select("organism_id", "uniquename", "property", "value", F.col("_action").alias("action"))


@query("D1_deleted_properties", f"SELECT organism_id, uniquename, property, value FROM ({PROP}) q WHERE action = 'delete'", GFF)
def _(c):
    types = c.tables["cvterm"].select(F.col("cvterm_id").alias("type_id"), F.col("name").alias("property"))
    gone = gff_result(c).merges["featureprop"].where("_action = 'delete'")
    return _named(c, gone.join(types, "type_id")).select("organism_id", "uniquename", "property", "value")


@query(
    "I1d_new_ranks",
    f"""SELECT organism_id, uniquename, property, value, cast(coalesce(top + 1, 0) AS int) AS rank FROM ({PROP}) q
LEFT JOIN (SELECT f.organism_id AS o, f.uniquename AS u, c.name AS p, max(rank) AS top FROM featureprop x
 JOIN feature f ON x.feature_id = f.feature_id JOIN cvterm c ON x.type_id = c.cvterm_id GROUP BY 1, 2, 3) m
 ON m.o = organism_id AND m.u = uniquename AND m.p = property WHERE action = 'insert'""",
    GFF,
)
def _(c):
    types = c.tables["cvterm"].select(F.col("cvterm_id").alias("type_id"), F.col("name").alias("property"))
    new = gff_result(c).merges["featureprop"].where("_action = 'insert'")
    return _named(c, new.join(types, "type_id")).select("organism_id", "uniquename", "property", "value", "rank")


XREF = _diff(
    "feature_dbxref",
    """SELECT f.organism_id, f.uniquename, db.name AS db, d.accession FROM feature_dbxref x JOIN feature f
ON x.feature_id = f.feature_id JOIN dbxref d ON x.dbxref_id = d.dbxref_id JOIN db ON d.db_id = db.db_id""",
    """SELECT n, uid, 'UniProtKB' AS db, replace(xref, 'UniProtKB:', '') AS accession FROM in_typed
 WHERE xref LIKE 'UniProtKB:%' UNION ALL
SELECT n, uid, 'NEWDB', replace(replace(xref2, 'NEWDB:', ''), ':2', '') FROM in_typed WHERE xref2 IS NOT NULL""",
    ["db", "accession"], "true",
)


def _xref_names(result):
    dbs = merge.applied(result.merges["db"]).select("db_id", F.col("name").alias("db"))
    return merge.applied(result.merges["dbxref"]).select("dbxref_id", "db_id", "accession", "version").join(dbs, "db_id")


@query("I1f_cross_references", XREF, GFF)
def _(c):
    result = gff_result(c)
    rows = _named(c, result.merges["feature_dbxref"].join(_xref_names(result), "dbxref_id"))
    return rows.select("organism_id", "uniquename", "db", "accession", F.col("_action").alias("action"))


@query(
    "I1f_new_dbxrefs",
    """SELECT DISTINCT 'NEWDB' AS db, replace(replace(xref2, 'NEWDB:', ''), ':2', '') AS accession, '2' AS version
FROM in_typed WHERE xref2 IS NOT NULL""",
    GFF,
)
def _(c):
    result = gff_result(c)
    new = result.merges["dbxref"].where("_action = 'insert'").select("dbxref_id")
    return _xref_names(result).join(new, "dbxref_id", "left_semi").select("db", "accession", "version")


@query("D2_deleted_cross_references", f"SELECT organism_id, uniquename, db, accession FROM ({XREF}) q WHERE action = 'delete'", GFF)
def _(c):
    result = gff_result(c)
    gone = result.merges["feature_dbxref"].where("_action = 'delete'")
    return _named(c, gone.join(_xref_names(result), "dbxref_id")).select("organism_id", "uniquename", "db", "accession")


ONT = _diff(
    "feature_cvterm",
    """SELECT f.organism_id, f.uniquename, db.name AS db, d.accession FROM feature_cvterm x JOIN feature f
ON x.feature_id = f.feature_id JOIN cvterm c ON x.cvterm_id = c.cvterm_id JOIN dbxref d ON c.dbxref_id = d.dbxref_id
JOIN db ON d.db_id = db.db_id""",
    """SELECT n, uid, 'GO' AS db, replace(ont, 'GO:', '') AS accession FROM in_typed WHERE ont LIKE 'GO:0%'
 AND replace(ont, 'GO:', '') IN (SELECT accession FROM dbxref WHERE db_id = 7)""",
    ["db", "accession"], "e.db = 'GO'",
)


@query("I1g_ontology_terms", ONT, GFF)
def _(c):
    result = gff_result(c)
    terms = c.tables["cvterm"].select("cvterm_id", "dbxref_id").join(_xref_names(result), "dbxref_id")
    rows = _named(c, result.merges["feature_cvterm"].join(terms, "cvterm_id"))
    return rows.select("organism_id", "uniquename", "db", "accession", F.col("_action").alias("action"))


@query("D3_deleted_ontology_terms", f"SELECT organism_id, uniquename, accession FROM ({ONT}) q WHERE action = 'delete'", GFF)
def _(c):
    result = gff_result(c)
    terms = c.tables["cvterm"].select("cvterm_id", "dbxref_id").join(_xref_names(result), "dbxref_id")
    gone = result.merges["feature_cvterm"].where("_action = 'delete'")
    return _named(c, gone.join(terms, "cvterm_id")).select("organism_id", "uniquename", "accession")


PUB = _diff(
    "feature_pub",
    """SELECT f.organism_id, f.uniquename, p.uniquename AS publication FROM feature_pub x JOIN feature f
ON x.feature_id = f.feature_id JOIN pub p ON x.pub_id = p.pub_id""",
    "SELECT n, uid, lit AS publication FROM in_typed WHERE lit IS NOT NULL",
    ["publication"], "true",
)


@query("I1h_publications", PUB, GFF)
def _(c):
    result = gff_result(c)
    pubs = merge.applied(result.merges["pub"]).select("pub_id", F.col("uniquename").alias("publication"))
    rows = _named(c, result.merges["feature_pub"].join(pubs, "pub_id"))
    return rows.select("organism_id", "uniquename", "publication", F.col("_action").alias("action"))


@query("D6_deleted_publications", f"SELECT organism_id, uniquename, publication FROM ({PUB}) q WHERE action = 'delete'", GFF)
def _(c):
    result = gff_result(c)
    pubs = c.tables["pub"].select("pub_id", F.col("uniquename").alias("publication"))
    gone = result.merges["feature_pub"].where("_action = 'delete'")
    return _named(c, gone.join(pubs, "pub_id")).select("organism_id", "uniquename", "publication")


REL = _diff(
    "feature_relationship",
    """SELECT f.organism_id, f.uniquename, c.name AS relationship, p.uniquename AS parent FROM feature_relationship x
JOIN feature f ON x.subject_id = f.feature_id JOIN feature p ON x.object_id = p.feature_id
JOIN cvterm c ON x.type_id = c.cvterm_id""",
    """SELECT n, uid, 'part_of' AS relationship, parent FROM in_typed WHERE parent NOT LIKE 'missing%' UNION ALL
SELECT n, uid, 'derives_from', derives FROM in_typed WHERE derives IS NOT NULL UNION ALL
SELECT n, uid, 'derives_from', derives FROM in_protein""",
    ["relationship", "parent"], "true",
)


def _relationships(c, merged):
    names = gff_result(c).features
    types = c.tables["cvterm"].select(F.col("cvterm_id").alias("type_id"), F.col("name").alias("relationship"))
    parent = names.select(F.col("feature_id").alias("object_id"), F.col("uniquename").alias("parent"))
    child = names.select(F.col("feature_id").alias("subject_id"), "organism_id", "uniquename")
    return merged.join(types, "type_id").join(parent, "object_id").join(child, "subject_id")


@query("I1e_relationships", REL, GFF)
def _(c):
    rows = _relationships(c, gff_result(c).merges["feature_relationship"])
    return rows.select("organism_id", "uniquename", "relationship", "parent", F.col("_action").alias("action"))


@query("D4_deleted_relationships", f"SELECT organism_id, uniquename, parent FROM ({REL}) q WHERE action = 'delete'", GFF)
def _(c):
    rows = _relationships(c, gff_result(c).merges["feature_relationship"].where("_action = 'delete'"))
    return rows.select("organism_id", "uniquename", "parent")
