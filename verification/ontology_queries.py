"""Ontology sources (S7-S9) and import."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.operators import merge
from helixframe.plans import ontology_import
from helixframe.session import scratch_path
from helixframe.sources import ontology as source
from verification.registry import query

PAD = "lpad(cast({x} AS string), 7, '0')"


def acc(x: str) -> str:
    return PAD.replace("{x}", x)


def fid(x: str) -> str:
    return f"'GO:' || {acc(x)} || CASE WHEN {x} % 16 = 7 THEN ':2' ELSE '' END"


HALF = "cast((s - s % 2) / 2 AS bigint)"
NONE = "cast(NULL AS string)"


def _term(where: str, **columns: str) -> str:
    base = {"id": NONE, "acc": NONE, "ver": "''", "name": NONE, "ns": NONE, "def": NONE, "cmt": NONE, "obs": "false",
            "syn1": NONE, "scope1": NONE, "syn2": NONE, "scope2": NONE, "xref1": NONE, "xref2": NONE, "alt": NONE,
            "isa": NONE, "isa2": NONE, "rel": NONE, "relobj": NONE}
    base.update(columns)
    return (f"SELECT {', '.join(f'{e} AS {c}' for c, e in base.items())} "
            f"FROM (SELECT s_suppkey AS s, s_name FROM {{supplier}}) q WHERE {where}")


SPACE = "CASE s % 3 WHEN 0 THEN 'biological_process' WHEN 1 THEN 'molecular_function' ELSE 'cellular_component' END"
O = {}
O["ob_term"] = "\nUNION ALL\n".join([
    _term(
        "s % 6 <> 5", id=fid("s"), acc=acc("s"), ver="CASE WHEN s % 16 = 7 THEN '2' ELSE '' END",
        name="CASE WHEN s % 10 = 9 THEN 'duplicate' WHEN s % 4 = 3 THEN s_name || ' v2' ELSE s_name END",
        ns=f"CASE WHEN s % 8 = 1 THEN NULL ELSE {SPACE} END",
        **{"def": "CASE WHEN s % 4 = 0 THEN NULL WHEN s % 4 = 1 THEN 'definition of ' || s_name"
                  " WHEN s % 12 = 6 THEN NULL ELSE 'new \"definition\" of ' || s_name END"},
        cmt="CASE WHEN s % 9 = 0 THEN 'changed comment' WHEN s % 6 = 0 THEN NULL WHEN s % 3 = 0 THEN 'comment '"
            " || cast(s AS string) WHEN s % 5 = 1 THEN 'added comment' END",
        obs="s % 10 = 9",
        syn1="CASE WHEN s % 2 = 0 AND s % 10 <> 4 THEN s_name || ' syn' END", scope1="'EXACT'",
        syn2="CASE WHEN s % 12 = 7 THEN 'odd' WHEN s % 3 = 1 THEN 'other, name' END",
        scope2="CASE WHEN s % 12 = 7 THEN 'STRANGE' ELSE 'NARROW' END",
        xref1="CASE WHEN s % 13 = 2 THEN 'bad' WHEN s % 10 = 0 THEN 'MetaCyc:M' || cast(s AS string) END",
        xref2="CASE WHEN s % 7 = 0 THEN 'NEWX:' || cast(s AS string) END",
        alt="CASE WHEN s % 11 = 0 THEN 'GO:8' || lpad(cast(s AS string), 6, '0') END",
        isa=f"CASE WHEN s > 1 AND s % 4 <> 1 THEN {fid(HALF)} END",
        isa2="CASE WHEN s % 19 = 3 THEN 'XX:1' END",
        rel="CASE WHEN s % 5 = 2 THEN 'part_of' WHEN s % 7 = 3 THEN 'regulates' WHEN s % 17 = 4 THEN 'strange_rel' END",
        relobj=fid("(s - 2)"),
    ),
    _term("s % 10 = 0", id="'GO:9' || lpad(cast(s AS string), 6, '0')", acc="'9' || lpad(cast(s AS string), 6, '0')",
          name="'new term ' || cast(s AS string)", ns="'biological_process'"),
    _term("s % 12 = 11", id="'GO:7' || lpad(cast(s AS string), 6, '0')", acc="'7' || lpad(cast(s AS string), 6, '0')",
          name="s_name", ns=SPACE),
])
O["ob_rel"] = """SELECT id, 'is_a' AS type, isa AS object FROM ob_term WHERE isa IS NOT NULL
UNION ALL SELECT id, 'is_a', isa2 FROM ob_term WHERE isa2 IS NOT NULL
UNION ALL SELECT id, rel, relobj FROM ob_term WHERE rel IS NOT NULL"""
O["ob_syn"] = """SELECT id, acc, syn1 AS syn, lower(scope1) AS scope FROM ob_term WHERE syn1 IS NOT NULL
UNION ALL SELECT id, acc, syn2, lower(scope2) FROM ob_term WHERE syn2 IS NOT NULL"""
O["ob_xref"] = """SELECT acc, alt AS xref FROM ob_term WHERE alt IS NOT NULL
UNION ALL SELECT acc, xref1 FROM ob_term WHERE xref1 IS NOT NULL AND xref1 <> 'bad'
UNION ALL SELECT acc, xref2 FROM ob_term WHERE xref2 IS NOT NULL"""

_FILES: dict[tuple, str] = {}


def _key(c, kind):
    return (c.spark.sparkContext.applicationId, c.sf_dir, kind)


def obo_file(c) -> str:
    """Write the terms as an OBO file of many stanzas."""
    if _key(c, "obo") not in _FILES:
        rows = c.view("SELECT * FROM ob_term", O)
        line = lambda tag, col: F.when(col.isNotNull(), F.concat(F.lit(f"{tag}: "), col))
        text = lambda col: F.concat(F.lit('"'), F.replace(col, F.lit('"'), F.lit('\\"')), F.lit('"'))
        synonym = lambda s, k: F.concat(text(F.col(s)), F.lit(" "), F.col(k), F.lit(" []"))
        stanza = F.concat_ws(
            "\n", F.lit("[Term]"), line("id", F.col("id")), line("name", F.col("name")), line("namespace", F.col("ns")),
            line("def", F.concat(text(F.col("def")), F.lit(" [ref:1]"))), line("comment", F.col("cmt")),
            line("synonym", synonym("syn1", "scope1")), line("synonym", synonym("syn2", "scope2")),
            line("xref", F.concat("xref1", F.lit(' "described"'))), line("xref", F.col("xref2")),
            line("alt_id", F.col("alt")), line("is_a", F.concat("isa", F.lit(" ! parent"))), line("is_a", F.col("isa2")),
            F.when(F.col("rel").isNotNull(), F.concat(F.lit("relationship: "), "rel", F.lit(" "), "relobj", F.lit(" ! it"))),
            F.when(F.col("obs"), F.lit("is_obsolete: true")), F.lit(""),
        )
        head = c.spark.range(1, numPartitions=1).select(F.explode(F.array(
            F.lit("format-version: 1.2\ndefault-namespace: gene_ontology\nontology: test\n"),
            F.lit("[Typedef]\nid: regulates\nname: regulates\n"), F.lit("[Typedef]\nid: part_of\nname: part of\n"),
            F.lit("[Term]\nid: XX:1\nname: foreign\n"),
        )).alias("value"))
        path = _FILES[_key(c, "obo")] = scratch_path(c.spark, "obo")
        head.union(rows.select(stanza.alias("value"))).write.text(path)
    return _FILES[_key(c, "obo")]


FLAT = """SELECT t.id, t.name, t.ns AS namespace, t."def" AS definition, t.cmt AS comment, t.obs AS is_obsolete,
 (SELECT string_agg(syn || '/' || scope, '|' ORDER BY syn) FROM ob_syn s WHERE s.id = t.id) AS synonyms,
 nullif(concat_ws('|', xref1, xref2), '') AS xrefs, alt AS alt_ids,
 (SELECT string_agg(type || ' ' || object, '|' ORDER BY type, object) FROM ob_rel r WHERE r.id = t.id) AS relations
FROM ob_term t"""


def _flat(terms):
    text = lambda col: F.when(F.size(col) > 0, F.array_join(col, "|"))
    return terms.select(
        "id", "name", "namespace", "definition", "comment", "is_obsolete",
        text(F.array_sort(F.transform("synonyms", lambda s: F.concat(s["text"], F.lit("/"), s["scope"])))).alias("synonyms"),
        text(F.col("xrefs")).alias("xrefs"), text(F.col("alt_ids")).alias("alt_ids"),
        text(F.array_sort(F.transform("relations", lambda r: F.concat(r["type"], F.lit(" "), r["object"])))).alias("relations"),
    )


FOREIGN = """ UNION ALL SELECT 'XX:1', 'foreign', NULL, NULL, NULL, false, NULL, NULL, NULL, NULL"""


@query("S7_obo_terms", FLAT + FOREIGN, O)
def _(c):
    return _flat(source.read_obo(c.spark, obo_file(c))[0])


@query("S9_terms_of_authority", f"SELECT id, name FROM ({FLAT}) q", O)
def _(c):
    return source.of_authority(source.read_obo(c.spark, obo_file(c))[0], "GO").select("id", "name")


# OWL has no versioned ids and no other synonym scopes.
OWL = {
    "ob_term": O["ob_term"].replace("CASE WHEN s % 16 = 7 THEN '2' ELSE '' END", "''"),
    "ob_rel": O["ob_rel"], "ob_syn": O["ob_syn"] + " AND scope2 <> 'STRANGE'",
}
for _x in ("s", HALF, "(s - 2)"):
    OWL["ob_term"] = OWL["ob_term"].replace(f" || CASE WHEN {_x} % 16 = 7 THEN ':2' ELSE '' END", "")


@query("S8_owl_terms", FLAT, OWL)
def _(c):
    rows = c.view("SELECT * FROM ob_term", OWL)
    esc = lambda col: F.replace(F.replace(col, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    tag = lambda name, col: F.when(col.isNotNull(), F.concat(F.lit(f"<{name}>"), esc(col), F.lit(f"</{name}>")))
    iri = lambda col: F.concat(F.lit("http://purl.obolibrary.org/obo/"), F.replace(col, F.lit(":"), F.lit("_")))
    is_a = lambda col: F.when(col.isNotNull(), F.concat(F.lit('<rdfs:subClassOf rdf:resource="'), iri(col), F.lit('"/>')))
    scope = lambda s, k: F.concat(*[
        F.coalesce(F.when(F.col(k) == name.upper(), tag(f"oboInOwl:has{name}Synonym", F.col(s))), F.lit(""))
        for name in ["Exact", "Narrow", "Broad", "Related"]
    ])
    xml = F.concat_ws(
        "\n", F.concat(F.lit('<owl:Class rdf:about="'), iri(F.col("id")), F.lit('">')), tag("rdfs:label", F.col("name")),
        tag("oboInOwl:hasOBONamespace", F.col("ns")), tag("obo:IAO_0000115", F.col("def")), tag("rdfs:comment", F.col("cmt")),
        F.when(F.col("obs"), F.lit("<owl:deprecated>true</owl:deprecated>")), scope("syn1", "scope1"), scope("syn2", "scope2"),
        tag("oboInOwl:hasDbXref", F.col("xref1")), tag("oboInOwl:hasDbXref", F.col("xref2")),
        tag("oboInOwl:hasAlternativeId", F.col("alt")), is_a(F.col("isa")), is_a(F.col("isa2")),
        F.when(F.col("rel").isNotNull(), F.concat(
            F.lit('<rdfs:subClassOf><owl:Restriction><owl:onProperty rdf:resource="http://purl.obolibrary.org/obo/go#'),
            F.col("rel"), F.lit('"/><owl:someValuesFrom rdf:resource="'), iri(F.col("relobj")),
            F.lit('"/></owl:Restriction></rdfs:subClassOf>'),
        )), F.lit("</owl:Class>"),
    )
    path = scratch_path(c.spark, "owl")
    rows.select(xml.alias("value")).write.text(path)
    return _flat(source.read_owl(c.spark, path))


_RESULTS = {}


def result(c):
    if _key(c, "result") not in _RESULTS:
        terms, typedefs, namespace = source.read_obo(c.spark, obo_file(c))
        _RESULTS[_key(c, "result")] = ontology_import.import_ontology(c.tables, terms, typedefs, namespace, "GO")
    return _RESULTS[_key(c, "result")]


# -- O: import ---------------------------------------------------------------

O["go_old"] = """SELECT c.*, d.accession, d.version, cv.name AS cv FROM cvterm c JOIN dbxref d ON c.dbxref_id = d.dbxref_id
JOIN cv ON c.cv_id = cv.cv_id WHERE d.db_id = 7"""
O["retired"] = """SELECT accession, cv, name, definition, row_number() OVER (PARTITION BY cv, name ORDER BY accession) AS n
FROM (SELECT acc AS accession, coalesce(ns, 'gene_ontology') AS cv, 'obsolete ' || name AS name, "def" AS definition
 FROM ob_term WHERE obs UNION ALL
 SELECT accession, cv, 'obsolete ' || name, definition FROM go_old WHERE accession NOT IN (SELECT acc FROM ob_term)) q"""
TERMS = """SELECT o.accession, coalesce(r.cv, f.cv, o.cv) AS vocabulary, coalesce(r.name, f.name) AS name,
 CASE WHEN r.accession IS NOT NULL THEN r.definition ELSE f.definition END AS definition,
 cast(coalesce(r.n, 0) AS int) AS is_obsolete,
 CASE WHEN f.accession IS NULL THEN 'obsolete' WHEN o.cv <> coalesce(r.cv, f.cv) OR o.name <> coalesce(r.name, f.name)
   OR o.definition IS DISTINCT FROM f.definition OR o.is_obsolete <> coalesce(r.n, 0) THEN 'update' ELSE 'keep' END AS action
FROM go_old o LEFT JOIN (SELECT acc AS accession, coalesce(ns, 'gene_ontology') AS cv, name, "def" AS definition FROM ob_term) f
 ON f.accession = o.accession LEFT JOIN retired r ON r.accession = o.accession
UNION ALL SELECT acc, coalesce(ns, 'gene_ontology'), name, "def", 0, 'insert' FROM ob_term
 WHERE acc NOT IN (SELECT accession FROM go_old)"""


def _terms(c):
    merges = result(c).merges
    xref = merge.applied(merges["dbxref"]).select("dbxref_id", "accession", "db_id")
    cv = merge.applied(merges["cv"]).select("cv_id", F.col("name").alias("vocabulary"))
    return merges["cvterm"].join(xref, "dbxref_id").join(cv, "cv_id")


@query("O2_terms", TERMS, O)
def _(c):
    return _terms(c).where("db_id = 7 and is_relationshiptype = 0").select(
        "accession", "vocabulary", "name", "definition", "is_obsolete", F.col("_action").alias("action")
    )


@query("O3_obsolete_terms", "SELECT accession, name, cast(n AS int) AS is_obsolete FROM retired", O)
def _(c):
    return _terms(c).where("db_id = 7 and is_obsolete > 0").select("accession", "name", "is_obsolete")


@query(
    "O1_dbxrefs",
    """SELECT d.accession, CASE WHEN f.acc IS NOT NULL AND f.ver <> d.version THEN f.ver ELSE d.version END AS version,
 CASE WHEN f.acc IS NOT NULL AND f.ver <> d.version THEN 'update' ELSE 'keep' END AS action
FROM dbxref d LEFT JOIN ob_term f ON f.acc = d.accession WHERE d.db_id = 7
UNION ALL SELECT acc, ver, 'insert' FROM ob_term WHERE acc NOT IN (SELECT accession FROM dbxref WHERE db_id = 7)
UNION ALL SELECT replace(alt, 'GO:', ''), '', 'insert' FROM ob_term WHERE alt IS NOT NULL
UNION ALL SELECT 'regulates', '', 'insert' FROM {region} WHERE r_regionkey = 0""",
    O,
)
def _(c):
    return result(c).merges["dbxref"].where("db_id = 7").select("accession", "version", F.col("_action").alias("action"))


@query(
    "O4_typedefs",
    """SELECT c.name, cv.name AS vocabulary, 'keep' AS action FROM cvterm c JOIN cv ON c.cv_id = cv.cv_id
WHERE is_relationshiptype = 1 UNION ALL SELECT 'regulates', 'gene_ontology', 'insert' FROM {region} WHERE r_regionkey = 0""",
)
def _(c):
    return _terms(c).where("is_relationshiptype = 1").select("name", "vocabulary", F.col("_action").alias("action"))


IN_FILE = "(SELECT acc FROM ob_term)"


def _accessions(c):
    merges = result(c).merges
    xref = merge.applied(merges["dbxref"]).where("db_id = 7").select("dbxref_id", "accession")
    return merge.applied(merges["cvterm"]).join(xref, "dbxref_id").select("cvterm_id", "accession")


@query(
    "O5_comments",
    f"""SELECT o.accession, coalesce(f.cmt, p.value) AS value,
 CASE WHEN f.acc IS NULL OR f.cmt = p.value THEN 'keep' WHEN f.cmt IS NULL THEN 'delete' ELSE 'update' END AS action
FROM cvtermprop p JOIN go_old o ON p.cvterm_id = o.cvterm_id LEFT JOIN ob_term f ON f.acc = o.accession
UNION ALL SELECT f.acc, f.cmt, 'insert' FROM ob_term f WHERE f.cmt IS NOT NULL AND f.acc NOT IN (
 SELECT o.accession FROM cvtermprop p JOIN go_old o ON p.cvterm_id = o.cvterm_id)""",
    O,
)
def _(c):
    rows = result(c).merges["cvtermprop"].join(_accessions(c), "cvterm_id")
    return rows.select("accession", "value", F.col("_action").alias("action"))


@query(
    "O6_synonyms",
    f"""SELECT o.accession, p.synonym, coalesce(s.scope, c.name) AS scope,
 CASE WHEN s.syn IS NOT NULL AND s.scope <> c.name THEN 'update' WHEN s.syn IS NOT NULL THEN 'keep'
  WHEN o.accession IN {IN_FILE} THEN 'delete' ELSE 'keep' END AS action
FROM cvtermsynonym p JOIN go_old o ON p.cvterm_id = o.cvterm_id JOIN cvterm c ON p.type_id = c.cvterm_id
LEFT JOIN ob_syn s ON s.acc = o.accession AND s.syn = p.synonym
UNION ALL SELECT s.acc, s.syn, s.scope, 'insert' FROM ob_syn s WHERE s.scope <> 'strange' AND NOT EXISTS (
 SELECT 1 FROM cvtermsynonym p JOIN go_old o ON p.cvterm_id = o.cvterm_id WHERE o.accession = s.acc AND p.synonym = s.syn)""",
    O,
)
def _(c):
    scopes = c.tables["cvterm"].select(F.col("cvterm_id").alias("type_id"), F.col("name").alias("scope"))
    rows = result(c).merges["cvtermsynonym"].join(_accessions(c), "cvterm_id").join(scopes, "type_id")
    return rows.select("accession", "synonym", "scope", F.col("_action").alias("action"))


@query(
    "O7_cross_references",
    f"""SELECT o.accession, db.name || ':' || d.accession AS xref, CASE WHEN x.acc IS NOT NULL THEN 'keep'
 WHEN o.accession IN {IN_FILE} THEN 'delete' ELSE 'keep' END AS action
FROM cvterm_dbxref p JOIN go_old o ON p.cvterm_id = o.cvterm_id JOIN dbxref d ON p.dbxref_id = d.dbxref_id
JOIN db ON d.db_id = db.db_id LEFT JOIN ob_xref x ON x.acc = o.accession AND x.xref = db.name || ':' || d.accession
UNION ALL SELECT x.acc, x.xref, 'insert' FROM ob_xref x WHERE NOT EXISTS (SELECT 1 FROM cvterm_dbxref p
 JOIN go_old o ON p.cvterm_id = o.cvterm_id JOIN dbxref d ON p.dbxref_id = d.dbxref_id JOIN db ON d.db_id = db.db_id
 WHERE o.accession = x.acc AND x.xref = db.name || ':' || d.accession)""",
    O,
)
def _(c):
    merges = result(c).merges
    db = merge.applied(merges["db"]).select("db_id", F.col("name").alias("db"))
    xref = merge.applied(merges["dbxref"]).select("dbxref_id", "db_id", F.col("accession").alias("a")).join(db, "db_id")
    rows = merges["cvterm_dbxref"].join(_accessions(c), "cvterm_id").join(xref, "dbxref_id")
    return rows.select("accession", F.concat_ws(":", "db", "a").alias("xref"), F.col("_action").alias("action"))


O["rel_new"] = """SELECT DISTINCT s.acc, r.type, t.acc AS object FROM ob_rel r JOIN ob_term s ON s.id = r.id
JOIN ob_term t ON t.id = r.object WHERE r.type IN ('is_a', 'part_of', 'regulates')"""


@query(
    "O8_relationships",
    f"""SELECT o.accession, 'is_a' AS type, b.accession AS object, CASE WHEN n.acc IS NOT NULL THEN 'keep'
 WHEN o.accession IN {IN_FILE} THEN 'delete' ELSE 'keep' END AS action
FROM cvterm_relationship p JOIN go_old o ON p.subject_id = o.cvterm_id JOIN go_old b ON p.object_id = b.cvterm_id
LEFT JOIN rel_new n ON n.acc = o.accession AND n.type = 'is_a' AND n.object = b.accession
UNION ALL SELECT acc, type, object, 'insert' FROM rel_new n WHERE NOT (type = 'is_a' AND EXISTS (
 SELECT 1 FROM cvterm_relationship p JOIN go_old o ON p.subject_id = o.cvterm_id JOIN go_old b ON p.object_id = b.cvterm_id
 WHERE o.accession = n.acc AND b.accession = n.object))""",
    O,
)
def _(c):
    merges = result(c).merges
    names = _accessions(c)
    types = merge.applied(merges["cvterm"]).select(F.col("cvterm_id").alias("type_id"), F.col("name").alias("type"))
    subject = names.withColumnRenamed("cvterm_id", "subject_id")
    objects = names.select(F.col("cvterm_id").alias("object_id"), F.col("accession").alias("object"))
    rows = merges["cvterm_relationship"].join(types, "type_id").join(subject, "subject_id").join(objects, "object_id")
    return rows.select("accession", "type", "object", F.col("_action").alias("action"))


@query(
    "O9_term_statistics",
    f"SELECT 'cvterm' AS table_name, action, count(*) AS n_rows FROM (SELECT action FROM ({TERMS}) q UNION ALL"
    " SELECT 'insert' FROM {region} WHERE r_regionkey = 0) a WHERE action <> 'keep' GROUP BY action",
    O,
)
def _(c):
    return ontology_import.statistics(result(c)).where("table_name = 'cvterm'")


@query(
    "O_rejects",
    """SELECT id, syn AS item, 'unknown synonym scope' AS reason FROM ob_syn WHERE scope = 'strange'
UNION ALL SELECT id, xref1, 'malformed cross reference' FROM ob_term WHERE xref1 = 'bad'
UNION ALL SELECT id, type, 'unknown relationship type' FROM ob_rel WHERE type = 'strange_rel'
UNION ALL SELECT id, object, 'related term not in the file' FROM ob_rel WHERE type <> 'strange_rel' AND object LIKE 'GO:%'
 AND object NOT IN (SELECT id FROM ob_term)""",
    O,
)
def _(c):
    return result(c).rejects
