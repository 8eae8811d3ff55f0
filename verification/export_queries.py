"""Exports (E1-E7, K3-K5) and the sources that read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.plans import fasta_export, gaf_export, gff_export
from helixframe.session import scratch_path
from helixframe.sinks.delimited import write_text
from helixframe.sources import fasta as fasta_source, gaf as gaf_source
from helixframe.sources.text import read_lines
from verification.registry import query
from verification.report_queries import H, PROTEINS

# -- E1: features ------------------------------------------------------------


def _enc(text: str) -> str:
    for char, code in [("%", "%25"), (";", "%3B"), ("=", "%3D"), ("&", "%26"), (",", "%2C")]:
        text = f"replace({text}, '{char}', '{code}')"
    return text


def _list(key: str, source: str, value: str, order: str) -> str:
    return f"""SELECT feature_id, '{key}=' || string_agg({_enc(value)}, ',' ORDER BY {order}) AS txt
FROM ({source}) q GROUP BY feature_id"""


SYNONYMS = """SELECT fs.feature_id, fs.feature_synonym_id, c.name AS type, s.name FROM feature_synonym fs
JOIN synonym s ON fs.synonym_id = s.synonym_id JOIN cvterm c ON s.type_id = c.cvterm_id"""
PROPS = """SELECT p.feature_id, c.name AS type, p.value, p.rank, p.featureprop_id FROM featureprop p
JOIN cvterm c ON p.type_id = c.cvterm_id"""
E1 = {
    "a_xref": _list("Dbxref", """SELECT x.feature_id, db.name AS db, d.accession FROM feature_dbxref x JOIN dbxref d
 ON x.dbxref_id = d.dbxref_id JOIN db ON d.db_id = db.db_id""", "db || ':' || accession", "db, accession"),
    "a_ont": _list("Ontology_term", """SELECT x.feature_id, d.accession FROM feature_cvterm x JOIN cvterm c
 ON x.cvterm_id = c.cvterm_id JOIN dbxref d ON c.dbxref_id = d.dbxref_id WHERE d.db_id = 7""",
                   "'GO:' || accession", "accession"),
    "a_alias": _list("Alias", f"SELECT * FROM ({SYNONYMS}) s WHERE type = 'alias'", "name", "name"),
    "a_syn": _list("synonym", f"SELECT * FROM ({SYNONYMS}) s WHERE type = 'synonym'", "name", "name"),
    "a_prev": _list("previous_systematic_id", f"SELECT * FROM ({SYNONYMS}) s WHERE type = 'previous_systematic_id'",
                    "name", "name"),
    "a_lit": _list("literature", "SELECT x.feature_id, p.uniquename FROM feature_pub x JOIN pub p ON x.pub_id = p.pub_id",
                   "uniquename", "uniquename"),
    "a_com": _list("comment", f"SELECT * FROM ({PROPS}) s WHERE type = 'comment'", "value", "rank"),
    "walked": """SELECT s.uniquename AS sequence, f.feature_id, NULL AS parent, NULL AS rel FROM feature f
 JOIN feature s ON s.feature_id = f.feature_id WHERE f.type_id = 4
UNION ALL SELECT s.uniquename, g.feature_id, NULL, NULL FROM feature g JOIN featureloc l ON l.feature_id = g.feature_id
 JOIN feature s ON l.srcfeature_id = s.feature_id WHERE g.type_id IN (1, 5) AND NOT g.is_obsolete
UNION ALL SELECT s.uniquename, t.feature_id, g.uniquename, 'Parent' FROM feature g JOIN featureloc l
 ON l.feature_id = g.feature_id JOIN feature s ON l.srcfeature_id = s.feature_id
 JOIN feature_relationship r ON r.object_id = g.feature_id JOIN feature t ON r.subject_id = t.feature_id
 WHERE g.type_id IN (1, 5) AND NOT g.is_obsolete AND NOT t.is_obsolete
UNION ALL SELECT s.uniquename, p.feature_id, t.uniquename, 'Derives_from' FROM feature g JOIN featureloc l
 ON l.feature_id = g.feature_id JOIN feature s ON l.srcfeature_id = s.feature_id
 JOIN feature_relationship r ON r.object_id = g.feature_id JOIN feature t ON r.subject_id = t.feature_id
 JOIN feature_relationship r2 ON r2.object_id = t.feature_id JOIN feature p ON r2.subject_id = p.feature_id
 WHERE g.type_id IN (1, 5) AND NOT g.is_obsolete AND NOT t.is_obsolete AND NOT p.is_obsolete""",
    "gff_line": f"""SELECT concat_ws(chr(9), w.sequence, coalesce(so.value, '.'), c.name,
 CASE WHEN l.feature_id IS NULL THEN '1' ELSE cast(l.fmin + 1 AS string) END,
 CASE WHEN l.feature_id IS NULL THEN cast(f.seqlen AS string) ELSE cast(l.fmax AS string) END, coalesce(sc.value, '.'),
 CASE WHEN l.strand > 0 THEN '+' WHEN l.strand < 0 THEN '-' ELSE '.' END, '.',
 concat_ws(';', 'ID=' || f.uniquename, 'Name=' || f.name, w.rel || '=' || w.parent, a1.txt, a2.txt, a3.txt, a4.txt, a5.txt,
  a6.txt, a7.txt, CASE WHEN c.name = 'polypeptide' THEN 'translation=' || upper(f.residues) END)) AS value
FROM walked w JOIN feature f ON w.feature_id = f.feature_id JOIN cvterm c ON f.type_id = c.cvterm_id
LEFT JOIN featureloc l ON l.feature_id = f.feature_id
LEFT JOIN ({PROPS}) so ON so.feature_id = f.feature_id AND so.type = 'source'
LEFT JOIN ({PROPS}) sc ON sc.feature_id = f.feature_id AND sc.type = 'score'
LEFT JOIN a_xref a1 ON a1.feature_id = f.feature_id LEFT JOIN a_ont a2 ON a2.feature_id = f.feature_id
LEFT JOIN a_alias a3 ON a3.feature_id = f.feature_id LEFT JOIN a_syn a4 ON a4.feature_id = f.feature_id
LEFT JOIN a_prev a5 ON a5.feature_id = f.feature_id LEFT JOIN a_lit a6 ON a6.feature_id = f.feature_id
LEFT JOIN a_com a7 ON a7.feature_id = f.feature_id""",
}


@query("E1_gff_records", "SELECT value FROM gff_line", E1)
def _(c):
    return gff_export.gff_records(c.tables).orderBy("sequence", "path").select("value")


@query(
    "E1b_attribute_lists",
    """SELECT feature_id, txt AS attributes FROM (
SELECT f.feature_id, concat_ws(';', a1.txt, a2.txt, a3.txt, a4.txt, a5.txt, a6.txt, a7.txt) AS txt FROM feature f
LEFT JOIN a_xref a1 ON a1.feature_id = f.feature_id LEFT JOIN a_ont a2 ON a2.feature_id = f.feature_id
LEFT JOIN a_alias a3 ON a3.feature_id = f.feature_id LEFT JOIN a_syn a4 ON a4.feature_id = f.feature_id
LEFT JOIN a_prev a5 ON a5.feature_id = f.feature_id LEFT JOIN a_lit a6 ON a6.feature_id = f.feature_id
LEFT JOIN a_com a7 ON a7.feature_id = f.feature_id) q WHERE txt <> ''""",
    E1,
)
def _(c):
    return gff_export.attribute_text(c.tables)


HEAD = """SELECT '##gff-version 3' AS value UNION ALL SELECT '# feature-ontology so.obo' UNION ALL
SELECT '##sequence-region' || chr(9) || uniquename || chr(9) || '1' || chr(9) || cast(seqlen AS string) FROM feature
 WHERE type_id = 4"""


@query("K3_gff_file", f"{HEAD} UNION ALL SELECT value FROM gff_line", E1)
def _(c):
    path = scratch_path(c.spark, "gff-out")
    lines = gff_export.gff_lines(c.tables).orderBy("section", "sequence", "path").select("value")
    write_text(lines, path, compress=True)
    return c.spark.read.text(path)


# -- E2-E6: sequences --------------------------------------------------------

QUOTED = "replace(o.genus, ' ', '%20') || '%20' || o.species || coalesce('%20' || o.infraspecific_name, '')"


def _fasta_sql(rows: str) -> str:
    """Header and residues of (feature f, residues) rows."""
    return f"""SELECT o.abbreviation AS organism, f.uniquename AS id, '| organism=' || {QUOTED} || ' | sequence_type=' || c.name
 || coalesce(' | sequence_name=' || f.name, '') || coalesce(' | genome_version=' || v.value, '') || ' | release=r%2B1'
 AS description, f.residues FROM ({rows}) f JOIN organism o ON f.organism_id = o.organism_id
JOIN cvterm c ON f.type_id = c.cvterm_id
LEFT JOIN organismprop v ON v.organism_id = o.organism_id AND v.type_id = 19"""


@query(
    "E2_contig_sequences",
    _fasta_sql("SELECT uniquename, name, organism_id, type_id, residues FROM feature WHERE type_id = 4"),
)
def _(c):
    return fasta_export.fasta_records(c.tables, "contigs", release="r+1")


def _genes_sql(spare: int) -> str:
    return f"""SELECT g.uniquename, g.name, g.organism_id, g.type_id, CASE WHEN l.strand < 0
  THEN reverse(translate(substr(s.residues, cast(l.fmin AS int) + 1, cast(l.fmax - l.fmin AS int)), 'ACGT', 'TGCA'))
  ELSE substr(s.residues, cast(l.fmin AS int) + 1, cast(l.fmax - l.fmin AS int)) END AS residues
FROM feature g JOIN featureloc l ON l.feature_id = g.feature_id JOIN feature s ON l.srcfeature_id = s.feature_id
WHERE g.type_id = 1 AND NOT g.is_obsolete AND length(s.residues) >= l.fmax + {spare}"""


@query("E3_gene_sequences", _fasta_sql(_genes_sql(1)))
def _(c):
    return fasta_export.fasta_records(c.tables, "genes", release="r+1")


@query("E3_gene_sequences_to_the_end", _fasta_sql(_genes_sql(0)))
def _(c):
    return fasta_export.fasta_records(c.tables, "genes", release="r+1", strict_end=False)


PEPTIDES = f"""SELECT uniquename, name, organism_id, type_id, residues FROM feature WHERE NOT is_obsolete
 AND substr(residues, 1, 1) = 'M' AND feature_id IN (SELECT feature_id FROM ({PROTEINS}) p)"""


@query("E4_protein_sequences", _fasta_sql(PEPTIDES))
def _(c):
    return fasta_export.fasta_records(c.tables, "proteins", release="r+1")


@query(
    "E5_residue_validity",
    """SELECT feature_id, regexp_matches(residues, '^[GATCRYWSMKHBVDNgatcrywsmkhbvdn]+$') AS nucleotides,
 regexp_matches(residues, '^[Mm]([A-Za-z]*[A-Za-z*])?$') AS protein FROM feature WHERE residues IS NOT NULL""",
)
def _(c):
    residues = F.col("residues")
    return c.tables["feature"].where(residues.isNotNull()).select(
        "feature_id", fasta_export.valid_residues(residues, "contigs").alias("nucleotides"),
        fasta_export.valid_residues(residues, "proteins").alias("protein"),
    )


@query(
    "E6_header_quoting",
    """SELECT p_partkey, '| organism=' || replace(replace(p_brand, '#', '%23'), ' ', '%20') || '~/%2A%2B%20' || cast(p_size AS string)
 AS header FROM {part}""",
)
def _(c):
    from helixframe.functions.expr import url_quote

    parts = c.view("SELECT * FROM {part}")
    text = F.concat("p_brand", F.lit("~/*+ "), F.col("p_size").cast("string"))
    return parts.select("p_partkey", F.concat(F.lit("| organism="), url_quote(text)).alias("header"))


def _fasta_file(c, kind: str, compress: bool = False) -> str:
    path = scratch_path(c.spark, "fasta")
    records = fasta_export.fasta_records(c.tables, kind, release="r+1").orderBy("id")
    write_text(records.select(fasta_export.fasta_text().alias("value")), path, compress)
    return path


@query(
    "K4_fasta_lines",
    f"""SELECT '>' || id || ' ' || description AS value FROM ({_fasta_sql(PEPTIDES)}) q
UNION ALL SELECT substr(residues, cast(60 * i AS int) + 1, 60) FROM (
 SELECT residues, unnest(range(0, (length(residues) + 59) // 60)) AS i FROM ({_fasta_sql(PEPTIDES)}) q) r""",
)
def _(c):
    return c.spark.read.text(_fasta_file(c, "proteins"))


@query(
    "S4_read_fasta",
    f"SELECT id, id || ' ' || description AS description, residues FROM ({_fasta_sql(_genes_sql(1))}) q",
)
def _(c):
    return fasta_source.read_fasta(c.spark, _fasta_file(c, "genes")).drop("pos")


_PIECES: dict[tuple[str, str], tuple] = {}


def _contig_pieces(c):
    """Records and stored pieces of a file of all top-level sequences."""
    key = (c.spark.sparkContext.applicationId, c.sf_dir)
    if key not in _PIECES:
        lines = read_lines(c.spark, _fasta_file(c, "contigs"))
        path = scratch_path(c.spark, "pieces")
        fasta_source.sequence_pieces(lines).write.parquet(path)
        pieces = c.spark.read.parquet(path)
        owners = c.tables["feature"].where("type_id = 4").select("organism_id", F.col("uniquename").alias("id"))
        _PIECES[key] = fasta_source.headers(lines).join(owners, "id"), pieces
    return _PIECES[key]


@query(
    "S4_sequence_pieces",
    f"""SELECT id, seqlen, cast(i AS int) AS chunk_no, substr(residues, cast({fasta_source.PIECE} * i AS int) + 1, {fasta_source.PIECE}) AS bases FROM (
SELECT id, residues, cast(length(residues) AS bigint) AS seqlen,
 unnest(range(0, (length(residues) + {fasta_source.PIECE - 1}) // {fasta_source.PIECE})) AS i FROM (
{_fasta_sql("SELECT uniquename, name, organism_id, type_id, residues FROM feature WHERE type_id = 4")}) q) r""",
)
def _(c):
    records, pieces = _contig_pieces(c)
    sized = fasta_source.with_lengths(records, pieces).select("pos", "id", "seqlen")
    return pieces.join(sized, "pos").select("id", "seqlen", "chunk_no", "bases")


@query("E3_genes_from_pieces", _fasta_sql(_genes_sql(1)))
def _(c):
    placed = fasta_export.pieces_of_features(c.tables, *_contig_pieces(c))
    return fasta_export.fasta_records(c.tables, "genes", release="r+1", pieces=placed)


_CONTIGS = _fasta_sql("SELECT uniquename, name, organism_id, type_id, residues FROM feature WHERE type_id = 4")


@query(
    "K4_lines_from_pieces",
    f"""SELECT '>' || id || ' ' || description AS value FROM ({_CONTIGS}) q
UNION ALL SELECT substr(residues, cast(60 * i AS int) + 1, 60) FROM (
 SELECT residues, unnest(range(0, (length(residues) + 59) // 60)) AS i FROM ({_CONTIGS}) q) r""",
)
def _(c):
    placed = fasta_export.pieces_of_features(c.tables, *_contig_pieces(c))
    path = scratch_path(c.spark, "fasta")
    fasta_export.write_pieces(c.tables, path, c.tables["feature"].where("type_id = 4"), placed, "r+1")
    return c.spark.read.text(path)


@query("S11_read_gzip", f"SELECT id, residues FROM ({_fasta_sql(PEPTIDES)}) q")
def _(c):
    return fasta_source.read_fasta(c.spark, _fasta_file(c, "proteins", compress=True)).select("id", "residues")


@query(
    "S5_fasta_header_type",
    "SELECT uniquename AS id, CASE WHEN feature_id % 3 = 0 THEN 'contig' WHEN feature_id % 3 = 1 THEN 'region' END AS type"
    " FROM feature WHERE residues IS NOT NULL",
)
def _(c):
    header = F.concat("uniquename", F.lit(" | organism=a=b "), F.expr(
        "CASE feature_id % 3 WHEN 0 THEN '| SO = contig | sequence_type=region' WHEN 1 THEN '|x=1| sequence_type=region ' ELSE '' END"
    ))
    rows = c.tables["feature"].where("residues is not null")
    return rows.select(F.col("uniquename").alias("id"), fasta_source.header_type(header).alias("type"))


# -- E7: associations --------------------------------------------------------

E7 = {
    **H,
    "g_go": """SELECT fc.feature_cvterm_id, fc.feature_id, fc.pub_id, fc.is_not, d.accession, cv.name AS namespace
FROM feature_cvterm fc JOIN cvterm c ON fc.cvterm_id = c.cvterm_id JOIN dbxref d ON c.dbxref_id = d.dbxref_id
JOIN cv ON c.cv_id = cv.cv_id WHERE d.db_id = 7""",
    "g_xref": """SELECT x.feature_cvterm_id, string_agg(db.name || ':' || d.accession, '|' ORDER BY x.feature_cvterm_dbxref_id)
 FILTER (WHERE db.name = 'GO_REF') AS refs, string_agg(db.name || ':' || d.accession, '|' ORDER BY x.feature_cvterm_dbxref_id)
 FILTER (WHERE db.name <> 'GO_REF') AS withs FROM feature_cvterm_dbxref x JOIN dbxref d ON x.dbxref_id = d.dbxref_id
JOIN db ON d.db_id = db.db_id GROUP BY x.feature_cvterm_id""",
    "g_pub2": """SELECT x.feature_cvterm_id, string_agg(p.uniquename, '|' ORDER BY x.feature_cvterm_pub_id) AS pubs
FROM feature_cvterm_pub x JOIN pub p ON x.pub_id = p.pub_id GROUP BY x.feature_cvterm_id""",
    "g_syn": f"SELECT feature_id, string_agg(name, '|' ORDER BY feature_synonym_id) AS syns FROM ({SYNONYMS}) s GROUP BY feature_id",
    "g_prod": """SELECT fc.feature_id, arg_min(c.name, fc.feature_cvterm_id) AS product FROM feature_cvterm fc
JOIN cvterm c ON fc.cvterm_id = c.cvterm_id WHERE c.cv_id = 4 GROUP BY fc.feature_id""",
    "g_full": """SELECT o.abbreviation AS organism, tg.uniquename AS id, coalesce(gn.name, gn.uniquename) AS symbol,
 CASE WHEN g.is_not THEN 'NOT' ELSE '' END AS qualifier, 'GO:' || g.accession AS go,
 coalesce(nullif(concat_ws('|', CASE WHEN p.uniquename <> 'null' THEN p.uniquename END, p2.pubs, x.refs), ''),
  'GO_REF:0000002') AS refs,
 CASE WHEN ev.value = 'Inferred from Sequence Orthology' THEN 'ISO' WHEN ev.value = 'IDA' THEN 'IDA' ELSE 'NR' END AS ev,
 coalesce(x.withs, '') AS withs,
 CASE g.namespace WHEN 'cellular_component' THEN 'C' WHEN 'molecular_function' THEN 'F' WHEN 'biological_process' THEN 'P' END
  AS aspect,
 coalesce(pr.product, '') AS product, coalesce(sy.syns, '') AS syns, tc.name AS type,
 'taxon:' || coalesce(tx.value, o.abbreviation) AS taxon, dt.value AS annotated, coalesce(ab.value, 'MyDB') AS assigned
FROM g_go g JOIN feature f ON g.feature_id = f.feature_id JOIN family fa ON fa.feature_id = f.feature_id
JOIN feature tg ON tg.feature_id = @target JOIN cvterm tc ON tg.type_id = tc.cvterm_id
JOIN family ta ON ta.feature_id = tg.feature_id LEFT JOIN feature gn ON gn.feature_id = ta.gene_id
JOIN organism o ON f.organism_id = o.organism_id JOIN pub p ON g.pub_id = p.pub_id
LEFT JOIN g_xref x ON x.feature_cvterm_id = g.feature_cvterm_id LEFT JOIN g_pub2 p2 ON p2.feature_cvterm_id = g.feature_cvterm_id
LEFT JOIN g_syn sy ON sy.feature_id = ta.gene_id LEFT JOIN g_prod pr ON pr.feature_id = f.feature_id
LEFT JOIN organismprop tx ON tx.organism_id = o.organism_id AND tx.type_id = 23
LEFT JOIN feature_cvtermprop dt ON dt.feature_cvterm_id = g.feature_cvterm_id AND dt.type_id = 14
LEFT JOIN feature_cvtermprop ev ON ev.feature_cvterm_id = g.feature_cvterm_id AND ev.type_id = 16
LEFT JOIN feature_cvtermprop ab ON ab.feature_cvterm_id = g.feature_cvterm_id AND ab.type_id = 18
WHERE NOT f.is_obsolete AND fa.kind IS NOT NULL""",
}
LEVELS = {"default": "f.feature_id", "gene": "coalesce(fa.gene_id, f.feature_id)",
          "transcript": "coalesce(fa.transcript_id, f.feature_id)", "protein": "coalesce(fa.protein_id, f.feature_id)"}
GAF_CELLS = "organism, id, symbol, qualifier, go, refs, ev, withs, aspect, product, syns, type, taxon, annotated, assigned"
TODAY = "strftime(current_date, '%Y%m%d')"


def _levels(level: str) -> dict[str, str]:
    return {**E7, "g_full": E7["g_full"].replace("@target", LEVELS[level])}


def _gaf_cells(records):
    joined = lambda name: F.array_join(name, "|")
    return records.select(
        "organism", F.col("DB_Object_ID").alias("id"), F.col("DB_Object_Symbol").alias("symbol"),
        F.col("Qualifier").alias("qualifier"), F.col("GO_ID").alias("go"), joined("DB_Reference").alias("refs"),
        F.col("Evidence").alias("ev"), joined("With").alias("withs"), F.col("Aspect").alias("aspect"),
        F.col("DB_Object_Name").alias("product"), joined("Synonym").alias("syns"), F.col("DB_Object_Type").alias("type"),
        F.col("Taxon_ID").alias("taxon"), F.col("Date").alias("annotated"), F.col("Assigned_By").alias("assigned"),
    )


def _register_level(level: str) -> None:
    cells = GAF_CELLS.replace("annotated", f"coalesce(annotated, {TODAY}) AS annotated")

    @query(f"E7_gaf_records_{level}", f"SELECT {cells} FROM g_full WHERE aspect IS NOT NULL AND symbol IS NOT NULL", _levels(level))
    def _(c):
        return _gaf_cells(gaf_export.gaf_records(c.tables, "MyDB", level=level)[0])


for _level in LEVELS:
    _register_level(_level)



@query(
    "E7d_rejected_annotations",
    """SELECT f.uniquename, 'GO:' || g.accession AS "GO_ID", 'unknown namespace' AS reason FROM g_go g
JOIN feature f ON g.feature_id = f.feature_id WHERE NOT f.is_obsolete AND g.namespace = 'molecular_function'""",
    E7,
)
def _(c):
    moved = c.tables["cvterm"].withColumn("cv_id", F.expr("CASE cv_id WHEN 9 THEN 6 ELSE cv_id END"))
    tables = c.tables.with_tables({"cvterm": moved})
    return gaf_export.gaf_records(tables, "MyDB")[1].select("uniquename", "GO_ID", "reason")


LINE = GAF_CELLS.split(", ")[1:]


def _gaf_file(c) -> str:
    path = scratch_path(c.spark, "gaf")
    head = c.spark.range(1, numPartitions=1).select(F.lit(gaf_export.HEADER).alias("value"))
    write_text(head.union(gaf_export.gaf_lines(gaf_export.gaf_records(c.tables, "MyDB")[0])), path)
    return path


@query(
    "K5_gaf_file",
    f"""SELECT '!gaf-version: 1.0' AS value UNION ALL
SELECT concat_ws(chr(9), 'MyDB', {', '.join('coalesce(annotated, ' + TODAY + ')' if x == 'annotated' else x for x in LINE)})
FROM g_full""",
    _levels("default"),
)
def _(c):
    return c.spark.read.text(_gaf_file(c))


@query("S6_read_gaf", f"SELECT {GAF_CELLS.replace('organism, ', '').replace('annotated', f'coalesce(annotated, {TODAY}) AS annotated')} FROM g_full", _levels("default"))
def _(c):
    records = gaf_source.read_gaf(c.spark, _gaf_file(c)).withColumn("organism", F.lit(""))
    records = records.withColumn("Qualifier", F.array_join("Qualifier", "|"))
    return _gaf_cells(records).drop("organism")
