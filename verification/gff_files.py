"""The feature files of the import checks, rendered from the annotation views.

``in_rec`` holds one row per record with its attributes as columns; Spark
renders it to text and reads that back, DuckDB uses the columns directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from helixframe.functions.expr import percent_encode
from helixframe.session import cut_lineage, scratch_path
from helixframe.sources.text import read_lines
from verification.registry import Context

NONE = "cast(NULL AS string)"
ATTRIBUTES = [
    "name", "alias", "alias2", "syn", "prev", "cmt", "note", "xref", "xref2", "ont", "lit", "size_", "parent", "derives",
    "translation", "protein_src", "colour",
]


def _row(table: str, where: str, /, **columns: str) -> str:
    base = {
        "n": "n", "ord": "0", "seqid": "'chr' || cast(n AS string)", "source": "'.'", "type": "'gene'",
        "start_": "(37 * o) % 12500 + 1", "end_": "(37 * o) % 12500 + 30 + o % 300", "score": "'.'",
        "strand": "CASE o % 4 WHEN 0 THEN '-' WHEN 3 THEN '.' ELSE '+' END", "phase": "'.'", "id": NONE,
        **{a: NONE for a in ATTRIBUTES},
    }
    base.update(columns)
    return f"SELECT {', '.join(f'{e} AS {c}' for c, e in base.items())} FROM {table} WHERE {where}"


G = "'G' || cast(o AS string)"
TX = f"{G} || '.' || cast(l AS string)"
VIEWS = {}
VIEWS["in_rec"] = "\nUNION ALL\n".join([
    _row(
        "fx_gene", "gene_id % 7 <> 3", ord="100 * o + 90", id=G,
        type="CASE WHEN o % 50 = 7 THEN 'mystery' WHEN o % 10 = 0 THEN 'pseudogene' ELSE 'gene' END",
        seqid="CASE WHEN o % 45 = 2 THEN 'chrX' ELSE 'chr' || cast(n AS string) END",
        start_="(37 * o) % 12500 + 1 + o % 3", source="CASE WHEN o % 2 = 0 THEN 'file' ELSE '.' END",
        score="CASE WHEN o % 6 = 0 THEN '0.9' ELSE '.' END",
        name=f"CASE WHEN o % 5 = 0 THEN 'new, ' || {G} || '; 100%' END",
        alias="CASE WHEN o % 6 = 0 THEN 'alias' || cast(o % 50 AS string) END",
        alias2="CASE WHEN o % 12 = 0 THEN 'extra' || cast(o AS string) END",
        syn="CASE WHEN o % 4 = 1 THEN 'syn' || cast(o AS string) END",
        prev="CASE WHEN o % 5 = 2 THEN 'older' || cast(o AS string) END",
        cmt="CASE WHEN o % 4 = 0 THEN 'first, comment' END",
        note="CASE WHEN o % 9 = 0 THEN 'noted ' || cast(o AS string) END",
        xref="CASE WHEN o % 4 = 2 THEN 'UniProtKB:P' || cast(o AS string) WHEN o % 30 = 1 THEN 'broken' END",
        xref2="CASE WHEN o % 10 = 1 THEN 'NEWDB:A' || cast(o AS string) || ':2' END",
        ont="CASE WHEN o % 12 = 11 THEN 'GO:absent' WHEN o % 24 = 5 THEN 'XX:1'"
            " WHEN o % 3 = 0 THEN 'GO:' || lpad(cast(o % 10 AS string), 7, '0') END",
        lit="CASE WHEN o % 3 = 1 THEN 'PMID:' || lpad(cast(o % 300 AS string), 7, '0') END",
        size_="CASE WHEN o % 11 = 0 THEN cast(o AS string) END",
        colour="CASE WHEN o % 13 = 0 THEN 'red' END",
    ),
    _row(
        "fx_model", "tx_id % 7 <> 3", ord="100 * o + 10 + l", id=TX, type="'mRNA'",
        parent=f"CASE WHEN o % 40 = 3 THEN 'missing' || cast(o AS string) ELSE {G} END",
        protein_src=f"CASE WHEN l = 1 AND o % 6 = 1 THEN 'P' || {TX} END",
    ),
    _row(
        "fx_model", "pep_id % 7 <> 3", ord="100 * o + 20 + l", id=f"{TX} || ':pep'", type="'polypeptide'",
        derives=TX, translation="'mkl' || translate(md5(cast(pep_id AS string)), '0123456789abcdef', 'acdefghiklmnpqrs')",
    ),
    _row("fx_gene", "o % 97 IN (0, 1)", ord="100 * o + 95", id=f"'N' || {G}"),
    _row("fx_gene", "o % 20 = 0", ord="100 * o + 30", type="'CDS'", phase="'0'", parent=G),
])
# The record's id (CDS records are numbered per organism), known type, and position.
VIEWS["in_named"] = """SELECT r.*, coalesce(r.id, 'CDS_' || cast(row_number() OVER (
 PARTITION BY r.n, r.type, r.id IS NULL ORDER BY r.ord) AS string)) AS uid FROM in_rec r"""
VIEWS["in_typed"] = "SELECT * FROM in_named WHERE type <> 'mystery'"
VIEWS["in_protein"] = """SELECT n, ord, 'P' || uid AS uid, seqid, source, start_, end_, strand, uid AS derives
FROM in_typed WHERE protein_src IS NOT NULL"""

KEYS = {
    "name": "Name", "syn": "synonym", "prev": "previous_systematic_id", "cmt": "comment", "note": "Note",
    "ont": "Ontology_term", "lit": "literature", "size_": "size", "parent": "Parent", "derives": "Derives_from",
    "translation": "translation", "protein_src": "protein_source_id", "colour": "colour",
}


def write_gff(c: Context) -> str:
    """Write one folder per organism, records in file order; returns the path."""
    rec = c.view("SELECT r.*, abbreviation FROM in_rec r JOIN organism ON n = organism_id", VIEWS)
    code = lambda col: percent_encode(F.col(col), ";=,&\t")
    number = F.regexp_extract("id", r"\d+", 0).cast("long")
    current = F.when(number % 8 == 1, "%3Bcurrent%3Dtrue").when(number % 8 == 5, "%3Bcurrent%3Dfalse").otherwise("")
    pair = lambda key, value: F.when(value.isNotNull(), F.concat(F.lit(f"{key}="), value))
    two = lambda a, b: F.when(F.col(a).isNotNull() | F.col(b).isNotNull(), F.concat_ws(",", code(a), code(b)))
    attributes = F.concat_ws(
        ";", pair("ID", code("id")), pair("Alias", two("alias", "alias2")), pair("Dbxref", two("xref", "xref2")),
        *[pair(key, F.concat(code(col), current) if col == "syn" else code(col)) for col, key in KEYS.items()],
    )
    cells = ["seqid", "source", "type", F.col("start_").cast("string"), F.col("end_").cast("string"), "score", "strand", "phase"]
    lines = rec.select("abbreviation", "ord", F.concat_ws("\t", *cells, attributes).alias("value"))
    top = c.view(
        "SELECT abbreviation, -3 AS ord, '##gff-version 3' AS value FROM organism UNION ALL "
        "SELECT abbreviation, -2, '##sequence-region chr' || cast(organism_id AS string) || ' 1 12800' FROM organism UNION ALL "
        "SELECT abbreviation, -1, '# a remark\twith\ttabs' FROM organism UNION ALL "
        "SELECT abbreviation, 1000000000000000, '##FASTA' FROM organism WHERE organism_id % 2 = 0"
    )
    seqs = c.view("""SELECT o.abbreviation, 1000000000000001 AS ord, '>' || f.uniquename || ' sequence_type=contig
' || regexp_replace(f.residues, '(.{{60}})', '$1\n') AS value FROM feature f JOIN organism o
ON f.organism_id = o.organism_id WHERE f.type_id = 4 AND o.organism_id % 2 = 0""".replace("\\n", "\\\\n"))
    path = scratch_path(c.spark, "gff")
    # Written once: finding the ranges of the files would render every line a second time.
    out = cut_lineage(lines.unionByName(top).unionByName(seqs).withColumnRenamed("abbreviation", "organism"))
    # Files are cut by place, so that no task holds an organism; the marker stays with the sequences after it.
    place = F.least("ord", F.lit(1000000000000000))
    out.repartitionByRange("organism", place).sortWithinPartitions("organism", "ord").select(
        "organism", "value"
    ).write.partitionBy("organism").option("compression", "gzip").text(path)
    return path


_LINES: dict[tuple[str, str], str] = {}


def gff_lines(c: Context) -> DataFrame:
    key = (c.spark.sparkContext.applicationId, c.sf_dir)
    if key not in _LINES:
        _LINES[key] = write_gff(c)
    return read_lines(c.spark, _LINES[key])
