"""Reading, importing and exporting small files."""

import os
import random

import pytest
from pyspark.sql import functions as F

from helixframe.plans import fasta_export, fasta_import, gaf_import, gff_export, gff_import, ontology_import
from helixframe.session import cut_lineage
from helixframe.sources import fasta, gaf, gff, ontology
from helixframe.sources.text import read_lines
from helixframe.tables import Tables

GFF = """##gff-version 3
##sequence-region   seq1 1 80
# a remark
seq1\tsrc\tCDS\t11\t40\t.\t+\t0\tParent=t1;protein_source_id=p1
seq1\tsrc\tmRNA\t11\t40\t0.5\t+\t.\tID=t1;Parent=g1;Note=one%2C two,three;oddity=1
seq1\tsrc\tgene\t11\t40\t.\t+\t.\tID=g1;Name=first%3B gene;Alias=al%3Bcurrent%3Dfalse;Dbxref=DB:1,broken;Ontology_term=GO:9
seq1\t.\tgene\t50\t80\t.\t-\t.\tID=g2;Parent=nowhere
seq2\t.\tgene\t1\t9\t.\t.\t.\tID=g3
seq1\t.\tsprocket\t1\t9\t.\t.\t.\tID=s1
seq1\t.\tgene\t1\t9\t.\t.\t.\tID=g3
too\tfew\tcolumns
##FASTA
>seq1 sequence_type=contig
ACGTACGTAC
GTACGTACGT
>seq2
acgt
"""


def write(path, text):
    path.mkdir()
    (path / "file.txt").write_text(text)
    return str(path)


def load(t, result):
    return Tables.of(t.spark, {**{n: t[n] for n in t._names}, **{n: cut_lineage(d) for n, d in result.tables().items()}})


@pytest.fixture(scope="module")
def gff_path(tmp_path_factory):
    return write(tmp_path_factory.mktemp("in") / "gff", GFF)


def test_records(spark, gff_path):
    got = {r["id"]: r for r in gff.read_gff(spark, gff_path).orderBy("pos").collect()}
    assert set(got) == {"CDS_1", "t1", "g1", "g2", "g3", "s1"}
    notes = [a["values"] for a in got["t1"]["attributes"] if a["key"] == "Note"]
    assert notes == [["one, two", "three"]]
    assert (got["g1"]["start"], got["g1"]["end"]) == (11, 40)


def test_embedded_sequences(spark, gff_path):
    lines = read_lines(spark, gff_path)
    got = {r["id"]: r["residues"] for r in gff.embedded_sequences(lines).collect()}
    assert got == {"seq1": "ACGTACGTACGTACGTACGT", "seq2": "acgt"}
    assert [r["name"] for r in gff.sequence_names(lines).collect()] == ["seq1"]
    with pytest.raises(ValueError):
        gff.embedded_sequences(lines, separate_file=True)


def test_embedded_sequences_across_splits(spark, tmp_path):
    body = "".join(f">s{i} x\n" + "".join(f"{'ACGT'[j % 4] * 60}\n" for j in range(40)) for i in range(30))
    path = write(tmp_path / "big", "##gff-version 3\n##FASTA\n" + body)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = read_lines(spark, path)
        assert lines.rdd.getNumPartitions() > 5
        got = {r["id"]: r["residues"] for r in gff.embedded_sequences(lines).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = "".join("ACGT"[j % 4] * 60 for j in range(40))
    assert got == {f"s{i}": want for i in range(30)}


@pytest.fixture(scope="module")
def imported(small, spark, gff_path):
    """(tables with the sequences, records, sequence names, import result, tables after it)"""
    lines = read_lines(spark, gff_path)
    seqs = gff_import.of_organism(small, gff.embedded_sequences(lines), "ONE")
    t = load(small, fasta_import.import_fasta(small, seqs, "chromosome"))
    before, _ = gff.annotation_lines(lines)
    records = gff_import.of_organism(t, gff.parse_records(before), "ONE")
    names = gff_import.of_organism(t, gff.sequence_names(lines), "ONE")
    result = gff_import.import_gff(t, records, sequence_names=names)
    return t, records, names, result, load(t, result)


def test_gff_import(imported):
    _, records, _, result, after = imported
    reasons = sorted((r["id"], r["reason"]) for r in result.rejects.collect())
    assert reasons == [
        ("g1", "malformed cross reference"), ("g1", "unknown accession"), ("g2", "unknown parent feature"),
        ("g3", "repeated id"), ("s1", "unknown feature type"),
    ]
    names = {r["feature_id"]: r["uniquename"] for r in after["feature"].collect()}
    assert set(names.values()) == {"seq1", "seq2", "CDS_1", "t1", "g1", "g2", "g3", "p1"}
    edges = {(names[r["subject_id"]], names[r["object_id"]]) for r in after["feature_relationship"].collect()}
    assert edges == {("CDS_1", "t1"), ("t1", "g1"), ("p1", "t1")}
    spots = {names[r["feature_id"]]: (r["fmin"], r["fmax"], r["strand"], r["phase"]) for r in after["featureloc"].collect()}
    assert spots["g2"] == (49, 80, -1, None) and spots["CDS_1"] == (10, 40, 1, 0) and spots["p1"] == (10, 40, 1, None)
    values = {(names[r["feature_id"]], r["value"], r["rank"]) for r in after["featureprop"].collect()}
    assert {("t1", "one, two", 0), ("t1", "three", 1), ("t1", "0.5", 0)} <= values
    assert [(r["is_current"]) for r in after["feature_synonym"].collect()] == [False]
    assert [r["attribute"] for r in result.reports["unknown_attributes"].collect()] == ["oddity"]


def test_importing_again_changes_nothing(imported):
    _, records, names, _, after = imported
    again = gff_import.import_gff(after, records, full_genome=True, full_attributes=True, sequence_names=names)
    for table in ["featureloc", "featureprop", "feature_relationship", "feature_synonym"]:
        assert again.merges[table].where("_action <> 'keep'").count() == 0, table
    # seq2 is not declared by a sequence-region line, so the full genome lacks it.
    changed = again.merges["feature"].where("_action <> 'keep'").collect()
    assert [(r["uniquename"], r["is_obsolete"]) for r in changed] == [("seq2", True)]


def test_gff_export_reads_back(spark, imported, tmp_path):
    after = imported[4]
    out = str(tmp_path / "out")
    gff_export.write_gff(after, out, "ONE", with_fasta=True)
    lines = [r["value"] for r in spark.read.text(out).coalesce(1).collect()]
    assert lines[0] == "##gff-version 3" and "##FASTA" in lines
    order = [line.split("ID=")[1].split(";")[0] for line in lines if "\t" in line and not line.startswith("#")]
    assert order == ["seq1", "g1", "t1", "CDS_1", "p1", "g2", "seq2", "g3"]
    g1 = next(line for line in lines if "ID=g1;" in line)
    assert "Name=first%3B gene" in g1 and "Alias=al" in g1 and g1.split("\t")[3:5] == ["11", "40"]
    got = gff.read_gff(spark, out)
    assert {r["id"] for r in got.collect()} == set(order)


def test_fasta(spark, tmp_path):
    path = write(tmp_path / "fa", ">a one | SO=region\r\nAC\r\nGT\r\n>b\n\nAAA\n>c empty\n")
    got = {r["id"]: (r["residues"], r["t"]) for r in fasta.read_fasta(spark, path).withColumn("t", fasta.header_type(F.col("description"))).collect()}
    assert got == {"a": ("ACGT", "region"), "b": ("AAA", None), "c": ("", None)}


@pytest.fixture
def tiny_splits(spark):
    """Files are read in splits of 200 bytes."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    held = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], "200")
    spark.conf.set(names[1], "0")
    yield
    for n, v in zip(names, held, strict=True):
        spark.conf.set(n, v)


def test_sequence_pieces(spark, tmp_path, tiny_splits):
    """Pieces over many splits: wrapped, unwrapped, empty and repeated records, blank lines, CRLF."""
    rng = random.Random(5)
    made, text = [], "no header yet\n"
    for name, n, wrap in [("a", 1500, 60), ("b", 0, 60), ("c", 700, 700), ("d", 30, 7), ("a", 41, 10), ("e", 60, 60)]:
        bases = "".join(rng.choices("ACGTN", k=n))
        made.append((name, bases))
        text += f">{name} of {n}\r\n" + "".join(bases[i:i + wrap] + rng.choice(["\n", "\r\n", "\n\n"]) for i in range(0, n, wrap))
    lines = read_lines(spark, write(tmp_path / "fa", text))
    assert lines.select("pos.block").distinct().count() > 5
    heads = {r["pos"]: (r["id"], r["description"]) for r in fasta.headers(lines).collect()}
    for width in (7, 60, 12_000):
        pieces = fasta.sequence_pieces(lines, width)
        rows = sorted(pieces.collect(), key=lambda r: (r["pos"], r["chunk_no"]))
        assert all(len(r["bases"]) <= width for r in rows)
        whole = [(heads[p][0], "".join(r["bases"] for r in rows if r["pos"] == p)) for p in sorted(heads)]
        assert whole == made
        sized = {r["pos"]: r["seqlen"] for r in fasta.with_lengths(fasta.headers(lines), pieces).collect()}
        assert [sized[p] for p in sorted(sized)] == [len(b) for _, b in made]
    assert sorted(heads.values()) == sorted((n, f"{n} of {len(b)}") for n, b in made)
    assert fasta.sequence_pieces(lines.where("false")).count() == 0


def test_import_and_genes_of_pieces(spark, small, tmp_path):
    """Of two records with one id the last is imported; genes are cut from its pieces and the file is written again from them."""
    bases = "".join(random.Random(6).choices("ACGT", k=900))
    text = ">seq1 old\n" + "A" * 500 + "\n>seq1 new\n" + "\n".join(bases[i:i + 60] for i in range(0, 900, 60)) + "\n"
    lines = read_lines(spark, write(tmp_path / "fa", text))
    pieces = fasta.sequence_pieces(lines).cache()
    records = gff_import.of_organism(small, fasta.with_lengths(fasta.headers(lines), pieces), "ONE")
    t = load(small, fasta_import.import_fasta(small, records, "chromosome"))
    top = t["feature"].where("uniquename = 'seq1'")
    assert [(r["residues"], r["seqlen"]) for r in top.collect()] == [(None, 900)]
    rows = "".join("\t".join(["seq1", "s", "gene", str(a), str(b), ".", strand, ".", f"ID={i}"]) + "\n" for i, a, b, strand in [
        ("g1", 1, 61, "+"), ("g2", 400, 800, "-"), ("g3", 850, 900, "+")])
    gff_records = gff_import.of_organism(small, gff.read_gff(spark, write(tmp_path / "g", "##gff-version 3\n" + rows)), "ONE")
    t = load(t, gff_import.import_gff(t, gff_records))
    placed = fasta_export.pieces_of_features(t, records, pieces)
    got = {r["id"]: r["residues"] for r in fasta_export.fasta_records(t, "genes", "ONE", pieces=placed, strict_end=False).collect()}
    turned = bases[399:800][::-1].translate(str.maketrans("ACGT", "TGCA"))
    assert got == {"g1": bases[:61], "g2": turned, "g3": bases[849:]}
    assert set(r["id"] for r in fasta_export.fasta_records(t, "genes", "ONE", pieces=placed).collect()) == {"g1", "g2"}
    fasta_export.write_pieces(t, str(tmp_path / "out"), top, placed)
    again = fasta.read_fasta(spark, str(tmp_path / "out")).collect()
    assert [(r["id"], r["residues"]) for r in again] == [("seq1", bases)]


def gaf_line(**cells):
    from helixframe.terms import GAF_COLUMNS

    base = {"DB": "Db", "DB_Object_ID": "t1", "DB_Object_Symbol": "abc", "GO_ID": "GO:1", "DB:Reference": "PMID:1", "Evidence": "IDA",
            "Aspect": "P", "DB_Object_Type": "gene", "Taxon_ID": "taxon:1", "Date": "20200101", "Assigned_By": "Db"}
    base.update(cells)
    return "\t".join(base.get(c, "") for c in GAF_COLUMNS)


@pytest.mark.skipif(not os.environ.get("HELIXFRAME_SLOW_TESTS"), reason="slow; set HELIXFRAME_SLOW_TESTS")
def test_gaf_import(spark, imported, tmp_path):
    t = imported[4]
    db = t.name_id("db", "GO")
    xref = spark.createDataFrame([(77, db, "1", "", None)], t["dbxref"].schema)
    term = spark.createDataFrame([(77, 1, 77, "growth", None, 0, 0)], t["cvterm"].schema)
    t = t.with_tables({"dbxref": t["dbxref"].unionByName(xref), "cvterm": t["cvterm"].unionByName(term)})
    lines = [
        "!gaf-version: 2.1", gaf_line(**{"DB_Object_Name": "kinase", "Qualifier": "NOT", "Synonym": "x1|x2",
                                       "DB:Reference": "GO_REF:2|PMID:7|thesis", "With": "UniProtKB:A"}),
        gaf_line(**{"DB_Object_Name": "other", "DB_Object_Symbol": "last", "Evidence": "??"}),
        gaf_line(**{"DB_Object_ID": "nobody"}),
    ]
    records = gff_import.of_organism(t, gaf.read_gaf(spark, write(tmp_path / "gaf", "\n".join(lines) + "\n")), "ONE")
    result = gaf_import.import_gaf(t, records, "protein")
    assert [(r["id"], r["reason"]) for r in result.rejects.collect()] == [("nobody", "unknown feature")]
    after = load(t, result)
    assert after["feature"].where("uniquename = 'g1'").first()["name"] == "last"
    p1 = after["feature"].where("uniquename = 'p1'").first()["feature_id"]
    terms = {r["cvterm_id"]: r["name"] for r in after["cvterm"].collect()}
    links = after["feature_cvterm"].where(F.col("feature_id") == p1).collect()
    assert {terms[r["cvterm_id"]]: r["is_not"] for r in links} == {"kinase": False, "growth": False}
    go = next(r["feature_cvterm_id"] for r in links if terms[r["cvterm_id"]] == "growth")
    values = sorted(r["value"] for r in after["feature_cvtermprop"].where(F.col("feature_cvterm_id") == go).collect())
    assert values == ["", "20200101", "Db"]
    pubs = {r["pub_id"]: r["uniquename"] for r in after["pub"].collect()}
    assert {pubs[r["pub_id"]] for r in links} == {"PMID:7"}
    assert [pubs[r["pub_id"]] for r in after["feature_cvterm_pub"].collect()] == ["thesis"]
    assert after["feature_cvterm_dbxref"].where(F.col("feature_cvterm_id") == go).count() == 2


OBO = """format-version: 1.2
default-namespace: animals

[Term]
id: T:1
name: beast
def: "a \\"big\\" animal" [x:1]
synonym: "brute" EXACT []
xref: DB:5 "more"

[Term]
id: T:2
name: dog
is_a: T:1 ! beast
relationship: eats T:1 {source="x"} ! beast
comment: good

[Term]
id: T:3
name: lost one
is_obsolete: true

[Term]
id: U:1
name: foreign

[Typedef]
id: eats
name: eats it
"""


def test_ontology_import(small, spark, tmp_path):
    terms, typedefs, space = ontology.read_obo(spark, write(tmp_path / "obo", OBO))
    assert space == "animals"
    first = ontology_import.import_ontology(small, terms, typedefs, space, "T")
    after = load(small, first)
    names = {r["name"]: r["is_obsolete"] for r in after["cvterm"].where("name in ('beast', 'dog', 'obsolete lost one', 'eats')").collect()}
    assert names == {"beast": 0, "dog": 0, "obsolete lost one": 1, "eats": 0}
    assert after["cvterm"].where("name = 'beast'").first()["definition"] == 'a "big" animal'
    assert after["cvterm_relationship"].count() == 2 and after["cvtermprop"].count() == 1
    less = ontology_import.import_ontology(after, terms.where("id <> 'T:2'"), typedefs, space, "T")
    acted = less.merges["cvterm"].where("_action <> 'keep'").collect()
    assert [(r["name"], r["is_obsolete"], r["_action"]) for r in acted] == [("obsolete dog", 1, "obsolete")]


def test_marker_is_a_whole_line_and_short_lines_are_reported(spark, tmp_path):
    row = "s\tx\tgene\t1\t9\t.\t+\t.\t"
    path = write(tmp_path / "m", f"##gff-version 3\n{row}ID=a;Note=see ##FASTA here\n{row}ID=b\nonly\tthree\tcells\n\n##FASTA\r\n>s\nACGT\n")
    lines = read_lines(spark, path)
    before, after = gff.annotation_lines(lines)
    assert [r["id"] for r in gff.parse_records(before).orderBy("pos").collect()] == ["a", "b"]
    assert [(r["item"], r["reason"]) for r in gff.malformed_lines(before).collect()] == [("only\tthree\tcells", "not nine columns")]
    assert [r["residues"] for r in gff.sequences_of_lines(after).collect()] == ["ACGT"]
    short = read_lines(spark, write(tmp_path / "g", "!gaf-version: 2.1\nDB\tid\n\n"))
    assert gff_import and gaf.parse_gaf(short).isEmpty() and [r["item"] for r in gaf.malformed_lines(short).collect()] == ["DB\tid"]


@pytest.mark.parametrize("gap,end", [("\n", "\n"), ("\r\n", "\r\n"), (" \n", "\n"), ("", "\n")])
def test_stanzas_need_no_blank_line(spark, tmp_path, gap, end):
    from helixframe.sources import ontology

    text = end.join(["format-version: 1.2", "default-namespace: n"]) + end
    for i in (1, 2):
        text += gap + end.join(["[Term]", f"id: X:{i}", f"name: t{i}"]) + end
    (tmp_path / "o.obo").write_bytes(text.encode())
    terms, _, namespace = ontology.read_obo(spark, str(tmp_path / "o.obo"))
    assert namespace == "n" and sorted((r["id"], r["name"]) for r in terms.collect()) == [("X:1", "t1"), ("X:2", "t2")]


def test_file_without_terms_is_refused(small, spark):
    from helixframe.plans import ontology_import
    from helixframe.sources import ontology

    empty = spark.createDataFrame([], "kind string, tags array<struct<tag string, value string>>")
    with pytest.raises((ValueError, LookupError)):
        ontology_import.import_ontology(small, ontology.obo_terms(empty), ontology.obo_typedefs(empty), "n", "GO")


def test_last_record_of_an_id_counts_as_a_whole(small, spark, tmp_path):
    path = write(tmp_path / "f", ">c1\nACGTACGT\n>c2\nAA\n>c1\nTTTT\n")
    records = gff_import.of_organism(small, fasta.read_fasta(spark, path), "ONE")
    got = load(small, fasta_import.import_fasta(small, records, "chromosome"))["feature"]
    assert {r["uniquename"]: (r["residues"], r["seqlen"]) for r in got.collect()} == {"c1": ("TTTT", 4), "c2": ("AA", 2)}


OWL_FILE = """<?xml version="1.0"?>
<!DOCTYPE rdf:RDF [
 <!ENTITY obo "http://purl.obolibrary.org/obo/" >
 <!ENTITY owl "http://www.w3.org/2002/07/owl#" >
]>
<rdf:RDF xmlns="http://www.w3.org/2002/07/owl#" xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:o="&owl;"
  xmlns:label="http://www.w3.org/2000/01/rdf-schema#" xmlns:obo="&obo;" xmlns:oio="http://www.geneontology.org/formats/oboInOwl#">
 <Ontology rdf:about="&obo;x.owl"/>
 <!-- <o:Class rdf:about="&obo;GO_9"><label:label>not this</label:label></o:Class> -->
 <o:ObjectProperty   rdf:about='&obo;x#part_of'><label:label>part of</label:label></o:ObjectProperty>
 <rdf:Description rdf:about="&obo;x#has_part"><rdf:type rdf:resource="&owl;ObjectProperty"/></rdf:Description>
 <o:Class
   xml:base="x>y"  rdf:about="&obo;GO_1">
  <label:label xml:lang="en">one &lt; two</label:label><obo:IAO_0000115><![CDATA[a <b>bold</b> text]]></obo:IAO_0000115>
  <oio:hasExactSynonym>uno</oio:hasExactSynonym>
 </o:Class>
 <Class rdf:ID="GO_2"><label:label>two</label:label><label:subClassOf rdf:resource="&obo;GO_1"/>
  <label:subClassOf><Restriction><onProperty rdf:resource="&obo;x#part_of"/><someValuesFrom rdf:resource="&obo;GO_3"/></Restriction></label:subClassOf></Class>
 <rdf:Description rdf:about="&obo;GO_3"><rdf:type rdf:resource="&owl;Class"/><label:label>three</label:label>
  <label:subClassOf><o:Class rdf:about="&obo;GO_2"/></label:subClassOf><o:deprecated>true</o:deprecated></rdf:Description>
 <o:Class rdf:about="&obo;GO_4"/>
 <o:Axiom><o:annotatedSource rdf:resource="&obo;GO_1"/></o:Axiom>
</rdf:RDF>
"""


def test_owl_forms(spark, tmp_path, tiny_splits):
    """Prefixes, entities, rdf:ID, attribute order, descriptions, nested classes, comments and CDATA, over many splits."""
    path = write(tmp_path / "owl", OWL_FILE)
    elements = ontology.owl_elements(spark, path)
    terms = {r["id"]: r for r in ontology.owl_terms(elements).collect()}
    assert {k: (r["name"], r["is_obsolete"]) for k, r in terms.items()} == {
        "GO:1": ("one < two", False), "GO:2": ("two", False), "GO:3": ("three", True)}
    assert terms["GO:1"]["definition"] == "a <b>bold</b> text" and terms["GO:1"]["synonyms"] == [("uno", "exact")]
    assert [tuple(x) for x in terms["GO:2"]["relations"]] == [("is_a", "GO:1"), ("part_of", "GO:3")]
    assert [tuple(x) for x in terms["GO:3"]["relations"]] == [("is_a", "GO:2")]
    assert {r["name"] for r in ontology.owl_typedefs(elements).collect()} == {"part_of", "has_part"}
