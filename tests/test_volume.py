"""What is written and exchanged on the way: shared views, cuts, marker join, association records."""

from pyspark.sql import functions as F

from helixframe.operators import deletion, hierarchy, lookups, merge, validate
from helixframe.plans import fasta_export, gaf_export, gaf_import, gff_import, ontology_import, reports
from helixframe.schema import TABLES
from helixframe.session import cut_lineage, partitions_for
from helixframe.sources import gaf, gff, ontology
from helixframe.sources.text import read_lines
from helixframe.tables import Tables
from verification import fixtures


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_shared_views_are_worked_out_once(spark, tmp_path):
    spark.range(3).select(F.col("id").alias("c_custkey"), F.lit(1).cast("int").alias("c_nationkey")).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(3).select(
        F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
        F.lit("1").alias("o_orderpriority")).write.parquet(f"{tmp_path}/orders.parquet")
    line = "1L AS l_partkey, 1L AS l_suppkey, 'A' AS l_returnflag, 'O' AS l_linestatus, timestamp '2020-01-01' AS l_shipdate"
    spark.range(6).selectExpr("id % 3 AS l_orderkey", "cast(id / 3 AS int) AS l_linenumber", line.split(", ")[0], *line.split(", ")[1:]).write.parquet(
        f"{tmp_path}/lineitem.parquet")
    t = fixtures.tables(spark, str(tmp_path))
    assert t["feature_relationship"].count() == 12
    root = fixtures._ROOTS[fixtures._key(spark, str(tmp_path))]
    made = fixtures._defined(spark, str(tmp_path), root, "feature_relationship")
    assert "lineitem" not in plan(made) and "Exchange" not in plan(made)
    shared = fixtures._defined(spark, str(tmp_path), root, "fx_model")
    assert plan(shared).count("hashpartitioning(l_orderkey") <= 1 and "l_linenumber#" not in "".join(
        x for x in plan(shared).splitlines() if "Exchange" in x)


def test_cut_rows_are_read_by_column(spark):
    df = spark.createDataFrame([(1, "a", ["x"]), (2, None, [])], "id long, name string, tags array<string>")
    cut = cut_lineage(df)
    assert cut.dtypes == df.dtypes
    assert sorted(map(tuple, cut.collect())) == [(1, "a", ["x"]), (2, None, [])]
    narrow = plan(cut.select("id"))
    assert "parquet" in narrow and "ReadSchema: struct<id:bigint>" in narrow


def test_lines_are_not_exchanged_to_find_the_marker(spark, tmp_path):
    (tmp_path / "a.gff").write_text("##gff-version 3\na\n##FASTA\n>s\nAC\n")
    (tmp_path / "b.gff").write_text("b\nc\n")
    before, after = gff.annotation_lines(read_lines(spark, str(tmp_path)))
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    held = spark.conf.get(threshold)
    assert sorted(r[0] for r in before.select("value").collect()) == ["##gff-version 3", "a", "b", "c"]
    assert sorted(r[0] for r in after.select("value").collect()) == [">s", "AC"]
    try:
        spark.conf.set(threshold, "-1")  # files too large to be broadcast by their size
        before, _ = gff.annotation_lines(read_lines(spark, str(tmp_path)))
        assert "SortMergeJoin" not in plan(before) and "BroadcastHashJoin" in plan(before)
    finally:
        spark.conf.set(threshold, held)


def test_association_records_are_exchanged_once(spark, small):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        records, _ = gaf_export.gaf_records(small, "Db")
        # The last exchange takes whole records to their annotations; none takes them to publications or genes before that.
        exchanges = [x for x in plan(records).splitlines() if "Exchange hashpartitioning(" in x]
        last = min(exchanges, key=lambda x: x.index("Exchange"))
        assert "hashpartitioning(feature_cvterm_id#" in last
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_features_after_an_import_are_read_not_merged_again(spark, small, tmp_path):
    (tmp_path / "a.gff").write_text("##gff-version 3\nseq\t.\tgene\t1\t9\t.\t+\t.\tID=g1;Name=n;translation=mk;odd=1\n")
    records = gff_import.of_organism(small, gff.read_gff(spark, str(tmp_path)), "ONE")
    result = gff_import.import_gff(small, records)
    held = result.features.select("feature_id", "organism_id", "uniquename")
    assert "Join" not in plan(held) and "Exchange" not in plan(held)
    assert sorted(map(tuple, held.collect())) == sorted(
        (r["feature_id"], r["organism_id"], r["uniquename"]) for r in merge.applied(result.merges["feature"]).collect())
    left = gff_import._without_merged(records).first()["attributes"]
    assert [a["key"] for a in left] == ["odd"]


def test_located_association_records_lose_what_nothing_reads(spark, small, tmp_path, monkeypatch):
    cells = ["Db", "g1", "abc", "", "GO:1", "PMID:1", "IDA", "", "P", "", "", "gene", "taxon:1", "20200101", "Db"]
    (tmp_path / "a.gaf").write_text("\t".join(cells) + "\n")
    held = []
    monkeypatch.setattr(gaf_import, "cut_lineage", lambda df: held.append(df.columns) or cut_lineage(df))
    gaf_import.import_gaf(small, gff_import.of_organism(small, gaf.read_gaf(spark, str(tmp_path)), "ONE"), "protein")
    located, linked = held[0], held[-1]
    assert "GO_ID" in located and not {"DB", "With", "DB_Reference", "Aspect", "Taxon_ID"} & set(located)
    assert "pubs" in linked and not {"DB_Object_Name", "DB_Object_Symbol", "Synonym", "GO_ID"} & set(linked)


def test_deleted_keys_are_worked_out_once(spark):
    feature = spark.createDataFrame([(1, 1), (2, 1), (3, 2)], "feature_id long, organism_id long")
    prop = spark.createDataFrame([(10, 1), (11, 3)], "featureprop_id long, feature_id long")
    frames = {n: spark.createDataFrame([], TABLES[n].struct) for n in TABLES}
    t = Tables.of(spark, {**frames, "feature": feature, "featureprop": prop})
    gone = deletion.doomed_rows(t, "feature", feature.where("organism_id = 1"))
    assert [sorted(r[0] for r in gone[n].collect()) for n in ("feature", "featureprop")] == [[1, 2], [10]]
    assert all("Join" not in plan(g) and "Exchange" not in plan(g) for g in gone.values())


def test_checks_count_keys_as_they_are_and_join_nothing(spark):
    terms = spark.createDataFrame(
        [(1, 1, 1, "a,b", None, 0, 0), (2, 1, 2, "a,b", None, 0, 0), (2, 1, None, None, None, 0, 0)], TABLES["cvterm"].struct)
    twice = validate.unique_violations(terms, "cvterm")
    assert "explode" not in plan(twice).lower() and "array" not in plan(twice)
    assert sorted(map(tuple, twice.collect())) == [("cvterm", "cvterm_id", "2", 2), ("cvterm", "name,cv_id,is_obsolete", "a,b,1,0", 2)]
    frames = {n: spark.createDataFrame([], TABLES[n].struct) for n in TABLES}
    cv = spark.createDataFrame([(1, "x", None), (None, "y", None)], TABLES["cv"].struct)
    prop = spark.createDataFrame([(1, 1, 9, "v", 0), (2, 1, 9, "v", 1), (3, None, 1, "v", 0), (4, 7, 1, "v", 0)], TABLES["cvtermprop"].struct)
    t = Tables.of(spark, {**frames, "cv": cv, "cvterm": terms, "cvtermprop": prop})
    found = validate.all_violations(t, ["cvterm", "cvtermprop"])["references"]
    assert "Join" not in plan(found)
    assert sorted(map(tuple, found.collect())) == [
        ("cvterm", "dbxref_id", 1, 1), ("cvterm", "dbxref_id", 2, 1), ("cvtermprop", "cvterm_id", 7, 1), ("cvtermprop", "type_id", 9, 2)]
    assert sorted(map(tuple, validate.reference_violations(t, prop, "cvtermprop").collect())) == [
        ("cvtermprop", "cvterm_id", 7, 1), ("cvtermprop", "type_id", 9, 2)]
    assert validate.reference_violations(t, cv, "cv").count() == 0


def test_flagged_features_are_found_without_an_exchange(spark, small, tmp_path):
    spark.range(3000).selectExpr(
        "id AS featureprop_id", "id AS feature_id", "-id AS type_id", "uuid() AS value", "0 AS rank").write.parquet(f"{tmp_path}/featureprop")
    spark.range(3000).selectExpr("id AS feature_id", "uuid() AS residues").write.parquet(f"{tmp_path}/feature")
    flag = spark.createDataFrame([(-1, 7, small.term_id("top_level_seq"), "true", 0)], "featureprop_id long, feature_id long, type_id long, value string, rank int")
    t = Tables.of(spark, {
        "cvterm": small["cvterm"], "cv": small["cv"], "feature": spark.read.parquet(f"{tmp_path}/feature"),
        "featureprop": spark.read.parquet(f"{tmp_path}/featureprop").unionByName(flag)})
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    held = spark.conf.get(threshold)
    try:
        spark.conf.set(threshold, "4000")
        found = lookups.features_with_property(t, "top_level_seq")
        assert "BroadcastHashJoin" in plan(found) and "hashpartitioning" not in plan(found)
        assert [r["feature_id"] for r in found.collect()] == [7]
    finally:
        spark.conf.set(threshold, held)


def test_locations_are_exchanged_once_for_genes(spark, small):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        loc = spark.createDataFrame([(1, 5, 9, 0, False, 2, False, 1, None, None, 0, 0)], TABLES["featureloc"].struct)
        genes, source = spark.createDataFrame([(5,)], "feature_id long"), spark.createDataFrame([(9, "ACGT")], "feature_id long, residues string")
        cut = fasta_export.gene_sequences(small.with_tables({"featureloc": loc}), genes, source)
        lines = plan(cut).splitlines()
        # No aggregate lies between the locations and their exchange by feature.
        first = next(i for i, x in enumerate(lines) if "fmin#" in x and "LocalTableScan" in x or "Scan ExistingRDD" in x and "fmin#" in x)
        exchange = max(i for i, x in enumerate(lines[:first]) if "Exchange hashpartitioning(feature_id#" in x)
        assert not any("Aggregate" in x for x in lines[exchange:first])
        assert [tuple(r) for r in cut.collect()] == [(5, "AC")]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_tasks_of_shared_views_follow_their_rows():
    assert [partitions_for(n) for n in (0, 1, 100_001, 36_000_000, 600_000_000)] == [1, 1, 2, 200, 400]


def test_parent_is_taken_from_the_path(spark):
    step = "struct<place:int,start:bigint,name:string,id:bigint>"
    s, g, x, p = (0, 0, "S", 1), (1, 5, "g", 2), (0, 0, "x", 3), (1, 0, "p", 4)
    paths = spark.createDataFrame([([s],), ([g],), ([g, x],), ([g, x, p],)], f"path array<{step}>")
    got = paths.select(*hierarchy.parent_of(F.col("path"))).collect()
    assert [tuple(r) for r in got] == [(None, None), (None, None), ("g", "part_of"), ("x", "derives_from")]


def _reported(spark, small, tmp_path):
    """Two products of two transcripts of one gene, in tables large enough that none is broadcast at 4 kB."""
    product, derives, part, flag = 5001, small.term_id("derives_from"), small.term_id("part_of"), small.term_id("genedb_public")
    one, two = small.name_id("organism", "ONE"), small.name_id("organism", "TWO")
    cv = small.name_id("cv", "genedb_products")
    feature = spark.createDataFrame(
        [(1, one, "g", False), (2, one, "t1", False), (3, one, "t2", True), (4, one, "p1", False), (5, one, "p2", False),
         (6, two, "h", False), (7, two, "u", False), (8, two, "q", False)],
        "feature_id long, organism_id long, uniquename string, is_obsolete boolean")
    more = spark.range(100, 3100).selectExpr("id AS feature_id", f"{one}L AS organism_id", "uuid() AS uniquename", "false AS is_obsolete")
    feature = feature.unionByName(more).selectExpr("*", f"{product}L AS type_id", "uniquename AS name")
    edge = spark.createDataFrame(
        [(2, 1, part), (3, 1, part), (4, 2, derives), (5, 3, derives), (7, 6, part), (8, 7, derives)], "subject_id long, object_id long, type_id long")
    more = spark.range(10000, 13000).selectExpr("id AS subject_id", "xxhash64(id) AS object_id", f"{part}L AS type_id")
    edge = edge.union(more).union(more.selectExpr("-subject_id", "object_id", f"{derives}L"))
    said = spark.createDataFrame([(4, product, 0), (4, product, 1), (5, product, 0), (8, product, 0)], "feature_id long, cvterm_id long, rank int")
    more = spark.range(10000, 13000).selectExpr("id AS feature_id", "xxhash64(id) AS cvterm_id", "0 AS rank")
    frames = {"feature": feature, "feature_relationship": edge, "feature_cvterm": said.unionByName(more)}
    for name, df in frames.items():
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}")
        frames[name] = spark.read.parquet(f"{tmp_path}/{name}")
    term = spark.createDataFrame([(product, cv, product, "kinase", None, 0, 0)], small["cvterm"].schema)
    flags = spark.createDataFrame([(901, one, flag, "true", 0), (902, one, flag, "yes", 0)], TABLES["organismprop"].struct)
    given = {n: small[n] for n in ("cv", "organism")} | {"cvterm": small["cvterm"].unionByName(term), "organismprop": flags}
    return Tables.of(spark, given | frames)


def test_public_organisms_are_found_without_an_exchange_of_features(spark, small, tmp_path):
    t = _reported(spark, small, tmp_path)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    held = spark.conf.get(threshold)
    try:
        spark.conf.set(threshold, "4000")
        found = reports.gene_products(t, public=True)
        assert "hashpartitioning(organism_id" not in plan(found)
        # An organism flagged twice doubles its rows.
        assert [tuple(r) for r in found.collect()] == [("ONE", "t1", "g", "g", "kinase", 0)] * 2 + [("ONE", "t1", "g", "g", "kinase", 1)] * 2
    finally:
        spark.conf.set(threshold, held)


def test_products_are_not_exchanged_to_find_transcripts_and_genes(spark, small, tmp_path):
    t = _reported(spark, small, tmp_path)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = reports.gene_products(t)
        exchanges = [x for x in plan(found).splitlines() if "Exchange hashpartitioning(" in x]
        # Paths, products and transcripts meet by transcript; a product's name meets them by product only.
        assert [sum(f"({key}#" in x for x in exchanges) for key in ("transcript_id", "gene_id", "product_id")] == [3, 2, 2]
        assert [tuple(r) for r in found.collect()] == [
            ("ONE", "t1", "g", "g", "kinase", 0), ("ONE", "t1", "g", "g", "kinase", 1), ("TWO", "u", "h", "h", "kinase", 0)]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _imported(spark, small, tmp_path, lines, t=None):
    (tmp_path / "in.gff").write_text("##gff-version 3\n##sequence-region seq 1 99\n" + "".join(f"seq\t.\t{x}\n" for x in lines))
    text = read_lines(spark, f"{tmp_path}/in.gff")
    of = lambda rows: gff_import.of_organism(small, rows, "ONE")
    return gff_import.import_gff(
        t or small, of(gff.read_gff(spark, f"{tmp_path}/in.gff")), full_genome=True, full_attributes=True,
        sequence_names=of(gff.sequence_names(text)))


LINES = [
    "gene\t1\t9\t.\t+\t.\tID=g1;Name=n%2C+m;synonym=s;literature=PMID:1;Dbxref=DB:a", "mRNA\t1\t9\t.\t+\t.\tID=g1.1;Parent=g1;protein_source_id=P1",
    "polypeptide\t1\t9\t.\t+\t.\tID=x;translation=mk;Derives_from=g1.1;comment=c", "strange\t1\t9\t.\t+\t.\tID=y",
    "mRNA\t2\t8\t.\t-\t.\tID=e;Parent=none;protein_source_id=P2", "CDS\t1\t9\t.\t+\t0\tParent=g1;protein_source_id=P3",
]


def _shown(result):
    skip = {"timeaccessioned", "timelastmodified"}
    return {n: sorted(map(repr, m.select(sorted(set(m.columns) - skip)).collect())) for n, m in result.merges.items()} | {
        "rejects": sorted(map(repr, result.rejects.collect())), "names": sorted(map(repr, result.features.collect()))}


def test_merges_of_an_import_are_worked_out_when_read(spark, small, tmp_path, monkeypatch):
    keys, targets = [], merge.targets
    monkeypatch.setattr(merge, "targets", lambda *a: keys.append(a[3]) or targets(*a))
    result = _imported(spark, small, tmp_path, LINES)
    # Features meet the table once, by name; every other table is resolved when somebody reads it.
    assert keys == [] and "featureloc" in result.merges
    loc = result.merges["featureloc"]
    assert keys == ["featureloc_id"] and result.merges["featureloc"] is loc
    assert {"feature", "db", "dbxref", "pub", "synonym", "feature_relationship"} <= set(result.merges)


def test_records_that_meet_the_table_once_give_the_same_import(spark, small, tmp_path, monkeypatch):
    first = _imported(spark, small, tmp_path, LINES)
    t = small.with_tables({n: cut_lineage(df) for n, df in first.tables().items()})
    lines = [x for x in LINES if "ID=e" not in x] + ["gene\t3\t7\t.\t+\t.\tID=g2;protein_source_id=P4"]
    again = _shown(_imported(spark, small, tmp_path, lines, t))
    monkeypatch.setattr(gff_import, "_located", lambda *a: None)
    assert again == _shown(_imported(spark, small, tmp_path, lines, t))
    assert [x for x in again["feature"] if "'e'" in x and "_action='update'" in x and "is_obsolete=True" in x]


def test_a_name_that_two_features_share_is_merged_as_before(spark, small, tmp_path, monkeypatch):
    first = _imported(spark, small, tmp_path, LINES).tables()
    twice = first["feature"].where("uniquename = 'g1'").withColumn("feature_id", F.col("feature_id") + 1)
    t = small.with_tables({n: cut_lineage(df) for n, df in (first | {"feature": first["feature"].unionByName(twice)}).items()})
    found = _shown(_imported(spark, small, tmp_path, LINES, t))
    monkeypatch.setattr(gff_import, "_located", lambda *a: None)
    assert found == _shown(_imported(spark, small, tmp_path, LINES, t))


def test_lines_are_parsed_once_for_records_and_rejected_types(spark, small, tmp_path):
    result = _imported(spark, small, tmp_path, LINES)
    unknown = result.rejects.where("reason = 'unknown feature type'")
    assert "FileScan text" not in plan(unknown) and [r["item"] for r in unknown.collect()] == ["strange"]


def test_text_without_a_percent_sign_is_not_decoded():
    assert "CASE WHEN contains(v, '%') THEN" in gff._attribute_expr()


def test_ontology_tables_are_read_with_few_joins(spark, small, tmp_path):
    (tmp_path / "o.obo").write_text(
        "default-namespace: animals\n\n[Term]\nid: T:1\nname: beast\nxref: DB:7\n\n[Term]\nid: T:2:5\nname: dog\nis_a: T:1\nsynonym: \"hound\" EXACT []\ncomment: good\n")
    terms, typedefs, space = ontology.read_obo(spark, f"{tmp_path}/o.obo")
    merges = ontology_import.import_ontology(small, terms, typedefs, space, "T").merges
    # What an import has worked out is written, not repeated below every table that builds on it.
    assert max(plan(m).count("Join") for m in merges.values()) <= 12
    assert [r["_action"] for r in merges["cvterm_relationship"].collect() if r["_action"] != "keep"] == ["insert"]
    assert [r["accession"] for r in merges["dbxref"].where("_action = 'insert'").orderBy("accession").collect()] == ["1", "2", "7"]


def test_rejected_associations_are_read_not_located_again(spark, small, tmp_path):
    cells = ["Db", "g1", "abc", "", "GO:1", "PMID:1", "IDA", "", "P", "", "", "gene", "taxon:1", "20200101", "Db"]
    (tmp_path / "a.gaf").write_text("\t".join(cells) + "\n")
    result = gaf_import.import_gaf(small, gff_import.of_organism(small, gaf.read_gaf(spark, str(tmp_path)), "ONE"), "protein")
    assert "FileScan text" not in plan(result.rejects) and plan(result.rejects).count("Join") <= 2
    assert [(r["item"], r["reason"]) for r in result.rejects.collect()] == [("g1", "unknown feature")]
    assert {"feature_cvtermprop", "feature_cvterm_dbxref", "feature_cvterm_pub", "synonym"} <= set(result.merges)


def test_annotations_are_worked_out_once_for_targets_and_records(spark, small):
    records, _ = gaf_export.gaf_records(small, "Db", level="protein")
    assert plan(records).count("Join") <= 16
    assert records.collect() == []
