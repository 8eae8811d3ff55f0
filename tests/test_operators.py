"""Merges, ranking, hierarchy, deletion, validation on rows small enough to check by hand."""

import random

import pytest
from pyspark.sql import functions as F

from helixframe.functions import expr
from helixframe.operators import changelog, deletion, hierarchy, merge, validate
from helixframe.schema import TABLES, audit_struct
from helixframe.session import cut_lineage
from helixframe.sinks.delimited import delimited_lines, json_lines
from helixframe.tables import Tables, write_snapshot


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def column(df, name):
    return sorted(r[0] for r in df.select(name).collect())


def test_update_keeps_old_value_for_null_but_takes_empty_text(spark):
    schema = "synonym_id long, name string, type_id long, synonym_sgml string"
    old = spark.createDataFrame([(1, "a", 1, "x"), (2, "b", 1, "y"), (3, "c", 1, "z")], schema)
    new = spark.createDataFrame([("a", 1, None), ("b", 1, ""), ("d", 1, "w")], "name string, type_id long, synonym_sgml string")
    out = merge.merge(old, new, "synonym").select("name", "synonym_sgml", "_action", "_touched")
    assert rows(out) == [
        ("a", "x", "keep", True), ("b", "", "update", True), ("c", "z", "keep", False), ("d", "w", "insert", True)
    ]


def test_match_with_several_rows_takes_lowest_id(spark):
    old = spark.createDataFrame(
        [(7, 1, 5, 1, False, 0), (3, 1, 5, 2, False, 0)],
        "feature_cvterm_id long, feature_id long, cvterm_id long, pub_id long, is_not boolean, rank int",
    )
    new = spark.createDataFrame([(1, 5, True)], "feature_id long, cvterm_id long, is_not boolean")
    out = merge.merge(old, new, "feature_cvterm").select("feature_cvterm_id", "is_not", "_action")
    assert rows(out) == [(3, True, "update"), (7, False, "keep")]


def test_merging_twice_changes_nothing(spark):
    schema = "pub_id long, feature_id long"
    empty = spark.createDataFrame([], "feature_pub_id long, feature_id long, pub_id long")
    batch = spark.createDataFrame([(1, 2), (1, 3)], schema)
    once = merge.applied(merge.merge(empty, batch, "feature_pub"))
    twice = merge.merge(once, batch, "feature_pub")
    assert column(twice, "_action") == ["keep", "keep"]


@pytest.mark.parametrize("hot", [0.0, 0.9])
def test_ordered_number_equals_brute_force(spark, hot):
    rng = random.Random(3)
    data = [("hot" if rng.random() < hot else f"k{rng.randrange(5)}", rng.randrange(10), i) for i in range(500)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "k string, b int, v int").repartition(7)
    got = rows(expr.ordered_number(df, ["k"], [F.col("b")], [F.col("v")], "n"))
    want, seen = [], {}
    for k, b, v in sorted(data):
        seen[k] = seen.get(k, 0) + 1
        want.append((k, b, v, seen[k]))
    assert got == sorted(want)


def test_strand_phase_and_references(spark):
    df = spark.createDataFrame([("+", "0", "a:b"), ("-", "7", "a:b:c"), ("?", ".", "a"), (".", "2", "a:b:c:d")], "s string, p string, x string")
    out = df.select(expr.strand_number(F.col("s")), expr.phase_number(F.col("p")), expr.xref_parts(F.col("x")))
    assert [tuple(r[:2]) + (tuple(r[2]) if r[2] else None,) for r in out.collect()] == [
        (1, 0, ("a", "b", "")), (-1, None, ("a", "b", "c")), (None, None, None), (None, 2, None)
    ]


def test_quoting(spark):
    df = spark.createDataFrame([("a b/c~*+%é",)], "s string")
    assert df.select(expr.url_quote(F.col("s"))).first()[0] == "a%20b/c~%2A%2B%25%C3%A9"
    assert df.select(expr.percent_decode(expr.percent_encode(F.col("s"), ";=,&"))).first()[0] == "a b/c~*+%é"


def test_reverse_complement(spark):
    df = spark.createDataFrame([("AACGTNRY",)], "s string")
    assert df.select(expr.reverse_complement(F.col("s"))).first()[0] == "RYNACGTT"


def test_report_files(spark):
    df = spark.createDataFrame([("x", True, None), ("y", False, 3)], "b string, a boolean, c int").coalesce(1)
    assert [r[0] for r in delimited_lines(df, ";", header=True).collect()] == ["b;a;c", "x;t;", "y;f;3"]
    assert json_lines(df).first()[0] == '{"a":true,"b":"x","c":null}'


def family(spark, edges):
    names = sorted({n for e in edges for n in e[:2]} | {"S"})
    ids = {n: i + 1 for i, n in enumerate(names)}
    feature = spark.createDataFrame(
        [(ids[n], None, 1, None, n, None, 100, None, 4 if n == "S" else 1, False, False, None, None) for n in names],
        TABLES["feature"].struct,
    )
    types = {"part_of": 8, "derives_from": 7}
    relation = spark.createDataFrame(
        [(i, ids[c], ids[p], types[k], None, 0) for i, (c, p, k) in enumerate(edges)], TABLES["feature_relationship"].struct)
    terms = spark.createDataFrame(
        [(7, 1, 7, "derives_from", None, 0, 1), (8, 2, 8, "part_of", None, 0, 1), (15, 6, 15, "top_level_seq", None, 0, 0)],
        TABLES["cvterm"].struct,
    )
    cv = spark.createDataFrame([(1, "sequence", None), (2, "relationship", None), (6, "genedb_misc", None)], TABLES["cv"].struct)
    prop = spark.createDataFrame([(1, ids["S"], 15, "true", 0)], TABLES["featureprop"].struct)
    loc = spark.createDataFrame(
        [(ids[n], ids[n], ids["S"], 10 * ids[n], False, 10 * ids[n] + 5, False, 1, None, None, 0, 0) for n in names if n != "S"],
        TABLES["featureloc"].struct,
    )
    return Tables.of(spark, {"feature": feature, "feature_relationship": relation, "cvterm": terms, "cv": cv,
                             "featureprop": prop, "featureloc": loc})


def test_child_of_two_parents_appears_below_each(spark):
    t = family(spark, [("b", "a", "part_of"), ("b", "d", "part_of"), ("c", "b", "derives_from")])
    walk = [r["path"][-1]["name"] for r in hierarchy.tree(t).orderBy("sequence", "path").collect()]
    assert walk == ["S", "a", "b", "c", "d", "b", "c"]


def test_part_of_children_come_before_derived_ones(spark):
    t = family(spark, [("a", "g", "derives_from"), ("z", "g", "part_of")])
    walk = [r["path"][-1]["name"] for r in hierarchy.tree(t).orderBy("sequence", "path").collect()]
    assert walk == ["S", "g", "z", "a"]


def test_circular_relationships_are_reported(spark):
    t = family(spark, [("a", "S", "part_of"), ("b", "a", "part_of"), ("a", "b", "part_of")])
    with pytest.raises(hierarchy.CircularTree):
        hierarchy.tree(t)


def test_cascade_removes_children_and_clears_loose_references(spark):
    t = family(spark, [("b", "a", "part_of")])
    left = deletion.cascade_delete(t, "feature", t["feature"].where("uniquename = 'S'"))
    assert left["feature"].count() == 2
    assert left["featureloc"].where("srcfeature_id is null").count() == 2
    assert left["featureprop"].count() == 0 and left["feature_relationship"].count() == 1


def test_fresh_load_guard(small):
    assert deletion.guard_fresh_load(small, "ONE") is False


def test_snapshot_is_published_by_its_manifest(spark, tmp_path):
    path = str(tmp_path / "store")
    one = spark.createDataFrame([(1, "a", None, None, None)], TABLES["db"].struct)
    two = spark.createDataFrame([(1, "a", None, None, None), (2, "b", None, None, None)], TABLES["db"].struct)
    cv = spark.createDataFrame([(1, "c", None)], TABLES["cv"].struct)
    write_snapshot({"db": one, "cv": cv}, path)
    two.write.parquet(f"{path}/v2/db")  # a job that died before publishing
    assert Tables.read(spark, path)["db"].count() == 1
    write_snapshot({"db": two}, path, version=2)
    now = Tables.read(spark, path)
    assert now["db"].count() == 2 and now["cv"].count() == 1 and now["pub"].count() == 0


def test_checks_ignore_keys_with_nulls(spark):
    df = spark.createDataFrame(
        [(1, "x", "g", "s", None, None, None, None), (2, "y", "g", "s", None, None, None, None)], TABLES["organism"].struct)
    assert validate.unique_violations(df, "organism").count() == 0


def test_audit_schema_and_ageing(spark):
    assert audit_struct("db").names == ["audit_id", "type", "username", "time", "db_id", "name", "description", "urlprefix", "url"]
    log = spark.createDataFrame([(1, "2020-01-01"), (2, "2020-01-02"), (3, None)], "audit_id int, t string").select(
        "audit_id", F.col("t").cast("timestamp").alias("time"))
    old, rest = changelog.age_out(log, "2020-01-02")
    assert column(old, "audit_id") == [1] and column(rest, "audit_id") == [2, 3]


def test_moving_aged_rows_counts_them(spark, tmp_path):
    log = spark.createDataFrame([(1, "2020-01-01"), (2, "2021-01-02")], "audit_id int, t string").select(
        "audit_id", F.col("t").cast("timestamp").alias("time"))
    moved = changelog.move_aged({"db": log}, "2020-06-01", str(tmp_path / "b"), str(tmp_path / "k"))
    assert moved == 1 and spark.read.parquet(str(tmp_path / "k" / "db")).count() == 1
    assert changelog.move_aged({"db": log}, "2020-06-01", str(tmp_path / "b"), str(tmp_path / "k")) == 1
    assert spark.read.parquet(str(tmp_path / "b" / "db")).count() == 1  # again, and nothing doubled
    rest = spark.read.parquet(str(tmp_path / "k" / "db"))
    assert changelog.move_aged({"db": rest}, "2020-06-01", str(tmp_path / "b"), str(tmp_path / "k2")) == 0
    with pytest.raises(ValueError):
        changelog.move_aged({"db": rest}, "2020-06-01", str(tmp_path / "b"), str(tmp_path / "k"))


def test_catalogue_counts():
    assert len(TABLES) == 39
    assert sum(len(t.references) for t in TABLES.values()) == 75


def test_deep_trees_have_no_limit(spark):
    t = family(spark, [("n0", "g", "part_of")] + [(f"n{i + 1}", f"n{i}", "part_of") for i in range(24)])
    assert max(r["depth"] for r in hierarchy.tree(t).select("depth").collect()) == 25


def test_json_array_over_part_files(spark, tmp_path):
    import json

    from helixframe.sinks.delimited import json_array, write_json

    for n in (0, 1, 25):
        df = spark.range(n).repartitionByRange(5, "id").selectExpr("id AS b", "nullif(id, 3) AS a")
        write_json(df, str(tmp_path / f"j{n}"))
        files = sorted(p for p in (tmp_path / f"j{n}").iterdir() if p.name.startswith("part-"))
        assert json.loads("".join(p.read_text() for p in files)) == [{"a": None if i == 3 else i, "b": i} for i in range(n)]
    assert json_array(spark.range(1)).count() == 3


def test_snapshot_versions(spark, tmp_path):
    from helixframe.tables import Tables, write_snapshot

    row = lambda i: spark.createDataFrame([(i, f"db{i}", None, None, None)], TABLES["db"].struct)
    write_snapshot({"db": row(1)}, str(tmp_path), version=3)
    write_snapshot({"db": row(2)}, str(tmp_path), version=7)
    assert [r["db_id"] for r in Tables.read(spark, str(tmp_path))["db"].collect()] == [2]
    with pytest.raises(ValueError):
        write_snapshot({"db": row(3)}, str(tmp_path), version=7)


def test_repeated_organism_counts_once(spark, small):
    columns = ["genus", "species", "abbreviation", "infraspecific_name", "common_name", "comment", "genome_version", "taxon_id", "wikidata_id"]
    schema = ", ".join(f"{c} string" for c in columns) + ", pos int"
    rows = [("G", "s", "NEW", None, None, "old", "v9", None, None, 1), ("G", "s", "NEW", None, None, "new", "v1", None, None, 2)]
    from helixframe.plans.organisms import insert_organisms

    result = insert_organisms(small, spark.createDataFrame(rows, schema)).tables()
    assert [r["comment"] for r in result["organism"].where("abbreviation = 'NEW'").collect()] == ["new"]
    new = result["organism"].where("abbreviation = 'NEW'").first()["organism_id"]
    assert [r["value"] for r in result["organismprop"].where(f"organism_id = {new}").collect()] == ["v1"]


def test_tree_works_out_edges_once_and_leaves_are_not_joined_again(spark, monkeypatch):
    t = family(spark, [("b", "a", "part_of"), ("c", "b", "part_of")])
    held = []
    monkeypatch.setattr(hierarchy, "cut_lineage", lambda df: held.append(df) or cut_lineage(df))
    assert {r["parent"] for r in hierarchy.tree(t).collect()} == {None, "a", "b"}
    levels = [df for df in held if "depth" in df.columns]
    assert len(levels) == 3  # the sequence and a, b, c; nothing is sought below c
    assert not any("Aggregate" in df._jdf.queryExecution().executedPlan().toString() for df in levels[1:])
