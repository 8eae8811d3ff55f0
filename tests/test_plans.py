"""Physical plans: what is pushed down, what is read, what is not shuffled."""

import re

import pytest

from helixframe import tables
from helixframe.operators import lookups, merge
from helixframe.plans import gff_export, reports
from verification import fixtures

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_type_names_reach_the_scan(spark):
    t = fixtures.tables(spark, SF)
    text = plan(lookups.relationships_by_type(t, ["derives_from"]))
    assert re.search(r"PushedFilters: \[.*(EqualTo|In)\(type_id", text)


def test_reports_do_not_read_residues(spark):
    text = plan(reports.gene_products(fixtures.tables(spark, SF)))
    schemas = re.findall(r"ReadSchema: (\S+)", text)
    assert schemas and not any("residues" in s for s in schemas)


def test_reports_have_no_cross_join(spark):
    t = fixtures.tables(spark, SF)
    for df in [reports.gene_products(t), reports.annotation_updates(t, "19960101"), reports.curator_comments(t), reports.organisms(t)]:
        text = plan(df)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_small_batch_does_not_shuffle_the_table(spark):
    t = fixtures.tables(spark, SF)
    resolved = spark.range(1).selectExpr("id as _target", "'x' as synonym_sgml")
    text = plan(merge.update_rows(t["synonym"], resolved, ["synonym_sgml"], "synonym_id"))
    physical = text[text.index("== Physical Plan =="):]
    assert "BroadcastHashJoin" in physical and "SortMergeJoin" not in physical


@pytest.mark.parametrize("make", [lookups.feature_properties, lookups.feature_synonyms, lookups.annotation_properties, gff_export.gff_records])
def test_type_names_are_joined_without_a_shuffle_on_types(spark, monkeypatch, make):
    exchange = re.compile(r"hashpartitioning\(type_id")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if no table were small
    try:
        assert not exchange.search(plan(make(fixtures.tables(spark, SF))))
        # Names beyond the bound are not forced to all tasks.
        monkeypatch.setattr(tables, "MOST_TERMS", 0)
        assert exchange.search(plan(make(fixtures.tables(spark, SF).with_tables({}))))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
