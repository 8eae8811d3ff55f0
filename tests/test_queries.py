"""A cross-section of the registered queries against their SQL at the smallest scale.

``python -m verification.run <sf_dir>`` compares all of them.
"""

import pytest

from verification import catalog
from verification.run import compare, connect

SF = "/root/testdata/sf0.001"
NAMES = [
    "Q1_organisms", "Q2_public_organisms", "Q3_cvterms", "Q4_gene_products", "Q5_public_gene_products",
    "Q6_annotation_updates", "Q8_curator_comments", "Q10_products_of_organism", "Q12_ad_hoc_sql", "K1_delimited_rows",
    "K2_json_rows", "L5_annotations_by_ontology_and_organism", "L11_protein_features", "L23_missing_terms",
    "H1_gene_of_feature", "H6_feature_tree", "M8_feature", "M10_featureprop", "M12_feature_cvterm", "D7_mark_obsolete",
    "D9_delete_organism", "A1_capture_changes", "A5_stream_to_table", "V1_unique", "V2_foreign_keys", "S1_gff_records",
    "S3_embedded_sequences", "E1_gff_records", "E3_gene_sequences", "E7_gaf_records_gene", "S7_obo_terms", "S8_owl_terms",
]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    line = compare(spark, con, SF, name)
    assert line.startswith("ok"), line


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["organism_name", "transcript_id", "gene_id", "gene_name", "product", "rankalternative"]
    assert df.count() > 0
