"""Run the headline queries and print one JSON line with their times."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from verification import catalog, fixtures

HEADLINE = [
    "Q4_gene_products", "Q1_organisms", "Q3_cvterms", "Q5_public_gene_products", "Q6_annotation_updates",
    "Q7_public_annotation_updates", "Q8_curator_comments", "Q9_public_curator_comments", "Q12_ad_hoc_sql",
    "L5_annotations_by_ontology_and_organism", "L6_parent_features", "L11_protein_features", "L15_feature_synonyms",
    "H1_gene_of_feature", "H3_protein_of_feature", "H6_feature_tree", "M8_feature", "M10_featureprop", "D7_mark_obsolete",
    "D9_delete_organism", "S1_gff_records", "I1_features", "I1e_relationships", "I3d_ontology_terms", "E1_gff_records",
    "E3_gene_sequences", "E4_protein_sequences", "E7_gaf_records_default", "A1_capture_changes", "V2_foreign_keys",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    started = time.time()
    tables = fixtures.tables(spark, sf_dir)
    for name in fixtures.STORED:
        tables[name]
    setup = time.time() - started
    times = {}
    for name in names:
        began = time.time()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - began, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "setup_sec": round(setup, 3),
    }))


if __name__ == "__main__":
    main()
