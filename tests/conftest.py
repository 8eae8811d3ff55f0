import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    from helixframe.session import tune

    yield tune(session)
    session.stop()


@pytest.fixture(scope="session")
def small(spark):
    """A seeded, otherwise empty set of tables with two organisms."""
    from helixframe.plans.organisms import insert_organisms, seed
    from helixframe.session import cut_lineage
    from helixframe.tables import Tables

    base = Tables.of(spark, {})
    seeded = {n: cut_lineage(df) for n, df in seed(base, sequence_terms=True).tables().items()}
    extra = [("polypeptide", 1), ("pseudogene", 2)]
    cv = seeded["cv"].where("name = 'sequence'").first()["cv_id"]
    terms = spark.createDataFrame(
        [(i, cv, i, name, None, 0, 0) for name, i in extra], seeded["cvterm"].schema)
    seeded["cvterm"] = cut_lineage(seeded["cvterm"].unionByName(terms))
    go = [(901, "GO")]
    seeded["db"] = cut_lineage(seeded["db"].unionByName(
        spark.createDataFrame([(i, n, None, None, None) for i, n in go], seeded["db"].schema)))
    t = Tables.of(spark, seeded)
    rows = spark.createDataFrame(
        [("Plas", "one", "ONE", None, None, None, "v1", "5833", "Q1"), ("Plas", "two", "TWO", "s", "Two", None, None, None, None)],
        "genus string, species string, abbreviation string, infraspecific_name string, common_name string, comment string,"
        "genome_version string, taxon_id string, wikidata_id string",
    )
    result = {n: cut_lineage(df) for n, df in insert_organisms(t, rows).tables().items()}
    return Tables.of(spark, {**seeded, **result})
