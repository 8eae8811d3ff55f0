import corpus_pipeline
from helixframe.llm import queries

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == COLUMNS, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        now = [r["doc_id"] for r in docs.select("doc_id").collect()]
        assert set(now) <= ids and len(now) > 0.5 * len(ids), name
        assert name == "mixing" or len(now) == len(set(now))
        ids = set(now)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert last.count() == docs.count()


def test_stages_on_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, extra int")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
    assert docs.count() == 0


def test_registered():
    import __spark_entry__

    assert set(queries.QUERIES) <= set(__spark_entry__.queries())
    assert [sum(q.startswith(f"op{n}_") for q in queries.QUERIES) for n in range(1, 11)] == [1] * 10
