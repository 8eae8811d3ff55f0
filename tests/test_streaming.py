import os

from pyspark.sql import functions as F

from helixframe.streaming import audit_stream

SCHEMA = "audit_id long, type string, row_id long, value string"


def expected(rows):
    last = {}
    for audit_id, kind, row_id, value in sorted(rows):
        if kind != "BEFORE":
            last[row_id] = (audit_id, kind, value)
    return {(k, *v) for k, v in last.items() if v[1] != "DELETE"}


def test_table_survives_restarts(spark, tmp_path):
    events, state, checkpoint = (f"file://{tmp_path}/{n}" for n in ("events", "state", "checkpoint"))
    done = []

    def arrive(rows):
        done.extend(rows)
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(events)

    def run(check=checkpoint):
        stream = audit_stream.change_events(spark, events, spark.createDataFrame([], SCHEMA).schema)
        audit_stream.maintain_table(stream, "row_id", state, check, buckets=4).awaitTermination()
        columns = stream.schema
        got = audit_stream.current_rows(spark, state, columns).select("row_id", "audit_id", "type", "value")
        assert {tuple(r) for r in got.collect()} == expected(done)

    def files():
        return {os.path.join(d, f) for d, _, fs in os.walk(tmp_path / "state" / "rows") for f in fs if f.endswith(".parquet")}

    arrive([(i, "INSERT", i, f"v{i}") for i in range(40)] + [(100, "BEFORE", 3, "v3"), (101, "UPDATE", 3, "x"), (102, "DELETE", 4, None)])
    run()
    first = files()
    run()  # restarted without new files
    assert files() == first
    arrive([(203, "UPDATE", 7, "late"), (50, "UPDATE", 7, "early")])
    run()
    fresh = files() - first
    assert len({f.split("/bucket=")[1][0] for f in fresh}) == 1  # only the bucket of row 7 was written
    arrive([(300, "DELETE", 7, None), (301, "INSERT", 4, "again")])
    run(checkpoint + "-new")  # a new checkpoint reads all files again
    assert len(files()) <= 2 * 4 * 4


def test_nothing_yet(spark, tmp_path):
    columns = spark.createDataFrame([], SCHEMA).schema
    assert audit_stream.current_rows(spark, f"file://{tmp_path}/none", columns).agg(F.count("*")).first()[0] == 0
