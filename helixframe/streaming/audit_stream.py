"""The change log as a stream: append events, and keep a table up to date."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery


def change_events(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """Change events arriving as Parquet files below ``path``."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def once_per_event(events: DataFrame, delay: str) -> DataFrame:
    """Drop repeated deliveries of an event; state older than ``delay`` is forgotten."""
    return events.withWatermark("time", delay).dropDuplicatesWithinWatermark(["audit_id"])


def append_log(events: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """Append every event to the log, partitioned by day, exactly once."""
    return (
        events.withColumn("day", F.to_date("time")).writeStream.format("parquet").outputMode("append")
        .partitionBy("day").option("checkpointLocation", checkpoint).option("path", sink)
        .trigger(availableNow=True).start()
    )


def latest_per_row(events: DataFrame, key: str) -> DataFrame:
    """The last event of each row (by audit_id); BEFORE images carry no new state."""
    data = [c for c in events.columns if c not in (key,)]
    last = F.max_by(F.struct(*data), "audit_id")
    return events.where(F.col("type") != "BEFORE").groupBy(key).agg(last.alias("e")).select(key, "e.*")


#: A state folder holds ``rows/bucket=<b>/slot=<0 or 1>`` and, per finished batch, one pointer that names each bucket's slot.
POINTER = "seq long, source string, batch long, bucket int, slot int"


def _pointer(spark: SparkSession, state: str) -> list[Row]:
    """The rows of the last pointer: one per bucket in use."""
    try:
        rows = spark.read.schema(POINTER).json(f"{state}/pointer")
        return rows.where(F.col("seq") == rows.agg(F.max("seq")).first()[0]).collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def _slots(spark: SparkSession, state: str, columns: T.StructType, held: list[tuple[int, int]]) -> DataFrame:
    """Rows of the given buckets in their slots."""
    if not held:
        return spark.createDataFrame([], columns)
    placed = T.StructType([*columns.fields, T.StructField("bucket", T.IntegerType()), T.StructField("slot", T.IntegerType())])
    paths = [f"{state}/rows/bucket={bucket}/slot={slot}" for bucket, slot in held]
    return spark.read.schema(placed).option("basePath", f"{state}/rows").parquet(*paths).drop("bucket", "slot")


def maintain_table(events: DataFrame, key: str, state: str, checkpoint: str, buckets: int = 16) -> StreamingQuery:
    """Keep the current rows (and tombstones) of a table below ``state``.

    Rows lie in buckets by a hash of the key. A batch reads and writes only the buckets that its events fall into: the new
    rows go into the slot of the bucket that no pointer names, and the pointer is written last. So a batch that is run
    again writes the same slots again, one that was finished is left out, and no more than two versions of a bucket are
    kept; a reader may stay one batch behind. The greatest audit_id wins, whatever the order of arrival; a deleted row
    stays as a DELETE tombstone. A new checkpoint over the same state goes on from its last pointer.
    """
    columns = T.StructType([events.schema[key], *[f for f in events.schema.fields if f.name != key]])

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = _pointer(spark, state)
        last = before[0] if before else None
        if last is not None and last["source"] == checkpoint and last["batch"] >= number:
            return
        slots = {r["bucket"]: r["slot"] for r in before}
        batch.persist()  # one read of the batch for its buckets and for its rows
        placed = latest_per_row(batch, key).withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        touched = sorted(r["bucket"] for r in placed.select("bucket").distinct().collect())
        if touched:
            known = _slots(spark, state, columns, [(b, slots[b]) for b in touched if b in slots])
            now = latest_per_row(known.unionByName(placed.select(*columns.names)), key)
            fresh = {b: 1 - slots.get(b, 1) for b in touched}
            slot = F.element_at(F.create_map(*[F.lit(x) for pair in fresh.items() for x in pair]), F.col("bucket"))
            now = now.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).withColumn("slot", slot)
            now.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "slot").parquet(f"{state}/rows")
            slots |= fresh
        batch.unpersist()
        if slots:
            seq = last["seq"] + 1 if last is not None else 0
            rows = [(seq, checkpoint, number, b, s) for b, s in sorted(slots.items())]
            spark.createDataFrame(rows, POINTER).coalesce(1).write.mode("append").json(f"{state}/pointer")

    return (
        events.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def current_rows(spark: SparkSession, state: str, columns: T.StructType) -> DataFrame:
    """The table after the last finished batch, also after a restart without new events."""
    held = [(r["bucket"], r["slot"]) for r in _pointer(spark, state)]
    return _slots(spark, state, columns, held).where(F.col("type") != "DELETE")
