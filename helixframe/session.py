"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the jobs rely on. Skewed joins are split by AQE even when
# that costs an extra exchange, and joins only broadcast a side whose size
# Spark has measured to be under the threshold.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


# Rows that a task sorts after an exchange. Up to 200 partitions Spark writes an
# exchange without sorting it, so tasks grow before there are more of them.
TASK_ROWS, MOST_TASK_ROWS, PLAIN_PARTITIONS = 100_000, 1_500_000, 200


def partitions_for(rows: int) -> int:
    """Partitions of an exchange after which rows are sorted, so that no task has to spill.

    The number follows the rows, not the session's ``spark.sql.shuffle.partitions``.
    """
    return max(1, min(PLAIN_PARTITIONS, -(-rows // TASK_ROWS)), -(-rows // MOST_TASK_ROWS))


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for the length of one step."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a folder on this machine.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="helixframe-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder."""
    return f"{scratch_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and continue from there.

    They are kept as compressed columns: a later step reads only those it uses,
    and Spark knows how large the result is. Their order is not kept.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "cut")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fix_rows(df: DataFrame) -> DataFrame:
    """The same for rows whose partitions and order must stay as they are."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_root(spark))
    return df.checkpoint(eager=True)
