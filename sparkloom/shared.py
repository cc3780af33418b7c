"""The folder that a cluster shares, for tables that are worked out once and read again, and session settings."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, *, set_checkpoints: bool = False) -> str:
    """The folder that spark.checkpoint.dir names; where that is unset and Spark runs in one process, a temporary one.

    set_checkpoints: RDDs can be checkpointed there from then on."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        if set_checkpoints and spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
            spark.sparkContext.setCheckpointDir(folder)
        return folder
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    used = spark.sparkContext._jsc.sc().getCheckpointDir()
    if used.isEmpty():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoint-"))
        used = spark.sparkContext._jsc.sc().getCheckpointDir()
    return used.get()


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Bound what one Arrow batch holds; rows of texts and pages can be large."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def written(df: DataFrame) -> DataFrame:
    """The rows, written as Parquet to the shared folder and read again."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
