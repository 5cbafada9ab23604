"""Incremental ingest: files of a landing folder become rows of a published table, each batch exactly once."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``. Where that is unset a local session gets a temporary one; on a cluster
    executors would each write to their own disk, so there this raises."""
    here = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not here and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{here or 'file://' + tempfile.mkdtemp(prefix='spark-cuvee-')}/stream-{uuid.uuid4().hex}"


def ingest(spark: SparkSession, landing: str, schema, table: str, checkpoint: str, pattern: str = "*") -> None:
    """Appends files that are new since the last run to ``table``, a folder by batch. A repeated batch overwrites its
    own folder, and a failing one leaves the checkpoint where it was, so nothing is lost or doubled."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch={number}")

    stream = spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(landing)
    run = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    run.awaitTermination()


def daily_counts(spark: SparkSession, path: str) -> DataFrame:
    """The events file through the stream, then counted by day and type."""
    base, _, name = path.rstrip("/").rpartition("/")
    here = shared(spark)
    schema = spark.read.parquet(path).schema
    if name.endswith(".parquet") and spark.read.format("binaryFile").load(path).select("path").limit(2).count() > 1:
        base, name = path, "*"
    ingest(spark, base, schema, f"{here}/events", f"{here}/checkpoint", name)
    d = spark.read.schema(schema).parquet(f"{here}/events")
    return d.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("n"))
