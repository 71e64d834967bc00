"""Triggered incremental file ingest and streaming upserts.

Each run processes only files/rows it has not seen (the checkpoint records
them); ``availableNow`` drains what is there and stops, so a scheduler can
run it like a batch job. Sinks are exactly-once: the file sink commits per
batch, and ``foreachBatch`` upserts are idempotent on the key.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.state import run_status
from strata.operators.tables import ensure_schema_of, show_folder, upsert
from strata.session import scratch_dir


MAX_FILES_PER_TRIGGER = 1000


def read_stream(spark: SparkSession, path: str, schema, fmt: str = "json", options: dict | None = None,
                max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """File stream with provenance columns.

    Micro-batches are bounded (``maxFilesPerTrigger``; ``availableNow``
    honours it), so a backfill of a large landing folder runs as many
    restartable batches instead of one giant one.
    """
    r = spark.readStream.format(fmt).schema(schema).options(**(options or {}))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return (r.load(path).withColumn("source_file", F.col("_metadata.file_path"))
            .withColumn("ingested_at", F.current_timestamp()))


def ingest_stream(spark: SparkSession, path: str, schema, target_path: str, checkpoint: str,
                  fmt: str = "json", options: dict | None = None, partition_by: Sequence[str] = (), table: str | None = None):
    """R2: append new files under ``path`` to a parquet folder, then stop. ``table`` is a name for readers of the folder."""
    w = (read_stream(spark, path, schema, fmt, options).writeStream.format("parquet")
         .option("checkpointLocation", checkpoint).option("path", target_path)
         .outputMode("append").trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start()
    q.awaitTermination()
    if table:
        ensure_schema_of(spark, table)
        show_folder(spark, table, target_path)
    return q


def upsert_stream(spark: SparkSession, stream: DataFrame, table: str, keys: Sequence[str],
                  order_by: Sequence[str], checkpoint: str, available_now: bool = True):
    """Every micro-batch is upserted on the key (W4), evaluated once; replays are harmless."""
    def each(batch: DataFrame, batch_id: int) -> None:
        upsert(spark, batch, table, keys, order_by)

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def run_status_stream(spark: SparkSession, stream: DataFrame, table: str, run: str, state: str, ts: str,
                      terminal: Sequence[str], checkpoint: str, available_now: bool = True):
    """Latest state per run kept current from an observation stream; ``table`` has one row per run.

    The runs' status lives in the stream's state store, which is saved with the
    checkpoint: a batch changes the states of the runs it observes (one row per
    run, whatever the number of batches) and the changed ones are upserted by
    run. A batch that is run again starts from the state before it and gives the
    same rows. It is the aggregation of ``run_status`` in update mode, which keeps
    its state in the JVM; Python state functions would have nothing to add.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        upsert(spark, batch, table, [run])

    w = run_status(stream, run, state, ts, terminal).writeStream.outputMode("update").foreachBatch(each)
    w = w.option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def full_refresh_stream(spark: SparkSession, path: str, schema, target_path: str, checkpoint: str | None = None,
                        fmt: str = "json", options: dict | None = None, partition_by: Sequence[str] = (),
                        table: str | None = None) -> tuple[str, str]:
    """Build a streamed target anew beside the old one, with a checkpoint of its own.

    Returns (folder of the new target, its checkpoint). The old target is not
    touched: readers of ``table`` switch to the new folder, at once, when the
    build is done. A build that was interrupted goes on if called again with the
    same ``checkpoint``, which also names the folder, so choose it before the call.
    """
    checkpoint = (checkpoint or scratch_dir(spark, "ckpt")).rstrip("/")
    target = f"{target_path.rstrip('/')}-{checkpoint.rsplit('/', 1)[1]}"
    ingest_stream(spark, path, schema, target, checkpoint, fmt, options, partition_by, table)
    return target, checkpoint
