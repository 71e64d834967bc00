"""Staged raw responses for restart safety.

Fetched rows are appended to a parquet stage chunk by chunk; a restarted run fetches only ids the stage lacks (S7 against the stage) and unions both.
One parquet stage instead of one JSON file per id keeps the file count
proportional to tasks, not to ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import scratch_dir
from strata.sources.ids import new_ids


def stage_raw(bronze: DataFrame, path: str) -> None:
    """Append fetched Bronze rows to the stage (one action runs the fetch)."""
    bronze.write.mode("append").parquet(path)


def load_staged(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def load_staged_json(spark: SparkSession, path: str, key_type: str = "bigint") -> DataFrame:
    """Reads a ``{id}.json`` per-record layout: key from the file name, body whole."""
    raw = spark.read.text(path, wholetext=True).select(
        F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.json$", 1).alias("object_id"),
        F.col("value").alias("raw_json"))
    return raw.select(F.col("object_id").cast(key_type).alias("object_id"),
                      F.lit(200).alias("http_status"), "raw_json",
                      F.lit(None).cast("string").alias("error_message"))


def resume(spark: SparkSession, ids: DataFrame, stage_path: str, fetch, chunks: int = 16) -> DataFrame:
    """Fetch the ids the stage lacks, chunk by chunk, and return everything staged.

    Each of the ``chunks`` (by a hash of the id) is fetched and committed on its
    own, so a pull that dies keeps what its finished chunks got, and the next
    call requests only the rest. ``fetch`` maps an id DataFrame to Bronze rows
    (e.g. a partial of ``fetch_all``).
    """
    try:
        staged = load_staged(spark, stage_path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        staged = None          # the first run
    todo = ids if staged is None else new_ids(ids, staged)
    listed = scratch_dir(spark, "todo")
    (todo.withColumn("_chunk", F.pmod(F.xxhash64("id"), F.lit(chunks))).write.partitionBy("_chunk").parquet(listed))
    todo = spark.read.schema(T.StructType([*todo.schema.fields, T.StructField("_chunk", T.IntegerType())])).parquet(listed)
    for k in range(chunks):
        stage_raw(fetch(todo.where(F.col("_chunk") == k).drop("_chunk")), stage_path)
    return load_staged(spark, stage_path)
