"""Bronze-level operators: success/failure filters and ingest profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ok_rows(bronze: DataFrame) -> DataFrame:
    """``http_status = 200 AND raw_json IS NOT NULL`` (both pushed to the scan)."""
    return bronze.where((F.col("http_status") == 200) & F.col("raw_json").isNotNull())


def failed_rows(bronze: DataFrame) -> DataFrame:
    """Every non-200 row."""
    return bronze.where(F.col("http_status") != 200)


def ingest_quality(bronze: DataFrame) -> DataFrame:
    """A1/A2: rows, success, failure in one pass (failure = rows - success)."""
    return (bronze.agg(F.count(F.lit(1)).alias("rows"),
                       F.count_if(F.col("http_status") == 200).alias("success"))
            .withColumn("failure", F.col("rows") - F.col("success")))


def error_class(msg: Column | str = "error_message") -> Column:
    """Class of a Bronze error message: the leading word (``retries_exhausted`` ...); ``ok`` when none."""
    m = F.col(msg) if isinstance(msg, str) else msg
    return F.coalesce(F.nullif(F.regexp_extract(m, r"^([a-z_]+)", 1), F.lit("")), F.lit("ok"))


def error_profile(bronze: DataFrame) -> DataFrame:
    """A4: rows per (http_status, error class); partial counts per task, tiny shuffle."""
    return (bronze.groupBy(F.col("http_status"), error_class().alias("error_class"))
            .agg(F.count(F.lit(1)).alias("n")))
