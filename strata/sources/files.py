"""File and table sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# CSV defaults of the file-ingest template.
CSV_DEFAULTS = {"header": "true", "inferSchema": "true", "sep": ",", "nullValue": ""}


def list_files(spark: SparkSession, path: str, n: int | None = None) -> list[str]:
    """Paths under a glob in ascending order, the first ``n`` of them; no file is opened."""
    if n is not None and n < 0:
        raise ValueError("max_files must be >= 0 or None")
    paths = spark.read.format("binaryFile").load(path).select("path").orderBy("path")
    return [r["path"] for r in (paths if n is None else paths.limit(n)).collect()]


def read_files(spark: SparkSession, prefix: str, pattern: str = "*", fmt: str = "csv",
               options: dict | None = None, schema=None, max_files: int | None = None) -> DataFrame:
    """Scan ``prefix/pattern`` in a format; explicit schema preferred.

    ``max_files`` takes the first files in path order: the paths are listed, and
    only the chosen files are read. Inference costs an extra pass over the
    input; pass ``schema`` in production.
    """
    path = f"{prefix.rstrip('/')}/{pattern}"
    reader = spark.read.format(fmt)
    opts = dict(CSV_DEFAULTS) if fmt == "csv" else {}
    if schema is not None:
        opts.pop("inferSchema", None)
        reader = reader.schema(schema)
    opts.update({k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in (options or {}).items()})
    reader = reader.options(**opts)
    if max_files is None:
        return reader.load(path)
    chosen = list_files(spark, path, max_files)
    if not chosen:
        return reader.load(path).limit(0)
    return reader.load(chosen)


def with_provenance(df: DataFrame, file_col: str = "source_file", ts_col: str = "ingested_at") -> DataFrame:
    """File path from the hidden ``_metadata`` column plus a load timestamp."""
    return df.withColumn(file_col, F.col("_metadata.file_path")).withColumn(ts_col, F.current_timestamp())


def file_counts(df: DataFrame, file_col: str = "source_file") -> DataFrame:
    """A5: rows per file (partial counts per task, then one small shuffle)."""
    return df.groupBy(file_col).agg(F.count(F.lit(1)).alias("n_rows"))


def read_table(spark: SparkSession, name: str, max_rows: int | None = None,
               order_by: list[str] | None = None) -> DataFrame:
    """Table by name with an optional, ordered (so repeatable) row cap."""
    df = spark.table(name)
    if max_rows is None:
        return df
    if max_rows < 0:
        raise ValueError("max_rows must be >= 0 or None")
    from strata.operators.selection import first_n

    return first_n(df, max_rows, list(order_by or df.columns))


def literal_rows(spark: SparkSession, n: int = 1, **values) -> DataFrame:
    """``n`` rows of literal columns (``spark.range`` + ``lit``)."""
    cols = [F.lit(v).alias(k) for k, v in values.items()]
    return spark.range(n).select(*(cols or [F.col("id")]))
