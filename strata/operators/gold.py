"""Gold: counts, ordering, top-k, opening nested JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, *cols: str, top: int | None = None) -> DataFrame:
    """A3/O1/O2: rows per group, most frequent first, ties broken by the keys.

    With ``top`` the ordered limit is a top-k (each task keeps k rows).
    """
    out = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    out = out.orderBy(F.col("n").desc(), *[F.col(c).asc_nulls_last() for c in cols])
    return out.limit(top) if top is not None else out


def explode_json(df: DataFrame, col: str, ddl: str, alias: str = "item", pos: bool = True) -> DataFrame:
    """One row per element of a JSON array text (empty/NULL arrays keep a NULL row)."""
    arr = F.from_json(F.col(col), ddl)
    rest = [c for c in df.columns if c != col]
    if pos:
        return df.select(*rest, F.posexplode_outer(arr).alias("pos", alias))
    return df.select(*rest, F.explode_outer(arr).alias(alias))
