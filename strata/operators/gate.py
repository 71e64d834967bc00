"""Comparison gate over computed metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Comparison operators of a condition task.
OPS = ("EQUAL_TO", "NOT_EQUAL", "GREATER_THAN", "GREATER_THAN_OR_EQUAL", "LESS_THAN", "LESS_THAN_OR_EQUAL")


def compare(left: Column, op: str, right: Column) -> Column:
    """Compare as numbers when both sides parse as doubles, else as text."""
    if op not in OPS:
        raise ValueError(f"op must be one of {OPS}")
    ls, rs = left.cast("string"), right.cast("string")
    ln, rn = ls.try_cast("double"), rs.try_cast("double")
    num = ln.isNotNull() & rn.isNotNull()

    def cmp(a, b):
        return {"EQUAL_TO": a == b, "NOT_EQUAL": a != b, "GREATER_THAN": a > b,
                "GREATER_THAN_OR_EQUAL": a >= b, "LESS_THAN": a < b, "LESS_THAN_OR_EQUAL": a <= b}[op]

    return F.when(num, cmp(ln, rn)).otherwise(cmp(ls, rs))


def gate(metrics: DataFrame, metric: str, op: str, threshold) -> DataFrame:
    """Rows of ``metrics`` with a ``passed`` verdict column for ``metric op threshold``."""
    return metrics.withColumn("passed", F.coalesce(compare(F.col(metric), op, F.lit(str(threshold))),
                                                   F.lit(False)))
