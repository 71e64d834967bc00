"""Joins beyond equality (J4): band joins as bin equi-joins.

A predicate ``r.t BETWEEN l.t + lo AND l.t + hi`` has no equality key, so a
plain join falls back to a nested loop (every pair examined). Cutting time
into bins of width ``hi - lo`` turns it into an equi-join on the bin: each
right row is tried against the one or two left bins it can match, and the
exact predicate is applied after. Work and shuffle grow with matches, not
with |L| x |R|; AQE's skew-join splitting covers a hot bin.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.selection import range_number
from strata.session import scratch_dir


def _micros(c):
    return F.unix_micros(F.col(c).cast("timestamp"))


def _to_micros(seconds: float) -> int:
    return round(seconds * 1_000_000)


def band_join(left: DataFrame, right: DataFrame, left_ts: str, right_ts: str, lo_seconds: float,
              hi_seconds: float, on: Sequence[str] = (), how: str = "inner") -> DataFrame:
    """Rows where ``left_ts + lo <= right_ts <= left_ts + hi`` (and equal ``on`` keys), in whole microseconds.

    Column names of the two sides must not collide except for ``on``.
    """
    lo, hi = _to_micros(lo_seconds), _to_micros(hi_seconds)
    if hi < lo:
        raise ValueError("hi_seconds must be >= lo_seconds")
    width = max(hi - lo, 1)
    l2 = left.withColumn("_from", _micros(left_ts) + F.lit(lo))
    l2 = l2.withColumn("_bin", F.expr(f"_from div {width} - cast(_from % {width} < 0 as bigint)"))
    # a right row in bin b can match left rows whose window starts in bin b or b-1
    r2 = right.withColumn("_at", _micros(right_ts))
    own = F.expr(f"_at div {width} - cast(_at % {width} < 0 as bigint)")
    r2 = r2.withColumn("_bin", F.explode(F.array(own, own - F.lit(1))))
    cond = [l2["_bin"] == r2["_bin"]] + [l2[k] == r2[k] for k in on]
    cond += [r2["_at"] >= l2["_from"], r2["_at"] <= l2["_from"] + F.lit(hi - lo)]
    j = l2.join(r2, cond, "inner")
    cols = [l2[c] for c in left.columns] + [r2[c] for c in right.columns if c not in on]
    out = j.select(*cols)
    if how == "inner":
        return out
    if how == "left":
        return _left_keep(left, out)
    raise ValueError("how must be 'inner' or 'left'")


def band_count(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, lo_seconds: float,
               hi_seconds: float, bins: int | None = None) -> DataFrame:
    """``key`` and the number ``n`` of right rows with ``left_ts + lo <= right_ts <= left_ts + hi``.

    No pair is made. Both ends of a left row's band ask how many right rows lie
    before them. Right rows and questions are first counted per instant, so an
    instant that a third of all rows share is one row; the instants go into bins
    of even numbers of them (quantiles), and a count is that of all earlier bins
    plus a running sum inside the bin. A busy hour is cut into as many bins as
    its instants need. Rows of ``left`` have distinct keys; those with a null
    time count 0.
    """
    spark = left.sparkSession
    lo, hi = _to_micros(lo_seconds), _to_micros(hi_seconds)
    at = _micros(left_ts)
    # side -1 stands before a right row of the same instant, side 1 after it
    ends = left.select(key, F.explode(F.array(
        F.struct((at + F.lit(lo)).alias("at"), F.lit(-1).alias("side")),
        F.struct((at + F.lit(hi)).alias("at"), F.lit(1).alias("side")))).alias("e")).select(key, "e.at", "e.side")
    points = right.select(_micros(right_ts).alias("at"), F.lit(0).alias("side"), F.lit(1).alias("c"))
    asked = ends.select("at", "side", F.lit(0).alias("c"))
    instants = points.unionByName(asked).where("at is not null").groupBy("at", "side").agg(F.sum("c").alias("c"))
    path = scratch_dir(spark, "instants")
    instants.write.parquet(path)
    instants = spark.read.schema(instants.schema).parquet(path)
    bins = bins or 4 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    cuts = instants.approxQuantile("at", [i / bins for i in range(1, bins)], 0.2 / bins) if bins > 1 else []
    binned = instants.withColumn("bin", range_number(F.col("at"), [int(c) for c in sorted(set(cuts))]))
    order = Window.partitionBy(F.lit(0)).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)      # a row per bin
    sums = binned.groupBy("bin").agg(F.sum("c").alias("c")).select("bin", F.coalesce(F.sum("c").over(order), F.lit(0)).alias("earlier"))
    inside = F.sum("c").over(Window.partitionBy("bin").orderBy("at", "side").rowsBetween(Window.unboundedPreceding, 0))
    before = binned.withColumn("inside", inside).where("side <> 0").join(sums, "bin")
    before = before.select("at", "side", (F.col("earlier") + F.col("inside")).alias("before"))
    counts = ends.join(before, ["at", "side"]).groupBy(key).agg(F.sum(F.col("side") * F.col("before")).cast("bigint").alias("n"))
    return left.select(key).join(counts, key, "left").select(key, F.coalesce("n", F.lit(0)).alias("n"))


def _left_keep(left: DataFrame, matched: DataFrame) -> DataFrame:
    """Left rows without a match, appended with NULL right columns.

    The anti join compares every left column NULL-safely (``<=>``), so a left
    row holding NULLs is recognised as matched.
    """
    hit = matched.select(*[F.col(c).alias(f"_m_{c}") for c in left.columns]).distinct()
    cond = [left[c].eqNullSafe(hit[f"_m_{c}"]) for c in left.columns]
    unmatched = left.join(hit, cond, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)
