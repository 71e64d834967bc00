"""First n rows by a cut of the keys, even ranges, counts in bands of equal depth."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.operators.joins import band_count
from strata.operators.selection import first_n, range_number


def test_range_numbers_count_the_cuts_not_above(spark):
    cuts = [-3, 0, 4, 4, 9, 11, 30]
    got = spark.range(-10, 40).select("id", range_number(F.col("id"), cuts).alias("n")).collect()
    assert {r.id: r.n for r in got} == {i: sum(c <= i for c in cuts) for i in range(-10, 40)}
    assert spark.range(1).select(range_number(F.col("id"), []).alias("n")).first().n == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_first_rows_equal_a_sort(spark, seed):
    rng = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = [(rng.choice([None, 1.5, 2.5, float(rng.randrange(40))]), rng.choice([None, "b", "a" * rng.randrange(6)]),
             base + dt.timedelta(microseconds=rng.randrange(10 ** 9)), i) for i in range(3000)]
    rows += [(7.0, "copy", base, -1)] * 1500                       # a third of the rows are one row
    df = spark.createDataFrame(rows, "x double, s string, t timestamp, i int").repartition(5)
    order = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")
    want = sorted(map(order, rows))
    for n in (0, 1, 99, 1200, 2000, 4400, 4500, 9000):
        got = first_n(df, n, ["x", "s"], top_k=100).collect()
        assert sorted(map(order, got)) == want[:n]
        assert not Counter(tuple(r) for r in got) - Counter(rows)                 # rows of the table, no more often than there


def test_first_rows_are_the_same_each_time(spark):
    df = spark.range(4000).selectExpr("id % 3 AS k", "id", "map('a', id) AS m")
    one, two = (sorted(r.id for r in first_n(df.repartition(p), 2000, ["k"], top_k=50).collect()) for p in (3, 7))
    assert one == two and len(one) == 2000


def test_many_rows_leave_from_many_tasks(spark):
    out = first_n(spark.range(0, 300_000, 1, 8).select(F.xxhash64("id").alias("id")), 200_000, ["id"])
    sizes = [r.n for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 200_000 and len(sizes) >= 8 and max(sizes) <= 40_000


def test_a_busy_hour_is_many_bins(spark):
    """A third of all rows lie in one hour, and a third of those in one instant."""
    rng = random.Random(4)
    at = lambda: rng.randrange(0, 40 * 86_400) if rng.random() < 0.66 else rng.choice([5 * 3600, 5 * 3600 + rng.randrange(3600)])
    left, right = [(i, at()) for i in range(300)], [(i, at()) for i in range(6000)]
    mk = lambda rows, a, b: spark.createDataFrame(rows, f"{a} int, s int").select(a, F.timestamp_seconds("s").alias(b))
    seen = []
    import strata.operators.joins as J

    real = J.range_number
    J.range_number = lambda value, cuts: seen.append(cuts) or real(value, cuts)
    try:
        got = {r.lid: r.n for r in band_count(mk(left, "lid", "lt"), mk(right, "rid", "rt"), "lid", "lt", "rt", -60, 7200, bins=24).collect()}
    finally:
        J.range_number = real
    assert got == {i: sum(t - 60 <= u <= t + 7200 for _, u in right) for i, t in left}
    instants = {u * 10 ** 6 for _, u in right} | {(t + d) * 10 ** 6 for _, t in left for d in (-60, 7200)}
    per_bin = Counter(sum(c <= u for c in seen[0]) for u in instants)
    assert len(per_bin) == 24 and max(per_bin.values()) < 3 * sorted(per_bin.values())[12]
