"""The first n rows of an order without n rows in one task, and even ranges of a number.

A top-k query gathers its k rows in one task, which holds for a small k. Beyond
that ``first_n`` looks for the key at which the first n rows end: pivots cut the
keys into ranges, one aggregation counts the rows of each range, and the range
that holds the n-th row is cut again until it is small. What lies before it
leaves by a filter, from all the tasks that read it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOP_K_ROWS = 20_000     # rows that one task may gather
PIVOTS = 64
SAMPLE_KEYS = 4_000     # distinct keys that pivots are made from, about

_KEY = "_first_n_key"


def range_number(value: Column, cuts: list) -> Column:
    """How many of the ascending ``cuts`` (columns or numbers) are not above a value, by two levels of comparisons."""
    if not cuts:
        return F.lit(0)
    cuts = [c if isinstance(c, Column) else F.lit(c) for c in cuts]
    step = max(1, round(len(cuts) ** 0.5))
    groups = [cuts[i:i + step] for i in range(0, len(cuts), step)]
    reached = lambda xs: F.size(F.filter(F.array(*xs), lambda c: c <= value))
    group = reached([g[0] for g in groups])                       # 0: below all cuts
    inside = F.coalesce(*[F.when(group == k + 1, reached(g)) for k, g in enumerate(groups)], F.lit(0))
    return F.greatest(group - 1, F.lit(0)) * step + inside


def first_n(df: DataFrame, n: int, order_by: list[str], top_k: int = TOP_K_ROWS) -> DataFrame:
    """The first ``n`` rows in ``order_by`` order, nulls last; rows that the order does not tell apart go by a hash of the row.

    Up to ``top_k`` rows are one top-k query, in order. Beyond that the input is
    read a few times (write it first if it is dear, or not the same twice) and
    the rows come in no order.
    """
    if n <= top_k:
        return df.orderBy(*[F.col(c).asc_nulls_last() for c in order_by]).limit(n)
    keyed = df.withColumn(_KEY, _key(df, order_by))
    key = F.col(_KEY)
    low = high = None          # the n-th row's key lies in [low, high)
    size, rest = keyed.count(), n
    if n >= size:
        return df
    while size > top_k:
        inside = _between(keyed, low, high)
        pivots = _pivots(inside.select(key), size, low)
        if not pivots:         # all rows in there have one key
            break
        counts = {r["p"]: r["n"] for r in inside.groupBy(range_number(key, pivots).alias("p")).agg(
            F.count(F.lit(1)).alias("n")).collect()}      # a row per pivot
        at = 0
        while rest > counts.get(at, 0):
            rest -= counts.get(at, 0)
            at += 1
        size = counts[at]
        low, high = pivots[at - 1] if at else low, pivots[at] if at < len(pivots) else high
    edge = _between(keyed, low, high)
    if size > top_k:
        edge = _copies(edge.limit(1), rest)
    else:
        edge = edge.orderBy(key).limit(rest)
    out = edge if low is None else _between(keyed, None, low).unionByName(edge)
    return out.drop(_KEY)


def _key(df: DataFrame, order_by: list[str]) -> Column:
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    fields = [x for i, c in enumerate(order_by) for x in (F.col(c).isNull().alias(f"null{i}"), F.col(c).alias(f"key{i}"))]
    return F.struct(*fields, F.xxhash64(*hashed).alias("tie"))


def _between(keyed: DataFrame, low, high) -> DataFrame:
    if low is not None:
        keyed = keyed.where(F.col(_KEY) >= low)
    return keyed if high is None else keyed.where(F.col(_KEY) < high)


def _pivots(keys: DataFrame, size: int, low) -> list[Column]:
    """Ascending keys that cut the rows into about even ranges, from the distinct keys of a hash share; above the least key."""
    tie = F.col(f"{_KEY}.tie")
    distinct = keys
    if size > SAMPLE_KEYS:
        share = max(1, (1 << 30) * SAMPLE_KEYS // size)
        distinct = keys.where(F.pmod(F.xxhash64(F.lit("pivot"), tie), F.lit(1 << 30)) < share)
    distinct = distinct.distinct()
    tiles = distinct.withColumn("tile", F.ntile(PIVOTS).over(Window.orderBy(_KEY)))        # about SAMPLE_KEYS rows
    least = keys.agg(F.min(_KEY).alias("k"), F.max(_KEY).alias("top")).first()             # one row
    found = [r["k"] for r in tiles.groupBy("tile").agg(F.min(_KEY).alias("k")).orderBy("k").collect()]     # PIVOTS rows
    types = keys.schema[_KEY].dataType
    if least["k"] == least["top"]:
        return []
    return [_literal(k, types) for k in ([x for x in found if x != least["k"]] or [least["top"]])]


def _literal(row, types) -> Column:
    return F.struct(*[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in types.fields])


def _copies(one: DataFrame, n: int, a_task: int = TOP_K_ROWS) -> DataFrame:
    """``n`` copies of one row, made in tasks of ``a_task`` copies."""
    tasks = -(-n // a_task)
    spread = one.withColumn("_task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1)))).repartitionById(tasks, "_task")
    last = F.least(F.lit(a_task), F.lit(n) - F.col("_task") * a_task)
    return spread.withColumn("_copy", F.explode(F.sequence(F.lit(1), last.cast("int")))).drop("_task", "_copy")
