"""ID sources and increments.

ID lists stay DataFrames end to end: nothing is collected to the driver.
"""

from __future__ import annotations

import itertools
import time
from functools import reduce
from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.selection import first_n
from strata.operators.tables import latest
from strata.sources.fetch import (BACKOFF_BASE_SEC, MAX_ATTEMPTS, NOT_FOUND, TokenBucket, bronze_schema, fetch_many,
                                  plan_parallelism)
from strata.sources.transport import Transport, TransportError


def _key_type(key_type: str):
    return "bigint" if key_type == "bigint" else "string"


def ids_from_list(responses: DataFrame, body_col: str = "body", path: str = "objectIDs",
                  key_type: str = "bigint", keep: tuple = ()) -> DataFrame:
    """Ids out of list responses; a missing or null array gives no rows.

    ``path`` is a top-level array field (``objectIDs``), ``array[].field``
    (``data[].id``), ``[]`` for an array of ids at the root or ``[].field`` for
    a root array of objects.
    """
    kt = _key_type(key_type)
    arr, is_objects, field = path.partition("[].")
    if path == "[]":
        items = F.from_json(F.col(body_col), f"array<{kt}>")
    elif is_objects:
        inner = f"array<struct<`{field}`:{kt}>>"
        items = F.from_json(F.col(body_col), f"struct<`{arr}`:{inner}>")[arr] if arr else F.from_json(F.col(body_col), inner)
    else:
        items = F.from_json(F.col(body_col), f"struct<`{path}`:array<{kt}>>")[path]
    out = responses.select(*keep, F.explode(items).alias("id"))
    return out.select(*keep, F.col("id")[field].alias("id")) if is_objects else out


def check_cap(cap: int | None) -> int | None:
    """None = all, 0 = none, negative = error (one rule for every cap)."""
    if cap is None:
        return None
    cap = int(cap)
    if cap < 0:
        raise ValueError(f"cap must be >= 0 or None, got {cap}")
    return cap


def cap_ids(ids: DataFrame, n: int | None, order_by: str = "id") -> DataFrame:
    """Keep the first ``n`` ids in key order (repeatable, unlike a bare limit).

    A large cap reads ``ids`` more than once: write ids of a list API first.
    """
    n = check_cap(n)
    if n is None:
        return ids
    return first_n(ids, n, [order_by])


def _page(fetch, bucket: TokenBucket, pause, max_attempts: int):
    """One list call under the retry policy: every attempt takes a token, the last failure is raised."""
    attempt = 0
    while True:
        bucket.take()
        try:
            return fetch()
        except TransportError:
            attempt += 1
            if attempt >= max_attempts:
                raise
            pause(BACKOFF_BASE_SEC ** attempt)


def _walk_fn(transport: Transport, page_size: int, cap: int | None, key_type: str, links: bool, rate: float | None,
             max_attempts: int, clock, sleep):
    def value(x):
        return None if x is None or pd.isna(x) else x

    def chain(row):
        return row["source"], value(row.get("start_after")), value(row.get("stop_at"))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t, pause = transport.open(), sleep or time.sleep
        bucket = TokenBucket(rate, clock or time.monotonic, pause)
        every = (row for pdf in batches for row in pdf.to_dict("records"))
        # carried rows of a chain stand together, one for each of its pages
        chains = itertools.groupby(every, chain) if transport.carry else ((chain(row), None) for row in every)
        try:
            for (source, cursor, stop), carried in chains:
                if key_type == "bigint":
                    cursor, stop = (None if x is None else int(x) for x in (cursor, stop))
                page, got, link, more = 0, 0, None, True
                while more and (cap is None or got < cap):
                    own = () if carried is None else (next(carried, None),)
                    if links:   # the response names the next page (Link header)
                        ids, link = _page(lambda: t.link_page(source, link, page_size, *own), bucket, pause, max_attempts)
                        more = link is not None
                    else:
                        ids, more = _page(lambda: t.list_page(source, cursor, page_size, *own), bucket, pause, max_attempts)
                    if not ids:
                        break
                    cursor = ids[-1]
                    if stop is not None and cursor > stop:   # end of this shard's key range
                        ids, more = [i for i in ids if i <= stop], False
                    if cap is not None:
                        ids = ids[: cap - got]  # the cap applies whatever has_more says
                    if ids:
                        yield pd.DataFrame({"source": source, "id": pd.Series(ids, dtype="int64" if key_type == "bigint" else "object"),
                                            "page": pd.Series(page, index=range(len(ids)), dtype="int32")})
                    got += len(ids)
                    page += 1
        finally:
            t.close()

    return walk


def _walk(sources: DataFrame, transport: Transport, page_size: int, cap: int | None, key_type: str, links: bool,
          rate_per_sec: float | None, partitions: int | None, max_attempts: int, clock, sleep) -> DataFrame:
    n, rate = plan_parallelism(rate_per_sec, partitions or sources.sparkSession.sparkContext.defaultParallelism)
    if transport.carry:
        chain = [c for c in ("source", "start_after", "stop_at") if c in sources.columns]
        dealt = sources.repartition(n, *chain).sortWithinPartitions(*chain, transport.order)
    else:       # few rows that stand for much work: dealt out by count, which no size-based coalescing undoes
        dealt = sources.repartition(n)
    return dealt.mapInPandas(
        _walk_fn(transport, page_size, check_cap(cap), key_type, links, rate, max_attempts, clock, sleep),
        f"source string, id {_key_type(key_type)}, page int")


def cursor_pages(sources: DataFrame, transport: Transport, page_size: int = 100, cap: int | None = None,
                 key_type: str = "bigint", rate_per_sec: float | None = None, partitions: int | None = None,
                 max_attempts: int = MAX_ATTEMPTS, clock=None, sleep=None) -> DataFrame:
    """One cursor chain per source row; chains are spread over ``partitions`` tasks.

    Next cursor = last id of the page; stop on an empty page, on ``has_more``
    false, or at the cap. Each page leaves the task as it comes, so a long chain
    holds one page in memory. Every call takes a token of its task's share of
    ``rate_per_sec`` and is retried like a fetch.

    A source may be split into key-range shards (columns ``start_after`` and
    ``stop_at``, numbers or strings as the keys are): each shard is its own chain
    starting after ``start_after``, so one very large source is walked by many
    tasks. Page numbers and caps then count per shard. Chains are told apart by
    these columns; a transport that carries columns has a row per page instead.
    """
    kt = _key_type(key_type)
    cols = [F.col("source").cast("string").alias("source")]
    cols += [F.col(c).cast(kt).cast("string").alias(c) for c in ("start_after", "stop_at") if c in sources.columns]
    cols += [F.col(c) for c in transport.carry]
    return _walk(sources.select(*cols), transport, page_size, cap, key_type, False, rate_per_sec, partitions,
                 max_attempts, clock, sleep)


def cursor_shards(keys: DataFrame, shards: int, source: str = "source", key: str = "id",
                  accuracy: int = 10000) -> DataFrame:
    """Split each source's key range into ``shards`` ranges from approximate quantiles (of an earlier key list).

    Returns (source, start_after, stop_at) rows, ``shards`` per source, covering
    every key exactly once (first start and last stop are open). Only the
    quantiles (a few numbers per source) are computed; no keys are gathered.
    """
    if shards < 1:
        raise ValueError("shards must be >= 1")
    probs = [i / shards for i in range(1, shards)]
    kind = keys.schema[key].dataType.simpleString()
    if kind == "string":
        # Text has no quantiles: bounds are keys drawn by hash, one per cut, the same in every run.
        drawn = [F.min_by(key, F.xxhash64(F.col(key), F.lit(i))) for i in range(1, shards)]
        q = keys.groupBy(F.col(source).alias("source")).agg(F.array(*drawn).cast("array<string>").alias("_q"))
    else:
        q = keys.groupBy(F.col(source).alias("source")).agg(
            F.percentile_approx(key, probs, accuracy).alias("_q") if probs else F.array().alias("_q"))
    bounds = F.array_distinct(F.array_sort(F.col("_q"))).cast(f"array<{kind}>")
    starts = F.concat(F.array(F.lit(None).cast(kind)), bounds)
    stops = F.concat(bounds, F.array(F.lit(None).cast(kind)))
    return q.select("source", F.explode(F.arrays_zip(starts.alias("start_after"), stops.alias("stop_at")))
                    .alias("_b")).select("source", "_b.start_after", "_b.stop_at")


def _offset_fn(transport: Transport, page_size: int, key_type: str, rate: float | None, max_attempts: int, clock, sleep):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t, pause = transport.open(), sleep or time.sleep
        bucket = TokenBucket(rate, clock or time.monotonic, pause)
        try:
            for pdf in batches:
                carried = [(r,) for r in pdf[list(transport.carry)].to_dict("records")] if transport.carry else [()] * len(pdf)
                for source, off, own in zip(pdf["source"].tolist(), pdf["offset"].tolist(), carried):
                    ids = list(_page(lambda: t.offset_page(source, int(off), page_size, *own), bucket, pause, max_attempts))
                    if ids:
                        yield pd.DataFrame({"source": source, "id": pd.Series(ids, dtype="int64" if key_type == "bigint" else "object"),
                                            "offset": pd.Series(off, index=range(len(ids)), dtype="int64")})
        finally:
            t.close()

    return run


def offset_pages(totals: DataFrame, transport: Transport, page_size: int = 100,
                 key_type: str = "bigint", partitions: int | None = None, rate_per_sec: float | None = None,
                 max_attempts: int = MAX_ATTEMPTS, clock=None, sleep=None, carried: DataFrame | None = None) -> DataFrame:
    """S3 (offset form): every page offset is known from the total up front,
    so pages are generated with ``sequence`` and fetched in parallel.

    ``totals`` has (source, total); each page becomes one request row. The columns
    that a transport carries come from ``carried`` (source, offset, ...). As in S2,
    each page leaves the task as it comes, and every call takes a token of its
    task's share of ``rate_per_sec`` and is retried like a fetch.
    """
    kt = _key_type(key_type)
    reqs = totals.select(
        F.col("source").cast("string").alias("source"),
        F.col("total").cast("bigint").alias("total"),
        F.explode(F.sequence(F.lit(0).cast("bigint"),
                             F.greatest(F.col("total").cast("bigint") - 1, F.lit(0).cast("bigint")),
                             F.lit(page_size).cast("bigint"))).alias("offset"),
    ).where(F.col("offset") < F.col("total")).drop("total")
    # the requests come from a handful of total rows: spread them over the
    # cluster, or every page would be fetched by one task
    n, rate = plan_parallelism(rate_per_sec, partitions or totals.sparkSession.sparkContext.defaultParallelism)
    if transport.carry:
        reqs = reqs.join(carried.select("source", "offset", *transport.carry), ["source", "offset"], "left")
    reqs = reqs.repartition(n, "source", "offset")
    return reqs.mapInPandas(_offset_fn(transport, page_size, key_type, rate, max_attempts, clock, sleep),
                            f"source string, id {kt}, offset bigint")


def link_pages(sources: DataFrame, transport: Transport, page_size: int = 100, cap: int | None = None,
               key_type: str = "bigint", rate_per_sec: float | None = None, partitions: int | None = None,
               max_attempts: int = MAX_ATTEMPTS, clock=None, sleep=None) -> DataFrame:
    """S3 (Link-header form): each response names the next page
    (``transport.link_page(source, link, size) -> (ids, next_link or None)``),
    so pages form a chain per source, walked like S2 and in parallel across sources."""
    return _walk(sources.select(F.col("source").cast("string"), *transport.carry), transport, page_size, cap, key_type, True,
                 rate_per_sec, partitions, max_attempts, clock, sleep)


def new_ids(ids: DataFrame, bronze: DataFrame, key: str = "id", bronze_key: str = "object_id") -> DataFrame:
    """Ids not yet in Bronze (left anti join; Spark picks the strategy)."""
    seen = bronze.select(F.col(bronze_key).alias(key))
    return ids.join(seen, key, "left_anti")


def failed_ids(bronze: DataFrame, key: str = "object_id", ts: str = "ingested_at") -> DataFrame:
    """Ids whose last fetch failed and is worth retrying (not 404).

    Over appended Bronze the newest row of a key counts (where ``ts`` is a
    column); a 200 without a body is a failure, as the success filter has it.
    """
    rows = latest(bronze, [key], [ts]) if ts in bronze.columns else bronze
    ok = (F.col("http_status") == 200) & F.col("raw_json").isNotNull()
    missing = F.coalesce(F.col("error_message") == NOT_FOUND, F.lit(False))
    return rows.where(F.col(key).isNotNull() & ~F.coalesce(ok, F.lit(False)) & ~missing).select(F.col(key).alias("id"))


def since(df: DataFrame, ts_col: str, runs: DataFrame, hwm_col: str = "high_water",
          ok_col: str | None = "success") -> DataFrame:
    """Rows at or after the high-water mark of the last good run; all rows if no run was good.

    The mark is a scalar subquery: Spark evaluates it once and inlines it as a
    literal filter.
    """
    good = runs.where(F.col(ok_col)) if ok_col else runs
    hwm = good.agg(F.max(hwm_col)).scalar()
    return df.where(hwm.isNull() | (F.col(ts_col) >= hwm))


def union_sources(*dfs: DataFrame) -> DataFrame:
    """Union by column name; columns missing on one side become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def _multi_fetch_fn(transport: Transport, key_type: str, max_attempts: int, clock, sleep):
    carry = list(transport.carry)

    def run(batches):
        t = transport.open()
        buckets: dict = {}
        pause = sleep or time.sleep
        try:
            for pdf in batches:
                keys = [None if k is None else int(k) if key_type == "bigint" else k for k in pdf["id"].tolist()]
                srcs = pdf["source"].tolist()
                rates = pdf["_rate"].tolist()
                rows = pdf[carry].to_dict("records") if carry else [None] * len(keys)
                for src, rate in zip(srcs, rates):
                    if src not in buckets:
                        rate = None if rate is None or pd.isna(rate) else float(rate)
                        buckets[src] = TokenBucket(rate, clock or time.monotonic, pause)
                got = fetch_many(t, lambda i: buckets[srcs[i]], keys, rows, clock or time.monotonic, pause, max_attempts)
                s_out, b_out, e_out = (list(x) for x in zip(*got)) if got else ([], [], [])
                yield pd.DataFrame({"source": srcs,
                                    "object_id": pd.Series(keys, dtype="Int64" if key_type == "bigint" else "object"),
                                    "http_status": pd.Series(s_out, dtype="Int32"),
                                    "raw_json": pd.Series(b_out, dtype="object"),
                                    "error_message": pd.Series(e_out, dtype="object")})
        finally:
            t.close()

    return run


def fetch_sources(ids: DataFrame, config: DataFrame, transport: Transport, key_type: str = "bigint",
                  max_attempts: int = MAX_ATTEMPTS, clock=None, sleep=None) -> DataFrame:
    """Several APIs in one job, each with its own rate and parallelism.

    ``ids`` has (source, id, carry...); ``config`` has (source, rate_per_sec,
    partitions), one row per API. Every source owns ``partitions`` tasks (fewer
    if its rate is lower), each with a bucket of its share of the rate; no two
    slots share a task. An id of a source without a config row fails the job
    before its fetch. Ids that are null (also by the cast to ``key_type``) name no
    object and are not requested: each comes back as a ``null_id`` row, as in
    ``fetch_all``.
    """
    rate, parts = F.col("rate_per_sec").cast("double"), F.col("partitions").cast("int")
    cfg = config.select(F.col("source").cast("string").alias("source"), rate.alias("rate"), F.greatest(
        F.lit(1), F.least(parts, F.coalesce(F.floor(rate).cast("int"), parts))).alias("_parts"))
    rows = cfg.orderBy("source").collect()      # one row per configured API
    first, slots = {}, 0
    for r in rows:
        first[r["source"]], slots = slots, slots + r["_parts"]
    start = F.coalesce(*[F.when(F.col("source") == s, F.lit(n)) for s, n in first.items()], F.raise_error(
        F.concat(F.lit("no configuration for source "), F.coalesce("source", F.lit("NULL"))))) if rows else F.raise_error(
        F.lit("no source is configured"))
    spread = F.when(F.col("id").isNull(), F.xxhash64(F.lit(0), *transport.carry)).otherwise(F.xxhash64("id"))
    kt = _key_type(key_type)
    j = (ids.select(F.col("source").cast("string").alias("source"), F.col("id").cast(kt).alias("id"),
                    *[F.col(c) for c in transport.carry])
         .withColumn("_first", start.cast("int")).join(cfg, "source", "left")
         .withColumn("_rate", F.col("rate") / F.col("_parts"))
         .withColumn("_slot", (F.col("_first") + F.pmod(spread, F.col("_parts"))).cast("int"))
         .withColumn("id", F.col("id").cast("string")))      # as text, so that null ids do not turn the others into floats
    j = j.repartitionById(max(1, slots), "_slot").drop("_first", "_slot")
    schema = T.StructType([T.StructField("source", T.StringType())] + bronze_schema(key_type).fields)
    return j.mapInPandas(_multi_fetch_fn(transport, key_type, max_attempts, clock, sleep), schema)
