"""Rate-limited, retrying fan-out fetch.

ids -> round-robin repartition(N) -> mapInPandas(one transport session and one token
bucket per task) -> fixed Bronze schema. The per-request loop is Python by
nature (one remote call per id); everything around it is DataFrame work.
"""

from __future__ import annotations

import heapq
import math
import threading
import time
import warnings
from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.transport import Transport, TransportError

# Retry policy and status classes of the Bronze contract.
RETRYABLE_STATUS = (429, 500, 502, 503, 504)
MAX_ATTEMPTS = 3
BACKOFF_BASE_SEC = 2  # wait 2 ** attempt seconds before the next attempt
NOT_FOUND = "not_found"
RETRIES_EXHAUSTED = "retries_exhausted ({status})"
UNEXPECTED_STATUS = "unexpected_status ({status})"
NETWORK_ERROR = "network_error: {error}"
NULL_ID = "null_id"   # our own: a request that was never made


def bronze_schema(key_type: str = "bigint") -> T.StructType:
    key = T.LongType() if key_type == "bigint" else T.StringType()
    return T.StructType([
        T.StructField("object_id", key, True),
        T.StructField("http_status", T.IntegerType(), True),
        T.StructField("raw_json", T.StringType(), True),
        T.StructField("error_message", T.StringType(), True),
    ])


class TokenBucket:
    """Token bucket with an injected clock.

    Starts with one token (so the first second also respects the cap), holds
    at most ``max(1, rate)`` tokens, and sets the refill mark *after* a wait so
    waited time is never credited twice. ``rate=None`` disables limiting.
    """

    def __init__(self, rate: float | None, clock: Callable[[], float] = time.monotonic,
                 sleep: Callable[[float], None] = time.sleep):
        self.rate = rate
        self.capacity = max(1.0, rate or 1.0)
        self.clock = clock
        self.sleep = sleep
        self.tokens = 1.0
        self.mark = clock()

    def take(self) -> None:
        if not self.rate:
            return
        now = self.clock()
        self.tokens = min(self.capacity, self.tokens + (now - self.mark) * self.rate)
        self.mark = now
        if self.tokens < 1.0:
            self.sleep((1.0 - self.tokens) / self.rate)
            self.mark = self.clock()
            self.tokens = 0.0
        else:
            self.tokens -= 1.0


SHARE_SECONDS = 0.5     # how often live tasks tell each other what they have left


def split_rate(rate: float, left: list[int]) -> list[float]:
    """Shares of a rate in proportion to what each task has left; all of it goes to tasks with work."""
    total = sum(left)
    return [rate * n / total if total else 0.0 for n in left]


class SharedBucket(TokenBucket):
    """A token bucket whose rate follows what the tasks of a barrier stage have left.

    A thread of each task takes part in rounds in which all tasks tell their
    number of unfinished ids (``gather``), and sets the task's share of the
    rate. The fetch itself never waits for a round. A task that is done goes on
    in the rounds until all are.
    """

    def __init__(self, rate: float, tasks: int, place: int, left: int, gather, clock=time.monotonic, sleep=time.sleep,
                 every: float = SHARE_SECONDS):
        super().__init__(rate / tasks, clock, sleep)
        self.total, self.place, self.left, self.gather, self.every = rate, place, left, gather, every
        self.rounds = threading.Thread(target=self._rounds, daemon=True)
        self.rounds.start()

    def _rounds(self) -> None:
        while True:
            left = [int(x) for x in self.gather(str(self.left))]
            if not any(left):
                return
            self.rate = split_rate(self.total, left)[self.place]
            self.capacity = max(1.0, self.rate)
            time.sleep(self.every)

    def take(self) -> None:
        while True:
            rate, now = self.rate, self.clock()
            self.tokens = min(self.capacity, self.tokens + (now - self.mark) * rate)
            self.mark = now
            if self.tokens >= 1.0:
                self.tokens -= 1.0
                return
            self.sleep(min(self.every, (1.0 - self.tokens) / rate) if rate else self.every)

    def done(self, n: int = 1) -> None:
        self.left -= n

    def finish(self) -> None:
        self.left = 0
        self.rounds.join()


def plan_parallelism(rate_per_sec: float | None, partitions: int) -> tuple[int, float | None]:
    """(tasks, per-task rate): never more tasks than whole requests per second."""
    if not rate_per_sec:
        return max(1, int(partitions)), None
    if rate_per_sec <= 0:
        raise ValueError("rate_per_sec must be positive")
    n = max(1, min(partitions, int(math.floor(rate_per_sec))))
    return n, rate_per_sec / n


def fetch_one(transport: Transport, bucket: TokenBucket, key, row, sleep,
              max_attempts: int = MAX_ATTEMPTS):
    """One id through the retry policy -> (status, body, error_message)."""
    attempt = 0
    while True:
        bucket.take()  # every attempt, retries included, takes a token
        try:
            status, body = transport.fetch(key, row)
        except TransportError as exc:
            attempt += 1
            if attempt >= max_attempts:
                return 0, None, NETWORK_ERROR.format(error=exc)
            sleep(BACKOFF_BASE_SEC ** attempt)
            continue
        if status == 200:
            return 200, body, None
        if status == 404:
            return 404, None, NOT_FOUND
        if status in RETRYABLE_STATUS:
            attempt += 1
            if attempt >= max_attempts:
                return status, None, RETRIES_EXHAUSTED.format(status=status)
            sleep(BACKOFF_BASE_SEC ** attempt)
            continue
        return status, None, UNEXPECTED_STATUS.format(status=status)


def fetch_many(transport: Transport, bucket_for, keys: list, rows: list, clock, sleep,
               max_attempts: int = MAX_ATTEMPTS, on_done=lambda: None) -> list[tuple]:
    """Several ids through the retry policy -> [(status, body, error_message)], in the order of ``keys``.

    An id that waits for its next attempt does not hold up the others: the task
    goes on with them and comes back when the wait is over, so retries do not
    leave tokens unused. ``bucket_for(i)`` is the token bucket of the i-th id;
    ``on_done`` is called when an id that was requested is finished.
    """
    done: list = [None] * len(keys)
    waiting: list[tuple[float, int, int]] = []      # (due, i, attempts made)
    ahead = iter(i for i, k in enumerate(keys) if k is not None)
    while True:
        if waiting and waiting[0][0] <= clock():
            _, i, made = heapq.heappop(waiting)
        elif (i := next(ahead, None)) is not None:
            made = 0
        elif waiting:
            due, i, made = heapq.heappop(waiting)
            sleep(max(0.0, due - clock()))
        else:
            break
        bucket_for(i).take()  # every attempt, retries included, takes a token
        try:
            status, body = transport.fetch(keys[i], rows[i])
            error = None
        except TransportError as exc:
            status, body, error = 0, None, NETWORK_ERROR.format(error=exc)
        if status == 200:
            done[i] = 200, body, None
        elif status == 404:
            done[i] = 404, None, NOT_FOUND
        elif status not in RETRYABLE_STATUS and status != 0:
            done[i] = status, None, UNEXPECTED_STATUS.format(status=status)
        elif made + 1 >= max_attempts:
            done[i] = status, None, error or RETRIES_EXHAUSTED.format(status=status)
        else:
            heapq.heappush(waiting, (clock() + BACKOFF_BASE_SEC ** (made + 1), i, made + 1))
        if done[i] is not None:
            on_done()
    return [(None, None, NULL_ID) if d is None else d for d in done]


def _fetch_fn(transport: Transport, rate: float | None, key_type: str, max_attempts: int,
              clock, sleep, backoff=None, tasks: int = 0):
    """``rate`` is the task's own, or with ``tasks`` that of all tasks of a barrier stage."""
    carry = list(transport.carry)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = transport.open()
        own, wait, on_done = clock or time.monotonic, sleep or time.sleep, lambda: None
        if tasks:
            from pyspark import BarrierTaskContext

            context = BarrierTaskContext.get()
            batches = list(batches)          # ids only; a task must know how many it has
            left = int(sum(pdf["id"].notna().sum() for pdf in batches))
            bucket = SharedBucket(rate, tasks, context.partitionId(), left, context.allGather, own, wait)
            on_done = bucket.done
        else:
            bucket = TokenBucket(rate, clock=own, sleep=wait)
        pause = backoff or wait
        try:
            for pdf in batches:
                keys = [None if k is None else int(k) if key_type == "bigint" else k for k in pdf["id"].tolist()]
                rows = pdf[carry].to_dict("records") if carry else [None] * len(keys)
                got = fetch_many(t, lambda i: bucket, keys, rows, own, pause, max_attempts, on_done)
                out_s, out_b, out_e = (list(x) for x in zip(*got)) if got else ([], [], [])
                yield pd.DataFrame({
                    "object_id": pd.Series(keys, dtype="Int64" if key_type == "bigint" else "object"),
                    "http_status": pd.Series(out_s, dtype="Int32"),
                    "raw_json": pd.Series(out_b, dtype="object"),
                    "error_message": pd.Series(out_e, dtype="object"),
                })
            if tasks:
                bucket.finish()
        finally:
            t.close()

    return run


def fetch_all(ids: DataFrame, transport: Transport, rate_per_sec: float | None = None,
              partitions: int | None = None, key_col: str = "id", key_type: str = "bigint",
              max_attempts: int = MAX_ATTEMPTS, clock=None, sleep=None,
              stamp: bool = True, backoff=None, share_rate: bool = False) -> DataFrame:
    """Fetch every id once through ``transport``; returns the Bronze rows.

    ``partitions`` defaults to the cluster's default parallelism; a capped API
    gets no more tasks than whole requests per second. A NULL id names no object:
    it is never requested and comes back as a row with ``null_id``. ``sleep``
    is the clock's wait (token bucket and, unless ``backoff`` is given, the
    retry backoff). The ids are spread round-robin over ``tasks``
    partitions (equal counts, so no task lags under its share of the rate)
    and the global rate is split evenly between tasks. The result is lazy:
    write it with one action.

    ``share_rate`` runs a capped fetch as a barrier stage whose tasks tell each
    other what they have left and split the rate anew by it, so tasks with many
    retries do not trail behind tokens that others leave unused. All tasks then
    run at a time (their number is at most the default parallelism), each holds
    its ids in memory, and if one is lost all are run again.
    """
    spark = ids.sparkSession
    if spark.sparkContext.getConf().get("spark.speculation", "false").lower() == "true":
        warnings.warn("spark.speculation is on: speculative copies of fetch tasks repeat remote calls "
                      "and can exceed the rate cap; run API ingest in a session with it off")
    tasks, per_task = plan_parallelism(rate_per_sec, partitions or spark.sparkContext.defaultParallelism)
    # as text, so that null ids do not turn the others into floating-point numbers
    key = F.col(key_col).cast("bigint" if key_type == "bigint" else "string").cast("string").alias("id")
    cols = [key] + [F.col(c) for c in transport.carry]
    # Round-robin placement gives every task the same number of ids (±1), so no task lags behind the
    # others under its share of the rate; Spark sorts before a round-robin
    # exchange, so a retried task sees the same ids.
    share_rate = share_rate and rate_per_sec is not None
    if share_rate:
        tasks, per_task = min(tasks, spark.sparkContext.defaultParallelism), rate_per_sec
    df = ids.select(*cols).repartition(tasks)
    fn = _fetch_fn(transport, per_task, key_type, max_attempts, clock, sleep, backoff, tasks if share_rate else 0)
    out = df.mapInPandas(fn, schema=bronze_schema(key_type), barrier=share_rate)
    if stamp:
        out = out.withColumn("ingested_at", F.current_timestamp())
    return out


def classify(status: Column | str, error: Column | str | None = None) -> Column:
    """Status class as a column (re-check of S6 on stored Bronze rows)."""
    s = F.col(status) if isinstance(status, str) else status
    return (F.when(s == 200, F.lit("ok"))
            .when(s == 404, F.lit("not_found"))
            .when(s == 0, F.lit("network_error"))
            .when(s.isin(*RETRYABLE_STATUS), F.lit("retries_exhausted"))
            .otherwise(F.lit("unexpected_status")))
