"""A fetch that is described by options alone, as a source in a configuration file is.

Options (text, as configurations hold them):
  ids_path      files with an ``id`` column (+ replay columns for ``transport=replay``)
  ids_format    their format (default ``parquet``)
  transport     ``http`` (default; needs ``detail_url``) or ``replay``
  header.NAME   a request header of the ``http`` transport
  key_type      ``bigint`` (default) or ``string``
  rate_per_sec  global cap, split over the partitions; empty or ``none`` for none
  partitions    tasks that fetch (default 8)
  retry_backoff ``true`` (default) waits 2**attempt s between retries;
                ``false`` retries at once (replayed APIs)
  share_rate    ``true`` lets live tasks share the rate (default ``false``)

Spark reads the ids, so any store and format that it knows will do and files of
a writer at work are not seen; the fetch is ``fetch_all``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.sources.fetch import fetch_all
from strata.sources.transport import HttpTransport, ReplayTransport

OPTIONS = {"ids_path", "ids_format", "transport", "detail_url", "key_type", "rate_per_sec", "partitions", "retry_backoff", "share_rate"}


def read_rest(spark: SparkSession, **options: str) -> DataFrame:
    """object_id, http_status, raw_json, error_message of every id; lazy, so write it with one action."""
    headers = {k[7:]: v for k, v in options.items() if k.lower().startswith("header.")}
    unknown = {k for k in options if not k.lower().startswith("header.")} - OPTIONS
    if unknown:
        raise ValueError(f"unknown options {sorted(unknown)}")
    name = options.get("transport", "http")
    if name not in ("http", "replay"):
        raise ValueError(f"no transport {name!r}")
    if name == "http" and not options.get("detail_url"):
        raise ValueError("the http transport needs detail_url")
    transport = ReplayTransport() if name == "replay" else HttpTransport(options["detail_url"], headers=headers)
    rate = options.get("rate_per_sec")
    ids = spark.read.format(options.get("ids_format", "parquet")).load(options["ids_path"])
    return fetch_all(ids, transport, None if rate in (None, "", "none") else float(rate), int(options.get("partitions", 8)),
                     key_type=options.get("key_type", "bigint"), stamp=False, share_rate=_true(options, "share_rate", "false"),
                     backoff=None if _true(options, "retry_backoff", "true") else _no_wait)


def _true(options: dict, name: str, default: str) -> bool:
    return str(options.get(name, default)).lower() == "true"


def _no_wait(seconds: float) -> None:
    pass
