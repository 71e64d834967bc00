"""Replay stand-ins: the remote APIs of the reference, answered from the given tables.

The rules below decide what the "API" returns for each row; Spark computes
them JVM-side and the fetch engine receives them as carried columns, so the
whole fetch path (partitioning, retries, status classes) is exercised
without a network.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.silver import spec

# Replay rule for events -> API answers.
#   event_type 'error'  -> HTTP 500 on every attempt (ends as retries_exhausted (500))
#   event_type 'signup' -> HTTP 404 (not_found)
#   anything else       -> HTTP 200 with body {"id", "event_type", "value", "k"}
ERROR_TYPE, MISSING_TYPE = "error", "signup"

EVENT_FIELDS = spec(("id", "bigint", "id"), ("event_type", "string", "event_type"),
                    ("value", "double", "value"), ("k", "int", "k"))

JSON_OPTS = {"ignoreNullFields": "false"}


def event_status(event_type="event_type"):
    et = F.col(event_type)
    return F.when(et == ERROR_TYPE, F.lit(500)).when(et == MISSING_TYPE, F.lit(404)).otherwise(F.lit(200))


def event_body():
    return F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type"), F.col("value"),
                              F.get_json_object("props", "$.k").cast("int").alias("k")), JSON_OPTS)


def event_requests(events: DataFrame) -> DataFrame:
    """(id, replay_status, replay_body) per event."""
    st = event_status()
    return events.select(F.col("event_id").alias("id"), st.alias("replay_status"),
                         F.when(st == 200, event_body()).alias("replay_body"))


def record_requests(df: DataFrame, key: str, source: str, fields: list[str]) -> DataFrame:
    """(source, id, replay_status=200, replay_body=JSON of fields) for any keyed table."""
    body = F.to_json(F.struct(F.col(key).alias("id"), *[F.col(f) for f in fields]), JSON_OPTS)
    return df.select(F.lit(source).alias("source"), F.col(key).alias("id"),
                     F.lit(200).alias("replay_status"), body.alias("replay_body"))


def page_rows(keys: DataFrame, chain: list[str], page_size: int) -> DataFrame:
    """A list API's pages of ``keys`` (chain columns, id), a row each: what ``ReplayPages`` carries, and offset."""
    place = F.expr(f"(row_number() OVER (PARTITION BY {', '.join(chain)} ORDER BY id) - 1) DIV {page_size}")
    pages = keys.withColumn("replay_page", place).groupBy(*chain, "replay_page").agg(
        F.array_sort(F.collect_list("id")).alias("replay_ids"))             # at most page_size ids
    order = Window.partitionBy(*chain).orderBy("replay_page")
    return (pages.withColumn("replay_cursor", F.element_at(F.lag("replay_ids").over(order), -1).cast("string"))
            .withColumn("replay_more", F.lead("replay_page").over(order).isNotNull())
            .withColumn("offset", F.col("replay_page") * page_size))


def shard_page_rows(keys: DataFrame, shards: DataFrame, page_size: int) -> DataFrame:
    """The pages that a walk of each shard (source, start_after, stop_at) sees: from its start, up to the one that holds its end."""
    inside = F.col("start_after").isNull() | (F.col("id") > F.col("start_after"))
    first = F.col("replay_ids")[0]
    pages = page_rows(keys.join(shards, "source").where(inside), ["source", "start_after", "stop_at"], page_size)
    return pages.where(F.col("stop_at").isNull() | (first <= F.col("stop_at"))).withColumn(
        "replay_cursor", F.coalesce("replay_cursor", F.col("start_after").cast("string")))
