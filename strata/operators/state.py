"""Keyed table state (T1-T8): reconcile, patch, change hashes, run status,
aliases, run search and tag logs, all as joins and aggregations.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.scalar import row_hash
from strata.operators.tables import latest

VIEW_TYPES = ("ACTIVE_ONLY", "DELETED_ONLY", "ALL")


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def one_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """At most one row per key: the greatest by ``order_by``, then by the other columns in their order."""
    return latest(df, keys, order_by)


def reconcile(current: DataFrame, desired: DataFrame, key, live: DataFrame | None = None,
              order_by: Sequence[str] = ()) -> DataFrame:
    """Full replace per key.

    Several desired (or current) rows of a key are reduced to the greatest by
    ``order_by``, then by their other columns.

    A desired key whose record is live becomes ``replace``; otherwise
    ``create`` (a stored record whose key is no longer live counts as
    absent). Current keys missing from ``desired`` are kept (``keep``) with
    their stored values, never deleted. One full outer join on the key (plus
    a left join with ``live`` when given).
    """
    keys = _keys(key)
    vals = [c for c in desired.columns if c not in keys]
    desired = one_per_key(desired, keys, order_by)
    cur = one_per_key(current.select(*keys, *vals), keys, [c for c in order_by if c in vals])
    cur = cur.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in vals]).withColumn("_cur", F.lit(True))
    if live is not None:
        cur = cur.join(live.select(*keys).distinct().withColumn("_live", F.lit(True)), keys, "left")
        cur = cur.withColumn("_cur", F.coalesce(F.col("_live"), F.lit(False))).drop("_live")
    j = desired.withColumn("_want", F.lit(True)).join(cur, keys, "full_outer")
    action = (F.when(F.col("_want").isNull(), F.lit("keep"))
              .when(F.coalesce(F.col("_cur"), F.lit(False)), F.lit("replace"))
              .otherwise(F.lit("create")))
    out = [F.when(F.col("_want").isNull(), F.col(f"_old_{c}")).otherwise(F.col(c)).alias(c) for c in vals]
    return j.select(*keys, *out, action.alias("action"))


def patch(current: DataFrame, changes: DataFrame, key, cols: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """Only supplied (non-NULL) fields overwrite; an empty string counts as supplied.

    Several changes of a key are reduced to the greatest by ``order_by``, then by
    their other columns.
    ``update_mask`` lists the fields that were set, in ``cols`` order.
    """
    keys = _keys(key)
    ch = one_per_key(changes, keys, order_by).select(*keys, *[F.col(c).alias(f"_new_{c}") for c in cols])
    j = current.join(ch, keys, "left")
    vals = [F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in cols else F.col(c)
            for c in current.columns if c not in keys]
    mask = F.concat_ws(",", *[F.when(F.col(f"_new_{c}").isNotNull(), F.lit(c)) for c in cols])
    return j.select(*keys, *vals, mask.alias("update_mask"))


def with_row_hash(df: DataFrame, cols: Sequence[str], name: str = "row_hash") -> DataFrame:
    """SHA-256 of the ordered columns, NULL-safe."""
    return df.withColumn(name, row_hash(*cols))


def changed(current: DataFrame, desired: DataFrame, key, cols: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """Desired rows that are new or whose hashed columns differ (one join); one row per key as in T1."""
    keys = _keys(key)
    cur = with_row_hash(one_per_key(current, keys, order_by), cols, "_old_hash").select(*keys, "_old_hash")
    des = with_row_hash(one_per_key(desired, keys, order_by), cols, "_new_hash")
    j = des.join(cur, keys, "left")
    change = F.when(F.col("_old_hash").isNull(), F.lit("new")).otherwise(F.lit("changed"))
    return (j.where(F.col("_old_hash").isNull() | (F.col("_old_hash") != F.col("_new_hash")))
            .select(*keys, *[c for c in desired.columns if c not in keys],
                    change.alias("change"), F.col("_new_hash").alias("row_hash")))


def duration_ms(start, end):
    """Whole milliseconds between two timestamps (microsecond difference, truncated)."""
    us = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return F.floor(us / 1000).cast("bigint")


def run_status(obs: DataFrame, run: str, state: str, ts: str, terminal: Sequence[str]) -> DataFrame:
    """T4: latest state per run, terminal flag, first/last observation, duration.

    First submit is kept (min), the state is the newest (max by ts); one
    partial+final aggregation, skew-safe.
    """
    agg = obs.groupBy(run).agg(
        F.max(F.struct(F.col(ts), F.col(state))).alias("_last"),
        F.min(ts).alias("first_seen"),
        F.count(F.lit(1)).alias("n_obs"),
    )
    last_ts = F.col("_last")[ts]
    term = F.col("_last")[state].isin(*terminal)
    dur = F.when(term, duration_ms(F.col("first_seen"), last_ts))
    return agg.select(F.col(run), F.col("_last")[state].alias("state"), "first_seen",
                      last_ts.alias("last_seen"), "n_obs", term.alias("is_terminal"), dur.alias("duration_ms"))


def resolve_alias(alias_log: DataFrame, versions: DataFrame, model: str = "full_name",
                  alias: str = "alias", version: str = "version", at: str = "assigned_at") -> DataFrame:
    """An alias points at the version assigned to it last; joined to the version record."""
    cur = latest(alias_log.select(model, alias, at, version), [model, alias], [at])
    return cur.join(versions, [model, version], "left").drop(at)


def search_runs(runs: DataFrame, tags: dict | None = None, view: str = "ACTIVE_ONLY",
                max_results: int = 100, order_by: Sequence[str] = ("start_time",),
                stage_col: str = "lifecycle_stage", tags_col: str = "tags", key: str = "run_id") -> DataFrame:
    """Filter on tag values and lifecycle stage, newest first, at most ``max_results`` (top-k)."""
    if view not in VIEW_TYPES:
        raise ValueError(f"view must be one of {VIEW_TYPES}")
    if not (0 < max_results <= 50000):
        raise ValueError("max_results must be in 1..50000")
    df = runs
    for k, v in (tags or {}).items():
        df = df.where(F.col(tags_col)[k] == F.lit(v))
    if view == "ACTIVE_ONLY":
        df = df.where(F.col(stage_col) == "active")
    elif view == "DELETED_ONLY":
        df = df.where(F.col(stage_col) == "deleted")
    return df.orderBy(*[F.col(c).desc() for c in order_by], F.col(key).asc()).limit(max_results)


def apply_tags(tag_log: DataFrame, entity: str = "run_id", key: str = "key", value: str = "value",
               at: str = "set_at", as_map: bool = False) -> DataFrame:
    """Last write per (entity, tag key) wins.

    The result is one row per (entity, key) with the winning value, from a
    partial aggregation (no entity's writes are gathered in one place).
    ``as_map=True`` additionally folds each entity's tags into a key-sorted
    map; use it only for bounded tag sets (the map of one entity lives in one
    row).
    """
    last = latest(tag_log.select(entity, key, at, value), [entity, key], [at]).select(entity, key, value)
    if not as_map:
        return last
    return last.groupBy(entity).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(key), F.col(value))))).alias("tags"))
