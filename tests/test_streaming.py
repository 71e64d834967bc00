"""Incremental runs, replay idempotence, state merged across micro-batches."""

import pytest
from pyspark.sql import functions as F

from strata.operators.state import run_status
from strata.operators import tables as TB
from strata.plans import registry as R
from strata.session import scratch_dir
from strata.streaming.ingest import full_refresh_stream, ingest_stream, read_stream, run_status_stream, upsert_stream


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_ingest_takes_only_new_files(spark, sf):
    landing, target, ckpt = R.stream_paths(spark)
    R.events_json_drop(spark, sf, landing, True)
    ingest_stream(spark, landing, R.EVENTS_JSON_SCHEMA, target, ckpt, options=R.JSON_READ)
    first = spark.read.parquet(target).count()
    ingest_stream(spark, landing, R.EVENTS_JSON_SCHEMA, target, ckpt, options=R.JSON_READ)  # nothing new
    assert spark.read.parquet(target).count() == first
    R.events_json_drop(spark, sf, landing, False)
    ingest_stream(spark, landing, R.EVENTS_JSON_SCHEMA, target, ckpt, options=R.JSON_READ)
    assert spark.read.parquet(target).count() == spark.read.parquet(f"{sf}/events.parquet").count()


def test_upsert_stream_replay_is_harmless(spark, sf):
    landing, _, ckpt = R.stream_paths(spark)
    R.events_json_drop(spark, sf, landing, True)
    R.events_json_drop(spark, sf, landing, False)
    tbl = f"{R.fresh_db(spark)}.latest"
    s = read_stream(spark, landing, R.EVENTS_JSON_SCHEMA, options=R.JSON_READ).drop("source_file", "ingested_at")
    upsert_stream(spark, s, tbl, ["user_id"], ["ts"], ckpt)
    before = _rows(spark.table(tbl))
    # a lost checkpoint replays everything into the same table
    upsert_stream(spark, s, tbl, ["user_id"], ["ts"], scratch_dir(spark, "ckpt2"))
    assert _rows(spark.table(tbl)) == before


def test_run_status_merges_across_batches(spark, sf):
    landing, _, ckpt = R.stream_paths(spark)
    R.events_json_drop(spark, sf, landing, True)
    R.events_json_drop(spark, sf, landing, False)
    tbl = f"{R.fresh_db(spark)}.status"
    s = read_stream(spark, landing, R.EVENTS_JSON_SCHEMA, options=R.JSON_READ, max_files_per_trigger=1)
    run_status_stream(spark, s, tbl, "user_id", "event_type", "ts", R.FIXTURE_TERMINAL, ckpt)
    ev = spark.read.parquet(f"{sf}/events.parquet")
    want = run_status(ev, "user_id", "event_type", "ts", R.FIXTURE_TERMINAL)
    cols = ["user_id", "state", "n_obs", "is_terminal", "duration_ms"]
    got = spark.table(tbl).select(*cols, F.col("first_seen").cast("string"), F.col("last_seen").cast("string"))
    exp = want.select(*cols, F.col("first_seen").cast("string"), F.col("last_seen").cast("string"))
    assert _rows(got) == _rows(exp)


def test_a_replayed_status_batch_is_counted_once(spark):
    tbl, landing = f"{R.fresh_db(spark)}.status", scratch_dir(spark, "land")
    spark.createDataFrame([(7, "a", 1), (7, "b", 2)], "run int, state string, ts int").coalesce(1).write.json(landing)
    for ckpt in ("ckpt-a", "ckpt-b"):       # the sink was written, the commit was lost: batch 0 runs again
        s = read_stream(spark, landing, "run int, state string, ts int")
        s = s.withColumn("ts", F.timestamp_seconds("ts"))
        run_status_stream(spark, s, tbl, "run", "state", "ts", ("b",), scratch_dir(spark, ckpt))
    assert spark.table(tbl).count() == 1
    row = spark.table(tbl).collect()
    assert [(r.run, r.state, r.n_obs, r.is_terminal, r.duration_ms) for r in row] == [(7, "b", 2, True, 1000)]


def test_full_refresh_keeps_the_old_target_and_can_go_on(spark):
    landing, target, ckpt = R.stream_paths(spark)
    schema = "id int, day int"
    spark.createDataFrame([(1, 1)], schema).write.json(landing)
    ingest_stream(spark, landing, schema, target, ckpt)
    new_ckpt = scratch_dir(spark, "again")
    new, used = full_refresh_stream(spark, landing, schema, target, new_ckpt, partition_by=["day"])
    spark.createDataFrame([(2, 2)], schema).write.mode("append").json(landing)
    assert (new, used) == full_refresh_stream(spark, landing, schema, target, new_ckpt, partition_by=["day"])
    assert spark.read.parquet(target).count() == 1 and spark.read.parquet(new).count() == 2 and used == new_ckpt


def test_one_row_per_run_after_any_number_of_batches(spark):
    """The fold leaves one stored row per run; a batch that runs again gives the same rows."""
    tbl, landing, ckpt = f"{R.fresh_db(spark)}.status", scratch_dir(spark, "land"), scratch_dir(spark, "ckpt")
    schema = "run int, state string, ts timestamp"
    for n in range(4):
        spark.sql(f"SELECT 7 AS run, 's{n}' AS state, timestamp_seconds({n}) AS ts").coalesce(1).write.mode("append").json(landing)
        run_status_stream(spark, read_stream(spark, landing, schema), tbl, "run", "state", "ts", ("s3",), ckpt)
    want = [(7, "s3", 4, True, 3000)]
    got = lambda: [(r.run, r.state, r.n_obs, r.is_terminal, r.duration_ms) for r in spark.table(tbl).collect()]
    assert got() == want
    TB.compact(spark, tbl)
    assert got() == want and spark.table(f"{tbl}{TB.BASE}{TB.state_of(spark, tbl).base}").count() == 1


def test_readers_of_the_name_switch_after_a_full_refresh(spark):
    landing, target, ckpt = R.stream_paths(spark)
    name, schema = f"{R.fresh_db(spark)}.landed", "id int"
    spark.createDataFrame([(1,), (2,)], schema).write.json(landing)
    ingest_stream(spark, landing, schema, target, ckpt, table=name)
    assert _rows(spark.table(name).select("id")) == [(1,), (2,)]
    spark.createDataFrame([(3,)], schema).write.mode("append").json(landing)
    new, _ = full_refresh_stream(spark, landing, schema, target)                  # built beside: nothing to see yet
    assert spark.table(name).count() == 2 and spark.read.parquet(new).count() == 3
    full_refresh_stream(spark, landing, schema, target, table=name)
    assert _rows(spark.table(name).select("id")) == [(1,), (2,), (3,)]
    with pytest.raises(ValueError):
        TB.write_full(spark.range(1), name)                                       # the name of a folder is no table
    TB.drop_table(spark, name)
    assert not TB.table_exists(spark, name) and spark.read.parquet(target).count() == 2
