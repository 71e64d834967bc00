"""End-to-end pipelines: API ingest gate and caps, file ingest, specs, literal rows."""

import pytest
from pyspark.sql import functions as F

from strata.plans import specs
from strata.plans.pipelines import run_api_ingest, run_configured_ingest, run_file_ingest
from strata.plans.registry import fresh_db
from strata.session import scratch_dir
from strata.sources.transport import ScriptedTransport


def test_gate_keeps_previous_bronze(spark):
    db = fresh_db(spark)
    ids = spark.range(10)
    good = run_api_ingest(spark, ids, ScriptedTransport({}), f"{db}.bronze", sleep=lambda s: None,
                          min_success_ratio=0.5, runs_table=f"{db}.runs")
    assert good["rows"] == 10 and "gated" not in good
    bad = run_api_ingest(spark, ids, ScriptedTransport({i: [500] for i in range(10)}), f"{db}.bronze",
                         sleep=lambda s: None, min_success_ratio=0.5, runs_table=f"{db}.runs")
    assert bad["gated"] and bad["success"] == 0
    assert spark.table(f"{db}.bronze").where("http_status = 200").count() == 10
    assert spark.table(f"{db}.runs").count() == 2


def test_config_caps_and_blank_params(spark):
    cfg = specs.IngestConfig.from_params(
        {"name": "met", "detail_url": "http://x/{id}", "table": "t"}, {"max_objects": "3", "rate_per_sec": ""})
    assert cfg.max_objects == 3 and cfg.rate_per_sec is None
    with pytest.raises(ValueError):
        specs.IngestConfig(name="x", detail_url="u", max_objects=-1)
    db = fresh_db(spark)
    cfg.table = f"{db}.b"
    rec = run_configured_ingest(spark, cfg, spark.range(100), ScriptedTransport({}), sleep=lambda s: None)
    assert rec["rows"] == 3
    assert sorted(r.object_id for r in spark.table(cfg.table).collect()) == [0, 1, 2]


def test_met_spec_has_32_silver_columns():
    # 30 JSON fields + object_id + ingested_at kept from Bronze
    assert len(specs.MET_OBJECTS) + 2 == 32
    assert {f.alias for f in specs.MET_OBJECTS} >= {"artist_begin_date", "artist_end_date"}


def test_file_ingest_with_cap(spark, sf):
    path = scratch_dir(spark, "csv")
    spark.read.parquet(f"{sf}/orders.parquet").repartition(3).write.option("header", "true").csv(path)
    db = fresh_db(spark)
    rec = run_file_ingest(spark, path, f"{db}.bronze_files", max_files=2,
                          schema="o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                                 "o_orderdate timestamp_ntz, o_orderpriority string")
    t = spark.table(f"{db}.bronze_files")
    assert t.select("source_file").distinct().count() == 2 and rec["rows"] == t.count()
    assert {"source_file", "ingested_at"} <= set(t.columns)


def test_literal_rows(spark):
    from strata.sources.files import literal_rows

    r = literal_rows(spark, 1, hello=1).withColumn("ts", F.current_timestamp()).collect()
    assert r[0].hello == 1 and r[0].ts is not None


def test_upsert_mode_fetches_once_and_merges(spark):
    db = fresh_db(spark)
    t = f"{db}.bronze"
    calls = spark.sparkContext.accumulator(0)

    class Counting(ScriptedTransport):
        def fetch(self, key, row=None):
            calls.add(1)
            return super().fetch(key, row)

    run_api_ingest(spark, spark.range(0, 6), Counting({}), t, sleep=lambda s: None, mode="upsert")
    run_api_ingest(spark, spark.range(4, 10), Counting({5: [404]}), t, sleep=lambda s: None, mode="upsert")
    assert calls.value == 12                      # every id requested exactly once per run
    rows = {r.object_id: r.http_status for r in spark.table(t).collect()}
    assert sorted(rows) == list(range(10)) and rows[5] == 404


def test_a_failed_fetch_does_not_replace_a_good_body(spark):
    """A transient failure loses to any answer of the API; an answer (here: gone) wins if it is newer."""
    t = f"{fresh_db(spark)}.bronze"
    pull = lambda script: run_api_ingest(spark, spark.range(3), ScriptedTransport(script), t, sleep=lambda s: None, mode="upsert")
    got = lambda: {r.object_id: (r.http_status, r.raw_json is not None) for r in spark.table(t).collect()}
    pull({2: [500] * 9})
    pull({0: [500] * 9, 1: [404], 2: [500] * 9})
    want = {0: (200, True), 1: (404, got()[1][1]), 2: (500, got()[2][1])}
    assert got() == want
    from strata.operators.tables import compact

    compact(spark, t)
    assert got() == want
    pull({})
    assert {k: v[0] for k, v in got().items()} == {0: 200, 1: 200, 2: 200}


def test_list_pages_are_called_once(spark):
    from strata.sources.ids import cursor_pages

    calls = spark.sparkContext.accumulator(0)

    class Counting(ScriptedTransport):
        def list_page(self, source, cursor, page_size):
            calls.add(1)
            return super().list_page(source, cursor, page_size)

    sources = spark.createDataFrame([("a",)], "source string")
    ids = cursor_pages(sources, Counting({}, pages={"a": list(range(150))}), page_size=100).select("id")
    rec = run_api_ingest(spark, ids, ScriptedTransport({}), f"{fresh_db(spark)}.bronze", sleep=lambda s: None)
    assert rec["rows"] == 150 and calls.value == 2


def test_an_interrupted_pull_keeps_its_chunks(spark):
    from strata.sources.fetch import fetch_all
    from strata.sources.staging import load_staged, resume

    path, ids = scratch_dir(spark, "stage"), spark.range(60)
    asked, chunk = spark.sparkContext.accumulator(0), []

    class Counting(ScriptedTransport):
        def fetch(self, key, row=None):
            asked.add(1)
            return super().fetch(key, row)

    def fetch(todo):
        chunk.append(1)
        if len(chunk) == 4:
            raise RuntimeError("killed")
        return fetch_all(todo, Counting({}), sleep=lambda s: None, stamp=False)

    with pytest.raises(RuntimeError):
        resume(spark, ids, path, fetch, chunks=6)
    kept = load_staged(spark, path).count()
    assert 0 < kept < 60 and asked.value == kept
    assert resume(spark, ids, path, fetch, chunks=6).count() == 60 and asked.value == 60     # no id asked twice


def test_training_run_record_can_be_read_back(spark, sf):
    import json

    from strata.plans.pipelines import run_training

    db = fresh_db(spark)
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    rec = run_training(spark, li, "l_extendedprice", ["l_orderkey", "l_linenumber"], ["l_quantity"],
                       predictions_table=f"{db}.p", runs_table=f"{db}.runs")
    run = spark.table(f"{db}.runs").collect()
    assert len(run) == 1 and run[0].run_id == rec["run_id"] and run[0].run_name == "training"
    assert json.loads(run[0].metrics)["rmse"] == pytest.approx(rec["rmse"])
    assert spark.table(f"{db}.p").count() == rec["n_test"]


def test_late_commit_reaches_silver(spark):
    from strata.operators.silver import refresh_silver, spec

    db = fresh_db(spark)
    bronze, silver = f"{db}.bronze", f"{db}.silver"
    schema = "object_id bigint, http_status int, raw_json string, error_message string, ingested_at int"
    fields = spec(("v", "int", "v"))
    add = lambda rows: spark.createDataFrame(rows, schema).write.mode("append").saveAsTable(bronze)
    add([(1, 200, '{"v": 1}', None, 20)])
    refresh_silver(spark, bronze, silver, fields)
    add([(2, 200, '{"v": 2}', None, 10)])            # a longer pull that began earlier commits now
    refresh_silver(spark, bronze, silver, fields)
    add([(1, 200, '{"v": 9}', None, 5)])             # older than what Silver has: no change
    refresh_silver(spark, bronze, silver, fields)
    assert sorted((r.object_id, r.v) for r in spark.table(silver).collect()) == [(1, 1), (2, 2)]
