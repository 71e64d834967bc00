"""Plan checks: pushdown, pruning, broadcast only where bounded, band join not a nested loop."""

from pyspark.sql import functions as F

from strata.operators.bronze import ok_rows
from strata.plans.registry import QUERIES
from strata.session import scratch_dir


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_success_filter_pushed_to_parquet(spark, sf):
    path = scratch_dir(spark, "bronze")
    QUERIES["bronze_fetch"](spark, sf).write.parquet(path)
    p = plan(ok_rows(spark.read.parquet(path)).select("object_id", "raw_json"))
    pushed = p.split("PushedFilters: [", 1)[1].split("]", 1)[0]
    assert "EqualTo(http_status,200)" in pushed and "IsNotNull(raw_json)" in pushed
    assert "ReadSchema: struct<object_id:bigint,http_status:int,raw_json:string>" in p


def test_file_cap_reads_only_the_chosen_files(spark, sf):
    p = plan(QUERIES["files_capped"](spark, sf))
    assert p.count("FileScan csv") == 1 and "Join" not in p and "InMemoryFileIndex(2 paths)" in p


def test_band_join_is_equi_join(spark, sf):
    p = plan(QUERIES["sql_range_join"](spark, sf))
    assert "NestedLoop" not in p and "CartesianProduct" not in p


def test_silver_parses_json_once(spark, sf):
    p = plan(QUERIES["silver_events"](spark, sf))
    assert p.count("from_json(") == 1  # one parse per document; fields are struct accesses


def test_scan_prunes_columns(spark, sf):
    p = plan(QUERIES["gate_metrics"](spark, sf))
    assert "ReadSchema: struct<l_quantity:double,l_discount:double,l_returnflag:string,l_linestatus:string>" in p


def test_range_counts_make_no_pairs(spark, sf):
    p = plan(QUERIES["sql_range_join"](spark, sf))
    assert "array(" not in p.split("Generate")[0] and p.count("Join") <= 3 and "Window" in p
