"""Laws from the test strategy, and a guard on driver-side actions in the library."""

import pathlib
import re

from strata.operators import state as ST

ROOT = pathlib.Path(__file__).resolve().parents[1] / "strata"

# Every driver-side action in the library, each bounded by construction.
BOUNDED_ACTIONS = {
    ("plans/pipelines.py", "regression_metrics(pred).first()"),              # one metrics row
    ("plans/sql.py", "select(\"query_text\").take(1)"),                      # one saved query
    ("plans/sql.py", "wholetext=True).first()"),                             # one SQL file text
    ("plans/registry.py", "== \"champion\").first()"),                       # one registry row
    ("operators/ml.py", "numbers.agg(*aggs).first()"),                       # k x k statistics
    ("operators/ml.py", "triangles.collect()"),                              # at most 16 triangles
    ("operators/ml.py", "json(path + \"/ols\").first()"),                    # one model row
    ("operators/tables.py", "SHOW TBLPROPERTIES {table}\").collect()"),      # table properties
    ("operators/tables.py", "LIKE '{name}{kind}*'\").collect()"),           # one table's data tables
    ("operators/selection.py", "F.count(F.lit(1)).alias(\"n\")).collect()"), # rows per pivot
    ("operators/selection.py", "alias(\"top\")).first()"),                   # least and greatest key
    ("operators/selection.py", "orderBy(\"k\").collect()"),                  # the pivots
    ("sources/ids.py", "orderBy(\"source\").collect()"),                     # one row per configured API
    ("sources/files.py", "paths.limit(n)).collect()"),                       # paths of files, which a reader lists anyway
    ("plans/refresh.py", "agg(F.max(t.mark)).first()"),                      # one mark
}


def test_driver_actions_are_bounded():
    found = set()
    for p in ROOT.rglob("*.py"):
        if "llm" in p.relative_to(ROOT).parts:
            continue
        rel = str(p.relative_to(ROOT))
        for line in p.read_text().splitlines():
            code = line.split("#", 1)[0]
            assert "toPandas(" not in code, (rel, line)
            if re.search(r"\.(collect|first)\(\)|\.take\(\d", code):
                hits = [snip for (f, snip) in BOUNDED_ACTIONS if f == rel and snip in code]
                assert hits, f"unlisted driver action in {rel}: {line.strip()}"
                found.add((rel, hits[0]))
    assert found == BOUNDED_ACTIONS


def test_reconcile_is_idempotent(spark):
    cur = spark.createDataFrame([(1, "a"), (2, "b"), (9, "z")], "k bigint, v string")
    want = spark.createDataFrame([(1, "a2"), (3, "c")], "k bigint, v string")
    once = ST.reconcile(cur, want, "k")
    state = once.drop("action")
    twice = ST.reconcile(state, want, "k")
    assert sorted((r.k, r.v) for r in twice.collect()) == sorted((r.k, r.v) for r in once.collect())
    assert {r.k: r.action for r in twice.collect()} == {1: "replace", 2: "keep", 3: "replace", 9: "keep"}


def test_ingest_counts_add_up(spark, sf):
    from strata.plans.registry import QUERIES

    r = QUERIES["ingest_quality"](spark, sf).first()
    assert r.rows == r.success + r.failure
