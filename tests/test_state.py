"""T1-T8 behaviour beyond the oracle fixture."""

from strata.operators import state as ST

CS = "k bigint, v string"


def test_reconcile_live_set_treats_stale_as_absent(spark):
    cur = spark.createDataFrame([(1, "a"), (2, "b")], CS)
    want = spark.createDataFrame([(1, "a2"), (2, "b2"), (3, "c")], CS)
    live = spark.createDataFrame([(1,)], "k bigint")
    out = {r.k: r.action for r in ST.reconcile(cur, want, "k", live).collect()}
    assert out == {1: "replace", 2: "create", 3: "create"}


def test_reconcile_keeps_absent_keys(spark):
    cur = spark.createDataFrame([(1, "a"), (9, "z")], CS)
    want = spark.createDataFrame([(1, "a2")], CS)
    out = {r.k: (r.v, r.action) for r in ST.reconcile(cur, want, "k").collect()}
    assert out == {1: ("a2", "replace"), 9: ("z", "keep")}


def test_patch_empty_string_counts(spark):
    cur = spark.createDataFrame([(1, "a")], CS)
    ch = spark.createDataFrame([(1, "")], CS)
    r = ST.patch(cur, ch, "k", ["v"]).collect()[0]
    assert (r.v, r.update_mask) == ("", "v")


def test_row_hash_null_positions_differ(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    hs = [r.row_hash for r in ST.with_row_hash(df, ["x", "y"]).collect()]
    assert hs[0] != hs[1]


def test_changed_detects_new_and_changed_only(spark):
    cur = spark.createDataFrame([(1, "a"), (2, "b")], CS)
    want = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], CS)
    out = {r.k: r.change for r in ST.changed(cur, want, "k", ["k", "v"]).collect()}
    assert out == {2: "changed", 3: "new"}


def test_search_runs_views(spark):
    from pyspark.sql import functions as F

    runs = spark.createDataFrame([(1, 10, "active"), (2, 20, "deleted"), (3, 30, "active")],
                                 "run_id bigint, start_time int, lifecycle_stage string") \
        .withColumn("tags", F.create_map(F.lit("team"), F.lit("x")))
    assert [r.run_id for r in ST.search_runs(runs, {"team": "x"}, "ALL", 2).collect()] == [3, 2]
    assert [r.run_id for r in ST.search_runs(runs, None, "DELETED_ONLY").collect()] == [2]


def test_apply_tags_last_write_wins(spark):
    log = spark.createDataFrame([(1, "a", "x", 1), (1, "a", "y", 2), (1, "b", "z", 1)],
                                "run_id bigint, key string, value string, set_at int")
    assert ST.apply_tags(log, as_map=True).collect()[0].tags == {"a": "y", "b": "z"}
    assert sorted(map(tuple, ST.apply_tags(log).collect())) == [(1, "a", "y"), (1, "b", "z")]


def test_different_rows_hash_differently(spark):
    from strata.functions.scalar import row_hash

    odd = [("a", None), ("a", "\\N"), (None, "a"), ("\\N", "a"), ("a\x1f", "b"), ("a", "\x1fb"), ("", None), (None, ""), ("-", None)]
    rows = spark.createDataFrame(odd, "a string, b string").select(row_hash("a", "b").alias("h")).collect()
    assert len({r.h for r in rows}) == len(odd)


def test_several_rows_of_a_key_are_reduced(spark):
    cur = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k int, v string, at int")
    two = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (3, "n", 1), (3, "m", 3)], "k int, v string, at int")
    got = sorted((r.k, r.v, r.action) for r in ST.reconcile(cur, two, "k", order_by=["at"]).collect())
    assert got == [(1, "y", "replace"), (2, "b", "keep"), (3, "m", "create")]
    got = sorted((r.k, r.v, r.update_mask) for r in ST.patch(cur, two.select("k", "v", "at"), "k", ["v"], order_by=["at"]).collect())
    assert got == [(1, "y", "v"), (2, "b", "")]
    assert ST.changed(cur, two, "k", ["v"], order_by=["at"]).count() == 2


def test_a_record_that_is_no_longer_live_is_created(spark):
    cur = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    want = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    live = spark.createDataFrame([(1,)], "k int")
    assert {r.k: r.action for r in ST.reconcile(cur, want, "k", live=live).collect()} == {1: "replace", 2: "create"}
