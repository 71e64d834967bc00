"""W3/W4/O3/T5 laws: idempotence, ties, NULL keys, skew-safe plans."""

import pytest
from pyspark.sql import functions as F

from strata.operators import tables as TB
from strata.plans.registry import fresh_db

SCHEMA = "k bigint, ts int, v string"


def _key(r):
    return tuple((x is None, "" if x is None else x) for x in r)


def rows(df):
    return sorted((tuple(r) for r in (df.collect() if hasattr(df, "collect") else df)), key=_key)


def test_latest_picks_newest_and_breaks_ties(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "b"), (1, 3, "c"), (2, 1, "z"), (None, 5, "n")], SCHEMA)
    assert rows(TB.latest(df, ["k"], ["ts"])) == rows([(1, 3, "c"), (2, 1, "z"), (None, 5, "n")])


def test_latest_is_partial_aggregate(spark):
    df = spark.createDataFrame([(1, 1, "a")], SCHEMA)
    plan = TB.latest(df, ["k"], ["ts"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_upsert_twice_is_same_table(spark):
    db = fresh_db(spark)
    t = f"{db}.kv"
    a = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], SCHEMA)
    b = spark.createDataFrame([(2, 2, "b2"), (3, 1, "c"), (1, 0, "old")], SCHEMA)
    TB.upsert(spark, a, t, ["k"], ["ts"])
    TB.upsert(spark, b, t, ["k"], ["ts"])
    first = rows(spark.table(t))
    TB.upsert(spark, b, t, ["k"], ["ts"])
    assert rows(spark.table(t)) == first == [(1, 1, "a"), (2, 2, "b2"), (3, 1, "c")]


def test_upsert_tie_incoming_wins(spark):
    db = fresh_db(spark)
    t = f"{db}.kv"
    TB.upsert(spark, spark.createDataFrame([(1, 5, "zzz")], SCHEMA), t, ["k"], ["ts"])
    TB.upsert(spark, spark.createDataFrame([(1, 5, "aaa")], SCHEMA), t, ["k"], ["ts"])
    assert rows(spark.table(t)) == [(1, 5, "aaa")]


def names(spark, table, of="__"):
    """Data tables of a table in the catalog."""
    db, name = table.split(".")
    return [x.name for x in spark.catalog.listTables(db) if x.name.startswith(name + of)]


def test_a_failed_overwrite_leaves_the_table(spark):
    t = f"{fresh_db(spark)}.kv"
    TB.write_full(spark.createDataFrame([(1, 1, "a")], SCHEMA), t)
    before = names(spark, t)
    with pytest.raises(Exception):
        TB.write_full(spark.range(3).select(F.raise_error(F.lit("broken")).cast("string").alias("v")), t)
    assert rows(spark.table(t)) == [(1, 1, "a")] and names(spark, t) == before


def test_a_crash_before_the_view_is_set_changes_nothing_and_a_dropped_table_stays_dropped(spark, monkeypatch):
    t = f"{fresh_db(spark)}.kv"
    TB.write_full(spark.createDataFrame([(1, 1, "old")], SCHEMA), t)

    def crash(*args):
        raise RuntimeError("crash")

    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(TB, "_publish", crash)
        TB.write_full(spark.createDataFrame([(9, 9, "new")], SCHEMA), t)
    assert len(names(spark, t)) == 2                       # the data that no reader was shown
    assert rows(spark.table(t)) == [(1, 1, "old")]
    TB.upsert(spark, spark.createDataFrame([(2, 1, "b")], SCHEMA), t, ["k"], ["ts"])
    assert rows(spark.table(t)) == [(1, 1, "old"), (2, 1, "b")]
    held = len(names(spark, t))
    assert TB.vacuum(spark, t) == [] and len(TB.vacuum(spark, t, older_than_seconds=0)) == 1
    assert rows(spark.table(t)) == [(1, 1, "old"), (2, 1, "b")] and len(names(spark, t)) == held - 1
    TB.drop_table(spark, t)
    assert not TB.table_exists(spark, t) and names(spark, t) == []
    assert TB.inventory(spark, t.split(".")[0]).where("not is_temporary").count() == 0


def test_a_reader_finds_old_or_new_rows_during_a_write(spark):
    """Read from another thread while the table is replaced over and over: never absent, never mixed."""
    import threading

    t = f"{fresh_db(spark)}.kv"
    write = lambda v: TB.write_full(spark.range(50).select("id", F.lit(v).alias("v")).repartition(4), t)
    write(0)
    seen, errors, done = [], [], threading.Event()

    def read():
        while not done.is_set():
            try:
                seen.append(tuple(spark.table(t).agg(F.count("*"), F.min("v"), F.max("v")).first()))
            except Exception as exc:
                errors.append(exc)

    reader = threading.Thread(target=read)
    reader.start()
    for v in range(1, 6):
        write(v)
    done.set()
    reader.join()
    assert not errors and seen and all(n == 50 and low == high for n, low, high in seen)
    assert [v for _, v, _ in seen] == sorted(v for _, v, _ in seen)


def test_replaced_data_goes_when_it_was_kept_long_enough(spark, monkeypatch):
    t = f"{fresh_db(spark)}.kv"
    for v in range(4):
        TB.write_full(spark.createDataFrame([(v, v, "x")], SCHEMA), t)
    assert len(names(spark, t)) == 4
    monkeypatch.setattr(TB, "KEEP_SECONDS", 0)
    TB.write_full(spark.createDataFrame([(9, 9, "x")], SCHEMA), t)
    assert len(names(spark, t)) == 1 and rows(spark.table(t)) == [(9, 9, "x")]


def test_full_write_then_upsert(spark):
    t = f"{fresh_db(spark)}.kv"
    TB.write_full(spark.createDataFrame([(1, 1, "a"), (1, 2, "a2"), (2, 1, "b")], SCHEMA), t)
    TB.upsert(spark, spark.createDataFrame([(2, 2, "b2"), (3, 1, "c")], SCHEMA), t, ["k"], ["ts"])
    assert rows(spark.table(t)) == [(1, 2, "a2"), (2, 2, "b2"), (3, 1, "c")]


def test_every_reader_sees_one_row_per_key(spark):
    """By name, by SQL and through Silver: no older version, no column of the layer's own."""
    from strata.operators.silver import silver, spec

    t = f"{fresh_db(spark)}.bronze"
    schema = "object_id bigint, http_status int, raw_json string, ingested_at int"
    for at, status, value in ((1, 200, 1), (2, 200, 2)):
        batch = [(7, status, '{"v": %d}' % value, at), (at + 10, 200, '{"v": 0}', at)]
        TB.upsert(spark, spark.createDataFrame(batch, schema), t, ["object_id"], ["ingested_at"])
    assert spark.table(t).columns == ["object_id", "http_status", "raw_json", "ingested_at"]
    assert spark.sql(f"SELECT count(*) AS n, count(DISTINCT object_id) AS k FROM {t}").first() == (3, 3)
    got = silver(spark.table(t), spec(("v", "int", "v"))).select("object_id", "v")
    assert rows(got) == [(7, 2), (11, 0), (12, 0)]


def test_versions_fold_and_the_batch_is_evaluated_once(spark):
    t, seen = f"{fresh_db(spark)}.kv", spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    for i in range(7):
        batch = spark.createDataFrame([(1, i, f"v{i}"), (10 + i, 0, "x")], SCHEMA)
        TB.upsert(spark, batch.mapInArrow(count, SCHEMA), t, ["k"], ["ts"], fold_every=3)
    assert seen.value == 14
    assert rows(spark.table(t)) == [(1, 6, "v6"), *[(10 + i, 0, "x") for i in range(7)]]
    assert len(TB._parts(spark, t, TB.state_of(spark, t))) < 3
    with pytest.raises(ValueError):
        TB.upsert(spark, batch, t, ["ts"], ["k"])


def test_rows_added_while_a_fold_is_written_stay(spark, monkeypatch):
    t = f"{fresh_db(spark)}.kv"
    mk = lambda *r: spark.createDataFrame(list(r), SCHEMA)
    TB.upsert(spark, mk((1, 1, "a")), t, ["k"], ["ts"])
    TB.upsert(spark, mk((1, 2, "a2")), t, ["k"], ["ts"])
    write = TB._write_data

    def and_an_append(df, name, *args):
        write(df, name, *args)
        if TB.BASE in name:                                # the fold has read its rows; another writer comes in
            monkeypatch.setattr(TB, "_write_data", write)
            TB.upsert(spark, mk((2, 1, "b"), (1, 3, "a3")), t, ["k"], ["ts"])

    monkeypatch.setattr(TB, "_write_data", and_an_append)
    TB.compact(spark, t)
    assert rows(spark.table(t)) == [(1, 3, "a3"), (2, 1, "b")]
    TB.compact(spark, t)
    assert rows(spark.table(t)) == [(1, 3, "a3"), (2, 1, "b")]


def test_a_fold_gives_way_to_a_whole_write(spark, monkeypatch):
    t = f"{fresh_db(spark)}.kv"
    mk = lambda *r: spark.createDataFrame(list(r), SCHEMA)
    TB.upsert(spark, mk((1, 1, "a")), t, ["k"], ["ts"])
    TB.upsert(spark, mk((2, 1, "b")), t, ["k"], ["ts"])
    write = TB._write_data

    def and_a_replacement(df, name, *args):
        write(df, name, *args)
        monkeypatch.setattr(TB, "_write_data", write)
        TB.write_keyed(mk((5, 5, "e")), t, ["k"], ["ts"])

    monkeypatch.setattr(TB, "_write_data", and_a_replacement)
    TB.compact(spark, t)
    assert rows(spark.table(t)) == [(5, 5, "e")]


def test_parts_of_two_writers_are_both_seen(spark, monkeypatch):
    """Another writer's part appears between this writer's listing and its view: the view is set again."""
    t = f"{fresh_db(spark)}.log"
    mk = lambda v: spark.createDataFrame([(v,)], "v int")
    TB.append(mk(0), t)
    view = TB._view_sql

    def late(spark_, table, state, parts):
        text = view(spark_, table, state, parts)
        monkeypatch.setattr(TB, "_view_sql", view)
        TB.append(mk(2), t)                                # sets its own view, which is then overwritten
        return text

    monkeypatch.setattr(TB, "_view_sql", late)
    TB.append(mk(1), t)
    assert rows(spark.table(t)) == [(0,), (1,), (2,)]


def test_appends_fold_and_keep_duplicates(spark):
    t = f"{fresh_db(spark)}.log"
    for v in range(5):
        TB.append(spark.createDataFrame([(v % 2,), (7,)], "v int"), t, fold_every=2)
    assert rows(spark.table(t)) == [(0,), (0,), (0,), (1,), (1,), *[(7,)] * 5]
    with pytest.raises(Exception):
        TB.append(spark.createDataFrame([("x",)], "other string"), t)


def test_reads_of_untouched_keys_compare_nothing(spark):
    t = f"{fresh_db(spark)}.kv"
    TB.write_keyed(spark.createDataFrame([(k, 1, "a") for k in range(50)], SCHEMA), t, ["k"], ["ts"])
    plan = lambda: spark.table(t)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan() and "Join" not in plan()
    TB.upsert(spark, spark.createDataFrame([(1, 2, "b"), (None, 1, "n")], SCHEMA), t, ["k"], ["ts"])
    assert "LeftAnti" in plan() and "LeftSemi" in plan() and "NestedLoop" not in plan()
    assert spark.table(t).count() == 51


def test_changed_rows_have_all_versions_of_their_keys(spark):
    t = f"{fresh_db(spark)}.kv"
    mk = lambda *r: spark.createDataFrame(list(r), SCHEMA)
    TB.write_keyed(mk((1, 1, "a"), (2, 1, "b"), (None, 1, "n")), t, ["k"], ["ts"])
    TB.upsert(spark, mk((1, 2, "a2")), t, ["k"], ["ts"])
    seen = TB.commits(spark, t)
    assert TB.changed_rows(spark, t, seen).count() == 0
    TB.upsert(spark, mk((2, 2, "b2"), (None, 2, "n2"), (4, 1, "d")), t, ["k"], ["ts"])
    want = [(2, 1, "b"), (2, 2, "b2"), (4, 1, "d"), (None, 1, "n"), (None, 2, "n2")]
    assert rows(TB.changed_rows(spark, t, seen).distinct()) == rows(want)
    TB.compact(spark, t)
    TB.upsert(spark, mk((1, 3, "a3")), t, ["k"], ["ts"])
    want += [(1, 1, "a"), (1, 2, "a2"), (1, 3, "a3")]
    assert rows(TB.changed_rows(spark, t, seen).distinct()) == rows(want)
    TB.write_keyed(mk((1, 1, "x")), t, ["k"], ["ts"])
    assert TB.changed_rows(spark, t, seen) is None


def test_deleted_keys_go_and_may_come_back(spark):
    t = f"{fresh_db(spark)}.kv"
    mk = lambda *r: spark.createDataFrame(list(r), SCHEMA)
    TB.upsert(spark, mk((1, 1, "a"), (2, 1, "b")), t, ["k"])
    TB.delete_keys(spark, mk((1, 0, "")).select("k"), t)
    assert rows(spark.table(t)) == [(2, 1, "b")]
    TB.compact(spark, t)
    assert rows(spark.table(t)) == [(2, 1, "b")]
    TB.upsert(spark, mk((1, 0, "again")), t, ["k"])
    assert rows(spark.table(t)) == [(1, 0, "again"), (2, 1, "b")]


def test_order_columns_may_be_expressions(spark):
    t = f"{fresh_db(spark)}.kv"
    mk = lambda *r: spark.createDataFrame(list(r), SCHEMA)
    order = ["coalesce(v = 'ok', false)", "ts"]
    TB.upsert(spark, mk((1, 1, "ok"), (1, 9, "bad"), (2, 1, "bad")), t, ["k"], order)
    TB.upsert(spark, mk((1, 5, None), (2, 2, "bad")), t, ["k"], order)
    assert rows(spark.table(t)) == [(1, 1, "ok"), (2, 2, "bad")]
    TB.compact(spark, t)
    TB.upsert(spark, mk((1, 6, "ok")), t, ["k"], order)
    assert rows(spark.table(t)) == [(1, 6, "ok"), (2, 2, "bad")]


def test_a_plain_table_is_refused_until_it_is_taken_over(spark):
    t = f"{fresh_db(spark)}.kv"
    spark.createDataFrame([(1, 1, "a")], SCHEMA).write.saveAsTable(t)
    batch = spark.createDataFrame([(2, 2, "b2"), (1, 2, "a2")], SCHEMA)
    for write in (lambda: TB.upsert(spark, batch, t, ["k"], ["ts"]), lambda: TB.write_full(batch, t)):
        with pytest.raises(ValueError):
            write()
    TB.adopt(spark, t)
    TB.adopt(spark, t)
    assert rows(spark.table(t)) == [(1, 1, "a")]
    TB.append(spark.createDataFrame([(1, 1, "a")], SCHEMA), t)
    assert rows(spark.table(t)) == [(1, 1, "a")] * 2
    TB.upsert(spark, batch, t, ["k"], ["ts"])
    assert rows(spark.table(t)) == [(1, 2, "a2"), (2, 2, "b2")]


def test_split_name():
    assert TB.split_name("a.b.c") == ("a", "b", "c") and TB.split_name("b.c") == (None, "b", "c")
    assert TB.split_name("c") == (None, None, "c")
    with pytest.raises(ValueError):
        TB.split_name("a.b.c.d")


def test_dedupe_token_keeps_nulls(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (None, 3, "c"), (None, 4, "d")], SCHEMA)
    assert rows(TB.dedupe_token(df, "k", ["ts"])) == rows([(1, 1, "a"), (None, 3, "c"), (None, 4, "d")])


def test_replace_from_query_reading_itself(spark):
    db = fresh_db(spark)
    t = f"{db}.r"
    spark.range(5).createOrReplaceTempView("five")
    TB.replace_from_query(spark, t, "SELECT id FROM five")
    TB.replace_from_query(spark, t, f"SELECT id + 1 AS id FROM {t}")
    assert sorted(r.id for r in spark.table(t).collect()) == [1, 2, 3, 4, 5]


def test_write_observed_counts(spark):
    db = fresh_db(spark)
    df = spark.createDataFrame([(200,), (404,), (200,)], "http_status int")
    rec = TB.write_observed(df, f"{db}.b", ok_expr=F.col("http_status") == 200)
    assert (rec["rows"], rec["success"], rec["failure"]) == (3, 2, 1)


def test_snapshot_and_inventory(spark):
    db = fresh_db(spark)
    TB.write_full(spark.range(3), f"{db}.t1")
    snap = TB.snapshot(spark, f"{db}.t1").collect()[0]
    assert snap.name == "t1" and snap.schema_name == db and snap.format == "parquet"
    assert [r.name for r in TB.inventory(spark, db).where("not is_temporary").collect()] == ["t1"]


def test_latest_carries_map_columns(spark):
    df = spark.createDataFrame([(1, 1, {"a": "x"}), (1, 2, {"a": "y"})], "k bigint, ts int, tags map<string,string>")
    r = TB.latest(df, ["k"], ["ts"]).collect()[0]
    assert (r.ts, r.tags) == (2, {"a": "y"})
    plan = TB.latest(df, ["k"], ["ts"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan
