"""Q1-Q5, R1 and P8 behaviour beyond the oracle fixtures."""

import pytest
from pyspark.sql import functions as F

from strata.operators import tables as TB

from strata.operators.gate import compare, gate
from strata.plans.models import Model, order_models, select_models
from strata.plans.refresh import Declared, refresh
from strata.plans.registry import fresh_db
from strata.plans.sql import for_each, run_sql, split_statements


def test_gate_numeric_and_text(spark):
    df = spark.createDataFrame([("10", "9"), ("abc", "abd"), ("2", "10")], "l string, r string")
    out = df.select(compare(F.col("l"), "GREATER_THAN", F.col("r")).alias("gt")).collect()
    assert [r.gt for r in out] == [True, False, False]   # 10 > 9 as numbers, 2 > 10 false as numbers
    m = spark.createDataFrame([("a", 0.2)], "k string, v double")
    assert gate(m, "v", "LESS_THAN_OR_EQUAL", "0.2").first().passed
    with pytest.raises(ValueError):
        compare(F.col("l"), "LIKE", F.col("r"))


def test_model_order_and_selection():
    ms = [Model("c", "select * from {{ ref('b') }}", ("marts",)), Model("a", "select 1", ("staging",)),
          Model("b", "select * from {{ ref('a') }}", ("staging",))]
    assert [m.name for m in order_models(ms)] == ["a", "b", "c"]
    assert [m.name for m in select_models(ms, "tag:staging")] == ["a", "b"]
    assert sorted(m.name for m in select_models(ms, "b+")) == ["b", "c"]
    with pytest.raises(ValueError):
        order_models([Model("x", "{{ ref('y') }}"), Model("y", "{{ ref('x') }}")])


def test_refresh_modes(spark):
    db = fresh_db(spark)
    src = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k bigint, v string, at int")
    src.createOrReplaceTempView("refresh_src")

    def base(s, names):
        return s.table("refresh_src")

    def count(s, names):
        return s.table(names["base"]).agg(F.count(F.lit(1)).alias("n"))

    tables = [Declared("base", base, keys=("k",), order_by=("at",)), Declared("counts", count, inputs=("base",))]
    assert refresh(spark, tables, db) == {"base": "full", "counts": "full"}
    spark.createDataFrame([(2, "b2", 2), (3, "c", 2)], "k bigint, v string, at int") \
        .createOrReplaceTempView("refresh_src")
    assert refresh(spark, tables, db, only=("base",)) == {"base": "incremental"}
    assert spark.table(f"{db}.counts").first().n == 2          # not refreshed
    assert refresh(spark, tables, db, full_for=("counts",)) == {"base": "incremental", "counts": "full"}
    assert spark.table(f"{db}.counts").first().n == 3
    assert sorted(r.v for r in spark.table(f"{db}.base").collect()) == ["a", "b2", "c"]
    with pytest.raises(ValueError):
        refresh(spark, tables, db, full=True, only=("base",))


def test_run_sql_params_and_limit(spark):
    spark.range(10).createOrReplaceTempView("ten")
    assert run_sql(spark, "SELECT id FROM ten WHERE id >= :lo", params={"lo": 5}, row_limit=3).count() == 3
    assert split_statements("-- c\nSELECT 1;\nSELECT\n 2;\n") == ["SELECT 1", "SELECT\n 2"]


def test_statements_end_outside_literals_and_comments():
    text = "SELECT ';' AS a, '-- no' AS b; -- c; d\n/* e; */ SELECT \"x;y\" FROM t WHERE s = 'it''s;' ; SELECT 3"
    assert split_statements(text) == ["SELECT ';' AS a, '-- no' AS b", "SELECT \"x;y\" FROM t WHERE s = 'it''s;'", "SELECT 3"]


def test_for_each_binds_each_row(spark):
    spark.createDataFrame([(1, 10), (1, 20), (2, 5)], "k int, v int").createOrReplaceTempView("fe")
    inputs = spark.createDataFrame([(1, 15), (2, 0), (3, 0)], "key int, least int")
    out = for_each(spark, inputs, "SELECT v, ':key' AS text FROM fe WHERE k = :key AND v >= :least;")
    assert sorted(map(tuple, out.collect())) == [(1, 15, 20, ":key"), (2, 0, 5, ":key")]
    with pytest.raises(ValueError):
        for_each(spark, inputs, "SELECT :nothing AS x")


def test_statement_in_another_schema_sees_the_callers_views(spark):
    db = fresh_db(spark)
    spark.range(3).write.saveAsTable(f"{db}.t3")
    spark.range(2).createOrReplaceTempView("own_view")
    before = spark.catalog.currentDatabase()
    assert run_sql(spark, "SELECT count(*) AS n FROM t3 CROSS JOIN own_view", schema=db).first().n == 6
    assert spark.catalog.currentDatabase() == before
    with pytest.raises(Exception):
        run_sql(spark, "SELECT * FROM no_such_table", schema=db)
    assert spark.catalog.currentDatabase() == before


def test_incremental_refresh_reads_new_input_only(spark):
    db, asked = fresh_db(spark), []

    def build(s, names):
        return s.table("inc_src")

    def changes(s, names, mark):
        asked.append(mark)
        return s.table("inc_src").where(F.col("at") >= mark)

    t = [Declared("t", build, keys=("k",), order_by=("at",), mark="at", changes=changes)]
    mk = lambda rows: spark.createDataFrame(rows, "k int, v string, at int").createOrReplaceTempView("inc_src")
    mk([(1, "a", 1), (2, "b", 2)])
    assert refresh(spark, t, db) == {"t": "full"}
    mk([(1, "changed long ago", 1), (2, "b2", 2), (3, "c", 3)])
    assert refresh(spark, t, db) == {"t": "incremental"} and asked == [2]
    assert sorted(r.v for r in spark.table(f"{db}.t").collect()) == ["a", "b2", "c"]
    mk([(3, "only", 3)])
    assert refresh(spark, t, db, full_for=("t",)) == {"t": "full"}
    assert [r.v for r in spark.table(f"{db}.t").collect()] == ["only"]


def test_late_orders_are_counted_by_an_incremental_refresh(spark):
    from strata.plans.registry import declared_orders

    db = fresh_db(spark)
    orders = f"{db}.orders"
    mk = lambda *rows: (spark.createDataFrame(rows, "o_orderkey bigint, day string, o_totalprice double")
                        .withColumn("o_orderdate", F.col("day").cast("timestamp_ntz")))
    days = lambda: {str(r.day): (r.n_orders, r.revenue) for r in spark.table(f"{db}.order_daily").collect()}
    TB.append(mk((1, "1995-01-01", 1.0), (2, "1995-01-02", 2.0), (3, "1995-01-03", 4.0), (9, None, 1.0)), orders)
    assert refresh(spark, declared_orders(orders), db) == {"order_daily": "full", "status_mix": "full"}
    TB.append(mk((4, "1995-01-01", 8.0), (5, "1994-12-31", 16.0), (8, None, 2.0)), orders)     # late: an earlier day, one not seen yet, none
    assert refresh(spark, declared_orders(orders), db) == {"order_daily": "incremental", "status_mix": "full"}
    want = {"1994-12-31": (1, 16.0), "1995-01-01": (2, 9.0), "1995-01-02": (1, 2.0), "1995-01-03": (1, 4.0), "None": (2, 3.0)}
    assert days() == want
    TB.write_full(spark.table(orders).where("o_orderkey < 3"), orders)              # what was seen is not there any more
    assert refresh(spark, declared_orders(orders), db, only=("order_daily",)) == {"order_daily": "full"}
    assert days() == {"1995-01-01": (1, 1.0), "1995-01-02": (1, 2.0)}


def test_only_touched_keys_are_built_and_keys_without_input_go(spark):
    """Orders change their day by upserts, with folds of the input in between."""
    db, built = fresh_db(spark), spark.sparkContext.accumulator(0)
    orders = f"{db}.orders"
    put = lambda *rows: TB.upsert(spark, spark.createDataFrame(rows, "id int, day string, v int"), orders, ["id"])

    def daily(s, names):
        def count(batches):
            for b in batches:
                built.add(b.num_rows)
                yield b

        rows = s.table(names[orders])
        return rows.mapInArrow(count, rows.schema).groupBy("day").agg(F.sum("v").alias("v"))

    t = [Declared("daily", daily, inputs=(orders,), keys=("day",), affected={orders: ["day"]})]
    days = lambda: {r.day: r.v for r in spark.table(f"{db}.daily").collect()}
    put((1, "a", 1), (2, "a", 2), (3, "b", 4), (4, "c", 8), (5, "c", 16))
    assert refresh(spark, t, db) == {"daily": "full"} and days() == {"a": 3, "b": 4, "c": 24} and built.value == 5
    put((3, "d", 4))                                                      # b has no order left
    TB.compact(spark, orders)                                             # and the base no trace of where it was
    assert refresh(spark, t, db) == {"daily": "incremental"} and days() == {"a": 3, "d": 4, "c": 24} and built.value == 6
    put((2, "c", 2))
    assert refresh(spark, t, db) == {"daily": "incremental"} and days() == {"a": 1, "d": 4, "c": 26} and built.value == 10
    assert refresh(spark, t, db) == {"daily": "incremental"} and built.value == 10


def test_touched_rows_are_found_by_a_semi_join(spark):
    from strata.plans.refresh import rows_of_keys

    rows = spark.range(9).selectExpr("id", "date_from_unix_date(int(id)) AS d")
    touched = spark.range(3).selectExpr("date_from_unix_date(int(id)) AS _k0")
    plan = rows_of_keys(rows, ["d"], touched)._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "NestedLoop" not in plan
