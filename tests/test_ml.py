"""M1, M5, M6 edge cases and laws."""

import pytest
from pyspark.sql import functions as F

from strata.operators import ml


def test_split_disjoint_and_complete(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    tr, te = ml.split(li, ["l_orderkey", "l_linenumber"])
    assert tr.count() + te.count() == li.count()
    again = ml.split(li.repartition(7), ["l_orderkey", "l_linenumber"])[1]
    assert sorted(map(tuple, te.collect())) == sorted(map(tuple, again.collect()))


def test_route_rules(spark):
    df = spark.range(1000).withColumn("key", F.col("id"))
    out = ml.route(df, "key", [("a", 50), ("b", 50), ("c", 0)])
    assert {r.served_entity for r in out.select("served_entity").distinct().collect()} == {"a", "b"}
    with pytest.raises(ValueError):
        ml.route(df, "key", [("a", 50), ("b", 40)])
    with pytest.raises(ValueError):
        ml.route(df, "key", [("a", 101)])


def test_decode_request_shapes(spark):
    reqs = spark.createDataFrame([
        (1, '{"dataframe_records": [{"x": 1}, {"x": 2}]}'),
        (2, '{"dataframe_split": {"columns": ["x", "y"], "data": [[1, 2], [3]]}}'),
        (3, '{"instances": [], "inputs": [1]}'),
        (4, '{}'),
        (5, '{"inputs": [[1, 2]]}'),
    ], "request_id bigint, body string")
    out = ml.decode_requests(reqs).collect()
    by = {}
    for r in out:
        by.setdefault(r.request_id, []).append(r)
    assert [x.record for x in sorted(by[1], key=lambda r: r.row_idx)] == ['{"x":1}', '{"x":2}']
    assert sorted((x.row_idx, x.ragged) for x in by[2]) == [(0, False), (1, True)]
    assert by[3][0].reject_reason == "more than one input shape set"
    assert by[4][0].reject_reason == "no input shape set"
    assert by[5][0].record == "[1,2]"


def test_training_pipeline_metrics(spark, sf):
    from strata.plans.pipelines import run_training

    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    rec = run_training(spark, li, "l_extendedprice", ["l_orderkey", "l_linenumber"], ["l_quantity"])
    assert rec["r2"] <= 1 and rec["rmse"] > 0 and rec["n_test"] > 0
    feats = ml.split_label(li, "l_extendedprice", exclude=["l_orderkey", "l_linenumber"])
    assert "l_quantity" in feats and "l_returnflag" not in feats


def test_every_request_gives_a_row(spark):
    reqs = spark.createDataFrame([
        (1, '{"inputs": {"x": 3}}'), (2, '{"instances": []}'), (3, '{"dataframe_records": {"x": 1}}'),
        (4, '{"dataframe_split": {"columns": ["x"], "data": []}}'), (5, '{"inputs": 4}'), (6, "not json"), (7, None),
        (8, '{"instances": [[5], {"x": 6}]}')], "request_id bigint, body string")
    rows = ml.decode_requests(reqs).collect()
    assert {r.request_id for r in rows} == set(range(1, 9))
    why = {r.request_id: r.reject_reason for r in rows}
    assert why == {1: None, 2: "no records", 3: "dataframe_records is malformed", 4: "no records", 5: None,
                   6: "no input shape set", 7: "no input shape set", 8: None}
    model = ml.LinearModel(["x"], [2.0], 1.0)
    scored = {(r.request_id, r.row_idx): r.predicted for r in ml.score_requests(model, ml.decode_requests(reqs), ["x"]).collect()}
    assert scored == {(1, 0): 7.0, (5, 0): 9.0, (8, 0): 11.0, (8, 1): 13.0}


def test_metrics_leave_out_missing_values(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 6.0), (None, 100.0), (5.0, None)], "predicted double, actual double")
    m = ml.regression_metrics(df).first()
    assert (m.n, m.n_unscored) == (2, 2) and m.rmse == pytest.approx((10 / 2) ** 0.5) and m.r2 == pytest.approx(1 - 10 / 8)
    assert ml.regression_metrics(df.limit(0)).first().rmse is None


def test_both_engines_agree_and_keep_rows(spark):
    df = spark.createDataFrame([(float(i), float(i * i % 7), 3.0 * i - i * i % 7 + 1) for i in range(50)], "a double, b double, y double")
    ols, lib = (ml.train(df, ["a", "b"], "y", engine=e) for e in ("ols", "mllib"))
    assert ols.coefficients == pytest.approx(list(lib.coefficients)) and ols.intercept == pytest.approx(lib.intercept)
    odd = df.unionByName(spark.createDataFrame([(None, 1.0, 2.0)], "a double, b double, y double"))
    for model in (ols, lib):
        got = ml.score(model, odd, ["a", "b"], "y").collect()
        assert len(got) == 51 and sum(r.predicted is None for r in got) == 1


@pytest.mark.parametrize("op, want", [("EQUAL_TO", [False, True, False]), ("NOT_EQUAL", [True, False, True]),
                                      ("GREATER_THAN", [False, False, True]), ("GREATER_THAN_OR_EQUAL", [False, True, True]),
                                      ("LESS_THAN", [True, False, False]), ("LESS_THAN_OR_EQUAL", [True, True, False])])
def test_all_gates(spark, op, want):
    from strata.operators.gate import gate

    df = spark.createDataFrame([(1.5,), (2.0,), (10.0,)], "m double")
    assert [r.passed for r in gate(df, "m", op, 2).collect()] == want


def _table(spark, x, y, partitions=5):
    import numpy as np

    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in np.column_stack([x, y])]
    names = [f"f{i}" for i in range(x.shape[1])]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in [*names, "y"])).repartition(partitions), names


def test_nearly_collinear_features_agree_with_a_reference_solver(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    base = rng.normal(1000, 1, 400)
    x = np.column_stack([base, base + 1e-6 * rng.normal(size=400), rng.normal(size=400)])
    y = x @ [2.0, -1.0, 0.5] + 7
    df, names = _table(spark, x, y)
    model = ml.train(df, names, "y")
    centred = x - x.mean(axis=0)
    want = np.linalg.lstsq(centred, y - y.mean(), rcond=None)[0]
    assert np.allclose(model.coefficients, want, rtol=1e-3) and np.allclose(model.coefficients, [2, -1, 0.5], rtol=1e-3)
    assert model.intercept == pytest.approx(7, rel=1e-2)
    moments = ml.train(df, names, "y", engine="moments")          # covariances square the condition number
    error = lambda m: np.abs(np.array(m.coefficients) - [2, -1, 0.5]).max()
    assert error(model) < error(moments) / 10


def test_two_hundred_features_fit_in_a_tree_of_triangles(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    x = rng.normal(size=(900, 200))
    beta = rng.normal(size=200)
    y = x @ beta - 3 + rng.normal(scale=0.1, size=900)
    x[5, 7] = y[9] = np.nan                                       # two rows with something missing
    df, names = _table(spark, x, y, partitions=40)                # more tasks than one merge takes
    model = ml.train(df, names, "y")
    ok = ~np.isnan(x).any(axis=1) & ~np.isnan(y)
    want = np.linalg.lstsq(np.column_stack([np.ones(ok.sum()), x[ok]]), y[ok], rcond=None)[0]
    assert np.allclose(model.coefficients, want[1:], atol=1e-9) and model.intercept == pytest.approx(want[0], abs=1e-9)
    assert (model.n_rows, model.n_dropped) == (898, 2)


def test_both_solvers_agree_and_count_dropped_rows(spark):
    rows = [(float(i), float(i * i % 7), 3.0 * i - 2.0 * (i * i % 7) + 1.0) for i in range(50)]
    rows += [(None, 1.0, 1.0), (1.0, float("nan"), 1.0), (1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    for engine in ("moments", "qr", "ols"):
        m = ml.train(df, ["a", "b"], "y", engine=engine)
        assert m.coefficients == pytest.approx([3, -2]) and m.intercept == pytest.approx(1)
        assert (m.n_rows, m.n_dropped) == (50, 3)
    constant = df.withColumn("b", F.lit(4.0))
    for engine in ("moments", "qr"):
        m = ml.train(constant, ["a", "b"], "y", engine=engine)
        assert m.coefficients[1] == pytest.approx(0, abs=1e-9)
    for engine in ("moments", "qr"):
        with pytest.raises(ValueError):
            ml.train(df.limit(0), ["a", "b"], "y", engine=engine)
