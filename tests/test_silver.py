"""P2/P3/A7 on edge rows the driver tables lack."""

import pytest
from pyspark.sql import functions as F

from strata.operators import silver as S

EDGE = ["not json", '{"a":[1', "{}", '{"n":null}', '{"n":""}', '{"n":"abc"}', '{"n":1.50}',
        '{"n":99999999999}', '{"N":1,"n":2}', '{"n":7}', '{"n":" 12 "}', '{"n":"+5"}',
        '{"t":[{"k": 1}],"o":{"a": 1}}', '{"t":[]}', '{"t":null}']


@pytest.fixture()
def raw(spark):
    return spark.createDataFrame([(i, s) for i, s in enumerate(EDGE)], "i int, raw_json string")


def test_project_json_edges(raw):
    spec = S.spec(("n", "int", "n"), ("t", "json", "t_raw"), ("o", "json", "o_raw"))
    out = {r.i: r for r in S.project_json(raw, spec, keep=["i"]).collect()}
    assert out[0].n is None and out[1].n is None and out[2].n is None
    assert out[3].n is None and out[4].n is None and out[5].n is None
    assert out[6].n is None            # 1.50 never truncates to 1
    assert out[7].n is None            # overflow
    assert out[8].n == 2               # case-sensitive field match
    assert out[9].n == 7
    assert out[11].n == 5
    assert out[12].t_raw == '[{"k":1}]' and out[12].o_raw == '{"a":1}'
    assert out[13].t_raw == "[]" and out[14].t_raw is None


def test_strict_mode_raises(raw, spark):
    spec = S.spec(("n", "bigint", "n"))
    with pytest.raises(Exception):
        S.project_json(raw.where("i = 5"), spec, strict=True).collect()


def test_cast_profile(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,), ("2.5",)], "v string")
    r = S.cast_profile(df, {"v": "int"}).collect()[0]
    assert (r.column_name, r.null_count, r.cast_failures, r.row_count) == ("v", 1, 2, 4)


def test_passthrough(spark):
    df = spark.createDataFrame([(1, "t")], "a int, ingested_at string")
    assert S.passthrough(df, {"ingested_at": "silver_ingested_at"}).columns == ["a", "ingested_at",
                                                                               "silver_ingested_at"]


def test_nested_paths(spark):
    docs = ['{"a": {"b": [{"c": "1", "d": {"e": 2.5}}, {"c": 7}], "x.y": {"k": "v"}}, "n": 3}',
            '{"a": {"b": [], "x.y": 5}, "n": "4"}', '{"a": {"b": "no list"}, "n": 5}', '{"a": [1, 2], "n": 6}', '{"a": null}', "{}",
            "not json", '{"a": {"b": [null, {"c": null}], "x.y": {"k": {"deep": [1]}}}, "n": 7}']
    df = spark.createDataFrame(list(enumerate(docs)), "i int, raw_json string")
    spec = S.spec(("$.a.b[0].c", "int", "first"), ("$.a.b[1].c", "int", "second"), ("$.a.b[0].d.e", "double", "e"),
                  ("$.a['x.y'].k", "string", "k"), ("n", "int", "n"), ("$.a.b[5].c", "int", "far"))
    out = S.project_json(df, spec, keep=["i"])
    got = {r.i: tuple(r)[1:] for r in out.collect()}
    none = (None,) * 5
    assert got[0] == (1, 7, 2.5, "v", 3, None) and got[1] == (None, None, None, None, 4, None)
    assert got[2] == (None, None, None, None, 5, None) and got[3] == (None, None, None, None, 6, None)
    assert got[4] == got[5] == got[6] == (None, *none) and got[7] == (None, None, None, '{"deep":[1]}', 7, None)
    assert out._jdf.queryExecution().executedPlan().toString().count("from_json(") == 1


def test_a_place_as_text_and_what_lies_in_it(spark):
    df = spark.createDataFrame([('{"a": {"b": [10, {"c": "x"}]}}',), ('{"a": 1}',)], "raw_json string")
    spec = S.spec(("a", "json", "a_raw"), ("$.a.b", "json", "b_raw"), ("$.a.b[0]", "int", "n"), ("$.a.b[1].c", "string", "c"))
    rows = [tuple(r) for r in S.project_json(df, spec).collect()]
    assert rows == [('{"b":[10,{"c":"x"}]}', '[10,{"c":"x"}]', 10, "x"), ("1", None, None, None)]


@pytest.mark.parametrize("path", ["$", "$[0].a", "$.a..b", "$.a[b]", "$a"])
def test_bad_paths_are_refused(path):
    with pytest.raises(ValueError):
        S.path_steps(path)


def test_a_place_is_an_object_or_an_array(raw):
    with pytest.raises(ValueError):
        S.project_json(raw, S.spec(("$.a.b", "int", "x"), ("$.a[0]", "int", "y")))


def test_names_and_paths(spark):
    from strata.functions import join_path, name_part

    df = spark.createDataFrame([("a.b.c",), ("b.c",), ("c",), (None,)], "n string")
    got = df.select(*[name_part("n", p) for p in ("catalog", "schema", "table")]).collect()
    assert [tuple(r) for r in got] == [("a", "b", "c"), (None, "b", "c"), (None, None, "c"), (None, None, None)]
    with pytest.raises(Exception, match="bad table name"):
        spark.sql("SELECT 'a.b.c.d' AS n").select(name_part("n", "table")).collect()
    one = lambda *p: spark.range(1).select(join_path(*[F.lit(x) for x in p])).first()[0]
    assert one("s3://b/", "/x/", "y") == "s3://b/x/y" and one("a", "*.csv") == "a/*.csv" and one("/r//", "t/") == "/r/t/"
