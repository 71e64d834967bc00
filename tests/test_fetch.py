"""Token bucket, parallelism plan and retry classes, with a fake clock."""

from collections import Counter

import pytest

from strata.sources.fetch import TokenBucket, fetch_all, fetch_one, plan_parallelism
from strata.sources.transport import ScriptedTransport


class FakeClock:
    def __init__(self):
        self.t = 0.0
        self.sleeps = []

    def __call__(self):
        return self.t

    def sleep(self, s):
        self.sleeps.append(s)
        self.t += s


def test_bucket_holds_the_cap():
    c = FakeClock()
    b = TokenBucket(10.0, clock=c, sleep=c.sleep)
    times = []
    for _ in range(2000):
        b.take()
        times.append(c.t)
    rate = (len(times) - 1) / (times[-1] - times[0])
    assert rate <= 10.05 + 1e-9


def test_bucket_first_second_respects_cap():
    c = FakeClock()
    b = TokenBucket(5.0, clock=c, sleep=c.sleep)
    n = 0
    while c.t < 1.0:
        b.take()
        n += 1
    assert n <= 6  # 1 initial token + 5 per second


def test_small_rate_still_passes_requests():
    c = FakeClock()
    b = TokenBucket(0.175, clock=c, sleep=c.sleep)
    for _ in range(5):
        b.take()
    assert 4 / c.t <= 0.175 + 1e-9


def test_plan_parallelism():
    assert plan_parallelism(80, 8) == (8, 10.0)
    assert plan_parallelism(0.175, 8) == (1, 0.175)
    assert plan_parallelism(3, 8) == (3, 1.0)
    assert plan_parallelism(None, 8) == (8, None)
    with pytest.raises(ValueError):
        plan_parallelism(-1, 8)


@pytest.mark.parametrize("answers,expected", [
    ([200], (200, '{"id": 1}', None)),
    ([404], (404, None, "not_found")),
    ([503, 503, 200], (200, '{"id": 1}', None)),
    ([429], (429, None, "retries_exhausted (429)")),
    ([500], (500, None, "retries_exhausted (500)")),
    ([502], (502, None, "retries_exhausted (502)")),
    ([504], (504, None, "retries_exhausted (504)")),
    ([418], (418, None, "unexpected_status (418)")),
    (["raise"], (0, None, "network_error: connection reset")),
    (["raise", 200], (200, '{"id": 1}', None)),
])
def test_status_classes(answers, expected):
    c = FakeClock()
    t = ScriptedTransport({1: answers}).open()
    assert fetch_one(t, TokenBucket(None), 1, None, c.sleep) == expected


def test_backoff_and_every_attempt_takes_a_token():
    c = FakeClock()
    t = ScriptedTransport({1: [503, 503, 503]}).open()
    b = TokenBucket(1.0, clock=c, sleep=c.sleep)
    fetch_one(t, b, 1, None, c.sleep)
    assert len(t.calls) == 3
    assert 2 in c.sleeps  # 2 ** 1 backoff
    assert c.t >= 2 + 2  # backoff plus waits for tokens on retries


def test_fetch_all_distributed(spark):
    ids = spark.createDataFrame([(i,) for i in range(50)], "id bigint")
    script = {3: [404], 7: [503, 200], 9: [500]}
    out = fetch_all(ids, ScriptedTransport(script), partitions=4, sleep=lambda s: None)
    rows = {r.object_id: r for r in out.collect()}
    assert len(rows) == 50
    assert rows[3].error_message == "not_found"
    assert rows[7].http_status == 200
    assert rows[9].error_message == "retries_exhausted (500)"
    assert out.schema["ingested_at"].dataType.simpleString() == "timestamp"


def test_string_keys_are_not_cast(spark):
    ids = spark.createDataFrame([("cus_A1",), ("cus_B2",)], "id string")
    out = fetch_all(ids, ScriptedTransport({}), key_type="string", sleep=lambda s: None, stamp=False)
    assert sorted(r.object_id for r in out.collect()) == ["cus_A1", "cus_B2"]


def test_null_ids_are_reported_not_requested(spark):
    big = 2 ** 53 + 1
    ids = spark.createDataFrame([(1,), (None,), (big,)], "id bigint")
    out = fetch_all(ids, ScriptedTransport({}), sleep=lambda s: None, stamp=False, partitions=1).collect()
    assert {(r.object_id, r.http_status, r.error_message) for r in out} == {(1, 200, None), (big, 200, None), (None, None, "null_id")}


def test_partitions_are_honoured(spark):
    ids = spark.range(100)
    out = fetch_all(ids, ScriptedTransport({}), rate_per_sec=1000.0, partitions=37, sleep=lambda s: None, stamp=False)
    assert out.rdd.getNumPartitions() == 37


def test_rest_source_reads_finished_files_only(spark):
    from strata.session import scratch_dir
    from strata.sources.rest_source import read_rest

    path = scratch_dir(spark, "ids")
    mk = lambda lo, hi: spark.range(lo, hi).selectExpr(
        "id", "CASE WHEN id % 7 = 0 THEN 404 ELSE 200 END AS replay_status",
        "CASE WHEN id % 7 = 0 THEN NULL ELSE to_json(named_struct('id', id)) END AS replay_body")
    mk(0, 50).write.mode("append").parquet(path)
    mk(50, 60).write.parquet(f"{path}/_temporary/0")       # a running writer's files
    opts = {"ids_path": path, "transport": "replay", "partitions": "4", "retry_backoff": "false"}
    batch = read_rest(spark, **opts)
    assert batch.count() == 50 and batch.where("error_message = 'not_found'").count() == 8


def test_rest_source_reports_null_ids(spark):
    from strata.session import scratch_dir
    from strata.sources.rest_source import read_rest

    for kind in ("bigint", "string"):
        path = scratch_dir(spark, "ids")
        spark.createDataFrame([(1,), (None,), (2 ** 53 + 1,), (None,)], "id bigint").selectExpr(
            f"CAST(id AS {kind}) AS id", "200 AS replay_status", "'{}' AS replay_body").write.parquet(path)
        out = read_rest(spark, ids_path=path, transport="replay", key_type=kind, retry_backoff="false")
        one, big = (1, 2 ** 53 + 1) if kind == "bigint" else ("1", str(2 ** 53 + 1))
        assert Counter((r.object_id, r.http_status, r.raw_json, r.error_message) for r in out.collect()) == {
            (one, 200, "{}", None): 1, (big, 200, "{}", None): 1, (None, None, None, "null_id"): 2}


from hypothesis import given, settings, strategies as st  # noqa: E402


@settings(max_examples=60, deadline=None)
@given(rate=st.floats(min_value=0.05, max_value=500.0), n=st.integers(min_value=2, max_value=400),
       latency=st.floats(min_value=0.0, max_value=0.2))
def test_bucket_never_exceeds_cap(rate, n, latency):
    c = FakeClock()
    b = TokenBucket(rate, clock=c, sleep=c.sleep)
    start = c.t
    granted = []
    for _ in range(n):
        b.take()
        granted.append(c.t)
        c.t += latency          # time spent on the request itself
    # n grants need at least n - 1 refills after the first token, whatever the latency
    assert granted[-1] - start >= (n - 1) / rate - 1e-9


def test_classify_column(spark):
    from strata.sources.fetch import classify

    df = spark.createDataFrame([(200,), (404,), (0,), (503,), (418,)], "http_status int")
    assert [r.c for r in df.select(classify("http_status").alias("c")).collect()] == \
        ["ok", "not_found", "network_error", "retries_exhausted", "unexpected_status"]


def test_a_rate_is_split_by_what_is_left():
    from strata.sources.fetch import split_rate

    assert split_rate(80.0, [1, 3, 0]) == [20.0, 60.0, 0.0] and split_rate(80.0, [0, 0]) == [0.0, 0.0]


def test_a_shared_bucket_takes_what_others_leave():
    """Two tasks; the other is done after its first round, so this one gets the whole rate."""
    import time

    from strata.sources.fetch import SharedBucket

    told = []

    def gather(mine):
        told.append(mine)
        return [mine, "30" if len(told) == 1 else "0"]

    bucket = SharedBucket(100.0, 2, 0, 60, gather, every=0.05)
    began = time.monotonic()
    for _ in range(60):
        bucket.take()
        bucket.done()
    took = time.monotonic() - began
    bucket.finish()
    assert 0.5 < took < 1.0 and told[-1] == "0"          # 0.6 s at the whole rate, 1.2 s at half of it


def test_live_tasks_share_the_rate(spark):
    """All slow ids lie in one task: it gets the tokens that the others do not use, and the cap holds."""
    import time

    from strata.sources.fetch import fetch_all

    calls = spark.sparkContext.accumulator(0)

    class Counting(ScriptedTransport):
        def fetch(self, key, row=None):
            calls.add(1)
            return super().fetch(key, row)

    ids = spark.range(0, 121).selectExpr("CASE WHEN id < 120 THEN id END AS id")
    script = {i: [503, 503, 200] for i in range(0, 120, 4)}
    began = time.monotonic()
    out = fetch_all(ids, Counting(script), rate_per_sec=60, partitions=4, stamp=False, backoff=lambda s: time.sleep(min(s, 0.2)),
                    share_rate=True).collect()
    took = time.monotonic() - began
    assert sorted(r.object_id for r in out if r.object_id is not None) == list(range(120)) and len(out) == 121
    assert {r.http_status for r in out if r.object_id is not None} == {200} and [r.error_message for r in out if r.object_id is None] == ["null_id"]
    assert calls.value == 180 and took > (180 - 4) / 60


def test_rest_options_are_checked_and_ids_may_have_any_format(spark):
    from strata.session import scratch_dir
    from strata.sources.rest_source import read_rest

    path = scratch_dir(spark, "ids")
    spark.range(5).selectExpr("id", "200 AS replay_status", "'{}' AS replay_body").write.json(path)
    opts = {"ids_path": path, "ids_format": "json", "transport": "replay"}
    out = read_rest(spark, **opts, rate_per_sec="1000", partitions="2", share_rate="true")
    assert sorted(r.object_id for r in out.collect()) == [0, 1, 2, 3, 4]
    for bad in ({"transport": "ftp"}, {"transport": "http"}, {"retries": "3"}):
        with pytest.raises(ValueError):
            read_rest(spark, **{**opts, **bad})
