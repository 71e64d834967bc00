"""List parsing, cursor walks, caps."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.sources import ids as I
from strata.sources.transport import ScriptedTransport, TransportError


class FakeClock:
    """Time stands still, so each token but the first must be waited for."""

    def __call__(self):
        return 0.0


def test_ids_from_list_missing_and_null(spark):
    df = spark.createDataFrame([('{"total": 2, "objectIDs": [5, 6]}',), ('{"total": 0}',),
                                ('{"objectIDs": null}',), ("not json",)], "body string")
    assert sorted(r.id for r in I.ids_from_list(df).collect()) == [5, 6]


def test_ids_from_list_nested_path(spark):
    df = spark.createDataFrame([('{"data": [{"id": "a"}, {"id": "b"}], "has_more": false}',)], "body string")
    assert [r.id for r in I.ids_from_list(df, path="data[].id", key_type="string").collect()] == ["a", "b"]


def pages(spark, src_ids, **kw):
    t = ScriptedTransport({}, pages=src_ids)
    sources = spark.createDataFrame([(s,) for s in src_ids], "source string")
    return I.cursor_pages(sources, t, **kw)


def test_cursor_walk_all_pages(spark):
    out = pages(spark, {"a": list(range(1, 251)), "b": [7]}, page_size=100).collect()
    a = sorted((r.id, r.page) for r in out if r.source == "a")
    assert [i for i, _ in a] == list(range(1, 251))
    assert {p for _, p in a} == {0, 1, 2}
    assert [r.id for r in out if r.source == "b"] == [7]


def test_cursor_cap_applies_even_without_more(spark):
    out = pages(spark, {"a": list(range(1, 51))}, page_size=100, cap=10).collect()
    assert sorted(r.id for r in out) == list(range(1, 11))


def test_cursor_cap_zero_and_empty_source(spark):
    assert pages(spark, {"a": [1, 2]}, cap=0).count() == 0
    assert pages(spark, {"a": []}).count() == 0
    with pytest.raises(ValueError):
        pages(spark, {"a": [1]}, cap=-1)


def test_cap_ids_ordered(spark):
    ids = spark.range(100).select(F.col("id")).orderBy(F.rand(1))
    assert [r.id for r in I.cap_ids(ids, 3).collect()] == [0, 1, 2]
    assert I.cap_ids(ids, None).count() == 100
    assert I.cap_ids(ids, 0).count() == 0


def test_new_and_failed_ids(spark):
    ids = spark.range(10)
    bronze = spark.createDataFrame([(1, 200, "x", None), (2, 404, None, "not_found"),
                                    (3, 500, None, "retries_exhausted (500)"), (4, 0, None, "network_error: x")],
                                   "object_id bigint, http_status int, raw_json string, error_message string")
    assert sorted(r.id for r in I.new_ids(ids, bronze).collect()) == [0, 5, 6, 7, 8, 9]
    assert sorted(r.id for r in I.failed_ids(bronze).collect()) == [3, 4]


def test_caps_are_exact_at_any_size(spark):
    ids = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("id")).repartition(6)
    assert [r.id for r in I.cap_ids(ids, 1234).collect()] == list(range(1234))
    assert I.cap_ids(ids, 5000).count() == I.cap_ids(ids, 9999).count() == 5000


def test_ids_from_a_root_array(spark):
    df = spark.createDataFrame([("[3, 4]",), ("[]",), ("null",)], "body string")
    assert sorted(r.id for r in I.ids_from_list(df, path="[]").collect()) == [3, 4]
    df = spark.createDataFrame([('[{"id": "a"}, {"id": "b"}]',)], "body string")
    assert [r.id for r in I.ids_from_list(df, path="[].id", key_type="string").collect()] == ["a", "b"]


def test_walks_run_in_several_tasks_and_call_each_page_once(spark):
    calls = spark.sparkContext.accumulator(0)

    class Counting(ScriptedTransport):
        def list_page(self, source, cursor, page_size):
            calls.add(1)
            return super().list_page(source, cursor, page_size)

    held = {f"s{i}": list(range(1, 251)) for i in range(8)}
    sources = spark.createDataFrame([(s,) for s in held], "source string")
    out = I.cursor_pages(sources, Counting({}, pages=held), page_size=100, partitions=4)
    rows = out.select("source", F.spark_partition_id().alias("task")).collect()
    assert len(rows) == 2000 and len({r.task for r in rows}) > 1 and calls.value == 24


def test_a_page_is_retried_and_takes_tokens(spark):
    class Flaky(ScriptedTransport):
        failed = False

        def list_page(self, source, cursor, page_size):
            if cursor == 2 and not self.failed:
                self.failed = True
                raise TransportError("503")
            return super().list_page(source, cursor, page_size)

    waits = []
    walk = I._walk_fn(Flaky({}, pages={"a": [1, 2, 3, 4, 5]}), 2, None, "bigint", False, 1.0, 3, FakeClock(), waits.append)
    got = [i for pdf in walk(iter([pd.DataFrame({"source": ["a"]})])) for i in pdf["id"]]
    assert got == [1, 2, 3, 4, 5] and 2 in waits and len(waits) == 4      # three waits for tokens, one backoff


class Offsets(ScriptedTransport):
    failed = False

    def offset_page(self, source, offset, limit):
        if offset == 2 and not self.failed:
            self.failed = True
            raise TransportError("503")
        return self.pages[source][offset:offset + limit]


def test_an_offset_page_is_retried_takes_tokens_and_leaves_at_once(spark):
    waits = []
    run = I._offset_fn(Offsets({}, pages={"a": [1, 2, 3, 4, 5]}), 2, "bigint", 1.0, 3, FakeClock(), waits.append)
    got = [(pdf["offset"].tolist(), pdf["id"].tolist()) for pdf in run(iter([pd.DataFrame({"source": ["a"] * 3, "offset": [0, 2, 4]})]))]
    assert got == [([0, 0], [1, 2]), ([2, 2], [3, 4]), ([4], [5])]
    assert 2 in waits and len(waits) == 4      # three waits for tokens, one backoff


def test_offset_pages_survive_a_failed_call(spark):
    held = {"a": list(range(1, 8)), "b": []}
    totals = spark.createDataFrame([(s, len(x)) for s, x in held.items()], "source string, total long")
    out = I.offset_pages(totals, Offsets({}, pages=held), page_size=2, partitions=3, sleep=lambda s: None)
    assert sorted((r.id, r.offset) for r in out.collect()) == [(i, (i - 1) // 2 * 2) for i in range(1, 8)]
    capped = I.offset_pages(totals, Offsets({}, pages=held), page_size=2, partitions=3, rate_per_sec=2.0, sleep=lambda s: None)
    assert capped.rdd.getNumPartitions() == 2 and capped.count() == 7
    with pytest.raises(Exception, match="503"):
        I.offset_pages(totals, Offsets({}, pages=held), page_size=2, max_attempts=1, sleep=lambda s: None).collect()


def test_string_keys_can_be_sharded(spark):
    keys = sorted(f"cus_{i:04d}" for i in range(0, 900, 7))
    t = ScriptedTransport({}, pages={"big": keys})
    kdf = spark.createDataFrame([("big", k) for k in keys], "source string, id string")
    shards = I.cursor_shards(kdf, 4)
    got = sorted(r.id for r in I.cursor_pages(shards, t, page_size=10, key_type="string").collect())
    assert got == keys and shards.count() > 1


def test_no_good_run_means_all_rows(spark):
    df = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id int, ts int")
    runs = spark.createDataFrame([(15, False)], "high_water int, success boolean")
    assert I.since(df, "ts", runs).count() == 3
    assert [r.id for r in I.since(df, "ts", runs.withColumn("success", F.lit(True))).collect()] == [2]


def test_failed_ids_over_appended_bronze(spark):
    bronze = spark.createDataFrame(
        [(1, 500, None, "retries_exhausted (500)", 1), (1, 200, "x", None, 2), (2, 200, None, None, 1),
         (3, 404, None, "not_found", 1), (4, 200, "x", None, 1), (4, 503, None, "retries_exhausted (503)", 2)],
        "object_id bigint, http_status int, raw_json string, error_message string, ingested_at int")
    assert sorted(r.id for r in I.failed_ids(bronze).collect()) == [2, 4]


def test_an_unconfigured_source_fails_and_slots_do_not_collide(spark):
    ids = spark.createDataFrame([("a", i) for i in range(100)] + [("b", None)], "source string, id bigint")
    config = spark.createDataFrame([("a", None, 3), ("b", None, 2)], "source string, rate_per_sec double, partitions int")
    out = I.fetch_sources(ids, config, ScriptedTransport({}), sleep=lambda s: None)
    rows = out.select("source", F.spark_partition_id().alias("task")).collect()
    assert len(rows) == 101 and len({r.task for r in rows if r.source == "a"}) == 3
    assert not {r.task for r in rows if r.source == "a"} & {r.task for r in rows if r.source == "b"}
    with pytest.raises(Exception, match="no configuration for source b"):
        I.fetch_sources(ids.fillna(5), config.where("source = 'a'"), ScriptedTransport({}), sleep=lambda s: None).collect()


def test_null_ids_of_sources_are_reported_not_requested(spark):
    big = 2 ** 53 + 1
    config = spark.createDataFrame([("a", None, 3), ("b", None, 2)], "source string, rate_per_sec double, partitions int")
    ids = spark.createDataFrame([("a", 1), ("a", None), ("b", big), ("b", None), ("b", None)], "source string, id bigint")
    out = I.fetch_sources(ids, config, ScriptedTransport({None: [500]}), sleep=lambda s: None).collect()
    assert sorted((r.source, r.object_id or 0, r.http_status or 0, r.error_message or "") for r in out) == [
        ("a", 0, 0, "null_id"), ("a", 1, 200, ""), ("b", 0, 0, "null_id"), ("b", 0, 0, "null_id"), ("b", big, 200, "")]
    text = I.fetch_sources(ids.withColumn("id", F.col("id").cast("string")), config, ScriptedTransport({}), key_type="string",
                           sleep=lambda s: None).collect()
    assert sorted(r.object_id or "" for r in text) == ["", "", "", "1", str(big)]


def test_the_query_reports_null_ids(spark, sf, monkeypatch):
    from strata.plans import registry

    real = registry.table
    monkeypatch.setattr(registry, "table", lambda s, d, name: real(s, d, name).withColumn(
        "s_suppkey", F.when(F.col("s_suppkey") != 1, F.col("s_suppkey"))) if name == "supplier" else real(s, d, name))
    out = registry.QUERIES["multi_source"](spark, sf).where("source = 'supplier'").collect()
    assert [r.error_message for r in out if r.object_id is None] == ["null_id"] and len(out) == real(spark, sf, "supplier").count()


def test_cursor_shards_cover_every_key_once(spark):
    keys = list(range(1, 1001, 3))                                 # one big source
    t = ScriptedTransport({}, pages={"big": keys})
    kdf = spark.createDataFrame([("big", k) for k in keys], "source string, id bigint")
    shards = I.cursor_shards(kdf, 5)
    assert shards.count() == 5
    got = sorted(r.id for r in I.cursor_pages(shards, t, page_size=7).collect())
    assert got == keys


def test_replayed_pages_check_the_walk(spark):
    from strata.plans.replay import page_rows, shard_page_rows
    from strata.sources.transport import ReplayPages

    keys = spark.createDataFrame([("a", i) for i in range(1, 36)] + [("b", 2 ** 53 + i) for i in range(3)], "source string, id bigint")
    got = I.cursor_pages(page_rows(keys, ["source"], 10), ReplayPages(), page_size=10, partitions=3).collect()
    want = [("a", i, (i - 1) // 10) for i in range(1, 36)] + [("b", 2 ** 53 + i, 0) for i in range(3)]
    assert sorted(map(tuple, got)) == want
    capped = I.cursor_pages(page_rows(keys, ["source"], 10), ReplayPages(), page_size=10, cap=15, partitions=1)
    assert sorted((r.source, r.id) for r in capped.collect()) == [r[:2] for r in want if r[0] == "b" or r[1] <= 15]
    shards = spark.createDataFrame([("a", None, 7), ("a", 7, 20), ("a", 20, None), ("b", None, None)],
                                   "source string, start_after bigint, stop_at bigint")
    pages = shard_page_rows(keys, shards, 4)
    assert sorted((r.source, r.id) for r in I.cursor_pages(pages, ReplayPages(), page_size=4).collect()) == [r[:2] for r in want]
    wrong = page_rows(keys, ["source"], 10).withColumn("replay_cursor", F.lit("3"))
    with pytest.raises(Exception, match="follows 3, not None"):
        I.cursor_pages(wrong, ReplayPages(), page_size=10).collect()
