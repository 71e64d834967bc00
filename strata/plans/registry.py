"""Registered queries (driver contract) and their DuckDB oracle SQL.

Every query reads the given parquet tables (or data Spark derives from them)
in full. Writes go to fresh folders under the shared checkpoint root.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import bronze as B
from strata.operators import gold as G
from strata.operators import silver as S
from strata.plans import replay as RP
from strata.session import prepare
from strata.sources import ids as I
from strata.sources.fetch import fetch_all
from strata.sources.transport import ReplayPages, ReplayTransport

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir.rstrip("/"))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return run
    return deco


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf}/{name}.parquet")


def no_sleep(_seconds: float) -> None:
    """Backoff clock for replayed APIs: retries cost no wall time."""


# ---------------------------------------------------------------- shared builders
def events_bronze(spark, sf, stamp=False) -> DataFrame:
    reqs = RP.event_requests(table(spark, sf, "events"))
    return fetch_all(reqs, ReplayTransport(), sleep=no_sleep, stamp=stamp)


def events_silver(spark, sf) -> DataFrame:
    return S.silver(events_bronze(spark, sf), RP.EVENT_FIELDS, keep=())


SQL_BRONZE = """
SELECT event_id AS object_id,
       CAST(CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 404 ELSE 200 END AS INTEGER) AS http_status,
       CASE WHEN event_type NOT IN ('error', 'signup') THEN
         CAST(json_object('id', event_id, 'event_type', event_type, 'value', value,
                          'k', CAST(json_extract_string(props, '$.k') AS INTEGER)) AS VARCHAR) END AS raw_json,
       CASE event_type WHEN 'error' THEN 'retries_exhausted (500)' WHEN 'signup' THEN 'not_found' END AS error_message
FROM events
"""

SQL_SILVER = """
SELECT event_id AS object_id, event_id AS id, event_type, value,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
FROM events WHERE event_type NOT IN ('error', 'signup')
"""


# ---------------------------------------------------------------- S5 S6 P1 P2
@register("bronze_fetch", SQL_BRONZE)
def bronze_fetch(spark, sf):
    """Rate-limited retrying fetch of every event id into the Bronze schema."""
    return events_bronze(spark, sf)


@register("silver_events", SQL_SILVER)
def silver_events(spark, sf):
    """Success filter + typed projection with one from_json."""
    return events_silver(spark, sf)


def lineitem_docs(spark, sf) -> DataFrame:
    """One JSON document per line item with a nested object and a nested array.

    Built row by row (no grouping), like an API detail record that carries
    its own nested fields."""
    li = table(spark, sf, "lineitem")
    amounts = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("value")) for k, c in AMOUNT_KINDS])
    doc = F.to_json(F.struct(F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("linenumber"),
                             F.col("l_partkey").alias("partkey"),
                             F.struct(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"))
                             .alias("ship"),
                             amounts.alias("amounts")), RP.JSON_OPTS)
    # never NULL: stated with coalesce so Catalyst drops the Bronze NOT NULL
    # filter instead of pushing it below (and building every document twice)
    return li.select(F.col("l_orderkey").alias("object_id"), F.lit(200).alias("http_status"),
                     F.coalesce(doc, F.lit("{}")).alias("raw_json"))


# Fixed order of the nested amounts array.
AMOUNT_KINDS = [("quantity", "l_quantity"), ("price", "l_extendedprice"), ("discount", "l_discount"),
                ("tax", "l_tax")]

LINE_FIELDS = S.spec(("orderkey", "bigint", "order_key"), ("linenumber", "int", "line_number"),
                     ("partkey", "bigint", "part_key"), ("ship", "json", "ship_raw_json"),
                     ("amounts", "json", "amounts_raw_json"))

SQL_AMOUNTS = ", ".join(f"{{'kind': '{k}', 'value': {c}}}" for k, c in AMOUNT_KINDS)

SQL_LINE_DOCS = f"""
SELECT l_orderkey AS object_id, l_orderkey AS order_key, l_linenumber AS line_number, l_partkey AS part_key,
       CAST(json_object('flag', l_returnflag, 'status', l_linestatus) AS VARCHAR) AS ship_raw_json,
       CAST(to_json([{SQL_AMOUNTS}]) AS VARCHAR) AS amounts_raw_json
FROM lineitem
"""


@register("silver_nested_text", SQL_LINE_DOCS)
def silver_nested_text(spark, sf):
    """Nested object and array stay compact JSON text in Silver."""
    return S.silver(lineitem_docs(spark, sf), LINE_FIELDS, keep=())


PATH_FIELDS = S.spec(("orderkey", "bigint", "order_key"), ("linenumber", "int", "line_number"),
                     ("$.ship.flag", "string", "return_flag"), ("$.ship.status", "string", "line_status"),
                     ("$.amounts[1].kind", "string", "second_kind"), ("$.amounts[1].value", "double", "price"),
                     ("$.amounts[3].value", "double", "tax"), ("$.amounts[9].value", "double", "no_such"))


@register("silver_nested_paths", """
SELECT l_orderkey AS object_id, l_orderkey AS order_key, l_linenumber AS line_number, l_returnflag AS return_flag,
       l_linestatus AS line_status, 'price' AS second_kind, l_extendedprice AS price, l_tax AS tax,
       CAST(NULL AS DOUBLE) AS no_such
FROM lineitem
""")
def silver_nested_paths(spark, sf):
    """Typed columns from places inside nested objects and arrays, one parse per document."""
    return S.silver(lineitem_docs(spark, sf), PATH_FIELDS, keep=())


AMOUNTS_DDL = "array<struct<kind:string, value:double>>"


SQL_OPEN_NESTED = "\nUNION ALL\n".join(
    f"SELECT l_orderkey AS order_key, l_linenumber AS line_number, l_partkey AS part_key, "
    f"CAST({i} AS INTEGER) AS pos, '{k}' AS kind, {c} AS value FROM lineitem"
    for i, (k, c) in enumerate(AMOUNT_KINDS))


@register("gold_open_nested", SQL_OPEN_NESTED)
def gold_open_nested(spark, sf):
    """Reopen the nested text in Gold and explode it with positions."""
    s = S.silver(lineitem_docs(spark, sf), LINE_FIELDS, keep=())
    out = G.explode_json(s.select("order_key", "line_number", "part_key", "amounts_raw_json"),
                         "amounts_raw_json", AMOUNTS_DDL, alias="amount")
    return out.select("order_key", "line_number", "part_key", "pos", "amount.kind", "amount.value")


@register("gold_count_by", """
SELECT event_type, count(*) AS n FROM events
WHERE event_type NOT IN ('error', 'signup') GROUP BY event_type
""")
def gold_count_by(spark, sf):
    """A3/O1: objects per group, most frequent first."""
    return G.count_by(events_silver(spark, sf), "event_type")


@register("ingest_quality", """
SELECT count(*) AS rows,
       count(*) FILTER (WHERE event_type NOT IN ('error', 'signup')) AS success,
       count(*) FILTER (WHERE event_type IN ('error', 'signup')) AS failure
FROM events
""")
def ingest_quality(spark, sf):
    """A1/A2: rows, success and failure in one pass."""
    return B.ingest_quality(events_bronze(spark, sf))


@register("error_profile", """
SELECT CAST(CASE event_type WHEN 'error' THEN 500 ELSE 404 END AS INTEGER) AS http_status,
       CASE event_type WHEN 'error' THEN 'retries_exhausted' ELSE 'not_found' END AS error_class,
       count(*) AS n
FROM events WHERE event_type IN ('error', 'signup') GROUP BY 1, 2
""")
def error_profile(spark, sf):
    """Failures by status and error class."""
    return B.error_profile(B.failed_rows(events_bronze(spark, sf)))


@register("silver_quality", """
SELECT 'text' AS column_name,
       count(*) FILTER (WHERE text IS NULL) AS null_count,
       count(*) FILTER (WHERE text IS NOT NULL AND (CASE WHEN regexp_full_match(trim(text), '[+-]?[0-9]+')
                         THEN TRY_CAST(trim(text) AS INTEGER) END) IS NULL) AS cast_failures,
       count(*) AS row_count
FROM documents
""")
def silver_quality(spark, sf):
    """Cast failures and NULLs when a drifting text field is typed as INT."""
    return S.cast_profile(table(spark, sf, "documents").select("text"), {"text": "int"})


# ---------------------------------------------------------------- S7 S9 J2 S4 S1
@register("failed_ids", "SELECT event_id AS id FROM events WHERE event_type = 'error'")
def failed_ids(spark, sf):
    """Failed (non-404) ids become the next run's input."""
    return I.failed_ids(events_bronze(spark, sf))


# Bronze of an earlier run = the events that existed before this instant.
EARLIER_RUN_CUTOFF = "2024-01-16 00:00:00"


@register("new_ids", f"""
SELECT e.event_id AS id FROM events e
WHERE NOT EXISTS (SELECT 1 FROM events b WHERE b.ts < TIMESTAMP '{EARLIER_RUN_CUTOFF}' AND b.event_id = e.event_id)
""")
def new_ids(spark, sf):
    """Only ids not yet in Bronze (left anti join)."""
    ev = table(spark, sf, "events")
    earlier = fetch_all(RP.event_requests(ev.where(F.col("ts") < F.lit(EARLIER_RUN_CUTOFF).cast("timestamp_ntz"))),
                        ReplayTransport(), sleep=no_sleep)
    return I.new_ids(ev.select(F.col("event_id").alias("id")), earlier)


@register("cap_ids", "SELECT o_orderkey AS id FROM orders ORDER BY o_orderkey LIMIT 500")
def cap_ids(spark, sf):
    """Id cap as an ordered top-k (repeatable)."""
    return I.cap_ids(table(spark, sf, "orders").select(F.col("o_orderkey").alias("id")), 500)


@register("first_rows", """
SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity FROM lineitem
ORDER BY l_shipdate, l_orderkey, l_linenumber LIMIT 4000
""")
def first_rows(spark, sf):
    """The first n rows of an order by the key at which they end; no task takes them all."""
    from strata.operators.selection import first_n

    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity")
    return first_n(rows, 4000, ["l_shipdate", "l_orderkey", "l_linenumber"], top_k=500)


@register("list_explode", "SELECT page_id AS id FROM pages")
def list_explode(spark, sf):
    """Ids out of one-shot list responses (pages chunked into list bodies of 100 ids),
    plus responses whose id array is missing or null."""
    pages = table(spark, sf, "pages")
    chunk = F.floor(F.col("page_id") / 100)
    bodies = pages.groupBy(chunk.alias("chunk")).agg(F.to_json(F.struct(
        F.count(F.lit(1)).alias("total"), F.array_sort(F.collect_list("page_id")).alias("objectIDs"))).alias("body"))
    edge = spark.createDataFrame([(-1, '{"total": 0}'), (-2, '{"total": 0, "objectIDs": null}')], "chunk long, body string")
    return I.ids_from_list(bodies.unionByName(edge), "body", "objectIDs")


# ---------------------------------------------------------------- helpers for writing queries
def fresh_db(spark: SparkSession, prefix: str = "strata") -> str:
    """A schema of its own under the shared checkpoint root, so two runs never meet."""
    from strata.operators.tables import ensure_schema
    from strata.session import fresh_schema, scratch_dir

    name = fresh_schema(prefix)
    ensure_schema(spark, name, scratch_dir(spark, name))
    return name


# ---------------------------------------------------------------- S2 S3 S11 S8
def customer_keys(spark, sf) -> DataFrame:
    """The list API's remote side: customer keys per market segment."""
    return table(spark, sf, "customer").select(F.col("c_mktsegment").alias("source"), F.col("c_custkey").alias("id"))


@register("cursor_pages", """
SELECT c_mktsegment AS source, c_custkey AS id,
       CAST((row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) - 1) // 100 AS INTEGER) AS page
FROM customer
""")
def cursor_pages(spark, sf):
    """One cursor chain per source (market segment), pages of 100, run in parallel."""
    return I.cursor_pages(RP.page_rows(customer_keys(spark, sf), ["source"], 100), ReplayPages(), page_size=100)


CURSOR_SHARDS = 4


@register("cursor_pages_sharded", "SELECT c_mktsegment AS source, c_custkey AS id FROM customer")
def cursor_pages_sharded(spark, sf):
    """S2 for skewed sources: each source split into key-range shards, every shard its own chain."""
    keys = customer_keys(spark, sf)
    pages = RP.shard_page_rows(keys, I.cursor_shards(keys, CURSOR_SHARDS), 100)
    return I.cursor_pages(pages, ReplayPages(), page_size=100).select("source", "id")


@register("link_pages", """
SELECT c_mktsegment AS source, c_custkey AS id,
       CAST((row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) - 1) // 100 AS INTEGER) AS page
FROM customer
""")
def link_pages(spark, sf):
    """S3 (Link form): every response names the next page; chains per source in parallel."""
    return I.link_pages(RP.page_rows(customer_keys(spark, sf), ["source"], 100), ReplayPages(), page_size=100)


@register("offset_pages", """
SELECT c_mktsegment AS source, c_custkey AS id,
       CAST((row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) - 1) // 100 * 100 AS BIGINT) AS "offset"
FROM customer
""")
def offset_pages(spark, sf):
    """S3: offsets known from the total up front; every page fetched in parallel."""
    keys = customer_keys(spark, sf)
    totals = keys.groupBy("source").agg(F.count(F.lit(1)).alias("total"))
    return I.offset_pages(totals, ReplayPages(), page_size=100, carried=RP.page_rows(keys, ["source"], 100))


@register("multi_source", """
SELECT 'customer' AS source, c_custkey AS object_id, 200 AS http_status,
       CAST(json_object('id', c_custkey, 'c_name', c_name, 'c_acctbal', c_acctbal) AS VARCHAR) AS raw_json,
       CAST(NULL AS VARCHAR) AS error_message
FROM customer
UNION ALL
SELECT 'supplier', s_suppkey, 200,
       CAST(json_object('id', s_suppkey, 's_name', s_name, 's_acctbal', s_acctbal) AS VARCHAR), NULL
FROM supplier
""")
def multi_source(spark, sf):
    """Two APIs in one job, each with its own parallelism and bucket."""
    ids = I.union_sources(
        RP.record_requests(table(spark, sf, "customer"), "c_custkey", "customer", ["c_name", "c_acctbal"]),
        RP.record_requests(table(spark, sf, "supplier"), "s_suppkey", "supplier", ["s_name", "s_acctbal"]))
    config = spark.createDataFrame([("customer", None, 10), ("supplier", None, 8)],
                                   "source string, rate_per_sec double, partitions int")
    return I.fetch_sources(ids, config, ReplayTransport(), sleep=no_sleep)


GOOD_RUNS_BEFORE = "2024-01-20 00:00:00"


@register("since_high_water", f"""
SELECT event_id, user_id, event_type FROM events
WHERE ts >= (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '{GOOD_RUNS_BEFORE}')
""")
def since_high_water(spark, sf):
    """Rows at or after the high-water mark of the last successful run.

    Runs are one per day of events; days before the cutoff succeeded."""
    ev = table(spark, sf, "events")
    runs = ev.groupBy(F.to_date("ts").alias("day")).agg(F.max("ts").alias("high_water")).withColumn(
        "success", F.col("day") < F.lit(GOOD_RUNS_BEFORE[:10]).cast("date"))
    return I.since(ev, "ts", runs).select("event_id", "user_id", "event_type")


# ---------------------------------------------------------------- S12-S15 J1 A5
ORDERS_CSV_SCHEMA = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                     "o_orderdate timestamp_ntz, o_orderpriority string")
CSV_FILES = 4
MAX_FILES = 2
MD5_BUCKET_SQL = "CAST(('0x' || substr(md5(CAST({k} AS VARCHAR)), 1, 8)) AS BIGINT) % {n}"


def orders_csv_drop(spark, sf) -> str:
    """``orders`` written as 4 CSV files (one per md5 bucket of the key) into a fresh folder."""
    from strata.functions.scalar import md5_bucket
    from strata.session import scratch_dir

    path = scratch_dir(spark, "csvdrop")
    o = table(spark, sf, "orders").withColumn("bucket", md5_bucket("o_orderkey", CSV_FILES))
    o.repartition(CSV_FILES, "bucket").write.partitionBy("bucket").option("header", "true").csv(path)
    return path


def ingest_csv(spark, sf, max_files):
    from strata.sources import files as FL

    path = orders_csv_drop(spark, sf)
    return FL.with_provenance(FL.read_files(spark, path, "bucket=*/*.csv", "csv", schema=ORDERS_CSV_SCHEMA,
                                            max_files=max_files))


@register("files_capped", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
WHERE {MD5_BUCKET_SQL.format(k='o_orderkey', n=CSV_FILES)} < {MAX_FILES}
""")
def files_capped(spark, sf):
    """CSV scan with options and schema, provenance, first N files by path."""
    return ingest_csv(spark, sf, MAX_FILES).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                                   "o_orderpriority")


def ingest_drop(spark, sf, fmt: str, schema=None):
    """orders dropped as files of a format, one folder per priority, ingested into a table and read by its name."""
    from strata.plans.pipelines import run_file_ingest
    from strata.session import scratch_dir

    path, name = scratch_dir(spark, "drop"), f"{fresh_db(spark)}.orders"
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    o.withColumn("p", F.substring("o_orderpriority", 1, 1)).repartition(4, "p").write.partitionBy("p").format(fmt).save(path)
    rec = run_file_ingest(spark, f"{path}/", name, pattern=f"p=*/*.{fmt}", fmt=fmt, schema=schema)
    return spark.table(name).withColumn("n_ingested", F.lit(rec["rows"]).cast("bigint"))


SQL_DROP = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, (SELECT count(*) FROM orders) AS n_ingested,
       substr(o_orderpriority, 1, 1) AS folder FROM orders
"""
DROP_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "n_ingested"]


@register("files_parquet", SQL_DROP)
def files_parquet(spark, sf):
    """Parquet files with the schema they hold, provenance, into a table."""
    folder = F.regexp_extract("source_file", r"p=([^/]+)/", 1).alias("folder")
    return ingest_drop(spark, sf, "parquet").select(*DROP_COLUMNS, folder)


@register("files_json", SQL_DROP)
def files_json(spark, sf):
    """JSON files with an inferred schema."""
    folder = F.regexp_extract("source_file", r"p=([^/]+)/", 1).alias("folder")
    return ingest_drop(spark, sf, "json").select(*DROP_COLUMNS, folder)


@register("qualified_names", """
SELECT n_nationkey AS key, r_name || '.' || n_name AS name, CAST(NULL AS VARCHAR) AS catalog_name, r_name AS schema_name,
       n_name AS table_name, '/lake/' || r_name || '/' || n_name || '/part.parquet' AS path
FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL
SELECT n_nationkey, 'main.' || r_name || '.' || n_name, 'main', r_name, n_name, '/lake/' || r_name || '/' || n_name || '/part.parquet'
FROM nation JOIN region ON n_regionkey = r_regionkey
""")
def qualified_names(spark, sf):
    """Functions: parts of qualified names, and paths put together from parts with stray slashes."""
    from strata.functions import join_path, name_part

    r = table(spark, sf, "region")
    n = table(spark, sf, "nation").join(r, F.col("n_regionkey") == r["r_regionkey"])
    two = F.concat_ws(".", "r_name", "n_name")
    named = n.select("n_nationkey", "r_name", "n_name", F.explode(F.array(two, F.concat(F.lit("main."), two))).alias("name"))
    path = join_path(F.lit("/lake//"), F.concat(F.lit("/"), "r_name"), F.concat("n_name", F.lit("/")), F.lit("/part.parquet"))
    return named.select(F.col("n_nationkey").alias("key"), "name",
                        *[name_part("name", p).alias(f"{p}_name") for p in ("catalog", "schema", "table")], path.alias("path"))


@register("file_counts", f"""
SELECT CAST({MD5_BUCKET_SQL.format(k='o_orderkey', n=CSV_FILES)} AS INTEGER) AS file_bucket, count(*) AS n_rows
FROM orders GROUP BY 1
""")
def file_counts(spark, sf):
    """A5: rows per ingested file (file named by its bucket folder)."""
    from strata.sources import files as FL

    counts = FL.file_counts(ingest_csv(spark, sf, None))
    return counts.select(F.regexp_extract("source_file", r"bucket=([0-9]+)", 1).cast("int").alias("file_bucket"),
                         "n_rows")


@register("passthrough", "SELECT *, o_orderdate AS silver_ingested_at FROM orders")
def passthrough(spark, sf):
    """P5: Silver pass-through with an aliased copy."""
    return S.passthrough(table(spark, sf, "orders"), {"o_orderdate": "silver_ingested_at"})


# ---------------------------------------------------------------- W4 O3
UPSERT_SPLIT = "2024-01-16 00:00:00"


@register("upsert_latest", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events) WHERE rn = 1
""")
def upsert_latest(spark, sf):
    """Two batches (before/after a cut) upserted on user_id, newest ts wins."""
    from strata.operators.tables import upsert

    ev = table(spark, sf, "events")
    cut = F.lit(UPSERT_SPLIT).cast("timestamp_ntz")
    tbl = f"{fresh_db(spark)}.events_latest"
    upsert(spark, ev.where(F.col("ts") < cut), tbl, ["user_id"], ["ts"])
    upsert(spark, ev.where(F.col("ts") >= cut), tbl, ["user_id"], ["ts"])
    return spark.table(tbl)


# ---------------------------------------------------------------- T1-T8
CUST_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
NEW_KEY_OFFSET = 1000000000


def altered_customer(spark, sf) -> DataFrame:
    """Desired state: MACHINERY customers absent, BUILDING balances changed, nation 3 copied under new keys."""
    c = table(spark, sf, "customer").select(*CUST_COLS)
    kept = c.where(F.col("c_mktsegment") != "MACHINERY").withColumn(
        "c_acctbal", F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") + 100.0)
        .otherwise(F.col("c_acctbal")))
    new = c.where(F.col("c_nationkey") == 3).select(
        (F.col("c_custkey") + NEW_KEY_OFFSET).alias("c_custkey"), F.concat("c_name", F.lit(" (new)")).alias("c_name"),
        "c_nationkey", "c_acctbal", "c_mktsegment")
    return kept.unionByName(new)


SQL_DESIRED = f"""
desired AS (
  SELECT c_custkey, c_name, c_nationkey,
         CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 100.0 ELSE c_acctbal END AS c_acctbal, c_mktsegment
  FROM customer WHERE c_mktsegment <> 'MACHINERY'
  UNION ALL
  SELECT c_custkey + {NEW_KEY_OFFSET}, c_name || ' (new)', c_nationkey, c_acctbal, c_mktsegment
  FROM customer WHERE c_nationkey = 3)
"""


@register("reconcile_full", f"""
WITH {SQL_DESIRED}
SELECT coalesce(d.c_custkey, c.c_custkey) AS c_custkey,
       CASE WHEN d.c_custkey IS NULL THEN c.c_name ELSE d.c_name END AS c_name,
       CASE WHEN d.c_custkey IS NULL THEN c.c_nationkey ELSE d.c_nationkey END AS c_nationkey,
       CASE WHEN d.c_custkey IS NULL THEN c.c_acctbal ELSE d.c_acctbal END AS c_acctbal,
       CASE WHEN d.c_custkey IS NULL THEN c.c_mktsegment ELSE d.c_mktsegment END AS c_mktsegment,
       CASE WHEN d.c_custkey IS NULL THEN 'keep' WHEN c.c_custkey IS NOT NULL THEN 'replace' ELSE 'create' END
         AS action
FROM desired d FULL JOIN customer c ON d.c_custkey = c.c_custkey
""")
def reconcile_full(spark, sf):
    """Full-replace reconcile of desired vs current records."""
    from strata.operators.state import reconcile

    cur = table(spark, sf, "customer").select(*CUST_COLS)
    return reconcile(cur, altered_customer(spark, sf), "c_custkey")


@register("reconcile_patch", """
WITH ch AS (
  SELECT c_custkey, upper(c_name) AS c_name, CAST(NULL AS DOUBLE) AS c_acctbal, CAST(NULL AS VARCHAR) AS c_mktsegment
  FROM customer WHERE c_mktsegment = 'BUILDING'
  UNION ALL
  SELECT c_custkey, NULL, NULL, '' FROM customer WHERE c_nationkey = 2 AND c_mktsegment <> 'BUILDING')
SELECT c.c_custkey, coalesce(ch.c_name, c.c_name) AS c_name, c.c_nationkey,
       coalesce(ch.c_acctbal, c.c_acctbal) AS c_acctbal, coalesce(ch.c_mktsegment, c.c_mktsegment) AS c_mktsegment,
       concat_ws(',', CASE WHEN ch.c_name IS NOT NULL THEN 'c_name' END,
                      CASE WHEN ch.c_acctbal IS NOT NULL THEN 'c_acctbal' END,
                      CASE WHEN ch.c_mktsegment IS NOT NULL THEN 'c_mktsegment' END) AS update_mask
FROM customer c LEFT JOIN ch ON c.c_custkey = ch.c_custkey
""")
def reconcile_patch(spark, sf):
    """Patch — only supplied fields overwrite; an empty string counts as supplied."""
    from strata.operators.state import patch

    c = table(spark, sf, "customer").select(*CUST_COLS)
    ch = c.where(F.col("c_mktsegment") == "BUILDING").select(
        "c_custkey", F.upper("c_name").alias("c_name"), F.lit(None).cast("double").alias("c_acctbal"),
        F.lit(None).cast("string").alias("c_mktsegment")).unionByName(
        c.where((F.col("c_nationkey") == 2) & (F.col("c_mktsegment") != "BUILDING")).select(
            "c_custkey", F.lit(None).cast("string").alias("c_name"), F.lit(None).cast("double").alias("c_acctbal"),
            F.lit("").alias("c_mktsegment")))
    return patch(c, ch, "c_custkey", ["c_name", "c_acctbal", "c_mktsegment"])


def sql_row_hash(cols, alias=""):
    text = [f"CAST({alias}{c} AS VARCHAR)" for c in cols]
    return "sha256(" + " || ".join(f"CASE WHEN {t} IS NULL THEN '-' ELSE length({t}) || ':' || {t} END" for t in text) + ")"


@register("row_hash", f"SELECT *, {sql_row_hash(CUST_COLS)} AS row_hash FROM customer")
def row_hash(spark, sf):
    """NULL-safe SHA-256 over ordered columns."""
    from strata.operators.state import with_row_hash

    return with_row_hash(table(spark, sf, "customer"), CUST_COLS)


@register("changed_rows", f"""
WITH {SQL_DESIRED}
SELECT d.*, CASE WHEN c.c_custkey IS NULL THEN 'new' ELSE 'changed' END AS change,
       {sql_row_hash(CUST_COLS, 'd.')} AS row_hash
FROM desired d LEFT JOIN customer c ON d.c_custkey = c.c_custkey
WHERE c.c_custkey IS NULL OR {sql_row_hash(CUST_COLS, 'd.')} <> {sql_row_hash(CUST_COLS, 'c.')}
""")
def changed_rows(spark, sf):
    """Desired rows that are new or differ by hash."""
    from strata.operators.state import changed

    cur = table(spark, sf, "customer").select(*CUST_COLS)
    return changed(cur, altered_customer(spark, sf), "c_custkey", CUST_COLS)


FIXTURE_TERMINAL = ("purchase", "error")  # events stand in for run observations


@register("run_status", """
WITH l AS (SELECT user_id, event_type AS state, ts,
                  row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type DESC) AS rn FROM events),
     a AS (SELECT user_id, min(ts) AS first_seen, count(*) AS n_obs FROM events GROUP BY user_id)
SELECT l.user_id, state, first_seen, ts AS last_seen, n_obs, state IN ('purchase', 'error') AS is_terminal,
       CASE WHEN state IN ('purchase', 'error') THEN (epoch_us(ts) - epoch_us(first_seen)) // 1000 END AS duration_ms
FROM l JOIN a ON l.user_id = a.user_id WHERE rn = 1
""")
def run_status(spark, sf):
    """T4: latest state per run, terminal flag, duration (user_id = run, event_type = state)."""
    from strata.operators.state import run_status as rs

    return rs(table(spark, sf, "events"), "user_id", "event_type", "ts", FIXTURE_TERMINAL)


@register("dedupe_token", """
SELECT event_id, user_id, event_type, token FROM (
  SELECT *, CASE WHEN event_type = 'view' THEN NULL ELSE user_id END AS token FROM events) e
QUALIFY token IS NULL OR row_number() OVER (PARTITION BY token ORDER BY ts) = 1
""")
def dedupe_token(spark, sf):
    """T5: one row per idempotency token (the first); NULL tokens always kept."""
    from strata.operators.tables import dedupe_token as dt

    ev = table(spark, sf, "events").withColumn(
        "token", F.when(F.col("event_type") == "view", F.lit(None)).otherwise(F.col("user_id")))
    return dt(ev, "token", ["ts"]).select("event_id", "user_id", "event_type", "token")


def alias_inputs(spark, sf):
    ev = table(spark, sf, "events")
    log = ev.select(F.col("event_type").alias("full_name"),
                    F.when(F.col("value") >= 100, F.lit("champion")).otherwise(F.lit("challenger")).alias("alias"),
                    F.col("user_id").alias("version"), F.col("ts").alias("assigned_at"))
    versions = ev.select(F.col("event_type").alias("full_name"), F.col("user_id").alias("version")).distinct() \
        .withColumn("source", F.concat(F.lit("models/"), "full_name", F.lit("/v"), F.col("version").cast("string")))
    return log, versions


@register("resolve_alias", """
WITH l AS (SELECT event_type AS full_name, CASE WHEN value >= 100 THEN 'champion' ELSE 'challenger' END AS alias,
                  user_id AS version, ts FROM events)
SELECT full_name, alias, version, 'models/' || full_name || '/v' || CAST(version AS VARCHAR) AS source
FROM l QUALIFY row_number() OVER (PARTITION BY full_name, alias ORDER BY ts DESC) = 1
""")
def resolve_alias(spark, sf):
    """An alias points to the version assigned to it last."""
    from strata.operators.state import resolve_alias as ra

    log, versions = alias_inputs(spark, sf)
    return ra(log, versions)


@register("apply_tags", """
SELECT user_id AS run_id, event_type AS key, CAST(value AS VARCHAR) AS value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) = 1
""")
def apply_tags(spark, sf):
    """Last tag write wins per (run, key)."""
    from strata.operators.state import apply_tags as at

    log = table(spark, sf, "events").select(F.col("user_id").alias("run_id"), F.col("event_type").alias("key"),
                                            F.col("value").cast("string").alias("value"), F.col("ts").alias("set_at"))
    return at(log)


SEARCH_MAX_RESULTS = 100


@register("search_runs", f"""
SELECT event_id AS run_id, CAST(user_id AS VARCHAR) AS user_tag, 'active' AS lifecycle_stage FROM events
WHERE event_type = 'click' ORDER BY ts DESC, event_id LIMIT {SEARCH_MAX_RESULTS}
""")
def search_runs(spark, sf):
    """Run search by tag and view type, newest first, max_results."""
    from strata.operators.state import search_runs as sr

    ev = table(spark, sf, "events")
    runs = ev.select(F.col("event_id").alias("run_id"), F.col("ts").alias("start_time"),
                     F.create_map(F.lit("type"), F.col("event_type"), F.lit("user"),
                                  F.col("user_id").cast("string")).alias("tags"),
                     F.when(F.col("event_type") == "error", F.lit("deleted")).otherwise(F.lit("active"))
                     .alias("lifecycle_stage"))
    out = sr(runs, {"type": "click"}, "ACTIVE_ONLY", SEARCH_MAX_RESULTS)
    return out.select("run_id", F.col("tags")["user"].alias("user_tag"), "lifecycle_stage")


# ---------------------------------------------------------------- P8
@register("gate_metrics", """
SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(avg(l_discount), 6) AS avg_disc,
       round(avg(l_discount), 6) > 0.05 AS passed
FROM lineitem GROUP BY 1, 2
""")
def gate_metrics(spark, sf):
    """Comparison gate (GREATER_THAN) over aggregated metrics."""
    from strata.operators.gate import gate

    m = table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"), F.round(F.avg("l_discount"), 6).alias("avg_disc"))
    return gate(m, "avg_disc", "GREATER_THAN", "0.05")


# ---------------------------------------------------------------- Q1 J3 J4 A8 O4 O6 (user SQL)
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def register_views(spark: SparkSession, sf: str, names=TABLES) -> None:
    """The given tables as temp views, so user SQL runs unchanged."""
    for t in names:
        table(spark, sf, t).createOrReplaceTempView(t)


def same_sql(name: str, sql: str, doc: str):
    """A query whose Spark SQL and DuckDB SQL are the same text."""
    import re

    used = [t for t in TABLES if re.search(rf"\b{t}\b", sql)]   # views the statement names

    def fn(spark, sf):
        from strata.plans.sql import run_sql

        register_views(spark, sf, used)
        return run_sql(spark, sql)
    fn.__doc__ = doc
    register(name, sql)(fn)


same_sql("sql_joins", """
SELECT r.r_name, n.n_name, count(o.o_orderkey) AS n_orders, round(sum(o.o_totalprice), 2) AS revenue
FROM region r
JOIN nation n ON n.n_regionkey = r.r_regionkey
LEFT JOIN customer c ON c.c_nationkey = n.n_nationkey
LEFT JOIN orders o ON o.o_custkey = c.c_custkey
GROUP BY r.r_name, n.n_name
""", "J3: inner + left joins through user SQL")

same_sql("sql_outer_joins", """
SELECT coalesce(cs.nk, ss.nk) AS nationkey, cs.n_cust, ss.n_supp, p.n_parts
FROM (SELECT c_nationkey AS nk, count(*) AS n_cust FROM customer GROUP BY c_nationkey) cs
FULL OUTER JOIN (SELECT s_nationkey AS nk, count(*) AS n_supp FROM supplier GROUP BY s_nationkey) ss
  ON cs.nk = ss.nk
RIGHT JOIN (SELECT n_nationkey AS nk, count(*) AS n_parts FROM nation GROUP BY n_nationkey) p
  ON p.nk = coalesce(cs.nk, ss.nk)
""", "J3: full and right outer joins")

same_sql("sql_semi_anti", """
SELECT 'semi' AS kind, count(*) AS n FROM customer c
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)
UNION ALL
SELECT 'anti', count(*) FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)
UNION ALL
SELECT 'in', count(*) FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)
""", "J3: semi / anti / IN-subquery joins")

same_sql("sql_grouping_sets", """
SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS qty
FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())
""", "A8: grouping sets")

same_sql("sql_rollup", """
SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS qty
FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)
""", "A8: rollup")

same_sql("sql_cube", """
SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)
""", "A8: cube")

same_sql("sql_distinct_aggs", """
SELECT o_orderpriority, count(DISTINCT o_custkey) AS n_cust, count(DISTINCT o_orderstatus) AS n_status,
       count(*) AS n
FROM orders GROUP BY o_orderpriority
""", "A8: distinct aggregates")

same_sql("sql_windows", """
SELECT o_orderkey, o_custkey,
       CAST(rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS BIGINT) AS price_rank,
       CAST(dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus) AS BIGINT) AS status_rank,
       lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev_order,
       lead(o_orderkey, 2) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS next2_order
FROM orders
""", "O4: ranking and offset window functions")

same_sql("sql_frames", """
SELECT o_orderkey,
       round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                                     ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS moving_total,
       count(*) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_n,
       max(o_totalprice) OVER (PARTITION BY o_custkey) AS cust_max
FROM orders
""", "O4: row frames")

same_sql("sql_set_ops", """
SELECT 'intersect' AS op, count(*) AS n FROM (SELECT c_custkey FROM customer INTERSECT SELECT o_custkey FROM orders) a
UNION ALL
SELECT 'except', count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders) b
UNION ALL
SELECT 'union', count(*) FROM (SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier) c
UNION ALL
SELECT 'union_all', count(*) FROM (SELECT c_nationkey FROM customer UNION ALL SELECT s_nationkey FROM supplier) d
""", "O6: intersect, except, union")

BAND_SECONDS = 300
BAND_MICROS = 90_500_000     # a fractional number of seconds


@register("sql_range_join", f"""
SELECT a.event_id, count(*) AS n_purchases
FROM events a JOIN events b
  ON b.ts BETWEEN a.ts AND a.ts + INTERVAL {BAND_SECONDS} SECOND
WHERE a.event_type = 'signup' AND b.event_type = 'purchase'
GROUP BY a.event_id
""")
def sql_range_join(spark, sf):
    """Matches in an interval per row, counted from running sums (no pair is made)."""
    from strata.operators.joins import band_count

    ev = table(spark, sf, "events")
    a = ev.where(F.col("event_type") == "signup").select("event_id", F.col("ts").alias("a_ts"))
    b = ev.where(F.col("event_type") == "purchase").select(F.col("event_id").alias("b_id"), F.col("ts").alias("b_ts"))
    counts = band_count(a, b, "event_id", "a_ts", "b_ts", 0, BAND_SECONDS)
    return counts.where("n > 0").select("event_id", F.col("n").alias("n_purchases"))


@register("sql_band_join", f"""
SELECT a.event_id, b.event_id AS b_id, CAST(epoch_us(b.ts) - epoch_us(a.ts) AS BIGINT) AS lag_us
FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts >= a.ts
  AND b.ts <= a.ts + INTERVAL {BAND_MICROS} MICROSECOND
WHERE a.event_type = 'signup' AND b.event_type = 'purchase'
""")
def sql_band_join(spark, sf):
    """The rows of a range join with a fractional bound and a key, planned as a bin equi-join."""
    from strata.operators.joins import band_join

    ev = table(spark, sf, "events")
    a = ev.where(F.col("event_type") == "signup").select("user_id", "event_id", F.col("ts").alias("a_ts"))
    b = ev.where(F.col("event_type") == "purchase").select("user_id", F.col("event_id").alias("b_id"), F.col("ts").alias("b_ts"))
    j = band_join(a, b, "a_ts", "b_ts", 0, BAND_MICROS / 1_000_000, on=["user_id"])
    return j.select("event_id", "b_id", (F.unix_micros(F.col("b_ts").cast("timestamp")) - F.unix_micros(
        F.col("a_ts").cast("timestamp"))).alias("lag_us"))


@register("sql_scalars", """
SELECT event_id,
       'https://api.example/objects/' || CAST(event_id AS VARCHAR) || '?v=1' AS url,
       regexp_replace(regexp_replace('/data/' || event_type || '/v1.json', '^/+', ''), '[/.]', ':', 'g') AS safe_name,
       substring(props, 1, 5) AS preview,
       sha256(event_type) AS type_sha,
       md5(CAST(user_id AS VARCHAR)) AS user_md5,
       make_timestamp(CAST(1700000000000 + event_id AS BIGINT) * 1000) AS from_millis,
       make_timestamp(CAST(1700000000 + event_id AS BIGINT) * 1000000) AS from_seconds,
       upper(event_type) AS type_upper,
       CAST(length(props) AS INTEGER) AS props_len,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
FROM events
""")
def sql_scalars(spark, sf):
    """§2.7 scalar functions: URL template, safe name, preview, SHA-256, md5, epoch ms/s, JSON path."""
    from strata.functions import scalar as X

    ev = table(spark, sf, "events")
    return ev.select(
        "event_id",
        X.url_for("https://api.example/objects/{id}?v=1", "event_id").alias("url"),
        X.safe_name(F.concat(F.lit("/data/"), F.col("event_type"), F.lit("/v1.json"))).alias("safe_name"),
        X.preview("props", 5).alias("preview"),
        F.sha2("event_type", 256).alias("type_sha"),
        F.md5(F.col("user_id").cast("string")).alias("user_md5"),
        X.epoch_millis_to_ts(F.lit(1700000000000) + F.col("event_id")).cast("timestamp_ntz").alias("from_millis"),
        X.epoch_seconds_to_ts(F.lit(1700000000) + F.col("event_id")).cast("timestamp_ntz").alias("from_seconds"),
        F.upper("event_type").alias("type_upper"),
        F.length("props").alias("props_len"),
        F.get_json_object("props", "$.k").cast("int").alias("k"))


# ---------------------------------------------------------------- Q4
NATION_STATEMENT = """
SELECT count(o_orderkey) AS n_orders, round(sum(o_totalprice), 2) AS revenue
FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_nationkey = :n_nationkey GROUP BY c_nationkey
"""


@register("for_each_params", """
SELECT n.n_nationkey, n.n_name, count(o.o_orderkey) AS n_orders, round(sum(o.o_totalprice), 2) AS revenue
FROM nation n JOIN customer c ON c.c_nationkey = n.n_nationkey JOIN orders o ON o.o_custkey = c.c_custkey
GROUP BY n.n_nationkey, n.n_name
""")
def for_each_params(spark, sf):
    """Q4: a per-nation task run once over all nations as a join (not N jobs)."""
    from strata.plans.sql import for_each

    register_views(spark, sf, ["customer", "orders"])
    return for_each(spark, table(spark, sf, "nation").select("n_nationkey", "n_name"), NATION_STATEMENT)


# ---------------------------------------------------------------- Q5
def order_models():
    from strata.plans.models import Model

    return [
        Model("stg_orders", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders", ("staging",)),
        Model("stg_customers", "SELECT c_custkey, c_name, c_mktsegment FROM customer", ("staging",)),
        Model("customer_orders", """
            SELECT c.c_custkey, c.c_mktsegment, count(o.o_orderkey) AS n_orders,
                   round(sum(o.o_totalprice), 2) AS total
            FROM {{ ref('stg_customers') }} c LEFT JOIN {{ ref('stg_orders') }} o ON o.o_custkey = c.c_custkey
            GROUP BY c.c_custkey, c.c_mktsegment""", ("marts",)),
    ]


def order_model_tests(db):
    from strata.plans.models import Test

    return [
        Test("not_null", f"{db}.customer_orders", "c_custkey"),
        Test("unique", f"{db}.customer_orders", "c_custkey"),
        Test("unique", f"{db}.stg_orders", "o_custkey"),
        Test("accepted_values", f"{db}.stg_orders", "o_orderstatus", ("F", "O", "P")),
        Test("accepted_values", f"{db}.stg_customers", "c_mktsegment", ("AUTOMOBILE", "BUILDING", "FURNITURE")),
        Test("relationships", f"{db}.stg_orders", "o_custkey", to_table=f"{db}.stg_customers", to_column="c_custkey"),
    ]


def built_models(spark, sf):
    from strata.plans.models import run_models

    register_views(spark, sf, ["orders", "customer"])
    db = fresh_db(spark)
    run_models(spark, order_models(), db, select="tag:staging")
    run_models(spark, order_models(), db, select="stg_orders+")
    return db


@register("model_set", """
SELECT c.c_custkey, c.c_mktsegment, count(o.o_orderkey) AS n_orders, round(sum(o.o_totalprice), 2) AS total
FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY c.c_custkey, c.c_mktsegment
""")
def model_set(spark, sf):
    """Q5: SQL models built in dependency order with tag and downstream selection."""
    return spark.table(f"{built_models(spark, sf)}.customer_orders")


@register("model_tests", """
SELECT 'not_null_customer_orders_c_custkey' AS test_name, CAST(0 AS BIGINT) AS failures, true AS passed
UNION ALL
SELECT 'unique_customer_orders_c_custkey', count(*), count(*) = 0 FROM
  (SELECT c_custkey FROM customer GROUP BY c_custkey HAVING count(*) > 1) u
UNION ALL
SELECT 'unique_stg_orders_o_custkey', count(*), count(*) = 0 FROM
  (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey HAVING count(*) > 1) u2
UNION ALL
SELECT 'accepted_values_stg_orders_o_orderstatus', count(*), count(*) = 0 FROM orders
  WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O', 'P')
UNION ALL
SELECT 'accepted_values_stg_customers_c_mktsegment', count(*), count(*) = 0 FROM customer
  WHERE c_mktsegment IS NOT NULL AND c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE')
UNION ALL
SELECT 'relationships_stg_orders_o_custkey', count(*), count(*) = 0 FROM orders
  WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer)
""")
def model_tests(spark, sf):
    """Q5: data tests (not_null, unique, accepted_values, relationships) as counting queries."""
    from strata.plans.models import test_models

    return test_models(spark, order_model_tests(built_models(spark, sf)))


# ---------------------------------------------------------------- R1
def declared_orders(orders: str):
    """Two declared tables over a table of orders: a keyed daily rollup and a status mix.

    An order goes into the day of its date; it may arrive late, for any day, so an
    incremental refresh builds the days anew that orders of new commits touch.
    """
    from strata.plans.refresh import Declared

    def daily(spark, names):
        return spark.table(names[orders]).groupBy(F.to_date("o_orderdate").alias("day")).agg(
            F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("revenue"))

    def status_mix(spark, names):
        d = spark.table(names["order_daily"])
        return d.agg(F.count(F.lit(1)).alias("days"), F.sum("n_orders").alias("n_orders"))

    return [Declared("order_daily", daily, inputs=(orders,), keys=("day",), affected={orders: ["to_date(o_orderdate)"]}),
            Declared("status_mix", status_mix, inputs=("order_daily",))]


REFRESH_CUT = "1998-01-01 00:00:00"


@register("refresh_set", """
SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n_orders, round(sum(o_totalprice), 2) AS revenue
FROM orders GROUP BY 1
""")
def refresh_set(spark, sf):
    """Full refresh of a partial input, then incremental refreshes of one table after each further commit.

    The first commit has no order from the cut on, and of the days before it all
    but every seventh order; the second has the late ones, the third the rest.
    """
    from strata.operators.tables import append
    from strata.plans.refresh import refresh

    db = fresh_db(spark)
    orders, every = f"{db}.orders", table(spark, sf, "orders")
    before = F.coalesce(F.col("o_orderdate") < F.lit(REFRESH_CUT).cast("timestamp_ntz"), F.lit(False))
    late = F.coalesce(F.col("o_orderkey") % 7 == 0, F.lit(False))
    append(every.where(before & ~late), orders)
    refresh(spark, declared_orders(orders), db, full=True)
    for part in (every.where(before & late), every.where(~before)):
        append(part, orders)
        refresh(spark, declared_orders(orders), db, only=("order_daily",))
    return spark.table(f"{db}.order_daily")


# ---------------------------------------------------------------- Q2 Q3
SAVED_SQL = ("SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders "
             "WHERE o_orderstatus = :status GROUP BY o_orderpriority")


@register("saved_query", SAVED_SQL.replace(":status", "'F'"))
def saved_query(spark, sf):
    """Q2: named SQL text kept in a table, run by name with a parameter."""
    from strata.plans.sql import SavedQueries

    register_views(spark, sf, ["orders"])
    sq = SavedQueries(spark, f"{fresh_db(spark)}.saved_queries")
    sq.register("orders_by_priority", SAVED_SQL, "orders per priority for one status", ["orders"])
    sq.register("orders_by_priority", SAVED_SQL, "orders per priority for one status (v2)", ["orders", "gold"])
    return sq.run("orders_by_priority", params={"status": "F"})


SQL_FILE_TEXT = """-- orders of one status, then per priority
CREATE TABLE IDENTIFIER(:tbl) USING parquet AS
SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders WHERE o_orderstatus = :status;
SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM IDENTIFIER(:tbl) GROUP BY o_orderpriority;
"""


@register("sql_file", SAVED_SQL.replace(":status", "'O'"))
def sql_file(spark, sf):
    """Q3: a SQL file with named parameters and IDENTIFIER() table names."""
    from strata.plans.sql import run_sql_file
    from strata.session import scratch_dir

    register_views(spark, sf, ["orders"])
    path = scratch_dir(spark, "sqlfile")
    spark.createDataFrame([(SQL_FILE_TEXT,)], "value string").coalesce(1).write.text(path)
    return run_sql_file(spark, path, {"tbl": f"{fresh_db(spark)}.orders_o", "status": "O"})


# ---------------------------------------------------------------- S16 W1-W3 W8
@register("table_scan", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 1000")
def table_scan(spark, sf):
    """Table by name with an ordered row cap (max_rows)."""
    from strata.operators.tables import write_full
    from strata.sources.files import read_table

    name = f"{fresh_db(spark)}.orders"
    write_full(table(spark, sf, "orders"), name)
    return read_table(spark, name, max_rows=1000, order_by=["o_orderkey"])


REPLACE_SQL = ("SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total "
               "FROM orders GROUP BY o_orderstatus")


@register("replace_from_query", REPLACE_SQL)
def replace_from_query(spark, sf):
    """Create-or-replace from a query, twice, then once from itself (stage path)."""
    from strata.operators.tables import replace_from_query as rq

    register_views(spark, sf, ["orders"])
    name = f"{fresh_db(spark)}.status_totals"
    rq(spark, name, REPLACE_SQL)
    rq(spark, name, REPLACE_SQL)
    return rq(spark, name, f"SELECT * FROM {name}")


@register("table_inventory", """
SELECT 'orders_copy' AS name, count(*) AS n_rows, max(o_orderkey) AS top_key FROM orders
UNION ALL SELECT 'events_copy', count(*), max(event_id) FROM events
""")
def table_inventory(spark, sf):
    """The tables of a schema (after a drop) from the catalog, with what each holds."""
    from strata.operators.tables import drop_table, inventory, write_full

    db = fresh_db(spark)
    write_full(table(spark, sf, "orders"), f"{db}.orders_copy")
    write_full(table(spark, sf, "events"), f"{db}.events_copy")
    write_full(table(spark, sf, "nation"), f"{db}.nation_copy")
    drop_table(spark, f"{db}.nation_copy")
    held = None
    for name, key in (("orders_copy", "o_orderkey"), ("events_copy", "event_id")):
        one = spark.table(f"{db}.{name}").agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n_rows"), F.max(key).alias("top_key"))
        held = one if held is None else held.unionByName(one)
    return inventory(spark, db).where(~F.col("is_temporary")).select("name").join(held, "name", "left")


@register("table_snapshot", """
SELECT 'orders_copy' AS name, 'MANAGED' AS table_type, 'parquet' AS format, count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys
FROM orders
""")
def table_snapshot(spark, sf):
    """What the catalog says of a keyed table after an upsert that changes nothing, and what a reader of its name counts."""
    from strata.operators.tables import snapshot, upsert

    name = f"{fresh_db(spark)}.orders_copy"
    orders = table(spark, sf, "orders")
    for batch in (orders, orders.where("o_orderstatus = 'F'")):
        upsert(spark, batch, name, ["o_orderkey"])
    held = spark.sql(f"SELECT '{name}' AS full_name, count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys FROM {name}")
    return snapshot(spark, name).join(held, "full_name").select("name", "table_type", "format", "n_rows", "n_keys")


# ---------------------------------------------------------------- R2-R5 (streaming)
EVENTS_JSON_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
STREAM_CUT = "2024-01-16 00:00:00"
TS_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
JSON_READ = {"timestampNTZFormat": TS_MICROS}
SQL_EVENTS_ALL = "SELECT event_id, ts, user_id, event_type, value, props FROM events"


def events_json_drop(spark, sf, path, before: bool) -> None:
    """Events landing as JSON files: one drop for rows before the cut, one for the rest."""
    ev = table(spark, sf, "events")
    cut = F.col("ts") < F.lit(STREAM_CUT).cast("timestamp_ntz")
    ev.where(cut if before else ~cut).repartition(4).write.mode("append") \
        .option("timestampNTZFormat", TS_MICROS).json(path)


def stream_paths(spark):
    from strata.session import scratch_dir

    root = scratch_dir(spark, "stream")
    return f"{root}/landing", f"{root}/target", f"{root}/checkpoint"


@register("stream_ingest", SQL_EVENTS_ALL)
def stream_ingest(spark, sf):
    """R2: triggered incremental file ingest; the second run only takes the new files."""
    from strata.streaming.ingest import ingest_stream

    landing, target, ckpt = stream_paths(spark)
    events_json_drop(spark, sf, landing, True)
    ingest_stream(spark, landing, EVENTS_JSON_SCHEMA, target, ckpt, options=JSON_READ)
    events_json_drop(spark, sf, landing, False)
    ingest_stream(spark, landing, EVENTS_JSON_SCHEMA, target, ckpt, options=JSON_READ)
    return spark.read.parquet(target).select("event_id", "ts", "user_id", "event_type", "value", "props")


@register("stream_upsert", """
SELECT event_id, ts, user_id, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1
""")
def stream_upsert(spark, sf):
    """Keyed upsert of every micro-batch (newest ts per user wins), read by name."""
    from strata.streaming.ingest import read_stream, upsert_stream

    landing, _, ckpt = stream_paths(spark)
    tbl = f"{fresh_db(spark)}.events_latest"
    for before in (True, False):
        events_json_drop(spark, sf, landing, before)
        s = read_stream(spark, landing, EVENTS_JSON_SCHEMA, options=JSON_READ).drop("source_file", "ingested_at")
        upsert_stream(spark, s, tbl, ["user_id"], ["ts"], ckpt)
    return spark.table(tbl)


@register("stream_run_status", """
WITH l AS (SELECT user_id, event_type AS state, ts,
                  row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type DESC) AS rn FROM events),
     a AS (SELECT user_id, min(ts) AS first_seen, count(*) AS n_obs FROM events GROUP BY user_id)
SELECT l.user_id, state, first_seen, ts AS last_seen, n_obs, state IN ('purchase', 'error') AS is_terminal,
       CASE WHEN state IN ('purchase', 'error') THEN (epoch_us(ts) - epoch_us(first_seen)) // 1000 END AS duration_ms
FROM l JOIN a ON l.user_id = a.user_id WHERE rn = 1
""")
def stream_run_status(spark, sf):
    """Latest state per run kept current from an observation stream."""
    from strata.streaming.ingest import read_stream, run_status_stream

    landing, _, ckpt = stream_paths(spark)
    tbl = f"{fresh_db(spark)}.run_status"
    for before in (True, False):
        events_json_drop(spark, sf, landing, before)
        s = read_stream(spark, landing, EVENTS_JSON_SCHEMA, options=JSON_READ)
        run_status_stream(spark, s, tbl, "user_id", "event_type", "ts", FIXTURE_TERMINAL, ckpt)
    return spark.table(tbl)


@register("stream_full_refresh", SQL_EVENTS_ALL)
def stream_full_refresh(spark, sf):
    """Full refresh of a stream = new checkpoint + rebuilt target (no duplicates); readers of the name switch."""
    from strata.streaming.ingest import full_refresh_stream, ingest_stream

    landing, target, ckpt = stream_paths(spark)
    events_json_drop(spark, sf, landing, True)
    events_json_drop(spark, sf, landing, False)
    name = f"{fresh_db(spark)}.events"
    ingest_stream(spark, landing, EVENTS_JSON_SCHEMA, target, ckpt, options=JSON_READ, table=name)
    full_refresh_stream(spark, landing, EVENTS_JSON_SCHEMA, target, options=JSON_READ, table=name)
    return spark.table(name).select("event_id", "ts", "user_id", "event_type", "value", "props")


# ---------------------------------------------------------------- M1-M7 A6 W5 P6
SPLIT_KEYS = ["l_orderkey", "l_linenumber"]
SEED = 42
TEST_SIZE = 0.2
FEATURES = ["l_quantity"]
LABEL = "l_extendedprice"


def sql_split_bucket(seed=SEED):
    return (f"CAST(('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, '{seed}')), 1, 8)) AS BIGINT)"
            " % 10000")


SQL_SPLIT = f"WITH t AS (SELECT *, {sql_split_bucket()} AS b FROM lineitem)"
NUMERIC_COLUMNS = ["l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax"]
SQL_MODEL = ("m AS (SELECT regr_slope(l_extendedprice, l_quantity) AS s, "
             "regr_intercept(l_extendedprice, l_quantity) AS i FROM t WHERE b >= 2000)")


@register("split_test_rows", f"""
{SQL_SPLIT}
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice FROM t WHERE b < 2000
""")
def split_test_rows(spark, sf):
    """M1: repeatable 20 % test split by md5 bucket of the key and seed."""
    from strata.operators.ml import split

    _, test = split(table(spark, sf, "lineitem"), SPLIT_KEYS, TEST_SIZE, SEED)
    return test.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")


def fitted(spark, sf, seed=SEED):
    from strata.operators import ml

    train_df, test_df = ml.split(table(spark, sf, "lineitem"), SPLIT_KEYS, TEST_SIZE, seed)
    return ml.train(train_df, FEATURES, LABEL), test_df


@register("linreg_predict", f"""
{SQL_SPLIT}, {SQL_MODEL}
SELECT l_orderkey, l_linenumber, round(m.i + m.s * l_quantity, 3) AS predicted, l_extendedprice AS actual
FROM t CROSS JOIN m WHERE b < 2000
""")
def linreg_predict(spark, sf):
    """M2/M3: OLS fit on the train split (MLlib normal equations), predictions on test rows."""
    from strata.operators.ml import score

    model, test_df = fitted(spark, sf)
    p = score(model, test_df, FEATURES, LABEL, keep=SPLIT_KEYS)
    return p.select(*SPLIT_KEYS, F.round("predicted", 3).alias("predicted"), "actual")


@register("feature_columns", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean FROM lineitem" for c in NUMERIC_COLUMNS))
def feature_columns(spark, sf):
    """The numeric columns other than the target and the keys, each with its mean."""
    from strata.operators.ml import split_label

    li = table(spark, sf, "lineitem")
    features = split_label(li, LABEL, exclude=SPLIT_KEYS)
    means = li.agg(*[F.round(F.avg(c), 6).alias(c) for c in features])
    return means.unpivot([], features, "feature", "mean")


@register("training_runs", f"""
{SQL_SPLIT}, {SQL_MODEL},
p AS (SELECT m.i + m.s * l_quantity AS predicted, l_extendedprice AS actual FROM t CROSS JOIN m WHERE b < 2000)
SELECT 'training' AS run_name, count(*) AS n_test,
       round(sqrt(avg((predicted - actual) * (predicted - actual))), 4) AS rmse,
       round(1 - sum((predicted - actual) * (predicted - actual)) / (var_pop(actual) * count(*)), 6) AS r2
FROM p
""")
def training_runs(spark, sf):
    """M4: the run record of a training, read back from the runs table."""
    from strata.plans.pipelines import run_training

    runs = f"{fresh_db(spark)}.runs"
    run_training(spark, table(spark, sf, "lineitem"), LABEL, SPLIT_KEYS, FEATURES, TEST_SIZE, SEED, runs_table=runs, name="lineitem")
    m = F.from_json("metrics", "n_test bigint, rmse double, r2 double")
    return spark.table(runs).select("run_name", m.alias("m")).select(
        "run_name", "m.n_test", F.round("m.rmse", 4).alias("rmse"), F.round("m.r2", 6).alias("r2"))


@register("linreg_metrics", f"""
{SQL_SPLIT}, {SQL_MODEL},
p AS (SELECT m.i + m.s * l_quantity AS predicted, l_extendedprice AS actual FROM t CROSS JOIN m WHERE b < 2000)
SELECT count(*) AS n, round(sqrt(avg((predicted - actual) * (predicted - actual))), 4) AS rmse,
       round(1 - sum((predicted - actual) * (predicted - actual)) / (var_pop(actual) * count(*)), 6) AS r2
FROM p
""")
def linreg_metrics(spark, sf):
    """RMSE and R^2 (1 - SSE/SST) of the test predictions."""
    from strata.operators.ml import regression_metrics, score

    model, test_df = fitted(spark, sf)
    m = regression_metrics(score(model, test_df, FEATURES, LABEL))
    return m.select("n", F.round("rmse", 4).alias("rmse"), F.round("r2", 6).alias("r2"))


def training_run_id():
    from strata.plans.pipelines import run_id_for

    return run_id_for("lineitem", FEATURES, LABEL, TEST_SIZE, SEED, None)


@register("predictions_table", f"""
{SQL_SPLIT}, {SQL_MODEL}
SELECT round(m.i + m.s * l_quantity, 3) AS predicted, l_extendedprice AS actual, '{training_run_id()}' AS run_id,
       l_orderkey, l_linenumber
FROM t CROSS JOIN m WHERE b < 2000
""")
def predictions_table(spark, sf):
    """Training run writes predictions (kept distributed) and a run record."""
    from strata.plans.pipelines import run_training

    db = fresh_db(spark)
    rec = run_training(spark, table(spark, sf, "lineitem"), LABEL, SPLIT_KEYS, FEATURES, TEST_SIZE, SEED,
                       predictions_table=f"{db}.predictions", runs_table=f"{db}.runs", name="lineitem")
    assert rec["run_id"] == training_run_id()
    p = spark.table(f"{db}.predictions")
    return p.select(F.round("predicted", 3).alias("predicted"), "actual", "run_id", *SPLIT_KEYS)


@register("score_alias", f"""
{SQL_SPLIT}, {SQL_MODEL}
SELECT l_orderkey, l_linenumber, round(m.i + m.s * l_quantity, 3) AS predicted, 'champion' AS alias,
       CAST(2 AS BIGINT) AS version
FROM t CROSS JOIN m WHERE b < 2000
""")
def score_alias(spark, sf):
    """The 'champion' alias moves from version 1 to 2; scoring loads what it points at."""
    from strata.operators import ml
    from strata.operators.state import resolve_alias
    from strata.session import scratch_dir

    root = scratch_dir(spark, "registry")
    m1, _ = fitted(spark, sf, seed=7)
    m2, test_df = fitted(spark, sf, seed=SEED)
    ml.save_model(m1, f"{root}/v1")
    ml.save_model(m2, f"{root}/v2")
    versions = spark.createDataFrame([("lineitem_price", 1, f"{root}/v1"), ("lineitem_price", 2, f"{root}/v2")],
                                     "full_name string, version bigint, source string")
    log = spark.createDataFrame([("lineitem_price", "champion", 1, 1), ("lineitem_price", "champion", 2, 2),
                                 ("lineitem_price", "challenger", 1, 3)],
                                "full_name string, alias string, version bigint, assigned_at bigint")
    target = resolve_alias(log, versions).where(F.col("alias") == "champion").first()  # one registry row
    model = ml.load_model(target["source"])
    p = ml.score(model, test_df, FEATURES, keep=SPLIT_KEYS)
    return p.select(*SPLIT_KEYS, F.round("predicted", 3).alias("predicted"), F.lit("champion").alias("alias"),
                    F.lit(target["version"]).cast("bigint").alias("version"))


ROUTES = [("model_a", 70), ("model_b", 30), ("model_c", 0)]


@register("traffic_split", f"""
SELECT event_id, user_id,
       CASE WHEN {MD5_BUCKET_SQL.format(k='user_id', n=100)} < 70 THEN 'model_a' ELSE 'model_b' END AS served_entity
FROM events
""")
def traffic_split(spark, sf):
    """M6: percentage traffic split by md5 bucket of the key (a 0 % route gets nothing)."""
    from strata.operators.ml import route

    return route(table(spark, sf, "events"), "user_id", ROUTES).select("event_id", "user_id", "served_entity")


def scoring_requests(spark, sf) -> DataFrame:
    """Events packed into the four request shapes (plus object inputs, none-set, two-set, empty and malformed requests)."""
    ev = table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    rec = F.array(F.struct("value", "k"))
    row = F.when(F.col("k") > 90, F.array(F.col("value"))).otherwise(
        F.array(F.col("value"), F.col("k").cast("double")))
    split_ = F.struct(F.array(F.lit("value"), F.lit("k")).alias("columns"), F.array(row).alias("data"))
    et = F.col("event_type")
    body = (F.when((et == "view") & (F.col("k") < 5),
                   F.to_json(F.struct(rec.alias("dataframe_records"), rec.alias("instances"))))
            .when((et == "view") & (F.col("k") > 95), F.lit('{"dataframe_records": []}'))
            .when((et == "view") & (F.col("k") > 90), F.lit('{"dataframe_records": {"value": 1}}'))
            .when(et == "view", F.to_json(F.struct(rec.alias("dataframe_records"))))
            .when(et == "click", F.to_json(F.struct(split_.alias("dataframe_split"))))
            .when(et == "purchase", F.to_json(F.struct(rec.alias("instances"))))
            .when((et == "signup") & (F.col("k") < 10), F.to_json(F.struct(F.struct("value", "k").alias("inputs"))))
            .when(et == "signup", F.to_json(F.struct(rec.alias("inputs"))))
            .otherwise(F.lit("{}")))
    return ev.select(F.col("event_id").alias("request_id"), body.alias("body"))


SQL_DECODE = """
WITH e AS (SELECT event_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
SELECT event_id AS request_id,
       CASE event_type WHEN 'view' THEN 'dataframe_records' WHEN 'purchase' THEN 'instances' ELSE 'inputs' END AS shape,
       0 AS row_idx, CAST(json_object('value', value, 'k', k) AS VARCHAR) AS record, false AS ragged,
       CAST(NULL AS VARCHAR) AS reject_reason
FROM e WHERE event_type IN ('purchase', 'signup') OR (event_type = 'view' AND k BETWEEN 5 AND 90)
UNION ALL
SELECT event_id, 'dataframe_records', NULL, NULL, false,
       CASE WHEN k > 95 THEN 'no records' ELSE 'dataframe_records is malformed' END
FROM e WHERE event_type = 'view' AND k > 90
UNION ALL
SELECT event_id, 'dataframe_split', 0,
       CASE WHEN k > 90 THEN '{"value":"' || CAST(value AS VARCHAR) || '"}'
            ELSE '{"value":"' || CAST(value AS VARCHAR) || '","k":"' || CAST(CAST(k AS DOUBLE) AS VARCHAR) || '"}' END,
       k > 90, NULL
FROM e WHERE event_type = 'click'
UNION ALL
SELECT event_id, NULL, NULL, NULL, false,
       CASE WHEN event_type = 'error' THEN 'no input shape set' ELSE 'more than one input shape set' END
FROM e WHERE event_type = 'error' OR (event_type = 'view' AND k < 5)
"""


@register("decode_requests", SQL_DECODE)
def decode_requests(spark, sf):
    """M5: scoring request log decoded to one row per record; bad requests kept with a reason."""
    from strata.operators.ml import decode_requests as dr

    return dr(scoring_requests(spark, sf))


@register("score_requests", """
WITH e AS (SELECT event_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
m AS (SELECT regr_slope(value, k) AS s, regr_intercept(value, k) AS i FROM e)
SELECT event_id AS request_id, 0 AS row_idx, round(m.i + m.s * k, 3) AS predicted
FROM e CROSS JOIN m
WHERE event_type IN ('purchase', 'signup') OR (event_type = 'view' AND k BETWEEN 5 AND 90)
  OR (event_type = 'click' AND k <= 90)
""")
def score_requests(spark, sf):
    """M5: decoded records scored in bulk by a model over the same features."""
    from strata.operators import ml

    ev = table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("double"))
    model = ml.train(ev, ["k"], "value")
    s = ml.score_requests(model, ml.decode_requests(scoring_requests(spark, sf)), ["k"])
    return s.select("request_id", "row_idx", F.round("predicted", 3).alias("predicted"))


# ---------------------------------------------------------------- S10 S18 W6 W7
@register("staged_resume", SQL_BRONZE)
def staged_resume(spark, sf):
    """An interrupted run staged the first half; the resume fetches only the rest."""
    from strata.session import scratch_dir
    from strata.sources.staging import load_staged, resume, stage_raw

    stage = scratch_dir(spark, "stage")
    ev = table(spark, sf, "events")
    first = ev.where(F.col("ts") < F.lit(STREAM_CUT).cast("timestamp_ntz"))
    stage_raw(fetch_all(RP.event_requests(first), ReplayTransport(), sleep=no_sleep), stage)

    reqs = RP.event_requests(ev)
    resume(spark, reqs, stage, lambda todo: fetch_all(todo, ReplayTransport(), sleep=no_sleep))
    return load_staged(spark, stage).select("object_id", "http_status", "raw_json", "error_message")


@register("rest_source", SQL_BRONZE)
def rest_source(spark, sf):
    """A fetch that is named by options alone: ids from stored files, a transport, a rate."""
    from strata.session import scratch_dir
    from strata.sources.rest_source import read_rest

    path = scratch_dir(spark, "restids")
    RP.event_requests(table(spark, sf, "events")).write.parquet(path)
    return read_rest(spark, ids_path=path, transport="replay", partitions="8", retry_backoff="false")


@register("run_log", """
SELECT 'events_ingest' AS run_name, count(*) AS rows,
       count(*) FILTER (WHERE event_type NOT IN ('error', 'signup')) AS success,
       count(*) FILTER (WHERE event_type IN ('error', 'signup')) AS failure, false AS skipped
FROM events
UNION ALL
SELECT 'empty_ingest', 0, NULL, NULL, true
""")
def run_log(spark, sf):
    """Run records with counts observed during the write; an empty input is skipped."""
    from strata.plans.pipelines import run_api_ingest

    db = fresh_db(spark)
    reqs = RP.event_requests(table(spark, sf, "events"))
    run_api_ingest(spark, reqs, ReplayTransport(), f"{db}.bronze", runs_table=f"{db}.runs",
                   run_name="events_ingest", sleep=no_sleep)
    run_api_ingest(spark, reqs.where(F.lit(False)), ReplayTransport(), f"{db}.bronze_empty",
                   runs_table=f"{db}.runs", run_name="empty_ingest", sleep=no_sleep)
    return spark.table(f"{db}.runs").select("run_name", "rows", "success", "failure", "skipped")


# ---------------------------------------------------------------- the reference's Silver projections
def met_documents(spark, sf) -> DataFrame:
    """Met-shaped detail records, one per part (row by row, no grouping)."""
    p = table(spark, sf, "part")
    doc = F.to_json(F.struct(
        F.col("p_partkey").alias("objectID"),
        F.concat(F.lit("P."), F.col("p_partkey").cast("string")).alias("accessionNumber"),
        F.col("p_size").cast("string").alias("accessionYear"),
        (F.col("p_size") > 40).alias("isHighlight"),
        (F.col("p_retailprice") < 1000).alias("isPublicDomain"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("department"),
        F.col("p_type").alias("classification"),
        F.col("p_size").alias("objectBeginDate"),
        (F.col("p_size") + 10).alias("objectEndDate"),
        F.split(F.col("p_type"), " ").alias("tags"),
        F.struct(F.col("p_size").alias("size"), F.col("p_retailprice").alias("price")).alias("measurements"),
    ), RP.JSON_OPTS)
    return p.select(F.col("p_partkey").alias("id"), F.lit(200).alias("replay_status"),
                    F.coalesce(doc, F.lit("{}")).alias("replay_body"))


SQL_MET_SILVER = """
SELECT p_partkey AS object_id, p_partkey AS met_object_id, 'P.' || CAST(p_partkey AS VARCHAR) AS accession_number,
       CAST(p_size AS VARCHAR) AS accession_year, p_size > 40 AS is_highlight, p_retailprice < 1000 AS is_public_domain,
       p_name AS title, CAST(NULL AS VARCHAR) AS object_date, p_size AS object_begin_date,
       p_size + 10 AS object_end_date, CAST(NULL AS VARCHAR) AS medium, CAST(NULL AS VARCHAR) AS dimensions,
       p_type AS classification, p_brand AS department, CAST(NULL AS VARCHAR) AS culture,
       CAST(NULL AS VARCHAR) AS period, CAST(NULL AS VARCHAR) AS dynasty, CAST(NULL AS VARCHAR) AS reign,
       CAST(NULL AS VARCHAR) AS artist_display_name, CAST(NULL AS VARCHAR) AS artist_display_bio,
       CAST(NULL AS VARCHAR) AS artist_role, CAST(NULL AS VARCHAR) AS artist_nationality,
       CAST(NULL AS VARCHAR) AS artist_begin_date, CAST(NULL AS VARCHAR) AS artist_end_date,
       CAST(NULL AS VARCHAR) AS primary_image_url, CAST(NULL AS VARCHAR) AS primary_image_small_url,
       CAST(NULL AS VARCHAR) AS object_url,
       CAST(to_json(string_split(p_type, ' ')) AS VARCHAR) AS tags_raw_json,
       CAST(json_object('size', p_size, 'price', p_retailprice) AS VARCHAR) AS measurements_raw_json,
       CAST(NULL AS VARCHAR) AS additional_images_raw_json, CAST(NULL AS VARCHAR) AS constituents_raw_json
FROM part
"""


@register("silver_met_objects", SQL_MET_SILVER)
def silver_met_objects(spark, sf):
    """The reference's Met Silver (30 typed/JSON-text fields + key) over fetched Met-shaped records."""
    from strata.plans.specs import MET_OBJECTS

    bronze = fetch_all(met_documents(spark, sf), ReplayTransport(), sleep=no_sleep, stamp=False)
    return S.silver(bronze, MET_OBJECTS, keep=())


def stripe_documents(spark, sf) -> DataFrame:
    """Stripe-shaped customers with string ids (cus_<key>), one per customer."""
    c = table(spark, sf, "customer")
    doc = F.to_json(F.struct(
        F.concat(F.lit("cus_"), F.col("c_custkey").cast("string")).alias("id"),
        F.concat(F.lower(F.regexp_replace("c_name", "[^A-Za-z0-9]", "")), F.lit("@example.com")).alias("email"),
        F.col("c_name").alias("name"),
        (F.lit(1700000000) + F.col("c_custkey")).alias("created"),
        F.col("c_mktsegment").alias("description"),
        F.lit("usd").alias("currency"),
        (F.col("c_acctbal") < 0).alias("delinquent"),
        F.lit(False).alias("livemode"),
        F.struct(F.col("c_nationkey").alias("nation")).alias("address"),
        F.struct(F.col("c_mktsegment").alias("segment")).alias("metadata"),
    ), RP.JSON_OPTS)
    return c.select(F.concat(F.lit("cus_"), F.col("c_custkey").cast("string")).alias("id"),
                    F.lit(200).alias("replay_status"), F.coalesce(doc, F.lit("{}")).alias("replay_body"))


SQL_STRIPE_SILVER = """
SELECT 'cus_' || CAST(c_custkey AS VARCHAR) AS customer_id,
       lower(regexp_replace(c_name, '[^A-Za-z0-9]', '', 'g')) || '@example.com' AS email, c_name AS name,
       1700000000 + c_custkey AS created_at_unix, c_mktsegment AS description, CAST(NULL AS VARCHAR) AS phone,
       'usd' AS currency, c_acctbal < 0 AS delinquent, false AS livemode,
       CAST(json_object('nation', c_nationkey) AS VARCHAR) AS address_raw_json,
       CAST(json_object('segment', c_mktsegment) AS VARCHAR) AS metadata_raw_json
FROM customer
"""


@register("silver_stripe_customers", SQL_STRIPE_SILVER)
def silver_stripe_customers(spark, sf):
    """The reference's Stripe Silver over fetched customers keyed by string ids (never cast)."""
    from strata.plans.specs import STRIPE_CUSTOMERS

    bronze = fetch_all(stripe_documents(spark, sf), ReplayTransport(), key_type="string",
                       sleep=no_sleep, stamp=False)
    return S.silver(bronze, STRIPE_CUSTOMERS, keep=()).withColumnRenamed("object_id", "customer_id")


# ---------------------------------------------------------------- incremental Silver
@register("silver_incremental", SQL_SILVER)
def silver_incremental(spark, sf):
    """P1/P2 incrementally: two Bronze runs (append), Silver refreshed after each from its high-water mark."""
    from strata.operators.silver import refresh_silver
    from strata.operators.tables import append

    db = fresh_db(spark)
    bronze, silver_t = f"{db}.bronze", f"{db}.silver"
    ev = table(spark, sf, "events")
    cut = F.col("ts") < F.lit(STREAM_CUT).cast("timestamp_ntz")
    for part in (ev.where(cut), ev.where(~cut)):
        fetched = fetch_all(RP.event_requests(part), ReplayTransport(), sleep=no_sleep)
        append(fetched, bronze)
        refresh_silver(spark, bronze, silver_t, RP.EVENT_FIELDS)
    return spark.table(silver_t).drop("ingested_at")


# ---------------------------------------------------------------- incremental Bronze (S7 + S9 + W4)
@register("bronze_incremental", SQL_BRONZE)
def bronze_incremental(spark, sf):
    """Incremental pulls: run 2 fetches only ids not in Bronze plus retryable failures, upserted on object_id."""
    from strata.plans.pipelines import run_api_ingest

    db = fresh_db(spark)
    bronze = f"{db}.bronze"
    ev = table(spark, sf, "events")
    reqs = RP.event_requests(ev)
    early = RP.event_requests(ev.where(F.col("ts") < F.lit(EARLIER_RUN_CUTOFF).cast("timestamp_ntz")))
    run_api_ingest(spark, early, ReplayTransport(), bronze, sleep=no_sleep, mode="upsert")
    stored = spark.table(bronze)
    todo = I.union_sources(I.new_ids(reqs.select("id"), stored), I.failed_ids(stored))
    run_api_ingest(spark, reqs.join(todo, "id", "left_semi"), ReplayTransport(), bronze, sleep=no_sleep,
                   mode="upsert")
    return spark.table(bronze).select("object_id", "http_status", "raw_json", "error_message")


@register("full_then_incremental", SQL_BRONZE)
def full_then_incremental(spark, sf):
    """The usual life of Bronze: a full pull (overwrite), then new ids only (upsert on object_id)."""
    from strata.plans.pipelines import run_api_ingest

    bronze = f"{fresh_db(spark)}.bronze"
    ev = table(spark, sf, "events")
    reqs = RP.event_requests(ev)
    early = RP.event_requests(ev.where(F.col("ts") < F.lit(EARLIER_RUN_CUTOFF).cast("timestamp_ntz")))
    run_api_ingest(spark, early, ReplayTransport(), bronze, sleep=no_sleep)
    todo = I.new_ids(reqs.select("id"), spark.table(bronze))
    run_api_ingest(spark, reqs.join(todo, "id", "left_semi"), ReplayTransport(), bronze, sleep=no_sleep, mode="upsert")
    return spark.table(bronze).select("object_id", "http_status", "raw_json", "error_message")


# ---------------------------------------------------------------- A7 over Bronze
DRIFT_FIELDS = S.spec(("id", "bigint", "id"), ("value", "double", "value"), ("k", "int", "k"),
                      ("event_type", "int", "event_type_as_int"))


@register("silver_quality_bronze", """
WITH ok AS (SELECT * FROM events WHERE event_type NOT IN ('error', 'signup'))
SELECT column_name, null_count, cast_failures, row_count FROM (
  SELECT 'id' AS column_name, 0 AS o, CAST(0 AS BIGINT) AS null_count, CAST(0 AS BIGINT) AS cast_failures,
         count(*) AS row_count FROM ok
  UNION ALL SELECT 'value', 1, 0, 0, count(*) FROM ok
  UNION ALL SELECT 'k', 2, 0, 0, count(*) FROM ok
  UNION ALL SELECT 'event_type_as_int', 3, 0, count(*), count(*) FROM ok) t
""")
def silver_quality_bronze(spark, sf):
    """NULL and cast-failure profile of a Silver spec over fetched Bronze (one field drifted)."""
    return S.silver_quality(events_bronze(spark, sf), DRIFT_FIELDS)
