"""Table writes and keyed maintenance.

A table's public name is a view over data tables of its own, which are written
once and never changed:

* ``name__base_<commit>`` holds the rows of a whole write or of a fold,
* ``name__part_<commit>`` those of one append or upsert.

A data table enters the catalog when all its rows are written, and readers see
it when one ``CREATE OR REPLACE VIEW`` names it. So a failed or interrupted
write changes nothing, and a reader finds the old rows or the new ones, never
none and never a part. Of a keyed table the view shows the newest version of
each key, to whoever reads the name.

What the view no longer names stays for ``KEEP_SECONDS``, for queries that still
read it, and is dropped by a later write. Two writers may append at a time; each
looks, after it has set the view, for parts that the other wrote meanwhile. As
catalogs swap no view by comparison, whole writes of one table are for one
writer at a time.
"""

from __future__ import annotations

import json
import random
import time
from dataclasses import asdict, dataclass, field
from typing import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType


# ---------------------------------------------------------------- names / schema
def split_name(full_name: str) -> tuple[str | None, str | None, str]:
    """``catalog.schema.table`` / ``schema.table`` / ``table``."""
    parts = full_name.split(".")
    if len(parts) > 3:
        raise ValueError(f"bad table name {full_name!r}")
    parts = [None] * (3 - len(parts)) + parts
    return parts[0], parts[1], parts[2]


def ensure_schema(spark: SparkSession, schema: str, location: str | None = None) -> None:
    """``CREATE SCHEMA IF NOT EXISTS`` (optionally at a shared location)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{loc}")


def ensure_schema_of(spark: SparkSession, table: str, location: str | None = None) -> None:
    cat, sch, _ = split_name(table)
    if sch:
        ensure_schema(spark, f"{cat}.{sch}" if cat else sch, location)


# ---------------------------------------------------------------- views over data tables
BASE, PART = "__base_", "__part_"
SEQ_COL, GONE_COL = "_seq", "_gone"     # of a row: the commit that wrote it; whether it says that its key is no more
STATE_PROP, FOLDER_PROP = "strata.state", "strata.folder"
KEEP_SECONDS = 3600             # how long data tables stay that the view no longer names
FOLD_EVERY = 16                 # parts after which an upsert or append folds them into a base
LINEAGE = 8                     # folds that ``changed_rows`` can look back over


@dataclass
class State:
    """What a view stands for; kept in the view's properties, so it changes with it."""
    base: int                                           # commit of the base
    columns: list[str]
    keys: list[str] = field(default_factory=list)       # of a keyed table
    order_by: list[str] = field(default_factory=list)   # expressions; on equal values the later commit is newer
    partition_by: list[str] = field(default_factory=list)
    covered: dict[str, int] = field(default_factory=dict)   # data tables (name ends) the base stands for: second of that
    lineage: list[list] = field(default_factory=list)   # the last folds: [base before, commits of the parts folded]
    seen: dict[str, dict] = field(default_factory=dict)     # of a derived table: input -> its commits() when it was built


def _quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def _commit() -> int:
    """A number for a commit: the time, and some bits that part writers of the same microsecond."""
    return (time.time_ns() // 1000 << 10) + random.getrandbits(10)


def state_of(spark: SparkSession, table: str) -> State | None:
    """None where there is no such table; an error for a table that this layer did not write."""
    if not spark.catalog.tableExists(table):
        return None
    text = _properties(spark, table).get(STATE_PROP)
    if text is None:
        raise ValueError(f"{table} is not a table of this layer; take it over with adopt()")
    return State(**json.loads(text))


def _data_tables(spark: SparkSession, table: str, kind: str = "__*_") -> list[str]:
    """Name ends (``__part_<commit>``) of the data tables in the catalog, in order of commit."""
    cat, sch, name = split_name(table)
    place = ".".join(x for x in (cat, sch) if x)
    if place and not spark.catalog.databaseExists(place):
        return []
    shown = spark.sql(f"SHOW TABLES {'IN ' + place if place else ''} LIKE '{name}{kind}*'").collect()
    found = [r["tableName"][len(name):] for r in shown if not r["isTemporary"]]
    ends = [e for e in found if e.startswith((BASE, PART)) and e.rsplit("_", 1)[1].isdigit()]
    return sorted(ends, key=lambda e: int(e.rsplit("_", 1)[1]))


def _parts(spark: SparkSession, table: str, state: State) -> list[str]:
    return [e for e in _data_tables(spark, table, PART) if e not in state.covered]


def _rows_sql(spark: SparkSession, table: str, state: State, ends: Sequence[str]) -> str:
    """All rows of some data tables with their commit and mark; a base that was taken over has neither column."""
    shown = ", ".join(map(_quoted, state.columns))
    out = []
    for e in ends:
        own = e.startswith(PART) or SEQ_COL in spark.table(f"{table}{e}").columns
        marks = f"{SEQ_COL}, {GONE_COL}" if own else f"{state.base}L AS {SEQ_COL}, false AS {GONE_COL}"
        out.append(f"SELECT {shown}, {marks} FROM {table}{e}")
    return " UNION ALL ".join(out)


def _newest_sql(spark: SparkSession, table: str, state: State, rows: str) -> str:
    """The newest of some rows for each key, unless it says that the key is gone."""
    types = {f.name: f.dataType for f in spark.table(f"{table}{BASE}{state.base}").schema.fields}
    rest = [c for c in state.columns if c not in state.keys]
    ordered = [c for c in rest if _orderable(types[c])]
    carried = [c for c in rest if c not in ordered]
    order = [f"{e} AS _o{i}" for i, e in enumerate(state.order_by)] + [SEQ_COL, GONE_COL, *map(_quoted, ordered)]
    newest = f"struct({', '.join(order)})"
    top = f"max({newest})" if not carried else f"max_by(struct({', '.join([GONE_COL, *map(_quoted, rest)])}), {newest})"
    keys = ", ".join(map(_quoted, state.keys))
    shown = ", ".join(_quoted(c) if c in state.keys else f"_top.{_quoted(c)} AS {_quoted(c)}" for c in state.columns)
    return f"SELECT {shown} FROM (SELECT {keys}, {top} AS _top FROM ({rows}) GROUP BY {keys}) WHERE NOT _top.{GONE_COL}"


def _view_sql(spark: SparkSession, table: str, state: State, parts: Sequence[str]) -> str:
    """The view's query. Of a keyed table, a base has one row per key: rows whose keys are in no part go through as they
    are (an anti join with the parts' keys, which are few), only the others are compared."""
    shown = ", ".join(map(_quoted, state.columns))
    base = _rows_sql(spark, table, state, [f"{BASE}{state.base}"])
    if not state.keys or not parts:
        return f"SELECT {shown} FROM ({' UNION ALL '.join([base, *([_rows_sql(spark, table, state, parts)] if parts else [])])})"
    new = _rows_sql(spark, table, state, parts)
    touched = "EXISTS (SELECT 1 FROM ({}) p WHERE {})".format(new, " AND ".join(f"p.{k} <=> b.{k}" for k in map(_quoted, state.keys)))
    old = f"SELECT {shown}, {SEQ_COL}, {GONE_COL} FROM ({base}) b WHERE {touched}"
    return (f"SELECT {shown} FROM ({base}) b WHERE NOT {touched} UNION ALL "
            + _newest_sql(spark, table, state, f"{new} UNION ALL {old}"))


def _publish(spark: SparkSession, table: str, state: State) -> None:
    """Let the view show the base and all parts that it does not cover; again if another writer added a part meanwhile."""
    text = json.dumps(asdict(state)).replace("\\", "\\\\").replace("'", "\\'")
    while True:
        parts = _parts(spark, table, state)
        spark.sql(f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ('{STATE_PROP}' = '{text}') AS "
                  + _view_sql(spark, table, state, parts))
        if _parts(spark, table, state) == parts:
            return


def _write_data(df: DataFrame, name: str, commit: int, partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """One write; the name is in the catalog when it is complete."""
    marks = {SEQ_COL: F.lit(commit)} if SEQ_COL not in df.columns else {}
    marks |= {GONE_COL: F.lit(False)} if GONE_COL not in df.columns else {}
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.withColumns(marks).write.mode("error").format(fmt)
    (w.partitionBy(*partition_by) if partition_by else w).saveAsTable(name)


def _replace(df: DataFrame, table: str, keys: Sequence[str] = (), order_by: Sequence[str] = (),
             partition_by: Sequence[str] = (), fmt: str = "parquet", folds: Sequence[str] | None = None,
             seen: dict | None = None) -> None:
    """A new base, and the view over it. It covers the parts that are there when the view is set, or only ``folds``."""
    spark = df.sparkSession
    before = state_of(spark, table)
    commit = _commit()
    columns = [c for c in df.columns if c not in (SEQ_COL, GONE_COL)]
    _write_data(df, f"{table}{BASE}{commit}", commit, partition_by, fmt)
    now, covered, lineage, seen = int(time.time()), {}, [], seen or {}
    if before is not None:
        if folds is not None:
            current = state_of(spark, table)
            if current is None or current.base != before.base:      # replaced, folded or dropped while this fold was written
                spark.sql(f"DROP TABLE IF EXISTS {table}{BASE}{commit}")
                return
            seen = current.seen
            lineage = [*before.lineage, [before.base, [int(e.rsplit("_", 1)[1]) for e in folds]]][-LINEAGE:]
        gone = _parts(spark, table, before) if folds is None else folds
        covered = before.covered | {e: now for e in [f"{BASE}{before.base}", *gone]}
    covered = _drop_old(spark, table, covered, now)
    _publish(spark, table, State(commit, columns, list(keys), list(order_by), list(partition_by), covered, lineage, seen))


def _drop_old(spark: SparkSession, table: str, covered: dict[str, int], now: int) -> dict[str, int]:
    """Drop data tables that were covered KEEP_SECONDS ago; returns the others."""
    old = [e for e, at in covered.items() if now - at >= KEEP_SECONDS]
    for e in old:
        spark.sql(f"DROP TABLE IF EXISTS {table}{e}")
    return {e: at for e, at in covered.items() if e not in old}


def vacuum(spark: SparkSession, table: str, older_than_seconds: int = 7 * 86_400) -> list[str]:
    """Drop bases that no view shows and that were begun so long ago (left by interrupted writes); returns their names.

    A write that is still going on must be younger. Parts need none of this: they are seen with the next commit.
    """
    state = state_of(spark, table)
    known = {f"{BASE}{state.base}", *state.covered}
    begun_before = (int((time.time() - older_than_seconds) * 1_000_000)) << 10
    left = [e for e in _data_tables(spark, table, BASE) if e not in known and int(e.rsplit("_", 1)[1]) < begun_before]
    for e in left:
        spark.sql(f"DROP TABLE IF EXISTS {table}{e}")
    return [f"{table}{e}" for e in left]


# ---------------------------------------------------------------- plain writes
def write_full(df: DataFrame, table: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Replace a table as a unit (one write of the data).

    The query may read the table it replaces. Partitioned writes go through a
    REBALANCE on the partition columns: rows of one partition value meet in few
    tasks (few files per directory) while AQE still splits a skewed value and
    merges small ones.
    """
    _replace(df, table, partition_by=partition_by, fmt=fmt)


def append(df: DataFrame, table: str, fold_every: int = FOLD_EVERY) -> None:
    """Add rows to a table as one commit, seen all at once; the first creates it.

    Only for tables without keys. After ``fold_every`` parts they are folded into the base.
    """
    spark = df.sparkSession
    state = state_of(spark, table)
    if state is None:
        ensure_schema_of(spark, table)
        write_full(df, table)
        return
    if state.keys:
        raise ValueError(f"{table} is keyed by {state.keys}; use upsert()")
    _add_part(spark, df, table, state, fold_every)


def _add_part(spark: SparkSession, df: DataFrame, table: str, state: State, fold_every: int = FOLD_EVERY,
              seen: dict | None = None) -> None:
    """One part: the table's columns, and the mark if ``df`` has it."""
    schema = spark.table(table).schema
    commit = _commit()
    gone = F.col(GONE_COL) if GONE_COL in df.columns else F.lit(False)
    rows = df.withColumn(GONE_COL, gone).select(*[_quoted(c) for c in state.columns], GONE_COL)
    _write_data(rows.to(StructType([*schema.fields, StructField(GONE_COL, BooleanType())])), f"{table}{PART}{commit}", commit)
    current = state_of(spark, table)
    if current is None:
        spark.sql(f"DROP TABLE IF EXISTS {table}{PART}{commit}")
        raise ValueError(f"{table} was dropped while rows were written to it")
    if seen is not None:
        current.seen = seen
    _publish(spark, table, current)
    if len(_parts(spark, table, current)) >= fold_every:
        compact(spark, table)


def adopt(spark: SparkSession, table: str) -> None:
    """Take over a plain table: its data get a name of their own, the public name becomes a view.

    This renames, so for a moment (or until the next call, if interrupted) readers do not find the name.
    """
    commit, kept = _commit(), _data_tables(spark, table, BASE)
    if spark.catalog.tableExists(table):
        if STATE_PROP in _properties(spark, table):
            return
        if SEQ_COL in spark.table(table).columns:
            raise ValueError(f"{table} has a column {SEQ_COL}")
        spark.sql(f"ALTER TABLE {table} RENAME TO {table}{BASE}{commit}")
    elif kept:
        commit = int(kept[-1].rsplit("_", 1)[1])
    else:
        raise ValueError(f"there is no table {table}")
    _publish(spark, table, State(commit, spark.table(f"{table}{BASE}{commit}").columns))


def show_folder(spark: SparkSession, table: str, path: str) -> None:
    """Let a name show a Parquet folder, or another one from now on; the folder's own files decide what is in it."""
    if spark.catalog.tableExists(table) and FOLDER_PROP not in _properties(spark, table):
        raise ValueError(f"{table} is a table, not a name for a folder")
    text = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ('{FOLDER_PROP}' = '{text}') AS SELECT * FROM parquet.{_quoted(path)}")


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def replace_from_query(spark: SparkSession, table: str, query, partition_by: Sequence[str] = ()) -> DataFrame:
    """Idempotent create-or-replace from a query (SQL text or DataFrame), which may read the table itself."""
    df = spark.sql(query) if isinstance(query, str) else query
    ensure_schema_of(spark, table)
    write_full(df, table, partition_by)
    return spark.table(table)


# ---------------------------------------------------------------- latest per key
def _orderable(dt) -> bool:
    from pyspark.sql import types as T

    unordered = (T.MapType,) + ((T.VariantType,) if hasattr(T, "VariantType") else ())
    if isinstance(dt, unordered):
        return False
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    return True


def latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], newest: bool = True) -> DataFrame:
    """O3: one row per key, the greatest (or least) by ``order_by``.

    Expressed as ``max(struct(order..., rest...))`` per key instead of a
    ``row_number`` window: max is a declarative aggregate, so Spark combines
    map-side (partial aggregate) before the shuffle and a hot key with a third
    of all rows costs one row per task, not one giant sorted partition. The
    remaining columns inside the struct break ties deterministically. Columns
    that cannot be ordered (maps) ride along through ``max_by``, which is a
    partial aggregate too.
    """
    keys, order_by = list(keys), list(order_by)
    types = {f.name: f.dataType for f in df.schema.fields}
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    fields = order_by + [c for c in rest if _orderable(types[c])]
    carried = [c for c in rest if not _orderable(types[c])]
    packed = F.struct(*[F.col(f"`{c}`") for c in fields])
    if carried:
        agg = (F.max_by if newest else F.min_by)(F.struct(*[F.col(f"`{c}`") for c in fields + carried]), packed)
    else:
        agg = F.max(packed) if newest else F.min(packed)
    out = df.groupBy(*keys).agg(agg.alias("_top"))
    return out.select(*keys, *[F.col("_top")[c].alias(c) for c in fields + carried]).select(*df.columns)


def dedupe_token(df: DataFrame, token: str, order_by: Sequence[str]) -> DataFrame:
    """T5: a repeated idempotency token yields one row (the first); NULL tokens are always kept."""
    firsts = latest(df.where(F.col(token).isNotNull()), [token], order_by, newest=False)
    return firsts.unionByName(df.where(F.col(token).isNull()))


# ---------------------------------------------------------------- upsert
def write_keyed(df: DataFrame, table: str, keys: Sequence[str], order_by: Sequence[str], seen: dict | None = None) -> None:
    """Full build of a keyed table: the newest row per key. ``order_by`` holds columns or SQL expressions of them."""
    ensure_schema_of(df.sparkSession, table)
    if set(order_by) <= set(df.columns):
        rows = latest(df, keys, order_by)
    else:
        names = [f"_o{i}" for i in range(len(order_by))]
        rows = latest(df.withColumns({n: F.expr(e) for n, e in zip(names, order_by)}), keys, names).select(*df.columns)
    _replace(rows, table, keys, order_by, seen=seen)


def upsert(spark: SparkSession, df: DataFrame, table: str, keys: Sequence[str], order_by: Sequence[str] = (),
           fold_every: int = FOLD_EVERY) -> DataFrame:
    """Keep the newest row per key; returns the table's rows.

    The batch is evaluated once and written as a part; nothing of the table is
    read. A batch that is applied twice changes nothing. On equal order values
    the later batch wins. A table of whole writes becomes keyed in the same
    call. After ``fold_every`` parts they are folded into the base.
    """
    keys, order_by = list(keys), list(order_by)
    state = state_of(spark, table)
    if state is None:
        write_keyed(df, table, keys, order_by)
        return spark.table(table)
    if not state.keys:
        write_keyed(spark.table(table), table, keys, order_by)
        state = state_of(spark, table)
    if state.keys != keys or state.order_by != order_by:
        raise ValueError(f"{table} is keyed by {state.keys}, ordered by {state.order_by}")
    _add_part(spark, df, table, state, fold_every)
    return spark.table(table)


def apply_changes(spark: SparkSession, changes: DataFrame, table: str, seen: dict | None = None) -> None:
    """Set and delete keys in one commit: rows with the table's columns and the mark ``_gone``.

    For tables that are ordered by commit alone. A key that is gone may come back with a later commit.
    """
    state = state_of(spark, table)
    if state is None or not state.keys or state.order_by:
        raise ValueError(f"{table} must be keyed, without order columns")
    _add_part(spark, changes, table, state, seen=seen)


def delete_keys(spark: SparkSession, gone: DataFrame, table: str) -> None:
    """Let keys (rows of key columns) vanish from a table that is ordered by commit alone."""
    state = state_of(spark, table)
    empty = {f.name: F.lit(None).cast(f.dataType) for f in spark.table(table).schema if f.name not in state.keys}
    apply_changes(spark, gone.withColumns({**empty, GONE_COL: F.lit(True)}), table)


def compact(spark: SparkSession, table: str) -> None:
    """Fold a table's parts into a new base.

    The fold covers the parts that it reads and no others, so a part that is
    added while the fold is written stays in the view. Rows keep their commit.
    """
    state = state_of(spark, table)
    parts = _parts(spark, table, state)
    if not parts:
        return
    rows = spark.sql(_rows_sql(spark, table, state, [f"{BASE}{state.base}", *parts]))
    if state.keys:
        names = [f"_o{i}" for i in range(len(state.order_by))]
        rows = rows.withColumns({n: F.expr(e) for n, e in zip(names, state.order_by)})
        rows = latest(rows, state.keys, [*names, SEQ_COL, GONE_COL]).where(f"NOT {GONE_COL}").drop(*names)
    _replace(rows, table, state.keys, state.order_by, state.partition_by, folds=parts)


def commits(spark: SparkSession, table: str) -> dict:
    """What a reader of the table has seen so far: pass it to ``changed_rows`` later."""
    state = state_of(spark, table)
    return {"base": state.base, "parts": [int(e.rsplit("_", 1)[1]) for e in _parts(spark, table, state)]}


def changed_rows(spark: SparkSession, table: str, seen: dict) -> DataFrame | None:
    """Rows that commits after ``seen`` wrote and, of a keyed table, all older versions of their keys.

    Folds in between are looked through by the commits that rows keep. None if
    that cannot be told any more: the table was written whole, or what was seen
    has been dropped.
    """
    state = state_of(spark, table)
    parts = _parts(spark, table, state)
    new = [int(e.rsplit("_", 1)[1]) for e in parts]
    ends = [f"{BASE}{state.base}", *parts]
    if state.base != seen["base"]:
        at = [k for k, (base, _) in enumerate(state.lineage) if base == seen["base"]]
        if not at:
            return None
        new += [c for _, folded in state.lineage[at[0]:] for c in folded]
        old = [f"{BASE}{seen['base']}", *(f"{PART}{c}" for c in seen["parts"])]
        if state.keys:       # versions that a fold has dropped are in the tables that were seen
            if any(not spark.catalog.tableExists(f"{table}{e}") for e in old):
                return None
            ends += [e for e in old if e not in ends]
    new = sorted(set(new) - set(seen["parts"]))
    rows = spark.sql(_rows_sql(spark, table, state, ends))
    fresh = rows.where(F.col(SEQ_COL).isin(new)) if new else rows.limit(0)
    if state.keys:
        touched = fresh.select(*[F.col(_quoted(k)).alias(f"_k{i}") for i, k in enumerate(state.keys)]).distinct()
        same = [F.col(_quoted(k)).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(state.keys)]
        fresh = rows.join(touched, same, "left_semi").where(f"NOT {GONE_COL}")
    return fresh.select([_quoted(c) for c in state.columns])


# ---------------------------------------------------------------- run records
def write_observed(df: DataFrame, table: str, ok_expr=None, mode: str = "overwrite",
                   partition_by: Sequence[str] = ()) -> dict:
    """Write once and count rows (and successes) during that same job.

    ``DataFrame.observe`` computes the metrics as the write streams by, so no
    second and third job re-read the table.
    """
    obs = Observation("write")
    metrics = [F.count(F.lit(1)).alias("rows")]
    if ok_expr is not None:
        metrics.append(F.count_if(ok_expr).alias("success"))
    observed = df.observe(obs, *metrics)
    if mode == "overwrite":
        write_full(observed, table, partition_by)
    elif mode == "append":
        append(observed, table)
    else:
        raise ValueError("mode must be 'overwrite' or 'append'")
    m = dict(obs.get)
    out = {"rows": int(m["rows"]), "table": table}
    if ok_expr is not None:
        out["success"] = int(m["success"])
        out["failure"] = out["rows"] - out["success"]
    return out


RUNS_SCHEMA = ("run_name string, run_id string, rows bigint, success bigint, failure bigint, "
               "skipped boolean, table_name string, metrics string, recorded_at timestamp")


def append_run(spark: SparkSession, runs_table: str, run_name: str, record: dict,
               run_id: str | None = None) -> None:
    """Append one run record (a single small row) to the runs table."""
    row = (run_name, run_id, record.get("rows"), record.get("success"), record.get("failure"),
           bool(record.get("skipped", False)), record.get("table"),
           json.dumps({k: v for k, v in record.items()
                       if k not in ("rows", "success", "failure", "skipped", "table")}, sort_keys=True))
    df = spark.createDataFrame([row], RUNS_SCHEMA.rsplit(",", 1)[0]).withColumn(
        "recorded_at", F.current_timestamp())
    ensure_schema_of(spark, runs_table)
    df.write.mode("append").saveAsTable(runs_table)


# ---------------------------------------------------------------- catalog
def drop_table(spark: SparkSession, table: str) -> None:
    """Drop a table with all its data, also what an interrupted write left; it does not come back."""
    if spark.catalog.tableExists(table):
        view = {STATE_PROP, FOLDER_PROP} & set(_properties(spark, table))
        spark.sql(f"DROP {'VIEW' if view else 'TABLE'} IF EXISTS {table}")
    for end in _data_tables(spark, table):
        spark.sql(f"DROP TABLE IF EXISTS {table}{end}")


def inventory(spark: SparkSession, schema: str) -> DataFrame:
    """Tables of a schema (one row per public name), as the catalog lists them; data tables are left out."""
    shown = spark.sql(f"SHOW TABLES IN {schema}")
    return shown.where(~F.col("tableName").rlike(f"({BASE}|{PART})[0-9]+$")).select(
        F.col("namespace").alias("schema_name"), F.col("tableName").alias("name"), F.col("isTemporary").alias("is_temporary"))


def snapshot(spark: SparkSession, table: str) -> DataFrame:
    """Metadata snapshot of one table with the time it was observed; its format is that of its base."""
    view = STATE_PROP in _properties(spark, table)
    data = f"{table}{BASE}{state_of(spark, table).base}" if view else table
    meta = spark.sql(f"DESCRIBE TABLE EXTENDED {data} AS JSON")
    j = F.col(meta.columns[0])
    cat, sch, name = split_name(table)
    return meta.select(
        F.lit(table).alias("full_name"),
        F.lit(name).alias("name"),
        F.get_json_object(j, "$.catalog_name").alias("catalog"),
        F.get_json_object(j, "$.namespace[0]").alias("schema_name"),
        F.get_json_object(j, "$.type").alias("table_type"),
        F.get_json_object(j, "$.provider").alias("format"),
        F.get_json_object(j, "$.owner").alias("owner"),
        F.current_timestamp().alias("observed_at"),
    )
