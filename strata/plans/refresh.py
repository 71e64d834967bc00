"""Refresh a set of declared tables (full, selective full, or incremental)."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import tables as TB
from strata.session import scratch_dir


@dataclass
class Declared:
    """A declared table: ``build(spark, tables)`` returns its DataFrame.

    ``inputs`` names the tables it reads: declared ones (which are refreshed
    first) or full names. With
    ``keys``/``order_by`` an incremental refresh upserts; without them
    incremental equals full.

    ``changes(spark, tables, mark)`` builds only what input from ``mark`` on
    changes, where ``mark`` is the greatest value of the ``mark`` column in the
    table: an incremental refresh then reads new input alone. The mark must grow
    as input arrives (a commit id, not a date in the rows): input that arrives
    later with a smaller mark is not read before a full refresh. (A row's key must
    not leave the input; rows that did go with a full refresh.)

    ``affected`` needs no mark: for each input table it gives SQL expressions of
    an input row that make the keys (in their order) of the target rows it goes
    into. The target remembers which commits of its inputs it was built from. An
    incremental refresh takes the rows of later commits, with the older versions
    of the same input keys, derives the target keys they touch, builds those
    keys from all their input rows (a semi join on the keys) and deletes the ones
    that have no input left. So input may arrive in any order, for any key, and
    may leave a key. Inputs must be tables of this layer, and ``build`` must read
    them by ``names[input]``. If an input was written whole since, or one without
    expressions has changed, the refresh is full.

    Without either, an incremental refresh builds all and upserts it.
    """
    name: str
    build: Callable[[SparkSession, dict], DataFrame]
    inputs: Sequence[str] = field(default_factory=tuple)
    keys: Sequence[str] = field(default_factory=tuple)
    order_by: Sequence[str] = field(default_factory=tuple)
    comment: str = ""
    mark: str | None = None
    changes: Callable[[SparkSession, dict, object], DataFrame] | None = None
    affected: dict[str, Sequence[str]] = field(default_factory=dict)

    def __post_init__(self):
        if self.affected and (not self.keys or self.order_by or self.changes):
            raise ValueError("a table with affected keys needs keys and has neither order columns nor changes")
        if set(self.affected) - set(self.inputs):
            raise ValueError("affected keys must be of inputs")


def refresh_order(tables: Sequence[Declared]) -> list[Declared]:
    by = {t.name: t for t in tables}
    done, out = set(), []
    while len(out) < len(tables):
        ready = [n for n in by if n not in done and all(i in done or i not in by for i in by[n].inputs)]
        if not ready:
            raise ValueError("cycle among declared tables")
        for n in sorted(ready):
            done.add(n)
            out.append(by[n])
    return out


def touched_keys(spark: SparkSession, t: Declared, names: dict[str, str], seen: dict) -> DataFrame | None:
    """Distinct target keys that input commits after ``seen`` touch; None if only a full build can tell."""
    out = None
    for i in t.inputs:
        if i not in seen:
            return None
        if i not in t.affected:
            if TB.commits(spark, names[i]) != seen[i]:
                return None
            continue
        rows = TB.changed_rows(spark, names[i], seen[i])
        if rows is None:
            return None
        keys = rows.select(*[F.expr(e).alias(f"_k{n}") for n, e in enumerate(t.affected[i])])
        out = keys if out is None else out.unionByName(keys)
    return out.distinct()


def rows_of_keys(rows: DataFrame, expressions: Sequence[str], touched: DataFrame) -> DataFrame:
    """The rows that go into touched target keys: a semi join on the keys."""
    same = [F.expr(e).eqNullSafe(F.col(f"_k{n}")) for n, e in enumerate(expressions)]
    return rows.join(touched, same, "left_semi")


def _refresh_affected(spark: SparkSession, t: Declared, names: dict[str, str], target: str) -> bool:
    """Rebuild the touched keys; False if a full build is needed."""
    now = {i: TB.commits(spark, names[i]) for i in t.inputs}
    touched = touched_keys(spark, t, names, TB.state_of(spark, target).seen)
    if touched is None:
        return False
    path = scratch_dir(spark, "touched")
    touched.write.parquet(path)
    touched = spark.read.schema(touched.schema).parquet(path)
    own, views = dict(names), []
    try:
        for i, expressions in t.affected.items():
            own[i] = f"_touched_{uuid.uuid4().hex[:12]}"
            rows_of_keys(spark.table(names[i]), expressions, touched).createOrReplaceTempView(own[i])
            views.append(own[i])
        built = t.build(spark, own).withColumn(TB.GONE_COL, F.lit(False))
        same = [F.col(k).eqNullSafe(F.col(f"_k{n}")) for n, k in enumerate(t.keys)]
        keys = [F.col(f"_k{n}").alias(k) for n, k in enumerate(t.keys)]
        rest = [c for c in built.columns if c not in (*t.keys, TB.GONE_COL)]
        changes = touched.join(built, same, "left").select(*keys, *rest, F.coalesce(TB.GONE_COL, F.lit(True)).alias(TB.GONE_COL))
        TB.apply_changes(spark, changes, target, seen=now)
    finally:
        for v in views:
            spark.catalog.dropTempView(v)
    return True


def refresh(spark: SparkSession, tables: Sequence[Declared], schema: str, full: bool = False,
            full_for: Sequence[str] = (), only: Sequence[str] = ()) -> dict[str, str]:
    """Refresh declared tables in input order; tables are never dropped.

    ``full`` rebuilds all; ``full_for`` rebuilds a subset fully (others run
    incrementally); ``only`` restricts the run to a subset. Returns
    name -> mode used.
    """
    if full and (full_for or only):
        raise ValueError("full refresh excludes a selection")
    done: dict[str, str] = {}
    names = {i: i for t in tables for i in t.inputs} | {t.name: f"{schema}.{t.name}" for t in tables}
    for t in refresh_order(tables):
        if only and t.name not in only and t.name not in full_for:
            continue
        target = names[t.name]
        mark = None
        incremental = t.keys and not full and t.name not in full_for and TB.table_exists(spark, target)
        if incremental and t.affected:
            incremental = _refresh_affected(spark, t, names, target)
        elif incremental:
            if t.changes and t.mark:
                mark = spark.table(target).agg(F.max(t.mark)).first()[0]      # one value
            df = t.build(spark, names) if mark is None else t.changes(spark, names, mark)
            TB.upsert(spark, df, target, t.keys, t.order_by)
        if not incremental:
            seen = {i: TB.commits(spark, names[i]) for i in t.inputs} if t.affected else None     # before the rows are read
            df = t.build(spark, names)
            if t.keys:
                TB.write_keyed(df, target, t.keys, t.order_by, seen=seen)
            else:
                TB.replace_from_query(spark, target, df)
        done[t.name] = "incremental" if incremental else "full"
    return done
