"""Q5: SQL model sets run in dependency order, then data tests as counting queries."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.tables import replace_from_query

REF = re.compile(r"\{\{\s*ref\(\s*['\"]([A-Za-z0-9_]+)['\"]\s*\)\s*\}\}")


@dataclass
class Model:
    name: str
    sql: str                      # may use {{ ref('other_model') }}
    tags: Sequence[str] = field(default_factory=tuple)

    @property
    def refs(self) -> list[str]:
        return REF.findall(self.sql)


def order_models(models: Sequence[Model]) -> list[Model]:
    """Dependency order (Kahn); a cycle is an error."""
    by = {m.name: m for m in models}
    deps = {m.name: [r for r in m.refs if r in by] for m in models}
    done, out = set(), []
    while len(out) < len(models):
        ready = [n for n in by if n not in done and all(d in done for d in deps[n])]
        if not ready:
            raise ValueError(f"model cycle among {sorted(set(by) - done)}")
        for n in sorted(ready):
            done.add(n)
            out.append(by[n])
    return out


def select_models(models: Sequence[Model], select: str | None) -> list[Model]:
    """``tag:x`` selects by tag, ``name`` by name, ``name+`` adds its downstream models."""
    if not select:
        return list(models)
    if select.startswith("tag:"):
        t = select[4:]
        return [m for m in models if t in m.tags]
    down = select.endswith("+")
    root = select.rstrip("+")
    chosen = {root}
    if down:
        changed = True
        while changed:
            changed = False
            for m in models:
                if m.name not in chosen and any(r in chosen for r in m.refs):
                    chosen.add(m.name)
                    changed = True
    return [m for m in models if m.name in chosen]


def run_models(spark: SparkSession, models: Sequence[Model], schema: str, select: str | None = None) -> list[str]:
    """Build each selected model as a table ``schema.name`` in dependency order."""
    built = []
    chosen = {m.name for m in select_models(models, select)}
    for m in order_models(models):
        if m.name not in chosen:
            continue
        sql = REF.sub(lambda mt: f"{schema}.{mt.group(1)}", m.sql)
        replace_from_query(spark, f"{schema}.{m.name}", sql)
        built.append(m.name)
    return built


@dataclass
class Test:
    kind: str                     # not_null | unique | accepted_values | relationships
    table: str
    column: str
    values: Sequence = ()
    to_table: str | None = None
    to_column: str | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.table.split('.')[-1]}_{self.column}"


def test_frame(spark: SparkSession, t: Test) -> DataFrame:
    """Failing-row count of one test, as a one-row DataFrame."""
    df = spark.table(t.table)
    c = F.col(t.column)
    if t.kind == "not_null":
        bad = df.where(c.isNull()).agg(F.count(F.lit(1)).alias("failures"))
    elif t.kind == "unique":
        bad = (df.where(c.isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("k"))
               .where(F.col("k") > 1).agg(F.count(F.lit(1)).alias("failures")))
    elif t.kind == "accepted_values":
        bad = df.where(c.isNotNull() & ~c.isin(*t.values)).agg(F.count(F.lit(1)).alias("failures"))
    elif t.kind == "relationships":
        parent = spark.table(t.to_table).select(F.col(t.to_column).alias(t.column))
        bad = (df.where(c.isNotNull()).select(t.column).join(parent, t.column, "left_anti")
               .agg(F.count(F.lit(1)).alias("failures")))
    else:
        raise ValueError(f"unknown test kind {t.kind}")
    return bad.select(F.lit(t.name).alias("test_name"), F.col("failures").cast("bigint").alias("failures"))


def test_models(spark: SparkSession, tests: Sequence[Test]) -> DataFrame:
    """All tests as one DataFrame (test_name, failures, passed)."""
    out = None
    for t in tests:
        f = test_frame(spark, t)
        out = f if out is None else out.unionByName(f)
    return out.withColumn("passed", F.col("failures") == 0)
