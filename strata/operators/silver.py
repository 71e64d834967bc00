"""Silver: typed projection of raw JSON (P2, P3, P5) and its quality profile.

One ``from_json`` parses each document once, into a struct as deep as the paths
asked for and with text at its leaves; every field is then cast on its own
(``try_cast`` by default, ``cast`` when strict). The struct is kept in its own
projection: inlined into one projection, Catalyst would split it into one parse
per field.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.bronze import ok_rows


@dataclass(frozen=True)
class Field:
    path: str          # top-level JSON key, or a path: $.a.b[0].c, $['a key'][2]
    type: str          # Spark SQL type name, or "json" to keep nested text (P3)
    alias: str


def spec(*triples: Sequence[str]) -> list[Field]:
    return [Field(*t) for t in triples]


PATH_STEP = re.compile(r"\.([^.\[\]']+)|\[([0-9]+)\]|\['([^']+)'\]")


def path_steps(path: str) -> list[str | int]:
    """Keys and array places of a path; without ``$`` it is one key."""
    if not path.startswith("$"):
        return [path]
    steps, at = [], 1
    while at < len(path):
        m = PATH_STEP.match(path, at)
        if not m:
            raise ValueError(f"bad path {path!r} at {path[at:]!r}")
        steps.append(int(m[2]) if m[2] else m[1] or m[3])
        at = m.end()
    if not steps or isinstance(steps[0], int):
        raise ValueError(f"path {path!r} must begin with a key")
    return steps


@dataclass
class Node:
    """What is asked for below a place in the documents."""
    text: bool = False                     # the place itself, as text
    kids: dict = field(default_factory=dict)

    def add(self, steps: list) -> None:
        if steps:
            self.kids.setdefault(steps[0], Node()).add(steps[1:])
        else:
            self.text = True

    def element(self) -> Node:
        """Of an array: all that is asked of its elements, wherever they stand."""
        out = Node()
        for kid in self.kids.values():
            out.text |= kid.text
            for k, n in kid.kids.items():
                out.kids.setdefault(k, Node()).merge(n)
        return out

    def merge(self, other: Node) -> None:
        self.text |= other.text
        for k, n in other.kids.items():
            self.kids.setdefault(k, Node()).merge(n)

    def inner_type(self) -> str:
        """The type that holds the kids."""
        if all(isinstance(k, int) for k in self.kids):
            return f"array<{self.element().type()}>"
        if any(isinstance(k, int) for k in self.kids):
            raise ValueError("one place is asked for as an object and as an array")
        return "struct<" + ", ".join(f"`{k.replace('`', '``')}`: {n.type()}" for k, n in self.kids.items()) + ">"

    def type(self) -> str:
        return "string" if self.text or not self.kids else self.inner_type()

    def reach(self, column: Column, steps: list) -> Column:
        """The text at ``steps`` below ``column``, which holds this place."""
        if not steps:
            return column
        if self.text:       # wanted as text too, so what lies below is read from the text
            column = F.from_json(column, self.inner_type())
        if isinstance(steps[0], int):
            return self.element().reach(F.get(column, F.lit(steps[0])), steps[1:])
        return self.kids[steps[0]].reach(column[steps[0]], steps[1:])


def paths(fields: Iterable[Field]) -> Node:
    root = Node()
    for f in fields:
        root.add(path_steps(f.path))
    return root


def _typed(raw: Column, f: Field, strict: bool) -> Column:
    if f.type in ("json", "string"):
        return raw
    if f.type in ("int", "integer") and not strict:
        # plain integer text only, so "1.50" or "1e3" never silently truncate
        s = F.trim(raw)
        return F.when(s.rlike(r"^[+-]?[0-9]+\z"), s.try_cast("int"))
    return raw.cast(f.type) if strict else raw.try_cast(f.type)


def parse_raw(df: DataFrame, fields: Sequence[Field], json_col: str = "raw_json") -> Column:
    return F.from_json(F.col(json_col), paths(fields).inner_type())


def project_json(df: DataFrame, fields: Sequence[Field], json_col: str = "raw_json",
                 keep: Sequence[str] = (), strict: bool = False) -> DataFrame:
    """Keep columns + one typed column per spec field; a place that a document does not have is null."""
    parsed, root = df.select(*keep, parse_raw(df, fields, json_col).alias("_j")), paths(fields)
    cols = [_typed(root.reach(F.col("_j"), path_steps(f.path)), f, strict).alias(f.alias) for f in fields]
    return parsed.select(*keep, *cols)


def silver(bronze: DataFrame, fields: Sequence[Field], key: str = "object_id",
           keep: Sequence[str] = ("ingested_at",), strict: bool = False) -> DataFrame:
    """Bronze -> Silver: success filter, then the typed projection."""
    return project_json(ok_rows(bronze), fields, keep=[key, *keep], strict=strict)


def passthrough(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    """P5: every column plus aliased copies (``ingested_at AS silver_ingested_at``)."""
    return df.select("*", *[F.col(src).alias(dst) for src, dst in renames.items()])


def cast_profile(df: DataFrame, casts: dict[str, str]) -> DataFrame:
    """A7 core: per column, rows, NULL inputs and cast failures (non-NULL in, NULL out).

    One aggregation pass; the result is unpivoted to one row per column.
    """
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for c, t in casts.items():
        typed = _typed(F.col(c).cast("string"), Field(c, t, c), strict=False)
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"{c}__nulls"))
        aggs.append(F.count_if(F.col(c).isNotNull() & typed.isNull()).alias(f"{c}__fail"))
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}__nulls`, `{c}__fail`" for c in casts)
    return wide.selectExpr(
        f"stack({len(casts)}, {stack}) as (column_name, null_count, cast_failures)", "_rows as row_count")


def silver_quality(bronze: DataFrame, fields: Sequence[Field], json_col: str = "raw_json") -> DataFrame:
    """Cast-failure and null profile of a Silver projection over Bronze."""
    raw = ok_rows(bronze).select(parse_raw(bronze, fields, json_col).alias("_j"))
    root = paths(fields)
    flat = raw.select(*[root.reach(F.col("_j"), path_steps(f.path)).alias(f.alias) for f in fields])
    return cast_profile(flat, {f.alias: f.type for f in fields})


def refresh_silver(spark, bronze_table: str, silver_table: str, fields: Sequence[Field],
                   key: str = "object_id", ts: str = "ingested_at", strict: bool = False) -> dict:
    """Incremental Silver: project only Bronze rows that are newer than Silver's row of the same key.

    What Silver already has is found by a join on the key over two narrow
    columns of either table, not by one high-water mark: rows of a long pull
    that commits after a shorter, later one are older than the mark but new to
    Silver. New rows are upserted on the key, newest ``ts`` winning, so
    re-running after a failure is harmless. The first run builds Silver in full.
    """
    from strata.operators.tables import table_exists, upsert

    bronze = spark.table(bronze_table)
    if table_exists(spark, silver_table):
        have = spark.table(silver_table).select(F.col(key).alias("_have"), F.col(ts).alias("_have_ts"))
        bronze = (bronze.join(have, F.col(key).eqNullSafe(F.col("_have")), "left")
                  .where(F.col("_have_ts").isNull() | (F.col(ts) > F.col("_have_ts"))).drop("_have", "_have_ts"))
    rows = silver(bronze, fields, key=key, keep=(ts,), strict=strict)
    upsert(spark, rows, silver_table, [key], [ts])
    return {"table": silver_table}
