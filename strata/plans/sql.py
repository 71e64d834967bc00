"""User SQL (Q1-Q4): statements, saved queries, SQL files, for-each as a join."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.tables import write_full

QUERIES_SCHEMA = "name string, query_text string, description string, tags array<string>"


def run_sql(spark: SparkSession, statement: str, catalog: str | None = None, schema: str | None = None,
            row_limit: int | None = None, params: dict | None = None) -> DataFrame:
    """Q1: run one statement with named parameters (``:p``) and an optional row limit.

    A default catalog/schema holds while the statement is resolved, in the
    caller's session (so its views and settings count), and is set back after.
    Failures raise.
    """
    before = spark.catalog.currentCatalog(), spark.catalog.currentDatabase()
    try:
        if catalog:
            spark.catalog.setCurrentCatalog(catalog)
        if schema:
            spark.catalog.setCurrentDatabase(schema)
        df = spark.sql(statement, args=params or None)
    finally:
        if catalog or schema:
            spark.catalog.setCurrentCatalog(before[0])
            spark.catalog.setCurrentDatabase(before[1])
    if row_limit is not None:
        if row_limit < 0:
            raise ValueError("row_limit must be >= 0")
        df = df.limit(row_limit)
    return df


class SavedQueries:
    """Q2: named SQL text with description and tags, kept in a table."""

    def __init__(self, spark: SparkSession, table: str):
        self.spark, self.table = spark, table

    def register(self, name: str, query_text: str, description: str = "", tags=()) -> None:
        row = self.spark.createDataFrame([(name, query_text, description, list(tags))], QUERIES_SCHEMA)
        if self.spark.catalog.tableExists(self.table):
            keep = self.spark.table(self.table).where(F.col("name") != name)
            row = keep.unionByName(row)
        write_full(row, self.table)

    def text(self, name: str) -> str:
        rows = self.spark.table(self.table).where(F.col("name") == name).select("query_text").take(1)
        if not rows:
            raise KeyError(name)
        return rows[0][0]

    def run(self, name: str, params: dict | None = None, row_limit: int | None = None) -> DataFrame:
        return run_sql(self.spark, self.text(name), params=params, row_limit=row_limit)


# What a SQL text is made of as far as we look: literals and quoted names, comments, ends of statements, parameters.
TOKEN = re.compile(r"""('(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.)*"|`(?:[^`]|``)*`)|(--[^\n]*|/\*.*?\*/)|(;)|(?<![:\w]):([A-Za-z_]\w*)""", re.S)


def split_statements(text: str) -> list[str]:
    """Statements of a SQL text, separated by ``;`` outside literals; comments dropped."""
    out, cur, at = [], "", 0
    for m in TOKEN.finditer(text):
        cur += text[at:m.start()]
        at = m.end()
        if m[3]:
            out.append(cur)
            cur = ""
        elif not m[2]:
            cur += m[0]
    return [s.strip() for s in [*out, cur + text[at:]] if s.strip()]


def parameters(statement: str) -> set[str]:
    """Names of the ``:name`` markers of a statement (not those inside literals)."""
    return {m[4] for m in TOKEN.finditer(statement) if m[4]}


def run_sql_file(spark: SparkSession, path: str, params: dict | None = None) -> DataFrame | None:
    """Q3: run a SQL file; parameters bind as named markers, never spliced into text.

    Table names go through ``IDENTIFIER(:name)``. Returns the last result.
    """
    text = spark.read.text(path, wholetext=True).first()[0]
    last = None
    for stmt in split_statements(text):
        used = {k: v for k, v in (params or {}).items() if k in parameters(stmt)}
        last = spark.sql(stmt, args=used or None)
    return last


def for_each(spark: SparkSession, inputs: DataFrame, statement: str) -> DataFrame:
    """Q4: a statement with ``:name`` parameters, run for every row of ``inputs`` at once.

    Each marker becomes the input row's column of that name and the statement a
    lateral subquery, so N parameter sets are one join and one job. The result
    has the columns of ``inputs``, then those of the statement; an input whose
    statement returns no row gives none.
    """
    missing = parameters(statement) - set(inputs.columns)
    if missing:
        raise ValueError(f"the inputs lack {sorted(missing)}")
    body = TOKEN.sub(lambda m: f"_inputs.`{m[4]}`" if m[4] else m[0], statement.strip().rstrip(";"))
    return spark.sql(f"SELECT _inputs.*, _each.* FROM {{inputs}} AS _inputs, LATERAL ({body}) AS _each", inputs=inputs)
