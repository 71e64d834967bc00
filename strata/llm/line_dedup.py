"""Line dedup: lines found in many documents leave every document (DataFrame functions only).

Lines are exploded with their position, normalised and hashed; the distinct
documents of each hash are counted (partial sums per task, so a line held by a
third of all documents costs one row per task); lines of hashes over the
threshold are dropped and the rest is reassembled by position.

Only (document, position, hash) rows are exploded, written once for both uses
and shuffled, never the line texts. A line is known by 96 bits of hash (xxhash64 and murmur3) and its length.

Defined cases: a null or empty text is one empty line and stays; rows repeated
with equal id and text count as one document and get equal results, one per
row; rows with equal id but other text are one document for the count; null
ids are a document of their own; other columns pass through untouched, whatever
their names; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SPACES, ascii_lower, stage, unused

MIN_DOCS = 10
MIN_CHARS = 1
SALTS = 8           # parts that the rows of one hash are joined in


def _lines(c):
    return F.split(F.coalesce(c, F.lit("")), "\n", -1)


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` plus kept_text, n_lines and n_dropped.

    Where ``docs`` has a column of such a name, the new one gets underscores before its name.
    """
    kept_text, n_lines, n_dropped, rid, rth, drop, split = unused(
        docs, "kept_text", "n_lines", "n_dropped", "drop_id", "drop_hash", "drop", "split")
    own = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    base = docs.select(F.col(id_col).alias("id"), own.alias("th"), _lines(F.col(text_col)).alias("lines"))
    lines = base.select("id", "th", F.posexplode("lines").alias("pos", "line"))
    key = ascii_lower(F.btrim("line", F.lit(SPACES)))
    lines = lines.select("id", "th", "pos", key.alias("key")).where(F.length("key") >= min_chars)
    lines = lines.select("id", "th", "pos", F.xxhash64("key").alias("h"),
                         F.hash("key").alias("h2"), F.length("key").alias("n"))
    lines = stage(docs.sparkSession, lines, "lines")
    often = (lines.select("h", "h2", "n", "id").distinct().groupBy("h", "h2", "n")
             .agg(F.count(F.lit(1)).alias("docs")).where(F.col("docs") >= min_docs).drop("docs"))
    # Salted, so that a line of very many documents is joined in several tasks.
    often = often.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    lines = lines.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    gone = (lines.join(often, ["h", "h2", "n", "salt"], "left_semi")
            .groupBy(F.col("id").alias(rid), F.col("th").alias(rth)).agg(F.collect_set("pos").alias(drop)))
    joined = docs.join(gone, F.col(id_col).eqNullSafe(F.col(rid)) & (own == F.col(rth)), "left")
    places = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col(drop))       # by a hash set, in order
    kept = F.transform(places, lambda i: F.get(F.col(split), i))
    return (joined.withColumn(split, _lines(F.col(text_col)))
            .withColumn(kept_text, F.when(F.col(drop).isNull(), F.coalesce(F.col(text_col), F.lit("")))
                        .otherwise(F.array_join(kept, "\n")))
            .withColumn(n_lines, F.size(split).cast("long"))
            .withColumn(n_dropped, F.coalesce(F.size(drop), F.lit(0)).cast("long"))
            .drop(rid, rth, drop, split))


def drop_lines(docs: DataFrame, text_col: str = "text", **kw) -> DataFrame:
    """``docs`` with shared lines gone from the text; null texts become empty, the columns stay."""
    kept, = unused(docs, "kept_text")
    out = dedup_lines(docs, text_col=text_col, **kw)
    return out.select(*[F.col(kept).alias(c) if c == text_col else F.col(c) for c in docs.columns])


def op6_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH l AS (
  SELECT doc_id, unnest(range(len(a))) AS pos, unnest(a) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents)),
k AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT k.*, f.key IS NOT NULL AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
