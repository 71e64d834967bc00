"""Token counts: an exact histogram of encoded lengths, and what its suffix sums answer.

Documents are encoded once and only their lengths leave the tasks, counted per
task before the shuffle. For every length L that occurs, one row tells how many
documents and tokens lie at, below and above it; ``truncated`` and ``quantiles``
answer any context limit from that table alone.

Suffix sums run in two levels (blocks of lengths, then inside a block), so no
task needs all rows whatever the longest document.

Defined cases: a null or empty text has no tokens but the end id, if one is
asked for; repeated rows each count; an empty table has an empty histogram.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import doc_columns, stage
from strata.llm.tokens import word_tokenizer

BLOCK = 256     # lengths summed together in the first level


def token_lengths(docs: DataFrame, path: str | None = None, end_id: int | None = 1) -> DataFrame:
    """doc_id, n_tokens of every row."""
    path = path or word_tokenizer()

    def count(batches):
        import numpy as np
        import pyarrow as pa

        from strata.llm.tokens import encoded

        for rows, _ids, bounds in encoded(batches, path, end_id):
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(np.diff(bounds), pa.int64())],
                                             names=["doc_id", "n_tokens"])

    docs = doc_columns(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(count, f"doc_id {kind}, n_tokens long")


def histogram(lengths: DataFrame) -> DataFrame:
    """n_tokens, docs: how many documents have each length."""
    return lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("docs"))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """The histogram plus, per length L:

    docs_over, tokens_over: documents longer than L and their tokens;
    tokens_total: tokens of all documents; tokens_kept: tokens left if each
    document is cut at L; share: documents of at most L tokens, of all.
    """
    h = hist.withColumn("block", F.floor(F.col("n_tokens") / BLOCK)).withColumn("tokens", F.col("docs") * F.col("n_tokens"))
    blocks = h.groupBy("block").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    later = Window.partitionBy(F.lit(0)).orderBy(F.desc("block"))
    before = later.rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("block", F.coalesce(F.sum("d").over(before), F.lit(0)).alias("d_after"),
                           F.coalesce(F.sum("t").over(before), F.lit(0)).alias("t_after"),
                           F.sum("d").over(Window.partitionBy(F.lit(0))).alias("d_all"),
                           F.sum("t").over(Window.partitionBy(F.lit(0))).alias("t_all"))
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    over_d = F.coalesce(F.sum("docs").over(inside), F.lit(0)) + F.col("d_after")
    over_t = F.coalesce(F.sum("tokens").over(inside), F.lit(0)) + F.col("t_after")
    return (h.join(blocks, "block").withColumn("docs_over", over_d).withColumn("tokens_over", over_t)
            .select("n_tokens", "docs", "docs_over", "tokens_over", F.col("t_all").alias("tokens_total"),
                    (F.col("t_all") - F.col("tokens_over") + F.col("docs_over") * F.col("n_tokens")).alias("tokens_kept"),
                    ((F.col("d_all") - F.col("docs_over")) / F.col("d_all")).alias("share")))


def truncated(sums: DataFrame, limits: list[int]) -> DataFrame:
    """limit, docs_cut, tokens_kept: what any context limit keeps, from the table of ``suffix_sums``.

    For a limit between two lengths, the nearest length below it (0 if none) gives the suffix.
    """
    spark = sums.sparkSession
    asked = spark.createDataFrame([(int(x),) for x in limits], "limit long")
    whole = sums.agg(F.max("tokens_total").alias("t_all"), F.sum("docs").alias("d_all"))
    below = (asked.join(sums.select("n_tokens", "docs_over", "tokens_over"), F.col("n_tokens") <= F.col("limit"), "left")
             .groupBy("limit").agg(F.max_by(F.struct("docs_over", "tokens_over"), "n_tokens").alias("s")))
    return below.join(whole).select(
        "limit", F.coalesce("s.docs_over", "d_all").alias("docs_cut"),
        (F.col("t_all") - F.coalesce("s.tokens_over", "t_all")
         + F.coalesce("s.docs_over", "d_all") * F.col("limit")).alias("tokens_kept"))


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """share, n_tokens: the smallest length that at least this share of documents does not exceed."""
    asked = sums.sparkSession.createDataFrame([(float(x),) for x in shares], "asked double")
    return (asked.join(sums.select("n_tokens", "share"), F.col("share") >= F.col("asked"))
            .groupBy(F.col("asked").alias("share")).agg(F.min("n_tokens").alias("n_tokens")))


def op8_token_counts(spark, sf_dir: str) -> DataFrame:
    """The histogram is written, a row per length, so that its two uses do not encode the documents twice."""
    hist = histogram(token_lengths(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    return suffix_sums(stage(spark, hist, "lengths"))
