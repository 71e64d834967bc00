"""Document fingerprints: bottom-k sketches of word shingles (DataFrame functions only).

A sketch is the ascending array of the ``k`` smallest distinct 64-bit hashes of
a text's shingles (``size`` consecutive words, lower-cased; a shorter text is
one shingle). It depends on the set of shingles only, so sketches of parts
merge to the sketch of the whole, and equal texts have equal sketches.

* ``merge``: the k smallest of two sketches.
* ``resemblance``: share of the k smallest of the union that lie in both.
* ``distinct_count``: exact below k, else (k - 1) / (kth smallest, scaled to 0..1).
* ``containment``: how much of A lies in B, from resemblance and counts.

Defined cases: a null text is empty; an empty sketch resembles an empty one
with 1 and any other with 0; long texts are one row's array, never a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import SPACES, doc_columns, hash_share, id_ranges

K = 128
SHINGLE = 5
SPAN = float(2 ** 64)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def with_sketch(df: DataFrame, text: str, name: str, k: int = K, size: int = SHINGLE) -> DataFrame:
    """``df`` plus the array<bigint> column ``name``: the bottom-k sketch of column ``text``."""
    words = F.split(F.btrim(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(SPACES)), "[\\x20\\x09-\\x0D]+")
    tmp = f"__{name}_h"
    df = df.withColumn(tmp, F.transform(words, lambda w: F.xxhash64(w)))
    h = F.col(tmp)
    many = F.transform(F.slice(h, 1, F.greatest(F.size(h) - (size - 1), F.lit(0))),
                       lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, size)]))
    empty = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(SPACES)) == ""
    shingles = (F.when(empty, F.array().cast("array<bigint>"))
                .when(F.size(h) < size, F.array(F.xxhash64(h)))
                .otherwise(many))
    return df.withColumn(name, F.slice(F.sort_array(F.array_distinct(shingles)), 1, k)).drop(tmp)


def merge(a, b, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_union(_c(a), _c(b))), 1, k)


def merge_parts(df: DataFrame, by: str, sketch: str, k: int = K) -> DataFrame:
    """One sketch per ``by`` from the sketches of its parts: the k smallest distinct hashes.

    Hashes are aggregated one by one and ranked, so a key with any number of
    parts never gathers them all in one array before the cut.
    """
    from pyspark.sql import Window

    parts = df.select(by, F.explode(sketch).alias("h")).distinct()
    low = parts.withColumn("r", F.row_number().over(Window.partitionBy(by).orderBy("h"))).where(F.col("r") <= k)
    found = low.groupBy(by).agg(F.sort_array(F.collect_list("h")).alias(sketch))
    none = df.select(by).distinct()
    return (none.join(found.withColumnRenamed(by, "_by"), F.col(by).eqNullSafe(F.col("_by")), "left").drop("_by")
            .withColumn(sketch, F.coalesce(sketch, F.array().cast("array<bigint>"))))


def resemblance(a, b, k: int = K) -> Column:
    a, b = _c(a), _c(b)
    low = merge(a, b, k)
    both = F.size(F.array_intersect(low, F.array_intersect(a, b)))
    return F.when(F.size(low) == 0, F.lit(1.0)).otherwise(both.cast("double") / F.size(low))


def distinct_count(a, k: int = K) -> Column:
    a = _c(a)
    top = (F.element_at(a, -1).cast("double") + F.lit(SPAN / 2) + 1.0) / F.lit(SPAN)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(float(k - 1)) / top)


def containment(a, b, k: int = K) -> Column:
    """Share of A's shingles that B holds too (1 for an empty A)."""
    a, b = _c(a), _c(b)
    union = distinct_count(merge(a, b, k), k)
    n = distinct_count(a, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), resemblance(a, b, k) * union / n))


def encode(a) -> Column:
    """A sketch as text: 16 hex digits per hash, ascending."""
    return F.array_join(F.transform(_c(a), lambda x: F.lpad(F.hex(x), 16, "0")), "")


def with_next(spark: SparkSession, docs: DataFrame, columns: list[str], then=lambda df: df) -> DataFrame:
    """``docs`` plus ``next_<c>``: the columns of the next row by ascending (doc_id, text); last meets first.

    ``then`` adds columns to each row before the rows are dealt out.

    Rows are dealt into id ranges; the first row of each range is added to the
    range before it (that of the first range to the last), so one window per
    range sees every successor and no task sees all rows.
    """
    from pyspark.sql import Window

    cut = docs.withColumn("range_no", id_ranges(spark, docs, tie=hash_share(F.xxhash64("text")))).withColumn("later", F.lit(0))
    key = F.struct("doc_id", F.xxhash64("text").alias("x"))
    firsts = cut.groupBy("range_no").agg(F.min_by(F.struct(*docs.columns), key).alias("f"))
    # one row per range: the window over them is as small as the count of ranges
    order = Window.partitionBy(F.lit(0)).orderBy("range_no")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = firsts.select(F.coalesce(F.lag("range_no").over(order), F.last("range_no").over(whole)).alias("range_no"),
                          "f.*").withColumn("later", F.lit(1))
    both = then(cut.unionByName(heads.select(*cut.columns)))
    by = Window.partitionBy("range_no").orderBy("later", F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    return (both.select("*", *[F.lead(c).over(by).alias(f"next_{c}") for c in columns])
            .where(F.col("later") == 0).drop("later", "range_no"))


def op3_fingerprint(spark, sf_dir: str) -> DataFrame:
    docs = doc_columns(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    pairs = with_next(spark, docs, ["text", "sketch"], lambda df: with_sketch(df, "text", "sketch")).withColumn("n", F.char_length("text"))
    cut = F.floor(F.col("n") / 2).cast("int")
    edited = F.concat(F.expr("substring(text, 1, n - cast(floor(n / 2) as int))"),
                      F.substring(F.col("next_text"), F.lit(1), cut))
    pairs = pairs.select("doc_id", F.col("n").cast("long").alias("n_chars"), edited.alias("edited"),
                         "sketch", "next_sketch")
    out = with_sketch(pairs, "edited", "edited_sketch")
    return out.select("doc_id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"),
                      encode("sketch").alias("fingerprint"), encode("edited_sketch").alias("edited_fingerprint"),
                      resemblance("sketch", "edited_sketch").alias("near_edited"),
                      resemblance("sketch", "next_sketch").alias("near_next"),
                      containment("edited_sketch", "sketch").alias("edited_inside"),
                      distinct_count("sketch").alias("n_shingles_estimate"))
