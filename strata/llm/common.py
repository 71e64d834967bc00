"""Small helpers shared by the corpus operators: stage tables, sizes, document columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = " \t\n\x0b\x0c\r"          # [\x20\x09-\x0D]


def stage(spark: SparkSession, df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    This cuts the lineage: a lost executor costs the running tasks only.
    """
    path = scratch_dir(spark, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def doc_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator works on, under its own names: ``doc_id`` and ``text`` (never null).

    Other columns are left out, so their names cannot clash with an operator's own.
    """
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores before them until no column of ``df`` has them."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        out.append(n)
    return out


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows whose (doc_id, hash of the text) lie in ``gone`` (doc_id, text_hash)."""
    i, h = unused(docs, "gone_id", "gone_hash")
    gone = gone.select(F.col("doc_id").alias(i), F.col("text_hash").alias(h)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(i)) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col(h))
    return docs.join(gone, same, "left_anti")


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts: one number, from which counts of batches are set."""
    return int(docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0])


IDS_A_RANGE = 250     # sampled ids that a range's bounds are made from
RANGES = 4            # for each partition of a shuffle, so that partitions get even loads of ranges


def id_ranges(spark: SparkSession, docs: DataFrame, n: int | None = None, id_col: str = "doc_id",
              tie: Column | None = None) -> Column:
    """A column that cuts ascending ids into about ``n`` even ranges, numbered from 0.

    The bounds are quantiles of a hash sample of about ``IDS_A_RANGE * n`` ids
    (``n - 1`` numbers on the driver). Null ids go before all others. Equal ids
    share a range, unless they or the null ids are more than a range should hold:
    then ``tie``, a number from 0 to below 1 that parts rows of one id, cuts them
    into as many ranges as they fill. Only rows that are equal in both stay together.
    """
    n = n or RANGES * max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    ids = docs.select(F.col(id_col).alias("id"))
    known, nulls = ids.agg(F.count("id"), F.count_if(F.col("id").isNull())).first()
    ids = ids.where("id is not null")
    some = about(ids, ["id"], IDS_A_RANGE * n, known).select(F.col("id").cast("double").alias("id"))
    found = some.approxQuantile("id", [i / n for i in range(1, n)], 0.2 / n) if n > 1 else []
    cuts = sorted(set(found))
    ranges_of_null = max(1, round(n * nulls / max(1, known + nulls))) if tie is not None else 1
    # A cut that several quantiles fall on: so many ranges for that one id.
    copies = [found.count(c) if tie is not None and abs(c) < 2 ** 53 else 1 for c in cuts]      # beyond, doubles are not exact
    if not cuts and ranges_of_null == 1:
        return F.lit(0)
    numbers = lambda xs: "array(" + ", ".join(f"{x!r}D" for x in xs) + ")"
    own, null = f"cast(`{id_col}` as double)", F.col(f"`{id_col}`").isNull()
    if cuts:
        # Two levels of comparisons: the group of cuts, then the cut inside it.
        step = max(1, round(len(cuts) ** 0.5))
        groups = [cuts[i:i + step] for i in range(0, len(cuts), step)]
        group = f"greatest(size(filter({numbers([g[0] for g in groups])}, c -> c <= {own})) - 1, 0)"
        inside = f"size(filter(get(array({', '.join(map(numbers, groups))}), {group}), c -> c <= {own}))"
        place = F.expr(f"{group} * {step} + {inside}")
    else:
        place = F.lit(0)
    if ranges_of_null == 1 and max(copies, default=1) == 1:
        return F.when(null, F.lit(0)).otherwise(place)
    # What comes before a place: the null ids' ranges, then each cut's.
    first = [ranges_of_null - 1]
    for k in copies:
        first.append(first[-1] + k)
    at = F.get(F.array(*map(F.lit, first)), place)          # the last range that a row of this place may be in
    hot = [(c, k) for c, k in zip(cuts, copies) if k > 1]
    back = F.lit(0)                                         # a hot id's rows go into its last k ranges
    for c, k in hot:                                        # at most n
        back = F.when(F.expr(own) == c, F.lit(k - 1) - F.floor(tie * k).cast("int")).otherwise(back)
    return F.when(null, F.floor(tie * ranges_of_null).cast("int")).otherwise(at - back)


def hash_share(hashed: Column) -> Column:
    """A 64-bit hash as a number from 0 to below 1, in the order of the hash."""
    return F.least((hashed.cast("double") / F.lit(2.0 ** 64)) + 0.5, F.lit(1 - 2.0 ** -50))


def crc_share(crc: Column) -> Column:
    """An unsigned 32-bit checksum as a number from 0 to below 1, in its order."""
    return crc.cast("double") / F.lit(2.0 ** 32)


def about(df: DataFrame, key: list[str], rows: int, of: int) -> DataFrame:
    """About ``rows`` of a table of ``of`` rows, always the same ones: those of low key hashes."""
    if of <= rows:
        return df
    steps = 1 << 30
    return df.where(F.pmod(F.xxhash64(F.lit("sample"), *key), F.lit(steps)) < max(1, steps * rows // of))
