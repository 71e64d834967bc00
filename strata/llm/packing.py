"""Packing by minimum bin slack: documents into sequences of at most ``window`` tokens with little padding.

A document longer than a window gives whole windows and one remainder. Packing
depends on the remainders' lengths alone, so the plan is made from their exact
histogram (at most ``window`` numbers, whatever the corpus): again and again the
longest length left is taken, and a bitset subset-sum over the lengths left
picks the multiset that fills the window closest to capacity; walking back
through the bitsets gives its counts, and the pattern is used as often as the
counts allow. Every pattern uses up a length, so there are at most ``window``.

Pieces then take their places by their rank among the pieces of their length.
Ranks come from counts per (id range, length) and a window inside each, so a
length that many documents share is spread over all ranges.

Defined cases: a null or empty text is its end id alone (without an end id it
gives no piece); repeated rows are packed each; an empty table gives no piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import crc_share, doc_columns, id_ranges, stage
from strata.llm.tokens import word_tokenizer

WINDOW = 2048


def best_subset(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths (at most ``counts`` of each) with the largest sum up to ``capacity``.

    ``reach`` has bit s set if some multiset sums to s; each step adds 1, 2, 4, ...
    copies of a length. The steps are walked back from the best sum to its counts.
    """
    full = (1 << (capacity + 1)) - 1
    reach, steps = 1, []
    for length in sorted(counts, reverse=True):
        left, copies = min(counts[length], capacity // length), 1
        while left:
            k = min(copies, left)
            steps.append((length, k, reach))
            reach |= (reach << (length * k)) & full
            left -= k
            copies *= 2
        if reach >> capacity & 1:
            break
    total, need = reach.bit_length() - 1, {}
    for length, k, before in reversed(steps):
        if not before >> total & 1:
            need[length] = need.get(length, 0) + k
            total -= length * k
    return need


def plan_bins(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[int, dict[int, int]]]:
    """(times, {length: copies}) patterns that use up the histogram, each window filled as far as can be."""
    left = {k: v for k, v in histogram.items() if v}
    plan = []
    while left:
        longest = max(left)
        rest = dict(left)
        rest[longest] -= 1
        if not rest[longest]:
            del rest[longest]
        need = best_subset({k: v for k, v in rest.items() if k <= window - longest}, window - longest)
        need[longest] = need.get(longest, 0) + 1
        times = min(left[k] // q for k, q in need.items())
        plan.append((times, need))
        for k, q in need.items():
            left[k] -= times * q
            if not left[k]:
                del left[k]
    return plan


def place_table(plan: list[tuple[int, dict[int, int]]]):
    """Arrays (length, first rank, first bin, copies per bin, offset), sorted by (length, first rank)."""
    import numpy as np

    used, rows, first_bin = {}, [], 0
    for times, need in plan:
        offset = 0
        for length in sorted(need, reverse=True):
            q = need[length]
            rows.append((length, used.get(length, 0), first_bin, q, offset))
            used[length] = used.get(length, 0) + times * q
            offset += q * length
        first_bin += times
    rows.sort()
    return np.array(rows, np.int64).reshape(-1, 5)


def cut_pieces(docs: DataFrame, path: str, end_id: int | None, window: int, with_ids: bool) -> DataFrame:
    """doc_id, start, length, doc_tokens, ids_crc32, ids: each document's whole windows and its remainder."""
    def run(batches):
        import zlib

        import numpy as np
        import pyarrow as pa

        from strata.llm.tokens import encoded

        for rows, ids, bounds in encoded(batches, path, end_id):
            size = np.diff(bounds)
            n = -(-size // window)
            doc = np.repeat(np.arange(len(size)), n)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * window
            length = np.minimum(window, size[doc] - start)
            data, at = ids.astype("<u4").tobytes(), bounds[:-1][doc] + start
            cut = [data[4 * a:4 * (a + k)] for a, k in zip(at.tolist(), length.tolist())]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id").take(pa.array(doc)), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                 pa.array(size[doc], pa.int64()), pa.array([zlib.crc32(c) for c in cut], pa.int64()),
                 pa.array(cut if with_ids else [None] * len(cut), pa.binary())],
                names=["doc_id", "start", "length", "doc_tokens", "ids_crc32", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, start long, length long, doc_tokens long, ids_crc32 long, ids binary")


def with_places(pieces: DataFrame, places) -> DataFrame:
    """``pieces`` (with ``length`` and ``rank``) plus sequence_id and offset."""
    data = pieces.sparkSession.sparkContext.broadcast(places)   # at most window rows for each length of a pattern

    def run(batches):
        import numpy as np
        import pyarrow as pa

        table = data.value
        keys = (table[:, 0] << 48) + table[:, 1]
        for batch in batches:
            length, rank = (np.asarray(batch.column(c)) for c in ("length", "rank"))
            row = table[np.searchsorted(keys, (length << 48) + rank, "right") - 1]
            inside = rank - row[:, 1]
            names = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(row[:, 2] + inside // row[:, 3], pa.int64()),
                 pa.array(row[:, 4] + inside % row[:, 3] * length, pa.int64())], names=[*names, "sequence_id", "offset"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields if f.name != "rank"]
    return pieces.mapInArrow(run, ", ".join([*fields, "sequence_id long", "offset long"]))


def pack(spark: SparkSession, docs: DataFrame, window: int = WINDOW, path: str | None = None,
         end_id: int | None = 1, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their sequence and offset. ``with_ids`` adds their ids (binary, 4 bytes each)."""
    path = path or word_tokenizer()
    docs = doc_columns(docs)
    ranges = id_ranges(spark, docs, tie=crc_share(F.col("ids_crc32")))
    pieces = cut_pieces(docs, path, end_id, window, with_ids).withColumn("range_no", ranges)
    pieces = stage(spark, pieces, "pieces")       # texts are encoded once
    by_length = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    places = place_table(plan_bins({r["length"]: r["n"] for r in by_length.collect()}, window))  # <= window rows
    counts = pieces.groupBy("range_no", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("range_no", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    order = Window.partitionBy("range_no", "length").orderBy(F.col("doc_id").asc_nulls_first(), "start", "ids_crc32")
    ranked = pieces.withColumn("inside", F.row_number().over(order) - 1).join(counts, ["range_no", "length"])
    ranked = ranked.withColumn("rank", (F.col("base") + F.col("inside")).cast("long")).drop("base", "inside", "range_no")
    columns = ["doc_id", "start", "length", "doc_tokens", "ids_crc32", *(["ids"] if with_ids else []), "rank"]
    return with_places(ranked.select(*columns), places)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, length, ids of each packed sequence (``packed`` made with ``with_ids``); one window each."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("p")).select(
        "sequence_id", "length",
        F.aggregate("p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids"))


def op10_packing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(spark, docs).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
