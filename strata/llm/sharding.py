"""Resharding by minimum-cost flow: from old shards to new ones, moving the fewest bytes.

Old shard sizes and new capacities make a small transport network (old shards by
new shards, whatever the corpus). A byte that stays in its shard costs nothing,
a moved one costs 1; the cheapest flow is found with successive shortest paths.
Its amounts cut each old shard, in id order, into runs of documents (blocks): a
document goes to the new shard in whose run its middle byte lies, so a shard is
off its capacity by less than a document per run. Shards that neither lose nor
gain a document keep their files; the others are rewritten.

Byte positions come from sums per (old shard, id range) and a window inside
each, so an old shard with a third of all rows is spread over all ranges.

Law ``bytes``: shard sizes near equal. Equal texts are not held together: a
third of all rows may be copies of one text, and an eighth must not hold them.

Defined cases: a null or empty text has size 1; equal ids lie next to each other
in order of size and checksum; a null old shard is shard 0; an old shard beyond
the new ones gives all its bytes away; an empty table gives empty shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import crc_share, id_ranges
from strata.session import scratch_dir

SHARDS = 8
OLD_SHARDS = 6


def cheapest_flow(sizes: dict[int, int], capacity: list[int]) -> dict[tuple[int, int], int]:
    """Bytes from old shard to new shard; sum of capacities >= sum of sizes.

    Successive shortest augmenting paths (Bellman-Ford) on source -> old -> new -> sink.
    """
    olds, n = sorted(sizes), len(capacity)
    source, sink = 0, 1 + len(olds) + n
    graph: list[list[list[int]]] = [[] for _ in range(sink + 1)]   # [to, room, cost, index of the reverse edge]

    def edge(a: int, b: int, room: int, cost: int) -> list[int]:
        graph[a].append([b, room, cost, len(graph[b])])
        graph[b].append([a, 0, -cost, len(graph[a]) - 1])
        return graph[a][-1]

    pairs = {}
    for i, o in enumerate(olds):
        edge(source, 1 + i, sizes[o], 0)
        for j in range(n):
            pairs[o, j] = edge(1 + i, 1 + len(olds) + j, sizes[o], int(o != j))
    for j in range(n):
        edge(1 + len(olds) + j, sink, capacity[j], 0)
    while True:
        cost, via = {source: 0}, {}
        changed = True
        while changed:
            changed = False
            for a in list(cost):
                for k, (b, room, c, _) in enumerate(graph[a]):
                    if room and cost[a] + c < cost.get(b, 1 << 60):
                        cost[b], via[b], changed = cost[a] + c, (a, k), True
        if sink not in cost:
            break
        path, at = [], sink
        while at != source:
            a, k = via[at]
            path.append(graph[a][k])
            at = a
        amount = min(e[1] for e in path)
        for e in path:
            e[1] -= amount
            graph[e[0]][e[3]][1] += amount
    return {(o, j): sizes[o] - e[1] for (o, j), e in pairs.items() if sizes[o] - e[1]}


def even_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


def with_size(docs: DataFrame) -> DataFrame:
    """Size (UTF-8 bytes plus 1) and checksum of each text."""
    text = F.coalesce("text", F.lit(""))
    return docs.withColumn("size", (F.octet_length(text) + 1).cast("long")).withColumn(
        "text_crc32", F.crc32(F.encode(text, "UTF-8")))


def place(spark: SparkSession, docs: DataFrame, old: str, shards: int = SHARDS,
          capacity: list[int] | None = None) -> tuple[DataFrame, dict]:
    """``docs`` (doc_id, text, ``old``) plus size, text_crc32, shard and slot, and the flow that was solved.

    Sums and counts are made from narrow rows; the texts are dealt out once, by (old shard, id range).
    """
    docs = with_size(docs).withColumn("old_shard", F.coalesce(F.col(old).cast("int"), F.lit(0)))
    docs = docs.withColumn("range_no", id_ranges(spark, docs, tie=crc_share(F.col("text_crc32"))))
    narrow = docs.select("doc_id", "size", "text_crc32", "old_shard", "range_no")
    sizes = {r["old_shard"]: r["s"] for r in narrow.groupBy("old_shard").agg(F.sum("size").alias("s")).collect()}
    flow = cheapest_flow(sizes, capacity or even_capacities(sum(sizes.values()), shards))
    ends, runs = {}, []
    for (o, j), amount in sorted(flow.items(), key=lambda x: (x[0][0], x[0][0] != x[0][1], x[0][1])):
        ends[o] = ends.get(o, 0) + amount
        runs.append((o, ends[o], j))       # old shard, byte where the run ends, new shard
    group = ["old_shard", "range_no"]
    order = [F.col("doc_id").asc_nulls_first(), "size", "text_crc32"]
    earlier = (Window.unboundedPreceding, -1)

    def located(df: DataFrame) -> DataFrame:
        """``df`` (with ``range_start``) plus the new shard of each row."""
        inside = F.sum("size").over(Window.partitionBy(*group).orderBy(*order).rowsBetween(*earlier))
        middle = F.col("range_start") + F.coalesce(inside, F.lit(0)) + F.floor(F.col("size") / 2)
        df = df.withColumn("middle", middle)
        shard = F.lit(None).cast("int")
        for o, end, j in reversed(runs):   # at most old x new shards
            shard = F.when((F.col("old_shard") == o) & (F.col("middle") < end), F.lit(j)).otherwise(shard)
        return df.withColumn("shard", shard).drop("middle", "range_start")

    by_old = Window.partitionBy("old_shard").orderBy("range_no").rowsBetween(*earlier)
    starts = narrow.groupBy(*group).agg(F.sum("size").alias("s")).select(
        *group, F.coalesce(F.sum("s").over(by_old), F.lit(0)).alias("range_start"))
    counts = located(narrow.join(starts, group)).groupBy(*group, "shard").agg(F.count(F.lit(1)).alias("n"))
    by_shard = Window.partitionBy("shard").orderBy(*group).rowsBetween(*earlier)
    slots = counts.withColumn("first", F.coalesce(F.sum("n").over(by_shard), F.lit(0))).groupBy(*group).agg(
        F.map_from_entries(F.collect_list(F.struct("shard", "first"))).alias("firsts"))   # at most one per new shard
    placed = located(docs.join(starts.join(slots, group), group))
    own = F.row_number().over(Window.partitionBy(*group, "shard").orderBy(*order)) - 1
    return placed.withColumn("slot", (F.element_at("firsts", F.col("shard")) + own).cast("long")).drop("firsts"), flow


def rewrite(placed: DataFrame, flow: dict, folder: str) -> list[int]:
    """Write the files of every shard that loses or gains documents; return those shards.

    A shard's rows lie in files by old shard and id range, in slot order; ``slot`` is kept with the text.
    """
    touched = sorted({s for (o, j) in flow if o != j for s in (o, j)})
    rows = placed.where(F.col("shard").isin(touched)) if touched else placed.limit(0)
    (rows.select("doc_id", "text", "slot", "shard").sortWithinPartitions("shard", "slot")
     .write.option("compression", "zstd").partitionBy("shard").parquet(folder))
    return touched


def op9_sharding(spark, sf_dir: str) -> DataFrame:
    """An old layout of 6 shards by source, uneven as sources are, becomes 8 even ones; read back from their files."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.select("doc_id", "text", F.pmod(F.crc32(F.encode(F.coalesce("source", F.lit("")), "UTF-8")),
                                                F.lit(OLD_SHARDS)).alias("old"))
    placed, flow = place(spark, docs, "old")
    folder = scratch_dir(spark, "shards")
    touched = rewrite(placed, flow, folder)
    kind = "doc_id long, text string, slot long, shard int"
    files = with_size(spark.read.schema(kind).parquet(folder))
    stay = placed.where(~F.col("shard").isin(touched)) if touched else placed
    cols = ["doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
            F.lit(None).cast("int").alias("grown_shard")]
    return files.select(*cols).unionByName(stay.select(*cols)) if len(touched) < SHARDS else files.select(*cols)
