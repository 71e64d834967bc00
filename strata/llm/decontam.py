"""Benchmark decontamination with a positional inverted index of the training tokens.

``build_index`` turns documents into index shards: for a few MB of text each,
the distinct terms (64-bit word hashes, ascending), and for each term the
ascending positions of its postings; documents follow each other with a gap.
The index is stored as a table and serves any number of searches.

``search`` looks up test phrases: in each shard a phrase starts from its rarest
term and intersects the other terms' lists, adjusted by their offsets, from
rare to common. What is left are exact matches. With ``slop`` the lists are
intersected with a tolerance, which gives proximity matches: for some start,
every term of the window lies up to ``slop`` words from its offset, all in one
document. That holds or not whatever else the shard has and whichever term is
its rarest; the start may lie before the document. Shards are spread
over the cluster and hold all postings of their documents, so a term that a
third of all documents share is spread with them.

Phrases go to the shards in blocks of bounded size (``BLOCK_BYTES``): each is
searched and its hits are written before the next is sent, however large the
benchmark.

Words: A-Z lower-cased, runs of digits, letters and all characters beyond ASCII.

Defined cases: a null or empty text has no words and no hit; an item without
words matches nothing, one with fewer words than a window is one window; equal
items, equal windows and repeated rows are each found; a null item id is the
empty string; other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import doc_columns, stage, text_bytes, without

WINDOW = 13
SHARD_BYTES = 4 << 20
BLOCK_BYTES = 8 << 20
GAP = 64                 # unused positions between two documents; a slop must stay below

INDEX = ("shard string, doc_ids array<{id}>, text_hashes array<long>, n_words array<long>, firsts array<long>, "
         "terms binary, bounds binary, positions binary")


def build_index(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The stored index: one row per shard."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        from strata.llm.text import ALNUM_TABLE, chunks, encode, hash_pieces, split

        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = encode(batch.column("text").to_pylist())
            for a, b in chunks(texts, SHARD_BYTES):
                words, buf = split(texts[a:b], ALNUM_TABLE, True)
                h = hash_pieces(buf, words.starts, words.ends)
                n = words.counts
                first = words.first[:-1] + GAP * np.arange(len(n))
                order = np.argsort(h, kind="stable")
                terms, at = np.unique(h[order], return_index=True)
                positions = np.arange(len(h)) + GAP * np.repeat(np.arange(len(n)), n)
                rows = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([
                    pa.array([f"{part}-{number}"]), *[pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), x) for x in (
                        rows.column("doc_id"), rows.column("text_hash"), pa.array(n, pa.int64()), pa.array(first, pa.int64()))],
                    pa.array([terms.tobytes()], pa.binary()),
                    pa.array([np.append(at, len(h)).astype("<i8").tobytes()], pa.binary()),
                    pa.array([positions[order].astype("<u4").tobytes()], pa.binary())],
                    names=["shard", "doc_ids", "text_hashes", "n_words", "firsts", "terms", "bounds", "positions"])
                number += 1

    docs = doc_columns(docs).withColumn("text_hash", F.xxhash64("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return stage(spark, docs.mapInArrow(run, INDEX.format(id=kind)), "postings")


class Phrases:
    """Distinct test phrases: the windows of a block of items, as rows of term numbers by length."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        import numpy as np

        from strata.llm.text import ALNUM_TABLE, encode, hash_pieces, split

        words, buf = split(encode([t for _, t in items]), ALNUM_TABLE, True)
        self.vocab, ids = np.unique(hash_pieces(buf, words.starts, words.ends), return_inverse=True)
        ids = ids.astype(np.int32)
        self.items, number = np.unique(np.array([i for i, _ in items], object), return_inverse=True)
        sizes = np.minimum(words.counts, window)
        self.groups = []            # (length, term numbers of each window, bounds into, the items of each window)
        for size in sorted(set(sizes[sizes > 0].tolist())):
            own = np.flatnonzero(sizes == size)
            begin, who = _expand(words.first[own], words.counts[own] - size + 1)      # where each window begins, its text
            rows = ids[begin[:, None] + np.arange(size)]
            order = np.lexsort(rows.T[::-1])
            rows, of = rows[order], number[own[who[order]]]
            new = np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)])
            pair = np.unique((np.cumsum(new) - 1) << 32 | of)
            bounds = np.searchsorted(pair >> 32, np.arange(int(new.sum()) + 1))
            self.groups.append((size, rows[new], bounds, pair & 0xFFFFFFFF))


def _expand(begin, count):
    """begin[i] .. begin[i] + count[i] - 1 for every i, and the i of each."""
    import numpy as np

    who = np.repeat(np.arange(len(count)), count)
    return begin[who] + np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count), who


def match(terms, bounds, positions, first, phrases: Phrases, size: int, windows, slop: int):
    """(window, document, position) of every place in a shard where all terms of a window lie in one document at their
    offsets, give or take slop. With slop a place of the rarest term counts once, with a position nearest to it."""
    import numpy as np

    at = np.minimum(np.searchsorted(terms, phrases.vocab), max(len(terms) - 1, 0))
    here = terms[at] == phrases.vocab if len(terms) else np.zeros(len(phrases.vocab), bool)
    count = np.where(here, bounds[at + 1] - bounds[at], 0) if len(terms) else np.zeros(len(here), np.int64)
    live = np.flatnonzero(count[windows].min(axis=1) > 0)
    if not len(live):
        return live, live, live
    # The postings of the phrases' terms as one ascending list of (term number, position).
    own, who = _expand(bounds[at], count)
    lists = (who.astype(np.int64) << 32) + positions[own]
    begin = np.cumsum(count) - count
    few = windows[live]
    rare = np.argsort(count[few], axis=1, kind="stable")
    anchor = np.take_along_axis(few, rare[:, :1], 1)[:, 0].astype(np.int64)
    place, who = _expand(begin[anchor], count[anchor])
    posting = lists[place] & 0xFFFFFFFF
    doc = np.searchsorted(first, posting, "right") - 1      # of the posting: with slop, start may lie in the gap before it
    start = posting - rare[who, 0]
    last = np.append(first[1:], 1 << 32) - 1

    def within(reach, start, who, doc):
        """Which rows have every other term up to reach from its offset, in the document."""
        keep = np.arange(len(start))
        for k in range(1, size):
            off = rare[who[keep], k]
            term, want = few[who[keep], off].astype(np.int64) << 32, start[keep] + off
            low, high = np.maximum(want - reach, first[doc[keep]]), np.minimum(want + reach, last[doc[keep]])
            i = np.searchsorted(lists, term + low)
            ok = (low <= high) & (i < len(lists))
            ok &= lists[np.minimum(i, len(lists) - 1)] <= term + high
            keep = keep[ok]
        return keep

    # The rarest term itself lies up to slop from its offset, so the others lie up to twice that from it.
    keep = within(2 * slop, start, who, doc)
    start, who, doc = start[keep], who[keep], doc[keep]
    if slop:
        found, left = [], np.arange(len(start))
        for shift in sorted(range(-slop, slop + 1), key=abs):
            ok = within(slop, start[left] + shift, who[left], doc[left])
            found.append((left[ok], start[left[ok]] + shift))
            left = np.delete(left, ok)
        keep, start = (np.concatenate(x) for x in zip(*found))
        who, doc = who[keep], doc[keep]
    return live[who], doc, start


def search(spark: SparkSession, index: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 0,
           item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One row per indexed document: doc_id, text_hash, n_words, n_hit, items, near_items, spans.

    items: ids (as strings, ascending) with an exact match; near_items: those that
    match with ``slop`` only; spans: word ranges [a, b) of the exact matches' windows.
    """
    if not 0 <= slop < GAP:
        raise ValueError(f"slop must lie between 0 and {GAP - 1}")
    items = items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                         F.coalesce(F.col(text_col), F.lit("")).alias("text")).distinct()     # copies would share a block
    n_blocks = -(-text_bytes(items) // BLOCK_BYTES)

    def finder(data):
        def run(batches):
            import numpy as np
            import pyarrow as pa

            phrases = data.value
            for batch in batches:
                for row in batch.to_pylist():
                    terms, bounds = np.frombuffer(row["terms"], np.uint64), np.frombuffer(row["bounds"], "<i8")
                    positions = np.frombuffer(row["positions"], "<u4").astype(np.int64)
                    first = np.array(row["firsts"], np.int64)
                    spans, pairs, near = [], [], []
                    for size, windows, cut, owners in phrases.groups:
                        w, d, p = match(terms, bounds, positions, first, phrases, size, windows, 0)
                        spans.append(np.stack([p, p + size]))
                        for tolerance, to in [(0, pairs)] + ([(slop, near)] if slop else []):
                            if tolerance:
                                w, d, _ = match(terms, bounds, positions, first, phrases, size, windows, tolerance)
                            dw = np.unique((d << 32) + w)
                            d, w = dw >> 32, dw & 0xFFFFFFFF
                            own, who = _expand(cut[w], cut[w + 1] - cut[w])
                            to.append((d[who] << 32) + owners[own])
                    spans = np.unique(np.concatenate(spans, axis=1), axis=1) if spans else np.empty((2, 0), np.int64)
                    pairs = np.unique(np.concatenate(pairs)) if pairs else np.empty(0, np.int64)
                    near = np.setdiff1d(np.concatenate(near), pairs) if near else np.empty(0, np.int64)
                    doc_of = np.searchsorted(first, spans[0], "right") - 1
                    found = sorted({*(pairs >> 32).tolist(), *(near >> 32).tolist()})
                    out = []
                    for d in found:
                        a, b = np.searchsorted(doc_of, [d, d + 1])
                        names = [[phrases.items[k & 0xFFFFFFFF] for k in x[np.searchsorted(x, d << 32):np.searchsorted(x, (d + 1) << 32)].tolist()]
                                 for x in (pairs, near)]
                        out.append({"shard": row["shard"], "doc": d, "items": names[0], "near_items": names[1],
                                    "spans": [{"a": x - int(first[d]), "b": y - int(first[d])} for x, y in _merged(spans[:, a:b])]})
                    if out:
                        yield pa.RecordBatch.from_pylist(out, schema)

        import pyarrow as pa

        schema = pa.schema([("shard", pa.string()), ("doc", pa.int32()), ("items", pa.list_(pa.string())),
                            ("near_items", pa.list_(pa.string())),
                            ("spans", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))])
        return run

    kind = "shard string, doc int, items array<string>, near_items array<string>, spans array<struct<a: long, b: long>>"
    hits = spark.createDataFrame([], kind)
    lists = index.select("shard", "firsts", "terms", "bounds", "positions")
    for k in range(n_blocks):
        block = [(r["item"], r["text"]) for r in
                 items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == k).collect()]   # about BLOCK_BYTES
        if block:
            data = spark.sparkContext.broadcast(Phrases(block, window))
            hits = hits.unionByName(stage(spark, lists.mapInArrow(finder(data), kind), "hits"))     # few rows, written
            data.unpersist()
    both = hits.groupBy("shard", "doc").agg(*[F.array_distinct(F.flatten(F.collect_list(c))).alias(c)
                                              for c in ("items", "near_items", "spans")])    # a row per block at most
    every = index.select("shard", F.posexplode(F.arrays_zip("doc_ids", "text_hashes", "n_words")).alias("doc", "d"))
    every = every.select("shard", "doc", F.col("d.doc_ids").alias("doc_id"), F.col("d.text_hashes").alias("text_hash"),
                         F.col("d.n_words").alias("n_words"))
    covered = F.aggregate(
        F.sort_array("spans"), F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n")),
        lambda s, x: F.struct(F.greatest(s["end"], x["b"]).alias("end"),
                              (s["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(x["a"], s["end"]))).alias("n")))["n"]
    none = F.array().cast("array<string>")
    return every.join(both, ["shard", "doc"], "left").select(
        "doc_id", "text_hash", "n_words", F.coalesce(covered, F.lit(0)).cast("long").alias("n_hit"),
        F.sort_array(F.coalesce("items", none)).alias("items"),
        F.sort_array(F.array_except(F.coalesce("near_items", none), F.coalesce("items", none))).alias("near_items"),
        F.sort_array(F.coalesce("spans", F.array().cast("array<struct<a: long, b: long>>"))).alias("spans"))


def _merged(spans) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in spans.T.tolist():
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def find_contaminated(spark: SparkSession, docs: DataFrame, items: DataFrame, one_in: int = 20, **kw) -> DataFrame:
    """``search`` plus contaminated: at least one word in ``one_in`` is hit."""
    out = search(spark, build_index(spark, docs), items, **kw)
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.lit(one_in) * F.col("n_hit") >= F.col("n_words")))


def drop_contaminated(spark: SparkSession, docs: DataFrame, items: DataFrame, **kw) -> DataFrame:
    """``docs`` without its contaminated rows; columns stay."""
    return without(docs, find_contaminated(spark, docs, items, **kw).where("contaminated"))


def op1_decontamination(spark, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    out = find_contaminated(spark, docs, items)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i
        FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT doc_id, dw.n, i, item_id FROM dw JOIN bw ON dw.s = bw.s AND dw.n = bw.n),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, n, i FROM m)) GROUP BY doc_id),
it AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(x, ',' ORDER BY x)) AS h
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM m) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(h, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""
