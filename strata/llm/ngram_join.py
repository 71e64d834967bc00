"""N-gram Jaccard join by prefixes under several global token orders.

A document is its set of distinct word shingles. If two sets have a Jaccard
similarity of at least t, they share a token among the first
n - ceil(t * n) + 1 of either set, under every order of all tokens. Three orders
are used; each puts tokens of one document first and then goes by frequency, by
a hash, and by another hash. A pair is a candidate only if it passes all three.

1. Equal texts are one class, represented by their smallest id. Each task lets
   a text through once, and its copies meet in one batch.
2. Tokens of one document only are found by batches (``keys``). They stand
   first in every order and no pair shares them, so a document with a prefix of
   such tokens is done: it links with nothing. The others keep the rest.
3. Documents that share prefix tokens of the first order form candidate groups
   (star edges to the smallest id of a token, then components), so a pair that
   passes the first order lies in one group.
4. Groups are cut into blocks of about ``BLOCK`` documents and every two blocks of
   a group are a cell, a task of bounded size. A cell tests its pairs against the
   three prefixes, in turn, verifies what is left by exact intersection and
   returns each document's count of links and a spanning forest, not the pairs.
5. Components of the forests' edges are the classes.

Tokens are 64-bit hashes of the words of a shingle; sizes and intersections are
of those. No pair is dropped: every two documents of a group meet in one cell.

Defined cases: null or empty texts, or such without words, have an empty set,
link with nothing and are their own component; a text of fewer words than a
shingle is one shingle; copies link with each other; repeated rows of one id are
copies; rows of one id with different texts are one node of the components;
other columns are left out; ids are integers; a row with a null id has
the component of its copies, or null if it has none with an id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import doc_columns, stage, text_bytes, without
from strata.llm.components import connected_components
from strata.llm.keys import (PACKED, batched, bucket_count, bucket_of, packed, per_batch, per_bucket, replies, unpacked,
                             with_replies)
from strata.llm.text import SPACE_TABLE, encode, hash_pieces, mix, shingles, split

SHINGLE = 4
PERCENT = 85
BLOCK = 64              # documents of a group in one block
TOKENS_AT_ONCE = 1 << 14  # columns of a cell's matrix at a time
SALTS = 8
NO_ID = 1 << 62         # texts without any id get numbers from here on; ids are below
SEEDS = (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344))
PAYLOAD = np.uint64(0x3FFFFFFF)

SETS = "same string, n long, tokens array<long>, p1 array<long>, p2 array<long>, p3 array<long>"


def _first_copies(batches):
    """Rows (same, text) of a task, each text once; what is kept of it is 16 bytes."""
    seen = set()
    for batch in batches:
        keep = []
        for i, x in enumerate(batch.column("same").to_pylist()):
            key = bytes.fromhex(x)
            if key not in seen:
                seen.add(key)
                keep.append(i)
        yield batch.take(pa.array(keep, pa.int64()))


def _distinct(docs: pa.Table) -> pa.Table:
    """A batch's texts, each once."""
    return docs.take(pa.array(np.unique(np.array(docs.column("same").to_pylist(), object), return_index=True)[1]))


def _sets(table: pa.Table, size: int):
    words, buf = split(encode(table.column("text").to_pylist()), SPACE_TABLE, True)
    return shingles(hash_pieces(buf, words.starts, words.ends), words.first, size)


def _codes(tokens: np.ndarray, n: int) -> np.ndarray:
    return (bucket_of(tokens, n) << np.uint64(30)) | (tokens & PAYLOAD)


def _ask_tokens(size: int, n_buckets: int):
    def run(docs: pa.Table) -> pa.Table:
        code = np.sort(_codes(_sets(_distinct(docs), size)[0], n_buckets))
        new = np.flatnonzero(np.diff(code, prepend=~code[:1]))
        count = np.minimum(np.diff(np.append(new, len(code))), 3).astype(np.uint64)
        code = code[new]
        return packed(docs.column("batch")[0].as_py(), (code >> np.uint64(30)).astype(np.int64),
                      (((code & PAYLOAD) << np.uint64(2)) | count).astype("<u4"))

    return run


def _find_shared(table: pa.Table) -> pa.Table:
    """Tokens of two documents or more, each with its frequency class (up to 3 counted a batch)."""
    row, v = unpacked(table, "<u4")
    key = v >> 2
    order = np.argsort(key, kind="stable")
    new = np.flatnonzero(np.diff(key[order].astype(np.int64), prepend=-1))
    size = np.diff(np.append(new, len(v)))
    docs = np.add.reduceat((v[order] & 3).astype(np.int64), new)
    rank = np.zeros(len(v), np.uint64)
    rank[order] = np.repeat(np.where(docs > 1, np.minimum(1 + 8 * np.log2(docs), 255), 0).astype(np.uint64), size)
    keep = rank > 0
    return replies(table, row[keep], ((key[keep].astype(np.uint64) << np.uint64(8)) | rank[keep]).astype("<u8"))


def _prefixes(size: int, percent: int, n_buckets: int):
    def run(docs: pa.Table, shared: pa.Table) -> pa.Table:
        schema = pa.schema([("same", pa.string()), ("n", pa.int64()), *[(c, pa.list_(pa.int64())) for c in ("tokens", "p1", "p2", "p3")]])
        if not docs.num_rows:
            return schema.empty_table()
        docs = _distinct(docs)
        tokens, bounds = _sets(docs, size)
        n = np.diff(bounds)
        freq = np.zeros(len(tokens), np.int64)
        if shared.num_rows:
            row, v = unpacked(shared, "<u8")
            key = (np.asarray(shared.column("bucket")).astype(np.uint64)[row] << np.uint64(30)) | (v >> np.uint64(8))
            order = np.argsort(key)
            key, rank = key[order], (v[order] & np.uint64(255)).astype(np.int64)
            code = _codes(tokens, n_buckets)
            at = np.minimum(np.searchsorted(key, code), len(key) - 1)
            freq = np.where(key[at] == code, rank[at], 0)
        rest = np.concatenate([[0], np.cumsum(freq > 0)])[bounds]
        prefix = n - (percent * n + 99) // 100 + 1 - (n - np.diff(rest))     # of the tokens that others have
        out = [[None] * len(n) for _ in range(4)]
        for d in np.flatnonzero(prefix > 0).tolist():
            mine = freq[bounds[d]:bounds[d + 1]]
            t = tokens[bounds[d]:bounds[d + 1]][mine > 0]
            mine = mine[mine > 0]
            k = int(prefix[d])
            if not len(t):
                continue
            a, b = mix(t ^ SEEDS[0]), mix(t ^ SEEDS[1])
            for c, o in enumerate((None, np.lexsort((a, mine)), np.argsort(a), np.argsort(b))):
                out[c][d] = (t if o is None else t[o[:k]]).view(np.int64)
        return pa.Table.from_arrays([docs.column("same").combine_chunks(), pa.array(n, pa.int64()),
                                     *[pa.array(x, pa.list_(pa.int64())) for x in out]], schema=schema)

    return run


def _groups(spark: SparkSession, found: DataFrame, prefix: str) -> DataFrame:
    """rep, grp: documents that prefix tokens of one order connect. Documents left alone are dropped."""
    rows = found.select("rep", F.explode(prefix).alias("token"))
    least = rows.groupBy("token").agg(F.min("rep").alias("v"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    salted = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    edges = (rows.withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(SALTS)).cast("int"))
             .join(salted, ["token", "salt"]).where("rep <> v").select(F.col("rep").alias("u"), "v"))
    return connected_components(spark, edges).select(F.col("node").alias("rep"), F.col("component").alias("grp"))


def _matrix(docs: int, row: np.ndarray, token: np.ndarray):
    """The docs x docs counts of common tokens, from (row, token) entries, a bounded part of the tokens at a time."""
    total = np.zeros((docs, docs), np.float32)
    order = np.argsort(token, kind="stable")
    row, token = row[order], token[order]
    new = np.flatnonzero(np.diff(token, prepend=~token[:1]))
    size = np.diff(np.append(new, len(token)))
    keep = np.repeat(size > 1, size)
    row, column = row[keep], np.repeat(np.arange((size > 1).sum()), size[size > 1])
    for a in range(0, int(column[-1]) + 1 if len(column) else 0, TOKENS_AT_ONCE):
        part = slice(np.searchsorted(column, a), np.searchsorted(column, a + TOKENS_AT_ONCE))
        m = np.zeros((docs, min(TOKENS_AT_ONCE, int(column[-1]) + 1 - a)), np.float32)
        m[row[part], column[part] - a] = 1
        total += m @ m.T
    return total


def _entries(column):
    lists = column.combine_chunks()
    n = np.diff(np.asarray(lists.offsets))
    return np.repeat(np.arange(len(n)), n), np.asarray(lists.flatten()).view(np.uint64)


def _verify(percent: int):
    def run(table: pa.Table) -> pa.Table:
        rep, n, copies = (np.asarray(table.column(c)) for c in ("rep", "n", "copies"))
        grp, side, cross = (np.asarray(table.column(c)) for c in ("grp", "side", "cross"))
        docs = len(rep)
        # Only pairs of one group, in a cell of two blocks only those across; sizes must allow the similarity.
        pairs = (grp[:, None] == grp[None, :]) & ((cross[:, None] == 0) | (side[:, None] != side[None, :]))
        pairs &= (100 * np.minimum(n[:, None], n[None, :]) >= percent * np.maximum(n[:, None], n[None, :]))
        np.fill_diagonal(pairs, False)
        for order in ("p1", "p2", "p3"):
            if pairs.any():
                pairs &= _matrix(docs, *_entries(table.column(order))) > 0
        if pairs.any():
            live = np.flatnonzero(pairs.any(axis=1))
            row, token = _entries(table.column("tokens"))
            keep = np.isin(row, live)
            both = _matrix(docs, row[keep], token[keep]).astype(np.int64)
            pairs &= 100 * both >= percent * (n[:, None] + n[None, :] - both)
        links = (pairs * copies[None, :]).sum(axis=1)
        root = np.arange(docs)
        while True:
            low = np.minimum(root, np.where(pairs, root[None, :], docs).min(axis=1))
            low = low[low]
            if (low == root).all():
                break
            root = low
        linked = np.flatnonzero(links)
        return pa.Table.from_arrays([pa.array(rep[linked]), pa.array(rep[root[linked]]), pa.array(links[linked], pa.int64())],
                                    names=["u", "v", "links"])

    return run


def _cells(found: DataFrame) -> DataFrame:
    """A row per document and cell: cell, side (its block), cross (1 if the cell is of two blocks)."""
    sizes = found.groupBy("grp").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    blocks = sizes.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    small = blocks.where("blocks = 1").agg(F.coalesce(F.sum("size"), F.lit(0)).alias("s")).first()["s"]
    # Salted, so that the rows of one large group are joined in several tasks.
    salted = blocks.drop("size").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = (found.withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(SALTS)).cast("int"))
            .join(salted, ["grp", "salt"]).drop("salt"))
    rows = rows.withColumn("side", F.pmod(F.xxhash64("rep", F.lit(1)), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    many = max(1, -(-int(small) // BLOCK))         # small groups share cells
    cell = F.when(F.col("blocks") == 1, F.concat(F.lit("s"), F.pmod(F.xxhash64("grp"), F.lit(many)))).otherwise(
        F.concat_ws("-", "grp", F.least("side", "other"), F.greatest("side", "other")))
    return rows.withColumn("cell", cell).withColumn("cross", (F.col("side") != F.col("other")).cast("int")).drop("other", "blocks")


def ngram_join(spark: SparkSession, docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, n_links of every row of ``docs``."""
    docs = doc_columns(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"),
                                    F.md5("text").alias("same"))
    ids = docs.select("doc_id", "text_hash", "same")
    rep = F.coalesce(F.min("doc_id"), F.lit(NO_ID) + F.pmod(F.xxhash64("same"), F.lit(NO_ID))).alias("rep")
    copies = stage(spark, ids.groupBy("same").agg(rep, F.count(F.lit(1)).alias("copies")), "classes")
    n_bytes = text_bytes(docs)
    n = bucket_count(n_bytes)
    texts = batched(docs.select("same", "text").mapInArrow(_first_copies, "same string, text string"), n_bytes, "same")
    shared = per_bucket(per_batch(texts, _ask_tokens(size, n), PACKED), _find_shared)
    sets = stage(spark, with_replies(texts, shared, _prefixes(size, percent, n), SETS), "sets")
    live = sets.where("p1 is not null")
    groups = _groups(spark, live.select("same", "p1").join(copies, "same").select("rep", "p1"), "p1")
    found = live.join(groups.join(copies, "rep"), "same").drop("same")
    checked = _cells(found).groupBy("cell").applyInArrow(_verify(percent), "u long, v long, links long")
    checked = stage(spark, checked, "links")
    classes = connected_components(spark, checked.select("u", "v"))
    links = checked.groupBy(F.col("u").alias("rep")).agg(F.sum("links").alias("links"))
    of_rep = (sets.select("same", "n").join(copies, "same").join(classes.withColumnRenamed("node", "rep"), "rep", "left")
              .join(links, "rep", "left"))
    # Salted, so that the rows of one text's many copies are joined in several tasks.
    of_rep = of_rep.select("same", "rep", "n", "copies", "component", "links",
                           F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    out = ids.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(of_rep, ["same", "salt"], "left")
    empty, least = F.coalesce("n", F.lit(0)) == 0, F.coalesce("component", "rep")
    return out.select("doc_id", "text_hash", F.coalesce("n", F.lit(0)).cast("long").alias("n_shingles"),
                      F.when(empty, F.col("doc_id")).when(least < NO_ID, least).alias("component_id"),
                      F.when(empty, 0).otherwise(F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"))


def keep_one(spark: SparkSession, docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest id; columns stay.

    Rows that repeat that id and its text, and rows with a null id, all stay.
    """
    found = ngram_join(spark, docs, size, percent)
    return without(docs, found.where(F.col("doc_id") != F.col("component_id")))


def op4_ngram_join(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return ngram_join(spark, docs).select("doc_id", "n_shingles", "component_id", "n_links")


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS (
  SELECT a.doc_id AS u, b.doc_id AS v
  FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
        FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL) p
  JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
r(u, v) AS (SELECT u, v FROM e UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
       least(d.doc_id, coalesce((SELECT min(v) FROM r WHERE r.u = d.doc_id), d.doc_id)) AS component_id,
       (SELECT count(*) FROM e WHERE e.u = d.doc_id) AS n_links
FROM d LEFT JOIN n USING (doc_id)
"""
