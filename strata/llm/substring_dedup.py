"""Substring dedup with fixed-block anchors: passages that occur more than once are removed.

With windows of 35 words, blocks are the non-overlapping runs of 18 words of a
document; every window holds one whole block. The index holds the blocks; every
rolling window of 18 words of every document probes it. A block that any other
place repeats is an anchor, and its places are extended: only windows around
anchors are compared as a whole, by a longer hash, and those found at more than
one place are united to maximal repeats, which are cut out.

Blocks and probes of one content meet in the bucket of their hash, once per
batch of documents (``keys``), so a passage of a third of all documents is one
entry per batch. Anchors are judged by 30 bits within a bucket, which may admit
a stray; windows by 64 bits within a bucket chosen by other bits (over 70).

Windows are judged on the input. Words are runs of other bytes than
[\\x20\\x09-\\x0D], unchanged.

Defined cases: a null or empty text has no words; a text shorter than a window
loses nothing; rows repeated as a whole are copies of each other and lose all
their windows; a passage repeated inside one text is cut at both places;
other columns are left out; a single text is handled in one task's memory.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import doc_columns, text_bytes
from strata.llm.keys import (PACKED, batched, bucket_count, bucket_of, member, packed, per_batch, per_bucket,
                             replies, unpacked, with_replies)
from strata.llm.text import SPACE_TABLE, WORD_POWERS, WORD_POWERS_2, encode, hash_pieces, split, window_hashes

WINDOW = 35
PAYLOAD = np.uint64(0x3FFFFFFF)


def _words(table: pa.Table):
    words, buf = split(encode(table.column("text").to_pylist()), SPACE_TABLE, False)
    return words, hash_pieces(buf, words.starts, words.ends)


def _codes(hashes: np.ndarray, n: int) -> np.ndarray:
    """(bucket, 30 bits) of block hashes as one ascending-by-bucket number."""
    return (bucket_of(hashes, n) << np.uint64(30)) | (hashes & PAYLOAD)


def _ask_blocks(block: int, n_buckets: int):
    def run(table: pa.Table) -> pa.Table:
        words, w = _words(table)
        hashes, ok = window_hashes(w, words.first, block)
        place = np.arange(len(w)) - np.repeat(words.first[:-1], words.counts)
        v = (_codes(hashes, n_buckets) << np.uint64(1) | (place % block == 0).astype(np.uint64))[ok]
        v.sort()
        code = v >> np.uint64(1)
        new = np.flatnonzero(np.diff(code, prepend=~code[:1]))
        last = np.append(new, len(v))[1:] - 1
        in_index, many = v[last] & np.uint64(1), (last > new).astype(np.uint64)
        code = code[new]
        value = ((code & PAYLOAD) << np.uint64(2)) | (in_index << np.uint64(1)) | many
        return packed(table.column("batch")[0].as_py(), (code >> np.uint64(30)).astype(np.int64), value.astype("<u4"))

    return run


def _find_anchors(table: pa.Table) -> pa.Table:
    """Of each batch's keys, those in the index that stand at two places or more."""
    row, v = unpacked(table, "<u4")
    key = v >> 2
    order = np.argsort(key, kind="stable")
    new = np.flatnonzero(np.diff(key[order].astype(np.int64), prepend=-1))
    size = np.diff(np.append(new, len(v)))
    places = size + np.add.reduceat(v[order] & 1, new)
    good = (places > 1) & (np.bitwise_or.reduceat(v[order] & 2, new) > 0)
    keep = np.zeros(len(v), bool)
    keep[order] = np.repeat(good, size)
    return replies(table, row[keep], key[keep].astype("<u4"))


def _ask_windows(size: int, block: int, n_buckets: int, n_windows: int):
    def run(docs: pa.Table, anchors: pa.Table) -> pa.Table:
        if not docs.num_rows or not anchors.num_rows:
            return packed(0, np.empty(0, np.int64), np.empty(0, "<u8"))
        words, w = _words(docs)
        row, key = unpacked(anchors, "<u4")
        known = np.sort((np.asarray(anchors.column("bucket")).astype(np.uint64)[row] << np.uint64(30)) | key)
        hashes, ok = window_hashes(w, words.first, block)
        anchor = ok & member(_codes(hashes, n_buckets), known)
        # a window is a candidate if an anchor begins at one of its first size - block + 1 words
        seen = np.concatenate([[0], np.cumsum(anchor)])
        p = np.flatnonzero(_starts(words, size))
        p = p[seen[np.minimum(p + size - block + 1, len(w))] > seen[p]]
        bucket, value = _long_keys(w, words.first, size, p, n_windows)
        order = np.lexsort((value, bucket))
        bucket, value = bucket[order], value[order]
        new = np.flatnonzero(np.diff(bucket, prepend=-1) | (np.diff(value, prepend=~value[:1]) != 0)) if len(p) else p
        many = np.diff(np.append(new, len(p))) > 1
        value = (value[new] & ~np.uint64(1)) | many.astype(np.uint64)
        return packed(docs.column("batch")[0].as_py(), bucket[new], value.astype("<u8"))

    return run


def _starts(words, size: int) -> np.ndarray:
    """Where a window of ``size`` words begins inside its text."""
    n = int(words.first[-1])
    last = np.repeat(words.first[1:], words.counts)
    return np.arange(n) + size <= last


def _long_keys(w, first, size: int, places: np.ndarray, n_buckets: int):
    """(bucket, 63 bits) of the windows at ``places``, from two independent hashes."""
    bucket = bucket_of(window_hashes(w, first, size, WORD_POWERS_2)[0][places], n_buckets).astype(np.int64)
    return bucket, window_hashes(w, first, size, WORD_POWERS)[0][places] & ~np.uint64(1)


def _find_repeats(table: pa.Table) -> pa.Table:
    row, v = unpacked(table, "<u8")
    key = v & ~np.uint64(1)
    order = np.argsort(key, kind="stable")
    new = np.flatnonzero(np.diff(key[order], prepend=~key[order][:1]))
    size = np.diff(np.append(new, len(v)))
    good = size + np.add.reduceat((v[order] & np.uint64(1)).astype(np.int64), new) > 1
    keep = np.zeros(len(v), bool)
    keep[order] = np.repeat(good, size)
    return replies(table, row[keep], key[keep])


def _cut(size: int, n_windows: int):
    def run(docs: pa.Table, repeats: pa.Table) -> pa.Table:
        words, w = _words(docs)
        gone = np.zeros(len(w), bool)
        if docs.num_rows and repeats.num_rows:
            row, key = unpacked(repeats, "<u8")
            in_bucket = np.asarray(repeats.column("bucket")).astype(np.int64)[row]
            p = np.flatnonzero(_starts(words, size))
            bucket, value = _long_keys(w, words.first, size, p, n_windows)
            # membership in (bucket, value): values alone first, then the bucket of the few that match
            order = np.argsort(key, kind="stable")
            at = np.minimum(np.searchsorted(key[order], value), len(key) - 1)
            hit = key[order][at] == value
            hit[hit] = in_bucket[order][at[hit]] == bucket[hit]
            step = np.zeros(len(w) + 1, np.int64)
            np.add.at(step, p[hit], 1)
            np.add.at(step, p[hit] + size, -1)
            gone = np.cumsum(step[:-1]) > 0
        kept, spans = [], []
        text = words.raw
        removed = np.concatenate([[0], np.cumsum(gone)])
        n_removed = removed[words.first[1:]] - removed[words.first[:-1]]
        starts, ends = words.starts.tolist(), words.ends.tolist()
        for d in range(docs.num_rows):
            a, b = int(words.first[d]), int(words.first[d + 1])
            if not n_removed[d]:
                lo = int(words.at[d])
                hi = int(words.at[d + 1]) - 1 if d + 1 < docs.num_rows else len(text)
                kept.append(b" ".join(text[lo:hi].split()))
                spans.append([])
                continue
            kept.append(b" ".join(text[starts[i]:ends[i]] for i in (np.flatnonzero(~gone[a:b]) + a).tolist()))
            edge = np.flatnonzero(np.diff(np.concatenate([[0], gone[a:b].astype(np.int8), [0]])))
            spans.append([{"a": x, "b": y} for x, y in edge.reshape(-1, 2).tolist()])
        return pa.Table.from_arrays(
            [docs.column("doc_id").combine_chunks(), docs.column("text_hash").combine_chunks(),
             pa.array(words.counts, pa.int64()), pa.array(n_removed, pa.int64()),
             pa.array(kept, pa.binary()).cast(pa.string()), pa.array(spans, SPANS)],
            names=["doc_id", "text_hash", "n_words", "n_removed", "kept_text", "spans"])

    return run


SPANS = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))


def remove_repeats(spark: SparkSession, docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, text_hash, n_words, n_removed, kept_text, spans (word ranges of the maximal repeats) of every row."""
    block = (window + 1) // 2
    docs = doc_columns(docs).withColumn("text_hash", F.xxhash64("text"))
    n_bytes = text_bytes(docs)
    n = bucket_count(n_bytes)
    docs = batched(docs, n_bytes, "doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    anchors = per_bucket(per_batch(docs, _ask_blocks(block, n), PACKED), _find_anchors)
    repeats = per_bucket(with_replies(docs, anchors, _ask_windows(window, block, n, n), PACKED), _find_repeats)
    return with_replies(docs, repeats, _cut(window, n),
                        f"doc_id {kind}, text_hash long, n_words long, n_removed long, kept_text string, "
                        "spans array<struct<a: long, b: long>>")


def op2_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeats(spark, docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (
  SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
r AS (SELECT hash(s) AS h, md5(s) AS m FROM p GROUP BY ALL HAVING count(*) > 1),
c AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i
  FROM (SELECT doc_id, i FROM p JOIN r ON hash(p.s) = r.h AND md5(p.s) = r.m)),
k AS (
  SELECT d.doc_id, d.i, d.x, c.i IS NOT NULL AS gone
  FROM (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM d) d LEFT JOIN c USING (doc_id, i)),
o AS (
  SELECT doc_id, count(*) FILTER (gone) AS n, string_agg(x, ' ' ORDER BY i) FILTER (NOT gone) AS t FROM k GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN o USING (doc_id)
"""
