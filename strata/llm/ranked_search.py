"""Ranked lexical search with FP-trees of documents.

The terms of a block of items are numbered by falling document frequency. Each
document is cut down to those terms and becomes an ascending vector of (term,
tf). In every shard of documents the vectors form a trie, so documents with the
same frequent terms share a path: sorted vectors are the trie in depth-first
order and a node is a range of them. A node knows, of all documents below it,
the greatest tf of every term, the least m and the least id.

A term's part of a score grows with tf and falls with m, so a node's maxima and
least m bound every score below it. Each item goes through the trie depth first,
best child first, and leaves out nodes whose bound cannot reach its 50th best;
documents on the last level are scored exactly. The 50th best comes from a
first run over a share of the shards, so later shards start with a high one and
what all of them send to the final ranking does not grow with their number.

Score: the sum over an item's distinct terms of w * (10**9 tf div (1000 tf +
20 m)), with w = floor(1000 ln((2N + 2) / (2 df + 1))), m = 50 + (50 n N) div L,
n a document's terms with repeats, L all terms, N the documents with a term.

Items go through in blocks of bounded size (``BLOCK_BYTES``), each written
before the next, so the driver and the tasks hold one block's terms at a time.

Defined cases: document ids are integers; on equal scores a null id comes last.
A null or empty text has no term and no rank. Every row is a document, so rows
with one id are ranked each. The terms of an item are those of all rows with its
id (null is an id too); an item without a term, or without any document that has
one, has no rows. Empty tables give no rows. Other columns are left out.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import doc_columns, stage, text_bytes

TOP = 50
BLOCK_BYTES = 4 << 20       # text of the items that are searched at a time
TREE_TERMS = 4096           # distinct terms of the items that share a tree (a single item may have more)
SHARD_DOCS = 8192           # documents and postings of a tree, about
SHARD_POSTINGS = 1 << 21
PAGE = 16                   # a node of at most so many documents is not split further
FIRST_SHARE = 16            # one row of the vectors in so many is searched first, for the 50th best
NO_ID = (1 << 63) - 1       # a null id: after all others


class Block:
    """Items and their terms: ``items`` are (id, distinct term numbers), ``vocab`` the terms' hashes, ascending."""

    def __init__(self, rows: list[tuple]):
        import numpy as np

        from strata.llm.text import ALNUM_TABLE, encode, hash_pieces, split

        words, buf = split(encode([t for _, t in rows]), ALNUM_TABLE, True)
        self.vocab, ids = np.unique(hash_pieces(buf, words.starts, words.ends), return_inverse=True)
        of: dict = {}
        for (item, _), a, b in zip(rows, words.first, words.first[1:]):
            of.setdefault(item, []).append(ids[a:b])
        self.items = [(item, np.unique(np.concatenate(x))) for item, x in of.items()]
        self.items = [(item, x) for item, x in self.items if len(x)]


VECTORS = ("n_docs long, n_terms long, doc_ids binary, sizes binary, bounds binary, terms binary, tfs binary, share int")


def vectors(docs: DataFrame, vocab) -> DataFrame:
    """Documents cut down to the terms of ``vocab`` (a broadcast of ascending hashes), a row per chunk of texts.

    n_docs and n_terms count documents with a term and their terms, of any kind;
    the arrays hold the documents that have a term of the vocabulary.
    """
    def run(batches):
        import numpy as np
        import pyarrow as pa

        from strata.llm.pretokens import text_slices
        from strata.llm.text import ALNUM_TABLE, CHUNK, encode, hash_pieces, mix, split

        known = vocab.value
        for batch in batches:
            for rows, texts in text_slices(batch, CHUNK):
                words, buf = split(encode(texts), ALNUM_TABLE, True)
                h = hash_pieces(buf, words.starts, words.ends)
                size = words.counts
                at = np.minimum(np.searchsorted(known, h), max(len(known) - 1, 0))
                here = known[at] == h if len(known) else np.zeros(len(h), bool)
                pair, tf = np.unique((np.repeat(np.arange(len(size)), size)[here] << 32) | at[here], return_counts=True)
                docs_of, bounds = np.unique(pair >> 32, return_index=True)
                ids = rows.column("doc_id").fill_null(NO_ID).to_numpy()[docs_of]
                share = int(mix(np.array([len(pair), int(ids[:1].sum()), int(size.sum())], np.uint64)).sum() % np.uint64(FIRST_SHARE))
                yield pa.RecordBatch.from_pydict({
                    "n_docs": pa.array([int((size > 0).sum())]), "n_terms": pa.array([int(size.sum())]),
                    **{k: pa.array([v.tobytes()], pa.binary()) for k, v in (
                        ("doc_ids", ids.astype("<i8")), ("sizes", size[docs_of].astype("<i8")),
                        ("bounds", np.append(bounds, len(pair)).astype("<i8")),
                        ("terms", (pair & 0xFFFFFFFF).astype("<u4")), ("tfs", tf.astype("<u4")))},
                    "share": pa.array([share], pa.int32())})

    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    return docs.mapInArrow(run, VECTORS)


def _frequencies(spark: SparkSession, stored: DataFrame, n: int):
    """(N, L, df of each of ``n`` terms); the terms are a block's, so they fit the driver."""
    import numpy as np

    def run(batches):
        import numpy as np
        import pyarrow as pa

        df = np.zeros(n, np.int64)
        for batch in batches:
            for terms in batch.column("terms"):
                df += np.bincount(np.frombuffer(terms.as_buffer(), "<u4"), minlength=n)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"term": pa.array(at, pa.int64()), "df": pa.array(df[at], pa.int64())})

    total = stored.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    def packed(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_pydict({c: pa.array([batch.column(c).to_numpy().astype("<i8").tobytes()], pa.binary())
                                              for c in ("term", "df")})

    df = np.zeros(n, np.int64)
    counted = stored.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for r in counted.mapInArrow(packed, "term binary, df binary").collect():       # arrays of n numbers in all
        df[np.frombuffer(r["term"], "<i8")] = np.frombuffer(r["df"], "<i8")
    return total[0], total[1], df


class Tree:
    """The FP-tree of a shard's documents over some terms."""

    def __init__(self, ids, m, bounds, terms, tfs, n_terms: int):
        import numpy as np

        # Sorted vectors are the leaves in depth-first order; lcp[i] terms are shared by the documents i - 1 and i.
        big = terms.astype(">u4")
        keys = [big[a:b].tobytes() for a, b in zip(bounds.tolist(), bounds[1:].tolist())]
        order = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
        count = np.diff(bounds)[order]
        self.bounds = np.concatenate([[0], np.cumsum(count)])
        take = np.repeat(bounds[:-1][order] - self.bounds[:-1], count) + np.arange(int(self.bounds[-1]))
        self.ids, self.m, self.terms, self.tfs = ids[order], m[order], terms[take].astype(np.int64), tfs[take].astype(np.int64)
        lcp = self._shared(count)
        self.begin, self.end, self.children = [0], [len(order)], [[]]
        stack = [0]
        while stack:
            node = stack.pop()
            for a, b in self._parts(lcp, self.begin[node], self.end[node]):
                self.children[node].append(len(self.begin))
                if b - a > PAGE:
                    stack.append(len(self.begin))
                self.begin.append(a), self.end.append(b), self.children.append([])
        self._summarise(n_terms)

    def _shared(self, count):
        import numpy as np

        lcp, live, depth = np.zeros(len(count), np.int64), np.arange(1, len(count)), 0
        while len(live):
            live = live[(count[live] > depth) & (count[live - 1] > depth)]
            live = live[self.terms[self.bounds[live] + depth] == self.terms[self.bounds[live - 1] + depth]]
            depth += 1
            lcp[live] = depth
        return lcp

    @staticmethod
    def _parts(lcp, a: int, b: int) -> list[tuple[int, int]]:
        """The parts of a node: subtrees at the place where its paths part; neighbours of a page's size in all stay one.

        While one subtree has nearly all documents, its parts take its place, so nodes are about as many as pages.
        """
        import numpy as np

        if b - a <= PAGE:
            return []
        left, right, todo = [], [], (a, b)
        while todo:
            x, y = todo
            inner = lcp[x + 1:y]
            cuts = [x, *(np.flatnonzero(inner == inner.min()) + x + 1).tolist(), y]
            parts = list(zip(cuts, cuts[1:]))
            large = [p for p in parts if p[1] - p[0] > PAGE]
            todo = None
            if len(large) == 1 and len(parts) > 1 and (b - a) - (large[0][1] - large[0][0]) < PAGE:
                k = parts.index(large[0])
                left, right, todo = left + parts[:k], parts[k + 1:] + right, large[0]
            else:
                left += parts
        out: list[tuple[int, int]] = []
        for x, y in left + right:
            if out and y - out[-1][0] <= PAGE:
                out[-1] = (out[-1][0], y)
            else:
                out.append((x, y))
        return out

    def _summarise(self, n_terms: int):
        """tf maxima, least m and least id of every node, the last level from its documents and others from their children."""
        import numpy as np

        self.tf = np.zeros((len(self.begin), n_terms), np.int32)
        self.least_m, self.least_id = (np.empty(len(self.begin), np.int64) for _ in range(2))
        for node in range(len(self.begin) - 1, -1, -1):          # children have larger numbers
            if kids := self.children[node]:
                self.tf[node] = self.tf[kids].max(axis=0)
                self.least_m[node], self.least_id[node] = self.least_m[kids].min(), self.least_id[kids].min()
            else:
                a, b = self.begin[node], self.end[node]
                p, q = self.bounds[a], self.bounds[b]
                np.maximum.at(self.tf[node], self.terms[p:q], self.tfs[p:q])
                self.least_m[node], self.least_id[node] = self.m[a:b].min(), self.ids[a:b].min()

    def search(self, terms, weights, column, best: "Best"):
        """Puts the documents that belong to an item's best there. ``column`` has a term's place among ``terms``, or -1."""
        import numpy as np

        tf = self.tf[:, terms].astype(np.int64)
        bound = (weights * ((10 ** 9 * tf) // (1000 * tf + 20 * self.least_m[:, None]))).sum(axis=1)
        live = (bound > 0).tolist()
        bound, least = bound.tolist(), self.least_id.tolist()
        stack = [0] if live[0] else []
        while stack:
            node = stack.pop()
            if not best.admits(bound[node], least[node]):
                continue
            if kids := self.children[node]:
                stack += sorted((k for k in kids if live[k] and best.admits(bound[k], least[k])), key=bound.__getitem__)
                continue
            a, b = self.begin[node], self.end[node]
            p, q = self.bounds[a], self.bounds[b]
            at = column[self.terms[p:q]]
            hit = np.flatnonzero(at >= 0)
            tf, doc = self.tfs[p:q][hit], np.searchsorted(self.bounds[a:b + 1], p + hit, "right") - 1
            part = weights[at[hit]] * ((10 ** 9 * tf) // (1000 * tf + 20 * self.m[a:b][doc]))
            total = np.zeros(b - a, np.int64)
            np.add.at(total, doc, part)
            for k in np.flatnonzero(total >= max(best.score, 1)).tolist():
                best.offer(int(total[k]), int(self.ids[a + k]))


class Best:
    """The best documents of an item so far, at most TOP; ``score`` and ``last`` are those that must be beaten."""

    def __init__(self, score: int = 0, last: int = NO_ID):
        self.score, self.last, self.heap = score, last, []

    def admits(self, score: int, doc_id: int) -> bool:
        return score > self.score or score == self.score and doc_id <= self.last

    def offer(self, score: int, doc_id: int):
        import heapq

        if self.admits(score, doc_id):
            heapq.heappush(self.heap, (score, -doc_id))
            if len(self.heap) > TOP:
                heapq.heappop(self.heap)
            if len(self.heap) == TOP:
                self.score, self.last = self.heap[0][0], -self.heap[0][1]


def _groups(items: list) -> list[list[int]]:
    """Numbers of items whose terms are at most TREE_TERMS together, or of one item."""
    out: list[list[int]] = []
    terms: set = set()
    for k, (_, x) in enumerate(items):
        both = terms.union(x.tolist())
        if out and len(both) <= TREE_TERMS:
            out[-1].append(k)
            terms = both
        else:
            out.append([k])
            terms = set(x.tolist())
    return out


def _tops(stored: DataFrame, data, kind: str) -> DataFrame:
    """item_id, doc_id, score: of every task and item the documents that may be among the best.

    ``data`` is a broadcast of (items, weights, frequency rank of each term, N, L, what must be beaten by item).
    """
    def run(batches):
        import numpy as np
        import pyarrow as pa

        items, weights, rank, n_docs, n_terms, beaten = data.value
        bests = [Best(*x) for x in beaten]
        groups = []                   # (items, their terms by falling frequency, a term's place among them)
        for numbers in _groups(items):
            own = np.unique(np.concatenate([items[k][1] for k in numbers]))
            own = own[np.argsort(rank[own])]
            place = np.full(len(rank), -1, np.int64)
            place[own] = np.arange(len(own))
            groups.append((numbers, own, place))

        def shard(rows):
            arrays = lambda c, t: [np.frombuffer(r[c].as_buffer(), t) for r in rows]
            ids, size = (np.concatenate(arrays(c, "<i8")) for c in ("doc_ids", "sizes"))
            terms, tfs = (np.concatenate(arrays(c, "<u4")) for c in ("terms", "tfs"))
            doc = np.repeat(np.arange(len(ids)), np.concatenate([np.diff(x) for x in arrays("bounds", "<i8")]))
            m = 50 + (50 * size * n_docs) // n_terms
            for numbers, own, place in groups:
                here = place[terms]
                keep = np.flatnonzero(here >= 0)
                keep = keep[np.lexsort((here[keep], doc[keep]))]
                some, bounds = np.unique(doc[keep], return_index=True)
                if not len(some):
                    continue
                tree = Tree(ids[some], m[some], np.append(bounds, len(keep)), here[keep], tfs[keep], len(own))
                column = np.full(len(own), -1, np.int64)
                for k in numbers:
                    at = place[items[k][1]]
                    column[at] = np.arange(len(at))
                    tree.search(at, weights[items[k][1]], column, bests[k])
                    column[at] = -1

        rows, docs, postings = [], 0, 0
        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r] for c in ("doc_ids", "sizes", "bounds", "terms", "tfs")}
                rows.append(row)
                docs += len(row["doc_ids"].as_buffer()) // 8
                postings += len(row["terms"].as_buffer()) // 4
                if docs >= SHARD_DOCS or postings >= SHARD_POSTINGS:
                    shard(rows)
                    rows, docs, postings = [], 0, 0
        if docs:
            shard(rows)
        found = [(k, -i, s) for k, b in enumerate(bests) for s, i in b.heap]
        names = pa.array([i for i, _ in items]) if items else pa.array([], pa.int64())
        yield pa.RecordBatch.from_pydict({
            "item_id": names.take(pa.array([k for k, _, _ in found], pa.int64())).cast(arrow_kind),
            "doc_id": pa.array([None if i == NO_ID else i for _, i, _ in found], pa.int64()),
            "score": pa.array([s for _, _, s in found], pa.int64())})

    import pyarrow as pa

    arrow_kind = pa.string() if kind == "string" else pa.int64()
    rows = stored.select("doc_ids", "sizes", "bounds", "terms", "tfs")
    return rows.mapInArrow(run, f"item_id {'string' if kind == 'string' else 'long'}, doc_id long, score long")


def _ranked(tops: DataFrame) -> DataFrame:
    """The TOP best of each item; the rank limit is applied before the shuffle as well as after it."""
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return tops.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)


def search(spark: SparkSession, docs: DataFrame, items: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score of each item's best documents."""
    import numpy as np

    docs = doc_columns(docs)
    kind = items.schema[item_col].dataType.simpleString()
    as_ = "string" if kind == "string" else "long"
    items = items.select(F.col(item_col).cast(as_).alias("item_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).distinct()
    n_blocks = -(-text_bytes(items) // BLOCK_BYTES)
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for k in range(n_blocks):
        of_block = F.pmod(F.xxhash64(F.lit("block"), "item_id"), F.lit(n_blocks)) == k
        block = Block([(r["item_id"], r["text"]) for r in items.where(of_block).collect()])      # about BLOCK_BYTES
        if not block.items:
            continue
        vocab = spark.sparkContext.broadcast(block.vocab)
        stored = stage(spark, vectors(docs, vocab), "vectors")
        vocab.unpersist()
        n_docs, n_terms, df = _frequencies(spark, stored, len(block.vocab))
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        rank = np.empty(len(df), np.int64)
        rank[np.lexsort((block.vocab, -df))] = np.arange(len(df))
        beaten: list[tuple] = [(0, NO_ID)] * len(block.items)
        number = {item: i for i, (item, _) in enumerate(block.items)}
        for rows in (stored.where("share = 0"), stored):       # the 50th best of a share is a bound for all
            data = spark.sparkContext.broadcast((block.items, weights, rank, n_docs, n_terms, beaten))
            ranked = stage(spark, _ranked(_tops(rows, data, kind)), "ranked")
            data.unpersist()
            for r in ranked.where(F.col("rank") == TOP).collect():       # one row an item of the block
                beaten[number[r["item_id"]]] = (r["score"], NO_ID if r["doc_id"] is None else r["doc_id"])
        out = out.unionByName(ranked.select(F.col("item_id").cast(kind).alias("item_id"), "rank", "doc_id", "score"))
    return out


def op12_ranked_search(spark, sf_dir: str) -> DataFrame:
    return search(spark, *(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark")))


ORACLE = r"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
d AS (SELECT r, doc_id, len(w) AS n, w FROM words WHERE len(w) > 0),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM d),
asked AS (
  SELECT DISTINCT item_id, t FROM (
    SELECT item_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS t FROM benchmark)),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM asked) GROUP BY r, t),
weight AS (
  SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, total GROUP BY t, docs),
scored AS (
  SELECT item_id, r, sum(weight.w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))))::BIGINT AS score
  FROM asked JOIN tf USING (t) JOIN weight USING (t) JOIN d USING (r), total GROUP BY item_id, r),
ranked AS (
  SELECT item_id, doc_id, score,
         row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored JOIN d USING (r) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""
