"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

1. Word vectors (all documents, no labels). Words are hashed into ``BUCKETS``
   rows; every row has a fixed sparse random index vector. A word's vector is
   the sum of its neighbours' index vectors over the whole corpus, an integer
   count that tasks add up before the shuffle. The table is of fixed size.
2. Pooling. A document is the mean of its word vectors, of their squares and of
   the products of neighbours (which tells repetition from prose).
3. A two-layer numpy network on a bounded sample of labelled rows
   (about ``max_train`` rows, by a hash of their ids), then a temperature
   fitted on rows kept out of the training, so that scores are probabilities.

Labels serve the fit only; id, language and source are never inputs.

Defined cases: a null or empty text has the zero vector and still a score; rows
that repeat get equal scores; several labels of one id count as the highest;
labels without a document and null labels are passed over; without two classes
to learn from, every score is the share of label 1 (0.5 without labels).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import about, doc_columns, stage, without

BUCKETS = 1 << 15
DIMS = 64
NONZERO = 2             # entries of an index vector
REACH = 2               # neighbours on either side
ROW_BLOCKS = 64         # parts of the vector table that are added up apart
HIDDEN = 32
EPOCHS = 40
MAX_TRAIN = 20_000
CUT = 0.3
WORDS_AT_ONCE = 1 << 18  # words whose neighbours are counted at a time
POOL_AT_ONCE = 1 << 12   # word vectors held at a time


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def word_rows(texts: list[bytes]):
    """(row of each word, bounds of the texts): runs of letters and of signs, hashed into the table."""
    import numpy as np

    from strata.llm.text import hash_pieces
    from strata.llm.tokens import ENDS, KIND, STARTS

    raw = b"\n".join(texts)
    buf = np.frombuffer(raw, np.uint8)
    kind = np.zeros(len(buf) + 2, np.uint8)
    np.take(KIND, buf, out=kind[1:-1])
    pair = (kind[:-1] << 3) | kind[1:]
    starts, ends = np.flatnonzero(STARTS[pair]), np.flatnonzero(ENDS[pair])
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=at[1:])
    rows = (hash_pieces(buf, starts, ends) & np.uint64(BUCKETS - 1)).astype(np.int64)
    return rows, np.searchsorted(starts, at)


def index_vectors(seed: int):
    """(places, signs), BUCKETS x NONZERO: the fixed random index vectors."""
    import numpy as np

    rng = np.random.Generator(np.random.PCG64(seed))
    return rng.integers(0, DIMS, (BUCKETS, NONZERO)), rng.integers(0, 2, (BUCKETS, NONZERO)) * 2 - 1


def neighbour_sums(texts: list[bytes], places, signs, out) -> None:
    """Add to ``out`` (BUCKETS * DIMS): for each word, its neighbours' index vectors."""
    import numpy as np

    rows, first = word_rows(texts)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for a in range(0, len(rows), WORDS_AT_ONCE):
        own, own_doc = rows[a:a + WORDS_AT_ONCE + REACH], doc[a:a + WORDS_AT_ONCE + REACH]
        cells, weights = [], []
        for step in range(1, REACH + 1):
            n = min(WORDS_AT_ONCE, len(own) - step)
            same = np.flatnonzero(own_doc[step:step + n] == own_doc[:n])
            x, y = own[same], own[same + step]
            for word, other in ((x, y), (y, x)):
                cells.append((word[:, None] * DIMS + places[other]).ravel())
                weights.append(signs[other].ravel())
        out += np.bincount(np.concatenate(cells), np.concatenate(weights), len(out))


def train_vectors(spark: SparkSession, docs: DataFrame, seed: int = 7):
    """The table of word vectors, BUCKETS x DIMS float32: 8 MB, whatever the corpus."""
    import numpy as np

    step = BUCKETS // ROW_BLOCKS

    def run(batches):
        import pyarrow as pa
        import zstandard

        from strata.llm.text import chunks, encode

        places, signs = index_vectors(seed)
        total = np.zeros(BUCKETS * DIMS)       # whole numbers, exact in doubles
        for batch in batches:
            texts = encode(batch.column("text").to_pylist())
            for a, b in chunks(texts):
                neighbour_sums(texts[a:b], places, signs, total)
        total = total.astype(np.int64).reshape(BUCKETS, DIMS)
        small = zstandard.ZstdCompressor(level=1)
        for k in range(ROW_BLOCKS):
            part = total[k * step:(k + 1) * step]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array(
                    [small.compress(part.astype("<i8").tobytes())], pa.binary())], names=["k", "part"])

    def add(batches):
        import pyarrow as pa
        import zstandard

        sums, big = {}, zstandard.ZstdDecompressor()       # ROW_BLOCKS parts at most
        for batch in batches:
            for k, x in zip(batch.column("k").to_pylist(), batch.column("part").to_pylist()):
                part = np.frombuffer(big.decompress(x), "<i8")
                sums[k] = sums[k] + part if k in sums else part.copy()
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(
                [x.tobytes() for x in sums.values()], pa.binary())], names=["k", "part"])

    kind = "k int, part binary"
    parts = docs.select("text").mapInArrow(run, kind).repartition(ROW_BLOCKS, "k").mapInArrow(add, kind)
    table = np.zeros((BUCKETS, DIMS))
    for r in parts.collect():        # a row for each of ROW_BLOCKS parts
        table[r["k"] * step:(r["k"] + 1) * step] = np.frombuffer(r["part"], "<i8").reshape(step, DIMS)
    size = np.linalg.norm(table, axis=1, keepdims=True)
    unit = np.divide(table, size, out=np.zeros_like(table), where=size > 0)
    seen = size[:, 0] > 0
    if seen.any():
        unit[seen] -= unit[seen].mean(axis=0)
    return unit.astype(np.float32)


def pool(texts: list[bytes], vectors):
    """Per text: means of the word vectors, of their squares and of neighbours' products.

    Words are taken in runs of bounded length, whatever texts they belong to.
    """
    import numpy as np

    rows, first = word_rows(texts)
    out = np.zeros((len(texts), 3 * DIMS), np.float32)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    for a in range(0, len(rows), POOL_AT_ONCE):
        n = min(POOL_AT_ONCE, len(rows) - a)
        words, own = vectors[rows[a:a + n + 1]], doc[a:a + n + 1]
        begin = np.flatnonzero(np.diff(own[:n], prepend=-1))
        to = own[begin]
        out[to, :DIMS] += np.add.reduceat(words[:n], begin, axis=0)
        out[to, DIMS:2 * DIMS] += np.add.reduceat(words[:n] * words[:n], begin, axis=0)
        m = len(words) - 1
        if m:
            words[:m] *= words[1:]
            words[:m][own[:m] != own[1:]] = 0          # a text's last word has no neighbour
            cut = begin[begin < m]
            out[own[cut], 2 * DIMS:] += np.add.reduceat(words[:m], cut, axis=0)
    n = np.diff(first)[:, None]
    out[:, :2 * DIMS] /= np.maximum(n, 1)
    out[:, 2 * DIMS:] /= np.maximum(n - 1, 1)
    return out


def pooled(spark: SparkSession, docs: DataFrame, vectors) -> DataFrame:
    """doc_id, text_hash, features (binary float32) of every row, stored."""
    data = spark.sparkContext.broadcast(vectors)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        from strata.llm.text import chunks, encode

        for batch in batches:
            texts = encode(batch.column("text").to_pylist())
            for a, b in chunks(texts):
                x = pool(texts[a:b], data.value)
                cut = np.arange(b - a + 1, dtype=np.int32) * (12 * DIMS)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), batch.column("text_hash").slice(a, b - a),
                     pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(cut), pa.py_buffer(x)])],
                    names=["doc_id", "text_hash", "features"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    return stage(spark, docs.mapInArrow(run, f"doc_id {kind}, text_hash long, features binary"), "pooled")


class Network:
    """Two layers, a logistic output and a temperature."""

    def __init__(self, x, y, seed: int = 7, hidden: int = HIDDEN, epochs: int = EPOCHS, batch: int = 256):
        import numpy as np

        self.base = float(y.mean()) if len(y) else 0.5
        self.trained = bool(len(y)) and 0 < self.base < 1
        if not self.trained:
            return
        rng = np.random.Generator(np.random.PCG64(seed))
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + np.float32(1e-6)
        keep = rng.random(len(y)) < 0.8            # the rest sets the temperature
        z = (x - self.mean) / self.scale
        w = [rng.normal(0, (2 / z.shape[1]) ** 0.5, (z.shape[1], hidden)), np.zeros(hidden),
             rng.normal(0, (1 / hidden) ** 0.5, hidden), np.zeros(1)]
        w = [p.astype(np.float32) for p in w]
        m, v, t = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
        zt, yt = z[keep], y[keep]
        for _ in range(epochs):
            order = rng.permutation(len(yt))
            for i in range(0, len(order), batch):
                a, b = zt[order[i:i + batch]], yt[order[i:i + batch]]
                h = np.maximum(a @ w[0] + w[1], 0)
                err = (_sigmoid(h @ w[2] + w[3]) - b) / len(b)
                back = np.outer(err, w[2]) * (h > 0)
                grads = [a.T @ back + 1e-4 * w[0], back.sum(axis=0), h.T @ err + 1e-4 * w[2], err.sum(keepdims=True)]
                t += 1
                for p, g, mi, vi in zip(w, grads, m, v):
                    mi += 0.1 * (g - mi)
                    vi += 0.001 * (g * g - vi)
                    p -= 0.002 * (mi / (1 - 0.9 ** t)) / ((vi / (1 - 0.999 ** t)) ** 0.5 + 1e-8)
        self.w, self.temperature = w, 1.0
        logit, yc = self.logits(x[~keep]), y[~keep]
        if len(yc) and 0 < yc.mean() < 1:
            def loss(temp):
                p = np.clip(_sigmoid(logit / temp), 1e-12, 1 - 1e-12)
                return -(yc * np.log(p) + (1 - yc) * np.log(1 - p)).mean()
            self.temperature = float(min(np.geomspace(0.25, 8, 61), key=loss))

    def logits(self, x):
        import numpy as np

        return np.maximum((x - self.mean) / self.scale @ self.w[0] + self.w[1], 0) @ self.w[2] + self.w[3]

    def score(self, x):
        import numpy as np

        if not self.trained:
            return np.full(len(x), self.base)
        return _sigmoid(self.logits(x) / self.temperature)


def _sigmoid(x):
    import numpy as np

    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit(features: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Network:
    """A network from labelled rows whose ids are not held out, about ``max_train`` of them.

    Copies of a row train once; if the sampled ids still have over twice
    ``max_train`` rows (many texts under one id), about so many of them train.
    """
    import numpy as np

    known = (labels.select("doc_id", "quality").where(F.col("quality").isNotNull() & ~held_out())
             .groupBy("doc_id").agg(F.max("quality").alias("quality")))
    known = about(known, ["doc_id"], max_train, known.count())
    pairs = features.select("doc_id", "text_hash").join(known, "doc_id").distinct()
    pairs = about(pairs, ["doc_id", "text_hash"], 2 * max_train, pairs.count())
    rows = (features.join(pairs, ["doc_id", "text_hash"]).dropDuplicates(["doc_id", "text_hash"])
            .orderBy("doc_id", "text_hash").select("features", "quality").collect())
    x = np.frombuffer(b"".join(bytes(r["features"]) for r in rows), np.float32).reshape(-1, 3 * DIMS)
    return Network(x, np.array([r["quality"] for r in rows], np.float32))


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, cut: float = CUT) -> DataFrame:
    """doc_id, text_hash, score (0 to 1), predicted of every row."""
    docs = doc_columns(docs)
    features = pooled(spark, docs, train_vectors(spark, docs))
    net = fit(features, labels, max_train)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            x = np.frombuffer(b"".join(batch.column("features").to_pylist()), np.float32).reshape(-1, 3 * DIMS)
            score = net.score(x).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(score),
                 pa.array((score >= cut).astype(np.int32))], names=["doc_id", "text_hash", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return features.mapInArrow(run, f"doc_id {kind}, text_hash long, score double, predicted int")


def drop_rejected(spark: SparkSession, docs: DataFrame, labels: DataFrame, **kw) -> DataFrame:
    """``docs`` without rows that the classifier rejects; columns stay."""
    return without(docs, classify(spark, docs, labels, **kw).where("predicted = 0"))


def op5_quality(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return classify(spark, docs, labels).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"),
                                                "score", "predicted")
