"""Token-id output: documents as separately compressed id arrays with a shared dictionary.

A table of blocks in ascending document order. A block is one binary value:

    magic "STID1\\0", flags (1: 2-byte ids), two spare bytes      8 bytes
    dictionary hash                                               8 bytes
    count of documents                                            8 bytes
    doc ids, token counts, frame offsets (count + 1)              8 bytes each
    one zstandard frame per document

The index lets a reader decompress one short document of a block alone. The
dictionary is trained once on serialized id arrays and stored beside the blocks;
readers refuse blocks of another dictionary. Block rows are written with Spark's
own writer, so they may live in any store that Spark reaches.

Ids are 2 bytes where the vocabulary allows, else 4.

``DICT_SAMPLE`` bounds the training sample only: ids are written for all rows.

Defined cases: a null or empty text is its end id alone; equal doc ids follow
each other in order of their ids' checksum; a null doc id comes first and reads
back as null; with too few texts to train on, frames carry no dictionary.
"""

from __future__ import annotations

import struct

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import about, crc_share, doc_columns, id_ranges
from strata.llm.tokens import word_tokenizer
from strata.session import scratch_dir

MAGIC = b"STID1\0"
HEAD = struct.Struct("<6sBxQQ")
DICT_SAMPLE = 1000          # about so many documents train the dictionary
DICT_SAMPLE_BYTES = 1 << 16  # longer texts are left out of the sample
DICT_BYTES = 1 << 15
LEVEL = 3
BLOCK_BYTES = 1 << 20
NULL_ID = -(2 ** 63)

FRAMES = "doc_id long, n_tokens long, ids_crc32 long, frame binary"
BLOCKS = "range_no int, block_no long, n_docs long, n_tokens long, block binary"


def ids_width(path: str) -> int:
    from strata.llm.tokens import encoder

    return 2 if encoder(path, None).tok.get_vocab_size() <= 1 << 16 else 4


def train_dictionary(docs: DataFrame, path: str, end_id: int | None, width: int) -> bytes:
    """A zstandard dictionary from the ids of a sample of about ``DICT_SAMPLE`` rows.

    Copies of a row count once; if the sampled ids still have over twice as many
    rows (many texts under one id), about that many are taken.
    """
    import zstandard

    from strata.llm.text import encode
    from strata.llm.tokens import encoder

    some = about(docs, ["doc_id"], DICT_SAMPLE, docs.count()).where(F.octet_length("text") <= DICT_SAMPLE_BYTES)
    some = some.select("doc_id", "text").distinct()
    some = about(some, ["doc_id", "text"], 2 * DICT_SAMPLE, some.count())
    rows = some.orderBy("doc_id", F.xxhash64("text")).select("text").collect()
    enc, samples = encoder(path, end_id), []
    for r in rows:
        ids, _ = enc.encode(encode([r["text"]]))
        samples.append(ids.astype(f"<u{width}").tobytes())
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:      # too little to learn from
        return b""


def dictionary_hash(data: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(data) if data else 0


def compress_documents(docs: DataFrame, dictionary: bytes, path: str, end_id: int | None, width: int) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, frame of every row."""
    def run(batches):
        import zlib

        import numpy as np
        import pyarrow as pa
        import zstandard

        from strata.llm.tokens import encoded

        how = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        pack = zstandard.ZstdCompressor(level=LEVEL, **how)
        for rows, ids, bounds in encoded(batches, path, end_id):
            wide, data, at = ids.astype("<u4").tobytes(), ids.astype(f"<u{width}").tobytes(), bounds.tolist()
            crc = [zlib.crc32(wide[4 * a:4 * b]) for a, b in zip(at, at[1:])]
            frames = [pack.compress(data[width * a:width * b]) for a, b in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(np.diff(bounds), pa.int64()), pa.array(crc, pa.int64()),
                 pa.array(frames, pa.binary())], names=["doc_id", "n_tokens", "ids_crc32", "frame"])

    return docs.withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(run, FRAMES)


def build_block(rows: list[tuple], dict_hash: int, width: int) -> bytes:
    """rows: (doc_id or None, n_tokens, frame)."""
    import numpy as np

    at = np.zeros(len(rows) + 1, "<i8")
    np.cumsum([len(r[2]) for r in rows], out=at[1:])
    return b"".join([HEAD.pack(MAGIC, width, dict_hash, len(rows)),
                     np.array([NULL_ID if r[0] is None else r[0] for r in rows], "<i8").tobytes(),
                     np.array([r[1] for r in rows], "<i8").tobytes(), at.tobytes(), *[r[2] for r in rows]])


class Block:
    """Reader of one block."""

    def __init__(self, data: bytes, dictionary: bytes):
        import numpy as np
        import zstandard

        magic, self.width, dict_hash, n = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a block of token ids")
        if dict_hash != dictionary_hash(dictionary):
            raise ValueError("the block was written with another dictionary")
        how = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        self._unpack, self._data = zstandard.ZstdDecompressor(**how), memoryview(data)
        index = np.frombuffer(data, "<i8", 3 * n + 1, HEAD.size)
        self.doc_ids, self.n_tokens, self._at = index[:n], index[n:2 * n], index[2 * n:]
        self._base = HEAD.size + 8 * (3 * n + 1)

    def __len__(self):
        return len(self.doc_ids)

    def ids(self, i: int):
        """Ids of document ``i``; no other document is decompressed."""
        import numpy as np

        a, b = self._base + int(self._at[i]), self._base + int(self._at[i + 1])
        raw = self._unpack.decompress(self._data[a:b], max_output_size=int(self.n_tokens[i]) * self.width)
        return np.frombuffer(raw, f"<u{self.width}")


def write_tokens(spark: SparkSession, docs: DataFrame, folder: str, path: str | None = None,
                 end_id: int | None = 1) -> str:
    """Write ``blocks`` and ``dictionary`` tables under ``folder`` in ascending doc_id order."""
    path = path or word_tokenizer()
    width = ids_width(path)
    docs = doc_columns(docs)
    dictionary = train_dictionary(docs, path, end_id, width)
    spark.createDataFrame([(f"{dictionary_hash(dictionary):016x}", bytearray(dictionary))],
                          "hash string, dictionary binary").write.parquet(f"{folder}/dictionary")
    dict_hash = dictionary_hash(dictionary)
    ranges = id_ranges(spark, docs, tie=crc_share(F.col("ids_crc32")))
    frames = compress_documents(docs, dictionary, path, end_id, width)

    def blocks(batches):
        import pyarrow as pa

        held, size, number, place = [], 0, 0, None

        def flush():
            n = sum(r[1] for r in held)
            return pa.RecordBatch.from_pylist([{"range_no": place, "block_no": number, "n_docs": len(held),
                                                "n_tokens": n, "block": build_block(held, dict_hash, width)}], schema)

        schema = pa.schema([("range_no", pa.int32()), ("block_no", pa.int64()), ("n_docs", pa.int64()),
                            ("n_tokens", pa.int64()), ("block", pa.binary())])
        for batch in batches:
            for r, d, n, f in zip(*(batch.column(c).to_pylist() for c in ("range_no", "doc_id", "n_tokens", "frame"))):
                if held and (r != place or size >= BLOCK_BYTES):
                    yield flush()
                    number = number + 1 if r == place else 0
                    held, size = [], 0
                place = r
                held.append((d, n, f))
                size += len(f)
        if held:
            yield flush()

    (frames.withColumn("range_no", ranges).repartition("range_no")
     .sortWithinPartitions("range_no", F.col("doc_id").asc_nulls_first(), "ids_crc32")
     .select("range_no", "doc_id", "n_tokens", "frame").mapInArrow(blocks, BLOCKS)
     .write.option("compression", "none").parquet(f"{folder}/blocks"))
    return folder


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and ids (binary, 4 bytes each; null without), decoded from the files."""
    dictionary = bytes(spark.read.parquet(f"{folder}/dictionary").first()["dictionary"])
    table = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    sizes = table.select("range_no", "block_no", "n_tokens")
    ranges = sizes.groupBy("range_no").agg(F.sum("n_tokens").alias("n"))
    # one row per range of ids: as many as write_tokens cut
    order = Window.partitionBy(F.lit(0)).orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("range_no", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("range_start"))
    inside = Window.partitionBy("range_no").orderBy("block_no").rowsBetween(Window.unboundedPreceding, -1)
    starts = (sizes.select("range_no", "block_no", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("b"))
              .join(ranges, "range_no").select("range_no", "block_no", (F.col("b") + F.col("range_start")).alias("at")))

    def decode(batches):
        import zlib

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for r, k, data in zip(*(batch.column(c).to_pylist() for c in ("range_no", "block_no", "block"))):
                block = Block(data, dictionary)
                wide = [block.ids(i).astype("<u4").tobytes() for i in range(len(block))]
                yield pa.RecordBatch.from_arrays([
                    pa.array([None if d == NULL_ID else d for d in block.doc_ids.tolist()], pa.int64()),
                    pa.array([r] * len(block), pa.int32()), pa.array([k] * len(block), pa.int64()),
                    pa.array(np.cumsum(block.n_tokens) - block.n_tokens, pa.int64()),
                    pa.array(block.n_tokens, pa.int64()), pa.array([zlib.crc32(w) for w in wide], pa.int64()),
                    pa.array(wide if with_ids else [None] * len(wide), pa.binary())],
                    names=["doc_id", "range_no", "block_no", "inside", "n_tokens", "ids_crc32", "ids"])

    docs = table.select("range_no", "block_no", "block").mapInArrow(
        decode, "doc_id long, range_no int, block_no long, inside long, n_tokens long, ids_crc32 long, ids binary")
    return docs.join(starts, ["range_no", "block_no"]).select(
        "doc_id", (F.col("at") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", "ids")


def op7_token_output(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = write_tokens(spark, docs, scratch_dir(spark, "token-ids"))
    return read_tokens(spark, folder, with_ids=False).drop("ids")
