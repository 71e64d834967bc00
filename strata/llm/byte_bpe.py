"""Byte-level BPE by a sentencepiece model that is written straight from a rank file.

``model_bytes`` serialises a BPE model: one piece per entry of the vocabulary,
its bytes mapped to letters (``byte_letters``), its score the negative rank,
with a normaliser that changes nothing. The merge rule of both is then the same:
of all neighbours that join to an entry, the one of lowest rank goes first, the
leftmost on ties. Texts are cut by the pattern, each distinct match is encoded
once per worker, and ids are mapped back to bytes for decoding.

A match that is an entry itself has that entry's id, as in the tiktoken
library, also where merges alone would not get there.

Defined cases: a null or empty text has no ids and decodes to no bytes; null and
repeated ids of documents are rows like all others (nothing is grouped or
sorted); an empty table gives an empty one; a text of any length is cut in
bounded lists of matches; other columns are left out.
"""

from __future__ import annotations

import base64
import struct

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import doc_columns

# Fixed values of the serialised model: piece types and the model type of BPE.
NORMAL, UNKNOWN, BPE = 1, 2, 2
SEPARATOR = "␀"      # not a byte's letter: stands between matches that are encoded in one call
MATCHES_A_CALL = 256


def read_ranks(path: str) -> dict[bytes, int]:
    """Entries of a rank file: base64 and a number on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes(out) + bytes([n])


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _block(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """A serialised sentencepiece model: entries by rank, then the unknown piece and the separator."""
    from strata.llm.pretokens import byte_letters

    letters = dict(enumerate(byte_letters()))

    def piece(text: str, score: float, kind: int) -> bytes:
        return _block(1, _block(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _number(3, kind))

    order = sorted(ranks, key=ranks.get)
    pieces = [piece(e.decode("latin-1").translate(letters), -float(ranks[e]), NORMAL) for e in order]
    lowest = -float(max(ranks.values(), default=0)) - 1
    pieces += [piece("<unk>", 0.0, UNKNOWN), piece(SEPARATOR, lowest, NORMAL)]
    trainer = _block(2, _number(3, BPE) + _number(4, len(pieces)) + _number(40, len(order)))
    normalizer = _block(3, _block(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0))
    return b"".join(pieces) + trainer + normalizer


class ByteBpe:
    """Ids of texts and bytes of ids for one rank file."""

    def __init__(self, path: str):
        import sentencepiece

        from strata.llm.pretokens import Splitter, Strings, WordIds, byte_letters

        self.ranks = read_ranks(path)
        order = sorted(self.ranks, key=self.ranks.get)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(self.ranks))
        self.id_of = [self.ranks[e] for e in order]     # of a piece's number
        strings = [b""] * (self.id_of[-1] + 1 if order else 0)
        for e in order:
            strings[self.ranks[e]] = e
        self.strings = Strings(strings)
        self.separator = len(order) + 1
        self.letters = dict(enumerate(byte_letters()))
        self.splitter, self.word_ids = Splitter(), WordIds(self._learn)

    def _learn(self, words: list[str]) -> list[list[int]]:
        cut = [self.splitter.matches(w) for w in words]
        ids = {m: [self.ranks[r]] if (r := m.encode()) in self.ranks else [] for x in cut for m in x}
        rest = [m for m, x in ids.items() if not x]
        for i in range(0, len(rest), MATCHES_A_CALL):
            some = rest[i:i + MATCHES_A_CALL]
            mapped = SEPARATOR.join(m.encode().decode("latin-1").translate(self.letters) for m in some)
            at = 0
            for n in self.model.encode(mapped, out_type=int):
                if n == self.separator:
                    at += 1
                else:
                    ids[some[at]].append(self.id_of[n])
        return [[n for m in x for n in ids[m]] for x in cut]

    def encode(self, texts: list[str]):
        """(ids of all texts in a row, bounds of each text)."""
        from strata.llm.pretokens import encode_texts

        return encode_texts(texts, self.word_ids)

    def decode(self, ids) -> bytes:
        return self.strings.join(ids)[0].tobytes()


_CODECS: dict = {}


def codec(path: str) -> ByteBpe:
    """One per worker process."""
    if path not in _CODECS:
        _CODECS[path] = ByteBpe(path)
    return _CODECS[path]


def multi_ranks() -> str:
    """Place of the default rank file."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _binaries(flat, bounds):
    import numpy as np
    import pyarrow as pa

    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(flat)])


def encode(docs: DataFrame, path: str | None = None, decoded: bool = False) -> DataFrame:
    """doc_id, ids array<int> of every row; with ``decoded`` also the bytes that the ids give back."""
    path = path or multi_ranks()

    def run(batches):
        import numpy as np
        import pyarrow as pa

        from strata.llm.pretokens import text_slices
        from strata.llm.text import CHUNK

        own = codec(path)
        for batch in batches:
            for rows, texts in text_slices(batch, CHUNK):
                ids, bounds = own.encode(texts)
                out = {"doc_id": rows.column("doc_id"),
                       "ids": pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)))}
                if decoded:
                    flat, ends = own.strings.join(ids)
                    out["decoded"] = _binaries(flat, np.concatenate([[0], ends])[bounds])
                yield pa.RecordBatch.from_pydict(out)

    docs = doc_columns(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, ids array<int>" + (", decoded binary" if decoded else ""))


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """The rows of ``encode`` (doc_id, ids) plus decoded binary; a null list of ids has no bytes."""
    path = path or multi_ranks()

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        own = codec(path)
        for batch in batches:
            lists = batch.column("ids")
            count = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            flat, ends = own.strings.join(lists.flatten().to_numpy())
            bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(count)])]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "ids": lists, "decoded": _binaries(flat, bounds)})

    encoded = encoded.select("doc_id", "ids")
    return encoded.mapInArrow(run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded binary")


def op11_byte_bpe(spark, sf_dir: str) -> DataFrame:
    out = encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), decoded=True)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))
