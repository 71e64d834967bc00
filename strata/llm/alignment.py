"""Alignment of two tokenizers: where their tokens end together, and which ids go with which.

Both tokenizers cut the same bytes. Every token points to the token of the
other side that overlaps it and reaches farthest right, or to itself if it ends
with a token of the other side and is the second tokenizer's. Doubling the
successors of all tokens at a time (``succ = succ[succ]``) brings each to the
last token of its component after a logarithmic number of rounds, and that
token labels the group.

Ids come from words that are learned once per worker (``pretokens``): the byte
pair tokenizer merges inside matches of its pattern only, the sentencepiece
model never joins a space to what stands before it. Files for which that does
not hold go through their library whole.

``align`` is one pass over the texts. ``link_counts`` stores what the passes
found, one row per chunk of documents with its distinct id pairs, adds the pairs
up over the corpus and sends each chunk the counts of its own pairs back; a pair
that all documents hold is one row per chunk.

Defined cases: a null or empty text, and one whose joined token bytes differ
from a space and the text (the second vocabulary writes a space as U+2581, so a
text with that character does), have no tokens: zeros and empty groups. Null and
repeated document ids are rows of their own, each counted. An empty table gives
an empty one. Other columns are left out. A single text is aligned in one task's
memory.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import doc_columns, stage

CHUNK_BYTES = 2 << 20     # text that is aligned at a time, whose pairs are one row
SPACED = re.compile(" +[^ ]*|[^ ]+")
WHOLE = re.compile("(?s:.+)")


class PairTokenizer:
    """A byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        from strata.llm.pretokens import WORD, Splitter, Strings, WordIds, byte_letters

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.by_word = spec.get("normalizer") is None and spec.get("pre_tokenizer") == {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        self.pattern = WORD if self.by_word else WHOLE
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        entries = {i: t for t, i in self.tok.get_vocab(with_added_tokens=True).items()}
        self.n_ids = max(entries) + 1
        raw = [entries.get(i, "") for i in range(self.n_ids)]
        self.strings = Strings([bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode() for t in raw])
        self.splitter, self.word_ids = Splitter(), WordIds(self._learn)

    def _learn(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(words, add_special_tokens=False)]


class PieceTokenizer:
    """A sentencepiece model that puts a space before the text."""

    def __init__(self, path: str):
        import sentencepiece

        from strata.llm.pretokens import Strings, WordIds

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.n_ids = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(self.n_ids)]
        self.strings = Strings([bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                                for i, p in enumerate(pieces)])
        changed = self.model.normalize(" a  b\n\tﬁ ") != "▁▁a▁▁b\n\tﬁ▁"      # a normaliser that rewrites or trims
        self.by_word = not changed and not any(re.search("[^▁]▁", p) for p in pieces)
        self.pattern = SPACED if self.by_word else WHOLE
        self.word_ids = WordIds(self._learn)

    def _learn(self, words: list[str]) -> list[list[int]]:
        # A word, or the whole, begins with a space, which the model puts there itself; it gives nothing for an empty text.
        found = self.model.encode([w[1:] for w in words], out_type=int, num_threads=1)
        return [[self.model.piece_to_id("▁")] if w == " " else ids for w, ids in zip(words, found)]


_SIDES: dict = {}


def sides(path_a: str, path_b: str) -> tuple[PairTokenizer, PieceTokenizer]:
    """Both tokenizers, loaded once per worker process."""
    if (path_a, path_b) not in _SIDES:
        _SIDES[path_a, path_b] = PairTokenizer(path_a), PieceTokenizer(path_b)
    return _SIDES[path_a, path_b]


def terminals(ends_a, ends_b):
    """The last B token of each token's component: (of the A tokens, of the B tokens).

    Both sides cut the same bytes; ``ends`` are ascending, no token is empty.
    """
    import numpy as np

    na, nb = len(ends_a), len(ends_b)
    # The token that holds another's last byte reaches farthest right of all that overlap it.
    succ_a = na + np.searchsorted(ends_b, ends_a)
    succ_b = np.searchsorted(ends_a, ends_b)
    together = ends_a[succ_b] == ends_b if na else np.ones(nb, bool)
    succ = np.concatenate([succ_a, np.where(together, na + np.arange(nb), succ_b)])
    while True:
        after = succ[succ]
        if (after == succ).all():
            return succ[:na] - na, succ[na:] - na
        succ = after


class Aligned:
    """The aligned tokens of several texts, one after the other."""

    def __init__(self, texts: list[str], a: PairTokenizer, b: PieceTokenizer):
        import numpy as np

        from strata.llm.pretokens import encode_texts

        whole = [" " + t if t else "" for t in texts]
        raw = [t.encode() for t in whole]
        want = np.array([len(r) for r in raw], np.int64)
        ids, bounds = [], []
        for side in (a, b):
            got, at = encode_texts(whole, side.word_ids, side.pattern)
            ids.append(got), bounds.append(at)
        if a.by_word and any(not t.isascii() for t in texts):
            self._whole_again(whole, a, ids, bounds)
        flat = np.frombuffer(b"".join(raw), np.uint8)
        ok = want > 0
        for k, side in enumerate((a, b)):
            sizes = np.concatenate([[0], np.cumsum(side.strings.size[ids[k]])])[bounds[k]]
            ok &= np.diff(sizes) == want
        while True:       # again without the texts whose bytes differ
            keep = [np.repeat(ok, np.diff(x)) for x in bounds]
            ids = [x[m] for x, m in zip(ids, keep)]
            bounds = [np.concatenate([[0], np.cumsum(np.where(ok, np.diff(x), 0))]) for x in bounds]
            flat = flat[np.repeat(ok, want)]
            want = np.where(ok, want, 0)
            (bytes_a, ends_a), (bytes_b, ends_b) = a.strings.join(ids[0]), b.strings.join(ids[1])
            wrong = np.flatnonzero((bytes_a != flat) | (bytes_b != flat))
            if not len(wrong):
                break
            ok[np.searchsorted(np.cumsum(want), wrong, "right")] = False
        self.ids_a, self.ids_b, self.bounds_a, self.bounds_b = *ids, *bounds
        of_a, of_b = terminals(ends_a, ends_b)
        #: Of each group: its last B token, and how many A tokens lie up to its end. Both end together.
        self.last_b = np.flatnonzero(of_b == np.arange(len(of_b)))
        self.upto_a = np.searchsorted(of_a, self.last_b, "right")
        self.groups = np.searchsorted(self.last_b, self.bounds_b)        # bounds of each text's groups

    @staticmethod
    def _whole_again(whole, a: PairTokenizer, ids, bounds):
        """Texts with a letter that not all Unicode tables know: A's ids by its library, whole."""
        import numpy as np

        doubt = [k for k, t in enumerate(whole) if not t.isascii() and a.splitter.doubtful("".join(set(t)))]
        if doubt:
            parts = [ids[0][x:y] for x, y in zip(bounds[0], bounds[0][1:])]
            for k in doubt:
                parts[k] = np.array(a.tok.encode(whole[k], add_special_tokens=False).ids, np.uint32)
            ids[0] = np.concatenate(parts)
            bounds[0] = np.concatenate([[0], np.cumsum([len(x) for x in parts])])

    def pairs(self, n_b: int):
        """The linked pairs, one per group, as A id * n_b + B id."""
        import numpy as np

        return self.ids_a[self.upto_a - 1].astype(np.int64) * n_b + self.ids_b[self.last_b]

    def written(self, decimals) -> list[str]:
        """Each text's groups as ``a1,a2|b1;a3|b2,b3``; ``decimals`` are the ids' digits and one byte."""
        import numpy as np

        # A group's A tokens stand before its B tokens, and all after those of the groups before.
        na = np.diff(self.upto_a, prepend=0)
        nb = np.diff(self.last_b + 1, prepend=0)
        at_a = np.arange(len(self.ids_a)) + np.repeat(np.cumsum(nb) - nb, na)
        at_b = np.arange(len(self.ids_b)) + np.repeat(self.upto_a, nb)
        tokens = np.empty(len(self.ids_a) + len(self.ids_b), np.int64)
        tokens[at_a], tokens[at_b] = self.ids_a, self.ids_b
        flat, ends = decimals.join(tokens)
        flat[ends - 1] = ord(",")
        flat[ends[at_a[self.upto_a - 1]] - 1] = ord("|")
        flat[ends[at_b[self.last_b]] - 1] = ord(";")
        cut = np.concatenate([[0], ends])[self.bounds_a + self.bounds_b].tolist()
        raw = flat.tobytes()
        return [raw[x:max(x, y - 1)].decode("ascii") for x, y in zip(cut, cut[1:])]


CHUNKS = ("chunk long, doc_ids array<{id}>, n_a array<long>, n_b array<long>, n_groups array<long>, groups array<string>, "
          "codes array<long>, times array<int>, places binary, place_times binary, place_bounds binary")


def _chunk_rows(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per chunk of documents: their figures and groups; the chunk's distinct pairs (``codes``) and how often
    they are linked; and for each document the places of its pairs in ``codes``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        from strata.llm.pretokens import Strings, text_slices

        a, b = sides(path_a, path_b)
        decimals = Strings([b"%d," % i for i in range(max(a.n_ids, b.n_ids))])
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for rows, texts in text_slices(batch, CHUNK_BYTES):
                found = Aligned(texts, a, b)
                codes, where = np.unique(found.pairs(b.n_ids), return_inverse=True)
                of = np.repeat(np.arange(len(texts)), np.diff(found.groups))
                own, times = np.unique((of << 32) | where, return_counts=True)
                one = lambda v, t: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v if isinstance(v, pa.Array) else pa.array(v, t))
                yield pa.RecordBatch.from_arrays([
                    pa.array([number], pa.int64()), one(rows.column("doc_id"), None),
                    one(np.diff(found.bounds_a), pa.int64()), one(np.diff(found.bounds_b), pa.int64()),
                    one(np.diff(found.groups), pa.int64()), one(found.written(decimals), pa.string()),
                    one(codes, pa.int64()), one(np.bincount(where, minlength=len(codes)), pa.int32()),
                    pa.array([(own & 0xFFFFFFFF).astype("<i4").tobytes()], pa.binary()),
                    pa.array([times.astype("<i4").tobytes()], pa.binary()),
                    pa.array([np.searchsorted(own >> 32, np.arange(len(texts) + 1)).astype("<i8").tobytes()], pa.binary())],
                    names=["chunk", "doc_ids", "n_a", "n_b", "n_groups", "groups", "codes", "times", "places", "place_times",
                           "place_bounds"])
                number += 1

    return docs.mapInArrow(run, CHUNKS.format(id=kind))


def default_files() -> tuple[str, str]:
    """Places of the default vocabulary files."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, groups (``a1,a2|b1;a3|b2,b3``) of every row."""
    a, b = default_files()
    rows = _chunk_rows(doc_columns(docs), path_a or a, path_b or b)
    names = ["doc_id", "n_a", "n_b", "n_groups", "groups"]
    return rows.select(F.explode(F.arrays_zip("doc_ids", *names[1:])).alias("d")).select(
        *[F.col("d")["doc_ids" if c == "doc_id" else c].alias(c) for c in names])


def link_counts(spark: SparkSession, docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs) of a corpus.

    documents: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row.
    pairs: a_id, b_id, n (how many links hold it) and best (n is the highest of the B id).
    """
    default = default_files()
    path_a, path_b = path_a or default[0], path_b or default[1]
    docs = doc_columns(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = _chunk_rows(docs, path_a, path_b)
    hashed = F.transform("groups", lambda g: F.when(g == "", F.lit("")).otherwise(F.sha2(g, 256)))
    chunks = stage(spark, rows.withColumn("groups", hashed), "aligned")

    n_b = sides(path_a, path_b)[1].n_ids
    asked = chunks.select("chunk", F.explode(F.arrays_zip("codes", "times")).alias("p"))
    asked = asked.select("chunk", F.col("p.codes").alias("code"), F.col("p.times").alias("times"))
    counts = asked.groupBy("code").agg(F.sum("times").alias("n"))
    b_id = F.col("code") % n_b
    counts = counts.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy(b_id)))   # at most the A vocabulary a group
    counts = stage(spark, counts, "pairs")
    answers = asked.join(counts, "code").select(F.col("chunk").alias("to"), "code", "n", "best")

    out = (f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")

    def answered(texts, replies):
        import numpy as np
        import pyarrow as pa

        # A chunk is one row; its answers in the order of the codes.
        code = replies.column("code").to_numpy()
        order = np.argsort(code)
        n, best = replies.column("n").to_numpy()[order], replies.column("best").to_numpy(zero_copy_only=False)[order]
        row = {c: texts.column(c).combine_chunks() for c in texts.column_names}
        places, times, bounds = (np.frombuffer(row[c][0].as_buffer(), t) for c, t in (
            ("places", "<i4"), ("place_times", "<i4"), ("place_bounds", "<i8")))
        sums = [np.diff(np.concatenate([[0], np.cumsum(times * x[places].astype(np.int64))])[bounds]) for x in (best, n)]
        groups = row["n_groups"].flatten()
        return pa.Table.from_arrays([row["doc_ids"].flatten(), row["n_a"].flatten(), row["n_b"].flatten(), groups, groups,
                                     pa.array(sums[0]), pa.array(sums[1]), row["groups"].flatten()],
                                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    documents = (chunks.drop("codes", "times").groupBy("chunk").cogroup(answers.groupBy("to")).applyInArrow(answered, out))
    pairs = counts.select(F.floor(F.col("code") / n_b).alias("a_id"), b_id.alias("b_id"), "n", "best")
    return documents, pairs


def op13_alignment(spark, sf_dir: str) -> DataFrame:
    return link_counts(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))[0]
