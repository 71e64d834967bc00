"""Token ids of texts by a public tokenizer file, many texts at a time.

``word_bpe`` files drop white space and merge inside words only, so a text's ids
are its words' ids in a row. Texts are cut into words with numpy, each distinct
word is encoded once per worker by the ``tokenizers`` library and its ids are
gathered. Other tokenizers, and texts that hold a special token's string, go
through the library whole.
"""

from __future__ import annotations

import json

import numpy as np

from strata.llm.text import CHUNK, LOWER, hash_pieces

MAX_WORDS = 1 << 21      # distinct words a worker remembers; then it starts anew
SENTINEL = "\x01"        # stands between words that are encoded together
WORDS_A_CALL = 64

# Byte kinds: 0 space, 1 letter, 2 sign, 3 apostrophe, 4 other.
KIND = np.full(256, 4, np.uint8)
KIND[[0x20, *range(0x09, 0x0E)]] = 0
KIND[0x41:0x5B] = KIND[0x61:0x7B] = 1
KIND[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = 2
KIND[0x27] = 3


def _cuts(start: bool) -> np.ndarray:
    """For kinds (before, here): whether a word begins (or ends) here."""
    out = np.zeros(64, bool)
    for a in range(5):
        for b in range(5):
            # A letter run never goes on into a sign, nor a sign into a letter run (after an apostrophe it may).
            cut = (a == 1 and b in (2, 3)) or (a == 2 and b == 1)
            out[a * 8 + b] = (b != 0 and (a == 0 or cut)) if start else (a != 0 and (b == 0 or cut))
    return out


STARTS, ENDS = _cuts(True), _cuts(False)


class Encoder:
    """Ids of texts, ``end_id`` after each."""

    def __init__(self, path: str, end_id: int | None = 1):
        from tokenizers import Tokenizer

        self.tok, self.end_id = Tokenizer.from_file(path), end_id
        spec = json.load(open(path, encoding="utf-8"))
        self.special = [t["content"] for t in spec.get("added_tokens") or ()]
        norm = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", ())]
        pre = [x.get("type") for x in (spec.get("pre_tokenizer") or {}).get("pretokenizers", ())]
        s = self.tok.encode(SENTINEL, add_special_tokens=False).ids
        self.by_word = norm == ["NFC", "Replace", "Lowercase"] and pre == ["Split", "ByteLevel"] and len(s) == 1
        self.sentinel = s[0] if s else -1
        self._reset()

    def _reset(self):
        self.hashes = np.empty(0, np.uint64)              # ascending
        self.rows = np.empty(0, np.int64)                 # hash -> row
        # row 0 is the end id
        self.ids = np.array([self.end_id or 0], np.uint32)
        self.begin, self.count = np.zeros(1, np.int64), np.ones(1, np.int64)

    def _plain(self, texts: list[bytes]):
        got = [e.ids for e in self.tok.encode_batch_fast([t.decode("utf-8") for t in texts], add_special_tokens=False)]
        if self.end_id is not None:
            got = [x + [self.end_id] for x in got]
        bounds = np.zeros(len(got) + 1, np.int64)
        np.cumsum([len(x) for x in got], out=bounds[1:])
        return np.array([i for x in got for i in x], np.uint32), bounds

    def _learn(self, hashes: np.ndarray, words: list[str]):
        """Add rows for words that no row has yet; many words go to the library in one string."""
        count = np.empty(len(words), np.int64)
        found = []
        for i in range(0, len(words), WORDS_A_CALL):
            some = words[i:i + WORDS_A_CALL]
            ids = self._encode_fast([f" {SENTINEL} ".join(some)])[0]
            cuts = np.flatnonzero(ids == self.sentinel)
            if len(cuts) != len(some) - 1 or any(SENTINEL in w for w in some):
                each = self._encode_fast(some)       # a word with the sentinel in it: one by one
                count[i:i + len(some)] = [len(x) for x in each]
                found += each
            else:
                count[i:i + len(some)] = np.diff(np.concatenate([[-1], cuts, [len(ids)]])) - 1
                found.append(ids[ids != self.sentinel])
        n = len(self.begin)
        begin = len(self.ids) + np.concatenate([[0], np.cumsum(count)[:-1]])
        self.ids = np.concatenate([self.ids, *found])
        self.begin, self.count = np.concatenate([self.begin, begin]), np.concatenate([self.count, count])
        hashes = np.concatenate([self.hashes, hashes])
        order = np.argsort(hashes, kind="stable")
        self.rows = np.concatenate([self.rows, np.arange(n, n + len(words))])[order]
        self.hashes = hashes[order]

    def _encode_fast(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _rows(self, raw: bytes, buf, starts, ends) -> np.ndarray:
        """The row of each word, learning new ones."""
        h = hash_pieces(buf, starts, ends)
        distinct, where, back = np.unique(h, return_index=True, return_inverse=True)
        if len(self.hashes) > MAX_WORDS:
            self._reset()
        at = np.searchsorted(self.hashes, distinct)
        known = at < len(self.hashes)
        known[known] = self.hashes[at[known]] == distinct[known]
        if not known.all():
            new = where[~known]
            self._learn(distinct[~known], [raw[a:b].decode("utf-8") for a, b in zip(starts[new].tolist(), ends[new].tolist())])
            at = np.searchsorted(self.hashes, distinct)
        return self.rows[at][back]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, bounds of each text)."""
        if not self.by_word or any(s.encode() in t for s in self.special for t in texts):
            return self._plain(texts)
        raw = b"\n".join(texts).translate(LOWER)
        buf = np.frombuffer(raw, np.uint8)
        kind = np.zeros(len(buf) + 2, np.uint8)
        np.take(KIND, buf, out=kind[1:-1])
        pair = (kind[:-1] << 3) | kind[1:]
        starts, ends = np.flatnonzero(STARTS[pair]), np.flatnonzero(ENDS[pair])
        rows = self._rows(raw, buf, starts, ends) if len(starts) else np.empty(0, np.int64)
        at = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=at[1:])
        first = np.searchsorted(starts, at)
        if self.end_id is not None:
            rows = np.insert(rows, first[1:], 0)
            first = first + np.arange(len(first))
        count = self.count[rows]
        ends_ = np.cumsum(count)
        total = int(ends_[-1]) if len(ends_) else 0
        ids = self.ids[np.repeat(self.begin[rows] - (ends_ - count), count) + np.arange(total)]
        return ids, np.concatenate([[0], ends_])[first]


_ENCODERS: dict = {}


def encoder(path: str, end_id: int | None = 1) -> Encoder:
    """One encoder per worker process, so words are learned once for all its tasks."""
    key = (path, end_id)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, end_id)
    return _ENCODERS[key]


def encoded(batches, path: str, end_id: int | None = 1, limit: int = CHUNK):
    """For record batches with a column ``text``: (rows of the batch, ids, bounds), about ``limit`` bytes a time."""
    from strata.llm.text import chunks
    from strata.llm.text import encode as utf8

    enc = encoder(path, end_id)
    for batch in batches:
        texts = utf8(batch.column("text").to_pylist())
        for a, b in chunks(texts, limit):
            ids, bounds = enc.encode(texts[a:b])
            yield batch.slice(a, b - a), ids, bounds


def word_tokenizer() -> str:
    """Place of the default vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
