"""Pre-tokens of texts and their ids, learned once per distinct word and worker.

Byte-level tokenizers cut a text by a pattern and merge inside each match only,
so a text's ids are its matches' ids in a row. ``Splitter`` finds the matches as
the tokenizers do, ``WordIds`` remembers the ids of distinct words, and
``Strings`` turns arrays of ids into bytes.
"""

from __future__ import annotations

import itertools
import re
import unicodedata

import numpy as np

MAX_WORDS = 1 << 19       # distinct words a worker remembers, and their characters; then it starts anew
MAX_CHARS = 1 << 24
WORDS_A_TIME = 1 << 18    # words held as Python strings at a time

# The characters of Unicode's White_Space.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: No match of the public pattern crosses these: a space with what is not white, or white space but for its last character.
WORD = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]")

#: A letter and a digit to all tables, and a sign.
STAND_INS = "a1!"


def tiktoken_classes(chars: list[str]) -> dict[str, str]:
    """Which of ``STAND_INS`` a character goes with in the tiktoken library's reading of \\p{L} and \\p{N}.

    A vocabulary that holds each stand-in together with the character as one
    entry gives that entry only where the pattern does not part the two.
    """
    import public_tokenizers
    import tiktoken

    ranks = {bytes([i]): i for i in range(256)}
    probes = {(s + c).encode(): (c, s) for c in chars for s in STAND_INS}
    ranks |= {p: 256 + k for k, p in enumerate(probes)}
    enc = tiktoken.Encoding("probe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return {c: s for p, (c, s) in probes.items() if enc.encode_ordinary(p.decode()) == [ranks[p]]}


class Splitter:
    """The matches of the public pattern (\\p{L}, \\p{N}, \\s) in words.

    The ``regex`` library may know letters of a later Unicode version than a
    tokenizer does. Characters that Python's own tables do not have are in
    doubt (``doubtful``); where they stand, ``matches`` cuts as the tiktoken
    library does, by looking at a stand-in of the same class.
    """

    def __init__(self):
        import public_tokenizers
        import regex

        self.pattern = regex.compile(public_tokenizers.PATTERN)
        known = regex.compile(r"[\p{L}\p{N}]")
        self.new = {c for c in map(chr, itertools.chain(range(0x80, 0xD800), range(0xE000, 0x110000)))
                    if unicodedata.category(c) == "Cn" and known.match(c)}
        self._stand_in = None

    def doubtful(self, word: str) -> bool:
        return not word.isascii() and not self.new.isdisjoint(word)

    def matches(self, word: str) -> list[str]:
        if not self.doubtful(word):
            return self.pattern.findall(word)
        if self._stand_in is None:
            classes = tiktoken_classes(sorted(self.new))
            self._stand_in = {ord(c): classes.get(c, "!") for c in self.new}
        # The contraction rules know a few letters after an apostrophe, none of them a stand-in.
        return [word[m.start():m.end()] for m in self.pattern.finditer(word.translate(self._stand_in))]


def words(text: str, pattern: re.Pattern = WORD):
    """Lists of the text's words, in order; a pattern must leave nothing between its matches."""
    if len(text) <= WORDS_A_TIME:
        yield pattern.findall(text)
        return
    found = pattern.finditer(text)
    while some := [m.group() for m in itertools.islice(found, WORDS_A_TIME)]:
        yield some


class WordIds:
    """Ids of words by ``learn(words) -> list of id lists``, which is asked once for each distinct word."""

    def __init__(self, learn):
        self.learn = learn
        self._reset()

    def _reset(self):
        self.row: dict[str, int] = {}
        self.chars = 0
        self.ids, self.begin, self.count = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def _add(self, new: list[str]):
        found = self.learn(new)
        count = np.array([len(x) for x in found], np.int64)
        begin = len(self.ids) + np.cumsum(count) - count
        self.row.update(zip(new, range(len(self.begin), len(self.begin) + len(new))))
        self.chars += sum(map(len, new))
        self.ids = np.concatenate([self.ids, np.fromiter(itertools.chain.from_iterable(found), np.uint32)])
        self.begin, self.count = np.concatenate([self.begin, begin]), np.concatenate([self.count, count])

    def __call__(self, some: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the words in a row, how many each has)."""
        if len(self.row) > MAX_WORDS or self.chars > MAX_CHARS:
            self._reset()
        rows = np.fromiter(map(self.row.get, some, itertools.repeat(-1)), np.int64, len(some))
        if len(new := np.flatnonzero(rows < 0)):
            unknown = [some[i] for i in new.tolist()]
            self._add(list(dict.fromkeys(unknown)))
            rows[new] = np.fromiter(map(self.row.__getitem__, unknown), np.int64, len(unknown))
        count = self.count[rows]
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(self.begin[rows] - (ends - count), count) + np.arange(total)], count


def encode_texts(texts: list[str], word_ids: WordIds, pattern: re.Pattern = WORD) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts in a row, bounds of each text)."""
    pending: list[str] = []
    lengths, of = [], []           # words of each list that is pending, and its text
    found, total = [], np.zeros(len(texts), np.int64)

    def flush():
        if pending:
            ids, count = word_ids(pending)
            found.append(ids)
            np.add.at(total, np.repeat(np.array(of, np.int64), np.array(lengths, np.int64)), count)
            pending.clear(), lengths.clear(), of.clear()

    for k, t in enumerate(texts):
        for some in words(t, pattern):
            pending += some
            lengths.append(len(some))
            of.append(k)
            if len(pending) >= WORDS_A_TIME:
                flush()
    flush()
    return (np.concatenate(found) if found else np.empty(0, np.uint32)), np.concatenate([[0], np.cumsum(total)])


def text_slices(batch, limit: int):
    """(rows of a record batch, their texts), about ``limit`` bytes of the column ``text`` at a time."""
    import pyarrow.compute as pc

    size = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(np.diff(np.cumsum(size) // limit)) + 1
    for a, b in itertools.pairwise([0, *cuts.tolist(), len(size)]):
        rows = batch.slice(a, b - a)
        yield rows, rows.column("text").to_pylist()


class Strings:
    """Byte strings by number; ``join`` puts those of an array of numbers in a row."""

    def __init__(self, strings: list[bytes]):
        self.flat = np.frombuffer(b"".join(strings), np.uint8)
        self.size = np.array([len(s) for s in strings], np.int64)
        self.begin = np.cumsum(self.size) - self.size

    def join(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the bytes, where each string ends in them)."""
        size = self.size[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.begin[ids] - (ends - size), size) + np.arange(total)], ends


def byte_letters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies.

    Bytes that are visible characters of Latin-1 stand for themselves; the others, in order, for those from U+0100 on.
    """
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in seen}
    rest = [b for b in range(256) if b not in out]
    out |= {b: chr(0x100 + k) for k, b in enumerate(rest)}
    return [out[b] for b in range(256)]
