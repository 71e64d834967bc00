"""The queries of the dealt operators on odd and empty tables, against plain versions."""

import struct
import zlib
from collections import Counter, defaultdict

import pytest

from strata.llm import registry
from strata.llm.tokens import Encoder, word_tokenizer
from tests.llm import brute

Q = registry.QUERIES


def got(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="session")
def ids(edge):
    tok = Encoder(word_tokenizer()).tok
    return [(d, tok.encode(t or "", add_special_tokens=False).ids + [1]) for d, t in edge[1]]


@pytest.mark.parametrize("name", sorted(Q))
def test_empty_tables(spark, empty, name):
    assert Q[name](spark, empty).count() == 0


def test_contamination(spark, edge):
    folder, rows, items = edge
    assert got(Q["op1_decontamination"](spark, folder)) == Counter(brute.contamination(rows, items))


def test_substrings(spark, edge):
    folder, rows, _ = edge
    assert got(Q["op2_substring_dedup"](spark, folder)) == Counter(brute.substrings(rows))


def test_fingerprints(spark, edge):
    folder, rows, _ = edge
    out = Q["op3_fingerprint"](spark, folder).collect()
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    known = {r[0]: r[1] or "" for r in rows if r[0] is not None}
    order = sorted(known)
    by_text = defaultdict(set)
    for r in out:
        if r.doc_id is None:
            continue
        text = known[r.doc_id]
        assert r.n_chars == len(text)
        by_text[text].add(r.fingerprint)
        nxt = known[order[order.index(r.doc_id) + 1]] if r.doc_id != order[-1] else None
        if nxt is None or r.doc_id == 10_120:       # the row that stands twice, and the last
            continue
        cut = len(text) // 2
        edited = text[:len(text) - cut] + nxt[:cut]
        assert r.edited_sha256 == brute.sha(edited)
        low = lambda t: brute.shingle_set(t.lower(), 5)
        for a, b, near in ((low(text), low(edited), r.near_edited), (low(text), low(nxt), r.near_next)):
            exact = len(a & b) / len(a | b) if a | b else 1.0
            assert 0 <= near <= 1 and near == pytest.approx(exact, abs=1e-9 if len(a | b) <= 128 else 0.25)
    assert all(len(v) == 1 for v in by_text.values()) and len(out) == len(rows)


def test_ngram_join(spark, edge):
    folder, rows, _ = edge
    assert got(Q["op4_ngram_join"](spark, folder)) == Counter(brute.components(rows))


def test_lines(spark, edge):
    folder, rows, _ = edge
    want = Counter((d, n, k, brute.sha(t)) for d, n, k, t in brute.lines(rows))
    assert got(Q["op6_line_dedup"](spark, folder)) == want
    assert any(k for _, _, k, _ in want)


def crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def test_token_output(spark, edge, ids):
    out = sorted(Q["op7_token_output"](spark, edge[0]).collect(), key=lambda r: r.start)
    want = sorted(((d, len(x), crc(x)) for d, x in ids), key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    assert [(r.doc_id, r.n_tokens, r.ids_crc32) for r in out] == want
    assert [r.start for r in out] == [sum(n for _, n, _ in want[:i]) for i in range(len(want))]


def test_token_counts(spark, edge, ids):
    size = [len(x) for _, x in ids]
    for r in Q["op8_token_counts"](spark, edge[0]).collect():
        n = r.n_tokens
        assert (r.docs, r.docs_over, r.tokens_over) == (size.count(n), sum(x > n for x in size), sum(x for x in size if x > n))
        assert r.tokens_total == sum(size) and r.tokens_kept == sum(min(x, n) for x in size)
        assert r.share == pytest.approx(sum(x <= n for x in size) / len(size))


def test_sharding(spark, edge):
    folder, rows, _ = edge
    out = Q["op9_sharding"](spark, folder).collect()
    text = lambda t: (t or "").encode()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in out) == Counter((d, len(text(t)) + 1, zlib.crc32(text(t))) for d, t in rows)
    by, slots = Counter(), defaultdict(list)
    for r in out:
        by[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert set(by) <= set(range(8)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(by.values()) - min(by.values()) <= 4 * max(r["size"] for r in out)


def test_packing(spark, edge, ids):
    out = Q["op10_packing"](spark, edge[0]).collect()
    sequences, docs = defaultdict(list), defaultdict(Counter)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
        docs[r.doc_id][(r.start, r.length, r.ids_crc32, r.doc_tokens)] += 1
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    want = defaultdict(Counter)
    for d, x in ids:
        for a in range(0, len(x), 2048):
            part = x[a:a + 2048]
            want[d][(a, len(part), crc(part), len(x))] += 1
    assert docs == want
    total = sum(len(x) for _, x in ids)
    assert len(sequences) <= 1.05 * total / 2048 and sorted(sequences) == list(range(len(sequences)))


def test_quality(spark, edge):
    folder, rows, _ = edge
    out = Q["op5_quality"](spark, folder).collect()
    assert Counter(r.doc_id for r in out) == Counter(d for d, _ in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    same = {r.score for r in out if r.doc_id in (10_000, 10_001, 10_004, 10_005)}
    assert len(same) == 1            # null and empty texts


def test_byte_bpe(spark, edge):
    import base64
    import hashlib

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for d, t in edge[1]:
        ids = enc.encode_ordinary(t or "")
        want[d, len(ids), brute.sha(",".join(map(str, ids))), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert got(Q["op11_byte_bpe"](spark, edge[0])) == want


def test_alignment(spark, edge):
    import public_tokenizers

    rows = edge[1]
    want = brute.alignment(rows, *map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model")))
    assert got(Q["op13_alignment"](spark, edge[0])) == Counter(want)
    assert len({r[5] != r[4] for r in want}) == 2


def test_ranked_search(spark, edge):
    folder, rows, items = edge
    assert got(Q["op12_ranked_search"](spark, folder)) == Counter(brute.ranked(rows, items))
