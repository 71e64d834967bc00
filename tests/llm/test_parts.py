"""Parts of the operators: plans, file format, hashes, sketches, components; and the general interfaces."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import (components, decontam, fingerprint, line_dedup, ngram_join, packing, quality, sharding,
                        substring_dedup, text, token_counts, token_output, tokens)
from strata.llm.common import about
from strata.llm.tokens import Encoder, word_tokenizer
from strata.session import scratch_dir
from tests.llm import brute


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


# ---------------------------------------------------------------- words and tokens
def test_words_and_window_hashes_know_equal_sequences():
    rng = random.Random(1)
    texts = [" ".join(rng.choice("a b ab ba aa bb é".split()) for _ in range(rng.randint(0, 30))) for _ in range(200)]
    words, buf = text.split(text.encode(texts), text.SPACE_TABLE, False)
    h = text.hash_pieces(buf, words.starts, words.ends)
    plain = [t.split() for t in texts]
    assert words.counts.tolist() == [len(w) for w in plain]
    for size in (1, 3, 7):
        hashes, ok = text.window_hashes(h, words.first, size)
        seen = {}
        for d, w in enumerate(plain):
            for i in range(len(w)):
                at = words.first[d] + i
                assert ok[at] == (i + size <= len(w))
                if ok[at]:
                    assert seen.setdefault(hashes[at], tuple(w[i:i + size])) == tuple(w[i:i + size])
        assert len(seen) == len(set(seen.values()))


def test_a_long_word_crosses_segments():
    long = b"x" * (3 * text.SEGMENT)
    words, buf = text.split([b"a " + long + b" b", long], text.SPACE_TABLE, False)
    h = text.hash_pieces(buf, words.starts, words.ends)
    assert h[1] == h[3] and len(set(h.tolist())) == 3


def test_ids_equal_the_library_on_odd_texts():
    enc, rng = Encoder(word_tokenizer()), random.Random(3)
    odd = ["", " ", "a'sb 's' S 'RE x'll!'s", "é ,́ ≮ a≮", "x\x01y \x01 z", "<|endoftext|> hi",
           "don't!!abc123é—d ΣΑΣ 'ſ", "\x1c\x1d a\x1eb", "a b ﬁ 123 ½", "İstanbul"]
    odd += ["".join(rng.choice("aS'tre!,é́ \n\x01ſß<|0̸ Ως") for _ in range(rng.randint(0, 14))) for _ in range(800)]
    ids, bounds = enc.encode(text.encode([t for t in odd if "<|endoftext|>" not in t]))
    for i, t in enumerate(t for t in odd if "<|endoftext|>" not in t):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == enc.tok.encode(t, add_special_tokens=False).ids + [1], t
    ids, _ = enc.encode(text.encode(["<|endoftext|> hi"]))
    assert ids.tolist() == enc.tok.encode("<|endoftext|> hi", add_special_tokens=False).ids + [1]


# ---------------------------------------------------------------- packing
def test_best_subset_is_the_best():
    rng = random.Random(2)
    for _ in range(200):
        counts = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(rng.randint(1, 4))}
        capacity = rng.randint(0, 60)
        need = packing.best_subset(counts, capacity)
        assert all(q <= counts[k] for k, q in need.items())
        sums = {sum(k * q for k, q in zip(counts, qs)) for qs in itertools.product(*[range(v + 1) for v in counts.values()])}
        assert sum(k * q for k, q in need.items()) == max(s for s in sums if s <= capacity)


def test_plan_uses_every_piece_once():
    rng = random.Random(4)
    histogram = {rng.randint(1, 64): rng.randint(1, 50) for _ in range(30)}
    plan, used = packing.plan_bins(histogram, 64), {}
    for times, need in plan:
        assert sum(k * q for k, q in need.items()) <= 64
        for k, q in need.items():
            used[k] = used.get(k, 0) + times * q
    assert used == histogram and len(plan) <= 64


def test_sequences_hold_the_ids(spark, edge):
    docs = frame(spark, edge[1])
    packed = packing.pack(spark, docs, window=256, with_ids=True)
    seq = {r.sequence_id: (r.length, np.frombuffer(r.ids, "<u4")) for r in packing.sequences(packed).collect()}
    enc = Encoder(word_tokenizer())
    ids = {d: enc.encode(text.encode([t]))[0] for d, t in edge[1] if d is not None}
    for r in packed.drop("ids").collect():
        if r.doc_id is not None:
            assert (seq[r.sequence_id][1][r.offset:r.offset + r.length] == ids[r.doc_id][r.start:r.start + r.length]).all()
    assert all(n == len(x) <= 256 for n, x in seq.values())


# ---------------------------------------------------------------- id ranges
def test_ranges_are_in_order_and_even(spark):
    from strata.llm.common import id_ranges

    ids = [None, *range(-500, 20000, 7), 10 ** 15, *[3] * 50]
    docs = spark.createDataFrame([(i,) for i in ids], "doc_id long").repartition(5)
    for n in (1, 2, 3, 7, 40):
        got = [tuple(r) for r in docs.select("doc_id", id_ranges(spark, docs, n)).collect()]
        got.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        rng = [r[1] for r in got]
        assert rng == sorted(rng) and rng[0] == 0 and max(rng) < n
        assert len(set(rng)) == n and max(rng.count(k) for k in set(rng)) < 3 * len(ids) / n + 60


# ---------------------------------------------------------------- sharding
def test_flow_moves_the_fewest_bytes():
    rng = random.Random(6)
    for _ in range(40):
        sizes = {i: rng.randint(0, 6) for i in range(3)}
        capacity = sharding.even_capacities(sum(sizes.values()), 3)
        flow = sharding.cheapest_flow(sizes, capacity)
        assert all(sum(v for (o, _), v in flow.items() if o == i) == sizes[i] for i in sizes)
        assert all(sum(v for (_, j), v in flow.items() if j == k) <= capacity[k] for k in range(3))
        # what must move is what an old shard holds beyond its own capacity
        assert sum(v for (o, j), v in flow.items() if o != j) == sum(max(0, sizes[i] - capacity[i]) for i in sizes)


def test_only_touched_shards_are_rewritten(spark):
    rows = [(i, "x" * 9, i % 3) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, old int")
    placed, flow = sharding.place(spark, docs, "old", 3)
    assert sharding.rewrite(placed, flow, scratch_dir(spark, "none")) == []
    placed, flow = sharding.place(spark, docs, "old", 4, [300, 300, 150, 150])
    touched = sharding.rewrite(placed, flow, folder := scratch_dir(spark, "some"))
    assert touched == [2, 3] and {r.shard for r in spark.read.parquet(folder).select("shard").collect()} == {2, 3}


# ---------------------------------------------------------------- token files
def test_one_document_of_a_block_and_the_dictionary_hash(spark, edge):
    docs = frame(spark, edge[1])
    folder = token_output.write_tokens(spark, docs, scratch_dir(spark, "tok"))
    dictionary = bytes(spark.read.parquet(f"{folder}/dictionary").first()["dictionary"])
    assert dictionary
    enc, texts = Encoder(word_tokenizer()), dict(edge[1])
    for row in spark.read.parquet(f"{folder}/blocks").collect():
        block = token_output.Block(bytes(row["block"]), dictionary)
        i = len(block) // 2
        if (d := int(block.doc_ids[i])) != token_output.NULL_ID:
            assert (block.ids(i) == enc.encode(text.encode([texts[d]]))[0]).all()
        with pytest.raises(ValueError):
            token_output.Block(bytes(row["block"]), dictionary + b"x")
    with pytest.raises(ValueError):
        token_output.Block(b"\0" * 64, b"")


def test_any_context_limit(spark, edge):
    docs = frame(spark, edge[1])
    lengths = token_counts.token_lengths(docs)
    size = [r.n_tokens for r in lengths.collect()]
    sums = token_counts.suffix_sums(token_counts.histogram(lengths))
    limits = [0, 1, 7, 100, 2048, 10 ** 6]
    got = {r.limit: (r.docs_cut, r.tokens_kept) for r in token_counts.truncated(sums, limits).collect()}
    assert got == {n: (sum(x > n for x in size), sum(min(x, n) for x in size)) for n in limits}
    q = {r.share: r.n_tokens for r in token_counts.quantiles(sums, [0.25, 0.5, 1.0]).collect()}
    assert q == {s: sorted(size)[int(np.ceil(s * len(size))) - 1] for s in (0.25, 0.5, 1.0)}


# ---------------------------------------------------------------- fingerprints
def test_sketches_merge_and_estimate(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(5000)]
    a = [rng.choice(words) for _ in range(3000)]
    b = a[:2000] + [rng.choice(words) for _ in range(1000)]
    df = frame(spark, [(1, " ".join(a)), (2, " ".join(b))])
    s = fingerprint.with_sketch(df, "text", "s")
    x, y = s.where("doc_id = 1").select(F.col("s").alias("x")), s.where("doc_id = 2").select(F.col("s").alias("y"))
    r = x.crossJoin(y).select(fingerprint.resemblance("x", "y").alias("j"), fingerprint.containment("x", "y").alias("c"),
                              fingerprint.distinct_count("x").alias("n"), fingerprint.merge("x", "y").alias("m")).first()
    sa, sb = brute.shingle_set(" ".join(a), 5), brute.shingle_set(" ".join(b), 5)
    assert abs(r.j - len(sa & sb) / len(sa | sb)) < 0.15 and abs(r.c - len(sa & sb) / len(sa)) < 0.25
    assert abs(r.n / len(sa) - 1) < 0.3
    parts = s.withColumn("g", F.lit(1))
    assert fingerprint.merge_parts(parts, "g", "s").first().s == r.m


# ---------------------------------------------------------------- joins and components
def test_components_of_a_long_chain(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001)], "u long, v long")
    got = {r.node: r.component for r in components.connected_components(spark, edges).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 1000: 1000, 1001: 1000}


@pytest.mark.parametrize("size, percent", [(4, 85), (5, 80), (2, 50)])
def test_join_of_random_near_copies(spark, size, percent):
    rng = random.Random(size)
    rows, vocabulary = [], [f"v{i}" for i in range(60)]
    for base in range(6):
        text_ = [rng.choice(vocabulary) for _ in range(rng.randint(8, 120))]
        for _ in range(rng.choice([2, 10, 150])):
            w = list(text_)
            for _ in range(rng.randint(0, 6)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append((len(rows) * 7, " ".join(w)))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in ngram_join.ngram_join(spark, frame(spark, rows), size, percent).collect()}
    assert got == {d: (n, c, k) for d, n, c, k in brute.components(rows, size, percent)}


# ---------------------------------------------------------------- decontamination
def test_proximity_matches_and_blocks(spark, monkeypatch):
    docs = frame(spark, [(1, "a b c d e f"), (2, "a b x c d e f"), (3, "a b c"), (4, "zz a b c d e f zz")])
    items = spark.createDataFrame([(7, "a b c d e f"), (8, "no such words")], "item_id long, text string")
    index = decontam.build_index(spark, docs)
    exact = {r.doc_id: (r["items"], r.near_items, r.n_hit) for r in decontam.search(spark, index, items).collect()}
    assert exact == {1: (["7"], [], 6), 2: ([], [], 0), 3: ([], [], 0), 4: (["7"], [], 6)}
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 8)        # many blocks
    near = {r.doc_id: (r["items"], r.near_items, [tuple(s) for s in r.spans]) for r in decontam.search(spark, index, items, slop=2).collect()}
    assert near == {1: (["7"], [], [(0, 6)]), 2: ([], ["7"], []), 3: ([], [], []), 4: (["7"], [], [(1, 7)])}


def near(doc, item, slop):
    """Whether for some start every word of the item lies up to slop from its offset in the document."""
    return any(all(w in doc[max(0, s + k - slop):max(0, s + k + slop + 1)] for k, w in enumerate(item))
               for s in range(-len(item) - slop, len(doc) + slop))


def test_a_rare_term_before_its_offset_stays_in_its_document(spark):
    texts = ["b a c d e f", "a a a a", "x y", "b a c d e f", "a b c d", "e f a a", ""]      # 'b' is rarer than 'a'
    index = decontam.build_index(spark, frame(spark, list(enumerate(texts))).coalesce(1))
    assert index.count() == 1
    items = spark.createDataFrame([(7, "a b c d e f")], "item_id long, text string")
    got = {r.doc_id: (r["items"], r.near_items) for r in decontam.search(spark, index, items, slop=2).collect()}
    assert got == {i: ([], ["7"] if i in (0, 3) else []) for i in range(len(texts))}


def test_proximity_ends_at_the_document(spark):
    index = decontam.build_index(spark, frame(spark, [(1, "a b c d e"), (2, "f g"), (3, "a b c d e f")]).coalesce(1))
    items = spark.createDataFrame([(7, "a b c d e f")], "item_id long, text string")
    got = {r.doc_id: (r["items"], r.near_items) for r in decontam.search(spark, index, items, slop=decontam.GAP - 1).collect()}
    assert got == {1: ([], []), 2: ([], []), 3: (["7"], [])}


def test_proximity_equals_the_plain_version(spark):
    rng = random.Random(17)
    words = lambda n: [rng.choice("aaaaabcdefgh") for _ in range(n)]
    docs = [(i, words(rng.randint(0, 14))) for i in range(150)]
    items = [(i, words(rng.randint(1, 5))) for i in range(40)]
    index = decontam.build_index(spark, frame(spark, [(i, " ".join(w)) for i, w in docs]).coalesce(2))
    table = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    for slop in (1, 3):
        got = {r.doc_id: set(r.near_items) | set(r["items"]) for r in decontam.search(spark, index, table, window=4, slop=slop).collect()}
        assert got == {d: {str(i) for i, x in items for k in range(max(1, len(x) - 3)) if near(w, x[k:k + 4], slop)} for d, w in docs}


# ---------------------------------------------------------------- what the driver collects
def sampled_id(spark, rows, of):
    """An id that a sample of about ``rows`` of ``of`` rows takes."""
    return about(spark.range(100_000).toDF("doc_id"), ["doc_id"], rows, of).first().doc_id


@pytest.mark.parametrize("texts", [1, 1000])
def test_rows_of_one_id_do_not_fill_the_dictionary_sample(spark, monkeypatch, texts):
    hot = sampled_id(spark, 20, 2000)
    docs = frame(spark, [(hot, f"t{i % texts} x") for i in range(1000)] + [(200_000 + i, f"u{i}") for i in range(1000)])
    monkeypatch.setattr(token_output, "DICT_SAMPLE", 20)
    taken, real = [], tokens.Encoder.encode
    monkeypatch.setattr(tokens.Encoder, "encode", lambda self, x: taken.append(x) or real(self, x))
    token_output.train_dictionary(docs, word_tokenizer(), None, 2)
    assert 1 <= len(taken) <= 100


@pytest.mark.parametrize("texts", [1, 1000])
def test_rows_of_one_id_do_not_fill_the_training_set(spark, monkeypatch, texts):
    known = [i for i, in spark.range(3000).toDF("doc_id").where(~quality.held_out()).collect()]
    labels = spark.createDataFrame([(i, i % 2) for i in known], "doc_id long, quality long")
    hot = about(labels, ["doc_id"], 20, len(known)).first().doc_id
    vector = np.ones(3 * quality.DIMS, np.float32).tobytes()
    rows = [(hot, k % texts, bytearray(vector)) for k in range(1000)] + [(i, 0, bytearray(vector)) for i in known if i != hot]
    features = spark.createDataFrame(rows, "doc_id long, text_hash long, features binary")
    seen = []
    monkeypatch.setattr(quality, "Network", lambda x, y: seen.append((len(x), len(y))))
    quality.fit(features, labels, 20)
    assert 1 <= seen[0][0] == seen[0][1] <= 100


def test_copies_of_a_benchmark_row_are_collected_once(spark, monkeypatch):
    items = spark.createDataFrame([(7, "a b c")] * 500 + [(8, "a b c"), (7, "c b")], "item_id long, text string")
    blocks, real = [], decontam.Phrases.__init__
    monkeypatch.setattr(decontam.Phrases, "__init__", lambda self, block, window: blocks.append(len(block)) or real(self, block, window))
    out = decontam.search(spark, decontam.build_index(spark, frame(spark, [(1, "x a b c"), (2, "c b")])), items)
    assert {r.doc_id: r["items"] for r in out.collect()} == {1: ["7", "8"], 2: ["7"]} and sum(blocks) == 3


# ---------------------------------------------------------------- texts and columns
def test_spans_of_maximal_repeats(spark):
    passage = " ".join(f"p{i}" for i in range(50))
    docs = frame(spark, [(1, "x " + passage + " y"), (2, passage), (3, " ".join(f"q{i}" for i in range(50)))])
    got = {r.doc_id: (r.kept_text, [tuple(s) for s in r.spans]) for r in substring_dedup.remove_repeats(spark, docs).collect()}
    assert got[1] == ("x y", [(1, 51)]) and got[2] == ("", [(0, 50)]) and got[3][1] == []


def test_filters_keep_all_columns(spark, edge):
    folder, rows, _ = edge
    docs, labels, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    for out in (line_dedup.drop_lines(docs), quality.drop_rejected(spark, docs, labels),
                ngram_join.keep_one(spark, docs), decontam.drop_contaminated(spark, docs, items)):
        assert out.columns == docs.columns and 0 < out.count() <= len(rows)


def test_scores_do_not_know_held_out_labels(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    scores = lambda x: sorted((r.doc_id, r.score) for r in quality.classify(spark, docs, x).collect())
    assert scores(labels) == scores(turned)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.classify(spark, docs, labels).join(labels, "doc_id").where(quality.held_out()).collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert sum((a > b) + (a == b) / 2 for a in good for b in bad) / (len(good) * len(bad)) > 0.98
    assert sum(b < quality.CUT for b in bad) >= 0.85 * len(bad)
    assert sum(a >= quality.CUT for a in good) >= 0.95 * len(good)


# ---------------------------------------------------------------- byte-level BPE
def odd_texts(seed: int, n: int):
    """Random mixes of letters, signs, white space, and characters that only some Unicode tables know."""
    from strata.llm.pretokens import Splitter

    rng = random.Random(seed)
    letters = "aS'tre!,é́ \n\x01ſß<|0̸ Ως中文字ñ½٣  \x1c\x85␀▁Ġ" + "".join(rng.sample(sorted(Splitter().new), 20))
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_byte_bpe_ids_equal_tiktoken():
    import public_tokenizers
    import tiktoken

    from strata.llm.byte_bpe import ByteBpe, multi_ranks

    own = ByteBpe(multi_ranks())
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    texts = odd_texts(1, 3000) + ["a" * 5000, " " * 3000 + "x", "<|endoftext|>", "", "it's IT'S 'lls"]
    texts += [k.decode("utf-8") for k in own.ranks if k.isascii()]
    ids, bounds = own.encode(texts)
    for i, t in enumerate(texts):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == plain.encode_ordinary(t), t
    assert own.decode(ids) == "".join(texts).encode()


def test_an_entry_is_found_where_merges_do_not_lead_to_it(tmp_path):
    import base64

    from strata.llm.byte_bpe import ByteBpe

    entries = [bytes([i]) for i in range(256)] + [b"abc"]        # no entry of two bytes
    path = tmp_path / "few.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(e) + b" %d\n" % k for k, e in enumerate(entries)))
    ids, bounds = ByteBpe(str(path)).encode(["abc", "abcd abc"])
    assert ids.tolist() == [256, 97, 98, 99, 100, 32, 97, 98, 99] and bounds.tolist() == [0, 1, 9]


def test_a_worker_forgets_words_and_cuts_long_texts(monkeypatch):
    from strata.llm import pretokens
    from strata.llm.byte_bpe import ByteBpe, multi_ranks

    texts = odd_texts(2, 300) + ["word " * 2000]
    want = ByteBpe(multi_ranks()).encode(texts)
    monkeypatch.setattr(pretokens, "MAX_WORDS", 50)
    monkeypatch.setattr(pretokens, "WORDS_A_TIME", 64)
    got = ByteBpe(multi_ranks()).encode(texts)
    assert all((a == b).all() for a, b in zip(want, got))


# ---------------------------------------------------------------- alignment
def test_pointers_end_at_the_last_token_of_their_component():
    from strata.llm.alignment import terminals

    rng = random.Random(8)
    for n in (1, 2, 40, 300):
        for share in (0.1, 0.5, 0.9):
            ends = [np.array(sorted({n, *(x for x in range(1, n) if rng.random() < share)})) for _ in range(2)]
            of_a, of_b = terminals(*ends)
            cuts = sorted(set(ends[0]) & set(ends[1]))
            last = [int(np.flatnonzero(ends[1] == c)[0]) for c in cuts]
            for got, side in ((of_a, ends[0]), (of_b, ends[1])):
                assert got.tolist() == [last[int(np.searchsorted(cuts, e))] for e in side]


def test_alignment_of_odd_texts(spark):
    from strata.llm import alignment

    files = alignment.default_files()
    texts = odd_texts(4, 500) + [" ", "  ", "a ", "a  ", "\x00", "<s></s><unk>", "<0x41>", "<|endoftext|> x", "x" * 3000, None, ""]
    texts += [t.replace("▁", "") for t in texts[:500]] + ["word " * 30_000]
    rows = list(enumerate(texts)) + [(None, "no id"), (7, "same id")]
    want = brute.alignment(rows, *files)
    documents, pairs = alignment.link_counts(spark, frame(spark, rows).repartition(3))
    assert sorted(map(tuple, documents.collect()), key=repr) == sorted(want, key=repr)
    assert pairs.agg(F.sum("n")).first()[0] == sum(r[4] for r in want)
    written = {r.doc_id: r.groups for r in alignment.align(frame(spark, rows)).collect()}
    for doc in (0, 3, 501, 506, 512):
        assert (brute.sha(written[doc]) if written[doc] else "") == next(r[7] for r in want if r[0] == doc)


def test_files_that_merge_across_words_are_encoded_whole(spark, tmp_path):
    from strata.llm import alignment

    a, b = alignment.default_files()
    own = alignment.Aligned(["some words", "", "more  of them\n"], *alignment.sides(a, b))
    pair, piece = alignment.PairTokenizer(a), alignment.PieceTokenizer(b)
    for side in (pair, piece):
        side.by_word, side.pattern = False, alignment.WHOLE
    whole = alignment.Aligned(["some words", "", "more  of them\n"], pair, piece)
    assert all((getattr(own, k) == getattr(whole, k)).all() for k in ("ids_a", "ids_b", "last_b", "upto_a", "groups"))


def test_stored_ids_decode_to_the_texts(spark):
    from strata.llm import byte_bpe

    rows = list(enumerate(odd_texts(6, 200))) + [(900, None), (901, ""), (None, "no id")]
    stored = byte_bpe.encode(frame(spark, rows)).unionByName(spark.createDataFrame([(902, None)], "doc_id long, ids array<int>"))
    back = {r.doc_id: bytes(r.decoded).decode() for r in byte_bpe.decode(stored).collect()}
    assert back == {d: t or "" for d, t in rows} | {902: ""}


# ---------------------------------------------------------------- ranked search
def test_a_tree_finds_the_best_of_its_documents(monkeypatch):
    from strata.llm import ranked_search as rs

    rng = random.Random(9)
    for page, top, n in ((1, 3, 60), (4, 5, 200), (16, 50, 500), (16, 5, 10)):
        monkeypatch.setattr(rs, "PAGE", page)
        monkeypatch.setattr(rs, "TOP", top)
        n_terms = 30
        docs = []
        for _ in range(n):
            terms = sorted({min(n_terms - 1, int(rng.expovariate(0.2))) for _ in range(rng.randint(1, 9))})
            docs.append((terms, [rng.randint(1, 4) for _ in terms], rng.choice((60, 100, 100, 900))))
        docs += [docs[0]] * 40                                    # copies, with equal scores
        ids = rng.sample(range(10_000), len(docs) - 1) + [rs.NO_ID]
        bounds = np.cumsum([0] + [len(t) for t, _, _ in docs])
        flat = [np.array([x for d in docs for x in d[k]], np.int64) for k in (0, 1)]
        tree = rs.Tree(np.array(ids), np.array([m for _, _, m in docs]), bounds, *flat, n_terms)
        assert tree.begin[0] == 0 and tree.end[0] == len(docs)
        for node, kids in enumerate(tree.children):               # children are the node's documents, in order
            if kids:
                spans = [(tree.begin[k], tree.end[k]) for k in kids]
                assert [a for a, _ in spans] == [tree.begin[node], *[b for _, b in spans[:-1]]] and spans[-1][1] == tree.end[node]
            else:
                assert tree.end[node] - tree.begin[node] <= page
        for _ in range(20):
            asked = np.array(sorted(rng.sample(range(n_terms), rng.randint(1, 8))))
            weights = np.array([rng.randint(0, 9000) for _ in asked])
            column = np.full(n_terms, -1)
            column[asked] = np.arange(len(asked))
            best = rs.Best()
            tree.search(asked, weights, column, best)
            want = []
            for i, (terms, tfs, m) in zip(ids, docs):
                score = sum(int(w) * (10 ** 9 * tfs[terms.index(t)] // (1000 * tfs[terms.index(t)] + 20 * m))
                            for t, w in zip(asked.tolist(), weights) if t in terms)
                if score:
                    want.append((score, -i))
            assert sorted(best.heap, reverse=True) == sorted(want, reverse=True)[:top]


def test_search_in_blocks_of_items_equals_one_block(spark, edge, monkeypatch):
    from strata.llm import ranked_search as rs

    _, rows, items = edge
    items = [(str(i), t) for i, t in items] + [(None, "w1 w2 w3"), (None, "w4")]
    asked = spark.createDataFrame(items, "item_id string, text string")
    monkeypatch.setattr(rs, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(rs, "FIRST_SHARE", 2)
    got = rs.search(spark, frame(spark, rows).repartition(6), asked).select("item_id", "rank", "doc_id", "score").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute.ranked(rows, items), key=repr)


# ---------------------------------------------------------------- hot ids
def test_null_and_hot_ids_fill_several_ranges_in_order(spark):
    from strata.llm.common import crc_share, hash_share, id_ranges

    rng = random.Random(12)
    ids = [None] * 4000 + [77] * 4000 + [rng.randrange(1000) for _ in range(4000)]
    docs = frame(spark, [(i, f"text {k}") for k, i in enumerate(ids)]).repartition(6)
    for share in (hash_share(F.xxhash64("text")), crc_share(F.crc32(F.encode("text", "UTF-8")))):
        rows = docs.select("doc_id", share.alias("tie"), id_ranges(spark, docs, 24, tie=share).alias("r")).collect()
        rows = sorted((r.doc_id is not None, r.doc_id or 0, r.tie, r.r) for r in rows)
        place = [r[3] for r in rows]
        assert all(0 <= t < 1 for _, _, t, _ in rows) and place == sorted(place) and place[0] == 0
        size = sorted(place.count(r) for r in set(place))
        assert len(size) >= 22 and size[-1] < 3 * size[len(size) // 2]
    only = frame(spark, [(None, f"t{k}") for k in range(3000)])
    spread = only.groupBy(id_ranges(spark, only, 6, tie=hash_share(F.xxhash64("text")))).count().collect()
    assert len(spread) == 6 and max(r["count"] for r in spread) < 700


def test_operators_on_a_table_of_null_and_hot_ids(spark):
    """A third of the rows without an id, a third with one id: successors, order of ids and slots hold."""
    from strata.llm import sharding, token_output

    rows = [(None, f"no id {k} of many") for k in range(300)] + [(5, f"one id {k} here") for k in range(300)]
    rows += [(k, f"own id {k} text") for k in range(300)]
    docs = frame(spark, rows).repartition(4)
    out = token_output.read_tokens(spark, token_output.write_tokens(spark, docs, scratch_dir(spark, "hot"))).collect()
    out.sort(key=lambda r: r.start)
    assert [r.doc_id for r in out] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))
    assert [r.start for r in out] == [0, *itertools.accumulate(r.n_tokens for r in out)][:-1]
    nxt = fingerprint.with_next(spark, docs, ["text"]).select("doc_id", "text", "next_text").collect()
    follow = {(r.doc_id, r.text): r.next_text for r in nxt}
    at, seen = min(follow, key=lambda r: (r[0] is not None, r[0] or 0)), set()
    at = (None, at[1])
    by_text = {t: d for d, t in rows}
    while at not in seen:                        # one ring through all rows, ids ascending
        seen.add(at)
        at = (by_text[follow[at]], follow[at])
    assert len(seen) == 900
    placed, _ = sharding.place(spark, docs.withColumn("old", F.lit(0)), "old")
    slots = sorted((r.shard, r.slot) for r in placed.collect())
    assert slots == [(s, k) for s in range(8) for k in range(sum(x == s for x, _ in slots))]


# ---------------------------------------------------------------- long texts, plain vectors
def test_a_text_of_five_megabytes(spark):
    """Longer than a chunk, a shard and a batch of any operator; its copy differs in one word."""
    import zlib

    import public_tokenizers
    import tiktoken

    from strata.llm import byte_bpe, ranked_search

    rng = random.Random(21)
    words = [f"w{rng.randrange(4000)}" for _ in range(950_000)]
    long = " ".join(words)
    other = " ".join(words[:40_000] + ["changed"] + words[40_001:60_000])
    rows = [(1, long), (2, other), (3, "short text\n" * 3), (4, None)]
    items = [(10, " ".join(words[700_000:700_030])), (11, "w1 changed w3")]
    assert len(long) > 5_000_000
    docs, bench = frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    hits = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in decontam.find_contaminated(spark, docs, bench).collect()}
    want = {r[0]: r[1:4] for r in brute.contamination(rows, items)}
    assert {d: (n, h, len(i)) for d, (n, h, i) in hits.items()} == want and hits[1][2] == ["10"]
    cut = substring_dedup.remove_repeats(spark, docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256))
    assert sorted(map(tuple, cut.collect())) == sorted(brute.substrings(rows))
    folder = token_output.write_tokens(spark, docs, scratch_dir(spark, "long"))
    enc = Encoder(word_tokenizer()).tok
    ids = {d: enc.encode(t or "", add_special_tokens=False).ids + [1] for d, t in rows}
    for r in token_output.read_tokens(spark, folder).collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == ids[r.doc_id] and r.ids_crc32 == zlib.crc32(r.ids)
    own = byte_bpe.codec(byte_bpe.multi_ranks())
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    for r in byte_bpe.encode(docs, decoded=True).collect():
        text = dict(rows)[r.doc_id] or ""
        assert list(r.ids) == plain.encode_ordinary(text) and bytes(r.decoded) == text.encode()
    got = ranked_search.search(spark, docs, bench).select("item_id", "rank", "doc_id", "score").collect()
    assert sorted(map(tuple, got)) == sorted(brute.ranked(rows, items))


def test_vectors_and_pooling_equal_plain_sums(spark):
    """Random indexing and pooling, word by word."""
    rng = random.Random(22)
    texts = [" ".join(rng.choice("ab cd ef gh ij kl".split()) for _ in range(n)) for n in (0, 1, 2, 3, 40, 700)]
    row = {w: int(quality.word_rows([w.encode()])[0][0]) for w in "ab cd ef gh ij kl".split()}
    places, signs = quality.index_vectors(7)
    table = np.zeros((quality.BUCKETS, quality.DIMS))
    for t in texts:
        w = t.split()
        for i, x in enumerate(w):
            for j in range(max(0, i - quality.REACH), min(len(w), i + quality.REACH + 1)):
                if j != i:
                    for p, s in zip(places[row[w[j]]], signs[row[w[j]]]):
                        table[row[x], p] += s
    total = np.zeros(quality.BUCKETS * quality.DIMS)
    quality.neighbour_sums(text.encode(texts), places, signs, total)
    assert (total.reshape(table.shape) == table).all()
    size = np.linalg.norm(table, axis=1)
    seen = size > 0
    unit = np.where(seen[:, None], table / np.where(seen, size, 1)[:, None], 0)
    unit[seen] -= unit[seen].mean(axis=0)
    vectors = quality.train_vectors(spark, frame(spark, list(enumerate(texts))).repartition(3))
    assert np.allclose(vectors, unit, atol=1e-6)
    pooled = quality.pool(text.encode(texts), vectors)
    for t, got in zip(texts, pooled):
        x = np.array([vectors[row[w]] for w in t.split()]).reshape(-1, quality.DIMS)
        near = x[:-1] * x[1:]
        want = [(x.mean(axis=0) if len(x) else np.zeros(quality.DIMS)), ((x * x).mean(axis=0) if len(x) else np.zeros(quality.DIMS)),
                near.mean(axis=0) if len(near) else np.zeros(quality.DIMS)]
        assert np.allclose(got, np.concatenate(want), atol=1e-5)


def test_the_network_scores_as_its_layers_say():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 3 * quality.DIMS)).astype(np.float32)
    y = (x[:, 0] + x[:, 1] > 0).astype(np.float32)
    net = quality.Network(x, y)
    hidden = np.maximum((x - net.mean) / net.scale @ net.w[0] + net.w[1], 0)
    want = 1 / (1 + np.exp(-(hidden @ net.w[2] + net.w[3]) / net.temperature))
    assert np.allclose(net.score(x), want, atol=1e-6) and ((net.score(x) > 0.5) == (y > 0.5)).mean() > 0.9
