"""The pipeline's stages against plain versions, each on what its predecessor kept."""

from collections import defaultdict

import corpus_pipeline as P
from strata.llm import quality
from strata.llm.tokens import Encoder, word_tokenizer
from tests.llm import brute


def test_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    columns, kept = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    rejected = {r.doc_id for r in quality.classify(spark, docs, spark.read.parquet(f"{sf}/labels.parquet")).where("predicted = 0").collect()}

    def plain(name, rows):
        if name == "quality":
            return [r for r in rows if r[0] not in rejected]
        if name == "lines":
            return [(d, t) for d, _, _, t in brute.lines(rows)]
        if name == "near_duplicates":
            keep = {d for d, _, c, _ in brute.components(rows, 5, 80) if d == c}
            return [r for r in rows if r[0] in keep]
        bad = {r[0] for r in brute.contamination(rows, items) if r[-1]}
        return [r for r in rows if r[0] not in bad]

    for k, (name, fn) in enumerate(P.STAGES[:-1]):
        want = plain(name, sorted(kept.items()))
        fn(spark, docs, sf).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        rows = docs.collect()
        assert docs.columns == columns and all(r.n_chars == len(r.text) for r in rows)
        assert sorted((r.doc_id, r.text) for r in rows) == want, name
        assert len(want) < len(kept) or name == "lines"
        kept = dict(want)
    tok, tokens = Encoder(word_tokenizer()).tok, defaultdict(int)
    for r in P.STAGES[-1][1](spark, docs, sf).collect():
        tokens[r.doc_id] += r.length
    assert tokens == {d: len(tok.encode(t, add_special_tokens=False).ids) + 1 for d, t in kept.items()}


def test_run_gives_the_last_stage(spark, empty, sf):
    assert P.run(spark, empty).count() == 0
    assert P.run(spark, sf).columns[:3] == ["doc_id", "start", "length"]
    assert [n for n, _ in P.STAGES] == ["quality", "lines", "near_duplicates", "contamination", "packing"]
