"""Registered queries of the corpus operators and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from strata.llm import alignment, byte_bpe, decontam, fingerprint, line_dedup, ngram_join, packing, quality, ranked_search, sharding, substring_dedup, token_counts, token_output
from strata.session import prepare

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _add(fn, oracle: str | None = None) -> None:
    def run(spark, sf_dir: str):
        prepare(spark)
        return fn(spark, sf_dir.rstrip("/"))

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    if oracle:
        ORACLES[fn.__name__] = oracle.strip()


_add(decontam.op1_decontamination, decontam.ORACLE)
_add(substring_dedup.op2_substring_dedup, substring_dedup.ORACLE)
_add(fingerprint.op3_fingerprint)
_add(ngram_join.op4_ngram_join, ngram_join.ORACLE)
_add(quality.op5_quality)
_add(line_dedup.op6_line_dedup, line_dedup.ORACLE)
_add(token_output.op7_token_output)
_add(token_counts.op8_token_counts)
_add(sharding.op9_sharding)
_add(packing.op10_packing)
_add(byte_bpe.op11_byte_bpe)
_add(ranked_search.op12_ranked_search, ranked_search.ORACLE)
_add(alignment.op13_alignment)
