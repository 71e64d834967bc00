"""The corpus pipeline: from raw documents to packed training sequences.

Each stage works on all rows its predecessor kept; stages are written as
Parquet and read again, so a lost executor costs one stage's tasks at most.
All but the last return the columns of ``documents``.

Defined cases, for every stage: an empty table gives an empty one (with the
stage's columns); a null text is an empty text; rows are kept or dropped by
(doc_id, text), so rows that repeat as a whole stay or go together; a null
doc_id is a row like others, but names no labelled document and no smallest id;
extra columns pass through, whatever their names, up to the last stage; a text
of any length is handled whole, in one task's memory. What each stage does with
null, empty and tied rows beyond that stands at the stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontam, line_dedup, ngram_join, packing, quality
from strata.llm.common import stage
from strata.session import prepare


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go (score below 0.3).

    Null and empty texts are scored as such (all alike); a score of exactly 0.3 stays; labels
    without a document are passed over; without labels of both classes every score is their share.
    """
    prepare(spark)
    return quality.drop_rejected(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in 10 documents or more leave every text; ``n_chars`` follows the text.

    Empty lines stay. Rows of one id count as one document, null ids together as one. A null text
    becomes an empty one; a text all of whose lines go stays as an empty text.
    """
    prepare(spark)
    return with_n_chars(line_dedup.drop_lines(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity of 0.8 or more, the smallest id.

    Texts without words are in no group and stay. Rows that repeat the smallest id and its text stay
    together, rows with a null id stay always; a similarity of exactly 0.8 is near.
    """
    prepare(spark)
    return ngram_join.keep_one(spark, docs, size=5, percent=80)


def contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go if benchmark passages of 13 words hit a twentieth of their words.

    Texts without words stay; exactly a twentieth goes; items without words hit nothing, items of
    fewer than 13 words are one passage.
    """
    prepare(spark)
    return decontam.drop_contaminated(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens.

    An empty text is its end id alone; rows that repeat are packed each; other columns are left out.
    """
    prepare(spark)
    return packing.pack(spark, docs)


def with_n_chars(docs: DataFrame) -> DataFrame:
    from pyspark.sql import functions as F

    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.select(*[F.char_length("text").cast(kind).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


STAGES = [
    ("quality", quality_filter),
    ("lines", shared_lines),
    ("near_duplicates", near_duplicates),
    ("contamination", contaminated),
    ("packing", packed_sequences),
]

# Scores of a trained network and token ids are beyond SQL; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    sf_dir = sf_dir.rstrip("/")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, fn in STAGES[:-1]:
        docs = stage(spark, fn(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
