"""From raw documents to tokens: quality, near-duplicates, benchmark passages, pieces.

STAGES are functions of (spark, docs, sf_dir); each stage's rows are written as Parquet and read again
as the next one's docs. All but the last return the columns of documents, whatever further ones there are.
No documents give no rows at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from waymark.llm import decontaminate, neardup, pieces, quality
from waymark.llm.common import read, stored


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised classifier, fitted to docs, doesn't reject.

    A null, empty or wordless text is rejected; equal texts fare alike; other columns ride along.
    """
    return quality.keep_good(docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8): that of the smallest id.

    Texts without words are in no group and stay; so do rows with a null id. Of rows that repeat an id one stays.
    """
    return neardup.deduplicate(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word window of a benchmark item.

    Texts without words have no window and stay; an item without words asks for nothing, one of fewer than ten words is one
    window; an empty benchmark keeps all.
    """
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled pieces of every document, decoded again and held against its text.

    A null or empty text has no pieces and counts as empty; every row gives a row, also one that repeats an id or has none.
    """
    return pieces.tokenize(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", minhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("SentencePiece encoding and decoding", sentencepiece_encoding),
]

#: SQL can express neither the fitted classifier nor the sampling.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows: (doc_id, token_ids, n_tokens, text_sha256, lossless)."""
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage{k}")
    return docs
