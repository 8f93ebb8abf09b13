"""The corpus pipeline: quality classifier, MinHash near-dedup, secret scans, packing.

Each stage works on all that the one before kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starpanel.llm import minhash_dedup, packing, quality, secret_scan
from starpanel.llm.common import Written, table

#: No SQL can fit the classifier or encode texts; the tests hold the stages against plain versions.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold. The model learns from labels outside the held-out fold."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), ~quality.held_out())
    return quality.kept_documents(docs, model)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (similarity 0.8 on shingles of five words): that of the smallest id."""
    return minhash_dedup.kept_documents(docs, 0.8)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents without the secrets in their texts; n_chars follows the text."""
    return secret_scan.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids, dealt to sequences without padding."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), ids=False)


STAGES = [
    ("quality classifier", quality_stage),
    ("MinHash near-dedup", dedup_stage),
    ("secret scans", secrets_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, written = table(spark, sf_dir, "documents"), Written(spark)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{k}")
    return docs
