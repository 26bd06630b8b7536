"""Documents to token ids: five stages, each over all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from instrel.llm import op03_quality, op05_simhash, op08_bpe, op09_secrets, op10_decontamination
from instrel.llm.common import stored, table

TOKENIZER = "byte_bpe_multi_50k.tiktoken"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from labelled rows of the folder's documents."""
    model = op03_quality.fit_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    scored = op03_quality.score_quality(docs, model, whole_rows=True)
    return scored.where(F.col("predicted") == 1).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by fingerprints of three-word shingles at most 2 bits apart the one of the smallest id stays."""
    return op05_simhash.keep_one(docs, shingle=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share ten words in a row with a benchmark item go."""
    return op10_decontamination.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; ``n_chars`` follows the text."""
    return op09_secrets.redact(docs).withColumn(
        "n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("bigint"))).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, ids_sha256, decoded_sha256``; the digest of the decoded bytes is that of the text."""
    path = public_tokenizers.path(TOKENIZER)
    encoded = op08_bpe.encode(docs, path, public_tokenizers.PATTERN, parted=True)
    return op08_bpe.decode(encoded, path).select("doc_id", "n_tokens", "ids", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality),
    ("simhash near duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scan", secrets),
    ("byte-level bpe", tokens),
]

#: Fitting and tokenising are no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stored(docs, f"stage-{at}")
    return docs
