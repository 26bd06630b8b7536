"""One query for each operator, over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from instrel.llm import op01_sharding, op02_context_tree, op03_quality, op04_toxicity, op05_simhash, op06_url_filters
from instrel.llm import op07_cross_polytope, op08_bpe, op09_secrets
from instrel.llm import op10_decontamination as decontamination
from instrel.llm import op11_packing as packing
from instrel.llm import op12_divergence as divergence
from instrel.llm import op13_vector_codes as vector_codes
from instrel.llm.common import table

SHARDS = 24
TOKENIZER = "byte_bpe_multi_50k.tiktoken"


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of 24 equal ones."""
    return op01_sharding.shard_documents(table(spark, sf_dir, "documents"), [1.0] * SHARDS)


def op2_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under a context-tree model of those not held out."""
    return op02_context_tree.score_documents(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    docs = table(spark, sf_dir, "documents")
    model = op03_quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return op03_quality.score_quality(docs, model)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs = table(spark, sf_dir, "documents")
    return op04_toxicity.score_toxicity(docs, op04_toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels")))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return op05_simhash.near_duplicates(table(spark, sf_dir, "documents"))


#: Site rules come first; the patterns behind them tell listing, account and file urls from texts.
URL_RULES = [
    op06_url_filters.site_rule("net", "/", "block"),
    op06_url_filters.site_rule("example.net", "/en/", "allow"),
    op06_url_filters.site_rule("example.com", "/de/", "block"),
    op06_url_filters.site_rule("org", "/fr/", "allow"),
]
URL_PATTERNS = [
    op06_url_filters.Rule("listing", r"(?s)^[^#]*#.*[?&]page=[0-9]+", ["page"], "block", 3),
    op06_url_filters.Rule("login", r"^[^#]*#[^#]*/login[/.#]", ["login"], "block", 2),
    op06_url_filters.Rule("cart", r"^[^#]*#[^#]*/cart[/.#]", ["cart"], "block", 2),
    op06_url_filters.Rule("archive file", r"^[^#]*#[^#]*\.zip#", ["zip"], "block", 1),
]


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url; ``rule`` names site rules only."""
    return op06_url_filters.judge_with_sites(table(spark, sf_dir, "pages"), URL_RULES, URL_PATTERNS)


def op7_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every twentieth vector."""
    return op07_cross_polytope.search(table(spark, sf_dir, "embeddings"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, decoded again."""
    path = public_tokenizers.path(TOKENIZER)
    encoded = op08_bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, parted=True)
    return op08_bpe.decode(encoded, path).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return op09_secrets.digest(op09_secrets.scan(table(spark, sf_dir, "documents")))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), "contaminated")


PACKING_TOKENIZER = "byte_bpe_50k.json"


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 ids."""
    packed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(PACKING_TOKENIZER))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of the sources of each language."""
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of all vectors after two rounds."""
    coded = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    totals = coded.rows.groupBy(F.col("label").alias("total_of")).agg(F.sum("error").alias("label_error"))
    return coded.rows.join(totals, F.col("label").eqNullSafe(F.col("total_of"))).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.sha2(F.lit(vector_codes.spelled(coded.codebooks)).cast("binary"), 256).alias("codebooks_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_sharding": op1_sharding,
        "op2_context_tree": op2_context_tree,
        "op3_quality": op3_quality,
        "op4_toxicity": op4_toxicity,
        "op5_simhash": op5_simhash,
        "op6_url_filters": op6_url_filters,
        "op7_cross_polytope": op7_cross_polytope,
        "op8_bpe": op8_bpe,
        "op9_secrets": op9_secrets,
        "op10_decontamination": op10_decontamination,
        "op11_packing": op11_packing,
        "op12_divergence": op12_divergence,
        "op13_vector_codes": op13_vector_codes,
    }
