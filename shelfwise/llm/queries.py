"""One query per operator, over its whole table with production parameters, and the SQL it is held against."""

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from shelfwise.llm import oracles
from shelfwise.llm.chat_views import rotate_perspectives
from shelfwise.llm.collocations import collocations
from shelfwise.llm.common import table
from shelfwise.llm.decontaminate import contamination
from shelfwise.llm.hard_negatives import hard_negatives
from shelfwise.llm.imatch import fingerprint_report
from shelfwise.llm.jaccard_join import jaccard_components
from shelfwise.llm.log_bilinear import language_model_scores
from shelfwise.llm.pareto_mix import by_length, mix_sources
from shelfwise.llm.pii import pii_digest
from shelfwise.llm.quality_gam import quality_scores
from shelfwise.llm.secrets import secret_report
from shelfwise.llm.suffix_dedup import remove_repeats
from shelfwise.llm.token_cache import count_tokens
from shelfwise.session import shared_dir

TOKENIZER = "word_bpe_49k.json"


def op1_chat_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as each of their speakers sees them."""
    return rotate_perspectives(table(spark, sf_dir, "conversations"))


def op2_token_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents through a cache that starts empty, so the call does all of its work."""
    cache = f"{shared_dir(spark).rstrip('/')}/llm-token-cache-{uuid.uuid4().hex}"
    return count_tokens(table(spark, sf_dir, "documents"), cache, public_tokenizers.path(TOKENIZER))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents inside ten-word windows of all benchmark items."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, of their edited texts, and how alike they and their neighbours are."""
    return fingerprint_report(table(spark, sf_dir, "documents"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    return secret_report(table(spark, sf_dir, "documents"))


def op6_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learned from the labels that are not held out."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to source weights 1, 2, 3, longer ones preferred."""
    return mix_sources(table(spark, sf_dir, "documents"), preference=by_length)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    return pii_digest(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' bytes without the 100-byte strings that occur earlier."""
    return remove_repeats(table(spark, sf_dir, "documents")).drop("removed")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents whose three-word shingle sets have a Jaccard similarity of 0.9 or more."""
    return jaccard_components(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector against all vectors."""
    return hard_negatives(table(spark, sf_dir, "embeddings"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases of two or three words in all documents, 2,000 of each language."""
    return collocations(table(spark, sf_dir, "documents"))


def op13_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of all documents, learned from those that are not held out."""
    return language_model_scores(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_chat_views": op1_chat_views,
    "op2_token_cache": op2_token_cache,
    "op3_decontamination": op3_decontamination,
    "op4_imatch": op4_imatch,
    "op5_secrets": op5_secrets,
    "op6_quality_gam": op6_quality_gam,
    "op7_pareto_mix": op7_pareto_mix,
    "op8_pii": op8_pii,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_collocations": op12_collocations,
    "op13_log_bilinear": op13_log_bilinear,
    "pipeline": pipeline,
}
ORACLES = {
    "op1_chat_views": oracles.CHAT_VIEWS,
    "op3_decontamination": oracles.DECONTAMINATION,
    "op7_pareto_mix": oracles.PARETO_MIX,
    "op8_pii": oracles.pii_sql(),
    "op11_hard_negatives": oracles.HARD_NEGATIVES,
    "op12_collocations": oracles.COLLOCATIONS,
}
