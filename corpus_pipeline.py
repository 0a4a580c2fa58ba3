"""A training corpus from raw documents: language, near-copies, passages, benchmarks, tokens.

Every stage takes all rows its predecessor kept and, but for the last, returns them with
the columns they came with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from txrisk.llm import bpe_codec, decontaminate, language_id, paragraphs, simhash
from txrisk.llm.common import id_remainder, keep, prepare, table
from txrisk.llm.queries import vocabulary_path

# A document goes if no language scores this much. What the kernel has learned from scores far above.
MIN_LANGUAGE_SCORE = 0.1


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from ``docs`` itself; null and letterless texts go."""
    prepare(spark)
    model = language_id.fit_languages(docs, id_remainder("doc_id", 4) != 2)
    found = language_id.identify(docs, model, "_found_")
    sure = (F.col("_found_lang_pred") != language_id.UNKNOWN) & (F.col("_found_score") >= MIN_LANGUAGE_SCORE)
    return found.where(sure).select(docs.columns)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near-copies.

    Of rows that repeat a doc_id one stays. Rows without a doc_id cannot be named and all stay.
    """
    prepare(spark)
    found = simhash.simhash_components(docs, shingle=3, max_bits=2)
    first = found.where("doc_id = component_id").select(F.col("doc_id").alias("_kept")).distinct()
    kept = docs.join(first, F.col("doc_id") == F.col("_kept"), "left_semi").dropDuplicates(["doc_id"])
    return kept.unionByName(docs.where("doc_id is null"))


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the paragraphs and passages that an earlier document has; a document left empty goes."""
    prepare(spark)
    return paragraphs.without_repeats(docs, paragraphs.repeated_paragraphs(docs))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"))
    leaks = found.select(F.col("doc_id").alias("_leak")).distinct()
    return docs.join(leaks, F.col("doc_id") == F.col("_leak"), "left_anti")


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, their number, and digests of the ids and of what they decode to."""
    prepare(spark)
    kept = docs.select("doc_id", "lang", "source", "text")
    return bpe_codec.codec_digests(kept, vocabulary_path(), keep_ids=True).drop("text")


STAGES = [
    ("language_id", language_stage),
    ("simhash_dedup", simhash_stage),
    ("substring_dedup", substring_stage),
    ("decontamination", benchmark_stage),
    ("bpe", token_stage),
]

# No engine's SQL has the kernels, fingerprints and vocabularies; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
