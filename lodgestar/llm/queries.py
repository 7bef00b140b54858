"""One registered query per operator, on its whole table with production settings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgestar.llm import (
    ann,
    embedding_dedup,
    fim,
    hard_negatives,
    licenses,
    line_dedup,
    mixing,
    packing,
    secrets,
    simhash,
    substring_dedup,
    toxicity,
    url_filter,
)
from lodgestar.session import stage

TOKENIZER = "byte_bpe_50k.json"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the words that the mix of all sources takes of it."""
    drawn = mixing.with_draws(_table(spark, folder, "documents"))
    # Without texts the rows are narrow, so the words are counted once and written.
    drawn = stage(drawn.select("doc_id", "mix_"), "mix-draws")
    mixed = mixing.mix_drawn(drawn, narrow=drawn.select("mix_"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op2_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of all vectors at cosine 0.95."""
    return embedding_dedup.near_duplicates(_table(spark, folder, "embeddings"))


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its lines, those removed, and a digest of what is left."""
    found = line_dedup.dedup_lines(_table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all documents by a model of the labelled ones outside the held-out fifth."""
    docs = _table(spark, folder, "documents")
    labels = _table(spark, folder, "labels")
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    model = toxicity.fit(docs, labels.where(remainder != 0))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        (remainder == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its words, those removed, and a digest of what is left."""
    return substring_dedup.dedup_substrings(_table(spark, folder, "documents"))


def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Every license notice in a document, with its coverage and span."""
    return licenses.scan(_table(spark, folder, "documents"))


def op7_ann(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 nearest vectors of every 100th vector."""
    vectors = _table(spark, folder, "embeddings")
    return ann.search(vectors.where(F.col("vec_id") % 100 == 0), vectors)


def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Findings in all documents that the forest does not reject."""
    return secrets.scan(_table(spark, folder, "documents"))


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.simhash_components(_table(spark, folder, "documents"))


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Places of all documents' tokens in sequences of 1,024."""
    return packing.pack_documents(_table(spark, folder, "documents"), tokenizer_path())


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every 50th vector; a seventh of the labels is moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _table(spark, folder, "embeddings").withColumn("label", moved)
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 50 == 0)


#: Rules of the registered query.
URL_RULES = (
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
)


def op12_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on every page's URL, with the rule or the terms behind it."""
    judged = url_filter.judge(_table(spark, folder, "pages"), URL_RULES)
    return judged.select(
        "page_id",
        "host",
        "path",
        "rule",
        "verdict",
        F.size("strict_terms").alias("n_strict"),
        F.size("soft_terms").alias("n_soft"),
    )


def op13_fim(spark: SparkSession, folder: str) -> DataFrame:
    """Every document cut for filling in its middle, as digests of the new and the restored text."""
    cut = fim.transform(_table(spark, folder, "documents"))
    restored = fim.restored(F.col("form"), F.col("output"))
    return cut.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored, 256).alias("restored_sha256"),
    )


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    functions = (
        op1_mixing,
        op2_embedding_dedup,
        op3_line_dedup,
        op4_toxicity,
        op5_substring_dedup,
        op6_license_scan,
        op7_ann,
        op8_secret_scan,
        op9_simhash,
        op10_packing,
        op11_hard_negatives,
        op12_url_filter,
        op13_fim,
        pipeline,
    )
    return {function.__name__: function for function in functions}
