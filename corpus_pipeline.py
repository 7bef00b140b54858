"""From raw documents to packed sequences: five stages, each on all that the one before kept.

``run`` writes the rows of every stage as Parquet in the shared folder and reads them back, so a lost
executor never costs more than a stage. Columns of ``documents`` come through all stages but the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgestar.llm import line_dedup, mixing, packing, simhash, toxicity
from lodgestar.llm.queries import tokenizer_path
from lodgestar.session import stage


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model of the labelled ones does not take for toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, labels)


def remove_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier document has as well."""
    kept = line_dedup.dedup_lines(docs)
    text = kept["kept_text"]
    changed = kept["n_removed"] > 0
    return kept.withColumns(
        {
            "text": F.when(changed, text).otherwise(kept["text"]),
            "n_chars": F.when(changed, F.length(text)).otherwise(kept["n_chars"]).cast("long"),
        }
    ).select(*docs.columns)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    return mixing.mixed_rows(mixing.mix_sources(docs)).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents' tokens in sequences."""
    return packing.pack_documents(docs, tokenizer_path())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", remove_toxic),
    ("line_dedup", remove_lines),
    ("simhash", remove_near_copies),
    ("mixing", mix),
    ("packing", pack),
]

# Training a model, fingerprints and a tokenizer have no SQL form; tests hold the stages against
# brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
