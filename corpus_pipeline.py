"""From raw documents to packed training sequences, in five stages.

Every stage reads the Parquet table its predecessor left and works on all of it. Texts in no known language go, then
lines that repeat, near duplicates and documents with benchmark passages; what is left is packed.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm import decontaminate, fuzzy_lines, jaccard_join, language, packing
from cohortloom.runtime import remove_path, scratch_path, scratch_scope

# three stages have no SQL form: trigram posteriors, SimHash groups and token ids
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in no language that the corpus declares; texts without letters among them.

    The declared language and the source are evidence, as markup and host are for a page. No accepted text changes.
    """
    judged = language.identify_languages(docs, F.col("text"), F.col("lang"), F.col("source"))
    return judged.filter("accepted").select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one occurrence of each group of similar lines; a document that loses all its words goes with them.

    ``n_chars`` follows the text of documents that change.
    """
    kept = fuzzy_lines.drop_repeated_lines(docs)
    changed = F.col("n_removed") > 0
    kept = kept.filter(~changed | F.col("text").rlike(r"[\p{L}\p{N}]"))
    kept = kept.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return kept.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the least document of each group of documents whose five-word shingles are similar by 0.8 or more."""
    return jaccard_join.keep_one(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold ten consecutive words of a benchmark item, or a shorter item whole."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.scan_benchmark(docs, items).filter("n_hit = 0").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, with their token ids and their places in the sequences."""
    pieces = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), carry=["doc_id"])
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("language", identify_language),
    ("lines", drop_lines),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark", drop_benchmark_passages),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents. What a stage wrote on the way goes when its table is written, and its table
    when the next one is."""
    path = f"{sf_dir}/documents.parquet"
    for at, (name, stage) in enumerate(STAGES):
        before, path = path, scratch_path(spark, name)
        with scratch_scope(spark):
            stage(spark, spark.read.parquet(before), sf_dir).write.parquet(path)
        if at:
            remove_path(spark, before)
    return spark.read.parquet(path)
