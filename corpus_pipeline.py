"""From documents to packed training sequences, by five operators of the llm subpackage.

Each stage works on all rows that the one before it kept, written as Parquet and read
again. All stages but the last return the columns of ``documents``.

Defined cases: rows with a null or empty text are scored like others by the classifier; they have
fingerprint zero, so one of them stays; their text stays as it is and is packed as its end id. Repeated rows
are near-duplicates of each other. Of groups the smallest doc_id stays, nulls last. Other columns stay as they
are, whatever their names. From an empty table each stage gives none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesprep.llm import decontamination, packing, quality_classifier, simhash, suffix_dedup
from salesprep.llm.queries import GOOD, quality_model, table, word_tokenizer
from salesprep.llm.shared import stage
from salesprep.staging import scope

#: SQL cannot express these stages; tests hold them against plain Python.
ORACLE_SQL = None

#: Words of a shingle whose hashes make a fingerprint.
SHINGLE = 3
#: Words from which a repeated passage goes.
PASSAGE_WORDS = 51


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not reject."""
    return quality_classifier.only_good(docs, quality_model(docs, table(spark, sf_dir, "labels")), GOOD)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints (at most ``simhash.DISTANCE`` bits)."""
    return simhash.one_of_each(docs, SHINGLE)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated passages of over 50 words; n_chars follows the text."""
    kept = suffix_dedup.without_repeats(docs, unit=suffix_dedup.Unit(PASSAGE_WORDS, words=True))
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents, packed into sequences."""
    return packing.pack(docs, word_tokenizer())


STAGES = [
    ("quality_classifier", classify),
    ("simhash_near_dedup", near_dedup),
    ("suffix_dedup", passage_dedup),
    ("decontamination", decontaminate),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage leaves is deleted when the next has been written."""
    docs = table(spark, sf_dir, "documents")
    with scope(spark) as whole:
        for name, step in STAGES:
            before = docs
            with scope(spark) as own:
                docs = stage(step(spark, before, sf_dir), name)
                own.keep(docs)
            whole.drop(spark, before)
        whole.keep(docs)
    return docs
