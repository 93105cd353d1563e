"""One query per operator over the whole given tables, and SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesprep.llm import (
    decontamination,
    fim,
    html_text,
    language_id,
    packing,
    prefix_trie,
    quality_classifier,
    quality_rules,
    simhash,
    slack_packing,
    suffix_dedup,
    url_filter,
    warc,
)

#: Fixed rules of the url query: host, path prefix, verdict.
URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.build_index(rules), keep=["page_id"])


def fold(parts: int) -> Column:
    """crc32 of the doc_id as text, modulo ``parts``; 0 for a null doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % parts, F.lit(0))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(table(spark, sf_dir, "documents"), shingle=3)


def word_tokenizer() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), word_tokenizer())


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", (fold(4) == 2).alias("held_out"))
    model = language_id.fit(docs.where("NOT held_out"))
    return language_id.predict(docs, model, keep=["doc_id", "held_out"])


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_back(spark, warc.write_archive(table(spark, sf_dir, "pages")))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


#: Score from which a text counts as good.
GOOD = 0.3


def quality_model(docs: DataFrame, labels: DataFrame) -> quality_classifier.Model:
    """Learnt from labelled rows outside the held-out fold."""
    return quality_classifier.fit(quality_classifier.sample(labels.where(fold(5) != 0), docs))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (fold(5) == 0).alias("held_out"))
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    scored = quality_classifier.score(docs, model, keep=["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= GOOD).cast("int"))


def op11_minimum_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slack_packing.pack(table(spark, sf_dir, "documents"), word_tokenizer())


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.transform(table(spark, sf_dir, "documents"))
    again = fim.restored(F.col("output"), F.col("form"))
    digests = [F.sha2("output", 256).alias("output_sha256"), F.sha2(again, 256).alias("restored_sha256")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.nodes(prefix_trie.rebuilt(prefix_trie.conversations(table(spark, sf_dir, "conversations"))))


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_decontamination": op2_decontamination,
    "op3_quality_rules": op3_quality_rules,
    "op4_simhash": op4_simhash,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_language_id": op7_language_id,
    "op8_warc": op8_warc,
    "op9_html_extraction": op9_html_extraction,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_minimum_slack_packing": op11_minimum_slack_packing,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_prefix_trie": op13_prefix_trie,
}
