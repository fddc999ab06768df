"""From raw documents to packed sequences: the stages, and a run over all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logweir.llm import decontaminate, langid, packing, pii, simhash
from logweir.llm.catalog import table, tokenizer
from logweir.llm.common import Tables, small_batches


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without a letter and texts in none of the languages that ``docs`` names."""
    small_batches(spark)
    return langid.known_language(docs, langid.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies, the one with the smallest id."""
    small_batches(spark)
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain a window of the benchmark."""
    small_batches(spark)
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts by surrogates. ``n_chars`` follows the text."""
    small_batches(spark)
    return pii.pseudonymised(docs, key="a key for these tables", n_chars="n_chars")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of what is left: one row for each piece and its place."""
    small_batches(spark)
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("personal_data", personal_data), ("packed", packed)]

#: Trained networks and byte-pair encoding are beyond SQL; the tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Each but the last is written to the shared folder and reread,
    so a lost executor costs no more than the stage at work; what a stage has used up is removed."""
    docs, tables, used = table(spark, sf_dir, "documents"), Tables(spark, "pipeline"), None
    for name, stage in STAGES[:-1]:
        docs = tables.write(name, stage(spark, docs, sf_dir))
        if used:
            tables.remove(used)
        used = name
    return STAGES[-1][1](spark, docs, sf_dir)
