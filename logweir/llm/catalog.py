"""The operators applied to whole tables, under the names the driver looks for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.llm import codes, decompose, decontaminate, importance, langid, nearest, packing, pii, ppm, quality, simhash, substring, suffix
from logweir.llm.common import held_out, small_batches
from logweir.session import pin_utc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return small_batches(pin_utc(spark)).read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """Where a public tokenizer's file lies on this machine and, by the same install, on executors."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_simhash(spark, d):
    found = simhash.near_duplicates(table(spark, d, "documents"))
    return found.select("doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op2_substring(spark, d):
    found = substring.without_repeats(table(spark, d, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op3_language_id(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    apart = held_out(F.col("doc_id"), 4, 2)
    model = langid.fit(docs.filter(~apart))
    return langid.identify(docs, model, result="l").select(
        "doc_id", apart.alias("held_out"), "l.lang_pred", "l.score")


@query
def op4_quality(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    apart = held_out(F.col("doc_id"), 4, 2)
    model = quality.fit(docs, table(spark, d, "labels").filter(~apart))
    return quality.score_quality(docs, model).select(
        "doc_id", apart.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op5_decontamination(spark, d):
    scanned = decontaminate.scan_documents(table(spark, d, "documents").select("doc_id", "text"),
                                           table(spark, d, "benchmark"), result="c")
    return scanned.select(
        "doc_id", F.col("c.n_words").alias("n_words"), F.size("c.positions").cast("long").alias("n_hit"),
        F.size("c.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("c.items", ","), 256).alias("items_sha256"),
        (F.size("c.positions") > 0).alias("contaminated"))


@query
def op6_nearest(spark, d):
    vectors = table(spark, d, "embeddings")
    return nearest.nearest(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


@query
def op7_lm_scoring(spark, d):
    return ppm.score_documents(table(spark, d, "documents"), ~held_out(F.col("doc_id"), 7, 2))


@query
def op8_pii(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return pii.pseudonymised(docs, key="a key for these tables", count="n_entities")


@query
def op9_suffix_array(spark, d):
    found = suffix.without_repeats(table(spark, d, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op10_packing(spark, d):
    return packing.pack(table(spark, d, "documents"), tokenizer("word_bpe_49k.json"))


@query
def op11_codes(spark, d):
    coded, books = codes.compress(table(spark, d, "embeddings"))
    return codes.with_label_error(coded).select(
        F.col("id").alias("vec_id"), F.lower(F.hex("codes")).alias("code"), "error", "label_error",
        F.lit(codes.books_digest(books)).alias("codebooks_sha256"))


@query
def op12_importance(spark, d):
    return importance.draw(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query
def op13_decomposition(spark, d):
    made = decompose.bucketed(table(spark, d, "documents"), tokenizer("byte_bpe_50k.json"))
    return made.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
