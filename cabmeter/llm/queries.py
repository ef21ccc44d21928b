"""One registered query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabmeter.llm.decontam import contaminated
from cabmeter.llm.divergence import source_divergence
from cabmeter.llm.linededup import line_dedup
from cabmeter.llm.lzprint import neighbour_prints
from cabmeter.llm.minhash import minhash_components
from cabmeter.llm.packing import pack_documents
from cabmeter.llm.pii import BASE, detect_pii, spans_text
from cabmeter.llm.rpforest import embedding_components
from cabmeter.llm.spelling import spelling_variants
from cabmeter.llm.substringdedup import substring_dedup
from cabmeter.llm.suffixdedup import suffix_dedup
from cabmeter.llm.tables import read_table
from cabmeter.llm.toxicity import fit_toxicity, remainder, score_toxicity
from cabmeter.llm.warc import read_archives, write_archives


def op1_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return minhash_components(docs, shingle=2, percent=80).select(
        F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "kept")


def op2_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return embedding_components(vectors, least=0.9).select(
        F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


def op3_dictionary_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = write_archives(read_table(spark, sf_dir, "pages"))
    return read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_pii_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = detect_pii(read_table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind):
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("pii", lambda s: s["rank"] < len(BASE))
    return docs.select("doc_id", *map(count, BASE), F.sha2(spans_text(base).cast("binary"), 256).alias("base_sha256"), spans_text(F.col("pii")).alias("spans"))


def op5_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    n_lines = F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("long")
    return line_dedup(docs.withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(n_lines))).select(
        "doc_id", F.col("n_lines").cast("long"), F.col("removed_lines").cast("long").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op6_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return pack_documents(docs, tokenizer_path(), size=2048, end_id=0).withColumnRenamed("id", "doc_id")


def op7_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return suffix_dedup(docs, size=400).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_count_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return substring_dedup(docs, size=35).select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op9_simhash_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).withColumnRenamed("id", "doc_id")


def op10_text_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, read_table(spark, sf_dir, "labels"))
    held_out = F.coalesce(remainder(F.col("doc_id")) == 2, F.lit(False))
    return score_toxicity(docs.select("doc_id", "text", "lang"), model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "rejected")


def op11_reduced_alphabet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(read_table(spark, sf_dir, "documents"), least=5, times=3, every=97, factor=2)


def op12_lz_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_prints(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op13_dominance_skyband(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(read_table(spark, sf_dir, "documents"), least_docs=30, top=50)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op")}
