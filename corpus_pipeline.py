"""A corpus from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a frame; it is written as
Parquet and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabmeter.llm.decontam import decontaminate
from cabmeter.llm.linededup import line_dedup
from cabmeter.llm.minhash import minhash_dedup
from cabmeter.llm.packing import pack_documents
from cabmeter.llm.queries import tokenizer_path
from cabmeter.llm.tables import drop_written, read_table, written
from cabmeter.llm.toxicity import fit_toxicity, score_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents under the toxicity threshold of their language."""
    model = fit_toxicity(docs, read_table(spark, sf_dir, "labels"))
    scored = score_toxicity(docs, model, score_col="__score", reject_col="__rejected")
    return scored.where("not __rejected").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier line of the corpus stands for.
    A document that has no other lines left goes."""
    cut = line_dedup(docs, out="__removed")
    if "n_chars" in docs.columns:
        n_chars = F.when(F.col("__removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
        cut = cut.withColumn("n_chars", n_chars)
    blank = (F.col("__removed") > 0) & ~F.col("text").rlike(r"\S")
    return cut.where(~F.coalesce(blank, F.lit(False))).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: shingles of five words,
    similarity of at least 0.8."""
    return minhash_dedup(docs, shingle=5, percent=80).select(*docs.columns)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark")).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences of 2048 tokens."""
    return pack_documents(docs, tokenizer_path(), size=2048, end_id=0).withColumnRenamed("id", "doc_id")


STAGES = [("toxicity", toxicity), ("line dedup", lines), ("MinHash near-dedup", near_duplicates),
          ("benchmark decontamination", benchmark_passages), ("best-fit packing", packing)]

# Neither the classifier nor the tokenizer can be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        done = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        drop_written(docs)
        docs = done
    return docs
