"""From raw documents to packed training sequences: quality filter, near-duplicate removal, substring
removal, benchmark decontamination, packing.  Each stage is written as Parquet and read again.

In every stage: a null text is an empty one; rows that share an id are judged by their own texts, but for
near duplicates, where an id is one node and all its rows stay or go; a row with a null id stays unless its
own text makes it go; repeated rows count each; an empty table gives an empty one; further columns of
the documents pass through, but names that begin with an underscore and that a stage needs raise."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm import decontaminate, near_dup, packing, quality, substring
from keelson.llm.common import join_small, read
from keelson.llm.queries import tokenizer_file
from keelson.session import scratch_path


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = quality.fit_classifier(docs, read(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model).where("_good").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near duplicates."""
    dropped = near_dup.link_documents(docs).where(~F.col("kept")).select("doc_id").distinct()
    return join_small(docs, dropped, ["doc_id"], 8, "left_anti")


def substring_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words that repeat a passage of an earlier document; texts that lose nothing
    stay as they are, and n_chars follows the text."""
    found = substring.substring_dedup(docs)
    cut = F.col("_n_removed") > 0
    new = {"text": F.when(cut, F.col("_kept")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(cut, F.length("_kept")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return found.withColumns(new).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    found = decontaminate.find_contamination(docs, read(spark, sf_dir, "benchmark"))
    return found.where(~decontaminate.contaminated(F.col("_n_hit"), F.col("_n_words"))).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences with their token ids (little-endian 32-bit) and the ids' checksum."""
    pieces = packing.pack_documents(docs, tokenizer_file("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", "ids", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("quality classifier", quality_filter), ("MinHash near-dedup", near_dedup), ("substring dedup", substring_removal),
          ("benchmark decontamination", decontamination), ("packing", packed)]

# A trained classifier and a packing order are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        out = scratch_path(spark, f"stage{i}")
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
