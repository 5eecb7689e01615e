"""Documents to training tokens: quality, line dedup, near dedup, mixing, encoding.

Each stage reads what its predecessor wrote and decides over all of it.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavefold.llm import byte_bpe, line_dedup, mixing, ngram_join, quality
from wavefold.llm.common import stage, table
from wavefold.session import ship_package

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    ship_package(spark)
    return quality.judge(docs).filter("kept").select(*COLUMNS)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the lines that an earlier one holds."""
    lean = line_dedup.line_dedup(docs)
    return lean.withColumn("text", F.col("kept_text")).withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    A document is an id and a text: rows that share an id are judged by their own text, of rows equal in both one stays.
    Its node is a 64-bit hash of both; a second hash tells rows that only share the node apart, and these all stay.
    A null, empty or wordless text is a copy of nothing; very long texts are judged whole; an empty table stays empty.
    """
    ship_package(spark)
    identity = ["doc_id", F.col("text").isNull(), "text"]
    named = docs.select(*COLUMNS, F.xxhash64(*identity).alias("node"), F.xxhash64(F.lit(1), *identity).alias("proof"))
    groups = ngram_join.ngram_components(named.select(F.col("node").alias("doc_id"), "text")).select(
        F.col("doc_id").alias("node"), "component_id").distinct()
    placed = stage(named.select("node", "doc_id").distinct().join(groups, "node"), "pipeline-groups")
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "node")  # rows without an id come last
    first = placed.groupBy("component_id").agg(F.min(order).alias("first"))
    again = stage(named.groupBy("node").agg(F.count(F.lit(1)).alias("rows"), (F.min("proof") < F.max("proof")).alias("mixed"))
                  .filter("rows > 1"), "pipeline-repeats")
    gone = (placed.select("node").join(first.select(F.col("first.node").alias("node")), "node", "left_anti")
            .join(again.filter("mixed"), "node", "left_anti"))  # different rows under one node: each stays
    left = named.join(gone, "node", "left_anti")
    one = (left.join(again, "node", "left_semi").groupBy("node", "proof").agg(F.min(F.struct(*COLUMNS)).alias("row"))
           .select("row.*"))
    return left.join(again, "node", "left_anti").select(*COLUMNS).unionByName(one)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, those of scarce sources again, so that the sources meet their target weights."""
    return mixing.mixed(docs).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text and the digest of the text they decode to; a text that does not come back is an error."""
    ship_package(spark)
    done = byte_bpe.encode_documents(docs, decoded=True)
    same = F.col("decoded_sha256") == F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    checked = F.when(same, F.col("decoded_sha256")).otherwise(F.raise_error(F.lit("token ids do not decode to the text")))
    return done.select("doc_id", "source", "lang", "n_tokens", "token_ids", checked.alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

# The similarity join and the tokenizer have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES:
        docs = stage(work(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
