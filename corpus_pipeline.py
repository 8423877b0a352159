"""The corpus pipeline: five stages, each over all that its predecessor kept.

documents -> quality classifier -> n-gram Jaccard join -> benchmark decontamination -> secret scans -> packing.
Each stage but the last returns the columns of documents; the last returns one row per packed piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envflow.llm import decontamination, jaccard_join, packing, quality, secrets
from envflow.llm.common import discard, forget, scratch, written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go. It is fitted on labels outside the held-out fold."""
    forget(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.train(docs, labels, held_in=~quality.held_out()))


#: The stage's similarity, in percent of shingles of so many words; 85 percent of four is the contract of the query op4.
PERCENT, SHINGLE_WORDS = 80, 5


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the document with the smallest id stays; so do rows without an id.

    Of rows that share that id one stays, that with the smallest hash of its text and then of all its columns.
    """
    forget(spark)
    heads = jaccard_join.components(docs, PERCENT, SHINGLE_WORDS).where("doc_id = component_id").select("doc_id").distinct()
    kept = docs.where("doc_id IS NOT NULL").join(heads, "doc_id", "left_semi")
    kept = kept.groupBy("doc_id").agg(F.min_by(F.struct(*docs.columns), F.struct(F.xxhash64("text"), F.xxhash64(*docs.columns))).alias("row")).select("row.*")
    return kept.unionByName(docs.where("doc_id IS NULL")).select(*docs.columns)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    forget(spark)
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; no document goes."""
    forget(spark)
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that stay, with their places in sequences."""
    forget(spark)
    return packing.pack(docs)


STAGES = [("quality", good_quality), ("near_duplicates", one_of_each), ("decontamination", uncontaminated), ("secrets", without_secrets), ("packing", packed)]
#: SQL can express neither the trained classifier nor the tokenizer; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over documents. Each other stage's rows are written to the shared folder and read again.

    What a stage wrote on its way is deleted when its rows are written, and its input when it has been read. A null
    text is an empty one and stays null; rows without an id are judged by their texts alone and stay apart; repeated
    rows are one document; an empty table gives an empty result.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with scratch() as made:
            after = written(stage(spark, docs, sf_dir), name)
            made.remove(after)
        discard(docs)
        docs = after
    return STAGES[-1][1](spark, docs, sf_dir)
